"""What several test modules share. It has a name of its own, because a folder below has its own conftest."""

from __future__ import annotations


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
