"""Token ids of whole texts inside a task.

``tokenizers`` and ``tiktoken`` read the same public vocabulary; the second takes a quarter of the time, so it does
the work. With ``special`` it gives the ids of the first as they come, where the name of the end token in a text is that
token; without, those of the first with ``encode_special_tokens``, where it is ordinary text. Its pattern fails on about a million white-space characters in a row, so long runs are cut out where the
pattern would cut them and encoded as the one piece that they are. Tests hold the two against each other.
"""

from __future__ import annotations

import base64
import functools
import re
import sys
from array import array
from collections.abc import Iterator

# White space of the vocabulary's pattern, which is less than Python's, and the longest run left to that pattern.
WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
LONGEST_RUN = 500_000
# The only special token of the public vocabulary.
END_NAME, END_ID = "<|endoftext|>", 50256


class TextEncoder:
    """Ids of a text as little-endian unsigned 32-bit numbers."""

    def __init__(self, ranks: str, special: bool = False) -> None:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        # Special tokens are cut out here, because their strings may also be ordinary text.
        self.special = special
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.one_piece = functools.cache(lambda: tiktoken.Encoding("piece", pat_str="(?s:.+)", mergeable_ranks=table, special_tokens={}))

    def _ids(self, text: str) -> Iterator[list[int]]:
        if self.special and END_NAME in text:
            done = 0
            while (at := text.find(END_NAME, done)) >= 0:
                yield from self._plain(text[done:at])
                yield [END_ID]
                done = at + len(END_NAME)
            text = text[done:]
        yield from self._plain(text)

    def _plain(self, text: str) -> Iterator[list[int]]:
        done = 0
        if len(text) > LONGEST_RUN:
            for run in WHITE.finditer(text):
                if run.end() - run.start() > LONGEST_RUN:
                    # The last character of a run stands with what follows it.
                    end = run.end() - (run.end() < len(text))
                    yield self.encoding.encode_ordinary(text[done:run.start()])
                    yield self.one_piece().encode_ordinary(text[run.start():end])
                    done = end
        yield self.encoding.encode_ordinary(text[done:] if done else text)

    def encode(self, text: str | None, last: int | None = None) -> array:
        """Ids of the whole text, and then ``last`` if it is given."""
        ids = array("I")
        for some in self._ids(text or ""):
            ids.extend(some)
        if last is not None:
            ids.append(last)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids


@functools.cache
def _encoder(ranks: str, special: bool) -> TextEncoder:
    return TextEncoder(ranks, special)


def encoder(ranks: str | None = None, special: bool = False) -> TextEncoder:
    """The encoder of this Python worker; by default the public byte-level vocabulary."""
    import public_tokenizers

    return _encoder(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), special)
