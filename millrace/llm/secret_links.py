"""Secrets, and credentials whose parts lie apart.

Strong spans (assignments, access keys, long hexadecimal runs) are always reported. Weak candidates (access
identifiers, secret-looking values, endpoints) are ordered by position and swept once in each direction;
the sweep is an interval join inside a scope, which ends at a blank line. A weak candidate is reported when
a complementary part lies in its scope: an identifier or endpoint needs a secret, a secret needs
an identifier or endpoint. All of it is column functions on one row, so no text moves between tasks.

Defined results: a null or empty text has no spans; repeated rows are scanned each by themselves; extra
columns pass through and give way to result columns of the same name. Offsets are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import scan, spans_of, whole
from millrace.operators.once import with_once

# The strong patterns. Repeats are possessive where they can be: they loop then, where others may recurse or
# come back.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}+"
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint", "break")

IDENTIFIER = (r"""(?i)(?<![a-z0-9])(?:user(?:[_-]?(?:name|id))?|login|account(?:[_-]?id)?|client[_-]?id|tenant[_-]?id|"""
              r"""access[_-]?key[_-]?id|key[_-]?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}+""")
WEAK_SECRET = (r"""(?i)(?<![a-z0-9_])(?:pwd|pass|pass_?phrase|auth|key|credentials?|private_?key|signature)["']?"""
               r"""\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}+""")
MIXED = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}+={0,2}"
ENDPOINT = (r"""(?i)(?<![a-z0-9+.-])(?:[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{4,}+|(?:host|server|endpoint|database|db_?host|url)"""
            r"""["']?\x20*[:=]\x20*["']?[a-z0-9-]++(?:\.[a-z0-9-]++)++(?::[0-9]{2,5})?)""")
BLANK_LINE = r"\n(?:[\x20\t\r]*+\n)++"

PART = "struct<start:int,rank:int,end:int>"
PLACE = "struct<start:int,end:int>"
SWEPT = (f"struct<start:int,rank:int,end:int,prev_id:{PLACE},prev_secret:{PLACE},prev_endpoint:{PLACE},"
         f"next_id:{PLACE},next_secret:{PLACE},next_endpoint:{PLACE}>")


def ranked(spans: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end")))


def when_found(gate: Column, parts: Column) -> Column:
    return F.when(gate, parts).otherwise(F.array().cast(f"array<{PART}>"))


def strong_parts(text: Column) -> Column:
    assign = F.filter(spans_of(text, ASSIGN, group=2), lambda x: F.length(x["value"]) >= 6)
    access = F.filter(spans_of(text, ACCESS), lambda x: x["end"] - x["start"] >= 20)
    runs = spans_of(text, HEX)
    return F.concat(
        when_found(text.rlike("(?i)password|passwd|secret|token|api_?key"), ranked(assign, "assign")),
        when_found(F.contains(text, F.lit("AKIA")), ranked(access, "access")),
        when_found(text.rlike("[0-9a-f]{24}"), ranked(runs, "hex")))


def weak_parts(text: Column) -> Column:
    mixed = F.filter(spans_of(text, MIXED), lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[a-z]") & x["value"].rlike("[A-Z]"))
    return F.concat(
        ranked(spans_of(text, IDENTIFIER), "identifier"), ranked(spans_of(text, WEAK_SECRET), "secret"),
        ranked(mixed, "secret"), ranked(spans_of(text, ENDPOINT), "endpoint"), ranked(spans_of(text, BLANK_LINE), "break"))


def is_part(x: Column, role: str) -> Column:
    roles = {"id": (1, 3), "secret": (0, 2, 4), "endpoint": (5,)}
    return x["rank"].isin(*roles[role])


def sweep(parts: Column) -> Column:
    """Parts in order, each with the nearest part of every role before and after it in its scope."""
    none = F.lit(None).cast(PLACE)
    place = lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))
    roles = ("id", "secret", "endpoint")
    own = ("start", "rank", "end")

    def state(acc: Column, x: Column) -> list[Column]:
        return [F.when(x["rank"] == 6, none).when(is_part(x, r), place(x)).otherwise(acc[r]).alias(r) for r in roles]

    def forward(acc: Column, x: Column) -> tuple[list[Column], Column]:
        # A weak value inside a stronger part is that part, not a second one.
        blocked = ((x["rank"] == 3) & (x["start"] < acc["strong_end"])) | ((x["rank"] == 4) & (x["start"] < acc["any_end"]))
        part = F.struct(*[x[n].alias(n) for n in own], *[acc[r].alias(f"prev_{r}") for r in roles], *[none.alias(f"next_{r}") for r in roles])
        moved = [
            *state(acc, x),
            F.when(x["rank"] <= 2, F.greatest(acc["strong_end"], x["end"])).otherwise(acc["strong_end"]).alias("strong_end"),
            F.when(x["rank"] != 6, F.greatest(acc["any_end"], x["end"])).otherwise(acc["any_end"]).alias("any_end")]
        names = (*roles, "strong_end", "any_end")
        return [F.when(blocked, acc[n]).otherwise(m).alias(n) for n, m in zip(names, moved, strict=True)], F.when(~blocked, part)

    def backward(acc: Column, x: Column) -> tuple[list[Column], Column]:
        return state(acc, x), F.struct(
            *[x[n].alias(n) for n in own], *[x[f"prev_{r}"].alias(f"prev_{r}") for r in roles], *[acc[r].alias(f"next_{r}") for r in roles])

    begin = {r: none for r in roles}
    # A secret that two patterns find is blocked by itself the second time.
    ordered = scan(F.sort_array(parts), begin | {"strong_end": F.lit(-1), "any_end": F.lit(-1)}, forward, SWEPT)
    return F.reverse(scan(F.reverse(ordered), begin, backward, SWEPT))


def has(x: Column, role: str) -> Column:
    return x[f"prev_{role}"].isNotNull() | x[f"next_{role}"].isNotNull()


def link_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the spans of every whole text and the credentials linked from them.

    New columns: ``secret_spans``, an array of (start, end, kind) in order of start and kind, and
    ``credentials``, an array of (secret, identifier, endpoint) with the nearest parts of each secret.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("secret_spans", "credentials")]
    cue = r"(?i)user|login|account|client[_-]?id|tenant|key[_-]?id|://|host|server|endpoint|database|url"
    read = df.select(*rest, whole(F.col(f"`{text}`")).alias("_s_text"))
    strong = read.select(*rest, "_s_text", strong_parts(F.col("_s_text")).alias("_s_strong"))
    # Weak parts can only matter beside an identifier or an endpoint; an access key is an identifier too.
    partner = F.col("_s_text").rlike(cue) | F.exists("_s_strong", lambda x: x["rank"] == 1)
    weak = strong.select(*rest, "_s_strong", when_found(partner, weak_parts(F.col("_s_text"))).alias("_s_weak"))
    no_parts = F.array().cast(f"array<{SWEPT}>")
    parts = F.concat("_s_strong", "_s_weak")
    swept = weak.select(*rest, F.when(F.size(parts) > 0, sweep(parts)).otherwise(no_parts).alias("_s_swept"))
    reported = F.filter("_s_swept", lambda x: (x["rank"] <= 2) | (
        ((x["rank"] == 3) | (x["rank"] == 5)) & has(x, "secret")) | ((x["rank"] == 4) & (has(x, "id") | has(x, "endpoint"))))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    # Held once, so that a filter on a result does not repeat all of this below itself.
    told = with_once(swept, "_s_told", reported).select(*rest, "_s_told")
    return told.select(
        *rest,
        F.transform("_s_told", lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.element_at(kinds, x["rank"] + 1).alias("kind"))).alias("secret_spans"),
        F.transform(
            F.filter("_s_told", lambda x: is_part(x, "secret") & (has(x, "id") | has(x, "endpoint"))),
            lambda x: F.struct(
                F.struct(x["start"].alias("start"), x["end"].alias("end")).alias("secret"),
                F.coalesce(x["prev_id"], x["next_id"]).alias("identifier"),
                F.coalesce(x["prev_endpoint"], x["next_endpoint"]).alias("endpoint"))).alias("credentials"))
