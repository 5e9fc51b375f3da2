"""Personal data, also where it is disguised, with offsets into the source text.

Plain detectors find e-mail addresses, network addresses, card and phone numbers. Where a text holds cues of
disguise (look-alike letters, full-width or spelled digits, words or signs for "at" and "dot"), transducers rewrite
it piece by piece and record for every written character where its source begins and ends; the same detectors
run on the rewritten text, and their spans are mapped back. Detection only depends on one text, so tasks work
on Arrow batches in place and nothing is shuffled.

Defined results: a null or empty text has no spans; repeated rows are scanned each by themselves; extra columns
pass through and give way to result columns of the same name. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from millrace.llm.common import whole

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
DIGIT_GROUPS = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    # From each @ back over the local part and on over the domain. Local parts hold no @, so no character is passed twice.
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end(), "email"
            done = found.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[Span]:
    for m in ADDRESS.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in m[0].split("."))):
            yield m.start(), m.end(), "ip"


def cards(text: str) -> Iterator[Span]:
    for m in DIGIT_GROUPS.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.start(), m.end(), "card"


def phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            yield m.start(), m.end(), "phone"


HAS_DIGIT = re.compile("[0-9]")


def plain_spans(text: str) -> list[Span]:
    """Spans of the plain detectors in order of start and kind."""
    found = list(emails(text)) if "@" in text else []
    if HAS_DIGIT.search(text):
        found += addresses(text)
        found += cards(text)
        if "+" in text:
            found += phones(text)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# Look-alikes of Latin letters in Cyrillic and Greek, signs like @ and ., invisible characters.
LOOKALIKES = dict(zip(
    "АВЕКМНОРСТХУаеорсухіјѕһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρ",
    "ABEKMHOPCTXYaeopcyxijshdqwABEZHIKMNOPTYXovp", strict=True))
LOOKALIKES |= {"＠": "@", "﹫": "@", "．": ".", "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "＋": "+", " ": " "}
INVISIBLE = "​‌‍⁠﻿­"
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
               "seven": "7", "eight": "8", "nine": "9"}

ODD = re.compile("[" + re.escape("".join(LOOKALIKES)) + INVISIBLE + "！-～٠-٩۰-۹\U0001d400-\U0001d7ff]")
SPELLED = re.compile(rf"(?i)(?<![a-z])(?:plus[\x20,.-]{{1,2}})?(?:{'|'.join(DIGIT_WORDS)})(?![a-z])(?:[\x20,.-]{{1,2}}(?:{'|'.join(DIGIT_WORDS)}|[0-9])(?![a-z]))+")
DIGIT_WORD = re.compile(rf"(?i)plus|{'|'.join(DIGIT_WORDS)}|[0-9]")
# White space around a sign in words: a few blanks, tabs or line ends.
GAP = r"[\x20\t\r\n]{1,3}"
NO_GAP = r"[\x20\t\r\n]{0,3}"
BRACKETED = re.compile(rf"(?i){NO_GAP}[\[({{<]{NO_GAP}(at|dot|punkt|point|punto|arroba|period|plus){NO_GAP}[\])}}>]{NO_GAP}")
# Bare words only count in the whole shape of an address: name at host dot end. Each sign may be real or a word. Parts
# are taken as they stand, without a way back, so that long chains stay linear.
NAME = re.compile(rf"(?i)[a-z0-9_%+-]++(?:(?:\.|{GAP}dot{GAP})[a-z0-9_%+-]++)*+")
BARE_AT = re.compile(rf"(?i)@|{GAP}at{GAP}")
HOST = re.compile(rf"(?i)[a-z0-9-]++(?:(?:\.|{GAP}dot{GAP})[a-z0-9-]++)*+")
HOST_DOT = re.compile(rf"(?i)\.|{GAP}dot{GAP}")
HOST_END = re.compile(r"(?i)[a-z]{2,}+(?![a-z0-9])")
DOTTED_NUMBERS = re.compile(rf"(?i)(?<![0-9])[0-9]{{1,3}}(?:(?:\.|{GAP}dot{GAP})[0-9]{{1,3}}){{3}}(?![0-9])")
BARE_DOT = re.compile(rf"(?i){GAP}dot{GAP}")
# Four parts of one to three digits, in figures or words, between real or spelled dots.
ANY_DOT = rf"(?:{NO_GAP}[\[({{<]{NO_GAP}(?:dot|punkt|point|punto|period){NO_GAP}[\])}}>]{NO_GAP}|{GAP}dot{GAP}|\.)"
ANY_DIGIT = rf"(?:{'|'.join(DIGIT_WORDS)}|[0-9])"
ANY_PART = rf"{ANY_DIGIT}(?:[\x20-]?{ANY_DIGIT}){{0,2}}+"
SPELLED_ADDRESS = re.compile(rf"(?i)(?<![a-z0-9.]){ANY_PART}(?:{ANY_DOT}{ANY_PART}){{3}}(?![a-z0-9])")
SPACED_SIGN = re.compile(r"(?<=[A-Za-z0-9])\x20{1,2}@\x20{1,2}(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])\x20@(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])@\x20(?=[A-Za-z0-9])")
SIGNS = {"at": "@", "arroba": "@", "dot": ".", "punkt": ".", "point": ".", "punto": ".", "period": ".", "plus": "+"}
ADDRESS_TOKEN = re.compile(rf"(?i){'|'.join(DIGIT_WORDS)}|[0-9]|dot|punkt|point|punto|period|\.")

NOT_HOSTS = {"a", "an", "any", "each", "every", "my", "our", "that", "the", "this", "your"}

Rewrite = tuple[int, int, str]


def odd_characters(text: str) -> Iterator[Rewrite]:
    for m in ODD.finditer(text):
        c = m[0]
        if c in INVISIBLE:
            yield m.start(), m.end(), ""
        else:
            plain = LOOKALIKES.get(c) or unicodedata.normalize("NFKC", c)
            if c.isdigit():
                plain = str(unicodedata.digit(c))
            yield m.start(), m.end(), plain


def spelled_digits(text: str) -> Iterator[Rewrite]:
    for m in SPELLED.finditer(text):
        words = list(DIGIT_WORD.finditer(text, m.start(), m.end()))
        if len(words) < 4:
            continue
        for i, w in enumerate(words):
            # The separator before a word goes with it, so that the digits join up.
            yield (words[i - 1].end() if i else w.start()), w.end(), (DIGIT_WORDS | SIGNS).get(w[0].lower(), w[0])


def spelled_addresses(text: str) -> Iterator[Rewrite]:
    """Dotted numbers with words among their digits, however short the parts are."""
    for m in SPELLED_ADDRESS.finditer(text):
        done = m.start()
        for w in ADDRESS_TOKEN.finditer(text, m.start(), m.end()):
            yield done, w.end(), DIGIT_WORDS.get(w[0].lower(), w[0] if w[0].isdigit() else ".")
            done = w.end()


def spelled_phones(text: str) -> Iterator[Span]:
    """Ten to fifteen digits, most of them words, need no plus sign to be a phone number."""
    for m in SPELLED.finditer(text):
        digits = [w[0].lower() for w in DIGIT_WORD.finditer(m[0]) if w[0].lower() != "plus"]
        if 10 <= len(digits) <= 15 and sum(d in DIGIT_WORDS for d in digits) * 2 > len(digits):
            yield m.start(), m.end(), "phone"


def marked_signs(text: str) -> Iterator[Rewrite]:
    for m in BRACKETED.finditer(text):
        yield m.start(), m.end(), SIGNS[m[1].lower()]
    for m in SPACED_SIGN.finditer(text):
        yield m.start(), m.end(), "@"


def host_dots(text: str, start: int) -> list[tuple[int, int]]:
    """Places of the dots, real or words, of the host that starts here; none if no part of it can be its end."""
    m = HOST.match(text, start)
    dots = [d.span() for d in HOST_DOT.finditer(text, *m.span())] if m else []
    while dots and not HOST_END.match(text, dots[-1][1]):
        dots.pop()
    return dots


def bare_signs(tape: Tape) -> Iterator[Rewrite]:
    """Words for signs, on the tape of the marked signs: a dot that was in brackets counts as a word."""
    text = tape.text

    def disguised(dots: list[tuple[int, int]]) -> bool:
        return any(last - first > 1 for first, last in (tape.source(*d) for d in dots))

    def words(dots: list[tuple[int, int]]) -> Iterator[Rewrite]:
        return ((start, end, ".") for start, end in dots if end - start > 1)

    for m in NAME.finditer(text):
        at = BARE_AT.match(text, m.end())
        dots = host_dots(text, at.end()) if at else []
        if not dots:
            continue
        before = [d.span() for d in HOST_DOT.finditer(text, *m.span())]
        if at[0] != "@":
            # "Look at example.com" is no address: a word for "at" needs another disguise beside it.
            if text[at.end():dots[-1][0]].lower() in NOT_HOSTS or not disguised(before + dots):
                continue
            yield *at.span(), "@"
        yield from words(before + dots)
    # Also where something else stands before a real @.
    at = text.find("@")
    while at >= 0:
        yield from words(host_dots(text, at + 1))
        at = text.find("@", at + 1)
    for m in DOTTED_NUMBERS.finditer(text):
        for dot in BARE_DOT.finditer(text, *m.span()):
            yield *dot.span(), "."


class Tape:
    """A text and, for each of its characters, where the source of that character begins and ends.

    Only the breaks are kept: between two breaks the text is copied one to one.
    """

    def __init__(self, text: str) -> None:
        self.text, self.out, self.begin, self.end, self.copied = text, [0], [0], [0], [True]

    def source(self, start: int, end: int) -> tuple[int, int]:
        i, j = bisect.bisect_right(self.out, start) - 1, bisect.bisect_right(self.out, end - 1) - 1
        first = self.begin[i] + (start - self.out[i] if self.copied[i] else 0)
        last = self.begin[j] + (end - self.out[j]) if self.copied[j] else self.end[j]
        return first, last

    def rewrite(self, rewrites: list[Rewrite]) -> Tape:
        """The tape after one transducer; of overlapping rewrites the first counts."""
        text, done, at = [], 0, 0
        out, begin, end, copied = [], [], [], []

        def copy(upto: int) -> None:
            nonlocal at
            if upto <= done:
                return
            # A copied stretch may span breaks of the tape before.
            i = bisect.bisect_right(self.out, done) - 1
            pos = done
            while pos < upto:
                stop = min(upto, self.out[i + 1] if i + 1 < len(self.out) else upto)
                if stop > pos:
                    first, _ = self.source(pos, pos + 1)
                    out.append(at)
                    begin.append(first)
                    end.append(self.end[i])
                    copied.append(self.copied[i])
                    at += stop - pos
                    pos = stop
                i += 1
            text.append(self.text[done:upto])

        for start, stop, plain in sorted(rewrites):
            if start < done or start == stop:
                continue
            copy(start)
            if plain:
                first, last = self.source(start, stop)
                out.append(at)
                begin.append(first)
                end.append(last)
                copied.append(False)
                text.append(plain)
                at += len(plain)
            done = stop
        copy(len(self.text))
        tape = Tape("".join(text))
        if out:
            tape.out, tape.begin, tape.end, tape.copied = out, begin, end, copied
        return tape


CUES = re.compile(rf"(?i)[\[({{<]{NO_GAP}(?:at|dot|punkt|point|punto|arroba|period|plus){NO_GAP}[\])}}>]|{GAP}dot{GAP}|\x20@|@\x20")
SPELLED_CUE = re.compile(rf"(?i)(?<![a-z])(?:{'|'.join(DIGIT_WORDS)})(?![a-z])[\x20,.-]{{1,2}}(?:{'|'.join(DIGIT_WORDS)}|[0-9])(?![a-z])")


def disguised_spans(text: str, known: list[Span]) -> list[Span]:
    """Spans that only show after the transducers, in source offsets, none inside a known one of its kind."""
    odd = not text.isascii() and ODD.search(text)
    if not (odd or CUES.search(text) or SPELLED_CUE.search(text)):
        return []
    tape = Tape(text)
    for transducer in (odd_characters, spelled_addresses, spelled_digits, marked_signs):
        if rewrites := list(transducer(tape.text)):
            tape = tape.rewrite(rewrites)
    if rewrites := list(bare_signs(tape)):
        tape = tape.rewrite(rewrites)
    if tape.text == text:
        return []
    candidates = [(*tape.source(start, end), kind) for start, end, kind in plain_spans(tape.text)]
    candidates += [s for s in spelled_phones(text) if not any(c[0] <= s[0] and s[1] <= c[1] and c[2] in ("phone", "card") for c in candidates)]
    taken = {kind: [(s, e) for s, e, k in known if k == kind] for kind in KINDS}
    found = []
    for first, last, kind in candidates:
        i = bisect.bisect_right(taken[kind], (first, len(text))) - 1
        if i < 0 or taken[kind][i][1] < last:
            found.append((first, last, kind))
    return found


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans and disguised spans."""
    base = plain_spans(text)
    return base, disguised_spans(text, base)


SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("kind", StringType()),
                   StructField("disguised", StringType())])


@F.pandas_udf(ArrayType(SPAN))
def _spans(texts: pd.Series) -> pd.Series:
    def one(text: str) -> list[dict]:
        base, more = all_spans(text or "")
        rows = [(s, e, k, "no") for s, e, k in base] + [(s, e, k, "yes") for s, e, k in more]
        rows.sort(key=lambda r: (r[0], KINDS.index(r[2]), r[1]))
        return [{"start": s, "end": e, "kind": k, "disguised": d} for s, e, k, d in rows]

    return texts.map(one)


def find_personal_data(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``pii_spans``, an array of (start, end, kind, disguised) in order of start and kind."""
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() != "pii_spans"]
    return df.select(*rest, _spans(whole(F.col(f"`{text}`"))).alias("pii_spans"))


@F.pandas_udf(StringType())
def _masked(texts: pd.Series) -> pd.Series:
    def one(text: str | None) -> str | None:
        if not text:
            return text
        base, more = all_spans(text)
        pieces, done = [], 0
        for start, end, kind in sorted(base + more, key=lambda s: (s[0], -s[1])):
            if start >= done:
                pieces += [text[done:start], f"[{kind.upper()}]"]
            done = max(done, end)
        return "".join(pieces) + text[done:]

    return texts.map(one)


def mask_personal_data(text: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    return _masked(text)
