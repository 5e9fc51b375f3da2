import random
import re
import time

import pytest
from pyspark.sql import functions as F

from millrace.llm.pii_transduce import KINDS, Tape, all_spans, find_personal_data, luhn, mask_personal_data, plain_spans

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain(text):
    found = []
    for n, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), n, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(found)]


HARD = ["a@b.com_x@c.org", "@@a@b@c.de", "1.2.3.4.5.6.7.8", "001.2.3.255 256.1.1.1", "4111-1111 1111 1111 11", "+1 (((( 2 +1234567890-", "a@b", "x.@-.-.",
        "12 +49 30 1234567 4111111111111111", "😀 a@b.org", "+" * 50 + "1", "1" * 3000, "a." * 2000 + "@x.y", "9999999999.1.1.1", "%@a.b%@c.d"]


@pytest.mark.parametrize("text", HARD)
def test_plain_detectors(text):
    assert plain_spans(text) == plain(text)


@pytest.mark.parametrize(("text", "kind", "cut"), [
    ("write to jane [at] example (dot) com now", "email", "jane [at] example (dot) com"),
    ("jane dot doe at example dot org", "email", "jane dot doe at example dot org"),
    ("ｂｏｂ＠ｅｘ.org", "email", "ｂｏｂ＠ｅｘ.org"),
    ("b​ob@ex.org", "email", "b​ob@ex.org"),
    ("аdmin@example.com", "email", "аdmin@example.com"),
    ("call plus four four seven one two three four five six seven eight nine!", "phone", "plus four four seven one two three four five six seven eight nine"),
    ("host 10[dot]0[dot]0[dot]1 down", "ip", "10[dot]0[dot]0[dot]1"),
    ("four one one one one one one one one one one one one one one one", "card", "four one one one one one one one one one one one one one one one"),
    ("ring five five five one two three four five six seven.", "phone", "five five five one two three four five six seven"),
    ("jane@example dot org", "email", "jane@example dot org"),
    ("ping 10 dot 0 dot 0 dot 1 now", "ip", "10 dot 0 dot 0 dot 1"),
    ("jane [at] example dot com", "email", "jane [at] example dot com"),
    ("ask jane at example [dot] com!", "email", "jane at example [dot] com"),
    ("jane @ example dot com", "email", "jane @ example dot com"),
    ("jane dot doe (at) mail dot example.com", "email", "jane dot doe (at) mail dot example.com"),
    ("jane at mail dot example.com", "email", "jane at mail dot example.com"),
    ("jane dot doe at example.com", "email", "jane dot doe at example.com"),
    ("a dot b dot c dot d dot e dot f dot g at h dot i dot j dot k dot l dot m dot org", "email",
     "a dot b dot c dot d dot e dot f dot g at h dot i dot j dot k dot l dot m dot org"),
    ("ping 10 dot 0[dot]0.1 now", "ip", "10 dot 0[dot]0.1"),
])
def test_disguises(text, kind, cut):
    base, more = all_spans(text)
    assert [(k, text[s:e]) for s, e, k in more] == [(kind, cut)]


@pytest.mark.parametrize("text", ["look at the dot com boom", "meet me at noon", "one two three", "He was at home. The dot matters.", "größe – zwölf × 3", "one @ two", "one two three four five six", "version 1 dot 2 dot 3", "She was at a dot on the map."])
def test_clean_texts_have_no_spans(text):
    assert all_spans(text) == ([], [])


@pytest.mark.parametrize("text", ["Look at example.com", "Look at this (dot) com", "He was [at] home. A dot com"])
def test_mixed_styles_leave_prose_alone(text):
    assert all_spans(text) == ([], [])


@pytest.mark.parametrize("text", ["a dot " * 200_000, "a at " * 200_000, "a.a at a dot " * 100_000, "@a dot " * 100_000, "x" * 1_000_000 + " dot at"])
def test_long_chains_stay_linear(text):
    start = time.process_time()
    all_spans(text)
    assert time.process_time() - start < 30


def test_tape_maps_back_through_several_rewrites():
    tape = Tape("abc def ghi").rewrite([(0, 3, "X"), (4, 7, "")]).rewrite([(0, 2, "YZ")])
    assert tape.text == "YZ ghi"
    assert tape.source(0, 2) == (0, 4) and tape.source(3, 6) == (8, 11) and tape.source(2, 6) == (7, 11)


def test_operator(documents, odd_documents, no_documents):
    for docs in (documents.select("doc_id", "text"), odd_documents.withColumnRenamed("labels", "pii_spans")):
        for r in find_personal_data(docs).collect():
            assert [(x.start, x.end, x.kind) for x in r.pii_spans if x.disguised == "no"] == plain(r["text"])
            assert r.pii_spans == sorted(r.pii_spans, key=lambda x: (x.start, KINDS.index(x.kind), x.end))
    assert find_personal_data(no_documents).count() == 0


def test_masking(spark):
    rows = [(1, "a@b.org and jane [at] x (dot) com, 10.0.0.1"), (2, None), (3, ""), (4, "clean")]
    out = spark.createDataFrame(rows, "doc_id long, text string").withColumn("m", mask_personal_data(F.col("text")))
    assert [r.m for r in out.orderBy("doc_id").collect()] == ["[EMAIL] and [EMAIL], [IP]", None, "", "clean"]


STYLES = {
    "at": ["@", " at ", " [at] ", "(at)", "\tAT\n", " @ ", "<at>"], "dot": [".", " dot ", "[dot]", " (punkt) ", "\ndot ", " [period] "],
}
WORDS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]


def disguise(rng, text):
    """The text with its signs and digits written in some of many ways, at least one of them a disguise."""
    while True:
        out, hidden = "", False
        for c in text:
            kind = {"@": "at", ".": "dot"}.get(c)
            if kind:
                written = rng.choice(STYLES[kind])
                hidden |= written.strip() != c
                out += written
            else:
                out += c
        # A bare "at" counts only beside a dot in disguise.
        if hidden and ("." not in text or re.search("(?i)dot|punkt|period|[\\[(<]at|@", out)):
            return out


def test_any_mixture_of_disguises_maps_back():
    rng, missed = random.Random(6), []
    for _ in range(600):
        name = f"{rng.choice(['jane', 'bob_k', 'x-y'])}@{rng.choice(['example', 'mail-7'])}.{rng.choice(['com', 'co.uk', 'internationaladdressingpublicdomain'])}"
        written = disguise(rng, name)
        text = f"Write, {written}; soon"
        if (text[7:7 + len(written)], "email") not in {(text[s:e], k) for s, e, k in sum(all_spans(text), [])} and not re.search(r"(?i)[^\]\[()<>@]\sat\s(?!.*(dot|punkt|period))", written):
            missed.append(written)
    assert not missed


def test_addresses_spelled_in_part():
    rng = random.Random(7)
    for _ in range(300):
        digits = [[rng.choice("012") if n == 3 and i == 0 else rng.choice("01234") for i in range(n)] for n in (rng.randint(1, 3) for _ in range(4))]
        spelled = [[WORDS[int(d)] if rng.random() < 0.6 else d for d in part] for part in digits]
        if not any(len(d) > 1 for part in spelled for d in part):
            spelled[0] = [WORDS[int(d)] for d in digits[0]]
        parts = [" ".join(p) if any(len(d) > 1 for d in p) else "".join(p) for p in spelled]
        written = parts[0] + "".join(rng.choice([" dot ", "[dot]", " dot\n"]) + p for p in parts[1:])
        text = f"host: {written}, up"
        assert (written, "ip") in {(text[s:e], k) for s, e, k in sum(all_spans(text), [])}, written


@pytest.mark.parametrize("text", ["a@ " * 200_000, "a" * 500_000 + "@ " * 100_000, "one dot " * 60_000, "1.1.one." * 60_000, "a.b at c dot " * 50_000, "[dot]" * 60_000])
def test_long_texts_stay_linear(text):
    def seconds(t):
        begun = time.perf_counter()
        all_spans(t)
        return time.perf_counter() - begun

    short = min(seconds(text[:len(text) // 4]) for _ in range(2))
    assert seconds(text) < 10 * short + 1
