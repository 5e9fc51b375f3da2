import hashlib
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm.fill_middle import Markers, fill_in_middle, restore

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(key, text, percent=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(units), "plain", text, None, None
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    spm_form = h[3] % 100 < spm
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm_form else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(units), "spm" if spm_form else "psm", out, len(prefix), len(middle)


HARD = ["a", " ", "\n\n \t", "  lead", "trail  ", "a\x0bb\x0cc\r\nd", "x<P>y", "<S", "a <S b> <M c> P>", "$1 \\E \\Q {2} (group)", "\xa0nbsp 　wide\x85nel",
        "😀 😀😀 é", "<P", "<<P >>", "word " * 7, "\x00 \x1c"]


def test_against_plain_version(spark, documents, odd_documents):
    hard = spark.createDataFrame([(i, t) for i in range(40) for t in HARD], "doc_id long, text string")
    for docs in (documents.select("doc_id", "text"), odd_documents, hard):
        out = fill_in_middle(docs).withColumn("back", restore(F.col("fim_form"), F.col("fim_text")))
        rows = out.collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert (r.fim_units, r.fim_form, r.fim_text, r.fim_prefix_chars, r.fim_middle_chars) == plain(r.doc_id, r["text"])
            assert r.back == (r["text"] or "")


def test_shares_and_other_markers(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words of"), "id", F.lit("here\nand there")).alias("text"))
    forms = {r.fim_form: r["count"] for r in fill_in_middle(docs).groupBy("fim_form").count().collect()}
    assert 900 < forms["plain"] < 1100 and 3 < forms["spm"] / forms["psm"] < 5.5
    marks = Markers("$\\1[", "{^}", "(.*)")
    out = fill_in_middle(docs, percent=100, spm_percent=0, markers=marks)
    assert out.filter("fim_form <> 'psm'").count() == 0
    assert out.filter(restore(F.col("fim_form"), F.col("fim_text"), marks) != F.col("text")).count() == 0


@pytest.mark.parametrize("text", ["ab " * 700_000, "x" * 2_000_000, " " * 2_000_000 + "x", "é\n" * 500_000])
def test_very_long_texts(spark, text):
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    for r in fill_in_middle(docs, percent=100).collect():
        assert (r.fim_units, r.fim_form, r.fim_text, r.fim_prefix_chars, r.fim_middle_chars) == plain(r.doc_id, text, 100)


def test_clashing_columns_and_empty_table(odd_documents, no_documents):
    out = fill_in_middle(odd_documents.withColumnRenamed("labels", "fim_text"))
    assert out.columns.count("fim_text") == 1 and out.count() == 12
    assert fill_in_middle(no_documents).count() == 0


def test_nothing_is_shuffled_and_no_python_runs(documents):
    plan = fill_in_middle(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
