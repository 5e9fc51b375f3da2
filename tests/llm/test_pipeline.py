import random
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
FOLDER = "/root/testdata/sf0.001"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_in_a_row(spark, documents):
    from test_line_quality import plain
    from test_pii_transduce import plain as plain_pii
    from test_signature_trees import plain_groups

    docs = documents
    kept = stage("quality")(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    base = {r.doc_id: plain(r.text) for r in docs.collect()}
    rows = {r.doc_id: r for r in kept.collect()}
    assert rows and all(base[k][0] >= 50 and base[k][4] * 2 <= base[k][0] for k in rows)
    assert all(r.n_chars == len(r.text) for r in rows.values())

    single = stage("near_duplicates")(spark, kept, FOLDER)
    groups = plain_groups([(k, r.text) for k, r in rows.items()], 5, 80)
    assert sorted(r.doc_id for r in single.collect()) == sorted({g for _, g in groups.values()})

    clean = stage("decontaminate")(spark, single, FOLDER)
    gone = {r.doc_id for r in single.collect()} - {r.doc_id for r in clean.collect()}
    benchmark = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    held = {k for k, r in rows.items() if any(t in r.text for t in benchmark)}
    assert held & {r.doc_id for r in single.collect()} <= gone

    private = stage("personal_data")(spark, clean, FOLDER)
    assert private.columns == docs.columns and private.count() == clean.count()
    assert all(not plain_pii(r.text) for r in private.collect())

    packed = stage("packing")(spark, private, FOLDER)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in private.collect()}


def test_odd_tables(spark, odd_documents, no_documents):
    body = " ".join(f"word{i}" for i in range(70)) + "."
    docs = odd_documents.unionByName(spark.createDataFrame(
        [(20, body, 1, "x"), (21, body, 1, "x"), (21, body, 1, "x"), (None, body, None, None)], "doc_id long, text string, n_words int, labels string"))
    assert sorted(str(r.doc_id) for r in stage("quality")(spark, docs, FOLDER).collect()) == ["20", "21", "21", "None"]
    stays = stage("near_duplicates")(spark, docs, FOLDER)
    assert sorted(str(r.doc_id) for r in stays.filter("text LIKE 'word0%'").collect()) == ["20", "None"]
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, no_documents, FOLDER).count() == 0
        out = step(spark, docs, FOLDER)
        if name != "packing":
            assert out.columns == docs.columns


def test_texts_of_one_id_are_documents_of_their_own(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(1, a), (2, a), (2, b), (3, b), (5, c), (5, c), (5, a + " more"), (None, a)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, `_row` int")
    kept = stage("near_duplicates")(spark, docs, FOLDER).collect()
    assert sorted((str(r.doc_id), r.text[0]) for r in kept) == [("1", "a"), ("2", "b"), ("5", "c"), ("None", "a")]


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER).collect()
    assert out and all(re.fullmatch(r"\d+", str(r.sequence_id)) for r in out)


def test_only_texts_that_may_go_are_shuffled(spark):
    from test_signature_trees import shuffle_bytes

    rng = random.Random(4)
    texts = [" ".join(str(rng.random()) for _ in range(2_000)) for _ in range(60)]
    rows = [*enumerate(texts), (60, texts[3] + " more"), (7, texts[7]), (None, texts[5])]
    single = stage("near_duplicates")(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER)
    before = set(shuffle_bytes(spark))
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in single.collect()) == [-1, *range(60)]
    assert sum(n for f, n in shuffle_bytes(spark).items() if f not in before) < sum(map(len, texts)) / 5
