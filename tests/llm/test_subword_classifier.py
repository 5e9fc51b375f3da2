import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import subword_classifier
from millrace.llm.queries import QUERIES
from millrace.llm.subword_classifier import Model, _bucket, bags, classify, fit_classifier, n_grams, train, training_sample

WHITE = " \t\n\x0b\x0c\r"
FULL = 1 << 64


def plain_bag(text, bits=16):
    """The n-grams of a short text, one by one."""
    words, place = [], 0
    found = Counter()

    def add(value, kind):
        found[int(_bucket(np.array([value % FULL], np.uint64), kind, bits)[0])] += 1

    while place < len(text):
        if text[place] in WHITE:
            place += 1
            continue
        end = place
        while end < len(text) and text[end] not in WHITE:
            end += 1
        folded = sum((ord(c) + 1) * pow(0x100000001B3, min(i, 64), FULL) for i, c in enumerate(text[place:end]))
        words.append((folded * 0x9E3779B97F4A7C15 + end - place) % FULL)
        place = end
    for w in words:
        add(w, 1)
    for a, b in zip(words, words[1:], strict=False):
        add(a * 31 + b, 2)
        add(int(a == b), 3)
    signs = "".join(" " if c in WHITE else c for c in f"\n{text}\n")
    for n in (2, 3, 4):
        for i in range(len(signs) - n + 1):
            gram = signs[i:i + n]
            if " " in gram[1:-1] or (gram[0] == " " and gram[-1] == " "):
                continue
            value = 0
            for c in gram:
                value = value * 0x5BD1E995 + ord(c)
            add(value, 10 + n)
    return found


TEXTS = ["", " \n", "a", "a a b", "x  y\n\nz", " lead and trail ", "same same same", "\tü 😀😀 é.\r\n", "one", "a" * 100 + " b" * 50]


def test_bags_against_one_by_one():
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("ab \n.ü😀") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    for text, (bucket, count) in zip(texts, bags(texts), strict=True):
        assert dict(zip(bucket.tolist(), count.tolist(), strict=True)) == plain_bag(text)
        assert bags([text])[0][0].tolist() == bucket.tolist(), "a text's bag does not depend on its batch"


def test_long_texts_in_pieces(monkeypatch):
    text = "some words here " * 40_000 + "x" * 700_000
    whole = sum(len(b) for _, b in n_grams([text]))
    assert whole > len(text)
    monkeypatch.setattr(subword_classifier, "PIECE", 64)
    pieces = sum(len(b) for _, b in n_grams(["ab cd " * 100]))
    borders = 6 * 100 // 64 + 2
    assert 0 <= sum(plain_bag("ab cd " * 100).values()) - pieces <= borders * 3


def labelled(n, seed):
    rng = random.Random(seed)
    good = ["river", "stone", "walks", "under", "light", "house", "green"]
    rows = []
    for i in range(n):
        words = [rng.choice(good) for _ in range(rng.randint(5, 40))]
        label = int(rng.random() < 0.7)
        rows.append((i, " ".join(words) if label else rng.choice([" ".join(w + "!!" for w in words), " ".join([words[0]] * 20), " ".join(w.upper() for w in words)]), label))
    return rows


def test_learns_what_the_labels_mark():
    rows, fresh = labelled(600, 1), labelled(300, 2)
    model = train([(*bags([t])[0], y) for _, t, y in rows])
    scores = model.scores([t for _, t, _ in fresh])
    assert np.mean((scores >= 0.5) == np.array([y for *_, y in fresh])) > 0.97
    again = train([(*bags([t])[0], y) for _, t, y in rows])
    assert np.array_equal(model.weights, again.weights), "the same rows give the same model"


def test_one_class_and_no_rows():
    assert train([]).scores(["a", ""]).tolist() == [0.5, 0.5]
    rows = [(*bags(["a b"])[0], 1)] * 3
    assert train(rows).scores(["x", ""]).min() > 0.99
    rows = [(*bags(["a b"])[0], 0)] * 3
    assert train(rows).scores(["x", ""]).max() < 0.01


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (8, 1), (9, None), (None, 1), (7, 5), (99, 1)], "doc_id long, quality int")
    model = fit_classifier(odd_documents, labels)
    out = classify(odd_documents.withColumn("score", F.lit("clash")), model)
    assert out.columns.count("score") == 1
    rows = out.collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    empty = {r.score for r in rows if not (r["text"] or "").strip()}
    assert len(empty) == 1
    assert classify(no_documents, model).count() == 0
    assert isinstance(fit_classifier(no_documents, labels), Model)


def test_the_bound_holds_and_is_the_same_each_time(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality")).repartition(7)
    one = {r._k for r in training_sample(labels, "doc_id", "quality", 100).collect()}
    other = {r._k for r in training_sample(labels.coalesce(1), "doc_id", "quality", 100).collect()}
    assert len(one) == 100 and one == other


@pytest.mark.parametrize("sf", ["0.01"])
def test_held_out_accuracy(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    scored = QUERIES["op12_subword_classifier"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert len(rows) > 50 and right / len(rows) >= 0.9
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert scored.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
