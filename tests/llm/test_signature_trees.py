import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import signature_trees as trees
from millrace.llm.common import keep, may_be_among
from millrace.llm.components import connected_components


def plain_sets(rows, width):
    sets = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        wide = min(width, len(words))
        sets[key] = {tuple(words[i:i + wide]) for i in range(len(words) - wide + 1)} if words else set()
    return sets


def plain_groups(rows, width, percent):
    sets, holders = plain_sets(rows, width), defaultdict(list)
    for key, held in sets.items():
        for shingle in held:
            holders[shingle].append(key)
    common = Counter((a, b) for keys in holders.values() for i, a in enumerate(keys) for b in keys[i + 1:])
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.fixture(scope="module")
def corpus(spark):
    """Groups of near copies around the threshold, a passage that most share, exact copies."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage, rows = " ".join(word() for _ in range(30)), []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 20, 60, 120]))]
        for _ in range(rng.choice([1, 2, 6])):
            near = [word() if rng.random() < rng.choice([0, 0.01, 0.03]) else w for w in base]
            rows.append(" ".join(near) + (" " + passage if rng.random() < 0.6 else ""))
    rows += rows[:5] + [passage, passage + " tail"]
    return list(enumerate(rows))


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80), (1, 50)])
@pytest.mark.parametrize("block", [8_000_000, 60])
def test_groups_match_brute_force(spark, corpus, monkeypatch, width, percent, block):
    monkeypatch.setattr(trees, "BLOCK_SHINGLES", block)
    out = trees.jaccard_groups(spark.createDataFrame(corpus, "doc_id long, text string"), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == plain_groups(corpus, width, percent)


def test_test_data_matches_brute_force(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    out = trees.jaccard_groups(documents, 4, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == plain_groups(rows, 4, 85)


def test_tree_keeps_every_similar_pair():
    rng = np.random.default_rng(7)
    base = [np.unique(rng.integers(0, 1 << 63, 80, np.uint64)) for _ in range(8)]
    sets = sorted((np.unique(np.concatenate([rng.choice(b, 76, replace=False), rng.integers(0, 1 << 63, 4, np.uint64)]))
                   for b in base for _ in range(15)), key=len)
    got = {tuple(p) for p in trees.candidate_pairs(sets, 85, lambda some: False)}
    similar = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if trees.similar(sets[i], sets[j], 85)}
    assert similar <= got and len(got) < len(sets) ** 2 / 8


def test_odd_rows(spark, odd_documents, no_documents):
    out = trees.jaccard_groups(odd_documents).collect()
    assert len(out) == 12
    by_id = defaultdict(set)
    for r in out:
        by_id[r.doc_id].add((r.n_shingles, r.component_id))
    assert by_id[1] == by_id[2] - {(0, 2)} | {(0, 1)} and by_id[3] == {(0, 3)}
    assert by_id[4] == by_id[5] == {(1, 4)} and by_id[8] == by_id[9] == {(1, 8)}
    assert {c for _, c in by_id[None]} == {None}
    assert trees.jaccard_groups(no_documents).count() == 0


def test_rows_of_one_id_are_one_node(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "u v w x y z"), (3, "u v w x y z")]
    out = trees.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in out} == {1}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7)]
    root = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == root
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_shared_shingle_is_no_neighbourhood(spark):
    """Texts that share one passage of five words with the next one, as long texts do by chance; two near copies."""
    texts = [[f"w{i}x{j}" for j in range(60)] for i in range(40)]
    for a, b in zip(texts, texts[1:]):
        b[:5] = a[-5:]
    texts.append([*texts[7][:-1], "other"])
    docs = spark.createDataFrame([(" ".join(t),) for t in texts], "text string")
    edges = trees._neighbour_edges(trees._first_of_documents(docs, np.empty(0, np.uint64), 5, 80), 80).collect()
    ends = sorted(trees.class_number(trees.shingle_set(" ".join(texts[i]), 5)) for i in (7, 40))
    assert [sorted(e) for e in edges] == [ends]


@pytest.mark.parametrize("paired", [2, 3, 8])
@pytest.mark.parametrize("late", [False, True])
def test_similar_sets_are_tied_by_shared_keys(monkeypatch, paired, late):
    monkeypatch.setattr(trees, "PAIRED", paired)
    rng, percent = np.random.default_rng(5), 80
    sets = []
    for size in [1, 2, 3, 4, 5, 9, 30, 120] * 6:
        base = rng.integers(0, 1 << 63, size, np.uint64)
        for _ in range(rng.integers(1, 6)):
            sets.append(np.unique(np.where(rng.random(size) < 0.08, rng.integers(0, 1 << 63, size, np.uint64), base)))
    keys = np.concatenate(sets) >> np.uint64(trees.KEY_SHIFT)
    found, counts = np.unique(keys, return_counts=True)
    frequent = found[counts >= 4] if late else np.empty(0, np.uint64)
    firsts = [trees.first_keys(s, frequent, percent) for s in sets]
    key, count = np.concatenate([f for f, _ in firsts]), [len(f) for f, _ in firsts]
    node, size = np.repeat(np.arange(len(sets)), count), np.repeat([len(s) for s in sets], count)
    part = np.concatenate([np.where(np.arange(len(f)) < early, -1, 0) for f, early in firsts])
    (a, b, need, votes), _ = trees.shared_keys(key, part, node, size, percent)
    root = list(range(len(sets)))
    for x, y in zip(a[votes >= need].tolist(), b[votes >= need].tolist()):
        root = [root[x] if r == root[y] else r for r in root]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if trees.similar(sets[i], sets[j], percent)]
    assert len(pairs) > 30 and all(root[i] == root[j] for i, j in pairs)


def shuffle_bytes(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f: os.path.getsize(f) for f in files if f.endswith(".data") and "shuffle_" in f and os.path.exists(f)}


def test_kept_tables_leave_no_shuffle_files(spark):
    before = set(shuffle_bytes(spark))
    assert keep(spark.range(10_000).repartition(4, "id"), "kept").count() == 10_000
    assert not {f for f, n in shuffle_bytes(spark).items() if f not in before and n > 5_000}


def test_only_texts_with_neighbours_are_shuffled(spark):
    rng = random.Random(8)
    texts = [" ".join(str(rng.random()) for _ in range(2_000)) for _ in range(60)]
    rows = [*enumerate(texts), (60, texts[3] + " more"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    members = spark.createDataFrame([(3, 1, 1, 2_000), (60, 2, 1, 2_000)], "doc_id long, node long, root long, n long")
    before = set(shuffle_bytes(spark))
    assert {r.doc_id for r in trees._tasks(docs.filter("doc_id IS NOT NULL"), members, 80).collect()} == {3, 60}
    assert sum(n for f, n in shuffle_bytes(spark).items() if f not in before) < sum(map(len, texts)) / 5


def test_keys_of_a_table_are_always_found(spark):
    keys = spark.range(0, 4_000, 4).withColumn("key", F.struct("id", F.lit("x")))
    found = {r.id for r in spark.range(4_000).filter(may_be_among(keys, "key")(F.struct("id", F.lit("x")))).collect()}
    assert found >= set(range(0, 4_000, 4)) and len(found) < 1_600
    assert spark.range(100).filter(may_be_among(keys.limit(0), "key")(F.struct("id", F.lit("x")))).count() == 0
