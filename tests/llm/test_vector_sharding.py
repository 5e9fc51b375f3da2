import zlib

import numpy as np

from millrace.llm.token_ids import encoder
from millrace.llm.vector_sharding import place_groups, shard_documents


def test_groups_go_where_the_dot_product_is_highest():
    vectors = np.array([[9, 1, 1], [1, 9, 1], [1, 1, 9], [2, 2, 2]], float)
    chosen = place_groups(vectors, 2)
    residual = np.full((2, 3), 0.5)
    scaled = vectors / vectors.sum(axis=0)
    for i in np.argsort(-scaled.max(axis=1), kind="stable"):
        assert np.isclose(residual[chosen[i]] @ scaled[i], (residual @ scaled[i]).max())
        residual[chosen[i]] -= scaled[i]


def check(docs, **more):
    rows, source = shard_documents(docs, **more).collect(), docs.collect()
    assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(map(repr, (r.doc_id for r in source)))
    known = {(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in source}
    assert {(r.doc_id, r["size"], r.text_crc32) for r in rows} == known
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    return rows


def test_shards_are_even_in_bytes_and_rows(documents):
    for more in ({}, {"rows_per_bucket": 40}):
        rows = check(documents, **more)
        sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
        counts = [sum(r.shard == s for r in rows) for s in range(8)]
        assert max(sizes) - min(sizes) < 0.1 * sum(sizes) / 8 + max(r["size"] for r in rows) and max(counts) - min(counts) <= 12


def test_equal_texts_stay_together_unless_they_are_too_many(spark):
    rows = [(i, f"text {i // 2} " + "w " * (i % 7 + i // 2 % 5)) for i in range(0, 400, 2)] * 2
    docs = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(rows)], "doc_id long, text string")
    text = {n: t for n, (_, t) in enumerate(rows)}
    shards = {}
    for r in check(docs):
        shards.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    hot = spark.createDataFrame([(n, "hot") for n in range(300)] + [(n, f"cold {n}") for n in range(300, 600)], "doc_id long, text string")
    sizes = {}
    for r in check(hot, rows_per_bucket=128):
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 30


def test_odd_rows(odd_documents, no_documents):
    check(odd_documents)
    assert shard_documents(no_documents).count() == 0


def test_tokens_are_even_without_blanks(spark):
    # As many bytes each, but one text in eight has many more tokens, parted by line ends or nothing at all.
    rich = [(i, "".join(f"{(i * j) % 7}\n" for j in range(i, i + 300))) for i in range(0, 400, 16)] + [
        (i, "".join(chr(0x4E00 + (i * 37 + j * 61) % 900) for j in range(200))) for i in range(8, 400, 16)]
    poor = [(i, f"{i:05d}" + "hello" * 119) for i in range(400) if i % 8]
    texts = dict(rich + poor)
    docs = spark.createDataFrame([(i, texts[i]) for i in sorted(texts)], "doc_id long, text string")
    tokens = {}
    for r in shard_documents(docs).collect():
        tokens[r.shard] = tokens.get(r.shard, 0) + len(encoder().encode(texts[r.doc_id]))
    assert len(tokens) == 8 and max(tokens.values()) < 1.1 * min(tokens.values())
