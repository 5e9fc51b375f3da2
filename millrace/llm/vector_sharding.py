"""Shards that balance bytes, tokens and rows at once: vector bin packing over groups of equal texts.

Texts are read once, for size, token count and hash; from then on rows carry numbers only. Groups are dealt
into buckets of bounded size by their hash, and every bucket packs its groups for itself: largest first, each
into the shard where the dot product of its vector with the residual capacity is highest. Since every bucket
fills all shards alike, so do all together, at any number of buckets. A group with more rows or bytes than a
bucket can level out is split into chunks, so that a group of any size is spread. Slots are the places in a
bucket plus the counts of the buckets before it.

Defined results: a null text has size 1, checksum 0 and the group of the empty text; a null document id is an id
like any other; repeated rows are a group and each gets its own slot; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from millrace.llm.common import keep, whole
from millrace.llm.token_ids import encoder

ROWS_PER_BUCKET = 50_000
CHUNKS_PER_BUCKET = 64  # a group larger than this share of a bucket is split
GROUP = ["text_hash", "text_crc32", "size", "chunk"]
PLACED = "doc_id {key}, size long, text_crc32 long, bucket long, shard int, place long"


def place_groups(vectors: np.ndarray, shards: int, rotate: int = 0) -> np.ndarray:
    """Shard of each group; ``vectors`` has a row for each group and a column for each thing to balance."""
    total = np.maximum(vectors.sum(axis=0), 1)
    scaled = vectors / total
    residual = np.full((shards, vectors.shape[1]), 1 / shards)
    chosen = np.empty(len(vectors), np.int32)
    for i in np.argsort(-scaled.max(axis=1), kind="stable"):
        shard = int(np.argmax(residual @ scaled[i]))
        residual[shard] -= scaled[i]
        chosen[i] = shard
    # Buckets start with different shards, so that what remains uneven cancels out between them.
    return (chosen + rotate) % shards


@F.pandas_udf(LongType())
def token_count(texts: pd.Series) -> pd.Series:
    """Ids of each text in the public vocabulary."""
    codec = encoder()
    return texts.map(lambda text: len(codec.encode(text))).astype("int64")


def shard_documents(df: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", tokens: Column | None = None,
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``; slots have no gaps within a shard.

    ``tokens`` is the token count of a row; by default that of the public vocabulary, in any script.
    """
    body = whole(F.col(f"`{text}`"))
    if tokens is None:
        tokens = token_count(body)
    rows = keep(df.select(
        F.col(f"`{key}`").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias("text_hash"), tokens.cast("long").alias("tokens"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    count, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = max(1, -(-count // rows_per_bucket))
    most_rows = max(1, rows_per_bucket // CHUNKS_PER_BUCKET)
    most_bytes = max(1, size // (buckets * CHUNKS_PER_BUCKET))
    identity = GROUP[:3]
    large = rows.groupBy(*identity).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1).select(
        *identity, F.least("copies", F.greatest(
            F.ceil(F.col("copies") / most_rows), F.ceil(F.col("copies") * F.col("size") / most_bytes))).alias("chunks"),
    ).filter("chunks > 1")
    dealt = rows.join(large, identity, "left").select(
        "doc_id", *identity, "tokens", "row",
        F.pmod(F.xxhash64("row"), F.coalesce("chunks", F.lit(1).cast("long"))).alias("chunk"))
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("text_hash", "text_crc32", "chunk"), F.lit(buckets).cast("long")))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([*GROUP, "row"], ignore_index=True)
        number = rows.groupby(GROUP, sort=False).ngroup().to_numpy()
        sums = rows.assign(rows=1).groupby(number, sort=False)[["size", "tokens", "rows"]].sum().to_numpy(np.float64)
        bucket = int(rows["bucket"].iloc[0])
        rows["shard"] = place_groups(sums, shards, bucket % shards)[number]
        rows["place"] = rows.groupby("shard").cumcount()
        return rows[["doc_id", "size", "text_crc32", "bucket", "shard", "place"]]

    id_type = rows.schema["doc_id"].dataType.simpleString()
    # Ids travel as text so that nulls and large numbers stay exact in pandas.
    packed = dealt.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("bucket").applyInPandas(place, PLACED.format(key="string"))
    placed = keep(packed.withColumn("doc_id", F.col("doc_id").cast(id_type)), "shard-places")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("bucket", "shard").count().select(
        "bucket", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    return placed.join(starts, ["bucket", "shard"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place")).alias("slot"))
