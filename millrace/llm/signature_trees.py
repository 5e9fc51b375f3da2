"""N-gram Jaccard join: documents whose word shingles overlap enough, and the groups they form.

1. Documents with equal shingle sets form a class; one row per class goes on.
2. Two sets that are similar enough share ``EVIDENCE`` of their first shingles in any common order. A first round
   orders by hash and counts; the second puts those found often last, so that first shingles are rare. Sets of fitting
   size that share so many lie in the same neighbourhood (a connected component), and no link crosses neighbourhoods.
   One shared shingle would not do: by chance alone, it ties most of a large input into one neighbourhood.
3. In a neighbourhood the sets stand in a signature tree: every node holds the union of the bitmaps below it and
   their range of sizes. Two nodes are walked down together only while the overlap that their bitmaps and
   sizes allow reaches the threshold; pairs of leaves are compared exactly. Sets that are already connected are
   not compared again, so a group of near copies costs about one comparison a member.
4. Links are joined to components.

Shingles are compared as 64-bit hashes and classes are numbered by 64 bits; neighbourhoods are told by the upper 42 bits
of shingles, which travel as packed blocks. Sets are computed from texts where they are needed instead of being
stored, and only texts of neighbourhoods are shuffled. A neighbourhood with more shingles than a task should hold is dealt out in
blocks by size and hash, and pairs of blocks of fitting size are joined in tasks of their own.

Defined results: a null or empty text, or one without words, has no shingles and is linked with nothing; a row
without id is linked with nothing and has no component; rows of the same id are one node; an empty table gives no
rows; columns beside id and text are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import keep, may_be_among, whole
from millrace.llm.components import connected_components

BLOCK_SHINGLES = 8_000_000  # shingles of a neighbourhood in one task
FREQUENT = 5  # sets with a shingle among their first, at which it goes to the end of the order
FREQUENT_KEPT = 1_000_000  # the order remembers so many shingles at most; any order gives the same links
PARTS = 64  # tasks that share a frequent shingle
EVIDENCE = 4  # first shingles that two similar sets share, if the smaller one has enough
PAIRED = 8  # holders of a shingle up to which every two count as sharing it; more are chained
KEY_SHIFT, BUCKET_BITS = 22, 10  # a shingle's key are its upper bits; the lower ones of the key are its bucket
FLUSH = 250_000  # rows that a task packs at once
FANOUT = 16


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    wide = min(width, len(words))
    count = len(words) - wide + 1
    mixed = hashes[:count] + np.uint64(wide)
    for i in range(1, wide):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + count]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def class_number(shingles: np.ndarray) -> int:
    """Number of the class of all documents with this set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def least_shared(size: np.ndarray, percent: int) -> np.ndarray:
    """Fewest common shingles of a set of this size with a similar one that is no smaller."""
    return -(-percent * size // 100)


def least_overlap(sizes: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Fewest common shingles of two similar sets with so many shingles together."""
    return -(-percent * sizes // (100 + percent))


def first_keys(shingles: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Keys of so many shingles in the common order that two similar sets share ``EVIDENCE``, and how many are not late.

    ``frequent`` are the keys that come last, in order.
    """
    count = len(shingles) + (-percent * len(shingles) // 100) + EVIDENCE
    keys = shingles >> np.uint64(KEY_SHIFT)
    if not len(frequent):
        return keys[:count], min(count, len(keys))
    at = np.searchsorted(frequent, keys)
    late = frequent[np.minimum(at, len(frequent) - 1)] == keys
    early = keys[~late]
    return np.concatenate([early, keys[late]])[:count], min(count, len(early))


class SignatureTree:
    """Levels of nodes over sets in order of size; level 0 are the sets themselves."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        sizes = np.array([len(s) for s in sets], np.int64)
        bits = 1 << max(6, min(13, int(4 * sizes.mean()).bit_length()))
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for row, shingles in zip(maps, sets, strict=True):
            at = shingles & np.uint64(bits - 1)
            np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        doubled = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, sizes, sizes, doubled)]
        while len(maps) > 1:
            starts = np.arange(0, len(maps), FANOUT)
            maps = np.bitwise_or.reduceat(maps, starts)
            _, low, high, doubled = self.levels[-1]
            self.levels.append((maps, np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.maximum.reduceat(doubled, starts)))
            maps = self.levels[-1][0]

    def fitting(self, level: int, a: int, b: int, percent: int) -> np.ndarray:
        """Pairs of children of two nodes whose overlap may reach the threshold, as two columns of numbers."""
        maps, low, high, doubled = self.levels[level - 1]
        rows = np.arange(a * FANOUT, min((a + 1) * FANOUT, len(maps)))
        columns = np.arange(b * FANOUT, min((b + 1) * FANOUT, len(maps)))
        x, y = rows[:, None], columns[None, :]
        fits = (high[x] * 100 >= low[y] * percent) & (high[y] * 100 >= low[x] * percent)
        if a == b:
            fits &= x <= y if level > 1 else x < y
        i, j = np.nonzero(fits)
        i, j = rows[i], columns[j]
        most = np.bitwise_count(maps[i] & maps[j]).sum(axis=1, dtype=np.int64) + np.minimum(doubled[i], doubled[j])
        kept = most >= least_overlap(low[i] + low[j], percent)
        return np.stack([i[kept], j[kept]], axis=1)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.sort(np.concatenate([a, b]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def candidate_pairs(sets: list[np.ndarray], percent: int, together: Callable[[set[int]], bool]) -> Iterator[tuple[int, int]]:
    """Pairs of sets, in order of size, that the tree cannot rule out; leaves already ``together`` are left out."""
    if len(sets) == 2:
        yield 0, 1
        return
    tree = SignatureTree(sets)
    stack = [(len(tree.levels) - 1, 0, 0)]
    while stack:
        level, a, b = stack.pop()
        if level > 1:
            stack += [(level - 1, i, j) for i, j in tree.fitting(level, a, b, percent).tolist()]
        elif not together({i for n in (a, b) for i in range(n * FANOUT, min((n + 1) * FANOUT, len(sets)))}):
            yield from tree.fitting(level, a, b, percent).tolist()


def linked(nodes: list[int], sets: list[np.ndarray], percent: int, part: list[int]) -> Iterator[tuple[int, int]]:
    """Links that connect all similar sets: (smallest node of a group, other node of it).

    Of sets from two parts only those of different parts are compared.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    nodes, sets, part = [nodes[i] for i in order], [sets[i] for i in order], [part[i] for i in order]
    apart = len(set(part)) > 1
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in candidate_pairs(sets, percent, lambda some: len({find(i) for i in some}) == 1):
        if apart and part[i] == part[j]:
            continue
        a, b = find(i), find(j)
        if a != b and similar(sets[i], sets[j], percent):
            root[max(a, b)] = min(a, b)
    groups: dict[int, list[int]] = {}
    for i, node in enumerate(nodes):
        groups.setdefault(find(i), []).append(node)
    for group in groups.values():
        first = min(group)
        yield from ((first, node) for node in group if node != first)


def _number_documents(docs: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, n_shingles, node): the size and the class number of every document's set."""
    schema = StructType(docs.select("doc_id").schema.fields).add("n_shingles", "long").add("node", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, nodes = [], []
            for body in batch.column("text"):
                shingles = shingle_set(body.as_py(), width)
                n.append(len(shingles))
                nodes.append(class_number(shingles) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(nodes, pa.int64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _blocks(bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (bucket, block): the numbers of a bucket, by the first column's lower 32 bits, columns one behind the other.

    A column is written by planes, the first byte of all numbers before the second: high bytes, mostly alike, shrink
    to nothing when Spark compresses.
    """
    order = np.argsort((bucket << 32) | (columns[0] & np.uint32(0xFFFFFFFF)).astype(np.int64))
    bucket, columns = bucket[order], [c[order] for c in columns]
    starts = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1))
    spans = zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)])
    packed = [b"".join(c[i:j].view(np.uint8).reshape(j - i, -1).T.tobytes() for c in columns) for i, j in spans]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), pa.array(packed, pa.binary())], names=["bucket", "block"])


def _buckets(batches: Iterator[pa.RecordBatch], kinds: Callable[[int], list[type]]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Columns of every bucket, from its blocks in a row; ``kinds`` are their types."""
    at, blocks = None, []

    def unpacked() -> list[np.ndarray]:
        found = [[] for _ in kinds(at)]
        for block in blocks:
            count, start = len(block) // sum(np.dtype(k).itemsize for k in kinds(at)), 0
            for column, kind in zip(found, kinds(at), strict=True):
                end = start + count * np.dtype(kind).itemsize
                column.append(np.ascontiguousarray(block[start:end].reshape(-1, count).T).view(kind).ravel())
                start = end
        return [np.concatenate(column) for column in found]

    for batch in batches:
        for bucket, block in zip(batch.column("bucket").to_pylist(), batch.column("block"), strict=True):
            if bucket != at and blocks:
                yield at, unpacked()
                blocks = []
            at = bucket
            blocks.append(np.frombuffer(block.as_buffer(), np.uint8))
    if blocks:
        yield at, unpacked()


RARE, LATE = [np.uint32, np.int64, np.int32], [np.uint64, np.int32, np.int64, np.int32]  # (key), part, node, size


def _bucket_and_rest(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64), (keys >> np.uint64(BUCKET_BITS)).astype(np.uint32)


def _first_of_documents(docs: DataFrame, frequent: np.ndarray | None, width: int, percent: int) -> DataFrame:
    """Blocks of the keys of every class's first shingles; without ``frequent``, to be counted, of nothing but keys.

    Else with the class's number and the size of its set. Keys of frequent shingles stand in buckets of their own,
    dealt to parts by size band and, within a band, by node.
    """
    none = np.empty(0, np.uint64)

    def packed(found: list[np.ndarray], early: list[int], nodes: list[int], sizes: list[int]) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate(found)
        if frequent is None:
            bucket, rest = _bucket_and_rest(keys)
            yield _blocks(bucket, [rest])
            return
        counts = np.array([len(f) for f in found])
        node, size = np.repeat(np.array(nodes, np.int64), counts), np.repeat(np.array(sizes, np.int32), counts)
        place = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)
        rare = place < np.repeat(np.array(early), counts)
        if rare.any():
            bucket, rest = _bucket_and_rest(keys[rare])
            yield _blocks(bucket, [rest, node[rare], size[rare]])
        if not rare.all():
            keys, node, size = keys[~rare], node[~rare], size[~rare]
            band = np.floor(np.log(size) / np.log(100 / percent)).astype(np.int64)
            part = (band * PARTS + (node & (PARTS - 1))).astype(np.int32)
            mixed = (keys + part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            yield _blocks((1 << BUCKET_BITS) + (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), [keys, part, node, size])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies in one task are told once; rows told twice do no harm
        found, early, nodes, sizes, held = [], [], [], [], 0
        for batch in batches:
            for body in batch.column("text"):
                shingles = shingle_set(body.as_py(), width)
                number = class_number(shingles) if len(shingles) else None
                if number is None or number in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(number)
                keys, rare = first_keys(shingles, none if frequent is None else frequent, percent)
                found.append(keys)
                early.append(rare)
                nodes.append(number)
                sizes.append(len(shingles))
                held += len(keys)
                if held > FLUSH:
                    yield from packed(found, early, nodes, sizes)
                    found, early, nodes, sizes, held = [], [], [], [], 0
        if found:
            yield from packed(found, early, nodes, sizes)

    return docs.select("text").mapInArrow(run, "bucket int, block binary").repartition("bucket").sortWithinPartitions("bucket")


def _often(blocks: DataFrame) -> np.ndarray:
    """Keys found ``FREQUENT`` times or more, in order; of too many, those found most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, (rest,) in _buckets(batches, lambda _: RARE[:1]):
            found, counts = np.unique(rest, return_counts=True)
            often = counts >= FREQUENT
            keys = (found[often].astype(np.int64) << BUCKET_BITS) | bucket
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts[often].astype(np.int64))], names=["key", "count"])

    most = blocks.mapInArrow(run, "key long, count long").orderBy(F.desc("count"), "key").limit(FREQUENT_KEPT)
    return np.sort(np.array([r[0] for r in most.select("key").collect()], np.int64).view(np.uint64))


def shared_keys(key: np.ndarray, part: np.ndarray, node: np.ndarray, n: np.ndarray, percent: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Pairs (a, b, need, votes) of classes of fitting size that share keys, and (key, part, n, a, n, b) of frequent keys' parts.

    Every key that two classes share is a vote; ``need`` is how many they must share to be similar. Keys of many holders,
    and frequent ones, link each holder to the one before in order of size, which needs no other votes: between two
    of fitting size all steps fit.
    """
    order = np.lexsort((node, n, part, key))
    key, part, node, n = key[order], part[order], node[order], n[order].astype(np.int64)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
    once = new.copy()
    once[1:] |= node[1:] != node[:-1]
    key, part, node, n, new = key[once], part[once], node[once], n[once], new[once]
    starts = np.flatnonzero(new)
    holders = np.diff(starts, append=len(key))
    paired = (part[starts] < 0) & (holders <= PAIRED)
    step = ~new & ~np.repeat(paired, holders)
    large = [np.flatnonzero(step)]
    small, need = [large[0] - 1], [np.zeros(len(large[0]), np.int64)]
    for h in range(2, PAIRED + 1):
        at = starts[paired & (holders == h)]
        for i, j in ((i, j) for j in range(1, h) for i in range(j)) if len(at) else ():
            small.append(at + i)
            large.append(at + j)
            # One vote less: two shared shingles may have the same key.
            need.append(np.clip(least_shared(n[at + i], percent), 2, EVIDENCE) - 1)
    small, large, need = np.concatenate(small), np.concatenate(large), np.concatenate(need)
    fits = n[small] * 100 >= n[large] * percent
    pairs = summed([node[small[fits]], node[large[fits]], need[fits], np.ones(fits.sum(), np.int64)])
    first = starts[part[starts] >= 0]
    last = (starts + holders - 1)[part[starts] >= 0]
    return pairs, [key[first].astype(np.int64), part[first], n[first], node[first], n[last], node[last]]


def summed(pairs: list[np.ndarray]) -> list[np.ndarray]:
    """One row (a, b, need, votes) for each pair."""
    a, b, need, votes = np.minimum(pairs[0], pairs[1]), np.maximum(pairs[0], pairs[1]), *pairs[2:]
    order = np.lexsort((need, b, a))
    a, b, need, votes = a[order], b[order], need[order], votes[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return [a[starts], b[starts], need[starts], np.add.reduceat(votes, starts) if len(starts) else votes]


def _neighbour_edges(first: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect all classes which share as many first shingles as similar ones and are of fitting size.

    The parts of a frequent shingle, each with its smallest and its largest class, are linked afterwards.
    """
    fits = lambda small, large: small * 100 >= large * percent
    names = ["a", "b", "need", "votes", "shingle", "part", "least", "most"]

    def rows(pairs: list[np.ndarray]) -> pa.RecordBatch:
        none = [pa.nulls(len(pairs[0]), t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())]
        return pa.RecordBatch.from_arrays([*map(pa.array, pairs), *none], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for bucket, columns in _buckets(batches, lambda at: LATE if at >> BUCKET_BITS else RARE):
            if bucket >> BUCKET_BITS:
                pairs, parts = shared_keys(*columns, percent)
                key, part, least_n, least, most_n, most = parts
                none = pa.nulls(len(key), pa.int64())
                yield pa.RecordBatch.from_arrays([*map(pa.array, (least, most)), none, none, *map(pa.array, (key, part, least_n, most_n))], names=names)
            else:
                rest, node, n = columns
                pairs, _ = shared_keys(rest, np.full(len(rest), -1, np.int32), node, n, percent)
            held.append(pairs)
            if sum(len(p[0]) for p in held) > 4 * FLUSH:
                yield rows(summed([np.concatenate(c) for c in zip(*held)]))
                held = []
        if held:
            yield rows(summed([np.concatenate(c) for c in zip(*held)]))

    near = keep(first.mapInArrow(run, "a long, b long, need long, votes long, shingle long, part int, least long, most long"), "near")
    steps = near.filter("shingle IS NULL").groupBy("a", "b").agg(
        F.min("need").alias("need"), F.sum("votes").alias("votes")).filter("votes >= need").select("a", "b")
    banded = near.filter("shingle IS NOT NULL").select(
        "shingle", F.floor(F.col("part") / PARTS).alias("band"), F.struct(F.col("least").alias("n"), F.col("a").alias("node")).alias("least"),
        F.struct(F.col("most").alias("n"), F.col("b").alias("node")).alias("most"))
    bands = banded.groupBy("shingle", "band").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    in_band = banded.select("shingle", "band", F.col("least.node").alias("b")).join(
        bands.select("shingle", "band", F.col("least.node").alias("a")), ["shingle", "band"]).select("a", "b")
    below = F.lag(F.struct("band", "most")).over(Window.partitionBy("shingle").orderBy("band"))
    across = bands.withColumn("below", below).filter(
        (F.col("below.band") == F.col("band") - 1) & fits(F.col("below.most.n"), F.col("least.n"))).select(
        F.col("below.most.node").alias("a"), F.col("least.node").alias("b"))
    return steps.union(in_band).union(across).filter("a <> b").distinct()


def _tasks(docs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Texts dealt to tasks by neighbourhood: (task, part, node, text); ``members`` has (doc_id, node, root, n)."""
    total = members.groupBy("root").agg(F.sum("n").alias("total")).filter(F.col("total") > BLOCK_SHINGLES)
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).cast("int")
    large = members.join(total.select("root"), "root").withColumn("band", band)
    blocks = keep(large.groupBy("root", "band").agg(F.ceil(F.sum("n") / (BLOCK_SHINGLES // 2)).cast("int").alias("blocks")), "blocks")
    placed = large.join(blocks, ["root", "band"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # A block meets the blocks of its band and of the next one; a task is a pair of blocks.
    near = blocks.select("root", F.col("band").alias("other_band"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = placed.join(near, "root").filter("other_band BETWEEN band - 1 AND band + 1")
    own, other = F.struct("band", "block"), F.struct(F.col("other_band").alias("band"), F.col("other").alias("block"))
    split = met.select("doc_id", "node", F.xxhash64("root", F.least(own, other), F.greatest(own, other)).alias("task"),
                       F.hash("band", "block").alias("part"))
    alone = members.join(total.select("root"), "root", "left_anti").select(
        "doc_id", "node", F.col("root").alias("task"), F.lit(0).alias("part"))
    return docs.filter(may_be_among(members, "doc_id")(F.col("doc_id"))).join(alone.unionByName(split), "doc_id")


def _compare(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links of rows (task, part, node, text), a task after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nodes, sets, part, links = None, [], [], [], []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"])

        for batch in batches:
            for at, where, node, body in zip(*(batch.column(c).to_pylist() for c in ("task", "part", "node")), batch.column("text"), strict=True):
                if at != task:
                    if len(nodes) > 1:
                        links += linked(nodes, sets, percent, part)
                    task, nodes, sets, part = at, [], [], []
                shingles = shingle_set(body.as_py(), width)
                # Another document of the same id may have come along, or the same one twice.
                if len(shingles) and class_number(shingles) == node and (not nodes or nodes[-1] != node):
                    nodes.append(node)
                    sets.append(shingles)
                    part.append(where)
            if len(links) > 10_000:
                yield packed()
                links = []
        if len(nodes) > 1:
            links += linked(nodes, sets, percent, part)
        if links:
            yield packed()

    return rows.select("task", "part", "node", "text").repartition("task").sortWithinPartitions("task", "node").mapInArrow(
        run, "a long, b long")


def jaccard_groups(df: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, class_id, component_id``.

    ``class_id`` is the smallest id with the same shingle set, ``component_id`` the smallest id that links reach.
    """
    docs = df.select(F.col(f"`{key}`").alias("doc_id"), whole(F.col(f"`{text}`")).alias("text"))
    documents = keep(_number_documents(docs, width), "documents")
    with_id = docs.filter("doc_id IS NOT NULL")
    frequent = _often(_first_of_documents(with_id, None, width, percent))
    first = _first_of_documents(with_id, frequent, width, percent)
    hoods = connected_components(_neighbour_edges(first, percent))
    classes = keep(documents.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("class_id"), F.max("n_shingles").alias("n")), "class-ids")
    members = keep(classes.join(hoods, "node").select(F.col("class_id").alias("doc_id"), "node", "root", "n"), "members")
    links = keep(_compare(_tasks(with_id, members, percent), width, percent), "links")
    # Rows of one id are one node of the result, whatever their texts.
    ids = documents.filter("doc_id IS NOT NULL AND node IS NOT NULL").select("doc_id", "node").distinct()
    twice = ids.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("doc_id", "a")
    same_id = ids.join(twice, "doc_id").select("a", F.col("node").alias("b"))
    roots = connected_components(links.union(same_id))
    named = classes.join(roots, "node", "left").select("node", "class_id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("class_id").alias("component_id"))
    result = named.join(least, "root").select("node", "class_id", "component_id")
    known = documents.withColumn("node", F.when(F.col("doc_id").isNotNull(), F.col("node")))
    return known.join(result, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"))
