"""Benchmark decontamination: training passages as queries against a BM25 index of test items.

The index stands over the test items, which are few and of checked size; every training text is cut into
overlapping passages and every passage is a query. Items of similar length share an index, whose passages are
twice as long, so that an item that occurs lies in one of them as a whole. A score is the share of the item's BM25
weight whose terms the passage holds. Postings are grouped in blocks of items with the largest impact of each
term in a block (block-max WAND): the sums of these maxima rule out nearly all pairs of passage and block, and
only the rest is scored. Terms found in very many blocks only count into one bound for all blocks. All items at or
above the threshold are then verified: word shingles of the question, and words of the answer, in the passage.

Nothing is shuffled; an item set too large for one index is dealt to several, and every text meets each.

Defined results: null or empty texts match nothing, items without words are never found; an item of one sentence
has no answer, and its answer overlap is 1; repeated rows are reported each by themselves, repeated items once each;
null ids stay null; empty tables give no rows; columns beside id and text are dropped.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from millrace.llm.common import whole

INDEX_WORDS = 2_000_000  # words of test items in one index; more items take more indexes
CHUNK_WORDS = 200_000  # words of training texts looked up at a time
CELLS = 4_000_000  # sums of passages and blocks held at a time

PUNCTUATION = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
SENTENCE_END = re.compile(r"(?<=[.!?。？！])\s+|\n+")


@dataclass(frozen=True)
class Limits:
    threshold: float = 0.5  # share of an item's weight that a passage must hold
    question_overlap: float = 0.6
    answer_overlap: float = 0.5
    shingle: int = 5
    k1: float = 1.2
    b: float = 0.75
    block_items: int = 4
    essential_blocks: int = 64  # a term in more blocks than this counts for all of them alike


def words_of(text: str) -> list[bytes]:
    """Words without regard to case; ASCII punctuation and white space part them."""
    return text.casefold().encode("utf-8", "surrogatepass").translate(PUNCTUATION).split()


def shingles(words: Sequence[bytes], width: int) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    width = min(width, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of all sentences but the last, and of the last; one sentence is a question."""
    sentences = [w for s in SENTENCE_END.split(text) if (w := words_of(s))]
    if len(sentences) < 2:
        return (sentences[0] if sentences else []), []
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def half_passage(words: int) -> int:
    """Length class of an item: the first of a series growing by a quarter that holds it."""
    half = 8
    while half < words:
        half += max(1, half // 4)
    return half


@dataclass
class BlockMaxIndex:
    """Items of similar length: their weights, and block maxima of every term."""

    half: int  # half a passage, in words
    items: list[int]  # numbers of items
    posting_starts: np.ndarray | None = None  # of each term: where its items begin
    posting_items: np.ndarray | None = None  # places in ``items``
    posting_weights: np.ndarray | None = None  # and the term's share of the item's weight
    starts: np.ndarray | None = None  # of each term: where its blocks begin
    blocks: np.ndarray | None = None
    maxima: np.ndarray | None = None
    common: np.ndarray | None = None  # of each term: its largest share, if it is in too many blocks
    block_items: int = 4

    def n_blocks(self) -> int:
        return -(-len(self.items) // self.block_items)


@dataclass
class ItemIndexes:
    vocabulary: dict[bytes, int]
    questions: list[list[bytes]]
    answers: list[list[bytes]]
    ids: list[object]
    indexes: list[BlockMaxIndex]


def build_indexes(items: Sequence[tuple[object, str]], limits: Limits) -> ItemIndexes:
    words = [words_of(text or "") for _, text in items]
    held = Counter(w for ws in words for w in set(ws))
    vocabulary = {w: i for i, w in enumerate(sorted(held))}
    filled = [i for i, ws in enumerate(words) if ws]
    mean = sum(len(words[i]) for i in filled) / max(1, len(filled))
    parts = [question_and_answer(text or "") for _, text in items]
    classes: dict[int, list[int]] = {}
    for i in filled:
        classes.setdefault(half_passage(len(words[i])), []).append(i)
    found = ItemIndexes(vocabulary, [q for q, _ in parts], [a for _, a in parts], [i for i, _ in items], [])
    for half, members in sorted(classes.items()):
        index = BlockMaxIndex(half, members, block_items=limits.block_items)
        postings, best = [], {}
        for place, i in enumerate(members):
            norm = limits.k1 * (1 - limits.b + limits.b * len(words[i]) / mean)
            impact = {vocabulary[w]: np.log1p((len(filled) - held[w] + 0.5) / (held[w] + 0.5)) * n * (limits.k1 + 1) / (n + norm)
                      for w, n in Counter(words[i]).items()}
            total = sum(impact.values())
            for t, w in impact.items():
                postings.append((t, place, w / total))
                key = (t, place // limits.block_items)
                best[key] = max(best.get(key, 0.0), w / total)
        postings.sort()
        index.posting_items = np.array([p for _, p, _ in postings], np.int64)
        index.posting_weights = np.array([w for _, _, w in postings])
        index.posting_starts = np.searchsorted(np.array([t for t, _, _ in postings]), np.arange(len(vocabulary) + 2))
        pairs = sorted(best)
        term = np.array([t for t, _ in pairs], np.int64)
        value = np.array([best[p] for p in pairs])
        counts = np.bincount(term, minlength=len(vocabulary) + 1)
        too_common = counts > limits.essential_blocks
        index.common = np.zeros(len(vocabulary) + 1)
        np.maximum.at(index.common, term[too_common[term]], value[too_common[term]])
        kept = ~too_common[term]
        index.blocks = np.array([b for _, b in pairs], np.int64)[kept]
        index.maxima = value[kept]
        index.starts = np.concatenate([[0], np.cumsum(np.where(too_common, 0, counts))])
        found.indexes.append(index)
    return found


def expand(starts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the postings of every term, and how many each term has."""
    counts = starts[ids + 1] - starts[ids]
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[ids] - (ends - counts), counts), counts


def possible_pairs(index: BlockMaxIndex, ids: np.ndarray, half_of: np.ndarray, halves: int, threshold: float) -> np.ndarray:
    """Which passages (by first half) and blocks have a bound that reaches the threshold: a table of truth values."""
    blocks = index.n_blocks()
    at, counts = expand(index.starts, ids)
    cell = np.repeat(half_of, counts) * blocks + index.blocks[at]
    sums = np.bincount(cell, weights=index.maxima[at], minlength=(halves + 1) * blocks).reshape(-1, blocks)
    common = np.bincount(half_of, weights=index.common[ids], minlength=halves + 1)
    bound = sums[:-1] + sums[1:] + (common[:-1] + common[1:])[:, None]
    return bound >= threshold - 1e-9


def scored(index: BlockMaxIndex, ids: np.ndarray, half_of: np.ndarray, possible: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """Passages, places of items and scores at or above the threshold, among the possible passages and blocks."""
    wanted = possible.any(axis=1)
    number = np.cumsum(wanted) - 1  # passages that are scored, without gaps
    # A word lies in the passage that begins with its half and in the one before.
    passage = np.concatenate([half_of, half_of - 1])
    term = np.concatenate([ids, ids])
    kept = (passage >= 0) & (passage < len(wanted))
    kept[kept] = wanted[passage[kept]]
    pair = np.unique(passage[kept] * (len(index.starts) + 1) + term[kept])  # a term counts once
    passage, term = np.divmod(pair, len(index.starts) + 1)
    at, counts = expand(index.posting_starts, term)
    passage, item = np.repeat(passage, counts), index.posting_items[at]
    there = possible[passage, item // index.block_items]
    sums = np.bincount(number[passage[there]] * len(index.items) + item[there], weights=index.posting_weights[at][there],
                       minlength=int(wanted.sum()) * len(index.items))
    found = np.flatnonzero(sums >= threshold - 1e-9)
    row, item = np.divmod(found, max(1, len(index.items)))
    return np.flatnonzero(wanted)[row], item, sums[found]


def find_items(found: ItemIndexes, texts: Sequence[str], limits: Limits) -> Iterator[tuple[int, int, float, int, float, float]]:
    """(text, item, score, first word, question overlap, answer overlap) of every verified item, best passage each."""
    words = [words_of(t) for t in texts]
    get = found.vocabulary.get
    known = [np.fromiter((get(w, -1) for w in ws), np.int64, len(ws)) for ws in words]
    best: dict[tuple[int, int], tuple[float, float, float, int]] = {}
    for index in found.indexes:
        # Halves of all texts in one line, with an empty one between two texts.
        n_halves = [len(ws) // index.half + 2 for ws in words]
        firsts = np.concatenate([[0], np.cumsum(n_halves)]).astype(np.int64)
        begin = 0
        while begin < len(words):
            end = begin + 1
            while end < len(words) and (firsts[end + 1] - firsts[begin]) * index.n_blocks() <= CELLS:
                end += 1
            ids = np.concatenate(known[begin:end])
            half_of = np.concatenate([np.arange(len(k)) // index.half + firsts[i] - firsts[begin] for i, k in enumerate(known[begin:end], begin)])
            present = ids >= 0
            ids, half_of = ids[present], half_of[present].astype(np.int64)
            possible = possible_pairs(index, ids, half_of, int(firsts[end] - firsts[begin]), limits.threshold)
            for passage, place, score in zip(*(c.tolist() for c in scored(index, ids, half_of, possible, limits.threshold)), strict=True):
                at = int(np.searchsorted(firsts, passage + firsts[begin], side="right")) - 1
                start = int(passage + firsts[begin] - firsts[at]) * index.half
                item = index.items[place]
                window = words[at][start:start + 2 * index.half]
                question, answer = found.questions[item], found.answers[item]
                wanted = shingles(question, limits.shingle)
                width = min(limits.shingle, len(question))
                there = shingles(window, width) if len(window) >= width else set()
                asked = len(wanted & there) / len(wanted)
                answered = len({*answer} & {*window}) / len({*answer}) if answer else 1.0
                if asked >= limits.question_overlap and answered >= limits.answer_overlap:
                    value = (asked, answered, score, -start)
                    best[at, item] = max(best.get((at, item), value), value)
            begin = end
    for (at, item), (asked, answered, score, start) in sorted(best.items()):
        yield at, item, round(score, 9), -start, asked, answered


def match_items(df: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
                limits: Limits | None = None, index_words: int = INDEX_WORDS) -> DataFrame:
    """Add ``benchmark_items``: an array of (item, score, first_word, question_overlap, answer_overlap), one entry for
    each verified test item with its best passage."""
    limits = limits or Limits()
    items = benchmark.select(F.col(f"`{item_key}`").alias("item"), whole(F.col(f"`{item_text}`")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.size(F.split("text", " "))), F.lit(0))).first()[0]
    shards = max(1, -(-size // index_words))
    entry = StructType([
        StructField("item", items.schema["item"].dataType), StructField("score", DoubleType()), StructField("first_word", IntegerType()),
        StructField("question_overlap", DoubleType()), StructField("answer_overlap", DoubleType())])

    def against(shard: int) -> Column:
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(shards)) == shard) if shards > 1 else items
        found = build_indexes([tuple(r) for r in part.distinct().orderBy("item", "text").collect()], limits)

        @F.pandas_udf(ArrayType(entry))
        def matches(texts: pd.Series) -> pd.Series:
            bodies, rows, begin = texts.tolist(), [[] for _ in texts], 0
            lengths = np.cumsum([len(t) // 6 + 1 for t in bodies])
            while begin < len(bodies):
                end = max(begin + 1, int(np.searchsorted(lengths, (lengths[begin - 1] if begin else 0) + CHUNK_WORDS)))
                for at, item, *values in find_items(found, bodies[begin:end], limits):
                    rows[begin + at].append(dict(zip(entry.names, (found.ids[item], *values), strict=True)))
                begin = end
            return pd.Series(rows)

        return matches(whole(F.col(f"`{text}`")))

    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() != "benchmark_items"]
    return df.select(*rest, F.concat(*[against(shard) for shard in range(shards)]).alias("benchmark_items"))


def find_contamination(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                       item_text: str = "text", limits: Limits | None = None) -> DataFrame:
    """One row per text and verified item: the key, the item's key, and the values of :func:`match_items`."""
    matched = match_items(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), benchmark, "text",
                          item_key, item_text, limits)
    return matched.select("key", F.explode("benchmark_items").alias("m")).select(
        F.col("key").alias(key), F.col("m.item").alias(item_key), "m.score", "m.first_word", "m.question_overlap", "m.answer_overlap")
