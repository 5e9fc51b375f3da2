"""Quality of texts by supervised subword embeddings.

A text is the bag of its hashed n-grams: words, pairs of words, repetition patterns of neighbouring words, and
character n-grams of two to four characters inside words with their edges. Every n-gram has a learned vector; the text
is their average, and a softmax over it gives the classes. Vectors and softmax are trained together by
stochastic gradient descent in numpy, on a bounded sample of labelled rows. Since the average is linear, a trained
model folds to one number per bucket, 256 KB with the default size, which rides with the task.

Bags are made where the rows are. The sample is at most ``most_rows`` labelled keys, those with the least hashes; their
bags, not their texts, meet in one task that trains. Scoring covers all rows and every whole text, and nothing
is shuffled for it. N-grams do not cross the borders of pieces of ``PIECE`` characters, so memory stays flat
on very long texts.

Defined results: a null or empty text has no n-grams and gets the score of the bias alone; repeated rows and ties
score alike, and one text of a key that repeats trains; null keys score and never train; rows without a label, or with another label than 0 and 1, do not
train; without any label of one class all scores are the share of the other; extra columns pass through and give way
to result columns of the same name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import whole

BITS = 16
DIM = 16
EPOCHS = 3
RATE = 0.5
# The bound of the training sample: at most so many labelled rows pass through the one task that trains.
MOST_ROWS = 4096
BAG_TASKS = 16
PIECE = 1 << 18
CHARACTERS = (2, 3, 4)
MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(values: np.ndarray, kind: int, bits: int) -> np.ndarray:
    """Upper bits of a multiplicative hash; each kind of n-gram has a seed of its own."""
    with np.errstate(over="ignore"):
        mixed = (values + np.uint64(kind) * np.uint64(0xD1B54A32D192ED03)) * MIX
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * MIX) >> np.uint64(64 - bits)).astype(np.int64)


def _pieces(texts: list[str]) -> Iterator[tuple[int, str]]:
    """Texts with their places; a long text is cut behind white space where there is some."""
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > PIECE:
            # The last quarter of a piece is searched, so that a text is walked once.
            cut = max(text.rfind(" ", at + PIECE * 3 // 4, at + PIECE), text.rfind("\n", at + PIECE * 3 // 4, at + PIECE)) + 1
            cut = cut if cut > at else at + PIECE
            yield i, text[at:cut]
            at = cut
        yield i, text[at:] if at else text


def _batches(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    owners, pieces, size = [], [], 0
    for owner, piece in _pieces(texts):
        owners.append(owner)
        pieces.append(piece)
        size += len(piece)
        if size >= PIECE:
            yield owners, pieces
            owners, pieces, size = [], [], 0
    if pieces:
        yield owners, pieces


def n_grams(texts: list[str], bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of (text number, bucket) arrays that together hold every n-gram of all texts once."""
    with np.errstate(over="ignore"):
        for owners, pieces in _batches(texts):
            # A line end on both sides of each piece: no window with white space inside counts.
            codes = np.frombuffer(("\n" + "\n".join(pieces) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            starts = np.cumsum([1, *(len(p) + 1 for p in pieces[:-1])])
            owner_of = np.asarray(owners)
            white = (codes == 32) | ((codes >= 9) & (codes <= 13))
            dark = ~white
            edge = np.flatnonzero(dark[1:] != dark[:-1]) + 1
            first, last = edge[::2], edge[1::2]
            if not len(first):
                continue
            place = owner_of[np.searchsorted(starts, first, "right") - 1]
            # Words: a polynomial over the places inside the word, folded per word.
            inside = np.arange(len(codes)) - np.repeat(np.r_[0, first], np.diff(np.r_[0, first, len(codes)]))
            powers = np.power(np.uint64(0x100000001B3), np.minimum(inside, 64).astype(np.uint64))
            terms = np.where(white, np.uint64(0), (codes + np.uint64(1)) * powers)
            words = np.add.reduceat(terms, first) * MIX + (last - first).astype(np.uint64)
            yield place, _bucket(words, 1, bits)
            if len(words) > 1:
                near = place[1:] == place[:-1]
                pairs = words[:-1] * np.uint64(31) + words[1:]
                yield place[1:][near], _bucket(pairs[near], 2, bits)
                same = (words[1:] == words[:-1]).astype(np.uint64)
                yield place[1:][near], _bucket(same[near], 3, bits)
            # Characters: white space is one sign, and only the edges of a window may be white.
            signs = np.where(white, np.uint64(32), codes)
            # The second sign tells the text: the first may be the line end before it.
            of_sign = owner_of[np.searchsorted(starts, np.arange(len(codes)), "right").clip(1) - 1]
            rolled, blocked = signs.copy(), np.zeros(len(codes), bool)
            for n in range(2, max(CHARACTERS) + 1):
                rolled = rolled[:-1] * np.uint64(0x5BD1E995) + signs[n - 1:]
                blocked = (blocked[:-1] | white[n - 2:-1]) if n > 2 else np.zeros(len(codes) - 1, bool)
                if n in CHARACTERS:
                    good = ~blocked & ~(white[:-(n - 1)] & white[n - 1:])
                    yield of_sign[1:len(good) + 1][good], _bucket(rolled[good], 10 + n, bits)


def bags(texts: list[str], bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and counts of every text."""
    keys, counts = [], []
    for place, bucket in n_grams(texts, bits):
        key, count = np.unique((place << bits) | bucket, return_counts=True)
        keys.append(key)
        counts.append(count)
    if not keys:
        return [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in texts]
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(back, np.concatenate(counts)).astype(np.int64)
    borders = np.searchsorted(key, np.arange(len(texts) + 1) << bits)
    return [(key[a:b] & ((1 << bits) - 1), total[a:b]) for a, b in zip(borders, borders[1:], strict=False)]


@dataclass(frozen=True)
class Model:
    """The folded model: what each bucket adds to the log-odds of class 1, and the bias."""

    weights: np.ndarray
    bias: float
    bits: int = BITS

    def scores(self, texts: list[str]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for place, bucket in n_grams(texts, self.bits):
            total += np.bincount(place, self.weights[bucket], len(texts))
            count += np.bincount(place, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(self.bias + total / np.maximum(count, 1), -60, 60)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], *, bits: int = BITS, dim: int = DIM, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 7) -> Model:
    """Vectors and softmax by stochastic gradient descent, one text after the other."""
    labels = np.array([label for *_, label in rows], np.int64)
    share = labels.mean() if len(labels) else 0.5
    if share in (0.0, 1.0):
        return Model(np.zeros(1 << bits, np.float32), 60.0 if share else -60.0, bits)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    soft = np.zeros((dim, 2), np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    shares = [(count / max(count.sum(), 1)).astype(np.float32) for _, count, _ in rows]
    energy = [max(float(part @ part), 1e-6) for part in shares]
    done, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            step = rate * (1 - done / steps)
            done += 1
            bucket, part = rows[i][0], shares[i]
            hidden = part @ vectors[bucket]
            odds = hidden @ soft + bias
            odds = np.exp(odds - odds.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            back = soft @ error
            soft -= step * np.outer(hidden, error)
            bias -= step * 0.1 * error
            # Shares are small: divided by the energy of the bag, a step moves the average as far as it moves the softmax.
            vectors[bucket] -= np.outer(part, back * (step / energy[i]))
    weights = vectors @ (soft[:, 1] - soft[:, 0])
    return Model(weights.astype(np.float32), float(bias[1] - bias[0]), bits)


def training_sample(labels: DataFrame, key: str, label: str, most_rows: int) -> DataFrame:
    """At most ``most_rows`` labelled keys, those with the least hashes, each with its label."""
    usable = labels.filter(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isin(0, 1)).select(
        F.col(f"`{key}`").alias("_k"), F.col(f"`{label}`").cast("int").alias("_label"))
    return usable.orderBy(F.xxhash64("_k"), "_k", "_label").limit(most_rows)


def fit_classifier(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "quality",
                   most_rows: int = MOST_ROWS, bits: int = BITS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE,
                   seed: int = 7) -> Model:
    """Train on labelled rows; ``labels`` should hold only those that may be learnt from. Runs a job when called."""
    chosen = training_sample(labels, key, label, most_rows)
    texts = docs.select(F.col(f"`{key}`").alias("_k"), whole(F.col(f"`{text}`")).alias("_text"))
    # The sample is bounded by most_rows, so it may be sent everywhere.
    joined = texts.join(F.broadcast(chosen), "_k")
    # One text a key, folded before it moves, so that a key with many rows stays as small as any other.
    single = joined.groupBy("_k", "_label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text")).select(
        F.xxhash64("_k").alias("_order"), "_label", "_text").repartition(BAG_TASKS)

    def make_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders, marks = batch.column("_order").to_pylist(), batch.column("_label").to_pylist()
            for i, body in enumerate(batch.column("_text")):
                bucket, count = bags([body.as_py()], bits)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([orders[i]], pa.int64()), pa.array([marks[i]], pa.int32()),
                     pa.array([bucket.astype("<u4").tobytes()], pa.binary()), pa.array([count.astype("<u4").tobytes()], pa.binary())],
                    names=["_order", "_label", "_buckets", "_counts"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for order, mark, bucket, count in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                rows.append((order, np.frombuffer(bucket, "<u4").astype(np.int64), np.frombuffer(count, "<u4"), mark))
        rows.sort(key=lambda r: (r[0], r[3]))
        model = train([r[1:] for r in rows], bits=bits, dim=dim, epochs=epochs, rate=rate, seed=seed)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.astype("<f4").tobytes()], pa.binary()), pa.array([model.bias], pa.float64())], names=["weights", "bias"])

    made = single.mapInArrow(make_bags, "_order long, _label int, _buckets binary, _counts binary")
    # One task trains; it reads the bags of at most most_rows texts.
    found = made.repartition(1).mapInArrow(fit, "weights binary, bias double").first()
    return Model(np.frombuffer(found["weights"], "<f4"), found["bias"], bits) if found else train([], bits=bits)


def score_texts(model: Model) -> Column:
    """A function of a text column: the probability of class 1."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores([t or "" for t in texts]))

    return score


def classify(df: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from the threshold on, else 0)."""
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("score", "predicted")]
    scored = df.select(*rest, score_texts(model)(whole(F.col(f"`{text}`"))).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
