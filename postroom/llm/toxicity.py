"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features of a text are the distinct hashes of its lower-case words, of its word
pairs and of its pairs with one word skipped, taken modulo ``2 ** BITS``. The
model is fitted in one task on a bounded sample of labelled rows (documented
below), with per-coordinate learning rates and L1, so most weights are exactly
zero; at most ``2 ** BITS`` weights are sent out. Every whole text is scored.

A feature is fitted only where the labels of its rows in the sample differ from
chance; this keeps the noise of a million rare features out of the weights.

Fitting: about MAX_TRAIN_ROWS labelled rows, twice as many at most, drawn by a hash
of their id and taken in its order, EPOCHS times. Rows with crc32(doc_id as text) mod 3 = 1
are held out and never fitted on. A document labelled twice is toxic if either
label says so. The label's column is read for fitting only.

Nulls: a null text is empty, a null label is no label, a null id is scored and
counted as held out = false. Empty texts get the score of the bias. Without any
label all scores are 0. Repeated rows are scored each; further columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_order, map_steps, mix, raw_texts, steps

BITS = 20
MAX_TRAIN_ROWS = 12_000
EPOCHS = 8
ALPHA, BETA, L1, L2 = 3.0, 1.0, 1.0, 1.0
#: Features whose labels lie closer to chance, in standard deviations, stay at 0.
MIN_DEVIATION = 3.5
CUT = 0.7

_WORD = re.compile(r"\w+")
_CACHE_WORDS = 300_000


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        return h


_hashes = _Hashes()


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Owner and index of every feature of the texts, repeats included."""
    if len(_hashes) > _CACHE_WORDS:
        _hashes.clear()
    words: list[str] = []
    lengths = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        found = _WORD.findall(t.decode("utf-8", "replace").lower())
        lengths[i] = len(found)
        words += found
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    owner = np.repeat(np.arange(len(texts)), lengths)
    owners, indices, mask = [owner], [h & np.uint64((1 << bits) - 1)], np.uint64((1 << bits) - 1)
    with np.errstate(over="ignore"):
        for gap in (1, 2):
            if len(h) > gap:
                same = owner[gap:] == owner[:-gap]
                pair = mix(h[:-gap] * np.uint64(0x9E3779B97F4A7C15) + h[gap:] + np.uint64(gap))
                owners.append(owner[gap:][same])
                indices.append(pair[same] & mask)
    return np.concatenate(owners), np.concatenate(indices).astype(np.int64)


class Ftrl:
    """FTRL-proximal state; x is a set of features, the bias has no penalty."""

    def __init__(self, bits: int = BITS) -> None:
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.z0 = self.n0 = 0.0

    def weights(self, i: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def bias(self) -> float:
        return -self.z0 / ((BETA + math.sqrt(self.n0)) / ALPHA)

    def learn(self, i: np.ndarray, label: int) -> None:
        w, b = self.weights(i), self.bias()
        g = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w.sum()) + b)))) - label
        step = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / ALPHA
        self.z[i] += g - step * w
        self.n[i] += g * g
        self.z0 += g - (math.sqrt(self.n0 + g * g) - math.sqrt(self.n0)) / ALPHA * b
        self.n0 += g * g


def screen(
    examples: list[tuple[np.ndarray, int]], bits: int = BITS
) -> list[tuple[np.ndarray, int]]:
    """The examples with only those features that the labels depend on."""
    rate = sum(label for _, label in examples) / max(1, len(examples))
    rows, excess = np.zeros(1 << bits), np.zeros(1 << bits)
    for index, label in examples:
        rows[index] += 1
        excess[index] += label - rate
    # One is added to the variance, so that a handful of rows proves nothing.
    telling = np.abs(excess) >= MIN_DEVIATION * np.sqrt(rows * rate * (1 - rate) + 1)
    return [(index[telling[index]], label) for index, label in examples]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Indices and values of the weights that aren't zero, and the bias."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    usable = usable.where(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    chosen = usable.withColumn("place", F.xxhash64(F.col("doc_id")))
    total = usable.count()
    if total > MAX_TRAIN_ROWS:
        share = int((1 << 30) * (MAX_TRAIN_ROWS / total))
        chosen = chosen.where(F.pmod("place", F.lit(1 << 30)) < share).limit(2 * MAX_TRAIN_ROWS)
    # At most 2 * MAX_TRAIN_ROWS short rows, so the broadcast has a bound.
    rows = in_order(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    ordered = rows.select("place", "label", "text").orderBy("place").coalesce(1)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples: list[tuple[np.ndarray, int]] = []
        for batch in steps(batches):
            owner, index = features(raw_texts(batch))
            for k, label in enumerate(batch.column("label").to_pylist()):
                # Owners rise within each kind of feature, and there are three.
                examples.append((np.unique(index[owner == k]).astype(np.int32), int(label > 0)))
        examples = screen(examples)
        model = Ftrl()
        for _ in range(EPOCHS):
            for index, label in examples:
                model.learn(index, label)
        if examples:
            w = model.weights(slice(None))
            found = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[-1, found], pa.int64()), pa.array(np.r_[model.bias(), w[found]])],
                ["at", "weight"],
            )

    got = ordered.mapInArrow(train, "at long, weight double").toPandas().sort_values("at")
    if got.empty:
        return None
    return got["at"].to_numpy()[1:], got["weight"].to_numpy()[1:], float(got["weight"].iloc[0])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float] | None) -> DataFrame:
    """doc_id, held_out, score and predicted for each row."""
    rows = in_order(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        result = np.zeros(batch.num_rows)
        if model is not None:
            at, weight, bias = model
            dense = np.zeros(1 << BITS)
            dense[at] = weight
            owner, index = features(raw_texts(batch))
            active = dense[index] != 0  # few: L1 has emptied the rest
            pairs = np.unique(owner[active] << BITS | index[active])
            sums = np.bincount(pairs >> BITS, dense[pairs & ((1 << BITS) - 1)], batch.num_rows)
            result = 1 / (1 + np.exp(-np.clip(sums + bias, -35, 35)))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(result),
                pa.array((result >= CUT).astype(np.int32)),
            ],
            ["doc_id", "held_out", "score", "predicted"],
        )

    return map_steps(rows, step, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op6_ftrl(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score(documents, fit(documents, in_order(labels, "doc_id", "toxic")))
