"""Repeated passages by seed and extend.

A passage is ``length`` words or more in a row that also stand in another text.
Seeds are winnowed anchors: of every ``length - SEED + 1`` seeds (hashes of SEED
words) in a row the least is an anchor, so each run of ``length`` words holds just
one as its least, and equal runs hold the same. The steps:

1. Each text gives its anchors, each with a hash of what it extends to: the
   stretch, both ways, of all runs that hold it as their least seed. By anchor,
   the least id and the number of different extensions are found. Anchors of one
   text are dropped.
2. Where all texts extend an anchor alike, the question is settled: every text
   but the first loses the stretch.
3. Elsewhere the texts are looked at again, and the anchor is extended run by run:
   the least id of each run says who loses it. This is the rare part: stretches
   next to an edit or at a passage's end, and short seeds that agree by chance.
4. Runs that go are joined to maximal stretches, whose words are removed.

A passage that stands in a third of all texts is so shuffled as one short row per
text and anchor. Everything is summed before it is shuffled; joins have one row
per key on one side, and Spark splits the other where it is skewed. The texts are
shuffled once, packed, and used for both looks. A run is known by 128 bits of
hashes; extensions are told apart by 32 bits beside the 64 of their anchor.

Nulls: a null text has no words; a null id is never earlier than another row, and
gets nothing removed. Rows that repeat an id are no earlier than each other:
neither makes the other's words go. Texts shorter than ``length`` lose nothing.
Texts are taken whole, however long. An empty table gives an empty result. Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    STEP_BYTES,
    gram_hashes,
    in_order,
    long_column,
    map_steps,
    mix,
    raw_texts,
    within,
    word_hashes,
    words_of,
    written,
)

LENGTH = 13
SEED = 5


def _sliding(a: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """The least or largest of every ``n`` neighbours."""
    size, out = 1, a
    while 2 * size <= n:
        out = pick(out[:-size], out[size:]) if len(out) > size else out[:0]
        size *= 2
    if size < n:
        rest = n - size
        out = pick(out[:-rest], out[rest:]) if len(out) > rest else out[:0]
    return out


def least_seeds(h: np.ndarray, length: int) -> np.ndarray:
    """For each run of ``length`` words the least seed in it."""
    return _sliding(gram_hashes(h, SEED), length - SEED + 1, np.minimum)


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, anchor, extension: the distinct ones of each row."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        flat, bounds = words_of(raw_texts(batch))
        if len(flat) < length:
            return None
        inside = within(bounds, length)
        h = word_hashes(flat)
        least, run = least_seeds(h, length)[inside], gram_hashes(h, length)[inside]
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(inside)][inside]
        if not len(least):
            return None
        # Neighbouring runs with one least seed are one extension of it.
        new = np.r_[True, (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])]
        starts = np.flatnonzero(new)
        with np.errstate(over="ignore"):
            whole = mix(np.add.reduceat(mix(run), starts)) >> np.uint64(32)
        owner, least = owner[starts], least[starts]
        one = _first_of_each(owner, mix(least) ^ whole)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(owner[one])),
                long_column(least[one]),
                pa.array(whole[one].astype(np.uint32).view(np.int32)),
            ],
            ["doc_id", "anchor", "extension"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_steps(docs, step, f"doc_id {kind}, anchor long, extension int")


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, pack: the texts, compressed for the shuffle."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=3).compress
        packs = pa.array([pack(t) for t in raw_texts(batch)], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), packs], ["doc_id", "pack"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_steps(docs, step, f"doc_id {kind}, pack binary")


def _keyed(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values told apart by their row as well."""
    with np.errstate(over="ignore"):
        return mix(values + owner.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def _first_of_each(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the first of equal values of a row."""
    return np.sort(np.unique(_keyed(owner, values), return_index=True)[1])


def _listed(column: pa.Array, owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values, each of a row, are in the array that the row has in ``column``."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    flat = column.flatten().to_numpy().view(np.uint64)
    wanted = _keyed(np.repeat(np.arange(len(lengths)), lengths), flat)
    hit = np.zeros(len(values), bool)
    if len(wanted):
        have = _keyed(owner, values)
        # A bit for each value first: most values are not listed.
        low = np.uint64((1 << 20) - 1)
        bits = np.zeros(1 << 20, bool)
        bits[wanted & low] = True
        maybe = np.flatnonzero(bits[have & low])
        hit[maybe] = np.isin(have[maybe], wanted)
    return hit


def _looks(batch: pa.RecordBatch, length: int) -> Iterator[tuple]:
    """Pieces of a batch: its rows, words and their bounds; owner, place, least seed and run."""
    unpack, texts, size, first = zstandard.ZstdDecompressor().decompress, [], 0, 0
    packs = batch.column("pack").to_pylist()
    for i, p in enumerate(packs):
        texts.append(unpack(p))
        size += len(texts[-1])
        if size < STEP_BYTES and i < len(packs) - 1:
            continue
        flat, bounds = words_of(texts)
        inside = within(bounds, length)
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))[: len(inside)][inside]
        if len(flat) >= length:
            h = word_hashes(flat)
            least, run = least_seeds(h, length)[inside], gram_hashes(h, length)[inside]
        else:
            least = run = np.zeros(0, np.uint64)
        rows = batch.slice(first, len(texts))
        yield rows, flat, bounds, owner, np.flatnonzero(inside), least, run
        texts, size, first = [], 0, i + 1


def open_runs(texts: DataFrame, length: int) -> DataFrame:
    """doc_id, anchor, run: runs of each row whose anchor is in the array ``open``."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Rows without open anchors are not looked at again.
            batch = batch.filter(batch.column("open").is_valid())
            for rows, _, _, owner, _, least, run in _looks(batch, length):
                hit = np.flatnonzero(_listed(rows.column("open"), owner, least))
                hit = hit[_first_of_each(owner[hit], run[hit])]
                for a in range(0, len(hit), 100_000):
                    some = hit[a : a + 100_000]
                    ids = rows.column("doc_id").take(pa.array(owner[some]))
                    columns = [ids, long_column(least[some]), long_column(run[some])]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "anchor", "run"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(look, f"doc_id {kind}, anchor long, run long")


def repeats(docs: DataFrame, texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, gone, runs: the anchors whose stretches a text loses, and single runs."""
    known = docs.where(F.col("doc_id").isNotNull())
    seeds = anchors(known, length)
    by_anchor = seeds.groupBy("anchor").agg(
        F.min("doc_id").alias("least"),
        F.count("*").alias("times"),
        F.min("extension").alias("one"),
        F.max("extension").alias("other"),
    )
    shared = by_anchor.where("times > 1").selectExpr("anchor", "least", "one <> other AS open")
    own = seeds.select("doc_id", "anchor").join(shared, "anchor")
    own = own.where("open OR doc_id > least").groupBy("doc_id")
    # As many anchors as one text has, at most.
    own = own.agg(
        F.collect_set(F.when(~F.col("open"), F.col("anchor"))).alias("gone"),
        F.collect_set(F.when(F.col("open"), F.col("anchor"))).alias("open"),
    )
    own = written(own, "anchors")

    # Rows without such anchors come along and nothing is written in between, so
    # that this join and the last one share one shuffle of the texts.
    again = open_runs(texts.join(own.select("doc_id", "open"), "doc_id", "left"), length)
    first = again.groupBy("anchor", "run").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("times")
    )
    lost = again.join(first.where("times > 1").drop("times"), ["anchor", "run"])
    lost = lost.where("doc_id > least").groupBy("doc_id").agg(F.collect_set("run").alias("runs"))
    return own.select("doc_id", "gone").join(lost, "doc_id", "full")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by blanks."""
    if length < SEED:
        raise ValueError(f"passages have {SEED} words at least")
    rows = in_order(docs, "doc_id", "text")
    texts = packed(rows)
    marked = texts.join(repeats(rows, texts, length), "doc_id", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat, bounds, owner, place, least, run in _looks(batch, length):
                hit = _listed(part.column("gone"), owner, least)
                hit |= _listed(part.column("runs"), owner, run)
                edges = np.bincount(place[hit], minlength=len(flat) + length + 1)
                edges = edges - np.r_[np.zeros(length, np.int64), edges[:-length]]
                stays = np.cumsum(edges)[: len(flat)] == 0
                kept_before = np.r_[0, np.cumsum(stays)]
                n_words, n_kept = np.diff(bounds), np.diff(kept_before[bounds])
                left = list(compress(flat, stays.tolist()))
                ends = kept_before[bounds].tolist()
                kept = [b" ".join(left[a:b]) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        long_column(n_words),
                        long_column(n_words - n_kept),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept string"
    return marked.select("doc_id", "pack", "gone", "runs").mapInArrow(cut, schema)


def op7_repeats(documents: DataFrame) -> DataFrame:
    cleaned = remove_repeats(documents, LENGTH)
    return cleaned.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256")
    )
