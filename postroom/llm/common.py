"""Small helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.scratch import materialise, scratch_dir

#: Text that one Python step holds at a time. A longer text is a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, reread when an executor is lost."""
    return materialise(df, f"{scratch_dir(df.sparkSession)}/{name}", **options)


def in_order(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, so that further columns can't clash with ours."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def bounded_sample(df: DataFrame, size: int) -> DataFrame:
    """About ``size`` rows, drawn by their place in the input; never over twice as many.

    Each task keeps its share, so what is sent on doesn't grow with the tasks, and
    copies of one row are drawn as often as they stand there. All rows if they are few.
    """
    total = df.count()
    if total <= size:
        return df
    place = F.xxhash64(F.monotonically_increasing_id())
    drawn = df.where(F.pmod(place, F.lit(1 << 30)) < int((1 << 30) * (size / total)))
    return drawn.limit(2 * size)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def steps(
    batches: Iterable[pa.RecordBatch], text: str = "text", most: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of about ``most`` bytes of text; no row is cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes.astype(np.int64)) // most
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


def raw_texts(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """Texts as UTF-8; a null text is empty."""
    return [b or b"" for b in batch.column(text).cast(pa.binary()).to_pylist()]


def map_steps(
    df: DataFrame,
    step: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    text: str = "text",
    most: int = STEP_BYTES,
) -> DataFrame:
    """``mapInArrow`` of a function of one step of rows with a ``text`` column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in steps(batches, text, most):
            out = step(piece)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


# bytes.split() cuts at exactly space and \x09-\x0D: the words of all operators
# here are the runs of other characters.
def words_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words of the texts in one list, and the bounds of each text in it."""
    flat: list[bytes] = []
    bounds = np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        flat += t.split()
        bounds[i + 1] = len(flat)
    return flat, bounds


def word_hashes(flat: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash, so that all its bits depend on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; the caller drops runs across texts."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    base, acc = np.uint64(0x9E3779B97F4A7C15), np.zeros(len(h) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            acc = acc * base + h[i : len(h) - n + 1 + i]
        return mix(acc)


def within(bounds: np.ndarray, n: int) -> np.ndarray:
    """For each run of ``n`` words of the flat list: whether it lies in one text."""
    total = int(bounds[-1])
    if total < n:
        return np.zeros(0, bool)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return owner[: total - n + 1] == owner[n - 1 :]


def long_column(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64))
