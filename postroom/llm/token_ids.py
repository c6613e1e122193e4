"""Token ids as Parquet: list columns that can be read in parts.

Documents are put in order of their id over range partitions, encoded with the
``tokenizers`` library, closed by an end id and written: one file or more for
each partition, in order. The list of ids is dictionary encoded (ids repeat and
a vocabulary is small beside a row group); the ascending columns beside it are
delta encoded. Row groups and pages have set sizes, and every file carries page
indexes: a reader of counts never touches the ids, and a reader of some
documents opens only the pages that hold them.

A row keeps its place inside its part. The ids before a part are a running sum
over one total per part, taken from the files' small columns on reading, so no
number depends on how many documents one task can hold.

Encoding cuts texts at ASCII white space where the vocabulary's own steps allow
that (they are read from its file), and asks the library once per worker for
each distinct word; letters with closing marks are looked up as letters and as
marks. Words that hold anything else go through the library's whole pipeline,
and other vocabularies encode whole texts.

Nulls: a null text has the end id alone, a null doc_id comes first. Empty texts
are as null ones; long texts are whole. Ties and repeated rows are ordered by
checksum, size and place in the input, and each is a document of its own. An
empty table gives an empty table. Further columns are ignored, so names can't
clash.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from ..sinks.scratch import scratch_dir
from .common import in_order, raw_texts, steps, text_of
from .ragged import Slices

#: Words that a worker remembers; emptied when there are more, so its memory has a bound.
CACHE_WORDS = 400_000

#: How files are cut: row groups and pages of these sizes, before compression.
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 128 << 10
PAGE_ROWS = 2_000

STORED = "part int, doc_id {id}, first long, n_tokens long, ids array<int>"

# Fixed value: the split of the vocabularies whose texts may be cut at blanks.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Letters that are one code point in every form and case, and marks that may close
# a word: the split parts the two.
_PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-ž]+)(?P<marks>[.,;:!?]*)$"


def cut_at_blanks(path: str) -> bool:
    """Whether each step of the vocabulary keeps to the words between ASCII blanks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    split, *more = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and split.get("pattern", {}).get("Regex") == _WORD_SPLIT
        and [(m["type"], m.get("use_regex")) for m in more] == [("ByteLevel", False)]
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        and not any(set(t["content"]) & set(" \t\n\v\f\r") for t in spec["added_tokens"])
    )


class TextEncoder:
    """Whole texts through the library; for any vocabulary."""

    def __init__(self, path: str, end: int) -> None:
        self.end = end
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end id, and how many each has."""
        found = self.library.encode_batch([t.decode() for t in texts], add_special_tokens=False)
        lists = [[*e.ids, self.end] for e in found]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = [i for ids in lists for i in ids]
        return np.array(flat, np.int32), lengths


class WordEncoder(TextEncoder):
    """Distinct words through the library, once each; for vocabularies cut at blanks."""

    def __init__(self, path: str, end: int) -> None:
        super().__init__(path, end)
        # Pieces that the split leaves whole need no more than the merges.
        self.pieces = Tokenizer(self.library.model)
        self.pieces.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # A token has a letter for each byte, and a mark if it ends a word.
        vocabulary, mark = self.library.get_vocab(), self.library.model.end_of_word_suffix or ""
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token.removesuffix(mark))
        self.forget()

    def forget(self) -> None:
        self.slices = Slices()
        # No marks are no ids.
        self.piece_of: dict[str, int] = {"": self.slices.add(np.zeros(0), np.array([0]))}
        self.odd_of: dict[str, int] = {}
        self.last = self.slices.add(np.array([self.end]), np.array([1]))

    def _slices(self, words: list[str], whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        if whole:
            found = self.library.encode_batch_fast(words, add_special_tokens=False)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            return np.array([i for e in found for i in e.ids], np.int64), lengths
        # The fast way doesn't say which word a token is of; the bytes do.
        (one,) = self.pieces.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(one.ids, np.int64)
        ends = np.cumsum(self.n_bytes[ids])
        wanted = np.cumsum([len(w.encode()) for w in words])
        if len(ids) and ends[-1] == wanted[-1]:
            last = np.searchsorted(ends, wanted)
            if last[-1] == len(ids) - 1 and (ends[last] == wanted).all():
                return ids, np.diff(last, prepend=-1)
        # Without tokens for some bytes.
        one = self.pieces.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.array(one.ids, np.int64), np.bincount(np.array(one.word_ids, np.int64), minlength=len(words))

    def _numbers(self, words: pa.Array, whole: bool) -> np.ndarray:
        """The slice of each word; each distinct one is looked up once."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.odd_of if whole else self.piece_of
        numbers = np.fromiter(map(known.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            fresh = [distinct[i] for i in new.tolist()]
            first = self.slices.add(*self._slices(fresh, whole))
            known.update(zip(fresh, range(first, first + len(fresh))))
            numbers[new] = np.arange(first, first + len(fresh))
        return numbers[coded.indices.to_numpy()]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.piece_of) + len(self.odd_of) > CACHE_WORDS:
            self.forget()
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        flat = lists.values
        some = pc.greater(pc.binary_length(flat), 0)  # blanks at the ends give empty words
        n_words = np.diff(np.r_[0, np.cumsum(some.to_numpy(zero_copy_only=False))][lists.offsets.to_numpy()])
        coded = flat.filter(some).dictionary_encode()

        # For each distinct word the slices of its letters and of its marks.
        words = coded.dictionary
        parts = pc.extract_regex(words, _PLAIN)
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        parts = parts.drop_null()
        two = np.empty((len(words), 2), np.int64)
        two[plain, 0] = self._numbers(pc.utf8_lower(parts.field("letters")), False)
        two[plain, 1] = self._numbers(parts.field("marks"), False)
        two[~plain, 0] = self._numbers(words.filter(pa.array(~plain)), True)
        two[~plain, 1] = self.piece_of[""]

        # All words in a row, and the end id behind each text's words.
        which = np.insert(two[coded.indices.to_numpy()], np.cumsum(n_words), [self.last, self.piece_of[""]], axis=0)
        ids, lengths = self.slices.take(which.ravel())
        bounds = 2 * np.r_[0, np.cumsum(n_words + 1)]
        return ids, np.diff(np.r_[0, np.cumsum(lengths)][bounds])


_encoders: dict[tuple[str, int], TextEncoder] = {}


def encoder(path: str, end: int) -> TextEncoder:
    """One encoder per worker, vocabulary and end id."""
    if (path, end) not in _encoders:
        kind = WordEncoder if cut_at_blanks(path) else TextEncoder
        _encoders[path, end] = kind(path, end)
    return _encoders[path, end]


def write_token_ids(
    docs: DataFrame,
    target: str,
    vocabulary: str,
    end: int,
    doc_id: str = "doc_id",
    text: str = "text",
    row_group: int = ROW_GROUP_BYTES,
    page: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Encode ``docs`` and write them to ``target`` in ascending order of their ids."""
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = slim.schema["doc_id"].dataType
    order = ["doc_id", F.crc32(F.encode(text_of(), "UTF-8")), F.octet_length(text_of())]
    order += [F.monotonically_increasing_id()]
    keyed = slim.select("*", *[F.col(o).alias("k0") if isinstance(o, str) else o.alias(f"k{i}") for i, o in enumerate(order)])
    keys = [f"k{i}" for i in range(len(order))]
    ranged = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for piece in steps(batches):
            ids, lengths = encoder(vocabulary, end).encode(raw_texts(piece))
            ends = np.cumsum(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(lengths), part, np.int32)),
                    piece.column("doc_id"),
                    pa.array(before + ends - lengths),
                    pa.array(lengths),
                    pa.ListArray.from_arrays(
                        pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids)
                    ),
                ],
                ["part", "doc_id", "first", "n_tokens", "ids"],
            )
            before += int(ends[-1])

    writer = ranged.mapInArrow(run, STORED.format(id=kind.simpleString())).write.mode("overwrite")
    options = {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": row_group,
        "parquet.page.size": page,
        "parquet.page.row.count.limit": page_rows,
        # Without a dictionary the second version of the format delta-encodes numbers.
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": "true",
    }
    writer.options(**{k: str(v) for k, v in options.items()}).parquet(target)


def read_token_ids(spark: SparkSession, target: str) -> DataFrame:
    """The files as they are: part, doc_id, first (in the part), n_tokens, ids."""
    return spark.read.parquet(target)


def read_placed(spark: SparkSession, target: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens and, if asked for, ids.

    ``start`` counts the ids of all documents before; it needs the small columns
    only. Filters on ``doc_id`` reach the files and their page indexes.
    """
    stored = read_token_ids(spark, target)
    # One row per written part: one task and a broadcast are enough.
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    kept = ["ids"] if with_ids else []
    return stored.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", *kept
    )


def checksums(placed: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: the ids as little-endian unsigned 32-bit numbers."""
    kind = placed.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            raw, bounds = memoryview(flat.view(np.uint8)), 4 * ids.offsets.to_numpy()
            sums = [zlib.crc32(raw[s:e]) for s, e in zip(bounds, bounds[1:])]
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    out = f"doc_id {kind}, start long, n_tokens long, ids_crc32 long"
    return in_order(placed, "doc_id", "start", "n_tokens", "ids").mapInArrow(run, out)


def op11_round_trip(documents: DataFrame, vocabulary: str, end: int = 2) -> DataFrame:
    """Write all documents as ids and read them back."""
    spark = documents.sparkSession
    target = f"{scratch_dir(spark)}/token-ids"
    write_token_ids(in_order(documents, "doc_id", "text"), target, vocabulary, end)
    return checksums(read_placed(spark, target))
