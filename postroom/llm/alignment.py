"""How two tokenizers cut the same text, and which of their tokens go together.

Both tokenizers cover the bytes of a blank and the text. Where tokens of both
end at one byte the text is cut into groups; two tokens are linked where their
bytes overlap. For each pair of ids the index holds which documents link it and
how often (:mod:`.pair_bitmaps`): the sets are built per block of documents, and
counts per pair come from their popcounts, so what is shuffled is a row per pair
and block, never a row per link. Scores return the same way: each block gets the
counts of its own pairs, and its postings spread them over the documents.

Texts are cut at blanks that follow a character which is no white space: there
neither tokenizer joins what stands on both sides (checked on the vocabulary).
Each distinct chunk goes through both libraries once per worker, letters and the
marks behind them apart where no piece joins these. A text with a chunk whose bytes
do not come back is asked for as a whole; if they still differ it has no tokens.

Nulls: a null or empty text has no tokens, zeros and an empty hash; a null doc_id
is kept. Long texts are whole, and make a block of their own when they have very
many links. Repeated rows each count. An empty table gives an empty result.
Further columns are ignored, so names can't clash.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .common import in_order, steps, written
from .pair_bitmaps import SLOTS, PairSets, build, spread, totals
from .ragged import Column, Slices
from .token_counts import _byte_letters

#: Chunks and parts of chunks that a worker remembers; emptied when there are more.
CACHE_PARTS = 250_000
#: Distinct links of document and pair from which a block is closed.
BLOCK_LINKS = 2_000_000

_BLANK = "▁"  # how the second kind of vocabulary writes a blank
# Letters that are one code point, and marks behind them; what tells their keys apart.
_LETTER, _MARK = "[A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-ž]", "[.,;:!?]"
_PLAIN = f"^(?P<letters>{_LETTER}+)(?P<marks>{_MARK}*)$"
_LETTERS, _MARKS, _CHUNK = " ", "\n ", "\0"
_BOUNDARY = re.compile(r"(?<=\S) ")

_DOCS = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK = (
    "block long, doc_id array<{id}>, groups_sha256 array<string>, "
    + ", ".join(f"{n} array<long>" for n in _DOCS)
    + ", pair array<long>, plane array<byte>, size array<int>, data binary"
)
RESULT = (
    "doc_id {id}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
    " groups_sha256 string"
)


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b.astype(np.int64)


@dataclass
class Aligned:
    """Tokens of some texts laid end to end; counts by text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    links: np.ndarray  # pair keys
    n_links: np.ndarray
    groups: list[str]


class Sides:
    """The ids of one tokenizer: their bytes, and how they are written."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.bytes = Slices(np.uint8)
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.bytes.add(np.frombuffer(b"".join(tokens), np.uint8), self.size)
        self.name = [str(i) for i in range(len(tokens))]


class Cut:
    """Texts cut into tokens by one side, laid end to end."""

    def __init__(self, side: Sides, lists: list[list[int]]) -> None:
        self.side, self.n_texts = side, len(lists)
        self.n = np.fromiter(map(len, lists), np.int64, len(lists))
        self.ids = np.fromiter(chain.from_iterable(lists), np.int64, int(self.n.sum()))

    def only(self, kept: np.ndarray) -> Cut:
        """The texts that are ``kept``; the others have no tokens."""
        other = Cut(self.side, [])
        other.n_texts, other.n = self.n_texts, np.where(kept, self.n, 0)
        other.ids = self.ids[np.repeat(kept, self.n)]
        return other

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.n)

    def covers(self, texts: list[bytes]) -> np.ndarray:
        """Whether the tokens of each text have its bytes."""
        want = np.fromiter(map(len, texts), np.int64, len(texts))
        size = np.bincount(self.owner, self.side.size[self.ids], self.n_texts)
        good = size == want
        same, _ = self.side.bytes.take(self.ids[np.repeat(good, self.n)])
        raw = np.frombuffer(b"".join(t for t, g in zip(texts, good) if g), np.uint8)
        wrong = np.flatnonzero(same != raw)
        if len(wrong):
            kept = np.flatnonzero(good)
            good[kept[np.searchsorted(np.cumsum(want[kept]), wrong, "right")]] = False
        return good


def align(a: Cut, b: Cut) -> Aligned:
    """Align texts whose tokens cover the same bytes."""
    size_a, size_b = a.side.size[a.ids], b.side.size[b.ids]
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    # All tokens have bytes, so a token overlaps a run of the other side's tokens.
    low = np.searchsorted(end_b, end_a - size_a, "right")
    high = np.searchsorted(end_b - size_b, end_a, "left")
    each = high - low
    other = np.repeat(low - (np.cumsum(each) - each), each) + np.arange(each.sum())
    links = pair_key(np.repeat(a.ids, each), b.ids[other])
    owner = a.owner
    # Tokens that end a group: their end is an end on the other side as well.
    last_a = np.isin(end_a, end_b, assume_unique=True)
    last_b = np.isin(end_b, end_a, assume_unique=True)
    n_groups = np.bincount(owner[last_a], minlength=a.n_texts)
    n_links = np.bincount(owner, each, a.n_texts).astype(np.int64)
    both = [f"{x}|{y}" for x, y in zip(_joined(a, last_a), _joined(b, last_b))]
    bounds = np.r_[0, np.cumsum(n_groups)].tolist()
    groups = [";".join(both[s:e]) for s, e in zip(bounds, bounds[1:])]
    return Aligned(a.n, b.n, n_groups, links, n_links, groups)


def _joined(cut: Cut, last: np.ndarray) -> list[str]:
    """The ids of each group, with commas."""
    words = list(map(cut.side.name.__getitem__, cut.ids.tolist()))
    ends = (np.flatnonzero(last) + 1).tolist()
    return [words[s] if e - s == 1 else ",".join(words[s:e]) for s, e in zip([0, *ends], ends)]


class Parts:
    """Strings that were aligned before, with what came out; looked up by number."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.links = Slices(np.int64)
        self.counts = Rows()
        self.groups: list[str] = []
        self.add([""], Aligned(*[np.zeros(1, np.int64)] * 3, np.zeros(0, np.int64), np.zeros(1, np.int64), [""]))

    def add(self, strings: list[str], found: Aligned, good: np.ndarray | None = None) -> None:
        counts = np.stack([found.n_a, found.n_b, found.n_groups], axis=1)
        if good is not None:
            counts[~good] = -1
        first = self.links.add(found.links, found.n_links)
        self.counts.extend(counts)
        self.groups += found.groups
        self.number.update(zip(strings, range(first, first + len(strings))))


class Rows:
    """A table of three counts that grows at its end."""

    def __init__(self) -> None:
        self.flat = Column(np.int64)

    def extend(self, rows: np.ndarray) -> None:
        self.flat.extend(rows.ravel())

    @property
    def values(self) -> np.ndarray:
        return self.flat.values.reshape(-1, 3)


class Aligner:
    """Both tokenizers and the parts they were asked for; one per worker."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        # Letters after a blank, and marks, are one piece to the split of the first.
        self.pieces = Tokenizer(self.a.model)
        self.pieces.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        value = {c: bytes([i]) for i, c in enumerate(_byte_letters())}
        vocabulary = self.a.get_vocab()
        tokens = [b"-"] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = b"".join(value.get(c, c.encode()) for c in token)
        self.side_a = Sides(tokens)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.side_b = Sides(
            [
                bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_BLANK, " ").encode()
                for i, p in enumerate(names)
            ]
        )
        # No piece goes on over a blank, so none can join two chunks.
        if any(_BLANK in p.lstrip(_BLANK) for p in names):
            raise ValueError(f"{path_b}: a piece has a blank inside")
        # Whether letters and the marks behind them can be told apart as well.
        with open(path_a, encoding="utf-8") as f:
            split = json.load(f)["pre_tokenizer"] or {}
        self.parted = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not any(re.search(_LETTER + _MARK, p) for p in names)
            and len(self.b.encode("x")) == 1
        )
        self.parts = Parts()

    def both(self, texts: list[str]) -> tuple[np.ndarray, Aligned]:
        """Whether both sides' bytes are those of a blank and the text; without
        that a text has no tokens."""
        spaced = [f" {t}" for t in texts]
        found = self.a.encode_batch_fast(spaced, add_special_tokens=False)
        return self._aligned([e.ids for e in found], self.b.encode(texts, num_threads=1), spaced)

    def _aligned(self, a: list[list[int]], b: list[list[int]], texts: list[str]) -> tuple[np.ndarray, Aligned]:
        cut_a, cut_b = Cut(self.side_a, a), Cut(self.side_b, b)
        raw = [t.encode() for t in texts]
        good = cut_a.covers(raw) & cut_b.covers(raw)
        return good, align(cut_a.only(good), cut_b.only(good))

    def _whole_pieces(self, strings: list[str]) -> list[list[int]]:
        """Ids of the first side for strings that its split leaves whole."""
        one = self.pieces.encode(strings, is_pretokenized=True, add_special_tokens=False)
        ids, ends = one.ids, np.cumsum(np.bincount(np.array(one.word_ids, np.int64), minlength=len(strings)))
        ends = ends.tolist()
        return [ids[s:e] for s, e in zip([0, *ends], ends)]

    def _numbers(self, strings: list[str], kind: str) -> np.ndarray:
        """The part of each string: chunks as they are, letters after a blank, or marks
        behind letters. A key tells the kinds apart."""
        keys = [kind + s if s or kind == _CHUNK else "" for s in strings]  # no marks are no tokens
        known = self.parts.number
        fresh = [(k, s) for k, s in dict(zip(keys, strings)).items() if k not in known]
        if fresh:
            new, texts = map(list, zip(*fresh))
            if kind == _CHUNK:
                good, found = self.both(texts)
            elif kind == _LETTERS:
                spaced = [f" {t}" for t in texts]
                good, found = self._aligned(self._whole_pieces(spaced), self.b.encode(texts, num_threads=1), spaced)
            else:
                behind = [ids[1:] for ids in self.b.encode([f"x{t}" for t in texts], num_threads=1)]
                good, found = self._aligned(self._whole_pieces(texts), behind, texts)
            self.parts.add(new, found, good)
        return np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))

    def _chunks(self, texts: list[str | None]) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Distinct chunks, the chunk at each place, and the bounds of the texts."""
        lists = pc.split_pattern(pa.array([t or "" for t in texts], pa.large_string()), " ")
        bounds = lists.offsets.to_numpy()
        coded = lists.values.dictionary_encode()
        # A chunk that is empty or ends in white space stands before a blank that is no boundary.
        sure = [bool(c) and not c[-1].isspace() for c in coded.dictionary.to_pylist()]
        unsure = ~np.array(sure, bool)[coded.indices.to_numpy()]
        odd = np.flatnonzero(np.diff(np.r_[0, np.cumsum(unsure)][bounds]))
        if len(odd):
            split = [_BOUNDARY.split(texts[i]) if texts[i] else [] for i in odd]
            sizes = np.diff(bounds)
            keep = np.ones(len(sizes), bool)
            keep[odd] = False
            place = np.repeat(np.arange(len(sizes)), sizes)
            flat = lists.values.filter(pa.array(keep[place]))
            more = pa.array([c for s in split for c in s], pa.large_string())
            place = np.r_[place[keep[place]], np.repeat(odd, [len(s) for s in split])]
            order = np.argsort(place, kind="stable")
            coded = pa.concat_arrays([flat, more]).take(pa.array(order)).dictionary_encode()
            bounds = np.searchsorted(place[order], np.arange(len(texts) + 1))
        return coded.dictionary, coded.indices, bounds

    def texts(self, texts: list[str | None]) -> Aligned:
        """Texts without tokens have zeros and an empty string."""
        if len(self.parts.number) > CACHE_PARTS:
            self.parts = Parts()
        distinct, places, bounds = self._chunks(texts)
        two = np.zeros((len(distinct), 2), np.int64)
        found = pc.extract_regex(distinct, _PLAIN)
        plain = found.is_valid().to_numpy(zero_copy_only=False) & self.parted
        parted = found.filter(pa.array(plain))
        two[plain, 0] = self._numbers(parted.field("letters").to_pylist(), _LETTERS)
        two[plain, 1] = self._numbers(parted.field("marks").to_pylist(), _MARKS)
        two[~plain, 0] = self._numbers(distinct.filter(pa.array(~plain)).to_pylist(), _CHUNK)

        # Sums over each distinct chunk first, then over the texts.
        at = places.to_numpy()
        counts = self.parts.counts.values[two]
        wrong = (counts[:, :, 0] < 0).any(axis=1)
        bad = np.flatnonzero(np.diff(np.r_[0, np.cumsum(wrong[at])][bounds]))
        counts = counts.sum(axis=1)
        sums = np.stack([np.diff(np.r_[0, np.cumsum(c[at])][bounds]) for c in counts.T], axis=1)
        links, lengths = self.parts.links.take(two[at].ravel())
        n_links = np.diff(np.r_[0, np.cumsum(lengths)][2 * bounds])
        name = self.parts.groups
        names = [f"{name[i]};{name[j]}" if j else name[i] for i, j in two.tolist()]
        flat, starts = list(map(names.__getitem__, at.tolist())), bounds.tolist()
        groups = [";".join(flat[s:e]) for s, e in zip(starts, starts[1:])]
        if len(bad):
            links, n_links = self._whole(texts, bad, links, n_links, sums, groups)
        return Aligned(sums[:, 0], sums[:, 1], sums[:, 2], links, n_links, groups)

    def _whole(self, texts, bad, links, n_links, sums, groups):
        """Texts with a chunk whose bytes differ, each as a whole; changes ``sums`` and ``groups``."""
        _, found = self.both([texts[i] or "" for i in bad])
        sums[bad] = np.stack([found.n_a, found.n_b, found.n_groups], axis=1)
        for i, g in zip(bad, found.groups):
            groups[i] = g
        pieces = np.split(links, np.cumsum(n_links)[:-1])
        for i, piece in zip(bad, np.split(found.links, np.cumsum(found.n_links)[:-1])):
            pieces[i] = piece
        return np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)


_aligners: dict[tuple[str, str], Aligner] = {}


class _Block:
    """Documents that share a set of bitmaps."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.ids: list[pa.Array] = []
        self.hashes: list[str] = []
        self.counts: list[np.ndarray] = []
        self.postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_slots = self.n_links = 0

    def add(self, ids: pa.Array, found: Aligned) -> None:
        slot = np.repeat(np.arange(len(ids)), found.n_links)
        order = np.lexsort((slot, found.links))
        pair, slot = found.links[order], slot[order]
        new = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (slot[1:] != slot[:-1])][: len(pair)])
        times = np.diff(np.r_[new, len(pair)])
        self.postings.append((pair[new], slot[new] + self.n_slots, times))
        self.ids.append(ids)
        self.hashes += [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups]
        self.counts.append(np.stack([found.n_a, found.n_b, found.n_groups, found.n_links]))
        self.n_slots += len(ids)
        self.n_links += len(new)

    def row(self) -> pa.RecordBatch:
        pair, slot, times = (np.concatenate(c) for c in zip(*self.postings))
        sets = build(pair, slot, times, self.n_slots)
        counts = np.concatenate(self.counts, axis=1)
        ids = pa.concat_arrays(self.ids)
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        columns = {
            "block": pa.array([self.number], pa.int64()),
            "doc_id": one(ids),
            "groups_sha256": one(pa.array(self.hashes, pa.string())),
            **{n: one(pa.array(c)) for n, c in zip(_DOCS, counts)},
            "pair": one(pa.array(sets.pair)),
            "plane": one(pa.array(sets.plane)),
            "size": one(pa.array(sets.size)),
            "data": pa.array([sets.data], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _sets(block: dict) -> PairSets:
    arrays = [np.array(block[n], t) for n, t in (("pair", np.int64), ("plane", np.int8), ("size", np.int32))]
    return PairSets(len(block["groups_sha256"]), *arrays, block["data"])


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    """Each row's lists as numpy arrays; ``data`` as bytes."""
    for i in range(batch.num_rows):
        row = {}
        for name in batch.schema.names:
            value = batch.column(name)[i]
            if name == "data":
                row[name] = value.as_py()
            elif pa.types.is_list(value.type):
                row[name] = value.values if name == "doc_id" else value.values.to_numpy(zero_copy_only=False)
            else:
                row[name] = value.as_py()
        yield row


def index(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per block of documents: their counts and hashes, and the sets of their pairs."""
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path_a, path_b) not in _aligners:
            _aligners[path_a, path_b] = Aligner(path_a, path_b)
        aligner = _aligners[path_a, path_b]
        # The same numbers when a lost task runs again.
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for piece in steps(batches):
            for start in range(0, piece.num_rows, SLOTS):
                part = piece.slice(start, SLOTS)
                if block.n_slots + part.num_rows > SLOTS:
                    yield block.row()
                    block = _Block(number := number + 1)
                block.add(part.column("doc_id"), aligner.texts(part.column("text").to_pylist()))
                if block.n_links >= BLOCK_LINKS:
                    yield block.row()
                    block = _Block(number := number + 1)
        if block.n_slots:
            yield block.row()

    return slim.mapInArrow(run, _BLOCK.format(id=kind))


def _counted(blocks: DataFrame) -> DataFrame:
    """block, pair, docs, links: popcounts of each block's sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                pair, docs, links = totals(_sets(row))
                number = np.full(len(pair), row["block"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (number, pair, docs, links)], ["block", "pair", "docs", "links"]
                )

    slim = blocks.select("block", "pair", "plane", "size", "data", "groups_sha256")
    return slim.mapInArrow(run, "block long, pair long, docs long, links long")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """a, b, pair, docs, links, best: each pair over the corpus, and whether no other
    pair with the same ``b`` has more links."""
    found = _counted(blocks).groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    found = found.select(
        F.shiftright("pair", 32).cast("int").alias("a"),
        F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"),
        "pair",
        "docs",
        "links",
    )
    # A group has at most as many rows as the first vocabulary has ids.
    most = F.max("links").over(Window.partitionBy("b"))
    return found.withColumn("best", F.col("links") == most)


def scored(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document, with the scores of its links."""
    kind = blocks.schema["doc_id"].dataType.elementType.simpleString()
    schema = RESULT.format(id=kind)
    wanted = _counted(blocks).select("block", "pair")
    scores = wanted.join(counts.select("pair", "links", "best"), "pair")

    def give(found: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        order = np.argsort(pair := found.column("pair").to_numpy())
        best = found.column("best").to_numpy().astype(np.int64)[order]
        links = found.column("links").to_numpy()[order]
        for row in _rows(held.combine_chunks()):
            n_best, count_sum = spread(_sets(row), pair[order], [best, links])
            columns = {
                "doc_id": row["doc_id"],
                **{n: pa.array(row[n]) for n in _DOCS},
                "n_best": pa.array(n_best),
                "count_sum": pa.array(count_sum),
                "groups_sha256": pa.array(row["groups_sha256"], pa.string()),
            }
            out.append(pa.table(columns))
        return pa.concat_tables(out)

    return scores.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(give, schema)


def op13_alignment(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """All documents, with counts of their links over all documents."""
    blocks = written(index(in_order(documents, "doc_id", "text"), path_a, path_b), "pair-sets")
    counts = written(pair_counts(blocks), "pair-counts")
    return scored(blocks, counts)
