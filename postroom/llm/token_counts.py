"""Token counts by rank-synchronous merging of ragged arrays.

For vocabularies of the kind ``BPE with a mark at word ends`` in a
``tokenizers`` JSON file: NFC, white space to a blank, lower case, a split by
pattern, bytes as symbols. Texts are cut at ASCII white space, which every step
respects; each distinct chunk is counted once per worker, as long as the cache
(bounded, emptied when full) holds it.

The distinct chunks' pre-tokens are laid out as one ragged numpy array of
symbols. In each round every sequence finds its lowest-rank pair and merges all
its places at once, left to right; a sequence without a pair is done, and its
symbols are counted. A merge makes only pairs of higher rank, as each symbol is
made by one merge, so a round may take all places of a pair together.

Nulls: a null text has no tokens, a null id is kept. Empty texts count 0; long
texts and pre-tokens are counted whole; repeated rows each give a row.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import unicodedata
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_order, long_column, map_steps, raw_texts

#: Distinct chunks that a worker remembers.
CACHE_CHUNKS = 400_000

_NO_RANK = np.int64(1 << 40)


@dataclass(frozen=True)
class Vocabulary:
    """What counting needs of a vocabulary file; its size is that of the file."""

    pattern: str
    specials: tuple[str, ...]
    n_symbols: int
    first: np.ndarray  # id of each byte within a word
    last: np.ndarray  # id of each byte at the end of a word
    keys: np.ndarray  # pairs as left * n_symbols + right, sorted
    ranks: np.ndarray
    merged: np.ndarray


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b], spare = chr(spare), spare + 1
    return [letters[b] for b in range(256)]


def read_vocabulary(path: str) -> Vocabulary:
    """Read a JSON vocabulary on the driver; other kinds of files are refused."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, end = spec["model"], spec["model"].get("end_of_word_suffix")
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    if model["type"] != "BPE" or not end or steps != ["NFC", "Replace", "Lowercase"]:
        raise ValueError(f"{path}: only lower-case BPE with word ends is supported")
    split, as_bytes = spec["pre_tokenizer"]["pretokenizers"]
    if not split["invert"] or as_bytes["type"] != "ByteLevel":
        raise ValueError(f"{path}: unknown split")
    ids = model["vocab"]
    letters, n = _byte_letters(), max(ids.values()) + 1
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    keys = np.array([ids[a] * n + ids[b] for a, b in pairs], np.int64)
    merged = np.array([ids[a + b] for a, b in pairs], np.int64)
    if len(set(merged.tolist())) != len(merged):
        raise ValueError(f"{path}: a symbol is made by two merges")
    order = np.argsort(keys)
    return Vocabulary(
        split["pattern"]["Regex"],
        tuple(t["content"] for t in spec["added_tokens"]),
        n,
        np.array([ids[c] for c in letters], np.int64),
        np.array([ids[c + end] for c in letters], np.int64),
        keys[order],
        order.astype(np.int64),
        merged[order],
    )


def merge_counts(sequences: list[bytes], vocabulary: Vocabulary) -> np.ndarray:
    """Symbols that are left of each non-empty pre-token after all merges."""
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    counts = np.zeros(len(sequences), np.int64)
    if not sequences:
        return counts
    flat = np.frombuffer(b"".join(sequences), np.uint8)
    symbols = vocabulary.first[flat]
    ends = np.cumsum(lengths) - 1
    symbols[ends] = vocabulary.last[flat[ends]]
    owner = np.repeat(np.arange(len(sequences)), lengths)
    while len(symbols):
        inside = owner[1:] == owner[:-1]
        key = symbols[:-1] * vocabulary.n_symbols + symbols[1:]
        at = np.minimum(np.searchsorted(vocabulary.keys, key), len(vocabulary.keys) - 1)
        known = inside & (vocabulary.keys[at] == key)
        # A last place without a pair closes every sequence.
        rank = np.full(len(symbols), _NO_RANK)
        rank[:-1][known] = vocabulary.ranks[at[known]]
        starts = np.flatnonzero(np.r_[True, ~inside])
        lowest = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.r_[starts, len(symbols)])
        done = lowest == _NO_RANK
        counts[owner[starts[done]]] = sizes[done]
        take = (rank == np.repeat(lowest, sizes)) & (rank < _NO_RANK)
        # Of neighbouring places (one symbol repeated) every second one is merged.
        places = np.flatnonzero(take)
        run = np.cumsum(np.r_[True, np.diff(places) > 1]) - 1 if len(places) else places
        head = places[np.r_[True, np.diff(places) > 1]] if len(places) else places
        places = places[(places - head[run]) % 2 == 0] if len(places) else places
        symbols[places] = vocabulary.merged[at[places]]
        keep = ~np.repeat(done, sizes)
        keep[places + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    return counts


class Counter:
    """Counts of whole texts; one per worker and vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.pattern = regex.compile(vocabulary.pattern + "|\n")
        self.special = None
        if vocabulary.specials:
            longest_first = sorted(vocabulary.specials, key=len, reverse=True)
            self.special = regex.compile("|".join(map(regex.escape, longest_first)))
        self.known: dict[bytes, int] = {}

    def learn(self, chunks: list[bytes]) -> None:
        """Count distinct chunks together: lines of one text, split by one search."""
        lines, extra = [], np.zeros(len(chunks), np.int64)
        for i, raw in enumerate(chunks):
            line = raw.decode()
            if self.special is not None and (found := self.special.findall(line)):
                extra[i] = len(found)
                line = self.special.sub(" ", line)  # a blank parts what stood around it
            lines.append(line)
        # Lower case letter by letter: a last sigma is no exception.
        joined = unicodedata.normalize("NFC", "\n".join(lines)).replace("Σ", "σ").lower()
        index: dict[str, int] = {"\n": 0}
        found = self.pattern.findall(joined)
        at = np.fromiter((index.setdefault(t, len(index)) for t in found), np.int64, len(found))
        tokens = [t.encode() for t in index][1:]
        sizes = np.r_[0, merge_counts(tokens, self.vocabulary)]
        line_of = np.cumsum(at == 0)[at > 0]
        counts = np.bincount(line_of, sizes[at[at > 0]], len(chunks)).astype(np.int64) + extra
        self.known.update(zip(chunks, counts.tolist()))

    def count(self, texts: list[bytes]) -> list[int]:
        chunks = [t.split() for t in texts]
        fresh = set().union(*chunks).difference(self.known)
        if fresh:
            if len(self.known) + len(fresh) > CACHE_CHUNKS:
                self.known.clear()
                fresh = set().union(*chunks)
            self.learn(list(fresh))
        return [sum(map(self.known.__getitem__, c)) for c in chunks]


_counters: dict[str, Counter] = {}


def count_tokens(
    docs: DataFrame, path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row."""
    vocabulary = read_vocabulary(path)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = _counters.get(path)
        if counter is None:
            counter = _counters[path] = Counter(vocabulary)
        texts = raw_texts(batch)
        n = np.array(counter.count(texts), np.int64)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(t) for t in texts], pa.int64()),
                long_column(n),
                pa.array(n > limit),
            ],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_steps(rows, step, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op9_counts(documents: DataFrame, path: str) -> DataFrame:
    return count_tokens(in_order(documents, "doc_id", "text"), path, 2048)
