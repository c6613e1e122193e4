"""Personal data: exact base rules, and spans that a trained tagger adds.

Base rules find e-mail addresses, IP addresses, card numbers (with Luhn's check)
and phone numbers; their spans always stay. The tagger, a bidirectional LSTM over
characters with CRF transitions, is trained from the base spans of a bounded
sample, as they are and rewritten the way people hide or mistype such data. It
reads overlapping windows of the whole text. A window's span counts if its centre
is in the part for which that window is the middle one; what windows then give for
a text is joined, and a span is added if it touches no base span and passes its
kind's check without regard to separators.

A span has a digit, an ``@``, or ``(at)`` or ``at`` before a dotted name by its kind's
definition, so a window without any has no span whatever the tagger says, and isn't
run. Where digits are everywhere, all windows are run. Where a span touches a window's
edge the next window is run as well, and the pieces are also joined.

Training: about TRAIN_TEXTS texts with a digit or an ``@``, twice as many at most,
and at most TRAIN_WINDOWS windows of them. Without a base span in the sample
nothing is trained or added.

Nulls: a null text is empty; a null id is carried along. Empty texts have no spans.
Long texts are read whole, window by window. Repeated rows each give a row; of spans
that tie the earlier, then the longer stays. An empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tagger
from .common import bounded_sample, in_order, map_steps, raw_texts, steps

# Kinds in order, and their patterns. Where a run of one class may be
# long, the pattern starts at the run's first character only, which changes no match
# and keeps the search linear.
KINDS = ("email", "ip", "card", "phone")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
#: What a span of some kind must hold, rewritten addresses included.
_AT = r"@|\(at\)|\bat\b"
_SIGN = re.compile(rf"[0-9@]|(?:{_AT})\s*[A-Za-z0-9-]+\.[A-Za-z0-9-]", re.I)

TRAIN_TEXTS = 3_000
TRAIN_WINDOWS = 2_000
EPOCHS = 6
WIDTH, STRIDE = 80, 40
BATCH = 512

Span = tuple[int, int, str]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def valid(kind: str, found: str) -> bool:
    """What a match of a kind's pattern must also fulfil."""
    if kind == "ip":
        return all(map(_small, found.split(".")))
    if kind == "card":
        digits = _digits(found)
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(_digits(found)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            free = m.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that don't overlap, without those that fail."""
    spans: list[Span] = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for m in pattern.finditer(text):
            if valid(kind, m[0]):
                spans.append((m.start(), m.end(), kind))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


# --- training -----------------------------------------------------------------


def _rewritten(kind: str, found: str, draw: np.random.Generator) -> str:
    """A span as it may also be written; the base rules need not find it."""
    way = int(draw.integers(4))
    if kind == "email":
        return found.replace("@", ("@", " @ ", " at ", "(at)")[way])
    if kind == "ip":
        return found.replace(".", (".", " . ", ". ", ".")[way])
    if kind == "card":
        digits, gap = _digits(found), ("", ".", " - ", " ")[way]
        return gap.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    digits = _digits(found)
    if len(digits) < 10:
        return found
    code, a, b, c = digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:]
    return (found, f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{code} {a} {b} {c}")[way]


def training_windows(text: str) -> list[tuple[str, list[Span]]]:
    """Windows of a text around its base spans, plain and rewritten, and around other digits.

    Digit runs that look like cards but fail the check say nothing about shape:
    their last digit is corrected, and they count as cards.
    """
    draw = np.random.default_rng(xxhash.xxh32_intdigest(text.encode("utf-8", "replace")))
    spans, out = base_spans(text), []
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and not luhn(digits):
            for last in "0123456789":
                if luhn(digits[:-1] + last):
                    text = text[: m.end() - 1] + last + text[m.end() :]
                    spans.append((m.start(), m.end(), "card"))
    spans.sort()
    places = [(s, True) for s in spans[:8]]
    marks = [m.start() for m in _MARK.finditer(text)]
    bare = [k for k in marks if not any(a <= k < b for a, b, _ in spans)]
    places += [((k, k + 1, ""), False) for k in bare[:: max(1, len(bare) // 3)][:3]]
    for (a, b, kind), real in places:
        for rewrite in (False, True) if real else (False,):
            new = _rewritten(kind, text[a:b], draw) if rewrite else text[a:b]
            whole = text[max(0, a - WIDTH) : a] + new + text[b : b + WIDTH]
            shift, grown = a - max(0, a - WIDTH), len(new) - (b - a)
            base = max(0, a - WIDTH)
            inside = [(shift, shift + len(new), kind)] if real else []
            for c, d, other in spans:
                if (c, d, other) != (a, b, kind):
                    move = grown if c >= b else 0
                    if c - base >= 0 and (d <= a or c >= b):
                        inside.append((c - base + move, d - base + move, other))
            first = max(0, min(shift - int(draw.integers(0, WIDTH // 2)), len(whole) - WIDTH))
            window = whole[first : first + WIDTH]
            kept = [(c - first, d - first, o) for c, d, o in inside if d > first and c < first + WIDTH]
            out.append((window, kept))
    return out


def label_row(spans: list[Span]) -> np.ndarray:
    """Labels of a window: 0 outside; 1 + 2 k at the start and 2 + 2 k within kind k."""
    row = np.zeros(WIDTH, np.int64)
    for a, b, kind in spans:
        k = KINDS.index(kind)
        row[max(a, 0) : b] = 2 + 2 * k
        if 0 <= a < WIDTH:
            row[a] = 1 + 2 * k
    return row


def _char_row(window: str) -> np.ndarray:
    row = np.zeros(WIDTH, np.int64)
    row[: len(window)] = tagger.encode(window)
    return row


def fit(docs: DataFrame) -> tagger.Params | None:
    """Train in one task on the bounded sample; the weights are a few thousand numbers."""
    marked = in_order(docs, "text").where(F.col("text").rlike("[0-9@]"))
    hashed = bounded_sample(marked, TRAIN_TEXTS).withColumn("h", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: list[tuple[str, list[Span]]] = []
        for batch in steps(batches):
            for text in raw_texts(batch):
                if len(windows) < TRAIN_WINDOWS:
                    windows += training_windows(text.decode("utf-8", "replace"))
        windows = windows[:TRAIN_WINDOWS]
        if any(spans for _, spans in windows):
            chars = np.array([_char_row(w) for w, _ in windows]).T
            labels = np.array([label_row(s) for _, s in windows]).T
            model = tagger.train(chars, labels, 1 + 2 * len(KINDS), EPOCHS)
            model = {k: v.astype(np.float32) for k, v in model.items()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([pickle.dumps(model)], pa.binary())], ["model"]
            )

    got = hashed.orderBy("h", "text").coalesce(1).select("text").mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else None


# --- tagging ------------------------------------------------------------------


def _tagged(kind: str, a: int, b: int, text: str) -> Span | None:
    """A tagged span, trimmed and checked without regard to separators."""
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    if text[max(a - 1, 0) : a].isdigit() or text[b : b + 1].isdigit():
        return None  # a part of a longer number
    found = text[a:b]
    if kind == "email":
        plain = re.sub(rf"\s*({_AT})\s*", "@", found, flags=re.I)
        ok = [*_emails(plain)] == [(0, len(plain))]
    elif kind == "ip":
        parts = re.split(r"\s*\.\s*", found)
        ok = len(parts) == 4 and all(p.isascii() and p.isdigit() and _small(p) for p in parts)
    elif kind == "card":
        ok = re.fullmatch(r"[0-9\s.-]+", found) is not None and valid(kind, found)
    else:
        ok = re.fullmatch(r"\+?[0-9(][0-9()\s./-]*", found) is not None
        ok = ok and re.search(r"[()\s./-]", found) is not None and valid(kind, found)
    return (a, b, kind) if ok else None


def _last_window(text: str) -> int:
    return max(0, -(-(len(text) - WIDTH) // STRIDE))


def _stitched(pieces: list[tuple[int, int, bool, bool]]) -> list[tuple[int, int]]:
    """Pieces, with whether a window's edge cuts their start and end, joined where they overlap."""
    out: list[tuple[int, int, bool]] = []
    for a, b, cut_start, cut_end in sorted(pieces):
        if out and a < out[-1][1] and (cut_start or out[-1][2]):
            start, end, was_cut = out.pop()
            out.append((start, max(b, end), cut_end if b > end else was_cut))
        else:
            out.append((a, b, cut_end))
    return [(a, b) for a, b, _ in out]


def add_spans(texts: list[str], base: list[list[Span]], model: tagger.Params) -> list[list[Span]]:
    """Base spans of each text with those that the tagger adds."""
    where: list[tuple[int, int]] = []
    for t, text in enumerate(texts):
        marks = np.fromiter((m.start() for m in _SIGN.finditer(text)), np.int64)
        if len(marks):
            last = _last_window(text)
            high = np.minimum(marks // STRIDE, last)
            low = np.maximum(0, -(-(marks - WIDTH + 1) // STRIDE))
            # WIDTH is twice STRIDE, so a place is in two windows at most.
            where += [(t, int(k)) for k in np.unique(np.r_[low, high]) if k <= last]
    out = [list(s) for s in base]
    raw: list[list[Span]] = [[] for _ in texts]
    pieces: list[dict[str, set]] = [{} for _ in texts]
    run = set(where)
    while where:
        more: set[tuple[int, int]] = set()
        for a in range(0, len(where), BATCH):
            some = where[a : a + BATCH]
            chars = np.array([_char_row(texts[t][k * STRIDE : k * STRIDE + WIDTH]) for t, k in some])
            labels = tagger.decode(model, chars.T).T
            for (t, k), row in zip(some, labels):
                if not row.any():
                    continue
                begins = np.flatnonzero((row > 0) & (np.r_[0, row[:-1]] != row) & ((row % 2 == 1) | (np.r_[0, row[:-1]] != row - 1)))
                for first in begins.tolist():
                    kind, end = (int(row[first]) - 1) // 2, first + 1
                    while end < WIDTH and row[end] == 2 + 2 * kind:
                        end += 1
                    middle, at = (first + end) / 2, k * STRIDE
                    whole = len(texts[t])
                    left = 0 if k == 0 else STRIDE / 2
                    right = WIDTH if at + WIDTH >= whole else WIDTH - STRIDE / 2
                    span = (at + first, min(at + end, whole), KINDS[kind])
                    if left <= middle < right:
                        raw[t].append(span)
                    cut_start, cut_end = first == 0 and k > 0, end == WIDTH and at + WIDTH < whole
                    pieces[t].setdefault(KINDS[kind], set()).add((*span[:2], cut_start, cut_end))
                    if cut_start:
                        more.add((t, k - 1))
                    if cut_end:
                        more.add((t, k + 1))
        where = sorted(more - run)
        run |= more
    for t, kinds in enumerate(pieces):
        for kind, found in kinds.items():
            if any(p[2] or p[3] for p in found):
                raw[t] += [(a, b, kind) for a, b in _stitched([*found])]
    for t, found in enumerate(raw):
        taken = sorted(out[t])
        for a, b, kind in sorted(set(found), key=lambda s: (s[0], -s[1], KINDS.index(s[2]))):
            span = _tagged(kind, a, b, texts[t])
            if span and not any(span[0] < d and c < span[1] for c, d, _ in taken):
                taken.append(span)
        out[t] = sorted(taken, key=lambda s: (s[0], KINDS.index(s[2])))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans, both as texts ``kind:start:end``, and base counts."""
    rows = in_order(docs, "doc_id", "text")
    model = fit(rows)
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = [f"n_{k}" for k in KINDS]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.decode("utf-8", "replace") for t in raw_texts(batch)]
        base = [base_spans(t) if _MARK.search(t) else [] for t in texts]
        spans = base if model is None else add_spans(texts, base, model)
        numbers = [[sum(s[2] == k for s in b) for b in base] for k in KINDS]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.array(n, pa.int64()) for n in numbers),
                pa.array([joined(b) for b in base], pa.string()),
                pa.array([joined(s) for s in spans], pa.string()),
            ],
            ["doc_id", *counts, "base", "spans"],
        )

    columns = ", ".join(f"{c} long" for c in counts)
    return map_steps(rows, step, f"doc_id {kind}, {columns}, base string, spans string")


def op5_spans(documents: DataFrame) -> DataFrame:
    found = find_personal_data(documents)
    sha = F.sha2(F.encode("base", "UTF-8"), 256).alias("base_sha256")
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], sha, "spans")
