"""Line-first cleaning: judge lines, drop those that fail, then judge the loss.

A line with a word fails by the first of these rules that holds:

* ``navigation``: three or more separator words, and at least a fifth of its words;
* ``symbols``: as many symbols as words, three at least;
* ``shouting``: three words or more, over half of which end in ``!!``;
* ``punctuation``: its last word has no closing mark, and fewer than one word
  in 30 ends a sentence (a cut-off or shuffled paragraph passes, a list doesn't);
* ``boilerplate``: it holds a stock phrase of web pages, or repeats an earlier
  line of the same text.

A text that loses more than ``max_loss`` of its word characters is rejected, as
is one that fails the base rules (fewer than 50 words; over half of its words in
three-word runs that occur twice). Lines without words are kept as they are.

Nulls: a null text is empty, so base_failed; null ids and other columns are
passed on. Empty texts have zero counts. Long texts are judged whole. Repeated
rows each give a row; an empty table gives an empty result. The input row is
kept in the struct ``row``, so its columns can't clash with ours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_order, map_steps, raw_texts

# What the rules look for.
SYMBOLS = "#*$%&|<>"
SEPARATORS = ("|", "›", "»", "·", ">", "/")
SENTENCE_ENDS = (".", "!", "?", "…")
CLOSING = (*SENTENCE_ENDS, '"', "'", "”", "’", "»", ")", "]", ":", ";")
PHRASES = (
    "privacy policy",
    "terms of use",
    "terms of service",
    "use of cookies",
    "uses cookies",
    "enable javascript",
    "all rights reserved",
    "lorem ipsum",
    "skip to content",
    "back to top",
    "click here",
    "share this page",
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOSS_PERCENT = 30
WORDS_PER_SENTENCE = 30

_SPACES = b" \t\n\x0b\x0c\r"
_SYMBOLS = SYMBOLS.encode()
_SEPARATORS = frozenset(s.encode() for s in SEPARATORS)
_SENTENCE_ENDS = tuple(s.encode() for s in SENTENCE_ENDS)
_CLOSING = tuple(s.encode() for s in CLOSING)
_PHRASES = tuple(s.encode() for s in PHRASES)

_REPORT = (
    "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint,"
    " n_repeat_words: bigint, base_failed: boolean, n_lines: bigint, n_failed_lines: bigint,"
    " lost_chars: bigint, kept: boolean>"
)


def _letters(b: bytes) -> int:
    """Code points of the words."""
    return len(b.translate(None, _SPACES).decode("utf-8", "replace"))


def line_fault(line: bytes, words: list[bytes], repeated: bool) -> str | None:
    """The rule by which a line with words fails."""
    n = len(words)
    separators = sum(map(_SEPARATORS.__contains__, words))
    if separators >= 3 and 5 * separators >= n:
        return "navigation"
    symbols = len(line) - len(line.translate(None, _SYMBOLS))
    if symbols >= max(3, n):
        return "symbols"
    if n >= 3 and b"!!" in line and 2 * sum(w.endswith(b"!!") for w in words) > n:
        return "shouting"
    if not words[-1].endswith(_CLOSING):
        if WORDS_PER_SENTENCE * sum(w.endswith(_SENTENCE_ENDS) for w in words) < n:
            return "punctuation"
    if repeated:
        return "boilerplate"
    low = line.lower()
    if any(p in low for p in _PHRASES):
        return "boilerplate"
    return None


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def repeat_words(ids: np.ndarray, n_ids: int) -> int:
    """Words in three-word windows that are found twice or more."""
    if len(ids) < 4:
        return 0
    pair = ids[:-1] * n_ids + ids[1:]
    if n_ids >= 1 << 21:  # three ids don't fit in 63 bits: number the pairs first
        pair = np.unique(pair, return_inverse=True)[1]
        n_ids = max(n_ids, int(pair.max()) + 1)
    keys = pair[:-1] * n_ids + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    covered = np.zeros(len(ids), bool)
    starts = np.r_[order[1:][same], order[:-1][same]]
    for k in range(3):
        covered[starts + k] = True
    return int(covered.sum())


def judge(text: bytes) -> tuple[tuple, bytes]:
    """The report of one text, in the order of its columns, and the clean text."""
    flat, lost, failed, dups, n_lines = [], 0, 0, 0, 0
    seen, clean = set(), []
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            n_lines += 1
            flat += words
            repeated = line in seen
            dups += repeated
            seen.add(line)
            if line_fault(line, words, repeated):
                failed += 1
                lost += _letters(line)
                continue
        clean.append(line)
    n, chars, ids = len(flat), _letters(text), _Ids()
    numbers = np.fromiter(map(ids.__getitem__, flat), np.int64, n)
    repeats = repeat_words(numbers, len(ids))
    base_failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    kept = not base_failed and 100 * lost <= MAX_LOSS_PERCENT * chars
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    report = (n, chars, symbols, dups, repeats, base_failed, n_lines, failed, lost, kept)
    return report, b"\n".join(clean)


def clean_lines(docs: DataFrame, text: str = "text", with_text: bool = True) -> DataFrame:
    """``row`` (the input row without its text), ``report`` and the ``clean`` text."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).alias("none")]
    rows = docs.select(F.struct(*others).alias("row"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    names = [f.split(":")[0].strip() for f in _REPORT[7:-1].split(",")]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        judged = [judge(t) for t in raw_texts(batch)]
        columns = list(zip(*[r for r, _ in judged]))
        report = pa.StructArray.from_arrays([pa.array(list(c)) for c in columns], names)
        out = [batch.column("row"), report]
        if with_text:
            out.append(pa.array([c for _, c in judged], pa.binary()).cast(pa.string()))
        return pa.RecordBatch.from_arrays(out, ["row", "report", "clean"][: len(out)])

    clean = ", clean string" if with_text else ""
    return map_steps(rows, step, f"row {kind}, report {_REPORT}{clean}")


def op2_line_rules(documents: DataFrame) -> DataFrame:
    judged = clean_lines(in_order(documents, "doc_id", "text"), with_text=False)
    return judged.select("row.doc_id", "report.*")


def _sql_list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

OP2_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, {_WORDS.format("t")} AS ws FROM docs
), windows AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), repeats AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), lines AS (
  SELECT r, i, ls[i] AS line, {_WORDS.format("ls[i]")} AS lw
  FROM (SELECT r, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT r, string_split(t, chr(10)) AS ls FROM docs))
), worded AS (
  SELECT *, len(lw) AS n, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again,
    len(list_filter(lw, lambda x: list_contains({_sql_list(SEPARATORS)}, x))) AS seps,
    length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS syms,
    len(list_filter(lw, lambda x: suffix(x, '!!'))) AS shouts,
    len(list_filter(lw, lambda x: list_contains({_sql_list(SENTENCE_ENDS)}, right(x, 1)))) AS ends,
    list_contains({_sql_list(CLOSING)}, right(lw[-1], 1)) AS closed,
    len(list_filter({_sql_list(PHRASES)}, lambda p: contains(lower(line), p))) > 0 AS stock
  FROM lines WHERE len(lw) > 0
), judged AS (
  SELECT *, length(list_aggregate(lw, 'string_agg', '')) AS chars,
    (seps >= 3 AND 5 * seps >= n) OR syms >= greatest(3, n)
    OR (n >= 3 AND 2 * shouts > n) OR (NOT closed AND {WORDS_PER_SENTENCE} * ends < n)
    OR again OR stock AS bad
  FROM worded
), by_doc AS (
  SELECT r, sum(chars) AS word_chars, sum(n) AS n_words, sum(again::INT) AS n_dup_lines,
    count(*) AS n_lines, sum(bad::INT) AS n_failed_lines,
    sum(CASE WHEN bad THEN chars ELSE 0 END) AS lost_chars
  FROM judged GROUP BY r
), counted AS (
  SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
    coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines,
    coalesce(n_failed_lines, 0)::BIGINT AS n_failed_lines,
    coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM docs LEFT JOIN by_doc USING (r) LEFT JOIN repeats USING (r)
)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
    AS base_failed,
  NOT base_failed AND 100 * lost_chars <= {MAX_LOSS_PERCENT} * word_chars AS kept
FROM counted
"""
