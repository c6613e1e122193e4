"""Token id files against the library on whole texts, and what the files look like."""

from __future__ import annotations

import random
import struct
import zlib
from glob import glob

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from postroom.llm import token_ids

WORDS, BYTES = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json"))
END = 2

ODD = [*"abcXYZ ,.;'!?\n\t\x0b 　éÉßẞİıſΣσςǅĳĲŉ漢字١²½´`_-<|>012́̇", "<|endoftext|>", "<|ENDOFTEXT|>"]


def odd_texts(n, seed=3):
    draw = random.Random(seed)
    return ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 40))) for _ in range(n)]


def expected(rows, path):
    """start, n_tokens and checksum of each row in order of its id, by the library."""
    library, start, out = Tokenizer.from_file(path), 0, []
    key = lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()))
    for i, t in sorted(rows, key=key):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, END]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_round_trip_equals_library(spark, documents, texts, path):
    got = token_ids.op11_round_trip(documents, path, END)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected(texts, path)


def test_odd_texts(spark):
    rows = list(enumerate(odd_texts(3000)))
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = token_ids.op11_round_trip(docs, WORDS, END).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows, WORDS)


def test_words_are_forgotten_when_there_are_too_many(monkeypatch):
    monkeypatch.setattr(token_ids, "CACHE_WORDS", 50)
    assert token_ids.cut_at_blanks(WORDS) and not token_ids.cut_at_blanks(BYTES)
    by_words, whole = token_ids.WordEncoder(WORDS, END), token_ids.TextEncoder(WORDS, END)
    texts = [t.encode() for t in odd_texts(300, 9)]
    for k in range(0, 300, 10):
        a, b = by_words.encode(texts[k : k + 10]), whole.encode(texts[k : k + 10])
        assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def test_files_have_the_set_form_and_can_be_read_in_parts(spark, tmp_path):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choices(["stone", "River", "amber,", "lantern"], k=400))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    target = str(tmp_path / "ids")
    token_ids.write_token_ids(docs, target, WORDS, END, row_group=1 << 18, page=1 << 14, page_rows=100)

    groups = {"ids.list.element": set(), "doc_id": set(), "first": set()}
    n_groups = last = 0
    for path in sorted(glob(f"{target}/part-*.parquet")):
        meta = pq.ParquetFile(path).metadata
        n_groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            columns = [meta.row_group(g).column(c) for c in range(meta.num_columns)]
            for c in columns:
                assert c.has_offset_index
                if c.path_in_schema in groups:
                    groups[c.path_in_schema].update(c.encodings)
            low = next(c for c in columns if c.path_in_schema == "doc_id")
            assert low.has_column_index and low.statistics.min >= last
            last = low.statistics.max
    assert n_groups > 3
    assert "RLE_DICTIONARY" in groups["ids.list.element"] or "PLAIN_DICTIONARY" in groups["ids.list.element"]
    assert "DELTA_BINARY_PACKED" in groups["doc_id"] and "DELTA_BINARY_PACKED" in groups["first"]

    # Counts without ids, and some documents by a filter that reaches the files.
    counts = token_ids.read_placed(spark, target, with_ids=False)
    assert counts.columns == ["doc_id", "start", "n_tokens"]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.replace(target, "")
    some = token_ids.read_placed(spark, target).where("doc_id between 1000 and 1009")
    assert "GreaterThanOrEqual(doc_id,1000)" in some._jdf.queryExecution().executedPlan().toString()
    want = {i: (s, n) for i, s, n, _ in expected(rows, WORDS)}
    assert {r["doc_id"]: (r["start"], r["n_tokens"]) for r in some.collect()} == {
        i: want[i] for i in range(1000, 1010)
    }
    assert all(len(r["ids"]) == r["n_tokens"] and r["ids"][-1] == END for r in some.collect())


def test_no_documents(no_documents):
    assert token_ids.op11_round_trip(no_documents, WORDS, END).count() == 0
