"""Token pairs of two tokenizers against a plain statement over whole texts."""

from __future__ import annotations

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from postroom.llm import alignment, pair_bitmaps
from postroom.llm.token_counts import _byte_letters

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()

ODD = [*"abcXYZ   ,.;'!?\n\t\x0b　é漢字١²´`_-<|>01▁\x1c\x00​😀", "<|endoftext|>", "<s>", "<0x0A>", "  ", " the"]


def odd_texts(n, seed=3):
    draw = random.Random(seed)
    return ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 30))) for _ in range(n)]


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    value = {c: bytes([i]) for i, c in enumerate(_byte_letters())}

    def tokens_a(text):
        return [
            (i, b"".join(value[c] for c in a.id_to_token(i)))
            for i in a.encode(" " + text, add_special_tokens=False).ids
        ]

    def tokens_b(text):
        return [
            (i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
            for i in b.encode(text)
            for p in [b.id_to_piece(i)]
        ]

    found, count = [], Counter()
    for doc, text in rows:
        raw = (" " + (text or "")).encode()
        x, y = (tokens_a(text), tokens_b(text)) if text else ([], [])
        if any(b"".join(t for _, t in z) != raw for z in (x, y)):
            x = y = []
        x, y = spans(x), spans(y)
        cuts = sorted({e for _, _, e in x} & {e for _, _, e in y})
        links, low = [], 0
        for i, start, end in x:
            while low < len(y) and y[low][2] <= start:
                low += 1
            at = low
            while at < len(y) and y[at][1] < end:
                links.append((i, y[at][0]))
                at += 1
        sides = []
        for z in (x, y):
            parts = [[] for _ in cuts]
            for i, _, end in z:
                parts[bisect.bisect_left(cuts, end)].append(str(i))
            sides.append([",".join(p) for p in parts])
        groups = [f"{p}|{q}" for p, q in zip(*sides)]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        count.update(links)
        found.append((doc, len(x), len(y), len(cuts), links, digest))
    highest = {}
    for (_, j), n in count.items():
        highest[j] = max(highest.get(j, 0), n)
    return sorted(
        (
            (doc, *counts, len(links), sum(count[p] == highest[p[1]] for p in links), sum(count[p] for p in links), digest)
            for doc, *counts, links, digest in found
        ),
        key=repr,
    )


def result(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def test_documents(documents, texts):
    assert result(alignment.op13_alignment(documents, A, B)) == plain(texts)


@pytest.mark.parametrize("links", [40, alignment.BLOCK_LINKS])
def test_odd_texts_in_blocks_of_any_size(spark, links, monkeypatch):
    # Workers are forked and don't see the patch, so the bound is also tried here.
    monkeypatch.setattr(alignment, "BLOCK_LINKS", links)
    rows = list(enumerate(odd_texts(1200)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(alignment.op13_alignment(docs, A, B)) == plain(rows)


def test_chunks_give_what_whole_texts_give(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_PARTS", 60)
    one = alignment.Aligner(A, B)
    texts = odd_texts(2000, 8)
    for k in range(0, 2000, 25):
        got = one.texts(texts[k : k + 25])
        _, want = one.both(texts[k : k + 25])
        for name in ("n_a", "n_b", "n_groups", "n_links", "links", "groups"):
            assert np.array_equal(getattr(got, name), getattr(want, name)), name


def test_sets_hold_every_posting():
    draw = np.random.default_rng(4)
    for n_slots, n in ((1, 1), (50, 300), (3000, 20_000)):
        pair = draw.integers(0, 12, n) ** 3
        slot = draw.integers(0, n_slots, n)
        key = np.unique(pair << 32 | slot)
        pair, slot = key >> 32, key & 0xFFFFFFFF
        times = draw.integers(1, 40, len(key))
        sets = pair_bitmaps.build(pair, slot, times, n_slots)
        number, slots = pair_bitmaps.members(sets)
        back = Counter()
        for i, s in zip(number.tolist(), slots.tolist()):
            back[int(sets.pair[i]), s] += 1 << int(sets.plane[i])
        assert back == dict(zip(zip(pair.tolist(), slot.tolist()), times.tolist()))
        found = list(zip(*(c.tolist() for c in pair_bitmaps.totals(sets))))
        assert found == [
            (p, int((pair == p).sum()), int(times[pair == p].sum())) for p in np.unique(pair).tolist()
        ]
        # A set that holds most slots is a bitmap, a rare one is a list.
        assert len(sets.data) <= sum(min(2 * int(k), sets.width) for k in sets.size)
        known = np.unique(pair)
        (sums,) = pair_bitmaps.spread(sets, known, [known + 1])
        want = np.zeros(n_slots, np.int64)
        np.add.at(want, slot, times * (pair + 1))
        assert sums.tolist() == want.tolist()


def test_counts_of_pairs(spark, documents, texts):
    counts = alignment.pair_counts(alignment.index(documents, A, B))
    rows = counts.collect()
    docs = sum(r["docs"] for r in rows)
    assert sum(r["links"] for r in rows) == sum(r[4] for r in plain(texts)) and docs < sum(
        r["links"] for r in rows
    )
    assert {r["b"] for r in rows} == {r["b"] for r in rows if r["best"]}


def test_no_documents(no_documents):
    assert alignment.op13_alignment(no_documents, A, B).count() == 0
