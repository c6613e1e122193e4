"""Each operator against a plain statement of what must come out."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postroom.llm import (
    decontamination,
    licences,
    line_quality,
    mixing,
    near_copies,
    personal_data,
    sharding,
    substrings,
    tagger,
    token_counts,
    toxicity,
)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- sharding -----------------------------------------------------------------


def test_shards_are_contiguous_equal_and_gapless(spark):
    draw = random.Random(1)
    docs = [(k, "é" * draw.randint(0, 300)) for k in range(400)] + [(5, "twice"), (5, "twice"), (None, None)]
    got = sharding.assign_shards(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), 7)
    got = sorted(got.collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(len(docs)))
    assert [r["doc_id"] if r["doc_id"] is not None else -1 for r in got] == sorted(
        -1 if i is None else i for i, _ in docs
    )
    sizes = [len((t or "").encode()) + 8 for _, t in docs]
    assert sorted(r["size"] for r in got) == sorted(sizes)
    before, total, seen = 0, sum(sizes), Counter()
    for r in got:
        assert r["shard"] == (2 * before + r["size"]) * 7 // (2 * total)
        assert r["slot"] == seen[r["shard"]]
        seen[r["shard"]] += 1
        before += r["size"]
    assert {r["text_crc32"] for r in got} == {zlib.crc32((t or "").encode()) for _, t in docs}


def test_shards_edges(documents, no_documents, texts, tmp_path):
    assert sharding.assign_shards(no_documents).count() == 0
    assert sharding.assign_shards(documents, 100).count() == len(texts)
    sharding.write_shards(documents, str(tmp_path / "shards"), 3)
    back = documents.sparkSession.read.parquet(str(tmp_path / "shards"))
    assert rows(back.select("row.*"), "doc_id", "text") == sorted(texts, key=repr)


# --- token counts -------------------------------------------------------------


def test_token_counts_equal_the_library(documents, no_documents, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = rows(token_counts.op9_counts(documents, path), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = []
    for i, t in texts:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want, key=repr)
    assert token_counts.op9_counts(no_documents, path).count() == 0


def test_token_counts_of_odd_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, draw = Tokenizer.from_file(path), random.Random(3)
    counter = token_counts.Counter(token_counts.read_vocabulary(path))
    alphabet = [*"abAB  \n\t\x0b\x1c\x85\xa0'sdtmlrev019é́İΣσ!#$👍漢٣Ⅷᾳﬁ<|>", "<|startoftext|>", "'S", "aaaa"]
    for _ in range(3000):
        s = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40)))
        assert counter.count([s.encode()]) == [len(library.encode(s, add_special_tokens=False).ids)], s


# --- quality ------------------------------------------------------------------


def test_line_rules():
    def fault(line, again=False):
        return line_quality.line_fault(line.encode(), line.encode().split(), again)

    assert fault("A sentence that ends.") is None
    assert fault("Home | About | News | Contact") == "navigation"
    assert fault("buy### now$$$ cheap%%%") == "symbols"
    assert fault("BUY!! NOW!! CHEAP!! OK.") == "shouting"
    assert fault("a heading without an end") == "punctuation"
    assert fault("He came. " + "word " * 20) is None
    assert fault("Please read our Privacy Policy.") == "boilerplate"
    assert fault("A line.", again=True) == "boilerplate"


def test_repeat_words_by_counting():
    draw = random.Random(2)
    for _ in range(200):
        ids = [draw.randint(0, 3) for _ in range(draw.randint(0, 30))]
        windows = Counter(tuple(ids[k : k + 3]) for k in range(len(ids) - 2))
        hit = {k + j for k in range(len(ids) - 2) if windows[tuple(ids[k : k + 3])] > 1 for j in range(3)}
        for n_ids in (4, 1 << 22):
            assert line_quality.repeat_words(np.array(ids, np.int64), n_ids) == len(hit)


def test_quality_edges(documents, no_documents, texts):
    got = line_quality.clean_lines(documents)
    assert got.count() == len(texts)
    assert got.where("row.row = 'r' AND row.report = 'p'").count() == len(texts)
    assert got.where("row.doc_id IN (5, 6, 9) AND report.kept").count() == 0
    assert got.where("row.doc_id = 4 AND report.kept").count() == 1
    assert line_quality.clean_lines(no_documents).count() == 0


# --- mixing -------------------------------------------------------------------


def test_raking_reaches_the_targets(spark):
    draw = random.Random(5)
    cells = [(s, g, t, draw.randint(1, 500)) for s in "ab" for g in ("x", None) for t in "uvw"]
    targets = {"source": {"a": 1, "b": 3}, "lang": {"x": 1, None: 1}, "topic": {"u": 1, "v": 1, "w": 2}}
    table = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    got = mixing.rake(table, targets, rounds=30, keep=0.3).collect()
    for axis, want in targets.items():
        for value, part in want.items():
            share = sum(r["raked"] for r in got if r[axis] == value)
            assert math.isclose(share, part / sum(want.values()), rel_tol=1e-6)
    kept = sum(r["tokens"] * r["probability"] for r in got)
    assert math.isclose(kept, 0.3 * sum(c[3] for c in cells), rel_tol=1e-3)


def test_mixing_edges(documents, no_documents, texts):
    got = mixing.sample(documents)
    assert got.count() == len(texts)
    assert got.where("tokens = 0 AND row.doc_id = 5").count() == 1
    twice = {r["kept"] for r in got.where("row.doc_id = 7").collect()}
    assert len(twice) == 1
    assert mixing.sample(no_documents).count() == 0
    only = mixing.sample(documents, {"source": {"src1": 1}}).where("kept").select("row.source").distinct()
    assert [r[0] for r in only.collect()] in ([], ["src1"])


# --- substrings ---------------------------------------------------------------


def cut_repeats(docs, length):
    """doc_id, words, removed, hash: by looking at every run of words."""
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - length + 1):
            if i is not None:
                g = tuple(w[k : k + length])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = set()
        for k in range(len(w) - length + 1):
            if i is not None and first[tuple(w[k : k + length])] < i:
                gone |= set(range(k, k + length))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_repeats_by_every_run(spark, documents, no_documents, texts):
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows(substrings.op7_repeats(documents), *columns) == cut_repeats(texts, 13)
    assert substrings.op7_repeats(no_documents).count() == 0
    # A tiny vocabulary: seeds agree by chance and runs overlap in many ways.
    draw = random.Random(8)
    small = [(k % 40, " ".join(draw.choice("ab") for _ in range(draw.randint(0, 60)))) for k in range(60)]
    got = substrings.op7_repeats(spark.createDataFrame(small, "doc_id long, text string"))
    assert rows(got, *columns) == cut_repeats(small, 13)


# --- near copies --------------------------------------------------------------


def link_all(docs):
    """doc_id, class_id, n_links for each row, by comparing all pairs."""
    sets = []
    for _, t in docs:
        w = words(t)
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    links = defaultdict(set)
    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and docs[a][0] is not None and docs[b][0] is not None:
                if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for a, (i, _) in enumerate(docs):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        out.append((i, None if i is None else min(docs[b][0] for b in seen), len(links[a])))
    return sorted(out, key=repr)


def near_family(seed, n):
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 999)}" for _ in range(60)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(draw.randint(0, 3)):
            w[draw.randrange(60)] = f"x{draw.randint(0, 99)}"
        out.append((1000 * seed + k, " ".join(w)))
    return out


def test_links_by_all_pairs(spark, documents, no_documents, texts, monkeypatch):
    columns = ("doc_id", "class_id", "n_links")
    assert rows(near_copies.op8_links(documents), *columns) == link_all(texts)
    assert near_copies.op8_links(no_documents).count() == 0
    family = near_family(1, 40) + near_family(2, 25) + [(5, "a b c"), (6, "a b c"), (7, "a b d")]
    docs = spark.createDataFrame(family, "doc_id long, text string")
    assert rows(near_copies.op8_links(docs), *columns) == link_all(family)
    monkeypatch.setattr(near_copies, "BLOCK_GRAMS", 300)  # components in several blocks
    assert rows(near_copies.op8_links(docs), *columns) == link_all(family)


def test_keep_one(documents, texts):
    kept = near_copies.keep_one(documents)
    assert kept.columns == documents.columns
    classes = {i: c for i, c, _ in link_all(texts) if i is not None}
    want = sorted(i for i, c in classes.items() if i == c)
    got = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert got == want
    assert kept.where("doc_id IS NULL").count() == 2


def test_band_plan_meets_the_recall():
    rows_, bands = near_copies.band_plan(0.8, 0.99999)
    assert 1 - (1 - 0.8**rows_) ** bands >= 0.99999 and rows_ * bands <= near_copies.MAX_HASHES


# --- decontamination ----------------------------------------------------------


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            last, row[k + 1] = row[k + 1], last + 1 if x == y else max(row[k + 1], row[k])
    return row[-1]


def test_common_length_by_table():
    draw = random.Random(4)
    for _ in range(300):
        a = [draw.choice("abcd") for _ in range(draw.randint(1, 20))]
        b = [draw.choice("abcde") for _ in range(draw.randint(0, 25))]
        masks = {}
        for k, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << k
        assert decontamination.common_length(masks, b) == subsequence(a, b)


def test_leaks_plain_and_paraphrased(spark, documents, no_documents):
    def item(seed):
        return " ".join(f"q{(7 * seed + k * k) % 311}" for k in range(30))

    draw, docs = random.Random(6), []
    fillers = [" ".join(f"v{draw.randint(0, 2000)}" for _ in range(150)) for _ in range(60)]
    for k, filler in enumerate(fillers):
        w = filler.split()
        if k < 10:
            w[40:40] = item(k).upper().split()  # as it is, but for case
        elif k < 20:
            p = item(k - 10).split()
            for at in (3, 11, 19):
                p[at] = f"v{at}"  # reworded
            w[100:100] = p
        docs.append((k, " ".join(w)))
    items = [(k, item(k)) for k in range(12)] + [(12, None), (None, ""), (13, "...")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows(decontamination.op1_leaks(table, benchmark), "doc_id", "item_id")
    assert got == sorted([(k, k % 10) for k in range(20)], key=repr)
    assert decontamination.op1_leaks(no_documents, benchmark).count() == 0
    assert decontamination.op1_leaks(table, benchmark.where("false")).count() == 0
    marked = decontamination.mark_leaks(documents, benchmark)
    assert marked.where("row.leaks = 3 AND size(leaks) = 0").count() == documents.count()


# --- personal data ------------------------------------------------------------


def plain_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = [
        (m.start(), m.end(), kind)
        for kind, p in patterns.items()
        for m in re.finditer(p, text)
        if personal_data.valid(kind, m[0])
    ]
    return sorted(out, key=lambda s: (s[0], list(patterns).index(s[2])))


def test_base_spans_by_plain_patterns():
    draw = random.Random(1)
    for _ in range(20_000):
        t = "".join(draw.choice("ab0123456789..@@+- ()_,é\n") for _ in range(draw.randint(0, 45)))
        assert personal_data.base_spans(t) == plain_spans(t), t


def test_base_spans_of_long_runs():
    for t in ("a" * 300_000, "1" * 300_000, "a." * 100_000 + "@", "+1" + "(" * 200_000):
        personal_data.base_spans(t)


def test_tagger_gradient():
    draw = np.random.default_rng(0)
    p = tagger.start_params(5, 3)
    chars, labels = draw.integers(0, 101, (6, 4)), draw.integers(0, 5, (6, 4))
    _, grad = tagger.loss_and_gradient(p, chars, labels)
    for name, value in p.items():
        at = tuple(int(draw.integers(0, n)) for n in value.shape)
        if name[0] == "x":
            at = (int(chars[2, 1]), at[1])
        ends = []
        for step in (1e-5, -1e-5):
            moved = {**p, name: value.copy()}
            moved[name][at] += step
            ends.append(tagger.loss_and_gradient(moved, chars, labels)[0])
        assert math.isclose(grad[name][at], (ends[0] - ends[1]) / 2e-5, rel_tol=1e-4, abs_tol=1e-8)


def test_personal_data(spark, documents, no_documents, texts):
    draw, docs = random.Random(12), []
    for k in range(220):
        filler = " ".join(f"word{chr(97 + draw.randint(0, 25))}" for _ in range(30))
        phone = f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}"
        mail = f"jo{draw.randint(10, 99)}@mail{draw.randint(0, 9)}.example.org"
        ip = ".".join(str(draw.randint(0, 255)) for _ in range(4))
        docs.append((k, f"{filler} {(phone, mail, ip)[k % 3]} {filler}"))
    bare = " ".join(["words"] * 30) + " (614) 555-8001 " + " ".join(["words"] * 30)
    docs += [(1000, bare), (1001, "version 2.0 of 12 things in 1999"), (1002, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in personal_data.op5_spans(table).collect()}
    for k, t in docs:
        base = plain_spans(t or "")
        joined = ",".join(f"{kind}:{a}:{b}" for a, b, kind in base)
        assert got[k]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(got[k]["spans"].split(","))
    # Held out in shape: the base rules need a plus sign.
    at = bare.index("(614)")
    assert got[1000]["spans"] == f"phone:{at}:{at + 14}"
    assert got[1001]["spans"] == "" and got[1002]["spans"] == ""
    assert personal_data.op5_spans(documents).count() == len(texts)
    assert personal_data.op5_spans(no_documents).count() == 0


# --- toxicity -----------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark, documents, no_documents, texts):
    draw, docs, labels = random.Random(9), [], []
    for k in range(900):
        w = [f"w{draw.randint(0, 300)}" for _ in range(60)]
        bad = k % 6 == 0
        if bad:
            for _ in range(4):
                w[draw.randrange(60)] = draw.choice(["vile", "rotten", "nasty"])
        docs.append((k, " ".join(w)))
        labels.append((k, int(bad)))
    docs.append((900, None))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(1, None), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.op6_ftrl(table, marks).collect()}
    assert len(got) == len(docs)
    for k, label in labels:
        assert got[k]["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1)
    held = [(got[k]["predicted"], label) for k, label in labels if got[k]["held_out"]]
    toxic = [p for p, label in held if label]
    assert sum(toxic) >= 0.9 * len(toxic)
    assert sum(p for p, label in held if not label) <= 0.02 * len(held)
    assert 0 <= got[900]["score"] < 0.7
    unlabelled = toxicity.op6_ftrl(documents, marks.where("false"))
    assert {r["score"] for r in unlabelled.collect()} == {0.0}
    assert unlabelled.count() == len(texts) and toxicity.op6_ftrl(no_documents, marks).count() == 0


# --- licences -----------------------------------------------------------------


def test_licences_and_inheritance(spark, documents, no_documents, texts):
    files = [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/b/code", "no licence here."),
        ("a/b/c/COPYING", "Licensed under the Apache License, Version 2.0."),
        ("a/b/c/d/code", "nothing"),
        ("a/b/c/own", "Some text. All rights reserved. More text."),
        ("z/code", "nothing"),
        ("a/b/long", "Licensed under CC BY-NC 4.0. " + "word " * 100),
        (None, "nothing"),
        ("root", None),
    ]
    table = spark.createDataFrame(files, "path string, text string")
    got = {r["path"]: r for r in licences.scan_licences(table, F.col("path")).collect()}
    want = {
        "a/LICENSE": ("MIT", "own"),
        "a/b/code": ("MIT", "directory"),
        "a/b/c/COPYING": ("Apache-2.0", "own"),
        "a/b/c/d/code": ("Apache-2.0", "directory"),
        "a/b/c/own": ("Proprietary", "own"),
        "z/code": (None, None),
        "a/b/long": ("CC-BY-NC-4.0", "own"),
        None: (None, None),
        "root": (None, None),
    }
    assert {p: (r["licence"], r["origin"]) for p, r in got.items()} == want
    assert got["a/b/code"]["from_dir"] == "a"
    assert licences.op10_licence_scan(documents).count() == len(texts)
    assert licences.op10_licence_scan(no_documents).count() == 0
