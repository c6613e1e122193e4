"""Components that are dealt to more blocks than have nodes."""

from __future__ import annotations

from postroom.llm import near_copies


def test_links_of_a_pair_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK_GRAMS", 20)
    docs = []
    for k in range(8):  # pairs of near copies, about eight blocks each
        w = [f"w{k}_{i}" for i in range(84)]
        docs += [(2 * k, " ".join(w)), (2 * k + 1, " ".join([*w[:-1], "changed"]))]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = near_copies.op8_links(table).collect()
    assert len(got) == 16 and {r["n_links"] for r in got} == {1}
    assert all(r["class_id"] == r["doc_id"] // 2 * 2 for r in got)
