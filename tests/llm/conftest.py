from __future__ import annotations

import random

import pytest

WORDS = "the of and to in river stone amber quiet lantern meadow copper thistle harbor willow".split()


def prose(seed: int, n: int) -> str:
    """Sentences of ``n`` words, the same for the same seed."""
    draw = random.Random(seed)
    out, left = [], n
    while left > 0:
        k = min(left, draw.randint(6, 12))
        out.append(" ".join(draw.choice(WORDS) + str(draw.randint(0, 40)) for _ in range(k)) + ".")
        left -= k
    return "\n".join(out)


# Columns whose names the operators use themselves.
CLASHING = "row string, report string, tokens long, shard int, leaks int, node string, row_key long"


@pytest.fixture(scope="session")
def texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and long texts, repeated rows, copies and near copies."""
    base = prose(1, 120)
    near = base.replace(base.split()[40], "changed", 1)
    return [
        (1, base),
        (2, near),
        (3, base),
        (4, prose(2, 80)),
        (5, ""),
        (6, None),
        (None, base),
        (None, None),
        (7, prose(3, 30) + "\n" + "\n".join(base.split("\n")[2:6])),
        (7, prose(3, 30) + "\n" + "\n".join(base.split("\n")[2:6])),
        (8, "one two"),
        (9, " \t\n\x0b "),
        (10, prose(4, 30_000)),
        (11, "naïve ünïcode 漢字 text " * 20),
        (12, "same words here " * 40),
    ]


@pytest.fixture(scope="session")
def documents(spark, texts):
    """The texts as a documents table with columns that clash."""
    rows = [
        (i, t, None if k % 5 == 0 else "en", f"src{k % 3}", len(t or ""), "r", "p", 1, 2, 3, "n", 4)
        for k, (i, t) in enumerate(texts)
    ]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, f"{columns}, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.where("false")
