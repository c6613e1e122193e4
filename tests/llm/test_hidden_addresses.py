"""Addresses without digit or @, and spans that are cut by a window's edge."""

from __future__ import annotations

import numpy as np
import pytest

from postroom.llm import personal_data as p


@pytest.fixture
def perfect(monkeypatch):
    """A tagger that knows the given words."""

    def know(*words):
        rows = [np.array(p.tagger.encode(w)) for w in words]

        def decode(model, chars):
            out = np.zeros(chars.shape, np.int64)
            for n, window in enumerate(chars.T):
                for w in rows:
                    for at in range(-len(w) + 1, len(window)):
                        a, b = max(at, 0), min(at + len(w), len(window))
                        if b - a > 3 and (window[a:b] == w[a - at : b - at]).all():
                            out[a:b, n] = 2
                            if at >= 0:
                                out[at, n] = 1
            return out

        monkeypatch.setattr(p.tagger, "decode", decode)

    return know


@pytest.mark.parametrize("way", [" at ", "(at)", " AT "])
def test_addresses_without_digit_or_sign(perfect, way):
    hidden = f"jane.doe{way}example.org"
    perfect(hidden)
    for n in range(0, 100, 7):
        text = "x" * n + " write to " + hidden + " soon " + "y" * 300
        a = text.index(hidden)
        assert p.add_spans([text], [[]], {}) == [[(a, a + len(hidden), "email")]]


def test_spans_over_a_window_edge(perfect):
    long = "".join(chr(97 + k * k * 7 % 23 % 26) + chr(97 + k) for k in range(26))
    hidden = f"{long} at {long[::-1]}.example.org"  # over a window
    perfect(hidden)
    for n in range(0, 100, 7):
        text = "x" * n + " " + hidden + " " + "y" * 300
        assert p.add_spans([text], [[]], {}) == [[(n + 1, n + 1 + len(hidden), "email")]]


def test_plain_prose_is_not_run(perfect, monkeypatch):
    monkeypatch.setattr(p.tagger, "decode", None)
    text = "We met at home. Then we sat at the table, at last."
    assert p.add_spans([text], [[]], {}) == [[]]
