from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluiceworks.llm.periodic_runs import COVER, SHIFT, V, Extensions, find_runs, runs_of
from tests.llm.conftest import frame


def codes(words) -> np.ndarray:
    return np.array(words, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)


def plain_runs(words, least=6, exponent=4):
    """(start, period, length) by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, exponent * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, q, e - s) for (s, e), q in found.items())


def test_cover_synchronises_any_two_places():
    for a in range(V):
        for b in range(V):
            d = SHIFT[a, b]
            assert d < V and (a + d) % V in COVER and (b + d) % V in COVER


def test_extensions_equal_plain_comparison():
    rng = random.Random(5)
    words = [rng.randrange(2) for _ in range(40)] * 5 + [rng.randrange(3) for _ in range(100)]
    ext = Extensions(codes(words))
    n = len(words)
    i, j = (x.ravel() for x in np.indices((n, n)))
    i, j = i[i < j], j[i < j]
    near, open_ = ext.near(i, j)
    far = np.zeros(len(i), np.int64)
    far[open_] = ext.beyond((i + near)[open_], (j + near)[open_])
    for a, b, length in zip(i.tolist(), j.tolist(), (near + far).tolist(), strict=True):
        k = 0
        while b + k < n and words[a + k] == words[b + k]:
            k += 1
        assert k == length


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(0, 2), max_size=30),
    st.lists(st.integers(0, 3), min_size=1, max_size=12),
    st.integers(0, 8),
    st.lists(st.integers(0, 2), max_size=30),
)
def test_runs_equal_brute_force(before, period, times, after):
    words = before + period * times + after
    assert [tuple(r) for r in runs_of(codes(words)).tolist()] == plain_runs(words)


@pytest.mark.parametrize(("least", "exponent"), [(2, 2), (9, 3), (40, 5)])
def test_other_bounds(least, exponent):
    rng = random.Random(least)
    for _ in range(100):
        words = [rng.randrange(2) for _ in range(rng.randrange(80))] * rng.choice((1, 1, 6))
        got = [tuple(r) for r in runs_of(codes(words), least, exponent).tolist()]
        assert got == plain_runs(words, least, exponent)


def test_a_very_long_text(spark):
    text = "is " * 200_000 + "a b c " * 70_000 + "end"
    row = find_runs(frame(spark, [(1, text)])).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 200_000, 1), (200_000, 210_000, 3)]
    assert row["n_words"] == 410_001 and row["text"] == "is a b c end"


def test_edge_rows(spark, edge, nothing):
    rows = find_runs(edge).collect()
    source = edge.select("doc_id", "text").collect()
    assert len(rows) == len(source)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = [(d, len((t or "").split()), " ".join((t or "").split())) for d, t in source]
    assert sorted(((r["doc_id"], r["n_words"], r["text"]) for r in rows), key=key) == sorted(expected, key=key)
    assert all(r["runs"] == [] for r in rows)
    assert find_runs(nothing).count() == 0


def test_text_without_repeats(spark):
    text = "x\n one two\tone two one  two one two one\ny z z z z z z"
    row = find_runs(frame(spark, [(1, text), (1, text)])).collect()
    assert [[tuple(r) for r in x["runs"]] for x in row] == [[(1, 9, 2), (11, 6, 1)]] * 2
    assert {x["text"] for x in row} == {"x one two y z"}
