from __future__ import annotations

import numpy as np
import pytest

from sluiceworks.llm.metric_join import choose_pivots, distance, near_vectors

KIND = "vec_id long, embedding array<double>, label int, n_links long, cell int, node string"


def plain_join(rows, least=0.93):
    """vec_id -> (n_links, component_id) by comparing all pairs."""
    sound = [
        (i, np.array(e, float) / np.max(np.abs(e)), label)
        for i, e, label in rows
        if label is not None and e and None not in e and np.isfinite(e).all() and any(e)
    ]
    unit = {i: (e / np.linalg.norm(e), label) for i, e, label in sound}
    links = {i: set() for i, _, _ in rows}
    for a, (x, one) in unit.items():
        for b, (y, other) in unit.items():
            if a != b and one == other and len(x) == len(y) and x @ y >= least:
                links[a].add(b)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            more = links[todo.pop()] - seen
            seen |= more
            todo += more
        out[i] = (len(links[i]), min(seen))
    return out


def joined(spark, rows, **options):
    filled = [(i, e, label, 7, 8, "x") for i, e, label in rows]
    found = near_vectors(spark.createDataFrame(filled, KIND), **options).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert len(found) == len({i for i, _, _ in rows})
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found}


def around(rng, centre, spread, n):
    x = centre + rng.normal(size=(n, len(centre))) * spread / np.sqrt(len(centre))
    return x * rng.uniform(0.1, 10, size=(n, 1))


def mixture(seed, width):
    """Background, tight groups, groups as wide as the radius, and chains."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(150, width))]
    for spread, n in ((0.01, 120), (0.1, 60), (0.25, 60), (0.3, 40), (0.4, 40)):
        centre = rng.normal(size=width)
        parts.append(around(rng, centre / np.linalg.norm(centre), spread, n))
    a, b = rng.normal(size=(2, width))
    b -= a * (a @ b) / (a @ a)
    b *= np.linalg.norm(a) / np.linalg.norm(b)
    t = np.linspace(0, 1.5, 12)[:, None]
    parts.append(a * np.cos(t) + b * np.sin(t))
    x = np.concatenate(parts)
    order = rng.permutation(len(x))
    labels = rng.choice([1, 1, 1, 2], len(x)).tolist()
    return [(int(3 * i + 1), x[k].tolist(), labels[i]) for i, k in enumerate(order)]


@pytest.mark.parametrize(
    ("width", "options"),
    [
        (8, {}),
        (3, {"cell_rows": 30, "block": 16}),
        (16, {"cell_rows": 20, "block": 16}),
        (64, {"cell_rows": 50, "block": 64, "sample": 100}),
        (8, {"sample": 3, "block": 32}),
        (8, {"sample": 0, "block": 50}),
        (8, {"pivots": 3, "cell_rows": 10, "block": 500}),
    ],
)
def test_equals_all_pairs(spark, width, options):
    rows = mixture(width, width)
    assert joined(spark, rows, **options) == plain_join(rows)


def test_other_threshold_and_negative_ids(spark):
    rows = [(-i, e, label) for i, e, label in mixture(5, 6)]
    assert joined(spark, rows, least=0.6, cell_rows=25, block=20) == plain_join(rows, 0.6)


def test_a_third_of_all_rows_in_one_group(spark):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=32)
    group = around(rng, centre / np.linalg.norm(centre), 0.12, 1500).tolist()
    copies = [rng.normal(size=32).tolist()] * 800
    rows = [(i, e, 1) for i, e in enumerate(group + copies + rng.normal(size=(2000, 32)).tolist())]
    found = joined(spark, rows, block=128)
    assert found == plain_join(rows)
    assert found[0] == (1499, 0) and found[1700] == (799, 1500)


def test_pivots_cover_dense_places():
    rng = np.random.default_rng(4)
    x = np.concatenate([around(rng, c, 0.05, 50) for c in np.eye(10)[:4]] + [rng.normal(size=(100, 10))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pivots = choose_pivots(x, 1, 0.18)
    assert len(pivots) == 4
    assert (distance(x[:200] @ pivots.T).min(axis=1) < 0.18).all()


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 1), (2, [2.0, 4.0, 6.0], 1), (3, one, None), (4, one, 2), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 3.0], 1), (9, [1.0, nan, 3.0], 1), (10, [1.0, inf, 3.0], 1),
        (11, [1e200, 2e200, 3e200], 1), (12, [1e-200, 2e-200, 3e-200], 1), (13, [1.0, 2.0], 1),
        (14, [2.0, 4.0], 1), (2**62, [-1.0, -2.0, -3.0], 1),
    ]
    found = joined(spark, rows)
    assert found == plain_join(rows)
    assert found[1] == (3, 1) and found[14] == (1, 13)


def test_rows_that_share_an_id_and_rows_without(spark):
    rows = [(1, [1.0, 0.0], 2), (1, [0.0, 1.0], 1), (2, [0.0, 2.0], 1), (3, [1.0, 0.0], 2), (None, [0.0, 1.0], 1)]
    filled = [(i, e, label, 7, 8, "x") for i, e, label in [*rows, rows[0], rows[-1]]]
    found = near_vectors(spark.createDataFrame(filled, KIND)).collect()
    key = lambda r: (r is None, r or 0)
    assert sorted([tuple(r) for r in found], key=lambda r: key(r[0])) == [
        (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (None, 0, None, True), (None, 0, None, True)
    ]


def test_nothing_and_floats(spark):
    assert near_vectors(spark.createDataFrame([], KIND)).count() == 0
    floats = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted(tuple(r) for r in near_vectors(floats).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]
    with pytest.raises(ValueError):
        near_vectors(floats, least=1.5)
