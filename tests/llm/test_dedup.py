from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sluiceworks.llm import near_dedup, queries, substring_dedup
from sluiceworks.llm.arrow_words import WordReader, sliding_min
from sluiceworks.llm.near_dedup import BINS, confirm, near_duplicates, sketch, walks
from sluiceworks.llm.substring_dedup import occurrences, remove_repeats, without
from tests.llm.conftest import LONG, SF, TEXTS, frame, words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def cut(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- words ------------------------------------------------------------------------------


def test_words_of_a_column():
    texts = ["a b  c", "", None, "\n x\ty z", "a b c", "é文 a", LONG]
    found = []
    for size in (4, 1 << 20):
        reader = WordReader(chunk_bytes=size)
        hashes = {}
        for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["-", *texts])[1:]):
            seen = []
            for chunk in reader.chunks(column):
                for a, b in zip(chunk.bounds[:-1], chunk.bounds[1:], strict=True):
                    own = [chunk.data[x:y].tobytes().decode() for x, y in zip(chunk.starts[a:b], chunk.ends[a:b])]
                    seen.append(own)
                    for w, h in zip(own, chunk.hashes[a:b].tolist(), strict=True):
                        assert hashes.setdefault(w, h) == h
            assert seen == [cut(t) for t in texts]
        assert len(set(hashes.values())) == len(hashes)
        found.append(hashes)
    assert found[0] == found[1]


def test_sliding_min():
    x = np.random.default_rng(1).integers(0, 99, 40)
    for width in (1, 2, 3, 9, 40, 50):
        assert sliding_min(x, width).tolist() == [min(x[i : i + width]) for i in range(40)]


# ---- near duplicates --------------------------------------------------------------------


def expected_components(rows, k=5, percent=85):
    """(doc_id, shingles, component) by comparing all pairs that share a shingle."""
    sets = []
    for d, t in rows:
        w = cut((t or "").translate(LOWER))
        grams = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets.append((d, grams))
    parent = {d: d for d, _ in sets if d is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, (d, s) in enumerate(sets):
        if d is None:
            continue
        common = Counter(j for g in s for j in holders[g])
        for g in s:
            holders[g].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = sorted((top(d), top(sets[j][0])))
                parent[b] = a
    return sorted(
        ((d, len(s), top(d) if d is not None else None) for d, s in sets), key=repr
    )


def found_components(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def test_near_duplicates_of_the_table(spark, documents):
    found = queries.op7_minhash_near_dedup(spark, SF)
    assert found_components(found) == expected_components(documents.items())
    assert found.where("kept <> (doc_id = component_id)").isEmpty()


def test_near_duplicates_edge_cases(spark, edge, nothing):
    found = near_duplicates(edge)
    assert found_components(found) == expected_components(TEXTS)
    assert found.where("doc_id IS NULL AND NOT kept").isEmpty()
    assert near_duplicates(nothing).count() == 0


def test_a_group_whose_first_member_is_a_poor_centre(spark):
    """Variants of one text: most are near the original, few near each other."""
    base = words(150, 7).split()
    rows = [(1000, " ".join(base))]
    for v in range(60):
        own = list(base)
        for e in range(1 + v % 4):
            own[(37 * v + 29 * e) % 150] = f"new{v}x{e}"
        rows.append((v, " ".join(own)))
    rows += [(2000 + i, rows[i][1]) for i in range(40)]
    found = near_duplicates(frame(spark, rows))
    assert found_components(found) == expected_components(rows)
    assert 1 < len({c for _, _, c in found_components(found)}) < 61


def test_components_go_on_from_the_stars_found_before(spark, monkeypatch):
    calls, components = [], near_dedup.components

    def spy(spark, links):
        out = components(spark, links)
        calls.append(({tuple(r) for r in links.collect()}, {tuple(r) for r in out.collect()}))
        return out

    monkeypatch.setattr(near_dedup, "components", spy)
    # one bucket for all, whose first member is a centre only for its own group
    monkeypatch.setattr(near_dedup, "band_keys", lambda value: np.ones(1, dtype=np.uint64))
    rows = [(100 * g + i, f"{words(150, g)} end{i}") for g in range(4) for i in range(3)]
    assert found_components(near_duplicates(frame(spark, rows))) == expected_components(rows)
    assert len(calls) > 1
    for (_, known), (links, _) in zip(calls, calls[1:]):
        assert {(component, node) for node, component in known} <= links


def test_components_of_repeated_links(spark):
    links = [(1, 2), (2, 1), (1, 2), (3, 3), (2, 7), (5, 4), (4, 9), (9, 8)]
    found = near_dedup.components(spark, spark.createDataFrame(links, "centre long, member long"))
    want = [(1, 1), (2, 1), (4, 4), (5, 4), (7, 1), (8, 4), (9, 4)]
    assert sorted(tuple(r) for r in found.collect()) == want


def test_hot_centre_is_split(spark, monkeypatch):
    monkeypatch.setattr("sluiceworks.llm.near_dedup.MEMBERS_PER_TASK", 5)
    sets = spark.createDataFrame(
        [(i, np.arange(20 + (i % 3 == 0), dtype=np.int64).tobytes()) for i in range(40)], "doc_id long, words binary"
    )
    edges = spark.range(1, 40).selectExpr("0L AS centre", "id AS member")
    assert sorted(r["member"] for r in confirm(sets, edges, 100).collect()) == [i for i in range(1, 40) if i % 3 == 0]


def test_densified_bins_agree_with_similarity():
    rng, walk = np.random.default_rng(3), walks()
    for size in (1, 6, 40, 1000):
        shared = []
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) << np.uint64(1))
            b = np.unique(np.append(a[: int(size * 0.9) or 1], rng.integers(0, 1 << 63, size // 10, dtype=np.uint64)))
            want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            shared.append((sketch(a, walk) == sketch(b, walk)).mean() - want)
        assert len(sketch(a, walk)) == BINS and abs(np.mean(shared)) < 0.06


# ---- substring dedup --------------------------------------------------------------------


def expected_rest(rows, n=13):
    first = {}
    for d, t in rows:
        w = cut(t)
        for i in range(len(w) - n + 1):
            if d is not None:
                key = tuple(w[i : i + n])
                first[key] = min(d, first.get(key, d))
    out = []
    for d, t in rows:
        w = cut(t)
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if d is not None and first[tuple(w[i : i + n])] < d:
                gone[i : i + n] = [True] * n
        out.append((d, len(w), sum(gone), [x for x, g in zip(w, gone, strict=True) if not g]))
    return sorted(out, key=repr)


def found_rest(df, words="n_words_", removed="n_removed_"):
    return sorted(((r["doc_id"], r[words], r[removed], cut(r["text"])) for r in df.collect()), key=repr)


def test_repeats_of_the_table(spark, documents):
    found = queries.op3_substring_dedup(spark, SF).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found)
    want = expected_rest(documents.items())
    assert got == sorted(
        (d, n, g, hashlib.sha256(" ".join(w).encode()).hexdigest()) for d, n, g, w in want
    )


@pytest.mark.parametrize("most", [4096, 1])
def test_repeats_edge_cases(spark, edge, nothing, monkeypatch, most):
    """Also with every anchor taken for a crowded one."""
    monkeypatch.setattr(substring_dedup, "MOST_STRETCHES", most)
    shared = words(25, 9)
    rows = [*TEXTS, *[(100 + i, f"{words(14, 20 + i)} {shared} {words(9, 40 + i)}") for i in range(12)]]
    rows += [(90, "the " * 200), (91, "the " * 30 + words(20, 8))]
    found = remove_repeats(frame(spark, rows))
    assert found_rest(found) == expected_rest(rows)
    assert found.columns[-2:] == ["n_words_", "n_removed_"]
    assert found.where("text IS NULL").count() == 2
    assert remove_repeats(nothing).count() == 0


def test_small_windows(spark):
    rows = [(i, words(30, i % 4)) for i in range(8)] + [(9, words(30, 1)[20:])]
    found = remove_repeats(frame(spark, rows), n=5)
    assert found_rest(found) == expected_rest(rows, 5)
    with pytest.raises(ValueError):
        remove_repeats(frame(spark, rows), n=4)


def test_automaton_finds_parts_of_passages():
    shard = [(b"a b c d e", 1, 3), (b"x b c d y", 2, 2), (b"q q q", 5, 5), (b"c d e f", 4, 4)]
    assert occurrences(shard, 3) == [[1, 1, 1], [None, 1, None], [None], [1, None]]


def test_cutting_keeps_the_white_space_around():
    assert without(b" a  b\nc d ", [1], 2) == (b" a  d ", 2)
    assert without(b"a b", [0], 2) == (b"", 2)
    assert without("é a b c".encode(), [2], 2) == ("é a ".encode(), 2)
