from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluiceworks.llm import spelling_variants as sv
from tests.llm.conftest import frame


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts: dict[str, int], ratio: int = 5) -> dict[str, tuple]:
    """word -> (form, root, n, n_near, form_n) by comparing all words."""
    near = {w: [x for x in counts if len(w) >= 4 <= len(x) and one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def groups(spark, counts: dict[str, int], **options) -> dict[str, tuple]:
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = sv.group_variants(words, **options).collect()
    assert len(rows) == len(counts)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def edited(word: str, rng: random.Random, letters: str) -> str:
    i, kind = rng.randrange(len(word) + 1), rng.randrange(3)
    if kind == 0:
        return word[:i] + rng.choice(letters) + word[i:]
    return word[:i] + ("" if kind == 1 else rng.choice(letters)) + word[i + 1 :]


@settings(max_examples=300, deadline=None)
@given(st.text("abé", min_size=4, max_size=12), st.data())
def test_words_one_edit_apart_share_a_gram_of_their_prefixes(word, data):
    i = data.draw(st.integers(0, len(word)))
    kind = data.draw(st.sampled_from(["insert", "delete", "replace"]))
    letter = data.draw(st.sampled_from("abéz"))
    other = {
        "insert": word[:i] + letter + word[i:],
        "delete": word[:i] + word[i + 1 :],
        "replace": word[:i] + letter + word[i + 1 :],
    }[kind]
    if len(other) < 4 or not one_edit(word, other):
        return
    grams = data.draw(st.lists(st.text("abé\x02\x03", min_size=2, max_size=4), max_size=12))
    frequent = {g: data.draw(st.integers(1, 5)) for g in grams}
    short, long = sorted((word, other), key=len)
    grown = len(long) - len(short)
    there = set(sv.prefix(long, frequent))
    assert any((g, p) in there or (g, p + grown) in there for g, p in sv.prefix(short, frequent))


def test_bound_counts_the_grams_that_an_edit_affects():
    rng = random.Random(3)
    frequent = {"ab": 9, "ba": 8, "aba": 7, "\x02a": 5}
    for _ in range(500):
        word = "".join(rng.choice("ab") for _ in range(rng.randrange(4, 12)))
        grams, bound = sv.decompose(word, frequent)
        other = edited(word, rng, "abc")
        lost = Counter(g for g, _ in grams) - Counter(g for g, _ in sv.decompose(other, frequent)[0])
        assert sum(lost.values()) <= bound <= sv.LONGEST


@pytest.mark.parametrize("max_grams", [8, 1 << 17])
def test_groups_equal_brute_force(spark, max_grams):
    rng = random.Random(max_grams)
    counts: dict[str, int] = {}
    letters = "aeinrsté"
    for _ in range(120):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 10)))
        counts[word] = rng.choice((5, 30, 400, 3000))
        for _ in range(3):
            counts.setdefault(edited(word, rng, letters), rng.choice((5, 5, 20, 100)))
    assert groups(spark, counts, max_grams=max_grams) == plain_groups(counts)


def test_long_chains_and_ties(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625}
    counts |= {"xxxxxxa": 50, "xxxxxxb": 50, "xxxxxx": 10, "xxxxxxz": 11}
    found = groups(spark, counts)
    assert found == plain_groups(counts)
    assert found["aaaaaa"][1] == "abbbbb" and found["xxxxxx"][0] == "xxxxxxa" and found["xxxxxxz"][0] is None


def test_one_gram_that_a_third_of_all_words_have(spark):
    rng = random.Random(11)
    counts = {"zzzzzz" + "".join(rng.choice("abcdefgh") for _ in range(4)): 5 + k for k in range(300)}
    counts |= {"".join(rng.choice("mnopqrs") for _ in range(8)): 7 for _ in range(600)}
    assert groups(spark, counts) == plain_groups(counts)


def test_edge_words(spark):
    rows = [("", 3), ("a", 9), ("ab", 9), ("abc", 100), ("abcd", 5), ("abcde", None), ("abcdf", 4), ("abcdf", 3), (None, 8), (None, None)]
    words = spark.createDataFrame([(w, n, "x", 1) for w, n in rows], "word string, n long, form string, key int")
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in sv.group_variants(words).collect()}
    assert found[""] == (None, "", 3, 0, None) and found["abc"] == (None, "abc", 100, 0, None)
    assert found["abcde"] == ("abcdf", "abcdf", 0, 2, 7)
    assert found["abcdf"] == (None, "abcdf", 7, 2, None) and len(found) == 7
    assert sv.group_variants(words.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sv.group_variants(words, ratio=1)


def test_runs_of_letters(spark, edge, nothing):
    text = "It's ÀB×c÷ naïve Āx 12ab́cÿ한\nZ"
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, "Ab")]
    found = [tuple(r) for r in sv.letter_runs(frame(spark, rows)).collect()]
    runs = ["it", "s", "Àb×c÷", "naïve", "x", "ab", "cÿ", "z"]
    assert found == [(1, r) for r in runs] * 2 + [(None, "ab")]
    assert sv.letter_runs(nothing).count() == 0
    counts = sv.word_counts(sv.letter_runs(edge).withColumnRenamed("run", "word"), 1, 1)
    assert {r["word"]: r["n"] for r in counts.collect()}["mit"] == 2
    twice = sv.word_counts(sv.letter_runs(frame(spark, rows)).withColumnRenamed("run", "word"), 5, 2)
    assert {r["word"]: r["n"] for r in twice.collect()} == {"Àb×c÷": 2, "naïve": 2}
