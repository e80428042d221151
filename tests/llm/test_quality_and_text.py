from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceworks.llm import queries
from sluiceworks.llm.byte_cnn import ByteCnn, chunks, excerpt, score_quality, train
from sluiceworks.llm.hamming_search import _with_masks, flips, nearest, sign_code
from sluiceworks.llm.license_scan import PHRASES, TEMPLATES, scan_licenses
from sluiceworks.llm.pii import BASE, KINDS, find_personal_data, luhn, mask, plain_spans
from sluiceworks.llm.quality_rules import bucket, bucket_floor, fences, judge
from tests.llm.conftest import LONG, SF, TEXTS, frame, words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

# ---- quality rules ----------------------------------------------------------------------


def counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    under = [False] * len(w)
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            under[i : i + 5] = [True] * 5
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), sum(under)


def measured(r):
    return tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))


def test_rules_of_the_table(spark, documents):
    found = queries.op1_adaptive_quality_rules(spark, SF).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {}
    for r in found:
        n = counts(documents[r["doc_id"]])
        assert measured(r) == n
        assert r["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r["kept"] and r["base_failed"])
        kept[r["doc_id"]] = r["kept"], r["base_failed"]
    assert len(kept) == len(documents)
    good = [k for d, (k, base) in kept.items() if labels.get(d) == 1 and not base]
    assert sum(good) >= 0.98 * len(good)


def test_rules_edge_cases(spark, nothing):
    rows = [*TEXTS, (20, "a b c d e f " * 30), (21, "l1 x\n\nl1 x\n \nl1 x\n" + words(40, 3)), (22, "#$ %% <>|" + words(30, 1))]
    found = judge(frame(spark, rows))
    got = sorted(((r["doc_id"], *measured(r)) for r in found.collect()), key=repr)
    assert got == sorted(((d, *counts(t or "")) for d, t in rows), key=repr)
    assert judge(nothing).count() == 0


def test_rules_have_no_python(spark):
    plan = judge(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_buckets(spark):
    values = [*range(200), 1023, 1024, 10**6, 2**40 + 12345]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for r in df.select("v", bucket_floor(bucket(F.col("v"))).alias("low")).collect():
        assert r["low"] <= r["v"] <= r["low"] + r["low"] // 32
    numbers = [r[0] for r in df.orderBy("v").select(bucket(F.col("v"))).collect()]
    assert numbers == sorted(numbers)


def test_fences_are_near_the_quartiles_of_each_group(spark):
    rng = np.random.default_rng(1)
    rows = [("g", "a", int(v), 0, 0) for v in rng.normal(5000, 300, 3000)]
    rows += [(None, None, int(v), 0, 0) for v in rng.normal(900, 60, 2000)]
    df = spark.createDataFrame(rows, "lang string, source string, length long, symbols long, repeats long")
    for r in fences(df.withColumn("key", F.struct("lang", "source"))).collect():
        own = sorted(v for lang, _, v, _, _ in rows if lang == r["key"]["lang"])
        q1, q3 = own[len(own) // 4], own[3 * len(own) // 4]
        spread = max(q3 - q1, 100)
        assert abs(r["length_fence"]["high"] - (q3 + 6 * spread)) < 0.25 * q3
        assert r["symbols_fence"]["high"] == 60


def test_an_outlier_of_its_source_goes(spark):
    clean = [(i, words(80, i)) for i in range(60)]
    loud = [(100, " ".join(w + "##" for w in words(80, 99).split())), (101, " ".join(w * 4 for w in words(80, 98).split()))]
    rows = [(d, t, "en", "s") for d, t in clean + loud]
    found = judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert {r["doc_id"] for r in found.where("NOT kept").collect()} == {100, 101}


# ---- quality classifier -----------------------------------------------------------------


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 120, n).tolist()) for n in (10, 300, 900)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    codes, first = chunks(offsets, np.frombuffer(b"".join(texts), np.uint8))
    wanted = np.array([1, 0, 1], np.float32)
    model = ByteCnn.start()
    for w in model.weights():
        w[...] = w.astype(np.float64)

    def loss():
        z = model.forward(codes, first)["logit"]
        return float(np.mean(np.logaddexp(0, z) - wanted * z))

    slopes = model.gradients(codes, first, wanted)
    for w, g in zip(model.weights()[1:], slopes[1:], strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        step, keep = 1e-2, w[at]
        w[at] = keep + step
        up = loss()
        w[at] = keep - step
        down = loss()
        w[at] = keep
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=0.1, abs=1e-4)


def test_scores_equal_plain_loops():
    """Every chunk, place and filter one by one."""
    rng = np.random.default_rng(6)
    model = ByteCnn.start(seed=2)
    model.shift = 0.3
    for n in (0, 3, 255, 256, 257, 700, 1500):
        text = bytes(rng.choice(list(b"abc de$\n"), n).tolist())
        begins = [0]
        while begins[-1] + 256 < n:
            begins.append(begins[-1] + 191)
        reads = []
        for b in begins:
            part = list(text[b : b + 256])
            plain = part + [256] * (256 - len(part))
            four = [(*plain[i : i + 3], plain[i + 3] & 31) for i in range(253)]  # as the network sees them
            again = [any(four[i - lag] == four[i] for lag in range(2, 33) if lag <= i) for i in range(253)]
            codes = [c + 257 * (c != 256 and i < 253 and again[i]) for i, c in enumerate(plain)]
            vectors = [model.embed[c].astype(float) for c in codes]
            pooled = np.full(32, -np.inf)
            for g in range(63):
                one, two = (np.concatenate(vectors[4 * h : 4 * h + 4]) for h in (g, g + 1))
                pooled = np.maximum(pooled, one @ model.filters[:, :32] + two @ model.filters[:, 32:])
            pooled = np.maximum(pooled + model.bias, 0)
            reads.append(np.maximum(pooled @ model.hidden + model.hidden_bias, 0))
        logit = np.mean(reads, axis=0) @ model.out + model.out_bias[0]
        score = model.score(np.array([0, n]), np.frombuffer(text, np.uint8))[0]
        assert score == pytest.approx(1 / (1 + np.exp(-logit - 0.3)), abs=1e-5)


def test_chunks_cover_the_whole_text():
    for n in (0, 1, 255, 256, 257, 448, 449, 5000):
        codes, first = chunks(np.array([0, n]), np.arange(n, dtype=np.int64).astype(np.uint8))
        assert first.tolist() == [0, len(codes)] and (codes != 256).sum() >= n
        assert len(codes) == 1 or (len(codes) - 1) * 191 + 256 >= n


def test_scores_do_not_depend_on_the_batch(spark):
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(32, 120, n).tolist()) for n in (0, 5, 700, 900_000, 40)]
    model = ByteCnn.start()
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = model.score(offsets, np.frombuffer(b"".join(texts), np.uint8))
    alone = [model.score(np.array([0, len(t)]), np.frombuffer(t, np.uint8))[0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-5)
    # a change at the very end counts
    changed = texts[3][:-200] + b"!" * 200
    assert model.score(np.array([0, len(changed)]), np.frombuffer(changed, np.uint8))[0] != alone[3]


def test_held_out_accuracy(spark):
    place = "/root/testdata/sf0.01"
    found = queries.op10_byte_cnn_quality(spark, place).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{place}/labels.parquet").collect()}
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1
    own = [r["predicted"] == labels[r["doc_id"]] for r in found if r["held_out"] and r["doc_id"] in labels]
    assert len(own) > 50 and sum(own) >= 0.93 * len(own)


def test_classifier_edge_cases(spark, edge, nothing, monkeypatch):
    monkeypatch.setattr("sluiceworks.llm.byte_cnn.STEPS", 5)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = [(1, 1), (2, 0), (4, 1), (5, 0), (7, 1), (9, 0), (9, 1), (None, 1), (10, None), (11, 2), (6, 0), (8, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    scored = score_quality(edge, labels)
    assert scored.count() == len(TEXTS) and scored.where("score IS NULL OR score < 0 OR score > 1").isEmpty()
    assert {r["score"] for r in score_quality(edge, none).collect()} == {0.5}
    assert {r["score"] for r in score_quality(edge, labels.where("quality = 1")).collect()} == {1.0}
    assert score_quality(nothing, labels).count() == 0
    assert train([], [], (0, 0)).constant == 0.5


# ---- licences ---------------------------------------------------------------------------


def base_of(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return (
        len(w), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def scanned(df):
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def test_licences_of_the_table(spark, documents):
    found = queries.op8_license_automaton(spark, SF)
    assert scanned(found) == sorted(((d, *base_of(t)) for d, t in documents.items()), key=repr)


def test_licences_edge_cases(spark, nothing):
    odd = [
        (20, "gnu gnu general public license license cc cc by by mit mit license"),
        (21, "Apache License" + " x" * 5000 + " apache LICENSE"),
        (22, "cc"),
    ]
    found = scan_licenses(frame(spark, TEXTS + odd))
    assert scanned(found) == sorted(((d, *base_of(t)) for d, t in TEXTS + odd), key=repr)
    assert found.where("(n_base > 0) <> (score = 1)").isEmpty()
    assert scan_licenses(nothing).count() == 0


def test_templates_are_found_whole_in_part_and_with_gaps(spark):
    notice = TEMPLATES["bsd"].split()
    gap = notice[:9] + ["and", "whatever"] + notice[9:]
    swapped = notice[12:] + ["x"] * 3 + notice[:12]
    rows = [
        (1, " ".join(notice)),
        (2, "Foo. " + " ".join(gap).upper() + " bar"),
        (3, " ".join(notice[:8])),
        (4, " ".join(swapped)),
        (5, words(500, 3)),
        (6, " ".join(notice) + " cc by " + TEMPLATES["isc"]),
    ]
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in scan_licenses(frame(spark, rows)).collect()}
    assert found[1] == ("bsd", 1.0) and found[2][0] == "bsd" and found[2][1] > 0.9
    assert found[3][0] == "" and 0.3 < found[3][1] < 0.6
    assert found[4][1] < found[1][1] and found[5] == ("", 0.0)
    assert found[6] == ("bsd,cc-by,isc", 1.0)


def test_excerpts_of_long_texts_are_learned(spark):
    """The quality of these shows beyond any prefix, and no text is short."""
    long = "ä" * 9000 + "".join(chr(97 + i % 26) for i in range(30_000))
    rows = [(1, "short é"), (2, long), (3, None)]
    got = {r[0]: r[1] for r in frame(spark, rows).select("doc_id", excerpt("text", 4096)).collect()}
    data = long.encode()
    assert bytes(got[1]) == "short é".encode() and got[3] is None and len(got[2]) == 4096
    begins = [int(i * (len(data) - 1024) / 3) for i in range(4)]
    assert bytes(got[2]) == b"".join(data[b : b + 1024] for b in begins)
    rng = np.random.default_rng(1)
    filler = lambda n: " ".join(words(40, int(rng.integers(1 << 30))) for _ in range(n))
    docs = [(i, filler(100) + ("$$$ ###" * 1500 if i % 2 else filler(50))) for i in range(60)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    scores = {r["doc_id"]: r["score"] for r in score_quality(frame(spark, docs), labels).collect()}
    assert sum((scores[i] > 0.5) == (i % 2 == 0) for i in range(60)) >= 57


def test_spans_and_sections_of_licences(spark):
    warranty, notice = TEMPLATES["mit/warranty"], TEMPLATES["bsd"].split()
    rows = [
        (1, f"{words(10, 1)} {warranty} {words(5, 2)}"),
        (2, " ".join(notice) + " x " + " ".join(notice)),
        (3, " ".join(notice[:-1]) + " y y " + " ".join(notice[:-1])),
        (4, " ".join(notice[:9] + ["and", "whatever"] + notice[9:])),
        (5, words(50, 3)),
    ]
    found = {r["doc_id"]: r for r in scan_licenses(frame(spark, rows)).collect()}

    def spans(d, template):
        return [tuple(x)[2:] for x in found[d]["spans"] if x["template"] == template]

    n, size = len(notice), len(warranty.split())
    assert found[1]["labels"] == "mit" and spans(1, "mit/warranty") == [(10, 10 + size, 0, size, 1.0)]
    assert spans(2, "bsd") == [(0, n, 0, n, 1.0), (n + 1, 2 * n + 1, 0, n, 1.0)]
    share = (n - 1) / n
    assert spans(3, "bsd") == [(0, n - 1, 0, n - 1, share), (n + 1, 2 * n, 0, n - 1, share)]
    assert spans(4, "bsd") == [(0, n + 2, 0, n, 1.0)] and spans(5, "bsd") == []


# ---- personal data ----------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def spans_of(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [
        (m.start(), 2, m.end())
        for m in CARD.finditer(text)
        if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))
    ]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(found)


def test_plain_forms_are_those_of_the_patterns():
    rng = np.random.default_rng(2)
    signs = [*"0123456789..@@++--  ()ab_%é\n", "1.2.3.4", "a@b.c", "4111111111111111", "+12 345 678 90", "255.255.0255.1"]
    for _ in range(4000):
        text = "".join(rng.choice(signs, rng.integers(0, 25)))
        assert plain_spans(text) == spans_of(text), text
    assert plain_spans("a" * 200_000 + "@") == [] and plain_spans("1" * 200_000) == []


def test_personal_data_of_the_table(spark, documents):
    for r in queries.op9_contextual_pii(spark, SF).collect():
        spans = spans_of(documents[r["doc_id"]])
        text = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert [r[f"n_{k}"] for k in BASE] == [sum(x == i for _, x, _ in spans) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(r["spans"].split(","))


def test_personal_data_edge_cases(spark, edge, nothing):
    found = find_personal_data(edge)
    got = sorted(((r["doc_id"], r["base"]) for r in found.collect()), key=repr)
    want = [(d, ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans_of(t or ""))) for d, t in TEXTS]
    assert got == sorted(want, key=repr)
    assert find_personal_data(nothing).count() == 0


def test_contexts_discover_numbers_without_a_plain_form(spark):
    rows = [(i, f"{words(8, i)} hotline +1 (555) 010-{1000 + i} {words(5, i)}") for i in range(12)]
    rows += [(20, "call our hotline (555) 010-7777 now"), (21, "chapter 1234567 of the book"), (22, "again (555) 010-7777 there")]
    rows += [(30 + i, f"the {words(6, 50 + i)} the +1 (555) 020-{1000 + i}") for i in range(5)]
    rows += [(40, "the 7654321 items")] + [(50 + i, "the " * 40) for i in range(5)]
    found = {r["doc_id"]: r["spans"] for r in find_personal_data(frame(spark, rows)).collect()}
    assert found[20] == "phone:17:31" and found[22] == "phone:6:20"
    assert found[21] == found[40] == ""


def test_accepted_numbers_make_patterns_without_seeds(spark):
    """Numbers after "tel" and "mobil" lead to the others after "mobil", which has no seed."""
    rows = [(i, f"{words(8, i)} tel: +1 (555) 010-{1000 + i} {words(5, i)}") for i in range(12)]
    rows += [(20 + i, f"{words(6, 20 + i)} {w}: 555-020-{2000 + i} x") for i in range(4) for w in ("tel", "mobil")]
    rows += [(40 + i, f"mobil: 555-030-{3000 + i}") for i in range(3)]
    rows += [(50, "volume: 555-040-4000")]
    spans = defaultdict(list)
    for r in find_personal_data(frame(spark, rows)).collect():
        spans[r["doc_id"]].append(r["spans"])
    assert all(s.startswith("phone:") for d in range(20, 24) for s in spans[d]) and len(spans[20]) == 2
    assert [spans[40 + i] for i in range(3)] == [["phone:7:19"]] * 3
    assert spans[50] == [""]


def test_a_word_used_without_numbers_too_is_a_pattern(spark):
    rows = [(i, f"{words(20, i)} phone: +1 (555) 010-{1000 + i}") for i in range(12)]
    rows += [(20 + i, f"{words(9, 60 + i)} the phone rang {words(20, i)}") for i in range(100)]
    rows += [(200, "my phone: 555-123-4567")]
    found = {r["doc_id"]: r["spans"] for r in find_personal_data(frame(spark, rows)).collect()}
    assert found[200] == "phone:10:22"


def test_mask():
    assert mask("mail a@b.cd or x", "email:5:11") == "mail <email> or x"
    assert mask("1.2.3.4567", "ip:0:8,card:2:10") == "<ip>"
    assert mask(None, "") is None and mask("x", None) == "x"


# ---- nearest codes ----------------------------------------------------------------------


def brute(codes, queries_, k):
    out = []
    for q, c in queries_:
        ranked = sorted((bin((c ^ d) & (2**64 - 1)).count("1"), i) for i, d in set(codes))
        out += [(q, n + 1, i, dist) for n, (dist, i) in enumerate(ranked[:k])]
    return sorted(out)


def found_near(df):
    return sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in df.collect())


@pytest.mark.parametrize("width", [None, 8, 16])
def test_nearest_codes(spark, width):
    rng = np.random.default_rng(3)
    centre = rng.integers(-(2**62), 2**62, 6)
    codes = [(i, int(centre[i % 6]) ^ (1 << int(rng.integers(63))) ^ (1 << int(rng.integers(63)))) for i in range(150)]
    codes += [(1000 + i, codes[0][1]) for i in range(40)] + [codes[5]] * 3 + [(-7, -1), (-8, 0)]
    asked = codes[:12] + [(500, int(rng.integers(2**62))), (501, -2**63)]
    df = spark.createDataFrame(codes, "id long, code long")
    ask = spark.createDataFrame(asked, "query_id long, code long")
    assert found_near(nearest(df, ask, 5, width)) == brute(codes, asked, 5)


def test_nearest_edge_cases(spark):
    schema, ask = "id long, code long, query string", spark.createDataFrame([(1, 5), (1, 5), (2, None)], "query_id long, code long")
    few = spark.createDataFrame([(1, 5, "x"), (2, 4, "x"), (None, 5, "x"), (3, None, "x")], schema)
    assert found_near(nearest(few, ask, 10)) == [(1, 1, 1, 0)] * 2 + [(1, 2, 2, 1)] * 2
    empty = spark.createDataFrame([], schema)
    assert nearest(empty, ask, 3).count() == 0
    assert nearest(few, ask.where("false"), 3).count() == 0
    with pytest.raises(ValueError):
        nearest(few, ask, 3, width=7)
    vectors = spark.createDataFrame([([1.0, -1.0, None, 2.0],), (None,), ([],)], "v array<float>")
    assert [r[0] for r in vectors.select(sign_code("v")).collect()] == [[9], [0], [0]]


def test_codes_of_all_components(spark):
    """Of 130, of which the first 64 are alike everywhere; some vectors are shorter."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        tail = rng.normal(size=[66, 66, 30, 0][i % 4]) if i % 9 else np.ones(66)
        rows.append((i, [1.0] * 64 + tail.tolist()))
    vectors = spark.createDataFrame(rows, "id long, v array<double>")
    codes = vectors.select("id", sign_code("v").alias("code"))
    asked = codes.where("id % 7 = 0").withColumnRenamed("id", "query_id")
    signs = {i: [x > 0 for x in v] + [False] * (130 - len(v)) for i, v in rows}
    want = []
    for q in range(0, 120, 7):
        ranked = sorted((sum(a != b for a, b in zip(signs[q], s, strict=True)), i) for i, s in signs.items())
        want += [(q, n + 1, i, d) for n, (d, i) in enumerate(ranked[:6])]
    assert found_near(nearest(codes, asked, 6, width=8)) == sorted(want)
    assert len({tuple(r["code"]) for r in codes.collect()}) > 60


@pytest.mark.parametrize(("width", "r"), [(8, 3), (16, 2), (32, 0), (32, 3), (32, 31)])
def test_masks(spark, width, r):
    masks = [m["mask"] for m in _with_masks(spark.range(1), width, r).collect()]
    assert sorted(masks) == sorted(flips(width, r))


def test_long_text_is_no_special_case():
    assert counts(LONG)[0] == 20_000
