from __future__ import annotations

import math
import re
import time
from collections import Counter, defaultdict

from sluiceworks.llm import pii
from sluiceworks.llm.pii import ACCEPT, BASE, CONFIDENT, KINDS, LIFT, SEEDS, Contexts, find_personal_data
from tests.llm.conftest import SF, frame, words

TOKEN = re.compile(r'token = "([0-9a-f]{40})"')


def plain_spans_of(texts: list[str]) -> list[str]:
    """The spans of each text, scored with plain dictionaries."""
    seen = [list(pii.mentions_of(t, pii.plain_spans(t))) for t in texts]
    every = [m for own in seen for m in own]
    total = Counter(w for t in texts for w in re.findall(r"[^\W\d_]+", t.lower()))
    uses = Counter((m[0], m[4]) for m in every if m[4] is not None)
    by_kind = Counter()
    for (kind, _), n in uses.items():
        by_kind[kind] += n
    forms, seeds = defaultdict(set), set()
    for kind, _, _, seed, word, patterns, form in every:
        for p in patterns:
            forms[kind, word, p].add(form)
            if seed:
                seeds.add((kind, word, p, form))

    def usable(key):
        kind, word, _ = key
        weak = sum((*key, f) not in seeds for f in forms[key])
        share = uses[kind, word] / total[word]
        usual = by_kind[kind] / sum(total.values())
        return len(forms[key]) >= SEEDS and weak and (share >= CONFIDENT or share >= LIFT * usual)

    graph = {key: own for key, own in forms.items() if usable(key)}
    found: set = set()
    while True:
        best: dict = defaultdict(dict)
        for (kind, word, p), own in graph.items():
            known = sum((kind, word, p, f) in seeds or (kind, f) in found for f in own)
            if known >= SEEDS and known / len(own) >= CONFIDENT:
                for f in own:
                    if (kind, word, p, f) not in seeds:
                        best[kind, f][word] = max(best[kind, f].get(word, 0), known / len(own))
        new = {
            key
            for key, confs in best.items()
            if 1 - math.exp(sum(math.log(max(1 - c, 1e-9)) for c in confs.values())) >= ACCEPT
        }
        if len(new) == len(found):
            break
        found = new
    found |= {(m[0], m[6]) for m in every if m[0] == len(BASE) and m[3]}
    out = []
    for own in seen:
        spans = sorted({(a, k, b) for k, a, b, seed, _, _, form in own if seed or (k, form) in found})
        out.append(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans))
    return out


def spans_in(spark, rows):
    found = find_personal_data(frame(spark, rows)).collect()
    return sorted((r["doc_id"], r["spans"]) for r in found)


def mixed_rows():
    rows = [(i, f"{words(8, i)} tel: +1 (555) 010-{1000 + i} {words(5, i)}") for i in range(9)]
    rows += [(20 + i, f"{words(6, i)} {w}: 555-020-{2000 + i} x") for i in range(4) for w in ("tel", "mobil")]
    rows += [(40 + i, f"mobil: 555-030-{3000 + i}, fax 555-030-{3000 + i}") for i in range(3)]
    rows += [(50 + i, f"fax 555-090-{i}000 or write me(at)home[dot]org") for i in range(5)]
    rows += [(60 + i, f"server ip 10.0.{i}.1 and fe80::{i}:1 end, ip fe80::{i}:9") for i in range(6)]
    rows += [(70 + i, f'api key = "Zx9{i}qwertyuiop{i}asdf" and session: Zx9{i}qwertyuiop{i}zz{i}') for i in range(5)]
    rows += [(80 + i, f"session: abcdefgh{i}jklmnopqrst then Zx9{i}qwertyuiop{i}asdf") for i in range(4)]
    return [*rows, (99, "volume: 555-040-4000 " + "a1" * 20), (100, words(50, 3))]


def test_spans_equal_plain_scoring(spark):
    rows = mixed_rows()
    want = sorted(zip([d for d, _ in rows], plain_spans_of([t for _, t in rows]), strict=True))
    assert spans_in(spark, rows) == want
    more = [s for _, s in want if s]
    assert any("secret" in s for s in more) and any("phone" in s for s in more) and want[-1][1] == ""


def test_spans_of_the_table_equal_plain_scoring_and_hold_its_secrets(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
    found = {r["doc_id"]: r["spans"] for r in find_personal_data(docs).collect()}
    assert found == dict(zip([d for d, _ in rows], plain_spans_of([t for _, t in rows]), strict=True))
    secrets, marked = set(), set()
    for doc_id, text in rows:
        secrets |= {(doc_id, m.start(1), m.end(1)) for m in TOKEN.finditer(text)}
        spans = [s.split(":") for s in found[doc_id].split(",") if s.startswith("secret:")]
        marked |= {(doc_id, int(a), int(b)) for _, a, b in spans}
    assert secrets and marked == secrets


def test_five_megabytes_of_forms_take_seconds():
    text = "mail a.b@c.de tel 555 123-4567 ip 10.0.0.1, key=abcdefgh12345678ijk\n" * 75_000
    assert len(text) > 5_000_000
    began = time.perf_counter()
    plain = pii.plain_spans(text)
    weak = pii.weak_spans(text, plain)
    assert time.perf_counter() - began < 60 and len(plain) == 150_000 and len(weak) == 150_000
    around = Contexts(text)
    assert around.at(weak[-1][0], weak[-1][2])[1]
    one_line = "1.2.3.4 " * 200_000
    assert len(pii.weak_spans(one_line, pii.plain_spans(one_line))) == 0


def test_contexts():
    text = f"Our {'x' * 5000}\n Tel. 12 + ab, cd 7 yz\nend"
    around = Contexts(text)
    at = text.index("7")
    assert around.at(at, at + 1) == ("cd", ["cd", ", cd", "ab , cd", "cd _ yz", ", cd _ yz", "ab , cd _ yz"])
    at = text.index("+")
    assert around.at(at, at + 1) == ("tel", ["tel . 0", "tel . 0 _ ab"])
    assert around.at(text.index(" Tel"), text.index(" Tel") + 1) == (None, [])
    long = "word" + "-" * 3000 + " 123"
    assert Contexts(long).at(len(long) - 3, len(long)) == (None, [])
    assert Contexts("x" * 9000 + " 5").at(9001, 9002) == ("x" * 9000, ["x" * 9000])
