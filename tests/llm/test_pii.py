from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import pii

from .conftest import prose

TEXTS = [
    (20, "mail anna.b@mail3.example.com, é😀 x@y.z and a@b.c%d@e.f, not @x.y or a@b; a@b-c.d.e."),
    (21, "host 10.0.0.1 and 1.2.3.4.5.6.7.8, 256.1.1.1 300.1.2.3 001.002.003.004 1.2.3 12.34.56.78.90"),
    (22, "card 4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 1234 5678 9012 3456 7890 1234 0000"),
    (23, "call +1 (988) 555-2485 or +49 30 1234567, +1 2 +12345678901234567 x+4 (20) 7946 0958."),
    (24, "tel (456) 555-2186, ssn 123-45-6789; DE89 3704 0044 0532 0130 00 and bob [at] mail [dot] example [dot] com"),
    (25, "1" * 5000 + " " + "a" * 5000 + "@" + "1." * 3000),
    (26, prose(1, 30_000) + " last.one@example.org"),
    (27, "version 1.2.3.4 release 5.6.7.8"),
]


def _luhn(s):
    d = [int(x) for x in s if x.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def _n(s):
    return sum(c.isdigit() for c in s)


CONTRACT = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= _n(s) <= 19 and _luhn(s)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= _n(s) <= 15),
}


def brute(text):
    return sorted((k, m.start(), m.end()) for k, (p, keep) in CONTRACT.items() for m in re.finditer(p, text or "") if keep(m.group()))


def test_base_spans_match_brute_force(make_docs, odd_docs):
    docs = [*odd_docs, *TEXTS, (20, TEXTS[0][1])]
    got = [(r.id, sorted((s.kind, s.start, s.end) for s in r.base)) for r in pii.find_personal_data(make_docs(docs), "doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted(((d, brute(t)) for d, t in docs), key=str)
    assert {k for _, s in got for k, *_ in s} == set(CONTRACT)


def test_further_kinds_and_overlaps(make_docs):
    docs = make_docs(TEXTS + [(100 + i, f"phone ({200 + i}) 555-21{i:02d} and {t}") for i in range(30) for t in [prose(i, 5)]])
    rows = {r.id: r for r in pii.find_personal_data(docs, "doc_id", "text").collect()}
    assert {s.kind for s in rows[24].more} >= {"local_phone", "ssn"}
    for r in rows.values():
        assert not any(a.start < b.end and b.start < a.end for a in r.base for b in r.more)
        for s in [*r.base, *r.more]:
            assert s.text == dict(TEXTS).get(r.id, s.text)[s.start : s.end] or r.id >= 100
    assert not rows[23].more  # the number inside a + phone is no candidate of its own


def test_em_finds_the_unreliable_labeler():
    r = np.random.default_rng(1)
    truth = r.random(4000) < 0.6
    votes = np.stack([np.where(r.random(4000) < a, np.where(truth, 1, -1), np.where(truth, -1, 1)) for a in (0.95, 0.9, 0.5)], axis=1)
    rows, n = np.unique(votes, axis=0, return_counts=True)
    p, model = pii.estimate_reliabilities(rows, np.zeros(len(rows), int), n.astype(float), 1)
    assert abs(model["rate"][0] - 0.6) < 0.03
    odds = model["odds"][0]  # labeler, truth, vote
    assert odds[0, 1, 2] > 0.9 and odds[1, 1, 2] > 0.85 and abs(odds[2, 1, 2] - 0.5) < 0.05
    agree = {tuple(v): x for v, x in zip(rows.tolist(), p, strict=True)}
    assert agree[1, 1, -1] > 0.9 > 0.1 > agree[-1, -1, 1]


def test_classifier_learns_soft_targets():
    w = pii.fit_classifier([["a"], ["b"], ["a", "b"]], np.array([1.0, 0.0, 0.5]), np.array([100.0, 100.0, 10.0]))
    assert w["a"] > 0.5 and w["b"] < -0.5 and set(w) == {"a", "b", ""}


@pytest.mark.parametrize("text", ["4111 1111 1111 1111", "79927398713", "0", "18", "19"])
def test_luhn(spark, text):
    assert spark.range(1).select(pii.luhn(F.lit(text))).first()[0] == _luhn(text)


def test_redaction(make_docs):
    docs = pii.candidate_columns(make_docs([*TEXTS, (1, None), (2, "")]), "text", "spans_")
    out = {r.doc_id: r.out for r in docs.select("doc_id", pii.redacted(F.col("text"), F.col("spans_.base")).alias("out")).collect()}
    for no, text in TEXTS:
        want, at = "", 0
        for kind, s, e in sorted(brute(text), key=lambda x: x[1:]):
            if s >= at:
                want += text[at:s] + f"[{kind.upper()}]"
            at = max(at, e)
        assert out[no] == want + text[at:], no
    assert out[1] is None and out[2] == ""


def test_empty_table_and_no_candidates(make_docs):
    assert pii.find_personal_data(make_docs([]), "doc_id", "text").count() == 0
    assert pii.find_personal_data(make_docs([(1, "nothing here")]), "doc_id", "text").first().base == []
