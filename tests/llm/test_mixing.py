from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm.mixing import LEVELS, mixed, share_out

from .conftest import prose


def fill(budget, children):
    """{child: share} of (child, cap, weight), by filling and sharing out again until nothing changes."""
    share = {c: 0.0 for c, *_ in children}
    open_ = {c: (cap, w) for c, cap, w in children if w > 0}
    while open_ and budget > 1e-9:
        total = sum(w for _, w in open_.values())
        full = [c for c, (cap, w) in open_.items() if cap <= budget * w / total + 1e-12]
        if not full:
            share |= {c: budget * w / total for c, (_, w) in open_.items()}
            return share
        for c in full:
            share[c] = open_[c][0]
        budget -= sum(open_.pop(c)[0] for c in full)
    return share


def expected(rows, weights, budget_share, epochs, seed):
    tokens = defaultdict(int)
    for *_, leaf, n in rows:
        tokens[leaf] += n
    cap = defaultdict(float)
    for leaf, n in tokens.items():
        for k in range(4):
            cap[leaf[:k]] += n * epochs
    share = {(): budget_share * sum(tokens.values())}
    for k, level in enumerate(LEVELS):
        for parent in {leaf[:k] for leaf in tokens}:
            children = sorted({leaf[: k + 1] for leaf in tokens if leaf[:k] == parent})
            share |= fill(share[parent], [(c, cap[c], weights.get(level, {}).get(c[-1], 1.0)) for c in children])
    out = []
    for leaf, n in tokens.items():
        if not n or not share[leaf]:
            continue
        whole = int(share[leaf] / n + 1e-9)
        rest = max(0, int(share[leaf] - whole * n + 1e-6))
        mine = sorted((hashlib.md5(f"{seed}:{whole}:{'none' if i is None else i}".encode()).hexdigest(), str(i), m) for i, f, m in rows if f == leaf)
        used = 0
        for key in sorted({k for k, *_ in mine}):
            group = [x for x in mine if x[0] == key]
            used += sum(m for *_, m in group)
            out += [(i, m, whole + (used <= rest)) for _, i, m in group if m and whole + (used <= rest)]
    return sorted(out)


def table(make_docs):
    docs = []
    for i in range(300):
        lang = ["en", "de", "fr", None][(i * 7) % 10 // 3]
        docs.append((i, prose(i, 1 + (i * 13) % 40), lang, f"src{i % 3 if i % 2 else 0}"))
    docs += [(None, "a b", "en", "src1"), (None, "a b", "en", "src1"), (5, "c d e", "en", "src1"), (900, None, "en", "src0"), (901, "", "xx", "src0"), (902, "é" * 5000, "en", None)]
    return docs, make_docs(docs)


WEIGHTS = {"domain": {"d0": 3.0, "d1": 1.0, "none": 0.5}, "lang": {"en": 2.0, "fr": 0.0}}


@pytest.mark.parametrize("share,epochs,weights", [(0.5, 4, WEIGHTS), (1.7, 3, WEIGHTS), (1.0, 1, {}), (9.0, 2, WEIGHTS), (0.0, 4, {})])
def test_matches_brute_force(make_docs, share, epochs, weights):
    docs, df = table(make_docs)
    domain = F.concat(F.lit("d"), F.expr("try_cast(substring(source, 4) as int) % 2").cast("string"))
    got = mixed(df, "doc_id", "text", domain, F.col("lang"), F.col("source"), weights, share, epochs, 11).collect()
    rows = []
    for d, text, lang, source in docs:
        leaf = ("none" if source is None else f"d{int(source[3:]) % 2}", lang or "none", source or "none")
        rows.append((d, leaf, len((text or "").split())))
    assert sorted((str(r.doc_id), r.mix_tokens, r.mix_copies) for r in got) == expected(rows, weights, share, epochs, 11)
    assert got == [] or set(df.columns) < set(got[0].asDict())
    assert sum(r.mix_tokens * r.mix_copies for r in got) <= share * sum(n for *_, n in rows) + 1


def test_shortage_goes_to_siblings_first(spark):
    nodes = spark.createDataFrame([("p", "a", 10.0, 1.0, 90.0), ("p", "b", 100.0, 1.0, 90.0), ("p", "c", 100.0, 2.0, 90.0), ("q", "a", 1.0, 1.0, 5.0)], "parent string, child string, cap double, weight double, budget double")
    got = {(r.parent, r.child): r.share for r in share_out(nodes, ["parent"], "child").collect()}
    assert got == pytest.approx({("p", "a"): 10, ("p", "b"): 80 / 3, ("p", "c"): 160 / 3, ("q", "a"): 1})


def test_empty_table(make_docs):
    assert mixed(make_docs([]), "doc_id", "text", F.lit("d"), F.col("lang"), F.col("source"), {}).count() == 0
