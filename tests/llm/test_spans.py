from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from strata.llm import spans as sp
from strata.llm.pii import candidate_columns, redacted

SPANS = "array<struct<kind:string,start:long,end:long>>"


def random_spans(r, n, size, kinds="abc"):
    out = []
    for _ in range(n):
        a = r.randint(0, size - 1)
        out.append((r.choice(kinds), a, r.randint(a + 1, min(size, a + 12))))
    return out


@pytest.mark.parametrize("width", [1, 3, 512])
def test_running_sums_and_largest_values(spark, width):
    r = random.Random(width)
    data = [([r.randint(0, 9) for _ in range(n)],) for n in (0, 1, 2, 3, 7, 40, 1500)]
    got = spark.createDataFrame(data, "v array<long>").select("v", sp.running(F.col("v"), width=width).alias("s"), sp.running(F.col("v"), True, width).alias("m")).collect()
    for x in got:
        assert x.s == [sum(x.v[: i + 1]) for i in range(len(x.v))] and x.m == [max(x.v[: i + 1]) for i in range(len(x.v))]


def test_matches_equal_finditer(spark):
    texts = ["", "12 é 345x6", "7", "a1b22c333", "😀1 日22", "1" * 50, "none"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", sp.matches(F.col("t"), "[0-9]+", "n").alias("s"), sp.matches(F.col("t"), "[a-z]?([0-9]+)", "g", lambda g: F.length(g) >= 2, 1).alias("g")).collect()
    for x in rows:
        found = list(re.finditer("[0-9]+", x.t))
        assert [(s.start, s.end, s.text) for s in x.s] == [(*m.span(), m.group()) for m in found]
        at = [0, *[m.end() for m in found]]
        assert [s.before for s in x.s] == [x.t[at[i] : m.start()][-40:] for i, m in enumerate(found)]
        assert [s.after for s in x.s] == [x.t[m.end() : m.end() + 1] if i + 1 == len(found) or found[i + 1].start() > m.end() else "" for i, m in enumerate(found)]
        assert [(s.start, s.end) for s in x.g] == [m.span() for m in re.finditer("[a-z]?([0-9]+)", x.t) if len(m.group(1)) >= 2]


def test_order_and_distinct(spark):
    r = random.Random(2)
    data = [(random_spans(r, n, 30) * 2,) for n in (0, 1, 5, 60)]
    rows = spark.createDataFrame(data, f"s {SPANS}").select("s", sp.joined(F.col("s"), ["b", "a", "c"]).alias("j")).collect()
    for x in rows:
        want = sorted({(s.start, "bac".index(s.kind), s.end, s.kind) for s in x.s})
        assert x.j == ",".join(f"{k}:{a}:{e}" for a, _, e, k in want)


def test_clear_of_equals_all_pairs(spark):
    r = random.Random(3)
    data = [(random_spans(r, r.choice([0, 1, 3, 20]), 200), random_spans(r, r.choice([0, 1, 3, 20]), 200)) for _ in range(80)]
    rows = spark.createDataFrame(data, f"a {SPANS}, b {SPANS}").select("a", "b", sp.clear_of(F.col("a"), F.col("b")).alias("c")).collect()
    for x in rows:
        want = [s for s in x.a if not any(o.start < s.end and s.start < o.end for o in x.b)]
        assert sorted(map(tuple, x.c)) == sorted(map(tuple, want))


def test_redaction_equals_a_plain_pass(spark):
    r = random.Random(4)
    text = "".join(r.choice("aé😀 b") for _ in range(1200))
    data = [(text[:n], random_spans(r, k, n, ["x", "y"])) for n, k in ((1200, 0), (1200, 1), (1200, 40), (1200, 150), (3, 2), (256, 5), (512, 9))]
    rows = spark.createDataFrame(data, f"t string, s {SPANS}").select("t", "s", redacted(F.col("t"), F.col("s")).alias("r")).collect()
    for x in rows:
        out, at = [], 0
        for s in sorted(x.s, key=lambda s: (s.start, s.end, s.kind)):
            if s.start >= at:
                out += [x.t[at : s.start], f"[{s.kind.upper()}]"]
            at = max(at, s.end)
        assert x.r == ("".join(out) + x.t[at:] if x.s else x.t)


def test_many_spans_in_one_text_take_linear_time(spark):
    """16,000 and 64,000 addresses in one text: found, sorted and redacted."""
    took = []
    for n in (16_000, 64_000):
        docs = spark.createDataFrame([(" ".join(f"user{i}@example.org" for i in range(n)),)], "text string").coalesce(1)
        begun = time.time()
        got = candidate_columns(docs, "text", "p").select(F.size("p.base").alias("n"), F.length(sp.joined(F.col("p.base"), ["email"])).alias("j"), redacted(F.col("text"), F.col("p.base")).alias("r")).first()
        took.append(time.time() - begun)
        assert got.n == n and got.r == " ".join(["[EMAIL]"] * n)
    assert took[0] < 20 and took[1] < 8 * max(took[0], 1), took
