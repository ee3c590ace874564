from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from strata.llm.graph import components
from strata.llm import jaccard_join
from strata.llm.jaccard_join import ngram_components
from strata.llm.words import gram_hashes, hash_words

from .conftest import prose

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if len(words) >= n:
        return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return frozenset([tuple(words)] if words else [])


def brute(docs, n, num, den):
    """Rows (id, set size, component) by comparing every two documents."""
    sets = [shingles(t, n) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            groups[root(i)].append(d)
    return sorted(((d, len(sets[i]), min(groups[root(i)], default=None)) for i, (d, _) in enumerate(docs)), key=str)


def run(make_docs, docs, n=3, num=90, den=100, **more):
    return sorted((tuple(r) for r in ngram_components(make_docs(docs), "doc_id", "text", n, num, den, **more).collect()), key=str)


def edited(text, seed, edits):
    r, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return " ".join(words)


def test_odd_documents(make_docs, odd_docs):
    assert run(make_docs, odd_docs) == brute(odd_docs, 3, 90, 100)


@pytest.mark.parametrize("n,num", [(3, 90), (5, 80)])
def test_near_copies_of_many_grades(make_docs, n, num):
    docs = [(100 * g + i, edited(prose(g, 120), i, i)) for g in range(6) for i in range(9)]
    docs += [(9000 + i, prose(50, 40) + " " + prose(100 + i, 30 + i)) for i in range(12)]
    assert run(make_docs, docs, n, num) == brute(docs, n, num, 100)


def test_group_larger_than_all_pairs_are_met_in(make_docs):
    """Chains, stars and stragglers in one group whose n-grams are all frequent: the second round has work."""
    base = prose(7, 80)
    docs = [(i, edited(base, i, 1 + i % 5)) for i in range(70)]
    for near in (1, 8):
        assert run(make_docs, docs, 3, 80, 100, near=near, frequent_least=2) == brute(docs, 3, 80, 100)


def test_group_of_copies_just_under_the_threshold(make_docs):
    """Hardly any two link: what the second round is left with, in texts short and long enough to fill the bitmap."""
    for words, edits in ((120, 5), (700, 24)):
        base = prose(9, words)
        docs = [(i, edited(base, i, edits + i % 3)) for i in range(60)]
        docs += [(100 + i, edited(docs[i][1], 300 + i, 1)) for i in range(0, 60, 7)]
        assert run(make_docs, docs, 3, 90, 100, near=2, frequent_least=2) == brute(docs, 3, 90, 100)


def test_bitmaps_never_differ_in_more_bits_than_the_sets_in_elements():
    r = np.random.default_rng(1)
    for _ in range(200):
        pool = r.integers(0, 1 << 58, 900, dtype=np.uint64)
        a, b = (np.unique(pool[r.random(900) < r.choice([0.1, 0.5, 0.97])]) for _ in range(2))
        differ = sum(int(x).bit_count() for x in (jaccard_join._bitmap(a) ^ jaccard_join._bitmap(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b)) and (differ - len(np.setxor1d(a, b))) % 2 == 0


def test_threshold_is_exact(make_docs):
    # 9 of 10 shingles shared is a link; 8 of 9 is none
    words = [f"v{i}" for i in range(12)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:11])), (3, " ".join(words[:10])), (4, " ".join(words).upper())]
    assert run(make_docs, docs) == brute(docs, 3, 90, 100)


def test_empty_table(make_docs):
    assert run(make_docs, []) == []


def test_components_of_a_long_chain_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (7, None)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1050), 1000)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    import pyarrow as pa

    from strata.llm import words

    texts = pa.array([None, "a b", "", " x\ty\u000bz ", "ab" * 40 + " c", "a b", prose(1, 200)])
    want = hash_words(texts, spans=True)
    monkeypatch.setattr(words, "_BLOCK", 16)
    got = hash_words(texts, spans=True)
    assert all(np.array_equal(a, b) for a, b in zip(want, got, strict=True))
    h, off = want[:2]
    assert np.diff(off).tolist() == [0, 2, 0, 3, 2, 2, 200]
    assert np.array_equal(h[off[1] : off[2]], h[off[5] : off[6]])
    assert np.array_equal(gram_hashes(h, 7)[3:5], gram_hashes(h[3:11], 7))
    lower = hash_words(pa.array(["Ab Éx", "ab Éx", "ab éx"]), lower=True)[0]
    assert lower[0] == lower[2] and lower[1] == lower[3] != lower[5]


def _watched(monkeypatch):
    """What the join writes from now on, as (purpose, plan, rows)."""
    seen = []

    def stored(df, purpose, real=jaccard_join.stored):
        out = real(df, purpose)
        seen.append((purpose, df._jdf.queryExecution().executedPlan().toString(), out[0].count()))
        return out

    monkeypatch.setattr(jaccard_join, "stored", stored)
    monkeypatch.setattr(jaccard_join, "written", lambda df, purpose: stored(df, purpose)[0])
    return seen


def test_unlike_texts_with_a_passage_in_common_are_left_out_before_segments_are_cut(make_docs, monkeypatch):
    docs = []
    for g in range(12):
        passage = prose(500 + g, 190)
        docs += [(10 * g + i, passage + " " + prose(900 + 10 * g + i, 110)) for i in range(2)]
    seen = _watched(monkeypatch)
    assert run(make_docs, docs) == brute(docs, 3, 90, 100)
    assert [rows for purpose, _, rows in seen if purpose in ("pairs", "segments")] == [0] * 3


def test_texts_are_cut_where_they_are_read(make_docs, monkeypatch):
    docs = [(10 * g + i, edited(prose(g, 90), 10 * g + i, i)) for g in range(8) for i in range(3)]
    seen = _watched(monkeypatch)
    assert run(make_docs, docs) == brute(docs, 3, 90, 100)
    plans = [plan for purpose, plan, rows in seen if purpose == "segments" and rows]
    assert plans and not any("Exchange hashpartitioning" in plan for plan in plans)


def test_repeated_rows_do_not_count_their_segments_again(make_docs):
    docs = [(10 * g + i, edited(prose(g, 60), 10 * g + i, 2 * i)) for g in range(6) for i in range(3)] * 3
    docs += [(None, prose(1, 60))] * 2 + [(7, None), (8, "")] * 2
    assert run(make_docs, docs) == brute(docs, 3, 90, 100)


def test_pairs_of_a_large_group_of_near_copies_grow_with_its_members(make_docs, monkeypatch):
    base = prose(11, 150)
    docs = [(i, edited(base, i, i % 9)) for i in range(160)]
    seen = _watched(monkeypatch)
    assert run(make_docs, docs, 5, 80, 100, frequent_least=2) == brute(docs, 5, 80, 100)
    assert sum(rows for purpose, _, rows in seen if purpose == "pairs") < 0.8 * len(docs)


def test_long_unlike_texts_are_left_out_before_segments_are_cut(make_docs, monkeypatch):
    docs = [(10 * g + i, prose(500 + g, 1900) + " " + prose(900 + 10 * g + i, 1100)) for g in range(4) for i in range(2)]
    seen = _watched(monkeypatch)
    assert run(make_docs, docs) == brute(docs, 3, 90, 100)
    assert [rows for purpose, _, rows in seen if purpose in ("pairs", "segments")] == [0] * 3


def test_second_bitmaps_of_different_sizes(make_docs):
    """Links across the sizes at which a set gets a second bitmap, and at which that doubles."""
    r = np.random.default_rng(2)
    for size in (600, 1000, 5000):
        grams = np.unique(r.integers(0, 1 << 58, size, dtype=np.uint64))
        words = len(jaccard_join._wide(grams))
        halves = jaccard_join._bitmap(grams, 2 * words).reshape(2, words)
        assert np.array_equal(halves[0] ^ halves[1], jaccard_join._wide(grams)) and 2 * size <= 64 * words <= 4 * size
    docs = [(100 * w + i, edited(prose(w, w), w, i) + " " + prose(w + i, 5 * i)) for w in (500, 1015) for i in range(8)]
    assert run(make_docs, docs) == brute(docs, 3, 90, 100)
