from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import spelling as sp

from .conftest import prose


def neighbours(words):
    """All pairs one edit apart: words that share a pattern with one place open, or of which one is the other without a letter."""
    by = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by[w[:i] + "?" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in by.values():
        for w in group:
            near[w] |= group - {w}
    have = set(words)
    for w in words:
        for i in range(len(w)):
            if (x := w[:i] + w[i + 1 :]) in have:
                near[w].add(x)
                near[x].add(w)
    return near


def brute(n):
    near, form = neighbours(n), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(map(str, out))


def brute_counts(docs, least_length=5, least=3):
    count = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    return {w: n for w, n in count.items() if len(w) >= least_length and n >= least}


def random_words(seed, size, alphabet="abcé"):
    r = random.Random(seed)
    return {"".join(r.choice(alphabet) for _ in range(r.choice([1, 2, 4, 5, 6, 7]))): r.randint(1, 60) for _ in range(size)}


@pytest.fixture(scope="module")
def variants(spark):
    def run(n, **more):
        words = spark.createDataFrame([(w, k) for w, k in n.items()], "word string, n long")
        got = sp.spelling_variants(words, **more)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        return sorted(str(tuple(r)) for r in got.collect())

    return run


@pytest.mark.parametrize("alphabet", ["abcé", "ab", "abcdefghijklmnopqrstuvwxyzÀÿðП"])
def test_variants_equal_brute_force(variants, alphabet):
    n = random_words(len(alphabet), 500, alphabet)
    assert variants(n) == brute(n)


def test_many_cells_give_the_same(variants):
    n = random_words(8, 900, "abcdef")
    assert variants(n, cell=20, sample=400) == brute(n)
    assert variants(n, cell=20, sample=30, max_cells=8) == brute(n)


def test_ties_chains_and_long_words(variants):
    long = "abcdefghij" * 300
    n = {"colour": 10, "color": 40, "colon": 40, "colors": 3, "coloor": 80, long: 4, long[:-1]: 8, long[:500] + "x" + long[501:]: 2, "lone": 5, "aaaaa": 1, "aaaa": 2, "aaa": 4, "aa": 8, "a": 16}
    assert variants(n) == brute(n)


def test_long_chains_reach_their_root(variants):
    """Words of 20 letters that differ in one place each, n doubling: a chain of 40 forms."""
    word, n = ["a"] * 20, {}
    for k in range(40):
        n["".join(word)] = 3 << k
        word[k % 20] = "bc"[k // 20]
    assert variants(n) == brute(n)


def test_tree_finds_what_brute_force_finds():
    r = random.Random(2)
    words = sorted({"".join(r.choice("abcd") for _ in range(7)) for _ in range(3000)})
    shorter = sorted({"".join(r.choice("abcd") for _ in range(6)) for _ in range(800)})
    tree = sp.Tree(words, 7)
    near = neighbours([*words, *shorter])
    for some in (words, shorter):
        i, j = tree.near(sp.letters(some, len(some[0])))
        assert sorted((some[a], words[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True)) == sorted((w, x) for w in some for x in near[w] if len(x) == 7)


def test_cells_hold_each_word_once():
    r = random.Random(6)
    words = sorted({"".join(r.choice("abcdefgh") for _ in range(8)) for _ in range(2000)})
    q = sp.codes(sp.letters(words, 8))
    cells = sp.cut(q[::3], 40.0)
    assert len(cells) > 10
    inside = np.stack([sp.near_box(q, np.uint64(low), np.uint64(high), 0, 0) for low, high in cells])
    assert (inside.sum(axis=0) == 1).all()


def test_word_counts_and_typos(spark, make_docs, odd_docs):
    docs = [*odd_docs, (30, "ÀÉÈÊË Über über ÜBER straße × a÷b " * 3), (31, "word1word22word")]
    docs += [(i, prose(i % 7, 40)) for i in range(100, 300)]
    got = {r.word: r.n for r in sp.word_counts(make_docs(docs), "doc_id", "text", "[A-Za-zÀ-ÿ]+", 5, 3, sp.drawn_typos()).collect()}
    assert got == brute_counts(docs)
    plain = {r.word: r.n for r in sp.word_counts(make_docs(docs), "doc_id", "text", "[A-Za-zÀ-ÿ]+", 5, 3).collect()}
    assert plain != got


def test_counts_are_passed_on_in_parts(make_docs, monkeypatch):
    monkeypatch.setattr(sp, "_FLUSH", 10)
    docs = [(i, prose(i % 9, 60)) for i in range(60)]
    got = {r.word: r.n for r in sp.word_counts(make_docs(docs), "doc_id", "text", "[A-Za-zÀ-ÿ]+", 5, 3, sp.drawn_typos()).collect()}
    assert got == brute_counts(docs)


def test_query_equals_brute_force(spark, tmp_path, make_docs, odd_docs):
    docs = [*odd_docs, *[(i, prose(i, 150)) for i in range(100, 400)], (7, prose(1, 90)), (7, prose(1, 90))]
    make_docs(docs).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(str(tuple(r)) for r in sp.op12_spelling_variants(spark, str(tmp_path)).collect())
    assert got == brute(brute_counts(docs))


def test_empty_tables(spark, make_docs, variants):
    assert variants({}) == []
    assert sp.word_counts(make_docs([]), "doc_id", "text", "[a-z]+", 5, 3).count() == 0
    assert sp.word_counts(make_docs([(1, None), (None, "")]), "doc_id", "text", "[a-z]+", 1, 1).count() == 0
