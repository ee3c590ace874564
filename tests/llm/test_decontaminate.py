from __future__ import annotations

import random
import re

import numpy as np
import pytest

from strata.llm import decontaminate as dc

from .conftest import prose


def edits_within(item, text):
    """Fewest edits of the whole item against any part of the text (plain dynamic programming)."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def norm(s):
    return re.sub(r"\s+", " ", s).lower()


def mangled(text, edits, seed):
    r, out = random.Random(seed), list(text)
    for _ in range(edits):
        i = r.randrange(1, len(out) - 1)
        kind = r.randrange(3)
        if kind == 0:
            out[i] = r.choice("qxz")
        elif kind == 1:
            del out[i]
        else:
            out.insert(i, r.choice("qxz"))
    return "".join(out)


ITEMS = [(1, prose(500, 20)), (2, "Was Über die Brücke ging, der sah 99 weiße Schwäne."), (3, prose(501, 60)), (4, None), (5, ""), (6, "too short"), (3, prose(502, 30)), (None, prose(503, 25))]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_finds_exactly_what_the_budget_allows(make_docs, odd_docs, benchmark):
    docs, no = list(odd_docs), 1000
    for item_id, item in ITEMS:
        if item and len(item) >= 20:
            for edits in (0, 1, 3, 6, 9, 14, 20, 40):
                docs.append((no, f"{prose(no, 40)} {mangled(item, edits, no)} {prose(no + 1, 30)}"))
                no += 1
    docs.append((no, ITEMS[0][1].upper().replace(" ", " \n\t ")))
    docs.append((no + 1, ITEMS[1][1] + " " + ITEMS[1][1]))
    rows = dc.find_leaks(make_docs(docs), "text", benchmark, "item_id", "text", "hits").select("doc_id", "text", "hits").collect()
    found = 0
    for r in rows:
        text = norm(r.text or "")
        if r.doc_id == 8:  # too long for the plain comparison; none is planted
            assert r.hits == []
            continue
        want = sorted(str(i) for i, t in ITEMS if t and len(t) >= 20 and text and edits_within(norm(t), text) <= int(0.1 * len(norm(t))))
        assert sorted({str(h.item_id) for h in r.hits}) == sorted(set(want)), r.doc_id
        for h in r.hits:
            item = min((norm(t) for i, t in ITEMS if i == h.item_id and t), key=lambda t: edits_within(t, norm(r.text[h.start : h.end])))
            assert edits_within(item, norm(r.text[h.start : h.end])) == h.edits
        found += len(r.hits)
    assert found >= 15
    assert len([r for r in rows if r.doc_id == no + 1][0].hits) == 2


def test_blocks_of_items_and_texts_make_no_difference(make_docs, benchmark, monkeypatch):
    docs = [(i, f"{prose(i, 10)} {t} {prose(i, 9)}" if t else t) for i, (_, t) in enumerate(ITEMS)]
    get = lambda **m: sorted(str(r) for r in dc.find_leaks(make_docs(docs), "text", benchmark, "item_id", "text", "hits", **m).select("doc_id", "hits").collect())
    want = get()
    assert sum("item_id" in r for r in want) >= 4
    got = get(block_chars=150)
    key = lambda rows: [sorted(re.findall(r"Row\(item_id=[^)]*\)", r)) for r in rows]
    assert key(got) == key(want)
    index = dc.Index([(i, t) for i, t in ITEMS if t and len(t) >= 20], 0.1, 8)
    text = " ".join(t for _, t in docs if t)
    whole = index.search(text)
    monkeypatch.setattr(dc, "_SLICE", 64)
    assert index.search(text) == whole and len(whole) >= 4


def test_matches_never_span_two_texts(make_docs, benchmark):
    item = ITEMS[0][1]
    half = len(item) // 2
    docs = make_docs([(1, item[:half]), (2, item[half:]), (3, "\0" + item + "\0")])
    rows = {r.doc_id: r.hits for r in dc.find_leaks(docs, "text", benchmark, "item_id", "text", "hits").collect()}
    assert rows[1] == rows[2] == [] and [(h.start, h.end, h.edits) for h in rows[3]] == [(1, 1 + len(item), 0)]


def test_aligned_edits():
    r = np.random.default_rng(3)
    items, low, want = [], [], []
    text = r.integers(0, 4, 40).astype(np.uint32)
    for _ in range(80):
        item = r.integers(4, 8, int(r.integers(20, 40))).astype(np.uint32)
        copy = item
        for _ in range(r.integers(0, 9)):
            at = r.integers(0, len(copy))
            copy = [np.delete(copy, at), np.insert(copy, at, 9), np.concatenate([copy[:at], [9], copy[at + 1 :]])][r.integers(0, 3)]
        items.append(item)
        low.append(len(text) - 8)
        text = np.concatenate([text, copy, r.integers(0, 4, 30)]).astype(np.uint32)
    got = dc.align(items, text, np.array(low), np.full(len(items), 6))
    for item, at, best in zip(items, low, got, strict=True):
        want = edits_within(item.tolist(), text[max(0, at - 60) : at + 120].tolist())
        assert (best is None) == (want > 6)
        if best:
            assert best[0] == want == edits_within(item.tolist(), text[best[1] : best[2]].tolist())
            whole = text[best[1] : best[2]].tolist()
            assert edits_within(whole, item.tolist()) <= want  # no longer than needed
    assert sum(x is not None for x in got) > 40
    assert dc.align([items[0]], items[0][2:-2], np.array([-4]), np.array([5])) == [(4, 0, len(items[0]) - 4)]


def test_empty_tables(make_docs, benchmark):
    assert dc.find_leaks(make_docs([]), "text", benchmark, "item_id", "text", "hits").count() == 0
    assert dc.find_leaks(make_docs([(1, "a b c")]), "text", benchmark.limit(0), "item_id", "text", "hits").first().hits == []
