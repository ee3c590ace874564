from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest

from strata.llm.substrings import digest, kept_text, level_lengths, repeated_windows

from .conftest import prose

SCHEMA = "n_words:long,n_removed:long,kept_sha256:string"


def brute(docs, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(make_docs, docs, window, **more):
    return sorted((tuple(r) for r in repeated_windows(make_docs(docs), "doc_id", "text", window, digest, SCHEMA, **more).collect()), key=str)


@pytest.mark.parametrize("window", [1, 2, 7, 35])
def test_odd_documents(make_docs, odd_docs, window):
    assert run(make_docs, odd_docs, window) == brute(odd_docs, window)


def test_passages_overlaps_and_periods(make_docs):
    passage, other = prose(77, 50), prose(78, 34)
    docs = [(i, f"{prose(i, 30 + i)} {passage} {prose(100 + i, 20)}") for i in range(5)]
    docs += [(10, f"{passage} {passage}"), (11, other), (12, f"x {other} y"), (13, "la " * 90), (14, "la " * 34), (15, f"{prose(3, 33)} {passage[:150]}"), (16, "Upper " + passage.upper())]
    for window in (8, 35):
        assert run(make_docs, docs, window) == brute(docs, window)
    assert run(make_docs, docs, 35, base=4) == brute(docs, 35)


def test_levels():
    assert level_lengths(35) == [9, 18, 35]
    assert level_lengths(1) == [1, 1]
    assert level_lengths(35, 35) == [35, 35]


def test_kept_text(make_docs):
    passage = prose(5, 40)
    docs = [(1, f"one  two {passage}"), (2, f"{passage} three"), (3, "as\n it  is"), (4, None)]
    out = {r.id: r.kept for r in repeated_windows(make_docs(docs), "doc_id", "text", 35, kept_text, "kept:string").collect()}
    assert out == {1: "one two", 2: "three", 3: "as\n it  is", 4: None}


def test_empty_table(make_docs):
    assert run(make_docs, [], 35) == []
