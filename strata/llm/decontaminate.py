"""Benchmark decontamination by the q-gram lemma.

A passage that differs from a benchmark item of m characters by at most k edits shares at least m + 1 - q - k q of the
item's q-grams with it, and their diagonals (place in the text minus place in the item) lie within k of each other.  So the shared
q-grams are counted in diagonal bands of width 2 (k + 1) at every k + 1 diagonals: each possible alignment lies whole
in one.  Bands that reach the bound are verified by banded alignment (all of the item against any part of the text).

Texts and items are compared in lower case, each run of blanks as one.  The items' q-grams are an index that every task
holds; a benchmark of more than ``block_chars`` characters is searched in blocks of at most that, one pass each.  A text
is searched whole, in its own task; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import bound_batches, lean

MATCHES = "array<struct<item_id:{id},start:long,end:long,edits:int>>"
_SLICE = 1 << 19
_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SYMBOLS: list[tuple[np.ndarray, np.ndarray]] = []


def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case (if one code point) with blanks as a space, and that folded to a byte."""
    if not _SYMBOLS:
        low = np.arange(0x110000, dtype=np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isspace():
                low[i] = 32
            elif len(x := c.lower()) == 1:
                low[i] = ord(x)
        _SYMBOLS.append((low, np.where(low < 128, low, 128 | (low & 127)).astype(np.uint8)))
    return _SYMBOLS[0]


def _normal(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points in lower case, bytes, place in the text) with each run of blanks as one."""
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    low, fold = _symbols()
    b = fold[cp]
    blank = b == 32
    keep = np.ones(len(b), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    at = np.flatnonzero(keep)
    return low[cp[at]], b[at], at


def _packed(b: np.ndarray) -> np.ndarray:
    """At each place the next eight bytes as one number, the first lowest (zeros beyond the end)."""
    x = np.concatenate([b, np.zeros(7, np.uint8)]).astype(np.uint64)
    x = x[:-1] | x[1:] << np.uint64(8)
    x = x[:-2] | x[2:] << np.uint64(16)
    return x[:-4] | x[4:] << np.uint64(32)


class Index:
    """The q-grams of a block of benchmark items."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float, q: int):
        self.items = []
        by_q: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for item_id, text in items:
            cp, b, _ = _normal(text.strip())
            k = int(error_rate * len(cp))
            own_q = min(q, 8, len(cp) // (k + 1))  # the longest q-gram of which the lemma promises one
            no = len(self.items)
            self.items.append((item_id, cp, k, len(cp) + 1 - own_q - k * own_q))
            grams = _packed(b)[: len(cp) - own_q + 1] & np.uint64((1 << 8 * own_q) - 1)
            by_q.setdefault(own_q, []).append((grams, np.full(len(grams), no), np.arange(len(grams))))
        self.tables = []
        for own_q, parts in by_q.items():
            grams, no, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(grams, kind="stable")
            known, first = np.unique(grams[order], return_index=True)
            sieve = np.zeros(1 << _BITS, bool)
            sieve[(known * _MIX) >> np.uint64(64 - _BITS)] = True
            mask = np.uint64((1 << 8 * own_q) - 1)
            self.tables.append((own_q, mask, sieve, known, np.append(first, len(grams)), no[order], at[order]))
        self.width = np.array([k + 1 for _, _, k, _ in self.items])
        self.need = np.array([need for *_, need in self.items])
        self.reach = max((len(cp) + 2 * k for _, cp, k, _ in self.items), default=0)

    def _hits(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, place in the item, place in the text) of all shared q-grams in places dense enough for some item."""
        out = []
        for own_q, mask, sieve, known, first, no, at in self.tables:
            places, grams = [], []
            for start in range(0, len(b) - own_q + 1, _SLICE):
                x = _packed(b[start : start + _SLICE + 7])[:_SLICE] & mask
                x = x[: len(b) - own_q + 1 - start]
                hit = np.flatnonzero(sieve[(x * _MIX) >> np.uint64(64 - _BITS)])
                places.append(hit + start)
                grams.append(x[hit])
            place, gram = np.concatenate(places or [np.zeros(0, np.int64)]), np.concatenate(grams or [np.zeros(0, np.uint64)])
            slot = np.searchsorted(known, gram)
            good = known[np.minimum(slot, len(known) - 1)] == gram
            place, slot = place[good], slot[good]
            # a match needs that many hits within its reach
            near = np.searchsorted(place, place + self.reach, side="right") - np.searchsorted(place, place - self.reach)
            dense = near >= self.need.min()
            place, slot = place[dense], slot[dense]
            n = first[slot + 1] - first[slot]
            rows = np.repeat(first[slot] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
            out.append((no[rows], at[rows], np.repeat(place, n)))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) of the best alignment in every band that holds one within the budget."""
        cp, b, at = _normal(text)
        return [(no, int(at[s]), int(at[e - 1]) + 1, edits) for no, s, e, edits in self.search_normal(cp, b)]

    def search_normal(self, cp: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int]]:
        if not self.items or not len(b):
            return []
        no, in_item, place = self._hits(b)
        if not len(no):
            return []
        diagonal = place - in_item + (1 << 20)  # items are shorter than that
        band = diagonal // self.width[no]
        key = np.concatenate([no << 44 | band, no << 44 | band - 1])
        key, n = np.unique(key, return_counts=True)
        key = key[n >= self.need[key >> 44]]
        which, low = key >> 44, (key & (1 << 44) - 1) * self.width[key >> 44] - (1 << 20)  # and each band's first diagonal
        found: dict[int, list[tuple[int, int, int]]] = {}
        for no, best in zip(which.tolist(), align([self.items[no][1] for no in which], cp, low, self.width[which] - 1), strict=True):
            if best:
                found.setdefault(no, []).append(best)
        out = []
        for no, places in found.items():  # overlapping places of one item: the fewest edits, then the first
            taken: list[tuple[int, int, int]] = []
            for edits, s, e in sorted(places):
                if all(e <= a or s >= z for _, a, z in taken):
                    taken.append((edits, s, e))
            out += [(no, s, e, edits) for edits, s, e in taken]
        return sorted(out, key=lambda x: (x[1], x[2], x[0]))


_FAR = 1 << 20


def _last_rows(items: list[np.ndarray], text: np.ndarray, low: np.ndarray, high: np.ndarray, most: np.ndarray, free: bool) -> list[np.ndarray | None]:
    """For each item, the edits of all of it against a part of ``text`` that ends on each of the diagonals low..high; None
    if there are more than ``most`` on all of them.

    With ``free`` the part begins anywhere, else at 0.  All items go through the rows together, and one drops out as
    soon as a whole row of it is above its budget.  Places outside the text match nothing.
    """
    out: list[np.ndarray | None] = [None] * len(items)
    length = np.array([len(x) for x in items])
    width = high - low + 1
    chars = np.zeros((len(items), length.max()), np.uint32)
    for c, x in enumerate(items):
        chars[c, : len(x)] = x
    pad = int(max(0, -low.min(), (high + length).max() - len(text))) + 1
    padded = np.full(len(text) + 2 * pad, 0xFFFFFFFF, np.uint32)
    padded[pad : pad + len(text)] = text
    step = np.arange(width.max())
    beyond = np.where(step[None, :] < width[:, None], 0, _FAR)
    start = low[:, None] + step
    row = np.maximum(np.zeros_like(start) if free else np.where(start < 0, _FAR, start), beyond)
    here = np.arange(len(items))
    at = start + pad
    for i in range(length.max()):
        # in row i + 1, diagonal d ends at place d + i + 1 and so has just read the text's place d + i
        new = row + (padded[np.clip(at + i, 0, len(padded) - 1)] != chars[here, i][:, None])
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        row = np.maximum(np.minimum.accumulate(new - step, axis=1) + step, beyond)
        done = length[here] == i + 1
        if done.any() or i % 8 == 7:
            fine = row.min(axis=1) <= most[here]
            for c in np.flatnonzero(done & fine):
                out[here[c]] = row[c, : width[here[c]]]
            go = fine & ~done
            row, here, at, beyond = row[go], here[go], at[go], beyond[go]
            if not len(here):
                break
    return out


def align(items: list[np.ndarray], text: np.ndarray, low: np.ndarray, k: np.ndarray) -> list[tuple[int, int, int] | None]:
    """Per item, (edits, start, end) of its best alignment with a part of ``text`` on the diagonals low - k .. low + 3 k + 1, a
    band and what its alignments can reach; None if that has more than ``k`` edits.  Of equals the first end counts."""
    out: list[tuple[int, int, int] | None] = []
    for a in range(0, len(items), 512):  # bounds what is held at once
        own = slice(a, a + 512)
        rows = _last_rows(items[own], text, low[own] - k[own], low[own] + 3 * k[own] + 1, k[own], True)
        for item, row, first, budget in zip(items[own], rows, (low[own] - k[own]).tolist(), k[own].tolist(), strict=True):
            if row is None:
                out.append(None)
                continue
            best = int(row.argmin())
            edits, end = int(row[best]), min(first + best + len(item), len(text))
            if edits == 0:
                out.append((0, end - len(item), end))
                continue
            near = text[max(0, end - len(item) - budget) : end][::-1]
            back = _last_rows([item[::-1]], near, np.array([-budget]), np.array([budget]), np.array([budget]), False)[0]
            out.append((edits, max(0, end - (len(item) + int(back.argmin()) - budget)), end))
    return out


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, min_chars: int, block_chars: int) -> Iterator[list[tuple[object, str]]]:
    """The benchmark's items in blocks of at most ``block_chars`` characters (or one item)."""
    items = benchmark.select(F.col(id_col).alias("i"), F.trim(F.col(text_col).cast("string")).alias("t")).where(F.length("t") >= min_chars)
    held, size = [], 0
    for r in items.toLocalIterator():
        t = r.t.replace("\0", "\1")
        if held and size + len(t) > block_chars:
            yield held
            held, size = [], 0
        held.append((r.i, t))
        size += len(t)
    if held:
        yield held


def find_leaks(docs: DataFrame, text_col: str, benchmark: DataFrame, item_id: str, item_text: str, out: str, error_rate: float = 0.1, q: int = 8, min_chars: int = 20, block_chars: int = 4_000_000) -> DataFrame:
    """``docs`` with an array column ``out`` of (item_id, start, end, edits), places in code points of the text.

    A match is a part of the text within ``error_rate`` edits per character of the whole item.  Of overlapping matches
    of one item the one of fewest edits is reported, then the first.  Null and empty texts have none.
    Items of fewer than ``min_chars`` characters, null ones too, say too little to be looked for.  An empty benchmark
    finds nothing; null and repeated ids and repeated items are reported as they are.
    """
    bound_batches(docs.sparkSession)
    kind = MATCHES.format(id=benchmark.schema[item_id].dataType.simpleString())
    found: Column = F.array().cast(kind)
    for block in blocks_of(benchmark, item_id, item_text, min_chars, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        found = F.concat(found, F.pandas_udf(lean(_searcher(shared, error_rate, q)), kind)(F.col(text_col).cast("string")))
    return docs.withColumn(out, found)


def _searcher(shared, error_rate: float, q: int):
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(shared.value, error_rate, q)
        # several short texts are searched as one, further apart than any item's budget
        apart = "\0" * (max(k for _, _, k, _ in index.items) + 1)

        def flush(held: list[tuple[int, str]], results: list[list[dict]]):
            starts = np.cumsum([0, *[len(t) + len(apart) for _, t in held]])
            for no, s, e, edits in index.search(apart.join(t for _, t in held)):
                i = int(np.searchsorted(starts, s, side="right")) - 1
                at = int(starts[i])
                results[held[i][0]].append({"item_id": index.items[no][0], "start": s - at, "end": e - at, "edits": edits})

        for texts in batches:
            results: list[list[dict]] = [[] for _ in texts]
            held, size = [], 0
            for i, t in enumerate(texts):
                if t:
                    held.append((i, t.replace("\0", "\1")))
                    size += len(t)
                if size >= _SLICE:
                    flush(held, results)
                    held, size = [], 0
            if held:
                flush(held, results)
            yield pd.Series(results)

    return search


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every place of a document that holds a benchmark item with at most 10 % edits."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_leaks(docs, "text", benchmark, "item_id", "text", "leak")
    return found.select("doc_id", F.explode("leak").alias("leak")).select("doc_id", "leak.*")
