"""Periodic runs of words, found with recompression: a run-length grammar that answers extensions.

A run is a stretch of words with a period of at most half its length that no neighbour extends.  Every run of period p
covers two neighbouring points of the grid 0, p, 2p, ..., which have equal words there.  So the pairs of points of all
grids (a harmonic sum: n log n of them) that agree are the candidates, and how far a pair goes on agreeing to the right
and to the left gives the run, or shows that there is none.

Those extensions come from a grammar of the sequence.  Its levels alternate between block compression (a maximal
block of one symbol becomes one symbol) and pair compression (symbols are dealt into two halves, and each left one
followed by a right one becomes one symbol), until nothing is left to compress.  Equal stretches are compressed
alike but for a few symbols at their ends.  Two places are extended by climbing while both stand at the beginning
of a symbol of the next level, and descending again from the first symbols that differ: O(log n) steps.  Symbols get
their names from sorted pairs, not from hashes, and a difference counts only at the lowest level, so results are exact.

All texts of a slice of an Arrow batch are one sequence with separators, which no symbol crosses, and all candidates
are extended together in array operations.  Rows are independent: there is no shuffle, and a lost executor costs the tasks it ran.

Words are maximal runs of other characters than space and \\x09-\\x0D.  Defined results: null and empty texts have no
words and no runs; repeated rows and null ids pass through; an empty table gives an empty result; columns other than
the two named are not read.  Of several grids that find one stretch the smallest period counts.  A text is one row:
memory is some 150 bytes a word for the longest text, or for slices of a megabyte of shorter ones.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import bound_batches
from strata.llm.words import mix64, pieces

_SLICE = 1 << 20  # bytes of text that share a grammar
_TABLE = 1 << 13  # texts up to so many words share one table of grid pairs
_MANY = 1 << 20  # grid pairs compared, and candidates extended, at once


class Grammar:
    """Levels of a run-length grammar of a sequence; symbol 0 separates texts and stands at both ends."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = [symbols.astype(np.int32)]
        self.first: list[np.ndarray] = []  # per step up: the place below of each symbol's first part, and the end
        self.up: list[np.ndarray] = []  # the place above of the symbol that each place below is part of, and the end
        self.blocks: list[bool] = []
        self.names = int(symbols.max(initial=0)) + 1
        turn = 0
        while True:
            self._blocks()
            s = self.symbols[-1]
            if not ((s[:-1] != 0) & (s[1:] != 0)).any():
                break
            self._pairs(turn)
            turn += 1

    def _step(self, starts: np.ndarray, blocks: bool) -> tuple[np.ndarray, np.ndarray]:
        first = np.flatnonzero(starts).astype(np.int32)
        up = np.empty(len(starts) + 1, np.int32)
        np.cumsum(starts, out=up[:-1])
        up[:-1] -= 1
        up[-1] = len(first)
        above = self.symbols[-1][first]
        self.first.append(np.append(first, np.int32(len(starts))))
        self.up.append(up)
        self.blocks.append(blocks)
        self.symbols.append(above)
        return self.first[-1], above

    def _name(self, above: np.ndarray, at: np.ndarray, key: np.ndarray) -> None:
        distinct, named = np.unique(key, return_inverse=True)
        above[at] = named + self.names
        self.names += len(distinct)

    def _blocks(self) -> None:
        s = self.symbols[-1]
        same = (s[1:] == s[:-1]) & (s[1:] != 0)
        if same.any():
            first, above = self._step(np.append(True, ~same), True)
            length = np.diff(first)
            at = np.flatnonzero(length > 1)
            self._name(above, at, above[at].astype(np.int64) << 32 | length[at])

    def _pairs(self, turn: int) -> None:
        s = self.symbols[-1]
        half = (mix64(s.astype(np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & np.uint64(1)).astype(bool)
        inside = (s[:-1] != 0) & (s[1:] != 0)
        either = [inside & ~half[:-1] & half[1:], inside & half[:-1] & ~half[1:]]
        pair = max(either, key=np.count_nonzero)
        if pair.any():
            first, above = self._step(np.append(True, ~pair), False)
            at = np.flatnonzero(np.diff(first) == 2)
            self._name(above, at, above[at].astype(np.int64) << 32 | s[first[at] + 1])

    def _advance(self, h: int, x: np.ndarray, y: np.ndarray, back: bool) -> np.ndarray:
        """How many equal symbols of level h may be passed at once where x and y agree."""
        if h == len(self.up) or not self.blocks[h]:
            return np.ones(len(x), np.int32)
        up, first = self.up[h], self.first[h]
        if back:
            return np.minimum(x - first[up[x - 1]], y - first[up[y - 1]])
        return np.minimum(first[up[x] + 1] - x, first[up[y] + 1] - y)

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols agree from places i and j on, or before them with ``back``; i and j differ and are in one text."""
        d, sign = (1, -1) if back else (0, 1)
        x, y = i.astype(np.int32), j.astype(np.int32)
        top = np.full(len(x), len(self.up), np.int32)
        going = np.arange(len(x))
        for h, (up, first) in enumerate(zip(self.up, self.first, strict=True)):
            if not len(going):
                break
            s, above = self.symbols[h], self.symbols[h + 1]
            a, b = x[going], y[going]
            whole = (first[up[a]] == a) & (first[up[b]] == b)
            part = np.flatnonzero(~whole)
            if len(part):
                part = part[s[a[part] - d] == s[b[part] - d]]
                step = sign * self._advance(h, a[part], b[part], back)
                a[part] += step
                b[part] += step
                whole[part] = (first[up[a[part]]] == a[part]) & (first[up[b[part]]] == b[part])
                x[going], y[going] = a, b
            climbs = whole.copy()
            a, b = up[a[whole]], up[b[whole]]
            climbs[whole] = above[a - d] == above[b - d]
            top[going[~climbs]] = h
            on = climbs[whole]
            going = going[climbs]
            x[going], y[going] = a[on], b[on]
        for h in range(len(self.up), -1, -1):
            at = np.flatnonzero(top >= h)
            if h < len(self.up):
                below = at[top[at] > h]
                x[below], y[below] = self.first[h][x[below]], self.first[h][y[below]]
            s = self.symbols[h]
            while len(at):
                at = at[s[x[at] - d] == s[y[at] - d]]
                step = sign * self._advance(h, x[at], y[at], back)
                x[at] += step
                y[at] += step
        return np.abs(x - i)


_GRID: list[tuple[np.ndarray, np.ndarray]] = []


def _grid_upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of neighbouring grid points (left, right) below n, ordered by the right one."""
    left = np.concatenate([np.arange(0, n - p, p, dtype=np.int32) for p in range(1, n)] or [np.zeros(0, np.int32)])
    right = np.concatenate([np.arange(p, n, p, dtype=np.int32) for p in range(1, n)] or [np.zeros(0, np.int32)])
    order = np.argsort(right, kind="stable")
    return left[order], right[order]


def grid_pairs(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (kp, kp + p) of positions below n for all periods p up to n / 2, in parts of bounded size."""
    if n <= _TABLE:
        if not _GRID:
            _GRID.append(_grid_upto(_TABLE))
        left, right = _GRID[0]
        upto = int(np.searchsorted(right, n))
        yield left[:upto], right[:upto]
        return
    root = int(n**0.5)
    for p in range(1, root + 1):  # short periods: along the text
        for at in range(0, n - p, p * _MANY):
            left = np.arange(at, min(at + p * _MANY, n - p), p)
            yield left, left + p
    for k in range((n - 1) // (root + 1)):  # long periods: the k-th points of all of them
        period = np.arange(root + 1, min(n // 2, (n - 1) // (k + 1)) + 1)
        for at in range(0, len(period), _MANY):
            yield k * period[at : at + _MANY], (k + 1) * period[at : at + _MANY]


def _distinct(rows: np.ndarray) -> np.ndarray:
    """The distinct rows, sorted."""
    rows = rows[np.lexsort(rows.T[::-1])]
    return rows[np.append(True, (rows[1:] != rows[:-1]).any(axis=1))] if len(rows) else rows


def runs_of(texts: list[np.ndarray], least: int) -> list[np.ndarray]:
    """Per text, a sequence of numbers from 1, its runs of at least ``least`` numbers as rows (start, length, period), sorted."""
    begin = np.cumsum([1, *(len(t) + 1 for t in texts)])
    sequence = np.zeros(begin[-1], np.int32)
    for t, at in zip(texts, begin.tolist(), strict=False):
        sequence[at : at + len(t)] = t
    grammar: list[Grammar] = []
    found: list[np.ndarray] = []
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def extended() -> None:
        i, j = (np.concatenate([w[k] for w in waiting]) for k in (0, 1))
        waiting.clear()
        if not grammar:
            grammar.append(Grammar(sequence))
        back = grammar[0].extend(i, j, back=True)
        length = back + grammar[0].extend(i, j) + (j - i)
        ok = length >= np.maximum(least, 2 * (j - i))
        found.append(_distinct(np.stack([(i - back)[ok], length[ok], (j - i)[ok]], axis=1)))

    n_waiting = 0
    for t, at in zip(texts, begin.tolist(), strict=False):
        if len(t) < least:
            continue
        own = sequence[at - 1 : at + len(t) + 1]  # with the separators: number k of the text is own[k + 1]
        for left, right in grid_pairs(len(t)):
            agree = np.flatnonzero(t[left] == t[right])
            i, j = left[agree], right[agree]
            # A run needs length - period >= max(period, least - period) agreeing neighbours; if that is two, one beside this one agrees.
            alone = (j - i < 2) & (least - (j - i) < 2)
            more = alone | (own[i + 2] == own[j + 2]) | (own[i] == own[j])
            if more.any():
                waiting.append((i[more].astype(np.int64) + at, j[more].astype(np.int64) + at))
                n_waiting += len(waiting[-1][0])
            if n_waiting > _MANY:
                extended()
                n_waiting = 0
    if waiting:
        extended()
    none = np.zeros((0, 3), np.int64)
    if not found:
        return [none] * len(texts)
    rows = _distinct(np.concatenate(found))  # by start, length, period: the first of a stretch has its smallest period
    rows = rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[: len(rows)]]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    edges = np.searchsorted(rows[:, 0], begin)
    return [rows[a:b] - [at, 0, 0] if b > a else none for a, b, at in zip(edges[:-1].tolist(), edges[1:].tolist(), begin.tolist(), strict=False)]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def periodic_runs(docs: DataFrame, id_col: str, text_col: str, finish: Callable, schema: str, least: int = 12, order: Callable | None = None) -> DataFrame:
    """``finish(words, runs)`` of every row: (id, *schema's values).

    ``words`` are the text's words in UTF-8, ``runs`` an array of rows (start, length, smallest period), by start, then period,
    of all runs of at least ``least`` (2 or more) words.  ``order(id as text, number of words)`` may give the text other words
    first: an array of places in it, or None to leave it alone.
    """
    if least < 2:
        raise ValueError("least must be 2 or more")
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(id_col).cast("string").alias("name"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    struct = _struct(schema)

    def work(batches):
        for b in batches:
            at = 0
            for texts in pieces(b.column("text"), _SLICE):
                part = b.slice(at, len(texts))
                at += len(texts)
                number: dict[bytes, int] = defaultdict(count(1).__next__)
                words, sequences = [], []
                for name, text in zip(part.column("name").to_pylist(), texts.to_pylist(), strict=True):
                    own = (text or "").encode("utf-8", "replace").split()  # bytes split at space and \x09-\x0D only
                    ids = np.fromiter(map(number.__getitem__, own), np.int32, len(own))
                    if order and (places := order(name, len(own))) is not None:
                        ids, own = ids[places], [own[k] for k in places.tolist()]
                    words.append(own)
                    sequences.append(ids)
                done = [finish(w, r) for w, r in zip(words, runs_of(sequences, least), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(done, struct)], ["id", "done"])

    return rows.mapInArrow(work, f"id {kind}, done struct<{schema}>").select("id", "done.*")


def _struct(schema: str) -> pa.DataType:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<struct<start:long,length:long,period:long>>": pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))}
    return pa.struct([(name, kinds[kind]) for name, kind in (x.strip().split(":", 1) for x in schema.split(", "))])


#: The schema of ``collapsed``.
COLLAPSED = "runs:array<struct<start:long,length:long,period:long>>, text:string"


def collapsed(words: list[bytes], runs: np.ndarray) -> dict:
    """The runs, and the text with one period left of each: its words joined by one space."""
    keep = kept_words(len(words), runs)
    return {"runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()], "text": b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k).decode()}


#: The schema of ``digest``.
DIGEST = "n_runs:long, start:long, length:long, period:long, exponent_milli:long, runs_sha256:string, collapsed_sha256:string"


def digest(words: list[bytes], runs: np.ndarray) -> dict:
    """Number of runs, the longest one, and the SHA-256 of all runs and of the words that are kept."""
    longest = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]), default=[None] * 3)
    kept = words
    if len(runs):
        kept = [w for w, k in zip(words, kept_words(len(words), runs).tolist(), strict=True) if k]
    return {
        "n_runs": len(runs), **dict(zip(("start", "length", "period"), longest, strict=True)),
        "exponent_milli": 1000 * longest[1] // longest[2] if len(runs) else None,
        "runs_sha256": hashlib.sha256("".join(f"{a},{n},{p}\n" for a, n, p in runs.tolist()).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(),
    }


def drawn_period(name: str | None, n: int) -> np.ndarray | None:
    """The contract's texts: one in ten, drawn by crc32 of the id, repeats a stretch of its words up to its end.  A null id reads as an empty one."""
    h = zlib.crc32((name or "").encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, some of them made periodic first, and what is left without repetitions."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return periodic_runs(docs, "doc_id", "text", digest, DIGEST, 12, drawn_period).withColumnRenamed("id", "doc_id")
