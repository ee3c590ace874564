"""Removal of repeated word windows by level-wise doubling.

A window of w words can only repeat if every shorter window inside it repeats.  So the first level looks at
windows of about w / 4 words; what repeats there alone is extended to twice the length, and again, up to w.
A level does not need all windows of its length inside a surviving w-window: one of them, chosen by content
(the smallest hash, the leftmost of equals), settles it, because equal w-windows choose equal ones.  Neighbouring
w-windows mostly choose the same one, so the first level shuffles some 7 % of all positions.  The last
level compares all surviving w-windows themselves, so the result is exact.

Hot windows are counted with partial sums; positions join the repeated hashes in sort-merge joins, whose
hot keys Spark splits.  Texts are shuffled once, and after the first level only those with a survivor are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import bound_batches, written
from strata.llm.words import gram_hashes, hash_words

_AT = (1 << 24) - 1  # low bits of an ordering key: a position, so that minima show where they are


def level_lengths(window: int, base: int = 0) -> list[int]:
    """Lengths of the levels: base, doubled until it would reach ``window``, then ``window``."""
    length = base or max(1, -(-window // 4))
    out = []
    while length < window:
        out.append(length)
        length *= 2
    return [*out, window] if out else [window, window]


def chosen_positions(grams: np.ndarray, places: int) -> np.ndarray:
    """For every window of ``places`` consecutive entries, the position of its smallest (leftmost) one."""
    out = []
    step = _AT + 1 - places
    for at in range(0, max(len(grams) - places + 1, 0), step):
        g = grams[at : at + step + places - 1]
        low = (g & ~np.uint64(_AT)) | np.arange(len(g), dtype=np.uint64)
        length = 1
        while 2 * length <= places:
            low = np.minimum(low[:-length], low[length:])
            length *= 2
        if places > length:
            low = np.minimum(low[: len(g) - places + 1], low[places - length :][: len(g) - places + 1])
        out.append((low & np.uint64(_AT)).astype(np.int64) + at)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def covered(starts: np.ndarray, window: int, n_words: int) -> np.ndarray:
    """Which words lie in a window that begins at one of ``starts``."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + window, n_words), -1)
    return np.cumsum(edge[:n_words]) > 0


def _candidates(h: np.ndarray, window: int, length: int, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions to test, their hashes, the position that settles each w-window) of one document at one level."""
    g = gram_hashes(h, length)
    if length == window:
        return alive, g[alive], alive
    by = chosen_positions(g, window - length + 1)[alive]
    at = np.unique(by)
    return at, g[at], by


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, window: int, finish: Callable, schema: str, base: int = 0) -> DataFrame:
    """``finish(text, removed)`` of every row: (id, *schema's values).

    ``removed`` tells for each word of the text (maximal runs of other characters than space and
    \\x09-\\x0D; none if null) whether a repeated window of ``window`` words covers it; a window repeats if its
    words, unchanged, also start anywhere else, in the same row or another, equal rows included.
    Texts with fewer words lose nothing.  Null ids pass through; an empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    id_type = rows.schema["id"].dataType.simpleString()
    lengths = level_lengths(window, base)

    def first_level(batches):
        for b in batches:
            h, off = hash_words(b.column("text"))
            grams, places, keys = [], [], []
            for i, key in enumerate(b.column("text_key").to_pylist()):
                own = h[off[i] : off[i + 1]]
                if len(own) >= window:
                    at, g, _ = _candidates(own, window, lengths[0], np.arange(len(own) - window + 1))
                    grams.append(g)
                    places.append(at)
                    keys.append(np.full(len(at), key, np.int64))
            if grams:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(keys)), pa.array(np.concatenate(places).astype(np.int32))], ["gram", "text_key", "at"])

    def repeating(tests: DataFrame, key: str, weight=None) -> DataFrame:
        """Per key the sorted positions whose n-gram occurs at least twice."""
        counts = tests.groupBy("gram").agg(F.sum(weight if weight is not None else F.lit(1)).alias("n")).where("n > 1").select("gram")
        found = tests.join(counts, "gram").groupBy(key, "at").agg(F.lit(1)).select(key, "at")
        return found.groupBy(key).agg(F.collect_list("at").alias("alive"))

    # Equal text keys of different texts only mix their survivors, which the next levels test again.
    alive = repeating(rows.mapInArrow(first_level, "gram long, text_key long, at int"), "text_key")
    joined = rows.join(alive, "text_key", "left")

    def settle(batches):
        """Rows without a survivor are finished; the others go on with their text."""
        for b in batches:
            done = [finish(text, None) if not on else None for text, on in zip(b.column("text").to_pylist(), b.column("alive").is_valid().to_pylist(), strict=True)]
            text = [t if on else None for t, on in zip(b.column("text").to_pylist(), b.column("alive").is_valid().to_pylist(), strict=True)]
            key = [hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=16).digest() if t is not None else None for t in text]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(text, pa.string()), pa.array(key, pa.binary()), b.column("alive"), pa.array(done, _struct(schema))], ["id", "text", "key", "alive", "done"])

    state = written(joined.select("id", "text", "alive").mapInArrow(settle, f"id {id_type}, text string, key binary, alive array<int>, done struct<{schema}>"), "settled")
    going = state.where("key is not null")
    texts = going.groupBy("key").agg(F.first("text").alias("text"), F.first("alive").alias("alive"), F.count(F.lit(1)).alias("copies"))
    texts = written(texts.withColumn("no", F.monotonically_increasing_id()), "texts")

    def survivors(h: np.ndarray, level: int, alive: list[int]) -> np.ndarray:
        """The w-windows that are alive after ``level``, from the positions found to repeat there."""
        before = np.arange(len(h) - window + 1) if level == 0 else None
        flag = np.zeros(len(h) + 1, bool)
        flag[[x for x in alive if x < len(h)]] = True
        if lengths[level] == window:
            return np.flatnonzero(flag[: len(h) - window + 1])
        by = chosen_positions(gram_hashes(h, lengths[level]), window - lengths[level] + 1)
        return np.flatnonzero(flag[by]) if before is None else before[flag[by]]

    for level in range(1, len(lengths)):

        def test(batches, level=level):
            for b in batches:
                h, off = hash_words(b.column("text"))
                grams, places, who, copies = [], [], [], []
                for i, (no, on, n) in enumerate(zip(b.column("no").to_pylist(), b.column("alive"), b.column("copies").to_pylist(), strict=True)):
                    own = h[off[i] : off[i + 1]]
                    if len(own) < window or not on.is_valid:
                        continue
                    at, g, _ = _candidates(own, window, lengths[level], survivors(own, level - 1, on.values.to_numpy()))
                    grams.append(g)
                    places.append(at)
                    who.append(np.full(len(at), no, np.int64))
                    copies.append(np.full(len(at), min(n, 2), np.int8))
                if grams:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(who)), pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(copies))], ["gram", "no", "at", "copies"])

        tests = texts.select("no", "text", "alive", "copies").mapInArrow(test, "gram long, no long, at int, copies byte")
        alive = repeating(tests, "no", F.col("copies"))
        texts = texts.drop("alive").join(alive, "no", "left")
        if level < len(lengths) - 1:
            texts = written(texts, "texts")

    def end(batches):
        for b in batches:
            h, off = hash_words(b.column("text"))
            done = []
            for i, (text, on) in enumerate(zip(b.column("text").to_pylist(), b.column("alive"), strict=True)):
                n = int(off[i + 1] - off[i])
                done.append(finish(text, covered(on.values.to_numpy().astype(np.int64), window, n) if on.is_valid else None))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(done, _struct(schema))], ["key", "done"])

    ended = texts.select("key", "text", "alive").mapInArrow(end, f"key binary, done struct<{schema}>")
    rest = going.select("id", "key").join(ended, "key").select("id", "done")
    return state.where("key is null").select("id", "done").unionByName(rest).select("id", "done.*")


def _struct(schema: str) -> pa.DataType:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.struct([(name, kinds[kind]) for name, kind in (x.split(":") for x in schema.replace(" ", "").split(","))])


def digest(text: str | None, removed: np.ndarray | None) -> dict:
    """Number of words, number removed and the SHA-256 of the kept words joined by one space."""
    words = (text or "").encode().split()  # bytes split at space and \x09-\x0D only
    kept = words if removed is None else [w for w, gone in zip(words, removed.tolist(), strict=True) if not gone]
    return {"n_words": len(words), "n_removed": len(words) - len(kept), "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest()}


def kept_text(text: str | None, removed: np.ndarray | None) -> dict:
    """The text without its removed words: kept as it is if none goes, else the kept words joined by one space."""
    if removed is None or not removed.any():
        return {"kept": text}
    return {"kept": b" ".join(w for w, gone in zip(text.encode().split(), removed.tolist(), strict=True) if not gone).decode()}


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """What is left of every document once all repeated windows of 35 words are removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = repeated_windows(docs, "doc_id", "text", 35, digest, "n_words:long,n_removed:long,kept_sha256:string")
    return out.withColumnRenamed("id", "doc_id")
