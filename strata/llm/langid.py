"""Language identification with hyperdimensional letter n-gram profiles.

Every letter has a random +-1 vector.  An n-gram is the elementwise product (binding) of its
letters' vectors, each permuted (rotated) by its place in the n-gram; a text is the sum (bundle)
of its n-grams, a language the bundle of its training texts.  A text gets the language whose
bundle has the largest cosine with its own.

Bundling is a sum, so training adds up n-gram counts per language in Spark (partial sums per task,
then one shuffle by (language, n-gram)) and each language's counts become one vector.  The model is
languages x dimensions numbers, checked against ``max_languages`` before it is collected.

Runs of letters are lower-cased; everything else counts as one blank.  Defined results: null text,
empty text and text without a letter are ``und`` with score 0; a null language trains nothing; ties
of the cosine go to the smaller language name; with no training text everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import bound_batches, lean

UNKNOWN = "und"
_SLICE = 1 << 20  # characters of a text counted at once
_ALPHA: list[np.ndarray] = []
_MASK = (1 << 21) - 1  # a code point has 21 bits: three of them fit into a long


def _is_letter() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _ALPHA[0]


def text_grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter trigrams of one text, as packed code points, and their counts."""
    grams: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    tail = np.array([32], dtype=np.int64)
    seen = False
    for at in range(0, len(text or ""), _SLICE):
        cp = np.frombuffer(text[at : at + _SLICE].lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
        letter = _is_letter()[cp]
        seen = seen or bool(letter.any())
        cp = np.concatenate([tail, np.where(letter, cp, 32)])
        cp = cp[np.concatenate([[True], (cp[1:] != 32) | (cp[:-1] != 32)])]
        tail = cp[-2:]
        if at + _SLICE >= len(text) and cp[-1] != 32:
            cp = np.append(cp, 32)
        if len(cp) >= 3:
            g, c = np.unique(cp[:-2] << 42 | cp[1:-1] << 21 | cp[2:], return_counts=True)
            grams.append(g)
            counts.append(c)
    if not seen or not grams:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(grams) == 1:
        return grams[0], counts[0]
    g, at = np.unique(np.concatenate(grams), return_inverse=True)
    return g, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)


def gram_vectors(grams: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """One +-1 vector per packed n-gram: its letters' vectors, rotated by place and multiplied."""
    letters, at = np.unique(np.stack([grams >> 42, grams >> 21 & _MASK, grams & _MASK]), return_inverse=True)
    at = at.reshape(3, -1)
    table = np.empty((len(letters), dimensions), dtype=np.float32)
    for i, cp in enumerate(letters):
        table[i] = np.random.default_rng([seed, int(cp)]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1
    return np.roll(table, 2, axis=1)[at[0]] * np.roll(table, 1, axis=1)[at[1]] * table[at[2]]


def _bundles(rows: list[tuple[np.ndarray, np.ndarray]], dimensions: int, seed: int) -> np.ndarray:
    """The bundle of each row of (n-grams, counts)."""
    vocabulary, at = np.unique(np.concatenate([g for g, _ in rows]), return_inverse=True)
    out = np.zeros((len(rows), dimensions), dtype=np.float32)
    row = np.repeat(np.arange(len(rows)), [len(g) for g, _ in rows])
    count = np.concatenate([c for _, c in rows]).astype(np.float32)
    for a in range(0, len(vocabulary), 1024):  # bounds the vectors held at once
        part = (at >= a) & (at < a + 1024)
        dense = np.zeros((len(rows), min(1024, len(vocabulary) - a)), dtype=np.float32)
        dense[row[part], at[part] - a] = count[part]
        out += dense @ gram_vectors(vocabulary[a : a + 1024], dimensions, seed)
    return out


class LanguageModel:
    """Language prototypes; ``identify`` adds the prediction for a text column."""

    def __init__(self, languages: list[str], prototypes: np.ndarray, seed: int):
        self.languages, self.prototypes, self.seed = languages, prototypes, seed

    def identify(self, docs: DataFrame, text_col: str, out: str) -> DataFrame:
        """``docs`` with a struct column ``out`` (lang_pred string, score double)."""
        bound_batches(docs.sparkSession)
        shared = docs.sparkSession.sparkContext.broadcast((self.languages, self.prototypes, self.seed))

        @F.pandas_udf("lang_pred string, score double")
        @lean
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            languages, prototypes, seed = shared.value
            for texts in batches:
                lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                todo: list[tuple[int, tuple[np.ndarray, np.ndarray]]] = []

                def flush():
                    b = _bundles([g for _, g in todo], prototypes.shape[1], seed)
                    norm = np.linalg.norm(b, axis=1)
                    cos = (b @ prototypes.T) / np.where(norm > 0, norm, 1)[:, None]
                    for (i, _), best, c in zip(todo, cos.argmax(axis=1), cos.max(axis=1), strict=True):
                        lang[i], score[i] = languages[best], min(1.0, max(0.0, float(c)))
                    todo.clear()

                if languages:
                    for i, text in enumerate(texts):
                        g = text_grams(text)
                        if len(g[0]):
                            todo.append((i, g))
                            if len(todo) == 256:
                                flush()
                    if todo:
                        flush()
                yield pd.DataFrame({"lang_pred": lang, "score": score})

        # called so only that a filter on the prediction does not predict a second time, in further Python workers
        return docs.withColumn(out, predict.asNondeterministic()(F.col(text_col)))


def train(
    docs: DataFrame,
    text_col: str,
    lang_col: str,
    where: Column,
    dimensions: int = 1024,
    seed: int = 7,
    max_languages: int = 4096,
) -> LanguageModel:
    """Prototypes from all rows that satisfy ``where`` and have a language."""
    bound_batches(docs.sparkSession)
    rows = docs.where(where & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    )

    def count(batches):
        have: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush(lang):
            g, at = np.unique(np.concatenate([x for x, _ in have[lang]]), return_inverse=True)
            have[lang] = [(g, np.bincount(at, weights=np.concatenate([c for _, c in have[lang]])).astype(np.int64))]

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                have.setdefault(lang, []).append(text_grams(text.as_py()))
                if len(have[lang]) > 500:
                    flush(lang)
        for lang in have:
            flush(lang)
            g, c = have[lang][0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(c)], ["lang", "gram", "n"])

    counts = rows.mapInArrow(lean(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))

    def vectors(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs, grams, n = np.array(b.column(0).to_pylist(), dtype=object), b.column(1).to_numpy(), b.column(2).to_numpy()
            for lang in set(langs.tolist()):
                part = langs == lang
                v = np.zeros(dimensions)
                for a in range(0, int(part.sum()), 1024):
                    v += n[part][a : a + 1024].astype(np.float64) @ gram_vectors(grams[part][a : a + 1024], dimensions, seed)
                total[lang] = total.get(lang, 0) + v
        for lang, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(v)], ["lang", "i", "v"])

    sums = counts.mapInArrow(lean(vectors), "lang string, i int, v double").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    found = (
        sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("v")).orderBy("lang").limit(max_languages + 1)
        .select("lang", F.transform("v", lambda x: x["v"]).alias("v")).collect()
    )
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages if that is meant")
    matrix = np.array([r.v for r in found], dtype=np.float64).reshape(len(found), -1 if found else dimensions)
    norm = np.linalg.norm(matrix, axis=1)
    return LanguageModel([r.lang for r in found], (matrix / np.where(norm > 0, norm, 1)[:, None]).astype(np.float32), seed)


def held_out(id_col: str) -> Column:
    """The contract's split: crc32 of the id as text, modulo 5, is 0.  A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the documents that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs, "text", "lang", ~held_out("doc_id"))
    found = model.identify(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), "text", "p")
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")
