"""The training-corpus pipeline over ``documents``.

Five stages, each a function (spark, docs, sf_dir) -> DataFrame of what it keeps; what one returns is written as
Parquet and read back as the next one's docs.  The first four return the columns of docs; the last adds how often each
row is taken.

1. language ID: rows without a recognised language go; a null language becomes the recognised one.
2. n-gram Jaccard join: of the rows whose sets of 5-word shingles are connected by similarities of 0.8 or more, one
   stays: the smallest doc_id (nulls last), of equal ids the smallest row hash.  Repeated rows count once.
3. benchmark decontamination: rows that hold a benchmark item with at most 10 % edits go.
4. PII: every span found is replaced by its kind in brackets, and n_chars becomes the new length.
5. mixing: the rows that the mixture takes, with the tree's node names, the row's tokens and ``mix_copies``.

Null and empty texts: stage 1 drops them, as they have no letter.  Null ids are kept.  Extra columns pass through all stages.
An empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.decontaminate import find_leaks
from strata.llm.graph import beside, written
from strata.llm.jaccard_join import ngram_components
from strata.llm.langid import UNKNOWN, held_out, train
from strata.llm.mixing import mix_documents
from strata.llm.pii import candidate_columns, confirmed, redacted, train_span_classifier


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = _free(docs, "found")
    model = train(docs, "text", "lang", ~held_out("doc_id"))
    out = model.identify(docs, "text", found).where(F.col(found)["lang_pred"] != UNKNOWN)
    return out.withColumn("lang", F.coalesce("lang", F.col(found)["lang_pred"])).drop(found)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = _free(docs, "row_key")
    keyed = docs.withColumn(key, F.unhex(F.md5(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}).cast("binary"))))
    rows = keyed.select(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col(key).alias("key")).alias("id"), "text")
    found = written(ngram_components(rows, "id", "text", n=5, num=80, den=100).select("id", "component_id"), "groups")
    gone = written(found.where("id <> component_id").select(F.col("id.key").alias(key)).distinct(), "gone")
    # rows that are equal in every column have one key and are one group: the first occurrence stays
    again = written(found.where("id = component_id").groupBy(F.col("id.key").alias(key)).count().where("count > 1").select(key), "again")
    kept = keyed.join(beside(gone), key, "left_anti")
    if again.isEmpty():
        return kept.drop(key)
    once = kept.join(beside(again), key, "left_semi").dropDuplicates([key])
    return kept.join(beside(again), key, "left_anti").unionByName(once).drop(key)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = _free(docs, "leaks")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(docs, "text", benchmark, "item_id", "text", leaks).where(F.size(leaks) == 0).drop(leaks)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spans = _free(docs, "spans")
    with_spans = candidate_columns(docs, "text", spans)
    weights = train_span_classifier(with_spans.select(f"{spans}.*"))
    found = F.concat(F.col(spans)["base"], confirmed(F.col(spans)["more"], weights))
    out = with_spans.withColumn(spans, found).withColumn("text", redacted(F.col("text"), F.col(spans)))
    return out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).drop(spans)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", personal_data),
    ("mixing sources", mix),
]

#: Language prediction, approximate matches and the span classifier cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{i + 1}")
    return docs
