"""Approximate nearest neighbours by cosine with a forest of hash prefixes.

Each tree gives a vector a long hash string, the signs of its products with random directions, and keeps all strings
in sorted arrays.  A query descends every tree to the longest prefix that it shares with an entry, then ascends
all trees together, one bit at a time, until the entries that share the prefix are ``candidates`` or more over all
trees.  Those are scored exactly.

In Spark: equal vectors are one entry, with the smallest ids that can matter.  Entries of a tree are grouped by their first
bits, few enough that each group is expected to hold what a query needs; groups of more than ``group_rows`` entries are dealt into
parts by id, and a query visits all parts of its group, so no task holds an unbounded group.  A first pass over
the groups counts, per query and depth, the entries that share the prefix; above the groups, up to the root, the groups' sizes give
the counts.  They are summed over trees and parts and give each query's depth.  A second pass scores, and passes on only each
part's best: a query whose group holds too little visits all groups under its prefix (at the root those of one tree, which holds
all entries).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.graph import bound_batches, written


def _matrix(column, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if len(column) else np.zeros((0, width))


def _scaled(v: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest magnitude to about one: cosines stay as they are, to the last
    bit, and no square of a tiny or huge component is lost."""
    _, up = np.frexp(np.abs(v).max(axis=1, initial=0.0))
    return np.ldexp(v, -up[:, None])


def usable(vector: Column, width: int) -> Column:
    """Whether a vector has that many finite components that are not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == width) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _bounds(codes: np.ndarray, queries: np.ndarray, depth: int | np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The range of the sorted codes that share their first ``depth`` bits with each query."""
    rest = bits - np.asarray(depth)
    low = queries >> rest << rest
    return np.searchsorted(codes, low), np.searchsorted(codes, low + (1 << rest) - 1, side="right")


def nearest(
    items: DataFrame,
    id_col: str,
    vector_col: str,
    is_query: Column,
    k: int = 5,
    trees: int = 6,
    bits: int = 24,
    candidate_share: float = 1.2,
    candidates: int = 1000,
    group_rows: int = 20_000,
    seed: int = 5,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row that ``is_query``, itself left out.

    Nearness is the cosine in double precision, ties go to the smaller id.  A query sees at least
    ``candidates`` entries, or ``candidate_share`` times the number of entries if that is more (an entry counts once per tree;
    never fewer than give ``k`` others), or all entries if there are fewer.  Vectors that are null, zero, hold null or non-finite components, or have
    another length than most take no part, nor do null ids.  Repeated rows count once; an id with
    several vectors has one entry each and none of them is its own neighbour.  Other columns are not read.
    """
    spark = items.sparkSession
    bound_batches(spark)
    rows = items.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).where("id is not null")
    lengths = rows.where("size(v) > 0").groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    width = lengths.n if lengths else 1
    rows = rows.where(usable(F.col("v"), width))
    id_type = rows.schema["id"].dataType.simpleString()

    # entries: distinct vectors with their k + 1 smallest ids (one may be the query's own)
    least = rows.groupBy("v", "id").agg(F.max("asks").alias("asks"))
    placed = least.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(f"place <= {k + 1}")
    entries = placed.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = written(entries.select(F.monotonically_increasing_id().alias("entry"), "v", "ids"), "entries")
    asking = written(least.where("asks").select("id", "v").join(entries, "v").select("id", "entry"), "asking")
    n = entries.count()
    wanted = max(candidates, math.ceil(candidate_share * n), trees * (k + 1))
    first_bits = min(bits, max(0, int(math.log2(max(1.0, trees * n / wanted)))))
    normals = np.random.default_rng(seed).standard_normal((width, trees * bits))

    def hashed(batches):
        weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for b in batches:
            signs = (_scaled(_matrix(pa.chunked_array([b.column("v")]), width)) @ normals > 0).reshape(-1, trees, bits)
            codes = (signs * weights).sum(axis=2)
            for t in range(trees):
                arrays = [b.column("entry"), pa.array(np.full(len(codes), t, np.int32)), pa.array(codes[:, t]), b.column("v"), b.column("ids")]
                yield pa.RecordBatch.from_arrays(arrays, ["entry", "tree", "code", "v", "ids"])

    strings = entries.mapInArrow(hashed, f"entry long, tree int, code long, v array<double>, ids array<{id_type}>")
    strings = strings.withColumn("head", F.shiftright("code", bits - first_bits))
    sizes = written(strings.groupBy("tree", "head").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / group_rows).cast("int")), "sizes")
    dealt = strings.join(sizes.drop("n"), ["tree", "head"]).withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int")).drop("parts")
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    asked = strings.join(asking.select("entry").distinct(), "entry", "left_semi").select("tree", "head", F.col("entry").alias("query"), "code", "v")
    asks = asked.drop("v").join(sizes.drop("n"), ["tree", "head"]).withColumn("part", every_part)
    group = ["tree", "head", "part"]

    def side(asks: DataFrame, *cols: str) -> DataFrame:
        """Columns of the queries under names of their own, grouped."""
        return asks.select(*[F.col(c).alias(f"ask_{c}") for c in (*group, *cols)]).groupBy(*[f"ask_{c}" for c in group])

    def count(key, left: pa.Table, right: pa.Table) -> pa.Table:
        codes = np.sort(left.column("code").to_numpy())
        own = right.column("ask_code").to_numpy()
        shared = []
        for depth in range(first_bits, bits + 1):
            low, high = _bounds(codes, own, depth, bits)
            shared.append(high - low)
        shared = np.array(shared).reshape(bits + 1 - first_bits, len(own)).T
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * shared.shape[1]), pa.array(shared.ravel().astype(np.int64)))
        return pa.table({"query": right.column("ask_query"), "shared": lists.cast(pa.list_(pa.int64()))})

    counts = dealt.select(*group, "code").groupBy(*group).cogroup(side(asks, "query", "code")).applyInArrow(count, "query long, shared array<long>")
    counts = counts.select("query", F.posexplode("shared").alias("up", "n")).select("query", (F.col("up") + first_bits).alias("depth"), "n")

    # above the groups; the root holds all entries and needs no count
    under = sizes.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(first_bits)))).withColumn("prefix", F.expr(f"shiftright(head, {first_bits} - depth)"))
    above = under.where((F.col("depth") > 0) & (F.col("depth") < first_bits))
    above = above.select("tree", "head", "depth", "prefix").join(above.groupBy("tree", "depth", "prefix").agg(F.sum("n").alias("n")), ["tree", "depth", "prefix"])
    counts = counts.unionByName(asked.join(above, ["tree", "head"]).select("query", "depth", "n"))

    totals = counts.groupBy("query", "depth").agg(F.sum("n").alias("n"))
    depths = totals.groupBy("query").agg(F.coalesce(F.max(F.when(F.col("n") >= wanted, F.col("depth"))), F.lit(0)).alias("reached"))

    # a query's groups: its own, or all under its prefix, found by prefixes of up to 6 bits more, so that none is too common
    asks = asked.drop("head").join(written(depths, "depths"), "query").where("reached > 0 or tree = 0")
    asks = asks.withColumn("top", F.least("reached", F.lit(first_bits))).withColumn("depth", F.least(F.col("top") + 6, F.lit(first_bits)))
    asks = asks.withColumn("low", F.expr(f"shiftleft(shiftright(code, {bits} - top), depth - top)"))
    asks = asks.withColumn("prefix", F.explode(F.expr("sequence(low, low + shiftleft(1L, depth - top) - 1)")))
    asks = asks.join(under.drop("n"), ["tree", "depth", "prefix"]).withColumn("part", every_part).select(*group, "query", "code", "v", F.col("reached").alias("depth"))

    def score(key, left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(left.column("code").to_numpy(), kind="stable")
        codes = left.column("code").to_numpy()[order]
        v = _scaled(_matrix(left.column("v"), width))[order]
        norm = np.sqrt(np.einsum("ij,ij->i", v, v))
        ids = left.column("ids")
        first = np.array([x[0] for x in ids.to_pylist()])[order]
        q = _scaled(_matrix(right.column("ask_v"), width))
        low, high = _bounds(codes, right.column("ask_code").to_numpy(), right.column("ask_depth").to_numpy(), bits)
        out: list[tuple[int, int, float]] = []
        for i, who in enumerate(right.column("ask_query").to_pylist()):
            a, z = int(low[i]), int(high[i])
            if a == z:
                continue
            own = math.sqrt(float(q[i] @ q[i]))
            cos = v[a:z] @ q[i] / (norm[a:z] * own)
            if z - a > 2 * (k + 1):  # rounding may differ in the last digits from one block to another
                edge = np.partition(cos, -(k + 1))[-(k + 1)] - 1e-12
                some = np.flatnonzero(cos >= edge)
            else:
                some = np.arange(z - a)
            exact = np.array([float(np.dot(v[a + j], q[i])) / (float(norm[a + j]) * own) for j in some])
            best = np.lexsort((first[a + some], -exact))[: k + 1]
            out += [(who, int(order[a + some[j]]), float(exact[j])) for j in best]
        where = np.array([x for _, x, _ in out], dtype=np.int64)
        return pa.table({"query": pa.array([x for x, *_ in out], pa.int64()), "entry": left.column("entry").take(where), "ids": ids.take(where), "score": pa.array([x for *_, x in out], pa.float64())})

    found = dealt.select(*group, "entry", "code", "v", "ids").groupBy(*group).cogroup(side(asks, "query", "code", "v", "depth"))
    found = found.applyInArrow(score, f"query long, entry long, ids array<{id_type}>, score double").groupBy("query", "entry").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    found = found.select(F.col("query").alias("entry"), F.explode("ids").alias("vec_id"), "score")
    ranked = asking.withColumnRenamed("id", "query_id").join(found, "entry").where("vec_id <> query_id").groupBy("query_id", "entry", "vec_id").agg(F.max("score").alias("score"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "entry").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_prefix_forest(spark, sf_dir: str) -> DataFrame:
    """The five nearest neighbours of every embedding whose id is divisible by 50, among all others."""
    items = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(items, "vec_id", "embedding", F.col("vec_id") % 50 == 0)
