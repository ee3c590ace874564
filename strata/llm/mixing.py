"""Mixing sources to target weights by hierarchical budgets.

Documents are the leaves' content in a tree domain > language > source.  A budget of tokens goes down the tree in
proportion to the weights of each node's children.  A child cannot take more than its subtree holds (its tokens times
``max_epochs``); what it leaves is shared out among its siblings by weight before any other branch gets it, because a node
never hands down more than its subtree can take.  Each leaf then takes whole epochs and, of the next one, the prefix
whose tokens fit, in an order drawn from the seed, the epoch and the id.

The tree is an aggregate of the documents: shares are found with windows over the children of each node.  The prefix of a
leaf is a threshold on its order keys.  It is found in two steps so that no leaf is sorted in one task: token sums
per (leaf, first three digits of the key) give the digit where the prefix ends, and only that 4096th of the leaf is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.graph import written

LEVELS = ["domain", "lang", "source"]
_BROADCAST_LEAVES = 100_000  # more leaves than that join by a shuffle


def n_tokens(text: Column) -> Column:
    """Words: maximal runs of other characters than space and \\x09-\\x0D; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(col: str, weights: dict[str, float]) -> Column:
    table = F.create_map(*[x for k, w in sorted(weights.items()) for x in (F.lit(k), F.lit(float(w)))]) if weights else None
    return F.coalesce(table[F.col(col)], F.lit(1.0)) if weights else F.lit(1.0)


def share_out(nodes: DataFrame, parents: list[str], child: str) -> DataFrame:
    """Splits each parent's ``budget`` over its children: in proportion to ``weight``, ``cap`` at most.

    With the children in order of cap / weight, all before the first one that is not filled are filled; from it on
    all get weight times the same level.  Children of weight 0 get nothing.
    """
    group = Window.partitionBy(*parents)
    order = group.orderBy("ratio", child)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("weight").over(
        order.rowsBetween(0, Window.unboundedFollowing)
    )
    rows = nodes.where("weight > 0").withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("level", level)
    rows = rows.withColumn("place", F.row_number().over(order))
    rows = rows.withColumn("open", F.min(F.when(F.col("level") < F.col("ratio"), F.col("place"))).over(group))
    rows = rows.withColumn("level", F.max(F.when(F.col("place") == F.col("open"), F.col("level"))).over(group))
    full = F.col("open").isNull() | (F.col("place") < F.col("open"))
    return rows.select(*parents, child, "cap", F.when(full, F.col("cap")).otherwise(F.greatest(F.lit(0.0), F.col("weight") * F.col("level"))).alias("share"))


def leaf_budgets(leaves: DataFrame, budget_share: float, max_epochs: int, weights: dict[str, dict[str, float]]) -> DataFrame:
    """Per leaf (domain, lang, source): ``tokens`` that it holds, whole ``epochs`` and ``rest`` tokens of the next one."""
    caps = leaves.withColumn("cap", F.col("tokens") * F.lit(float(max_epochs)))
    total = caps.agg((F.sum("tokens") * F.lit(budget_share)).alias("share"))
    above, budgets = [], total
    for level in LEVELS:
        nodes = caps.groupBy(*above, level).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(level, weights.get(level, {})))
        budgets = budgets.drop("cap").withColumnRenamed("share", "budget")
        nodes = nodes.join(budgets, above) if above else nodes.join(F.broadcast(budgets))  # the root: one row
        budgets = share_out(nodes, above, level)
        above.append(level)
    out = leaves.join(budgets.select(*LEVELS, "share"), LEVELS).where("tokens > 0 and share > 0")
    whole = F.floor(F.col("share") / F.col("tokens") + F.lit(1e-9)).cast("long")
    return out.select(*LEVELS, "tokens", whole.alias("epochs"), F.greatest(F.lit(0), F.floor(F.col("share") - whole * F.col("tokens") + F.lit(1e-6))).cast("long").alias("rest"))


def mixed(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    domain: Column,
    lang: Column,
    source: Column,
    weights: dict[str, dict[str, float]],
    budget_share: float = 0.6,
    max_epochs: int = 4,
    seed: int = 11,
    prefix: str = "mix_",
) -> DataFrame:
    """``docs`` with ``<prefix>domain``, ``lang``, ``source``, ``tokens`` and ``copies`` (1 or more: in how many epochs the row is taken).

    ``weights`` has one mapping per level; unnamed nodes weigh 1.  Null domains, languages and sources are nodes named
    ``none``.  Rows without tokens are left out, as they fill no budget.  Rows with the same id are taken or
    left together; a null id counts as the id ``none``.  Columns of ``docs`` keep their names; none may begin with the prefix.
    An empty table gives an empty result.
    """
    names = {c: prefix + c for c in (*LEVELS, "tokens")}
    name = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    rows = docs.select("*", name(domain).alias(names["domain"]), name(lang).alias(names["lang"]), name(source).alias(names["source"]), n_tokens(F.col(text_col).cast("string")).alias(names["tokens"]))
    own = [F.col(names[c]).alias(c) for c in LEVELS]
    key_of = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("id")).cast("binary"))
    narrow = rows.select(name(F.col(id_col)).alias("id"), *own, F.col(names["tokens"]).alias("n"))
    leaves = written(narrow.groupBy(*LEVELS).agg(F.sum("n").alias("tokens")), "leaves")
    budgets = written(leaf_budgets(leaves, budget_share, max_epochs, weights), "budgets")
    small = budgets.count() <= _BROADCAST_LEAVES

    def beside(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if small else table

    keyed = narrow.join(beside(budgets), LEVELS).withColumn("key", key_of).withColumn("first", F.substring("key", 1, 3))
    sums = keyed.groupBy(*LEVELS, "rest", "first").agg(F.sum("n").alias("n"))
    up_to = Window.partitionBy(*LEVELS).orderBy("first")
    sums = sums.withColumn("before", F.sum("n").over(up_to) - F.col("n"))
    # the first digits within which the rest runs out; with none, the prefix is the whole leaf (and rest is 0 then)
    ends = sums.where("before <= rest and before + n > rest").select(*LEVELS, "first", "before")
    ends = written(ends, "ends")
    last = keyed.join(beside(ends), [*LEVELS, "first"]).groupBy(*LEVELS, "first", "before", "rest", "key").agg(F.sum("n").alias("n"))
    last = last.withColumn("through", F.col("before") + F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("key")))
    last = last.where("through <= rest").groupBy(*LEVELS).agg(F.max("key").alias("last"))
    cuts = written(budgets.join(ends.select(*LEVELS, "first"), LEVELS, "left").join(last, LEVELS, "left").select(*LEVELS, "epochs", "first", "last"), "cuts")
    cuts = cuts.select(*[F.col(c).alias(names[c]) for c in LEVELS], F.struct("epochs", "first", "last").alias(prefix + "cut"))
    out = rows.join(beside(cuts), [names[c] for c in LEVELS])
    cut = F.col(prefix + "cut")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), cut["epochs"].cast("string"), name(F.col(id_col))).cast("binary"))
    inside = cut["first"].isNotNull() & ((F.substring(key, 1, 3) < cut["first"]) | F.coalesce(key <= cut["last"], F.lit(False)))
    copies = (cut["epochs"] + inside.cast("long")).alias(prefix + "copies")
    return out.select(*[F.col(c) for c in docs.columns], *names.values(), copies).where((F.col(prefix + "copies") > 0) & (F.col(names["tokens"]) > 0))


#: Production parameters over ``documents``: the domain is the source's number modulo 4.
WEIGHTS = {
    "domain": {"domain0": 0.4, "domain1": 0.3, "domain2": 0.2, "domain3": 0.1},
    "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2},
}


def domain_of(source: Column) -> Column:
    return F.concat(F.lit("domain"), (F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("int") % 4).cast("string"))


def mix_documents(docs: DataFrame) -> DataFrame:
    return mixed(docs, "doc_id", "text", domain_of(F.col("source")), F.col("lang"), F.col("source"), WEIGHTS)


def op7_source_mix(spark, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes, and how often."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = mix_documents(docs.select("doc_id", "text", "lang", "source"))
    return out.select("doc_id", *[F.col(f"mix_{c}").alias(c) for c in LEVELS], F.col("mix_tokens").alias("n_tokens"), F.col("mix_copies").alias("copies"))


def _level_sql(level: str, above: list[str], table: str, weight: str) -> str:
    keys = ", ".join(above)
    part = f"PARTITION BY {keys}" if above else ""
    join = f"JOIN {table} USING ({keys})" if above else f"CROSS JOIN {table}"
    cols = ", ".join([*above, level])
    return f"""
{level}_nodes AS (SELECT {cols}, sum(tokens) * 4.0::DOUBLE AS cap, max({weight}) AS weight FROM leaves GROUP BY {cols}),
{level}_levels AS (
  SELECT n.*, share AS budget, n.cap / n.weight AS ratio,
    (share - coalesce(sum(n.cap) OVER ({part} ORDER BY n.cap / n.weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(n.weight) OVER ({part} ORDER BY n.cap / n.weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev,
    row_number() OVER ({part} ORDER BY n.cap / n.weight, {level}) AS place
  FROM {level}_nodes n {join}),
{level}_open AS (SELECT *, min(CASE WHEN lev < ratio THEN place END) OVER ({part}) AS op FROM {level}_levels),
{level}_share AS (
  SELECT {cols}, CASE WHEN op IS NULL OR place < op THEN cap
    ELSE greatest(0.0, weight * max(CASE WHEN place = op THEN lev END) OVER ({part})) END AS share
  FROM {level}_open),"""


ORACLE_SQL = (
    r"""WITH d AS (
  SELECT doc_id, coalesce('domain' || (TRY_CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS INT) % 4)::VARCHAR, 'none') AS domain,
    coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n)::BIGINT AS tokens FROM d GROUP BY ALL),
root AS (SELECT sum(tokens) * 0.6::DOUBLE AS share FROM leaves),"""
    + _level_sql("domain", [], "root", "CASE domain WHEN 'domain0' THEN 0.4::DOUBLE WHEN 'domain1' THEN 0.3 WHEN 'domain2' THEN 0.2 WHEN 'domain3' THEN 0.1 ELSE 1.0 END")
    + _level_sql("lang", ["domain"], "domain_share", "CASE lang WHEN 'en' THEN 0.4::DOUBLE WHEN 'de' THEN 0.2 WHEN 'fr' THEN 0.2 WHEN 'es' THEN 0.2 ELSE 1.0 END")
    + _level_sql("source", ["domain", "lang"], "lang_share", "1.0::DOUBLE")
    + """
budgets AS (
  SELECT *, greatest(0, floor(share - epochs * tokens + 1e-6))::BIGINT AS rest FROM (
    SELECT l.*, share, floor(share / tokens + 1e-9)::BIGINT AS epochs FROM leaves l JOIN source_share USING (domain, lang, source) WHERE tokens > 0 AND share > 0)),
k AS (SELECT d.*, epochs, rest, md5('11:' || epochs::VARCHAR || ':' || coalesce(doc_id::VARCHAR, 'none')) AS key FROM d JOIN budgets USING (domain, lang, source)),
s AS (SELECT *, sum(n) OVER (PARTITION BY domain, lang, source ORDER BY key) AS through FROM k)
SELECT doc_id, domain, lang, source, n AS n_tokens, epochs + (through <= rest)::INT AS copies
FROM s WHERE n > 0 AND epochs + (through <= rest)::INT > 0"""
)
