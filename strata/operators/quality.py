"""Declarative data tests (DQ-1..DQ-6) as distributed aggregates.

Failure counts follow the reference's test runner: ``unique`` counts duplicated *values*
(NULLs ignored), ``not_null`` counts NULL rows, ``accepted_values`` counts distinct offending
values (NULL passes).  All tests declared on one table share a single pass over it, and all tables two shuffles.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("test_name", T.StringType(), False),
        T.StructField("model", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("failures", T.LongType(), False),
        T.StructField("status", T.StringType(), False),
    ]
)


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """Values occurring more than once (DQ-1): ``(value, n_records)``; partial counts map-side."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def not_null_violations(df: DataFrame, col: str) -> DataFrame:
    """Rows where the column is NULL (DQ-2)."""
    return df.filter(F.col(col).isNull())


def accepted_values_violations(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the accepted list, with their counts (DQ-3); NULL passes."""
    return (
        df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def foreign_key_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child key values with no parent row (DQ-4), with the number of child rows each.

    The child is first reduced to one row per key value (partial aggregation, so a hot key
    collapses map-side); the anti-join is then between two inputs unique on the key.
    """
    keys = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("child_rows"))
    parents = parent.select(F.col(pk).alias("_pk"))
    return keys.join(parents, F.col(fk) == F.col("_pk"), "left_anti")


@dataclass
class TableRules:
    """The tests declared for one table (one entry of a schema file)."""

    model: str
    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    accepted_values: dict[str, Sequence[str]] = field(default_factory=dict)


def _status(failures):
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail"))


def declared_tests(rules: TableRules) -> list[tuple[str, str]]:
    """(test, column) of every test declared for one table, in the order of the report."""
    return [("not_null", c) for c in rules.not_null] + [("accepted_values", c) for c in rules.accepted_values] + [("unique", c) for c in rules.unique]


def _findings(df: DataFrame, rules: TableRules, tests: Sequence[tuple[str, str]], number: dict[tuple[str, str, str], int]) -> DataFrame:
    """(test, value) rows that the counts of one table's tests need: every value of a unique column, and only the offending
    rows of the others.  One pass over the table, however many tests it has."""

    def entry(name: str, c: str, when: Column | None, value: Column) -> Column:
        own = F.struct(F.lit(number[name, rules.model, c]).alias("test"), value.alias("value"))
        return own if when is None else F.when(when, own)

    entries = []
    for name, c in tests:
        col = F.col(c)
        if name == "unique":
            entries.append(entry(name, c, col.isNotNull(), col.cast("string")))
        elif name == "not_null":
            entries.append(entry(name, c, col.isNull(), F.lit(None).cast("string")))
        else:
            entries.append(entry(name, c, col.isNotNull() & ~col.isin(*rules.accepted_values[c]), col.cast("string")))
    if len(entries) == 1:
        return df.select(entries[0].alias("e")).filter("e is not null").select("e.test", "e.value")
    found = df.select(F.explode(F.array(*entries)).alias("e")).filter("e is not null")
    return found.select("e.test", "e.value")


def run_table_checks(df: DataFrame, rules: TableRules) -> DataFrame:
    """Report rows (REPORT_SCHEMA) for every test declared on one table, in **one pass** over it."""
    return run_checks({rules.model: df}, [rules])


def spark_of(tables: dict[str, DataFrame]) -> SparkSession:
    return next((t.sparkSession for t in tables.values()), None) or SparkSession.active()


def run_checks(tables: dict[str, DataFrame], rules: Iterable[TableRules], known: dict[str, dict[tuple[str, str], int]] | None = None) -> DataFrame:
    """Test-run report (DQ-5): one row per declared test, over all tables; a test of an absent table fails.

    Each table is read once and turned into (test, value) rows; two aggregates over all of them together, by (test, value)
    and by test, give every failure count.  Partial counts make one row of a hot value per map task.  Values are compared as
    text, which keeps different ones of a column apart.  ``known`` has failure counts per table and (test, column) that
    need no read (``sinks.metrics``); a table with nothing left to test is not read at all.
    """
    rules = list(rules)
    declared = [(name, r.model, c) for r in rules for name, c in declared_tests(r)]
    if not declared:
        raise ValueError("no rules" if not rules else f"no tests declared for {rules[0].model}")
    number = {test: i for i, test in enumerate(declared)}
    spark = spark_of(tables)
    told = {(name, r.model, c): n for r in rules for (name, c), n in (known or {}).get(r.model, {}).items()}
    told |= {test: 1 for test in declared if test[1] not in tables}  # one failure: the table

    parts = []
    for r in rules:
        left = [(name, c) for name, c in declared_tests(r) if (name, r.model, c) not in told]
        if r.model in tables and left:
            parts.append(_findings(tables[r.model], r, left, number))
    # every declared test has a row of its own, with what is told of it: a test without findings is there too
    seeds = spark.range(1, numPartitions=1).select(
        F.inline(F.array(*[F.struct(F.lit(number[t]).alias("test"), F.lit(told.get(t, 0)).cast("long").alias("told")) for t in declared]))
    )
    out = seeds.select("test", "told", F.lit(0).cast("long").alias("n"))
    if parts:
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        counts = every.groupBy("test", "value").agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(counts.select("test", F.lit(0).cast("long").alias("told"), "n"))
    # sums of numbers alone: with names among them Spark would sort all values by test
    by_test = out.groupBy("test").agg(
        F.count_if(F.col("n") > 1).alias("repeated"), F.sum("n").alias("rows"), F.count_if(F.col("n") > 0).alias("values"), F.sum("told").alias("told")
    )
    names = F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(t, ("test_name", "model", "column_name"), strict=True)]) for t in declared])
    by_test = by_test.withColumn("t", F.get(names, F.col("test")))
    kind = F.col("t.test_name")
    found = F.when(kind == "unique", F.col("repeated")).when(kind == "not_null", F.col("rows")).otherwise(F.col("values"))
    failures = (found + F.col("told")).cast("long")
    return by_test.select("t.test_name", "t.model", "t.column_name", failures.alias("failures"), _status(failures).alias("status"))


def run_relationships(tables: dict[str, DataFrame], keys: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """Report rows for foreign keys (child, column, parent, column): key values without a parent (DQ-4).  A
    relationship of an absent table fails."""
    out = None
    for child, fk, parent, pk in keys:
        if child in tables and parent in tables:
            failures = foreign_key_violations(tables[child], fk, tables[parent], pk).agg(F.count(F.lit(1)).alias("failures"))
        else:
            failures = spark_of(tables).range(1).select(F.lit(1).cast("long").alias("failures"))
        part = failures.select(
            F.lit("relationships").alias("test_name"), F.lit(child).alias("model"), F.lit(fk).alias("column_name"),
            "failures", _status(F.col("failures")).alias("status"),
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no relationships")
    return out


def row_counts(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table (DQ-6 / RPT-2) as one DataFrame: a union of global counts."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    return out


# The foreign keys of the source schema.
FOREIGN_KEYS = (
    ("bronze.orders", "customer_id", "bronze.customers", "customer_id"),
    ("bronze.order_items", "order_id", "bronze.orders", "order_id"),
    ("bronze.order_items", "product_id", "bronze.products", "product_id"),
    ("bronze.payments", "order_id", "bronze.orders", "order_id"),
)

# The tests declared by the reference's schema files (39 tests).
ORDER_STATUSES = ("PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED")
PAYMENT_STATUSES = ("INITIATED", "SUCCESS", "FAILED", "REFUNDED")
EVENT_TYPES = ("page_view", "product_view", "search", "add_to_cart", "remove_from_cart", "checkout_start")

SOURCE_RULES = (
    TableRules("bronze.customers", unique=["customer_id"], not_null=["customer_id"]),
    TableRules("bronze.products", unique=["product_id"], not_null=["product_id"]),
    TableRules("bronze.orders", unique=["order_id"], not_null=["order_id", "customer_id"]),
    TableRules("bronze.order_items", unique=["order_item_id"], not_null=["order_item_id"]),
    TableRules("bronze.payments", unique=["payment_id"], not_null=["payment_id"]),
    TableRules("bronze.clickstream_events", unique=["event_id"], not_null=["event_id"]),
)
SILVER_RULES = (
    TableRules("silver_customers", unique=["customer_id", "email"], not_null=["customer_id", "email"]),
    TableRules("silver_products", unique=["product_id"], not_null=["product_id"]),
    TableRules(
        "silver_orders",
        unique=["order_id"],
        not_null=["order_id", "customer_id"],
        accepted_values={"status": ORDER_STATUSES},
    ),
    TableRules("silver_order_items", unique=["order_item_id"], not_null=["order_item_id"]),
    TableRules(
        "silver_payments",
        unique=["payment_id"],
        not_null=["payment_id"],
        accepted_values={"status": PAYMENT_STATUSES},
    ),
    TableRules(
        "silver_clickstream_sessions",
        unique=["event_id"],
        not_null=["event_id"],
        accepted_values={"event_type": EVENT_TYPES},
    ),
)
GOLD_RULES = (
    TableRules("gold_daily_sales_summary", unique=["order_day"], not_null=["order_day"]),
    TableRules("gold_customer_ltv", unique=["customer_id"], not_null=["customer_id"]),
)
SNAPSHOT_RULES = (
    TableRules("customers_snapshot", unique=["dbt_scd_id"], not_null=["dbt_scd_id"]),
    TableRules("products_snapshot", unique=["dbt_scd_id"], not_null=["dbt_scd_id"]),
)
ALL_RULES = SOURCE_RULES + SILVER_RULES + GOLD_RULES + SNAPSHOT_RULES
