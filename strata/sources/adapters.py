"""Map the driver's star-schema tables onto the retail Bronze schema.

The rules are deterministic column expressions, so the DuckDB oracle can state the same
mapping in SQL.  Messy casing and padding are added on purpose, so the Silver cleaners have
work to do.  Every adapter is a lazy projection over one parquet scan; Catalyst prunes the
columns a query does not use and pushes its filters into the scan.

Every adapter keeps every row of its table.  Scenario choices (ours, not the reference's),
all driven by attributes of the data:
* upsert: Bronze ``orders`` as of 2000-01-01 (orders placed before it) receives a batch of
  the orders placed since (inserts) plus the delivery of every order that was still open
  (status ``O``) before the cutoff (updates, one day after the order date);
* SCD extracts: run 2 moves the customers of segment ``MACHINERY`` to a new city, deletes
  the customers with a negative balance, reprices parts of size <= 10 by +10.00, discontinues
  parts of size 20 (a soft delete: a flag flip, SCD-4) and changes only the stock of ``PROMO``
  parts (no new version); run 3 restores the run-1 extract (A -> B -> A, and deleted keys
  come back).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.tables import hadoop_path

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# The as-of instants of the three snapshot runs, and the "today" of the LTV recency.
SNAPSHOT_RUNS = ("1996-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00")
LTV_AS_OF = "2001-08-02"
INCREMENTAL_SINCE = "2000-01-01 00:00:00"
UPSERT_CUTOFF = "2000-01-01 00:00:00"
MOVED_SEGMENT = "MACHINERY"
REPRICED_MAX_SIZE = 10
DISCONTINUED_SIZE = 20
STOCK_ONLY_TYPE = "PROMO"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table ``name`` (read-only), listed anew each time."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts_ntz(value: str | _dt.datetime) -> Column:
    """A zone-free timestamp literal (the driver tables store timestamp_ntz)."""
    return F.lit(str(value)).cast("timestamp_ntz")


def _pad(col: Column, left: str = "", right: str = "") -> Column:
    return F.concat(F.lit(left), col, F.lit(right))


def _run_column(run: int | Sequence[int]) -> Column:
    """The number of an extract: one, or a row for each of several (one scan for all)."""
    return F.lit(run) if isinstance(run, int) else F.explode(F.array(*[F.lit(r) for r in run]))


def _customer_rows(spark: SparkSession, sf_dir: str, run: int | Sequence[int]) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
    key = F.col("c_custkey")
    signup = F.date_add(F.lit("1990-01-01").cast("date"), (key % 1000).cast("int")).cast("timestamp_ntz")
    moved = (F.col("_run") == 2) & (F.col("c_mktsegment") == MOVED_SEGMENT)
    # in run 2 accounts in debt (is_active false) were closed: absent from that full extract
    there = (F.col("_run") != 2) | F.coalesce(F.col("is_active"), F.lit(True))
    return j.select("*", _run_column(run).alias("_run")).select(
        "_run",
        key.alias("customer_id"),
        _pad(F.upper("c_name"), "  ", " ").alias("first_name"),
        _pad(F.col("c_mktsegment"), "", "  ").alias("last_name"),
        F.concat(F.col("c_name"), F.lit("@EXAMPLE.COM")).alias("email"),
        F.when(key % 9 == 0, F.lit(None).cast("string"))
        .otherwise(F.lpad(key.cast("string"), 10, "0"))
        .alias("phone"),
        F.concat(key.cast("string"), F.lit(" Main St")).alias("address_line"),
        F.when(moved, F.concat(F.col("n_name"), F.lit(" NEW"))).otherwise(F.col("n_name")).alias("city"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("country"),
        F.when(F.col("c_nationkey") % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.lpad(F.col("c_nationkey").cast("string"), 5, "0"))
        .alias("postal_code"),
        signup.alias("signup_date"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        signup.alias("created_at"),
        signup.alias("updated_at"),
    ).filter(there)


def customers(spark: SparkSession, sf_dir: str, run: int = 1) -> DataFrame:
    """Bronze ``customers``; ``run`` selects the SCD extract (1, 2 or 3; 3 equals 1)."""
    return _customer_rows(spark, sf_dir, run).drop("_run")


def customers_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All SCD extracts of customers, with the number of each (``_run``)."""
    return _customer_rows(spark, sf_dir, range(1, len(SNAPSHOT_RUNS) + 1))


def _delivered_again(df: DataFrame, key: str, changes: dict[str, Column], only_again: bool = False) -> DataFrame:
    """``df`` and, one day later, a changed second delivery of every row whose key is 3 modulo 7 (or those alone)."""
    twice = F.when(F.col(key) % 7 == 3, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = df.filter(F.col(key) % 7 == 3).withColumn("_again", F.lit(True)) if only_again else df.withColumn("_again", F.explode(twice))  # one scan
    changes = {"updated_at": F.col("updated_at") + F.expr("INTERVAL 1 DAY"), **changes}
    return rows.withColumns({c: F.when(F.col("_again"), new).otherwise(F.col(c)) for c, new in changes.items()}).drop("_again")


def customers_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with second deliveries; half of those lost the email (the latest row is the invalid one)."""
    lost = F.when(F.col("customer_id") % 14 != 3, F.col("email"))
    return _delivered_again(customers(spark, sf_dir), "customer_id", {"email": lost, "city": F.lower("city")})


def products_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with second deliveries; half of those have a negative price."""
    price = F.when(F.col("product_id") % 14 == 3, F.lit(-1)).otherwise(F.col("price") + 1).cast("decimal(10,2)")
    return _delivered_again(products(spark, sf_dir), "product_id", {"price": price})


def orders_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with second deliveries; some of those lost the amount or the status, some name no known customer."""
    return _orders_delivered(spark, sf_dir, False)


def orders_delivered_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second deliveries alone."""
    return _orders_delivered(spark, sf_dir, True)


def _orders_delivered(spark: SparkSession, sf_dir: str, only_again: bool) -> DataFrame:
    k = F.col("order_id")
    return _delivered_again(
        orders(spark, sf_dir),
        "order_id",
        {
            "total_amount": F.when(k % 14 != 3, F.col("total_amount")),
            "status": F.when(k % 21 != 10, F.col("status")),
            "customer_id": F.when(k % 35 == 24, -F.col("customer_id")).otherwise(F.col("customer_id")),
        },
        only_again,
    )


def _product_rows(spark: SparkSession, sf_dir: str, run: int | Sequence[int]) -> DataFrame:
    p = read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    second = F.col("_run") == 2
    price = F.col("p_retailprice").cast("decimal(10,2)")
    stock = (F.col("p_size") * 3 - 20).cast("int")
    repriced = second & (F.col("p_size") <= REPRICED_MAX_SIZE)
    stamp = ts_ntz("1995-01-01 00:00:00")
    return p.select("*", _run_column(run).alias("_run")).select(
        "_run",
        key.alias("product_id"),
        _pad(F.col("p_name"), "", " ").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_size") % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lower("p_type"), F.lit("_DEPT ")))
        .alias("sub_category"),
        F.col("p_brand").alias("brand"),
        F.when(repriced, (price + F.lit(10).cast("decimal(10,2)")).cast("decimal(10,2)")).otherwise(price).alias("price"),
        F.when(second & (F.col("p_type") == STOCK_ONLY_TYPE), stock + 7).otherwise(stock).alias("stock_qty"),
        ((F.col("p_size") > 45) | (second & (F.col("p_size") == DISCONTINUED_SIZE))).alias("is_discontinued"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def products(spark: SparkSession, sf_dir: str, run: int = 1) -> DataFrame:
    """Bronze ``products``; ``run`` selects the SCD extract (1, 2 or 3; 3 equals 1)."""
    return _product_rows(spark, sf_dir, run).drop("_run")


def products_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All SCD extracts of products, with the number of each (``_run``)."""
    return _product_rows(spark, sf_dir, range(1, len(SNAPSHOT_RUNS) + 1))


def _order_columns(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(" cancelled "))
        .when(F.col("o_orderstatus") == "F", F.lit("Delivered"))
        .when(F.col("o_orderstatus") == "O", F.lit("shipped"))
        .otherwise(F.lit("PENDING"))
    )
    city = (
        F.when(k % 3 == 0, F.lit(" san francisco"))
        .when(k % 3 == 1, F.lit("NEW YORK "))
        .otherwise(F.lit(None).cast("string"))
    )
    return o.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        status.alias("status"),
        city.alias("shipping_city"),
        F.lit("US").alias("shipping_country"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ``orders``: every order."""
    return _order_columns(read(spark, sf_dir, "orders"))


def orders_before(spark: SparkSession, sf_dir: str, cutoff: str = UPSERT_CUTOFF) -> DataFrame:
    """Bronze ``orders`` as a previous run left it: the orders placed before ``cutoff``."""
    o = read(spark, sf_dir, "orders")
    return _order_columns(o.filter(F.col("o_orderdate") < ts_ntz(cutoff)))


def orders_batch_since(spark: SparkSession, sf_dir: str, cutoff: str = UPSERT_CUTOFF) -> DataFrame:
    """The incremental batch after ``cutoff``: orders placed since (inserts) and the delivery of
    every earlier order that was still open (updates, one day after the order date)."""
    o = read(spark, sf_dir, "orders")
    cut = ts_ntz(cutoff)
    new = _order_columns(o.filter(F.col("o_orderdate") >= cut))
    delivered = _order_columns(o.filter((F.col("o_orderdate") < cut) & (F.col("o_orderstatus") == "O"))).withColumns(
        {"status": F.lit("DELIVERED"), "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 DAY")}
    )
    return new.unionByName(delivered)


def orders_rescheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch: every order whose key is 5 modulo 11 is taken up again 40 days on (another creation month), twice
    in one batch; the second row of each is the later one."""
    again = F.explode(F.array(F.lit(1), F.lit(2))).alias("_time")
    o = orders(spark, sf_dir).filter(F.col("order_id") % 11 == 5).select("*", again)
    later = F.expr("INTERVAL 40 DAYS")
    return o.withColumns(
        {
            "status": F.when(F.col("_time") == 2, F.lit("pending")).otherwise(F.lit("confirmed")),
            "created_at": F.col("created_at") + later,
            "updated_at": F.col("updated_at") + later + F.make_interval(hours=F.col("_time")),
        }
    ).drop("_time")


def _line() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ``order_items``, one per line item; ``order_item_id`` repeats in this data (a real
    finding of the unique test on the raw source)."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        # some lines are void (quantity 0) or reversed (negative price)
        F.when(_line() % 50 == 7, 0).otherwise(F.col("l_quantity")).cast("int").alias("quantity"),
        F.when(_line() % 50 == 12, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).cast("decimal(10,2)").alias("unit_price"),
        F.col("l_shipdate").alias("created_at"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ``payments``; ``payment_id`` repeats (several attempts per id), a natural dedup input."""
    li = read(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    method = (
        F.when(n % 4 == 0, F.lit("card"))
        .when(n % 4 == 1, F.lit(" UPI"))
        .when(n % 4 == 2, F.lit("NetBanking "))
        .otherwise(F.lit("COD"))
    )
    status = (
        F.when(F.col("l_returnflag") == "R", F.lit("failed"))
        .when(F.col("l_returnflag") == "A", F.lit("SUCCESS"))
        .otherwise(F.lit("initiated"))
    )
    return li.select(
        (F.col("l_orderkey") * 10 + n).alias("payment_id"),
        F.col("l_orderkey").alias("order_id"),
        F.when(_line() % 50 == 3, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).cast("decimal(12,2)").alias("amount"),
        method.alias("method"),
        status.alias("status"),
        F.col("l_shipdate").alias("paid_at"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
    )


def clickstream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ``clickstream_events`` (already decoded): one session per user and day."""
    e = read(spark, sf_dir, "events")
    t = F.col("event_type")
    etype = (
        F.when(t == "view", F.lit("PAGE_VIEW"))
        .when(t == "click", F.lit("product_view"))
        .when(t == "signup", F.lit("add_to_cart"))
        .when(t == "purchase", F.lit("checkout_start"))
        .when(t == "error", F.lit("search"))
        .otherwise(t)
    )
    eid = F.col("event_id")
    device = (
        F.when(eid % 4 == 0, F.lit("DESKTOP"))
        .when(eid % 4 == 1, F.lit("iPhone 15"))
        .when(eid % 4 == 2, F.lit(" Tablet "))
        .otherwise(F.lit(None).cast("string"))
    )
    k = F.get_json_object("props", "$.k")
    return e.select(
        eid.cast("string").alias("event_id"),
        etype.alias("event_type"),
        F.when(eid % 40 != 11, F.col("ts")).alias("event_time"),  # the others could not be parsed
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string")).alias("session_id"),
        F.when(F.col("user_id") % 5 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("customer_id"),
        device.alias("device"),
        F.concat(F.lit("/p/"), k).alias("page_url"),
        F.lit(None).cast("string").alias("referrer"),
        F.lit(None).cast("string").alias("user_agent"),
        F.lit(None).cast("string").alias("ip_address"),
        k.cast("int").alias("product_id"),
        F.lit(None).cast("int").alias("quantity"),
        F.lit(None).cast("string").alias("search_term"),
        F.col("value").alias("cart_value"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker-like messages (``value`` JSON string, ``timestamp``) built from ``events``.

    Event times are written in the formats a producer emits: ISO with offset, slash format,
    ISO without offset, and epoch milliseconds (which strict decoding cannot read, L13).  Ints
    sometimes arrive as strings and the cart value sometimes carries a ``$`` (L12); every
    20th message carries an extra unknown key.
    """
    return messages_of(read(spark, sf_dir, "events"))


def event_message_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """The same messages as a stream over the files of ``events``, so many files a micro-batch."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    reader = spark.readStream.schema(read(spark, sf_dir, "events").schema).option("maxFilesPerTrigger", str(files_per_trigger))
    fs, location = hadoop_path(spark, path)
    if fs.getFileStatus(location).isDirectory():
        return messages_of(reader.parquet(path))
    # a file stream reads a folder: the one that holds the table's only file
    return messages_of(reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir))


def broken_message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream with messages that are no event: of every 23 one is cut off, one is a text and one has no id."""
    no = F.get_json_object("value", "$.event_id").cast("long") % 23
    broken = (
        F.when(no == 4, F.substring("value", 1, 12))
        .when(no == 9, F.lit('"a text"'))
        .when(no == 14, F.lit('{"event_type":"SEARCH"}'))
        .otherwise(F.col("value"))
    )
    return event_message_stream(spark, sf_dir).withColumn("value", broken)


def messages_of(e: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    ts = F.col("ts")
    event_time = (
        F.when(eid % 4 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
        .when(eid % 4 == 1, F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
        .when(eid % 4 == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.floor(F.unix_micros(ts.cast("timestamp")) / 1000).cast("bigint").cast("string"))
    )
    k = F.get_json_object("props", "$.k")
    uid = F.col("user_id")
    # string fields through to_json (escaping, explicit nulls); the numeric fields are appended
    # as JSON literals, with the drift applied, and "null" when the source value is missing
    strings = F.to_json(
        F.struct(
            eid.cast("string").alias("event_id"),
            F.upper(F.col("event_type")).alias("event_type"),
            event_time.alias("event_time"),
            F.concat(uid.cast("string"), F.lit("-"), F.to_date(ts).cast("string")).alias("session_id"),
        ),
        {"ignoreNullFields": "false"},
    )
    cust = F.when(uid % 5 == 0, F.lit("null")).when(uid % 7 == 0, F.concat(F.lit('"'), uid.cast("string"), F.lit('"')))
    cust = F.coalesce(cust.otherwise(uid.cast("string")), F.lit("null"))
    cart = F.when(eid % 10 == 3, F.concat(F.lit('"$'), F.col("value").cast("string"), F.lit('"')))
    cart = F.coalesce(cart.otherwise(F.col("value").cast("string")), F.lit("null"))
    parts = [
        strings.substr(F.lit(1), F.length(strings) - 1),
        F.lit(',"customer_id":'), cust,
        F.lit(',"product_id":'), F.coalesce(k, F.lit("null")),
        F.lit(',"cart_value":'), cart,
        F.when(eid % 20 == 7, F.lit(',"_meta_source_version":"v2"')).otherwise(F.lit("")),
        F.lit("}"),
    ]
    return e.select(F.concat(*parts).alias("value"), ts.alias("timestamp"))
