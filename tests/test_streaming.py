"""STR-1..8 decode and stream ingest, SRC-2/3 Kafka options; ledger L12/L13/L28."""

import os

from conftest import ts
from pyspark.sql import functions as F

from strata.streaming.decode import decode_events
from strata.streaming.ingest import MESSAGE_SCHEMA, file_stream, ingest_stream
from strata.streaming.kafka import kafka_options, namespace_host

MSGS = [
    '{"event_id":"e1","event_type":"PAGE_VIEW","event_time":"2024-05-01T10:00:00.250+00:00","session_id":"s",'
    '"customer_id":102,"product_id":5,"quantity":2,"cart_value":149.99}',
    '{"event_id":"e2","event_type":"add_to_cart","event_time":"2024/05/01 10:00:05","session_id":"s",'
    '"customer_id":"102","product_id":"5","quantity":2.0,"cart_value":"$149.99","_meta_source_version":"v2"}',
    '{"event_id":"e3","event_type":"search","event_time":"2024-05-01T10:00:09","session_id":"s","customer_id":null}',
    '{"event_id":"e4","event_type":"search","event_time":"1714557609000","session_id":"s"}',
    "not json at all",
    '{"event_id":"e6","event_type":"x",',
    "",
]


def raw(spark, values=MSGS):
    t = ts("2024-05-01 10:00:10")
    return spark.createDataFrame([(v, t) for v in values], "value string, timestamp timestamp")


def test_strict_decode_reproduces_silent_nulls(spark):
    out = {r.event_id: r for r in decode_events(raw(spark)).collect()}
    e1, e2, e3, e4 = out["e1"], out["e2"], out["e3"], out["e4"]
    assert e1.event_time == ts("2024-05-01 10:00:00.250") and e1.customer_id == 102 and e1.cart_value == 149.99
    assert e2.event_time == ts("2024-05-01 10:00:05")  # slash pattern
    assert (e2.customer_id, e2.product_id, e2.quantity, e2.cart_value) == (None, None, None, None)  # L12
    assert e2.session_id == "s" and e2.event_type == "add_to_cart"  # other fields survive
    assert e3.event_time == ts("2024-05-01 10:00:09")  # ISO without offset
    assert e4.event_time is None  # L13: epoch milliseconds unreadable in strict mode
    assert out[None].event_type is None  # malformed messages give all-NULL rows
    assert {r._source_system for r in out.values()} == {"eventhub_clickstream"}


def test_lenient_decode_repairs_drift(spark):
    out = {r.event_id: r for r in decode_events(raw(spark), mode="lenient").collect() if r.event_id}
    e2, e4 = out["e2"], out["e4"]
    assert (e2.customer_id, e2.product_id, e2.quantity, e2.cart_value) == (102, 5, 2, 149.99)
    assert e4.event_time == ts("2024-05-01 10:00:09")
    assert out["e3"].customer_id is None
    corrupt = decode_events(raw(spark), mode="lenient").filter(F.col("_corrupt_record").isNotNull()).count()
    assert corrupt >= 2


def test_kafka_options_src3():
    cs = "Endpoint=sb://ns.example.net/;SharedAccessKeyName=k;SharedAccessKey=s"
    assert namespace_host(cs) == "ns.example.net"
    o = kafka_options(cs, "clicks")
    assert o["kafka.bootstrap.servers"] == "ns.example.net:9093"
    assert o["subscribe"] == "clicks" and o["startingOffsets"] == "earliest" and o["failOnDataLoss"] == "false"
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="$ConnectionString"' in o["kafka.sasl.jaas.config"]
    assert "maxOffsetsPerTrigger" not in o
    assert kafka_options(cs, "clicks", max_offsets_per_trigger=1000)["maxOffsetsPerTrigger"] == "1000"


def test_available_now_drains_in_bounded_batches(spark, tmp_root):
    src, sink, ckpt = (os.path.join(tmp_root, p) for p in ("src", "sink", "ckpt"))
    for i in range(3):
        _write_batch(spark, src, MSGS[i : i + 1])
    batches = ingest_stream(file_stream(spark, src, max_files_per_trigger=1), ckpt, path=sink)
    assert batches >= 3 and spark.read.parquet(sink).count() == 3


def _write_batch(spark, folder, values):
    t = ts("2024-05-01 10:00:10")
    spark.createDataFrame([(v, t) for v in values], MESSAGE_SCHEMA).write.mode("append").parquet(folder)


def test_available_now_checkpointed_reruns(spark, tmp_root):
    src, sink, ckpt = (os.path.join(tmp_root, p) for p in ("src", "sink", "ckpt"))
    _write_batch(spark, src, MSGS[:2])
    ingest_stream(file_stream(spark, src), ckpt, path=sink)
    assert spark.read.parquet(sink).count() == 2
    ingest_stream(file_stream(spark, src), ckpt, path=sink)  # STR-6: nothing new -> +0
    assert spark.read.parquet(sink).count() == 2
    _write_batch(spark, src, MSGS[2:4])  # a new file adds only its own rows
    ingest_stream(file_stream(spark, src), ckpt, path=sink)
    assert spark.read.parquet(sink).count() == 4
    # STR-8: a new checkpoint replays everything (into a fresh sink: a file sink's own commit log
    # would skip batch ids it has already committed)
    ingest_stream(file_stream(spark, src), ckpt + "-replay", path=sink + "-replay")
    assert spark.read.parquet(sink + "-replay").count() == 4


def test_files_per_batch_caps_output_files(spark, tmp_root):
    import glob

    src, sink, ckpt = (os.path.join(tmp_root, p) for p in ("src", "sink", "ckpt"))
    for i in range(4):
        _write_batch(spark, src, MSGS[i : i + 1])
    ingest_stream(file_stream(spark, src), ckpt, path=sink, files_per_batch=1)
    assert spark.read.parquet(sink).count() == 4 and len(glob.glob(f"{sink}/*.parquet")) == 1


def test_dedup_within_watermark_l28(spark, tmp_root):
    src, sink, ckpt = (os.path.join(tmp_root, p) for p in ("src", "sink", "ckpt"))
    _write_batch(spark, src, [MSGS[0], MSGS[0], MSGS[2]])
    ingest_stream(file_stream(spark, src), ckpt, path=sink, dedup_within="1 hour")
    assert sorted(r.event_id for r in spark.read.parquet(sink).collect()) == ["e1", "e3"]


def test_drift_report_counts_lost_and_repaired(spark):
    from strata.streaming.decode import drift_report

    got = {r.field: (r.lost_strict, r.repaired, r.unreadable) for r in drift_report(raw(spark)).collect()}
    assert got["customer_id"] == (1, 1, 0)  # "102" lost by strict, repaired by lenient
    assert got["cart_value"] == (1, 1, 0)  # "$149.99"
    assert got["quantity"] == (1, 1, 0)  # 2.0
    assert got["event_time"] == (1, 1, 0)  # epoch milliseconds
    assert got["<message>"][0] == 3  # not JSON, truncated JSON, empty
