"""STR-2, STR-4, STR-6, SNK-5: every message in one of two tables, each batch once and whole."""

import json
import os
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_streaming import MSGS, _write_batch, raw

from strata.streaming import batches as B
from strata.streaming.decode import NO_ID, NOT_AN_OBJECT, NOT_JSON, decode_all, decode_events
from strata.streaming.ingest import file_stream


@pytest.fixture()
def place(spark, tmp_root):
    db = f"e{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    src, ckpt, root = (os.path.join(tmp_root, p) for p in ("src", "ckpt", "table"))
    return src, ckpt, f"{db}.events", root


ODD = ['"text"', "[1, 2]", "null", "7", '{"event_type":"x","extra":{"a":[1,{"b":2.5}]}}', '{"event_id":null}', None, '{"event_id":"u1","more":{"deep":[1,"2",null]},"n":12.50,"event_type":"search"}', "{'event_id':'q'}"]


def test_each_message_is_an_event_or_a_dead_letter(spark):
    values = MSGS + ODD
    out = decode_all(raw(spark, values)).collect()
    assert len(out) == len(values)
    dead = {r.json_value: r._reason for r in out if r._reason}
    assert dead == {"not json at all": NOT_JSON, '{"event_id":"e6","event_type":"x",': NOT_JSON, "": NOT_JSON, None: NOT_JSON, '"text"': NOT_AN_OBJECT, "[1, 2]": NOT_AN_OBJECT, "null": NOT_AN_OBJECT, "7": NOT_AN_OBJECT, ODD[4]: NO_ID, ODD[5]: NO_ID} | ({ODD[8]: dead[ODD[8]]} if ODD[8] in dead else {})
    events = {r.event_id: r for r in out if not r._reason}
    assert {"e1", "e2", "e3", "e4", "u1"} <= set(events)
    assert all(r.event_id is not None for r in events.values())


def test_unknown_keys_keep_value_and_type(spark):
    got = {r.event_id: r.u for r in decode_all(raw(spark, MSGS + ODD)).filter("_reason is null").select("event_id", F.to_json("_unknown").alias("u")).collect()}
    assert got["e1"] is None and got["e3"] is None
    assert json.loads(got["e2"]) == {"_meta_source_version": "v2"}
    assert json.loads(got["u1"]) == {"more": {"deep": [1, "2", None]}, "n": 12.5}
    typed = decode_all(raw(spark, ODD)).filter("event_id = 'u1'").select(F.try_variant_get("_unknown", "$.more.deep[0]", "int").alias("x"), F.schema_of_variant("_unknown").alias("s")).first()
    assert typed.x == 1 and "more" in typed.s


@pytest.mark.parametrize("mode", ["strict", "lenient"])
def test_events_are_decoded_as_before(spark, mode):
    known = decode_events(raw(spark), mode).drop("_ingested_at").filter("event_id is not null")
    whole = decode_all(raw(spark), mode).filter("_reason is null").select(*known.columns)
    assert rows(whole) == rows(known)


def drained(spark, place, **more):
    src, ckpt, name, root = place
    return B.ingest_batches(file_stream(spark, src, max_files_per_trigger=1), more.pop("ckpt", ckpt), name, root, **more)


def counts(spark, name):
    return spark.table(name).count(), spark.table(f"{name}_dead_letters").count()


def test_drain_reruns_and_replay(spark, place):
    src, ckpt, name, _ = place
    for part in (MSGS[:3], MSGS[3:], ODD):
        _write_batch(spark, src, part)
    drained(spark, place)
    total = len(MSGS) + len(ODD)
    events, dead = counts(spark, name)
    assert events + dead == total and dead >= 10
    drained(spark, place)  # STR-6: nothing new
    assert counts(spark, name) == (events, dead)
    _write_batch(spark, src, MSGS[:1])
    drained(spark, place)
    assert counts(spark, name) == (events + 1, dead)
    drained(spark, place, ckpt=ckpt + "-replay")  # STR-8: all of it again, as another stream
    assert counts(spark, name) == (2 * events + 2, 2 * dead)
    assert {r._reason for r in spark.table(f"{name}_dead_letters").collect()} == {NOT_JSON, NOT_AN_OBJECT, NO_ID}
    assert "json_value" not in spark.table(name).columns


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_batch_that_is_killed_and_repeated_is_there_once(spark, place, monkeypatch, when):
    """Killed after its files are written but before it is registered, or registered but not yet noted in the checkpoint."""
    src, _, name, root = place
    _write_batch(spark, src, MSGS[:4])
    _write_batch(spark, src, MSGS[4:])
    register, killed = B._register, []

    def dies(*args):
        if when == "after":
            register(*args)
        killed.append(args[-1])
        raise RuntimeError("killed")

    monkeypatch.setattr(B, "_register", dies)
    with pytest.raises(Exception, match="killed"):
        drained(spark, place)
    monkeypatch.undo()
    assert killed == [0]
    visible = sum(counts(spark, name))
    assert visible == 0 if when == "before" else 0 < visible < len(MSGS)
    drained(spark, place)
    assert sum(counts(spark, name)) == len(MSGS)
    assert rows(spark.table(name), "event_id") == [("e1",), ("e2",), ("e3",), ("e4",)]


def test_compaction_keeps_each_message_once(spark, place):
    import glob

    src, ckpt, name, root = place
    for i in range(4):
        _write_batch(spark, src, [MSGS[i], ODD[i], f'{{"event_id":"x{i}","new":{i}}}'])
    drained(spark, place)
    before = rows(spark.table(name), "event_id", "event_type"), rows(spark.table(f"{name}_dead_letters"), "json_value", "_reason")
    assert B.compact(spark, name, root) > 4 and B.compact(spark, name, root) == 0
    after = lambda: (rows(spark.table(name), "event_id", "event_type"), rows(spark.table(f"{name}_dead_letters"), "json_value", "_reason"))
    assert after() == before
    assert B.vacuum(spark, name) > 8 and after() == before
    assert len(glob.glob(f"{root}/*/_dead=false/*.parquet")) == 1
    assert {json.loads(r.u)["new"] for r in spark.table(name).filter("event_id like 'x%'").select(F.to_json("_unknown").alias("u")).collect()} == {0, 1, 2, 3}
    # a repeated batch is still known, new ones are added, and a second compaction takes the first along
    B.write_batch(decode_all(raw(spark, MSGS[:1])), 0, name, root, B.stream_name(ckpt))
    assert after() == before
    _write_batch(spark, src, ['{"event_id":"late"}'])
    drained(spark, place)
    assert B.compact(spark, name, root) >= 1 and B.vacuum(spark, name) >= 4
    assert len(after()[0]) == len(before[0]) + 1 and after()[1] == before[1]


def test_one_scan_a_batch(spark, place):
    """Both tables come from one pass over the messages."""
    plan = decode_all(raw(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan") == 1


def test_empty_batches(spark, place):
    src, _, name, _ = place
    spark.createDataFrame([], "value string, timestamp timestamp").write.parquet(src)
    drained(spark, place)
    assert counts(spark, name) == (0, 0)
