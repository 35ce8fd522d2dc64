"""The jobs over dropped files: drain, rerun, replay, disorder, bad records."""

import datetime as dt
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from paylake.checks.queries import _records
from paylake.operators.upsert import upsert
from paylake.sources import files
from paylake.sources.events import prepare_bronze
from paylake.sources.tables import Lake, stream_folder
from paylake.specs import entity_for_topic, static_for_table
from paylake.streaming import bronze, gold, moves, pipeline, silver, static

RECORDS = "topic string, partition int, offset bigint, timestamp timestamp, value binary"


@pytest.fixture(autouse=True, scope="module")
def small_data(spark):
    """A handful of rows: compiling code and planning again would cost more than they save."""
    settings = {
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


class Feed:
    """A folder that receives one file of records per call of ``drop``."""

    def __init__(self, spark, root):
        self.spark, self.root, self.offset = spark, root, 0
        self.schema = spark.createDataFrame([], RECORDS).schema

    def drop(self, *events, hour=None):
        rows = []
        for topic, payload in events:
            self.offset += 1
            text = payload
            if isinstance(payload, dict):
                text = json.dumps({"timestamp": "2024-01-01T00:00:00Z", "payload": payload})
            arrived = dt.datetime(2024, 1, 1, self.offset % 24 if hour is None else hour)
            rows.append((topic, 0, self.offset, arrived, bytearray(text.encode())))
        df = self.spark.createDataFrame(rows, RECORDS)
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/drop")

    def stream(self):
        return stream_folder(self.spark, f"{self.root}/drop", self.schema, max_files=1)


def payment(pid, **fields):
    base = dict(
        payment_id=pid, merchant_id="m1", customer_id="c", gateway_id="g1",
        payment_method_id="pm", amount=100, payment_status="Captured",
        initiated_at="2024-01-01T00:00:00Z",
    )
    return ("payment-events", {**base, **fields})


def refund(rid, pid="p1", **fields):
    base = dict(refund_id=rid, payment_id=pid, merchant_id="m1", refund_amount=10,
                requested_at="2024-01-02T00:00:00Z")
    return ("refund-events", {**base, **fields})


def merchant(mid, name):
    return ("merchant-events", {"merchant_id": mid, "merchant_name": name})


def make_lake(spark, root, **options):
    lake = Lake(spark, str(root), **options)
    frames = {
        "payment_gateways": [("g1", "Gate", "P", "Card", "Active"),
                             ("g2", "Other", "P", "Card", "Active")],
        "payment_methods": [("pm", "UPI", "Digital", "NPCI", "Active")],
        "payment_attempts": [("a1", "p1", "g1", "Success", 1)],
        "payment_events": [],
    }
    for name, rows in frames.items():
        spec = static_for_table(name)
        lake.keyed("silver", name, spec.keys).overwrite(
            spark.createDataFrame(rows, spec.schema)
        )
    return lake


def run(lake, feed, checkpoints="checkpoints", **options):
    pipeline.run(lake, feed.stream(), f"{feed.root}/{checkpoints}", **options)


def state(lake, topic):
    return silver.entity_table(lake, entity_for_topic(topic)).read()


def metric(lake, name):
    return gold.gold_table(lake, name).read()


def by_key(df):
    return {r[0]: r.asDict() for r in df.collect()}


def test_whole_pipeline_drain_and_rerun(spark, tmp_path):
    feed, lake = Feed(spark, tmp_path), make_lake(spark, tmp_path / "lake")
    feed.drop(merchant("m1", "Acme"), payment("p1"), payment("p2", payment_status="Failed"))
    feed.drop(refund("r1"), refund("r9", pid="unknown"))
    run(lake, feed)
    raw = spark.read.parquet(lake.location("bronze", bronze.RAW_EVENTS))
    assert raw.count() == 5
    performance = by_key(metric(lake, "payment_performance"))
    assert set(performance) == {"p1", "p2"}
    assert performance["p1"]["merchant_name"] == "Acme"
    assert performance["p1"]["refund_count"] == 1 and performance["p1"]["attempt_count"] == 1
    merchants = by_key(metric(lake, "merchant_performance"))
    assert merchants["m1"]["payment_count"] == 2 and merchants["m1"]["refund_count"] == 2
    assert by_key(metric(lake, "gateway_performance"))["g1"]["successful_payment_count"] == 1
    days = by_key(metric(lake, "financial_operations"))
    assert days[dt.date(2024, 1, 1)]["net_payment_amount"] == 100
    assert days[dt.date(2024, 1, 2)]["net_payment_amount"] == -20

    # Nothing new: nothing is written.
    before = {n: gold.gold_table(lake, n)._folders() for n in gold.GRAINS}
    run(lake, feed)
    assert {n: gold.gold_table(lake, n)._folders() for n in gold.GRAINS} == before

    # New data: only what it touches changes. The refund moves from its request
    # day to its completion day, and the day it leaves has no row any more.
    feed.drop(refund("r1", completed_at="2024-01-05T00:00:00Z", refund_amount=30),
              refund("r9", pid="unknown", completed_at="2024-01-05T00:00:00Z"))
    run(lake, feed)
    days = by_key(metric(lake, "financial_operations"))
    assert set(days) == {dt.date(2024, 1, 1), dt.date(2024, 1, 5)}
    assert days[dt.date(2024, 1, 5)]["total_refund_amount"] == 40
    assert by_key(metric(lake, "payment_performance"))["p1"]["total_refund_amount"] == 30

    # A payment moves to another merchant, gateway and day: both sides follow.
    feed.drop(merchant("m2", "Beta"), payment("p2", merchant_id="m2", gateway_id="g2",
                                              initiated_at="2024-01-09T00:00:00Z"))
    run(lake, feed)
    merchants = by_key(metric(lake, "merchant_performance"))
    assert (merchants["m1"]["payment_count"], merchants["m2"]["payment_count"]) == (1, 1)
    gateways = by_key(metric(lake, "gateway_performance"))
    assert (gateways["g1"]["payment_count"], gateways["g2"]["payment_count"]) == (1, 1)
    days = by_key(metric(lake, "financial_operations"))
    assert days[dt.date(2024, 1, 1)]["payment_count"] == 1
    assert days[dt.date(2024, 1, 9)]["payment_count"] == 1

    # Folding the changes alters no result, and the next run builds on it.
    kept = {n: sorted(map(repr, metric(lake, n).collect())) for n in gold.GRAINS}
    pipeline.compact(lake)
    pipeline.clean(lake)
    assert not state(lake, "payment-events").isEmpty()
    assert {n: sorted(map(repr, metric(lake, n).collect())) for n in gold.GRAINS} == kept
    feed.drop(refund("r2"))
    run(lake, feed)
    assert by_key(metric(lake, "payment_performance"))["p1"]["refund_count"] == 2

    # A full rebuild agrees with what the increments have left.
    kept = {n: sorted(map(repr, metric(lake, n).collect())) for n in gold.GRAINS}
    gold.rebuild_all(lake)
    for name in ("payment_performance", "merchant_performance", "financial_operations"):
        assert sorted(map(repr, metric(lake, name).collect())) == kept[name]


def test_replay_into_a_fresh_checkpoint_gives_the_same_state(spark, tmp_path):
    feed, lake = Feed(spark, tmp_path), make_lake(spark, tmp_path / "lake")
    feed.drop(payment("p1"), payment("p1", amount=7), payment("p2"))
    run(lake, feed)
    first = state(lake, "payment-events").select("payment_id", "amount").collect()
    assert sorted(first) == [("p1", 7), ("p2", 100)]
    silver.run(pipeline.raw_log(lake), lake, f"{tmp_path}/again")
    assert sorted(state(lake, "payment-events").select("payment_id", "amount").collect()) == sorted(first)
    assert state(lake, "payment-events").count() == 2


@pytest.mark.parametrize("newer_wins,amount", [(False, 1), (True, 2)])
def test_older_event_in_a_later_batch(spark, tmp_path, newer_wins, amount):
    feed = Feed(spark, tmp_path)
    lake = make_lake(spark, tmp_path / "lake", newer_wins=newer_wins)
    feed.drop(payment("p1", amount=2), hour=9)
    run(lake, feed)
    feed.drop(payment("p1", amount=1), hour=3)
    run(lake, feed)
    assert state(lake, "payment-events").first()["amount"] == amount
    assert metric(lake, "payment_performance").first()["amount"] == amount


def test_bad_record_fails_the_batch_and_every_rerun(spark, tmp_path):
    feed, lake = Feed(spark, tmp_path), make_lake(spark, tmp_path / "lake")
    feed.drop(payment("p1"), ("payment-events", "garbage"))
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="payment_id"):
            run(lake, feed)
    assert state(lake, "payment-events").count() == 0


def test_options_are_checked():
    with pytest.raises(ValueError):
        silver.SilverOptions(on_bad="ignore")


def test_negative_amount_fails(spark, tmp_path):
    feed, lake = Feed(spark, tmp_path), make_lake(spark, tmp_path / "lake")
    feed.drop(payment("p1", amount=-1))
    with pytest.raises(StreamingQueryException, match="negative"):
        run(lake, feed)


def test_quarantine_sets_bad_records_aside(spark, tmp_path):
    feed, lake = Feed(spark, tmp_path), make_lake(spark, tmp_path / "lake")
    feed.drop(payment("p1"), ("payment-events", "garbage"), payment("p2", amount=-1),
              payment("p3", merchant_id=None), payment("p4", amount=5.0))
    seen = []
    options = silver.SilverOptions(on_bad="quarantine", numbers="tolerant")
    bronze.ingest(prepare_bronze(feed.stream()), lake, f"{tmp_path}/cb")
    silver.run(pipeline.raw_log(lake), lake, f"{tmp_path}/cs", options, seen.append)
    kept = state(lake, "payment-events").select("payment_id", "amount").collect()
    assert sorted(kept) == [("p1", 100), ("p4", 5)]
    aside = lake.keyed("quarantine", "payments", ("topic", "partition", "offset")).read()
    errors = {r["offset"]: r["errors"] for r in aside.collect()}
    assert errors[2][0] == "malformed" and errors[3] == ["negative:amount"]
    assert errors[4] == ["missing:merchant_id"]
    assert seen[0]["record_count"] == 5 and seen[0]["negative_amount"] == 1


def test_dimension_changes_follow_on_request(spark, tmp_path):
    feed, lake = Feed(spark, tmp_path), make_lake(spark, tmp_path / "lake")
    feed.drop(merchant("m1", "Old"), payment("p1"))
    run(lake, feed)
    feed.drop(merchant("m1", "New"))
    run(lake, feed)
    assert by_key(metric(lake, "merchant_performance"))["m1"]["merchant_name"] == "New"
    assert by_key(metric(lake, "payment_performance"))["p1"]["merchant_name"] == "Old"
    feed.drop(merchant("m1", "Newer"))
    run(lake, feed, gold_options=gold.GoldOptions(follow_dimensions=True))
    assert by_key(metric(lake, "payment_performance"))["p1"]["merchant_name"] == "Newer"


def test_static_path(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    good = tmp_path / "good.csv"
    good.write_text("event_id,payment_id,retry_count,event_timestamp\n"
                    "e1,p1,2,2024-01-01 10:00:00\ne2,p1,,2024-01-02T00:00:00.5\n")
    static.ingest(lake, {"payment_events": str(good)})
    static.process(lake, ["payment_events"])
    rows = by_key(lake.keyed("silver", "payment_events", ["event_id"]).read())
    assert rows["e1"]["event_timestamp"] == dt.datetime(2024, 1, 1, 10)
    assert rows["e2"]["retry_count"] is None
    bad = tmp_path / "bad.csv"
    bad.write_text("event_id,payment_id,retry_count,event_timestamp\ne1,p1,,\ne1,p2,,\n")
    static.ingest(lake, {"payment_events": str(bad)}, infer=True)
    with pytest.raises(ValueError, match="repeat"):
        static.process(lake, ["payment_events"])
    assert lake.keyed("silver", "payment_events", ["event_id"]).read().count() == 2


def test_wide_and_bad_csv(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    wide = tmp_path / "wide.csv"
    wide.write_text("note,attempt_number,attempt_id,payment_id,gateway_id,attempt_status,amount\n"
                    "x,2,a1,p1,g1,Failed,5\n,,a2,p1,g1,Success,\n")
    static.ingest(lake, {"payment_attempts": str(wide)})
    static.process(lake, ["payment_attempts"])
    spec = static_for_table("payment_attempts")
    rows = lake.keyed("silver", "payment_attempts", spec.keys).read()
    assert rows.schema == spec.schema
    assert sorted(map(tuple, rows.collect())) == [("a1", "p1", "g1", "Failed", 2), ("a2", "p1", "g1", "Success", None)]
    assert "note" in lake.keyed("bronze", "payment_attempts", spec.keys).read().columns
    bad = tmp_path / "bad.csv"
    bad.write_text("attempt_number,attempt_id,payment_id,gateway_id,attempt_status\none,a1,p1,g1,Failed\n")
    static.ingest(lake, {"payment_attempts": str(bad)})
    with pytest.raises(ValueError, match="attempt_number"):
        static.process(lake, ["payment_attempts"])
    assert lake.keyed("silver", "payment_attempts", spec.keys).read().count() == 2


class SnapshotTable:
    """A keyed table that keeps nothing but its current rows, as a MERGE leaves it."""

    def __init__(self, spark, path, keys, schema=None):
        self.spark, self.path, self.keys, self.schema = spark, path, list(keys), schema

    def _versions(self):
        return sorted(os.listdir(self.path)) if os.path.isdir(self.path) else []

    def read(self):
        found = self._versions()
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.parquet(f"{self.path}/{found[-1]}")

    def overwrite(self, rows):
        rows.write.parquet(f"{self.path}/{len(self._versions()):06d}")

    def upsert(self, rows, batch=None, remove=None):
        if not self._versions():
            return self.overwrite(rows)
        kept = upsert(self.read(), rows, self.keys)
        if remove is not None:
            gone = remove.join(rows, self.keys, "left_anti")
            kept = kept.join(gone, self.keys, "left_anti").select(*kept.columns)
        return self.overwrite(kept)


class SnapshotLake(Lake):
    def keyed(self, layer, table, keys, schema=None, newer_wins=False):
        return SnapshotTable(self.spark, self.location(layer, table), keys, schema)


def test_moves_are_followed_without_a_history(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    lake = SnapshotLake(spark, str(tmp_path / "lake"))
    spec = static_for_table("payment_gateways")
    gates = [("g1", "Gate", "P", "Card", "Active"), ("g2", "Other", "P", "Card", "Active"), ("g3", "Idle", "P", "Card", "Active")]
    lake.keyed("silver", "payment_gateways", spec.keys).overwrite(spark.createDataFrame(gates, spec.schema))
    feed.drop(merchant("m1", "A"), merchant("m2", "B"), payment("p1"), payment("p2"), refund("r1"))
    run(lake, feed)
    # The gateway without any payment has a row too.
    assert by_key(metric(lake, "gateway_performance"))["g3"]["payment_count"] == 0
    feed.drop(payment("p2", merchant_id="m2", gateway_id="g2", initiated_at="2024-01-09T00:00:00Z"),
              refund("r1", pid="p2", merchant_id="m2", requested_at="2024-01-10T00:00:00Z"))
    run(lake, feed)
    payments = by_key(metric(lake, "payment_performance"))
    assert (payments["p1"]["refund_count"], payments["p2"]["refund_count"]) == (0, 1)
    merchants = by_key(metric(lake, "merchant_performance"))
    assert (merchants["m1"]["payment_count"], merchants["m2"]["payment_count"]) == (1, 1)
    assert (merchants["m1"]["refund_count"], merchants["m2"]["refund_count"]) == (0, 1)
    gateways = by_key(metric(lake, "gateway_performance"))
    assert (gateways["g1"]["payment_count"], gateways["g2"]["payment_count"]) == (1, 1)
    days = by_key(metric(lake, "financial_operations"))
    assert set(days) == {dt.date(2024, 1, 1), dt.date(2024, 1, 9), dt.date(2024, 1, 10)}


def test_log_of_moves_survives_a_second_attempt(spark, tmp_path):
    feed, lake = Feed(spark, tmp_path), make_lake(spark, tmp_path / "lake")
    feed.drop(payment("p1"))
    run(lake, feed)
    assert moves.read(lake) is None
    spec = entity_for_topic("payment-events")
    new = state(lake, "payment-events").withColumn("merchant_id", F.lit("m9"))
    new = spark.createDataFrame(new.collect(), new.schema)
    silver.write_silver(new, lake, spec, "q-7")
    moves.record(lake, spec, silver.entity_table(lake, spec), new, "q-7")
    assert [r["merchant_id"] for r in moves.read(lake).collect()] == ["m1"]
    moves.clear(lake)
    assert moves.read(lake) is None


def test_unreadable_values(spark, tmp_path, caplog):
    feed, lake = Feed(spark, tmp_path), make_lake(spark, tmp_path / "lake")
    feed.drop(payment("p1", amount="abc"), payment("p2", amount=5.0000001), payment("p3", amount=10**20),
              payment("p4", completed_at="not a date"), payment("p5", amount="7.0"), payment("p5", amount=1.5e1))
    bronze.ingest(prepare_bronze(feed.stream()), lake, f"{tmp_path}/cb")
    refusing = silver.SilverOptions(numbers="tolerant")
    with pytest.raises(StreamingQueryException, match="cannot be read"):
        silver.run(pipeline.raw_log(lake), lake, f"{tmp_path}/c1", refusing)
    options = silver.SilverOptions(on_bad="quarantine", numbers="tolerant")
    silver.run(pipeline.raw_log(lake), lake, f"{tmp_path}/c2", options)
    assert state(lake, "payment-events").select("payment_id", "amount").collect() == [("p5", 15)]
    aside = lake.keyed("quarantine", "payments", ("topic", "partition", "offset")).read()
    assert {r["offset"]: r["errors"] for r in aside.collect()} == {
        1: ["unreadable:amount"], 2: ["unreadable:amount"], 3: ["unreadable:amount"],
        4: ["unreadable:completed_at"],
    }
    # Repeats and unreadable values are logged where nobody asks for the report.
    assert "repeated_keys" in caplog.text and "unreadable_amount" in caplog.text


def test_append_stream_to_a_catalog_table(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.drop(payment("p1"), refund("r1"))
    spark.sql("DROP TABLE IF EXISTS raw_stream_table")
    query = bronze.append_stream(
        prepare_bronze(feed.stream()), "raw_stream_table", f"{tmp_path}/c"
    )
    query.awaitTermination()
    assert spark.read.table("raw_stream_table").count() == 2
    spark.sql("DROP TABLE raw_stream_table")


def test_parts_follow_changes_without_reading_facts(spark, tmp_path):
    """Sums and greatest values of merchants and gateways after moves, replays and a second look."""
    feed, lake = Feed(spark, tmp_path), make_lake(spark, tmp_path / "lake")
    feed.drop(merchant("m1", "A"), merchant("m2", "B"),
              payment("p1", completed_at="2024-01-03T00:00:00Z", processing_time_ms=10),
              payment("p2", completed_at="2024-01-05T00:00:00Z", processing_time_ms=30), payment("p3"))
    run(lake, feed)
    # Twice within one run: first a later time, then an earlier one at another merchant.
    feed.drop(payment("p2", completed_at="2024-01-09T00:00:00Z"))
    feed.drop(payment("p2", merchant_id="m2", completed_at="2024-01-04T00:00:00Z", processing_time_ms=50, gateway_id="g2"))
    feed.drop(refund("r1"))
    read = []

    def facts(name, state, keys=None, original=gold._facts):
        read.append((name, keys is not None))
        return original(name, state, keys)

    gold._facts, original = facts, gold._facts
    try:
        run(lake, feed)
        # The latest time of m1 went away, so its facts were read; nothing else was.
        assert read == [("merchant_performance", True)]
        read.clear()
        feed.drop(refund("r1", refund_amount=25), payment("p3", completed_at="2024-02-01T00:00:00Z"))
        run(lake, feed)
        assert read == []
    finally:
        gold._facts = original
    merchants = by_key(metric(lake, "merchant_performance"))
    assert merchants["m1"]["payment_count"] == 2 and merchants["m2"]["payment_count"] == 1
    assert merchants["m1"]["total_refund_amount"] == 25
    assert merchants["m1"]["avg_processing_time_ms"] == 10 and merchants["m2"]["avg_processing_time_ms"] == 50
    assert merchants["m1"]["last_payment_completed_at"] == dt.datetime(2024, 2, 1)
    kept = {n: sorted(map(repr, metric(lake, n).collect())) for n in gold.GRAINS}
    parts = {n: sorted(map(repr, gold.parts_table(lake, n).read().where("kind = 'row'").collect())) for n in gold.deltas.PARTS}
    # The names of entries that were cleared are forgotten at the next update.
    assert gold.parts_table(lake, "merchant_performance").read().where("kind = 'entry'").count() <= 4
    gold.rebuild_all(lake)
    assert {n: sorted(map(repr, metric(lake, n).collect())) for n in gold.GRAINS} == kept
    assert {n: sorted(map(repr, gold.parts_table(lake, n).read().where("kind = 'row'").collect())) for n in gold.deltas.PARTS} == parts


def test_a_second_gold_run_over_the_same_log_adds_nothing(spark, tmp_path):
    feed, lake = Feed(spark, tmp_path), make_lake(spark, tmp_path / "lake")
    feed.drop(merchant("m1", "A"), payment("p1"))
    run(lake, feed)
    feed.drop(payment("p1", amount=7), payment("p2", amount=9))
    bronze.ingest(prepare_bronze(feed.stream()), lake, f"{feed.root}/checkpoints/bronze")
    silver.run(pipeline.raw_log(lake), lake, f"{feed.root}/checkpoints/silver")
    # Two jobs with checkpoints of their own, so both see all batches; the log is not cleared in between.
    for checkpoint in ("checkpoints/gold", "other"):
        gold.run(pipeline.raw_log(lake), lake, f"{feed.root}/{checkpoint}")
        row = by_key(metric(lake, "merchant_performance"))["m1"]
        assert (row["payment_count"], row["total_payment_amount"]) == (2, 16)


def test_static_loads_reach_the_metrics(spark, tmp_path):
    feed, lake = Feed(spark, tmp_path), Lake(spark, str(tmp_path / "lake"))

    def load(**tables):
        paths = {}
        for name, lines in tables.items():
            paths[name] = str(tmp_path / f"{name}.csv")
            spec = static_for_table(name)
            (tmp_path / f"{name}.csv").write_text("\n".join([",".join(spec.schema.fieldNames()), *lines]) + "\n")
        run(lake, feed, static_paths=paths)

    gates = ["g1,Gate,P,Card,Active", "g2,Other,P,Card,Active"]
    feed.drop(merchant("m1", "A"), payment("p1"), payment("p2"), payment("p3", gateway_id="g2"))
    load(payment_gateways=gates, payment_methods=["pm,UPI,Digital,NPCI,Active"], payment_events=["e1,p1,2,2024-01-01 10:00:00"],
         payment_attempts=["a1,p1,g1,Success,1", "a2,p2,g1,Failed,4", "a3,p3,g2,Success,1"])
    assert by_key(metric(lake, "payment_performance"))["p2"]["max_attempt_number"] == 4
    assert by_key(metric(lake, "gateway_performance"))["g1"]["max_attempt_number"] == 4
    before = metric(lake, "payment_performance").count()
    # One attempt changes and moves to another gateway, one goes, one comes; no event arrives.
    load(payment_attempts=["a1,p1,g1,Success,1", "a2,p2,g2,Failed,2", "a4,p2,g1,Success,3"],
         payment_events=["e1,p1,2,2024-01-01 10:00:00"], payment_gateways=gates)
    payments = by_key(metric(lake, "payment_performance"))
    assert len(payments) == before
    assert (payments["p2"]["attempt_count"], payments["p2"]["max_attempt_number"]) == (2, 3)
    assert payments["p3"]["attempt_count"] == 0 and payments["p1"]["event_count"] == 1
    gateways = by_key(metric(lake, "gateway_performance"))
    assert (gateways["g1"]["attempt_count"], gateways["g1"]["max_attempt_number"]) == (2, 3)
    assert (gateways["g2"]["attempt_count"], gateways["g2"]["max_attempt_number"]) == (1, 2)
    # Only the payments of those attempts were written again.
    table = gold.gold_table(lake, "payment_performance")
    last = spark.read.parquet(*table._paths(table._folders()[-1:]))
    assert sorted(r["payment_id"] for r in last.collect()) == ["p2", "p3"]
    # The same files once more: nothing to do.
    folders = table._folders()
    load(payment_attempts=["a1,p1,g1,Success,1", "a2,p2,g2,Failed,2", "a4,p2,g1,Success,3"])
    assert table._folders() == folders
    # A dimension row: payments follow on request.
    paths = {"payment_gateways": str(tmp_path / "payment_gateways.csv")}
    (tmp_path / "payment_gateways.csv").write_text("gateway_id,gateway_name,provider,gateway_type,status\ng1,New,P,Card,Active\ng2,Other,P,Card,Active\n")
    run(lake, feed, static_paths=paths, gold_options=gold.GoldOptions(follow_dimensions=True))
    payments = by_key(metric(lake, "payment_performance"))
    assert [payments[p]["gateway_name"] for p in ("p1", "p2", "p3")] == ["New", "New", "Other"]
    assert by_key(metric(lake, "gateway_performance"))["g1"]["gateway_name"] == "New"


def test_first_load_is_logged_without_a_comparison(spark, tmp_path, monkeypatch):
    spec = static_for_table("payment_methods")
    lake = Lake(spark, f"{tmp_path}/lake")
    table = lake.keyed("silver", spec.table, spec.keys, spec.schema)
    rows = spark.createDataFrame([("a",), ("b",), (None,)], f"{spec.keys[0]} string")
    rows = rows.select(*[F.col(f.name) if f.name in spec.keys else F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields])

    def compared(*_):
        raise AssertionError("compared with nothing")

    monkeypatch.setattr(moves, "changed_keys", compared)
    moves.record_load(lake, spec, table, rows)
    got = moves.changes(lake, moves.entries(lake)).select("entity_id", "weight").collect()
    assert sorted(map(tuple, got)) == [("a", 1), ("b", 1)]
    table.overwrite(rows)
    with pytest.raises(AssertionError, match="compared"):
        moves.record_load(lake, spec, table, rows)


def test_raw_log_is_dropped_and_taken_in_without_moving_its_text(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    log = spark.range(3000).selectExpr(
        "CONCAT('t', id % 3) AS topic", "0 AS partition", "id AS offset", "TIMESTAMP '2024-01-01' AS kafka_timestamp", "REPEAT('x', 200) AS raw_payload"
    ).repartition(3)
    stream = prepare_bronze(_records(lake, log))
    # As many files as the log has partitions: nothing is dealt anew.
    assert len(list((tmp_path / "lake/drop").glob("*.parquet"))) == 3
    bronze.ingest(stream, lake, f"{tmp_path}/checkpoint")
    written = list((tmp_path / "lake/bronze").rglob("*.parquet"))
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in written} == {"ZSTD"}
    assert spark.read.parquet(lake.location("bronze", bronze.RAW_EVENTS)).count() == 3000
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == str(bronze.OPEN_FILES)


def test_files_of_records_are_written_and_read_in_bounded_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ROW_GROUP", 100_000)
    spark.conf.unset(files.ROW_GROUP_SETTING)
    try:
        lake = Lake(spark, f"{tmp_path}/lake")
        log = spark.range(0, 3000, 1, 1).selectExpr(
            "CONCAT('t', id % 3) AS topic", "0 AS partition", "id AS offset", "TIMESTAMP '2024-01-01' AS kafka_timestamp",
            "CONCAT(SHA2(CONCAT('a', id), 512), SHA2(CONCAT('b', id), 512)) AS raw_payload",
        )
        bronze.ingest(prepare_bronze(_records(lake, log)), lake, f"{tmp_path}/checkpoint")
    finally:
        spark.conf.unset(files.ROW_GROUP_SETTING)
    written = {d: [pq.ParquetFile(f).metadata for f in (tmp_path / "lake" / d).rglob("*.parquet")] for d in ("drop", "bronze")}
    assert {d: sum(m.num_rows for m in found) for d, found in written.items()} == {"drop": 3000, "bronze": 3000}
    assert written["drop"][0].num_row_groups > 2
    assert len(written["bronze"]) == 3 and all(m.num_row_groups > 1 for m in written["bronze"])
    read = spark.read.parquet(lake.location("bronze", bronze.RAW_EVENTS)).drop("kafka_timestamp")
    expected = log.drop("kafka_timestamp").select(*read.columns)
    assert read.exceptAll(expected).isEmpty() and expected.exceptAll(read).isEmpty()
