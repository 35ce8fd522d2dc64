"""Snapshots, signed changes, months, buckets, sets of ids, winners in the state store."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from paylake.functions import distinct
from paylake.operators import snapshots
from paylake.operators.keys import bit_set, restrict, restrict_large
from paylake.plans import deltas
from paylake.sources import bucketed, monthly
from paylake.streaming import winners

ROW = "k string, a string, b string, n int"


def test_changed_keys(spark):
    old = spark.createDataFrame([("same", "x", None, 1), ("moved", "x", None, 1), ("gone", "x", "y", 1), ("null", None, None, None)], ROW)
    new = spark.createDataFrame([("same", "x", None, 1), ("moved", None, "x", 1), ("new", "x", "y", 1), ("null", None, None, None)], ROW)
    got = {r["k"]: r["change"] for r in snapshots.changed_keys(old, new, ["k"]).collect()}
    assert got == {"moved": "changed", "gone": "removed", "new": "inserted"}
    assert snapshots.changed_keys(old, old.select("n", "b", "k", "a"), ["k"]).isEmpty()
    empty = spark.createDataFrame([], ROW)
    assert snapshots.changed_keys(empty, old, ["k"]).count() == 4 and snapshots.changed_keys(empty, empty, ["k"]).isEmpty()


PAYMENT = "payment_id string, merchant_id string, gateway_id string, amount bigint, payment_status string, processing_time_ms bigint, completed_at timestamp, initiated_at timestamp"


def payment(spark, rows):
    full = [(p, m, "g", amount, status, ms, at and dt.datetime(2024, 1, at), None) for p, m, amount, status, ms, at in rows]
    return spark.createDataFrame(full, PAYMENT)


def test_signed_changes_against_a_full_count(spark):
    """Random histories: rows that come, change, move and go, several times between updates, with ties and NULLs."""
    draw = random.Random(3)
    parts = deltas.PARTS["merchant_performance"]

    def some():
        return (draw.choice(["m1", "m2", "m3", None]), draw.choice([None, 5, 7]), draw.choice(["Captured", "Failed", None]),
                draw.choice([None, 10, 20]), draw.choice([None, 1, 2, 2, 3]))

    now = {f"p{i}": some() for i in range(12)}
    read = []
    stored = deltas.accumulate(deltas.images(payment(spark, [(k, *v) for k, v in now.items()]), deltas.PAYMENT), parts).cache()
    for _ in range(4):
        olds, news = [], []
        for _ in range(draw.choice([1, 3])):
            for key in draw.sample(sorted(now) + [f"q{draw.randrange(99)}"], 2):
                if key in now:
                    olds.append((key, *now[key]))
                    del now[key]
                if draw.random() < 0.8:
                    now[key] = some()
                    news.append((key, *now[key]))
        changed = deltas.changes(payment(spark, olds), payment(spark, news), deltas.PAYMENT)
        facts = deltas.images(payment(spark, [(k, *v) for k, v in now.items()]), deltas.PAYMENT)

        def again(keys, facts=facts):
            read.append(1)
            return facts.join(keys, parts.key, "left_semi")

        updated = deltas.update(stored, changed, parts, again)
        stored = spark.createDataFrame(deltas.merged(stored, updated, parts).collect(), stored.schema)
        names = [parts.key, *parts.names()]
        full = {r[0]: tuple(r) for r in deltas.accumulate(facts, parts).select(*names).collect()}
        got = {r[0]: tuple(r) for r in stored.select(*names).collect()}
        for key in got.keys() | full.keys():
            none = (key, *[0] * len(parts.sums()), *[None] * len(parts.greatest()))
            assert got.get(key, none) == full.get(key, none)


EVENT = "id string, at timestamp, n int"


def days(rows):
    return sorted((r["id"], r["n"], r[monthly.MONTH]) for r in rows.collect())


def test_months_are_replaced_one_by_one(spark, tmp_path):
    path, day = f"{tmp_path}/t", F.to_date("at")

    def rows(*items):
        return spark.createDataFrame([(i, at and dt.datetime(*at), n) for i, at, n in items], EVENT)

    monthly.write(rows(("a", (2024, 1, 5), 1), ("b", (2024, 1, 9), 1), ("c", (2024, 2, 1), 1), ("d", None, 1), ("e", (2024, 3, 1), 1)), path, day)
    schema = rows(("x", None, 1)).schema
    march = [f for f in monthly.read(spark, path, schema).inputFiles() if "2024-03" in f]
    # a moves to the next month, c leaves its month for no day, f comes; d stays where it is.
    monthly.replace(
        spark, path, rows(("a", (2024, 1, 5), 1), ("c", (2024, 2, 1), 1)),
        rows(("a", (2024, 2, 7), 2), ("c", None, 2), ("f", (2024, 1, 1), 2)), ["id"], day,
    )
    expected = [("a", 2, dt.date(2024, 2, 1)), ("b", 1, dt.date(2024, 1, 1)), ("c", 2, None), ("d", 1, None), ("e", 1, dt.date(2024, 3, 1)), ("f", 2, dt.date(2024, 1, 1))]
    assert days(monthly.read(spark, path, schema)) == expected
    assert [f for f in monthly.read(spark, path, schema).inputFiles() if "2024-03" in f] == march
    # The only row of a month goes.
    monthly.replace(spark, path, rows(("e", (2024, 3, 1), 1)), rows(("e", (2024, 2, 9), 3)), ["id"], day)
    assert ("e", 3, dt.date(2024, 2, 1)) in days(monthly.read(spark, path, schema))
    assert monthly.read(spark, path, schema).count() == 6
    found = monthly.of_days(monthly.read(spark, path, schema), spark.sql("SELECT DATE '2024-02-07' AS d UNION ALL SELECT NULL"), day, "d")
    assert [r["id"] for r in found.collect()] == ["a"] and monthly.MONTH not in found.columns


def test_number_of_buckets():
    assert [bucketed.buckets_for(n, 10) for n in (0, 10, 11, 20, 21, 40, 41, 10_000)] == [1, 1, 2, 2, 4, 4, 8, 1024]


def test_sets_of_ids_merge(spark):
    draw = random.Random(5)
    rows = [(draw.choice("ab"), d, draw.choice([None, 0, 1, 40_000, 32_768, draw.randrange(200_000)])) for d in range(4) for _ in range(300)]
    facts = spark.createDataFrame(rows, "g string, d int, id bigint")
    # Each day is stored on its own.
    stored = None
    for d in range(4):
        sets = distinct.id_sets(facts.where(f"d = {d}"), ["g"], "id")
        stored = sets if stored is None else stored.union(sets)
    got = {r["g"]: r["c"] for r in distinct.counts(stored, ["g"], "c").collect()}
    assert got == {g: len({i for x, _, i in rows if x == g and i is not None}) for g in "ab"}
    assert distinct.counts(distinct.id_sets(facts.where("false"), ["g"], "id"), ["g"], "c").isEmpty()


def test_ids_are_numbered_without_gaps(spark):
    ids = spark.createDataFrame([(f"id{i % 500:03d}",) for i in range(1500)] + [(None,)], "id string").repartition(5)
    got = {r["id"]: r["number"] for r in distinct.numbered(ids, "id").collect()}
    assert got == {f"id{i:03d}": i for i in range(500)}


def test_latest_per_key_takes_the_greatest_and_leaves_null_keys_out(spark):
    schema = "k string, v int, kafka_timestamp timestamp, partition int, offset bigint"
    t = dt.datetime(2024, 1, 1)
    rows = [("a", 1, t, 0, 1), ("a", 2, t, 0, 3), ("a", 3, t, 0, 2), ("b", 4, None, 1, 1), ("b", 5, t, None, None), (None, 6, t, 0, 9)]
    for last_arrival in (False, True):
        got = winners.latest_per_key(spark.createDataFrame(rows, schema), ["k"], last_arrival)
        assert sorted((r["k"], r["v"]) for r in got.collect()) == [("a", 2), ("b", 5)]
        assert got.columns == ["k", "v", "kafka_timestamp", "partition", "offset"]


def test_buckets_meet_without_a_shuffle(spark, tmp_path):
    rows = spark.range(100).selectExpr("id % 10 AS k", "id AS v")
    spark.sql("DROP TABLE IF EXISTS bucketed_test")
    table = bucketed.write(rows, "bucketed_test", "k", 4, f"{tmp_path}/b")
    try:
        sums = table.groupBy("k").agg(F.sum("v").alias("s"))
        assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
        assert {r["k"]: r["s"] for r in sums.collect()} == {k: sum(range(k, 100, 10)) for k in range(10)}
    finally:
        spark.sql("DROP TABLE bucketed_test")


@pytest.mark.parametrize("topic", [deltas.ATTEMPT, deltas.LIFECYCLE, "payment_gateways"])
def test_images_of_rows_without_some_columns(spark, topic):
    row = spark.createDataFrame([("x",)], f"{deltas.IDS[topic]} string")
    image = deltas.images(row, topic, -1).first()
    assert (image["entity_id"], image["weight"], image["amount"], image["operation_dates"] or []) == ("x", -1, None, [])


def test_bit_set_drops_most_other_rows_and_no_key(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id", "IF(id % 100 = 0, NULL, CONCAT('k', id)) AS k")
    keys = spark.range(0, 20_000, 37).selectExpr("CONCAT('k', id) AS k")
    keys.write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")
    exact = {r["id"] for r in restrict(rows, keys, "k").collect()}
    near = {r["id"] for r in bit_set(keys, "k").maybe(rows, "k").collect()}
    assert exact <= near and len(near) < len(exact) + 0.1 * 20_000
    assert {r["id"] for r in restrict_large(rows, keys, "k").collect()} == exact
    # A set that is far too small for its keys lets others pass, and still loses none.
    small = bit_set(keys, "k", most_words=2)
    assert small.size == 2 and exact <= {r["id"] for r in small.maybe(rows, "k").collect()}
    assert bit_set(keys.where("false"), "k").maybe(rows, "k").isEmpty()
    # All 64 bits of a word are used.
    numbers = spark.range(5000).cache()
    assert bit_set(numbers, "id").maybe(spark.range(5000), "id").count() == 5000


def test_large_key_sets_shuffle_few_other_rows(spark, tmp_path):
    """With broadcasts of key sets off, the rows before the exact join are nearly those behind it."""
    rows = spark.range(50_000).selectExpr("id", "id * 7 AS k")
    spark.range(0, 50_000, 50).selectExpr("id * 7 AS k").write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        passed = bit_set(keys, "k").maybe(rows, "k")
        assert 1000 <= passed.count() < 1000 + 0.08 * 50_000
        found = restrict_large(rows, keys, "k")
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and text.count("BroadcastHashJoin") == 1
        assert found.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sets_of_scattered_ids_are_no_larger_than_the_facts(spark, tmp_path):
    """Groups with one id in each neighbourhood, as days have: a word for each, not four kilobytes."""
    facts = spark.range(20_000).selectExpr("id % 50 AS day", "(id * 7919) % 20000003 - 5000000 AS id")
    sets = distinct.id_sets(facts, ["day"], "id")
    assert {f.name: f.dataType.simpleString() for f in sets.schema} == {"day": "bigint", distinct.BUCKET: "bigint", distinct.BITS: "bigint"}
    assert sets.count() <= 20_000
    assert "SortAggregate" not in sets._jdf.queryExecution().executedPlan().toString()
    assert sum(r["n"] for r in distinct.counts(sets, ["day"], "n").collect()) == 20_000
    edges = spark.createDataFrame([("a", i) for i in (-65, -64, -1, 0, 63, 64, 2**62, -(2**63), 2**63 - 1, 63)], "g string, id bigint")
    assert distinct.counts(distinct.id_sets(edges, ["g"], "id"), ["g"], "n").first()["n"] == 9
