"""Plan shapes that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from paylake.checks.queries import QUERIES, _monthly
from paylake.checks.views import Views
from paylake.functions import measures as M
from paylake.operators.keys import restrict
from paylake.operators.latest import keep_latest
from paylake.operators.upsert import upsert
from paylake.plans import deltas, gold, incremental
from paylake.session import KEPT_ROWS, keep
from paylake.sources.tables import FolderTable

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", plan(df)))


def test_no_query_pairs_everything(spark):
    for name, query in QUERIES.items():
        if "stream" in name or name == "static_silver_state":
            continue
        text = plan(query(spark, FOLDER))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name
        # Two distinct counts side by side double the rows, of two narrow columns only.
        assert "Expand" not in text or name == "payment_count", name
        assert "PythonUDF" not in text, name


def test_keep_latest_cuts_hot_keys_before_the_shuffle(spark):
    df = Views.of(spark, FOLDER).table("lineitem")
    text = plan(keep_latest(df, ["l_orderkey"], ["l_shipdate"]))
    assert re.search(r"Partial", text) and text.count("WindowGroupLimit") == 2


def test_unique_ids_need_one_shuffle(spark):
    attempts = Views.of(spark, FOLDER).attempts()
    assert exchanges(M.rollup(attempts, "gateway_id", M.attempts)) == 2
    assert exchanges(M.rollup(attempts, "gateway_id", M.attempts, ids_unique=True)) == 1


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["total_payment_amount"](spark, FOLDER))
    # The child aggregates cannot change the sum: they are not even read.
    assert "lineitem" not in text and "events" not in text
    refunds = plan(QUERIES["refunds_by_payment"](spark, FOLDER))
    assert "l_quantity" not in refunds and "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in refunds


def test_day_keys_are_broadcast(spark):
    v = Views.of(spark, FOLDER)
    days = v.chargebacks().selectExpr("to_date(created_at) AS operation_date")
    part = incremental.rebuild(
        "financial_operations", days, v.payments(), v.refunds(), v.chargebacks(), v.settlements(), ids_unique=True
    )
    text = plan(part)
    assert "SortMergeJoin [operation_date" not in text
    assert text.count("BroadcastHashJoin [operation_date") == 4


def test_counted_key_set_is_joined_by_its_size(spark):
    v = Views.of(spark, FOLDER)
    keys = v.chargebacks().select("payment_id").distinct().persist()
    keys.count()
    try:
        assert "BroadcastHashJoin" in plan(restrict(v.payments(), keys, "payment_id"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        assert "SortMergeJoin" in plan(restrict(v.payments(), keys, "payment_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        keys.unpersist()


def test_metric_tables_without_any_broadcast(spark):
    """The same rows when every side is too large to broadcast."""
    v = Views.of(spark, FOLDER)
    inputs = (v.merchants(), v.payments(), v.refunds(), v.chargebacks(), v.settlements())
    small = sorted(map(repr, gold.merchant_performance(*inputs).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = gold.merchant_performance(*inputs)
        assert "BroadcastHashJoin" not in plan(df)
        assert sorted(map(repr, df.collect())) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture
def no_broadcasts(spark):
    """Every side too large to broadcast, and partitions skewed beyond a low limit."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


N = 120_000


def hot_payments(spark):
    """A third of the payments belong to one merchant."""
    merchant = "if(id % 3 = 0, 'm1', concat('m', id % 900))"
    return spark.range(0, N, 1, 8).selectExpr(
        "concat('p', id) payment_id", f"{merchant} merchant_id", "'c' customer_id",
        "'i' invoice_id", "'g' gateway_id", "'pm' payment_method_id", "id amount",
        "'INR' currency", "'Captured' payment_status", "uuid() payment_reference",
        "timestamp'2024-01-01' initiated_at", "timestamp'2024-01-01' completed_at",
        "id processing_time_ms",
    )


def merchants_and_children(spark):
    merchants = spark.range(900).selectExpr(
        "concat('m', id) merchant_id", "concat('name ', id) merchant_name", "'x' business_type",
        "'x' country", "'x' city", "'x' industry", "'Low' risk_level", "'x' settlement_cycle",
        "'x' verification_status",
    )
    child = spark.range(0)
    children = (
        child.selectExpr("'' payment_id", "'' merchant_id", "id refund_id", "id refund_amount"),
        child.selectExpr("'' payment_id", "'' merchant_id", "id chargeback_id", "id amount"),
        child.selectExpr("'' payment_id", "'' merchant_id", "id settlement_id", "id settlement_amount"),
    )
    return merchants, children


def test_hot_merchant_is_split_across_tasks(spark, no_broadcasts):
    merchants, children = merchants_and_children(spark)
    gateways = spark.sql("SELECT 'g' gateway_id, 'G' gateway_name, 'P' provider, 'C' gateway_type")
    methods = spark.sql("SELECT 'pm' payment_method_id, 'U' payment_method_name, 'D' category")
    child = spark.range(0)
    performance = gold.payment_performance(
        hot_payments(spark), merchants, gateways, methods,
        child.selectExpr("'' payment_id", "id attempt_id", "'' attempt_status", "1 attempt_number"),
        child.selectExpr("'' payment_id", "id event_id", "1 retry_count",
                         "timestamp'2024-01-01' event_timestamp"),
        *children,
    )
    rows = performance.groupBy("merchant_name").count().where("merchant_name = 'name 1'")
    assert rows.collect()[0]["count"] > N // 3
    assert "skew=true" in plan(rows)


def below_exchanges(df, key):
    """What stands right below each shuffle by the key."""
    lines = [re.sub(r"^[\s:|+*()0-9-]*", "", x) for x in plan(df).splitlines()]
    return [lines[i + 1] for i, x in enumerate(lines) if x.startswith(f"Exchange hashpartitioning({key}#")]


@pytest.mark.parametrize("ids_unique", [True, False])
def test_hot_merchant_in_a_partial_rebuild(spark, no_broadcasts, ids_unique):
    merchants, children = merchants_and_children(spark)
    keys = spark.range(0, 900, 2).selectExpr("concat('m', id + 1) merchant_id").distinct().persist()
    keys.count()
    inputs = (merchants, hot_payments(spark), *children)
    try:
        part = incremental.rebuild("merchant_performance", keys, *inputs, ids_unique=ids_unique)
        below = below_exchanges(part, "merchant_id")
        whole = gold.merchant_performance(*inputs, ids_unique=ids_unique)
        wanted = {r.merchant_id: r.payment_count for r in whole.join(keys, "merchant_id", "left_semi").collect()}
        assert {r.merchant_id: r.payment_count for r in part.collect()} == wanted
        assert wanted["m1"] > N // 3
        # No raw payments are shuffled: each shuffle is of combined rows, of merchants or of keys.
        facts = [x for x in below if "amount" in x]
        assert facts
        assert all(x.startswith("HashAggregate") and "partial_" in x for x in facts)
    finally:
        keys.unpersist()


def test_hot_merchant_among_payments_of(spark, no_broadcasts):
    keys = spark.range(0, 900).selectExpr("concat('m', id) merchant_id").persist()
    keys.count()
    try:
        found = incremental.payments_of(hot_payments(spark), keys, "merchant_id")
        assert found.count() == N
        counted = found.groupBy().count()
        counted.collect()
        assert "skew=true" in plan(counted)
    finally:
        keys.unpersist()


def test_events_are_parsed_once_and_not_in_filters(spark):
    for name in ("unreadable_values", "refused_events"):
        text = plan(QUERIES[name](spark, FOLDER))
        filters = [line for line in text.splitlines() if re.search(r"\bFilter\b", line)]
        assert filters and not any("from_json" in line for line in filters), name
        # One for each of the five topics.
        assert text.count("from_json") == 5, name


def scans(df):
    """The file scans of a plan that has run, with their metrics."""
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            walk(node.plan())
        elif name == "FileSourceScanExec":
            metrics = node.metrics()
            found.append((node.toString(), metrics.apply("numFiles").value()))
        children = node.children()
        for i in range(children.length()):
            walk(children.apply(i))

    query = df._jdf.queryExecution()
    df._jdf.collectToPython()
    walk(query.executedPlan())
    return found


def test_days_read_their_months_alone(spark):
    v = Views.of(spark, FOLDER)
    tables = list(_monthly(v).values())
    # As the job has them: cached.
    days = spark.sql("SELECT DATE '1995-03-04' AS operation_date").cache()
    part = incremental.rebuild("financial_operations", days, *tables)
    assert len(re.findall(r"PartitionFilters: \[[^\]]*1995-03-01", plan(part))) == 4
    read, whole = scans(part), scans(gold.financial_operations(*tables))
    # One month of seven years.
    assert read and 0 < 20 * max(n for _, n in read) < min(n for _, n in whole)


def test_bucketed_facts_need_no_shuffle(spark):
    text = plan(QUERIES["bucketed_payment_performance"](spark, FOLDER))
    assert "Exchange hashpartitioning(payment_id" not in text
    assert text.count("Bucketed: true") == 6


def test_merged_counts_shuffle_no_ids(spark):
    text = plan(QUERIES["attempts_by_merged_days"](spark, FOLDER))
    assert "attempt_id" not in text.replace("attempt_count", "")
    assert len(re.findall("Exchange hashpartitioning", text)) == 2


def test_parts_are_updated_without_facts(spark, tmp_path):
    def stored_as(rows, name):
        rows.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    parts = deltas.PARTS["merchant_performance"]
    v = Views.of(spark, FOLDER)
    stored = stored_as(deltas.accumulate(deltas.images(v.payments(), deltas.PAYMENT), parts), "parts")
    old = v.payments().where("payment_id = 8")
    changed = stored_as(deltas.changes(old, old.withColumn("amount", F.col("amount") + 5), deltas.PAYMENT), "changes")

    def facts(keys):
        raise AssertionError("facts were read")

    updated = deltas.update(stored, changed, parts, facts)
    text = plan(updated)
    assert "orders" not in text and "lineitem" not in text
    before = {r["merchant_id"]: r["total_payment_amount"] for r in stored.collect()}
    assert [r["total_payment_amount"] - before[r["merchant_id"]] for r in updated.collect()] == [5]


def test_buckets_follow_the_input(spark, monkeypatch):
    v = Views.of(spark, FOLDER)
    assert "out of 8" in plan(QUERIES["bucketed_payment_performance"](spark, FOLDER))
    monkeypatch.setattr(v, "_bytes", 33 * 4 * 1024 * 1024)
    monkeypatch.setattr("paylake.checks.views.fit_partitions", lambda *_: None)
    assert "out of 64" in plan(QUERIES["bucketed_payment_performance"](spark, FOLDER))


def test_kept_frames_have_no_partition_for_a_few_rows(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        kept = keep(spark.range(1000).selectExpr("id % 100 AS k").distinct())
        assert kept.count() == 100
        assert kept.rdd.getNumPartitions() < 50
        kept.unpersist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_kept_frames_take_no_memory_from_the_executors(spark):
    def stored():
        return {i.id(): i for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}

    before = set(stored())
    kept = keep(spark.range(20 * KEPT_ROWS).selectExpr("id", "CONCAT(REPEAT('x', 200), id) AS text"))
    try:
        assert kept.count() == 20 * KEPT_ROWS
        (found,) = [i for k, i in stored().items() if k not in before]
        assert found.memSize() == 0 and found.diskSize() > 0
        assert kept.where("text = CONCAT(REPEAT('x', 200), id)").count() == 20 * KEPT_ROWS
    finally:
        kept.unpersist()
    assert spark.conf.get("spark.sql.inMemoryColumnarStorage.batchSize") == str(KEPT_ROWS)


def test_a_table_without_rows_needs_no_join(spark, tmp_path):
    rows = spark.range(10).selectExpr("id AS k", "id AS v")
    empty = FolderTable(spark, f"{tmp_path}/none", ["k"], rows.schema).read()
    for joined in (rows.join(empty, "k", "left_anti"), upsert(empty, rows, ["k"]), restrict(empty, rows, "k").unionByName(rows)):
        assert "Join" not in joined._jdf.queryExecution().optimizedPlan().toString()
        assert joined.count() == 10


@pytest.mark.parametrize("option", ["prefilter", "most"])
def test_large_sets_of_payments_are_joined_once(spark, option):
    v = Views.of(spark, FOLDER)
    inputs = (v.payments(), v.merchants(), v.gateways(), v.payment_methods(), v.attempts(), v.payment_events(), v.refunds(),
              v.chargebacks(), v.settlements())
    keys = v.payments().where("payment_id % 5 = 0").select("payment_id")
    rebuilt = incremental.rebuild("payment_performance", keys, *inputs, **{option: True})
    plan = rebuilt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 1
    expected = restrict(gold.payment_performance(*inputs), keys, "payment_id")
    assert rebuilt.exceptAll(expected).isEmpty() and expected.exceptAll(rebuilt).isEmpty()
