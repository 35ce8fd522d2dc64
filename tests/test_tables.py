import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.errors import UnsupportedOperationException

from paylake.operators.latest import keep_latest
from paylake.operators.upsert import upsert
from paylake.checks.views import Views
from paylake.session import MIB, cluster_conf, fit_partitions, scratch_dir, shuffle_partitions
from paylake.sources.kafka import kafka_options, stream_options
from paylake.sources.static import read_csv
from paylake.sources.tables import (
    FolderTable,
    Lake,
    LostWriteError,
    MergeTable,
    overwrite_table,
    read_table,
    with_removals,
)
from paylake.specs import STATIC

SCHEMA = "id string, v int, kafka_timestamp timestamp, partition int, offset bigint"


def frame(spark, *rows):
    made = [(i, v, dt.datetime(2024, 1, d) if d else None, p, o) for i, v, d, p, o in rows]
    return spark.createDataFrame(made, SCHEMA)


def state(df):
    return sorted(((r["id"], r["v"]) for r in df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    return FolderTable(spark, str(tmp_path / "t"), ["id"])


def test_keep_latest_order(spark):
    df = frame(spark, ("a", 1, 1, 0, 9), ("a", 2, 2, 0, 1), ("a", 3, 2, 1, 0), ("a", 4, 2, 1, 1),
               ("a", 5, None, 9, 9), (None, 6, 1, 0, 0), (None, 7, 2, 0, 0))
    assert state(keep_latest(df, ["id"])) == [("a", 4), (None, 7)]


def test_upsert_plan(spark):
    target = frame(spark, ("a", 1, 5, 0, 0), ("b", 1, 1, 0, 0), (None, 1, 1, 0, 0))
    source = frame(spark, ("a", 2, 1, 0, 0), ("b", 2, 2, 0, 0), ("c", 2, 1, 0, 0), (None, 2, 1, 0, 0))
    assert state(upsert(target, source, ["id"])) == [
        ("a", 2), ("b", 2), ("c", 2), (None, 1), (None, 2)]
    assert state(upsert(target, source, ["id"], newer_wins=True)) == [
        ("a", 1), ("b", 2), ("c", 2), (None, 1), (None, 2)]
    again = frame(spark, ("a", 3, 5, 0, 0))
    assert state(upsert(target, again, ["id"], newer_wins=True))[0] == ("a", 3)


def test_folder_table_last_batch_wins(spark, table):
    assert not table.exists()
    assert table.upsert(frame(spark, ("a", 1, 5, 0, 0), ("b", 1, 5, 0, 0)), "q-0")
    assert table.upsert(frame(spark, ("a", 2, 1, 0, 0), ("c", 2, 1, 0, 0)), "q-1")
    assert state(table.read()) == [("a", 2), ("b", 1), ("c", 2)]
    # The same batch again changes nothing; a new query may reuse the number.
    assert not table.upsert(frame(spark, ("a", 9, 1, 0, 0)), "q-1")
    assert table.upsert(frame(spark, ("a", 3, 1, 0, 0)), "other-1")
    assert state(table.read()) == [("a", 3), ("b", 1), ("c", 2)]


def test_folder_table_newer_wins(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), ["id"], newer_wins=True)
    table.upsert(frame(spark, ("a", 1, 5, 0, 0), ("b", 1, 1, 0, 0), ("z", 1, 1, 0, 0)))
    table.upsert(frame(spark, ("a", 2, 1, 0, 0), ("b", 2, 2, 0, 0)))
    table.upsert(frame(spark, ("b", 3, 1, 5, 5), ("c", 3, 1, 0, 0)))
    wanted = [("a", 1), ("b", 2), ("c", 3), ("z", 1)]
    assert state(table.read()) == wanted
    assert table.compact()
    assert state(table.read()) == wanted
    with pytest.raises(ValueError):
        table.upsert(table.read(), remove=table.read())


def test_folder_table_null_keys_stay_apart(spark, table):
    table.upsert(frame(spark, (None, 1, 1, 0, 0)))
    table.upsert(frame(spark, (None, 2, 1, 0, 0)))
    table.upsert(frame(spark, (None, 3, 1, 0, 0), ("a", 3, 1, 0, 0)))
    assert state(table.read()) == [("a", 3), (None, 1), (None, 2), (None, 3)]


def test_folder_table_remove(spark, table):
    table.upsert(frame(spark, ("a", 1, 1, 0, 0), ("b", 1, 1, 0, 0)))
    affected = spark.createDataFrame([("a",), ("b",), ("never",)], "id string")
    table.upsert(frame(spark, ("b", 2, 1, 0, 0)), remove=affected)
    assert state(table.read()) == [("b", 2)]
    table.upsert(frame(spark, ("a", 3, 1, 0, 0)))
    assert state(table.read()) == [("a", 3), ("b", 2)]


def test_folder_table_compact_and_clean(spark, table):
    table.upsert(frame(spark, ("a", 1, 1, 0, 0)), "q-0")
    assert not table.compact()
    table.upsert(frame(spark, ("a", 2, 1, 0, 0)), "q-1")
    assert table.compact()
    assert state(table.read()) == [("a", 2)]
    assert not table.upsert(frame(spark, ("a", 9, 1, 0, 0)), "q-1")
    assert table.clean() == 2
    assert state(table.read()) == [("a", 2)]
    fresh = FolderTable(spark, table.path, ["id"])
    assert fresh.schema.fieldNames() == ["id", "v", "kafka_timestamp", "partition", "offset"]


def test_unfinished_write_is_invisible(spark, table, tmp_path):
    table.upsert(frame(spark, ("a", 1, 1, 0, 0)), "q-0")
    frame(spark, ("a", 9, 1, 0, 0)).write.parquet(f"{table.path}/000000000001-part-q-1")
    (tmp_path / "t" / "000000000001-part-q-1" / "_SUCCESS").unlink()
    assert state(table.read()) == [("a", 1)]
    assert table.upsert(frame(spark, ("a", 2, 1, 0, 0)), "q-1")
    assert state(table.read()) == [("a", 2)]


def test_write_without_marker_raises(spark, table):
    table.upsert(frame(spark, ("a", 1, 1, 0, 0)), "q-0")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        with pytest.raises(LostWriteError):
            table.upsert(frame(spark, ("a", 2, 1, 0, 0)), "q-1")
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert state(table.read()) == [("a", 1)]


def test_foreign_folders_are_left_alone(spark, table, tmp_path):
    table.upsert(frame(spark, ("a", 1, 1, 0, 0)))
    table.overwrite(frame(spark, ("b", 1, 1, 0, 0)))
    (tmp_path / "t" / "notes-of-mine").mkdir()
    assert state(table.read()) == [("b", 1)]
    assert table.clean() == 1
    assert (tmp_path / "t" / "notes-of-mine").exists()


def test_rebuilt_rows_are_evaluated_once(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").groupBy("o_custkey").count()
    text = with_removals(rows, rows.select("o_custkey").limit(5), ["o_custkey"])
    plan = text._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [o_orderkey") == 2  # the rows, and the key set made from the same file


def test_overwrite_replaces_rows_and_schema(spark, table):
    table.upsert(frame(spark, ("a", 1, 1, 0, 0)))
    table.overwrite(spark.createDataFrame([("z", "text")], "id string, note string"))
    assert table.read().collect() == [("z", "text")]


def test_missing_table(spark, tmp_path):
    with pytest.raises(ValueError):
        FolderTable(spark, str(tmp_path / "none"), ["id"]).read()
    known = FolderTable(spark, str(tmp_path / "none"), ["id"], frame(spark).schema)
    assert known.read().count() == 0


def test_merge_statement(spark):
    statement = MergeTable(spark, "c.s.t", ["a", "b"], newer_wins=True).merge_statement(["a", "v"])
    assert "ON target.a = source.a AND target.b = source.b" in statement
    assert "UPDATE SET target.`a` = source.`a`, target.`v` = source.`v` " in statement
    assert "INSERT (`a`, `v`) VALUES (source.`a`, source.`v`)" in statement
    assert "struct(source.kafka_timestamp, source.partition, source.offset) >=" in statement
    # Spark accepts the statement up to the point where the format has to support it.
    spark.sql("DROP TABLE IF EXISTS merge_target")
    spark.sql("CREATE TABLE merge_target (id string, v int) USING parquet")
    target = MergeTable(spark, "merge_target", ["id"], fmt="parquet")
    source = spark.createDataFrame([("a", 1)], "id string, v int")
    with pytest.raises(UnsupportedOperationException, match="MERGE"):
        target.upsert(source, remove=source)
    spark.sql("DROP TABLE merge_target")


def test_lake_locations(spark):
    assert Lake(spark, "/data/").location("silver", "payments") == "/data/silver/payments"
    assert Lake(spark, "dev", "delta").location("gold", "x") == "dev.gold.x"
    assert isinstance(Lake(spark, "dev", "delta").keyed("gold", "x", ["k"]), MergeTable)


def test_catalog_tables(spark):
    overwrite_table(spark.range(3).toDF("id"), "plain_table")
    overwrite_table(spark.range(2).selectExpr("id AS other"), "plain_table", replace_schema=True)
    assert read_table(spark, "plain_table").columns == ["other"]
    spark.sql("DROP TABLE plain_table")


def test_csv(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("gateway_id,gateway_name,provider,gateway_type,status\nG1,n,p,,Active\n")
    spec = next(s for s in STATIC if s.table == "payment_gateways")
    assert read_csv(spark, str(path), spec.schema).first()["gateway_type"] is None
    (tmp_path / "y.csv").write_text("id,phone,created_at\n1,+9163,2024-01-01 00:00:00\n")
    inferred = dict(read_csv(spark, str(tmp_path / "y.csv")).dtypes)
    assert inferred == {"id": "int", "phone": "int", "created_at": "timestamp"}


def test_kafka_options():
    options = kafka_options("h:9092", "u", "p")
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="u" password="p"' in options["kafka.sasl.jaas.config"]
    merged = stream_options(kafka_options("h:9092"), ["a", "b"], max_offsets_per_trigger=5)
    assert merged == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "a,b",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5",
    }


def test_scratch_dir_follows_the_session(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")

    def session(shared, master):
        conf = SimpleNamespace(get=lambda key, default: shared)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert scratch_dir(session("s3a://b/shared/", "yarn"), "x").startswith("s3a://b/shared/x-")
    with pytest.raises(ValueError):
        scratch_dir(session(None, "yarn"), "x")


def test_partitions_follow_the_data():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(100 * 1024**4) == 409600
    assert cluster_conf(1024**4)["spark.sql.shuffle.partitions"] == "4096"


def test_partitions_follow_the_input(spark, tmp_path):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        fit_partitions(spark, 10 * MIB)
        assert {n: spark.conf.get(n, None) for n in names} == before
        fit_partitions(spark, 6 * 1024 * MIB)
        assert [spark.conf.get(n) for n in names] == ["1536", str(16 * MIB)]
        fit_partitions(spark, MIB)
        assert spark.conf.get(names[0]) == "1536"
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
    spark.range(10).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(10).write.parquet(f"{tmp_path}/lineitem.parquet")
    v = Views.of(spark, str(tmp_path))
    assert v.fact_bytes() == sum(f.stat().st_size for f in tmp_path.rglob("*") if f.is_file() and not f.name.startswith(".")) > 0
