import datetime as dt

from pyspark.sql import functions as F

from changeflow.operators.layout import zorder
from changeflow.operators.snapshots import SnapshotTable, change_feed, expired_versions
from changeflow.session import work_dir


def test_change_feed_types(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "k int, v string")
    gone = spark.createDataFrame([(1, "a")], "k int, v string")
    feed = change_feed(old, new, ["k"]).collect()
    assert sorted((r.k, r.v, r._change_type) for r in feed) == [
        (2, "B", "update_postimage"), (2, "b", "update_preimage"), (4, "d", "insert")]
    assert sorted(r._change_type for r in change_feed(old, gone, ["k"]).collect()) == ["delete", "delete"]


def test_versions_restore_and_retention(spark):
    t = SnapshotTable(spark, work_dir(spark, "test_snap"))
    base = spark.createDataFrame([(i, "ENVIADO" if i % 2 else "PAGO") for i in range(10)], "k int, status string")
    day = lambda n: dt.datetime(2024, 1, n)
    t.create(base, day(1))
    t.update({"status": "'ENTREGUE'"}, "status = 'ENVIADO'", day(2))
    t.delete(None, day(3))
    assert t.read().count() == 0
    v = t.restore(t.last_version_where("DELETE"), day(10))
    assert v == 3 and t.read().filter("status = 'ENTREGUE'").count() == 5
    assert t.read(0).filter("status = 'ENVIADO'").count() == 5  # time travel
    m = {r.version: r.operationMetrics for r in t.history().collect()}
    assert m[1]["numTargetRowsUpdated"] == "5" and m[2]["numTargetRowsDeleted"] == "10"
    exp = sorted(r.version for r in expired_versions(t.history(), day(10), 24 * 7).collect())
    assert exp == [0, 1]  # older than 7 days; the current version is never expired
    assert 3 not in [r.version for r in expired_versions(t.history(), dt.datetime(2030, 1, 1), 1).collect()]


def test_zorder_keeps_rows_and_prunes_files(spark, tmp_dir):
    df = spark.range(0, 20000).select((F.col("id") % 200).alias("a"), (F.col("id") * 7 % 1000).alias("b"), "id")
    out = zorder(df, ["a", "b"], rows_per_file=1000)
    path = f"{tmp_dir}/z"
    out.write.parquet(path)
    back = spark.read.parquet(path)
    assert back.count() == 20000 and back.agg(F.sum("id")).first()[0] == sum(range(20000))
    total = len(back.inputFiles())
    hit = back.filter((F.col("a") < 10) & (F.col("b") < 50)).select(F.input_file_name()).distinct().count()
    assert total >= 10 and hit < total / 2


def test_layout_splits_a_hot_key(spark, tmp_dir):
    from changeflow.operators.layout import clustered

    df = spark.range(0, 12000).select(F.when(F.col("id") < 8000, F.lit(1)).otherwise(F.col("id")).alias("a"), "id")
    for out, name in ((zorder(df, ["a"], rows_per_file=1000), "z"), (clustered(df, ["a"], rows_per_file=1000), "c")):
        out.write.parquet(f"{tmp_dir}/{name}")
        back = spark.read.parquet(f"{tmp_dir}/{name}")
        assert back.count() == 12000
        hot_files = back.filter("a = 1").select(F.input_file_name()).distinct().count()
        assert hot_files >= 4  # 8,000 rows of one value spread over several files


def test_commit_keeps_columns_that_start_with_an_underscore(spark, tmp_dir):
    import datetime as dt

    from changeflow.operators.snapshots import SnapshotTable

    t = SnapshotTable(spark, tmp_dir + "/t")
    t.create(spark.createDataFrame([(1, "x", 5), (2, None, 6)], "id int, _rescued_data string, __START_AT long"), dt.datetime(2024, 1, 1))
    t.update({"id": "id + 1"}, "id = 1", dt.datetime(2024, 1, 2))
    t.delete("__START_AT = 6", dt.datetime(2024, 1, 3))
    assert t.read().columns == ["id", "_rescued_data", "__START_AT"] and [tuple(r) for r in t.read().collect()] == [(2, "x", 5)]
