import datetime as dt
import os

from pyspark.sql import functions as F

from changeflow.streaming.runner import StreamTarget, read_sink, run_available_now
from changeflow.streaming.windows import dedup_within_watermark, orders_per_hour

SCHEMA = "pedido_id bigint, quantidade int, preco_unitario double, status string, canal string, pedido_ts timestamp"


def _write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("errorifexists").parquet(path)


def test_late_row_after_watermark_is_dropped(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    _write(spark, [(1, 1, 10.0, "CRIADO", "app", t(0, 10)), (2, 1, 5.0, "CRIADO", "app", t(5, 0))], os.path.join(src, "b1"))
    target = StreamTarget.create(spark, "test_hourly")
    stream = lambda: orders_per_hour(spark.readStream.schema(SCHEMA).parquet(os.path.join(src, "*")))
    run_available_now(stream(), target)
    # second file: a row for the 00:00 window, now older than the watermark (05:00 - 2h)
    _write(spark, [(3, 1, 7.0, "CRIADO", "app", t(0, 20)), (4, 1, 1.0, "CRIADO", "app", t(9, 0))], os.path.join(src, "b2"))
    run_available_now(stream(), target)
    out = {r.janela_inicio.hour: r.qtd_pedidos for r in read_sink(spark, target).collect()}
    assert out[0] == 1          # late row did not reopen the closed window
    assert out.get(5) == 1      # 05:00 window closed once 09:00 arrived (watermark 07:00)
    assert 9 not in out         # still open


def test_dedup_within_watermark(spark, tmp_dir):
    src = os.path.join(tmp_dir, "dedup")
    t = dt.datetime(2024, 1, 1, 0, 0)
    _write(spark, [(1, 1, 1.0, "CRIADO", "app", t), (1, 1, 1.0, "CRIADO", "app", t), (2, 1, 1.0, "PAGO", "app", t)], src)
    target = StreamTarget.create(spark, "test_dedup")
    s = spark.readStream.schema(SCHEMA).parquet(src)
    run_available_now(dedup_within_watermark(s, ["pedido_id", "pedido_ts"], "pedido_ts"), target)
    assert sorted(r.pedido_id for r in read_sink(spark, target).collect()) == [1, 2]


def test_naive_times_ignore_session_zone(spark):
    from changeflow.functions.timeutil import instant_to_ntz, ntz_text, ntz_to_instant

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # 2001-10-14 00:00 does not exist on Sao Paulo wall clocks (DST start)
        df = spark.sql("SELECT TIMESTAMP_NTZ '2001-10-14 00:00:00' AS t")
        r = df.select(instant_to_ntz(ntz_to_instant("t")).alias("back"), ntz_text("t").alias("txt"),
                      F.window(ntz_to_instant("t"), "1 hour").start.alias("w")).select(
            "back", "txt", instant_to_ntz("w").alias("w")).first()
        assert r.back == dt.datetime(2001, 10, 14) and r.txt == "2001-10-14 00:00:00" and r.w == dt.datetime(2001, 10, 14)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_fail_rule_aborts_streaming_flow(spark, tmp_dir):
    import pytest

    from changeflow.operators.quality import split_valid
    from changeflow.plans.silver import PRODUCT_RULES

    src = os.path.join(tmp_dir, "produtos")
    spark.createDataFrame([(1, "a"), (None, "b")], "produto_id bigint, nome_produto string").write.parquet(src)
    stream = spark.readStream.schema("produto_id bigint, nome_produto string").parquet(src)
    valid, _ = split_valid(stream, PRODUCT_RULES)
    with pytest.raises(Exception, match="produto_id_obrigatorio"):
        run_available_now(valid, StreamTarget.create(spark, "test_fail_stream"))


def test_streams_read_tables_that_are_folders(spark, tmp_dir):
    from conftest import SF_SMOKE

    from changeflow.sources.tables import read_table, stream_table
    from changeflow.streaming.runner import StreamTarget, read_sink, run_available_now

    events = read_table(spark, SF_SMOKE, "events")
    events.repartition(3).write.parquet(f"{tmp_dir}/events.parquet")
    for sf_dir in (tmp_dir, SF_SMOKE):
        target = StreamTarget.create(spark, "events_copy")
        run_available_now(stream_table(spark, sf_dir, "events", events.schema), target)
        assert read_sink(spark, target).count() == events.count()


def test_totals_of_many_batches_are_complete(spark):
    """More micro-batches than a query keeps progress reports for."""
    from pyspark.sql import functions as F

    from conftest import SF_SMOKE

    from changeflow.operators.quality import Rule
    from changeflow.plans.pipeline import Pipeline

    p = Pipeline(spark, SF_SMOKE)
    p.lote, p.update_id = 1, "update-1"
    source = f"{p.root}/numbers"
    spark.range(0, 1500, 1, 150).write.parquet(source)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
    p.run_flow("numbers", stream, "silver", "numbers", [Rule("even", "id % 2 = 0", "drop")])
    assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == kept
    p.flush()
    import json

    details = json.loads(p.event_log().where(F.col("event_type") == "flow_progress").first()["details"])["flow_progress"]
    assert details["metrics"]["num_output_rows"] == 750
    assert details["data_quality"]["expectations"][0] == {"name": "even", "dataset": "numbers", "passed_records": 750, "failed_records": 750}
    table = p.metrics.table()
    assert table.count() == 150 and table.agg(F.max("batch_id")).first()[0] == 149
    # A batch that reports again, as after a failure, counts once.
    again = table.where("batch_id = 7").withColumn("recorded_at", F.expr("recorded_at + INTERVAL 1 HOUR"))
    again.select("flow", "batch_id", "run", "recorded_at", "metrics").write.mode("append").parquet(p.metrics.path)
    assert {(r["name"], r["total"]) for r in p.metrics.totals().collect()} == {
        ("rows", 1500), ("output_rows", 750), ("failed_even", 750), ("dropped_records", 750)}


def test_guard_that_aborts_is_logged(spark):
    import pytest
    from pyspark.sql import functions as F

    from conftest import SF_SMOKE

    from changeflow.operators.quality import Rule, fail_guard
    from changeflow.plans.pipeline import Pipeline

    p = Pipeline(spark, SF_SMOKE)
    p.lote, p.update_id = 1, "update-1"
    rules = (Rule("positive", "id > 0", "fail"),)
    with pytest.raises(Exception, match="positive"):
        p.write_observed(spark.range(5), "gold", "guarded", "guarded", rules, lambda rows: fail_guard(rows, rules))
    p.write_observed(spark.range(1, 5), "gold", "guarded", "guarded", rules, lambda rows: fail_guard(rows, rules))
    p.flush()
    import json

    log = p.event_log().where(F.col("event_type") == "flow_progress").orderBy("timestamp").collect()
    failed, done = [json.loads(r["details"])["flow_progress"] for r in log]
    assert failed["status"] == "FAILED" and "positive" in failed["error"]
    assert done["data_quality"]["expectations"][0]["passed_records"] == 4 and done["metrics"]["num_output_rows"] == 4


def test_late_file_in_an_old_folder_is_applied_and_old_updates_stay(spark):
    from conftest import SF_SMOKE

    from changeflow.plans.pipeline import Pipeline

    p = Pipeline(spark, SF_SMOKE)
    p.update(1)
    first = sorted(map(tuple, spark.read.parquet(p.table_path("silver", "pedidos", 1)).collect()), key=repr)
    line = '{"cliente_id":990001,"nome":"Late","email":"a@b.c","cpf":"12345678901","telefone":"11987654321","cidade":"X","uf":"sp","data_nascimento":"1980-01-01","operacao":"INSERT","evento_seq":1,"evento_ts":"2024-01-01T00:00:00.000"}'
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{p.root}/landing/clientes/lote=1")
    p.update(2)
    assert p.current("silver", "clientes").where("cliente_id = 990001").count() == 1
    p.update(1)
    assert sorted(map(tuple, spark.read.parquet(p.table_path("silver", "pedidos", 1)).collect()), key=repr) == first
