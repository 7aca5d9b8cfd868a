import json
import os

from pyspark.sql import functions as F

from changeflow.sources.ingest import csv_stream, json_stream, rescue_json, schema_with_hints
from changeflow.streaming.runner import StreamTarget, read_sink, run_available_now

HINTS = "id BIGINT, qty INT, name STRING"


def test_rescue_json_cases(spark):
    lines = spark.createDataFrame(
        [('{"id": 1, "qty": 2, "name": "a"}',),
         ('{"id": 2, "qty": "two", "name": "b"}',),
         ('{"id": 3, "qty": 1, "extra": "x"}',),
         ('{"id": 4, "qty": null, "name": null}',),
         ("not json at all",)],
        "value string",
    )
    out = {r.id: (r.qty, r._rescued_data) for r in rescue_json(lines, schema_with_hints(HINTS)).collect()}
    assert out[1] == (2, None)
    assert out[2][0] is None and json.loads(out[2][1]) == {"qty": "two"}
    assert json.loads(out[3][1]) == {"extra": "x"}
    assert out[4] == (None, None)  # explicit nulls are not rescued
    assert out[None] == (None, "not json at all")


def test_json_stream_resume_reads_each_file_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(os.path.join(landing, "lote=1"))
    with open(os.path.join(landing, "lote=1", "a.json"), "w") as f:
        f.write('{"id": 1, "qty": 1}\n{"id": 2, "qty": "x"}\n')
    target = StreamTarget.create(spark, "test_json_stream")
    schema = schema_with_hints(HINTS)
    run_available_now(json_stream(spark, os.path.join(landing, "*"), schema), target)
    assert read_sink(spark, target).count() == 2
    os.makedirs(os.path.join(landing, "lote=2"))
    with open(os.path.join(landing, "lote=2", "b.json"), "w") as f:
        f.write('{"id": 3, "qty": 3}\n')
    run_available_now(json_stream(spark, os.path.join(landing, "*"), schema), target)
    run_available_now(json_stream(spark, os.path.join(landing, "*"), schema), target)  # nothing new
    sink = read_sink(spark, target)
    assert sorted(r.id for r in sink.collect()) == [1, 2, 3]
    assert sink.filter(F.col("arquivo_origem").contains("lote=2")).count() == 1


def test_csv_stream_rescues_bad_cast(spark, tmp_dir):
    d = os.path.join(tmp_dir, "csv", "lote=1")
    os.makedirs(d)
    with open(os.path.join(d, "p.csv"), "w") as f:
        f.write("id,qty,name\n1,5,a\n2,five,b\n")
    target = StreamTarget.create(spark, "test_csv_stream")
    run_available_now(csv_stream(spark, os.path.join(tmp_dir, "csv", "*"), schema_with_hints(HINTS)), target)
    out = {r.id: (r.qty, r._rescued_data) for r in read_sink(spark, target).collect()}
    assert out[1] == (5, None)
    assert out[2][0] is None and json.loads(out[2][1]) == {"qty": "five"}


def test_repeated_keys_are_rescued_and_do_not_stop(spark):
    from pyspark.sql import types as T

    from changeflow.sources.ingest import rescue_json

    lines = ['{"id":1,"x":"1","x":"2"}', '{"id":2,"id":3}', '{"id":4}']
    got = rescue_json(spark.createDataFrame([(x,) for x in lines], "value string"), T.StructType.fromDDL("id long")).collect()
    assert [r["_rescued_data"] for r in got] == [lines[0], lines[1], None] and got[0]["id"] == 1


def test_csv_with_another_header_stops(spark, tmp_dir):
    import pytest
    from pyspark.sql import types as T

    from changeflow.sources.ingest import csv_stream
    from changeflow.streaming.runner import StreamTarget, run_available_now

    schema = T.StructType.fromDDL("id long, qty long, name string")
    spark.createDataFrame([("bob", 1, 5)], "name string, id long, qty long").coalesce(1).write.option("header", True).csv(f"{tmp_dir}/in")
    with pytest.raises(Exception):
        run_available_now(csv_stream(spark, f"{tmp_dir}/in", schema), StreamTarget.create(spark, "csv"))


def test_batch_of_path_without_batch_is_null(spark):
    from changeflow.sources.ingest import batch_of

    df = spark.createDataFrame([("/x/a.json",), ("/x/lote=7/a.json",)], "arquivo_origem string")
    assert [r[0] for r in df.select(batch_of()).collect()] == [None, 7]


def test_csv_columns_are_mapped_by_each_files_header(spark, tmp_dir):
    from changeflow.sources.ingest import run_csv_by_header

    d = os.path.join(tmp_dir, "in")
    os.makedirs(os.path.join(d, "lote=1"))
    files = {
        "a.csv": "id,qty,name\n1,5,a\n2,five,b\n",
        "b.csv": 'extra, name ,id\n"x, ""y""",c,3\n,d,4\n\nname,name,id\n',
        "c.csv": "name,name,id\ne,f,5\ng,,6,7,8\n",
        "d.csv": "id\n",
    }
    for name, text in files.items():
        with open(os.path.join(d, "lote=1", name), "w") as f:
            f.write(text)
    target = StreamTarget.create(spark, "csv_headers")
    schema = schema_with_hints(HINTS)
    run_csv_by_header(spark, os.path.join(d, "*"), schema, target)

    def rows():
        return sorted(((r.id, r.qty, r.name, json.loads(r._rescued_data) if r._rescued_data else None) for r in read_sink(spark, target).collect()), key=repr)

    first = [
        (1, 5, "a", None), (2, None, "b", {"qty": "five"}), (3, None, "c", {"extra": 'x, "y"'}), (4, None, "d", None),
        (5, None, "e", {"name#2": "f"}), (6, None, "g", {"_linha": "g,,6,7,8"}), (None, None, "name", {"id": "id", "extra": "name"}),
    ]
    assert rows() == sorted(first, key=repr)
    run_csv_by_header(spark, os.path.join(d, "*"), schema, target)  # nothing new
    os.makedirs(os.path.join(d, "lote=2"))
    with open(os.path.join(d, "lote=2", "e.csv"), "w") as f:
        f.write("qty,id\n9,7\n")
    run_csv_by_header(spark, os.path.join(d, "*"), schema, target)
    assert rows() == sorted([*first, (7, 9, None, None)], key=repr)


def test_only_lines_with_something_to_rescue_are_parsed_again(spark):
    """A line of as many keys as typed values is clean; the string map is parsed for the others alone, with the same results."""
    lines = {
        '{"pedido_id":1,"quantidade":2}': (1, 2, None),
        '{"pedido_id":1,"quantidade":null}': (1, None, None),
        '{"pedido_id":1,"pedido_id":2}': (2, None, '{"pedido_id":1,"pedido_id":2}'),
        '{"pedido_id":1,"quantidade":"3 un"}': (1, None, '{"quantidade":"3 un"}'),
        '{"pedido_id":1,"cupom":"A"}': (1, None, '{"cupom":"A"}'),
        '{"quantidade":"3 un","cupom":"A"}': (None, None, '{"quantidade":"3 un","cupom":"A"}'),
        "{'pedido_id':1}": (1, None, None),
        "{}": (None, None, None),
        "#corrupt": (None, None, "#corrupt"),
    }
    df = spark.createDataFrame([(t, t) for t in lines], "line string, value string")
    out = rescue_json(df, schema_with_hints("pedido_id BIGINT, quantidade INT"))
    assert {r["line"]: (r["pedido_id"], r["quantidade"], r["_rescued_data"]) for r in out.collect()} == lines
    assert "CASE WHEN NOT _clean" in out._jdf.queryExecution().analyzed().toString()


def test_landing_is_compressed_in_many_files(spark, tmp_dir, monkeypatch):
    from changeflow.plans import pipeline as pl

    monkeypatch.setitem(pl.LANDED, "maxRecordsPerFile", 100)
    p = pl.Pipeline(spark, "/root/testdata/sf0.001", root=tmp_dir)
    p.lote = 1
    p.land()
    for entity in ("clientes", "pedidos", "produtos"):
        files = [f for f in os.listdir(os.path.join(tmp_dir, "landing", entity, "lote=1")) if f.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
    orders = spark.read.text(os.path.join(tmp_dir, "landing", "pedidos"))
    assert len(orders.inputFiles()) * 100 >= orders.count()


def test_stream_shuffles_grow_with_rows(spark):
    from changeflow.streaming.runner import partitions_for

    assert partitions_for(spark, 0) == spark.sparkContext.defaultParallelism
    assert partitions_for(spark, 200_000_001) == 201
