"""Driver contract and the oracle gate: every key with oracle SQL must match DuckDB exactly."""

import os
import sys

import duckdb
import pytest

from conftest import SF_SMOKE

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import rows_key  # noqa: E402
from changeflow.plans.catalog import QUERIES  # noqa: E402
from changeflow.sources.tables import TABLES  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "receita_dia" in df.columns


def test_oracle_keys_are_query_keys():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMOKE, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], plan
    s_rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(s_rows) >= 0
        return
    res = duck.execute(sql)
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_key(df.columns, s_rows) == rows_key(d_cols, res.fetchall())


def test_pipeline_update_rerun_is_idempotent(spark):
    """Re-running an update (as after a driver failure) re-reads no landing file twice."""
    from changeflow.plans.pipeline import Pipeline

    p = Pipeline(spark, SF_SMOKE)
    p.update(1)
    counts = {n: p.read("silver", n).count() for n in ("pedidos_eventos_validos", "pedidos_quarentena")}
    current = p.current("silver", "clientes").count()
    files = sorted(map(tuple, p.file_ledger().collect()))
    assert sum(f[2] for f in files if f[0] == "pedidos_raw") == p.read("bronze", "pedidos_raw").count()
    p.update(1)
    assert sorted(map(tuple, p.file_ledger().collect())) == files
    assert {n: p.read("silver", n).count() for n in counts} == counts
    assert p.current("silver", "clientes").count() == current


def test_foreign_table_of_the_same_name_stays(spark):
    """Registering a run replaces tables of earlier runs only."""
    from changeflow.plans.pipeline import Pipeline, register_tables, run_pipeline

    p = run_pipeline(spark, SF_SMOKE)
    register_tables(p)
    masked = spark.table("gold.dim_clientes")
    assert masked.where("email NOT LIKE '***@%' OR cpf NOT LIKE '***%' OR telefone NOT LIKE '****%'").count() == 0
    spark.sql("DROP TABLE silver.pedidos")
    spark.sql("CREATE TABLE silver.pedidos AS SELECT 7 AS mine")
    with pytest.raises(ValueError):
        register_tables(p)
    assert spark.table("silver.pedidos").columns == ["mine"]
    spark.sql("DROP TABLE silver.pedidos")
    register_tables(p)
    assert isinstance(p, Pipeline)
