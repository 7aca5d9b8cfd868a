import pytest
from pyspark.sql import functions as F

from changeflow.operators.quality import DROP, FAIL, WARN, Rule, rule_counts, split_valid
from changeflow.plans import silver

ORDER_COLS = "pedido_id bigint, cliente_id bigint, produto_id bigint, quantidade int, preco_unitario double, " \
    "status string, canal string, pedido_ts timestamp_ntz, evento_ts timestamp_ntz, desempate bigint"


def _orders(spark, rows):
    return spark.createDataFrame(rows, ORDER_COLS)


def test_null_status_goes_to_quarantine_not_lost(spark):
    import datetime as dt

    t = dt.datetime(2000, 1, 1)
    rows = [
        (1, 1, 1, 1, 10.0, "PAGO", "app", t, t, 0),
        (2, 1, 1, 1, 10.0, None, "app", t, t, 0),          # NULL status: NOT(... AND NULL) is NULL
        (3, None, 1, -1, 10.0, "PERDIDO", None, t, t, 0),  # several violations, NULL channel only warns
    ]
    ev = _orders(spark, rows)
    valid, quarantine = split_valid(ev, silver.ORDER_RULES)
    assert sorted(r.pedido_id for r in valid.collect()) == [1]
    q = {r.pedido_id: r.regras_violadas for r in quarantine.collect()}
    assert q[2] == ["status_invalido"]
    assert q[3] == ["cliente_id_nulo", "quantidade_invalida", "status_invalido"]
    assert valid.count() + quarantine.count() == ev.count()


def test_warn_rule_keeps_row_and_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, c string")
    rules = [Rule("c_present", "c IS NOT NULL", WARN), Rule("id_present", "id IS NOT NULL", DROP)]
    valid, quarantine = split_valid(df, rules)
    assert valid.count() == 2 and quarantine.count() == 0
    counts = {r.regra: (r.aprovados, r.reprovados) for r in rule_counts(df, rules, "d").collect()}
    assert counts == {"c_present": (1, 1), "id_present": (2, 0)}


def test_fail_rule_aborts(spark):
    df = spark.createDataFrame([(1,), (None,)], "produto_id int")
    valid, _ = split_valid(df, [Rule("produto_id_obrigatorio", "produto_id IS NOT NULL", FAIL)])
    with pytest.raises(Exception, match="produto_id_obrigatorio"):
        valid.count()


def test_fail_guard_survives_column_pruning(spark):
    from changeflow.plans.gold import DAILY_SALES_RULES
    from changeflow.operators.quality import fail_guard

    df = spark.createDataFrame([(1, -5.0)], "k int, receita_dia double")
    with pytest.raises(Exception, match="receita_nao_negativa"):
        fail_guard(df, DAILY_SALES_RULES).select("k").count()


def test_customer_rules_waive_email_and_cpf_for_delete(spark):
    df = spark.createDataFrame(
        [(1, 10, "DELETE", None, None, "SP"), (2, 20, "UPDATE", "no-at", "12345678901", "SP"),
         (3, 30, "UPDATE", "a@b", "123", "SP"), (4, 40, "UPSERT", "a@b", "12345678901", None)],
        "cliente_id int, evento_seq bigint, operacao string, email string, cpf string, uf string",
    )
    valid, quarantine = split_valid(df, silver.CUSTOMER_RULES)
    assert [r.cliente_id for r in valid.collect()] == [1]
    reasons = {r.cliente_id: r.regras_violadas for r in quarantine.collect()}
    assert reasons == {2: ["email_valido"], 3: ["cpf_valido"], 4: ["operacao_valida"]}
