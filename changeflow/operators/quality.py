"""Row-level data-quality rules: warn, drop, fail — plus quarantine and metrics.

A rule *passes* only when its predicate is TRUE; FALSE and NULL are violations
(three-valued logic would otherwise let NULL rows vanish from both the valid and
the quarantine side). The quarantine is the exact complement of the valid rows
and records every violated rule in an array column.

Everything is a narrow projection/filter (no shuffle); rule totals are one
global aggregate with map-side partial counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    """An expectation: ``name`` EXPECT (``predicate``) ON VIOLATION ``action``.

    ``reason`` is the label written to the quarantine array (defaults to ``name``).
    """

    name: str
    predicate: str
    action: str = WARN
    reason: str | None = None

    def __post_init__(self):
        if self.action not in (WARN, DROP, FAIL):
            raise ValueError(f"rule {self.name}: action must be warn, drop or fail")

    @property
    def label(self) -> str:
        return self.reason or self.name

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def _all(cols: Iterable[Column]) -> Column:
    out = None
    for c in cols:
        out = c if out is None else (out & c)
    return F.lit(True) if out is None else out


def fail_guard(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Abort the job on any row violating a FAIL rule.

    Written as a *filter* whose condition raises: a projected guard column is
    pruned away when nothing reads it, a filter is always evaluated.
    """
    guards = [r for r in rules if r.action == FAIL]
    for r in guards:
        df = df.filter(
            F.when(r.passes(), F.lit(True)).otherwise(
                F.raise_error(F.lit(f"expectation {r.name} violated (ON VIOLATION FAIL UPDATE)"))
            )
        )
    return df


def valid_condition(rules: Sequence[Rule]) -> Column:
    return _all(r.passes() for r in rules if r.action == DROP)


def violations(rules: Sequence[Rule], actions=(DROP,)) -> Column:
    """Array of labels of the violated rules, in rule order."""
    labels = [F.when(~r.passes(), F.lit(r.label)) for r in rules if r.action in actions]
    if not labels:
        return F.array().cast("array<string>")
    return F.filter(F.array(*labels), lambda x: x.isNotNull())


def split_valid(df: DataFrame, rules: Sequence[Rule], reasons_col: str = "regras_violadas"):
    """Return (valid, quarantine). FAIL rules guard both; quarantine = NOT all DROP rules pass."""
    guarded = fail_guard(df, rules)
    ok = valid_condition(rules)
    valid = guarded.filter(ok)
    quarantine = guarded.filter(~ok).withColumn(reasons_col, violations(rules))
    return valid, quarantine


def rule_counts(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """Passed / failed totals per rule over all input rows: one pass, one tiny global aggregate."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(r.passes()).alias(f"_p{i}") for i, r in enumerate(rules)]
    totals = df.agg(*aggs)
    rows = ", ".join(f"'{r.name}', '{r.action}', _p{i}" for i, r in enumerate(rules))
    return totals.selectExpr(
        f"stack({len(rules)}, {rows}) AS (regra, acao, aprovados)", "_total"
    ).select(
        F.lit(dataset).alias("dataset"),
        "regra",
        "acao",
        F.col("aprovados").cast("bigint").alias("aprovados"),
        (F.col("_total") - F.col("aprovados")).cast("bigint").alias("reprovados"),
    )


def observe_rules(df: DataFrame, rules: Sequence[Rule], name: str):
    """Attach per-rule counters to ``df`` as a Spark Observation (batch and streaming).

    Returns (observed_df, observation); the metrics are filled once an action ran.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, *rule_metric_columns(rules)), obs


def rule_metric_columns(rules: Sequence[Rule]) -> list[Column]:
    """Aggregate Columns for ``DataFrame.observe``: rows, failures per rule, dropped rows."""
    cols = [F.count(F.lit(1)).alias("rows")]
    cols += [F.count_if(~r.passes()).alias(f"failed_{r.name}") for r in rules]
    cols.append(F.count_if(~valid_condition(rules)).alias("dropped_records"))
    return cols
