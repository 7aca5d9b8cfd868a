"""Governance queries: masked dimension, row filter, regional view and counts, policy reload."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.masks import apply_masks, mask_format_preview, row_filter
from ..sources import fixtures as fx
from . import gold, silver
from . import oracle as O
from .registry import query

# The reader whose view the regional queries show.
ANALYST = ("analysts",)

# The analysts' regions after the policy reload.
RELOADED_ANALYST_REGIONS = ("SP", "RJ", "MG", "GO", "DF")

DIM_SQL = """dim AS (
  SELECT cliente_id, nome, email, cpf, telefone, cidade, uf, data_nascimento, __START_AT AS vigente_desde_evento_seq
  FROM scd2_customers WHERE __END_AT IS NULL)"""

# Each mask as a pattern whose group is what stays visible: no match, no visible part.
MASK_PATTERNS = (("email", "^[^@]*@([^@]*)", "***@", "***@desconhecido"), ("cpf", "(..)$", "***.***.*", "***.***.*-**"), ("telefone", "(....)$", "****", "****"))
MASKED_SELECT = "SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN regexp_matches({c}, '{p}') THEN '{before}' || regexp_extract({c}, '{p}', 1) ELSE '{instead}' END AS {c}" for c, p, before, instead in MASK_PATTERNS
) + ") FROM dim"

ANALYST_FILTER = "uf IN (SELECT uf FROM region_policy WHERE grupo = 'analysts')"


def _dim(spark, sf_dir):
    return gold.masked_dimension_source(silver.current_customers(spark, sf_dir))


@query("masked_customers", O.with_(*O.CUST, DIM_SQL) + MASKED_SELECT)
def masked_customers(spark, sf_dir):
    """The current customer dimension as a reader outside the PII groups sees it."""
    return apply_masks(_dim(spark, sf_dir), groups=())


@query(
    "unmasked_customers",
    O.with_(*O.CUST, DIM_SQL) + "SELECT * FROM dim",
)
def unmasked_customers(spark, sf_dir):
    """The same dimension for a PII reader: values pass through."""
    return apply_masks(_dim(spark, sf_dir), groups=("pii_readers",))


@query(
    "mask_format_preview",
    O.with_(*O.CUST, DIM_SQL)
    + """SELECT '***@' || string_split(email, '@')[2] AS email_mascarado,
       '***.***.*' || right(cpf, 2) AS cpf_mascarado,
       '****' || right(telefone, 4) AS telefone_mascarado
FROM dim""",
)
def mask_format_preview_query(spark, sf_dir):
    return mask_format_preview(_dim(spark, sf_dir))


@query(
    "row_filter_regions",
    O.with_(*O.CUST, DIM_SQL, O.REGION_POLICY) + f"SELECT cliente_id, uf FROM dim WHERE {ANALYST_FILTER}",
)
def row_filter_regions(spark, sf_dir):
    return row_filter(_dim(spark, sf_dir), fx.region_policy(spark), ANALYST).select("cliente_id", "uf")


@query(
    "regional_customers",
    O.with_(*O.CUST, DIM_SQL, O.REGION_POLICY) + f"SELECT * FROM ({MASKED_SELECT}) m WHERE {ANALYST_FILTER}",
)
def regional_customers(spark, sf_dir):
    """Masks plus row filter: the regional view for an analyst."""
    return apply_masks(row_filter(_dim(spark, sf_dir), fx.region_policy(spark), ANALYST), ANALYST)


@query(
    "regional_counts",
    O.with_(*O.CUST, DIM_SQL, O.REGION_POLICY) + f"SELECT uf, count(*) AS clientes FROM dim WHERE {ANALYST_FILTER} GROUP BY uf",
)
def regional_counts(spark, sf_dir):
    v = regional_customers(spark, sf_dir)
    return v.groupBy("uf").agg(F.count(F.lit(1)).alias("clientes"))


def reload_group(policy, group: str, regions) -> "DataFrame":  # noqa: F821
    """Idempotent reload of one group's grants: DELETE WHERE grupo = g, then INSERT the new rows."""
    spark = policy.sparkSession
    new_rows = spark.createDataFrame([(group, r) for r in regions], "grupo string, uf string")
    kept = policy.filter(~F.coalesce(F.col("grupo") == group, F.lit(False)))
    return kept.unionByName(new_rows)


CURRENT_POLICY = """current_policy AS (
  SELECT * FROM region_policy
  UNION ALL SELECT DISTINCT 'auditors' AS grupo, upper(uf) AS uf FROM customer_events WHERE uf IS NOT NULL)"""


@query(
    "policy_reload",
    O.with_(O.CUSTOMER_EVENTS, O.REGION_POLICY, CURRENT_POLICY)
    + """SELECT * FROM current_policy WHERE NOT coalesce(grupo = 'analysts', false)
UNION ALL SELECT * FROM (VALUES ('analysts', 'SP'), ('analysts', 'RJ'), ('analysts', 'MG'), ('analysts', 'GO'), ('analysts', 'DF')) t(grupo, uf)""",
)
def policy_reload(spark, sf_dir):
    """Grants table = fixed grants + an auditors grant per region seen in the data; reload the analysts."""
    seen = (
        silver.customer_events_std(spark, sf_dir)
        .filter(F.col("uf").isNotNull())
        .select(F.lit("auditors").alias("grupo"), F.col("uf"))
        .distinct()
    )
    current = fx.region_policy(spark).unionByName(seen)
    return reload_group(current, "analysts", RELOADED_ANALYST_REGIONS)
