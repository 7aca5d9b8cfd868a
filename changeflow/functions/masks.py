"""PII masks and the region row filter as Column expressions.

Group membership is an explicit argument (``groups``: the reader's groups),
resolved when the plan is built, so masks stay plain Catalyst expressions
inside whole-stage codegen — no Python UDF.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Groups that read unmasked PII, and groups that see every region.
PII_READERS = ("engineering", "pii_readers")
ALL_REGIONS = ("engineering", "pii_readers", "admins")

# Mask formats.
EMAIL_UNKNOWN = "***@desconhecido"
CPF_MASKED = "***.***.*-**"
CPF_PREFIX = "***.***.*"
PHONE_MASK = "****"


def _member(groups: Iterable[str], privileged: Iterable[str]) -> bool:
    return bool(set(groups or ()) & set(privileged))


# What a mask shows of a value (SQL, NULL: nothing can be shown), the text before it, and the text instead of it.
MASKS = {
    "mask_email": ("get(split({0}, '@'), 1)", "***@", EMAIL_UNKNOWN),
    "mask_cpf": ("if(length({0}) < 2, NULL, right({0}, 2))", CPF_PREFIX, CPF_MASKED),
    "mask_phone": ("if(length({0}) < 4, NULL, right({0}, 4))", PHONE_MASK, PHONE_MASK),
}


def mask_sql(name: str, value: str, groups: Iterable[str] = ()) -> str:
    """SQL of mask ``name`` for the SQL expression ``value``, as a reader in ``groups`` sees it."""
    shown, before, instead = MASKS[name]
    return value if _member(groups, PII_READERS) else f"coalesce('{before}' || {shown.format(value)}, '{instead}')"


def mask_email(column: str, groups: Iterable[str] = ()) -> Column:
    """Keep the domain: ``***@`` + the text between the first and second ``@``."""
    return F.expr(mask_sql("mask_email", f"`{column}`", groups))


def mask_cpf(column: str, groups: Iterable[str] = ()) -> Column:
    """Keep the last two digits."""
    return F.expr(mask_sql("mask_cpf", f"`{column}`", groups))


def mask_phone(column: str, groups: Iterable[str] = ()) -> Column:
    """Keep the last four digits."""
    return F.expr(mask_sql("mask_phone", f"`{column}`", groups))


def mask_format_preview(df: DataFrame) -> DataFrame:
    """The mask formats without any membership check (a format preview, not a reader's view)."""
    return df.select(
        F.concat(F.lit("***@"), F.get(F.split("email", "@"), 1)).alias("email_mascarado"),
        F.concat(F.lit(CPF_PREFIX), F.right(F.col("cpf"), F.lit(2))).alias("cpf_mascarado"),
        F.concat(F.lit(PHONE_MASK), F.right(F.col("telefone"), F.lit(4))).alias("telefone_mascarado"),
    )


def apply_masks(df: DataFrame, groups: Iterable[str] = ()) -> DataFrame:
    """Replace email / cpf / telefone by their masks for a reader in ``groups``."""
    return df.withColumns({
        "email": mask_email("email", groups),
        "cpf": mask_cpf("cpf", groups),
        "telefone": mask_phone("telefone", groups),
    })


def row_filter(df: DataFrame, policy: DataFrame, groups: Iterable[str] = (), region_col: str = "uf") -> DataFrame:
    """Rows a reader may see: all for ALL_REGIONS groups, else regions granted to one of ``groups``.

    The policy is a grants table (groups x regions); Spark broadcasts the allowed set when it measures few rows.
    """
    groups = set(groups or ())
    if _member(groups, ALL_REGIONS):
        return df
    allowed = policy.filter(F.col("grupo").isin(sorted(groups))).select(F.col("uf").alias("_allowed_uf")).distinct()
    return df.join(allowed, F.col(region_col) == F.col("_allowed_uf"), "left_semi")


def register_sql_functions(spark: SparkSession, groups: Iterable[str] = ()) -> None:
    """Register the masks as SQL temporary functions for a reader in ``groups``."""
    for name in MASKS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING RETURN {mask_sql(name, 'value', groups)}")
