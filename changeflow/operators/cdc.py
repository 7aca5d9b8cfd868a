"""Change-data application: SCD type 1 and type 2, incremental apply, MERGE.

The append-only, validated change log is the source of truth; targets are
derived from it. Events are ordered by their sequence column, never by arrival,
so out-of-order and late events land where they belong, and a delete
(tombstone) outlives any older upsert that arrives after it.

SCD1 keeps the latest event per key with ``max_by`` — a hash-partitioned
aggregate with map-side partial aggregation, so a hot key is reduced inside
each map task before the shuffle. SCD2 needs the next sequence of each event
(``skew.lead_sequence``), which splits hot keys across tasks.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import HOT_ROWS, lead_sequence

START_AT, END_AT = "__START_AT", "__END_AT"


def _is_delete(delete_when: str | Column | None) -> Column:
    if delete_when is None:
        return F.lit(False)
    c = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    return F.coalesce(c, F.lit(False))


def apply_scd1(
    log: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    delete_when: str | Column | None = None,
    except_cols: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Current state per key: the event with the greatest (sequence, *tiebreak), dropped if it is a delete.

    ``columns`` limits the carried row to what the caller reads: the winning row
    travels through the shuffle inside the ``max_by`` payload, where Catalyst
    cannot prune fields. The delete flag is evaluated before the shuffle and
    travels as one boolean.
    """
    keys = list(keys)
    wanted = [c for c in log.columns if c not in keys and c not in except_cols
              and (columns is None or c in columns)]
    order = F.struct(*[F.col(c) for c in [sequence_by, *tiebreak]])
    payload = F.struct(*[F.col(c) for c in wanted], _is_delete(delete_when).alias("_del"))
    latest = log.groupBy(*keys).agg(F.max_by(payload, order).alias("_row"))
    out = latest.select(*keys, "_row.*").filter(~F.col("_del"))
    return out.select(*[c for c in log.columns if c in keys or c in wanted])


def apply_scd2(
    log: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    delete_when: str | Column | None = None,
    except_cols: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Full history: one version per non-delete event, valid over [__START_AT, __END_AT).

    ``__END_AT`` is the sequence of the key's next event (upsert or delete), NULL
    for the current version. A delete closes the open version and creates none;
    an upsert after a delete opens a new one. Both columns take the sequence type.
    """
    seq_type = log.schema[sequence_by].dataType
    with_next = lead_sequence(log, keys, sequence_by, tiebreak, out_col="_next_seq", hot_rows=hot_rows)
    versions = with_next.filter(~_is_delete(delete_when)).select(
        *log.columns,
        F.col(sequence_by).cast(seq_type).alias(START_AT),
        F.col("_next_seq").cast(seq_type).alias(END_AT),
    )
    return versions.drop(*except_cols)


def current_scd2(
    log: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    delete_when: str | Column | None = None,
    except_cols: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The open versions of ``apply_scd2``, without its history: the last event of each key, unless it is a delete.

    ``max_by`` combines a key's events inside each map task; no event is sorted.
    """
    rest = [c for c in log.columns if c not in keys]
    payload = F.struct(*rest, _is_delete(delete_when).alias("_del"))
    order = F.struct(*[F.col(c) for c in [sequence_by, *tiebreak]])
    last = log.groupBy(*keys).agg(F.max_by(payload, order).alias("_row")).select(*keys, "_row.*").filter(~F.col("_del"))
    seq_type = log.schema[sequence_by].dataType
    opened = last.select(*log.columns, F.col(sequence_by).alias(START_AT), F.lit(None).cast(seq_type).alias(END_AT))
    return opened.drop(*except_cols)


def apply_incremental(
    target: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    apply_fn: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Apply a new batch: recompute only the keys the batch touches.

    ``log`` is the full append-only log *including* ``batch``; ``target`` is the
    result of ``apply_fn`` over the log before the batch. Untouched keys are
    carried over (anti-join), touched keys are rebuilt from their whole log
    (semi-join), so late events and tombstones resolve exactly as in a full
    recompute.
    """
    keys = list(keys)
    touched = batch.select(*keys).distinct()
    rebuilt = apply_fn(log.join(touched, keys, "left_semi"))
    kept = target.join(touched, keys, "left_anti")
    return kept.unionByName(rebuilt)


MERGE_DUPLICATE = "MERGE source has several rows for one target key"


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched_condition: str | None = None,
    update_set: Mapping[str, str] | None = None,
    insert: bool = True,
    action_col: str | None = None,
) -> DataFrame:
    """MERGE INTO target USING source ON keys.

    WHEN MATCHED [AND matched_condition] THEN UPDATE SET col = expr (``update_set``;
    None = all source columns); WHEN NOT MATCHED THEN INSERT * (if ``insert``).
    In ``matched_condition`` and ``update_set`` expressions, refer to the target
    as ``t.col`` and to the source as ``s.col``. Several source rows matching one
    target row abort the job, as in SQL MERGE.

    One full-outer join on the keys (a shuffle of both sides on the key; keys are
    unique on both sides, so there is no skew). ``action_col`` (optional) tags
    each output row with update / insert / copy for commit metrics.
    """
    on = list(on)
    t = target.withColumn("_t_present", F.lit(True)).alias("t")
    # Rows per source key, counted in the same job: the window hash-partitions the source on the
    # keys and the join reuses that partitioning, so the check costs no extra pass over the source.
    s = (
        source.withColumn("_s_rows", F.count(F.lit(1)).over(Window.partitionBy(*on)))
        .withColumn("_s_present", F.lit(True))
        .alias("s")
    )
    cond = None
    for k in on:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    tp = F.col("t._t_present").isNotNull()
    sp = F.col("s._s_present").isNotNull()
    matched = tp & sp
    if matched_condition is not None:
        matched = matched & F.coalesce(F.expr(matched_condition), F.lit(False))
    if update_set is None:
        update_set = {c: f"s.{c}" for c in target.columns}
    inserted = (~tp) & sp
    out_cols = []
    for c in target.columns:
        new = F.expr(update_set[c]) if c in update_set else F.col(f"t.{c}")
        out_cols.append(
            F.when(matched, new).when(inserted, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
        )
    action = F.when(matched, "update").when(inserted, "insert").otherwise("copy")
    keep = tp | (inserted if insert else F.lit(False))
    single = F.when(tp & sp & (F.col("s._s_rows") > 1), F.raise_error(F.lit(MERGE_DUPLICATE))).otherwise(F.lit(True))
    res = j.filter(single).filter(keep).select(*out_cols, action.alias("_merge_action"))
    return res.withColumnRenamed("_merge_action", action_col) if action_col else res.drop("_merge_action")
