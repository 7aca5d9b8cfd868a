import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators.cdc import apply_incremental, apply_scd1, apply_scd2, merge_upsert
from changeflow.operators.skew import lead_sequence

LOG = "k int, seq bigint, op string, v string"


def _scd2(log, **kw):
    return apply_scd2(log, ["k"], "seq", delete_when="op = 'DELETE'", except_cols=("op",), **kw)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_scd2_late_event_is_backfilled(spark):
    log = spark.createDataFrame([(1, 10, "INSERT", "a"), (1, 30, "UPDATE", "c"), (1, 20, "UPDATE", "b-late")], LOG)
    out = _rows(_scd2(log), ["v", "__START_AT", "__END_AT"])
    assert out == [("a", 10, 20), ("b-late", 20, 30), ("c", 30, None)]


def test_scd2_delete_closes_and_reinsert_reopens(spark):
    log = spark.createDataFrame(
        [(1, 1, "INSERT", "a"), (1, 2, "DELETE", None), (1, 3, "INSERT", "b"), (2, 1, "INSERT", "x"), (2, 5, "DELETE", None)],
        LOG,
    )
    out = _rows(_scd2(log), ["k", "v", "__START_AT", "__END_AT"])
    assert out == [(1, "a", 1, 2), (1, "b", 3, None), (2, "x", 1, 5)]
    current = _scd2(log).filter("__END_AT IS NULL")
    assert [r.k for r in current.collect()] == [1]


def test_scd1_tombstone_outlives_stale_upsert(spark):
    log = spark.createDataFrame([(1, 1, "INSERT", "a"), (1, 3, "DELETE", None), (1, 2, "UPDATE", "stale")], LOG)
    assert apply_scd1(log, ["k"], "seq", delete_when="op = 'DELETE'").count() == 0


def test_scd1_tiebreak_on_equal_sequences(spark):
    log = spark.createDataFrame([(1, 5, "UPDATE", "a"), (1, 5, "UPDATE", "z"), (1, 4, "UPDATE", "zz")], LOG)
    out = apply_scd1(log, ["k"], "seq", tiebreak=("v",)).collect()
    assert [r.v for r in out] == ["z"]


def test_arrival_order_never_matters(spark):
    rows = [(k, s, random.choice(["INSERT", "UPDATE", "DELETE"]), f"{k}-{s}") for k in range(5) for s in range(1, 30, 3)]
    random.seed(7)
    base = _rows(_scd2(spark.createDataFrame(rows, LOG)), ["k", "v", "__START_AT", "__END_AT"])
    for _ in range(3):
        random.shuffle(rows)
        shuffled = spark.createDataFrame(rows, LOG).repartition(4)
        assert _rows(_scd2(shuffled), ["k", "v", "__START_AT", "__END_AT"]) == base
        assert _rows(apply_scd1(shuffled, ["k"], "seq", "op = 'DELETE'"), ["k", "v"]) == \
            _rows(apply_scd1(spark.createDataFrame(rows, LOG), ["k"], "seq", "op = 'DELETE'"), ["k", "v"])


def test_hot_key_split_equals_plain_window(spark):
    rows = [(0, s, "UPDATE", str(s)) for s in range(0, 400, 3)] + [(k, s, "UPDATE", "x") for k in range(1, 6) for s in range(4)]
    log = spark.createDataFrame(rows, LOG)
    plain = _rows(lead_sequence(log, ["k"], "seq"), ["k", "seq", "_next_seq"])
    split = _rows(lead_sequence(log, ["k"], "seq", hot_rows=10), ["k", "seq", "_next_seq"])
    assert split == plain
    assert _rows(_scd2(log, hot_rows=10), ["k", "__START_AT", "__END_AT"]) == _rows(_scd2(log), ["k", "__START_AT", "__END_AT"])


def test_incremental_equals_full(spark):
    random.seed(3)
    rows = [(random.randrange(8), s, random.choice(["INSERT", "UPDATE", "DELETE"]), f"v{s}") for s in range(200)]
    log = spark.createDataFrame(rows, LOG)
    for cut in (50, 120, 199):
        b1 = log.filter(F.col("seq") < cut)
        b2 = log.filter(F.col("seq") >= cut)
        inc = apply_incremental(_scd2(b1), log, b2, ["k"], _scd2)
        cols = ["k", "v", "__START_AT", "__END_AT"]
        assert _rows(inc, cols) == _rows(_scd2(log), cols)


def test_merge_updates_inserts_and_rejects_duplicate_keys(spark):
    target = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "k int, s string")
    source = spark.createDataFrame([(2, "B"), (3, "X"), (4, "D")], "k int, s string")
    out = merge_upsert(target, source, ["k"], matched_condition="t.s != s.s", update_set={"s": "s.s"}, action_col="a")
    assert _rows(out, ["k", "s", "a"]) == [(1, "A", "copy"), (2, "B", "copy"), (3, "X", "update"), (4, "D", "insert")]
    dup = spark.createDataFrame([(2, "B"), (2, "Z")], "k int, s string")
    with pytest.raises(Exception, match="several rows for one target key"):
        merge_upsert(target, dup, ["k"]).collect()
    # duplicates that match no target row are inserted, as in SQL MERGE
    fresh = spark.createDataFrame([(9, "x"), (9, "y")], "k int, s string")
    assert merge_upsert(target, fresh, ["k"]).filter("k = 9").count() == 2


def test_scd2_bucketed_path_on_real_log(spark):
    """Forcing every customer above the hot-key threshold gives the same history as one window."""
    from conftest import SF_SMOKE
    from changeflow.plans import silver

    log = silver.valid_customer_events(spark, SF_SMOKE)
    cols = ["cliente_id", "nome", "__START_AT", "__END_AT"]
    plain = silver.customers_scd2(log)
    split = silver.customers_scd2(log, hot_rows=5)
    assert _rows(split, cols) == _rows(plain, cols)


def test_hot_key_split_with_timestamp_sequence(spark):
    rows = [(0, f"2024-01-01 00:{m:02d}:{s:02d}", "UPDATE", "x") for m in range(10) for s in range(0, 60, 7)]
    rows += [(1, "2024-01-02 00:00:00", "UPDATE", "y"), (1, "2024-01-03 00:00:00", "DELETE", None)]
    log = spark.createDataFrame(rows, LOG.replace("seq bigint", "seq string")).withColumn(
        "seq", F.col("seq").cast("timestamp_ntz"))
    cols = ["k", "seq", "_next_seq"]
    assert _rows(lead_sequence(log, ["k"], "seq", hot_rows=7), cols) == _rows(lead_sequence(log, ["k"], "seq"), cols)


def test_scd1_narrow_payload_equals_full_projection(spark):
    log = spark.createDataFrame(
        [(1, 1, "INSERT", "a"), (1, 3, "DELETE", None), (1, 2, "UPDATE", "stale"), (2, 5, "UPDATE", "b"), (2, 4, "INSERT", "c")],
        LOG,
    )
    full = apply_scd1(log, ["k"], "seq", delete_when="op = 'DELETE'", except_cols=("op",))
    narrow = apply_scd1(log, ["k"], "seq", delete_when="op = 'DELETE'", except_cols=("op",), columns=("v",))
    assert narrow.columns == ["k", "v"]
    assert _rows(narrow, ["k", "v"]) == _rows(full, ["k", "v"]) == [(2, "b")]


def test_text_sequences_split_like_numbers(spark):
    """A hot key's next value is the same whatever the split, also where the sequence is text."""
    from changeflow.operators.skew import lead_sequence

    rows = [("k", str(i)) for i in range(1, 40)] + [("k", f"2024-01-{d:02d}T00:00:00Z") for d in range(1, 29)] + [("c", "x"), ("k", None)]
    df = spark.createDataFrame(rows, "key string, seq string")
    plain = sorted(lead_sequence(df, ["key"], "seq").collect(), key=repr)
    assert sorted(lead_sequence(df, ["key"], "seq", hot_rows=5).collect(), key=repr) == plain


def test_lead_of_a_hot_key_needs_no_job_to_plan(spark):
    """A key with nine tenths of the rows, 100,000 equal sequences in it, NULL sequences and a NULL key."""
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 10 > 0, 0).when(F.col("id") % 1000 == 0, None).otherwise(F.col("id") % 7).cast("int").alias("k"),
        F.when(F.col("id") < 120_000, 5).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 50_000).cast("long").alias("seq"),
        F.col("id").cast("string").alias("v"),
    )
    spark.sparkContext.setJobGroup("lead-plan", "planning only")
    split = lead_sequence(rows, ["k"], "seq", hot_rows=20_000)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lead-plan")
    spark.sparkContext.setJobGroup("lead-run", "run")

    def counts(df):
        return sorted((tuple(r) for r in df.groupBy("k", "seq", "_next_seq").count().collect()), key=repr)

    assert counts(split) == counts(lead_sequence(rows, ["k"], "seq", hot_rows=1 << 40))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    largest = max(r["n"] for r in split.where("k = 0").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert largest < 120_000  # the 180,000 rows of the key are not in one task


def test_current_versions_equal_the_open_ones(spark):
    random.seed(5)
    rows = [(random.randrange(9), random.randrange(12), random.choice(["INSERT", "UPDATE", "DELETE"]), f"v{i}") for i in range(120)]
    from changeflow.operators.cdc import current_scd2

    log = spark.createDataFrame(rows + [(20, None, "INSERT", "n"), (21, None, "DELETE", "n")], LOG)
    options = dict(delete_when="op = 'DELETE'", except_cols=("op",), tiebreak=("op", "v"))
    full = apply_scd2(log, ["k"], "seq", **options).filter("__END_AT IS NULL")
    got = current_scd2(log, ["k"], "seq", **options)
    assert got.dtypes == full.dtypes
    cols = ["k", "seq", "v", "__START_AT", "__END_AT"]
    # A NULL sequence is an end without an end: only the last event of a key is open.
    assert sorted(_rows(got, cols), key=repr) == sorted((r for r in _rows(full, cols) if r[1] is not None or r[0] == 20), key=repr)
