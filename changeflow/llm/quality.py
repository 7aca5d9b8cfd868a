"""Quality rules: a threshold table compiled into one projection of text measures.

Everything is a built-in expression; there is no user function and no shuffle.

Defined results: a null text has no words, so every count is 0 and it fails the
base rule. Empty and white-space texts are the same. Repeated rows are measured
row by row. An empty table gives an empty table. Only the id and text columns
are read, so extra columns of any name do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE

#: Frequent function words by language, lower case.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "as", "be", "this", "are", "by", "from", "or", "an", "at", "on", "a", "not", "have", "which"],
    "fr": ["le", "la", "les", "de", "des", "du", "un", "une", "et", "en", "est", "que", "qui", "dans", "pour", "sur", "au", "avec", "pas", "ne", "par"],
    "de": ["der", "die", "das", "und", "ist", "ein", "eine", "nicht", "mit", "von", "zu", "im", "den", "dem", "des", "auf", "als", "sich", "auch", "in", "für"],
    "es": ["el", "la", "los", "las", "de", "del", "un", "una", "y", "en", "es", "que", "por", "con", "para", "no", "se", "su", "lo", "al"],
}

#: Words in a run that counts as repeated when it is found twice; a power of two.
RUN = 8


@dataclass(frozen=True)
class Threshold:
    """A row passes when ``measure`` (a measure or a ratio of two) is within [low, high].

    The rule binds texts of ``min_words`` words or more only.
    """

    name: str
    measure: str
    over: str | None = None
    low: float | None = None
    high: float | None = None
    min_words: int = 0

    def passes(self) -> Column:
        value = F.col(self.measure).cast("double")
        if self.over:
            value = F.when(F.col(self.over) > 0, value / F.col(self.over)).otherwise(F.lit(0.0))
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= self.low)
        if self.high is not None:
            ok = ok & (value <= self.high)
        return ok | (F.col("n_words") < self.min_words) if self.min_words else ok


#: The thresholds of the production rules.
RULES = (
    Threshold("words", "n_words", low=20),
    Threshold("word_length", "word_chars", "n_words", low=2, high=20),
    Threshold("symbols", "n_symbols", "n_words", high=0.1),
    Threshold("stop_words", "n_stop_words", "n_words", low=0.02, min_words=100),
    Threshold("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
    Threshold("same_words", "n_same_words", "n_words", high=0.2),
    Threshold("bullet_lines", "n_bullet_lines", "n_lines", high=0.9, min_words=50),
    Threshold("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=0.3, min_words=50),
)


def measures(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the measures of each whole text."""
    out = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).withColumn("__words", F.array_remove(F.split("__text", WHITE), ""))
    out = out.withColumn("n_words", F.size("__words").cast("long"))
    out = out.withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # Hashes of runs of 1, 2, 4 and RUN words at each position. Equal runs have equal hashes, so a text whose hashes
    # all differ repeats no run; only the other texts are compared word by word.
    out = out.withColumn("__h", F.expr(f"IF(n_words >= {RUN}, transform(__words, w -> xxhash64(w)), array())"))
    step = 1
    while step < RUN:
        left = f"greatest(0, size(__h) - {step})"
        out = out.withColumn("__h", F.expr(f"zip_with(slice(__h, 1, {left}), slice(__h, {step + 1}, {left}), (a, b) -> xxhash64(a, b))"))
        step *= 2
    runs = f"transform(sequence(1, CAST(n_words AS INT) - {RUN - 1}), i -> struct(array_join(slice(__words, i, {RUN}), ' ') AS run, i AS at))"
    out = out.withColumn("__sorted", F.expr(f"IF(size(array_distinct(__h)) < size(__h), array_sort({runs}), NULL)"))
    out = out.withColumn("__at", F.expr("""
        IF(__sorted IS NULL, NULL, array_sort(array_distinct(flatten(zip_with(
            slice(__sorted, 1, size(__sorted) - 1), slice(__sorted, 2, size(__sorted) - 1),
            (a, b) -> IF(a.run = b.run, array(a.at, b.at), array()))))))"""))
    # Each repeated run covers RUN words, less what the next one covers again.
    out = out.withColumn("n_repeat_words", F.expr(f"""
        CAST(IF(__at IS NULL OR size(__at) = 0, 0, {RUN} + aggregate(zip_with(slice(__at, 1, greatest(0, size(__at) - 1)), slice(__at, 2, greatest(0, size(__at) - 1)),
            (a, b) -> least({RUN}, b - a)), 0, (s, x) -> s + x)) AS LONG)"""))
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws})
    return out.select(
        *keep,
        "n_words",
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("__lines").cast("long").alias("n_lines"),
        F.size(F.filter("__lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•·]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("__lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("__words", lambda w: F.lower(w).isin(stop))).cast("long").alias("n_stop_words"),
        F.size(F.filter(F.expr("zip_with(__words, slice(__words, 2, size(__words)), (a, b) -> a = b)"), lambda same: same)).cast("long").alias("n_same_words"),
    )


def judge(measured: DataFrame, rules: tuple[Threshold, ...] = RULES) -> DataFrame:
    """``base_failed``, ``kept`` and the names of the failed rules, from the measures."""
    # The row number, never negative, keeps Spark from copying all measures into a filter on a verdict.
    here = F.monotonically_increasing_id() >= 0
    base = here & ((F.col("n_words") < 20) | (F.lit(100) * F.col("n_repeat_words") > F.lit(30) * F.col("n_words")))
    failed = F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]))
    return measured.withColumn("base_failed", base).withColumn("failed_rules", F.concat_ws(",", failed)).withColumn("kept", here & ~F.col("base_failed") & (F.col("failed_rules") == ""))


def quality_rules(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: tuple[Threshold, ...] = RULES) -> DataFrame:
    """One row per document: ``keep`` columns, measures, ``base_failed``, ``failed_rules`` and ``kept``."""
    return judge(measures(df, text, keep), rules)


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Threshold, ...] = RULES) -> DataFrame:
    """The rows of ``df``, all columns, that every rule passes. A projection and a filter, no join."""
    packed = df.select(F.struct("*").alias("__row"), F.col(text).alias("__body"))
    return quality_rules(packed, "__body", ("__row",), rules).where("kept").select("__row.*")


def oracle_sql(rules: tuple[Threshold, ...] = RULES) -> str:
    """DuckDB SQL for the rows of ``quality_rules``."""
    stop = ", ".join("'" + w + "'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))
    failed = []
    for r in rules:
        value = f"{r.measure}::DOUBLE" if not r.over else f"(CASE WHEN {r.over} > 0 THEN {r.measure}::DOUBLE / {r.over} ELSE 0 END)"
        ok = " AND ".join(f"{value} {op} {x}" for op, x in ((">=", r.low), ("<=", r.high)) if x is not None)
        failed.append(f"CASE WHEN ({ok})" + (f" OR n_words < {r.min_words}" if r.min_words else "") + f" THEN NULL ELSE '{r.name}' END")
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT row_number() OVER () AS r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
x AS (SELECT r, unnest(range(1, len(ws) - {RUN - 2})) AS i, ws FROM w WHERE len(ws) >= {RUN}),
g AS (SELECT r, i, array_to_string(ws[i:i + {RUN - 1}], ' ') AS run FROM x),
h AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS gap FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM g) WHERE n > 1),
k AS (SELECT r, sum(least({RUN}, coalesce(gap, {RUN}))) AS n FROM h GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(k.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
             len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•·]')))::BIGINT AS n_bullet_lines,
             len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipsis_lines,
             len(list_filter(ws, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words,
             len(list_filter(list_zip(ws, ws[2:], true), lambda p: p[1] = p[2]))::BIGINT AS n_same_words
      FROM w LEFT JOIN k USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, concat_ws(',', {', '.join(failed)}) AS failed_rules FROM m)
SELECT *, NOT base_failed AND failed_rules = '' AS kept FROM f"""
