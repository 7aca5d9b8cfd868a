"""Hilbert-curve sharding: rows ordered along a space-filling curve and cut into runs.

Each metadata dimension is quantised into bins of equal row counts, the bins of a
row give its place on a Hilbert curve, and the curve order (ties broken by id and
text checksum) is cut into shards whose row counts differ by one at most. A file
written per shard covers a small box in every dimension, so filters on any of
them prune files. Only narrow rows are sorted, never the texts.

Defined results: a null dimension counts as its given lowest value, a null text as
empty. Rows that tie in everything are interchangeable. Repeated ids are sharded
row by row. An empty table gives no rows; with fewer rows than shards, some shards
stay empty. The operator reads only the columns it is told of.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prefix_sums

LAW = "rows"


def bin_cuts(df: DataFrame, value: Column, bits: int) -> list[tuple[object, int]]:
    """The smallest value of each bin, for 2**bits bins of near equal row counts (at most that many pairs).

    A value's bin is floor(rows with a smaller value * bins / rows): exact, monotone, equal values share a bin.
    """
    counts = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    placed, total = prefix_sums(counts, ["value"], {"less": F.col("n")})
    if not total["less"]:
        return []
    number = F.expr(f"CAST(less AS DECIMAL(38, 0)) * {1 << bits} DIV {total['less']}").cast("int")
    return [(r["low"], r["bin"]) for r in placed.groupBy(number.alias("bin")).agg(F.min("value").alias("low")).orderBy("bin").collect()]


def bin_of(value: Column, cuts: list[tuple[object, int]]) -> Column:
    """The bin of ``value``, from the cuts."""
    out = None
    for low, number in reversed(cuts[1:]):
        out = F.when(value >= F.lit(low), number) if out is None else out.when(value >= F.lit(low), number)
    low, number = cuts[0]
    # A dimension of one value: a condition, as the curve's steps would copy a literal into each other.
    return F.when(value >= F.lit(low), number).otherwise(number + 1) if out is None else out.otherwise(number)


def hilbert_steps(names: list[str], bits: int) -> list[list[tuple[str, str]]]:
    """SQL assignments that turn coordinates in ``names`` into the transposed Hilbert index, in place.

    Each inner list is evaluated at once; both Spark and DuckDB read ``xor(a, b)`` as exclusive or when
    ``xor`` is given. Reflections and swaps go from the highest bit down, then the Gray code is undone.
    """
    steps: list[list[tuple[str, str]]] = []
    head = names[0]
    for bit in range(bits - 1, 0, -1):
        mask, high = (1 << bit) - 1, 1 << bit
        steps.append([(head, f"CASE WHEN ({head} & {high}) <> 0 THEN xor({head}, {mask}) ELSE {head} END")])
        for x in names[1:]:
            swap = f"(xor({head}, {x}) & {mask})"
            steps.append([
                (head, f"CASE WHEN ({x} & {high}) <> 0 THEN xor({head}, {mask}) ELSE xor({head}, {swap}) END"),
                (x, f"CASE WHEN ({x} & {high}) <> 0 THEN {x} ELSE xor({x}, {swap}) END"),
            ])
    for before, x in zip(names, names[1:]):
        steps.append([(x, f"xor({x}, {before})")])
    last = names[-1]
    flip = "0"
    for bit in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN ({last} & {1 << bit}) <> 0 THEN {(1 << bit) - 1} ELSE 0 END)"
    steps.append([("__flip", flip)])
    steps.append([(x, f"xor({x}, __flip)") for x in names])
    return steps


def interleave(names: list[str], bits: int) -> str:
    """SQL sum that takes the bits of the transposed index in turn, highest first."""
    n = len(names)
    return " + ".join(f"(CASE WHEN ({x} & {1 << bit}) <> 0 THEN {1 << (bit * n + n - 1 - i)} ELSE 0 END)" for bit in range(bits) for i, x in enumerate(names))


def spark_xor(sql: str) -> str:
    """``xor(a, b)`` calls written with Spark's ``^`` operator."""
    while (at := sql.rfind("xor(")) >= 0:
        depth, comma, end = 0, 0, at + 4
        while depth >= 0:
            c = sql[end]
            depth += (c == "(") - (c == ")")
            comma = end if c == "," and depth == 0 and not comma else comma
            end += 1
        sql = f"{sql[:at]}(({sql[at + 4:comma]}) ^ ({sql[comma + 1:end - 1]})){sql[end:]}"
    return sql


def hilbert_index(df: DataFrame, names: list[str], bits: int, out: str = "hilbert") -> DataFrame:
    """``df`` with the curve index of the integer coordinates in ``names`` (each below 2**bits)."""
    cols = df.columns
    work = [f"__x{i}" for i in range(len(names))]
    df = df.select("*", *[F.col(n).cast("int").alias(w) for n, w in zip(names, work)])
    for step in hilbert_steps(work, bits):
        df = df.withColumns({name: F.expr(spark_xor(sql)) for name, sql in step})
    return df.select(*cols, F.expr(interleave(work, bits)).cast("long").alias(out))


def hilbert_shards(rows: DataFrame, dims: dict[str, Column], ties: list[str], n_shards: int, bits: int = 5) -> DataFrame:
    """``rows`` (narrow) with ``hilbert``, ``shard`` and ``slot``; shard counts differ by one at most.

    ``dims``: dimensions by name, not null. ``ties``: columns of ``rows`` that order rows of one curve cell.
    """
    cols = rows.columns
    cells = rows
    for name, value in dims.items():
        cuts = bin_cuts(rows, value, bits)
        if not cuts:  # no rows
            return rows.limit(0).select("*", F.lit(0).cast("long").alias("hilbert"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
        cells = cells.withColumn(f"__bin_{name}", bin_of(value, cuts))
    cells = hilbert_index(cells, [f"__bin_{n}" for n in dims], bits).select(*cols, "hilbert")
    placed, total = prefix_sums(cells, ["hilbert", *ties], {"__at": F.lit(1)})
    n = max(1, total["__at"])
    out = placed.withColumn("shard", F.expr(f"CAST(__at * {n_shards} DIV {n} AS INT)"))
    return out.withColumn("slot", F.expr(f"__at - (shard * CAST({n} AS LONG) + {n_shards - 1}) DIV {n_shards}")).drop("__at")


def document_shards(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """Shards of documents over source, language and length: id, size, checksum, curve index, shard and slot."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(body).cast("long") + 16).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.coalesce(F.col("source"), F.lit("")).alias("__source"),
        F.coalesce(F.col("lang"), F.lit("")).alias("__lang"),
        F.coalesce(F.col("n_chars"), F.lit(-1)).cast("long").alias("__n_chars"),
    )
    dims = {"source": F.col("__source"), "lang": F.col("__lang"), "n_chars": F.col("__n_chars")}
    out = hilbert_shards(rows, dims, ["doc_id", "text_crc32", "size"], n_shards)
    return out.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write the rows of ``docs`` into one folder per shard, in slot order. Joined by id and text checksum."""
    keys = ["doc_id", "text_crc32"]
    packed = docs.select(F.struct("*").alias("__row"), F.col("doc_id"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    where = placed.groupBy(*keys).agg(F.min(F.struct("shard", "slot")).alias("__place"))
    out = packed.join(where, [packed[k].eqNullSafe(where[k]) for k in keys]).select("__row.*", "__place.*")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def oracle_sql(n_shards: int = 40, bits: int = 5) -> str:
    """DuckDB SQL for the rows of ``document_shards``."""
    dims = {"__source": "coalesce(source, '')", "__lang": "coalesce(lang, '')", "__n_chars": "coalesce(n_chars, -1)"}
    # CRC-32 by its definition, byte by byte, with the table of its reflected polynomial computed in place.
    table = "list_transform(range(256), lambda b: list_reduce(list_prepend(b::UBIGINT, [i::UBIGINT for i in range(8)]), lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::UBIGINT) ELSE a // 2 END))"
    parts = [f"""d AS (SELECT doc_id, coalesce(text, '') AS t, {', '.join(f'{v} AS {k}' for k, v in dims.items())} FROM documents)""",
             f"tab AS (SELECT {table} AS tb)",
             """u AS (SELECT DISTINCT t, list_transform(range(octet_length(encode(t))), lambda i: ('0x' || substr(hex(encode(t)), CAST(2 * i + 1 AS INT), 2))::UBIGINT) AS bytes FROM d)""",
             """c AS (SELECT t, xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes), lambda a, b: xor(a // 256, tb[CAST(xor(a, b) % 256 AS INT) + 1])), 4294967295::UBIGINT)::BIGINT AS crc FROM u, tab)""",
             "r AS (SELECT doc_id, (octet_length(encode(d.t)) + 16)::BIGINT AS size, crc AS text_crc32, __source, __lang, __n_chars FROM d JOIN c USING (t))"]
    for i, k in enumerate(dims):
        parts.append(f"""b{i} AS (SELECT {k}, CAST((sum(n) OVER (ORDER BY {k}) - n) * {1 << bits} // (SELECT count(*) FROM r) AS INT) AS __x{i} FROM (SELECT {k}, count(*) AS n FROM r GROUP BY 1))""")
    names = [f"__x{i}" for i in range(len(dims))]
    parts.append(f"s0 AS (SELECT doc_id, size, text_crc32, {', '.join(names)}, 0 AS __flip FROM r " + " ".join(f"JOIN b{i} USING ({k})" for i, k in enumerate(dims)) + ")")
    steps = hilbert_steps(names, bits)
    for k, step in enumerate(steps):
        new = dict(step)
        cols = ", ".join(f"{new.get(c, c)} AS {c}" for c in [*names, "__flip"])
        parts.append(f"s{k + 1} AS (SELECT doc_id, size, text_crc32, {cols} FROM s{k})")
    parts.append(f"h AS (SELECT doc_id, size, text_crc32, ({interleave(names, bits)})::BIGINT AS hilbert FROM s{len(steps)})")
    parts.append("p AS (SELECT *, row_number() OVER (ORDER BY hilbert, doc_id NULLS FIRST, text_crc32, size) - 1 AS place, count(*) OVER () AS n FROM h)")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * {n_shards} // n AS INT) AS shard,
       (place - ((place * {n_shards} // n) * n + {n_shards - 1}) // {n_shards})::BIGINT AS slot, CAST(NULL AS INT) AS grown_shard, hilbert FROM p"""
