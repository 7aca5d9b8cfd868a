"""Incremental file ingestion (bronze): JSON-lines and headered CSV file streams with rescue.

``_rescued_data`` keeps, as JSON text, what did not fit the schema:
  * keys the schema does not know,
  * values whose typed parse is NULL while the raw value is not (wrong type),
  * the whole line when it does not parse as a JSON object at all.
It is NULL for a clean row. Provenance columns record the source file and the
ingestion time. Everything is built from ``from_json`` / ``try_cast`` /
map functions — no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeutil import ntz_text

RESCUED = "_rescued_data"

# Schema hints of the landing files.
ORDER_HINTS = (
    "pedido_id BIGINT, cliente_id BIGINT, produto_id BIGINT, quantidade INT, preco_unitario DOUBLE, "
    "status STRING, canal STRING, pedido_ts STRING, evento_ts STRING, desempate BIGINT"
)
PRODUCT_HINTS = (
    "produto_id BIGINT, nome_produto STRING, categoria_id INT, preco_lista DOUBLE, ativo BOOLEAN, "
    "operacao STRING, atualizado_em STRING"
)


def schema_with_hints(hints_ddl: str, inferred: T.StructType | None = None) -> T.StructType:
    """Pin the hinted columns' types; keep any other inferred column as inferred."""
    hinted = T.StructType.fromDDL(hints_ddl)
    if inferred is None:
        return hinted
    pinned = {f.name: f for f in hinted.fields}
    fields = [pinned.pop(f.name, f) for f in inferred.fields]
    return T.StructType(fields + list(pinned.values()))


def _to_json_or_null(m: Column) -> Column:
    return F.when(F.size(m) > 0, F.to_json(m))


def rescue_json(lines: DataFrame, schema: T.StructType, text_col: str = "value") -> DataFrame:
    """Typed columns of ``schema`` plus ``_rescued_data`` from a column of JSON text lines.

    Each line is parsed once, typed, and its keys are listed. A line of as many keys as typed values has
    nothing to rescue: each key is known, of the right type and there once. Only the other lines
    are parsed again, as a string map, which the rescue logic reads.
    """
    text = F.col(text_col)
    typed, raw, clean = F.col("_typed"), F.col("_raw"), F.col("_clean")
    names = [f.name for f in schema.fields]
    parsed = lines.select("*", F.from_json(text, schema).alias("_typed"), F.json_object_keys(text).alias("_keys"))
    values = sum((F.when(typed[n].isNotNull(), 1).otherwise(0) for n in names), F.lit(0))
    parsed = parsed.withColumn("_clean", F.coalesce(F.size("_keys") == values, F.lit(False)))  # not an object: no keys
    parsed = parsed.withColumn("_raw", F.when(~clean, F.from_json(text, "map<string,string>")))
    mistyped = F.map_from_entries(F.filter(
        F.array(*[
            F.when(raw[n].isNotNull() & typed[n].isNull(), F.struct(F.lit(n).alias("k"), raw[n].alias("v")))
            for n in names
        ]),
        lambda e: e.isNotNull(),
    ))
    known = F.array(*[F.lit(n) for n in names])
    unknown = F.map_filter(raw, lambda k, v: ~F.array_contains(known, k))
    # A line that repeats a key is kept whole: a map holds a key once.
    repeats = F.size(F.array_distinct(F.map_keys(raw))) < F.size(raw)
    rescued = F.when(clean, F.lit(None)).when(raw.isNull() | repeats, text).otherwise(_to_json_or_null(F.map_concat(mistyped, unknown)))
    return parsed.select(
        *[c for c in lines.columns if c != text_col], *[typed[n].alias(n) for n in names], rescued.alias(RESCUED)
    )


def rescue_csv(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast string columns to ``schema`` with try_cast; failed casts go to ``_rescued_data``."""
    casts = {f.name: F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})") for f in schema.fields}
    mistyped = F.map_from_entries(F.filter(
        F.array(*[
            F.when(F.col(n).isNotNull() & c.isNull(), F.struct(F.lit(n).alias("k"), F.col(n).alias("v")))
            for n, c in casts.items()
        ]),
        lambda e: e.isNotNull(),
    ))
    others = [c for c in df.columns if c not in casts]
    return df.select(*others, *[c.alias(n) for n, c in casts.items()], _to_json_or_null(mistyped).alias(RESCUED))


def with_provenance(df: DataFrame) -> DataFrame:
    """``arquivo_origem`` (source file) and ``data_ingestao`` (ingestion time)."""
    return df.select("*", F.col("_metadata.file_path").alias("arquivo_origem"), F.current_timestamp().alias("data_ingestao"))


def json_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON-lines files under ``path`` as a stream: text lines -> typed + rescued + provenance."""
    lines = spark.readStream.format("text").load(path)
    return rescue_json(with_provenance(lines), schema)


def csv_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV files under ``path`` as a stream: string columns -> try_cast + rescued + provenance.

    The header of every file must name the schema's columns in order: a file whose header differs stops the
    stream instead of being read by position under wrong names.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.readStream.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").schema(as_text).csv(path)
    return rescue_csv(with_provenance(raw), schema)


def csv_by_header(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns of ``schema`` plus ``_rescued_data`` from the text lines of headered CSV files, by column name.

    ``lines``: value, arquivo_origem, data_ingestao and ``_start`` (where the line's block begins in its file). Each
    file's first line names its columns, in any order: a column of ``schema`` that it lacks is NULL; a column that the schema
    does not know, a second column of a name, a value of the wrong type and the values beyond the header are rescued
    (the latter as the whole line, ``_linha``). A quote within quotes is doubled; values hold no line breaks. Blank lines are no rows.
    """
    lines = lines.withColumn("_at", F.struct("_start", F.monotonically_increasing_id().alias("_n")))
    first = lines.filter("_start = 0").groupBy("arquivo_origem").agg(F.min(F.struct("_at", "value")).alias("_h"))
    first = first.select("arquivo_origem", F.col("_h._at").alias("_first"), F.col("_h.value").alias("_header"))
    # Separators of the widest header: at least its columns. One number reaches the driver.
    width = first.agg(F.max(F.length("_header") - F.length(F.replace("_header", F.lit(","), F.lit(""))) + 1)).first()[0] or 1
    generic = ", ".join(f"c{i} STRING" for i in range(width + 1))
    cells = lambda c: F.array(*[F.from_csv(c, generic, {"escape": '"'})[f"c{i}"] for i in range(width + 1)])
    named = first.select("arquivo_origem", "_first", F.transform(F.filter(cells("_header"), lambda x: x.isNotNull()), lambda x: F.trim(x)).alias("_names"))
    # One row per file: joined like any other table.
    rows = lines.join(named, "arquivo_origem").filter((F.col("_at") != F.col("_first")) & (F.trim("value") != ""))
    rows = rows.withColumn("_cells", F.transform(cells("value"), lambda x: F.when(x != "", x)))
    names = [f.name for f in schema.fields]
    by_name = {n: F.get("_cells", (F.array_position("_names", n) - 1).cast("int")) for n in names}
    as_text = rows.select("*", *[F.when(F.array_contains("_names", n), c).alias(n) for n, c in by_name.items()])
    typed = rescue_csv(as_text, schema).withColumnRenamed(RESCUED, "_mistyped")
    known = F.lit(names)
    entry = F.transform("_names", lambda n, i: F.struct(
        F.when(F.array_position("_names", n) == i + 1, n).otherwise(F.concat(n, F.lit("#"), (i + 1).cast("string"))).alias("k"), F.get("_cells", i).alias("v"),
        (F.array_contains(known, n) & (F.array_position("_names", n) == i + 1)).alias("fits")))
    others = F.transform(F.filter(entry, lambda e: ~e["fits"] & e["v"].isNotNull()), lambda e: F.struct(e["k"], e["v"]))
    beyond = F.exists(F.slice("_cells", F.size("_names") + 1, width + 1), lambda x: x.isNotNull())
    beyond = F.when(beyond, F.map_from_arrays(F.array(F.lit("_linha")), F.array("value"))).otherwise(F.create_map().cast("map<string,string>"))
    mistyped = F.coalesce(F.from_json("_mistyped", "map<string,string>"), F.create_map().cast("map<string,string>"))
    rescued = F.map_concat(mistyped, F.map_from_entries(others), beyond)
    return typed.select("arquivo_origem", "data_ingestao", *names, _to_json_or_null(rescued).alias(RESCUED))


def run_csv_by_header(spark: SparkSession, path: str, schema: T.StructType, target) -> None:
    """Ingest the headered CSV files under ``path`` not seen before into ``target`` (a StreamTarget), columns by name.

    A micro-batch holds whole files, so their headers are in it. Each is written to a folder of its own number, which a
    repeated micro-batch overwrites: every file is ingested once.
    """
    lines = spark.readStream.format("text").load(path).select(
        "value", F.col("_metadata.file_path").alias("arquivo_origem"), F.col("_metadata.file_block_start").alias("_start"))

    def write(batch: DataFrame, number: int) -> None:
        out = csv_by_header(batch.withColumn("data_ingestao", F.current_timestamp()), schema)
        out.write.mode("overwrite").parquet(f"{target.path}/micro_batch={number}")

    query = lines.writeStream.foreachBatch(write).option("checkpointLocation", target.checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def batch_of(path_col: str = "arquivo_origem") -> Column:
    """The landing batch number from a ``lote=<n>`` folder in the file path; null for other paths."""
    return F.regexp_extract(F.col(path_col), r"lote=(\d+)", 1).try_cast("int")


# ---------------------------------------------------------------------------- landing writers


def order_landing_lines(order_events: DataFrame) -> DataFrame:
    """Order events as JSON text lines, with three injected faults (fixed rules):
    wrong type (pedido_id % 97 = 3: quantity as text), unknown key (pedido_id % 89 = 5: ``cupom``),
    unparseable line (pedido_id % 101 = 7)."""
    cols = order_events.columns
    ev = order_events.select(*[
        ntz_text(c).alias(c) if c in ("pedido_ts", "evento_ts") else F.col(c) for c in cols
    ])
    pid = F.col("pedido_id")
    base = F.to_json(F.struct(*[F.col(c) for c in cols]))
    typed_fault = F.when(pid % 97 == 3, F.regexp_replace(base, r'"quantidade":(-?[0-9]+)', '"quantidade":"$1 un"')) \
        .otherwise(base)
    extra_key = F.concat(F.lit(',"cupom":"PROMO'), pid.cast("string"), F.lit('"}'))
    with_key = F.when(pid % 89 == 5, F.regexp_replace(typed_fault, r"\}$", extra_key)).otherwise(typed_fault)
    line = F.when(pid % 101 == 7, F.concat(F.lit("#corrupt line "), pid.cast("string"))).otherwise(with_key)
    return ev.select(line.alias("value"), F.col("evento_ts"))


def product_landing(product_events: DataFrame) -> DataFrame:
    """Product events as CSV-ready strings; a stale update carries a price that is not a number."""
    return product_events.select(
        F.col("produto_id").cast("string").alias("produto_id"),
        "nome_produto",
        F.col("categoria_id").cast("string").alias("categoria_id"),
        F.when(F.col("atualizado_em") == F.expr("TIMESTAMP_NTZ '1995-01-15 00:00:00'"), F.lit("R$ 1.00"))
        .otherwise(F.col("preco_lista").cast("string")).alias("preco_lista"),
        F.col("ativo").cast("string").alias("ativo"),
        "operacao",
        ntz_text("atualizado_em").alias("atualizado_em"),
    )


def write_batch_json(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("errorifexists").text(path)


def write_batch_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)
