"""URL filter over a sorted digest array: rules for hosts and path prefixes, and a list of blocked hosts or addresses.

An entry is a host followed by a path prefix. Entries are written as shards by the range of their 64-bit xxhash
digest: an Arrow stream of digests in ascending order, entries and kinds. Executors fetch the shard files once
and map them into memory, so that a list is paged, not loaded. A task hashes what an address could match (the
ends of its host that hold no more labels than any entry, then these with beginnings of its path as long as some entry's),
finds the digests by vectorised binary search and confirms each hit against the stored string; equal
digests of other strings are stepped over. Indexes larger than ``MAPPED_BYTES`` are not sent to all executors:
distinct candidates are dealt to the owner of their shard, and hits are joined back.

The longest fitting rule decides (of equally long ones that with the longer host); without a rule, an address is blocked
if an entry of the list fits it, and allowed if not.

Defined results: host and path of a null url, or one without ``://``, are empty; an empty host fits no entry. An entry given
twice counts once, a blocking one before an allowing one. Rows are judged one by one, repeated ids too. An empty
table gives an empty table; an empty index allows everything. Other columns are ignored.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_dir
from .common import join_hot, written
from .wordcodes import of_worker

#: Kinds of entries: a host that any entry has (written with ``HOST_MARK``), an allowing rule, a blocking rule, a listed address.
HOST, ALLOW, BLOCK, LISTED = range(4)
HOST_MARK = "\x00"
#: Entries of a shard, about, and the bytes of all shards up to which every executor maps them.
SHARD_ENTRIES = 1 << 20
MAPPED_BYTES = 1 << 30
#: Seed of Spark's xxhash64, which makes the digests.
SEED = 42
#: Shards begin at multiples of this many bytes of their file.
ALIGN = 64

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rules of the query (host, path prefix, kind); fixed values.
RULES = [("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK), ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK)]
#: Hosts with one of these among their words are put on the list of the query.
HOST_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "#", 1))
    rest = F.substring_index(F.coalesce(rest, F.lit("")), "?", 1)
    host = F.substring_index(rest, "/", 1)
    return F.translate(host, UPPER, LOWER), F.substring(rest, F.length(host) + 1, F.length(rest))


@dataclasses.dataclass(frozen=True)
class UrlIndex:
    """A written index: its table of shards, the raw shard files, path lengths and labels that entries have."""

    shards: str
    files: tuple[str, ...]
    n_bytes: int
    n_shards: int
    lengths: tuple[int, ...]
    labels: int


def shard_of(digest: Column, n: int) -> Column:
    return (F.shiftrightunsigned(digest, 48) * n / 65536).cast("int")


def shard_bytes(number: int, digests: np.ndarray, entries: pa.Array, kinds: np.ndarray) -> bytes:
    """A shard as an Arrow stream, filled up so that it ends at a multiple of ``ALIGN`` with a newline after it."""
    rows = pa.table({"digest": pa.array(digests), "entry": entries.cast(pa.large_string()), "kind": pa.array(kinds.astype(np.int8))})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema.with_metadata({"shard": str(number)})) as out:
        out.write_table(rows.replace_schema_metadata({"shard": str(number)}))
    blob = sink.getvalue().to_pybytes()
    return blob + b"\0" * (-(len(blob) + 1) % ALIGN)


def build_index(entries: DataFrame, shard_entries: int = SHARD_ENTRIES) -> UrlIndex:
    """Write the index of ``entries`` (host, path, kind): distributed, one task per shard."""
    spark = entries.sparkSession
    named = entries.where("host <> ''").select("host", F.coalesce("path", F.lit("")).alias("path"), "kind")
    marks = named.select(F.concat(F.lit(HOST_MARK), "host").alias("entry"), F.lit(HOST).alias("kind"))
    # A rule and a listed address of the same text are two entries.
    whole = named.select(F.concat("host", "path").alias("entry"), F.col("kind").cast("int").alias("kind"))
    group = [F.col("entry"), (F.col("kind") == LISTED).alias("listed")]
    flat = marks.unionByName(whole).groupBy(*group).agg(F.max("kind").alias("kind")).select("entry", "kind", F.xxhash64("entry").alias("digest"))
    flat = written(flat, "url_entries")
    facts = named.agg(F.array_sort(F.collect_set(F.length("path"))), F.max(F.size(F.split("host", r"\.")))).first()
    n = max(1, -(-flat.count() // shard_entries))

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        digests = table["digest"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(digests, kind="stable")
        blob = shard_bytes(key[0].as_py(), digests[order], table["entry"].combine_chunks().take(pa.array(order)), table["kind"].to_numpy()[order])
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "blob": pa.array([blob], pa.binary())})

    path = work_dir(spark, "url_index")
    flat.withColumn("shard", shard_of(F.col("digest"), n)).groupBy("shard").applyInArrow(build, "shard int, blob binary").write.parquet(f"{path}/shards")
    blobs = spark.read.parquet(f"{path}/shards")
    size = blobs.agg(F.coalesce(F.sum(F.octet_length("blob") + 1), F.lit(0))).first()[0]
    files = []
    if 0 < size <= MAPPED_BYTES:
        # The text writer puts the bytes as they are.
        blobs.select(F.col("blob").cast("string").alias("value")).write.option("compression", "none").text(f"{path}/files")
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/files")
        listed = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
        files = [s.getPath().toString() for s in listed if s.getPath().getName().startswith("part-") and s.getLen()]
    return UrlIndex(f"{path}/shards", tuple(sorted(files)), size, n, tuple(facts[0]), facts[1] or 0)


class Shard:
    """Digests in ascending order, with the entry and the kind of each."""

    def __init__(self, table: pa.Table):
        self.number = int(table.schema.metadata[b"shard"])
        table = table.combine_chunks()
        self.digests = table["digest"].combine_chunks().to_numpy() if table.num_rows else np.zeros(0, np.uint64)
        self.entries = table["entry"].combine_chunks()
        self.kinds = table["kind"].to_numpy()

    def find(self, digests: np.ndarray, strings: list[str]) -> list[list[int]]:
        """The kinds of the entries equal to each string."""
        found: list[list[int]] = [[] for _ in strings]
        at = np.searchsorted(self.digests, digests)
        open_ = np.arange(len(strings))
        while True:
            open_ = open_[at[open_] < len(self.digests)]
            open_ = open_[self.digests[at[open_]] == digests[open_]]
            if not len(open_):
                return found
            entries, kinds = self.entries.take(pa.array(at[open_])).to_pylist(), self.kinds[at[open_]]
            for i, entry, kind in zip(open_.tolist(), entries, kinds.tolist()):
                if entry == strings[i]:
                    found[i].append(kind)
            at[open_] += 1


def read_shards(file) -> list[Shard]:
    """All shards of a mapped file or a buffer."""
    out = []
    while file.tell() < file.size():
        with pa.ipc.open_stream(file) as rows:
            out.append(Shard(rows.read_all()))
        file.seek(min(-(-(file.tell() + 1) // ALIGN) * ALIGN, file.size()))
    return out


class Mapped:
    """The shards of an index in this worker, mapped from the executor's copies of its files."""

    def __init__(self, names: list[str], n_shards: int):
        self.n = n_shards
        self.shards = {s.number: s for name in names for s in read_shards(pa.memory_map(SparkFiles.get(name)))}

    def find(self, strings: list[str]) -> list[list[int]]:
        digests = np.fromiter((xxhash.xxh64_intdigest(s.encode(), SEED) for s in strings), np.uint64, len(strings))
        owner = ((digests >> np.uint64(48)) * np.uint64(self.n) >> np.uint64(16)).astype(np.int64)
        out: list[list[int]] = [[] for _ in strings]
        for number in np.unique(owner).tolist():
            if number in self.shards:
                at = np.flatnonzero(owner == number)
                for i, kinds in zip(at.tolist(), self.shards[number].find(digests[at], [strings[i] for i in at])):
                    out[i] = kinds
        return out


def host_ends(host: str, labels: int) -> list[str]:
    """The host and its parent domains of at most ``labels`` labels, longest first."""
    parts = host.rsplit(".", labels)[-labels:] if host and labels else []
    return [e for e in (".".join(parts[i:]) for i in range(len(parts))) if e]


def judge(pages: DataFrame, index: UrlIndex) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url)."""
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    if index.n_bytes > MAPPED_BYTES or not index.files:
        return judge_dealt(rows, index)
    for file in index.files:
        rows.sparkSession.sparkContext.addFile(file)
    names, n, lengths, labels = [f.rsplit("/", 1)[1] for f in index.files], index.n_shards, index.lengths, index.labels

    def task(batches):
        mapped = of_worker(f"url {names[0]}", lambda: Mapped(names, n))
        for batch in batches:
            hosts = batch.column(1).dictionary_encode()
            ends = [host_ends(h, labels) for h in hosts.dictionary.to_pylist()]
            flat = [e for some in ends for e in some]
            known = iter(mapped.find([HOST_MARK + e for e in flat]))
            ends = [[e for e in some if next(known)] for some in ends]
            of, paths = hosts.indices.to_pylist(), batch.column(2).to_pylist()
            rules, verdicts = [None] * len(of), ["allow"] * len(of)
            # Longest first, then the longer host, so that the first rule found decides.
            owner, asked = [], []
            for i, (k, p) in enumerate(zip(of, paths)):
                some = sorted(((-len(e) - m, -len(e), e + p[:m]) for e in ends[k] for m in lengths if m <= len(p))) if ends[k] else ()
                owner += [i] * len(some)
                asked += [s[2] for s in some]
            listed = set()
            for i, entry, kinds in zip(owner, asked, mapped.find(asked)):
                rule = max((k for k in kinds if k in (ALLOW, BLOCK)), default=None)
                if rule and rules[i] is None:
                    rules[i], verdicts[i] = entry, "allow" if rule == ALLOW else "block"
                if LISTED in kinds:
                    listed.add(i)
            for i in listed:
                verdicts[i] = "block" if rules[i] is None else verdicts[i]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    kind = dict(rows.dtypes)["page_id"]
    return rows.mapInArrow(task, f"page_id {kind}, host string, path string, rule string, verdict string")


def judge_dealt(rows: DataFrame, index: UrlIndex) -> DataFrame:
    """The same for an index of any size: each distinct candidate is looked up by the task that owns its shard."""
    spark = rows.sparkSession
    kinds = written(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")), "addresses")
    labels = f"IF(host = '', 0, least({index.labels}, size(split(host, '[.]'))))"
    ends = kinds.where(f"{labels} > 0").select("host", "path", F.explode(F.expr(f"transform(sequence(1, {labels}), k -> substring_index(host, '.', -k))")).alias("end"))
    lengths = F.filter(F.lit(list(index.lengths)).cast("array<int>"), lambda m: m <= F.length("path"))
    asked = ends.where("end <> ''").select("host", "path", "end", F.explode(lengths).alias("m"))
    asked = asked.select("host", "path", (F.length("end") * 2 + F.col("m")).alias("by_host"), (F.length("end") + F.col("m")).alias("length"), F.concat("end", F.expr("left(path, m)")).alias("entry"))
    distinct = asked.groupBy("entry").agg(F.count(F.lit(1)).alias("times")).withColumn("digest", F.xxhash64("entry"))
    distinct = distinct.withColumn("shard", shard_of(F.col("digest"), index.n_shards))

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        entries, times = left["entry"].to_pylist(), left["times"].to_pylist()
        found = [[] for _ in entries]
        for blob in right["blob"].to_pylist() if entries else ():
            for shard in read_shards(pa.BufferReader(blob)):
                found = shard.find(left["digest"].to_numpy().astype(np.int64).view(np.uint64), entries)
        hits = [(e, k, n) for e, some, n in zip(entries, found, times) for k in some]
        return pa.table({n: pa.array([h[i] for h in hits], t) for i, (n, t) in enumerate((("entry", pa.string()), ("kind", pa.int32()), ("times", pa.int64())))})

    blobs = spark.read.parquet(index.shards)
    hits = written(distinct.groupBy("shard").cogroup(blobs.groupBy("shard")).applyInArrow(look, "entry string, kind int, times long"), "url_hits")
    # One row per entry: the kind of its rule, and whether it is listed.
    hits = hits.groupBy("entry").agg(F.max(F.when(F.col("kind") != LISTED, F.col("kind"))).alias("kind"), F.max(F.col("kind") == LISTED).alias("listed"), F.max("times").alias("times"))
    total = hits.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    fits = join_hot(asked, hits, ["entry"], "times", total, how="inner")
    best = F.max_by(F.when(F.col("kind").isNotNull(), F.struct("entry", "kind")), F.when(F.col("kind").isNotNull(), F.struct("length", "by_host")))
    judged = fits.groupBy("host", "path").agg(best.alias("best"), F.max("listed").alias("listed"))
    judged = kinds.join(judged, ["host", "path"], "left").select(
        "host", "path", "n", F.col("best.entry").alias("rule"),
        F.when(F.col("best").isNotNull(), F.when(F.col("best.kind") == ALLOW, "allow").otherwise("block")).when(F.col("listed"), "block").otherwise("allow").alias("verdict"),
    )
    judged = written(judged, "judged")
    n_rows = judged.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return join_hot(rows, judged, ["host", "path"], "n", n_rows, how="inner").select("page_id", "host", "path", "rule", "verdict")


def page_entries(pages: DataFrame) -> DataFrame:
    """The entries of the query: its rules, and every host of the pages that has a listed word."""
    host, _ = split_url(F.col("url"))
    hosts = pages.select(host.alias("host")).where(F.arrays_overlap(F.split("host", "[.-]"), F.lit(list(HOST_WORDS)))).distinct()
    listed = hosts.select("host", F.lit("").alias("path"), F.lit(LISTED).alias("kind"))
    rules = pages.sparkSession.createDataFrame(RULES, "host string, path string, kind int")
    return rules.unionByName(listed)


ORACLE_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url[position('://' IN url) + 3:], '^[^?#]*') ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(split_part(rest, '/', 1), '{UPPER}', '{LOWER}') AS host, rest[length(split_part(rest, '/', 1)) + 1:] AS path FROM u),
rules AS (SELECT * FROM (VALUES {', '.join(f"('{h}', '{p}', '{'allow' if k == ALLOW else 'block'}')" for h, p, k in RULES)}) AS r(rule_host, rule_path, verdict)),
j AS (SELECT page_id, host, path, rule_host || rule_path AS rule, verdict,
        row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS k
      FROM (SELECT DISTINCT * FROM p) JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, p.host, p.path, rule, coalesce(verdict, CASE WHEN list_has_any(regexp_split_to_array(p.host, '[.-]'), {list(HOST_WORDS)}) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN (SELECT * FROM j WHERE k = 1) j ON p.page_id IS NOT DISTINCT FROM j.page_id AND p.host = j.host AND p.path = j.path"""
