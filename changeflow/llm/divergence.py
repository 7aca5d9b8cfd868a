"""Source divergence audit: which terms, and which sources of a language, differ, by a minimal-perfect-hash recount.

The first pass counts the documents of each term exactly; terms of enough documents of a language are kept.
Kept terms are dealt to shards of a language, and one task per shard builds a minimal perfect hash: levels of bits in which a term is
placed where it is alone, the rest going to the next level, the few left over (equal digests) to a list. Slots are the ranks of the bits,
and the terms lie in slot order, so that a hit is verified against the stored term. Shards are broadcast, as many at a
time as fit ``BROADCAST_BYTES``, with one counting pass for each such set; it increments dense arrays of slots per group (language
and source). The counts of a shard's terms in all sources of its language are then compared in one task, the shard being small
enough for that, and sums over shards give the divergence of each pair of sources.

Defined results: null text, language and source are empty strings. Each row is a document, repeated ids and copies too. A language without
kept terms has value 0 for every pair; a language of one source has no pairs. An empty table gives an
empty table. Other columns are ignored. The rows of part ``pair`` are quadratic in the sources of a language by definition. N + 5 V stays below 2**53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, written
from .wordcodes import of_worker, raw, text_batches

#: Least documents of a kept term, what is added to each count, and the terms reported of each group.
LEAST_DOCS = 30
ADDED = 5
TOP_TERMS = 50
SCALE = 1_000_000_000
#: Terms of a shard, at most; fewer where a language has many sources (cells of sources and terms in one task).
SHARD_TERMS = 8192
SHARD_CELLS = 1 << 21
#: Bytes of shards that are broadcast at once, and dense cells that a counting task holds.
BROADCAST_BYTES = 64 << 20
HELD_CELLS = 1 << 22
#: Levels of a perfect hash before the list, and bits of a level for each term.
LEVELS = 24
SPARE = 2
#: Seed of Spark's xxhash64, which deals terms to shards.
SEED = 42
#: Bytes of text handled at once.
BLOCK = 8 << 20

LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def term_codes(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Code of every term, the distinct terms, and the text that each is in."""
    data, offsets = raw(texts)
    solid = LETTER[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = solid[first]
    starts = np.flatnonzero(begins)
    upto = np.cumsum(solid)
    ends = np.append(upto[starts] - 1, upto[-1] if len(upto) else 0).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.tobytes()), pa.py_buffer(FOLD[data[solid]].tobytes())).dictionary_encode()
    return terms.indices.to_numpy().astype(np.int64), terms.dictionary, np.searchsorted(offsets, starts, "right") - 1


def filled(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term) of the terms in at least ``least`` documents of the language."""

    def task(batches):
        for batch, texts in text_batches(batches, limit=BLOCK):
            codes, terms, text = term_codes(texts)
            langs = batch.column(0).dictionary_encode()
            met = np.unique(text * max(1, len(terms)) + codes)  # once per document
            of = langs.indices.to_numpy()[met // max(1, len(terms))].astype(np.int64)
            pairs, n = np.unique(of * max(1, len(terms)) + met % max(1, len(terms)), return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "lang": langs.dictionary.take(pa.array(pairs // max(1, len(terms)))),
                "term": terms.take(pa.array(pairs % max(1, len(terms)))).cast(pa.string()),
                "n": pa.array(n.astype(np.int64)),
            })

    rows = docs.select("lang", "text").mapInArrow(task, "lang string, term string, n long")
    return rows.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


def mixed(digests: np.ndarray, level: int) -> np.ndarray:
    """Another hash of each digest for each level."""
    h = digests ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def build_levels(digests: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The bits of each level, and the keys in slot order (those left over last)."""
    left, levels, order = np.arange(len(digests)), [], []
    while len(left) and len(levels) < LEVELS:
        size = SPARE * len(left)
        at = (mixed(digests[left], len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        placed = alone[at]
        levels.append(alone)
        order.append(left[placed][np.argsort(at[placed])])
        left = left[~placed]
    return levels, np.concatenate([*order, left]) if order else left


class PerfectHash:
    """Slots of a shard's terms; -1 for any other."""

    def __init__(self, sizes: list[int], bits: bytes, terms: pa.Array):
        flat = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)[:sum(sizes)]
        ranks = np.cumsum(flat) - 1
        cuts = np.cumsum(sizes)[:-1] if sizes else []
        self.levels = [np.where(b, r, -1) for b, r in zip(np.split(flat, cuts), np.split(ranks, cuts))] if sizes else []
        self.terms = terms
        placed = int(flat.sum())
        self.rest = {t: placed + i for i, t in enumerate(terms.slice(placed).to_pylist())}

    def slots(self, digests: np.ndarray, terms: pa.Array) -> np.ndarray:
        slot = np.full(len(digests), -1, np.int64)
        open_ = np.arange(len(digests))
        for number, level in enumerate(self.levels):
            got = level[(mixed(digests[open_], number) % np.uint64(len(level))).astype(np.int64)]
            slot[open_] = got
            open_ = open_[got < 0]
        hit = np.flatnonzero(slot >= 0)
        same = pc.equal(self.terms.take(pa.array(slot[hit])), terms.take(pa.array(hit))).to_numpy(zero_copy_only=False) if len(hit) else np.zeros(0, bool)
        slot[hit[~same]] = -1
        if self.rest:
            for i in np.flatnonzero(slot < 0).tolist():
                slot[i] = self.rest.get(terms[i].as_py(), -1)
        return slot


def digests_of(terms: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t.encode(), SEED) for t in terms.to_pylist()), np.uint64, len(terms))


SHARDS = "lang string, shard int, kept long, n_shards int, sizes array<int>, bits binary, terms array<string>"


def build_shards(kept: DataFrame, langs: DataFrame) -> DataFrame:
    """One row per shard with its perfect hash; ``langs``: lang, kept (number of terms) and n_shards."""

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        terms = table["term"].combine_chunks().cast(pa.large_string())
        levels, order = build_levels(digests_of(terms))
        bits = np.packbits(np.concatenate(levels)).tobytes() if levels else b""
        return pa.table({
            "lang": pa.array([key[0].as_py()]), "shard": pa.array([key[1].as_py()], pa.int32()),
            "kept": table["kept"].slice(0, 1), "n_shards": table["n_shards"].slice(0, 1).cast(pa.int32()),
            "sizes": pa.array([[len(b) for b in levels]], pa.list_(pa.int32())), "bits": pa.array([bits], pa.binary()),
            "terms": pa.array([terms.take(pa.array(order)).to_pylist()], pa.list_(pa.string())),
        })

    dealt = kept.join(langs, "lang").withColumn("shard", F.expr("CAST(pmod(xxhash64(term), n_shards) AS INT)"))
    return dealt.groupBy("lang", "shard").applyInArrow(build, SHARDS)


class Recount:
    """The broadcast shards in a worker: slots of the terms of a language, numbered over its shards."""

    def __init__(self, data: bytes):
        rows = pa.ipc.open_stream(data).read_all()
        self.langs: dict[str, tuple[int, dict[int, tuple[int, PerfectHash]], int]] = {}
        for r in range(rows.num_rows):
            lang, shard, n_shards = (rows[c][r].as_py() for c in ("lang", "shard", "n_shards"))
            terms = rows["terms"][r].values.cast(pa.large_string())
            n, shards, width = self.langs.get(lang, (n_shards, {}, 0))
            shards[shard] = (width, PerfectHash(rows["sizes"][r].as_py(), rows["bits"][r].as_py(), terms))
            self.langs[lang] = (n, shards, width + len(terms))

    def slots(self, lang: str, terms: pa.Array) -> np.ndarray:
        n, shards, _ = self.langs[lang]
        digests = digests_of(terms)
        signed = digests.view(np.int64)
        owner = signed % n  # like pmod
        out = np.full(len(terms), -1, np.int64)
        for shard in np.unique(owner).tolist():
            if shard in shards:
                at = np.flatnonzero(owner == shard)
                got = shards[shard][1].slots(digests[at], terms.take(pa.array(at)))
                out[at] = np.where(got >= 0, got + shards[shard][0], -1)
        return out

    def places(self, lang: str, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard and slot in it of numbered slots in ascending order."""
        _, shards, _ = self.langs[lang]
        numbers, bases = np.array(list(shards)), np.array([b for b, _ in shards.values()])
        which = np.searchsorted(bases, cells, "right") - 1
        return numbers[which], cells - bases[which]


def recount(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, source, shard, slot, n): occurrences of kept terms, for the shards given (few enough to broadcast)."""
    sink = pa.BufferOutputStream()
    table = shards.select("lang", "shard", "n_shards", "sizes", "bits", "terms").toArrow()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    sent = docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())

    def rows_of(held, known):
        for (lang, source), dense in held.items():
            cells = np.flatnonzero(dense)
            shard, slot = known.places(lang, cells)
            yield pa.RecordBatch.from_pydict({"lang": pa.repeat(lang, len(cells)), "source": pa.repeat(source, len(cells)), "shard": pa.array(shard.astype(np.int32)), "slot": pa.array(slot.astype(np.int32)), "n": pa.array(dense[cells])})
        held.clear()

    def task(batches):
        known = of_worker(f"recount {sent._path}", lambda: Recount(sent.value))
        held: dict[tuple[str, str], np.ndarray] = {}
        cells = 0
        for batch, texts in text_batches(batches, limit=BLOCK):
            codes, terms, text = term_codes(texts)
            langs, sources = batch.column(0).dictionary_encode(), batch.column(1).dictionary_encode()
            lang_of = langs.indices.to_numpy().astype(np.int64)
            group_of = lang_of * len(sources.dictionary) + sources.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                if lang not in known.langs:
                    continue
                mine = lang_of[text] == k
                used, at = np.unique(codes[mine], return_inverse=True)
                slot = known.slots(lang, terms.take(pa.array(used)))[at]
                groups = group_of[text[mine]]
                width = known.langs[lang][2]
                order = np.argsort(groups, kind="stable")
                cuts = np.flatnonzero(np.diff(groups[order])) + 1
                for some in np.split(order, cuts) if len(order) else ():
                    hit = slot[some]
                    hit = hit[hit >= 0]
                    key = (lang, sources.dictionary[int(groups[some[0]]) % len(sources.dictionary)].as_py())
                    if key not in held:
                        if cells + width > HELD_CELLS and held:
                            yield from rows_of(held, known)
                            cells = 0
                        held[key] = np.zeros(width, np.int64)
                        cells += width
                    held[key] += np.bincount(hit, minlength=width)
        yield from rows_of(held, known)

    return docs.mapInArrow(task, "lang string, source string, shard int, slot int, n long")


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * count / total), exact for count <= total < 2**53: three digits at a time."""
    out, left = np.divmod(count, total)
    for _ in range(3):
        more, left = np.divmod(left * 1000, total)
        out = out * 1000 + more
    return out + 1


def compare(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
    """What a shard adds to each pair of sources, and its best terms of each source.

    ``left``: counts by source and slot, with slot -1 the sum over all kept terms. ``right``: the shard.
    """
    terms = right["terms"][0].values.cast(pa.large_string()) if right.num_rows else pa.array([], pa.large_string())
    kept = right["kept"][0].as_py()
    names, slot, n = left["source"].combine_chunks().dictionary_encode(), left["slot"].to_numpy(), left["n"].to_numpy()
    of, names = names.indices.to_numpy(), names.dictionary
    size, width = len(names), len(terms)
    total = np.zeros(size, np.int64)
    total[of[slot < 0]] = n[slot < 0]
    counts = np.zeros((size, width), np.int64)
    counts[of[slot >= 0], slot[slot >= 0]] = n[slot >= 0]
    p = share(counts + ADDED, (total + ADDED * kept)[:, None]) if width else counts
    q = share(counts.sum(0) + ADDED, total.sum() + ADDED * kept) if width else np.zeros(0, np.int64)
    rank = np.empty(width, np.int64)
    rank[pc.sort_indices(terms).to_numpy()] = np.arange(width)
    every = np.arange(size)
    source, item, value, part = [], [], [], []
    for i in range(size):
        others = every[every != i]
        source.append(np.full(len(others), i))
        item.append(names.take(pa.array(others)))
        value.append(np.abs(p[others] - p[i]).sum(1))
        part.append(np.zeros(len(others), np.int8))
        up = np.flatnonzero((counts[i] > 0) & (p[i] > q))
        best = up[np.lexsort((rank[up], q[up] - p[i][up]))][:TOP_TERMS]
        source.append(np.full(len(best), i))
        item.append(terms.take(pa.array(best)).cast(pa.string()))
        value.append(p[i][best] - q[best])
        part.append(np.ones(len(best), np.int8))
    part = np.concatenate(part) if part else np.zeros(0, np.int8)
    return pa.table({
        "lang": pa.repeat(key[0].as_py(), len(part)),
        "source": names.take(pa.array(np.concatenate(source))) if source else pa.array([], pa.string()),
        "part": pa.array(np.array(["pair", "term"], dtype=object)[part], pa.string()),
        "item": pa.concat_arrays(item) if item else pa.array([], pa.string()),
        "value": pa.array(np.concatenate(value).astype(np.int64) if value else np.zeros(0, np.int64)),
    })


def audit(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part, item, value and rank: divergent sources and terms of every group."""
    docs = filled(docs)
    groups = written(docs.select("lang", "source").distinct(), "groups")
    kept = written(kept_terms(docs, least), "kept")
    width = F.greatest(F.lit(64), F.least(F.lit(SHARD_TERMS), F.expr(f"{SHARD_CELLS} DIV sources")))
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept")), "lang", "left")
    langs = langs.select("lang", F.coalesce("kept", F.lit(0)).alias("kept"), F.ceil(F.coalesce("kept", F.lit(0)) / width).cast("int").alias("n_shards"))
    langs = written(langs, "langs")
    few = broadcast_if_small(langs, langs.count())
    shards = written(build_shards(kept, few), "perfect_hashes")
    size = shards.agg(F.coalesce(F.sum(F.octet_length("bits") + F.expr("aggregate(terms, 0L, (s, t) -> s + octet_length(t) + 16)")), F.lit(0))).first()[0]

    # Twice as many sets as their mean size asks for: shards are dealt by hash.
    sets = 1 if size <= BROADCAST_BYTES else -(-2 * size // BROADCAST_BYTES)
    counts = None
    for k in range(sets):
        some = recount(docs, shards.where(F.pmod(F.xxhash64("lang", "shard"), F.lit(sets)) == k))
        counts = some if counts is None else counts.unionByName(some)
    counts = written(counts.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n")), "recount")

    sums = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"))
    # A language without kept terms has one shard without terms.
    places = shards.select("lang", "shard", "kept", "terms").unionByName(langs.where("kept = 0").select("lang", F.lit(0).alias("shard"), "kept", F.array().cast("array<string>").alias("terms")))
    whole = sums.join(places.select("lang", "shard"), "lang").select("lang", "source", "shard", F.lit(-1).alias("slot"), "n")
    left = counts.select("lang", "source", "shard", "slot", "n").unionByName(whole)
    right = places.select(F.col("lang").alias("of_lang"), F.col("shard").alias("of_shard"), "kept", "terms")
    found = left.groupBy("lang", "shard").cogroup(right.groupBy("of_lang", "of_shard")).applyInArrow(compare, "lang string, source string, part string, item string, value long")
    found = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    return found.withColumn("rank", F.row_number().over(order)).where(f"part = 'pair' OR rank <= {TOP_TERMS}")


def oracle_sql(least: int = LEAST_DOCS) -> str:
    """DuckDB SQL for the rows of ``audit(documents)``."""
    p = f"1 + {SCALE}::HUGEINT * (c + {ADDED}) // (total + {ADDED} * kept)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
o AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT id) >= {least}),
v AS (SELECT lang, count(*) AS kept FROM k GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS c FROM o JOIN k USING (lang, term) GROUP BY ALL),
a AS (SELECT lang, source, term, coalesce(c, 0) AS c FROM g JOIN k USING (lang) LEFT JOIN n USING (lang, source, term)),
s AS (SELECT lang, source, sum(c) AS total FROM a GROUP BY ALL),
q AS (SELECT lang, term, {p} AS q FROM (SELECT lang, term, sum(c) AS c FROM a GROUP BY ALL) JOIN (SELECT lang, sum(c) AS total FROM a GROUP BY ALL) USING (lang) JOIN v USING (lang)),
p AS (SELECT lang, source, term, c, {p} AS p FROM a JOIN s USING (lang, source) JOIN v USING (lang)),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM r
QUALIFY part = 'pair' OR rank <= {TOP_TERMS}"""
