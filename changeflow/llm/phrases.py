"""Phrase collocations by Toivonen's sampling: a sample proposes, full passes count exactly.

Texts are kept as blocks, one per language, sample and batch: codes into the block's own word list with a mark between
pieces. Words are counted from the blocks' lists. The longer phrases that are frequent in the sample (at a lowered threshold) form,
with the frequent words, a proposed set. A full
pass counts that set and its negative border, the phrases outside it whose two longest parts are both inside. A border
phrase that turns out frequent is a failure of the sample: it joins the set, and a further pass counts what the border
gained. No frequent phrase is missed when a pass adds nothing, as all parts of a frequent phrase are frequent. The sample's own set is found by the same passes over the sample from the frequent words.

Passes count phrases by a 48-bit hash, and the set is sent to the tasks as a bit filter of a fixed size. Phrases that share a
hash, or that the filter takes for members by mistake, only make the set or its border larger, never smaller. A last pass counts
the phrases found frequent by their texts: results are exact whatever the sample, the hash and the filter said.

Defined results: a null text is empty, a null language ``und``. Repeated rows and copies all count, overlapping
occurrences too. Words keep the spelling of their bytes but for A-Z. Ties follow the contract: the earliest cut, then
score, count and UTF-8 order. Tables without a frequent phrase give an empty table. Other columns are ignored.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, written
from .wordcodes import raw, text_batches

#: Least count of a phrase, most words of it, and the phrases returned for each language.
LEAST = 30
WORDS = 4
TOP = 2000
#: One in so many documents is in the sample; there a phrase is proposed from this share of the expected least count.
SAMPLE_ONE_IN = 8
LOWERED = 0.6
#: A candidate goes when a longer one around it has this many hundredths of its count.
COVERED = 80
#: Bits of the filter (8 MB), whatever the corpus.
FILTER_BITS = 1 << 26
#: Bytes of text in a block.
BLOCK = 6 << 20

PIECE_END = np.zeros(256, dtype=bool)
PIECE_END[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
GAP = PIECE_END.copy()
GAP[[9, 32]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

FACTOR = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)
UNDO = np.uint64(pow(int(FACTOR), -1, 1 << 64))
#: Passes count by the upper bits of a hash.
SHORT = np.uint64(16)


def word_codes(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Code of every word, the distinct words, the text of each and whether a piece begins with it."""
    data, offsets = raw(texts)
    solid = ~GAP[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = solid[first]
    starts = np.flatnonzero(begins)
    upto = np.cumsum(solid, dtype=np.int32)
    ends = np.append(upto[starts] - 1, upto[-1] if len(upto) else 0).astype(np.int64)
    letters = FOLD[data[solid]]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.tobytes()), pa.py_buffer(letters.tobytes())).dictionary_encode()
    text = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(PIECE_END[data], dtype=np.int32)[starts] if len(starts) else starts
    fresh = np.append(True, (text[1:] != text[:-1]) | (piece[1:] != piece[:-1]))[:len(starts)]
    return words.indices.to_numpy(), words.dictionary, text, fresh


def word_blocks(docs: DataFrame, one_in: int) -> DataFrame:
    """Blocks of one language, in the sample or not: word list with counts, and codes with -1 before each piece."""

    def task(batches):
        for batch, texts in text_batches(batches, limit=BLOCK):
            codes, words, text, fresh = word_codes(texts)
            langs = batch.column(0).dictionary_encode()
            kind = langs.indices.to_numpy() * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            of = kind[text]
            for k in np.unique(of).tolist():
                mine = of == k
                used, seq = np.unique(codes[mine], return_inverse=True)
                at = np.flatnonzero(fresh[mine])
                counts = np.bincount(seq, minlength=len(used))
                seq = np.insert(seq.astype(np.int32), at, -1)
                lang, own = langs.dictionary[k // 2].as_py(), words.take(pa.array(used)).cast(pa.string())
                ends = pa.array([0, len(used)], pa.int32())
                yield pa.RecordBatch.from_pydict({
                    "lang": [lang], "sampled": [bool(k % 2)],
                    "words": pa.ListArray.from_arrays(ends, own), "counts": pa.ListArray.from_arrays(ends, pa.array(counts)),
                    "codes": pa.array([zstandard.compress(seq.tobytes(), 1)], pa.binary()),
                })

    sampled = F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_in)) == 0
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), sampled.alias("sampled"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, "lang string, sampled boolean, words array<string>, counts array<long>, codes binary")


def word_hash(lang: str, words: pa.Array) -> np.ndarray:
    """Polynomials of the words' bytes modulo 2**64, by running sums; mixed with length and language."""
    data, offsets = raw(words)
    up, down = np.cumprod(np.full(len(data) + 1, FACTOR)), np.cumprod(np.full(len(data) + 1, UNDO))
    upto = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * up[:-1]))
    h = (upto[offsets[1:]] - upto[offsets[:-1]]) * down[offsets[:-1]]
    h = (h ^ np.diff(offsets).astype(np.uint64) ^ np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))) * SPREAD
    return (h ^ (h >> np.uint64(32))) * FACTOR


def longer_hash(prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its words but the last and that of the last."""
    h = (prefix * FACTOR) ^ (last + (prefix >> np.uint64(29)))
    return (h ^ (h >> np.uint64(32))) * SPREAD


def places(short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each shortened hash."""
    mask = np.uint64(FILTER_BITS - 1)
    return short & mask, (short >> np.uint64(22)) & mask


def inside(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.ones(len(hashes), dtype=bool)
    for at in places(hashes >> SHORT):
        out &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0
    return out


def block_phrases(words: pa.Array, base: np.ndarray, seq: np.ndarray, old: np.ndarray | None, new: np.ndarray, most: int):
    """(word codes, hashes, counts) of the block's phrases that ``new`` admits and ``old`` did not, for each number of words."""
    ids = seq.astype(np.int64)
    grams, hashes, met = np.arange(len(words))[:, None], base, np.full(len(words), old is not None)
    for n in range(2, most + 1):
        member = np.append(inside(new, hashes), False)  # -1: no phrase
        before = met & inside(old, hashes) if old is not None else met
        here = member[ids]
        at = np.flatnonzero(here[:-1] & here[1:])
        if not len(at):
            return
        found, inverse, counts = np.unique(ids[at] * len(hashes) + ids[at + 1], return_inverse=True, return_counts=True)
        head, tail = found // len(hashes), found % len(hashes)
        last = grams[tail, -1]
        ids = np.full(len(ids) - 1, -1, np.int64)
        ids[at] = inverse
        met = before[head] & before[tail]  # counted by an earlier pass
        fresh = ~met
        grams, hashes = np.column_stack([grams[head], last]), longer_hash(hashes[head], base[last])
        yield grams[fresh], hashes[fresh], counts[fresh]


def blocks_of(batch: pa.RecordBatch):
    for lang, words, codes in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
        seq = np.frombuffer(zstandard.decompress(codes.as_py()), np.int32)
        words = words.values.cast(pa.large_string())
        yield lang, words, word_hash(lang, words), seq


def counted(blocks: DataFrame, old: np.ndarray | None, new: np.ndarray, least: int, most: int) -> DataFrame:
    """The shortened hashes of phrases newly admitted whose counts reach ``least``.

    Blocks have added up their phrases; few repeat within a task, so that they are added up after the shuffle. They are
    sent in the order of their hashes, for better compression.
    """
    sent = blocks.sparkSession.sparkContext.broadcast((old, new))

    def task(batches):
        old, new = sent.value
        for batch in batches:
            for _, words, base, seq in blocks_of(batch):
                for _, hashes, counts in block_phrases(words, base, seq, old, new, most):
                    order = np.argsort(hashes)
                    yield pa.RecordBatch.from_pydict({"hash": pa.array((hashes[order] >> SHORT).view(np.int64)), "a": pa.array(counts[order].astype(np.int64))})
        pa.default_memory_pool().release_unused()  # the worker lives on

    rows = blocks.select("lang", "words", "codes").mapInArrow(task, "hash long, a long")
    return rows.repartition("hash").groupBy("hash").agg(F.sum("a").alias("a")).where(F.col("a") >= least).select("hash")


def recounted(blocks: DataFrame, members: np.ndarray, least: int, most: int) -> DataFrame:
    """(lang, phrase, words, a) of all phrases in the set, counted by their texts."""
    sent = blocks.sparkSession.sparkContext.broadcast(members)

    def task(batches):
        members = sent.value
        for batch in batches:
            for lang, words, base, seq in blocks_of(batch):
                for grams, hashes, counts in block_phrases(words, base, seq, None, members, most):
                    mine = inside(members, hashes)
                    parts = [words.take(pa.array(c)) for c in grams[mine].T]
                    phrases = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
                    size = len(phrases)
                    yield pa.RecordBatch.from_pydict({"lang": pa.repeat(lang, size), "phrase": phrases.cast(pa.string()), "words": pa.repeat(pa.scalar(len(parts), pa.int32()), size), "a": pa.array(counts[mine].astype(np.int64))})

    rows = blocks.select("lang", "words", "codes").mapInArrow(task, "lang string, phrase string, words int, a long")
    return written(rows.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).where(F.col("a") >= least), "phrases")


def word_marks(words: DataFrame) -> DataFrame:
    """The shortened hashes of ``words`` (lang, phrase)."""

    def task(batches):
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                some = batch.column(1).filter(pc.equal(batch.column(0), lang)).cast(pa.large_string())
                yield pa.RecordBatch.from_pydict({"hash": pa.array((word_hash(lang, some) >> SHORT).view(np.int64))})

    return words.select("lang", "phrase").mapInArrow(task, "hash long")


def marked(hashes: DataFrame, *sets: np.ndarray) -> list[np.ndarray]:
    """Each of ``sets`` with the bits of all ``hashes``, as ``places`` puts them."""
    both = hashes.select(F.explode(F.array(F.col("hash"), F.shiftright("hash", 22))).alias("h"))
    at = both.select(F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1).cast("long")).alias("at"))
    got = at.groupBy(F.shiftright("at", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("mark")).toArrow()  # at most FILTER_BITS / 64 rows
    out = [s.copy() for s in sets]
    for s in out if got.num_rows else ():
        s[got["slot"].to_numpy()] |= got["mark"].to_numpy().view(np.uint64)
    return out


def closed(blocks: DataFrame, words: np.ndarray, proposed: np.ndarray, least: int, most: int) -> tuple[np.ndarray, int]:
    """Passes over ``blocks`` until the border of the set holds no frequent phrase: the frequent phrases (with ``words``), and the passes."""
    old, new, frequent, passes = None, proposed, words, 0
    while True:
        grown, frequent = marked(counted(blocks, old, new, least, most), new, frequent)
        passes += 1
        release(blocks.sparkSession)
        if (grown == new).all():
            return frequent, passes
        old, new = new, grown


@dataclasses.dataclass
class Mined:
    """Frequent phrases (lang, phrase, words, a), single words among them, words of each language, and the full passes made."""

    frequent: DataFrame
    totals: DataFrame
    passes: int


def mine(docs: DataFrame, least: int = LEAST, most: int = WORDS, one_in: int = SAMPLE_ONE_IN) -> Mined:
    blocks = written(word_blocks(docs, one_in), "phrase_blocks")
    listed = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", F.col("w.words").alias("phrase"), F.col("w.counts").alias("a"))
    frequent = written(listed.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least), "words")
    words = marked(word_marks(frequent), np.zeros(FILTER_BITS // 64, np.uint64))[0]
    proposed, _ = closed(blocks.where("sampled"), words, words, max(2, int(LOWERED * least / one_in)), most)
    members, passes = closed(blocks, words, proposed, least, most)
    frequent = frequent.select("lang", "phrase", F.lit(1).alias("words"), "a").unionByName(recounted(blocks, members, least, most))
    totals = blocks.groupBy("lang").agg(F.sum(F.expr("aggregate(counts, 0L, (s, c) -> s + c)")).alias("n"))
    return Mined(frequent, totals, passes)


def top_phrases(mined: Mined, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best candidates."""
    big = lambda c: F.col(c).cast("decimal(38,0)")
    f = mined.frequent
    phrases = f.where("words > 1").select("lang", "phrase", "a", "words", F.split("phrase", " ").alias("w"))
    part = "concat_ws(' ', slice(w, {}, {}))"
    spans = "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> " + part.format("i", "m") + ")))"
    around = phrases.where("words > 2").select("lang", F.explode(F.array_distinct(F.expr(spans))).alias("phrase"), "a")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = phrases.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (big("longer") * 100 < big("a") * covered))
    cuts = left.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr(part.format(1, "k")).alias("first"), F.expr(part.format("k + 1", "size(w) - k")).alias("rest"))
    # All parts of a frequent phrase are frequent.
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    score = F.expr("CAST(a AS DECIMAL(38, 0)) * 2000000 DIV (CAST(l AS DECIMAL(38, 0)) + r)").cast("long")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within some buckets of a language, so that no task ranks all its candidates.
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(32))).orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    n = mined.totals
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = LEAST, most: int = WORDS, top: int = TOP, covered: int = COVERED) -> str:
    """DuckDB SQL for the rows of ``top_phrases(mine(documents))``."""
    grams = " UNION ALL ".join(f"SELECT lang, {n} AS words, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS phrase FROM p" for n in range(1, most + 1))
    return f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
s AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM s),
g AS ({grams}),
f AS (SELECT lang, words, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE words = 1 GROUP BY 1),
c AS (SELECT lang, words, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= {least}),
u AS (SELECT lang, a AS longer, unnest(flatten(list_transform(range(2, words), lambda m: list_transform(range(1, words - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) AS phrase FROM c WHERE words > 2),
m AS (SELECT lang, phrase, max(longer) AS longer FROM u GROUP BY ALL),
k AS (SELECT c.*, unnest(range(1, words)) AS k FROM c LEFT JOIN m USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {covered} * a),
x AS (SELECT k.lang, k.phrase, k.a, k.k, h.a AS l, t.a AS r, (2000000::HUGEINT * k.a // (h.a + t.a))::BIGINT AS score FROM k
      JOIN f h ON h.lang = k.lang AND h.phrase = array_to_string(w[1:k], ' ')
      JOIN f t ON t.lang = k.lang AND t.phrase = array_to_string(w[k + 1:], ' ')),
y AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS best FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM y WHERE best = 1)
SELECT z.lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= {top}"""
