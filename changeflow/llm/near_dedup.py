"""Near-duplicate classes by ProbMinHash over word shingles, weighted and distinct.

A text is the multiset of its runs of five words (lower case); the weight of a
shingle is how often it occurs. ProbMinHash lets every shingle emit points of a
Poisson process whose rate is its weight, each into a random slot; a slot keeps
the shingle of its first point, and a shingle stops as soon as its next point comes after
the last slot's first. Two texts agree in a slot with the probability Jaccard
similarity of their multisets. Slots are banded into buckets. A second sketch, in which
every shingle weighs one, agrees in a slot with the share of common distinct shingles,
however often a text repeats a passage; its bands go into the same buckets (a text
that repeats no shingle has one sketch).

Links are verified on the texts: the share of common distinct shingles must reach
the threshold. Pairs whose distinct sketches are far below it are not compared. Each text is first compared with two heads, the least and the
greatest of the least members of its buckets, and linked texts
are joined into classes. Where many pairs of bucket members are then still of different classes,
rounds follow in which each text is compared with one pivot, the most similar one by the sketches of those that its buckets hold. What all these may have missed comes last: members of a
bucket that are then of different classes are compared with each other, in buckets
of many such members through an exact prefix filter (rare shingles first) whose pairs
are all compared, so that no bucket is ever expanded into all its pairs. A pair at the
threshold shares no bucket with a probability of 7 in a million.

Defined results: a text of one to four words has one shingle, all its words. Texts
equal up to case and white space are copies and share a class; that holds for texts
without words too (null counts as empty), which resemble nothing else. The class id
is the smallest id in the class. Repeated rows are members like any other. An empty
table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, WHITE, broadcast_if_small, discard, join_hot, release, written
from .wordcodes import raw, text_batches

WORDS = 5
SIMILARITY = 0.8
ROWS, BANDS = 5, 30
SLOTS = ROWS * BANDS
#: Pairs whose slots of distinct shingles agree less than this are not verified; a pair at the threshold is 10 standard deviations above.
ESTIMATE = 0.45
#: Members of different classes up to which a bucket's pairs are listed; above, the prefix filter finds them.
LISTED = 4
#: Pairs of one node that meet one copy of its text; a node of more pairs is copied.
SPLIT = 1000
#: Rounds of pivots at most, and pairs left for each bucket membership that call for another one. Neither changes the classes: what the
#: rounds leave apart is compared after them.
TURNS, DENSE = 4, 4

C0, C1, C2, C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x2545F4914F6CDD1D))


def mix(z: np.ndarray) -> np.ndarray:
    """A bijective hash of 64-bit numbers."""
    z = (z ^ (z >> np.uint64(30))) * C1
    z = (z ^ (z >> np.uint64(27))) * C2
    return z ^ (z >> np.uint64(31))


def normal_form(text: str = "text") -> Column:
    """Words in lower case, one space between; null is empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), WHITE, " "))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of normal-form texts, the text of each (ascending) and its count."""
    data, offsets = raw(texts)
    n = len(texts)
    lengths = np.diff(offsets)
    space = data == 32
    first = np.zeros(len(data), bool)
    first[1:] = space[:-1]
    first[offsets[:-1][lengths > 0]] = True
    first &= ~space
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A word's hash: its bytes folded in one pass, then mixed.
    owner = np.searchsorted(offsets, starts, "right") - 1
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    value = np.where(space, np.uint64(0), mix((data.astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64) + C0))
    word = mix(np.add.reduceat(value, starts))
    # Runs of WORDS words; a shorter text is one run.
    n_words = np.bincount(owner, minlength=n)
    begin = np.cumsum(n_words) - n_words
    runs = np.where(n_words >= WORDS, n_words - WORDS + 1, np.minimum(n_words, 1))
    at = np.repeat(begin, runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    text = np.repeat(np.arange(n), runs)
    hashes = np.zeros(len(at), np.uint64)
    last = (begin + n_words)[text]
    for k in range(WORDS):
        there = at + k < last
        hashes = np.where(there, mix(hashes * C3 + word[np.minimum(at + k, len(word) - 1)] + C0), hashes)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1]))
    begin = np.flatnonzero(new)
    return hashes[begin], text[begin], np.diff(np.append(begin, len(hashes)))


def prob_min_hash(hashes: np.ndarray, text: np.ndarray, weights: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """The shingle that each slot of each of ``n`` texts keeps."""
    first = np.full(n * slots, np.inf)
    kept = np.zeros(n * slots, np.uint64)
    last = np.full(n, np.inf)
    rate, when, turn = weights.astype(np.float64), np.zeros(len(hashes)), 0
    while len(hashes):
        turn += 1
        z = mix(hashes + np.uint64(int(C0) * turn & (1 << 64) - 1))
        when = when - np.log(((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        alive = when < last[text]  # later points come later still: who is late now is done
        hashes, text, rate, when, z = hashes[alive], text[alive], rate[alive], when[alive], z[alive]
        slot = text * slots + (mix(z ^ C3) % np.uint64(slots)).astype(np.int64)
        np.minimum.at(first, slot, when)
        wins = first[slot] == when
        kept[slot[wins]] = hashes[wins]
        if turn < 8 or turn % 8 == 0:  # an old bound is only a looser one
            last = first.reshape(n, slots).max(1)
    return kept.reshape(n, slots)


def band_buckets(kept: np.ndarray) -> np.ndarray:
    """The bucket of each band of each text."""
    salts = mix(np.arange(1, BANDS + 1).astype(np.uint64) * C0)
    bands = np.broadcast_to(salts, (len(kept), BANDS)).copy()
    for k in range(ROWS):
        bands = mix(bands * C3 + kept.reshape(-1, BANDS, ROWS)[:, :, k])
    return bands


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, key (digest of the normal form), the buckets of all bands and one byte of each slot of distinct shingles."""
    kind = dict(docs.dtypes)["doc_id"]

    def task(batches):
        for batch, texts in text_batches(batches, "norm", 2 << 20):
            hashes, text, counts = shingles(texts)
            n = len(texts)
            kept = prob_min_hash(hashes, text, np.ones(len(text)), n)
            bands = np.tile(band_buckets(kept), 2)
            # Only texts that repeat a shingle have a weighted sketch of their own.
            repeats = np.bincount(text, counts > 1, n) > 0
            own = repeats[text]
            place = np.cumsum(repeats) - 1
            bands[repeats, BANDS:] = band_buckets(prob_min_hash(hashes[own], place[text[own]], counts[own], int(repeats.sum())))
            new = np.ones(bands.shape, bool)
            new[:, BANDS:] = bands[:, BANDS:] != bands[:, :BANDS]
            new[np.bincount(text, minlength=n) == 0] = False
            ends = np.append(0, np.cumsum(new.sum(1))).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "key": batch.column(1),
                "buckets": pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[new].view(np.int64))),
                "slots": pa.array([row.tobytes() for row in (kept & np.uint64(255)).astype(np.uint8)], pa.binary()),
            })

    rows = docs.select("doc_id", normal_form().alias("norm")).select("doc_id", F.md5("norm").alias("key"), "norm")
    return rows.mapInArrow(task, f"doc_id {kind}, key string, buckets array<long>, slots binary")


def texts_of(docs: DataFrame, keys: DataFrame, rows: int) -> DataFrame:
    """``node`` and the normal form of its text, for the nodes in ``keys`` (node, key)."""
    norm = docs.select(normal_form().alias("norm"))
    found = norm.withColumn("key", F.md5("norm")).join(broadcast_if_small(keys, rows), "key")
    return found.groupBy("node").agg(F.first("norm").alias("norm"))  # one copy of a text leaves each task


def beside(pairs: DataFrame, values: DataFrame, side: str) -> DataFrame:
    """The written ``pairs`` (a, b) with the value of their node on ``side``, from ``values`` (node, value).

    A node of more than ``SPLIT`` pairs has a copy of its value for each ``SPLIT`` of them, in different tasks.
    """
    value = values.columns[1]
    named = values.withColumnsRenamed({"node": side, value: f"{value}_{side}"})
    hot = pairs.groupBy(side).agg((F.count(F.lit(1)) / SPLIT).cast("int").alias("last")).where("last > 0")
    n_hot = hot.count()
    if not n_hot:
        return pairs.join(named, side)
    hot = broadcast_if_small(hot, n_hot)
    last = F.coalesce("last", F.lit(0))
    spread = pairs.join(hot, side, "left").withColumn("salt", F.pmod(F.xxhash64("b" if side == "a" else "a"), last + 1).cast("int"))
    copies = named.join(hot, side, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), last)))
    return spread.drop("last").join(copies.drop("last"), [side, "salt"]).drop("salt")


def estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The written ``pairs`` (a, b) of nodes whose slots of distinct shingles agree well enough to be compared, with the ``share`` that agrees."""
    slots = nodes.select("node", "slots")
    near = beside(pairs, slots, "a").select("a", "b", "slots_a")
    near = near.join(slots.withColumnsRenamed({"node": "b", "slots": "slots_b"}), "b")

    def task(batches):
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SLOTS) for i in (2, 3))
                share = (left == right).mean(1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(share)], names=["a", "b", "share"]).filter(pa.array(share >= ESTIMATE))

    return near.select("a", "b", "slots_a", "slots_b").mapInArrow(task, "a long, b long, share double")


def verified(near: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes in ``near``, a written table, whose ``texts`` (node, norm) reach the similarity."""
    if near.isEmpty():
        return near
    both = beside(near, texts, "a").join(texts.withColumnsRenamed({"node": "b", "norm": "norm_b"}), "b")

    def compared(batches):
        for batch, left in text_batches(batches, "norm_a", 1 << 20):
            right = pc.fill_null(batch.column(3).cast(pa.large_string()), "")
            n = len(left)
            ha, ta, _ = shingles(left)
            hb, tb, _ = shingles(right)
            h, t = np.concatenate([ha, hb]), np.concatenate([ta, tb])
            order = np.lexsort((h, t))
            h, t = h[order], t[order]
            both = np.bincount(t[1:][(h[1:] == h[:-1]) & (t[1:] == t[:-1])], minlength=n)
            all_ = np.bincount(t, minlength=n) - both
            good = both >= SIMILARITY * all_ - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good & (all_ > 0)))

    return written(both.select("a", "b", "norm_a", "norm_b").mapInArrow(compared, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every linked node; the label is the least node of its component.

    Alternating stars: every node passes its least neighbour on, first to larger neighbours, then to smaller
    ones, until all components are stars. Each round is written, and what it was made of deleted; a node with very many links is combined
    per task, and least neighbours of few nodes are broadcast. The result is read from the table ``written_to``.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, nodes, rows, knots = least_neighbours(both)
        if not knots:
            break
        # Repeated edges do no harm here: the second step drops them.
        passed = written(with_least(both, least, nodes, rows).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "star")
        for done in (edges, least):
            discard(done)
        least, nodes, rows, _ = least_neighbours(passed)
        joined = with_least(passed, least, nodes, rows).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(joined.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "edges")
        for done in (passed, least):
            discard(done)
    discard(least)
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    labels.written_to = edges.written_to
    return labels


def least_neighbours(edges: DataFrame) -> tuple[DataFrame, int, int, int]:
    """For each node u of ``edges`` (u, v), written: m, its least neighbour or itself, and n, its edges; the number of nodes, of
    edges, and of nodes with several edges of which one leads to a lesser node.

    Where ``edges`` holds each edge once in either direction, all components are stars when there is no such node.
    """
    least = written(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
    nodes, rows, knots = least.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.count_if((F.col("m") < F.col("u")) & (F.col("n") > 1))).first()
    return least, nodes, rows, knots


def with_least(edges: DataFrame, least: DataFrame, nodes: int, rows: int) -> DataFrame:
    """``edges`` (u, v) with the m of their u, from ``least`` of so many ``nodes`` and edges."""
    if nodes <= BROADCAST_ROWS:
        return edges.join(F.broadcast(least.select("u", "m")), "u")
    return join_hot(edges, least, ["u"], "n", rows, how="inner")


def joined_labels(labels: DataFrame, more: DataFrame) -> DataFrame:
    """The written ``labels`` of ``components`` after the links ``more``: a label stands for all links that gave it. Deletes the old ones."""
    merged = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more.select("a", "b")))
    discard(labels)
    return merged


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def pivot_pairs(rest: DataFrame, near: DataFrame, nodes: DataFrame, turn: int) -> DataFrame:
    """Each node in ``rest`` (see ``apart``) as b with the pivot most like it of another label as a; pairs in ``near`` are done.

    A bucket's pivot is its least member by a hash of bucket, node and ``turn``. All pivots that a node meets are
    estimated on the slots, one is compared.
    """
    met = rest.where((F.col("turn") == turn) & (F.col("label") != F.col("pivot.label")))
    pairs = met.select(F.col("pivot.node").alias("a"), F.col("node").alias("b")).distinct()
    done = near.union(near.select("b", "a"))
    asked = written(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
    likely = estimated(asked, nodes)
    tried = written(likely.groupBy("b").agg(F.max(F.struct("share", "a")).alias("best")).select("best.a", "b"), "tried")
    discard(asked)
    return tried


def apart(shared: DataFrame, labels: DataFrame, turn: int) -> tuple[DataFrame, int, float]:
    """What is left of the buckets ``shared`` (bucket, node) when linked nodes have ``labels``.

    Returns the members (bucket, node, label, n, pivot, turn) of buckets that hold several labels, n being their number and pivot
    (node, label) the bucket's pivot of ``turn``, the number of these buckets and of their pairs of members of different labels.
    The members are written once, and carry the pivots with them: no later step joins by bucket again.
    """
    labelled = shared.join(broadcast_if_small(labels, labels.count()), "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    labelled = written(labelled, "labelled")
    place = F.struct(F.xxhash64("bucket", "node", F.lit(turn)).alias("place"), "node", "label")
    sizes = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k"), F.min(place).alias("first"))
    mixed = sizes.groupBy("bucket").agg(
        F.sum("k").alias("n"), F.sum(F.col("k").cast("double") * F.col("k")).alias("own"), F.count(F.lit(1)).alias("labels"), F.min("first").alias("pivot"))
    pairs = (F.col("n").cast("double") * F.col("n") - F.col("own")) / 2
    mixed = written(mixed.where("labels > 1").select("bucket", "n", F.struct("pivot.node", "pivot.label").alias("pivot"), pairs.alias("pairs")), "mixed")
    n_mixed, pairs = mixed.agg(F.count(F.lit(1)), F.coalesce(F.sum("pairs"), F.lit(0.0))).first()
    held = mixed.select("bucket", "n", "pivot")
    # A row here is twice as wide as the narrow rows that may be broadcast.
    if 2 * n_mixed <= BROADCAST_ROWS:
        members = labelled.join(F.broadcast(held), "bucket")
    else:
        members = join_hot(labelled, held, ["bucket"], "n", labelled.count(), how="inner")
    rest = written(members.select("bucket", "node", "label", "n", "pivot", F.lit(turn).alias("turn")), "rest")
    discard(labelled)
    discard(mixed)
    return rest, n_mixed, pairs


def prefix_pairs(docs: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs (a, b) of nodes in ``members`` (node, key, label) that can reach the similarity, across labels."""
    return pairs_of_texts(texts_of(docs, members.select("node", "key"), members.count()), members)


def pairs_of_texts(texts: DataFrame, members: DataFrame) -> DataFrame:
    """``prefix_pairs`` for nodes whose ``texts`` (node, norm) are at hand.

    Shingles are ordered from rare to common. Two sets of similarity s share one among the first
    n - ceil(s * n) + 1 shingles of either, n being its size, so only those are joined, and only where
    the sets are long enough after them.
    """
    rows = members.count()
    texts = texts.join(broadcast_if_small(members.select("node"), rows), "node", "left_semi")

    def task(batches):
        for batch, norm in text_batches(batches, "norm", 1 << 20):
            hashes, text, _ = shingles(norm)
            size = np.bincount(text, minlength=len(norm))
            yield pa.RecordBatch.from_pydict({"node": batch.column(0).take(pa.array(text)), "shingle": pa.array(hashes.view(np.int64)), "size": pa.array(size[text])})

    sets = written(texts.select("node", "norm").mapInArrow(task, "node long, shingle long, size long"), "sets")
    common = sets.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")  # who is alone finds nobody
    common = written(common, "common")
    ranked = join_hot(sets, common, ["shingle"], "n", max(1, rows))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.coalesce("n", F.lit(1)), "shingle"))
    need = F.ceil(F.col("size") * SIMILARITY - 1e-9)
    prefix = ranked.withColumn("place", place).where(F.col("n").isNotNull() & (F.col("place") <= F.col("size") - need + 1))
    prefix = written(prefix.join(members.select("node", "label"), "node").select("shingle", "node", "label", "size", "place"), "prefix")
    discard(sets)
    discard(common)
    # The smaller set of a pair shares at least 2s / (1 + s) of its size, so its prefix is shorter still.
    least = F.ceil(F.col("size") * (2 * SIMILARITY / (1 + SIMILARITY)) - 1e-9)
    small, large = ({c: f"{c}_{x}" for c in ("node", "label", "size", "place")} for x in "ab")
    left, right = prefix.where(F.col("place") <= F.col("size") - least + 1).withColumnsRenamed(small), prefix.withColumnsRenamed(large)
    ordered = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("node_a") < F.col("node_b")))
    fits = F.col("size_a") >= F.col("size_b") * SIMILARITY - 1e-9
    # What both can still share from their first common shingle on must reach the overlap that the similarity asks for.
    rest = F.least(F.col("size_a") - F.col("place_a") + 1, F.col("size_b") - F.col("place_b") + 1)
    enough = rest >= (F.col("size_a") + F.col("size_b")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9
    found = left.join(right, "shingle").where(ordered & fits & enough & (F.col("label_a") != F.col("label_b")))
    return found.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, ``key`` (digest of its normal form) and the label of its class."""
    rows = written(sketches(docs).withColumn("row", F.monotonically_increasing_id()), "sketches")
    # Copies share a key: one node per different text.
    nodes = written(rows.groupBy("key").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("buckets").alias("buckets"), F.first("slots").alias("slots")), "nodes")
    members = nodes.select(F.explode("buckets").alias("bucket"), "node")
    heads = members.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    heads = written(heads, "heads")
    n_members = nodes.select(F.sum(F.size("buckets"))).first()[0] or 0
    shared = written(join_hot(members, heads, ["bucket"], "n", n_members, how="inner"), "buckets")
    n_shared = shared.count()
    asked = written(shared.select("node").distinct().join(nodes.select("node", "key"), "node"), "asked")
    texts = written(texts_of(docs, asked, asked.count()), "texts")
    # A node of a large class meets another head in almost every bucket: two of them are enough to join most classes.
    tops = shared.where("node != head").groupBy("node").agg(F.min("head").alias("low"), F.max("head").alias("high"))
    pairs = written(tops.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("a"), F.col("node").alias("b")), "pairs")
    near = written(estimated(pairs, nodes).select("a", "b"), "near")
    discard(pairs)
    links = verified(near, texts)
    labels = components(links)
    rest, n_mixed, left = apart(shared, labels, 0)
    for done in (heads, shared, asked):
        discard(done)
    release(docs.sparkSession)
    # Many pairs apart are often of few classes: pivots join these, as long as they do.
    for turn in range(TURNS):
        if left <= DENSE * n_shared:
            break
        tried = pivot_pairs(rest, near, nodes, turn)
        more = verified(tried, texts)
        near = near.union(ordered(tried))
        if more.isEmpty():
            break
        labels = joined_labels(labels, more)
        # Labels only merge: buckets of one label stay so, and only members of the others are looked at again.
        before, held = left, rest
        rest, n_mixed, left = apart(held.select("bucket", "node"), labels, turn + 1)
        discard(held)
        release(docs.sparkSession)
        if left > 0.9 * before:
            break
    # What is left: all pairs of small buckets, the prefix filter for large ones.
    if n_mixed:
        # A small bucket's members are few, and the same few often share several buckets: each set of them is listed once.
        few = rest.where(f"n <= {LISTED}").groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("node", "label"))).alias("held")).select("held").distinct()
        few = few.select("held", F.explode("held").alias("x")).select("x", F.explode(F.filter("held", lambda y: (F.col("x.node") < y["node"]) & (F.col("x.label") != y["label"]))).alias("y"))
        pairs = few.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        many = written(rest.where(f"n > {LISTED}").select("node", "label").distinct(), "many")
        if not many.isEmpty():
            pairs = pairs.union(pairs_of_texts(texts, many))
        pairs = written(pairs.distinct().join(near, ["a", "b"], "left_anti"), "pairs")
        likely = written(estimated(pairs, nodes).select("a", "b"), "near")
        more = verified(likely, texts)
        if not more.isEmpty():
            labels = joined_labels(labels, more)
        for done in (many, pairs, likely):
            discard(done)
    discard(rest)
    discard(texts)
    keys = written(nodes.select("key", "node").join(labels, "node", "left").select("key", F.coalesce("label", "node").alias("label")), "labels")
    named = rows.select("doc_id", "key").join(broadcast_if_small(keys, keys.count()), "key")
    named = written(named, "named")
    for done in (nodes, labels, keys, rows):
        discard(done)
    release(docs.sparkSession)
    classes = written(named.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "classes")
    out = join_hot(named, classes, ["label"], "class_size", named.count(), how="inner")
    return out.select("doc_id", "class_id", "class_size", "key", "label")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns: of each class the one with the smallest id (any one if ids repeat)."""
    classes = written(near_classes(docs), "near")
    keep = classes.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy(F.col("class_id").alias("__id"), "label").agg(F.min("key").alias("__key"), F.count(F.lit(1)).alias("n"))
    keep = written(keep, "keep")
    packed = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__id"), F.md5(normal_form()).alias("__key"))

    def same(left: DataFrame, right: DataFrame) -> list[Column]:
        return [left["__id"].eqNullSafe(right["__id"]), left["__key"] == right["__key"]]

    seen = classes.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
    drop = written(seen.join(keep, same(seen, keep), "left_anti"), "drop")
    discard(classes)
    few = broadcast_if_small(drop, drop.count())
    rest = packed.join(few, same(packed, few), "left_anti")
    if keep.where("n > 1").isEmpty():
        return rest.select("__row.*")
    return rest.dropDuplicates(["__id", "__key"]).select("__row.*")
