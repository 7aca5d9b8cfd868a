import collections
import os
import random
import re

import numpy as np
import pytest
from llm_cases import DOCS, LONG, PROSE, documents, rows, words
from pyspark.sql import functions as F

from conftest import SF_CHECK

from changeflow.llm import exact_dedup, near_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    """A weak key puts many texts into one chain; the byte comparison tells them apart."""
    key = (lambda c: F.length(c).cast("long") % 3) if weak else exact_dedup.key_of
    got = exact_dedup.exact_groups(documents(spark, clash=True), key, capacity=2).collect()
    groups = collections.defaultdict(list)
    for i, t, *_ in DOCS:
        groups[norm(t)].append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    import hashlib

    expected = sorted(((i, least[norm(t)], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t, *_ in DOCS), key=repr)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == expected
    assert sum(r["kept"] for r in got) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_directory_doubles_until_buckets_fit():
    rng = random.Random(1)
    counts = {p: rng.randint(0, 9) for p in range(64)} | {5: 500}
    buckets = exact_dedup.grow_directory(counts, 6, 20)
    slots = []
    for prefix, local in buckets:
        own = range(prefix << (6 - local), (prefix + 1) << (6 - local))
        slots += own
        assert local == 6 or sum(counts[s] for s in own) <= 20
        if local:  # its parent was overfull
            up = prefix >> 1
            assert sum(counts[s] for s in range(up << (7 - local), (up + 1) << (7 - local))) > 20
    assert sorted(slots) == list(range(64))


def test_directory_has_a_slot_for_every_prefix():
    buckets = exact_dedup.grow_directory({3: 50}, 4, 20)
    assert sorted(s for p, d in buckets for s in range(p << (4 - d), (p + 1) << (4 - d))) == list(range(16))


def test_directory_routes_the_search(spark):
    """Copies are found through the directory: where an entry leads to another bucket, those of its keys are not."""
    from pyspark.sql import functions as F

    texts = [(i, f"text {i // 2}", "en", "a", 1) for i in range(400)]
    norm = documents(spark, texts).select("doc_id", exact_dedup.normalised().alias("__norm"))
    entries = norm.select("doc_id", exact_dedup.key_of("__norm").alias("key"), F.sha2("__norm", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row"))
    index, directory, rows = exact_dedup.build_index(entries, capacity=16)
    assert directory.count() > 16 and index.count() == rows == 400
    good = exact_dedup.chain_groups(norm, exact_dedup.key_of, index, directory, rows)
    assert good.where("group_size = 2").count() == 400 and good.where("kept").count() == 200
    first = index.agg(F.min("bucket")).first()[0]
    lost = index.where(F.col("bucket") == first).count()
    bad = directory.withColumn("bucket", F.when(F.col("bucket") == first, F.lit(-1)).otherwise(F.col("bucket")))
    got = exact_dedup.chain_groups(norm, exact_dedup.key_of, index, bad, rows)
    assert got.count() == 400 and got.where("group_size = 2").count() == 400 - lost < 400


def test_overfull_bucket_is_cut_into_parts(spark):
    from pyspark.sql import functions as F

    entries = documents(spark, [(i, "hot" if i % 2 else f"t{i}", "en", "a", 1) for i in range(2000)])
    entries = entries.select("doc_id", exact_dedup.key_of("text").alias("key"), F.lit("").alias("text_sha256"), F.col("doc_id").alias("row"))
    index, _, _ = exact_dedup.build_index(entries, capacity=64)
    per = {r["parts"]: r["most"] for r in index.groupBy("bucket", "key", "part", "parts").count().groupBy("parts").agg(F.max("count").alias("most")).collect()}
    assert per[1] == 1 and max(per) > 10 and per[max(per)] < 200


def test_keep_first(spark):
    docs = documents(spark, clash=True)
    kept = exact_dedup.keep_first(docs, capacity=2)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(got) == len({norm(t) for _, t, *_ in DOCS}) == len({norm(t) for _, t in got})
    assert (1, PROSE) in got and not any(i == 17 for i, _ in got)
    assert sum(i is None for i, _ in got) == 1
    assert exact_dedup.keep_first(documents(spark, [])).count() == 0


def test_hot_key_is_not_shuffled_to_one_task(spark):
    texts = [(i, "hot text" if i % 3 == 0 else f"text {i}", "en", "a", 1) for i in range(6000)]
    got = exact_dedup.exact_groups(documents(spark, texts), capacity=64)
    assert got.where("group_size = 2000 AND keep_id = 0").count() == 2000 and got.where("kept").count() == 4001


def brute(docs, threshold=0.8):
    nodes = {}
    for i, t in docs:
        nodes.setdefault(" ".join(words((t or "").lower())), []).append(i)
    sets, where = [], collections.defaultdict(list)
    for n, key in enumerate(nodes):
        w = key.split(" ") if key else []
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
        for s in sets[-1]:
            where[s].append(n)
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, s in enumerate(sets):
        for m, both in collections.Counter(m for x in s for m in where[x] if m > n).items():
            if both >= threshold * (len(s) + len(sets[m]) - both) - 1e-9:
                up[max(root(n), root(m))] = min(root(n), root(m))
    classes = collections.defaultdict(list)
    for n, ids in enumerate(nodes.values()):
        classes[root(n)] += ids
    return sorted(((i, min((x for x in ids if x is not None), default=None), len(ids)) for ids in classes.values() for i in ids), key=repr)


def near_rows(df):
    return rows(df.select("doc_id", "class_id", "class_size"))


def test_near_classes_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert near_rows(near_dedup.near_classes(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_near_edges(spark):
    docs = documents(spark, clash=True)
    assert near_rows(near_dedup.near_classes(docs)) == brute([(i, t) for i, t, *_ in DOCS])
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({(c, s) for _, c, s in brute([(i, t) for i, t, *_ in DOCS])})
    assert near_dedup.keep_one(documents(spark, [])).count() == 0


def variants(n, edits, size=60, seed=2):
    """``n`` copies of one text, each with its own words changed."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
    out = []
    for i in range(n):
        text = list(base)
        for k in rng.sample(range(size), edits):
            text[k] = f"x{i}y{k}"
        out.append(" ".join(text))
    return out


def test_large_classes_and_shared_passages(spark, monkeypatch):
    """Many near copies, close to the threshold, and texts that only share a passage: links equal brute force."""
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = variants(80, 1) + variants(60, 0, seed=9)[:3] + variants(40, 2, size=120, seed=5)
    texts += [passage + " " + " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(rng.randint(8, 40))) for _ in range(120)]
    docs = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    expected = brute([(i, t) for i, t, *_ in docs])
    assert near_rows(near_dedup.near_classes(documents(spark, docs))) == expected
    monkeypatch.setattr(near_dedup, "LISTED", 2)  # every mixed bucket goes through the prefix filter
    assert near_rows(near_dedup.near_classes(documents(spark, docs))) == expected


def test_pivot_rounds_and_copied_texts(spark, monkeypatch):
    """Rounds of pivots, and texts that are copied to several tasks, leave classes as brute force has them."""
    texts = variants(30, 2, size=90, seed=5) + variants(30, 1, seed=6) + variants(20, 4, seed=7)
    docs = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    turns = []
    pivots = near_dedup.pivot_pairs
    monkeypatch.setattr(near_dedup, "pivot_pairs", lambda *x: turns.append(x[-1]) or pivots(*x))
    monkeypatch.setattr(near_dedup, "DENSE", 0)
    monkeypatch.setattr(near_dedup, "SPLIT", 3)
    assert near_rows(near_dedup.near_classes(documents(spark, docs))) == brute([(i, t) for i, t, *_ in docs])
    assert turns


def test_intermediate_tables_are_discarded(spark, monkeypatch):
    """Rounds of pivots leave no tables behind, and each round joins by bucket once: what is left is written with its pivots."""
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(variants(30, 2, size=90, seed=5) + variants(20, 4, seed=7))])
    tables, rests = [], []
    written, apart = near_dedup.written, near_dedup.apart
    monkeypatch.setattr(near_dedup, "written", lambda *x: tables.append(written(*x)) or tables[-1])
    monkeypatch.setattr(near_dedup, "apart", lambda *x: rests.append(apart(*x)) or rests[-1])
    monkeypatch.setattr(near_dedup, "DENSE", 0)
    near_dedup.near_classes(docs)
    left = {os.path.basename(t.written_to).rpartition("-")[0] for t in tables if os.path.exists(t.written_to)}
    assert left <= {"links", "near", "tried", "prefix", "named", "classes"}  # what the result and pairs yet to be compared read
    assert len(rests) > 1 and all("pivot" in r.columns and hasattr(r, "written_to") for r, *_ in rests)


def test_repeated_passages_do_not_hide_links(spark):
    """A text, and the same with an inner passage repeated: almost the same distinct shingles, other weights."""
    texts = []
    for k, (size, times) in enumerate([(10, 100), (10, 200), (12, 400), (40, 20), (40, 100), (25, 60)]):
        for j in range(4):
            base = [f"t{k}x{j}w{i}" for i in range(400)]
            texts += [" ".join(base), " ".join(base[:100] + base[100:100 + size] * times + base[100 + size:])]
    docs = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    expected = brute([(i, t) for i, t, *_ in docs])
    assert {n for _, _, n in expected} == {2}
    assert near_rows(near_dedup.near_classes(documents(spark, docs))) == expected


def test_prefix_filter_finds_all_pairs(spark):
    texts = variants(30, 1, size=100, seed=7) + variants(30, 3, size=100, seed=8)
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    members = docs.select(F.col("doc_id").alias("node"), F.md5(near_dedup.normal_form()).alias("key"), F.col("doc_id").alias("label"))
    got = {tuple(r) for r in near_dedup.prefix_pairs(docs, members).collect()}
    sets = [{tuple(t.split()[i:i + 5]) for i in range(96)} for t in texts]
    wanted = {(a, b) for a in range(60) for b in range(a + 1, 60) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert wanted <= got and wanted


def test_slots_estimate_probability_jaccard():
    """The share of equal slots is the probability Jaccard similarity of weighted sets."""
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 60).astype(np.uint64)
    a, b = rng.integers(1, 5, 60), rng.integers(1, 5, 60)
    a[:10], b[-10:] = 0, 0
    exact = sum(1 / np.maximum(a / a[d], b / b[d]).sum() for d in range(60) if a[d] and b[d])
    equal = []
    for k in range(300):
        keys = near_dedup.mix(h + np.uint64(k))
        x = near_dedup.prob_min_hash(keys[a > 0], np.zeros((a > 0).sum(), int), a[a > 0], 1)
        y = near_dedup.prob_min_hash(keys[b > 0], np.zeros((b > 0).sum(), int), b[b > 0], 1)
        equal.append((x == y).mean())
    assert abs(np.mean(equal) - exact) < 0.01


def test_components(spark):
    rng = random.Random(6)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 600)]
    pairs = [p for p in pairs if p[0] != p[1]]
    up = {x: x for p in pairs for x in p}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        up[max(root(a), root(b))] = min(root(a), root(b))
    got = dict(tuple(r) for r in near_dedup.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert {x: got.get(x, x) for x in up} == {x: root(x) for x in up}


def test_long_text_is_read_whole():
    import pyarrow as pa

    a, _, _ = near_dedup.shingles(pa.array([LONG, LONG + " tail"], pa.large_string()))
    assert len(a) > 2 * 20_000


def test_components_shuffle_little(spark):
    """A round of stars deals its edges out twice, whether the components are stars is read off what it wrote, and labels stand for earlier links."""
    conf = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 9)] + [(20, 21), (21, 22)], "a long, b long").coalesce(1)
    more = spark.createDataFrame([(22, 9), (30, 31)], "a long, b long")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("components", "components")
        labels = near_dedup.components(links)
        tracker = spark.sparkContext.statusTracker()
        stages = {s for job in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(job).stageIds}
        tasks = sum(info.numCompletedTasks for info in map(tracker.getStageInfo, stages) if info)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in was.items():
            spark.conf.set(k, v)
    assert dict(tuple(r) for r in labels.collect()) == {i: 1 for i in range(2, 10)} | {21: 20, 22: 20}
    assert tasks < 600, tasks
    merged = near_dedup.joined_labels(labels, more)
    assert dict(tuple(r) for r in merged.collect()) == {i: 1 for i in [*range(2, 10), 20, 21, 22]} | {31: 30}
