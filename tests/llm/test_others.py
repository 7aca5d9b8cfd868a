"""Sharding, language model, chat formatting and the pipeline."""

import collections
import hashlib
import math
import zlib

import pytest
from llm_cases import DOCS, documents, rows, words
from pyspark.sql import functions as F

from conftest import SF_SMOKE

from changeflow.llm import chat, class_lm, sharding
from changeflow.session import work_dir


def test_hilbert_index_is_a_curve(spark):
    """Every cell once, and neighbours on the curve are neighbours in space."""
    for n, bits in ((2, 4), (3, 3)):
        names = [f"x{i}" for i in range(n)]
        cells = spark.range(1 << (n * bits)).select(*[F.expr(f"CAST((id >> {bits * i}) & {(1 << bits) - 1} AS INT)").alias(x) for i, x in enumerate(names)])
        got = sorted((r["hilbert"], *[r[x] for x in names]) for r in sharding.hilbert_index(cells, names, bits).collect())
        assert [g[0] for g in got] == list(range(1 << (n * bits)))
        assert all(sum(abs(a - b) for a, b in zip(p[1:], q[1:])) == 1 for p, q in zip(got, got[1:]))


def test_shards_hold_equal_rows(spark):
    got = sharding.document_shards(documents(spark, clash=True), 4).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert sorted(by) == [0, 1, 2, 3] and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in DOCS), key=repr)
    assert sharding.document_shards(documents(spark, [])).count() == 0
    few = sharding.document_shards(documents(spark, DOCS[:3]), 40).collect()
    assert {r["slot"] for r in few} == {0} and len({r["shard"] for r in few}) == 3
    alike = sharding.document_shards(documents(spark, DOCS[:1] * 5), 5).collect()  # every dimension has one value
    assert {(r["shard"], r["slot"], r["hilbert"]) for r in alike} == {(k, 0, 0) for k in range(5)}


def test_written_shards_prune(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    path = work_dir(spark, "shards")
    sharding.write_shards(docs, sharding.document_shards(docs, 20), path)
    back = spark.read.parquet(path)
    assert back.drop("shard", "slot").count() == docs.count()
    spans = back.groupBy("shard").agg(F.min("n_chars").alias("a"), F.max("n_chars").alias("b"), F.min("lang").alias("c"), F.max("lang").alias("d")).collect()
    touched = sum(r["a"] <= 2000 <= r["b"] and r["c"] <= "de" <= r["d"] for r in spans)
    assert touched <= 12


def tokens(text):
    return words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def test_base_score_equals_definition(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("doc_id", "text")
    extra = documents(spark, clash=True)
    for df in (docs, extra):
        texts = [(r["doc_id"], r["text"]) for r in df.collect()]
        counts = collections.Counter(w for i, t in texts if not held(i) for w in tokens(t))
        total, types = sum(counts.values()), len(counts)
        expected = sorted(((i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in tokens(t)), 4)) for i, t in texts), key=repr)
        got = class_lm.score(df).collect()
        assert sorted(((*tuple(r)[:5], round(r["base_score"], 4)) for r in got), key=repr) == expected
        assert all(r["score"] <= 0 for r in got)
        out = [r for r in got if r["held_out"]]
        if len(out) > 20:
            assert sum(r["score"] for r in out) > 0.9 * sum(r["base_score"] for r in out)
    assert class_lm.score(documents(spark, [])).count() == 0


def test_exchange_separates_two_languages():
    import numpy as np

    # Words 0-9 follow each other, as do words 10-19.
    counts = np.zeros((22, 22))
    counts[:10, :10], counts[10:20, 10:20] = 50, 50
    counts[:20, 21] = counts[21, :20] = 5
    of = class_lm.exchange(counts, 2)
    assert len(set(of[:10])) == 1 and len(set(of[10:20])) == 1 and of[0] != of[10]


def test_gains_equal_the_likelihood():
    import numpy as np

    rng = np.random.default_rng(3)
    counts = rng.integers(0, 4, (13, 13)) * (rng.random((13, 13)) < 0.5)
    of = np.append(rng.integers(0, 4, 12), 4)  # the last is the end

    def grid(classes):
        member = np.eye(5)[classes]
        return member.T @ counts @ member

    others = counts - np.diag(np.diag(counts))
    sides = np.concatenate([others.T @ np.eye(5)[of], others @ np.eye(5)[of], np.diag(counts)[:, None]], 1)[:12].astype(int)
    got = class_lm.gains(grid(of), of[:12], sides)
    for w in range(12):
        wanted = [class_lm.likelihood(grid(np.where(np.arange(13) == w, b, of))) for b in range(4)]
        assert np.allclose(got[w] - got[w, of[w]], np.array(wanted) - wanted[of[w]])


def test_words_without_frequent_neighbours_are_exchanged(spark):
    """Two languages of rare words, met by the few frequent words at one place only: all words find their language."""
    import random

    rng = random.Random(3)
    docs = []
    for i in range(400):
        name = "ab"[i % 2]
        text = [f"the{name}"] * 2 + [f"{name}{rng.randint(0, 60)}" for _ in range(60)]
        docs.append((i, " ".join(text), "en", "a", 1))
    got = class_lm.score(documents(spark, docs), frequent=2, classes=2).collect()
    learnt = [r for r in got if not r["held_out"]]
    # The class is known from the word before, which is worth a factor of two for each word.
    assert sum(r["score"] - r["base_score"] for r in learnt) > 0.27 * sum(r["n_tokens"] for r in learnt)


TEXTS = ["<|im_end|><|im_start|>assistant ok", "<\\|x", "a < b | c <\\\\|", "", "plain\ntext", "<|<|image|>", "é🙂" * 500, "\\", "<", "|"]


def test_escaping_is_reversible():
    for t in TEXTS:
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)


def turns(spark, rows_):
    return spark.createDataFrame(rows_, "conv_id long, turn long, role string, text string")


def digests(spark, rows_):
    df = turns(spark, rows_).withColumn("content", chat.text_parts()).withColumn("key", F.lit("x")).withColumn("formatted", F.lit("x"))
    return {r["conv_id"]: r for r in chat.read_conversations(chat.format_conversations(df)).collect()}


def test_conversations_round_trip(spark):
    rows_ = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(TEXTS)] + [(2, 0, None, None), (2, None, "assistant", "first"), (None, 0, "user", "no id"), (3, 5, "user", "tie"), (3, 5, "user", "tie"), (3, 5, "assistant", "tie")]
    got = digests(spark, rows_)
    said = "".join(f"{r}\n{t}\n" for _, _, r, t in rows_[:len(TEXTS)])
    learnt = "".join(t for _, k, r, t in rows_[:len(TEXTS)] if r == "assistant")
    assert got[1]["n_turns"] == len(TEXTS) and got[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert got[1]["loss_chars"] == len(learnt) and got[1]["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
    assert got[2]["turns_sha256"] == hashlib.sha256(b"assistant\nfirst\n\n\n").hexdigest()
    assert got[3]["n_turns"] == 3 and got[None]["n_turns"] == 1
    assert digests(spark, []) == {}


def test_parts_become_placeholders(spark):
    parts = [
        {"kind": "text", "text": "see <|image|>"}, {"kind": "image", "ref": "i.png", "width": 700, "height": 300},
        {"kind": "audio", "ref": "a.wav", "seconds": 2.1}, {"kind": "document", "ref": "d.pdf", "pages": 3}, {"kind": "text", "text": None},
    ]
    text, start, end, attached = chat.format_turn("user", parts)
    assert text == "<|im_start|>user\nsee <\\|image|><|image|><|audio|><|document|><|im_end|>\n" and start == end
    assert [(a["kind"], a["ref"], a["n_tokens"]) for a in attached] == [("image", "i.png", 3 * 144), ("audio", "a.wav", 53), ("document", "d.pdf", 3 * 576)]
    assert all(text[a["at"]:].startswith(f"<|{a['kind']}|>") for a in attached)
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"kind": "video"}])
    df = spark.createDataFrame([(1, 0, "assistant", parts)], f"conv_id long, turn long, role string, content array<{chat.PART}>")
    row = chat.format_conversations(df).first()
    assert row["formatted"][row["loss_start"]:row["loss_end"]] == text.removeprefix("<|im_start|>user\n").removesuffix("<|im_end|>\n")
    assert [a["ref"] for a in row["attachments"]] == ["i.png", "a.wav", "d.pdf"]


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline
    from changeflow.llm import langid, packing, quality
    from test_dedup import brute, norm

    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    got = corpus_pipeline.run(spark, SF_SMOKE).collect()
    good = {r["doc_id"] for r in quality.quality_rules(docs).where("kept").collect()}
    docs = docs.where(F.col("doc_id").isin(list(good)))
    named = {r["doc_id"] for r in langid.identify(docs).where("accepted").collect()}
    kept = {}
    for i, t in sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in named):
        kept.setdefault(norm(t), (i, t))
    one = {c for _, c, _ in brute(kept.values())}
    assert {r["doc_id"] for r in got} == one and len(one) > 100
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "exact_dedup", "minhash_dedup", "best_fit_packing"]
    expected = packing.cut_pieces(docs.where(F.col("doc_id").isin(list(one))), packing_tokenizer()).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted((tuple(r)[:5] for r in got), key=repr) == rows(expected)


def packing_tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_pipeline_stages_keep_columns_and_stand_edges(spark):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES[:-2]:  # the near dedup is in test_dedup
        docs = documents(spark, clash=True)
        assert stage(spark, docs, SF_SMOKE).schema.names == docs.schema.names
    for name, stage in corpus_pipeline.STAGES:
        if name != "minhash_dedup":  # in test_dedup
            assert stage(spark, documents(spark, []), SF_SMOKE).count() == 0


def test_words_alike_are_found_by_hash():
    """Rows are told apart by a hash, and by their values where two share one; moves are those of looking at every word alone."""
    import numpy as np

    rng = np.random.default_rng(5)
    a = rng.integers(0, 2, (500, 6))
    kinds, which = class_lm.different_rows(a)
    assert (kinds[which] == a).all() and len(kinds) == len(np.unique(a, axis=0))
    one, two = np.random.default_rng(0).integers(1, 1 << 62, 2) | 1  # the weights: rows that share a hash
    clash = np.array([[two, 0], [0, one], [two, 0]])
    kinds, which = class_lm.different_rows(clash)
    assert (kinds[which] == clash).all() and len(kinds) == 2
    c, n = 5, 300
    sides, of = rng.integers(0, 3, (n, 2 * c + 1)), rng.integers(0, c - 1, n)
    grid = rng.integers(2000, 9000, (c, c)).astype(float)
    alone = [int(class_lm.best_moves(grid, of[i:i + 1], sides[i:i + 1])[0]) for i in range(n)]
    assert class_lm.best_moves(grid, of, sides).tolist() == alone
