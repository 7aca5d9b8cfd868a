"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's features are the byte n-grams (2 to 4) of its words, with a mark at word
edges, hashed into a fixed number of buckets. The mean of their embeddings goes
through a linear softmax; both are trained together by stochastic gradient descent
in numpy. A temperature fitted on labelled documents that were not trained on
calibrates the score. Two statistics reject a text, each against a bound taken from
the documents held back: the score, and the share of the text's byte trigrams that
training has met. The score alone cannot: a softmax is as sure of a foreign text as
of a known one. Texts that mix two learnt languages are held back too, as such a
text is to be kept. Counting and prediction run in Spark tasks over whole texts;
only the counts of a bounded sample of labelled documents reach the driver.

Defined results: a text that is null or has no letter is ``und`` with score 0 and
is not accepted. Ties go to the alphabetically first language. Without labelled
rows outside the held-out quarter there is nothing to learn: every text is ``und``
with score 0, and accepted if it has a letter, so that a stage before others does
not empty the corpus. With fewer than five sampled documents none is held back, and
nothing with a letter is rejected. Repeated rows are predicted
row by row; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .wordcodes import raw, text_batches

BUCKETS = 1 << 14
GRAMS = (2, 3, 4)
UNKNOWN = "und"

#: Labelled documents that the classifier is fitted on, at most: of each language, and in all. Two of a language are
#: needed, so that SAMPLE / 2 languages, the most frequent, can be learnt.
SAMPLE_PER_LANGUAGE = 400
SAMPLE = 4000

#: Both bounds of rejection start at this quantile of what documents held back show. A text is foreign when training has
#: met less than FOREIGN of the share of its trigrams that it has met at that quantile.
REJECTED = 0.001
FOREIGN = 0.5

#: Bytes as the features see them: letters in lower case, everything else one separator.
FOLD = np.full(256, 32, np.uint8)
FOLD[65:91] = FOLD[97:123] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def folded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The folded bytes of all texts, where they separate, and the text of each."""
    data, offsets = raw(texts)
    n = len(texts)
    # A separator before each text, then runs of separators folded to one.
    stream = np.full(len(data) + n + 1, 32, np.uint8)
    lengths = np.diff(offsets)
    stream[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), lengths)] = FOLD[data]
    owner = np.repeat(np.arange(n), lengths + 1)
    owner = np.append(owner, n - 1 if n else 0)
    gap = stream == 32
    stay = np.append(True, ~(gap[1:] & gap[:-1]))
    # The separator that ends a text belongs to it; the next text begins with its own.
    stream, owner, gap = stream[stay], owner[stay], gap[stay]
    return stream.astype(np.uint32), gap, owner


def trigrams(stream: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All byte trigrams around a byte of a word, as numbers below 2**24, and the text of each."""
    codes, gap, owner = stream
    m = max(0, len(codes) - 2)
    value = codes[:m] << np.uint32(16) | codes[1:m + 1] << np.uint32(8) | codes[2:m + 2]
    ok = ~gap[1:m + 1]
    return value[ok], owner[1:m + 1][ok]


def features(texts: pa.Array, stream=None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords and the text of each."""
    codes, gap, owner = stream or folded(texts)
    inner = ~gap
    buckets, owners = [], []
    for size in GRAMS:
        m = len(codes) - size + 1
        if m <= 0:
            continue
        value, ok = codes[:m].copy(), np.ones(m, bool)
        for k in range(1, size):
            value = value * np.uint32(0x01000193) ^ codes[k:k + m]
            if k < size - 1:
                ok &= inner[k:k + m]
        value = value[ok] * np.uint32(0x9E3779B1) + np.uint32(size)
        buckets.append((value >> np.uint32(18)).astype(np.int32))
        # An n-gram that starts at a separator belongs to the text of its second byte.
        owners.append(np.where(gap[:m], owner[1:m + 1], owner[:m])[ok])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # score of each bucket for each language: embedding times softmax layer, over temperature
    bias: np.ndarray
    reject_below: float
    met: np.ndarray = None  # the trigrams of the documents trained on
    foreign_below: float = 0.0

    def known(self, texts: pa.Array, stream=None) -> np.ndarray:
        """The share of each text's trigrams that training has met; 1 where a text has none."""
        table = np.zeros(1 << 24, bool)
        table[self.met] = True
        grams, owners = trigrams(stream or folded(texts))
        n = np.bincount(owners, minlength=len(texts))
        return np.where(n > 0, np.bincount(owners, table[grams], len(texts)) / np.maximum(1, n), 1.0)

    def judge(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The probabilities of the languages, and whether each text passes both bounds."""
        stream = folded(texts)
        p = self.probabilities(texts, stream)
        return p, (p.max(1) >= self.reject_below) & (self.known(texts, stream) >= self.foreign_below)

    def probabilities(self, texts: pa.Array, stream=None) -> np.ndarray:
        buckets, owners = features(texts, stream)
        n = np.maximum(1, np.bincount(owners, minlength=len(texts)))
        logits = np.stack([np.bincount(owners, self.weights[buckets, k], len(texts)) / n for k in range(len(self.languages))], 1) + self.bias
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def train(counts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: list[str], calibrate: np.ndarray, dim: int = 16, steps: int = 1000, rate: float = 4.0, batch: int = 16) -> Model:
    """Stochastic gradient descent over documents given as (buckets, shares); ``calibrate`` marks those held back."""
    rng = np.random.default_rng(7)
    k = len(languages)
    embedding = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, k), np.float32), np.zeros(k, np.float32)
    fit = np.flatnonzero(~calibrate)
    epochs = -(-steps // max(1, -(-len(fit) // batch)))
    total = max(1, epochs * -(-len(fit) // batch))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(fit)
        for a in range(0, len(order), batch):
            docs = order[a:a + batch]
            at = np.concatenate([counts[d][0] for d in docs])
            share = np.concatenate([counts[d][1] for d in docs])[:, None]
            owner = np.repeat(np.arange(len(docs)), [len(counts[d][0]) for d in docs])
            hidden = np.zeros((len(docs), dim), np.float32)
            np.add.at(hidden, owner, share * embedding[at])
            logits = hidden @ layer + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(docs)), labels[docs]] -= 1
            now = rate * (1 - step / total)
            back = p @ layer.T
            layer -= now * hidden.T @ p / len(docs)
            bias -= now * 0.1 * p.sum(0) / len(docs)
            np.subtract.at(embedding, at, now * share * back[owner])
            step += 1
    weights = embedding @ layer

    def logits_of(d):
        return counts[d][1] @ weights[counts[d][0]] + bias

    held = np.flatnonzero(calibrate)
    if not len(held):
        return Model(languages, weights.astype(np.float32), bias, 0.0)
    z = np.array([logits_of(d) for d in held])

    def log_p(scale):
        s = z * scale
        return s - s.max(1, keepdims=True) - np.log(np.exp(s - s.max(1, keepdims=True)).sum(1, keepdims=True))

    # The temperature of least log loss on the documents held back, from a fixed grid.
    scale = min(np.geomspace(0.1, 10, 41), key=lambda x: -log_p(x)[np.arange(len(held)), labels[held]].mean())
    # Documents, and each mixed in equal parts with others drawn from other languages: logits add up as shares of subwords do.
    drawn = [rng.permutation(len(held)) for _ in range(8)]
    mixed = [(z[i] + z[j]) / 2 for pairs in drawn for i, j in enumerate(pairs) if labels[held[i]] != labels[held[j]]]
    s = np.concatenate([z, np.array(mixed).reshape(-1, k)]) * scale
    top = 1 / np.exp(s - s.max(1, keepdims=True)).sum(1)
    return Model(languages, (weights * scale).astype(np.float32), bias * scale, float(np.quantile(top, REJECTED)))


def held_out() -> Column:
    """Documents that are never learnt from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def fit(docs: DataFrame) -> Model | None:
    """The model, from a bounded sample of labelled rows: the first of each language by hash of id, language and text; equal rows count once."""
    named = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    named = named.select("lang", "text", F.xxhash64("doc_id", "lang", "text").alias("key"))
    labelled = written(named.select("lang", "key").distinct(), "labelled")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(SAMPLE // 2).collect()}
    languages = sorted(sizes)
    if not languages:
        return None
    per_language = min(SAMPLE_PER_LANGUAGE, SAMPLE // len(languages))
    # Keys are hashes: of n, those below 4 * per_language / n of their range hold the first per_language, but for a chance
    # under 1e-9 that a few are missing. So only a few rows of a frequent language meet in the task that numbers them.
    below = docs.sparkSession.createDataFrame([(lang, float(min(1.0, (4 * per_language + 40) / n))) for lang, n in sizes.items()], "lang string, below double")
    early = labelled.join(F.broadcast(below), "lang").where((F.col("key") / float(1 << 64) + 0.5) <= F.col("below"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    chosen = written(early.withColumn("place", place).where(F.col("place") <= per_language).select("lang", "key"), "sample")
    rows = named.join(F.broadcast(chosen), ["lang", "key"]).groupBy("lang", "key").agg(F.first("text").alias("text"))  # at most SAMPLE rows

    def count(batches):
        for batch, texts in text_batches(batches, limit=1 << 20):
            stream = folded(texts)
            buckets, owners = features(texts, stream)
            order = np.argsort(owners, kind="stable")
            ends = np.searchsorted(owners[order], np.arange(len(texts) + 1))
            grams, parts = trigrams(stream)
            bounds = np.searchsorted(parts, np.arange(len(texts) + 1))
            out = {"lang": [], "key": [], "at": [], "share": [], "gram": [], "times": []}
            for i, lang, key in zip(range(len(texts)), batch.column(2).to_pylist(), batch.column(0).to_pylist()):
                at, n = np.unique(buckets[order[ends[i]:ends[i + 1]]], return_counts=True)
                if len(at):
                    out["lang"].append(lang)
                    out["key"].append(key)
                    out["at"].append(at.astype("<u2").tobytes())
                    out["share"].append((n / n.sum()).astype("<f4").tobytes())
                    gram, n = np.unique(grams[bounds[i]:bounds[i + 1]], return_counts=True)
                    out["gram"].append(gram.astype("<u4").tobytes())
                    out["times"].append(n.astype("<u4").tobytes())
            kinds = {"lang": pa.string(), "key": pa.int64()}
            yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.binary())) for c, v in out.items()})

    rows = rows.select("key", "text", "lang")
    got = sorted(tuple(r) for r in rows.mapInArrow(count, "lang string, key long, at binary, share binary, gram binary, times binary").collect())
    counts = [(np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(s, "<f4")) for _, _, a, s, _, _ in got]
    labels = np.array([languages.index(r[0]) for r in got], np.int64)
    seen = sorted(set(labels.tolist()))
    if not seen:
        return None
    labels = np.searchsorted(seen, labels)
    calibrate = np.arange(len(got)) % 5 == 4
    model = train(counts, labels, [languages[i] for i in seen], calibrate)
    return with_trigrams(model, [(np.frombuffer(g, "<u4"), np.frombuffer(n, "<u4")) for *_, g, n in got], calibrate)


def with_trigrams(model: Model, grams: list[tuple[np.ndarray, np.ndarray]], calibrate: np.ndarray) -> Model:
    """``model`` with the trigrams (value, count) of the documents trained on, and the bound from those held back."""
    model.met = np.unique(np.concatenate([g for (g, _), back in zip(grams, calibrate) if not back] or [np.zeros(0, np.uint32)]))
    shares = [n[np.isin(g, model.met)].sum() / n.sum() for (g, n), back in zip(grams, calibrate) if back and len(g)]
    model.foreign_below = FOREIGN * float(np.quantile(shares, REJECTED)) if shares else 0.0
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ``accepted`` for each whole text."""
    kind = dict(docs.dtypes)["doc_id"]

    def task(batches):
        for batch, texts in text_batches(batches, limit=1 << 20):
            lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            if model is None:
                name, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
                accepted = lettered
            else:
                p, passed = model.judge(texts)
                score = np.where(lettered, p.max(1), 0.0)
                name = np.where(lettered, np.array(model.languages, object)[p.argmax(1)], UNKNOWN)
                accepted = lettered & passed
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "held_out": batch.column(2), "lang_pred": pa.array(name, pa.string()), "score": pa.array(score, pa.float64()), "accepted": pa.array(accepted)})

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    return rows.mapInArrow(task, f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))


def keep_identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is accepted; where nothing can be learnt, all with a letter."""
    model = model or fit(docs)
    schema = docs.schema

    def task(batches):
        for batch, texts in text_batches(batches, limit=1 << 20):
            lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            good = lettered if model is None else lettered & model.judge(texts)[1]
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(task, schema)
