import numpy as np
import pyarrow as pa
from llm_cases import documents, rows

from conftest import SF_CHECK, SF_SMOKE

from changeflow.llm import langid


def test_features_equal_a_plain_version():
    def plain(text):
        folded = "".join(chr(c) if c != 32 else " " for c in langid.FOLD[np.frombuffer(text.encode(), np.uint8)].tolist())
        stream = " " + " ".join(folded.split(" ")) + " "
        while "  " in stream:
            stream = stream.replace("  ", " ")
        out = []
        for n in langid.GRAMS:
            for i in range(len(stream) - n + 1):
                g = stream[i:i + n]
                if " " not in g[1:-1] and g.strip() and (n > 2 or g.strip()):
                    out.append((n, g))
        return out

    texts = ["It is late.", "a", "  x  y ", "12 !", ""]
    buckets, owners = langid.features(pa.array(texts, pa.large_string()))
    for i, t in enumerate(texts):
        assert (owners == i).sum() == len(plain(t)), t


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = langid.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in got)
    assert right >= 0.99 * len(got) > 100
    assert all(r["accepted"] and 0 <= r["score"] <= 1 for r in got)


def test_prediction_uses_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    model = langid.fit(docs)
    a = rows(langid.predict(docs, model).select("doc_id", "lang_pred", "score"))
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert rows(langid.predict(other, model).select("doc_id", "lang_pred", "score")) == a


def test_edges(spark):
    docs = documents(spark, clash=True)
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert {got[i]["lang_pred"] for i in (4, 5, 6, 12, 13)} == {"und"} and got[4]["score"] == 0 and not got[4]["accepted"]
    assert got[7]["lang_pred"] in ("en", "de", "es", "fr")
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 0
    assert langid.identify(documents(spark, [])).count() == 0 and langid.keep_identified(documents(spark, [])).count() == 0
    unlabelled = documents(spark, [(1, "some words", None, None, 1)])
    assert langid.identify(unlabelled).first()["lang_pred"] == "und"


def test_score_bound_is_calibrated_with_mixtures():
    counts = [(np.array([i % 2, 2]), np.array([0.8, 0.2], np.float32)) for i in range(200)]
    model = langid.train(counts, np.arange(200) % 2, ["a", "b"], np.arange(200) % 5 == 4, steps=200)
    even = model.weights[[0, 1, 2]].T @ np.array([0.4, 0.4, 0.2]) + model.bias
    assert 0.5 <= model.reject_below <= 1 / (1 + np.exp(-abs(even[0] - even[1]))) + 1e-6


def test_foreign_texts_are_rejected_and_mixtures_kept(spark):
    """Letters that no learnt language writes so go; learnt languages, alone or mixed, stay."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    model = langid.fit(docs)
    rng = np.random.default_rng(3)
    foreign = [
        "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。",
        "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему.",
        " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 9))) for _ in range(200)),
    ]
    whole = {r["lang"]: r["text"] for r in docs.where("lang IS NOT NULL AND text IS NOT NULL").orderBy("doc_id").collect()}
    named = sorted(whole)
    mixed = [whole[a][:800] + "\n" + whole[b][:800] for a, b in zip(named, named[1:])]
    cases = documents(spark, [(i, t, None, None, 1) for i, t in enumerate(foreign + mixed)])
    got = {r["doc_id"]: r["accepted"] for r in langid.predict(cases, model).collect()}
    assert [got[i] for i in range(len(got))] == [False] * 3 + [True] * len(mixed)
    assert sorted(r["doc_id"] for r in langid.keep_identified(cases, model).collect()) == list(range(3, 3 + len(mixed)))


def test_predictions_equal_a_plain_version(spark):
    """Score and decision from the model's tables, one n-gram at a time."""
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet").where("length(text) < 3000")
    model = langid.fit(docs)
    met = set(model.met.tolist())
    for r, text in [(r, r["text"]) for r in langid.predict(docs, model).join(docs.select("doc_id", "text"), "doc_id").limit(20).collect()]:
        stream = b" " + b" ".join(bytes(langid.FOLD[list(text.encode())]).split()) + b" "
        logits, n, known, all_ = model.bias.astype(float).copy(), 0, 0, 0
        total = np.zeros(len(model.languages))
        for size in langid.GRAMS:
            for i in range(len(stream) - size + 1):
                g = stream[i:i + size]
                if 32 in g[1:-1]:
                    continue
                value = g[0]
                for c in g[1:]:
                    value = (value * 0x01000193 & 0xFFFFFFFF) ^ c
                total += model.weights[(value * 0x9E3779B1 + size & 0xFFFFFFFF) >> 18]
                n += 1
                if size == 3:
                    all_ += 1
                    known += int.from_bytes(g, "big") in met
        logits += total / n
        p = np.exp(logits - logits.max())
        p /= p.sum()
        assert abs(p.max() - r["score"]) < 1e-6 and model.languages[int(p.argmax())] == r["lang_pred"]
        assert r["accepted"] == (p.max() >= model.reject_below and known / all_ >= model.foreign_below)


def test_sample_is_of_rows_not_ids(spark, monkeypatch):
    """One id with many rows of two languages: its rows keep their own labels, and the sample stays bounded."""
    from collections import Counter

    rows_ = [(1, f"{'uno dos tres' if i % 2 else 'one two three'} {i}", "es" if i % 2 else "en", "a", 1) for i in range(100)]
    rows_ += rows_[:2] * 50
    seen = []
    monkeypatch.setattr(langid, "SAMPLE_PER_LANGUAGE", 20)
    monkeypatch.setattr(langid, "train", lambda counts, labels, languages, calibrate: seen.append(Counter(languages[i] for i in labels)))
    monkeypatch.setattr(langid, "with_trigrams", lambda model, grams, calibrate: model)
    langid.fit(documents(spark, rows_))
    assert seen == [{"en": 20, "es": 20}]


def test_unlabelled_rows_are_kept_if_they_have_a_letter(spark):
    docs = documents(spark, [(1, "some words", None, None, 1), (2, "12 --", None, None, 1), (3, None, None, None, 1)])
    assert [r["doc_id"] for r in langid.keep_identified(docs).collect()] == [1]
    assert [r["doc_id"] for r in langid.identify(docs).where("accepted").collect()] == [1]
