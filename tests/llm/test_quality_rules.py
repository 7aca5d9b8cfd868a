from collections import Counter

from llm_cases import DOCS, documents, rows, words

from changeflow.llm import quality


def brute(text):
    ws, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    runs = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    covered = {k for i in range(len(ws) - 7) if runs[tuple(ws[i:i + 8])] > 1 for k in range(i, i + 8)}
    return (len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(spark):
    out = quality.quality_rules(documents(spark, clash=True))
    got = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out.collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t, *_ in DOCS), key=repr)


def test_verdicts(spark):
    got = {r["doc_id"]: r for r in quality.quality_rules(documents(spark)).collect()}
    assert got[4]["base_failed"] and not got[4]["kept"]  # null
    assert got[1]["base_failed"]  # the same passage three times
    assert got[9]["base_failed"] is False and got[13]["kept"] is False and "symbols" in got[13]["failed_rules"]
    assert got[15]["base_failed"]


def test_keep_good_keeps_rows_whole(spark):
    docs = documents(spark, clash=True)
    good = {r["doc_id"] for r in quality.quality_rules(docs).collect() if r["kept"]}
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert rows(kept) == rows(docs.where(docs.doc_id.isin([i for i in good if i is not None])))
    assert good


def test_filter_on_a_verdict_stays_small(spark):
    plan = quality.quality_rules(documents(spark)).where("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 200_000 and "Python" not in plan


def test_empty_table(spark):
    assert quality.quality_rules(documents(spark, [])).count() == 0 and quality.keep_good(documents(spark, [])).count() == 0
