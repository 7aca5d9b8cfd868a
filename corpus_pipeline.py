"""Corpus pipeline: quality rules, language ID, exact dedup, near dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result to the shared folder and hands what was written to the next stage.
"""

from __future__ import annotations

import public_tokenizers

from changeflow.llm import exact_dedup as exact
from changeflow.llm import langid, near_dedup, packing, quality
from changeflow.llm.common import written
from changeflow.sources.tables import read_table


def quality_rules(spark, docs, sf_dir):
    """Documents that pass every quality rule."""
    return quality.keep_good(docs)


def language_id(spark, docs, sf_dir):
    """Documents whose language is accepted, by a classifier learnt from the labels of this stage's input."""
    return langid.keep_identified(docs)


def exact_dedup(spark, docs, sf_dir):
    """One document of each group of equal texts."""
    return exact.keep_first(docs)


def minhash_dedup(spark, docs, sf_dir):
    """One document of each class of near-duplicates."""
    return near_dedup.keep_one(docs)


def best_fit_packing(spark, docs, sf_dir, tokenizer=public_tokenizers.path("byte_bpe_50k.json")):
    """The pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs, tokenizer)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("minhash_dedup", minhash_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Hashing, learning and tokenising stages have no SQL form; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
