"""The registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ..session import work_dir
from ..sources.tables import read_table
from . import chat, class_lm, divergence, exact_dedup, langid, near_dedup, packing, phrases, piece_bpe, quality, sharding, tokenfile, url_filter
from .common import written


def op1_quality_rules(spark, sf_dir):
    return quality.quality_rules(read_table(spark, sf_dir, "documents"))


def op2_language_id(spark, sf_dir):
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op3_token_files(spark, sf_dir, tokenizer=public_tokenizers.path("word_bpe_49k.json")):
    path = work_dir(spark, "tokens")
    tokenfile.write_tokens(read_table(spark, sf_dir, "documents"), tokenizer, path)
    return tokenfile.read_documents(spark, path)


def op4_hilbert_shards(spark, sf_dir):
    return sharding.document_shards(read_table(spark, sf_dir, "documents"))


def op5_piece_bpe(spark, sf_dir, model=public_tokenizers.path("piece_bpe_32k.model")):
    return piece_bpe.encode_texts(read_table(spark, sf_dir, "documents"), model, digest=True)


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents")).drop("bucket")


def op7_near_dedup(spark, sf_dir):
    classes = near_dedup.near_classes(read_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op8_class_lm(spark, sf_dir):
    return class_lm.score(read_table(spark, sf_dir, "documents"))


def op9_chat_format(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(chat.PROBE, turns.schema))
    out = chat.format_conversations(turns.withColumn("content", chat.text_parts()))
    return chat.read_conversations(written(out, "chat"))


def op10_best_fit_packing(spark, sf_dir, tokenizer=public_tokenizers.path("byte_bpe_50k.json")):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer)


def op11_url_filter(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.build_index(url_filter.page_entries(pages)))


def op12_phrases(spark, sf_dir):
    return phrases.top_phrases(phrases.mine(read_table(spark, sf_dir, "documents")))


def op13_divergence(spark, sf_dir):
    return divergence.audit(read_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_language_id, op3_token_files, op4_hilbert_shards, op5_piece_bpe, op6_exact_dedup,
        op7_near_dedup, op8_class_lm, op9_chat_format, op10_best_fit_packing, op11_url_filter, op12_phrases, op13_divergence,
    )
}

ORACLE = {
    "op1_quality_rules": quality.oracle_sql(),
    "op4_hilbert_shards": sharding.oracle_sql(),
    "op6_exact_dedup": exact_dedup.ORACLE_SQL,
    "op9_chat_format": chat.ORACLE_SQL,
    "op11_url_filter": url_filter.ORACLE_SQL,
    "op12_phrases": phrases.oracle_sql(),
    "op13_divergence": divergence.oracle_sql(),
}
