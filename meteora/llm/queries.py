"""Queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from meteora.llm import alignment, ann, chat, language_id, line_dedup, mixing, ngram_join, packing, quality, suffix_dedup, token_counts, vector_codes, warc
from meteora.llm.common import table


def tokenizer_path() -> str:
    """The vocabulary file that the contract names."""
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    return token_counts.count_edits(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_line_dedup(spark, sf_dir):
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_pareto_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op8_quality_rules(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_block_matrix_ann(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


def op10_chat_format(spark, sf_dir):
    return chat.digest(chat.format_chat(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op11_vector_codes(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_warc(spark, sf_dir):
    return warc.digest(warc.archive_and_read(table(spark, sf_dir, "pages")))


def op13_token_alignment(spark, sf_dir):
    import public_tokenizers
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(),
                           str(public_tokenizers.path("piece_bpe_32k.model")))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_token_counts, op3_line_dedup, op4_suffix_dedup, op5_best_fit_packing, op6_pareto_mix,
    op7_language_id, op8_quality_rules, op9_block_matrix_ann, op10_chat_format, op11_vector_codes, op12_warc,
    op13_token_alignment)}
ORACLES = {"op6_pareto_mix": mixing.ORACLE, "op9_block_matrix_ann": ann.ORACLE, "op10_chat_format": chat.ORACLE,
           "op11_vector_codes": vector_codes.ORACLE, "op12_warc": warc.ORACLE}
