"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinara.llm import (
    byte_bpe,
    chat_format,
    collocations,
    html_extract,
    jaccard_join,
    mixing,
    ngram_lm,
    pii_crf,
    quality_rules,
    secret_scan,
    toxicity,
    vector_codes,
    weighted_sampling,
)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "op1_html_extract": html_extract.op1_html_extract,
    "op2_byte_bpe": byte_bpe.op2_byte_bpe,
    "op3_mixing": mixing.op3_mixing,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op5_ngram_lm": ngram_lm.op5_ngram_lm,
    "op6_weighted_sampling": weighted_sampling.op6_weighted_sampling,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_pii_crf": pii_crf.op9_pii_crf,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_collocations": collocations.op11_collocations,
    "op12_chat_format": chat_format.op12_chat_format,
    "op13_vector_codes": vector_codes.op13_vector_codes,
    "pipeline": pipeline,
}
ORACLE = {
    "op3_mixing": mixing.OP3_SQL,
    "op7_jaccard_join": jaccard_join.OP7_SQL,
    "op8_quality_rules": quality_rules.OP8_SQL,
    "op11_collocations": collocations.OP11_SQL,
    "op12_chat_format": chat_format.OP12_SQL,
    "op13_vector_codes": vector_codes.OP13_SQL,
}
