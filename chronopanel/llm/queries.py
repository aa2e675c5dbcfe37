"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``,
and SQL for those that SQL can express."""

from __future__ import annotations

from chronopanel.session import table

from . import decontaminate, jaccard_join, quality_rules, vector_codes, warc
from .bpe_codec import coded_documents
from .kneser_ney import scored_documents
from .language_id import predicted_languages
from .sharding import sharded_documents
from .subword_viterbi import encoded_documents
from .token_counts import line_token_counts
from .token_output import token_output
from .whitening import whitened_embeddings


def op1_resharding(spark, sf_dir):
    return sharded_documents(spark, table(spark, sf_dir, "documents"))


def op2_language_id(spark, sf_dir):
    return predicted_languages(spark, table(spark, sf_dir, "documents"))


def op3_quality_rules(spark, sf_dir):
    return quality_rules.quality_table(table(spark, sf_dir, "documents"))


def op4_token_counts(spark, sf_dir):
    return line_token_counts(spark, table(spark, sf_dir, "documents"))


def op5_token_output(spark, sf_dir):
    return token_output(spark, table(spark, sf_dir, "documents"))


def op6_warc_bundles(spark, sf_dir):
    return warc.warc_bundles(spark, table(spark, sf_dir, "pages"))


def op7_decontamination(spark, sf_dir):
    return decontaminate.contaminated_pairs(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_subword_viterbi(spark, sf_dir):
    return encoded_documents(spark, table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op10_kneser_ney(spark, sf_dir):
    return scored_documents(spark, table(spark, sf_dir, "documents"))


def op11_bpe_codec(spark, sf_dir):
    return coded_documents(spark, table(spark, sf_dir, "documents"))


def op12_whitening(spark, sf_dir):
    return whitened_embeddings(spark, table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark, sf_dir):
    return vector_codes.coded_embeddings(spark, table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_resharding, op2_language_id, op3_quality_rules, op4_token_counts, op5_token_output,
                                   op6_warc_bundles, op7_decontamination, op8_subword_viterbi, op9_jaccard_join, op10_kneser_ney,
                                   op11_bpe_codec, op12_whitening, op13_vector_codes)}

SQL = {"op3_quality_rules": quality_rules.SQL, "op6_warc_bundles": warc.SQL,
       "op7_decontamination": decontaminate.SQL, "op9_jaccard_join": jaccard_join.SQL,
       "op13_vector_codes": vector_codes.SQL}
