"""Registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from vitrine.llm import (
    decontam, hard_negatives, html_cut, jaccard_join, kneser_ney, line_dedup, personal_data, phrases, quality, sentence_pieces,
    suffix_dedup, token_counts, url_rules)
from vitrine.llm.core import table

MODEL, TOKEN_LIMIT = "piece_bpe_32k.model", 4096


def model_file(name: str = MODEL) -> bytes:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_dedup_digest(table(spark, sf_dir, "documents"))


def op2_html(spark, sf_dir):
    return html_cut.extract(table(spark, sf_dir, "pages"))


def op3_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup_digest(table(spark, sf_dir, "documents"))


def op4_decontam(spark, sf_dir):
    return decontam.decontam_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_url_rules(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op6_sentence_pieces(spark, sf_dir):
    return sentence_pieces.encode(table(spark, sf_dir, "documents"), model_file())


def op7_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), model_file(), TOKEN_LIMIT)


def op8_near_copies(spark, sf_dir):
    return jaccard_join.near_copies(table(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_kneser_ney(spark, sf_dir):
    return kneser_ney.held_out_scores(table(spark, sf_dir, "documents"))


def op11_personal_data(spark, sf_dir):
    return personal_data.personal_data_digest(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


ALL = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_html": op2_html,
    "op3_line_dedup": op3_line_dedup,
    "op4_decontam": op4_decontam,
    "op5_url_rules": op5_url_rules,
    "op6_sentence_pieces": op6_sentence_pieces,
    "op7_token_counts": op7_token_counts,
    "op8_near_copies": op8_near_copies,
    "op9_quality": op9_quality,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_personal_data": op11_personal_data,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_phrases": op13_phrases,
}
SQL = {
    "op3_line_dedup": line_dedup.SQL,
    "op4_decontam": decontam.SQL,
    "op8_near_copies": jaccard_join.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_phrases": phrases.SQL,
}
