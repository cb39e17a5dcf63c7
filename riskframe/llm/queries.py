"""The registered queries opN_<name>: each applies one operator to its whole table."""
from __future__ import annotations

from riskframe.llm import (
    bpe, decontaminate, filter_audit, html_text, line_dedup, neardup, quality, secrets, source_divergence, suffix_dedup, token_counts,
    topk_search, warc)
from riskframe.llm.common import table


def op1_near_dedup(spark, sf_dir):
    return neardup.near_components(table(spark, sf_dir, "documents"), words=4)


def op2_suffix_dedup(spark, sf_dir):
    # three batches: the second is scanned against the first's level and merged with it, the third against the merged one
    return suffix_dedup.digest(table(spark, sf_dir, "documents"), batches=3)


def op3_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op4_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_secret_scan(spark, sf_dir):
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark, sf_dir):
    return line_dedup.dedup_digest(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents"))


def op8_bpe_roundtrip(spark, sf_dir):
    return bpe.digest(table(spark, sf_dir, "documents"))


def op9_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_decontaminate(spark, sf_dir):
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_topk_search(spark, sf_dir):
    return topk_search.search_table(table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark, sf_dir):
    return source_divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_near_dedup, op2_suffix_dedup, op3_token_counts, op4_warc, op5_secret_scan, op6_line_dedup, op7_quality_rules,
    op8_bpe_roundtrip, op9_html_text, op10_decontaminate, op11_filter_audit, op12_topk_search, op13_source_divergence)}
#: DuckDB SQL where the result has a SQL form.
ORACLE_SQL = {"op1_near_dedup": neardup.ORACLE, "op4_warc": warc.ORACLE, "op6_line_dedup": line_dedup.ORACLE,
              "op11_filter_audit": filter_audit.ORACLE, "op12_topk_search": topk_search.ORACLE,
              "op13_source_divergence": source_divergence.ORACLE}
