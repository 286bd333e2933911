"""The operators as queries over whole tables, ``f(spark, sf_dir) -> DataFrame``,
and SQL for those it can express."""

from visitlog.llm.decontaminate import contamination
from visitlog.llm.language import predict_languages
from visitlog.llm.lm import score_documents
from visitlog.llm.neardup import link_duplicates
from visitlog.llm.negatives import label_negatives
from visitlog.llm.oracle import ORACLE
from visitlog.llm.ordered import pack_document_tokens
from visitlog.llm.packing import pack_documents
from visitlog.llm.pii import pseudonymize
from visitlog.llm.quality import quality_report
from visitlog.llm.runs import document_runs
from visitlog.llm.sharding import shard_documents
from visitlog.llm.tokens import count_tokens
from visitlog.llm.warc import capture_pages

__all__ = ["ORACLE", "QUERIES"]


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over(name, operator):
    return lambda spark, sf_dir: operator(_table(spark, sf_dir, name))


QUERIES = {
    "op1_near_duplicates": _over("documents", link_duplicates),
    "op2_best_fit_packing": _over("documents", pack_documents),
    "op3_warc_captures": _over("pages", capture_pages),
    "op4_lm_scoring": _over("documents", score_documents),
    "op5_jump_sharding": _over("documents", shard_documents),
    "op6_pii_surrogates": _over("documents", pseudonymize),
    "op7_token_counts": _over("documents", count_tokens),
    "op8_decontamination": lambda spark, sf_dir: contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    ),
    "op9_quality_rules": _over("documents", quality_report),
    "op10_language_id": _over("documents", predict_languages),
    "op11_hard_negatives": _over("embeddings", label_negatives),
    "op12_periodic_runs": _over("documents", document_runs),
    "op13_ordered_packing": _over("documents", pack_document_tokens),
}
