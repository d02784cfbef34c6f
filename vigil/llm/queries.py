"""The registered queries of this package: ``(spark, sf_dir) -> DataFrame``
by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import bpe, filteraudit, langid, licenses, lines, mixing, ngram_join, periodic, records, subword, suffix, tokencount, urlfilter
from vigil.sources.tables import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"), k=5, num=75, den=100)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by the path of their url; documents have no path and inherit nothing."""
    def files(name: str, id_col: str, path: Column, text_col: str) -> DataFrame:
        return table(spark, sf_dir, name).select(F.struct(F.lit(name).alias("table"), F.col(id_col).alias("id")).alias("file"),
                                                 path.alias("path"), F.col(text_col).alias("text"))

    both = files("pages", "page_id", licenses.url_path(F.col("url")), "html").unionByName(
        files("documents", "doc_id", F.lit(None).cast("string"), "text"))
    return licenses.scan(both, id_col="file").select("file.*", "path", "license", "cosine", "origin", "inherited_from")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), urlfilter.RULES)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(table(spark, sf_dir, "documents"), ranks=langid.RANKS)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.verbatim_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13)
    return suffix.judge(found, times=20).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
        F.col("matches").alias("verbatim_matches"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return subword.score(docs, subword.fit(docs, table(spark, sf_dir, "labels"), sample=subword.SAMPLE), threshold=0.3)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.judge_lines(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents")).withColumn(
        "first_slot", F.coalesce("first_slot", F.lit(-1)).cast("long"))     # -1: never taken


def op9_mixing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the schedule first takes each document."""
    return mixing.mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "taken", "first_slot")


def op10_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic.repeated_tail(F.col("text"), F.col("doc_id")).alias("text"))
    return periodic.digests(periodic.find_runs(docs))


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_token_counts": op2_token_counts,
    "op3_license_scan": op3_license_scan,
    "op4_url_filter": op4_url_filter,
    "op5_language_id": op5_language_id,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op9_mixing_order": op9_mixing_order,
    "op10_binary_records": op10_binary_records,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_bpe_round_trip": op12_bpe_round_trip,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op8_quality_rules": lines.LINES_SQL.strip(),
    "op9_mixing": mixing.MIX_SQL.strip(),
    "op13_filter_audit": filteraudit.AUDIT_SQL.strip(),
}


def load() -> tuple[dict, dict]:
    """All queries and oracles of the package, the corpus pipeline included."""
    import corpus_pipeline
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return QUERIES | {"pipeline": corpus_pipeline.run}, ORACLES | sql
