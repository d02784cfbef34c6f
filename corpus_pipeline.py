"""A training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's docs.  All but the last return the
columns of ``documents``.

1. language ID: documents whose language cannot be told go (no letter, far from
   every profile, or no nearer to one than to the next); ``lang`` becomes the
   identified language;
2. n-gram Jaccard join: of each group of near copies the one with the smallest
   id stays, with documents that have no words all staying;
3. benchmark decontamination: contaminated documents go;
4. mixing: the sources' words are taken up to their targets, at most twice, in
   the order of the low-discrepancy schedule;
5. output: token ids as length-delimited binary records in that order, read back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import langid, mixing, ngram_join, records, suffix
from vigil.llm.storage import Scratch
from vigil.sources.tables import table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return records.write_and_read(docs, public_tokenizers.path("byte_bpe_50k.json"), table_order=True)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

#: None: rank-order profiles and the tokenizer have no SQL form; the tests
#: hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are a table in the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{i}")
        if i:
            scratch.drop(f"stage-{i - 1}")
    return docs
