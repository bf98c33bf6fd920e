"""A training corpus from `documents` in five stages, each on what the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's docs. All
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streamtab.llm import decontam, mix, partenum, quality, tokens
from streamtab.llm.common import saved
from streamtab.sources.files import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Near copies in a corpus: words of a shingle and least similarity in percent. Query op4 has values of its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or that the isolation forest finds odd go."""
    docs = docs.select(*COLUMNS)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose n-gram sets are linked, the one with the smallest id stays."""
    return partenum.one_of_each(spark, docs.select(*COLUMNS), n=NEAR_WORDS, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    return decontam.without_copies(spark, docs.select(*COLUMNS), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix.mixed_rows(spark, docs.select(*COLUMNS))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token files; one row per document read back from them."""
    return tokens.checksums(tokens.read_metadata(spark, tokens.write_tokens(spark, docs.select("doc_id", "text")), ids=True))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID output", token_files),
]

# The forest, the alignment, the knapsack and the tokenizer have no SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
