"""Corpus pipeline: documents through quality rules, near-dedup, PII masking, mixing and packing.

Each stage takes (spark, docs, sf_dir), calls one operator of ``postalspark.llm`` on all that its predecessor kept,
and returns a DataFrame that is written and read again as the next one's documents. All but the last
return the columns of documents; their decisions take effect (rejected and copied rows go, identifiers are replaced by
their kind, mixing repeats or drops rows). Defined cases (nulls, empty texts, ties, repeated rows, empty tables) are the operators'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalspark.llm import mixing, packing, pii, quality, simhash
from postalspark.llm.common import stash, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within two bits: the one with the smallest id."""
    return simhash.one_of_each(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind in brackets; ``n_chars`` follows."""
    return pii.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or dropped by their fitted rate, so that tokens come to the stated `mixing.TARGETS`."""
    return mixing.resample(docs, table(spark, sf_dir, "labels"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows, with their ids."""
    return packing.pack(docs).select("doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", F.crc32("ids").alias("ids_crc32"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("PII", mask_pii),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: quality cutoffs, fingerprints and tokens are beyond SQL; the stages are tested against plain versions instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if (name, stage) != STAGES[-1]:
            docs = stash(docs, "stage-" + name.lower().replace(" ", "-"))
    return docs
