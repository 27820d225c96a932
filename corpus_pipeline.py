"""The corpus pipeline: quality rules, near-duplicates, secrets, mixing and packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes the result of each stage to the shared folder and reads it
back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartmart.llm import mixing, near_duplicates, packing, quality_rules, secrets
from chartmart.llm.common import documents, settle

DEDUP_PERCENT = 80  # of equal shingles; op8_near_duplicates has its own threshold


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.cascade(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of near-duplicates."""
    return near_duplicates.kept(docs, DEDUP_PERCENT)


def scrub(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return secrets.mask(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample that holds source, language and topic at their target shares."""
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in token sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", dedup),
    ("secrets", scrub),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
# Tokens of the packing stage and raking have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None
ORACLE: dict[str, str] = {}
