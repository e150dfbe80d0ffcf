"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, packing.

``STAGES`` lists (name, function) in order.  Every function takes (spark, docs, sf_dir) and
returns a DataFrame; ``run`` writes each result as Parquet in the shared staging folder and
rereads it as the next stage's documents.  All stages but the last return the columns of
documents.

Defined cases: null and blank texts fail the quality rules; repeated rows fall to the
near-duplicate stage; an empty table passes through empty; extra columns are kept to the last
stage, under whatever name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemrollup.llm.common import cut, cuts, drop_cuts, prepare, table
from itemrollup.llm.decontaminate import drop_contaminated
from itemrollup.llm.near_dups import drop_near_duplicates
from itemrollup.llm.packing import pack
from itemrollup.llm.quality_rules import keep_good, trained
from itemrollup.llm.secret_scan import redact
from itemrollup.llm.token_counts import build, load_pieces


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the trained verdict reject go."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels")
    return keep_good(docs, trained(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays."""
    prepare(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    prepare(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; n_chars follows the masked text."""
    prepare(spark)
    out = redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the remaining texts, with their bytes, in optimal length buckets and batches."""
    prepare(spark)
    return pack(docs, automaton=build(load_pieces()))


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

# Trained and hashed stages have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents.  A stage's own folders go when its result is stored, and that
    result when the next one is; only what the returned frame reads is left."""
    docs, old = table(spark, sf_dir, "documents"), []
    for i, (name, stage) in enumerate(STAGES):
        with cuts() as made:
            docs = stage(spark, docs, sf_dir)
            if i < len(STAGES) - 1:
                docs = cut(docs, "pipeline-" + name.replace(" ", "-"))
        if i < len(STAGES) - 1:
            drop_cuts(spark, [*old, *made[:-1]])
            old = made[-1:]
    return docs
