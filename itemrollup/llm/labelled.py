"""Bounded samples of labelled rows, joined to their whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import one_per_key, sample_by_hash


def usable_labels(labels: DataFrame, label: str, eligible=None, key: str = "doc_id") -> DataFrame:
    """(key, label): one row a key.  Labels that are null, that are neither 0 nor 1, or that
    contradict each other for one key are not learned from."""
    marks = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    if eligible is not None:
        marks = marks.where(eligible)
    return marks.groupBy(key).agg(F.min(label).alias("label"), F.max(label).alias("_most")).where("label = _most").select(key, "label")


def share_of_ones(labels: DataFrame, label: str, eligible=None, key: str = "doc_id") -> float | None:
    """Share of label 1 among all usable labels (None without any)."""
    return usable_labels(labels, label, eligible, key).agg(F.avg(F.col("label").cast("double")).alias("share")).collect()[0]["share"]


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, per_class: int, eligible=None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, label, text) of at most ``per_class`` documents of each of the labels 0 and 1.

    The sample is a top-n by a hash of the key over the narrow label table; only its rows'
    texts are read on, one row of each key.
    """
    marks = usable_labels(labels, label, eligible, key)
    zero = sample_by_hash(marks.where("label = 0"), key, per_class)
    one = sample_by_hash(marks.where("label = 1"), key, per_class)
    few = zero.unionByName(one)  # at most 2 * per_class narrow rows
    return one_per_key(docs.select(F.col(key), F.col(text).alias("text")), few).select(key, F.col("label").cast("int").alias("label"), "text")
