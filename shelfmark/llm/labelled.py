"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def sample_labels(labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """_id and y of at most `most` labelled documents outside the held-out fold, the least by a hash of the id.

    Null ids and labels are left out; an id that repeats counts once, with its larger label.
    """
    known = labels.where(f"doc_id IS NOT NULL AND {label} IN (0, 1)").groupBy(F.col("doc_id").alias("_id")).agg(F.max(label).cast("int").alias("y"))
    return known.where(fold("_id", folds) != held_out).orderBy(F.xxhash64("_id"), "_id").limit(most)
