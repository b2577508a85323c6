"""Bounded labelled samples for the classifiers, folds by checksum, bounded lists of frequent values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import materialize


def fold(doc_id: str, n: int):
    """crc32 of the id as text, modulo n (null ids: null)."""
    return F.crc32(F.col(doc_id).cast("string")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train, per_class: int) -> DataFrame:
    """doc_id, text, label of up to `per_class` labelled documents of either class that `train` admits.

    Chosen by the smallest hash of the id. The ids are at most 2 * per_class, which bounds the
    broadcast and keeps the texts of all other documents in place. A document with
    contradicting labels counts as the larger one; null labels and ids are left out, rows that
    repeat count once.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    some = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    return docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(some[0].union(some[1])), "doc_id").distinct()


def most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """The rows of `counted` (with a count n) of the largest counts, `most` at most.

    The cut lies between two steps of a logarithmic scale (an eighth of a doubling), found
    from one count per step, so that no task or driver has to order all rows.
    """
    counted = materialize(counted, "counted")
    step = F.floor(F.log2("n") * 8)
    total, cut = 0, None
    for row in sorted(counted.groupBy(step.alias("step")).count().collect(), reverse=True):  # at most 512 steps
        total += row["count"]
        if total > most:
            break
        cut = row["step"]
    return counted.where(step >= cut) if cut is not None else counted.limit(0)
