"""Bounded samples of labelled rows, for classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, texts_of

#: A document's place is a hash of its id, one of so many.
PLACES = 1 << 40


def labelled_sample(docs: DataFrame, classes: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, text, label) of about per_class documents of each label, or all where a label has no more.

    classes: (doc_id, label). A document is chosen if the hash of its id, as a share of all hashes, lies
    below per_class / (the label's documents), so a label's number is binomial about per_class: a tenth
    more than that is over five standard deviations off. Rows are only filtered, never gathered by label: what
    crosses tasks by label are counts. Those counts, a row a label, and then the chosen ids, bounded by
    per_class times the labels, go to every task.

    An id with several labels has the least of them. Null ids and labels are left out; repeated rows of docs
    with a chosen id all come. An empty table gives an empty sample.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(PLACES))
    rows = classes.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "label").groupBy("doc_id").agg(F.min("label").alias("label"))
    sizes = rows.groupBy("label").agg(F.count("*").alias("_size"))
    chosen = rows.join(F.broadcast(sizes), "label").where(place < F.lit(float(per_class) * PLACES) / F.col("_size")).select("doc_id", "label")
    return staged(texts_of(docs).join(F.broadcast(chosen), "doc_id"), "sample")
