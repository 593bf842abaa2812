"""Operator 13: exact dedup by progressive refinement, in DataFrame functions only.

Two texts are equal when they are identical after lower-casing A-Z.
Equal texts have equal lengths, then equal beginnings, then equal
digests, and each step looks only at rows that the one before could not
tell apart:

1. lengths: rows per text length in bytes; a length that one row has is settled;
2. beginnings: rows per (length, hash of the first ``prefix`` characters) among the others;
3. contents: SHA-256 of the whole normalised text of the rows whose
   length and beginning occur more than once; groups of two or more stay.

Steps 1 and 2 move counts, combined before the shuffle. The texts of
step 3 are found by a semi join with the stored pairs of step 2, which
Spark broadcasts when the table's size on disk allows it (no text is
moved then) and joins by a shuffle otherwise. A group holding a
thousandth of all rows or more (there are a thousand of them at most) is
handed to the rows by a broadcast and the others by a join, so no key of
a join has more rows than that.

Of equal texts the row with the largest doc_id stays. A null text counts
as empty; a null doc_id is smaller than any other, and where all of a
text's rows have none they all stay. Rows that repeat both id and text
are marked alike (``drop_exact_duplicates`` keeps one of them). An empty
table gives an empty result; other columns are not looked at, whatever
they are called. Texts of any length are hashed whole inside one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A group of a ``HOT``-th of all rows is joined by a broadcast; at most ``HOT`` groups can be that large.
HOT = 1000


def normalised(name: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(name), F.lit("")), UPPER, LOWER)


def digest(name: str = "text") -> Column:
    return F.sha2(normalised(name), 256)


def _measured(docs: DataFrame, prefix: int) -> DataFrame:
    """doc_id, text, length and hash of the beginning."""
    begin = F.translate(F.substring(F.coalesce(F.col("text"), F.lit("")), 1, prefix), UPPER, LOWER)
    return docs.select("doc_id", "text", F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("_n"),
                       F.xxhash64(begin).alias("_p"))


def refine(docs: DataFrame, prefix: int = 128) -> tuple[DataFrame, int]:
    """(text_sha256, keep_id, group_size) of the texts that several rows have, and the number of rows."""
    rows = _measured(docs, prefix)
    lengths = saved(rows.groupBy("_n").agg(F.count(F.lit(1)).alias("_c")))
    total = lengths.agg(F.sum("_c")).first()[0] or 0
    begins = saved(rows.select("_n", "_p").join(lengths.filter("_c > 1"), "_n", "left_semi")
                   .groupBy("_n", "_p").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("_n", "_p"))
    left = rows.join(begins, ["_n", "_p"], "left_semi").select("doc_id", "_n", "_p", digest().alias("text_sha256"))
    groups = (left.groupBy("_n", "_p", "text_sha256")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"))
    return saved(groups.select("text_sha256", "keep_id", "group_size")), total


def _with_groups(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """Left join of ``rows`` (with doc_id, text_sha256) with their groups; adds keep_id, group_size and kept."""
    is_hot = F.col("group_size") * HOT >= F.lit(total)
    hot = groups.filter(is_hot).select("text_sha256", F.col("keep_id").alias("_k1"), F.col("group_size").alias("_g1"))
    cold = groups.filter(~is_hot).select(F.col("text_sha256").alias("_key"), F.col("keep_id").alias("_k2"),
                                         F.col("group_size").alias("_g2"))
    # Rows that met a hot group spread over a key of their own; no cold group has it.
    key = F.when(F.col("_g1").isNull(), F.col("text_sha256")).otherwise(F.concat_ws("#", F.col("text_sha256"), F.col("doc_id")))
    met = rows.join(F.broadcast(hot), "text_sha256", "left").withColumn("_key", key).join(cold, "_key", "left")
    keep = (F.when(F.col("_g1").isNotNull(), F.col("_k1")).when(F.col("_g2").isNotNull(), F.col("_k2"))
            .otherwise(F.col("doc_id")))
    return (met.withColumn("keep_id", keep).withColumn("group_size", F.coalesce("_g1", "_g2", F.lit(1)).cast("long"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))).drop("_key", "_k1", "_g1", "_k2", "_g2"))


def exact_duplicates(docs: DataFrame, prefix: int = 128) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    groups, total = refine(docs, prefix)
    rows = docs.select("doc_id", digest().alias("text_sha256"))
    return _with_groups(rows, groups, total).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_exact_duplicates(docs: DataFrame, prefix: int = 128) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat id and text, one."""
    groups, total = refine(docs, prefix)
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", digest().alias("text_sha256"))
    stay = _with_groups(rows, groups, total).filter("kept")
    # Only rows of groups can repeat; the others keep a key of their own.
    alone = stay.filter("group_size = 1").select("_row.*")
    return alone.unionByName(stay.filter("group_size > 1").dropDuplicates(["doc_id", "text_sha256"]).select("_row.*"))
