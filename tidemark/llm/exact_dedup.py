"""Exact deduplication by 128-bit content hash, with bytes compared inside each hash group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, named, one_of_each, text_of


def normal_text(text_col: str) -> Column:
    return F.regexp_replace(text_of(text_col), SPACE, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became one space; null counts as empty.
    The smallest id of equal texts stays. Rows repeated with one id and equal texts count each in group_size, and
    one of them is kept. A null id is kept only where no equal text has an id.

    Classes come from one aggregation on (hash, text): the 128-bit hash comes first in the key, and texts under one
    hash are told apart by their bytes, so a collision makes two classes. Copies meet already on the map side,
    so a group that holds a third of all rows reaches the shuffle as one row per map task. Only classes of two rows
    and more go back to the documents, in a left join of narrow rows that adaptive execution may split where a
    class is large.
    """
    keyed = (
        docs.select(F.col(id_col).alias("_id"), normal_text(text_col).alias("_norm"))
        .withColumn("_hash", F.unhex(F.md5("_norm")))
    )
    classes = (
        keyed.groupBy("_hash", "_norm")
        .agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_hash", F.sha2("_norm", 256).alias("_sha"), "_keep", "_n")
    )
    rows = keyed.select("_id", "_hash", F.sha2("_norm", 256).alias("_sha")).groupBy("_id", "_hash", "_sha").agg(F.count(F.lit(1)).alias("_copies"))
    joined = rows.join(classes, ["_hash", "_sha"], "left")
    keep = F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return (
        joined.select("_id", keep.alias("_keep"), F.coalesce("_n", F.lit(1)).alias("_n"), "_sha", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
        .select(
            F.col("_id").alias(id_col),
            F.col("_keep").alias("keep_id"),
            F.col("_n").cast("long").alias("group_size"),
            (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_copy") == 1)).alias("kept"),
            F.col("_sha").alias("text_sha256"),
        )
    )


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns, whatever these are called.

    One row of each repeated row stays, that of the smallest text before normalisation. Of equal texts that all
    lack an id one stays. An empty table gives an empty table.
    """
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(named(id_col).alias("k_id"), F.col("text_sha256").alias("k_text"))
    return one_of_each(docs, id_col, F.sha2(normal_text(text_col), 256), text_col, kept)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g USING (norm)
"""
