"""Exact duplicates by a content sort.

Texts are equal when they are the same without separators. Sampled splitters
(Spark's range exchange) deal the rows out by the beginning of the normalised
text and, where many texts begin alike, by a hash; every task sorts its range,
which spills to disk, so that equal texts stand next to each other, and the
window over the sorted rows compares neighbours in full.

A text with more rows than one piece (see ``piece_rows``) is sorted in several
pieces. Its totals are summed before the shuffle, one row for each task, so a
group with a third of all rows meets in no task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import fresh, piece_rows, squeezed, text_of, without
from ledgerloom.operators.tables import stored

RESULT = ("keep_id", "group_size", "kept", "text_sha256")
PREFIX_CHARS = 48


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Of equal texts the row with the most code points in its original text stays,
    then the one with the smallest id; a null id comes last, and of rows that
    repeat in both, one stays. A null text counts as empty, and all empty texts
    are one group. An empty table gives an empty result. An input column named
    like a result column is replaced.
    """
    docs = without(docs, *RESULT)
    spark = docs.sparkSession
    norm, digest, length, prefix, pieces, salt, rank = fresh(
        docs, "norm", "digest", "length", "prefix", "pieces", "salt", "rank")
    keys = docs.withColumn(norm, squeezed(text_of(text_col)))
    keys = keys.withColumn(digest, F.xxhash64(norm)).withColumn(length, F.char_length(text_of(text_col)))

    counts = stored(keys.groupBy(digest).agg(F.count("*").alias("n")).filter("n > 1"), "copies")
    piece = piece_rows(spark, docs.count())
    hot = counts.filter(F.col("n") > piece).select(
        digest,
        F.ceil(F.col("n") / piece).cast("int").alias(pieces))

    # at most twice the number of shuffle partitions, see piece_rows
    keys = keys.join(F.broadcast(hot), digest, "left")
    hot_rows = keys.filter(F.col(pieces).isNotNull())
    best = hot_rows.groupBy(norm).agg(
        F.count("*").alias("total"),
        F.min(F.struct(-F.col(length), F.col(id_col).isNull(), F.col(id_col))).alias("best"))
    best = best.select(
        F.sha2(F.col(norm), 256).alias("text_sha256"), "total",
        (-F.col("best.col1")).alias("best_length"), F.col(f"best.{id_col}").alias("best_id"))

    spread = (
        keys.withColumn(prefix, F.substring(norm, 1, PREFIX_CHARS))
        .withColumn(salt, F.coalesce(F.pmod(F.xxhash64(id_col), F.col(pieces)), F.lit(0)))
        .repartitionByRange(prefix, digest, salt)
    )
    piece_of = Window.partitionBy(prefix, digest, salt, norm)
    order = piece_of.orderBy(F.col(length).desc(), F.col(id_col).asc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = spread.select(
        *docs.columns, length, pieces,
        F.sha2(F.col(norm), 256).alias("text_sha256"),
        F.first(id_col).over(whole).alias("keep_id"),
        F.count("*").over(whole).alias("group_size"),
        F.row_number().over(order).alias(rank),
    )
    # one row for each hot text, so as few as the list above
    joined = local.join(F.broadcast(best), "text_sha256", "left")
    is_hot = F.col("total").isNotNull()
    first = (F.col(rank) == 1) & (
        ~is_hot | (F.col(id_col).eqNullSafe(F.col("best_id")) & (F.col(length) == F.col("best_length"))))
    return joined.select(
        *docs.columns,
        F.when(is_hot, F.col("best_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("total", "group_size").alias("group_size"),
        first.alias("kept"), "text_sha256")
