"""Mixing of sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, gone through up to
``repeats`` times. A document's virtual finish time is the number of words its
source has sent up to its end, divided by the source's target. All sources
reach their target at time 1. The mix is the documents in order of finish time,
cut where their words pass the total budget.

Running sums inside a source are taken in pieces of its shuffled order: a sum
for each piece, a running sum over the pieces, and one inside each piece. So a
source with a third of all rows is spread like the others. The cut is found the
same way: sums over narrow ranges of finish time, then rows of the one range in
which the budget ends.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import fresh, partitions, piece_rows, text_of, without, word_count
from ledgerloom.operators.tables import stored

RESULT = ("size", "source_size", "target", "copies", "finish")


@dataclass
class Queues:
    """What the passes over the narrow rows have found."""

    sources: DataFrame  # one row for each source: size, target, number of pieces
    starts: DataFrame  # one row for each piece: words of the source before it
    cut: Row | None  # the last row that is taken; None: all rows are taken
    repeats: int


def _shuffled(column: str, seed: str) -> Column:
    return F.coalesce(F.md5(F.concat(F.col(column).cast("string"), F.lit(seed))), F.lit(""))


def _piece(order: str, pieces: str) -> Column:
    """Equal ranges of the shuffled order."""
    head = F.coalesce(F.conv(F.substring(order, 1, 8), 16, 10).cast("long"), F.lit(0))
    return F.floor(head * F.col(pieces) / F.lit(1 << 32)).cast("int")


def source_targets(narrow: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """Targets of the sources; the rows handled here are one for each source.

    Sources in order of code point, null last, take the weights in turn. They
    share the words of all; a target stops at ``repeats`` times the size of its
    source, and what is over goes to the others by weight. In order of that
    limit for each unit of weight, the sources that stop come first, so running
    sums give the level at which the others end.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    sources = sources.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn).cast("long"))
    sources = sources.withColumn("most", F.col("source_size") * repeats)
    by_level = Window.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = sources.withColumns({
        "all_size": F.sum("source_size").over(everything),
        "stopped": F.coalesce(F.sum("most").over(before), F.lit(0)),
        "rest": F.sum("weight").over(after),
    })
    left = F.col("all_size") - F.col("stopped")
    sources = sources.withColumn("stops", F.col("most") * F.col("rest") <= left * F.col("weight"))
    level = F.first(F.when(~F.col("stops"), left.cast("double") / F.col("rest")), ignorenulls=True)
    sources = sources.withColumn("level", level.over(everything))
    target = F.when(F.col("stops"), F.col("most").cast("double")).otherwise(F.col("level") * F.col("weight"))
    return sources.select("source", "source_size", "n", "all_size", target.alias("target"))


def _finish(epoch: int) -> Column:
    sent = (F.lit(epoch) * F.col("source_size") + F.col("sent")).cast("double")
    return F.when(F.col("target") > 0, sent / F.col("target")).when(F.lit(epoch == 0), F.lit(0.0))


def _tag(epoch: int) -> Column:
    """Place in the order of the mix; null for a repeat that no one needs."""
    return F.when(_finish(epoch).isNotNull(), F.struct(
        _finish(epoch).alias("finish"), F.col("source").isNull().alias("unnamed"),
        F.coalesce("source", F.lit("")).alias("source"), F.col("order").alias("order"),
        F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("id")))


def _with_sums(rows: DataFrame, sources: DataFrame, starts: DataFrame) -> DataFrame:
    """``rows`` (id, source, size, order and others) with the words sent up to each one's end."""
    named = sources.withColumnRenamed("source", "s").drop("n", "all_size")
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    rows = rows.withColumn("piece", _piece("order", "pieces"))
    begun = starts.withColumnRenamed("source", "s").withColumnRenamed("piece", "p")
    rows = rows.join(begun, F.col("source").eqNullSafe(F.col("s")) & (F.col("piece") == F.col("p")), "left")
    inside = (
        Window.partitionBy("source", "piece")
        .orderBy("order", F.col("id").asc_nulls_first(), "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return rows.withColumn("sent", F.col("start") + F.sum("size").over(inside)).drop("s", "p", "start")


def queues(narrow: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3) -> Queues:
    """Targets, running sums and the cut for stored rows of (id, source, size, order)."""
    spark = narrow.sparkSession
    sources = source_targets(narrow, weights, repeats)
    piece = piece_rows(spark, narrow.count())
    sources = stored(sources.withColumn(
        "pieces", F.ceil(F.col("n") / piece).cast("long")), "sources")
    named = sources.select(F.col("source").alias("s"), "pieces")
    dealt = narrow.join(named, F.col("source").eqNullSafe(F.col("s")), "left")
    sums = dealt.withColumn("piece", _piece("order", "pieces")).groupBy("source", "piece").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(sums.select(
        "source", "piece", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start")), "starts")

    sent = stored(_with_sums(narrow, sources, starts), "sent")
    passes = sent.withColumn("tag", F.explode(F.filter(
        F.array(*[_tag(e) for e in range(repeats)]), lambda t: t.isNotNull())))
    ranges = 4 * partitions(spark)  # of a unit of finish time
    passes = passes.withColumn("range", F.least(F.floor(F.col("tag.finish") * ranges), F.lit(4 * ranges)))
    by_range = passes.groupBy("range").agg(F.sum("size").alias("words"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    budget = sources.agg(F.max("all_size").alias("words")).collect()[0]["words"] or 0
    over = (
        by_range.withColumn("upto", F.sum("words").over(upto))
        .filter(F.col("upto") > budget).orderBy("range").limit(1).collect()
    )
    if not over:
        return Queues(sources, starts, None, repeats)
    at = over[0]
    in_order = Window.orderBy("tag").rowsBetween(Window.unboundedPreceding, 0)
    last = passes.filter(F.col("range") == at["range"]).select("tag", "size")
    last = last.withColumn("upto", F.lit(at["upto"] - at["words"]) + F.sum("size").over(in_order))
    last = last.filter(F.col("upto") <= budget).agg(F.max("tag").alias("tag")).collect()[0]["tag"]
    start = Row(finish=at["range"] / ranges, unnamed=False, source="", order="", no_id=False, id=-(1 << 62))
    return Queues(sources, starts, last or start, repeats)


def _taken(epoch: int, cut: Row | None) -> Column:
    if cut is None:
        return F.coalesce(_finish(epoch).isNotNull(), F.lit(False)).cast("int")
    end = F.struct(*[F.lit(cut[k]).alias(k) for k in ("finish", "unnamed", "source", "order", "no_id", "id")])
    return F.coalesce(_tag(epoch) <= end, F.lit(False)).cast("int")


def narrow_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        word_count(text_of(text_col)).alias("size"), _shuffled(id_col, seed).alias("order"))


def fair_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3, seed: str = "mix",
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.

    ``copies`` says how often the mix takes the whole document, 0 to ``repeats``
    times; documents are never cut, so a source ends within one document of its
    share. The order is shuffled by a digest of the id and the seed and depends
    on nothing else, so reruns agree. A null source is a source, the last one;
    a null text is empty. Empty documents cost nothing: they come as often as
    their place in the queue is passed, and once if all of the source is empty.
    Rows that repeat are separate rows. An empty table gives an empty result.
    An input column named like a result column is replaced.
    """
    docs = without(docs, *RESULT)
    narrow = stored(narrow_rows(docs, id_col, text_col, source_col, seed), "sizes")
    found = queues(narrow, weights, repeats)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        word_count(text_of(text_col)).alias("size"), _shuffled(id_col, seed).alias("order"))
    return _decided(rows, found).select("row.*", "size", "source_size", "target", "copies", "finish")


def _decided(rows: DataFrame, found: Queues) -> DataFrame:
    rows = _with_sums(rows, found.sources, found.starts)
    taken = [_taken(e, found.cut) for e in range(found.repeats)]
    return rows.withColumn("copies", sum(taken[1:], taken[0])).withColumn("finish", _finish(0))


def mix_sizes(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3, seed: str = "mix",
              id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """What :func:`fair_mix` decides, without the texts: id, size, source_size, target, copies."""
    narrow = stored(narrow_rows(docs, id_col, text_col, source_col, seed), "sizes")
    rows = _decided(narrow, queues(narrow, weights, repeats))
    return rows.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies")


def in_mix_order(mixed: DataFrame) -> DataFrame:
    """A row for each copy, in order of virtual finish time over all partitions."""
    (epoch,) = fresh(mixed, "epoch")
    rows = mixed.filter("copies > 0").withColumn(epoch, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    time = F.col("finish") + F.coalesce(F.try_divide(F.col(epoch) * F.col("source_size"), F.col("target")), F.lit(0.0))
    return rows.withColumn("finish", time).repartitionByRange("finish").sortWithinPartitions("finish")
