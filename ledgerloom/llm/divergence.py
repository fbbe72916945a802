"""How far the sources of a language differ in their words.

Identical texts of a language collapse to one row with a multiplicity for each
source, which is tokenized once; its term counts go into document frequencies
and counts with the multiplicities as weights. Only counts above zero are ever
rows: the sum over all kept terms of a pair of sources is taken from them, and
what both lack is added in closed form.

With ``x(t)`` the share of a term, ``z`` the share of an absent one, the
distance of sources a and b over V terms is

    V |z_a - z_b|  +  sum over terms that a or b has of (|x_a - x_b| - |z_a - z_b|)

The second part is summed in tiles: a tile holds the rows of two blocks of
sources for a part of the terms, so its size is bounded whatever the number of
terms and sources. All arithmetic is in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import ship, text_of
from ledgerloom.operators.tables import stored

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # what stands between terms
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
PRIOR = 5
BLOCK_SOURCES = 256  # sources of a block, on average
TILE_ROWS = 200_000  # rows of a tile, on average


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + PRIOR) / (total + PRIOR terms)); null where there is no term."""
    up = (count + F.lit(PRIOR)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    down = (total + F.lit(PRIOR) * terms).cast("decimal(20,0)")
    return F.when(terms > 0, F.call_function("div", up, down) + 1)


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, h1, h2, text, copies): each text of a language once, with (source, n) for each of its sources.

    Copies are counted without their texts; of the texts one for each digest
    leaves a task, so a text with many copies fills no task.
    """
    rows = docs.select("lang", "source", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(11), "text").alias("h2"))
    key = ["lang", "h1", "h2"]
    texts = rows.groupBy(*key).agg(F.any_value("text").alias("text"))
    copies = rows.groupBy(*key, "source").agg(F.count(F.lit(1)).alias("n"))
    copies = copies.groupBy(*key).agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    return texts.join(copies, key)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, docs, count): weighted document frequencies and counts."""
    # a text that begins or ends between terms gives an empty string there
    terms = F.split(F.translate("text", UPPER, LOWER), BETWEEN, -1)
    found = collapsed(docs).select("lang", "h1", "h2", "copies", F.explode(terms).alias("term")).where("term <> ''")
    # one row for each term of a text; the rows of a text are in one task already,
    # and as a part of the key the copies leave the hash table its fixed-size values
    once = found.groupBy("lang", "h1", "h2", "copies", "term").agg(F.count(F.lit(1)).alias("times"))
    weighed = once.select("lang", "term", "times", F.explode("copies").alias("copy"))
    return weighed.groupBy("lang", F.col("copy.source").alias("source"), "term").agg(
        F.sum("copy.n").alias("docs"), F.sum(F.col("copy.n") * F.col("times")).alias("count"))


def _tile_sums(batch: pa.Table) -> pa.Table:
    """Sums of ``|x_a - x_b| - |z_a - z_b|`` over the terms of a tile, for the pairs of its two blocks."""
    lang, left, right = (batch.column(c)[0].as_py() for c in ("lang", "left", "right"))
    names, source = np.unique(batch.column("source").to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
    block = np.zeros(len(names), np.int64)
    block[source] = batch.column("block").to_numpy()
    bases = np.zeros(len(names), np.int64)
    bases[source] = batch.column("base").to_numpy()
    held = batch.column("term").is_valid().to_numpy()
    source = source[held]
    x = batch.column("x").to_numpy()[held]
    words = batch.column("term").filter(pa.array(held)).combine_chunks().dictionary_encode()
    term = words.indices.to_numpy().astype(np.int64)
    order = np.argsort(source, kind="stable")
    source, term, x = source[order], term[order], x[order]
    starts = np.searchsorted(source, np.arange(len(names) + 1))
    own = bases[source]
    ones, others, sums = [], [], []
    shares = np.zeros(len(words.dictionary), np.int64)
    has = np.zeros(len(words.dictionary), bool)

    def by_source(values: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(values)))[starts])

    for a in np.flatnonzero(block == left):
        here = slice(starts[a], starts[a + 1])
        shares[:] = bases[a]
        shares[term[here]], has[term[here]] = x[here], True
        apart = np.abs(bases[a] - bases)
        # terms that b has
        total = by_source(np.abs(shares[term] - x) - apart[source])
        # terms that a has, against the base of b, without those that b has too
        at = np.sort(x[here])
        upto = np.concatenate(([0], np.cumsum(at)))
        below = np.searchsorted(at, bases)
        total += upto[-1] - 2 * upto[below] - (len(at) - 2 * below) * bases - len(at) * apart
        both = has[term]
        total -= by_source(np.where(both, np.abs(shares[term] - own) - apart[source], 0))
        has[term[here]] = False
        partners = np.flatnonzero((block == right) & (np.arange(len(names)) != a))
        ones.append(np.full(len(partners), a))
        others.append(partners)
        sums.append(total[partners])
    if not ones:
        ones, others, sums = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0, int)]
    ones, others = np.concatenate(ones), np.concatenate(others)
    return pa.table({
        "lang": pa.array([lang] * len(ones), pa.string()), "source": pa.array(names[ones], pa.string()),
        "item": pa.array(names[others], pa.string()), "part_sum": pa.array(np.concatenate(sums), pa.int64()),
    })


def pair_distances(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language.

    ``groups``: (lang, source, terms, base); ``shares``: (lang, source, term, x)
    for the terms that a source has.
    """
    size = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_SOURCES).cast("int").alias("blocks"))
    held = shares.groupBy("lang").agg(F.count(F.lit(1)).alias("held"))
    size = size.join(held, "lang", "left").select(
        "lang", "blocks",
        # each block meets each other, so a tile has the rows of two blocks
        F.greatest(F.lit(1), F.ceil(2 * F.coalesce("held", F.lit(0)) / F.col("blocks") / TILE_ROWS)).cast("int").alias("tiles"))
    blocked = groups.join(size, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    blocked = blocked.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocked = blocked.withColumns({"left": F.col("block"), "right": F.col("partner")})
    # of (i, j) and (j, i) both are summed, each for the sources of its left block
    swapped = blocked.where("block <> partner").withColumns({"left": F.col("partner"), "right": F.col("block")})
    seats = blocked.unionByName(swapped).select(
        "lang", "source", "block", "base", "terms", "left", "right", "tiles")
    empty = F.lit(None).cast("string")
    bases = seats.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "lang", "left", "right", "tile", "source", "block", "base", empty.alias("term"), F.lit(0).cast("long").alias("x"))
    rows = shares.join(seats, ["lang", "source"]).select(
        "lang", "left", "right", F.pmod(F.xxhash64("term"), F.col("tiles")).cast("int").alias("tile"),
        "source", "block", "base", "term", "x")
    ship(groups.sparkSession)
    sums = bases.unionByName(rows).groupBy("lang", "left", "right", "tile").applyInArrow(
        _tile_sums, "lang string, source string, item string, part_sum long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("part_sum").alias("part_sum"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("base_b"))
    return sums.join(groups, ["lang", "source"]).join(other, ["lang", "item"]).select(
        "lang", "source", "item",
        F.when(F.col("terms") > 0, F.col("part_sum") + F.col("terms") * F.abs(F.col("base") - F.col("base_b")))
        .otherwise(0).cast("long").alias("value"))


def divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets the sources of a language apart.

    A language keeps the terms that ``least_docs`` or more of its documents
    hold. Rows of part ``pair`` give the distance of a source to each other
    source of its language, those of part ``term`` the ``top`` kept terms that
    the source has more of than its language, by the difference of shares; ties
    go to the smaller item in the order of UTF-8.

    Null text, language and source count as empty strings and are groups like
    others. Every row is a document, so rows that repeat count as often as they
    occur. A source without a term has distances all the same, and zeros where
    its language keeps no term; a source alone in its language has no row of
    part ``pair``. Long texts are taken whole. An empty table gives an empty
    result. Only the three columns are read, so others may have any name.
    """
    rows = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).alias("text"))
    per_term = Window.partitionBy("lang", "term")
    counts = term_counts(rows).withColumn("in_docs", F.sum("docs").over(per_term))
    kept = counts.where(F.col("in_docs") >= least_docs).select(
        "lang", "source", "term", "count", F.sum("count").over(per_term).alias("lang_count"))
    kept = stored(kept, "terms")

    held = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    langs = kept.groupBy("lang", "term").agg(F.sum("count").alias("n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    groups = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("long")
    groups = groups.join(held, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("total", none).alias("total"), F.coalesce("terms", none).alias("terms"),
        F.coalesce("lang_total", none).alias("lang_total"))
    groups = stored(groups.select("*", F.coalesce(share(none, F.col("total"), F.col("terms")), none).alias("base")), "groups")

    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("count"), F.col("total"), F.col("terms")).alias("x"),
        share(F.col("lang_count"), F.col("lang_total"), F.col("terms")).alias("q"))
    shares = stored(shares, "shares")

    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pair_distances(groups.select("lang", "source", "terms", "base"), shares.select("lang", "source", "term", "x"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    terms = shares.where("x > q").select("lang", "source", F.col("term").alias("item"), (F.col("x") - F.col("q")).alias("value"))
    terms = terms.select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    return pairs.unionByName(terms.where(F.col("rank") <= top))
