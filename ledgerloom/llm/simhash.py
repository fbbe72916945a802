"""Near duplicates by SimHash fingerprints, compared exactly in tiles.

Rows with one fingerprint are one row before anything is compared. A tile holds
fingerprints with the same population counts of their ``BLOCKS`` blocks of
bits. Fingerprints that differ in r bits have counts that differ by r at most,
summed over the blocks, so only tiles within that distance meet; all others are
skipped. A fingerprint goes to its own tile and, as a guest, to the later ones
of the tiles near it. A tile with many rows is divided, and guests go to all of
its parts. In a part, numpy's exclusive-or and bit counts compare the rows with
each other and with the guests as they stream by, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import fresh, ship, text_of
from ledgerloom.llm.components import components
from ledgerloom.operators.tables import stored

WORDS = 3
RADIUS = 2
BLOCKS = 4
TILE = 8192  # rows of a part of a tile
SLICE = 1 << 16  # shingles hashed at once
CELLS = 1 << 21  # comparisons at once


def fingerprint(text: str) -> int:
    """64 bits, each set if it is set in more than half of the hashes of the shingles."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8").lower().split()  # bytes: A-Z and the six separators only
    if not words:
        return 0
    width = min(WORDS, len(words))
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    starts, ends = starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), SLICE):
        hashes = np.array([xxh64_intdigest(data[a:b], 42)
                           for a, b in zip(starts[i:i + SLICE], ends[i:i + SLICE], strict=True)], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.int64)[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def fingerprints(docs: DataFrame, text_col: str = "text", name: str = "fp") -> DataFrame:
    ship(docs.sparkSession)
    return docs.withColumn(name, _fingerprints(text_of(text_col)))


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that join the same nodes as the pairs (i, j), one for each node at most."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            nodes = np.flatnonzero(label != np.arange(n))
            return nodes, label[nodes]
        label = new


def _near(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the radius between two blocks of fingerprints, as a spanning forest of theirs."""
    if not len(left):  # a part that no row of its tile fell into
        return left, left
    i, j = [], []
    step = max(1, CELLS // max(1, len(right)))
    for a in range(0, len(left), step):
        hit = np.bitwise_count(left[a:a + step, None] ^ right[None, :]) <= radius
        x, y = np.nonzero(hit)
        i.append(x + a)
        j.append(y)
    i, j = np.concatenate(i), np.concatenate(j)
    if not len(i):
        return left[:0], left[:0]
    both = np.concatenate([left, right])
    nodes, roots = spanning(i, j + len(left), len(both))
    a, b = both[nodes], both[roots]
    return a[a != b], b[a != b]


def _links(radius: int):
    """Rows in order of part, own fingerprints first: links between them and with the guests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own, done = None, np.empty(0, np.uint64), True
        for batch in batches:
            parts, guest, fp = (batch.column(k).to_numpy() for k in range(3))
            fp = fp.view(np.uint64)
            edges = np.flatnonzero(np.diff(parts)) + 1
            for a, b in zip(np.append(0, edges), np.append(edges, len(parts)), strict=True):
                if a == b:
                    continue
                if parts[a] != part:
                    if not done:
                        yield _batch(*_near(own, own, radius))
                    part, own, done = parts[a], np.empty(0, np.uint64), False
                home = int(np.searchsorted(guest[a:b], 1)) + a
                own = np.concatenate([own, fp[a:home]])
                if home < b:
                    if not done:
                        yield _batch(*_near(own, own, radius))
                        done = True
                    for c in range(home, b, TILE):
                        yield _batch(*_near(own, fp[c:min(c + TILE, b)], radius))
        if not done:
            yield _batch(*_near(own, own, radius))

    return run


def _batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def near_links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect whatever distinct fingerprints ``fp`` differ in ``radius`` bits or fewer.

    Of the links inside a group only a spanning forest is given for each pair of
    blocks compared, so a large group gives about one link for each row.
    """
    ship(prints.sparkSession)
    bits = 64 // blocks
    base = bits + 1
    counts = [F.bit_count(F.shiftrightunsigned("fp", k * bits).bitwiseAND(F.lit((1 << bits) - 1)))
              for k in range(blocks)]
    cell = sum((c.cast("long") * base ** k for k, c in enumerate(counts)), F.lit(0).cast("long"))
    homes = prints.select("fp", cell.alias("cell"), F.array(*counts).alias("counts"))
    # bounded by the number of combinations of counts, 17 ** 4, and so is its broadcast
    sizes = homes.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("parts"))
    steps = [
        s for s in product(range(-radius, radius + 1), repeat=blocks)
        if sum(map(abs, s)) <= radius and tuple(reversed(s)) > (0,) * blocks
    ]
    inside = [F.lit(True)] * len(steps)
    for n, step in enumerate(steps):
        for k, d in enumerate(step):
            if d:
                inside[n] = inside[n] & (F.get("counts", F.lit(k)) + d).between(0, bits)
    near = F.array(*[
        F.when(ok, F.col("cell") + sum(d * base ** k for k, d in enumerate(step)))
        for ok, step in zip(inside, steps, strict=True)])
    own = homes.join(F.broadcast(sizes), "cell")
    place = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    home = own.select("cell", place.alias("part"), F.lit(0).alias("guest"), "fp")
    # the parts of one tile: a row is a guest of the parts before its own
    among = own.filter(place > 0).select(
        "cell", F.explode(F.sequence(F.lit(0), place - 1)).alias("part"), F.lit(1).alias("guest"), "fp")
    visits = homes.select(F.explode(F.array_compact(near)).alias("cell"), "fp").join(F.broadcast(sizes), "cell")
    visits = visits.select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                           F.lit(1).alias("guest"), "fp")
    rows = home.unionByName(among).unionByName(visits)
    rows = rows.select((F.col("cell") * (1 << 20) + F.col("part")).alias("tile"), "guest", "fp")
    rows = rows.repartition("tile").sortWithinPartitions("tile", "guest")
    return rows.mapInArrow(_links(radius), "a long, b long")


def groups(ids: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) for every fingerprint among the stored rows (id, fp)."""
    heads = stored(ids.groupBy("fp").agg(F.min("id").alias("head")), "heads")
    linked = components(near_links(heads.select("fp"), radius))
    linked = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct())
    rooted = heads.join(linked, heads["fp"] == linked["node"], "left")
    rooted = rooted.select("fp", "head", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("head").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``.

    The fingerprint is given as 16 hexadecimal digits; ``component_id`` is the
    smallest id that links of ``radius`` bits or fewer reach, the row's own
    included. Null and empty texts, and texts without a word, have fingerprint
    zero and are linked like others. Null ids count last: they are the component
    only where no row has another id. Rows that repeat give rows that repeat.
    An empty table gives an empty result. Long texts are hashed in slices.
    """
    ids = stored(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).select("id", "fp"), "prints")
    found = ids.join(stored(groups(ids, radius), "groups"), "fp")
    return found.select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without those that are near duplicates of a row that stays.

    Of each component one document stays, the one with the smallest id; of rows
    with that id, the one whose text has the smallest hash. Rows that repeat
    both id and text are one document.
    """
    key, digest = fresh(docs, "key", "digest")
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = stored(fingerprints(narrow).select("id", F.xxhash64("text").alias("digest"), "fp"), "prints")
    found = ids.join(stored(groups(ids.select("id", "fp"), radius), "groups"), "fp")
    stay = found.groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "digest")).alias("first"))
    # null ids of several components stand apart by their hash
    stay = stay.select(F.col("first.id").alias(key), F.col("first.digest").alias(digest)).distinct()
    same = F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(digest))
    return docs.join(stay, same, "left_semi").select(*docs.columns)
