"""Best-fit packing of documents into bins, under conflicts.

A bin holds at most ``capacity`` words, at most ``per_source`` documents of one
source, and no two documents of one duplicate cluster. Documents are dealt into
shards of bounded size by a hash, so every source and every cluster is spread
evenly, however large. In a shard the longest document comes first. The bins
are ordered by the room that is left; the search begins at the tightest bin
with room enough and goes on to its successors until one is compatible. Each
bin carries bitmaps: ``per_source`` planes of sources, where bit s of plane n
says that the bin has more than n documents of source s, and one of clusters.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship, squeezed, text_of, word_count
from ledgerloom.operators.tables import stored

CAPACITY = 4096
PER_SOURCE = 4
SHARD_ROWS = 8192


def best_fit(items: list[tuple[int, int | None, int | None]], capacity: int, per_source: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item (size, source bit, cluster bit); a bit of None conflicts with nothing."""
    out: list[tuple[int, int]] = [(-1, -1)] * len(items)
    room: list[int] = []  # residual << 32 | bin, in order
    planes: list[list[int]] = []
    clusters: list[int] = []
    for k in sorted(range(len(items)), key=lambda i: -items[i][0]):
        size, source, cluster = items[k]
        source_bit = 0 if source is None else 1 << source
        cluster_bit = 0 if cluster is None else 1 << cluster
        at = bisect_left(room, size << 32)
        while at < len(room):
            b = room[at] & 0xFFFFFFFF
            if not (planes[b][-1] & source_bit or clusters[b] & cluster_bit):
                break
            at += 1
        if at < len(room):
            residual = room.pop(at) >> 32
        else:
            b, residual = len(planes), capacity
            planes.append([0] * per_source)
            clusters.append(0)
        out[k] = (b, capacity - residual)
        clusters[b] |= cluster_bit
        for n in range(per_source):
            if not planes[b][n] & source_bit:
                planes[b][n] |= source_bit
                break
        insort(room, (residual - size) << 32 | b)
    return out


def _shard(capacity: int, per_source: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("cluster", "ascending"), ("id", "ascending")])
        sizes, sources, clusters = (table.column(c).to_pylist() for c in ("size", "source", "cluster"))
        shard = table.column("shard")[0].as_py() << 32
        source_bits: dict = {}
        seen: dict = {}
        for c in clusters:
            seen[c] = seen.get(c, 0) + 1
        cluster_bits = {c: n for n, c in enumerate(c for c, n in seen.items() if n > 1)}
        items, row, piece = [], [], []
        for k, size in enumerate(sizes):
            rest = size % capacity
            if rest:
                items.append((rest, source_bits.setdefault(sources[k], len(source_bits)), cluster_bits.get(clusters[k])))
                row.append(k)
                piece.append(size // capacity)
        bins, offsets = [], []
        used = 0
        for b, offset in best_fit(items, capacity, per_source):
            bins.append(shard + b)
            offsets.append(offset)
            used = max(used, b + 1)
        lengths = [i[0] for i in items]
        for k, size in enumerate(sizes):  # whole bins of long documents
            for p in range(size // capacity):
                bins.append(shard + used)
                used += 1
                row.append(k)
                piece.append(p)
                offsets.append(0)
                lengths.append(capacity)
        return pa.table({
            "id": table.column("id").combine_chunks().take(pa.array(row, pa.int64())),
            "piece": pa.array(piece, pa.int64()), "bin_id": pa.array(bins, pa.int64()),
            "bin_offset": pa.array(offsets, pa.int64()), "size": pa.array(lengths, pa.int64()),
        })

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_rows: int = SHARD_ROWS,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, piece, bin_id, bin_offset, size): a row for each document, or piece of a long one.

    A document of more than ``capacity`` words fills bins of its own, one for
    each whole ``capacity``; what is left is packed like other documents. The
    cluster is the text without separators, so exact copies, and copies of a
    row that a mix repeats, never share a bin. A document without a word takes
    no room: it has one row of size 0 without a bin. A null source is a source;
    null ids and rows that repeat are documents like others. An empty table
    gives an empty result.
    """
    ship(docs.sparkSession)
    text = text_of(text_col)
    narrow = stored(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text).alias("size"),
        F.xxhash64(squeezed(text)).alias("cluster")), "sizes")
    shards = max(1, -(-narrow.count() // shard_rows))
    kind = dict(narrow.dtypes)["id"]
    dealt = narrow.filter("size > 0").withColumn(
        "shard", F.pmod(F.xxhash64("id", "cluster"), F.lit(shards)))
    packed = dealt.groupBy("shard").applyInArrow(
        _shard(capacity, per_source), f"id {kind}, piece long, bin_id long, bin_offset long, size long")
    empty = narrow.filter("size = 0").select(
        "id", F.lit(0).cast("long").alias("piece"), F.lit(None).cast("long").alias("bin_id"),
        F.lit(None).cast("long").alias("bin_offset"), "size")
    return packed.unionByName(empty).withColumnRenamed("id", id_col)
