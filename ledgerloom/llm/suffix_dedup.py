"""Removal of long repeated strings by a distributed merge sort of suffixes.

Only suffixes at content-defined places are sorted. In every string of
``length`` bytes the ``SEED`` bytes with the smallest hash, leftmost first, mark
its anchor; equal strings have their anchor at the same offset. So each repeat
shows up as two anchors whose texts agree to the left and to the right over
``length`` bytes together, and an anchor whose seed hash occurs once in the
corpus can be left out before any text is moved.

1. ``anchors``: seed hashes and places of all texts; joined with the hashes
   that occur more than once.
2. ``runs``: tasks take the suffixes (and what stands before them) at those
   places, sort them in runs of bounded size, and cut each run into blocks by
   ranges of the order, front-coded: a suffix is the length of the prefix it
   shares with the one before it and the rest. Equal suffixes of one run are
   sent once, so a large group of copies is reduced before the exchange.
3. ``merged``: each range merges its blocks with a loser tree that keeps the
   common prefix of every loser with the last winner and compares from there.
   The common prefixes of neighbours, which the merge gives, say how far texts
   agree to the right; those of what stands before them, how far to the left.
4. ``removed``: the ranges are joined with their texts and cut out.

The order is by a hash of the seed and then by bytes, so ranges of hashes are
splitters that need no sample. A seed with more than ``HOT`` anchors would meet
in one task: the strings around those anchors are compared by 128-bit digests
instead, counted with partial sums before the shuffle.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, partitions, ship, text_of, without
from ledgerloom.operators.tables import stored

RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
LENGTH = 400
SEED = 128
HOT = 200_000  # anchors of one seed
RUN_BYTES = 24 << 20  # of the suffixes sorted in one run
RANGE_ROWS = 40_000  # suffixes merged by one task
BUFFER_BITS = 20  # bytes hashed at once


# --- anchors ---------------------------------------------------------------------


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.full(size, base, np.uint64)
        down = np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    head = np.minimum.accumulate(rows, axis=1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n - width + 1], head[width - 1:n])


def find_anchors(buffer: bytes, ends: list[int], length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and seed hashes of the anchors of all strings in the texts that end at ``ends``."""
    data = np.frombuffer(buffer, np.uint8)
    up, down = _powers(1 << (BUFFER_BITS + 1))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * down[:len(data)], out=sums[1:])
        n = len(data) - seed + 1
        hashes = (sums[seed:] - sums[:n]) * up[:n]
        hashes ^= hashes >> np.uint64(31)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(29)
        hashes *= np.uint64(0x94D049BB133111EB)
        hashes ^= hashes >> np.uint64(32)
    low = np.uint64((1 << (BUFFER_BITS + 1)) - 1)
    least = _sliding_min((hashes & ~low) | np.arange(n, dtype=np.uint64), length - seed + 1)
    whole = np.ones(len(least), bool)
    for end in ends:
        whole[max(0, end - length + 1):end] = False
    places = (least[whole] & low).astype(np.int64)
    places = places[np.append(True, places[1:] != places[:-1])] if len(places) else places
    return places, hashes[places].view(np.int64)


def _anchors(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = 1 << (BUFFER_BITS - 1)
        parts: list[tuple[int, int, int, bytes]] = []
        size = 0

        def flush():
            ends = np.cumsum([len(p[3]) for p in parts])
            begins = ends - [len(p[3]) for p in parts]
            places, hashes = find_anchors(b"".join(p[3] for p in parts), ends.tolist(), length, seed)
            which = np.searchsorted(ends, places, "right")
            one, two, offset = (np.array([p[k] for p in parts], np.int64) for k in range(3))
            out = [hashes, one[which], two[which], (places - begins[which] + offset[which]).astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["h", "k1", "k2", "pos"])

        for batch in batches:
            for k1, k2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8")
                for at in range(0, max(1, len(data) - length + 1), step):
                    part = data[at:at + step + length - 1]
                    if len(part) < length:
                        continue
                    if size + len(part) > 1 << BUFFER_BITS and parts:
                        yield flush()
                        parts, size = [], 0
                    parts.append((k1, k2, at, part))
                    size += len(part)
        if parts:
            yield flush()

    return run


# --- runs --------------------------------------------------------------------------


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix; the first ``known`` bytes are not compared."""
    n = min(len(a), len(b))
    different = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (different.bit_length() + 7) // 8


BLOCK = ["one", "two", "pos", "shared", "rest", "left_shared", "left_rest", "text", "left",
         "c_one", "c_two", "c_from", "c_to"]
KINDS = [np.int64, np.int64, np.int32, np.uint16, np.uint16, np.uint16, np.uint16, None, None,
         np.int64, np.int64, np.int32, np.int32]


class Run:
    """Suffixes of one task in order; ``entries``: (order key and suffix, reversed left side, key, place)."""

    def __init__(self, length: int, seed: int, ranges: int):
        self.length, self.seed, self.ranges = length, seed, ranges
        self.entries: list[tuple[bytes, bytes, int, int, int]] = []
        self.size = 0

    def add(self, data: bytes, one: int, two: int, pos: int) -> None:
        from xxhash import xxh3_64_digest

        right = data[pos:pos + self.length]
        left = data[max(0, pos - self.length + self.seed):pos][::-1]
        self.entries.append((xxh3_64_digest(right[:self.seed]) + right, left, one, two, pos))
        self.size += len(right) + len(left)

    def blocks(self) -> Iterator[list]:
        self.entries.sort()
        columns: list[list] = [[] for _ in BLOCK]
        target, before, before_left = None, b"", b""
        for suffix, left, one, two, pos in self.entries:
            to = int.from_bytes(suffix[:8], "big") * self.ranges >> 64
            if to != target:
                if target is not None:
                    yield [target, *columns]
                    columns = [[] for _ in BLOCK]
                target, before, before_left, sent = to, b"", b"", None
            if suffix == before and left == before_left and sent is not None:
                # a copy: what it can share with others, the one before it shares
                low, high = self.length - (len(suffix) - 8), len(left)
                if low <= high:
                    for entry in ((one, two, pos), sent):
                        if entry is not None:
                            for c, v in zip(columns[9:], (*entry[:2], entry[2] - high, entry[2] - low + self.length), strict=True):
                                c.append(v)
                sent = (one, two, pos)
                continue
            shared, left_shared = common(suffix, before), common(left, before_left)
            for c, v in zip(columns, (one, two, pos, shared, len(suffix) - shared, left_shared,
                                      len(left) - left_shared, suffix[shared:], left[left_shared:]), strict=False):
                c.append(v)
            before, before_left, sent = suffix, left, (one, two, pos)
        if target is not None:
            yield [target, *columns]


def _runs(length: int, seed: int, ranges: int):
    def pack(rows: list[list]) -> pa.RecordBatch:
        arrays = [pa.array([r[0] for r in rows], pa.int64())]
        for k, kind in enumerate(KINDS, 1):
            arrays.append(pa.array(
                [b"".join(r[k]) if kind is None else np.array(r[k], kind).tobytes() for r in rows], pa.binary()))
        return pa.RecordBatch.from_arrays(arrays, names=["target", *BLOCK])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = Run(length, seed, ranges)
        for batch in batches:
            for k1, k2, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8")
                for pos in places:
                    current.add(data, k1, k2, pos)
                    if current.size > RUN_BYTES:
                        yield pack(list(current.blocks()))
                        current = Run(length, seed, ranges)
        if current.entries:
            yield pack(list(current.blocks()))

    return run


# --- merge -------------------------------------------------------------------------


class Stream:
    """The suffixes of a front-coded block, one after the other."""

    def __init__(self, block: dict):
        self.columns = [
            block[n] if kind is None else np.frombuffer(block[n], kind).tolist()
            for n, kind in zip(BLOCK, KINDS, strict=True)
        ]
        self.at, self.text_at, self.left_at = -1, 0, 0
        self.suffix, self.left = b"", b""
        self.alive = self.advance()

    def advance(self) -> bool:
        """To the next suffix; ``shared`` is what it has in common with the one before."""
        self.at += 1
        one, two, pos, shared, rest, left_shared, left_rest, text, left = self.columns[:9]
        if self.at >= len(one):
            self.alive = False
            return False
        self.shared = shared[self.at]
        self.suffix = self.suffix[:self.shared] + text[self.text_at:self.text_at + rest[self.at]]
        self.left = self.left[:left_shared[self.at]] + left[self.left_at:self.left_at + left_rest[self.at]]
        self.text_at += rest[self.at]
        self.left_at += left_rest[self.at]
        self.entry = (one[self.at], two[self.at], pos[self.at])
        return True


def merge(streams: list[Stream]) -> Iterator[tuple[int, bytes, bytes, tuple]]:
    """All suffixes in order, each with the length it shares with the one before.

    A tournament of losers. Every node keeps its loser and the prefix that it
    shares with the winner that last went by. A newcomer brings the prefix that
    it shares with its predecessor, which is that winner. Of two with different
    shared prefixes the longer one is smaller, and nothing is compared; with
    equal ones, bytes are compared from there on.
    """
    k = 1
    while k < len(streams):
        k *= 2
    losers: list[int] = [-1] * k  # -1: nobody
    shared = [0] * k

    def play(a: int, a_shared: int, node: int) -> tuple[int, int]:
        """The winner of the newcomer ``a`` and the node's loser, with its shared prefix."""
        b = losers[node]
        if b < 0 or not streams[b].alive:
            losers[node] = -1
            return a, a_shared
        if a < 0 or not streams[a].alive:
            losers[node] = -1
            return b, shared[node]
        b_shared = shared[node]
        if a_shared > b_shared:
            return a, a_shared
        if a_shared < b_shared:
            losers[node], shared[node] = a, a_shared
            return b, b_shared
        x, y = streams[a].suffix, streams[b].suffix
        both = common(x, y, a_shared)
        if both == len(y) or both < len(x) and x[both] > y[both]:
            if both == len(x) == len(y) and a < b:
                shared[node] = both
                return a, a_shared
            losers[node], shared[node] = a, both
            return b, b_shared
        shared[node] = both
        return a, a_shared

    # the first round: pairs from the leaves up, nothing shared yet
    level: list[tuple[int, int]] = [(i if i < len(streams) else -1, 0) for i in range(k)]
    nodes = k
    while len(level) > 1:
        nodes //= 2
        upper = []
        for i in range(0, len(level), 2):
            node = nodes + i // 2
            losers[node], shared[node] = level[i + 1]
            upper.append(play(*level[i], node))
        level = upper
    winner, common_prefix = level[0]
    while winner >= 0 and streams[winner].alive:
        s = streams[winner]
        yield common_prefix, s.suffix, s.left, s.entry
        now, now_shared = winner, (s.shared if s.advance() else 0)
        node = (winner + k) // 2
        while node >= 1 and k > 1:
            now, now_shared = play(now, now_shared, node)
            node //= 2
        winner, common_prefix = now, now_shared


def cover(group: list[tuple[int, bytes, tuple]], length: int) -> Iterator[tuple[int, int, int, int]]:
    """Ranges (key, from, to) that repeat, for suffixes of one seed in order.

    ``group`` has (bytes shared with the one before, reversed left side, entry).
    Neighbours are joined into sets, longest shared prefix first. A set keeps
    its left sides in order, and the smaller set moves into the larger: only the
    neighbours of what is moved can share more to the left than they did. A pair
    with r bytes to the right and l to the left repeats the strings that begin
    ``length - r`` to l bytes before the anchor; for one anchor these ranges
    together are one.
    """
    n = len(group)
    order = sorted(range(n), key=lambda i: group[i][1])
    rank = [0] * n
    for place, i in enumerate(order):
        rank[i] = place
    low, high = [length + 1] * n, [-1] * n
    of = list(range(n))
    sets: list[list[int]] = [[rank[i]] for i in range(n)]

    def root(i: int) -> int:
        while of[i] != i:
            of[i] = of[of[i]]
            i = of[i]
        return i

    for edge in sorted(range(1, n), key=lambda i: -group[i][0]):
        right = group[edge][0]
        a, b = root(edge - 1), root(edge)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        of[b] = a
        large = sets[a]
        for place in sets[b]:
            i = order[place]
            at = bisect_left(large, place)
            for other in ([large[at - 1]] if at else []) + ([large[at]] if at < len(large) else []):
                j = order[other]
                left = common(group[i][1], group[j][1])
                if length - right <= left:
                    for x in (i, j):
                        low[x] = min(low[x], length - right)
                        high[x] = max(high[x], left)
            large.insert(at, place)
        sets[b] = []
    for i in range(n):
        if high[i] >= 0:
            one, two, pos = group[i][2]
            yield one, two, pos - high[i], pos - low[i] + length


def _merged(length: int, seed: int):
    def run(table: pa.Table) -> pa.Table:
        found: list[list] = [[], [], [], []]
        streams = []
        for block in table.select(BLOCK).to_pylist():
            for column, name, kind in zip(found, BLOCK[9:], KINDS[9:], strict=True):
                column.append(np.frombuffer(block[name], kind))
            streams.append(Stream(block))
        ranges: list[tuple[int, int, int, int]] = []
        group: list[tuple[int, bytes, tuple]] = []
        for shared, _, left, entry in merge(streams):
            if shared < 8 + seed:
                if len(group) > 1:
                    ranges.extend(cover(group, length))
                group = []
            group.append((shared - 8, left, entry))
        if len(group) > 1:
            ranges.extend(cover(group, length))
        for column, values in zip(found, zip(*ranges, strict=True), strict=False):
            column.append(np.array(values, np.int64))
        k1, k2, begin, end = (np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in found)
        return pa.table({"k1": k1, "k2": k2, "span": begin << 32 | end})

    return run


# --- seeds with very many anchors ----------------------------------------------------


def _digests(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for k1, k2, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8")
                begins = sorted({s for p in places
                                 for s in range(max(0, p - length + seed), min(p, len(data) - length) + 1)})
                for at in range(0, len(begins), 1 << 16):
                    some = begins[at:at + (1 << 16)]
                    digest = np.frombuffer(b"".join(xxh3_128_digest(data[s:s + length]) for s in some), np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(some), k1)), pa.array(np.full(len(some), k2)),
                        pa.array(np.array(some, np.int64)), pa.array(digest[::2]), pa.array(digest[1::2]),
                    ], names=["k1", "k2", "begin", "d1", "d2"])

    return run


# --- all together ----------------------------------------------------------------------


def merge_spans(spans: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for span in np.sort(spans).tolist():
        begin, end = span >> 32, span & 0xFFFFFFFF
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def repeated_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """(k1, k2, spans) of the texts (k1, k2, text) that hold repeats; a span is ``begin << 32 | end``."""
    ship(docs.sparkSession)
    spark = docs.sparkSession
    anchors = stored(docs.mapInArrow(_anchors(length, seed), "h long, k1 long, k2 long, pos int"), "anchors")
    # stored, so that the join has plain shuffles on both sides and splits a seed with very many anchors
    counts = stored(anchors.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "seeds")
    repeated = anchors.join(counts, "h")
    places = stored(
        repeated.groupBy("k1", "k2").agg(
            F.collect_set(F.when(F.col("n") <= hot, F.col("pos"))).alias("places"),
            F.collect_set(F.when(F.col("n") > hot, F.col("pos"))).alias("hot")), "places")
    total = places.agg(F.sum(F.size("places")).alias("n"), F.sum(F.size("hot")).alias("hot")).collect()[0]
    ranges = max(partitions(spark), -(-(total["n"] or 0) // RANGE_ROWS))
    texts = docs.join(places, ["k1", "k2"])
    blocks = texts.filter(F.size("places") > 0).select("k1", "k2", "text", F.array_sort("places").alias("places"))
    blocks = blocks.mapInArrow(
        _runs(length, seed, ranges), "target long, " + ", ".join(f"{n} binary" for n in BLOCK))
    spans = blocks.groupBy("target").applyInArrow(_merged(length, seed), "k1 long, k2 long, span long")
    if total["hot"]:
        strings = texts.filter(F.size("hot") > 0).select("k1", "k2", "text", "hot").mapInArrow(
            _digests(length, seed), "k1 long, k2 long, begin long, d1 long, d2 long")
        strings = stored(strings, "strings")
        again = stored(strings.groupBy("d1", "d2").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "again")
        found = strings.join(again, ["d1", "d2"])
        spans = spans.unionByName(found.select(
            "k1", "k2", F.expr(f"shiftleft(begin, 32) + begin + {length}").alias("span")))
    return spans.groupBy("k1", "k2").agg(F.collect_set("span").alias("spans"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, k1: str, k2: str, text: str) -> DataFrame:
    """Two 64-bit hashes of id and text name a document; rows that repeat both are one document twice."""
    return docs.withColumn(text, text_of(text_col)).withColumns({
        k1: F.xxhash64(F.col(id_col), F.col(text)), k2: F.xxhash64(F.lit(1), F.col(text), F.col(id_col))})


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length: int = LENGTH, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """The rows of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans``.

    A byte is removed when a string of ``length`` bytes that covers it also
    starts elsewhere, in the same text or another one, judged on the texts as
    given. ``spans`` has the removed runs, from and to in bytes, none of which
    touch; what is left may not be whole characters, so it is given as a digest
    of bytes. Null counts as empty. Texts shorter than ``length`` lose nothing.
    Rows that repeat are separate rows and repeat each other. An empty table
    gives an empty result. Input columns named like a result are replaced.
    """
    docs = without(docs, *RESULT, "spans")
    k1, k2, text, found = fresh(docs, "k1", "k2", "whole", "found")
    keyed = _keyed(docs, id_col, text_col, k1, k2, text)
    spans = stored(repeated_spans(
        keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(text).alias("text")),
        length, seed, hot), "spans")

    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = []
        for t, s in zip(texts, found, strict=True):
            if t is None or s is None:
                rows.append((0, 0, None, None))
                continue
            data, runs = t.encode("utf-8"), merge_spans(np.asarray(s, np.int64))
            kept, at = hashlib.sha256(), 0
            for b, e in runs:
                kept.update(data[at:b])
                at = e
            kept.update(data[at:])
            rows.append((sum(e - b for b, e in runs), len(runs), kept.hexdigest(), [list(r) for r in runs]))
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256", "spans"])

    spans = spans.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("spans").alias(found))
    joined = keyed.join(spans, [k1, k2], "left")
    held = F.when(F.col(found).isNotNull(), F.col(text))
    done = joined.withColumn(found, cut(held, F.col(found)))
    return done.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.coalesce(f"{found}.n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce(f"{found}.n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce(f"{found}.kept_sha256", F.sha2(F.col(text), 256)).alias("kept_sha256"),
        F.coalesce(f"{found}.spans", F.array().cast("array<array<long>>")).alias("spans"))
