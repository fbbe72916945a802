"""Masked pseudo-likelihood of texts under a bidirectional window network.

Every word is predicted from the two words on its left and the two on its
right; the sum of the log-probabilities scores a text. The probability of a word
is that of its class, given the context, times that of its unit in the class,
given the context, times its share of the unit. The ``HEADS`` most frequent
words are units of their own. Each of the other units holds the words of one
hash value, whose shares are their exact counts: all distinct words are counted
over all texts, in a stored table that grows with the input and is joined back
by the word. So no two words are merged, and over the words of the corpus the
probabilities add up to 1.

The network is trained in numpy on all texts, in rounds. In a round each task
goes through its texts of the round, beginning with the parameters that all
tasks share, and the results are averaged, weighted by words. They meet in
blocks of parameters and in groups of ``FAN_IN`` tasks, level by level, so
nothing grows with the number of tasks but the number of groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, ship, text_of, without
from ledgerloom.operators.tables import stored

RESULT = ("n_tokens", "log_likelihood", "mean_log_likelihood")
CLASSES = 64
MEMBERS = 64  # units of a class
HEADS = 3072  # units that are one word; these are the most frequent ones
UNITS = CLASSES * MEMBERS
PAD = UNITS
WIDTH = 16
SIDE = 2
ROUNDS = 3
RATE = 0.1
BATCH = 1 << 14  # words
FAN_IN = 64
BLOCKS = 64
SAFE = 60  # logits up to it are exponentiated as they are
KEPT = 1_000_000  # words that a task holds before it counts them and passes the counts on
HASHED = "64m"  # of a partition of words, as shuffled, that a join holds in a hash table
NANO = 1_000_000_000  # shares are whole billionths of a nat, so that their sums do not depend on an order
NEVER = -1e9  # log-probability of a unit without words


class Units(dict):
    """From a word to its unit; words that are not listed share the units from ``heads`` on."""

    def __init__(self, words: list[bytes], heads: int):
        super().__init__(zip(words, range(heads)))
        self.heads = heads

    def __missing__(self, word: bytes) -> int:
        return self.heads + crc32(word) % (UNITS - self.heads)


@dataclass(frozen=True)
class Vocabulary:
    units: Units  # of the heads
    totals: np.ndarray  # words of the corpus in each unit

    @cached_property
    def listed(self) -> pa.Array:
        """The heads in the order of their units."""
        return pa.array(list(self.units), pa.binary())


def tokens(text: str) -> list[bytes]:
    return text.encode("utf-8").split()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ``tokens`` of all texts in one array, and how many of them each text has."""
    lists = pc.ascii_split_whitespace(texts)
    words, ends = lists.flatten().cast(pa.binary()), lists.offsets.to_numpy()
    held = pc.binary_length(words).to_numpy() > 0  # white space at an end leaves an empty one
    kept_before = np.append(0, np.cumsum(held))
    return words.filter(pa.array(held)), np.diff(kept_before[ends])


def in_units(words: pa.Array | list[bytes], known: Vocabulary) -> np.ndarray:
    words, heads = pa.array(words, pa.binary()) if isinstance(words, list) else words, known.units.heads
    places = pc.index_in(words, value_set=known.listed)
    units, rest = places.fill_null(0).to_numpy().astype(np.uint16), places.is_null()
    hashes = np.fromiter(map(crc32, words.filter(rest).to_numpy(zero_copy_only=False)), np.int64)
    units[rest.to_numpy(zero_copy_only=False)] = heads + hashes % (UNITS - heads)  # as in ``Units``
    return units


def _by_text(values: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    return np.split(values, np.cumsum(lengths)[:-1]) if len(lengths) else []


def _log_totals(totals: np.ndarray) -> np.ndarray:
    logs = np.full(len(totals), NEVER)
    np.log(totals, out=logs, where=totals > 0)
    return logs


def initial(totals: np.ndarray) -> np.ndarray:
    """All parameters in one vector; without a context they give the frequencies of the units."""
    draw = np.random.default_rng(11)
    return np.concatenate([
        draw.normal(0, 0.1, 2 * SIDE * (UNITS + 1) * WIDTH),
        draw.normal(0, 0.1, WIDTH * CLASSES), _log_totals(totals.reshape(CLASSES, MEMBERS).sum(axis=1)),
        draw.normal(0, 0.1, CLASSES * WIDTH * MEMBERS), _log_totals(totals),
    ]).astype(np.float32)


def _settled(logits: np.ndarray) -> np.ndarray:
    """The logits, less the highest of their row unless all rows can do without."""
    if logits.max() > SAFE or logits[:, 0].min() < -SAFE:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def _row_sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], values.dtype)


def _softmax(logits: np.ndarray) -> np.ndarray:
    np.exp(_settled(logits), out=logits)
    logits /= _row_sums(logits)[:, None]
    return logits


def _log_part(logits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The log-probability of one column of each row; exact also where it is close to 0."""
    logits -= logits[np.arange(len(wanted)), wanted][:, None]
    high = logits.max(axis=1) if logits.max() > SAFE else np.zeros(len(wanted), logits.dtype)
    if high.any():
        logits -= high[:, None]
    return -(high + np.log(_row_sums(np.exp(logits, out=logits))))


def _segments(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts ``ids``, and where in it each value begins."""
    order = np.argsort(ids, kind="stable")
    return order, np.flatnonzero(np.append(True, np.diff(ids[order]) != 0))


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Where each value of a sorted array begins and ends."""
    ends = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(ends, ends[1:]))


class Network:
    """Two context words on each side, a hidden layer, a class and a unit of it."""

    def __init__(self, parameters: np.ndarray):
        self.all = parameters.copy()
        sizes = [2 * SIDE * (UNITS + 1) * WIDTH, WIDTH * CLASSES, CLASSES, CLASSES * WIDTH * MEMBERS]
        embed, out, bias, unit_out, unit_bias = np.split(self.all, np.cumsum(sizes))
        self.embed = embed.reshape(2 * SIDE, UNITS + 1, WIDTH)
        self.out, self.bias = out.reshape(WIDTH, CLASSES), bias
        self.unit_out, self.unit_bias = unit_out.reshape(CLASSES, WIDTH, MEMBERS), unit_bias.reshape(CLASSES, MEMBERS)
        self.embed_seen = np.full((2 * SIDE, UNITS + 1, 1), 1e-6, np.float32)
        self.seen = [np.full_like(p, 1e-6) for p in (self.out, self.bias, self.unit_out, self.unit_bias)]

    def hidden(self, contexts: list[np.ndarray]) -> np.ndarray:
        total = self.embed[0].take(contexts[0], axis=0)
        for side, ids in zip(self.embed[1:], contexts[1:], strict=True):
            total += side.take(ids, axis=0)
        return np.tanh(total, out=total)

    def classes(self, hidden: np.ndarray) -> np.ndarray:
        """Logits of all classes."""
        logits = hidden @ self.out
        logits += self.bias
        return logits

    def members(self, hidden: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Logits of the units in the class of each row; ``classes`` is sorted."""
        logits = np.empty((len(classes), MEMBERS), np.float32)
        for a, b in _runs(classes):
            np.matmul(hidden[a:b], self.unit_out[classes[a]], out=logits[a:b])
            logits[a:b] += self.unit_bias[classes[a]]
        return logits

    def log_probabilities(self, contexts: list[np.ndarray], units: np.ndarray) -> np.ndarray:
        """Of ``units``, each in its context."""
        order, _ = _segments(units)
        hidden, wanted = self.hidden([c[order] for c in contexts]), units[order]
        classes = wanted // MEMBERS
        out = np.empty(len(units))
        out[order] = _log_part(self.classes(hidden), classes) + _log_part(self.members(hidden, classes), wanted % MEMBERS)
        return out

    def train(self, contexts: list[np.ndarray], units: np.ndarray) -> None:
        """One step, with step sizes that shrink where gradients have been seen."""
        order, _ = _segments(units)
        contexts, units, at = [c[order] for c in contexts], units[order], np.arange(len(units))
        targets = units // MEMBERS
        hidden = self.hidden(contexts)
        error = _softmax(self.classes(hidden))
        error[at, targets] -= 1
        inner = _softmax(self.members(hidden, targets))
        inner[at, units % MEMBERS] -= 1
        back = error @ self.out.T
        runs = _runs(targets)
        found, one = targets[[a for a, _ in runs]], np.ones(len(units), np.float32)
        unit_out = np.empty((len(runs), WIDTH, MEMBERS), np.float32)
        unit_bias = np.empty((len(runs), MEMBERS), np.float32)
        for k, (a, b) in enumerate(runs):
            back[a:b] += inner[a:b] @ self.unit_out[found[k]].T
            np.matmul(hidden[a:b].T, inner[a:b], out=unit_out[k])
            np.matmul(one[a:b], inner[a:b], out=unit_bias[k])
        back *= 1 - hidden * hidden
        every = slice(None)
        for value, seen, rows, gradient in zip(
            (self.out, self.bias, self.unit_out, self.unit_bias), self.seen, (every, every, found, found),
            (hidden.T @ error, one @ error, unit_out, unit_bias), strict=True,
        ):
            seen[rows] += gradient * gradient
            value[rows] -= RATE * gradient / np.sqrt(seen[rows])
        for side, seen, ids in zip(self.embed, self.embed_seen, contexts, strict=True):
            order, first = _segments(ids)
            rows = ids[order][first]
            gradient = np.add.reduceat(back.take(order, axis=0), first, axis=0)
            seen[rows] += (gradient * gradient).mean(axis=1, keepdims=True)
            side[rows] -= RATE * gradient / np.sqrt(seen[rows])


def examples(texts: list[np.ndarray]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Contexts, units and text numbers, ``BATCH`` words at a time; contexts end with their text."""
    gap = np.full(SIDE, PAD, np.uint16)
    pieces, places, numbers, at = [gap], [], [], SIDE
    for n, ids in enumerate(texts):
        if len(ids):
            pieces += [ids, gap]
            places.append(np.arange(at, at + len(ids)))
            numbers.append(np.full(len(ids), n))
            at += len(ids) + SIDE
    if not places:
        return
    line, places, numbers = (np.concatenate(x) for x in (pieces, places, numbers))
    for a in range(0, len(places), BATCH):
        p = places[a:a + BATCH]
        contexts = [line[p + d] for d in (*range(-SIDE, 0), *range(1, SIDE + 1))]
        yield contexts, line[p], numbers[a:a + BATCH]


def _grouped(texts: list[np.ndarray], limit: int = 1 << 20) -> Iterator[list[np.ndarray]]:
    """The texts in groups of bounded size (or a single longer text)."""
    group, size = [], 0
    for ids in texts:
        if group and size + len(ids) > limit:
            yield group
            group, size = [], 0
        group.append(ids)
        size += len(ids)
    if group:
        yield group


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of every distinct word of all ``texts`` (text), stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> pa.RecordBatch:
            total = pc.value_counts(pa.chunked_array(held, pa.binary()))
            return pa.RecordBatch.from_arrays([total.field(0), total.field(1)], names=["word", "n"])

        held, n = [], 0
        for batch in batches:
            held.append(words_of(batch.column(0))[0])
            n += len(held[-1])
            if n > KEPT:
                yield counted()
                held, n = [], 0
        yield counted()

    return stored(texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


def vocabulary(words: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The units, and (word, share) of each word that shares its unit with others, stored.

    ``share`` is the log of the word's part of its unit. ``HEADS`` words and as
    many sums as there are other units reach the driver, whatever the data.
    """
    spark = words.sparkSession
    heads = words.orderBy(F.col("n").desc(), "word").limit(HEADS).collect()
    totals = np.zeros(UNITS)
    totals[:len(heads)] = [r["n"] for r in heads]
    listed = spark.createDataFrame([(bytes(r["word"]),) for r in heads], "word binary")
    # at most HEADS rows, so the words stay where they are
    rest = words.join(F.broadcast(listed), "word", "left_anti").withColumn(
        "unit", (HEADS + F.crc32("word") % (UNITS - HEADS)).cast("int"))
    sums = rest.groupBy("unit").agg(F.sum("n").alias("total")).collect()
    for r in sums:
        totals[r["unit"]] = r["total"]
    of_unit = spark.createDataFrame([(r["unit"], r["total"]) for r in sums], "unit int, total long")
    share = F.round(F.log(F.col("n") / F.col("total")) * NANO).cast("long")
    shares = stored(rest.join(F.broadcast(of_unit), "unit").select("word", share.alias("share")), "shares")
    return Vocabulary(Units([bytes(r["word"]) for r in heads], HEADS), totals), shares


def _trained(parameters: np.ndarray, known: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, n = Network(parameters), 0
        for batch in batches:
            words, lengths = words_of(batch.column(0))
            for group in _grouped(_by_text(in_units(words, known), lengths)):
                for contexts, units, _ in examples(group):
                    network.train(contexts, units)
                    n += len(units)
        if n:
            blocks = [b.tobytes() for b in np.array_split(network.all, BLOCKS)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(BLOCKS, TaskContext.get().partitionId(), np.int32)),
                pa.array(np.arange(BLOCKS, dtype=np.int32)), pa.array(np.full(BLOCKS, float(n))), pa.array(blocks, pa.binary()),
            ], names=["task", "block", "n", "part"])

    return run


AVERAGED = "task int, block int, n double, part binary"


def _average(table: pa.Table) -> pa.Table:
    """The mean of a block over a group of tasks, weighted by words; in order, so that reruns agree."""
    table = table.sort_by("task")
    n = table.column("n").to_numpy()
    parts = np.stack([np.frombuffer(b, np.float32) for b in table.column("part").to_pylist()])
    mean = (parts * (n / n.sum())[:, None]).sum(axis=0).astype(np.float32)
    return pa.table({
        "task": pa.array([table.column("task")[0].as_py() // FAN_IN], pa.int32()),
        "block": table.column("block").combine_chunks()[:1], "n": pa.array([n.sum()]),
        "part": pa.array([mean.tobytes()], pa.binary()),
    })


def fit(texts: DataFrame, rounds: int = ROUNDS) -> tuple[Vocabulary, DataFrame, np.ndarray]:
    """Units, shares and the parameters, trained once on every one of ``texts`` (text)."""
    ship(texts.sparkSession)
    known, shares = vocabulary(word_counts(texts))
    parameters = initial(known.totals)
    for n in range(rounds):
        share = texts.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == n)
        parts = stored(share.mapInArrow(_trained(parameters, known), AVERAGED), "parts")
        while (most := parts.agg(F.max("task").alias("m")).collect()[0]["m"]) is not None:
            parts = stored(parts.withColumn("g", F.floor(F.col("task") / FAN_IN)).groupBy("g", "block")
                           .applyInArrow(_average, AVERAGED), "parts")
            if most < FAN_IN:
                rows = sorted(parts.collect(), key=lambda r: r["block"])  # one for each block
                parameters = np.concatenate([np.frombuffer(r["part"], np.float32) for r in rows])
                break
    return known, shares, parameters


def score_units(texts: list[np.ndarray], network: Network) -> np.ndarray:
    """Summed log-probability of the units of each text."""
    sums = [np.zeros(0)]
    for group in _grouped(texts):
        total = np.zeros(len(group))
        for contexts, units, numbers in examples(group):
            total += np.bincount(numbers, network.log_probabilities(contexts, units), len(group))
        sums.append(total)
    return np.concatenate(sums)


SCORED = "n long, units double, rare array<binary>"


def _scored(texts: pa.Array, known: Vocabulary, network: Network) -> pa.StructArray:
    """For each text its length, the sum over its units, and its words that share a unit, each as often as it occurs."""
    words, lengths = words_of(texts)
    units = in_units(words, known)
    sums = np.round(score_units(_by_text(units, lengths), network), 3)  # single precision depends on the place in a batch
    shared = units >= known.units.heads
    ends = np.append(0, np.cumsum(lengths))
    starts = np.append(0, np.cumsum(shared))[ends].astype(np.int32)
    rare = pa.ListArray.from_arrays(pa.array(starts), words.filter(pa.array(shared)))
    return pa.StructArray.from_arrays([pa.array(lengths, pa.int64()), pa.array(sums), rare], names=["n", "units", "rare"])


@contextmanager
def _hash_joins(spark: SparkSession) -> Iterator[None]:
    """A shuffled join sorts neither side if all partitions of one are small enough for a hash table."""
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, HASHED)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pseudo_likelihood(
    docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, kept: tuple[str, ...] | None = None
) -> DataFrame:
    """The rows of ``docs`` with ``n_tokens``, ``log_likelihood`` and ``mean_log_likelihood``.

    ``kept`` names the columns of ``docs`` that the result has, all of them by
    default; the others, such as the text, need not be written to the scratch.

    Words are what white space separates. The model is trained on all texts of
    ``docs`` itself. Null counts as empty; an empty text has no token, a sum of
    0 and no mean. A long text is scored as a whole. Rows that repeat are scored
    alike, to a thousandth of a nat. An empty table gives an empty result. Input columns named like a
    result are replaced.
    """
    docs = without(docs, *RESULT)
    columns = docs.columns if kept is None else list(kept)
    found, row, total = fresh(docs, "found", "row", "total")
    known, shares, parameters = fit(docs.select(text_of(text_col).alias("text")), rounds)

    @F.arrow_udf(SCORED)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        network = Network(parameters)
        for batch in batches:
            yield _scored(batch, known, network)

    # stored, so that the numbers of the rows hold for both reads
    done = stored(docs.select(
        *[F.col(f"`{c}`") for c in columns], score(text_of(text_col)).alias(found),
        F.monotonically_increasing_id().alias(row)), "scored")
    shared = (
        done.select(F.col(row).alias("row"), F.explode(f"{found}.rare").alias("word")).join(shares, "word")
        .groupBy("row").agg(F.sum("share").alias("total"))
        .select(F.col("row").alias(row), F.col("total").alias(total))
    )
    with _hash_joins(docs.sparkSession):
        shared = stored(shared, "shared")
    likelihood = F.col(f"{found}.units") + F.coalesce(F.col(total), F.lit(0)) / NANO
    return done.join(shared, row, "left").select(
        *[F.col(f"`{c}`") for c in columns], F.col(f"{found}.n").alias("n_tokens"),
        likelihood.alias("log_likelihood"),
        F.when(F.col(f"{found}.n") > 0, likelihood / F.col(f"{found}.n")).alias("mean_log_likelihood"))
