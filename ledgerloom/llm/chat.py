"""Chat formatting in budgeted windows.

A conversation becomes windows of whole turns. Prefix sums of turn tokens
choose them: a turn belongs to the window in whose range of the prefix sum it
begins, and a last turn that would pass the budget gets a window of its own.
Every window starts with the system turn and repeats as much of the history
before it as its allowance holds; only new assistant turns are under the loss
mask, so each is a target once.

Prefix sums are taken inside pieces of a conversation and over the pieces, and
windows are put together by conversation and window, so one very long
conversation is spread over tasks like many short ones. Only reading all of a
conversation back in order goes through one task, as a stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import ship, word_count
from ledgerloom.operators.tables import stored

START, END = "<|im_start|>", "<|im_end|>"
BUDGET = 1024  # tokens of a window: words, and OVERHEAD for each turn
HISTORY = 192
OVERHEAD = 4
PIECE_TURNS = 256


def escaped(text: Column) -> Column:
    """Text in which no control string can begin: one mark more between ``<`` and ``|``."""
    return F.regexp_replace(text, r"<(!*)\|", r"<!$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape(text: str) -> str:
    return re.sub(r"<!(!*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted window."""
    turns, at = [], 0
    while at < len(formatted):
        head = formatted.index("\n", at)
        end = formatted.index(END, head)
        turns.append((unescape_role(formatted[at + len(START):head]), unescape(formatted[head + 1:end])))
        at = end + len(END) + 1
    return turns


def _numbered(turns: DataFrame, id_col: str) -> DataFrame:
    """Rows (conv, id, n, role, text, tokens, before): place and tokens before it in its conversation."""
    rows = turns.select(
        F.when(F.col(id_col).isNull(), "n").otherwise(F.concat(F.lit("c"), F.col(id_col).cast("string"))).alias("conv"),
        F.col(id_col).alias("id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", word_count(F.col("text")) + OVERHEAD)
    rows = rows.withColumn("piece", F.coalesce(F.floor(F.col("turn") / PIECE_TURNS), F.lit(-(1 << 60))))
    sums = rows.groupBy("conv", "piece").agg(F.count("*").alias("rows"), F.sum("tokens").alias("words"))
    earlier = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "conv", "piece", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words_before"))
    rows = rows.join(sums, ["conv", "piece"])
    order = Window.partitionBy("conv", "piece").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    inside = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "conv", "id", "role", "text", "tokens",
        (F.row_number().over(order) - 1 + F.col("rows_before")).alias("n"),
        (F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("words_before")).alias("before"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, id_col: str = "conv_id") -> DataFrame:
    """(id, window, formatted, loss, repeated, tokens): a row for each window, numbered by place.

    ``loss`` has the character ranges [from, to) under the mask, and ``repeated``
    says how many turns at the front were given before. A window holds at most
    ``budget`` tokens unless its system turn takes more than three quarters of
    what the history leaves, or its only new turn is longer. The system turn is
    the first turn, if it has that role. ``history`` is at most a quarter of the
    budget.

    Turns are in order of ``turn``, nulls first; of the same number in order of
    role and text. A null role or text is empty, an empty text a turn like
    others; null ids are one conversation; rows that repeat are turns that
    repeat. An empty table gives an empty result; other columns are ignored.
    """
    if not 0 <= 4 * history <= budget:
        raise ValueError("the history takes at most a quarter of the budget")
    rows = stored(_numbered(turns, id_col), "turns")
    # windows are chosen on rows without text
    narrow = rows.select("conv", "n", "role", "tokens", "before")
    system = narrow.filter((F.col("n") == 0) & (F.col("role") == "system")).select(
        "conv", F.col("tokens").alias("s_tokens"))
    body = narrow.join(system, "conv", "left").withColumn("s_tokens", F.coalesce("s_tokens", F.lit(0).cast("long")))
    only_system = body.filter((F.col("n") == 0) & (F.col("s_tokens") > 0))
    body = body.filter((F.col("n") > 0) | (F.col("s_tokens") == 0)).withColumns({
        "before": F.col("before") - F.col("s_tokens"),
        "span": F.greatest(F.lit(budget - history) - F.col("s_tokens"), F.lit(budget // 4).cast("long")),
    })
    body = body.withColumn("k", F.floor(F.col("before") / F.col("span")))
    of_range = Window.partitionBy("conv", "k")
    first = F.min("before").over(of_range)
    late = (F.col("before") > first) & (F.col("before") + F.col("tokens") - first > F.col("span"))
    body = stored(body.withColumn("w", 2 * F.col("k") + late.cast("long")), "body")

    begins = body.groupBy("conv", "w").agg(F.min("before").alias("begin"))
    # a turn can be history of the next windows only, because span >= budget / 4 >= history
    later = body.withColumn("w", F.explode(F.sequence(F.col("w") + 1, 2 * F.col("k") + 3)))
    later = later.join(begins, ["conv", "w"]).filter(
        (F.col("begin") > F.col("before")) & (F.col("begin") - F.col("before") <= history))
    first_turn = F.lit(0).cast("long").alias("n")
    head = begins.join(system, "conv").select("conv", "w", first_turn, (F.col("begin") > 0).alias("again"))
    parts = body.select("conv", "w", "n", F.lit(False).alias("again")).unionByName(
        later.select("conv", "w", "n", F.lit(True).alias("again"))).unionByName(head)
    # a conversation of a system turn alone
    lone = only_system.join(begins.select("conv").distinct(), "conv", "left_anti").select(
        "conv", F.lit(0).cast("long").alias("w"), "n", F.lit(False).alias("again"))
    parts = parts.unionByName(lone).join(rows.select("conv", "n", "id", "role", "text", "tokens"), ["conv", "n"])

    parts = parts.withColumns({"text": escaped(F.col("text")), "head": F.concat(
        F.lit(START), escaped_role(F.col("role")), F.lit("\n"))})
    parts = parts.withColumn("part", F.concat("head", "text", F.lit(END + "\n")))
    sofar = Window.partitionBy("conv", "w").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.char_length("part")).over(sofar), F.lit(0)) + F.char_length("head")
    parts = parts.withColumn("mask", F.when(
        (F.col("role") == "assistant") & ~F.col("again"), F.array(begin, begin + F.char_length("text"))))
    done = parts.groupBy("conv", "w").agg(
        F.array_sort(F.collect_list(F.struct("n", "part"))).alias("parts"),
        F.array_sort(F.collect_list("mask")).alias("loss"),
        F.sum(F.col("again").cast("int")).alias("repeated"), F.sum("tokens").alias("tokens"),
        F.first("id").alias(id_col))
    return done.select(
        id_col, F.col("w").alias("window"), F.array_join("parts.part", "").alias("formatted"), "loss", "repeated", "tokens")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest rows of conversations whose windows come in order."""
    now, state = None, None

    def row() -> pa.RecordBatch:
        n, turns, chars, loss, formatted, conv = state
        return pa.RecordBatch.from_arrays([
            pa.array([conv], pa.int64()), pa.array([n], pa.int64()), pa.array([turns.hexdigest()]),
            pa.array([chars], pa.int64()), pa.array([loss.hexdigest()]), pa.array([formatted], pa.int64()),
        ], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for batch in batches:
        for key, conv, formatted, loss, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != now:
                if state is not None:
                    yield row()
                now, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, conv]
            for role, text in parse(formatted)[repeated:]:
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            for a, b in loss:
                text = unescape(formatted[a:b])
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += len(formatted)
    if state is not None:
        yield row()


def digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the windows of each conversation hold, read back from the formatted text and the mask."""
    ship(formatted.sparkSession)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("key")
    rows = formatted.select(key, F.col(id_col).alias("conv"), "window", "formatted", "loss", "repeated")
    rows = rows.repartition("key").sortWithinPartitions("key", "window")
    return rows.select("key", "conv", "formatted", "loss", "repeated").mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
