"""Removal of lines that several documents hold.

Normalised lines are exploded and hashed, the documents of each hash are
counted, lines over the threshold go everywhere but in the first document, and
what stays is put together again by position.

A line is known by 128 bits of hash. What crosses the shuffles is a hash and a
position for each line; texts cross one. A line that a large part of all
documents holds is counted inside each task first, and meets its decision in
as many copies as its number of uses asks for, so it fills no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, piece_rows, text_of, without
from ledgerloom.operators.tables import stored

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS = 10
DOCUMENTS = 2


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """Blanks go at both ends, A-Z become small."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def digest(value: Column) -> list[Column]:
    """128 bits in two halves, the second one of another seed."""
    return [F.xxhash64(value), F.xxhash64(F.lit(11), value)]


def _repeated(rows: DataFrame, least_chars: int, documents: int) -> DataFrame:
    """(h1, h2, uses, first) for each key that ``documents`` or more rows hold; a row counts a key once."""
    keys = F.array_distinct(F.transform(lines_of(F.col("text")), line_key))
    uses = rows.select("id", F.explode(keys).alias("line")).where(F.char_length("line") >= least_chars)
    h1, h2 = digest(F.col("line"))
    held = uses.select("id", h1.alias("h1"), h2.alias("h2")).groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("uses"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id")).alias("first"))
    return held.where(F.col("uses") >= documents)


def _dropped(rows: DataFrame, repeated: DataFrame, least_chars: int) -> DataFrame:
    """(id, t1, t2, drops) with the positions that go, for documents that lose a line."""
    total = repeated.agg(F.sum("uses")).first()[0] or 0
    piece = piece_rows(rows.sparkSession, total)
    # at most twice as many keys as there are shuffle partitions are above a piece
    hot = repeated.where(F.col("uses") > piece).select(
        "h1", "h2", F.ceil(F.col("uses") / piece).cast("int").alias("parts"))
    places = rows.select("id", "t1", "t2", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    places = places.select("id", "t1", "t2", "pos", line_key(F.col("line")).alias("line"))
    h1, h2 = digest(F.col("line"))
    places = places.where(F.char_length("line") >= least_chars).select(
        "id", "t1", "t2", "pos", h1.alias("h1"), h2.alias("h2"))
    part = F.coalesce(F.pmod(F.xxhash64("id", "t1", "pos"), F.col("parts")), F.lit(0)).cast("int").alias("part")
    places = places.join(F.broadcast(hot), ["h1", "h2"], "left").select(*places.columns, part)
    decided = repeated.select(
        "h1", "h2", F.col("first.id").alias("first"),
        F.explode(F.sequence(F.lit(0), F.ceil(F.col("uses") / piece).cast("int") - 1)).alias("part"))
    found = places.join(decided, ["h1", "h2", "part"]).where(~F.col("id").eqNullSafe(F.col("first")))
    return found.groupBy("id", "t1", "t2").agg(F.collect_set("pos").alias("drops"))


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    documents: int = DOCUMENTS,
) -> DataFrame:
    """``docs`` with the text that stays, and ``n_lines`` and ``n_dropped``.

    Lines end at ``\\n``. Lines are the same where their keys are: blanks at
    both ends gone, A-Z small. A key of ``least_chars`` code points or more that
    ``documents`` or more rows hold loses its lines everywhere but in the
    document with the smallest id, where all of them stay. Shorter keys, blank
    lines among them, always stay.

    A null text counts as empty: one empty line, and an empty text stays. A null
    id comes after all others. Rows that share an id are one document when lines
    are dropped, so the rows with the smallest id all keep theirs; each row is
    put together on its own, and rows that repeat give rows that repeat. A text
    that loses all lines becomes empty. Long texts are taken whole. An empty
    table gives an empty result. Columns called like a result column are
    replaced, others are kept, whatever their names.
    """
    rest = without(docs, "n_lines", "n_dropped")
    k1, k2, k_id, g1, g2, lines, drops = fresh(rest, "t1", "t2", "id", "g1", "g2", "lines", "drops")
    t1, t2 = digest(text_of(text_col))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"), t1.alias("t1"), t2.alias("t2"))
    repeated = stored(_repeated(rows, least_chars, documents), "lines")
    gone = _dropped(rows, repeated, least_chars).select(
        F.col("id").alias(k_id), F.col("t1").alias(g1), F.col("t2").alias(g2), F.col("drops").alias(drops))

    others = [F.col(f"`{c}`") for c in rest.columns if c.lower() != text_col.lower()]
    cut = rest.select(*others, lines_of(text_of(text_col)).alias(lines), t1.alias(k1), t2.alias(k2))
    same = (cut[k1] == gone[g1]) & (cut[k2] == gone[g2]) & cut[id_col].eqNullSafe(gone[k_id])
    both = cut.join(gone, same, "left")
    n_lines = F.size(lines)
    stay = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col(drops))
    kept = F.when(F.col(drops).isNull(), F.array_join(lines, "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col(lines), i)), "\n"))
    out = [kept.alias(c) if c.lower() == text_col.lower() else F.col(f"`{c}`") for c in rest.columns]
    return both.select(
        *out, n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size(drops), F.lit(0)).cast("long").alias("n_dropped"))
