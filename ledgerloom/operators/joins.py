"""Joins whose plain form would leave a hot task or a nested loop behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _slots(df: DataFrame) -> int:
    """Null keys are dealt into slots, so many for each shuffle partition that the partitions come out even."""
    return 64 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _spread(df: DataFrame, key: str, by: list[str], mark: str = "?") -> Column:
    """The join key as text, with nulls spread over slots that match nothing.

    A null key matches no row, yet all null keys would hash to one task. Real
    keys start with ``=`` and slots with another mark, so a slot can never meet
    a key. The text is never null, which spares the join its null filter.
    """
    slot = F.pmod(F.xxhash64(*by), F.lit(_slots(df))).cast("string")
    real = F.concat(F.lit("="), F.col(key).cast("string"))
    return F.coalesce(real, F.concat(F.lit(mark), slot), F.lit(mark))


def left_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: list[str],
    also: list[str] | None = None,
    how: str = "left",
) -> DataFrame:
    """Left join (or left anti join) on ``key`` that tolerates many null keys.

    ``also`` names further equality columns. Both sides call the columns alike
    and ``lookup`` gives no other column that ``facts`` has. A hot value in
    ``facts``, or many null keys with the same ``spread_by``, is split by
    adaptive skew handling, which may split the preserved side of these joins.
    """
    also = also or []
    left = facts.withColumn("_join_key", _spread(facts, key, spread_by))
    right = lookup.withColumn(
        "_join_key", F.concat(F.lit("="), F.col(key).cast("string"))
    ).drop(key)
    return left.join(right, ["_join_key", *also], how).select(
        *facts.columns,
        *([] if how == "left_anti" else [c for c in lookup.columns if c not in (key, *also)]),
    )


def member_lookup(facts: DataFrame, dim: DataFrame, key: str, unknown: int) -> DataFrame:
    """Inner join on a surrogate key that many facts share, that of the unknown member.

    Its one row goes to the facts that point at it, which are read once more but
    not shuffled; only the others are joined by key.
    """
    known = facts.where(F.col(key) != unknown).join(dim.where(F.col(key) != unknown), key)
    return known.unionByName(
        facts.where(F.col(key) == unknown).join(F.broadcast(dim.where(F.col(key) == unknown)), key))


def full_outer_on_key(
    left: DataFrame, right: DataFrame, key: str, left_id: list[str], right_id: list[str]
) -> DataFrame:
    """Full outer join on one key, as a left join plus an anti join.

    Neither side of a full outer join may be split, so one hot key would stay in
    one task. Here ``right`` is the preserved side of a left join and ``left``
    of an anti join against the distinct keys of ``right``: both may be split,
    and the distinct collapses a hot key before its shuffle. Null keys match
    nothing and are all kept: each side's slots carry its own mark.

    Both joins take the same shuffle of ``left``, which Spark then runs once. A
    constant column would differ between them; derive it after the join.
    """
    keyed_left = left.withColumn("_join_key", _spread(left, key, left_id, "<")).drop(key)
    keyed_right = right.withColumn("_join_key", _spread(right, key, right_id, ">")).drop(key)
    seen = right.where(F.col(key).isNotNull()).select(
        F.concat(F.lit("="), F.col(key).cast("string")).alias("_join_key")
    )
    joined = keyed_right.join(keyed_left, "_join_key", "left")
    left_only = keyed_left.join(seen.distinct(), "_join_key", "left_anti")
    return joined.unionByName(left_only, allowMissingColumns=True).drop("_join_key")


def natural_id_bridge(dim: DataFrame, sk: str, sources: dict[str, str]) -> DataFrame:
    """``(source_system, natural_id, sk)`` rows from one dimension row per source.

    ``sources`` maps a source system to the dimension column that holds its id.
    With the bridge, "match by this column for that source" is one equality
    join; as a disjunction Spark could only run it as a nested loop.
    """
    pairs = [
        F.struct(F.lit(source).alias("source_system"), F.col(column).alias("natural_id"))
        for source, column in sources.items()
    ]
    return (
        dim.select(sk, F.explode(F.array(*pairs)).alias("_id"))
        .select("_id.source_system", "_id.natural_id", sk)
        .where(F.col("natural_id").isNotNull())
    )


def natural_id(sources: dict[str, str]) -> Column:
    """The id column that counts for the row's source system; null for other sources."""
    column = F.lit(None).cast("string")
    for source, name in sources.items():
        column = F.when(F.col("source_system") == source, F.col(name)).otherwise(column)
    return column


def with_constant_match(
    facts: DataFrame, dim: DataFrame, condition: Column, key: str
) -> DataFrame:
    """Left join of every fact row to the one dimension row that meets a constant condition.

    No join is needed: the key is a scalar subquery, null where no row meets the
    condition. Several rows would multiply every fact, so they fail the job.
    """
    several = F.raise_error(F.lit(f"several rows give a {key} for every fact"))
    one = F.when(F.count(F.lit(1)) > 1, several.cast(dim.schema[key].dataType)).otherwise(F.max(key))
    return facts.withColumn(key, dim.where(condition).agg(one).scalar())


def as_of_lookup(
    facts: DataFrame, versions: DataFrame, key: str, at: str, since: str, until: str, order: list[str],
    spread_by: list[str],
) -> DataFrame:
    """Left join of each fact to the version of its member that was in force at the time ``at``.

    A version holds from ``since`` until ``until`` or the next version of the
    member begins; of versions that begin together the last one in ``order``
    counts. Facts without key or time, and those at a time without a version,
    get nulls. All columns of ``versions`` but the key are added.

    Time is cut into months. Per member and month with facts, one row stands
    among the member's versions in order of time and takes the last one along:
    that one and those that begin inside the month are all that facts of the
    month can meet. Facts are then joined by member and month, whose rows
    adaptive skew handling may split, so neither a hot member nor one with a
    long history meets in one task; only versions and months are sorted.
    """
    begins, ends = F.col(since).cast("timestamp"), F.col(until).cast("timestamp")
    line = Window.partitionBy(key).orderBy("_since", *[F.col(c).asc_nulls_first() for c in order])
    names = [c for c in versions.columns if c != key]
    spans = versions.where(F.col(key).isNotNull() & F.col(since).isNotNull()).select(
        key, begins.alias("_since"), ends.alias("_until"), *order, F.struct(*names).alias("_version")
    )
    spans = spans.withColumn("_until", F.least("_until", F.lead("_since").over(line)))
    spans = spans.where(F.col("_until").isNull() | (F.col("_since") < F.col("_until")))
    spans = spans.select(key, F.struct("_since", "_until", "_version").alias("_span"))

    def month(column: str | Column) -> Column:
        return F.date_trunc("month", column).alias("_month")

    dated = facts.withColumn("_at", F.col(at).cast("timestamp"))
    months = dated.where(F.col(key).isNotNull() & F.col("_at").isNotNull()).select(key, month("_at")).distinct()
    marks = months.select(key, F.col("_month").alias("_time"), "_month")
    starts = spans.select(key, F.col("_span._since").alias("_time"), "_span")
    # a version that begins with the month comes before the month's row
    course = Window.partitionBy(key).orderBy("_time", F.col("_month").isNotNull())
    carried = starts.unionByName(marks, allowMissingColumns=True)
    carried = carried.withColumn("_span", F.last("_span", ignorenulls=True).over(course)).where("_month is not null")
    carried = carried.where("_span._until is null or _span._until > _month").select(key, "_month", "_span")
    inside = spans.select(key, month("_span._since"), "_span").where("_span._since > _month")
    inside = inside.join(months, [key, "_month"], "left_semi")

    met = carried.where("_span is not null").unionByName(inside).select(
        F.concat(F.lit("="), F.col(key).cast("string")).alias("_held_key"), F.col("_month").alias("_held_month"), "_span"
    )
    left = dated.withColumn("_month", month("_at")).withColumn("_join_key", _spread(facts, key, spread_by))
    same = (F.col("_join_key") == F.col("_held_key")) & (F.col("_month") == F.col("_held_month"))
    then = (F.col("_at") >= F.col("_span._since")) & (
        F.col("_span._until").isNull() | (F.col("_at") < F.col("_span._until")))
    return left.join(met, same & then, "left").select(*facts.columns, *[f"_span._version.{c}" for c in names])
