"""What the operators share: table access, column names, words, and sizes of pieces."""

from __future__ import annotations

import math
import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed by the contracts: what separates words, and what a word is.
SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Bounds of a batch that goes to a Python worker.
BATCH_BYTES = str(8 << 20)
BATCH_ROWS = "2000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without its columns of these names: a result column replaces an input one."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def text_of(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def squeezed(text: Column) -> Column:
    """The text without separators."""
    return F.regexp_replace(text, SEPARATORS, "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def piece_rows(spark: SparkSession, total: int) -> int:
    """Rows of one piece of a hot key: at most twice as many pieces as shuffle partitions are full.

    So a list of the keys that need more than one piece has at most twice as
    many entries as there are shuffle partitions, whatever the data.
    """
    return max(1, math.ceil(total / (2 * partitions(spark))))


@cache
def _shipped(application: str, context: SparkContext) -> None:
    package = Path(__file__).parents[1]
    target = Path(tempfile.mkdtemp()) / "ledgerloom_modules.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may not have it on their path.

    Also bounds what is handed to them at once: texts differ in length by orders
    of magnitude, so a batch is bounded in bytes and not only in rows.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    _shipped(spark.sparkContext.applicationId, spark.sparkContext)
