"""The training corpus: ``documents`` through five stages, each stored before the next one reads it.

Every stage takes the rows its predecessor kept, any number of them, and all but
the last return their columns unchanged, also where a column is called like one
that the stage computes with. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, fair_mix, packing, rules, simhash
from ledgerloom.llm.common import table
from ledgerloom.operators.tables import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

USED = ("doc_id", "text", "source")


def _through(docs: DataFrame, decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``decide`` keeps; columns it does not use are out of its sight."""
    others = [c for c in docs.columns if c not in USED]
    if not others:
        return decide(docs).select(*docs.columns)
    nested = docs.select(*USED, F.struct(*[F.col(f"`{c}`") for c in others]).alias("others"))
    return decide(nested).select(
        *[F.col(c) if c in USED else F.col(f"others.`{c}`").alias(c) for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rule ensemble takes for good.

    It learns from the labelled rows among ``docs``. A null text is scored as an
    empty one, a long text as a whole; rows that repeat are kept or go together.
    """
    labels = table(spark, sf_dir, "labels")
    return _through(docs, lambda rows: rules.quality_scores(rows, labels).filter("predicted = 1"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, blanks aside: the longest, then the smallest id.

    Null texts are equal to empty ones. Of rows that repeat one stays; null ids
    come last.
    """
    return _through(docs, lambda rows: exact_dedup.exact_dedup(rows).filter("kept"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links join: the one with the smallest id.

    Shingles and radius are those of query op7. Texts without a word share a
    fingerprint, so one of them stays. Null ids come last.
    """
    return _through(docs, lambda rows: simhash.near_dedup(rows, radius=2))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them, in order of virtual finish time.

    A null source is a source, the last one. Empty texts cost nothing.
    """
    return _through(docs, lambda rows: fair_mix.in_mix_order(fair_mix.fair_mix(rows)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in bins; long ones are cut into pieces that fill bins.

    Empty texts have a place of size 0. Every repetition has a place of its own.
    """
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# the classifier and the packing have no SQL form; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
