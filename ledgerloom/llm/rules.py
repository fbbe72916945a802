"""Quality scores by a sparse ensemble of rules.

Statistics of the text are Spark columns. Shallow trees are grown on a bounded
sample of labelled rows; every path from a root to a node below it is a rule, a
conjunction of bounds on statistics. A logistic regression with an L1 penalty
weighs the rules and drops most of them. The rules that are left are compiled
into one column expression, so all texts are scored inside the scan, without
Python.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SEPARATORS, fresh, text_of, without
from ledgerloom.operators.tables import stored

RESULT = ("held_out", "score", "predicted")
TRAINING_ROWS = 20_000  # bound of the labelled sample
TREES, DEPTH = 24, 3
PENALTY = 0.001
SEED = 17

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, at most?, bound), all of them


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]


def statistics(text: Column) -> dict[str, Column]:
    """Name and column of each statistic; none looks at anything but the text.

    All are plain expressions in generated code, which evaluates the split of
    the text into words, lines or sentences once for all that use it.
    """
    chars = F.greatest(F.char_length(text), F.lit(1))
    words = F.split(text, SEPARATORS)
    lines = F.split(text, "\n")
    sentences = F.split(text, r"[.!?\n]+[ \n]*")

    def share(rest: Column) -> Column:
        return (F.char_length(text) - F.char_length(rest)) / chars

    return {
        "log_words": F.log1p(F.size(words).cast("double")),
        "chars_per_word": chars / F.size(words),
        # of natural texts of any length about alike, unlike the plain share of distinct words
        "variety": F.log1p(F.size(F.array_distinct(words)).cast("double")) / F.log1p(F.size(words).cast("double")),
        "distinct_sentences": F.size(F.array_distinct(sentences)) / F.size(sentences),
        "capitals": share(F.regexp_replace(text, r"\p{Lu}+", "")),
        "digits": share(F.regexp_replace(text, "[0-9]+", "")),
        "sentence_marks": share(F.regexp_replace(text, "[.,;:?]+", "")),
        "exclamations": share(F.replace(text, F.lit("!"), F.lit(""))),
        "other_marks": share(F.regexp_replace(text, r"[^\p{L}0-9\s.,;:?!'-]+", "")),
        "words_per_line": F.size(words) / F.size(lines),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
    }


def held_out(id_col: str) -> Column:
    """Rows that no label may be learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def tree_rules(description: str) -> list[Rule]:
    """The paths to all nodes of the trees in a forest's description."""
    rules: list[Rule] = []
    path: list[tuple[int, tuple[int, bool, float]]] = []
    for line in description.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)", line)
        if line.lstrip().startswith("Tree"):
            path = []
        if found:
            depth = len(found[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (int(found[2]), found[3] == "<=", float(found[4]))))
            rules.append(tuple(p[1] for p in path))
    return list(dict.fromkeys(rules))


def compiled(rule: Rule, stats: list[Column]) -> Column:
    bounds = [stats[n] <= b if below else stats[n] > b for n, below, b in rule]
    return reduce(lambda a, b: a & b, bounds).cast("double")


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """Statistics and labels of at most ``rows`` labelled documents outside the held-out third.

    Taken in order of a digest of the id, so the sample is the same in each run.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("double").alias("label"))
    known = stored(known.orderBy(F.md5(F.col("id").cast("string")), "id").limit(rows), "labelled")
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    found = texts.join(F.broadcast(known), "id")  # at most ``rows`` pairs of numbers
    stats = statistics(F.col("text"))
    return stored(found.select("id", "label", F.array(*[c.cast("double") for c in stats.values()]).alias("stats")), "training")


def fit(sample: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> Ensemble:
    """The ensemble for rows (id, label, stats); with less than two classes, a constant."""
    seen = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(seen) < 2:
        return Ensemble({0.0: -3.0, 1.0: 3.0}.get(next(iter(seen), None), 0.0), ())
    # one ordered partition of bounded size: the trees draw alike in every run
    rows = sample.repartition(1).sortWithinPartitions("id", "stats").withColumn("features", array_to_vector("stats"))
    rows = stored(rows.select("id", "label", "stats", "features"), "ordered").coalesce(1).cache()
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="onethird",
                                    minInstancesPerNode=10, labelCol="label", featuresCol="features").fit(rows)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        rows.unpersist()
        return Ensemble(0.0, ())
    n = len(statistics(F.lit("")))
    stats = [F.get("stats", F.lit(k)) for k in range(n)]
    design = rows.select("label", array_to_vector(F.array(*[compiled(r, stats) for r in rules])).alias("rules")).cache()
    lasso = LogisticRegression(labelCol="label", featuresCol="rules", elasticNetParam=1.0, regParam=penalty,
                               standardization=False, maxIter=100).fit(design)
    weights = lasso.coefficients.toArray().tolist()
    design.unpersist()
    rows.unpersist()
    return Ensemble(float(lasso.intercept), tuple((r, w) for r, w in zip(rules, weights, strict=True) if w))


def scored(docs: DataFrame, ensemble: Ensemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    docs = without(docs, *RESULT)
    (name,) = fresh(docs, "stats")
    stats = statistics(text_of(text_col))
    # a generated row, so that a filter on the score stays above the statistics and none is computed twice
    rows = docs.withColumn(name, F.struct(*[c.cast("double").alias(n) for n, c in stats.items()]))
    rows = rows.withColumn(name, F.explode(F.array(name)))
    values = [F.col(f"{name}.{n}") for n in stats]
    margin = F.lit(ensemble.intercept)
    for rule, weight in ensemble.rules:
        margin = margin + compiled(rule, values) * weight
    rows = rows.withColumn(name, margin)
    score = 1 / (1 + F.exp(-F.col(name)))
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns], held_out(id_col).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", rows: int = TRAINING_ROWS) -> DataFrame:
    """The rows of ``docs`` with ``held_out``, ``score`` (0 to 1) and ``predicted`` (0 or 1).

    Labels are read for training only, from ids whose crc32 leaves no 1 when
    divided by 3, at most ``rows`` of them. Scores depend on the text alone. A
    null text is scored as an empty one; a null id is never held out. Labels
    other than 0 and 1 are left out, and of several labels of an id the largest
    counts. Without labels all scores are 0.5; with labels of one class all
    texts are predicted to have it. An empty table gives an empty result. Input
    columns named like a result column are replaced.
    """
    return scored(docs, fit(training_sample(docs, labels, id_col, text_col, label_col, rows)), id_col, text_col)
