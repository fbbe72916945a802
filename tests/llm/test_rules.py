import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import rules
from ledgerloom.llm.common import table

SF_DIR = "/root/testdata/sf0.01"


def frames(spark, n=400):
    random.seed(1)
    docs, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        words = [random.choice(["river", "stone", "walks", "under", "light", "seven"]) + str(random.randint(0, 9) if not good else "")
                 for _ in range(random.randint(5, 60))]
        docs.append((i, " ".join(words) + ("." if good else " ### $$$")))
        labels.append((i, int(good)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_learns_and_uses_text_alone(spark):
    docs, labels = frames(spark)
    found = {r.doc_id: r for r in rules.quality_scores(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    wrong = sum(r.predicted != int(i % 3 != 0) for i, r in found.items() if r.held_out)
    assert wrong <= 0.05 * len(found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    # labels of held-out rows have no influence
    changed = labels.withColumn("quality", F.when(rules.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in rules.quality_scores(docs, changed).collect()}
    assert again == {i: r.score for i, r in found.items()}


def test_compiled_scores_are_the_model(spark):
    docs, labels = frames(spark, 200)
    sample = rules.training_sample(docs, labels, "doc_id", "text", "quality", 1000)
    model = rules.fit(sample)
    assert model.rules
    stats = {r.id: r.stats for r in sample.collect()}
    scores = {r.doc_id: r.score for r in rules.scored(docs, model).collect()}
    for i, values in stats.items():
        margin = model.intercept + sum(
            w for rule, w in model.rules if all((values[n] <= b) if below else (values[n] > b) for n, below, b in rule))
        assert scores[i] == pytest.approx(1 / (1 + 2.718281828459045 ** -margin))


def test_tree_paths():
    text = """Forest
  Tree 0 (weight 1.0):
    If (feature 3 <= 0.5)
     If (feature 1 <= 4.25E-4)
      Predict: 0.0
     Else (feature 1 > 4.25E-4)
      Predict: 1.0
    Else (feature 3 > 0.5)
     Predict: 0.0
  Tree 1 (weight 1.0):
    Predict: 1.0
"""
    assert rules.tree_rules(text) == [
        ((3, True, 0.5),), ((3, True, 0.5), (1, True, 4.25e-4)), ((3, True, 0.5), (1, False, 4.25e-4)), ((3, False, 0.5),)]


def test_the_sample_is_bounded(spark):
    docs, labels = frames(spark, 200)
    sample = rules.training_sample(docs, labels, "doc_id", "text", "quality", 30).collect()
    assert len(sample) == 30 and all(zlib.crc32(str(r.id).encode()) % 3 != 1 for r in sample)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (None, "x", "c"), (3, "word " * 50000, "d"), (3, "word", "e")],
        "doc_id long, text string, score string")
    _, labels = frames(spark, 10)
    none = rules.quality_scores(docs, labels.limit(0))
    assert none.columns == ["doc_id", "text", "held_out", "score", "predicted"]
    assert [r.score for r in none.collect()] == [0.5] * 5
    one = rules.quality_scores(docs, spark.createDataFrame([(3, 1), (2, None), (None, 0)], "doc_id long, quality int"))
    assert {r.predicted for r in one.collect()} == {1}
    assert rules.quality_scores(docs.limit(0), labels).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    found = rules.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out")
    right = found.filter("predicted = quality").count()
    assert right >= 0.97 * found.count()
