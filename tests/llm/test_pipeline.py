import os

import pytest

import corpus_pipeline
import test_exact_dedup
import test_fair_mix
import test_packing
import test_simhash
from ledgerloom.llm import rules
from ledgerloom.llm.common import table
from ledgerloom.operators.tables import stored

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_order_of_the_stages():
    assert list(STAGES) == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_each_stage_on_its_own_input(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns

    kept = stored(STAGES["quality"](spark, docs, SF_DIR), "t")
    assert kept.columns == columns
    scores = {r.doc_id: r.predicted for r in rules.quality_scores(docs, table(spark, SF_DIR, "labels")).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, p in scores.items() if p == 1)

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    unique = stored(STAGES["exact_dedup"](spark, kept, SF_DIR), "t")
    assert unique.columns == columns
    assert sorted(r.doc_id for r in unique.collect()) == sorted(r[0] for r in test_exact_dedup.brute(rows) if r[3])

    rows = [(r.doc_id, r.text) for r in unique.collect()]
    single = stored(STAGES["near_dedup"](spark, unique, SF_DIR), "t")
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted({r[2] for r in test_simhash.brute(rows)})

    rows = [(r.doc_id, r.text, r.source) for r in single.collect()]
    mixed = stored(STAGES["mixing"](spark, single, SF_DIR), "t")
    assert mixed.columns == columns
    expected = [r[0] for r, b in zip(rows, test_fair_mix.brute(rows), strict=True) for _ in range(b[3])]
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(expected)

    packed = STAGES["packing"](spark, mixed, SF_DIR).collect()
    total = sum(len(r.text.split()) for r in mixed.collect())
    assert sum(r.size for r in packed) == total


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    assert test_packing  # its brute force holds the last stage


NULLS = [
    (None, None, None, None, None), (None, "", "a", "en", 1), (1, None, "a", None, 2), (2, " \n", None, "en", None),
    (3, "the same words stand here twice", "a", "en", 3), (3, "the same words stand here twice", "a", "en", 3),
    (4, "long words " * 20_000, "b", "de", 4), (5, "short", "b", "de", 5),
]


@pytest.mark.parametrize("name", ["quality", "exact_dedup", "near_dedup", "mixing"])
def test_nulls_repeats_and_clashing_columns(spark, name):
    schema = "doc_id long, text string, source string, size string, n_chars int, kept string, finish string, predicted int, Score int"
    docs = spark.createDataFrame([(i, t, s, x, n, "k", "f", -1, n) for i, t, s, x, n in NULLS], schema)
    out = STAGES[name](spark, docs, SF_DIR)
    assert out.columns == docs.columns
    given = {tuple(r) for r in docs.collect()}
    kept = [tuple(r) for r in out.collect()]
    assert set(kept) <= given
    if name == "exact_dedup":
        assert sorted(r[0] for r in kept) == [2, 3, 4, 5]
    empty = STAGES[name](spark, docs.limit(0), SF_DIR)
    assert empty.columns == docs.columns and empty.count() == 0


def test_packing_of_nulls_and_of_nothing(spark):
    docs = spark.createDataFrame(NULLS, "doc_id long, text string, source string, lang string, bin int")
    packed = STAGES["packing"](spark, docs, SF_DIR).collect()
    assert sum(r.size for r in packed) == sum(len((r[1] or "").split()) for r in NULLS)
    assert STAGES["packing"](spark, docs.limit(0), SF_DIR).count() == 0
