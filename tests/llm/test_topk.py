import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import topk


def brute(rows, k=5):
    clean = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in clean if i % 50 == 0}):
        vector = min(tuple(v) for i, v in clean if i == q)
        scores = sorted((-int(np.dot(vector, v)), i) for i, v in clean if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, id int")
    return sorted(map(tuple, topk.search(df, F.col("id") % 50 == 0, **options).collect()))


def sample(n=400, dims=8):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, dims)]) for i in range(n)]
    rows += [(500, rows[0][1]), (501, rows[1][1]), (501, rows[1][1]), (550, rows[1][1]), (600, [0.0] * dims)]
    return rows + [(602, None), (603, [None] + [0.1] * (dims - 1)), (650, [float("nan")] * dims),
                   (604, [float("inf")] * dims), (None, rows[2][1])]


@pytest.mark.parametrize("options", [{}, {"bits": 1}, {"bits": 8, "query_block": 3}])
def test_against_brute_force(spark, options):
    assert run(spark, sample(), **options) == brute(sample())


def test_few_candidates_and_none(spark):
    rows = [(0, [0.5, -0.5]), (1, [0.25, 0.5])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[1:]) == []
    assert run(spark, []) == []
    assert run(spark, [(0, [0.5])]) == []


def test_empty_vectors_and_those_of_another_length_take_no_part(spark):
    rows = sample()
    odd = [(0, []), (700, []), (701, [9.0]), (750, [9.0] * 16), (702, [9.0] * 9)]
    assert run(spark, rows + odd) == brute(rows)
    assert run(spark, [(0, []), (1, [])]) == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-300, 300, (50, 6)), rng.integers(-300, 300, (9, 6))
    low, high = x.min(axis=0), x.max(axis=0)
    for bits in (1, 4, 8):
        step = topk._steps(low, high, bits)
        cells = ((x - low) // step).astype(np.uint8)
        block = topk.Bounds(q, low, step)
        exact = x @ q.T
        assert (block.of(cells) + block.down <= exact).all() and (block.of(cells) + block.up >= exact).all()
