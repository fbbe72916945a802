import hashlib
import random
from collections import Counter

import pytest

from ledgerloom.llm import suffix_dedup as sd


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[s:s + length] for _, d in data for s in range(len(d) - length + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if seen[d[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(d)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, k1 string, spans int")
    found = sd.suffix_dedup(df, **options)
    assert found.columns == ["doc_id", "text", "k1", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()], key=repr)


def sample(seed, n=120):
    random.seed(seed)

    def noise(k):
        return "".join(random.choice("abcdeé ") for _ in range(k))

    passages = [noise(random.randint(20, 120)) for _ in range(10)]
    rows = []
    for i in range(n):
        parts = [random.choice([noise(random.randint(0, 40)), random.choice(passages),
                                random.choice(passages)[random.randint(0, 20):]]) for _ in range(random.randint(0, 8))]
        rows.append((i, "".join(parts)))
    return rows + [(900, None), (901, ""), (902, "a" * 300), (902, "a" * 300), (None, rows[5][1]),
                   (903, "ab" * 200 + "c" * 10), (904, rows[7][1]), (904, rows[7][1])]


@pytest.mark.parametrize("options", [
    {"length": 40, "seed": 12}, {"length": 40, "seed": 39}, {"length": 40, "seed": 8, "hot": 3}])
def test_against_brute_force(spark, options):
    rows = sample(3)
    assert run(spark, rows, **options) == brute(rows, 40)


def test_small_runs_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(sd, "RANGE_ROWS", 5)
    rows = sample(8, 40)
    assert run(spark, rows, length=40, seed=12) == brute(rows, 40)


def test_texts_longer_than_the_buffer(spark):
    random.seed(2)
    text = "".join(random.choice("abcdefgh ") for _ in range(700_000))
    rows = [(1, text), (2, text[523_000:525_000]), (3, text[-450:]), (4, text[:400]), (5, text[1:400])]
    expected = {1: 2000 + 450 + 400, 2: 2000, 3: 450, 4: 400, 5: 0}
    assert {r[0]: r[2] for r in run(spark, rows)} == expected


def test_nothing_repeats_and_empty_table(spark):
    assert run(spark, []) == []
    assert [r[2] for r in run(spark, [(1, "x" * 399), (2, "x" * 399)])] == [0, 0]


def test_merge_keeps_order_and_prefixes():
    random.seed(9)
    blocks, everything = [], []
    for _ in range(7):
        current = sd.Run(40, 12, 1)
        for k in range(random.randint(0, 60)):
            data = bytes(random.choices(b"ab", k=80))
            current.add(data, 1, 2, 10 + k % 5)
        everything += [e[0] for e in {(e[0], e[1]): e for e in current.entries}.values()]
        for block in current.blocks():
            packed = {n: b"".join(v) if kind is None else sd.np.array(v, kind).tobytes()
                      for n, v, kind in zip(sd.BLOCK, block[1:], sd.KINDS, strict=True)}
            blocks.append(sd.Stream(packed))
    before, out = b"", []
    for shared, suffix, _, _ in sd.merge(blocks):
        if out:
            assert shared == sd.common(before, suffix)
        before = suffix
        out.append(suffix)
    assert out == sorted(everything)
