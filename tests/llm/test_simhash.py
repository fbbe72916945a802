import random

import numpy as np
import xxhash

from ledgerloom.llm import simhash
from ledgerloom.llm.components import components


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closed(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(i) for i in range(n)]


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = closed(len(rows), pairs)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted([(i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, roots, strict=True)], key=repr)


def sample():
    random.seed(5)
    words = [f"w{i}" for i in range(60)] + ["É", "Été", "A", "b"]
    rows = [(i, " ".join(random.choices(words, k=random.choice([1, 2, 3, 30, 200])))) for i in range(60)]
    for i in range(40):
        base = rows[i][1].split()
        base[random.randrange(len(base))] = "changed"
        rows.append((200 + i, " ".join(base)))
    return rows + [(300, None), (301, ""), (302, " \n"), (303, rows[3][1].upper()), (304, rows[4][1]), (304, rows[4][1]),
                   (None, rows[5][1]), (None, "alone here"), (305, "x y z " * 40000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", "d") for i, t in rows], "doc_id long, text string, key string, fp string")


def test_against_brute_force(spark):
    rows = sample()
    found = simhash.simhash_groups(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_long_texts_are_hashed_in_slices(monkeypatch):
    text = "a b c d e f " * 50
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert simhash.fingerprint(text) == whole


def test_one_of_each_group_stays(spark):
    rows = sample()
    df = frame(spark, rows)
    kept = simhash.near_dedup(df)
    assert kept.columns == df.columns
    groups = {c for _, _, c in brute(rows) if c is not None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(groups)


def test_empty_table(spark):
    assert simhash.simhash_groups(frame(spark, [])).collect() == []
    assert simhash.near_dedup(frame(spark, [])).collect() == []


def test_divided_tiles_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40)
    values = {int(b) ^ (1 << int(x)) ^ (1 << int(y)) for b in base for x, y in rng.integers(0, 60, (12, 2))}
    values |= {-1, 0, 1, -(2**63), 3}
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    order = sorted(values)
    unsigned = np.array(order, np.int64).view(np.uint64)
    near = np.bitwise_count(unsigned[:, None] ^ unsigned[None, :]) <= 2
    expected = closed(len(order), zip(*np.nonzero(np.triu(near, 1)), strict=True))
    place = {v: i for i, v in enumerate(order)}
    for tile, blocks in ((8192, 4), (3, 4), (2, 2)):
        links = simhash.near_links(prints, tile=tile, blocks=blocks).collect()
        assert closed(len(order), [(place[r.a], place[r.b]) for r in links]) == expected


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500 + i, 500) for i in range(1, 80)] + [(900, 900)]
    found = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {(i, 0) for i in range(1, 201)} | {(500 + i, 500) for i in range(1, 80)}
