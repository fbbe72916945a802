import random
import re
from collections import Counter

import pytest

from ledgerloom.llm import divergence

SCHEMA = "lang string, source string, text string, h1 int, Item string, doc_id long"
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    rows = [tuple(v or "" for v in r) for r in rows]
    out = []
    for lang in {r[0] for r in rows}:
        counts, held = {}, Counter()
        for _, source, text in (r for r in rows if r[0] == lang):
            words = Counter(re.findall(divergence.TERM, text.translate(SMALL)))
            counts.setdefault(source, Counter()).update(words)
            held.update(words.keys())
        kept = [t for t, n in held.items() if n >= least]
        whole = Counter()
        for found in counts.values():
            whole.update(found)

        def shares(found):
            total = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(whole)
        p = {source: shares(found) for source, found in counts.items()}
        for a in counts:
            pairs = [(-sum(abs(p[a][t] - p[b][t]) for t in kept), b.encode(), b) for b in counts if b != a]
            terms = [(q[t] - p[a][t], t.encode(), t) for t in kept if counts[a][t] and p[a][t] > q[t]]
            out += [(lang, a, "pair", item, -v, n + 1) for n, (v, _, item) in enumerate(sorted(pairs))]
            out += [(lang, a, "term", item, -v, n + 1) for n, (v, _, item) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def run(spark, rows, least=3, top=4):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    found = divergence.divergence(df, least_docs=least, top=top)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


def corpus(seed, sources=6, docs=150):
    random.seed(seed)
    words = ["Über", "ÜBER", "naïve", "the", "The", "THE", "a1b", "x-y", "日本", "\U0001f600", "z"] + [f"w{c}" for c in "abcdefghijkl"]
    rows = []
    for _ in range(docs):
        source = random.choice([None, ""] + [f"s{i}" for i in range(sources)])
        start = random.randint(0, 15)
        text = " ".join(random.choices(words[start:], k=random.randint(0, 12)))
        rows += [(random.choice([None, "en", "de"]), source, text)] * random.choice([1, 1, 1, 5])
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rows = corpus(seed) + [("en", "none", None), ("en", "none too", "12 34"), ("xx", "p", "lone"), ("xx", "q", ""), ("yy", "p", "")]
    rows += [(lang, source, "Alpha beta") for lang in ("2:zz", ":", "1:") for source in ("a:b", ":", "", "2") for _ in range(2)]
    assert run(spark, rows) == brute(rows, 3, 4)


def test_blocks_of_sources_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 4)
    monkeypatch.setattr(divergence, "TILE_ROWS", 12)
    rows = corpus(7, sources=17, docs=300)
    assert run(spark, rows, least=2, top=9) == brute(rows, 2, 9)


def test_copies_and_long_texts(spark):
    rows = [("en", "a", "one two " * 50_000), ("en", "b", "two three")] + [("en", f"s{i % 3}", "Copy of copies") for i in range(90)]
    assert run(spark, rows, least=1) == brute(rows, 1, 4)


def test_counts_beyond_64_bits(spark):
    got = spark.sql("select 9000000000000000000L as c, 9100000000000000000L as n, 7L as v").select(
        divergence.share(*[divergence.F.col(c) for c in "cnv"])).first()[0]
    assert got == 1 + 10**9 * (9 * 10**18 + 5) // (91 * 10**17 + 35)


def test_empty_table(spark):
    assert run(spark, []) == []
