import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from ledgerloom.llm import pseudo_lm as lm


def sentences(n, seed=0):
    random.seed(seed)
    out = []
    for _ in range(n):
        words = []
        for _ in range(random.randint(3, 30)):
            k = random.randrange(20)
            words += [f"a{k}", f"b{k}", f"c{k}"]
        out.append(" ".join(words))
    return out


def frame(spark, texts):
    return spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string").repartition(3, "doc_id")


def unigrams(texts, counts):
    n = sum(counts.values())
    return [sum(math.log(counts[w] / n) for w in t.encode().split()) for t in texts]


def test_learns_from_both_sides(spark):
    texts = sentences(400)
    known, _, parameters = lm.fit(frame(spark, texts).select("text"))
    fresh = sentences(40, seed=9)
    mixed = [" ".join(random.sample(t.split(), len(t.split()))) for t in fresh]

    def score(some):
        return lm.score_units([lm.in_units(lm.tokens(t), known) for t in some], lm.Network(parameters))

    n = sum(len(t.split()) for t in fresh)
    plain = unigrams(fresh, Counter(w for t in texts for w in t.encode().split()))
    good, shuffled = score(fresh), score(mixed)
    # every word is a unit: half a nat a word better than the frequencies of whole words
    assert good.sum() > sum(plain) + 0.5 * n
    assert (good > shuffled).mean() > 0.9


def some_vocabulary(texts, monkeypatch, heads=2):
    """By plain loops: the units of the words, and each word's share of its unit."""
    monkeypatch.setattr(lm, "HEADS", heads)
    counts = Counter(w for t in texts for w in t.encode().split())
    first = sorted(counts, key=lambda w: (-counts[w], w))[:heads]
    units, totals = lm.Units(first, heads), np.zeros(lm.UNITS)
    for w, n in counts.items():
        totals[units[w]] += n
    return lm.Vocabulary(units, totals), {w: counts[w] / totals[units[w]] for w in counts}


def test_probabilities_of_all_words_add_up(monkeypatch):
    known, share = some_vocabulary(sentences(20), monkeypatch, 20)
    network = lm.Network(lm.initial(known.totals))
    context = [np.array([known.units[w]], np.uint16) for w in (b"a1", b"b2", b"c3", b"nowhere")]
    total = sum(
        math.exp(network.log_probabilities(context, np.array([known.units[w]]))[0]) * part for w, part in share.items())
    assert abs(total - 1) < 1e-4


def brute(texts, known, share, parameters):
    """The pseudo-likelihood of each text, word by word."""
    net, out = lm.Network(parameters), []
    for text in texts:
        words, total = text.encode().split(), 0.0
        for i, word in enumerate(words):
            h = np.zeros(lm.WIDTH)
            for k, d in enumerate((-2, -1, 1, 2)):
                h += net.embed[k][known.units[words[i + d]] if 0 <= i + d < len(words) else lm.PAD]
            h, (c, m) = np.tanh(h), divmod(known.units[word], lm.MEMBERS)
            for logits, wanted in ((h @ net.out + net.bias, c), (h @ net.unit_out[c] + net.unit_bias[c], m)):
                total += logits[wanted] - logits.max() - math.log(np.exp(logits - logits.max()).sum())
            total += math.log(share[word])
        out.append(total)
    return out


def test_brute_force(spark, monkeypatch):
    texts = ["a b a c", "", "c d e f g a a", "a b", "a b", "\u00e9\t\u00fc\n a", "h " * 9000]
    known, share = some_vocabulary(texts, monkeypatch)
    df = frame(spark, texts)
    fitted = lm.fit(df.select("text"))
    assert (fitted[0].units, fitted[0].totals.tolist()) == (known.units, known.totals.tolist())
    assert {bytes(r.word): r.share for r in fitted[1].collect()} == {
        w: round(math.log(p) * lm.NANO) for w, p in share.items() if w not in known.units}
    monkeypatch.setattr(lm, "fit", lambda *_: fitted)
    rows = lm.pseudo_likelihood(df).orderBy("doc_id").collect()
    assert [r.n_tokens for r in rows] == [len(t.split()) for t in texts]
    assert np.allclose([r.log_likelihood for r in rows], brute(texts, known, share, fitted[2]), rtol=1e-4)


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(lm, "KEPT", 3)
    texts = sentences(50)
    found = {bytes(r.word): r.n for r in lm.word_counts(frame(spark, texts).select("text")).collect()}
    assert found == Counter(w for t in texts for w in t.encode().split())


def test_a_step_lowers_the_loss(monkeypatch):
    known, _ = some_vocabulary(sentences(20), monkeypatch, 20)
    network = lm.Network(lm.initial(known.totals))
    (contexts, units, _), = lm.examples([lm.in_units(lm.tokens(t), known) for t in sentences(20)])
    before = network.log_probabilities(contexts, units).sum()
    for _ in range(20):
        network.train(contexts, units)
    assert network.log_probabilities(contexts, units).sum() > before + 0.5 * len(units)


def test_contexts_end_with_their_text(monkeypatch):
    texts = ["a b c", "", "d e f g", "h"]
    known, _ = some_vocabulary(texts, monkeypatch)
    network = lm.Network(lm.initial(known.totals))
    ids = [lm.in_units(lm.tokens(t), known) for t in texts]
    alone = [lm.score_units([i], network)[0] for i in ids]
    assert np.allclose(lm.score_units(ids, network), alone)


def test_reruns_agree_in_levels(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN_IN", 2)
    df = frame(spark, sentences(60)).select("text")
    assert np.array_equal(lm.fit(df)[2], lm.fit(df)[2])


def test_odd_rows(spark):
    found = lm.pseudo_likelihood(frame(spark, [None, "", "a b", "a b", "w " * 60000]))
    assert found.columns == ["doc_id", "text", "n_tokens", "log_likelihood", "mean_log_likelihood"]
    rows = {r.doc_id: r for r in found.collect()}
    assert [rows[i].n_tokens for i in range(5)] == [0, 0, 2, 2, 60000]
    found = lm.pseudo_likelihood(frame(spark, ["a", None]), kept=("doc_id",))
    assert found.columns == ["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"]
    assert sorted(r.n_tokens for r in found.collect()) == [0, 1]
    assert rows[0].log_likelihood == 0 and rows[0].mean_log_likelihood is None
    assert rows[2].log_likelihood == rows[3].log_likelihood < 0
    assert lm.pseudo_likelihood(frame(spark, [None]).limit(0)).collect() == []


def test_probabilities_hold_for_logits_of_any_size():
    for low, high in ((-5, 5), (-3000, -2000), (2000, 3000), (-1e9, 0)):
        logits = np.random.default_rng(3).uniform(low, high, (50, lm.CLASSES)).astype(np.float32)
        wanted = np.arange(50) % lm.CLASSES
        exact = logits.astype(float) - logits.max(axis=1, keepdims=True)
        exact -= np.log(np.exp(exact).sum(axis=1, keepdims=True))
        assert np.allclose(lm._log_part(logits.copy(), wanted), exact[np.arange(50), wanted], rtol=1e-4, atol=1e-3)
        assert np.allclose(lm._softmax(logits.copy()), np.exp(exact), atol=1e-4)


def test_the_highest_logit_is_looked_for_only_where_it_matters():
    usual = np.zeros((4, lm.CLASSES), np.float32)
    usual[:, 0] = 9
    assert lm._settled(usual)[0, 0] == 9
    usual[2, 5] = 500
    assert lm._settled(usual)[:, 0].tolist() == [0, 0, -491, 0]


def test_units_of_words_do_not_depend_on_how_they_are_looked_up():
    known = lm.Vocabulary(lm.Units([b"a", b"b"], 2), np.ones(lm.UNITS))
    words = [b"a", b"zz", b"b", b"", b"yy"]
    assert lm.in_units(words, known).tolist() == [known.units[w] for w in words]


def test_words_of_many_texts_are_their_tokens():
    texts = ["a b", "", " ", "\t a\r\n", "b\x0b\x0c c  d ", " e\u0085 f\x1cg h", "a" * 300]
    words, lengths = lm.words_of(pa.array(texts))
    assert words.to_pylist() == [w for t in texts for w in lm.tokens(t)]
    assert lengths.tolist() == [len(lm.tokens(t)) for t in texts]
    words, lengths = lm.words_of(pa.array(texts)[2:5])
    assert words.to_pylist() == [b"a", b"b", b"c", b"d"] and lengths.tolist() == [0, 1, 3]
    assert [len(x) for x in lm.words_of(pa.array([], pa.string()))] == [0, 0]


def test_units_of_words(monkeypatch):
    texts = sentences(20)
    known, _ = some_vocabulary(texts, monkeypatch, 20)
    for words in ([*lm.tokens(texts[0]), b"nowhere", b""], [b"nowhere"], []):
        expected = [known.units[w] for w in words]
        assert lm.in_units(words, known).tolist() == lm.in_units(pa.array(words, pa.binary()), known).tolist() == expected
    known = lm.Vocabulary(lm.Units([], 20), np.zeros(lm.UNITS))
    assert lm.in_units([b"x"], known).tolist() == [known.units[b"x"]]


def test_words_that_share_a_unit_are_counted_by_text(monkeypatch):
    texts = ["", "x a x y", " ", "a", "y y x", ""]
    known, _ = some_vocabulary(["a a a b b x y"], monkeypatch)
    found = lm._scored(pa.array(texts), known, lm.Network(lm.initial(known.totals))).to_pylist()
    assert [r["n"] for r in found] == [len(t.split()) for t in texts]
    assert [Counter(r["rare"]) for r in found] == [
        Counter(w for w in lm.tokens(t) if w not in known.units) for t in texts]


def test_words_meet_their_shares_without_a_sort(spark, monkeypatch):
    plans, write = {}, lm.stored

    def stored(df, label):
        if label == "shared":
            df.collect()
            plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, label)

    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before, old = spark.conf.get(name), [spark.conf.get(n) for n in names]
    monkeypatch.setattr(lm, "stored", stored)
    monkeypatch.setattr(lm, "HEADS", 2)
    try:
        for n, value in zip(names, ("-1", "true"), strict=True):
            spark.conf.set(n, value)
        rows = lm.pseudo_likelihood(frame(spark, sentences(30)), rounds=1).collect()
    finally:
        for n, value in zip(names, old, strict=True):
            spark.conf.set(n, value)
    final = plans["shared"].split("== Initial Plan ==")[0]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final
    assert len(rows) == 30 and spark.conf.get(name) == before
