import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import token_counts

tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
MODEL = tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
MACHINE = token_counts.Transducer(MODEL)
TINY = token_counts.Transducer(MODEL, states=60, longest=4)


def counts(texts):
    return [len(LIBRARY.encode(t)) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab the\n\t é▁漢字😀0<s>/|"), max_size=40), max_size=6))
def test_any_text(texts):
    assert MACHINE.counts(texts).tolist() == counts(texts)
    assert TINY.counts(texts).tolist() == counts(texts)


@pytest.mark.parametrize("machine", [MACHINE, TINY])
def test_chunks_compose(machine):
    random.seed(4)
    parts = ["the ", "ing", "é", "漢", "▁", "\n", " " * 7, "<s>", "x" * 30, "\0", "1999 ", "straße "]
    texts = ["".join(random.choices(parts, k=random.choice([5, 200, 900]))) for _ in range(60)]
    texts += ["a" * 3000, " " * 3000, "漢" * 2000, "ab" * 1500 + " c", "\n" * 1500, "", " "]
    assert machine.counts(texts).tolist() == counts(texts)


@pytest.mark.parametrize("machine", [MACHINE, TINY])
def test_runs_that_begin_where_a_chunk_does(machine):
    texts = ["a " * 255 + "\n" + run * n + tail for run in ("-", "a", "=", "漢") for n in (600, 1024, 2500)
             for tail in (" b", "", "\n" + "-" * 700 + " c")]
    texts += ["a " * 254 + "b" * k + "\n" + "-" * 1100 + "\n" for k in range(6)]
    assert machine.counts(texts).tolist() == counts(texts)


def test_long_states_compose():
    machine = token_counts.Transducer(MODEL, longest=2000)
    texts = ["a " * 255 + "\n" + "-" * 1700 + " b", "a" * 3000 + " b"]
    assert machine.counts(texts).tolist() == counts(texts)


def test_frame(spark):
    rows = [(1, "the cat", "x"), (None, None, "y"), (2, "", "z"), (2, "", "z"), (3, "long text " * 30000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = token_counts.token_counts(df, MODEL)
    assert found.columns == ["doc_id", "text", "n_bytes", "n_tokens"]
    expected = [(i, len((t or "").encode()), len(LIBRARY.encode(t or ""))) for i, t, _ in rows]
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in found.collect()], key=repr) == sorted(expected, key=repr)
    assert token_counts.token_counts(df.limit(0), MODEL).collect() == []
