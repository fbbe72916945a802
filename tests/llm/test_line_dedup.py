import random

import pytest

from ledgerloom.llm import line_dedup

SCHEMA = "doc_id long, text string, lines string, T1 int, drops string, id string"
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, documents=2):
    holders = {}
    for n, (doc_id, text) in enumerate(rows):
        for key in {line.strip(" \t\n\x0b\x0c\r").translate(SMALL) for line in (text or "").split("\n")}:
            holders.setdefault(key, []).append((doc_id is None, doc_id or 0))
    out = []
    for doc_id, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            key = line.strip(" \t\n\x0b\x0c\r").translate(SMALL)
            held = holders[key]
            if len(key) < least or len(held) < documents or min(held) == (doc_id is None, doc_id or 0):
                kept.append(line)
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in rows], SCHEMA)
    found = line_dedup.line_dedup(df, **options)
    assert found.columns == df.columns + ["n_lines", "n_dropped"]
    out = found.collect()
    assert all((r.lines, r.T1, r.drops, r.id) == ("x", 1, "y", "z") for r in out)
    return sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out], key=repr)


CASES = [
    (1, "A shared line\nmine alone, one\nshort"), (2, "a SHARED line\nshort\n"), (3, " \ta shared line\r\n\n\nx"),
    (4, None), (5, ""), (6, "\n\n"), (None, "a shared line\nin a null id"), (None, "a shared line\nin a null id"),
    (7, "In a null id\nÄ not folded"), (8, "ä not folded\ntwice here ok\ntwice here ok"), (9, "twice here ok"),
    (9, "twice here ok"), (10, "ten chars.\nnine char"), (11, "ten chars.\nnine char"), (12, "a shared line "),
    (13, "a shared line\x85"), (14, "word " * 60_000 + "\na shared line\n" + "long " * 9), (15, "a shared line"),
    (16, "\n".join(f"line number {i % 700}" for i in range(5000))), (17, "line number 3\nline number 699"),
]


def test_nulls_ties_repeats_and_long_texts(spark):
    assert run(spark, CASES) == brute(CASES)


def test_other_thresholds(spark):
    assert run(spark, CASES, least_chars=1, documents=3) == brute(CASES, 1, 3)


@pytest.mark.parametrize("seed", range(3))
def test_hot_lines_in_pieces(spark, monkeypatch, seed):
    monkeypatch.setattr(line_dedup, "piece_rows", lambda *_: 4)
    random.seed(seed)
    lines = ["all hold this one", "Many hold this one", "", "few hold it here", "  ALL hold this one ", "tiny"]
    rows = [(random.choice([None, *range(30)]), "\n".join(random.choices(lines + [f"own line {i}"], k=random.randint(0, 8))))
            for i in range(120)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_no_python(spark, plan_of):
    df = spark.createDataFrame([(i, t) for i, t in CASES], "doc_id long, text string")
    assert "Python" not in plan_of(line_dedup.line_dedup(df))
