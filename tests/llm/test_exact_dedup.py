import hashlib
import re

import pytest

from ledgerloom.llm import exact_dedup

SCHEMA = "doc_id long, text string, kept string, norm string, Salt int"


def norm(text):
    return re.sub(r"[\x20\x09-\x0d]", "", text or "")


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(norm(text), []).append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for text, members in groups.items():
        members.sort()
        best = None if members[0][1] else members[0][2]
        for place, (_, no_id, doc_id) in enumerate(members):
            out.append((None if no_id else doc_id, best, len(members), place == 0,
                        hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)
    found = exact_dedup.exact_dedup(df)
    assert found.columns == ["doc_id", "text", "norm", "Salt", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted([tuple(r) for r in found.select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=repr)


CASES = [
    (1, "a b"), (2, "ab"), (3, "a  b"), (4, "a\tb "), (5, None), (6, ""), (7, " \n"), (None, "ab"),
    (8, "é x"), (9, "éx"), (9, "éx"), (10, "a b"), (11, "long " * 40000), (12, "long" * 40000),
]


def test_nulls_ties_repeats_and_long_texts(spark):
    assert run(spark, CASES) == brute(CASES)


def test_groups_larger_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "piece_rows", lambda *_: 3)
    rows = CASES + [(100 + i, " " * (i % 5) + "hot") for i in range(60)] + [(120, "hot"), (None, " hot ")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_one_exchange_of_texts(spark, plan_of):
    df = spark.createDataFrame([(i, t) for i, t in CASES], "doc_id long, text string")
    plan = plan_of(exact_dedup.exact_dedup(df))
    assert plan.count("rangepartitioning") == 1 and "Python" not in plan


@pytest.mark.parametrize("text", ["\x0b\x0c\r", " x"])
def test_only_six_separators(spark, text):
    assert run(spark, [(1, text)]) == brute([(1, text)])
