import json
import os

import pytest

from ledgerloom import catalogue
from ledgerloom.sources import files, readers
from ledgerloom.streaming import feed, landing
from ledgerloom.streaming.landing import dead_letter_sink, dead_letters, folder_sink, landed, start_landing
from ledgerloom.streaming.parse import judged_events, landing_rows, parse_events

GOOD = {"source_system": "EWALLET", "event_id": "w1", "wallet_id": "W1", "base_amount": 7, "currency": "USD",
        "timestamp": "2024-01-02T03:04:06Z"}
CASES = {
    json.dumps(GOOD): None,
    json.dumps({**GOOD, "base_amount": None, "timestamp": None}): None,
    "{}": None,
    "{broken": "NOT_JSON",
    "": "NO_TEXT",
    "words": "NOT_JSON",
    '"text"': "NOT_AN_EVENT",
    "17": "NOT_AN_EVENT",
    json.dumps({**GOOD, "base_amount": "many"}): "BAD_FIELD",
    json.dumps({**GOOD, "timestamp": "soon"}): "BAD_TIMESTAMP",
    json.dumps({**GOOD, "base_amount": 1e30}): "AMOUNT_OUT_OF_RANGE",
}


def test_reasons(spark):
    raw = spark.createDataFrame([(v,) for v in [*CASES, None]], "value string")
    rows = judged_events(raw).collect()
    assert {r.value: r.reason for r in rows} == {**CASES, None: "NO_TEXT"}
    # what lands is the same with and without letters
    plain = [tuple(r) for r in landing_rows(parse_events(raw)).collect()]
    assert [tuple(r) for r in landing_rows(judged_events(raw).drop("value", "reason")).collect()] == plain


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_letters_come_with_their_batch_and_a_replay_replaces_them(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in", "1.json", [v for v in CASES if v])

    def stream():
        start_landing(
            readers.file_events(spark, f"{base}/in", 1), f"{base}/checkpoint", folder_sink(f"{base}/out"),
            dead=dead_letter_sink(f"{base}/dead"), available_now=True).awaitTermination()

    stream()
    put(f"{base}/in", "2.json", ["{again", json.dumps({**GOOD, "event_id": "w2"})])
    stream()
    expected = sorted([v for v, reason in CASES.items() if reason and v] + ["{again"])
    letters = dead_letters(spark, f"{base}/dead")
    assert sorted(r.value for r in letters.collect()) == expected
    batches = {r.batch_id for r in letters.collect()}
    assert batches == {r.batch_id for r in landing.with_batches(spark, f"{base}/out").select("batch_id").distinct().collect()}
    raw = spark.createDataFrame([("{again",)], "value string")
    dead_letter_sink(f"{base}/dead")(judged_events(raw), max(batches))
    assert sorted(r.value for r in dead_letters(spark, f"{base}/dead").collect()) == expected
    assert landed(spark, f"{base}/out").count() == len([v for v in CASES if v]) + 2
    assert dead_letters(spark, f"{base}/none").count() == 0


def test_the_feed_keeps_the_newest_over_batches_and_replays(spark, tmp_path):
    path = f"{tmp_path}/feed"
    sink = feed.feed_sink(path, rows=5)
    events = [json.dumps({**GOOD, "event_id": f"w{n}", "timestamp": f"2024-01-02T03:{n * 7 % 60:02d}:00Z"}) for n in range(40)]

    def batch(k):
        return landing_rows(parse_events(spark.createDataFrame([(v,) for v in events[k::4]], "value string")))

    for k in (0, 1, 1, 2, 3, 3, 3):
        sink(batch(k), f"q-{k}")
    best = sorted(range(40), key=lambda n: (n * 7 % 60, f"w{n}"), reverse=True)[:5]
    assert sorted(r.event_id for r in feed.latest(spark, path).collect()) == sorted(f"w{n}" for n in best)
    assert feed.latest(spark, f"{tmp_path}/none").count() == 0


def test_texts_for_a_stream_are_compressed_files_of_few_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "TEXT_ROWS", 10)
    raw = spark.range(0, 100, 1, 2).selectExpr("concat('{\"event_id\":\"', id, '\", \"currency\":\"', repeat('x', 300), '\"}') AS value")
    catalogue._write_texts(raw, f"{tmp_path}/in")
    texts = [n for n in os.listdir(f"{tmp_path}/in") if n.startswith("part-")]
    assert len(texts) == 10 and all(n.endswith(".txt.lz4") for n in texts)
    start_landing(
        readers.file_events(spark, f"{tmp_path}/in", 4), f"{tmp_path}/checkpoint", folder_sink(f"{tmp_path}/out"),
        available_now=True).awaitTermination()
    assert sorted(int(r.event_id) for r in landed(spark, f"{tmp_path}/out").collect()) == list(range(100))


HEADER = "id,one,two,three,four\n"


@pytest.fixture
def load(spark, tmp_path):
    def run(text, table="ewallet.balance"):
        os.makedirs(f"{tmp_path}/in", exist_ok=True)
        with open(f"{tmp_path}/in/part.csv", "w") as f:
            f.write(text)
        files.load_folder(spark, {table: f"{tmp_path}/in"}, f"{tmp_path}/out")
        held = spark.read.parquet(f"{tmp_path}/out/{table}").collect()
        path = f"{tmp_path}/out/{files.REJECTS}"
        return held, sorted(spark.read.parquet(path).collect(), key=str) if os.path.isdir(path) else []

    return run


def test_a_line_break_in_a_cell_is_one_row(load):
    held, rejects = load('CIF,Full_Name\nC1,"Ann ""the\none"", b"\nC2,Bo\n', "corebank.customer")
    assert sorted((r.cif, r.full_name) for r in held) == [("C1", 'Ann "the\none", b'), ("C2", "Bo")] and rejects == []


def test_bad_cells_and_records_are_rejected_alone(load):
    held, rejects = load(
        HEADER + "1,1.5,1,0,2024-01-01 00:00:00\n2,x,y,0,2024-01-01 00:00:00\n3,1,1,0,soon\n4,1,1\n5,1e40,1,0,\n6,2,2,0,\n")
    assert sorted(r.account_id for r in held) == [1, 6]
    assert [(r.row_number, r.reason, r.column_name, r.cell) for r in sorted(rejects, key=lambda r: (r.row_number, str(r.column_name)))] == [
        (2, "BAD_CELL", "available_balance", "y"), (2, "BAD_CELL", "current_balance", "x"), (3, "BAD_CELL", "last_updated", "soon"),
        (4, "MALFORMED_RECORD", None, "4,1,1"), (5, "BAD_CELL", "current_balance", "1e40")]
    assert all(r.file_name.endswith("/part.csv") and r.table_name == "ewallet.balance" for r in rejects)


def test_rejects_of_a_table_go_with_its_next_load(load):
    assert len(load(HEADER + "1,x,1,0,\n2,1,1,0,\n")[1]) == 1
    assert load(HEADER + "1,3,1,0,\n2,1,1,0,\n")[1] == []
