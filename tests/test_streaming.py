import datetime as dt
import json
import os

import pytest

from ledgerloom.sources import readers
from ledgerloom import schemas
from ledgerloom.plans import daily
from ledgerloom.streaming.landing import (
    folder_sink,
    landed,
    query_id,
    start_console,
    start_landing,
    to_sinks,
    with_batches,
)
from ledgerloom.streaming.parse import landing_rows, parse_events

PAY = {"source_system": "PAYMENT", "event_id": "p1", "cif": "CIF000001", "card_bin": "450630XXXX",
       "merchant_name": "Shop", "base_amount": 12.345, "currency": "USD", "timestamp": "2024-01-02T03:04:05.5Z"}
WALLET = {"source_system": "EWALLET", "event_id": "w1", "wallet_id": "W000501", "service_type": "TAXI",
          "promo_discount": 1.5, "base_amount": 7, "currency": "USD", "timestamp": "2024-01-02T03:04:06Z"}
OLDER = {"event_id": "o1", "account_id": 7, "amount": 5.0, "txn_type": "TOP_UP", "currency": "VND",
         "timestamp": "2024-01-02T03:04:07Z", "merchant": "Shop", "is_fraud_flag": 1}
EDGE = [
    json.dumps(PAY), json.dumps(WALLET), json.dumps(OLDER), "{broken", "not json at all",
    json.dumps({**PAY, "event_id": "p2", "base_amount": "many"}),
    json.dumps({**PAY, "event_id": "p3", "timestamp": "soon"}),
    json.dumps({**PAY, "event_id": "p4", "cif": None, "base_amount": None}),
    json.dumps({**PAY, "event_id": "p1"}),
]


@pytest.fixture
def parsed(spark):
    return {i: r for i, r in enumerate(parse_events(spark.createDataFrame([(v,) for v in EDGE], "value string")).collect())}


def test_declared_fields_only(parsed):
    assert parsed[0].asDict() == {
        "source_system": "PAYMENT", "event_id": "p1", "cif": "CIF000001", "wallet_id": None,
        "merchant_name": "Shop", "base_amount": 12.345, "currency": "USD",
        "timestamp": dt.datetime(2024, 1, 2, 3, 4, 5, 500000),
    }
    assert parsed[1].wallet_id == "W000501" and parsed[1].base_amount == 7.0
    # the older shape has no base amount under this schema
    assert parsed[2].event_id == "o1" and parsed[2].base_amount is None


def test_broken_events_become_rows(parsed):
    for i in (3, 4):
        assert all(v is None for v in parsed[i])
    assert parsed[5].base_amount is None and parsed[5].event_id == "p2" and parsed[5].currency == "USD"
    assert parsed[6].timestamp is None and parsed[6].base_amount == 12.345
    assert parsed[7].cif is None and parsed[7].base_amount is None
    assert len(parsed) == len(EDGE)


def test_bytes_parse_like_text(spark):
    raw = spark.createDataFrame([(bytearray(json.dumps(PAY).encode()),)], "value binary")
    assert parse_events(raw).first().event_id == "p1"


def test_landing_casts_money(spark):
    row = landing_rows(parse_events(spark.createDataFrame([(json.dumps(PAY),)], "value string"))).first()
    assert str(row.base_amount) == "12.35" and row.account_id is None


def test_an_amount_beyond_the_column_does_not_stop_the_stream(spark):
    huge = spark.createDataFrame([(json.dumps({**PAY, "base_amount": 1e30}),)], "value string")
    row = landing_rows(parse_events(huge)).first()
    assert row.event_id == "p1" and row.base_amount is None


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def land(spark, base, *extra, checkpoint="checkpoint"):
    stream = start_landing(
        readers.file_events(spark, f"{base}/in", max_files=1), f"{base}/{checkpoint}", folder_sink(f"{base}/out"),
        *extra, available_now=True,
    )
    stream.awaitTermination()


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    base = str(tmp_path)
    write(f"{base}/in", "1.json", EDGE[:4])
    write(f"{base}/in", "2.json", EDGE[4:])
    land(spark, base)
    assert landed(spark, f"{base}/out").count() == len(EDGE)
    land(spark, base)
    assert landed(spark, f"{base}/out").count() == len(EDGE)
    write(f"{base}/in", "3.json", [json.dumps({**WALLET, "event_id": "w9"})])
    land(spark, base)
    rows = landed(spark, f"{base}/out")
    assert rows.count() == len(EDGE) + 1 and rows.where("event_id = 'w9'").count() == 1
    own = query_id(spark, f"{base}/checkpoint")
    batches = {r.batch_id for r in with_batches(spark, f"{base}/out").select("batch_id").distinct().collect()}
    assert batches == {f"{own}-{n}" for n in range(3)}


def test_a_new_checkpoint_replaces_nothing(spark, tmp_path):
    base = str(tmp_path)
    write(f"{base}/in", "1.json", EDGE)
    land(spark, base)
    os.rename(f"{base}/in", f"{base}/seen")
    write(f"{base}/in", "2.json", [json.dumps({**WALLET, "event_id": "w9"})])
    land(spark, base, checkpoint="second")
    assert landed(spark, f"{base}/out").count() == len(EDGE) + 1


def test_streams_add_to_a_loaded_table_and_other_layouts_are_refused(spark, tmp_path):
    base = str(tmp_path)
    w = daily.Warehouse(spark, base)
    rows = landing_rows(parse_events(spark.createDataFrame([(v,) for v in EDGE[:3]], "value string")))
    w.reload("public.realtime_transactions", rows)
    folder_sink(w.path("public.realtime_transactions"))(rows, "q-0")
    assert landed(spark, w.path("public.realtime_transactions")).count() == 6
    schemas.conform(rows, "public.realtime_transactions").write.parquet(f"{base}/plain")
    with pytest.raises(ValueError, match="folders by month"):
        landed(spark, f"{base}/plain")


def test_a_day_reads_its_own_month(spark, tmp_path, plan_of):
    sink = folder_sink(f"{tmp_path}/out")
    later = json.dumps({**PAY, "event_id": "p8", "timestamp": "2024-01-03T00:00:00Z"})
    sink(landing_rows(parse_events(spark.createDataFrame([(v,) for v in [*EDGE, later]], "value string"))), 0)
    day = landed(spark, f"{tmp_path}/out", "2024-01-03")
    assert [r.event_id for r in day.collect()] == ["p8"]
    assert "PartitionFilters: [isnotnull(event_month" in plan_of(day)
    assert "GreaterThanOrEqual(timestamp" in plan_of(day)
    # without a timestamp an event belongs to no day, but it is landed
    assert landed(spark, f"{tmp_path}/out").where("timestamp IS NULL").count() == 3
    sink(landing_rows(parse_events(spark.createDataFrame([(later,)], "value string"))), 1)
    assert landed(spark, f"{tmp_path}/out").count() == len(EDGE) + 2


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    sink = folder_sink(f"{tmp_path}/out")
    batch = landing_rows(parse_events(spark.createDataFrame([(v,) for v in EDGE], "value string")))
    for _ in range(2):
        sink(batch, 4)
    assert landed(spark, f"{tmp_path}/out").count() == len(EDGE)
    assert landed(spark, f"{tmp_path}/out", "2024-01-02").count() == 6


def test_empty_batches_reach_no_sink(spark):
    calls = []
    write_batch = to_sinks(lambda batch, i: calls.append(i))
    write_batch(spark.range(0), 0)
    write_batch(spark.range(1), 1)
    assert calls == [1]


def test_a_batch_of_several_sinks_is_kept_on_disk_and_let_go(spark):
    levels, batch = [], spark.range(3)
    to_sinks(*[lambda rows, i: levels.append(rows.storageLevel)] * 2)(batch, 0)
    assert [(x.useDisk, x.useMemory) for x in levels] == [(True, False)] * 2
    assert not batch.storageLevel.useDisk


def test_two_sinks_get_the_same_batch(spark, tmp_path):
    base = str(tmp_path)
    write(f"{base}/in", "1.json", EDGE)
    land(spark, base, folder_sink(f"{base}/lake"))
    assert landed(spark, f"{base}/lake").count() == landed(spark, f"{base}/out").count() == len(EDGE)


def test_a_running_stream_takes_new_events_until_stopped(spark, tmp_path):
    base = str(tmp_path)
    write(f"{base}/in", "1.json", EDGE[:2])
    stream = start_landing(
        readers.file_events(spark, f"{base}/in"), f"{base}/checkpoint", folder_sink(f"{base}/out")
    )
    try:
        stream.processAllAvailable()
        write(f"{base}/in", "2.json", EDGE[2:])
        stream.processAllAvailable()
        assert stream.isActive
    finally:
        stream.stop()
    assert landed(spark, f"{base}/out").count() == len(EDGE)


def test_console(spark, tmp_path):
    write(f"{tmp_path}/in", "1.json", EDGE[:1])
    stream = start_console(readers.file_events(spark, f"{tmp_path}/in"), f"{tmp_path}/checkpoint")
    try:
        stream.processAllAvailable()
        assert stream.lastProgress["numInputRows"] == 1
    finally:
        stream.stop()


def test_reader_options():
    kafka = readers.kafka_options("broker:9092", maxOffsetsPerTrigger="1000")
    assert kafka == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "realtime_transactions",
                     "startingOffsets": "latest", "maxOffsetsPerTrigger": "1000"}
    jdbc = readers.jdbc_options("jdbc:x", "t", partition_column="id", lower=0, upper=9, partitions=3, user="u")
    assert jdbc["batchsize"] == "500" and jdbc["numPartitions"] == "3" and jdbc["user"] == "u"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", partition_column="id")
