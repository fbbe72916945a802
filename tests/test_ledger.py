import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.plans import daily
from ledgerloom.streaming import landing
from ledgerloom.streaming.landing import folder_sink, landed

EVENTS = "event_id string, source_system string, wallet_id string, base_amount double, timestamp string"


def events(spark, rows):
    return schemas.conform(spark.createDataFrame(rows, EVENTS), daily.LANDING)


def event(n, day="2024-01-02"):
    return (f"e{n}", "EWALLET", "W1", 1.0 + n, f"{day} 10:00:00" if day else None)


@pytest.fixture
def w(spark, tmp_path):
    w = daily.Warehouse(spark, str(tmp_path))
    for table in ("corebank.customer", "corebank.mortgage_loan", "ewallet.account"):
        w.reload(table, schemas.empty(spark, table))
    return w


def facts(w):
    return sorted((r.source_trans_id, str(r.trans_date)) for r in w.stored(daily.FACTS).collect())


def test_every_reload_becomes_facts(spark, w):
    w.reload(daily.LANDING, events(spark, [event(n) for n in range(3)]))
    daily.run_daily(w, "2024-01-05")
    w.reload(daily.LANDING, events(spark, [event(n) for n in range(9)]))
    daily.run_daily(w, "2024-01-06")
    assert facts(w) == [(f"e{n}", "2024-01-02") for n in range(9)]


def test_days_that_a_reload_emptied_are_emptied(spark, w):
    w.reload(daily.LANDING, events(spark, [event(0), event(1, "2024-02-03"), event(2, None)]))
    daily.run_daily(w, "2024-01-05")
    assert facts(w) == [("e0", "2024-01-02"), ("e1", "2024-02-03"), ("e2", "None")]
    w.reload(daily.LANDING, events(spark, [event(0), event(3, "2024-02-04")]))
    daily.run_daily(w, "2024-01-05")
    assert facts(w) == [("e0", "2024-01-02"), ("e3", "2024-02-04")]


def test_a_run_that_stops_is_made_up_for(spark, w, monkeypatch):
    w.reload(daily.LANDING, events(spark, [event(0), event(1, "2024-01-05")]))
    monkeypatch.setattr(daily, "monitor_quality", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily.run_daily(w, "2024-01-05")
    monkeypatch.undo()
    daily.run_daily(w, "2024-01-06")
    assert facts(w) == [("e0", "2024-01-02"), ("e1", "2024-01-05")]


def test_only_new_batches_are_read_again(spark, w, plan_of):
    sink = folder_sink(w.path(daily.LANDING))
    sink(events(spark, [event(0)]), "q-0")
    daily.run_daily(w, "2024-01-05")
    sink(events(spark, [event(1, "2024-03-01")]), "q-1")
    arrived = daily.Arrivals(w)
    assert [str(d) for d in arrived.days] == ["2024-03-01"]
    assert [r.event_id for r in arrived.events.collect()] == ["e1"]
    arrived.record(w)
    assert daily.Arrivals(w).days == []


def test_five_hundred_tiny_batches_are_packed(spark, w):
    """Batches of a micro-batch each, written as the sink lays them out."""
    path = w.path(daily.LANDING)
    rows = [event(n, (None, "2024-01-02", "2024-02-03")[n % 3]) for n in range(500)]
    dated = events(spark, rows).withColumn("batch_id", F.concat(F.lit("q-"), F.substring("event_id", 2, 9)))
    dated = dated.withColumn("event_month", landing.month_of(F.to_date("timestamp")))
    dated.repartition(8).write.partitionBy("event_month", "batch_id").parquet(path)
    daily.Arrivals(w).record(w)
    before = sorted(r.event_id for r in landed(spark, path).collect())
    assert daily.compact_landing(w)
    folders = landing.batch_folders(spark, path).collect()
    # the newest batch may be replayed, so it stays
    assert sorted(str(f.event_month) for f in folders) == sorted(["None", "2024-01-01", "2024-02-01", "2024-01-01"])
    assert [f.batch_id for f in folders if not f.batch_id.startswith("packed-")] == ["q-499"]
    assert sorted(r.event_id for r in landed(spark, path).collect()) == before
    assert daily.Arrivals(w).days == [] and not daily.compact_landing(w)
    folder_sink(path)(events(spark, [rows[499]]), "q-499")
    assert sorted(r.event_id for r in landed(spark, path).collect()) == before


def test_batches_that_no_run_took_up_are_not_packed(spark, w):
    sink = folder_sink(w.path(daily.LANDING))
    for n in range(4):
        sink(events(spark, [event(n)]), f"q-{n}")
    assert not daily.compact_landing(w)
    arrived = daily.Arrivals(w)
    sink(events(spark, [event(4)]), "q-4")
    arrived.record(w)
    assert daily.compact_landing(w)
    names = {r.batch_id for r in landing.batch_folders(spark, w.path(daily.LANDING)).collect()}
    assert "q-4" in names and len(names) == 2
    assert daily.Arrivals(w).days != []
