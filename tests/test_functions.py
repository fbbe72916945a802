import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions import dates, measures, text


def one(spark, **columns):
    return spark.range(1).select(*[v.alias(k) for k, v in columns.items()]).first().asDict()


def test_text_cleansing(spark):
    got = one(
        spark,
        phone=text.digits_only(F.lit("(09) 12-34")),
        no_phone=text.digits_only(F.lit(None).cast("string")),
        name=text.clean_name(F.lit("  anna b ")),
        padded=text.padded_id("CIF", F.lit(7), 6),
        no_id=text.padded_id("CIF", F.lit(None).cast("int"), 6),
        short=text.short_id(F.lit("0123456789")),
        clock=text.clock(F.lit("2024-01-02 03:04:05").cast("timestamp")),
    )
    assert got == {
        "phone": "091234", "no_phone": None, "name": "ANNA B", "padded": "CIF000007", "no_id": None,
        "short": "01234567...", "clock": "03:04:05",
    }


def test_amount_label(spark):
    values = ["1234.50", "1000.00", "0.25", "-12.30"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(
        text.amount_label(F.col("v").cast("decimal(18,2)"), F.lit("VND")).alias("label")
    )
    assert [r.label for r in df.collect()] == ["1,234.5 VND", "1,000 VND", "0.25 VND", "-12.3 VND"]


def test_iso_timestamp_keeps_set_fractions_only(spark):
    got = one(
        spark,
        whole=text.iso_timestamp(F.lit("2024-01-02 03:04:05").cast("timestamp")),
        part=text.iso_timestamp(F.lit("2024-01-02 03:04:05.120000").cast("timestamp")),
    )
    assert got == {"whole": "2024-01-02T03:04:05", "part": "2024-01-02T03:04:05.12"}


def test_names_are_padded_and_weekends_text(spark):
    days = spark.createDataFrame(
        [(dt.date(2024, 5, d),) for d in (3, 4, 5, 6)], "d date"
    ).select(
        dates.padded_day_name("d").alias("n"), dates.padded_month_name("d").alias("m"),
        dates.weekend_text("d").alias("w"),
    ).collect()
    assert [r.n for r in days] == ["Friday   ", "Saturday ", "Sunday   ", "Monday   "]
    assert {r.m for r in days} == {"May      "}
    assert [r.w for r in days] == ["false", "true", "true", "false"]


def test_on_day_is_half_open(spark):
    stamps = ["2024-01-14 23:59:59.999999", "2024-01-15 00:00:00", "2024-01-15 23:59:59", "2024-01-16 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp").alias("t"))
    assert df.where(dates.on_day("t", "2024-01-15")).count() == 2


def test_ratio_rounds_half_up_on_exact_decimals(spark):
    cases = [("1", "0", None), ("0", "5", 0.0), ("12345", "100000", 12.35), ("1", "3", 33.33)]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a string, b string").select(
        measures.safe_ratio_pct(F.col("a").cast("decimal(38,2)"), F.col("b").cast("decimal(38,2)"), 2).alias("r")
    )
    got = [None if r.r is None else float(r.r) for r in df.collect()]
    assert got == [c[2] for c in cases]


def test_ratio_close_to_a_tie_keeps_enough_digits(spark):
    # 12.3449996 %: a six-digit quotient would round up to 12.35
    df = spark.range(1).select(
        measures.safe_ratio_pct(
            F.lit("12344999.60").cast("decimal(38,2)"), F.lit("100000000").cast("decimal(38,2)"), 2
        ).alias("r")
    )
    assert float(df.first().r) == 12.34


def test_average_of_nothing_is_null(spark):
    got = one(
        spark,
        none=measures.average(F.lit(None).cast("decimal(28,2)"), F.lit(0)),
        some=measures.average(F.lit("10.00").cast("decimal(28,2)"), F.lit(4)),
    )
    assert got["none"] is None and float(got["some"]) == 2.5


def test_risk_ladder(spark):
    days = [-1, 0, 1, 30, 31, 60, 61, 90, 91, None]
    df = spark.createDataFrame([(d,) for d in days], "d int").select(measures.risk_bucket("d").alias("b"))
    assert [r.b for r in df.collect()] == [
        "CURRENT", "CURRENT", "1-30 DPD", "1-30 DPD", "31-60 DPD", "31-60 DPD", "61-90 DPD", "61-90 DPD",
        "NPL", None,
    ]


def test_segments(spark):
    data = [(1, 1, 1), (2, None, 5), (0, 0, 1), (None, None, None)]
    df = spark.createDataFrame(data, "a int, b int, c int").select(
        measures.customer_segment(F.col("a"), F.col("b"), F.col("c")).alias("s")
    )
    assert [r.s for r in df.collect()] == ["3-Product", "2-Product", "1-Product", "1-Product"]


def test_type_codes_and_their_case(spark):
    data = ["PAYMENT", "TRANSFER", "WITHDRAWAL", "TOP_UP", "WITHDRAW", "top_up", None]
    df = spark.createDataFrame([(v,) for v in data], "t string").select(
        measures.txn_type_code("t").alias("train"),
        measures.txn_type_code("t", ignore_case=True).alias("score"),
    )
    got = df.collect()
    assert [r.train for r in got] == [0, 0, 1, 2, 0, 0, 0]
    assert [r.score for r in got] == [0, 0, 1, 2, 0, 2, 0]


def test_rule_score(spark):
    df = spark.createDataFrame([(2999.99,), (3000.0,), (3000.01,)], "a double").select(
        measures.rule_score("a").alias("s"), measures.score_pct(measures.rule_score("a")).alias("p")
    )
    assert [(r.s, r.p) for r in df.collect()] == [(0.1, 10.0), (0.1, 10.0), (0.8, 80.0)]


def test_headers():
    assert text.normalise_headers([" CIF", "Full_Name "]) == ["cif", "full_name"]
