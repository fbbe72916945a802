import datetime as dt

from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import tables


def day_rows(spark, values):
    return spark.createDataFrame(values, "id long, day date")


D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_overwrite_and_append(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    tables.overwrite(spark.range(3), path)
    tables.overwrite(spark.range(2), path)
    tables.append(spark.range(5, 6), path)
    assert rows(tables.read(spark, path)) == [(0,), (1,), (5,)]


def test_overwrite_clears_all_partitions(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    tables.overwrite(day_rows(spark, [(1, D1), (2, D2)]), path, "day")
    tables.overwrite(day_rows(spark, [(3, D2)]), path, "day")
    assert rows(tables.read(spark, path)) == [(3, D2)]


def test_create_if_absent(spark, tmp_path):
    path = f"{tmp_path}/t"
    shape = schemas.struct_of("public.realtime_transactions")
    assert tables.create_if_absent(spark, path, shape)
    assert tables.read(spark, path).columns == shape.names
    tables.append(schemas.conform(spark.range(1).selectExpr("'e' AS event_id"), "public.realtime_transactions"), path)
    assert not tables.create_if_absent(spark, path, shape)
    assert tables.read(spark, path).count() == 1


def test_replace_and_clear_a_day(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    tables.overwrite(day_rows(spark, [(1, D1), (2, D2), (3, D2)]), path, "day")
    for _ in range(2):
        tables.replace_partition(day_rows(spark, [(9, D2)]), path, "day", D2)
    assert rows(tables.read(spark, path)) == [(1, D1), (9, D2)]
    tables.replace_partition(day_rows(spark, []), path, "day", D2)
    assert rows(tables.read(spark, path)) == [(1, D1)]
    tables.clear_partition(spark, path, "day", D1)
    assert rows(tables.read(spark, path)) == []


def test_insert_ignoring_conflicts(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    shape = "k string, v string"
    tables.overwrite(spark.createDataFrame([("a", "old"), (None, "old")], shape), path)
    incoming = [("a", "new"), ("b", "same"), ("b", "same"), (None, "n1"), (None, "n2")]
    tables.insert_ignore(spark, path, spark.createDataFrame(incoming, shape), "k")
    assert rows(tables.read(spark, path)) == sorted(
        [("a", "old"), ("b", "same"), (None, "n1"), (None, "n2"), (None, "old")], key=repr
    )


def test_rewrite_reads_its_own_table(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    tables.overwrite(day_rows(spark, [(1, D1), (2, D2)]), path, "day")
    tables.rewrite(tables.read(spark, path).where("id <> 1"), path, "day")
    assert rows(tables.read(spark, path)) == [(2, D2)]


def test_delete_through_a_join_keeps_null_keys(spark, rows):
    facts = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id long, time_key long")
    keys = spark.createDataFrame([(10,), (10,)], "time_key long")
    assert rows(tables.delete_matching(facts, keys, "time_key")) == [(2, 11), (3, None)]


def test_added_columns_read_as_null(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(1).write.parquet(path)
    shape = spark.range(1).selectExpr("id", "CAST(1 AS DECIMAL(18,2)) AS base_amount").schema
    assert tables.read(spark, path, shape).first().asDict() == {"id": 0, "base_amount": None}
    assert tables.add_columns(spark.range(1), shape).columns == ["id", "base_amount"]


def test_defaults_fill_only_missing_columns(spark):
    one = schemas.conform(spark.range(1).selectExpr("'s' AS source_system"), "mdm.fact_enterprise_transaction").first()
    assert (one.customer_sk, one.merchant_sk, one.product_sk) == (1, 1, 1)
    null = schemas.conform(
        spark.range(1).selectExpr("CAST(NULL AS BIGINT) AS merchant_sk"), "mdm.fact_enterprise_transaction"
    ).first()
    assert null.merchant_sk is None
    logged = schemas.conform(spark.range(1).selectExpr("1 AS x"), "mdm.dq_quarantine_log").first()
    assert logged.created_at is not None
    held = schemas.conform(spark.range(1).selectExpr("1 AS x"), "star.dim_customer").first()
    assert held.is_current is True and held.effective_date is not None


def test_every_declaration_parses(spark):
    for name in schemas.TABLES:
        shape = schemas.struct_of(name)
        for declared in (schemas.DEFAULTS, schemas.REQUIRED, schemas.UNIQUE, schemas.FOREIGN_KEYS):
            assert set(declared.get(name, ())) <= set(shape.names), name
    for name in schemas.UNKNOWN_MEMBERS:
        assert schemas.unknown_member(spark, name).first()[0] == schemas.UNKNOWN_SK


def test_amounts_round_half_up_on_landing(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-2.675,)], "base_amount double")
    got = schemas.conform(df, "public.realtime_transactions").select(F.col("base_amount").cast("string"))
    assert [r[0] for r in got.collect()] == ["1.01", "2.68", "-2.68"]
