import os

from ledgerloom import schemas
from ledgerloom.plans import fraud
from ledgerloom.sources import files


def transactions(spark, n=600):
    return schemas.conform(
        spark.range(n).selectExpr(
            "id AS txn_id", "IF(id % 3 = 0, 'TOP_UP', 'PAYMENT') AS txn_type", "CAST(id % 50 AS DECIMAL(18,2)) * 100 AS txn_amount",
            "IF(id % 50 > 40, 'FAILED', 'SUCCESS') AS txn_status",
        ),
        "ewallet.transaction",
    )


def test_training_set(spark):
    got = fraud.training_set(transactions(spark)).where("txn_id IN (0, 1, 41)").orderBy("txn_id").collect()
    assert [(r.txn_type, float(r.amount), r.is_fraud) for r in got] == [(2, 0.0, 0), (0, 100.0, 0), (0, 4100.0, 1)]


def test_split_is_a_partition_and_repeatable(spark):
    rows = fraud.training_set(transactions(spark, 5000))
    train, test = fraud.split(rows)
    assert train.count() + test.count() == 5000 and 850 < test.count() < 1150
    again = fraud.split(rows.repartition(3))[1]
    assert {r.txn_id for r in again.collect()} == {r.txn_id for r in test.collect()}


def test_train_save_load_score(spark, tmp_path):
    path = f"{tmp_path}/model"
    assert fraud.load_model(spark, path) is None
    assert fraud.train(transactions(spark), path) > 0.95
    model = fraud.load_model(spark, path)
    assert model.stages[-1].getNumTrees == fraud.TREES
    asked = spark.createDataFrame([("payment", 4500.0), ("PAYMENT", 100.0)], "txn_type string, amount double")
    got = fraud.score(asked, model).collect()
    assert [r.is_fraud for r in got] == [True, False]
    assert all(0 <= r.risk_score <= 1 and r.risk_pct == round(r.risk_score * 100, 1) for r in got)


def test_rule_without_a_model(spark):
    asked = spark.createDataFrame([("PAYMENT", 3000.01), ("TOP_UP", 3000.0)], "txn_type string, amount double")
    got = fraud.score(asked, None).collect()
    assert [(r.risk_score, r.is_fraud, r.risk_pct) for r in got] == [(0.8, True, 80.0), (0.1, False, 10.0)]


def put(folder, text):
    os.makedirs(folder)
    with open(f"{folder}/part.csv", "w") as f:
        f.write(text)
    return str(folder)


def test_load_folder(spark, tmp_path):
    paths = {
        "ReadMe first": put(tmp_path / "r", "a,b\n1,2\n"),
        "corebank.customer": put(tmp_path / "c", " CIF ,Full_Name,,NATIONAL_ID\nC1,Ann,x,ID1\n,,,\nC2,Bo,,ID2\n"),
        "ewallet.balance": put(tmp_path / "b", "id,one,two,three,four,extra\n1,10.5,9.5,1,2024-01-02 00:00:00,zz\n"),
        "ewallet.topup": put(tmp_path / "t", "topup_id,amount\n"),
        "notes.free": put(tmp_path / "n", "Key,Value\nk,v\n"),
    }
    target = f"{tmp_path}/out"
    for _ in range(2):
        loaded = files.load_folder(spark, paths, target)
    assert loaded == ["corebank.customer", "ewallet.balance", "notes.free"]
    customers = spark.read.parquet(f"{target}/corebank.customer").orderBy("cif").collect()
    assert [(r.cif, r.full_name, r.national_id, r.phone) for r in customers] == [
        ("C1", "Ann", "ID1", None), ("C2", "Bo", "ID2", None),
    ]
    balance = spark.read.parquet(f"{target}/ewallet.balance").first()
    assert (balance.account_id, str(balance.current_balance), str(balance.frozen_amount)) == (1, "10.50", "1.00")
    assert spark.read.parquet(f"{target}/notes.free").columns == ["key", "value"]


def test_parquet_files_load_too(spark, tmp_path):
    spark.createDataFrame([("C1", "Ann"), (None, None)], "CIF string, Full_Name string").write.parquet(f"{tmp_path}/c")
    loaded = files.load_folder(spark, {"corebank.customer": f"{tmp_path}/c"}, f"{tmp_path}/out", kind="parquet")
    assert loaded == ["corebank.customer"]
    assert spark.read.parquet(f"{tmp_path}/out/corebank.customer").count() == 1
