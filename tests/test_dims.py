import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import quality
from ledgerloom.plans import dims
from ledgerloom.sources import seeds

BANK = [
    # cif, name, national id, phone
    ("C1", " ann lee ", "ID1", "(09) 1-1"),
    ("C2", "Bob", "ID2", "0922"),
    ("C3", "Cy", None, "09-33"),
    ("C4", "Di", None, None),
]
WALLET = [
    # account, user, phone, name, national id, level, status
    (1, "W1", "0811", "Ann L", "ID1", "ADVANCED", "ACTIVE"),
    (2, "W2", "0812", "ann twice", "ID1", "BASIC", "ACTIVE"),
    (3, "W3", "09 33", "cy w", None, "BASIC", "ACTIVE"),
    (4, "W4", "0844", " eve ", None, "STANDARD", "SUSPENDED"),
    (5, "W5", None, "fay", None, "BASIC", "ACTIVE"),
    (6, "W6", None, "gus", None, "BASIC", "ACTIVE"),
]


@pytest.fixture
def bank(spark):
    df = spark.createDataFrame(BANK, "cif string, full_name string, national_id string, phone string")
    return schemas.conform(df, "corebank.customer")


@pytest.fixture
def wallet(spark):
    df = spark.createDataFrame(
        WALLET, "account_id long, user_id string, phone_number string, full_name string, "
        "national_id string, kyc_level string, account_status string"
    )
    return schemas.conform(df, "ewallet.account")


def test_identity_resolution(bank, wallet):
    got = {
        (r.bank_cif, r.wallet_user_id): (r.national_id, r.phone_number, r.full_name, r.is_wallet_user,
                                         r.is_borrower, r.kyc_level)
        for r in dims.resolve_customers(bank, wallet).collect()
    }
    assert got == {
        # one bank customer with two wallets appears twice, bank values first
        ("C1", "W1"): ("ID1", "0911", "ANN LEE", True, True, "TIER_2"),
        ("C1", "W2"): ("ID1", "0911", "ANN LEE", True, True, "TIER_2"),
        ("C2", None): ("ID2", "0922", "BOB", False, True, "TIER_2"),
        # both without a national id, matched by phone; the stored id has its own prefix
        ("C3", "W3"): ("PH_0933", "0933", "CY", True, True, "TIER_2"),
        # no id and no phone: matches nothing and stays
        ("C4", None): (None, None, "DI", False, True, "TIER_2"),
        (None, "W4"): ("PH_0844", "0844", "EVE", True, False, "STANDARD"),
        (None, "W5"): (None, None, "FAY", True, False, "BASIC"),
        (None, "W6"): (None, None, "GUS", True, False, "BASIC"),
    }


def test_customer_dimension_has_one_unknown_member(bank, wallet):
    got = dims.customer_dimension(bank, wallet).orderBy("customer_sk").collect()
    assert [r.customer_sk for r in got] == list(range(1, 10))
    assert tuple(got[0]) == (1, "N/A", "N/A", "General/Unknown/N/A", False, False, "TIER_0", None, None)


def test_known_customers_keep_their_keys(bank, wallet, rows):
    first = dims.customer_dimension(bank, wallet.where("account_id <> 4"))
    again = dims.customer_dimension_keeping_keys(bank, wallet, first)
    before = {tuple(r)[1:]: r.customer_sk for r in first.collect()}
    after = {tuple(r)[1:]: r.customer_sk for r in again.collect()}
    assert {k: after[k] for k in before} == before
    assert sorted(after.values()) == list(range(1, 10))


def test_deduplication_log_names_the_merged_wallets(bank, wallet):
    log = dims.deduplication_log(dims.customer_dimension(bank, wallet)).collect()
    assert sorted(r.merged_source_id for r in log) == ["W1", "W2", "W3"]
    assert {str(r.confidence_score) for r in log} == {"0.95"}


def test_merchants_keep_a_missing_name_and_skip_the_unknown_id(spark):
    events = spark.createDataFrame([("Shop",), (None,), ("Shop",), (None,), ("NA",)], "merchant_name string")
    got = dims.merchant_dimension(events).orderBy("merchant_sk").collect()
    assert tuple(got[0]) == (1, "NA", "General/Unknown")
    assert {(r.source_merchant_id, r.merchant_name) for r in got[1:]} == {("Shop", "Shop"), (None, None)}
    assert [r.merchant_sk for r in got] == [1, 2, 3]


def test_products_of_wallets_and_loans(spark, bank, wallet):
    loans = schemas.conform(
        spark.createDataFrame(
            [("L1", "C2", "B1"), ("L2", "C2", "B1"), ("L3", "nobody", "B1"), ("L4", "C1", None)],
            "contract_no string, cif string, branch_code string",
        ),
        "corebank.mortgage_loan",
    )
    customers = dims.customer_dimension(bank, wallet)
    got = dims.product_dimension(wallet, loans, customers).orderBy("product_sk").collect()
    assert tuple(got[0]) == (1, 1, "N/A", "N/A", "N/A")
    assert [r.product_sk for r in got] == list(range(1, len(got) + 1))
    kinds = [(r.product_type, r.source_account_id, r.status) for r in got[1:]]
    assert sorted(kinds, key=repr) == sorted(
        [("WALLET_ACCOUNT", str(a[0]), a[6]) for a in WALLET]
        + [("MORTGAGE_LOAN", "B1_C2", "ACTIVE")] * 2
        # customer C1 holds two rows; without a branch the id is null
        + [("MORTGAGE_LOAN", None, "ACTIVE")] * 2,
        key=repr,
    )


def test_calendar(spark):
    days = seeds.calendar(spark)
    full = dims.missing_days(days, None)
    assert full.count() == 1461
    row = full.where("full_date = DATE '2024-03-02'").first()
    assert tuple(row) == (427, dt.date(2024, 3, 2), 2, 3, 1, 2024, "Saturday ", "March    ", "true")
    rest = dims.missing_days(days, full.where("year < 2026"), first_key=5000)
    assert rest.count() == 365 and rest.agg(F.min("full_date")).first()[0] == dt.date(2026, 1, 1)
    assert dims.missing_days(days, full).count() == 0


def test_new_merchants_lack_a_code(spark):
    events = spark.createDataFrame([("Old",), ("New",), ("New",), (None,)], "merchant string")
    dim = spark.createDataFrame([(1, "O", "Old")], "merchant_key long, merchant_code string, merchant_name string")
    fresh = dims.new_merchants(events, dim)
    assert sorted(map(tuple, fresh.collect()), key=repr) == [("New", "General"), (None, "General")]
    broken = quality.null_rows(schemas.conform(fresh, "star.dim_merchant"), ["merchant_code"])
    assert broken.count() == 2


def test_versions_of_a_changed_customer(spark):
    shape = "customer_key long, cif_number string, full_name string, phone_number string, effective_date date, " \
            "expiry_date date, is_current boolean"
    d0, d1 = dt.date(2020, 1, 1), dt.date(2021, 1, 1)
    dim = spark.createDataFrame(
        [(1, "A", "Ann", "1", d0, None, True), (2, "B", "Bo", None, d0, None, True),
         (3, "C", "Cy", "3", d0, d1, False), (4, "D", "Di", "4", d0, None, True)], shape
    )
    arrived = spark.createDataFrame(
        [("A", "Anna", "1"), ("B", "Bo", None), ("C", "Cy", "3"), ("E", "Eve", "5")],
        "cif_number string, full_name string, phone_number string",
    )
    got = dims.scd2_merge(dim, arrived, "customer_key", "cif_number", ["full_name", "phone_number"], "2024-05-01")
    day = dt.date(2024, 5, 1)
    found = {tuple(r)[1:] for r in got.collect()}
    assert found == {
        ("A", "Ann", "1", d0, day, False), ("A", "Anna", "1", day, None, True),
        ("B", "Bo", None, d0, None, True), ("C", "Cy", "3", d0, d1, False), ("C", "Cy", "3", day, None, True),
        ("D", "Di", "4", d0, None, True), ("E", "Eve", "5", day, None, True),
    }
    assert sorted(r.customer_key for r in got.collect()) == [1, 2, 3, 4, 5, 6, 7]
    twice = dims.scd2_merge(
        dim, arrived.unionAll(arrived), "customer_key", "cif_number", ["full_name", "phone_number"], "2024-05-01")
    assert sorted(map(tuple, twice.collect()), key=repr) == sorted(map(tuple, got.collect()), key=repr)
    other = arrived.unionAll(arrived.where("cif_number = 'A'").withColumn("full_name", F.lit("Anne")))
    with pytest.raises(Exception, match="named twice"):
        dims.scd2_merge(
            dim, other, "customer_key", "cif_number", ["full_name", "phone_number"], "2024-05-01").collect()


def test_seed_rows(spark):
    customers = seeds.seed_customers(seeds.series(spark, seeds.SEED_CUSTOMERS))
    assert customers.count() == 200
    assert tuple(customers.where("cif = 'CIF000007'").first()) == (
        "CIF000007", "Customer 7", "0000000007", "0900000007"
    )
    wallets = seeds.seed_wallets(seeds.series(spark, seeds.SEED_WALLETS))
    assert wallets.count() == 250
    levels = {r.user_id: r.kyc_level for r in wallets.collect()}
    assert [levels[f"W000{500 + n}"] for n in (1, 2, 3, 6)] == ["BASIC", "STANDARD", "ADVANCED", "ADVANCED"]
