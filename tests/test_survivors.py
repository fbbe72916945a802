from ledgerloom.operators import tables
from ledgerloom.plans import daily, dims
from test_daily import DAY, natural, put, warehouse  # noqa: F401 - the fixture

DIM = "customer_sk long, bank_cif string, wallet_user_id string"
BANK = "cif string, full_name string, national_id string, phone string"


def retired(spark, before, after, earlier=None):
    df = dims.retired_customers(spark.createDataFrame(before, DIM), spark.createDataFrame(after, DIM), earlier)
    return tables.stored(df, "retired")


def ways(df):
    return {r.customer_sk: r.surviving_customer_sk for r in df.collect()}


def test_where_the_keys_go(spark):
    before = [(1, None, None), (2, "C1", None), (3, "C2", None), (4, None, "W1"), (5, None, "W2"), (6, "C3", None)]
    # C1 owns both wallets, C3 is gone
    after = [(1, None, None), (4, "C1", "W1"), (5, "C1", "W2"), (3, "C2", None)]
    found = retired(spark, before, after)
    assert ways(found) == {2: 4, 6: None}
    # then the first wallet goes to C2, which loses its key; C1 keeps the second
    later = [(1, None, None), (4, "C2", "W1"), (5, "C1", "W2")]
    found = retired(spark, after, later, found)
    assert ways(found) == {2: 5, 3: 4, 6: None}
    # a customer whose ids are gone stays where it went, and goes on from there
    last = [(1, None, None), (4, "C2", "W1"), (9, "C7", "W2")]
    found = retired(spark, later, last, found)
    assert ways(found) == {2: 9, 3: 4, 5: 9, 6: None}


def test_a_way_has_one_step(spark):
    earlier = retired(spark, [(2, "C1", None), (3, None, "W1")], [(3, "C1", "W1")])
    assert ways(earlier) == {2: 3}
    second = retired(spark, [(3, "C1", "W1")], [(7, None, "W1")], earlier)
    assert ways(second) == {2: 7, 3: 7}
    third = retired(spark, [(7, None, "W1")], [(7, None, "W1")], second)
    assert ways(third) == ways(second)


def test_keys_of_the_dead_are_not_given_again(warehouse):  # noqa: F811
    w = warehouse
    daily.run_daily(w, DAY)
    first = natural(w)
    keys = {r.customer_sk for r in w.table("mdm.dim_customer").collect()}
    # the loan's customer turns out to own the second wallet, then two others arrive
    bank = [("C1", "ann", "ID1", "1"), ("C2", "bo", "ID9", "2")]
    put(w, "corebank.customer", bank, BANK)
    daily.load_dimensions(w)
    gone = keys - {r.customer_sk for r in w.table("mdm.dim_customer").collect()}
    assert len(gone) == 1
    put(w, "corebank.customer", [*bank, ("C5", "di", "ID5", "5"), ("C6", "ed", "ID6", "6")], BANK)
    daily.load_dimensions(w)
    held = {r.bank_cif: r.customer_sk for r in w.table("mdm.dim_customer").collect()}
    assert not gone & set(held.values())
    assert ways(w.retired()) == {next(iter(gone)): held["C2"]}

    def under_survivors(rows):
        customers = w.table("mdm.dim_customer").select("customer_sk", "bank_cif", "wallet_user_id")
        products = w.table("mdm.dim_product_account").select("product_sk", "source_account_id")
        joined = rows.join(customers, "customer_sk").join(products, "product_sk")
        return {(r.source_trans_id, r.bank_cif, r.wallet_user_id, r.source_account_id) for r in joined.collect()}

    def joined_ids(row):
        event, bank_cif, wallet, account = row
        return (event, "C2", "W2", account) if bank_cif == "C2" or wallet == "W2" else row

    # no fact is lost, and the loan's account keeps its key
    expected = {joined_ids(r) for r in first}
    assert under_survivors(w.facts()) == expected
    assert under_survivors(w.stored(daily.FACTS)) != expected
    # written under the surviving key: files of other days stay as they are
    files = {r[0] for r in w.stored(daily.FACTS).selectExpr("_metadata.file_path").distinct().collect()}
    assert daily.move_facts(w) > 0
    after = {r[0] for r in w.stored(daily.FACTS).selectExpr("_metadata.file_path").distinct().collect()}
    assert files & after and files != after
    assert under_survivors(w.stored(daily.FACTS)) == expected
    assert daily.move_facts(w) == 0


def test_renumbering_forgets_the_dead(warehouse):  # noqa: F811
    w = warehouse
    daily.load_dimensions(w)
    put(w, "corebank.customer", [("C1", "ann", "ID1", "1")], BANK)
    daily.load_dimensions(w)
    assert w.retired().count() == 1
    daily.load_dimensions(w, renumber=True)
    assert w.retired().count() == 0


def test_update_using_without_a_match_writes_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), path)
    changes = spark.createDataFrame([(7, 8)], "k long, n long")
    assert tables.update_using(spark, path, changes, "k", "n") == 0
    changes = spark.createDataFrame([(2, 8)], "k long, n long")
    assert tables.update_using(spark, path, changes, "k", "n") == 1
    assert sorted((r.k, r.v) for r in tables.read(spark, path).collect()) == [(1, "a"), (8, "b")]
