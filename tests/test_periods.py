"""Period features: leak-free history, worst status, rounding, single period, unknown bracket."""
import pytest
from pyspark.sql import functions as F

from vigilo.operators import periods as FP

COLS = "id string, term int, status int, days_since_last_payment int, family_income_bracket string, " \
       "transport_user int, sibling_count int, total_outstanding double"


@pytest.fixture(scope="module")
def df(spark):
    rows = [
        ("a", 1, 1, 10, "Low", 0, 1, 100.0), ("a", 2, 2, 25, "Low", 0, 1, 200.125), ("a", 3, 0, 0, "High", 1, 3, 0.0),
        ("b", 3, 2, 50, "Medium", 1, 0, 900.0),                           # single period
        ("c", 1, 0, 0, "Gold", 0, 0, 0.0), ("c", 2, 0, 1, "Gold", 0, 0, 0.0),   # unknown bracket
    ]
    return spark.createDataFrame(rows, COLS)


def test_period_features(df):
    got = {r["id"]: r for r in FP.period_features(df).collect()}
    a = got["a"]
    assert a["days_since_last_payment"] == 17.5                   # mean of history only
    assert a["previous_term_status"] == 2                          # worst, not best
    assert a["total_outstanding"] == 150.06                        # 150.0625 -> half-even at 2 dp
    assert (a["income_encoded"], a["transport_user"], a["sibling_count"], a["label"]) == (0, 1, 3, 0)
    assert "b" not in got                                          # no history -> dropped
    assert got["c"]["income_encoded"] is None                      # unknown -> NULL (null check fails)


def test_keep_no_history(df):
    got = {r["id"]: r for r in FP.period_features(df, keep_no_history=True).collect()}
    assert got["b"]["days_since_last_payment"] is None and got["b"]["label"] == 2


def test_split_latest_and_inputs(df):
    s = {r["id"]: r for r in FP.split_latest(df).collect()}
    assert (s["a"]["label_term"], s["a"]["label"], s["a"]["n_history"]) == (3, 0, 2)
    m = {r["id"]: r for r in FP.model_inputs(FP.period_features(df)).collect()}
    assert m["a"]["has_many_siblings"] == 1 and m["a"]["was_late_or_worse"] == 1
    assert m["a"]["days_x_outstanding"] == pytest.approx(17.5 * 150.06 / 10000)


def test_every_order_becomes_a_period_also_for_a_hot_customer(spark):
    """One customer holds a third of all orders and crosses many partition borders; dates tie."""
    from pyspark.sql import Window
    from vigilo.sources.adapters import periods_from_orders
    orders = spark.range(3000).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 3 == 0, 7).otherwise(100 + F.col("id") % 40).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"), (F.col("id") * 1.25).alias("o_totalprice"),
        F.date_add(F.lit("1992-01-01").cast("date"), ((F.col("id") * 37) % 900).cast("int")).alias("o_orderdate"))
    customer = spark.range(200).select(F.col("id").alias("c_custkey"), F.lit(10.0).alias("c_acctbal"), F.lit(3).alias("c_nationkey"))
    got = {(r.id, r.term): r.days_since_last_payment for r in periods_from_orders(orders, customer).collect()}
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    want = orders.select("o_custkey", F.row_number().over(w).alias("t"),
                         F.coalesce(F.datediff("o_orderdate", F.lag("o_orderdate").over(w)), F.lit(0)).alias("d")).collect()
    assert len(got) == 3000 and got == {(r.o_custkey, r.t): r.d for r in want}


def test_calendar_may_span_centuries(spark):
    from vigilo.sources.adapters import presence_from_events
    ev = spark.sql("select * from values (1, timestamp'1900-01-01 10:00:00'), (1, timestamp'2024-05-06 00:00:00'), "
                   "(2, timestamp'9999-12-31 00:00:00'), (3, cast(null as timestamp)) as t(user_id, ts)")
    rows = presence_from_events(ev).collect()
    assert len(rows) == 9 and sum(r.is_present for r in rows) == 3
