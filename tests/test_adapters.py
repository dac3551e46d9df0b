"""The adapters over the test tables: plans without jobs, numbering with hot customers."""
import datetime as dt
import os
import random

import pytest

from vigilo.sources import adapters as AD

SF = "/root/testdata/sf0.001"
#: Queries that fit a model, rank or page something first; all others only build a plan.
EAGER = ("m", "e4_", "d8_keyset_page", "d11_score_ids_anomaly_model", "d12_score_ids_fee_model", "b11_drill_down_class_metrics", "s5_",
         "a5_segment_summaries", "a5_appended_days")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
def test_building_a_query_starts_no_job_and_writes_nothing(spark):
    from vigilo.plans import models  # noqa: F401
    from vigilo.plans.catalog import REGISTRY
    from vigilo.session import ensure_checkpoint_dir
    sc = spark.sparkContext
    shared = ensure_checkpoint_dir(spark).removeprefix("file:")
    written = lambda: sorted(os.path.join(d, f) for d, _, names in os.walk(shared) for f in names)
    before, built = written(), 0
    for name, query in REGISTRY.items():
        if name.startswith(EAGER):
            continue
        sc.setJobGroup(f"plan-{name}", "planning only")
        query(spark, SF)
        # inferring a Parquet schema is the only job a plan may start
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(f"plan-{name}")]
        tasks = sum(sc.statusTracker().getStageInfo(s).numTasks for j in jobs if j for s in j.stageIds)
        assert tasks <= 6, (name, tasks)
        built += 1
    sc.setJobGroup("tests", "")
    assert written() == before and built > 80


def order_rows():
    rng = random.Random(8)
    rows = []
    for key in range(900):
        customer = 1 if key % 3 == 0 else rng.randint(2, 60)          # a third of all orders are one customer's
        rows.append((key * 7 % 901, customer, dt.date(2020, 1, 1) + dt.timedelta(rng.choice([0, 1, 30, 31, 400, rng.randint(0, 900)]))))
    return rows


@pytest.mark.parametrize("hot_orders", [0, 5, 100, None], ids=["all hot", "many hot", "one hot", "none hot"])
def test_numbering_is_the_same_however_many_customers_are_hot(spark, hot_orders):
    rows = order_rows()
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, _d date").repartition(6)
    got = {r["o_orderkey"]: (r["term"], r["_prev"]) for r in AD._numbered(orders, hot_orders).collect()}
    want = {}
    for customer in {c for _, c, _ in rows}:
        own = sorted((d, k) for k, c, d in rows if c == customer)
        for i, (d, k) in enumerate(own):
            want[k] = (i + 1, own[i - 1][0] if i else None)
    assert got == want


def test_a_hot_customer_is_numbered_month_by_month(spark):
    plan = AD._numbered(spark.createDataFrame(order_rows(), "o_orderkey long, o_custkey long, _d date"), 100)
    windows = [line for line in plan._jdf.queryExecution().optimizedPlan().toString().splitlines() if "row_number()" in line]
    assert len(windows) == 1 and "_part" in windows[0] and "o_custkey" in windows[0]


def test_presence_of_no_events(spark):
    none = spark.createDataFrame([], "user_id long, ts timestamp")
    assert AD.presence_from_events(none).collect() == []
    some = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 3)), (3, None)], "user_id long, ts timestamp")
    got = sorted((r["id"], r["date"].day, r["is_present"]) for r in AD.presence_from_events(some).collect())
    assert got == [(1, 1, 1), (1, 3, 0), (2, 1, 0), (2, 3, 1), (3, 1, 0), (3, 3, 0)]


def test_customers_are_not_broadcast_to_meet_their_orders(spark, tmp_path):
    """Files of repeated values are small, their rows are not: the driver must not hold a table that grows with the input."""
    orders = spark.createDataFrame([(1, 1, "F", 10.0, "1998-02-06"), (2, 1, "O", 20.0, "1998-03-06"), (3, 9, "O", 5.0, "1998-03-06")],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string")
    customer = spark.createDataFrame([(1, 100.0, 5), (2, 9000.0, 6)], "c_custkey long, c_acctbal double, c_nationkey int")
    for name, rows in (("orders", orders), ("customer", customer)):  # the planner knows the size of files
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    orders, customer = (AD.load(spark, str(tmp_path), name) for name in ("orders", "customer"))
    periods = AD.periods_from_orders(orders, customer)
    got = periods.orderBy("term").select("id", "term", "days_since_last_payment", "family_income_bracket", "total_outstanding").collect()
    assert [tuple(r) for r in got] == [(1, 1, 0, "Low", 0.0), (1, 2, 28, "Low", 20.0)]
    joins = [line for line in periods._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line and "c_custkey" in line]
    assert joins and all("SortMergeJoin" in line for line in joins), joins
