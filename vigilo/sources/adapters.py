"""Adapters from the shared test tables onto the reference's data model.

* presence — one row per (entity, day): an entity of ``events`` is present on
  a day when it has any event that day; the day set is every day with any
  event at all.
* periods — every order of a customer is one of its periods, numbered 1..n by
  (date, order key); the latest is the label, all earlier ones the history.
* entity dimension — class = nation name of the customer.

Everything is derived by Spark from the given tables, so the work grows with
them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the period adapter: order status -> payment status,
# account-balance cut points for the income bracket.
STATUS_OF_ORDER = {"F": 0, "O": 1}  # anything else (P) -> 2
INCOME_LOW_BELOW, INCOME_MEDIUM_BELOW = 1200.0, 6800.0


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def presence_from_events(events: DataFrame, id_col: str = "user_id", ts_col: str = "ts") -> DataFrame:
    """(id, date, is_present) grid: every event entity x every event day.

    Plan: one ``groupBy(entity)`` collects the entity's distinct event days
    (partial aggregation map-side, so a hot entity ships at most one set per
    map task, each bounded by the number of days). Each entity row then
    emits its present days and the other event days (``array_except``, a hash
    set difference — O(days), no per-day probing). The distinct event days (a
    date each, however far apart) are a scalar subquery of the same plan, so
    building the plan starts no job. The output is partitioned by entity, which
    the feature window reuses.
    """
    day = F.to_date(F.col(ts_col))
    calendar = events.agg(F.collect_set(day)).scalar()
    per_entity = events.groupBy(F.col(id_col).alias("id")).agg(F.collect_set(day).alias("_days"))
    per_entity = per_entity.withColumn("_calendar", calendar)
    rows = F.concat(
        F.transform("_days", lambda d: F.struct(d.alias("date"), F.lit(1).alias("is_present"))),
        F.transform(F.array_except("_calendar", "_days"),
                    lambda d: F.struct(d.alias("date"), F.lit(0).alias("is_present"))))
    return per_entity.select("id", F.inline(rows))


#: Orders beyond which a customer's orders are numbered month by month, each in a task of its own.
HOT_ORDERS = 1_000_000


def _numbered(orders: DataFrame, hot_orders: int | None = None) -> DataFrame:
    """Orders with ``term`` (1..n per customer by date, key) and the previous order's date.

    One window per customer, and per month for hot customers: those with more
    than HOT_ORDERS orders (so one in HOT_ORDERS of all orders at most, a table
    that Spark broadcasts or not by its size). A hot customer's months get the
    count and last date of the months before from one row per month. The plan is
    built without a job and without writing anything; without hot customers the
    branch is empty and adaptive execution drops its joins.
    """
    most = F.lit(HOT_ORDERS if hot_orders is None else hot_orders)
    hot = (orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
           .select(F.col("o_custkey").alias("_hot")))
    month = (F.year("_d") * 12 + F.month("_d")).cast("int")
    marked = orders.join(hot, orders["o_custkey"] == hot["_hot"], "left")
    marked = marked.withColumn("_part", F.when(F.col("_hot").isNotNull(), month).otherwise(F.lit(0))).drop("_hot")
    inside = Window.partitionBy("o_custkey", "_part").orderBy("_d", "o_orderkey")
    local = marked.withColumn("_rn", F.row_number().over(inside)).withColumn("_prev", F.lag("_d").over(inside))
    before = Window.partitionBy("_c").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    carry = (orders.join(hot, orders["o_custkey"] == hot["_hot"], "left_semi")
             .groupBy(F.col("o_custkey").alias("_c"), month.alias("_m")).agg(F.count(F.lit(1)).alias("_n"), F.max("_d").alias("_end"))
             .select("_c", "_m", F.sum("_n").over(before).alias("_skip"), F.max("_end").over(before).alias("_carry")))
    return (local.join(carry, (local["o_custkey"] == carry["_c"]) & (local["_part"] == carry["_m"]), "left")
            .withColumn("term", (F.col("_rn") + F.coalesce("_skip", F.lit(0))).cast("int"))
            .withColumn("_prev", F.coalesce("_prev", "_carry")).drop("_part", "_rn", "_skip", "_carry", "_c", "_m"))


def periods_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Every order of a customer as a period; the gap in days to the previous order is the
    "days since last payment" (0 for the first).

    Customers meet their orders by a shuffle: judged by the size of their compressed files they
    would be broadcast, and the driver would hold all of them, eight times that size and more.
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                      F.to_date("o_orderdate").alias("_d"))
    numbered = _numbered(o)
    status = F.coalesce(
        F.create_map(*[x for k, v in STATUS_OF_ORDER.items() for x in (F.lit(k), F.lit(v))])[F.col("o_orderstatus")],
        F.lit(2))
    cust = customer.select("c_custkey", "c_acctbal", "c_nationkey")
    return (numbered.join(cust.hint("merge"), numbered.o_custkey == cust.c_custkey)
            .select(
                F.col("o_custkey").alias("id"),
                "term",
                status.cast("int").alias("status"),
                F.coalesce(F.datediff("_d", "_prev"), F.lit(0)).cast("int").alias("days_since_last_payment"),
                F.when(F.col("c_acctbal") < INCOME_LOW_BELOW, "Low")
                 .when(F.col("c_acctbal") < INCOME_MEDIUM_BELOW, "Medium")
                 .otherwise("High").alias("family_income_bracket"),
                F.pmod(F.col("c_nationkey"), F.lit(2)).cast("int").alias("transport_user"),
                F.pmod(F.col("c_nationkey"), F.lit(4)).cast("int").alias("sibling_count"),
                F.when(F.col("o_orderstatus") == "F", F.lit(0.0))
                 .otherwise(F.col("o_totalprice")).alias("total_outstanding")))


def entity_dim_from_events(events: DataFrame, customer: DataFrame, nation: DataFrame,
                           id_col: str = "user_id") -> DataFrame:
    """(id, class): class of an event entity = nation name of the customer with that key."""
    users = events.select(F.col(id_col).alias("id")).distinct()
    return (users.join(customer.select(F.col("c_custkey").alias("id"), "c_nationkey"), "id")
                 .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("class")),
                       "c_nationkey")
                 .select("id", "class"))


def class_dimension(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """(id, class) for every customer: the build side when the caller's own join already restricts the ids."""
    return (customer.select(F.col("c_custkey").alias("id"), "c_nationkey")
            .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("class")),
                  "c_nationkey")
            .select("id", "class"))


def anomaly_labels(presence: DataFrame, cut: float = 0.85) -> DataFrame:
    """(id, is_anomaly) test label: presence rate below ``cut`` (surrogate risk > 50)."""
    return (presence.groupBy("id").agg(F.avg(F.col("is_present").cast("double")).alias("_r"))
            .select("id", (F.col("_r") < F.lit(cut)).cast("int").alias("is_anomaly")))


class TestTables:
    """Lazily derived model tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = load(self.spark, self.sf_dir, name)
        return self._cache[name]

    @property
    def presence(self) -> DataFrame:
        if "_presence" not in self._cache:
            self._cache["_presence"] = presence_from_events(self.raw("events"))
        return self._cache["_presence"]

    @property
    def periods(self) -> DataFrame:
        if "_periods" not in self._cache:
            self._cache["_periods"] = periods_from_orders(self.raw("orders"), self.raw("customer"))
        return self._cache["_periods"]

    @property
    def class_dim(self) -> DataFrame:
        if "_class_dim" not in self._cache:
            self._cache["_class_dim"] = class_dimension(self.raw("customer"), self.raw("nation"))
        return self._cache["_class_dim"]

    @property
    def dim(self) -> DataFrame:
        if "_dim" not in self._cache:
            self._cache["_dim"] = entity_dim_from_events(self.raw("events"), self.raw("customer"),
                                                         self.raw("nation"))
        return self._cache["_dim"]
