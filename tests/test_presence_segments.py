"""Presence features from merged date segments: the same rows, whatever the cuts."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vigilo.operators import presence as A
from vigilo.operators import presence_segments as PS

START = dt.date(2023, 1, 1)
SCHEMA = "id long, date date, is_present int"


def records(n_entities=25, days=400, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n_entities):
        p = rng.choice([0.0, 0.2, 0.5, 0.9, 1.0])
        for d in sorted(rng.sample(range(days), rng.choice([1, 2, 29, 30, 31, 120, days]))):
            rows.append((i, START + dt.timedelta(d), int(rng.random() < p)))
    return rows


def features(df):
    out = df.select("id", F.round("attendance_rate", 9), "longest_absence_streak", "absence_in_last_30_days", F.round("day_of_week_variance", 9))
    return sorted((tuple(r) for r in out.collect()), key=lambda r: str(r[0]))


@pytest.mark.parametrize("segment_days, fan_in", [(1, 2), (7, 3), (64, 64), (1000, 2)])
def test_same_rows_as_the_window_form(spark, segment_days, fan_in):
    df = spark.createDataFrame(records(), SCHEMA).repartition(5)
    merged = PS.merge_segments(PS.segment_summaries(df, segment_days=segment_days), fan_in=fan_in)
    assert features(PS.features_from_summary(merged)) == features(A.presence_features(df))


def test_merging_is_associative_with_a_neutral_element(spark):
    """(a b) c = a (b c) for every cut of some runs, empty parts included."""
    runs = [[0, 0, 1, 0], [1], [0] * 5, [0, 1, 1, 0, 0], [1, 0] * 9, []]
    rows = [(i, [(START + dt.timedelta(k), f) for k, f in enumerate(r)], a, b)
            for i, r in enumerate(runs) for a in range(len(r) + 1) for b in range(a, len(r) + 1)]
    df = spark.createDataFrame(rows, "i int, r array<struct<d:date,f:int>>, a int, b int")
    part = lambda lo, hi: PS._folded(F.transform(F.slice("r", lo + 1, hi - lo), lambda x: F.struct(PS._one(x["d"], x["f"]).alias("s"))), 3)
    a, b, c = part(F.lit(0), F.col("a")), part(F.col("a"), F.col("b")), part(F.col("b"), F.size("r"))
    out = df.select(part(F.lit(0), F.size("r")).alias("whole"), a.alias("x"), b.alias("y"), c.alias("z"))
    left, right = PS.merge(PS.merge(F.col("x"), F.col("y"), 3), F.col("z"), 3), PS.merge(F.col("x"), PS.merge(F.col("y"), F.col("z"), 3), 3)
    assert out.where((left != F.col("whole")) | (right != F.col("whole"))).count() == 0
    assert out.where(PS.merge(PS._empty(), F.col("whole"), 3) != F.col("whole")).count() == 0


def test_a_hot_entity_is_spread_over_tasks(spark):
    """One entity with more than a third of all records: they are grouped by (entity, segment), no key holds more than a segment."""
    long = spark.range(30_000).select(F.lit(0).cast("long").alias("id"), F.date_add(F.lit(dt.date(1900, 1, 1)), F.col("id").cast("int")).alias("date"),
                                      (F.col("id") % 3 > 0).cast("int").alias("is_present"))
    others = spark.range(20_000).select((F.col("id") % 200 + 1).alias("id"), F.date_add(F.lit(START), (F.col("id") / 200).cast("int")).alias("date"),
                                        F.lit(1).alias("is_present"))
    df = long.unionByName(others)
    segments = PS.segment_summaries(df).repartition(8, "id", "segment").withColumn("task", F.spark_partition_id()).persist()
    tasks = segments.where("id = 0").groupBy("task").agg(F.sum("summary.n").alias("n")).collect()
    assert len(tasks) == 8 and max(r["n"] for r in tasks) < 30_000 / 4
    assert segments.agg(F.max("summary.n")).first()[0] <= PS.SEGMENT_DAYS
    hot = PS.features_from_summary(PS.merge_segments(segments.drop("task"))).where("id = 0").first()
    assert (hot["longest_absence_streak"], hot["absence_in_last_30_days"]) == (1, 10)
    segments.unpersist()


@pytest.mark.parametrize("cut", [0, 100, 393, 400])
def test_appended_days_touch_their_segments_only(spark, cut):
    rows = records()
    old = [r for r in rows if (r[1] - START).days < cut]
    new = [r for r in rows if (r[1] - START).days >= cut]
    new += [(i, d, 1 - f) for i, d, f in old[-20:]] + [(99, START, 0)]     # corrections of known days, an entity never seen
    history, arrived = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    stored = PS.segment_summaries(history, segment_days=16)
    now = PS.append_records(stored, history, arrived, segment_days=16)
    latest = {(i, d): f for i, d, f in old + new}
    whole = spark.createDataFrame([(i, d, f) for (i, d), f in latest.items()], SCHEMA)
    assert features(PS.features_from_summary(PS.merge_segments(now))) == features(A.presence_features(whole))
    untouched = stored.join(arrived.select("id", F.floor(F.unix_date("date") / 16).alias("segment")).distinct(), ["id", "segment"], "left_anti")
    assert untouched.join(now, ["id", "segment", "summary"], "left_anti").count() == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert PS.presence_features_by_segments(none).collect() == []
    some = spark.createDataFrame(records(3), SCHEMA)
    stored = PS.segment_summaries(some)
    assert PS.append_records(stored, some, none) is stored
    assert features(PS.features_from_summary(PS.merge_segments(PS.append_records(PS.segment_summaries(none), none, some)))) == features(A.presence_features(some))
