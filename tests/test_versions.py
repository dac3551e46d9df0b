"""Versioned artifacts: whole or absent, bound to their training rows."""
import glob
import os

import pytest
from pyspark.sql import functions as F

from vigilo.sources import versions as V


def save(spark, model, path):
    spark.createDataFrame([(model,)], "m string").coalesce(1).write.parquet(f"{path}/a")
    spark.createDataFrame([(len(model),)], "n int").coalesce(1).write.parquet(f"{path}/b")


def load(spark, path):
    return spark.read.parquet(f"{path}/a").first()["m"]


@pytest.fixture
def store(spark, tmp_path):
    calls = []

    def get(model, training=None, save=save):
        def fit():
            calls.append(model)
            return model
        return V.load_or_fit_version(spark, str(tmp_path / "m"), load, fit, save, training)
    return get, calls, str(tmp_path / "m")


def test_second_call_loads_and_versions_are_kept(spark, store):
    get, calls, path = store
    assert get("one") == "one" and get("two") == "one" and calls == ["one"]
    for name in ("two", "three", "four"):
        V.publish(spark, path, name, save)
    assert get("five") == "four" and [v[0] for v in V.versions(spark, path)] == [4, 3]


def test_a_killed_save_leaves_the_old_model(spark, store):
    get, calls, path = store
    get("old")

    def killed(spark, model, folder):
        spark.createDataFrame([(model,)], "m string").coalesce(1).write.parquet(f"{folder}/a")
        raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        V.publish(spark, path, "new", killed)
    assert get("other") == "old" and calls == ["old"]
    assert [c for _, _, c in V.versions(spark, path)] == [False, True]
    V.publish(spark, path, "newer", save)
    assert get("other") == "newer"


def test_changed_training_rows_refit_and_equal_ones_do_not(spark, store):
    get, calls, _ = store
    rows = spark.range(50).select("id", (F.col("id") * 2).alias("x"))
    assert get("a", rows) == "a"
    assert get("b", rows.repartition(7).orderBy(F.desc("x"))) == "a"
    assert get("c", rows.withColumn("x", F.when(F.col("id") == 3, 0).otherwise(F.col("x")))) == "c"
    assert get("d", rows) == "a" and calls == ["a", "c"]


def test_a_damaged_version_is_not_loaded(spark, store):
    get, calls, path = store
    get("first")
    V.publish(spark, path, "second", save)
    folder = V.versions(spark, path)[0][1].removeprefix("file:")
    os.remove(glob.glob(f"{folder}/b/part-*")[0])
    assert get("third") == "first" and calls == ["first"]
    part = glob.glob(f"{V.versions(spark, path)[1][1].removeprefix('file:')}/a/part-*")[0]
    with open(part, "ab") as f:
        f.write(b"x")
    os.remove(os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc"))  # the local file system's own guard
    assert get("third") == "third"


def test_fingerprint_counts_repeated_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    marks = {V.fingerprint(d) for d in (df, df.unionByName(df), df.unionByName(df).unionByName(df), df.limit(0), df.select("x"),
                                        df.withColumnRenamed("y", "z"), df.fillna("b"))}
    assert len(marks) == 7


def test_errors_of_a_whole_version_are_raised(spark, store):
    get, _, path = store
    get("good")
    with pytest.raises(PermissionError):
        def broken(*_):
            raise PermissionError("no access")
        V.load_or_fit_version(spark, path, broken, lambda: "x", save)
    assert len(V.versions(spark, path)) == 1
