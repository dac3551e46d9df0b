"""The refresh stream rebuilds from the whole presence table when files arrive."""
import datetime as dt


def test_refresh_rebuilds_on_arrival(spark, tmp_path):
    from vigilo.operators.presence import presence_features
    from vigilo.streaming import start_profile_refresh
    src = tmp_path / "presence"
    rows = [("s1", dt.date(2024, 1, 1) + dt.timedelta(days=i), i % 2) for i in range(10)]
    spark.createDataFrame(rows, "student_id string, date date, is_present int").write.parquet(str(src / "batch1"))
    seen = []

    def rebuild(full):
        seen.append(presence_features(full.withColumnRenamed("student_id", "id")).first()["attendance_rate"])

    q = start_profile_refresh(spark, str(src / "*"), rebuild, name=f"t{abs(hash(str(tmp_path)))}")
    q.awaitTermination(120)
    assert seen == [0.5]
