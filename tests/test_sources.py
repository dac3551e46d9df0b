"""Readers/writers: schema'd CSV read, float->int cast on reload, round trip, missing input."""
import pytest

from vigilo.sources import readers as R
from vigilo.sources.readers import MissingInputError


def test_feature_round_trip_and_casts(spark, tmp_path):
    p = tmp_path / "att.csv"
    p.write_text("student_id,attendance_rate,longest_absence_streak,absence_in_last_30_days,"
                 "day_of_week_variance,is_anomaly\nSTU_001,0.9,7.0,24.0,0.001,0\n")
    df = R.read_features(spark, str(p), "presence")
    r = df.first()
    assert r["longest_absence_streak"] == 7 and isinstance(r["absence_in_last_30_days"], int)
    R.write_features(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.collect() == df.collect()


def test_presence_csv(spark, tmp_path):
    p = tmp_path / "presence.csv"
    p.write_text("student_id,date,is_present\nSTU_001,2023-08-01,1\nSTU_001,2023-08-02,0\n")
    df = R.read_presence(spark, str(p))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "date", "int"]
    assert df.count() == 2


def test_require_inputs(spark, tmp_path):
    with pytest.raises(MissingInputError, match="feature step"):
        R.require_inputs(spark, {str(tmp_path / "nope.csv"): "the feature step"})
    assert R.read_entity_dim(spark, str(tmp_path / "nope.parquet")) is None


def test_entity_dim_optional_class(spark, tmp_path):
    p = tmp_path / "labels.csv"
    p.write_text("student_id,is_anomaly\nSTU_001,1\nSTU_002,0\n")
    df = R.read_entity_dim(spark, str(p))
    rows = {r["student_id"]: r for r in df.collect()}
    assert rows["STU_001"]["is_anomaly"] == 1 and rows["STU_001"]["class"] is None
    q = tmp_path / "labels2.csv"
    q.write_text("student_id,class,is_anomaly\nSTU_001,10A,0\n")
    assert R.read_entity_dim(spark, str(q)).first()["class"] == "10A"
