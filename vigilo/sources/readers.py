"""schema'd readers and writers for presence, period and feature tables.

Schemas are always explicit (never inferred). CSV and Parquet are both
accepted; the format is taken from the path suffix unless given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

PRESENCE_SCHEMA = T.StructType([
    T.StructField("student_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("is_present", T.IntegerType()),
])

PERIODS_SCHEMA = T.StructType([
    T.StructField("student_id", T.StringType()),
    T.StructField("term", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("days_since_last_payment", T.IntegerType()),
    T.StructField("family_income_bracket", T.StringType()),
    T.StructField("transport_user", T.IntegerType()),
    T.StructField("sibling_count", T.IntegerType()),
    T.StructField("total_outstanding", T.DoubleType()),
])

ENTITY_DIM_SCHEMA = T.StructType([
    T.StructField("student_id", T.StringType()),
    T.StructField("class", T.StringType()),
    T.StructField("is_anomaly", T.IntegerType()),
])

# Feature tables are stored with integral counts written as doubles ("7.0");
# they are read as double and cast to int.
PRESENCE_FEATURES_SCHEMA = T.StructType([
    T.StructField("student_id", T.StringType()),
    T.StructField("attendance_rate", T.DoubleType()),
    T.StructField("longest_absence_streak", T.DoubleType()),
    T.StructField("absence_in_last_30_days", T.DoubleType()),
    T.StructField("day_of_week_variance", T.DoubleType()),
    T.StructField("is_anomaly", T.DoubleType()),
])
PRESENCE_FEATURE_INTS = ["longest_absence_streak", "absence_in_last_30_days", "is_anomaly"]

PERIOD_FEATURES_SCHEMA = T.StructType([
    T.StructField("student_id", T.StringType()),
    T.StructField("days_since_last_payment", T.DoubleType()),
    T.StructField("previous_term_status", T.DoubleType()),
    T.StructField("total_outstanding", T.DoubleType()),
    T.StructField("income_encoded", T.DoubleType()),
    T.StructField("transport_user", T.DoubleType()),
    T.StructField("sibling_count", T.DoubleType()),
    T.StructField("label", T.DoubleType()),
])
PERIOD_FEATURE_INTS = ["previous_term_status", "income_encoded", "transport_user", "sibling_count", "label"]


class MissingInputError(FileNotFoundError):
    """An input table is absent; the message names the step that produces it."""


def _fmt(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    return "csv" if path.lower().endswith(".csv") else "parquet"


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None) -> DataFrame:
    f = _fmt(path, fmt)
    reader = spark.read.schema(schema)
    if f == "csv":
        # Columns are bound by header name: read as text, then cast (a value that does not fit fails the query).
        raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
        missing = [c.name for c in schema.fields if c.name not in raw.columns]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
        return raw.select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in schema.fields])
    return reader.format(f).load(path)


def read_presence(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Daily presence rows (entity, date, 0/1)."""
    return _read(spark, path, PRESENCE_SCHEMA, fmt)


def read_periods(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Per-period payment rows."""
    return _read(spark, path, PERIODS_SCHEMA, fmt)


def read_entity_dim(spark: SparkSession, path: str, fmt: str | None = None,
                    required: bool = False) -> DataFrame | None:
    """S3: entity dimension (id, optional class, optional label).

    The file is optional (missing -> None unless ``required``) and so is its
    class column: columns are matched by name (CSV header or Parquet
    schema), never by position; absent ones become NULL.
    """
    f = _fmt(path, fmt)
    try:
        if f == "csv":
            raw = spark.read.option("header", True).option("inferSchema", False).csv(path)  # all strings
        else:
            raw = spark.read.format(f).load(path)
        cols = set(raw.columns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        if required:
            raise MissingInputError(f"entity dimension not found at {path}")
        return None
    out = []
    for field in ENTITY_DIM_SCHEMA.fields:
        c = field.name
        out.append((F.col(c) if c in cols else F.lit(None)).cast(field.dataType).alias(c))
    if "student_id" not in cols:
        raise ValueError(f"entity dimension at {path} has no student_id column")
    return raw.select(*out)


def read_features(spark: SparkSession, path: str, kind: str, fmt: str | None = None) -> DataFrame:
    """Reload a feature table; integral columns stored as doubles are cast to int."""
    if kind == "presence":
        schema, ints = PRESENCE_FEATURES_SCHEMA, PRESENCE_FEATURE_INTS
    elif kind == "period":
        schema, ints = PERIOD_FEATURES_SCHEMA, PERIOD_FEATURE_INTS
    else:
        raise ValueError(f"unknown feature kind {kind!r}")
    df = _read(spark, path, schema, fmt)
    return df.select(*[F.col(c).cast("int").alias(c) if c in ints else F.col(c) for c in df.columns])


def write_features(df: DataFrame, path: str, fmt: str | None = None) -> None:
    """Overwrite a feature table (Parquet by default; CSV with header)."""
    f = _fmt(path, fmt)
    w = df.write.mode("overwrite")
    if f == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(f).save(path)


def require_inputs(spark: SparkSession, paths: dict[str, str]) -> None:
    """Fail early with a clear message when an input table is absent.

    ``paths`` maps a path to the step that produces it. Existence is checked
    through the Hadoop file system of the session, so it works for any
    cluster file system, not only local disk.
    """
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for path, producer in paths.items():
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(hconf).exists(p):
            missing.append(f"{path} (run {producer} first)")
    if missing:
        raise MissingInputError("missing inputs: " + "; ".join(missing))
