"""A1–A5 from mergeable summaries of date segments.

A summary of consecutive records of one entity is a monoid: record and presence
counts, leading and trailing absences, longest absence run, the last flags and
weekday sums. Two neighbouring summaries merge into the summary of both, so

* an entity is split by date range: records of one (entity, segment) meet in
  one task, not all records of an entity, and segments merge level by level;
* appended days need no rescan: only segments that new records fall into are
  summarised again, the others are read from the stored summaries.

A segment spans SEGMENT_DAYS days and an entity has one record per day at most,
so what one task gathers for a key is bounded whatever an entity's share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.operators.presence import RECENT_N, _with_weekday_variance

SEGMENT_DAYS = 64
#: Segments that one merge step joins.
FAN_IN = 64

_FIELDS = {"n": "bigint", "present": "bigint", "lead": "bigint", "trail": "bigint", "best": "bigint",
           "recent": "array<int>", "days": "array<bigint>", "met": "array<bigint>"}
SUMMARY = "struct<{}>".format(",".join(f"{k}:{t}" for k, t in _FIELDS.items()))


def _struct(**fields: Column) -> Column:
    return F.struct(*[fields[k].cast(t).alias(k) for k, t in _FIELDS.items()])


def _empty() -> Column:
    none = F.array(*[F.lit(0)] * 7)
    return _struct(n=F.lit(0), present=F.lit(0), lead=F.lit(0), trail=F.lit(0), best=F.lit(0), recent=F.array(), days=none, met=none)


def _one(day: Column, flag: Column) -> Column:
    """Summary of a single record."""
    absent = F.when(flag == 0, 1).otherwise(0)
    at = F.weekday(day)
    seven = [F.when(at == k, 1).otherwise(0) for k in range(7)]
    return _struct(n=F.lit(1), present=flag, lead=absent, trail=absent, best=absent, recent=F.array(flag),
                   days=F.array(*seven), met=F.array(*[s * flag for s in seven]))


def merge(a: Column, b: Column, recent: int) -> Column:
    """Summary of the records of ``a`` followed by those of ``b``; the last ``recent`` flags are kept. Associative, empty is neutral."""
    flags = F.concat(a["recent"], b["recent"])
    plus = lambda x, y: F.zip_with(x, y, lambda u, v: u + v)
    return _struct(
        n=a["n"] + b["n"], present=a["present"] + b["present"],
        lead=F.when(a["lead"] < a["n"], a["lead"]).otherwise(a["n"] + b["lead"]),
        trail=F.when(b["trail"] < b["n"], b["trail"]).otherwise(b["n"] + a["trail"]),
        best=F.greatest(a["best"], b["best"], a["trail"] + b["lead"]),
        recent=F.slice(flags, F.greatest(F.lit(1), F.size(flags) - F.lit(recent - 1)), F.lit(recent)),
        days=plus(a["days"], b["days"]), met=plus(a["met"], b["met"]))


def _folded(sorted_summaries: Column, recent: int) -> Column:
    return F.aggregate(sorted_summaries, _empty(), lambda acc, s: merge(acc, s["s"], recent))


def segment_summaries(df: DataFrame, id_col: str = "id", date_col: str = "date", flag_col: str = "is_present",
                      recent_n: int = RECENT_N, segment_days: int = SEGMENT_DAYS) -> DataFrame:
    """Records (id, date, 0/1 flag) -> one row per entity and date segment that has records: (id, segment, summary).

    (id, date) must be unique, as everywhere here. Segments start at fixed
    dates, so summaries made on different days fit together.
    """
    segment = F.floor(F.unix_date(F.col(date_col).cast("date")) / F.lit(segment_days)).cast("long")
    rows = df.select(F.col(id_col), segment.alias("segment"),
                     F.struct(F.col(date_col).cast("date").alias("d"), F.col(flag_col).cast("int").alias("f")).alias("r"))
    held = rows.groupBy(id_col, "segment").agg(F.sort_array(F.collect_list("r")).alias("r"))  # segment_days at most
    ones = F.transform("r", lambda r: F.struct(_one(r["d"], r["f"]).alias("s")))
    return held.select(id_col, "segment", _folded(ones, recent_n).alias("summary"))


def merge_segments(segments: DataFrame, id_col: str = "id", recent_n: int = RECENT_N, fan_in: int = FAN_IN) -> DataFrame:
    """One summary per entity: neighbouring segments merge ``fan_in`` at a time, so no task ever holds an entity's whole history.

    The steps follow from the range of segments (one aggregation reads it):
    calendars need two or three, each a partial result ``fan_in`` times smaller.
    """
    ends = segments.agg(F.min("segment").alias("lo"), F.max("segment").alias("hi")).first()
    level, span = segments, 1 if ends["lo"] is None else ends["hi"] - ends["lo"] + 1
    base = ends["lo"] or 0
    level = level.withColumn("segment", F.col("segment") - F.lit(base))
    while True:
        step = F.floor(F.col("segment") / F.lit(fan_in)).cast("long")
        level = (level.select(id_col, step.alias("up"), F.struct("segment", F.col("summary").alias("s")).alias("p"))
                 .groupBy(id_col, "up").agg(F.sort_array(F.collect_list("p")).alias("p"))  # fan_in at most
                 .select(id_col, F.col("up").alias("segment"), _folded(F.col("p"), recent_n).alias("summary")))
        span = -(-span // fan_in)
        if span <= 1:
            return level.select(id_col, "summary")


def features_from_summary(merged: DataFrame, id_col: str = "id", recent_name: str = "absence_in_last_30_days") -> DataFrame:
    """A5 rows from one summary per entity: rate, longest absence run, absences among the last records, weekday variance."""
    s = F.col("summary")
    wide = merged.select(
        id_col, (s["present"].cast("double") / s["n"]).alias("attendance_rate"), s["best"].cast("int").alias("longest_absence_streak"),
        F.size(F.filter(s["recent"], lambda f: f == 0)).alias(recent_name),
        *[F.when(s["days"][k] > 0, s["met"][k]).cast("double").alias(f"_s{k}") for k in range(7)],
        *[s["days"][k].alias(f"_c{k}") for k in range(7)])
    return _with_weekday_variance(wide, [id_col, "attendance_rate", "longest_absence_streak", recent_name])


def presence_features_by_segments(df: DataFrame, id_col: str = "id", date_col: str = "date", flag_col: str = "is_present",
                                  recent_n: int = RECENT_N, recent_name: str = "absence_in_last_30_days") -> DataFrame:
    """A5 without a window over an entity: the same rows as ``presence_features``, a hot entity spread by date range."""
    return features_from_summary(merge_segments(segment_summaries(df, id_col, date_col, flag_col, recent_n), id_col, recent_n),
                                 id_col, recent_name)


def append_records(stored: DataFrame, history: DataFrame, new: DataFrame, id_col: str = "id", date_col: str = "date",
                   flag_col: str = "is_present", recent_n: int = RECENT_N, segment_days: int = SEGMENT_DAYS) -> DataFrame:
    """Segment summaries after ``new`` records arrived: only the touched (entity, segment) pairs are summarised again.

    ``stored`` holds the summaries of ``history``. Of the history only records
    of touched segments count, and those lie within the date range of the new
    records, rounded to whole segments: a filter that reaches the scan of a
    history stored by date. A record that arrives again for a known (entity,
    date) replaces the old one; new records must be unique themselves.
    """
    segment = F.floor(F.unix_date(F.col(date_col).cast("date")) / F.lit(segment_days)).cast("long")
    mine = new.select(F.col(id_col), F.col(date_col).cast("date").alias(date_col), F.col(flag_col).cast("int").alias(flag_col))
    ends = mine.agg(F.min(segment).alias("lo"), F.max(segment).alias("hi")).first()
    if ends["lo"] is None:
        return stored
    touched = mine.select(id_col, segment.alias("segment")).distinct()
    first, last = (F.date_from_unix_date(F.lit(int(x) * segment_days)) for x in (ends["lo"], ends["hi"] + 1))
    near = (history.select(F.col(id_col), F.col(date_col).cast("date").alias(date_col), F.col(flag_col).cast("int").alias(flag_col))
            .where((F.col(date_col) >= first) & (F.col(date_col) < last)))
    again = (near.withColumn("segment", segment).join(touched, [id_col, "segment"], "left_semi").drop("segment")
             .join(mine.select(id_col, date_col), [id_col, date_col], "left_anti"))
    fresh = segment_summaries(again.unionByName(mine), id_col, date_col, flag_col, recent_n, segment_days)
    return stored.join(touched, [id_col, "segment"], "left_anti").unionByName(fresh)
