"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each SQL is written independently of the Spark code, straight from the
definitions: explicit grids, self-describing window functions, plain
GROUP BYs. ``rint`` rounding is ``round_even(x * 10^k, 0) / 10^k``.
"""

from __future__ import annotations

from vigilo.functions.text import DISPLAY_NAMES, FALLBACK_CLASSES


def R(x: str, k: int = 6) -> str:
    s = f"1e{k}"
    return f"(round_even(({x}) * {s}, 0) / {s})"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


NAMES_SQL = _list(DISPLAY_NAMES)
CLASSES_SQL = _list(FALLBACK_CLASSES)

CTE = {}
DEPS = {}


def cte(name, deps, body):
    CTE[name] = body
    DEPS[name] = deps


cte("presence", [], """
  select u.user_id as id, d.date, case when p.user_id is null then 0 else 1 end as is_present
  from (select distinct user_id from events) u
  cross join (select distinct cast(ts as date) as date from events) d
  left join (select distinct user_id, cast(ts as date) as date from events) p
    on p.user_id = u.user_id and p.date = d.date""")

cte("pr", ["presence"], """
  select id, date, is_present,
         row_number() over (partition by id order by date) as rn,
         count(*) over (partition by id) as n,
         sum(is_present) over (partition by id order by date rows between unbounded preceding and current row) as run
  from presence""")

cte("streak", ["pr"], """
  select id, max(len) as longest from
    (select id, run, count(*) as len from pr where is_present = 0 group by id, run) z
  group by id""")

cte("wdvar", ["presence"], """
  select id, var_samp(m) as day_of_week_variance from
    (select id, isodow(date) as wd, avg(is_present) as m from presence group by id, isodow(date)) y
  group by id""")

cte("feat", ["pr", "streak", "wdvar"], """
  select a.id, a.attendance_rate, cast(coalesce(s.longest, 0) as integer) as longest_absence_streak,
         a.absence_in_last_30_days, v.day_of_week_variance
  from (select id, avg(is_present) as attendance_rate,
               cast(sum(case when rn > n - 30 then 1 - is_present else 0 end) as integer) as absence_in_last_30_days
        from pr group by id) a
  left join streak s on s.id = a.id
  left join wdvar v on v.id = a.id""")

cte("lab", ["presence"], """
  select id, cast(case when avg(is_present) < 0.85e0 then 1 else 0 end as integer) as is_anomaly
  from presence group by id""")

cte("att", ["feat", "lab"], """
  select f.id as student_id, f.attendance_rate, f.longest_absence_streak, f.absence_in_last_30_days,
         f.day_of_week_variance, l.is_anomaly
  from feat f join lab l on l.id = f.id""")

cte("ranked", [], """
  select o.*, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as term,
         lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as prev_date
  from orders o""")

cte("periods", ["ranked"], """
  select r.o_custkey as id, cast(r.term as integer) as term,
         cast(case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end as integer) as status,
         cast(coalesce(date_diff('day', r.prev_date, r.o_orderdate), 0) as integer) as days_since_last_payment,
         case when c_acctbal < 1200 then 'Low' when c_acctbal < 6800 then 'Medium' else 'High' end
           as family_income_bracket,
         cast(c_nationkey % 2 as integer) as transport_user, cast(c_nationkey % 4 as integer) as sibling_count,
         case when o_orderstatus = 'F' then 0.0e0 else o_totalprice end as total_outstanding
  from ranked r join customer on c_custkey = r.o_custkey""")

cte("dim", [], """
  select user_id as id, n_name as class from (select distinct user_id from events)
  join customer on c_custkey = user_id join nation on n_nationkey = c_nationkey""")

cte("fee", ["periods"], """
  select id,
    round_even(cast(sum(case when term < mt then days_since_last_payment end) as double) / nullif(count(*) - 1, 0) * 10e0, 0) / 10e0 as days_since_last_payment,
    cast(max(case when term < mt then status end) as integer) as previous_term_status,
    round_even(cast(sum(case when term < mt then cast(total_outstanding as decimal(18,6)) end) as double) / (count(*) - 1) * 100e0, 0) / 100e0 as total_outstanding,
    cast(max(case when term = mt then case family_income_bracket when 'High' then 0 when 'Medium' then 1
                                          when 'Low' then 2 end end) as integer) as income_encoded,
    cast(max(case when term = mt then transport_user end) as integer) as transport_user,
    cast(max(case when term = mt then sibling_count end) as integer) as sibling_count,
    cast(max(case when term = mt then status end) as integer) as label
  from (select *, max(term) over (partition by id) as mt from periods) group by id having count(*) > 1""")

cte("feetab", ["fee"], "select id as student_id, * exclude (id) from fee")

cte("fsc", ["fee"], """
  select *, least(1e0, 0.2e0 * previous_term_status + days_since_last_payment / 1500e0) as default_prob
  from fee""")

cte("asc_", ["feat"], """
  select *, greatest(0e0, least(100e0, 50e0 - 200e0 * (attendance_rate - 0.85e0))) as risk_raw
  from feat""")

cte("prof", ["asc_", "fsc", "dim"], f"""
  select a.id,
    {NAMES_SQL}[((a.id - 1) % 20 + 20) % 20 + 1] as name,
    coalesce(dim.class, {CLASSES_SQL}[((a.id - 1) % 10 + 10) % 10 + 1]) as student_class,
    round_even(a.attendance_rate * 100e0 * 10e0, 0) / 10e0 as attendance_rate,
    a.risk_raw > 50e0 as is_anomaly,
    round_even(a.risk_raw * 10e0, 0) / 10e0 as risk_score,
    a.longest_absence_streak as absence_streak,
    a.absence_in_last_30_days as absence_30d,
    coalesce(f.label, 0) as fee_label,
    coalesce(round_even(100e0 * f.default_prob * 10e0, 0) / 10e0, 0e0) as fee_prob,
    coalesce(f.total_outstanding, 0e0) as outstanding,
    coalesce(cast(trunc(f.days_since_last_payment) as integer), 0) as days_late
  from asc_ a left join fsc f on f.id = a.id left join dim on dim.id = a.id""")

cte("pred", ["fsc"], """
  select id, cast(label = 2 as integer) as y_true, cast(previous_term_status = 2 as integer) as y_pred,
         (round_even(100e0 * default_prob * 10e0, 0) / 10e0) / 100e0 as prob,
         label, previous_term_status as ps
  from fsc""")

cte("req", [], "select o_custkey as id from orders where o_orderpriority = '1-URGENT'")


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n):
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    return "with " + ",\n".join(f"{n} as ({CTE[n]})" for n in order) + "\n" + body


SQL: dict[str, str] = {}


def q(name, body, *ctes):
    SQL[name] = with_ctes(body, *ctes) if ctes else body


# S
q("s1_read_presence", "select id, date, is_present from presence", "presence")
q("s2_read_periods", "select * from periods", "periods")
q("s3_entity_dim", "select id, class from dim", "dim")

# A
q("a0_business_days", "select id, date, is_present from presence where isodow(date) <= 5", "presence")
q("a1_presence_rate", f"select id, {R('avg(is_present)')} as attendance_rate from presence group by id", "presence")
q("a2_longest_absence_streak", """
  select p.id, cast(coalesce(s.longest, 0) as integer) as longest_absence_streak
  from (select distinct id from presence) p left join streak s on s.id = p.id""", "presence", "streak")
q("a3_absences_last_n", """
  select id, cast(sum(case when rn > n - 10 then 1 - is_present else 0 end) as integer) as absence_in_last_n
  from pr group by id""", "pr")
q("a4_weekday_variance", f"select id, {R('day_of_week_variance')} as day_of_week_variance from wdvar", "wdvar")
for _name in ("a5_presence_features", "a5_segment_summaries", "a5_appended_days"):
    q(_name, f"""
  select id, {R('attendance_rate')} as attendance_rate, longest_absence_streak, absence_in_last_30_days,
         {R('day_of_week_variance')} as day_of_week_variance from feat""", "feat")
q("a6_attach_labels", f"""
  select student_id, {R('attendance_rate')} as attendance_rate, longest_absence_streak, absence_in_last_30_days,
         {R('day_of_week_variance')} as day_of_week_variance, is_anomaly from att""", "att")

# F
q("f1_split_latest", """
  select id, max(term) as label_term, max_by(status, term) as label, count(*) - 1 as n_history
  from periods group by id""", "periods")
q("f2_history_avg_days", """
  select id, round_even(cast(sum(case when term < mt then days_since_last_payment end) as double) / nullif(count(*) - 1, 0) * 10e0, 0) / 10e0
         as days_since_last_payment
  from (select *, max(term) over (partition by id) as mt from periods) group by id""", "periods")
q("f3_history_worst_status", """
  select id, max(case when term < mt then status end) as previous_term_status
  from (select *, max(term) over (partition by id) as mt from periods) group by id""", "periods")
q("f4_history_avg_outstanding", """
  select id, round_even(cast(sum(case when term < mt then cast(total_outstanding as decimal(18,6)) end) as double) / nullif(count(*) - 1, 0) * 100e0, 0) / 100e0
         as total_outstanding
  from (select *, max(term) over (partition by id) as mt from periods) group by id""", "periods")
q("f5_encode_income", """
  select id, term, case family_income_bracket when 'High' then 0 when 'Medium' then 1 when 'Low' then 2 end
         as income_encoded from periods""", "periods")
q("f6_period_features", "select * from fee", "fee")
q("f7_default_target", "select id, label, cast(label = 2 as integer) as fee_default from fee", "fee")
q("f8_is_low_income", "select id, income_encoded, cast(income_encoded = 2 as integer) as is_low_income from fee", "fee")
q("f9_has_many_siblings", "select id, sibling_count, cast(sibling_count >= 3 as integer) as has_many_siblings from fee", "fee")
q("f10_was_late_or_worse", """select id, previous_term_status, cast(previous_term_status >= 1 as integer)
  as was_late_or_worse from fee""", "fee")
q("f11_days_x_outstanding", f"""select id, {R('days_since_last_payment * total_outstanding / 10000e0')}
  as days_x_outstanding from fee""", "fee")


# Q: check rows, generated from the same check definitions (tables / columns / bounds)
def _check(tbl, check, col, observed, bound, severity, passed):
    colv = "null" if col is None else f"'{col}'"
    return (f"select '{tbl}' as tbl, '{check}' as check_name, cast({colv} as varchar) as col, "
            f"{R(f'cast({observed} as double)')} as observed, {R(f'cast({bound} as double)')} as bound, "
            f"'{severity}' as severity, coalesce({passed}, false) as passed")


ATT_COLS = ["student_id", "attendance_rate", "longest_absence_streak", "absence_in_last_30_days", "day_of_week_variance", "is_anomaly"]
FEE_COLS = ["student_id", "days_since_last_payment", "previous_term_status", "total_outstanding", "income_encoded",
            "transport_user", "sibling_count", "label"]
DOUBLE_COLS = {"attendance_rate", "day_of_week_variance", "days_since_last_payment", "total_outstanding"}


def _null_expr(c):
    return f"(count(*) filter (where {c} is null{' or isnan(' + c + ')' if c in DOUBLE_COLS else ''}))"


def _check_rows(kind, probes=False):
    rows = []
    tabs = [("attendance_features", "att", ATT_COLS, "is_anomaly"), ("fee_features", "feetab", FEE_COLS, "label")]
    for tbl, src, cols, lab in tabs:
        if kind == "required":
            rows.append(f"select * from ({_check(tbl, 'required_columns', None, '0', '0', 'error', 'true')})")
        if kind == "nulls":
            for c in cols:
                rows.append(f"select * from ({_check(tbl, 'nulls', c, _null_expr(c), '0', 'error', _null_expr(c) + ' = 0')} from {src})")
    if kind == "required" and probes:
        rows.append(f"select * from ({_check('fee_features_unlabelled', 'required_columns', None, '1', '0', 'error', 'false')})")
    if kind == "nulls" and probes:
        holes = ("(select * replace (case when student_id % 7 <> 0 then student_id end as student_id, "
                 "case when student_id % 7 <> 0 then days_since_last_payment end as days_since_last_payment) from feetab)")
        for c in FEE_COLS:
            rows.append(f"select * from ({_check('fee_features_holes', 'nulls', c, _null_expr(c), '0', 'error', _null_expr(c) + ' = 0')} from {holes} h)")
    ranges = [("attendance_features", "att", "attendance_rate", 0, 1), ("attendance_features", "att", "longest_absence_streak", None, 200)]
    for c in ["income_encoded", "transport_user", "sibling_count", "previous_term_status", "label"]:
        hi = {"income_encoded": 2, "transport_user": 1, "sibling_count": 3, "previous_term_status": 2, "label": 2}[c]
        ranges.append(("fee_features", "feetab", c, 0, hi))
    if kind == "ranges":
        for tbl, src, c, lo, hi in ranges:
            if lo is not None:
                rows.append(f"select * from ({_check(tbl, 'min', c, f'min({c})', str(lo), 'error', f'min({c}) >= {lo}')} from {src})")
            if hi is not None:
                rows.append(f"select * from ({_check(tbl, 'max', c, f'max({c})', str(hi), 'error', f'max({c}) <= {hi}')} from {src})")
    if kind == "band":
        pct = "(count(*) filter (where is_anomaly = 1)) / count(*) * 100e0"
        rows.append(f"select * from ({_check('attendance_features', 'label_pct_min', 'is_anomaly', pct, '10', 'warn', pct + ' >= 10')} from att)")
        rows.append(f"select * from ({_check('attendance_features', 'label_pct_max', 'is_anomaly', pct, '20', 'warn', pct + ' <= 20')} from att)")

    def mean(c, lab, k):
        return f"avg(case when {lab} = {k} then {c} end)"
    if kind == "means":
        for tbl, src, lab, c, a, b, less, sev in [
                ("attendance_features", "att", "is_anomaly", "attendance_rate", 1, 0, True, "error"),
                ("attendance_features", "att", "is_anomaly", "longest_absence_streak", 1, 0, False, "error"),
                ("fee_features", "feetab", "label", "total_outstanding", 2, 0, False, "error"),
                ("fee_features", "feetab", "label", "income_encoded", 2, 0, False, "warn")]:
            name = f"mean_{a}_{'lt' if less else 'gt'}_{b}"
            op = "<" if less else ">"
            rows.append(f"select * from ({_check(tbl, name, c, mean(c, lab, a), mean(c, lab, b), sev, f'{mean(c, lab, a)} {op} {mean(c, lab, b)}')} from {src})")
    if kind == "monotone":
        c = "days_since_last_payment"
        for lo, hi in [(0, 1), (1, 2)]:
            rows.append(f"select * from ({_check('fee_features', f'rising_{hi}_over_{lo}', c, mean(c, 'label', hi), mean(c, 'label', lo), 'warn', f"{mean(c, 'label', hi)} > {mean(c, 'label', lo)}")} from feetab)")
    return rows


def _union(rows):
    return "\nunion all\n".join(rows)


q("q1_required_columns", _union(_check_rows("required", True)), "att", "feetab")
q("q2_null_counts", _union(_check_rows("nulls", True)), "att", "feetab")
q("q3_ranges", _union(_check_rows("ranges")), "att", "feetab")
q("q4_label_distribution", f"""
  select 'attendance_features' as tbl, is_anomaly as label, count(*) as n,
         {R('count(*) / sum(count(*)) over () * 100e0')} as pct from att group by is_anomaly
  union all
  select 'fee_features' as tbl, label, count(*) as n,
         {R('count(*) / sum(count(*)) over () * 100e0')} as pct from feetab group by label""", "att", "feetab")
q("q4_label_band", _union(_check_rows("band")), "att")
q("q5_group_means", _union(_check_rows("means")), "att", "feetab")
q("q6_monotone_means", _union(_check_rows("monotone")), "feetab")
q("q7_top_anomalies", f"""
  select student_id, {R('attendance_rate')} as attendance_rate, longest_absence_streak, absence_in_last_30_days
  from att where is_anomaly = 1 order by longest_absence_streak desc, student_id limit 5""", "att")
_all_checks = _union(_check_rows("required") + _check_rows("nulls") + _check_rows("ranges") + _check_rows("means"))
q("q8_quality_gate", f"""
  , chk as ({_all_checks})
  select tbl, bool_and(passed) as passed from chk where severity = 'error' group by tbl
  union all
  select 'all' as tbl, coalesce(bool_and(passed), true) as passed from chk where severity = 'error'""".lstrip(),
  "att", "feetab")
SQL["q8_quality_gate"] = SQL["q8_quality_gate"].replace("\n\n  , chk as", ",\n  chk as").replace("\n  , chk as", ",\n  chk as")

# E
q("e1_confusion_matrix", """
  select a.actual, count(*) filter (where y_true = a.actual and y_pred = 0) as pred_0,
         count(*) filter (where y_true = a.actual and y_pred = 1) as pred_1
  from (select 0 as actual union all select 1) a, pred group by a.actual""", "pred")
q("e2_binary_metrics", f"""
  select tp, fp, fn, tn,
    {R('coalesce(tp / nullif(tp + fn, 0), 0)')} as recall,
    {R('coalesce(tp / nullif(tp + fp, 0), 0)')} as precision,
    {R('coalesce(2e0 * (coalesce(tp / nullif(tp + fp, 0), 0)) * (coalesce(tp / nullif(tp + fn, 0), 0)) / nullif(coalesce(tp / nullif(tp + fp, 0), 0) + coalesce(tp / nullif(tp + fn, 0), 0), 0), 0)')} as f1,
    {R('coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0)')} as accuracy
  from (select count(*) filter (where y_true = 1 and y_pred = 1) as tp,
               count(*) filter (where y_true = 0 and y_pred = 1) as fp,
               count(*) filter (where y_true = 1 and y_pred = 0) as fn,
               count(*) filter (where y_true = 0 and y_pred = 0) as tn from pred)""", "pred")
q("e3_classification_report", f"""
  , cls as (
    select c.k, c.nm, count(*) filter (where label = c.k and ps = c.k) as tp,
           count(*) filter (where label = c.k) as sup, count(*) filter (where ps = c.k) as pp
    from (select 0 as k, 'On Time' as nm union all select 1, 'Late' union all select 2, 'Default') c, pred
    group by c.k, c.nm),
  m as (select k, nm, sup, coalesce(tp / nullif(pp, 0), 0) as p, coalesce(tp / nullif(sup, 0), 0) as r from cls),
  m2 as (select *, coalesce(2e0 * p * r / nullif(p + r, 0), 0) as f from m),
  tot as (select count(*) as n, count(*) filter (where label = ps) as hit from pred)
  select nm as label, {R('p')} as precision, {R('r')} as recall, {R('f')} as f1, sup as support from m2
  union all select 'accuracy', null, null, {R('coalesce(hit / nullif(n, 0), 0)')}, n from tot
  union all select 'macro avg', {R('avg(p)')}, {R('avg(r)')}, {R('avg(f)')}, (select n from tot) from m2
  union all select 'weighted avg', {R('coalesce(sum(p * sup) / nullif((select n from tot), 0), 0)')},
    {R('coalesce(sum(r * sup) / nullif((select n from tot), 0), 0)')},
    {R('coalesce(sum(f * sup) / nullif((select n from tot), 0), 0)')}, (select n from tot) from m2""".lstrip(), "pred")
SQL["e3_classification_report"] = SQL["e3_classification_report"].replace("\n, cls as", ",\n cls as").replace("\n  , cls as", ",\n  cls as")
q("e4_roc_auc", f"""
  select {R('coalesce(sum(pos * (below + neg / 2e0)) / nullif(sum(pos) * sum(neg), 0), 0)')} as auc from (
    select s, pos, neg, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) as below
    from (select prob as s, count(*) filter (where y_true = 1) as pos, count(*) filter (where y_true <> 1) as neg
          from pred group by prob))""", "pred")
q("e5_class_recall", f"""
  select 2 as class, {R('coalesce((count(*) filter (where label = 2 and ps = 2)) / nullif(count(*) filter (where label = 2), 0), 0)')} as recall,
         count(*) filter (where label = 2) as support from pred""", "pred")
q("e6_target_gate", f"""
  select 'fee_default' as model, 'recall' as metric, {R('v')} as value, 0.7e0 as minimum, v >= 0.7e0 as passed from (
    select coalesce((count(*) filter (where label = 2 and ps = 2)) / nullif(count(*) filter (where label = 2), 0), 0) as v
    from pred)""", "pred")
q("e7_top_flagged", f"""
  select a.id, {R('attendance_rate')} as attendance_rate, {R('risk_raw')} as risk_score, longest_absence_streak,
         absence_in_last_30_days,
         case when l.is_anomaly = 1 then 'Correctly Flagged' else 'False Positive' end as verdict
  from asc_ a join lab l on l.id = a.id where risk_raw > 50e0 order by risk_raw desc, a.id limit 5""", "asc_", "lab")
q("e8_top_default", f"""
  select id, {R('default_prob')} as default_prob, total_outstanding,
         cast(trunc(days_since_last_payment) as integer) as days_late,
         coalesce(['On Time', 'Late', 'Default'][previous_term_status + 1], '?') as previous_status,
         case when label = 2 then 'True Default' else 'Check Needed' end as verdict
  from fsc order by default_prob desc, id limit 5""", "fsc")
q("e9_target_summary", f"""
  select count(*) as rows, cast(sum(cast(label = 2 as integer)) as bigint) as positives,
         {R('avg(cast(label = 2 as integer)) * 100e0')} as positive_pct from fee""", "fee")

# D
q("d1_risk_tier", "select id, case when risk_score > 70 then 'High' when risk_score > 40 then 'Medium' else 'Low' end as risk_tier from prof", "prof")
q("d2_fee_tier", """
  select id,
    case when fee_prob / 100e0 > 0.6e0 then 'High' when fee_prob / 100e0 > 0.3e0 then 'Medium' else 'Low' end as fee_tier,
    case when fee_prob / 100e0 >= 0.6e0 then 'HIGH' when fee_prob / 100e0 >= 0.3e0 then 'MEDIUM' else 'LOW' end as fee_tier_batch
  from prof""", "prof")
q("d3_build_profile", "select * from prof", "prof")
q("d4_assign_by_modulo", f"""
  select id, {NAMES_SQL}[((id - 1) % 20 + 20) % 20 + 1] as name,
         {CLASSES_SQL}[((id - 1) % 10 + 10) % 10 + 1] as fallback_class from dim""", "dim")
q("d5_search", """select id, name, student_class from prof
  where contains(lower(name), 'ar') or contains(lower(cast(id as varchar)), 'ar')""", "prof")
q("d5_search_literal_percent", """select id, name from prof
  where contains(lower(name), '%') or contains(lower(cast(id as varchar)), '%')""", "prof")
q("d6_segment_anomaly", "select id, risk_score from prof where is_anomaly", "prof")
q("d6_segment_fee_risk", "select id, fee_prob from prof where fee_label = 2", "prof")
q("d6_segment_safe", "select id, risk_score, fee_label from prof where not is_anomaly and fee_label = 0", "prof")
q("d7_sort_profiles", "select id, attendance_rate from prof order by attendance_rate, id", "prof")
for _k, _c, _o in (("risk_desc", "risk_score", "desc"), ("risk_asc", "risk_score", "asc"), ("att_desc", "attendance_rate", "desc"),
                   ("fee_desc", "fee_prob", "desc")):
    q(f"d7_sort_{_k}", f"select id, {_c} from prof order by {_c} {_o}, id", "prof")
q("d8_keyset_page", "select id, name, risk_score from prof order by risk_score desc, id limit 20 offset 20", "prof")
q("d8_keyset_page_by_id", "select id, name from prof where id > 40 order by id limit 20", "prof")
q("d8_page", "select id, name, risk_score from prof order by risk_score desc, id limit 20 offset 20", "prof")
q("d8_page_info", """
  select total, cast(ceil(total / 20) as bigint) as pages,
         printf('%d–%d of %d', 21, least(40, total), total) as label
  from (select count(*) as total from prof where not is_anomaly and fee_label = 0)""", "prof")
q("d9_lookup", "select * from prof where id = 42", "prof")
q("d10_history", "select * from (select id, date, is_present from presence where id = 42 order by date desc limit 10) order by date", "presence")
q("d10_history_arrays", """
  select id, string_agg(cast(date as varchar) || ':' || cast(is_present as varchar), ',' order by date) as history
  from (select *, row_number() over (partition by id order by date desc) as r from presence) where r <= 10
  group by id""", "presence")
q("d11_score_ids_anomaly", f"""
  select id as student_id, {R('risk_raw', 2)} as risk_score, risk_raw > 50e0 as is_flagged,
         case when risk_raw > 70 then 'High' when risk_raw > 40 then 'Medium' else 'Low' end as risk_level
  from asc_ where id in (select id from req)""", "asc_", "req")
q("d12_score_ids_fee", f"""
  select id as student_id, {R('default_prob', 2)} as default_probability,
         case when default_prob > 0.6e0 then 'High' when default_prob > 0.3e0 then 'Medium' else 'Low' end as risk_category
  from fsc where id in (select id from req)""", "fsc", "req")
q("d13_overall_status", """
  select id, case when is_anomaly or fee_label = 2 then 'Critical'
                  when fee_label = 1 or risk_score > 40 then 'At Risk' else 'Normal' end as overall_status
  from prof""", "prof")
q("d14_bands", """
  select id,
    case when attendance_rate >= 80 then 'ok' when attendance_rate >= 60 then 'warn' else 'danger' end as attendance_band,
    case when risk_score > 70 then 'danger' when risk_score > 40 then 'warn' else 'ok' end as risk_band,
    case when fee_prob > 60 then 'danger' when fee_prob > 25 then 'warn' else 'ok' end as prob_band
  from prof""", "prof")
q("d15_risk_reasons", """
  select id, attendance_reasons, fee_reasons, attendance_reasons = '' and fee_reasons = '' as no_risk from (
  select id,
    concat_ws(' | ',
      case when is_anomaly and attendance_rate < 50 then 'Critical attendance at ' || regexp_replace(format('{:.6f}', cast(attendance_rate as double)), '\\.?0+$', '') || '% — far below the 75% safe threshold. IsolationForest flagged this as a severe anomaly.'
           when is_anomaly and attendance_rate < 70 then 'Attendance dropped to ' || regexp_replace(format('{:.6f}', cast(attendance_rate as double)), '\\.?0+$', '') || '%, triggering the anomaly detection model.'
           when is_anomaly then 'Despite ' || regexp_replace(format('{:.6f}', cast(attendance_rate as double)), '\\.?0+$', '') || '% overall, the absence pattern is irregular — a sudden recent drop was detected.' end,
      case when is_anomaly and absence_streak >= 5 then cast(absence_streak as varchar) || '-day consecutive absence streak detected — possible family crisis or health issue.' end,
      case when is_anomaly and absence_30d >= 8 then cast(absence_30d as varchar) || ' absences in the last 30 days — sharp recent deterioration.' end
    ) as attendance_reasons,
    concat_ws(' | ',
      case when fee_label = 2 then 'Student has defaulted with ₹' || regexp_replace(format('{:,.3f}', cast(outstanding as double)), '\\.?0+$', '') || ' outstanding.'
           when fee_label = 1 then 'Late payment pattern — ' || cast(days_late as varchar) || ' days since last payment.' end,
      case when fee_label = 2 and days_late > 30 then 'Payment is ' || cast(days_late as varchar) || ' days overdue — confirmed default.' end,
      case when fee_prob > 15 and fee_label < 2 then 'AI predicts ' || regexp_replace(format('{:.6f}', cast(fee_prob as double)), '\\.?0+$', '') || '% chance of future default — early intervention recommended.' end
    ) as fee_reasons
  from prof)""", "prof")
q("d16_initials", """
  select id, substring(array_to_string(list_transform(string_split(name, ' '), lambda w: substring(w, 1, 1)), ''), 1, 2)
         as initials from prof""", "prof")
q("d17_decode_status", "select id, ['On Time', 'Late', 'Default'][fee_label + 1] as fee_status from prof", "prof")

# B
KPI = """
  select count(*) as total, count(*) filter (where is_anomaly) as anomalies,
         count(*) filter (where fee_label = 2) as fee_defaults, count(*) filter (where fee_label = 1) as fee_late,
         count(*) filter (where fee_label = 0) as fee_on_time, count(*) filter (where risk_score > 70) as risk_high,
         count(*) filter (where risk_score > 40 and risk_score <= 70) as risk_medium
  from prof"""
cte("kpi0", ["prof"], KPI)
cte("kpi", ["kpi0"], """
  select *, total - risk_high - risk_medium as risk_low,
    case when total > 0 then greatest(0e0, round_even((100e0 - risk_high / total * 40e0 - fee_defaults / total * 60e0) * 10e0, 0) / 10e0) end as system_health,
    greatest(0, total - anomalies - fee_defaults) as landing_safe
  from kpi0""")
q("b1_summary", "select total, anomalies, fee_defaults, fee_late from kpi", "kpi")
q("b2_risk_distribution", """
  select 'High' as tier, risk_high as students from kpi union all select 'Medium', risk_medium from kpi
  union all select 'Low', risk_low from kpi""", "kpi")
q("b3_fee_distribution", """
  select 'On Time' as status, fee_on_time as students from kpi union all select 'Late', fee_late from kpi
  union all select 'Default', fee_defaults from kpi""", "kpi")
q("b4_rate_histogram", """
  select b.position, b.bucket, count(p.id) as students
  from (select 0 as position, '0-50%' as bucket, -1e308 as lo, 50e0 as hi union all select 1, '50-60%', 50e0, 60e0
        union all select 2, '60-70%', 60e0, 70e0 union all select 3, '70-80%', 70e0, 80e0
        union all select 4, '80-90%', 80e0, 90e0 union all select 5, '90-100%', 90e0, 1e308) b
  left join prof p on p.attendance_rate >= b.lo and (p.attendance_rate < b.hi or b.position = 5)
  group by b.position, b.bucket""", "prof")
q("b5_class_breakdown", """
  select coalesce(student_class, 'Unknown') as class, count(*) as total, count(*) filter (where is_anomaly) as anomalies,
         count(*) filter (where fee_label = 2) as defaults, count(*) filter (where fee_label = 1) as late
  from prof group by 1 order by 1""", "prof")
q("b6_combined_risk_ranking", """
  select id, name, risk_score * 0.5e0 + fee_prob * 0.5e0 as combined_risk from prof
  order by combined_risk desc, id""", "prof")
q("b7_top_n", """
  select id, name, student_class, risk_score * 0.5e0 + fee_prob * 0.5e0 as combined_risk from prof
  order by combined_risk desc, id limit 10""", "prof")
q("b8_alert_feed", """
  select id, name, case when is_anomaly then 'Attendance Anomaly' else 'Fee Default' end as type,
         case when is_anomaly then 'Risk ' || cast(risk_score as varchar)
              else cast(fee_prob as varchar) || '% default prob' end as detail
  from prof where is_anomaly or fee_label = 2 order by id limit 8""", "prof")
q("b9_health_score", "select system_health from kpi where total > 0", "kpi")
q("b10_safe_count_landing", "select landing_safe from kpi", "kpi")
q("b11_drill_down_risk_tier", "select id, risk_score from prof where risk_score > 40 and risk_score <= 70", "prof")
q("b11_drill_down_rate_bucket", "select id, attendance_rate from prof where attendance_rate >= 80 and attendance_rate < 90", "prof")
q("b11_drill_down_class", "select id, fee_label from prof where student_class = 'GERMANY' and fee_label = 2", "prof")
q("b11_drill_down_fee_status", "select id, fee_label from prof where fee_label = 1", "prof")
q("b11_drill_down_class_metrics", """
  select p.id, m.metric from prof p, (select unnest(['all', 'anomalies', 'late', 'defaults']) as metric) m
  where p.student_class = (select student_class from prof group by 1 order by count(*) desc, 1 limit 1)
    and (m.metric = 'all' or m.metric = 'anomalies' and is_anomaly or m.metric = 'late' and fee_label = 1
         or m.metric = 'defaults' and fee_label = 2)""", "prof")
q("b12_suggest", """
  select id, name, student_class from prof
  where contains(lower(name), 'ar') or contains(lower(cast(id as varchar)), 'ar') order by id limit 5""", "prof")
q("b13_kpis", "select * from kpi", "kpi")
_TOP = ["id", "name", "student_class", "attendance_rate", "risk_score", "fee_prob", "is_anomaly", "fee_label"]
_ACT = ["id", "name", "type", "detail"]
cte("bundle_top", ["prof"], """
  select *, row_number() over (order by risk_score * 0.5e0 + fee_prob * 0.5e0 desc, id) as rank from prof qualify rank <= 10""")
cte("bundle_activity", ["prof"], """
  select id, name, case when is_anomaly then 'Attendance Anomaly' else 'Fee Default' end as type,
         case when is_anomaly then 'Risk ' || cast(risk_score as varchar) else cast(fee_prob as varchar) || '% default prob' end as detail,
         row_number() over (order by id) as rank
  from prof where is_anomaly or fee_label = 2 qualify rank <= 8""")
cte("bundle_class", ["prof"], """
  select coalesce(student_class, 'Unknown') as class, count(*) as total, count(*) filter (where is_anomaly) as anomalies,
         count(*) filter (where fee_label = 2) as defaults, count(*) filter (where fee_label = 1) as late from prof group by 1""")
cte("bundle_bucket", ["prof"], """
  select case when attendance_rate < 50 then '0-50%' when attendance_rate < 60 then '50-60%' when attendance_rate < 70 then '60-70%'
              when attendance_rate < 80 then '70-80%' when attendance_rate < 90 then '80-90%' else '90-100%' end as bucket from prof""")
q("b13_analytics_bundle", f"""
  select 'totals' as part, 'all' as key, m.metric, cast(case m.metric when 'total_students' then total when 'anomaly_count' then anomalies
    when 'fee_default_count' then fee_defaults else fee_late end as varchar) as value
  from kpi, (select unnest(['total_students', 'anomaly_count', 'fee_default_count', 'fee_late_count']) as metric) m
  union all select 'risk_distribution', k.tier, 'count', cast(case k.tier when 'High' then risk_high when 'Medium' then risk_medium else risk_low end as varchar)
  from kpi, (select unnest(['High', 'Medium', 'Low']) as tier) k
  union all select 'fee_distribution', k.status, 'count', cast(case k.status when 'On Time' then fee_on_time when 'Late' then fee_late else fee_defaults end as varchar)
  from kpi, (select unnest(['On Time', 'Late', 'Default']) as status) k
  union all select 'attendance_histogram', b.bucket, 'count', cast(count(h.bucket) as varchar)
  from (select unnest(['0-50%', '50-60%', '60-70%', '70-80%', '80-90%', '90-100%']) as bucket) b left join bundle_bucket h on h.bucket = b.bucket group by b.bucket
  union all select 'system_health', 'all', 'system_health', cast(system_health as varchar) from kpi
  {" ".join(f"union all select 'class_breakdown', class, '{m}', cast({m} as varchar) from bundle_class" for m in ("total", "anomalies", "defaults", "late"))}
  {" ".join(f"union all select 'top_risk_students', cast(rank as varchar), '{m}', cast({m} as varchar) from bundle_top" for m in _TOP)}
  {" ".join(f"union all select 'recent_activity', cast(rank as varchar), '{m}', cast({m} as varchar) from bundle_activity" for m in _ACT)}""", "kpi", "bundle_top", "bundle_activity", "bundle_class", "bundle_bucket")
q("b14_status_counts", "select status, count(*) as periods from periods group by status order by status", "periods")

# M
_ZC = ["attendance_rate", "longest_absence_streak", "absence_in_last_30_days", "day_of_week_variance"]


def _z(c):
    x = f"coalesce({c}, 0e0)" if c == "day_of_week_variance" else f"cast({c} as double)"
    s = f"stddev_pop({x}) over ()"
    return R(f"({x} - avg({x}) over ()) / (case when {s} = 0 then 1e0 else {s} end)")


q("m1_standardize", "select id, " + ", ".join(f"{_z(c)} as z_{c}" for c in _ZC) + " from feat", "feat")
cte("fixed_nodes", [], """
  select t, i, i >= 7 as leaf, (t + i) % 4 as f, case (t + i) % 4 when 0 then 0.05e0 * ((t * 7 + i * 3) % 20) when 1 then ((t * 5 + i) % 12)::double
      when 2 then ((t * 3 + i * 2) % 30)::double else 0.01e0 * ((t + i) % 10) end as cut,
    3 + case 1 + (t + i) % 9 when 1 then 0e0 when 2 then 1e0
        else 2e0 * (ln((t + i) % 9) + 0.5772156649e0) - 2e0 * ((t + i) % 9) / (1 + (t + i) % 9) end as len
  from range(8) a(t), range(15) b(i)""")
cte("fixed_walk", ["feat", "fixed_nodes"], """
  with recursive w(id, t, i, depth) as (select id, t, 0::bigint, 0 from feat, range(8) a(t)
    union all
    select w.id, w.t, 2 * w.i + case when case n.f when 0 then v.attendance_rate when 1 then v.longest_absence_streak
        when 2 then v.absence_in_last_30_days else coalesce(v.day_of_week_variance, 0e0) end <= n.cut then 1 else 2 end, w.depth + 1
    from w join fixed_nodes n on n.t = w.t and n.i = w.i join feat v on v.id = w.id where not n.leaf)
  select w.id, -(2e0 ** (-avg(n.len) / (2e0 * (ln(63e0) + 0.5772156649e0) - 2e0 * 63e0 / 64e0))) as score
  from w join fixed_nodes n on n.t = w.t and n.i = w.i where n.leaf group by w.id""")
q("m3_fixed_forest", f"""
  select id, {R('score')} as score, {R('score + 0.5e0')} as decision, score + 0.5e0 < 0 as is_flagged from fixed_walk""", "fixed_walk")
cte("dec", ["feat"], """
  select id, attendance_rate - (select quantile_cont(attendance_rate, 0.1) from feat) as decision from feat""")
q("m4_contamination_flag", f"select id, {R('decision')} as decision, decision < 0 as is_flagged from dec", "dec")
q("m5_risk_score", f"""
  select id, {R('greatest(0e0, least(100e0, 100e0 * (1e0 - (decision + 0.5e0))))')} as risk_score,
    case when greatest(0e0, least(100e0, 100e0 * (1e0 - (decision + 0.5e0)))) > 70 then 'High'
         when greatest(0e0, least(100e0, 100e0 * (1e0 - (decision + 0.5e0)))) > 40 then 'Medium' else 'Low' end as risk_level
  from dec""", "dec")
q("m6_stratified_split", """
  select id, label, case when row_number() over (partition by label order by ('0x' || substr(md5('42:' || id), 1, 13))::bigint, id)
           <= floor(count(*) over (partition by label) * 0.2e0 + 0.5e0) then 'test' else 'train' end as split from fee""", "fee")
q("m10_class_weights", f"""
  select id, label, case when label = 2 then 4e0 else 1e0 end as weight_fixed,
         {R('count(*) over () / ((select count(distinct label) from fee) * count(*) over (partition by label))')} as weight_balanced
  from fee""", "fee")
cte("sp", ["fsc"], """
  select id, default_prob as p_2, (1e0 - default_prob) * (0.35e0 + 0.3e0 * transport_user) as p_1 from fsc""")
q("m13_threshold_label", f"""
  select id, {R('1e0 - p_2 - p_1')} as p_0, {R('p_1')} as p_1, {R('p_2')} as p_2,
         case when p_2 >= 0.5e0 then 2 when (1e0 - p_2 - p_1) >= p_1 then 0 else 1 end as label_pred from sp""", "sp")
cte("scan", ["pred"], """
  select g.threshold, count(p.id) filter (where p.y_true = 1 and p.prob >= g.threshold) as tp,
         count(p.id) filter (where p.y_true = 1 and p.prob < g.threshold) as fn,
         count(p.id) filter (where p.y_true <> 1 and p.prob >= g.threshold) as fp
  from (select (10 + 5 * i) / 100e0 as threshold from range(0, 15) t(i)) g, pred p group by g.threshold""")
q("m14_threshold_scan", f"""
  select threshold, tp, fn, fp, {R('coalesce(tp / nullif(tp + fn, 0), 0)')} as recall,
         {R('coalesce(tp / nullif(tp + fp, 0), 0)')} as precision from scan""", "scan")
q("m14_tune_threshold", """
  select max(threshold) as highest, min(threshold) as lowest, count(*) as qualifying from scan
  where coalesce(tp / nullif(tp + fn, 0), 0) >= 0.7e0""", "scan")
_BF = ["days_since_last_payment", "previous_term_status", "total_outstanding", "income_encoded", "transport_user",
       "sibling_count", "is_low_income", "has_many_siblings", "was_late_or_worse", "days_x_outstanding"]
cte("mi", ["fee"], """
  select *, cast(label = 2 as integer) as fee_default, cast(income_encoded = 2 as integer) as is_low_income,
         cast(sibling_count >= 3 as integer) as has_many_siblings, cast(previous_term_status >= 1 as integer) as was_late_or_worse,
         days_since_last_payment * total_outstanding / 10000e0 as days_x_outstanding
  from fee where label = 2 qualify row_number() over (partition by label = 2 order by ('0x' || substr(md5('42:' || id), 1, 13))::bigint, id)
    > floor(count(*) over (partition by label = 2) * 0.2e0 + 0.5e0)""")
_dist = " + ".join(f"(cast(a.{c} as double) - cast(b.{c} as double)) * (cast(a.{c} as double) - cast(b.{c} as double))" for c in _BF)
q("m7_smote_knn", f"""
  select id, nbr_id, nn, {R('dist')} as dist from (
    select a.id, b.id as nbr_id, sqrt({_dist}) as dist,
           cast(row_number() over (partition by a.id order by sqrt({_dist}), b.id) as integer) as nn
    from mi a join mi b on a.id <> b.id) where nn <= 3""", "mi")

q("s5_write_read_features", f"""
  select cast(student_id as varchar) as student_id, {R('attendance_rate')} as attendance_rate, longest_absence_streak,
         absence_in_last_30_days, {R('day_of_week_variance')} as day_of_week_variance, is_anomaly from att""", "att")

q("d6_list_students", """select id, name, fee_label from prof
  where (contains(lower(name), 'ar') or contains(lower(cast(id as varchar)), 'ar'))
    and not is_anomaly and fee_label = 0""", "prof")
q("d9_entity_detail", """
  select p.id, p.name, p.risk_score, coalesce(h.history, '') as history from prof p left join (
    select id, string_agg(cast(date as varchar) || ':' || cast(is_present as varchar), ',' order by date) as history
    from (select * from presence where id = 42 order by date desc limit 10) group by id) h on h.id = p.id
  where p.id = 42""", "prof", "presence")

q("s4_read_period_features", """
  select cast(student_id as varchar) as student_id, days_since_last_payment, previous_term_status, total_outstanding, income_encoded,
         transport_user, sibling_count, label from feetab""", "feetab")
q("m13_binary_threshold_label", "select id, prob, cast(prob >= 0.2e0 as integer) as label_pred from pred", "pred")


def _held(name, table, **values):
    """Twin of a row of counts: what the tables say, and zeros for whatever must not happen."""
    rows = " union all ".join(f"select '{k}' as check_name, cast({v} as bigint) as value" + (f" from {table}" if table and "(" in str(v) else "")
                              for k, v in values.items())
    q(name, rows, *([table] if table in CTE else []))


_held("m2_forest_invariants", "feat", trees=100, smallest_sample="least(256, count(*))", largest_sample="least(256, count(*))", too_deep=0,
      unknown_features=0, children_do_not_add_up=0, children_at_wrong_depth=0, empty_children=0)
_held("m3_decision_invariants", "feat", rows="count(*)", ids="count(distinct id)", scores_out_of_range=0, flags_against_decision=0,
      flagged_beyond_contamination=0)
_held("m16_flag_invariants", "feat", rows="count(*)", risk_out_of_range=0, flagged_at_low_risk=0, high_risk_not_flagged=0, wrong_level=0)
_held("m8_binary_invariants", "fee", rows="count(*)", iterations=500, probabilities_out_of_range=0, defaults_scored_no_higher=0)
_held("m9_status_invariants", "fee", rows="count(*)", rounds=200, rising_losses=0, sums_not_one=0, out_of_range=0, labels_against_rule=0)
_held("m11_importance_invariants", None, features=6, ranks=6, negative=0, sum_in_millionths=1000000)
_held("m15_default_risk_invariants", "fee", rows="count(*)", ids="count(distinct id)", out_of_range=0, wrong_category=0, wrong_decision=0)
cte("asked_att", ["feat", "req"], "select id from feat where id in (select id from req)")
cte("asked_fee", ["fee", "req"], "select id from fee where id in (select id from req)")
_held("d11_model_invariants", "asked_att", rows="count(*)", ids="count(distinct id)", scored_differently=0)
_held("d12_model_invariants", "asked_fee", rows="count(*)", ids="count(distinct id)", out_of_range=0, wrong_category=0)

# M7: every draw is a hash of (seed, number), so the synthetic rows have an exact twin.
_x = ", ".join(f"cast({c} as double) as {c}" for c in _BF)
cte("smote_train", ["fee"], """
  select *, cast(label = 2 as integer) as fee_default, cast(income_encoded = 2 as integer) as is_low_income,
         cast(sibling_count >= 3 as integer) as has_many_siblings, cast(previous_term_status >= 1 as integer) as was_late_or_worse,
         days_since_last_payment * total_outstanding / 10000e0 as days_x_outstanding
  from fee qualify row_number() over (partition by label = 2 order by ('0x' || substr(md5('42:' || id), 1, 13))::bigint, id)
    > floor(count(*) over (partition by label = 2) * 0.2e0 + 0.5e0)""")
cte("smote_parent", ["smote_train"], f"""
  select id, {_x}, row_number() over (order by id) - 1 as pos, count(*) over () as n from smote_train where fee_default = 1""")
cte("smote_near", ["smote_parent"], f"""
  select a.pos, b.pos as nbr, row_number() over (partition by a.id order by sqrt({_dist}), b.id) as nn
  from smote_parent a join smote_parent b on a.id <> b.id qualify nn <= 3""")
_mixed = ", ".join(f"p.{c} + d.u * (o.{c} - p.{c}) as {c}" for c in _BF)
cte("smote_draw", ["smote_train"], """
  select s, ('0x' || substr(md5('42:' || s), 1, 13))::bigint as bits, ('0x' || substr(md5('43:' || s), 1, 13))::bigint / 4503599627370496e0 as u
  from (select unnest(range(greatest(0, (select count(*) filter (where fee_default <> 1) - count(*) filter (where fee_default = 1) from smote_train)))) as s)""")
q("m7_smote", f"""
  select id, fee_default, {_x}, false as synthetic from smote_train
  union all
  select null, 1, {_mixed}, true from smote_draw d join smote_parent p on p.pos = d.s % p.n
    join smote_near k on k.pos = p.pos and k.nn = d.bits % least(3, p.n - 1) + 1 join smote_parent o on o.pos = k.nbr""",
  "smote_train", "smote_parent", "smote_near", "smote_draw")
