"""Queries for time series, increments, expectations and the feature tables built from them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nivalis.functions import columns as C
from nivalis.operators import clean as P
from nivalis.operators import quality as Q
from nivalis.operators import timeseries as W
from nivalis.plans.fixtures import table, view
from nivalis.plans.registry import query, with_folder
from nivalis.plans.relational_queries import VARIABLES
from nivalis.sources.published import DayTable, Versions
from nivalis.streaming import incremental as T
from nivalis.streaming import seasons as SS


def known():
    """The value, or null where it is a gap."""
    return F.when(F.col("v") <= 240, F.col("v"))


_G = "g as (select point_id, obs_date, case when v <= 240 then v end as v, date_diff('day', date '1970-01-01', obs_date) as x from panel)"
_EDGES = """, e as (select *,
  last_value(case when v is not null then x end ignore nulls) over b as px, last_value(v ignore nulls) over b as pv,
  first_value(case when v is not null then x end ignore nulls) over a as nx, first_value(v ignore nulls) over a as nv
  from g window b as (partition by point_id order by obs_date rows between unbounded preceding and current row),
                a as (partition by point_id order by obs_date rows between current row and unbounded following))
"""
_FILLED = "case when v is not null then v when pv is null and nv is null then 0e0 when pv is null then {lead} when nv is null then pv else pv + (nv - pv) * (x - px) / nullif(nx - px, 0) end"


@query("w01_lags", "select point_id, obs_date, coalesce(v, 0e0) as v, " + ", ".join(f"coalesce(lag(v, {k}) over (partition by point_id order by obs_date), 0e0) as v_{k}" for k in range(1, 8)) + " from panel", "panel")
def w01(panel):
    return W.lags(panel, ["point_id"], "obs_date", ["v"])


_RUN = "select point_id, obs_date, case when v is not null then round(sum(v) over (partition by {keys} order by obs_date rows unbounded preceding), 4) end as total from {source}"


@query("w02_running_sum", _RUN.format(keys="point_id", source="panel"), "panel")
def w02(panel):
    return W.running_sum(panel, ["point_id"], "obs_date", "v", "total").select("point_id", "obs_date", F.round("total", 4).alias("total"))


@query("w03_water_year_sum", _RUN.format(keys="point_id, water_year", source="season"), "season")
def w03(season):
    return W.running_sum(season, ["point_id", "water_year"], "obs_date", "v", "total").select("point_id", "obs_date", F.round("total", 4).alias("total"))


@query("w04_fill_linear", f"with {_G}{_EDGES} select point_id, obs_date, round({_FILLED.format(lead='nv')}, 6) as filled from e", "panel")
def w04(panel):
    return W.fill_linear(panel, ["point_id"], "obs_date", known(), "filled").select("point_id", "obs_date", F.round("filled", 6).alias("filled"))


_GROW = _G.replace("date_diff('day', date '1970-01-01', obs_date)", "row_number() over (partition by point_id order by obs_date)")


@query("w05_fill_and_total", f"with {_GROW}{_EDGES} select point_id, round(sum({_FILLED.format(lead='0e0')}), 4) as total from e group by 1", "panel")
def w05(panel):
    filled = W.fill_linear(panel, ["point_id"], "obs_date", known(), "filled", leading="zero", spacing="rows")
    return filled.groupBy("point_id").agg(F.round(F.sum("filled"), 4).alias("total"))


#: Added before rounding to four digits, so that values between two of them go one way.
_NUDGE = 1e-8


@query(
    "w06_fill_line",
    f"with {_G}, h as (select point_id, obs_date, v, x - min(x) over (partition by point_id) as x, cast(round(v * 1000000) as hugeint) as y from g), "
    "k as (select point_id, count(y) as n, sum(cast(x as hugeint)) filter (where y is not null) as sx, sum(cast(x * x as hugeint)) filter (where y is not null) as sxx, sum(y) as sy, sum(x * y) as sxy from h group by 1), "
    "s as (select h.*, k.* exclude (point_id), n * sxx - sx * sx as d from h join k using (point_id)) "
    f"select point_id, obs_date, round(greatest(0e0, least(240e0, case when n <= 1 then 0e0 when v is not null then v when d = 0 then cast(sy as double) / (n * 1e6) else cast(sy * sxx - sx * sxy + x * (n * sxy - sx * sy) as double) / (cast(d as double) * 1e6) end)) + {_NUDGE!r}, 4) as filled from s",
    "panel",
)
def w06(panel):
    days = F.datediff("obs_date", F.lit("1970-01-01").cast("date"))
    filled = W.fill_line(panel, ["point_id"], days, known(), "filled", 0.0, 240.0)
    return filled.select("point_id", "obs_date", F.round(F.col("filled") + _NUDGE, 4).alias("filled"))


@query("w07_season_to_date", "select point_id, count(*) as n, round(sum(v), 2) as total from season where obs_date between date '1996-10-01' and date '1997-03-15' group by 1", "season")
def w07(season):
    return W.season_to_date(season, "obs_date", "1997-03-15").groupBy("point_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 2).alias("total"))


@query("w08_day_and_total", "select point_id, max(case when obs_date = date '2024-01-20' then v end) as value, round(sum(v), 4) as total from panel where obs_date between date '2023-10-01' and date '2024-01-20' group by 1", "panel")
def w08(panel):
    return W.day_and_total(panel, ["point_id"], "obs_date", "v", "2024-01-20").withColumn("total", F.round("total", 4))


@query(
    "w09_complete_days",
    "with d as (select point_id, obs_date, v from daily where variable = 'click'), s as (select unnest(generate_series(min(obs_date), max(obs_date), interval 1 day)) as t from d) "
    "select p.point_id, cast(s.t as date) as obs_date, coalesce(d.v, 200e0) as v from (select distinct point_id from d) p cross join s left join d on d.point_id = p.point_id and d.obs_date = s.t",
    "daily",
)
def w09(daily):
    return W.complete_days(daily.where("variable = 'click'"), "point_id", "obs_date", "v", 200.0)


@query(
    "w10_by_series",
    "with s as (select point_id, obs_date, sum(coalesce(v, 0e0) - 50) over w as s from panel window w as (partition by point_id order by obs_date rows unbounded preceding)) "
    "select point_id, obs_date, round(s - least(0e0, min(s) over (partition by point_id order by obs_date rows unbounded preceding)), 4) as store from s",
    "panel",
)
def w10(panel):
    """A store that gains each day's value and loses up to 50 a day: a step from day to day, in each series by its order."""

    def stored(part):
        left, out = 0.0, []
        for gain in part["v"].fillna(0.0):
            left = max(0.0, left + gain - 50)
            out.append(left)
        return part[["point_id", "obs_date"]].assign(store=out)

    out = W.by_series(panel, ["point_id"], "obs_date", stored, "point_id long, obs_date date, store double")
    return out.withColumn("store", F.round("store", 4))


_SUMS = ", ".join(f"sum(power(x, {k})) filter (where v is not null) over w as s{k}, sum(v * power(x, {k})) over w as t{k}" for k in range(5))
_DET = "(({0}) * (({4}) * ({8}) - ({5}) * ({7})) - ({1}) * (({3}) * ({8}) - ({5}) * ({6})) + ({2}) * (({3}) * ({7}) - ({4}) * ({6})))"
_PARABOLA = " + ".join(f"power(x, {k}) * {_DET.format(*[f't{i}' if j == k else f's{i + j}' for i in range(3) for j in range(3)])}" for k in range(3))
_WHOLE = _DET.format(*[f"s{i + j}" for i in range(3) for j in range(3)])


@query(
    "w10_fill_parabola",
    f"with {_GROW}, p as (select point_id, obs_date, v, x - 1 - 15e0 as x from g), s as (select *, count(v) over w as n, {_SUMS} from p window w as (partition by point_id)) "
    f"select point_id, obs_date, round(case when n <= 2 then 0e0 when v is not null then v else ({_PARABOLA}) / {_WHOLE} end, 3) + 0e0 as v from s",
    "panel",
)
def w10_parabola(panel):
    """Gaps on each series' least-squares parabola."""
    rows = panel.select("point_id", "obs_date", known().alias("v"))
    return W.fill_polynomial(rows, ["point_id"], "obs_date", "v", 2).withColumn("v", F.round("v", 3) + 0.0)


# ---- expectations


@query("q01_no_nulls", "select 'v' as expectation, count(*) as checked, count(*) filter (where v is null) as failed, count(*) filter (where v is null) = 0 as ok from panel", "panel")
def q01(panel):
    return Q.no_nulls(panel, ["v"])


@query("q02_at_most", "select 'v' as expectation, count(*) as checked, count(*) filter (where v > 240) as failed, count(*) filter (where v > 240) = 0 as ok from panel", "panel")
def q02(panel):
    return Q.at_most(panel, {"v": 240.0})


@with_folder("q03_same_rows", "select count(*) as before, count(*) as after, true as ok from panel", "panel")
def q03(spark, sf_dir, folder):
    """Gap filling keeps the rows: counted before and after it while its result is written."""
    step = lambda df: W.fill_linear(df, ["point_id"], "obs_date", known(), "filled")
    return Q.watched_step(view(spark, sf_dir, "panel"), step, lambda df: df.write.parquet(f"{folder}/out"))


_RULES = {"no gap": "filled is not null", "not below 0": "filled >= 0", "at most 240": "filled <= 240"}


@with_folder(
    "q02_published_if_good",
    f"with {_G}{_EDGES}, f as (select {_FILLED.format(lead='nv')} as filled from e), c as (select unnest(['no gap', 'not below 0', 'at most 240']) as expectation) "
    "select expectation, (select count(*) from f) as checked, (select count(*) from f where case expectation when 'no gap' then filled is null when 'not below 0' then not coalesce(filled >= 0, false) else not coalesce(filled <= 240, false) end) as failed, true as ok from c",
    "panel",
)
def q02_published(spark, sf_dir, folder):
    """A filled series is published with its report; the same series before filling breaks a rule and is not, so readers keep the first."""
    panel = view(spark, sf_dir, "panel")
    rules = {n: F.expr(r) for n, r in _RULES.items()}
    filled = W.fill_linear(panel, ["point_id"], "obs_date", known(), "filled")
    number, report = Q.publish_checked(spark, folder, "good", filled, rules)
    try:
        Q.publish_checked(spark, folder, "bad", panel.withColumn("filled", F.lit(None).cast("double")), rules)
    except Q.ExpectationFailed as e:
        assert e.failed["no gap"] == panel.count()
    kept = Versions(spark, folder).latest() == number
    return report.withColumn("ok", F.col("ok") & F.lit(kept))


@query("q03_fills_grid", "select count(*) as rows, cast((max(y) + 1) * (max(x) + 1) as bigint) as cells, count(*) = (max(y) + 1) * (max(x) + 1) as ok from grid", "grid")
def q03_grid(grid):
    return Q.fills_grid(grid)


@query("q04_enough_places", "select 'distinct places' as expectation, count(*) as checked, greatest(10 - count(*), 0) as failed, count(*) >= 10 as ok from (select distinct lat10, lon10 from station)", "station")
def q04(station):
    return Q.enough_places(station, ["lat10", "lon10"], 10)


@query("q05_same_columns", "with c as (select column_name as name, table_name as t from information_schema.columns where table_name in ('customer', 'supplier')) select name as expectation, cast(1 as bigint) as checked, cast(case when count(distinct t) = 2 then 0 else 1 end as bigint) as failed, count(distinct t) = 2 as ok from c group by name", "customer", "supplier")
def q05(customer, supplier):
    return Q.same_columns(customer, supplier)


# ---- increments and streams


@query("t01_days_after", "select point_id, obs_date, v from daily where variable = 'view' and obs_date > (select max(obs_date) from daily where variable = 'click' and obs_date <= date '2024-01-20')", "daily")
def t01(daily):
    done = daily.where("variable = 'click' and obs_date <= date'2024-01-20'")
    return T.days_after(daily.where("variable = 'view'"), done, "obs_date").select("point_id", "obs_date", "v")


@with_folder("t02_daily_stream", "select cast(ts as date) as obs_date, event_type, count(*) as n, round(sum(value), 2) as total from events group by 1, 2")
def t02(spark, sf_dir, folder):
    """Event files as a stream with daily windows, as totals of all that has arrived."""
    events = table(spark, sf_dir, "events")
    stream = T.read_stream(spark, f"{sf_dir}/events.parquet*", events.schema)
    T.run_available(T.daily_totals(stream, "ts", ["event_type"], "value"), f"{folder}/out", f"{folder}/checkpoint", "complete")
    out = spark.read.parquet(f"{folder}/out")
    return out.select(F.col("window.start").cast("date").alias("obs_date"), "event_type", "n", F.round("total", 2).alias("total"))


_LATE = "ts < timestamp '2024-01-08' and event_id % 10 = 0"


@with_folder(
    "t02_daily_arrivals",
    f"select cast(ts as date) as obs_date, event_type, count(*) as n, round(sum(value), 2) as total from events where not ({_LATE}) "
    "group by 1, 2 having cast(ts as date) + interval 1 day <= (select max(ts) - interval 3 days from events)",
)
def t02_arrivals(spark, sf_dir, folder):
    """The same in three arrivals, each a run that goes on from the last one's state: a day comes out once and for good
    when it is three days behind, and rows of the first week that only the last arrival brings are too late."""
    events = table(spark, sf_dir, "events")
    late, new = F.expr(_LATE), F.col("ts") >= F.lit("2024-01-16").cast("timestamp")
    for arrived in (~late & ~new, ~late & new, late):
        events.where(arrived).write.mode("append").parquet(f"{folder}/in")
        stream = T.read_stream(spark, f"{folder}/in", events.schema)
        T.run_available(T.daily_totals(stream, "ts", ["event_type"], "value"), f"{folder}/out", f"{folder}/checkpoint")
    out = spark.read.parquet(f"{folder}/out")
    return out.select(F.col("window.start").cast("date").alias("obs_date"), "event_type", "n", F.round("total", 2).alias("total"))


@with_folder("t03_season_stream", "select o_custkey as point_id, cast(year(o_orderdate) + case when month(o_orderdate) >= 10 then 1 else 0 end as int) as water_year, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1, 2")
def t03(spark, sf_dir, folder):
    """Orders in two arrivals; the second run goes on from the totals that the first one kept as state."""
    orders = table(spark, sf_dir, "orders")
    for part in (0, 1):
        orders.where(F.pmod("o_orderkey", F.lit(2)) == part).write.mode("append").parquet(f"{folder}/in")
        stream = T.read_stream(spark, f"{folder}/in", orders.schema)
        T.run_available(T.season_totals(stream, "o_orderdate", "o_custkey", "o_totalprice"), f"{folder}/out", f"{folder}/checkpoint", "complete")
    return spark.read.parquet(f"{folder}/out").select(F.col("o_custkey").alias("point_id"), "water_year", "n", F.round("total", 2).alias("total"))


_ARRIVALS = (
    ("obs_date < date '1995-06-01'", "case when obs_date >= date '1995-04-01' then 2 * v else v end"),
    ("obs_date >= date '1995-04-01' and obs_date < date '1996-12-01'", "v"),
    ("obs_date >= date '1996-12-01' or (obs_date >= date '1996-09-01' and point_id % 10 = 0)", "v"),
)


def season_runs(spark, sf_dir, folder):
    """Daily totals in three arrivals: the second corrects two months of the first, the third brings again what some points had."""
    season, own = view(spark, sf_dir, "season").select("point_id", "obs_date", "v"), SS.state_session(spark)
    for chosen, v in _ARRIVALS:
        season.where(chosen).withColumn("v", F.expr(v)).write.mode("append").parquet(f"{folder}/in")
        stream = T.read_stream(own, f"{folder}/in", season.schema)
        SS.run_changes(SS.changed_totals(stream, "obs_date", "point_id", "v", late="200 days", blocks=4096), f"{folder}/out", f"{folder}/checkpoint")


@with_folder("t03_season_state", "select point_id, water_year, count(*) as n, round(sum(v), 2) as total, max(obs_date) as last_day from season group by 1, 2", "season")
def t03_state(spark, sf_dir, folder):
    """What stands after all arrivals equals the totals of all days."""
    season_runs(spark, sf_dir, folder)
    return SS.current_totals(spark, f"{folder}/out", "point_id").withColumn("total", F.round("total", 2))


@with_folder(
    "t03_changed_rows",
    "with r as (select 0 as run, point_id, water_year, obs_date from season where obs_date < date '1995-06-01' "
    "union all select 1, point_id, water_year, obs_date from season where obs_date >= date '1995-04-01' and obs_date < date '1996-12-01' "
    "union all select 2, point_id, water_year, obs_date from season where obs_date >= date '1996-12-01') "
    "select run, count(distinct (point_id, water_year)) as seasons, count(*) as written from (select distinct run, point_id, water_year from r) group by 1",
    "season",
)
def t03_changed(spark, sf_dir, folder):
    """Each run writes only the seasons that it changed, each once; days that come again with the value they had change none."""
    season_runs(spark, sf_dir, folder)
    rows = spark.read.parquet(f"{folder}/out")
    runs = rows.select("batch").distinct().withColumn("run", (F.row_number().over(Window.orderBy("batch")) - 1).cast("int"))
    return rows.join(runs, "batch").groupBy("run").agg(F.count_distinct("point_id", "water_year").alias("seasons"), F.count(F.lit(1)).alias("written"))


@with_folder("t04_late_correction", "select point_id, obs_date, variable, case when variable = 'click' then v * 2 else v end as v from daily", "daily")
def t04(spark, sf_dir, folder):
    """All days are stored, then corrected clicks arrive and replace theirs."""
    daily = view(spark, sf_dir, "daily").select("point_id", "obs_date", "variable", "v")
    daily.write.parquet(f"{folder}/in1")
    daily.where("variable = 'click'").withColumn("v", F.col("v") * 2).write.parquet(f"{folder}/in2")
    for part in ("in1", "in2"):
        stream = T.read_stream(spark, f"{folder}/{part}", daily.schema)
        T.correct_days(stream, f"{folder}/table", f"{folder}/checkpoint-{part}", "obs_date", ["point_id", "variable"])
    return DayTable(spark, f"{folder}/table").read().select("point_id", "obs_date", "variable", "v")


@with_folder(
    "t04_ordered_corrections",
    "select point_id, obs_date, variable, case when variable = 'click' then v + 2 when variable = 'view' then v + 1 else v end as v from daily",
    "daily",
)
def t04_ordered(spark, sf_dir, folder):
    """Several corrections of a key arrive in one batch, and the one sent last counts, whatever their order in the files; rows without a point are replaced too."""
    daily = view(spark, sf_dir, "daily").select(F.when(F.col("point_id") % 7 > 0, F.col("point_id")).alias("p"), "point_id", "obs_date", "variable", "v", F.lit(0).alias("sent"))
    daily.write.parquet(f"{folder}/in1")
    again = lambda kinds, turn, add: daily.where(F.col("variable").isin(kinds)).withColumns({"v": F.col("v") + add, "sent": F.lit(turn)})
    again(["click", "view"], 1, 1.0).union(again(["click"], 2, 2.0)).repartition(3, "v").write.parquet(f"{folder}/in2")
    for part in ("in1", "in2"):
        stream = T.read_stream(spark, f"{folder}/{part}", daily.schema)
        T.correct_days(stream, f"{folder}/table", f"{folder}/checkpoint-{part}", "obs_date", ["p", "point_id", "variable"], "sent")
    return DayTable(spark, f"{folder}/table").read().select("point_id", "obs_date", "variable", "v")


# ---- feature tables


@query(
    "season_features",
    f"with {_G}{_EDGES}, f as (select point_id, obs_date, {_FILLED.format(lead='nv')} as filled, "
    "year(obs_date) + case when month(obs_date) >= 10 then 1 else 0 end as wy from e), "
    "c as (select *, sum(filled) over (partition by point_id, wy order by obs_date rows unbounded preceding) as total from f) "
    "select c.point_id, c.obs_date, round(c.filled, 6) as filled, round(log10(c.total + 0.1e0), 6) as cumulative, s.elevation from c left join station s using (point_id)",
    "panel",
    "station",
)
def season_features(panel, station):
    """Gap-filled observations, their total for the season so far on a log scale, and the station's elevation."""
    filled = W.fill_linear(panel, ["point_id"], "obs_date", known(), "filled").withColumn("water_year", C.water_year(F.col("obs_date")))
    total = W.running_sum(filled, ["point_id", "water_year"], "obs_date", "filled", "cumulative")
    logged = C.log_cumulative(total.select("point_id", "obs_date", "filled", "cumulative"))
    out = logged.join(station.select("point_id", "elevation"), "point_id", "left")
    return out.withColumns({"filled": F.round("filled", 6), "cumulative": F.round("cumulative", 6)})


@query(
    "training_table",
    "with k as (select point_id, obs_date, " + ", ".join(f"max(v) filter (where variable = '{v}') as {v}" for v in VARIABLES) + " from daily group by 1, 2) "
    f"select point_id, obs_date, {', '.join(VARIABLES)}, cast(floor(((month(obs_date) + 9) % 12) / 3) as int) + 1 as season, elevation, "
    "coalesce(lag(click, 1) over w, 0e0) as click_1, coalesce(lag(click, 2) over w, 0e0) as click_2 "
    "from (select k.*, s.elevation from k join station s using (point_id) where lat between 25 and 49 and lon between -125 and -100) window w as (partition by point_id order by obs_date)",
    "daily",
    "station",
)
def training_table(daily, station):
    """Sources as columns, stations in the region, season and lags: the table a model is trained on."""
    wide = daily.groupBy("point_id", "obs_date").pivot("variable", VARIABLES).agg(F.first("v"))
    stations = P.in_box(station, 25, 49, -125, -100).select("point_id", "elevation")
    joined = wide.join(stations, "point_id").withColumn("season", C.season(F.col("obs_date")))
    w = Window.partitionBy("point_id").orderBy("obs_date")
    return joined.withColumns({f"click_{k}": F.coalesce(F.lag("click", k).over(w), F.lit(0.0)) for k in (1, 2)})
