"""Queries for joins, aggregates, sorts and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from nivalis.functions import columns as C
from nivalis.operators import aggregates as A
from nivalis.operators import joins as J
from nivalis.operators import sketches as K
from nivalis.operators.lineage import checkpointed, numbered
from nivalis.plans.fixtures import view
from nivalis.plans.registry import query, with_folder
from nivalis.sources.bucketed import bucketed

KEY = ["point_id", "obs_date"]
VARIABLES = ["click", "view", "purchase", "error", "signup"]
_THREE = [f"{v} as (select point_id, obs_date, v as {v} from daily where variable = '{v}')" for v in ("click", "view", "purchase")]
WITH3 = "with " + ", ".join(_THREE) + " "


def three(daily):
    return [daily.where(F.col("variable") == v).select(*KEY, F.col("v").alias(v)) for v in ("click", "view", "purchase")]


@query("j01_inner", WITH3 + 'select point_id, obs_date, click, "view" from click join "view" using (point_id, obs_date)'.replace('"view"', "view"), "daily")
def j01(daily):
    click, view, _ = three(daily)
    return J.inner(click, view.withColumnRenamed("point_id", "p"), KEY, ["p", "obs_date"])


@query(
    "j01_inner_null_safe",
    "select a.event_id as event_id, b.n from code a join (select label, count(*) as n from code group by 1) b on a.label is not distinct from b.label",
    "code",
)
def j01_null_safe(code):
    counts = code.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return J.inner(code.select("event_id", "label"), counts, ["label"], null_safe=True).select("event_id", "n")


@query("j02_left_chain", WITH3 + "select point_id, obs_date, click, view, purchase from click left join view using (point_id, obs_date) left join purchase using (point_id, obs_date)", "daily")
def j02(daily):
    click, view, purchase = three(daily)
    return J.left_chain(click.unionByName(click), [view, purchase], KEY, ["click"])


@query("j03_outer_chain", WITH3 + "select distinct point_id, obs_date, click, view, purchase from click full join view using (point_id, obs_date) full join purchase using (point_id, obs_date)", "daily")
def j03(daily):
    click, view, purchase = three(daily)
    return J.outer_chain([click.unionByName(click), view, purchase], KEY)


@with_folder("j03_bucketed_chain", WITH3 + "select distinct point_id, obs_date, click, view, purchase from click full join view using (point_id, obs_date) full join purchase using (point_id, obs_date)", "daily")
def j03_bucketed(spark, sf_dir, folder):
    """Three sources stored in buckets of point and day, and joined where they lie."""
    sources = three(view(spark, sf_dir, "daily"))
    return J.outer_chain([bucketed(s, f"{folder}/{i}", KEY, 8) for i, s in enumerate(sources)], KEY)


@query("j04_dimension", "select d.point_id, d.obs_date, d.variable, d.v, s.elevation from daily d left join station s using (point_id)", "daily", "station")
def j04(daily, station):
    return J.with_dimension(daily, station.select("point_id", "elevation"), ["point_id"]).drop("n")


@query("j05_zip", "with a as (select z, row_number() over (order by cell_id) as row from grid), b as (select code, row_number() over (order by cell_id desc) as row from grid) select row, z, code from a full join b using (row)", "grid")
def j05(grid):
    a, b = grid.select("cell_id", "z"), grid.select(F.col("cell_id").alias("c"), "code")
    return J.zip_by_order([a, b], [["cell_id"], [F.desc("c")]]).select(F.col("row").cast("long").alias("row"), "z", "code")


@query("j06_present_every_day", "select point_id, obs_date, v from (select *, count(v) over (partition by point_id) as own from panel) where own = (select count(distinct obs_date) from panel) and v is not null", "panel")
def j06(panel):
    return J.present_every_day(panel.where("v is not null"), "point_id", "obs_date")


@query("j14_look_up", "select s.event_id, s.code, s.lc, g.z as found from code s left join grid g on g.y = s.lc and g.x = s.code", "code", "grid")
def j14(code, grid):
    return J.look_up(code.select("event_id", "code", "lc"), grid, "lc", "code", "z")


@query("j15_pixel", "select point_id, cast(floor((49.05e0 - lat) / 0.36e0) as int) as y, cast(floor((lon - -125.05e0) / 0.36e0) as int) as x, cast(trunc((49.05e0 - lat) / 0.36e0) as int) as ty from station", "station")
def j15(station):
    y, x = J.pixel(F.col("lat"), F.col("lon"), 49.05, -125.05, 0.36)
    return station.select("point_id", y.alias("y"), x.alias("x"), J.pixel(F.col("lat"), F.col("lon"), 49.05, -125.05, 0.36, truncate=True)[0].alias("ty"))


@query("j16_audit", WITH3 + "select count(*) as compared, count(*) filter (where click.click is distinct from view.view) as differ from click join view using (point_id, obs_date)", "daily")
def j16(daily):
    click, view, _ = three(daily)
    return J.audit(click.withColumnRenamed("click", "x"), view.withColumnRenamed("view", "x"), KEY, "x")


@query("j17_not_collected", WITH3 + "select point_id, obs_date, click from click where not exists (select 1 from view where view.point_id = click.point_id and view.obs_date = click.obs_date)", "daily")
def j17(daily):
    click, view, _ = three(daily)
    return J.not_collected(click, view, KEY)


@query("j18_attach", "with p as (select point_id, round(avg(v), 6) as predicted from panel where v > 100 group by 1) select point_id, obs_date, v, predicted from panel left join p using (point_id)", "panel")
def j18(panel):
    predicted = panel.where("v > 100").groupBy("point_id").agg(F.round(F.avg("v"), 6).alias("predicted"))
    return J.attach(panel, predicted, ["point_id"])


@query("j20_last_year", "with y as (select point_id, year(obs_date) as cover_year, round(sum(v), 2) as cover from season group by 1, 2) select s.point_id, s.obs_date, cast(year(s.obs_date) - 1 as int) as cover_year, y.cover from season s left join y on y.point_id = s.point_id and y.cover_year = year(s.obs_date) - 1", "season")
def j20(season):
    yearly = season.groupBy("point_id", F.year("obs_date").alias("cover_year")).agg(F.round(F.sum("v"), 2).alias("cover"))
    return J.with_last_year(season, "obs_date", yearly, "cover_year", ["point_id"]).select("point_id", "obs_date", "cover_year", "cover")


# ---- aggregates

_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
_LONG = "with s as (" + " union all ".join(f"select '{c}' as name, {c} as value from lineitem" for c in _COLS) + ") "


def rounded(df, digits=6):
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


@query("a01_describe", _LONG + "select name, count(value) as n, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std, round(min(value), 6) as low, " + ", ".join(f"round(percentile_cont({p}) within group (order by value), 6) as q{int(p * 100)}" for p in (0.25, 0.5, 0.75)) + ", round(max(value), 6) as high from s group by name", "lineitem")
def a01(lineitem):
    return rounded(A.describe(lineitem, _COLS))


_RANGES = "(values ('first', date '2024-01-01', date '2024-01-10'), ('rest', date '2024-01-11', date '2024-01-31'), ('all', date '2024-01-01', date '2024-01-31')) t(part, a, b)"


def daily_summaries(daily):
    return K.daily(daily.select("obs_date", "point_id", "v"), "obs_date", "v", F.col("point_id"), 0.0, 500.0, 50)


def of_ranges(daily, read):
    """read(the merged summaries) of three ranges of days."""
    days = checkpointed(daily_summaries(daily))
    ranges = [("first", "2024-01-01", "2024-01-10"), ("rest", "2024-01-11", "2024-01-31"), ("all", "2024-01-01", "2024-01-31")]
    parts = [read(K.over(days, "obs_date", a, b)).select(F.lit(part).alias("part"), "*") for part, a, b in ranges]
    return parts[0].union(parts[1]).union(parts[2])


@query("a01_merged_summaries", f"select t.part, count(*) as n, count(*) - count(v) as n_null, round(avg(v), 6) as mean, min(v) as smallest, max(v) as largest from daily join {_RANGES} on obs_date between t.a and t.b group by 1", "daily")
def a01_merged(daily):
    """Ranges of days from daily summaries."""
    return of_ranges(daily, K.answers).select("part", "n", "n_null", F.round("mean", 6).alias("mean"), "smallest", "largest")


@query("a15_merged_histogram", f"select t.part, cast(least(floor(v / 500 * 50), 49) as int) as bin, count(*) as n from daily join {_RANGES} on obs_date between t.a and t.b where v between 0 and 500 group by 1, 2", "daily")
def a15_merged(daily):
    return of_ranges(daily, K.histogram)


@query(
    "a05_sketch_errors",
    f"select t.part, count(distinct point_id) as places, true as places_near, true as quantiles_near from daily join {_RANGES} on obs_date between t.a and t.b group by 1",
    "daily",
)
def a05_errors(daily):
    """Estimates of ranges of days against exact counts: within the bounds that the sketches state."""
    exact = lambda a, b: daily.where(F.col("obs_date").between(F.lit(a).cast("date"), F.lit(b).cast("date")))
    found = of_ranges(daily, K.answers)
    out = None
    for part, a, b in (("first", "2024-01-01", "2024-01-10"), ("rest", "2024-01-11", "2024-01-31"), ("all", "2024-01-01", "2024-01-31")):
        own = F.broadcast(found.where(F.col("part") == part).withColumnsRenamed({"n": "__n"}))  # one row
        rows = exact(a, b).select("point_id", "v").join(own)
        near = [(F.count_if(F.col("v") <= F.col(q)) / F.max("__n") >= s - K.RANK_ERROR) & (F.count_if(F.col("v") < F.col(q)) / F.max("__n") <= s + K.RANK_ERROR) for q, s in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))]
        n = F.count_distinct("point_id")
        row = rows.agg(F.lit(part).alias("part"), n.alias("places"), (F.abs(F.max("places") - n) <= K.DISTINCT_ERROR * n + 0.5).alias("places_near"), (near[0] & near[1] & near[2]).alias("quantiles_near"))
        out = row if out is None else out.union(row)
    return out


@query("a02_describe_population", _LONG + "select name, round(avg(value), 6) as mean, round(median(value), 6) as median, round(stddev_pop(value), 6) as std, round(var_pop(value) / 1e6, 4) as variance, round(min(value), 6) as low, round(max(value), 6) as high, round(sum(value), 1) as total from s group by name", "lineitem")
def a02(lineitem):
    out = A.describe_population(lineitem, _COLS)
    out = out.withColumns({"variance": F.round(F.col("variance") / 1e6, 4), "total": F.round("total", 1)})
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "median", "std", "low", "high")})


@query("a03_null_counts", "select 'depth' as name, count(*) filter (where depth is null) as nulls from code union all select 'label', count(*) filter (where label is null) from code", "code")
def a03(code):
    return A.null_counts(code, ["depth", "label"])


@query("a04_count_where", "select count(*) filter (where v > 240) as n from panel", "panel")
def a04(panel):
    return A.count_where(panel, F.col("v") > 240)


@query("a05_distinct_places", "select count(*) as places, count(*) >= 10 as enough from (select distinct lat10, lon10 from station)", "station")
def a05(station):
    return A.distinct_places(station, ["lat10", "lon10"], 10)


@query("a06_distinct_years", "select distinct cast(year(obs_date) as int) as year from season", "season")
def a06(season):
    return season.select(F.year("obs_date").alias("year")).distinct()


_ENDS = "with e as (select greatest(min(l_extendedprice), 0e0) as low, max(l_extendedprice) as high from lineitem) "


@query("a07_class_breaks", _ENDS + "select cast(step as int) as step, round(low + step * (high - low) / 12, 6) as bound from e, range(12) r(step)", "lineitem")
def a07(lineitem):
    return rounded(A.class_breaks(lineitem, "l_extendedprice"))


@query("a08_class_counts", _ENDS + "select case " + " ".join(f"when l_extendedprice <= low + {i} * (high - low) / 12 then {i}" for i in range(12)) + " else 12 end as class, count(*) as n from lineitem, e group by 1", "lineitem")
def a08(lineitem):
    return A.class_counts(lineitem, "l_extendedprice")


@query("a09_group_total", "select o_orderkey, round(sum(o_totalprice) over (partition by o_custkey), 2) as total from orders", "orders")
def a09(orders):
    from pyspark.sql.window import Window

    return orders.select("o_orderkey", F.round(F.sum("o_totalprice").over(Window.partitionBy("o_custkey")), 2).alias("total"))


@query("a10_circular_mean", "with s as (select y, code * 1.40625e0 as a from grid) select y, round(case when d < 0 then d + 360 else d end, 4) as aspect from (select y, degrees(atan2(sum(sin(radians(a))), sum(cos(radians(a))))) as d from s group by y)", "grid")
def a10(grid):
    return grid.groupBy("y").agg(F.round(A.circular_mean(F.col("code") * 1.40625), 4).alias("aspect"))


@query("a12_keep_first", "select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as r from orders) where r = 1", "orders")
def a12(orders):
    return A.keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("a13_full_row_dedup", "select distinct l_partkey, l_suppkey, l_quantity from lineitem", "lineitem")
def a13(lineitem):
    return lineitem.select("l_partkey", "l_suppkey", "l_quantity").dropDuplicates()


@query("a14_latest_date", "select max(cast(ts as date)) as latest from events", "events")
def a14(events):
    return events.agg(F.max(F.col("ts").cast("date")).alias("latest"))


@query(
    "a15_compare_histograms",
    """
    with s as (select 'l_quantity' as name, l_quantity as v, 0e0 as lo, 50e0 / 100 as w, l_orderkey % 5 = 0 as test from lineitem
               union all select 'l_discount', l_discount * 1000, 0e0, 100e0 / 100, l_orderkey % 5 = 0 from lineitem)
    select name, cast(least(floor((v - lo) / w) + 1, 100) as int) as bin, count(*) filter (where not test) as n_a, count(*) filter (where test) as n_b
    from s group by 1, 2
    """,
    "lineitem",
)
def a15(lineitem):
    rows = lineitem.select("l_orderkey", "l_quantity", (F.col("l_discount") * 1000).alias("l_discount"))
    test = F.col("l_orderkey") % 5 == 0
    return A.compare_histograms(rows.where(~test), rows.where(test), ["l_quantity", "l_discount"], {"l_quantity": (0.0, 50.0), "l_discount": (0.0, 100.0)})


@query("a16_density", "select cast(floor(l_quantity / 5) as bigint) as bx, cast(floor(l_extendedprice / 10000) as bigint) as \"by\", count(*) as n from lineitem group by 1, 2", "lineitem")
def a16(lineitem):
    return A.density(lineitem, "l_quantity", "l_extendedprice", 5, 10000)


@query("a19_union_by_variable", "select point_id, obs_date, variable, v from daily where variable is not null", "daily")
def a19(daily):
    parts = [daily.where(F.col("variable") == v).select(*KEY, F.lit(v).alias("variable"), "v") for v in VARIABLES]
    return A.union_all(*parts)


@query("a20_widen", "select point_id, obs_date, " + ", ".join(f"max(v) filter (where variable = '{v}') as {v}" for v in VARIABLES) + " from daily group by 1, 2", "daily")
def a20(daily):
    return A.widen(daily, KEY, "variable", "v", VARIABLES)


@query("a21_correlations", "select 'l_quantity' as name, round(corr(l_quantity, l_extendedprice), 6) as corr from lineitem union all select 'l_tax', round(corr(l_tax, l_extendedprice), 6) from lineitem", "lineitem")
def a21(lineitem):
    return rounded(A.correlations(lineitem, "l_extendedprice", ["l_quantity", "l_tax"]))


# ---- sorts and unions


@query("o01_sort_by_day", "select point_id, obs_date, v, row_number() over (order by obs_date, point_id, v) as place from season", "season")
def o01(season):
    """A global order, by a range sort at the end; the place comes from the sizes of ranges, not from one task."""
    return numbered(season.select("point_id", "obs_date", "v"), ["obs_date", "point_id", "v"], "place").orderBy("obs_date", "point_id", "v")


@query("o02_sort_by_point", "select point_id, obs_date, row_number() over (partition by point_id order by obs_date, v) as place from season", "season")
def o02(season):
    from pyspark.sql.window import Window

    return season.select("point_id", "obs_date", F.row_number().over(Window.partitionBy("point_id").orderBy("obs_date", "v")).cast("long").alias("place"))


@query("o03_head", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10", "orders")
def o03(orders):
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


@query("o05_argmin", "select y, min_by(cell_id, abs(z - 300) * 100000 + cell_id) as cell_id from grid group by y", "grid")
def o05(grid):
    return grid.groupBy("y").agg(F.min_by("cell_id", F.struct(F.abs(F.col("z") - 300).alias("d"), "cell_id")).alias("cell_id"))


@query("u01_union_missing", "select c_custkey as id, c_acctbal as bal, c_mktsegment from customer union all select s_suppkey, s_acctbal, null from supplier", "customer", "supplier")
def u01(customer, supplier):
    a = customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), "c_mktsegment")
    return A.union_all(a, supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal")))


@query("u02_union_same", "select point_id, obs_date, variable, v from daily", "daily")
def u02(daily):
    parts = [daily.where(F.col("variable") == v) for v in VARIABLES]
    rest = daily.where(~F.col("variable").isin(VARIABLES) | F.col("variable").isNull())
    return A.union_all(*parts, rest).drop("n")


@query("u03_union_points", "select lat10, lon10 from station union select lat10, lon10 from grid", "station", "grid")
def u03(station, grid):
    return A.union_all(station.select("lat10", "lon10"), grid.select("lat10", "lon10")).distinct()


@query(
    "u04_column_difference",
    "with c as (select column_name as name, table_name as t from information_schema.columns where table_name in ('documents', 'pages')), "
    "n as (select 'documents' as t, count(*) as n from documents union all select 'pages', count(*) from pages) "
    "select name, case t when 'documents' then 'left' else 'right' end as only_in, n from (select name, min(t) as t from c group by name having count(distinct t) = 1) join n using (t)",
    "documents", "pages",
)
def u04(documents, pages):
    """Columns that only one of two tables has, with the number of rows that carry them."""
    counts = A.union_all(*[df.agg(F.count(F.lit(1)).alias("n")).withColumn("only_in", F.lit(side)) for df, side in ((documents, "left"), (pages, "right"))])
    return A.column_difference(documents, pages).join(counts, "only_in")


@query("a06_seasons_by_point", "select point_id, count(*) as n, cast(count(distinct water_year) as bigint) as seasons from season group by 1", "season")
def a06_by_point(season):
    return season.groupBy("point_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(C.water_year(F.col("obs_date"))).alias("seasons"))
