"""Queries for column functions and value repairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from nivalis.functions import columns as C
from nivalis.operators import aggregates as A
from nivalis.operators import clean as P
from nivalis.plans.registry import query, scalar

DAY = ["point_id", "obs_date"]

scalar("f01_season", "season", DAY, {"season": (lambda: C.season(F.col("obs_date")), "cast(floor(((month(obs_date) + 9) % 12) / 3) as int) + 1")})
scalar("f02_month_mod3", "season", DAY, {"m": (lambda: C.month_mod3(F.col("obs_date")).cast("int"), "cast((month(obs_date) - 1) % 3 as int)")})
scalar("f03_water_year", "season", DAY, {"wy": (lambda: C.water_year(F.col("obs_date")), "water_year")})
scalar("f04_season_start", "season", DAY, {"start": (lambda: C.season_start(F.col("obs_date")), "make_date(water_year - 1, 10, 1)")})
scalar(
    "f05_days_since_1900", "season", DAY,
    {
        "days": (lambda: C.days_since_1900(F.col("obs_date")).cast("long"), "date_diff('day', date '1900-01-01', obs_date)"),
        "back": (lambda: C.from_days_since_1900(C.days_since_1900(F.col("obs_date"))), "obs_date"),
    },
)
scalar("f06_year_and_day", "season", DAY, {"yd": (lambda: C.year_and_day(F.col("obs_date")), "year(obs_date) || lpad(cast(dayofyear(obs_date) as varchar), 3, '0')")})
scalar("f07_cube_day", "season", DAY, {"idx": (lambda: C.cube_day(F.col("obs_date")).cast("int"), "cast(dayofyear(obs_date) - 1 as int)")})
scalar(
    "f08_parse_us_time", "season", DAY,
    {"parsed": (lambda: C.parse_us_time(F.concat(F.month(F.col("obs_date")), F.lit("/"), F.dayofmonth(F.col("obs_date")), F.lit("/"), F.year(F.col("obs_date")), F.lit(" 7:05"))), "obs_date")},
)
scalar(
    "f09_haversine", "station", ["point_id"],
    {"km": (lambda: F.round(C.haversine_km(F.col("lat"), F.col("lon"), F.lit(40.0), F.lit(-110.0)), 5),
            "round(2 * 6371.0e0 * asin(sqrt(least(pow(sin(radians(40.0e0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(40.0e0)) * pow(sin(radians(-110.0e0 - lon) / 2), 2), 1e0))), 5)")},
)
scalar("f10_degree_distance", "station", ["point_id"], {"d": (lambda: F.round(C.degree_distance(F.col("lat"), F.col("lon"), F.lit(40.0), F.lit(-110.0)), 8), "round(sqrt(pow(40.0e0 - lat, 2) + pow(-110.0e0 - lon, 2)), 8)")})
@query("f15_sample_weight", "select point_id, obs_date, round((v - min(v) over (partition by water_year)) / nullif(max(v) over (partition by water_year) - min(v) over (partition by water_year), 0) * 10, 8) as w from season", "season")
def f15(season):
    return A.scaled_weight(season, "v", "w", 10.0, ["water_year"]).select(*DAY, F.round("w", 8).alias("w"))


@query("f15_sample_weight_all", "select point_id, obs_date, round((v - min(v) over ()) / nullif(max(v) over () - min(v) over (), 0) * 10, 8) as w from season", "season")
def f15_all(season):
    return A.scaled_weight(season, "v", "w", 10.0).select(*DAY, F.round("w", 8).alias("w"))


scalar("f16_asymmetric_loss", "lineitem", ["l_orderkey", "l_linenumber"], {"loss": (lambda: F.round(C.asymmetric_loss(F.col("l_quantity"), F.col("l_tax") * 100), 6), "round(abs(l_quantity - l_tax * 100) * case when l_quantity > 10 then 2e0 else 1e0 end, 6)")})
scalar("f17_normalise", "panel", DAY, {"scaled": (lambda: F.round(C.normalised(F.col("v")), 9), "round(v / 200e0, 9)"), "back": (lambda: F.round(C.denormalised(C.normalised(F.col("v"))), 6), "round(v / 200e0 * 200e0, 6)")})
scalar("f19_operation_day", "season", DAY, {"op_day": (lambda: C.operation_day(F.col("obs_date")), "cast(obs_date - interval 3 day as date)")})
scalar(
    "f14_name_parts", "pages", ["page_id"],
    {"variable": (lambda: C.name_parts(F.concat(F.lit("tmmx_"), F.col("page_id"), F.lit("_2024.nc")))[0], "'tmmx'"),
     "number": (lambda: C.name_parts(F.concat(F.lit("tmmx_"), F.col("page_id"), F.lit("_2024.nc")))[1], "cast(page_id as varchar)"),
     "url_date": (lambda: C.date_in(F.col("url")), "nullif(regexp_extract(url, '\\d{4}-\\d{2}-\\d{2}'), '')")},
)


@query("f11_log_cumulative", "select point_id, obs_date, v, case when v + 0.1e0 > 0 then round(log10(v + 0.1e0), 8) end as cumulative_v, case when v * 2 + 0.1e0 > 0 then round(log10(v * 2 + 0.1e0), 8) end as cumulative_w from panel", "panel")
def log_cumulative(panel):
    wide = panel.withColumns({"cumulative_v": F.col("v"), "cumulative_w": F.col("v") * 2})
    out = C.log_cumulative(wide)
    return out.withColumns({c: F.round(c, 8) for c in ("cumulative_v", "cumulative_w")})


_BREAKS = [float(5 * i) for i in range(12)]


@query("f12_class_index", "select l_orderkey, l_linenumber, case " + " ".join(f"when l_quantity <= {b}e0 then {i}" for i, b in enumerate(_BREAKS)) + " else 12 end as class from lineitem", "lineitem")
def class_index(lineitem):
    return lineitem.select("l_orderkey", "l_linenumber", C.class_index(F.col("l_quantity"), [F.lit(b) for b in _BREAKS]).alias("class"))


_SITES = {"click": (1.0, -2.0), "view": (2.5, -4.0), "purchase": (-3.0, 6.0), "error": (4.0, 8.25), "signup": (5.0, -10.0)}


@query(
    "f13_site_columns",
    "with sites(variable, lat, lon) as (values " + ", ".join(f"('{v}', {y}e0, {x}e0)" for v, (y, x) in _SITES.items()) + ") "
    "select k.point_id, k.obs_date, sites.lat, sites.lon, d.v from (select distinct point_id, obs_date from daily) k cross join sites "
    "left join daily d on d.point_id = k.point_id and d.obs_date = k.obs_date and d.variable = sites.variable",
    "daily",
)
def site_columns(daily):
    """Columns named by coordinates become rows, for all sites."""
    wide = daily.groupBy(*DAY).pivot("variable", list(_SITES)).agg(F.first("v"))
    wide = wide.toDF(*DAY, *[f"({y}, {x})" for y, x in _SITES.values()])
    out = wide.unpivot(DAY, [f"`{c}`" for c in wide.columns[2:]], "site", "v")
    return out.select(*DAY, *C.coordinates_in(F.col("site")), "v")


# ---- projections, filters, repairs


@query("p01_rename", 'select l_orderkey as point, l_linenumber, l_quantity as "SWE", l_tax as wind_speed from lineitem', "lineitem")
def rename(lineitem):
    named = lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("AMSR_SWE"), F.col("l_tax").alias("vs"))
    return P.rename(P.rename(named), {"l_orderkey": "point", "not_there": "x"})


@query("p02_select_in_order", "select l_tax, l_discount, l_quantity, l_orderkey, l_linenumber from lineitem", "lineitem")
def select_in_order(lineitem):
    return P.select_in_order(lineitem, ["l_tax", "l_discount", "l_quantity", "l_orderkey", "l_linenumber"])


@query("p03_drop_columns", "select p_partkey, p_size, p_retailprice from part", "part")
def drop_columns(part):
    twice = part.select("p_partkey", "p_size", "p_retailprice", "p_name", "p_type", "p_brand", F.col("p_size").alias("p_size"))
    return P.drop_matching(P.drop_repeated_names(twice), "^p_(name|type|brand)$")


@query("p04_numeric_only", "select p_partkey, p_size, p_retailprice from part", "part")
def numeric_only(part):
    return P.numeric_only(part)


@query("p05_bounding_box", "select point_id, lat, lon from station where lat between 30 and 40 and lon between -120 and -110", "station")
def bounding_box(station):
    return P.in_box(station, 30, 40, -120, -110).select("point_id", "lat", "lon")


@query("p06_date_range", "select o_orderkey, o_totalprice from orders where cast(o_orderdate as date) between date '1996-03-01' and date '1997-09-30'", "orders")
def date_range(orders):
    return P.in_dates(orders, "o_orderdate", "1996-03-01", "1997-09-30").select("o_orderkey", "o_totalprice")


@query("p07_active", "select o_orderkey from orders where o_orderdate > date '1998-01-01' and o_orderstatus = 'O'", "orders")
def active(orders):
    return P.active(orders, "o_orderdate", "1998-01-01").where("o_orderstatus = 'O'").select("o_orderkey")


@query("p08_drop_nulls", "select point_id, obs_date, v from panel where v is not null", "panel")
def drop_nulls(panel):
    return P.drop_nulls(panel, ["v"])


@query("p09_fill_and_drop_missing", "select event_id, coalesce(depth, -999e0) as depth, label from code where label is not null", "code")
def fill_and_drop(code):
    filled = P.fill_nulls(code.select("event_id", "depth", "label"), -999.0, ["depth", "label"])
    return filled.where("label != -999")


@query("p10_blank_to_null", "select event_id, nullif(s, '--') as s from strnum", "strnum")
def blank_to_null(strnum):
    return strnum.select("event_id", P.blank_to_null(F.col("s")).alias("s"))


@query("p11_to_number", "select event_id, try_cast(s as double) as x from strnum", "strnum")
def to_number(strnum):
    return strnum.select("event_id", P.to_number(F.col("s")).alias("x"))


@query("p12_unit_conversion", "select point_id, round(elevation * 3.28084e0, 6) as feet, round(elevation * 39.3701e0, 6) as inches from station", "station")
def unit_conversion(station):
    out = P.converted(station, {"feet": ("elevation", 3.28084), "inches": ("elevation", 39.3701)})
    return out.select("point_id", F.round("feet", 6).alias("feet"), F.round("inches", 6).alias("inches"))


scalar("p13_zero_or_missing", "code", ["event_id"], {"label0": (lambda: P.zero_or_missing(F.col("depth")), "case when depth = 0 then 0e0 else -999e0 end")})
scalar("p14_fill_label", "code", ["event_id"], {"label1": (lambda: P.fill_label_where_clear(F.col("label"), F.col("code")), "case when label is null and code in (0, 225, 237, 239) then 0e0 else label end")})
scalar("p15_clean_code", "code", ["event_id"], {"cover": (lambda: P.clean_code(F.col("code")), "case when code in (225, 237, 239) or code < 0 then 0 when code > 100 then null else code end")})
scalar("p16_clip", "panel", DAY, {"clipped": (lambda: P.clip(F.col("v"), 20.0, 240.0), "case when v is not null then greatest(20e0, least(240e0, v)) end")})
scalar("p17_mask", "code", ["event_id"], {"masked": (lambda: P.mask_prediction(F.col("depth"), F.col("code"), F.col("label"), F.col("lc")), "case when code in (0, 225, 237, 239) or label is null or lc in (3, 27, 255) then 0e0 else depth end")})


@query("p18_quality_flags", "select event_id, 'best' as kind from code where qa = 0 and code <= 100 union all select event_id, 'ok' from code where qa < 3 and code <= 100", "code")
def quality_flags(code):
    best, ok = P.good_quality(code, "qa", "code"), P.good_quality(code, "qa", "code", best=False)
    return best.select("event_id", F.lit("best").alias("kind")).unionByName(ok.select("event_id", F.lit("ok").alias("kind")))


@query("p19_replace_column", "select cell_id, z / 2 as z from grid", "grid")
def replace_column(grid):
    return P.replace_by(grid.withColumn("z_fixed", F.col("z") / 2), "z", "z_fixed").select("cell_id", "z")
