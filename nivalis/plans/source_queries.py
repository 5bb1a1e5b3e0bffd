"""Queries for sources, sinks, samples and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from nivalis.operators import models as M
from nivalis.operators import random_trees as X
from nivalis.operators import sampling as S
from nivalis.operators import timeseries as W
from nivalis.plans.fixtures import view
from nivalis.plans.registry import query, with_folder
from nivalis.sources import grids as G
from nivalis.sources import readers as R
from nivalis.sources import writers as K


@with_folder("s01_typed_csv", "select point_id, station_name, elevation from station", "station")
def s01(spark, sf_dir, folder):
    view(spark, sf_dir, "station").select("point_id", "station_name", "elevation").write.option("header", True).csv(folder)
    return R.typed_csv(spark, folder, "point_id long, station_name string, elevation double")


@with_folder("s02_split_scan", "select l_returnflag, count(*) as n, round(sum(l_extendedprice), 1) as total from lineitem group by 1")
def s02(spark, sf_dir, folder):
    """The scan is cut into blocks of 10 MB for this query."""
    blocks = R.in_blocks(spark, f"{sf_dir}/lineitem.parquet", 10 << 20)
    return blocks.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 1).alias("total"))


@query("s03_pruned_scan", "select l_orderkey as point, l_quantity as depth from lineitem", "lineitem")
def s03(lineitem):
    return R.pruned(lineitem, {"l_orderkey": "point", "l_quantity": "depth"})


@with_folder("s04_dated_files", "select point_id, variable, v, obs_date as date from daily where obs_date between date '2024-01-05' and date '2024-01-20'", "daily")
def s04(spark, sf_dir, folder):
    daily = view(spark, sf_dir, "daily").select("point_id", "variable", "v", F.col("obs_date").alias("d"))
    daily.repartition("d").write.partitionBy("d").option("header", True).csv(folder)
    return R.dated_files(spark, f"{folder}/*", "point_id long, variable string, v double", "2024-01-05", "2024-01-20")


@query("s05_nested_json", "select event_id, try_cast(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) as int) as k from events", "events")
def s05(events):
    return R.flattened(events.select("event_id", "props"), "props", "k int").drop("props")


_DRIFT = {"k": (["$.k", "$.reading.k"], "int"), "unit": (["$.reading.unit"], "string")}


@query("s05_drifting_records", "select event_id, try_cast(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) as int) as k, case when event_id % 3 = 1 then 'm' end as unit from events where event_id % 3 < 2 union all select event_id, null, null from events where event_id % 3 = 2", "events")
def s05_drifting(events):
    """Records of three kinds in one scan: as they are, with the field one level down beside a unit, and texts that are no JSON."""
    moved = F.concat(F.lit('{"reading": '), F.regexp_replace("props", r"\}\s*$", ', "unit": "m"}'), F.lit("}"))
    kind = F.col("event_id") % 3
    texts = events.select("event_id", F.when(kind == 0, F.col("props")).when(kind == 1, moved).otherwise(F.lit("{broken")).alias("props"))
    return R.drifting(texts, "props", _DRIFT)


@with_folder(
    "s04_dated_grids",
    "select d.obs_date as day, s.lat10 - 250 as y, s.lon10 + 1250 as x, round(sum(d.v), 4) as z from daily d join station s using (point_id) where d.obs_date between date '2024-01-05' and date '2024-01-20' group by 1, 2, 3",
    "daily", "station",
)
def s04_grids(spark, sf_dir, folder):
    """Every day's observations are written as a grid in binary files, of which those of two weeks are read again."""
    daily, station = view(spark, sf_dir, "daily"), view(spark, sf_dir, "station")
    placed = daily.join(station.select("point_id", (F.col("lat10") - 250).alias("y"), (F.col("lon10") + 1250).alias("x")), "point_id")
    grids = placed.groupBy(F.col("obs_date").alias("day"), "y", "x").agg(F.sum("v").alias("z"))
    G.write_grids(grids, folder, "v", 25.0, -125.0, -0.1)
    return G.read_grids(spark, folder, "2024-01-05", "2024-01-20").select("day", "y", "x", F.round("z", 4).alias("z"))


@query("s06_centroids", "select cell_id, cast(lat10 as double) as lat, cast(lon10 as double) as lon from grid", "grid")
def s06(grid):
    corner = lambda dx, dy: F.struct((F.col("lon10") + dx).cast("double").alias("x"), (F.col("lat10") + dy).cast("double").alias("y"))
    ring = F.array(corner(-2, -3), corner(2, -3), corner(2, 3), corner(-2, 3), corner(-2, -3))
    return R.centroids(grid.select("cell_id", ring.alias("ring")), "cell_id", "ring")


@query("s07_report_lines", "select doc_id, cast(i as int) as line_no, l[i + 1] as line from (select doc_id, l, unnest(range(len(l))) as i from (select doc_id, string_split(text, chr(10)) as l from documents)) where l[i + 1] <> '' and not starts_with(l[i + 1], '#')", "documents")
def s07(documents):
    return R.report_lines(documents.select("doc_id", "text"), "text")


@query(
    "s08_inventory",
    r"select doc_id, cast(r as bigint) as record, " + ", ".join(f"t[r * 6 + {i + 1}] as f{i}" for i in range(6)) + r" from (select doc_id, t, unnest(range(len(t) // 6)) as r from (select doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as t from documents))",
    "documents",
)
def s08(documents):
    return R.inventory(documents.select("doc_id", "text"), "doc_id", "text")


@query("s09_links", "select page_id, link from (select page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) as link from pages) where regexp_matches(link, '^/[a-z]') and link not in ('/the', '/of')", "pages")
def s09(pages):
    return R.links(pages.select("page_id", "html"), include="^/[a-z]", exclude=["/the", "/of"])


@query("s09_latest_date", "select max(obs_date) as latest from daily", "daily")
def s09_latest(daily):
    return R.latest_date(daily.select(F.format_string("map_%s_v2.tif", F.col("obs_date").cast("string")).alias("name")), "name")


_MAPPED = "m as (select point_id, cast(point_id % 8 as int) as y, cast(floor(point_id / 8) % 8 as int) as x from station) "


def mapped(station):
    return station.select("point_id", (F.col("point_id") % 8).cast("int").alias("y"), (F.floor(F.col("point_id") / 8) % 8).cast("int").alias("x"))


@query("s11_cube_day", "with " + _MAPPED + "select m.point_id, c.value from m join cube c using (y, x) where c.day_idx = 100", "station", "cube")
def s11(station, cube):
    return R.cube_at(cube, mapped(station), 100).select("point_id", "value")


@query("s12_cube_all_days", "select s_suppkey as point_id, c.day_idx, c.value from supplier join cube c on c.y = s_suppkey % 8 and c.x = cast(floor(s_suppkey / 8) % 8 as int)", "supplier", "cube")
def s12(supplier, cube):
    """Every day's value for a list of stations, as rows."""
    return R.cube_at(cube.drop("tile"), mapped(supplier.withColumnRenamed("s_suppkey", "point_id"))).select("point_id", "day_idx", "value")


@query("s13_sampled_scan", None, "lineitem")
def s13(lineitem):
    return S.sampled(lineitem, 0.1).select("l_orderkey", "l_linenumber", "l_quantity")


@query("s13_sampled_by_key", "select l_orderkey, l_linenumber, l_quantity from lineitem where cast('0x' || substr(md5(cast(l_orderkey as varchar)), 1, 7) as bigint) % 10 = 0", "lineitem")
def s13_by_key(lineitem):
    return S.sampled_by_key(lineitem, "l_orderkey", 10).select("l_orderkey", "l_linenumber", "l_quantity")


@query("s14_daily_requests", "select cast(day as date) as day, 'get/' || cast(cast(day as date) as varchar) || '.nc' as request from (select unnest(generate_series(min(obs_date), max(obs_date), interval 1 day)) as day from daily)", "daily")
def s14(daily):
    return R.requests_for(W.calendar(daily, "obs_date").withColumnRenamed("obs_date", "day"), "get/%s.nc")


@query("s15_text_payloads", "select page_id from pages where length(html) > 0 and strpos(html, chr(0)) = 0", "pages")
def s15(pages):
    return pages.where(R.is_text(F.col("html").cast("binary"), None)).select("page_id")


# ---- sinks


@with_folder("k01_one_file", "select point_id, obs_date, v from season", "season")
def k01(spark, sf_dir, folder):
    K.write_table(view(spark, sf_dir, "season").drop("water_year"), folder, one_file=True)
    return spark.read.parquet(folder)


@with_folder("k02_skip_if_there", "select point_id, obs_date, v from season", "season")
def k02(spark, sf_dir, folder):
    season = view(spark, sf_dir, "season").drop("water_year")
    K.write_table(season.withColumn("v", F.lit(0.0)), folder)
    K.write_table(season, folder, force=True)
    K.write_table(season.withColumn("v", F.lit(1.0)), folder, force=False)
    return spark.read.parquet(folder)


@with_folder("k03_append_days", "select point_id, variable, v, obs_date from daily", "daily")
def k03(spark, sf_dir, folder):
    daily = view(spark, sf_dir, "daily").drop("n")
    for part in (daily.where("obs_date < date'2024-01-15'"), daily.where("obs_date >= date'2024-01-15'")):
        K.append_days(part, folder)
    return spark.read.parquet(folder)


@query("k06_published_dates", "select distinct cast(obs_date as varchar) as day from daily", "daily")
def k06(daily):
    return K.published_dates(daily.select(F.format_string("swe_%s.tif", F.col("obs_date").cast("string")).alias("name")), "name")


@with_folder("k07_versioned", "select point_id, obs_date, v from panel", "panel")
def k07(spark, sf_dir, folder):
    """Two runs are published; the latest is read through the pointer."""
    panel = view(spark, sf_dir, "panel")
    K.write_versioned(panel.withColumn("v", F.lit(0.0)), folder, "a1b2c")
    K.write_versioned(panel, folder, "d3e4f")
    return K.read_latest(spark, folder)


# ---- samples and models

FEATURES = ["l_quantity", "l_discount", "l_tax"]
_SPLIT = "select l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice, l_orderkey % 5 = 0 as is_test from lineitem"


def split(lineitem):
    rows = lineitem.select("l_orderkey", "l_linenumber", *FEATURES, F.col("l_extendedprice").alias("label"))
    return S.split_by_key(rows, F.col("l_orderkey"))


def parts(lineitem):
    rows = split(lineitem)
    return rows.where("not is_test"), rows.where("is_test")


def predicted(df):
    return df.select("l_orderkey", "l_linenumber", F.col("label"), F.round("prediction", 4).alias("prediction"))


@query("m01_split", _SPLIT.replace("l_extendedprice", "l_extendedprice as label", 1), "lineitem")
def m01(lineitem):
    return split(lineitem)


@query("m02_prepare", "select event_id, point_id, code, lc, qa, coalesce(depth, -999e0) as depth, label from code where label is not null", "code")
def m02(code):
    return M.prepare(code, "label")


@query(
    "m02_prepare_features",
    "select cast(floor(((month(obs_date) + 9) % 12) / 3) as int) + 1 as season, coalesce(depth, -999e0) as depth, coalesce(try_cast(s as double), -999e0) as s, lc, label from code join strnum using (event_id) where label is not null",
    "code", "strnum",
)
def m02_features(code, strnum):
    """The season, texts with '--' as numbers, and the features in a declared order."""
    return M.prepare(code.join(strnum, "event_id"), "label", day="obs_date", features=["season", "depth", "s", "lc"])


@query("m03_scaled", "select l_orderkey, l_linenumber, " + ", ".join(f"round((l_{c} - avg(l_{c}) over ()) / stddev_pop(l_{c}) over (), 6) as l_{c}_scaled" for c in ("quantity", "tax")) + " from lineitem", "lineitem")
def m03(lineitem):
    out = M.population_scaled(lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"), ["l_quantity", "l_tax"])
    return out.select("l_orderkey", "l_linenumber", F.round("l_quantity_scaled", 6).alias("l_quantity_scaled"), F.round("l_tax_scaled", 6).alias("l_tax_scaled"))


@query("m04_forest", None, "lineitem")
def m04(lineitem):
    train, test = parts(lineitem)
    return predicted(M.fit(train, FEATURES, M.forest("label")).transform(test))


@query("m05_extra_trees", None, "lineitem")
def m05(lineitem):
    train, test = parts(lineitem)
    return predicted(M.extra_trees(train, FEATURES, "label").predict(test))


@query(
    "m05_one_tree",
    "with t as (select *, case when l_quantity <= 17.5 then (case when l_discount <= 0.045 then 2 else 3 end) else (case when l_tax <= 0.035 then 5 else 6 end) end as leaf from lineitem) "
    "select leaf, count(*) as n, round(avg(l_extendedprice), 4) as value from t group by 1",
    "lineitem",
)
def m05_tree(lineitem):
    """The rows of each leaf of a given tree."""
    tree = X.Tree()
    for depth, features, thresholds in ((0, 0, 17.5), (1, 1, 0.045), (2, -1, 0.0), (2, -1, 0.0), (1, 2, 0.035), (2, -1, 0.0), (2, -1, 0.0)):
        node = tree.add(0.0, depth)
        tree.feature[node], tree.threshold[node] = features, thresholds
    tree.left, tree.right = [1, 2, -1, -1, 5, -1, -1], [4, 3, -1, -1, 6, -1, -1]
    tree.value = [float(i) for i in range(7)]
    leaves = X.Forest(FEATURES, [tree]).predict(lineitem, "leaf")
    return leaves.groupBy(F.col("leaf").cast("int").alias("leaf")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("l_extendedprice"), 4).alias("value"))


@query("m06_balanced_weights", "with e as (select l_orderkey, l_linenumber, abs(l_quantity - 25) as err from lineitem), c as (select err, count(*) as n from e group by 1) select l_orderkey, l_linenumber, round((select count(*) from e) / ((select count(*) from c) * c.n), 8) as weight from e join c using (err)", "lineitem")
def m06(lineitem):
    rows = lineitem.select("l_orderkey", "l_linenumber", F.abs(F.col("l_quantity") - 25).alias("err"))
    return M.balanced_weights(rows, F.col("err")).select("l_orderkey", "l_linenumber", F.round("weight", 8).alias("weight"))


@query("m06_fit_twice", None, "lineitem")
def m06_twice(lineitem):
    train, test = parts(lineitem)
    return predicted(M.fit_twice(train, FEATURES, "label", lambda label, **more: M.forest(label, 5, 5, **more)).transform(test))


@query("m07_metrics", "with e as (select l_extendedprice as y, l_extendedprice - l_quantity * 1500 as e from lineitem) select round(avg(abs(e)), 4) as mae, round(avg(e * e) / 1e6, 4) as mse, round(sqrt(avg(e * e)), 4) as rmse, round(1 - avg(e * e) / var_pop(y), 6) as r2 from e", "lineitem")
def m07(lineitem):
    out = M.metrics(lineitem.select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction")))
    return out.select(F.round("mae", 4).alias("mae"), F.round(F.col("mse") / 1e6, 4).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@query("m08_predict_grid", None, "grid", "code")
def m08(grid, code):
    """A forest learns from four fifths of the cells and predicts every cell; the cells' own codes mask the predictions."""
    from nivalis.operators import clean as P
    from nivalis.operators import joins as J

    table = grid.select("cell_id", "y", "x", F.col("z").alias("label"))
    train = S.split_by_key(table, F.col("cell_id")).where("not is_test").drop("is_test")
    found = M.fit(train, ["y", "x"], M.forest("label", 10, 6)).transform(table).select("cell_id", "prediction")
    depths = code.groupBy(F.col("lc").alias("y")).agg(F.max("depth").alias("depth"))
    codes = grid.select("cell_id", "y", "code").join(depths, "y", "left").withColumn("lc", F.col("y")).drop("y")
    out = J.attach(table.join(codes, "cell_id", "left"), found, ["cell_id"])
    return out.select("cell_id", P.mask_prediction(F.col("prediction"), F.col("code"), F.col("depth"), F.col("lc")).alias("prediction"))


@query(
    "daily_prediction_raster",
    "with t as (select point_id, elevation, round(sum(v), 2) as label from station join season using (point_id) where lat between 25 and 49 group by 1, 2), "
    "m as (select regr_slope(label, elevation) as s, regr_intercept(label, elevation) as i from t), "
    "d as (select lc, max(depth) as depth from code group by 1), "
    "p as (select y, x, case when g.code in (0, 225, 237, 239) or d.depth is null or d.lc in (3, 27, 255) then 0e0 else round((m.i + m.s * g.z) / 1e6, 6) end as v from grid g cross join m left join d on d.lc = g.y) "
    "select r.y, list(p.v order by c.x) as row from (select distinct y from p) r cross join (select unnest(range((select max(x) + 1 from p))) as x) c left join p on p.y = r.y and p.x = c.x group by r.y",
    "station", "season", "grid", "code",
)
def daily_prediction_raster(station, season, grid, code):
    """The daily job: station totals train a model, every cell of the grid is predicted and masked, and rows of the raster come out."""
    from nivalis.operators import clean as P
    from nivalis.operators import raster as G

    totals = P.in_box(station, 25, 49, -180, 180).select("point_id", "elevation").join(season, "point_id").groupBy("point_id", "elevation").agg(F.round(F.sum("v"), 2).alias("label"))
    cells = grid.select("cell_id", "y", "x", "code", F.col("z").alias("elevation"))
    found = M.fit(totals, ["elevation"], M.linear("label")).transform(cells).select("cell_id", "prediction")
    depths = code.groupBy("lc").agg(F.max("depth").alias("depth"))
    full = cells.join(found, "cell_id").join(depths, cells["y"] == depths["lc"], "left")
    masked = P.mask_prediction(F.round(F.col("prediction") / 1e6, 6), F.col("code"), F.col("depth"), F.coalesce("lc", F.lit(-1)))
    return G.dense_rows(full.select("y", "x", masked.alias("v")), "v")


@query("m09_importances", None, "lineitem")
def m09(lineitem):
    train, _ = parts(lineitem)
    return M.importances(M.fit(train, FEATURES, M.forest("label", 10, 6)), FEATURES, lineitem.sparkSession)


@query("m10_line", "select round(regr_slope(l_extendedprice, l_quantity), 4) as slope, round(regr_intercept(l_extendedprice, l_quantity), 2) as intercept from lineitem", "lineitem")
def m10(lineitem):
    model = M.fit(lineitem.withColumnRenamed("l_extendedprice", "label"), ["l_quantity"], M.linear("label")).stages[-1]
    ends = lineitem.sparkSession.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double")
    return ends.select(F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


@query("m11_compare", None, "lineitem")
def m11(lineitem):
    train, test = parts(lineitem)
    return M.compare(train, test, "label", {"quantity": ["l_quantity"], "rates": ["l_discount", "l_tax"], "all": FEATURES})


_ERRORS = "round(avg(abs(e)), 4) as mae, round(avg(e * e), 4) as mse, round(sqrt(avg(e * e)), 4) as rmse, round(1 - avg(e * e) / nullif(var_pop(label), 0), 6) as r2"


@query(
    "m11_compare_quality",
    "with s as (select k.name as rows_used, c.* from code c join (values ('best', 0), ('usable', 2), ('any', 3)) k(name, most) on c.qa <= k.most where label is not null and depth is not null), "
    "m as (select rows_used, regr_slope(label, depth) as a, regr_intercept(label, depth) as b from s where event_id % 5 <> 1 group by 1) "
    f"select rows_used, {_ERRORS} from (select rows_used, label, label - (b + a * depth) as e from s join m using (rows_used) where event_id % 5 = 1) group by 1",
    "code",
)
def m11_quality(code):
    """One model over the rows of three grades of quality."""
    rows = S.split_by_key(code.where("label is not null and depth is not null"), F.col("event_id"), test=1)
    grades = {"best": F.col("qa") == 0, "usable": F.col("qa") < 3, "any": F.lit(True)}
    out = M.compare_rows(rows.where("not is_test"), rows.where("is_test"), "label", ["depth"], grades)
    return out.withColumns({"mae": F.round("mae", 4), "mse": F.round("mse", 4), "rmse": F.round("rmse", 4), "r2": F.round("r2", 6)})


@query("m12_melted", "select point_id, obs_date, 'a' as model, v as predicted from panel union all select point_id, obs_date, 'b', v * 2 from panel", "panel")
def m12(panel):
    return M.melted(panel.select("point_id", "obs_date", F.col("v").alias("a"), (F.col("v") * 2).alias("b")), ["point_id", "obs_date"], ["a", "b"])


@query("m13_cover_model", None, "code")
def m13(code):
    rows = code.select("code", "lc", "qa", F.col("label")).na.drop()
    train, test = S.random_split(rows)
    return M.metrics(M.fit(train, ["code", "lc", "qa"], M.forest("label", 10, 5)).transform(test))


@query("m13_cover_importances", None, "code")
def m13_importances(code):
    """What the cover model goes by, most important first."""
    rows = code.select("code", "lc", "qa", F.col("label")).na.drop()
    return M.importances(M.fit(rows, ["code", "lc", "qa"], M.forest("label", 10, 5)), ["code", "lc", "qa"], code.sparkSession)


@query("m14_label_encoded", "select c_custkey, c_mktsegment, cast(dense_rank() over (order by c_mktsegment) - 1 as int) as c_mktsegment_code from customer", "customer")
def m14(customer):
    return M.label_encoded(customer.select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query("m15_search", None, "lineitem")
def m15(lineitem):
    train, test = parts(lineitem)
    return M.metrics(M.search(train, FEATURES, "label", [3, 6], [2, 4]).transform(test))


@query("m16_negatives", "with p as (select event_id, depth as swe from code where depth > 50), n as (select event_id, row_number() over (order by event_id) as r from code where code <= 20 and not coalesce(depth > 50, false)) select event_id, swe from p union all select event_id, 0e0 from n where r <= (select count(*) from p)", "code")
def m16(code):
    rows = code.select("event_id", "code", F.col("depth").alias("swe"))
    return S.balanced_negatives(rows, F.col("swe") > 50, F.col("code") <= 20, "swe", [F.col("event_id")]).select("event_id", "swe")


@query("m17_random_land", None, "grid")
def m17(grid):
    ends = grid.agg(F.max("y"), F.max("x")).first()
    return S.random_land_points(grid, 200, 25.0, -125.0, 0.6, ends[0] + 1, ends[1] + 1)


@query("m18_random_above", "select point_id, elevation from station where elevation > 1000 order by md5(cast(point_id as varchar)), point_id limit 50", "station")
def m18(station):
    return S.random_above(station, "elevation", 1000.0, 50, "point_id").select("point_id", "elevation")


@with_folder("m19_saved_model")
def m19(spark, sf_dir, folder):
    train, test = parts(view(spark, sf_dir, "lineitem"))
    M.save_versioned(M.fit(train, FEATURES, M.linear("label"), scale=True), spark, folder, "a1b2c")
    return predicted(M.load_latest(spark, folder).transform(test))


@query("o04_ranked", "select name as feature, corr as importance, cast(row_number() over (order by corr desc, name) as int) as rank from (select 'l_quantity' as name, round(corr(l_quantity, l_extendedprice), 6) as corr from lineitem union all select 'l_tax', round(corr(l_tax, l_extendedprice), 6) from lineitem union all select 'l_discount', round(corr(l_discount, l_extendedprice), 6) from lineitem)", "lineitem")
def o04_by_correlation(lineitem):
    """Features ranked by their correlation with the label."""
    from nivalis.operators import aggregates as A

    return M.ranked(A.correlations(lineitem, "l_extendedprice", FEATURES).select(F.col("name").alias("feature"), F.round("corr", 6).alias("importance")))


@query("o04_ranked_importances", None, "lineitem")
def o04(lineitem):
    train, _ = parts(lineitem)
    return M.shares(FEATURES, M.extra_trees(train, FEATURES, "label", 5, 5).importances(), lineitem.sparkSession)


@query("f18_run_id", None, "region")
def f18(region):
    """Rows with a run id of their own making; a caller's id is used where runs must be repeatable."""
    return region.select("r_regionkey", F.substring(F.md5(F.expr("uuid()")), 1, 5).alias("run_id"))
