"""Views that let the given tables stand for station lists, grids, daily series and cubes.

The text of a view runs in Spark, where {table} names a DataFrame, and in other SQL engines, where
it names a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "embeddings")

VIEWS = {
    "station": """
        select c_custkey as point_id, c_name as station_name, c_mktsegment as network,
               cast(250 + (c_custkey*37) % 241 as int) as lat10, cast(-1250 + (c_custkey*53) % 251 as int) as lon10,
               cast(250 + (c_custkey*37) % 241 as double)/10e0 as lat,
               cast(-1250 + (c_custkey*53) % 251 as double)/10e0 as lon, c_acctbal as elevation
        from {customer}""",
    "grid": """
        select p_partkey as cell_id, cast(floor(p_partkey/50) as int) as y, cast(p_partkey % 50 as int) as x,
               cast(250+6*floor(p_partkey/50) as int) as lat10, cast(-1250+5*(p_partkey % 50) as int) as lon10,
               p_size*10e0 + p_retailprice/100e0 as z, cast((p_size*7) % 256 as int) as code
        from {part}""",
    "daily": """
        select user_id as point_id, cast(ts as date) as obs_date, event_type as variable,
               round(sum(value),2) as v, count(*) as n
        from {events} group by 1,2,3""",
    "panel": """
        select p.point_id, d.obs_date, o.v
        from (select distinct user_id as point_id from {events}) p
        cross join (select distinct cast(ts as date) as obs_date from {events}) d
        left join (select user_id as point_id, cast(ts as date) as obs_date, round(sum(value),2) as v
                   from {events} group by 1,2) o
          on o.point_id=p.point_id and o.obs_date=d.obs_date""",
    "code": """
        select event_id, user_id as point_id, cast(ts as date) as obs_date,
               cast(event_id % 256 as int) as code, cast(event_id % 41 as int) as lc, cast(event_id % 4 as int) as qa,
               case when event_id % 3 = 0 then 0e0 when event_id % 7 = 0 then null else value end as depth,
               case when event_id % 5 = 0 then null else value end as label
        from {events}""",
    "strnum": """
        select event_id, case when event_id % 10 = 0 then '--' when event_id % 10 = 1 then 'n/a'
                              else cast(event_id as string) end as s
        from {events}""",
    "season": """
        select o_custkey as point_id, cast(o_orderdate as date) as obs_date, round(sum(o_totalprice),2) as v,
               cast(year(o_orderdate) + case when month(o_orderdate) >= 10 then 1 else 0 end as int) as water_year
        from {orders} group by 1,2,4""",
}

_CUBE = """
    select vec_id as day_idx, label as tile, cast(floor(pos/8) as int) as y, cast(pos % 8 as int) as x,
           cast(v as double) as value
    from (select vec_id, label, {explode} from {embeddings})"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a table if there is no view of that name."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    text = _CUBE.replace("{explode}", "posexplode(embedding) as (pos, v)") if name == "cube" else VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def oracle(query: str, *views: str) -> str:
    """query with the views it names put before it, as SQL on the plain tables."""
    parts = []
    for name in views:
        text = _CUBE.replace("{explode}", "unnest(range(64)) as pos, unnest(embedding) as v") if name == "cube" else VIEWS[name]
        parts.append(f"{name} as ({text.format(**{t: t for t in TABLES})})")
    query = query.strip()
    if parts and query.startswith("with "):
        return f"with {', '.join(parts)}, {query[5:]}"
    return f"with {', '.join(parts)} {query}" if parts else query
