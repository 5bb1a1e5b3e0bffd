"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Each source gets a target number of words: weights share the whole, a target stops at ``most``
times its source's size, and the excess is shared again by weight. A document's expected copies
are its source's target over its size. Within a source the expected copies are added up along an
order of documents, one random offset is added, and a document is taken once for each integer
boundary that its share crosses. The order puts documents of like size together, so the words
taken come near the target although sizes differ widely.

The prefix sum needs no task that holds a source: documents fall into cells (source, leading bits
of the size, hash of the id), the cells' counts are added up over the small table of cells, and
ranks are taken within cells only. A source with a third of all rows is spread over hundreds of
cells.

Defined cases: a null text has size 0; a null source is a source of its own, after all others; a
null id is ordered as an empty one; rows that repeat an id are separate documents; a source
without words gets target 0 and no copies; an empty table gives an empty result; other columns
are kept by ``mix`` whatever their names, and ignored by ``report``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nivalis.llm.common import documents, materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2, "mix"
ID_CELLS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    """The columns that place a document: src, cell, size, mark; and ``more``."""
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select(
        F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source").cast("string"))).alias("src"),
        word_count(F.col("text")).alias("size"),
        mark.alias("mark"),
        *more,
    )
    bits = F.length(F.bin("size"))
    lead = F.expr("shiftright(size, greatest(length(bin(size)) - 4, 0))")
    slot = F.pmod(F.conv(F.substring("mark", 1, 2), 16, 10).cast("int"), F.lit(ID_CELLS))
    return rows.withColumn("cell", ((bits * 16 + lead) * ID_CELLS + slot).cast("int"))


def _cells(sized: DataFrame) -> DataFrame:
    return sized.groupBy("src", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))


def targets(cells: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """src, source_size and target of each source: the weights' shares, filled up to ``most`` times the size.

    The sources that reach their limit are those with the smallest limit per weight, and the
    level (words per weight) is highest just after the last of them.
    """
    sources = cells.groupBy("src").agg(F.sum("words").alias("source_size"))
    by_name = Window.orderBy(F.col("src") == "n", "src")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1)
    all_rows = Window.partitionBy(F.lit(1))
    s = sources.select("src", "source_size", weight.alias("weight"), (F.sum("source_size").over(all_rows) * F.lit(float(share))).alias("whole"))
    s = s.withColumn("limit", F.col("source_size") * F.lit(float(most)))
    by_limit = Window.partitionBy(F.lit(1)).orderBy(F.col("limit") / F.col("weight"), "src")
    before = F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", (F.col("whole") - before) / after)
    level = F.max("level").over(all_rows)
    return s.select("src", "source_size", F.least(F.col("limit"), level * F.col("weight")).alias("target"))


def _with_copies(sized: DataFrame, cells: DataFrame, seed: str, ties: Sequence[Column] = ()) -> DataFrame:
    """sized with source_size, target and copies."""
    run = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("src"))), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    plan = cells.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0))).join(targets(cells), "src")
    plan = plan.select(
        "src", "cell", "source_size", "target", "before", offset.alias("offset"),
        F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0)).alias("each"),
    )
    place = F.row_number().over(Window.partitionBy("src", "cell").orderBy("size", "mark", *ties))
    rows = sized.withColumn("place", place).join(plan, ["src", "cell"]).withColumn("rank", F.col("before") + F.col("place"))
    crossed = lambda r: F.floor(F.col("each") * r + F.col("offset"))
    return rows.withColumn("copies", crossed(F.col("rank")) - crossed(F.col("rank") - 1))


def report(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken (words taken, repeats counted) and copies of each document."""
    sized = materialise(_sized(docs, F.col("doc_id")))
    rows = _with_copies(sized, _cells(sized), seed)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """docs with each row as often as it is taken, all columns kept."""
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row")
    cells = materialise(_cells(_sized(docs)))
    sized = _sized(docs, row, F.xxhash64("text").alias("tie"))
    rows = _with_copies(sized, cells, seed, ["tie"]).where("copies > 0")
    rows = rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
    return rows.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(documents(spark, sf_dir))


OP8_SQL = r"""
with d as (
  select doc_id, case when source is null then 'n' else 's' || source end as src,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         md5(coalesce(cast(doc_id as varchar), '')) as mark
  from documents),
c as (
  select *, (length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0))) * 64
            + cast('0x' || substr(mark, 1, 2) as bigint) % 64 as cell
  from d),
s0 as (
  select src, cast(sum(size) as bigint) as source_size,
         [3, 1, 2][cast((row_number() over (order by src = 'n', src) - 1) % 3 as int) + 1] as weight
  from d group by src),
s1 as (
  select *, 1.5e0 * sum(source_size) over () as whole, 2e0 * source_size as cap from s0),
s2 as (
  select *, (whole - coalesce(sum(cap) over (order by cap / weight, src rows between unbounded preceding and 1 preceding), 0e0))
            / sum(weight) over (order by cap / weight, src rows between current row and unbounded following) as level
  from s1),
s3 as (select src, source_size, least(cap, max(level) over () * weight) as target from s2),
r as (
  select c.doc_id, c.size, s3.source_size, s3.target,
         row_number() over (partition by c.src order by c.cell, c.size, c.mark) as rank,
         case when s3.source_size = 0 then 0e0 else s3.target / s3.source_size end as each,
         cast('0x' || substr(md5('mix' || c.src), 1, 8) as bigint) / 4294967296e0 as shift
  from c join s3 using (src))
select doc_id, size, source_size, target,
       cast(size * (floor(each * rank + shift) - floor(each * (rank - 1) + shift)) as bigint) as taken,
       cast(floor(each * rank + shift) - floor(each * (rank - 1) + shift) as bigint) as copies
from r
"""
