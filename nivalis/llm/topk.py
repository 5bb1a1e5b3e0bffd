"""Exact top-k by inner product with the threshold algorithm.

Vectors are dealt into blocks. In each pair of a query block and a candidate block, every
dimension has a list of the candidates sorted by that component. A query walks all its lists
together, each from the end where its own component gains most, scores what it meets, and stops
as soon as the sum of the contributions at the current depth (a bound on everything not yet met)
is below its k-th best score. A query that has walked as many entries as its block has rows scores
the rows not met yet, which ends its search. The best of each block are then merged per query.

Each block pair costs at most one full scoring, so the work is that of the stated query set
against all rows in blocks; nothing is broadcast and no pair of vectors becomes a row unless it
is among the k best of its block.

Defined cases: a null id, and a null vector or one with a null or non-finite component, takes no
part; rows that repeat an id are candidates each, and the largest vector asks for the id, of which
no row is an answer; only vectors of equal length are compared; ties go to the smaller id; a query
with fewer than k candidates returns all; a score beyond 64 bits counts as the nearest that fits.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 16384
FIRST_DEPTH = 16
#: Entries of all lists together that are walked for each row of a block before the rows not met are scored at once.
WALKED = 1


def threshold_search(q: np.ndarray, data: np.ndarray, order: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of data with the k highest products with q (ties: smaller id), except those with id ``own``.

    ``order`` holds, for each column of data, its row numbers by rising value.
    """
    n = len(data)
    up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
    used = np.concatenate([up, down])
    seen = np.zeros(n, bool)
    rows, scores = np.empty(0, np.int64), np.empty(0, data.dtype)
    done, depth = 0, min(n, FIRST_DEPTH)
    while True:
        if not len(used) or depth * len(used) > WALKED * n:
            depth = n  # few are left that no list has shown: to score them costs less than to walk on
        if depth == n:
            new = np.flatnonzero(~seen)
        else:
            met = seen.copy()
            met[order[n - depth : n - done, up]] = True
            met[order[done:depth, down]] = True
            new, seen = np.flatnonzero(met & ~seen), met
        new = new[ids[new] != own]
        rows = np.concatenate([rows, new])
        found = data[new] @ q
        scores = np.concatenate([scores, np.clip(found, -(2**63), 2**63 - 1) if data.dtype == object else found])
        if len(rows) > k:
            kth = np.sort(scores)[len(scores) - k] if scores.dtype == object else np.partition(scores, len(scores) - k)[len(scores) - k]
            keep = scores >= kth
            rows, scores = rows[keep], scores[keep]
        if depth == n:
            break
        if len(rows) >= k:
            last = np.concatenate([order[n - depth, up], order[depth - 1, down]])
            if (data[last, used] * q[used]).sum() < scores.min():
                break
        done, depth = depth, min(n, depth * 2)
    best = np.lexsort((ids[rows], -scores))[:k]
    return rows[best], scores[best]


def _block_search(k: int):
    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(queries) and len(candidates):
            data, ids = np.stack(candidates["v"].to_list()), candidates["id"].to_numpy()
            asked = np.stack(queries["v"].to_list())
            most = data.shape[1] * float(np.abs(data.astype(float)).max(initial=0)) * float(np.abs(asked.astype(float)).max(initial=0))
            kind = np.float64 if most < 2**53 else np.int64 if most < 2**63 else object  # the fastest that is exact
            data, asked = data.astype(kind), asked.astype(kind)
            order = np.argsort(data, axis=0, kind="stable")
            for own, q in zip(queries["id"].to_numpy(), asked, strict=True):
                rows, scores = threshold_search(q, data, order, ids, own, k)
                out.append((np.full(len(rows), own), ids[rows], scores.astype(np.int64)))
        parts = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), parts, strict=True)))

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other rows for each row of ``vectors`` (id long, v array<long>) that is a query."""
    one = vectors.where("id is not null and v is not null and not exists(v, x -> x is null)")
    one = one.select("id", "v", F.size("v").alias("dims"))
    askers = one.where(is_query).groupBy("id").agg(F.max("v").alias("v")).withColumn("dims", F.size("v"))
    n, asked = one.select(F.count(F.lit(1)), F.count_if(is_query)).first()
    blocks, query_blocks = max(1, math.ceil(n / CANDIDATE_BLOCK)), max(1, math.ceil(asked / QUERY_BLOCK))
    own = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")  # rows of one id spread
    query_own = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(query_blocks)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    candidates = one.select("dims", own.alias("c"), every(query_blocks).alias("q"), "id", "v")
    queries = askers.select("dims", every(blocks).alias("c"), query_own.alias("q"), "id", "v")
    found = (
        queries.groupBy("dims", "c", "q")
        .cogroup(candidates.groupBy("dims", "c", "q"))
        .applyInPandas(_block_search(k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def quantised(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """id and v = floor(scale * x) of each vector whose components are all finite."""
    x = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    unfit = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(math.inf)))
    whole = embeddings.select(F.col("vec_id").cast("long").alias("id"), x.alias("x")).where(F.col("x").isNotNull() & ~unfit)
    return whole.select("id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, F.col("id") % 20 == 0, 20)


OP2_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 20 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""
