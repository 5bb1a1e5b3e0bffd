import datetime as dt
import functools

import pytest

from nivalis.streaming import incremental as T
from nivalis.streaming import seasons as S

DDL = "p string, d date, v double, o long"


class Runs:
    def __init__(self, spark, folder, order="o", late="60 days"):
        self.spark, self.own, self.folder, self.order, self.late, self.batches = spark, S.state_session(spark), folder, order, late, 0

    def arrive(self, *rows):
        """The rows that the run writes, and how many entries its state has then."""
        self.spark.createDataFrame([(p, d and dt.date.fromisoformat(d), v, o) for p, d, v, o in rows], DDL).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        before = self.written()
        stream = T.read_stream(self.own, f"{self.folder}/in", DDL)
        query = S.run_changes(S.changed_totals(stream, "d", "p", "v", self.order, self.late), f"{self.folder}/out", f"{self.folder}/check")
        new = [r for r in self.written() if r not in before]
        return sorted((r.p, r.water_year, r.n, r.total, str(r.last_day)) for r in new), query.lastProgress["stateOperators"][0]["customMetrics"]

    def written(self):
        try:
            return self.spark.read.schema("p string, water_year int, n long, total double, last_day date, batch int").parquet(f"{self.folder}/out").collect()
        except Exception:
            return []

    def current(self):
        return sorted((r.p, r.water_year, r.n, r.total) for r in S.current_totals(self.spark, f"{self.folder}/out", "p").collect())


def test_late_days_corrections_and_unchanged_rows(spark, tmp_path):
    runs = Runs(spark, f"file://{tmp_path}")
    new, _ = runs.arrive(("a", "2023-12-01", 1.0, 1), ("a", "2023-12-03", 4.0, 1), ("b", "2023-12-01", 2.0, 1), (None, "2023-12-01", 9.0, 1), ("a", None, 9.0, 1))
    assert new == [("a", 2024, 2, 5.0, "2023-12-03"), ("b", 2024, 1, 2.0, "2023-12-01")]
    # a day between, a correction, and b's day again as it was
    new, _ = runs.arrive(("a", "2023-12-02", 2.0, 2), ("a", "2023-12-03", 5.0, 2), ("b", "2023-12-01", 2.0, 2))
    assert new == [("a", 2024, 3, 8.0, "2023-12-03")]
    # older than what stands; two at once; a value taken out
    new, _ = runs.arrive(("a", "2023-12-03", 100.0, 1), ("b", "2023-12-01", 7.0, 4), ("b", "2023-12-01", 8.0, 3), ("a", "2023-12-01", None, 3))
    assert new == [("a", 2024, 2, 7.0, "2023-12-03"), ("b", 2024, 1, 7.0, "2023-12-01")]
    assert runs.current() == [("a", 2024, 2, 7.0), ("b", 2024, 1, 7.0)]


def test_state_goes_when_its_season_is_over(spark, tmp_path):
    runs = Runs(spark, f"file://{tmp_path}", order=None, late="10 days")
    runs.arrive(("a", "2023-09-25", 1.0, 0), ("b", "2023-09-26", 2.0, 0))
    new, _ = runs.arrive(("a", "2023-10-05", 3.0, 0), ("a", "2023-09-25", 1.5, 0))
    assert new == [("a", 2023, 1, 1.5, "2023-09-25"), ("a", 2024, 1, 3.0, "2023-10-05")]
    # the watermark passes 1 October: both seasons' states go; b's row of September comes too late
    runs.arrive(("a", "2023-12-01", 3.0, 0))
    new, metrics = runs.arrive(("b", "2023-09-26", 50.0, 0), ("a", "2023-12-02", 1.0, 0))
    assert new == [("a", 2024, 3, 7.0, "2023-12-02")]
    assert runs.current() == [("a", 2023, 1, 1.5), ("a", 2024, 3, 7.0), ("b", 2023, 1, 2.0)]
    state = spark.read.format("statestore").option("stateVarName", "days").load(f"file://{tmp_path}/check")
    assert [(r.key.p, r.key.water_year) for r in state.collect()] == [("a", 2024)]


def test_values_alike_in_order(spark, tmp_path):
    runs = Runs(spark, f"file://{tmp_path}", order=None)
    new, _ = runs.arrive(("a", "2023-12-01", 1.0, 0), ("a", "2023-12-01", 3.0, 0), ("a", "2023-12-01", None, 0))
    assert new == [("a", 2024, 1, 3.0, "2023-12-01")]
    new, _ = runs.arrive(("a", "2023-12-01", 2.0, 0))
    assert new == [("a", 2024, 1, 2.0, "2023-12-01")]


@pytest.mark.parametrize("kind", ["int", "string"])
def test_keys_keep_their_type(spark, tmp_path, kind):
    spark.sql(f"select cast(7 as {kind}) as p, date'2024-01-01' as d, 1.0D as v").write.parquet(f"file://{tmp_path}/in")
    own = S.state_session(spark)
    stream = T.read_stream(own, f"file://{tmp_path}/in", f"p {kind}, d date, v double")
    S.run_changes(S.changed_totals(stream, "d", "p", "v"), f"file://{tmp_path}/out", f"file://{tmp_path}/check")
    assert dict(S.current_totals(spark, f"file://{tmp_path}/out", "p").dtypes)["p"] == kind


class BlockRuns(Runs):
    def __init__(self, spark, folder, blocks, **how):
        super().__init__(spark, folder, **how)
        self.blocks = blocks

    def arrive(self, *rows):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(S, "changed_totals", functools.partial(S.changed_totals, blocks=self.blocks))
            return super().arrive(*rows)


def test_points_of_a_block_share_an_entry(spark, tmp_path):
    """With an entry for each point and season, time went to the calls for each."""
    ids = range(60)
    first = [(f"p{i}", "2023-12-01", float(i), 1) for i in ids]
    # of the second run: a later day, a correction, a value as it was, an older row, and a point of its own; then no value
    second = [("p0", "2023-12-02", 5.0, 2), ("p1", "2023-12-01", 7.0, 2), ("p2", "2023-12-01", 2.0, 3), ("p3", "2023-12-01", 9.0, 0), ("new", "2023-12-05", 1.0, 2)]
    third = [("p0", "2023-12-01", None, 4), ("p4", "2022-12-01", 1.0, 4), ("p2", "2023-12-01", 8.0, 2), (None, "2023-12-01", 8.0, 2)]
    runs, alone = (BlockRuns(spark, f"file://{tmp_path}/{blocks}", blocks, late="500 days") for blocks in (4, None))
    for rows in (first, second, third):
        (new, metrics), (want, _) = runs.arrive(*rows), alone.arrive(*rows)
        assert new == want and want
    assert new == [("p0", 2024, 1, 5.0, "2023-12-02"), ("p4", 2023, 1, 1.0, "2022-12-01")]
    assert runs.current() == alone.current() and len(alone.current()) == 62
    assert metrics["numRegisteredTimers"] == 1
    entries = {path: spark.read.format("statestore").option("stateVarName", "days").load(f"file://{tmp_path}/{path}/check").count() for path in (4, None)}
    assert entries == {4: 5, None: 62}


def test_a_block_goes_when_its_season_is_over(spark, tmp_path):
    runs = BlockRuns(spark, f"file://{tmp_path}", 1, order=None, late="10 days")
    runs.arrive(("a", "2023-09-25", 1.0, 0), ("b", "2023-09-26", 2.0, 0))
    runs.arrive(("a", "2023-12-01", 3.0, 0))
    new, _ = runs.arrive(("b", "2023-09-26", 50.0, 0), ("b", "2023-12-02", 1.0, 0))
    assert new == [("b", 2024, 1, 1.0, "2023-12-02")]
    assert runs.current() == [("a", 2023, 1, 1.0), ("a", 2024, 1, 3.0), ("b", 2023, 1, 2.0), ("b", 2024, 1, 1.0)]
    state = spark.read.format("statestore").option("stateVarName", "days").load(f"file://{tmp_path}/check")
    assert [(r.key.water_year, r.value.points) for r in state.collect()] == [(2024, ["a", "b"])]


def test_points_that_are_not_numbers(spark, tmp_path):
    """NaN is one point, in a block as in Spark's groups."""
    rows = "select double('nan') as p, date'2024-01-01' as d, 1.0D as v union all select double('nan'), date'2024-01-02', 2.0D union all select 1.0D, date'2024-01-02', 4.0D"
    own = S.state_session(spark)
    for run in (1, 2):
        spark.sql(rows if run == 1 else "select double('nan') as p, date'2024-01-03' as d, 3.0D as v").write.mode("append").parquet(f"file://{tmp_path}/in")
        stream = T.read_stream(own, f"file://{tmp_path}/in", "p double, d date, v double")
        S.run_changes(S.changed_totals(stream, "d", "p", "v", blocks=1), f"file://{tmp_path}/out", f"file://{tmp_path}/check")
    assert sorted((str(r.p), r.n, r.total) for r in S.current_totals(spark, f"file://{tmp_path}/out", "p").collect()) == [("1.0", 1, 4.0), ("nan", 3, 6.0)]
