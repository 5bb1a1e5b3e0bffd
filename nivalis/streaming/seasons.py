"""Season totals kept as the state of a stream, one entry for each point and season, or for a block of points.

The state of a point's season is its days with their values (a season has 366 at most), so a day
that comes late is added and one that comes again is corrected. A run writes the totals that its
rows changed, and no others. When the watermark passes the end of a season, a timer drops its state.

Each entry takes some calls between Python and the state store in each run that touches it, and some
more when it is dropped, whatever it holds. With many points of few days a season, ``blocks`` puts
points together by the hash of their key; an entry is then read and written as a whole.

Which row stands for a day: the one with the largest ``order`` that has come so far (without such a
column, that of the latest batch), and of rows alike in that the largest value. A null value takes
the day out of the total. Rows with a null key or day are left out; rows of days more than ``late``
behind the newest day of earlier batches are too late and have no effect.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, DateType, DoubleType, IntegerType, LongType, StructField, StructType

from nivalis.functions.columns import water_year

#: The order and value of each day.
Days = dict[int, tuple[int, float | None]]
_NAN = float("nan")
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB, which timers and typed state need."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    return own


def _same(point):
    """NaN is one point."""
    return _NAN if point != point else point


class SeasonState(StatefulProcessor):
    """Rows of (point, day as a number, value, order) by season and point or block of points."""

    def __init__(self, key: StructField):
        self.key, self.out = key, Row(key.name, "water_year", "n", "total", "last_day")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = {"points": self.key.dataType, "days": IntegerType(), "vals": DoubleType(), "orders": LongType()}
        self.days = handle.getValueState("days", StructType([StructField(name, ArrayType(kind)) for name, kind in kinds.items()]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.days.get()
        seasons: dict[object, Days] = {}
        for point, day, value, order in zip(*known, strict=True) if known else ():
            seasons.setdefault(_same(point), {})[day] = order, value
        arrived: dict[object, Days] = {}
        for row in rows:
            # by place, as names may not come through: point or block, season, time, point, day, value, order
            new, day, value, order = arrived.setdefault(_same(row[3]), {}), row[4], row[5], row[6]
            value = None if value != value else value
            at = new.get(day)
            if at is None or (order, value is not None, value or 0.0) > (at[0], at[1] is not None, at[1] or 0.0):
                new[day] = order, value
        changed, touched = [], False
        for point, new in arrived.items():
            before = seasons.get(point, {})
            after = before | {d: x for d, x in new.items() if d not in before or x[0] >= before[d][0]}
            if after != before:
                touched = True
                seasons[point] = after
                # values may be alike where only the order is new
                if {d: v for d, (_, v) in after.items()} != {d: v for d, (_, v) in before.items()}:
                    changed.append(self._row(point, key[1], after))
        if touched:
            if not known:
                self.handle.registerTimer(int(datetime(key[1], 10, 1, tzinfo=UTC).timestamp() * 1000))
            entries = [(point, day, *own[day]) for point, own in seasons.items() for day in sorted(own)]
            points, days, orders, values = map(list, zip(*entries, strict=True))
            self.days.update((points, days, values, orders))
        return iter(changed)

    def _row(self, point, season: int, known: Days) -> Row:
        days = [d for d in sorted(known) if known[d][1] is not None]
        total = float(sum(known[d][1] for d in days))
        return self.out(point, season, len(days), total, date(1970, 1, 1) + timedelta(days=days[-1]) if days else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.days.clear()
        return iter(())

    def close(self) -> None:
        pass


def changed_totals(stream: DataFrame, day: str, key: str, value: str, order: str | None = None, late: str = "60 days", blocks: int | None = None) -> DataFrame:
    """key, water_year, n, total and last_day of each season that a batch changes; ``stream`` is of a ``state_session``.

    ``blocks``: so many entries for each season instead of one for each point; a checkpoint keeps the number it began with.
    """
    rows = stream.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(
        (F.pmod(F.xxhash64(key), F.lit(blocks)).alias("__block") if blocks else F.col(key)),
        water_year(F.col(day)).cast("int").alias("water_year"),
        F.col(day).cast("timestamp").alias("__time"),
        F.col(key).alias("__point"),
        F.datediff(day, F.lit("1970-01-01").cast("date")).alias("__day"),
        F.col(value).cast("double").alias("__value"),
        (F.col(order).cast("long") if order else F.lit(0).cast("long")).alias("__order"),
    )
    own = StructField(key, stream.schema[key].dataType, stream.schema[key].nullable)
    schema = StructType([own, StructField("water_year", IntegerType()), StructField("n", LongType()), StructField("total", DoubleType()), StructField("last_day", DateType())])
    seasons = rows.withWatermark("__time", late).groupBy("__block" if blocks else key, "water_year")
    return seasons.transformWithState(SeasonState(own), schema, "Update", "EventTime")


def run_changes(changes: DataFrame, path: str, checkpoint: str):
    """Processes what has arrived; each batch's rows are a part of their own, which a batch that is run again replaces. The query, when done."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def current_totals(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The totals as they stand: of each season the row of the last batch that changed it."""
    rows = spark.read.parquet(path)
    kept = [c for c in rows.columns if c not in (key, "water_year", "batch")]
    return rows.groupBy(key, "water_year").agg(F.max_by(F.struct(*kept), "batch").alias("now")).select(key, "water_year", "now.*")
