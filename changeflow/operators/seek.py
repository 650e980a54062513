"""Incremental extraction from a position: what was handed out is a prefix of the order, and a few late rows.

Rows are handed out in the order of (order column, key). What is remembered is the last place handed out, the keys, filed by
range of the order column, and the digests of each run's ranges. A row is new if it stands after the place; it is late if it stands
before it and wasn't handed out. Ranges whose digest equals that of what was handed out have no late rows, so the keys of
the other ranges only are read and joined, not all keys ever emitted.

    <path>/keys/_run=N/_range=R/     keys handed out by run N
    <path>/digests/_run=N/           digests of the ranges of run N
    <path>/place/_run=N/             one row: the last place after run N; its arrival completes the run
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.digest import RANGE, added_up, differences, digests
from changeflow.sources import paths

RUN = "_run"


class Extraction:
    """``key`` tells rows apart; ``order`` is the column that rows come in the order of, NULL last; ``by`` gives the range of a
    row, which must follow from ``key`` and ``order``."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: str, by: Column):
        self.spark, self.path, self.key, self.order, self.by = spark, path.rstrip("/"), key, order, by

    def runs(self) -> int:
        """Completed runs."""
        root = f"{self.path}/place"
        done = [n for n in paths.partition_values(self.spark, root, RUN) if paths.exists(self.spark, f"{root}/{RUN}={n}/_SUCCESS")]
        return max(map(int, done), default=0)

    def _place(self, rows: DataFrame, run: int):
        schema = rows.select(self.order, self.key).schema
        return self.spark.read.schema(schema).parquet(f"{self.path}/place/{RUN}={run}").first()

    def _keys(self, rows: DataFrame, runs: int) -> DataFrame:
        """What was handed out: key, order column, range."""
        handed = rows.select(self.key, self.order, self.by.alias(RANGE))
        schema = handed.schema.add(RUN, "long")
        return self.spark.read.schema(schema).parquet(f"{self.path}/keys").where(F.col(RUN) <= runs).select(*handed.columns)

    def pending(self, rows: DataFrame) -> DataFrame:
        """Rows that weren't handed out."""
        runs = self.runs()
        if runs == 0:
            return rows
        place = self._place(rows, runs)
        key, order = F.col(self.key), F.col(self.order)
        if place[self.order] is None:
            after = order.isNull() & (key > F.lit(place[self.key]))
        else:
            after = order.isNull() | (order > F.lit(place[self.order]))
            after = after | ((order == F.lit(place[self.order])) & (key > F.lit(place[self.key])))
        passed = rows.where(~after)
        handed = self._keys(rows, runs)
        names = [self.key, self.order]
        before = self.spark.read.option("basePath", f"{self.path}/digests").parquet(f"{self.path}/digests").where(F.col(RUN) <= runs)
        changed = differences(added_up(before), digests(passed, self.by, names)).where("NOT same AND n_after > 0").select(RANGE)
        changed = paths.stage(changed).withColumnRenamed(RANGE, "__range")
        of_range = F.col(RANGE).eqNullSafe(F.col("__range"))
        suspects = passed.withColumn(RANGE, self.by).join(changed, of_range, "left_semi").drop(RANGE)
        known = handed.join(changed, of_range, "left_semi").select(*[F.col(n).alias(f"__{n}") for n in names])
        same = (key == F.col(f"__{self.key}")) & order.eqNullSafe(F.col(f"__{self.order}"))
        return suspects.join(known, same, "left_anti").unionByName(rows.where(after))

    def next_batch(self, rows: DataFrame, size: int) -> DataFrame:
        """The next ``size`` rows, stored and remembered as a run. A run that died is done again."""
        run = self.runs() + 1
        order = [F.col(self.order).asc_nulls_last(), F.col(self.key).asc()]
        batch = paths.stage(self.pending(rows).orderBy(*order).limit(size))
        for part in paths.partition_values(self.spark, f"{self.path}/keys", RUN):
            if int(part) >= run:  # keys of a run that wasn't completed
                paths.delete(self.spark, f"{self.path}/keys/{RUN}={part}")
        handed = batch.select(self.key, self.order, self.by.alias(RANGE))
        handed.write.partitionBy(RANGE).mode("overwrite").parquet(f"{self.path}/keys/{RUN}={run}")
        ranges = digests(batch, self.by, [self.key, self.order])
        ranges.write.mode("overwrite").parquet(f"{self.path}/digests/{RUN}={run}")
        last = batch.select(self.order, self.key)
        if run > 1:
            before = self.spark.read.schema(last.schema).parquet(f"{self.path}/place/{RUN}={run - 1}")
            last = last.unionByName(before)
        down = [F.col(self.order).desc_nulls_first(), F.col(self.key).desc()]
        last.orderBy(*down).limit(1).write.mode("overwrite").parquet(f"{self.path}/place/{RUN}={run}")
        return batch
