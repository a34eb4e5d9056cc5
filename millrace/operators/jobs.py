"""Named jobs: started and ended around a block of driver code, kept as rows that outlive the driver."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import JOB
from millrace.sources import sinks


class Jobs:
    """With a path, a job's begin and end are small files below it, each there whole or not at all, and ids go on from those there are, several drivers' as well; else rows are kept by this object alone."""

    def __init__(self, spark: SparkSession | None = None, path: str | None = None) -> None:
        self.rows: list[dict] = []
        self.spark, self.path = spark, path and path.rstrip("/")

    def _put(self, row: dict, kind: str) -> None:
        told = {k: v.strftime("%Y-%m-%dT%H:%M:%S.%fZ") if isinstance(v, datetime) else v for k, v in row.items()}
        sinks.publish_text(self.spark, f"{self.path}/{row['id']:012d}-{kind}.json", json.dumps(told))

    def _begin(self, row: dict) -> None:
        """Give the row the next id; where another driver takes it meanwhile, the one after."""
        if not self.path:
            row["id"] = len(self.rows) + 1
            return
        row["id"] = max((int(n[:12]) for n in sinks.names(self.spark, self.path) if n[:12].isdigit()), default=0) + 1
        while True:
            try:
                return self._put(row, "0")
            except FileExistsError:
                row["id"] += 1

    @contextmanager
    def job(self, name: str) -> Iterator[dict]:
        """Set ``records_in`` and ``records_out`` on what is given; an exception marks the job failed and goes on."""
        row = {"id": 0, "job_name": name, "status": "running", "started_at": datetime.now(UTC), "finished_at": None, "records_in": None, "records_out": None, "error": None}
        self._begin(row)
        self.rows.append(row)
        try:
            yield row
            row["status"] = "succeeded"
        except BaseException as e:
            row.update(status="failed", error=str(e)[:2000])
            raise
        finally:
            row["finished_at"] = datetime.now(UTC)
            if self.path:
                self._put(row, "1")

    def frame(self, spark: SparkSession) -> DataFrame:
        """A row per job, the ended ones as they ended; a job whose driver died stays ``running``."""
        names = [part.split()[0] for part in JOB.split(", ")]
        if not self.path:
            return spark.createDataFrame([tuple(r[n] for n in names) for r in self.rows], JOB)
        if not sinks.names(spark, self.path):
            return spark.createDataFrame([], JOB)
        rows = spark.read.schema(JOB).json(f"{self.path}/*.json")
        return rows.groupBy("id").agg(F.max_by(F.struct(*names[1:]), F.col("finished_at").isNotNull()).alias("r")).select("id", "r.*")

    def orphaned(self, spark: SparkSession, *, older_than: datetime) -> DataFrame:
        """Jobs that began before a time and never ended, as failed ones, for healing to take up."""
        rows = self.frame(spark).filter((F.col("status") == "running") & (F.col("started_at") < F.lit(older_than)))
        return rows.withColumns({"status": F.lit("failed"), "error": F.lit("its driver ended")})
