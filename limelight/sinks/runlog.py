"""One row a run and stage, appended in any case.

``with run_log(spark, root, stage) as log`` writes one JSON row to
``<root>/runs/<stage>/run=<run_id>/`` when the block ends, however it ends: run id, stage,
status (``success`` or ``failed``), error message, start, end, elapsed seconds, and the
counts that the block had reported by then. A run has a folder of its own, so runs do not
overwrite one another. An error of the block is raised again after the row is written;
where writing the row fails too, the block's error is the one that is raised.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = logging.getLogger(__name__)
FIXED = "run_id string, stage string, status string, error_message string, started_at string, finished_at string, elapsed_sec double"


class RunLog:
    def __init__(self, spark: SparkSession, root: str, stage: str, run_id: str | None = None):
        self.spark, self.root, self.stage = spark, root.rstrip("/"), stage
        self.run_id = run_id or f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        self.counts: dict[str, int] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/runs/{name}/run={self.run_id}"

    def report(self, **counts: int) -> None:
        """Counts for the row; a later value of a name replaces an earlier one."""
        self.counts |= counts

    def table(self, name: str, df: DataFrame) -> None:
        """A result table of this run, beside those of other runs."""
        df.write.mode("append").json(self.path(name))

    def write(self, status: str, error: str | None, started: dt.datetime, elapsed: float) -> None:
        row = {"run_id": self.run_id, "stage": self.stage, "status": status, "error_message": error, "started_at": started.isoformat(),
               "finished_at": (started + dt.timedelta(seconds=elapsed)).isoformat(), "elapsed_sec": round(elapsed, 3), **self.counts}
        line = json.dumps(row, ensure_ascii=False)
        self.spark.range(1).select(F.lit(line).alias("value")).write.mode("append").text(self.path(self.stage))


@contextmanager
def run_log(spark: SparkSession, root: str, stage: str, run_id: str | None = None) -> Iterator[RunLog]:
    log = RunLog(spark, root, stage, run_id)
    started, clock = dt.datetime.now(dt.UTC), time.monotonic()
    status, error = "failed", None
    try:
        yield log
        status = "success"
    except BaseException as e:
        error = f"{type(e).__name__}: {e}"[:4000]
        raise
    finally:
        try:
            log.write(status, error, started, time.monotonic() - clock)
        except Exception:
            if status == "success":
                raise
            LOG.exception("the run row of the failed stage %s could not be written", stage)


def read_runs(spark: SparkSession, root: str, stage: str) -> DataFrame:
    """All rows of a stage, oldest first; counts are columns, NULL where a run did not report them."""
    path = f"{root.rstrip('/')}/runs/{stage}"
    found = {f.name: f for f in spark.read.option("basePath", path).option("pathGlobFilter", "*.txt").json(path).schema if f.name != "run"}
    fixed = {x.split()[0]: x.split()[1] for x in FIXED.split(", ")}
    counts = [f"`{name}` bigint" for name in found if name not in fixed]
    rows = spark.read.schema(", ".join([FIXED, *counts])).json(path).drop("run")
    return rows.orderBy("started_at", "run_id")
