"""What pipes are doing, entered in the run log, so that any session can read it."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from tradeflow.streaming.runs import enter_runs

UNIT = "pipe"
STARTED, TOOK_IN, STOPPED, FAILED = "STARTED", "TOOK_IN", "STOPPED", "FAILED"


class PipeProgress(StreamingQueryListener):
    """Enters the start, each trigger that found files, and the end of one run of a pipe."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.root, self.name, self.run = spark, root, name, None

    def _enter(self, status: str, started: datetime, took_ms: float = 0.0, files: int | None = None, why: str | None = None) -> None:
        ended = started + timedelta(milliseconds=took_ms)
        row = (f"{self.run}-{uuid.uuid4().hex[:12]}", UNIT, self.name, status, started, ended, took_ms, took_ms, files, why)
        enter_runs(self.spark, self.root, [row])

    def onQueryStarted(self, event) -> None:
        if self.run is None and event.name == self.name:
            self.run = str(event.runId)
            self._enter(STARTED, datetime.now(timezone.utc))

    def onQueryProgress(self, event) -> None:
        told = event.progress
        if str(told.runId) == self.run and told.numInputRows:
            at = datetime.fromisoformat(told.timestamp.replace("Z", "+00:00"))
            self._enter(TOOK_IN, at, float(told.durationMs.get("triggerExecution", 0)), told.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run:
            failed = event.exception is not None
            self._enter(FAILED if failed else STOPPED, datetime.now(timezone.utc), why=event.exception[:1000] if failed else None)
            self.spark.streams.removeListener(self)


def follow_progress(spark: SparkSession, root: str, name: str) -> None:
    """Enter the progress of the next query of this name that starts in the session."""
    spark.streams.addListener(PipeProgress(spark, root, name))
