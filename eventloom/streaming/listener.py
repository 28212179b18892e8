"""What streaming queries report about themselves: failures and late rows as alert rows."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.counts import ALERT_SCHEMA
from ..plans.ingest import Layout, write_failure
from ..sinks.publish import write_rows

_MARK = "eventloom"


def query_name(layout: Layout, kind: str) -> str:
    """A name that tells listeners which layout a query belongs to; unlike that of any other."""
    return f"{_MARK} {kind} {uuid.uuid4().hex} {layout.base}"


class QueryAlerts(StreamingQueryListener):
    """Leaves an alert row below ``alerts`` when a query of the layout ends by an error, and
    one when its watermark has dropped late rows.

    Spark tells listeners a little after the query itself; an alert is there soon after
    ``awaitTermination`` returns or raises.  Works for failures anywhere in a query: in a batch, in
    its source, its sink or its checkpoint.
    """

    def __init__(self, spark: SparkSession, layout: Layout):
        super().__init__()
        self.spark, self.layout = spark, layout
        self.kinds: dict[str, str] = {}
        self.late: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        parts = (event.name or "").split(" ", 3)
        if len(parts) == 4 and parts[0] == _MARK and parts[3] == self.layout.base:
            self.kinds[str(event.runId)] = parts[1]

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.runId) in self.kinds:
            dropped = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
            self.late[str(progress.runId)] = self.late.get(str(progress.runId), 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        kind = self.kinds.pop(run, None)
        if kind is None:
            return
        dropped = self.late.pop(run, 0)
        if dropped:
            rows = self.spark.createDataFrame([(kind, "", "late", dropped, [])], ALERT_SCHEMA)
            write_rows(rows, self.layout.alerts, f"stream-{run}-late")
        if event.exception is not None:
            write_failure(self.spark, self.layout, f"stream-{run}", kind, event.exception)


_WATCHED: dict[tuple[str, str], QueryAlerts] = {}


def watch(spark: SparkSession, layout: Layout) -> QueryAlerts:
    """The layout's listener, added once to an application."""
    key = (spark.sparkContext.applicationId, layout.base)
    if key not in _WATCHED:
        _WATCHED[key] = QueryAlerts(spark, layout)
        spark.streams.addListener(_WATCHED[key])
    return _WATCHED[key]
