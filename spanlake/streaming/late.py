"""Roots and anchors that may change until a watermark has passed, and scores that come late, as streams with state."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from spanlake.functions import ids, values

#: State store that timers and states by key need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How long a trace stays open after its last row, in milliseconds.
QUIET_MS = 3_600_000
_STATE = "n long, parentless long, start timestamp, end timestamp, root_at timestamp, root string, first_at timestamp, first string, session string"
_CLOSED = "trace_id string, rows long, parentless long, start_time timestamp, end_time timestamp, only_root string, session_id string"


def _utc(moment: datetime | None) -> datetime | None:
    return moment.replace(tzinfo=UTC) if moment is not None and moment.tzinfo is None else moment


class Traces(StatefulProcessor):
    """What is known of each open trace: nine values, however many rows it has. A timer after its end closes it, and a row that moves the end moves the timer."""

    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("trace", _STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803  names are given
        n, parentless, start, end, root_at, root, first_at, first, session = self.state.get() if self.state.exists() else (0, 0, None, None, None, None, None, None, None)
        start, end, root_at, first_at = map(_utc, (start, end, root_at, first_at))
        for row in rows:
            at, until, order = _utc(row.start_time), _utc(row.until), row.id or ""
            n += 1
            start, end = at if start is None else min(start, at), until if end is None else max(end, until)
            if row.parentless:
                parentless += 1
                if root_at is None or (at, order) < (root_at, root):
                    root_at, root = at, order
            if first_at is None or (at, order) < (first_at, first):
                first_at, first, session = at, order, row.session_id
        self.state.update((n, parentless, start, end, root_at, root, first_at, first, session))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(max(start, end).timestamp() * 1000) + self.quiet_ms)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:  # noqa: N802, N803
        if not self.state.exists():
            return
        n, parentless, start, end, _, root, _, _, session = self.state.get()
        self.state.clear()
        yield Row(trace_id=key[0], rows=n, parentless=parentless, start_time=_utc(start), end_time=_utc(end), only_root=root, session_id=session)


def roots(stream: DataFrame, late: str = "1 hour", quiet_ms: int = QUIET_MS, names: ids.Namespaces = ids.DEFAULT) -> DataFrame:
    """trace_id, rows, parentless, made_up, root_id, start_time, end_time, session_id of each trace, once, when it is closed.

    A trace is closed when the watermark (`late` behind the newest start) is quiet_ms past its end; until then each row may
    change its root. What `spans.roots` says of the same rows is said here. A row that comes later still opens its trace anew.
    Rows without a trace or start are left out. The session needs the state store STORE.
    """
    end = values.end_time(F.col("end_time"), F.lit(None).cast("timestamp"), F.col("start_time"))
    rows = stream.where("trace_id IS NOT NULL AND start_time IS NOT NULL").select("trace_id", F.col("id").cast("string").alias("id"), "start_time", end.alias("until"), values.or_else(F.col("parent_id")).isNull().alias("parentless"), "session_id")
    closed = rows.withWatermark("start_time", late).groupBy("trace_id").transformWithState(Traces(quiet_ms), _CLOSED, "Append", "EventTime")
    made_up = F.col("parentless") != 1
    root = F.when(made_up, ids.root_span_id(F.col("trace_id"), names)).otherwise(ids.span_id(F.col("only_root"), names))
    return closed.select("trace_id", "rows", "parentless", made_up.alias("made_up"), root.alias("root_id"), "start_time", "end_time", "session_id")


def scored(spans: DataFrame, scores: DataFrame, within: str = "1 day", late: str = "1 hour", target: Column | None = None) -> DataFrame:
    """Each score with the span it is for, if it was given from the span's start to `within` after it: both sides are streams.

    spans: span_id, start_time; scores: id, target (or `target`), at, and what else they have. The interval and both watermarks
    say when a row can have no partner any more, so state is bounded by `within` and `late`.
    """
    s = spans.withWatermark("start_time", late).alias("s")
    c = (scores if target is None else scores.withColumn("target", target)).withWatermark("at", late).alias("c")
    near = (F.col("c.target") == F.col("s.span_id")) & (F.col("c.at") >= F.col("s.start_time")) & (F.col("c.at") <= F.col("s.start_time") + F.expr(f"INTERVAL {within}"))
    return c.join(s, near).select("c.*", F.col("s.start_time").alias("span_start"))
