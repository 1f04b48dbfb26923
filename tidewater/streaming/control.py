"""Run control for streaming queries (ST1–ST3, ST5–ST7, ST13, ST16, ST17).

Bounded runs use ``trigger(availableNow=True)``: drain everything present at
start, in as many micro-batches as the source limits allow, then stop.
Continuous runs use a processing-time trigger (the reference's 5 s flush and
30 s / 10 s checkpoints).  Restart = same checkpoint folder; fresh start =
a new one.

A pipeline observes its good and bad records in the streaming plan itself
(:func:`observed`), so the counts come with Spark's progress events and cost no
pass of their own.  :class:`RunMonitor` listens to these events; heartbeats and
the idle stop follow from what it has heard.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

FLUSH_5S = "5 seconds"
CHECKPOINT_30S = "30 seconds"
CHECKPOINT_10S = "10 seconds"


def start(writer, checkpoint: str, bounded: bool, every: str = FLUSH_5S,
          name: str | None = None) -> StreamingQuery:
    """Start a ``DataStreamWriter`` bounded (availableNow) or continuous."""
    w = writer.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if bounded else w.trigger(processingTime=every)
    return w.start()


def drain_and_stop(q: StreamingQuery) -> None:
    """Process everything available now, then stop (ST6)."""
    q.processAllAvailable()
    q.stop()


def counts_name(stream_id: str) -> str:
    return f"counts-{stream_id}"


def observed(rows: DataFrame, stream_id: str, ok: Column, latest: str | None = None) -> DataFrame:
    """Attach the counts of good and bad records (and the latest event time of
    the good ones) to a stream; they are reported with its progress."""
    ok = F.coalesce(ok, F.lit(False))
    last = F.max(F.when(ok, F.col(latest))).cast("string") if latest else F.max(F.lit(None).cast("string"))
    return rows.observe(counts_name(stream_id), F.count(F.when(ok, 1)).alias("good"), F.count(F.when(~ok, 1)).alias("bad"), last.alias("latest"))


@dataclass
class BatchCounts:
    good: int
    bad: int
    latest: str | None


@dataclass(eq=False)
class RunMonitor(StreamingQueryListener):
    """Counts of one pipeline's batches, as the progress events tell them.

    ``heartbeat`` gets ``STATUS rows=<n> latest=<ts>`` after every batch with
    data; ``base(first_batch)`` gives the rows and latest time that were there
    before the first batch heard of.  A batch told twice counts once."""

    stream_id: str
    heartbeat: Callable[[str], None] | None = None
    base: Callable[[int], tuple[int, str | None]] | None = None
    clock: Callable[[], float] = time.monotonic
    batches: dict[int, BatchCounts] = field(default_factory=dict)

    def __post_init__(self):
        self._lock = threading.Condition()
        self._start: tuple[int, str | None] | None = None
        self._done: set[str] = set()
        self.last_data = self.clock()

    def attach(self, spark: SparkSession) -> "RunMonitor":
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    # --- events -------------------------------------------------------------
    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        told = p.observedMetrics.get(counts_name(self.stream_id))
        if told is None:
            return
        with self._lock:
            if p.numInputRows > 0:
                self.last_data = self.clock()
                self.batches[p.batchId] = BatchCounts(told["good"] or 0, told["bad"] or 0, told["latest"])
            self._lock.notify_all()
        if self.heartbeat and p.numInputRows > 0:
            self.heartbeat(self.status())

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._done.add(str(event.runId))
            self._lock.notify_all()

    # --- what was heard -----------------------------------------------------
    @property
    def good(self) -> int:
        return sum(b.good for b in self.batches.values())

    @property
    def bad(self) -> int:
        return sum(b.bad for b in self.batches.values())

    def status(self) -> str:
        """``STATUS rows=<n> latest=<max ts or none>`` of the table so far."""
        if self._start is None:
            self._start = self.base(min(self.batches, default=0)) if self.base else (0, None)
        rows, latest = self._start
        times = [t for t in (latest, *(b.latest for b in self.batches.values())) if t is not None]
        return f"STATUS rows={rows + self.good} latest={_millis(max(times, key=_time)) if times else 'none'}"

    def wait(self, q: StreamingQuery, timeout: float = 60.0) -> bool:
        """Until the end of ``q`` has been heard of; its batches come before."""
        end = time.monotonic() + timeout
        with self._lock:
            while str(q.runId) not in self._done:
                if not self._lock.wait(max(0.0, min(1.0, end - time.monotonic()))) and time.monotonic() >= end:
                    return False
        return True

    def stop_when_idle(self, q: StreamingQuery, idle_seconds: float, poll_seconds: float = 1.0, max_seconds: float = float("inf"),
                       sleep: Callable[[float], None] = time.sleep) -> bool:
        """Stop ``q`` once no batch with data was heard of for ``idle_seconds``
        (ST5); True if stopped for that.  A batch that is still running is not
        idle time."""
        began = self.clock()
        self.last_data = max(self.last_data, began)
        while q.isActive and self.clock() - began < max_seconds:
            status = q.status or {}
            if status.get("isTriggerActive") and status.get("isDataAvailable"):
                self.last_data = self.clock()
            if self.clock() - self.last_data >= idle_seconds:
                q.stop()
                return True
            sleep(poll_seconds)
        return False


def _time(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def _millis(text: str) -> str:
    return _time(text).strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]


def wait_for_rows(count: Callable[[], int], expected: int, poll_seconds: float = 3.0,
                  timeout_seconds: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> int:
    """Poll a row count until it reaches ``expected`` or the timeout (ST13)."""
    waited = 0.0
    n = count()
    while n < expected and waited < timeout_seconds:
        sleep(poll_seconds)
        waited += poll_seconds
        n = count()
    return n
