"""Event-time operators over the message stream: dedup, statistics by window, entity views.

Event time is a message's ``kafka_timestamp``. Watermarks work on zoned timestamps, so the
wall-clock time is read as the session's zone shows it and handed on as it came.
"""

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType, StructType

EVENT = "event_time"
TIME = "kafka_timestamp"
KEYS = ("video_id", TIME)


def timed(messages: DataFrame, late: str, time: str = TIME) -> DataFrame:
    """Messages with their event time, which may come up to ``late`` out of order. A message
    without time cannot be placed: it is no part of event-time results."""
    known = messages.filter(F.col(time).isNotNull())
    return known.withColumn(EVENT, F.col(time).cast("timestamp")).withWatermark(EVENT, late)


def deduplicated(messages: DataFrame, keys: Sequence[str] = KEYS, late: str = "10 minutes") -> DataFrame:
    """The first message of each key, if its repeats come within ``late`` of it in event time.

    The state holds a key until the watermark has passed it by that time, so it does not
    grow with the stream; a message older than the watermark is dropped, repeat or not.
    """
    return timed(messages, late).dropDuplicatesWithinWatermark(list(keys)).drop(EVENT)


def windowed_stats(messages: DataFrame, window: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Messages, views and likes of each category in each stretch of event time.

    A stretch is given out once, when the watermark has passed its end (append mode);
    messages that are later than ``late`` do not count.
    """
    spans = timed(messages, late).groupBy(F.window(EVENT, window).alias("span"), "categoryId")
    stats = spans.agg(
        F.count("*").alias("messages"),
        F.sum("view_count").alias("views"),
        F.sum("likes").alias("likes"),
        F.approx_count_distinct("video_id").alias("videos"),
    )
    ends = {c: F.col(f"span.{c}").cast("timestamp_ntz") for c in ("start", "end")}
    return stats.withColumns(ends).drop("span")


class _Views(StatefulProcessor):
    """Keeps the best and the first row of a video; gives out what changed."""

    def __init__(self, columns: Sequence[str], schema: StructType, best: Sequence[str], first: Sequence[str]):
        self.columns, self.schema, self.best, self.first = list(columns), schema, list(best), list(first)
        # pandas reads whole numbers as fractions where some are NULL; the state would lose them
        self.whole = [isinstance(f.dataType, IntegralType) for f in schema.fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = {view: handle.getValueState(view, self.schema) for view in ("best", "first")}

    def _rank(self, row: tuple, view: str) -> tuple:
        cells = dict(zip(self.columns, row, strict=True))
        known = lambda c: (cells[c] is None, cells[c] if cells[c] is not None else 0)
        if view == "first":  # NULL goes first, as ascending orders have it
            return tuple((not n, v) for n, v in map(known, self.first))
        metric, *ties = self.best
        missing, value = known(metric)
        return ((missing, 0 if missing else -value), *[(not n, v) for n, v in map(known, ties)])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        changed = {}
        now = {view: tuple(state.get()) if state.exists() else None for view, state in self.held.items()}
        for frame in rows:
            for row in frame[self.columns].astype(object).where(frame[self.columns].notna(), None).itertuples(index=False, name=None):
                cells = tuple(int(c) if whole and c is not None else c.to_pydatetime() if isinstance(c, pd.Timestamp) else c for whole, c in zip(self.whole, row, strict=True))
                for view, kept in now.items():
                    if kept is None or self._rank(cells, view) < self._rank(kept, view):
                        now[view] = changed[view] = cells
        for view, cells in changed.items():
            self.held[view].update(cells)
            yield pd.DataFrame({"view": [view], **{c: pd.Series([v], dtype=object) for c, v in zip(self.columns, cells, strict=True)}})

    def close(self) -> None:
        pass


def entity_views(
    rows: DataFrame,
    columns: Sequence[str],
    best: Sequence[str] = ("view_count", "trending_date"),
    first: Sequence[str] = ("trending_date",),
) -> DataFrame:
    """A row for each change of a video's best row (``view`` = best: largest of the first of
    ``best``, then smallest of the others) or of its first row (view = first: smallest).

    The newest row of a video and view is what keep_best and keep_first give over all
    rows so far. The state is two rows for each video in a state store that a restart
    reads back; set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB one.
    ``columns`` hold video_id; rows without it form one video.
    """
    schema = StructType([rows.schema[c] for c in columns])
    output = StructType().add("view", "string")
    for field in schema.fields:
        output = output.add(field)
    processor = _Views(columns, schema, best, first)
    return rows.select(*columns).groupBy("video_id").transformWithStateInPandas(statefulProcessor=processor, outputStructType=output, outputMode="Update", timeMode="None")
