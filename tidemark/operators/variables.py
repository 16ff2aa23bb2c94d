"""Groups with several named state variables and timers.

``VariableCounts`` keeps a total, a map of counts by kind and one timer for each key.  Its rows
are counts that were folded ahead of the shuffle, so a busy key arrives as a few rows per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

TIMES = {"none": "None", "event": "EventTime", "processing": "ProcessingTime"}


def process_groups(
    df: DataFrame,
    keys: list[str],
    processor: StatefulProcessor,
    output: str,
    mode: str = "update",
    time: str = "none",
) -> DataFrame:
    """Run a processor with state variables over the groups of a stream, in pandas chunks.

    ``time`` says what its timers follow: ``event`` (the stream needs a watermark),
    ``processing`` or ``none``.  Each variable and the timers can be read from the checkpoint by name.
    """
    if mode not in ("append", "update"):
        raise ValueError(f"mode must be 'append' or 'update', not {mode!r}")
    if time not in TIMES:
        raise ValueError(f"time must be one of {sorted(TIMES)}, not {time!r}")
    return df.groupBy(*keys).transformWithStateInPandas(
        processor, outputStructType=output, outputMode=mode, timeMode=TIMES[time]
    )


class VariableCounts(StatefulProcessor):
    """Counts for each key: ``total``, ``kinds`` and a timer ``gap_ms`` behind the last time.

    Takes the columns ``kind`` (a null kind is the empty one), ``n`` and ``time`` (not null), emits the
    keys with the new total (``closed`` false), and once more (``closed`` true, the total that goes) when
    the timer ends, which also clears the state: a key that returns starts anew.
    """

    def __init__(self, kind: str, n: str, time: str, gap_ms: int):
        self._columns = (kind, n, time)
        self._gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._total = handle.getValueState("total", "n long")
        self._kinds = handle.getMapState("kinds", "kind string", "n long")
        self._last = handle.getValueState("last", "ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kind, n, time = self._columns
        found: dict[str, int] = {}
        high = None
        for chunk in rows:
            for name, more in chunk.groupby(chunk[kind].fillna(""))[n].sum().items():
                found[name] = found.get(name, 0) + int(more)
            ms = int(chunk[time].dt.tz_localize(None).astype("datetime64[ms]").astype("int64").max())
            high = ms if high is None else max(high, ms)
        # get and getValue give None for what isn't there: one call to the state store each
        held = self._total.get()
        total = sum(found.values()) + (held[0] if held is not None else 0)
        self._total.update((total,))
        for name, more in found.items():
            held = self._kinds.getValue((name,))
            self._kinds.updateValue((name,), ((held[0] if held is not None else 0) + more,))
        held = self._last.get()
        before = held[0] if held is not None else None
        if before is None or high > before:
            if before is not None:
                self._handle.deleteTimer(before + self._gap_ms)
            self._handle.registerTimer(high + self._gap_ms)
            self._last.update((high,))
        yield self._row(key, total, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total = self._total.get()[0]
        self._total.clear()
        self._kinds.clear()
        self._last.clear()
        yield self._row(key, total, True)

    @staticmethod
    def _row(key: tuple, total: int, closed: bool) -> pd.DataFrame:
        return pd.DataFrame([[*key, total, closed]])

    def close(self) -> None:
        pass
