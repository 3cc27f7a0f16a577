"""Frozen and ramp flags on arrival, in event-time order.

Ordered windows do not exist on streams. A key's state holds the readings the watermark has not
passed yet, and the last two it has: readings may arrive in any order within the lateness, are flagged
once the watermark has passed them, and get the flags the batch ``lag`` form gives over all of them. A
reading that comes after the watermark has passed its hour is dropped, as windows drop late rows.

A waiting reading is an entry of its own in map state and a timer stands at the earliest, so what a
batch writes follows the readings it brings and flags, not those that wait. State is bounded by the
readings of a key within the lateness. Readings that share a key and an hour keep their order of arrival.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wattloom.schemas import MAX_RAMP_PCT

FLAGGED = "ba_code string, period_utc timestamp, demand_mwh double, flag_frozen_reading boolean, flag_extreme_ramp boolean"
#: Map and timer state need this store; it is set for the session, before the query starts.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A waiting reading: its hour in microseconds and its number of arrival, then the reading (NaN for none).
WAITING = ("hour long, nth long", "reading double")
#: The two newest passed readings, the newest passed hour, the next number of arrival, the hour of the timer (-1: none).
PASSED = "before double, last double, newest long, arrived long, timer long"
_NOTHING = (float("nan"), float("nan"), -(2**62), 0, -1)


def _flags(values: np.ndarray, passed: list[float]) -> tuple[pd.Series, pd.Series]:
    """Three-valued flags of ``values`` in order; ``passed`` are the two readings before, NaN where there is none."""
    line = np.concatenate([passed, values])
    now, one, two = line[2:], line[1:-1], line[:-2]
    missing, unknown = np.isnan(now), np.isnan(one) | np.isnan(two)
    differs = (~np.isnan(one) & (now != one)) | (~np.isnan(two) & (now != two))
    frozen = pd.Series(~missing & ~unknown & ~differs, dtype="boolean")
    frozen[~missing & unknown & ~differs] = pd.NA
    with np.errstate(divide="ignore", invalid="ignore"):
        change = np.abs(now - one) / np.where(one == 0, np.nan, one) * 100
    ramp = pd.Series(change > MAX_RAMP_PCT, dtype="boolean")
    ramp[np.isnan(change)] = pd.NA
    return frozen, ramp


class ArrivalFlags(StatefulProcessor):
    """Keeps a key's waiting readings and emits them with their flags once the watermark is past."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getMapState("waiting", *WAITING)
        self._passed = handle.getValueState("passed", PASSED)

    def _known(self) -> tuple:
        return tuple(self._passed.get()) if self._passed.exists() else _NOTHING

    def _remind(self, timer: int, hour: int) -> int:
        """A timer at an hour, rounded up to milliseconds, unless the key's timer is as early; it fires when the watermark is there."""
        wanted = max(-(-hour // 1000), 0)
        if 0 <= timer <= wanted:
            return timer
        if timer >= 0:
            self._handle.deleteTimer(timer)
        self._handle.registerTimer(wanted)
        return wanted

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before, last, newest, arrived, timer = self._known()
        least = None
        for part in rows:
            times = part["period_utc"].to_numpy().astype("datetime64[us]").astype(np.int64)
            values = part["demand_mwh"].to_numpy(dtype=np.float64)
            fresh = times > newest
            for time, value in zip(times[fresh].tolist(), values[fresh].tolist(), strict=True):
                self._waiting.updateValue((time, arrived), (value,))
                arrived += 1
            if fresh.any():
                first = int(times[fresh].min())
                least = first if least is None else min(least, first)
        if least is not None:
            self._passed.update((before, last, newest, arrived, self._remind(timer, least)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        before, last, newest, arrived, _ = self._known()
        found = sorted((*at, *reading) for at, reading in self._waiting.iterator())
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        ready = [row for row in found if row[0] <= mark]
        for hour, nth, _ in ready:
            self._waiting.removeKey((hour, nth))
        timer = self._remind(-1, found[len(ready)][0]) if len(ready) < len(found) else -1
        if ready:
            values = np.array([reading for *_, reading in ready], dtype=np.float64)
            frozen, ramp = _flags(values, [before, last])
            yield pd.DataFrame(
                {
                    "ba_code": key[0],
                    "period_utc": np.array([hour for hour, *_ in ready], dtype="datetime64[us]"),
                    "demand_mwh": values,
                    "flag_frozen_reading": frozen.to_numpy(dtype=object, na_value=None),
                    "flag_extreme_ramp": ramp.to_numpy(dtype=object, na_value=None),
                }
            )
            before, last = [before, last, *values.tolist()][-2:]
            newest = ready[-1][0]
        self._passed.update((before, last, newest, arrived, timer))

    def close(self) -> None:
        pass


def flag_on_arrival(readings: DataFrame, lateness: str = "24 hours") -> DataFrame:
    """(ba_code, period_utc, demand_mwh) rows with both flags, three-valued as in the batch build."""
    readings.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rows = readings.select("ba_code", "period_utc", "demand_mwh").withWatermark("period_utc", lateness)
    return rows.groupBy("ba_code").transformWithStateInPandas(ArrivalFlags(), FLAGGED, "append", "eventTime")
