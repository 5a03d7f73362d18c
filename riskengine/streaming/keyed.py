"""Exact trailing windows per card as keyed state with event-time timers.

The state of a card is a buffer of events that are still open, in arrival order, and the *history* of closed ones: one cell per
second (count, sum, sum of squares) no older than the widest window. An event is closed once the watermark
has passed its second; no event before it can come any more, so its windows are final and it is emitted, once. A
timer stands at the first open second, so a card that gets no more events is emitted too, and
another one frees the history when the widest window has gone by. Input may be out of order by as much as the
watermark's delay; later rows are dropped by the engine. After a restart the checkpointed state goes on.

All events of a card meet in one state, whose size is bounded by the seconds of the widest window and the events of the
delay. Where one card has more events than one task can take, use ``velocity.exact_velocity``, which
splits cards and seconds and gives the same figures at arrival.

Defined results: events of one second are ordered by the key; a null amount counts as an event and is left out
of mean and deviation; a null card is a card of its own; rows without a time are dropped by the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STATE = (
    "open_key array<long>, open_time array<long>, open_value array<double>, "
    "cell_time array<long>, cell_n array<long>, cell_k array<long>, cell_s array<double>, cell_q array<double>, last long, centre double"
)
_EMPTY = ([], [], [], [], [], [], [], [], None, None)


def windows_of(
    times: np.ndarray, values: np.ndarray, cells: dict[str, np.ndarray], centre: float, windows: Mapping[str, int]
) -> dict[str, np.ndarray]:
    """Count, mean and population deviation of each window for events in order, after the cells of earlier seconds."""
    before = len(cells["time"])
    known = ~np.isnan(values)
    away = np.where(known, values - centre, 0.0)
    line = np.concatenate((cells["time"], times))
    sums = {
        "n": np.concatenate(([0], cells["n"], np.ones(len(times), np.int64))),
        "k": np.concatenate(([0], cells["k"], known.astype(np.int64))),
        # differences of running sums: extended precision keeps the deviations of equal amounts near zero
        "s": np.concatenate(([0.0], cells["s"], away)).astype(np.longdouble),
        "q": np.concatenate(([0.0], cells["q"], away * away)).astype(np.longdouble),
    }
    sums = {m: np.cumsum(v) for m, v in sums.items()}
    upto = before + 1 + np.arange(len(times))
    out = {}
    for tag, width in windows.items():
        since = np.searchsorted(line, times - width, side="left")
        n, k, s, q = (sums[m][upto] - sums[m][since] for m in ("n", "k", "s", "q"))
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = np.where(k > 0, s / k, np.nan)
            square = q / k
            spread = square - mean * mean
            # below what the stored squares can tell from zero
            spread = np.where(spread > 1e-14 * square, spread, 0.0)
        out[f"count_{tag}"] = n
        out[f"avg_{tag}"] = (mean + centre).astype(np.float64)
        out[f"std_{tag}"] = np.where(k > 0, np.sqrt(spread), np.nan).astype(np.float64)
    return out


def _cells(times: np.ndarray, values: np.ndarray, centre: float) -> dict[str, np.ndarray]:
    seconds, at = np.unique(times, return_inverse=True)
    known = ~np.isnan(values)
    away = np.where(known, values - centre, 0.0)

    def summed(x: np.ndarray) -> np.ndarray:
        return np.bincount(at, weights=x, minlength=len(seconds))

    return {
        "time": seconds,
        "n": summed(np.ones(len(times))).astype(np.int64),
        "k": summed(known.astype(float)).astype(np.int64),
        "s": summed(away),
        "q": summed(away * away),
    }


def _advance(windows: Mapping[str, int], by: Sequence[str], key: str, recency: str | None):
    reach = max(windows.values(), default=0)

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = max(0, state.getCurrentWatermarkMs())
        closed_before = watermark // 1000
        was = state.get if state.exists else _EMPTY
        keys, times, values = (np.asarray(x, t) for x, t in zip(was[:3], (np.int64, np.int64, np.float64), strict=True))
        names = ("time", "n", "k", "s", "q")
        cells = {m: np.asarray(x, np.float64 if m in "sq" else np.int64) for m, x in zip(names, was[3:8], strict=True)}
        last, centre = was[8], was[9]
        for frame in frames:
            keys = np.concatenate((keys, frame[key].to_numpy(np.int64)))
            times = np.concatenate((times, frame["_second"].to_numpy(np.int64)))
            values = np.concatenate((values, frame["_value"].to_numpy(np.float64)))
        order = np.lexsort((keys, times))
        keys, times, values = keys[order], times[order], values[order]
        done = int(np.searchsorted(times, closed_before, side="left"))
        if centre is None:
            known = values[~np.isnan(values)]
            centre = float(np.median(known)) if len(known) else None
        middle = 0.0 if centre is None else centre
        if done:
            found = windows_of(times[:done], values[:done], cells, middle, windows)
            out = {c: [g] * done for c, g in zip(by, group, strict=True)} | {key: keys[:done], "time_s": times[:done]} | found
            if recency:
                earlier = np.concatenate(([times[0] if last is None else last], times[: done - 1]))
                out[recency] = times[:done] - earlier
            last = int(times[done - 1])
            new = _cells(times[:done], values[:done], middle)
            cells = {m: np.concatenate((cells[m], new[m])) for m in names}
            yield pd.DataFrame(out)
        keep = cells["time"] >= closed_before - reach
        cells = {m: v[keep] for m, v in cells.items()}
        rest = [keys[done:].tolist(), times[done:].tolist(), values[done:].tolist()]
        if not rest[0] and not len(cells["time"]) and not recency:
            state.remove()
            return
        state.update((*rest, *[cells[m].tolist() for m in names], last, centre))
        if rest[1]:
            state.setTimeoutTimestamp(max((rest[1][0] + 1) * 1000 - 1, watermark + 1))
        elif len(cells["time"]):
            state.setTimeoutTimestamp(max((int(cells["time"][-1]) + reach + 1) * 1000, watermark + 1))

    return step


def keyed_velocity(
    events: DataFrame,
    windows: Mapping[str, int],
    by: Sequence[str] = ("card_id",),
    key: str = "txn_id",
    time: str = "ts",
    value: str = "Amount",
    delay: str = "10 minutes",
    recency: str | None = "time_since_last_txn",
) -> DataFrame:
    """Per event ``by``, key, time_s (Unix second), count, mean and population deviation of every window, and the seconds since the
    card's event before (0 for the first). ``key`` must be a unique long."""
    by = list(by)
    rows = events.withWatermark(time, delay).select(
        *by, F.col(key).cast("long").alias(key), time, F.unix_seconds(F.col(time).cast("timestamp")).alias("_second"), F.col(value).cast("double").alias("_value")
    )
    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by)
    figures = "".join(f", count_{t} long, avg_{t} double, std_{t} double" for t in windows)
    out = f"{types}, `{key}` long, time_s long{figures}" + (f", {recency} long" if recency else "")
    found = rows.groupBy(*by).applyInPandasWithState(_advance(windows, by, key, recency), out, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    # a figure that no amount stands behind is null, as in the batch operator
    return found.withColumns({f"{m}_{t}": F.nullif(f"{m}_{t}", F.lit(float("nan"))) for t in windows for m in ("avg", "std")})
