"""Structured Streaming forms of the merge operators: session windows over event time, and a stateful merge with a length cap."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(events: DataFrame, key: str, ts: str, gap: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(key, start, end, n) of sessions that end after a gap; for a stream and a batch alike. Rows later than ``late`` are dropped
    by a stream once their session is out."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    out = rows.groupBy(key, F.session_window(ts, gap).alias("s")).agg(F.count("*").alias("n"))
    return out.select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def capped_merge(segments: DataFrame, key: str = "episode_id", max_gap: float = 1.0, max_length: int = 1200, quiet_ms: int | None = 60_000) -> DataFrame:
    """(key, first, n, text) groups of a stream of (key, seq, start, end, text): a group goes out when the next row does not fit
    it, or when its key has been quiet for ``quiet_ms`` (None: never; a query that stops when all is read needs None).

    Rows of a batch are taken in the order of seq. A row whose seq is not past its key's last one comes late and is passed over: the
    groups before it may be out already. A missing or NaN time ends a group.
    """

    def fold(k, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        first, n, end, text, last = state.get if state.exists else (None, 0, None, "", None)
        out = []
        if state.hasTimedOut:
            if n:
                out.append((k[0], first, n, text))
            state.update((None, 0, None, "", last))
        else:
            rows = pd.concat(list(frames)).sort_values("seq")
            for r in rows.itertuples():
                if last is not None and r.seq <= last:
                    continue
                last = int(r.seq)
                said = r.text or ""
                if n and end is not None and r.start - end <= max_gap and len(text) + 1 + len(said) <= max_length:
                    n, text = n + 1, f"{text} {said}"
                else:
                    if n:
                        out.append((k[0], first, n, text))
                    first, n, text = last, 1, said
                end = None if pd.isna(r.end) else float(r.end)
            state.update((first, n, end, text, last))
            if quiet_ms:
                state.setTimeoutDuration(quiet_ms)
        yield pd.DataFrame(out, columns=[key, "first", "n", "text"])

    kind = segments.schema[key].dataType.simpleString()
    return segments.groupBy(key).applyInPandasWithState(fold, f"{key} {kind}, first long, n long, text string", "first long, n long, end double, text string, last long", "append", "ProcessingTimeTimeout" if quiet_ms else "NoTimeout")
