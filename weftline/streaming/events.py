"""Structured Streaming: validation records from log lines, and windows over events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.logs import REQUIRED, validation_values

RECORD = "epoch long, up long, chrf double, ce_mean_words double, bleu_detok double"


def assemble_stream(lines: DataFrame, give_up_ms: int | None = 3_600_000) -> DataFrame:
    """Records from a stream of log lines: each key waits in state until its required values have arrived.

    A value that comes after its record opens the key anew; keys that wait longer than give_up_ms are given up.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        have = list(state.get) if state.exists else [None] * len(REQUIRED)
        done = []
        for part in parts:
            for k, v in zip(part["key"], part["value"], strict=True):
                if k in REQUIRED:
                    have[REQUIRED.index(k)] = float(v)
                    if None not in have:
                        done.append((*key, *have))
                        have = [None] * len(REQUIRED)
        if any(v is not None for v in have):
            state.update(tuple(have))
            if give_up_ms:
                state.setTimeoutDuration(give_up_ms)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(done, columns=["epoch", "up", *REQUIRED])

    values = validation_values(lines).select("epoch", "up", "key", "value")
    return values.groupBy("epoch", "up").applyInPandasWithState(run, RECORD, "chrf double, ce_mean_words double, bleu_detok double", "append", GroupStateTimeout.ProcessingTimeTimeout if give_up_ms else GroupStateTimeout.NoTimeout)


def windows(events: DataFrame, length: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """(start, event_type, n, total) by tumbling or sliding windows; `late` sets a watermark on streams."""
    e = events.withWatermark("ts", late) if late else events
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    return e.groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "20 minutes", late: str | None = None) -> DataFrame:
    """(user_id, start, n): runs of a user's events without a gap."""
    e = events.withWatermark("ts", late) if late else events
    return e.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")
