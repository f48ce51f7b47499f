"""Action pairs over a stream of events: the batch bigram operator, kept up to date.

The reference has no streaming; this is an addition for feeds that do not end. Events are
windowed by event time with a watermark, so state is bounded by what may still be late.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_actions(events: DataFrame, delay: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """(start, action, n) of a streaming or batch frame (ts, event_type)."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp"))
    return timed.withWatermark("at", delay).groupBy(F.window("at", window), F.col("event_type").alias("action")).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "action", "n")


PAIRS = "key string, seq long, sequence string"
HELD = "last string, times array<long>, seqs array<long>, actions array<string>"


def action_pairs(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """(key, seq, sequence) of a stream (key, ts, seq, action): each event with the one before it of its key, by (ts, seq).

    A key's state holds its last settled action and the events that the watermark has not passed; a timer at the earliest of them wakes the key when
    the watermark does, so events that come out of order within ``delay`` pair in their own order, each once. Later ones are dropped by the watermark."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", delay).select("key", "at", F.unix_micros("at").alias("micros"), "seq", "action")

    def step(key, frames, state):
        last, held = None, []
        if state.exists:
            last, times, seqs, actions = state.get
            held = list(zip(times, seqs, actions, strict=True))
        for frame in frames:
            held += zip((int(t) for t in frame["micros"]), (int(n) for n in frame["seq"]), frame["action"], strict=True)
        passed = state.getCurrentWatermarkMs() * 1000
        held.sort(key=lambda e: e[:2])
        ready = [e for e in held if e[0] <= passed]
        out = []
        for _, seq, action in ready:
            if last is not None:
                out.append((key[0], seq, f"{last} → {action}"))
            last = action
        held = held[len(ready) :]
        state.update((last, [e[0] for e in held], [e[1] for e in held], [e[2] for e in held]))
        if held:
            state.setTimeoutTimestamp(max(held[0][0] // 1000, passed // 1000 + 1))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in PAIRS.split(", ")])

    return timed.groupBy("key").applyInPandasWithState(step, PAIRS, HELD, "append", "EventTimeTimeout")
