"""Lives of entities as a stream with state: changes that aren't allowed are refused, faults wait longer each time, silence is told.

Every entity has one value state: where it is, how often it has failed since it last got through, when it was last heard of. A
row asks for a change; one that the table of transitions doesn't have leaves the state as it is and comes out as refused, for
a side table. A fault's wait doubles with each further one. With ``stale`` a timer on event time tells of an entity that
the feed's watermark has left behind. Rows of a batch are taken in order of seq; a row not beyond the last one is a replay
and changes nothing. lives_batch gives the same rows (but for timers) from a finished table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "key string, seq long, before string, after string, kind string, attempt int, wait_s double"
COLUMNS = ["key", "seq", "before", "after", "kind", "attempt", "wait_s"]
_ROW = Row(*COLUMNS)
STATE = "state string, seq long, attempt int"


class Rules:
    """Transitions by state, which states are faults and which end a run of faults, and the waits after faults."""

    def __init__(self, transitions: dict[str, set[str]], faults: set[str], through: set[str], start: str = "new", first_s: float = 5.0, most_s: float = 480.0) -> None:
        self.transitions, self.faults, self.through, self.start, self.first_s, self.most_s = transitions, faults, through, start, first_s, most_s

    def step(self, state: str, attempt: int, after: str) -> tuple[str, int, str, float | None]:
        """(state, attempt, kind, wait) after a row that asks for a state."""
        if after not in self.transitions.get(state, ()):
            return state, attempt, "refused", None
        if after in self.faults:
            return after, attempt + 1, "fault", min(self.first_s * 2.0**attempt, self.most_s)
        return after, 0 if after in self.through else attempt, "changed", None

    def fold(self, key: str, rows: list[tuple[int, str]], held: tuple[str, int, int] | None) -> tuple[list[tuple], tuple[str, int, int]]:
        state, last, attempt = held or (self.start, -(2**62), 0)
        out = []
        for seq, after in sorted(rows):
            if seq <= last:
                continue
            before = state
            state, attempt, kind, wait = self.step(state, attempt, after)
            out.append((key, seq, before, after, kind, attempt, wait))
            last = seq
        return out, (state, last, attempt)


class Life(StatefulProcessor):
    def __init__(self, rules: Rules, stale_s: float | None) -> None:
        self.rules, self.stale_s = rules, stale_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("life", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        asked, newest = [], 0
        for r in rows:
            asked.append((r.seq, r.state))
            newest = max(newest, r.ms or 0)
        held = self.held.get()
        out, now = self.rules.fold(key[0], asked, tuple(held) if held else None)
        self.held.update(now)
        if self.stale_s is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(newest + self.stale_s * 1000))
        for told in out:
            yield _ROW(*told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state, seq, attempt = self.held.get()
        yield _ROW(key[0], seq, state, state, "stale", attempt, None)

    def close(self) -> None:
        pass


def lives(feed: DataFrame, rules: Rules, late: str = "1 hour", stale_s: float | None = None) -> DataFrame:
    """key, seq, before, after, kind (changed, fault, refused or stale), attempt, wait_s of a stream (key string, seq long, state string, ts timestamp)."""
    feed.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    rows = feed.select("key", "seq", "state", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", late)
    # rows, as a frame for each entity and batch costs more than the few rows in it
    return rows.withColumn("ms", F.unix_millis("ts")).groupBy("key").transformWithState(Life(rules, stale_s), OUT, "append", "EventTime" if stale_s is not None else "None")


def lives_batch(rows: DataFrame, rules: Rules) -> DataFrame:
    """Batch twin of lives() from a table (key, seq, state)."""

    def fold(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(rules.fold(key[0], list(zip(part.seq.tolist(), part.state.tolist(), strict=True)), None)[0], columns=COLUMNS)

    return rows.select("key", "seq", "state").groupBy("key").applyInPandas(fold, OUT)


def idle_stop(cycles: DataFrame, seq: str, changes: str, idle: int) -> DataFrame:
    """The cycles up to the one at which a loop ends that stops after so many cycles without changes in a row (all, if it doesn't)."""
    from funnelspark.operators.ranking import idle_runs

    counted = idle_runs(cycles.withColumn("_active", F.col(changes) > 0), seq, "_active", []).drop("_active")
    end = counted.filter(F.col("idle") >= idle).agg(F.min(seq).alias("_end"))
    return counted.join(F.broadcast(end), F.col("_end").isNull() | (F.col(seq) <= F.col("_end"))).drop("_end")  # one row
