"""Streams with state for each key: guarded corrections, keys seen within a retention, and runs within a look-back.

State lives in the query's checkpoint, so it outlasts restarts, and each key's state lives for as long as its time to live says. The
processors need the state store that keeps state outside the heap; start() sees to that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewright.functions.values import LICENCE_RANK
from tidewright.operators.keyed import KEEP, MERGE, PRESERVE, REPLACE, STRICTER
from tidewright.operators.store import RETENTION_DAYS

DAY_MS = 86_400_000
#: Days back that a report on recent runs looks.
LOOK_BACK_DAYS = 30
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _plain(rows: pd.DataFrame) -> list[dict]:
    """The rows with what is missing as None."""
    return rows.astype(object).where(rows.notna(), None).to_dict("records")


def _rank(tag) -> int:
    return LICENCE_RANK.get(tag, max(LICENCE_RANK.values()) + 1)


def merged(had: dict | None, row: dict, policy: dict[str, str], guard: str) -> dict | None:
    """The record after one row, or null if the guard rejects it: what keyed.apply_in_order does for one row at a time."""
    if had is None:
        return {c: None if policy.get(c) == PRESERVE else v for c, v in row.items()}
    if had[guard] is not None and (row[guard] is None or row[guard] < had[guard]):
        return None
    how = {
        REPLACE: lambda new, old: new, MERGE: lambda new, old: old if new is None else new, KEEP: lambda new, old: old, PRESERVE: lambda new, old: old,
        STRICTER: lambda new, old: new if _rank(new) >= _rank(old) else old,
    }
    return {c: how[policy.get(c, REPLACE)](v, had[c]) for c, v in row.items()}


class _Corrections(StatefulProcessor):
    def __init__(self, keys: list[str], schema: T.StructType, order: list[str], policy: dict[str, str], guard: str, ttl_ms: int | None):
        self.keys, self.schema, self.order, self.policy, self.guard, self.ttl = keys, schema, order, policy, guard, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.record = handle.getValueState("record", self.schema, self.ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.schema.names
        had = dict(zip(names, self.record.get(), strict=True)) if self.record.exists() else None
        batch = [r for some in rows for r in _plain(some)]
        batch.sort(key=lambda r: [(r[c] is not None, r[c]) if r[c] is not None else (False,) for c in self.order])
        changed = False
        for row in batch:
            now = merged(had, row, self.policy, self.guard)
            if now is not None:
                had, changed = now, True
        if changed:
            self.record.update(tuple(had[c].to_pydatetime() if isinstance(had[c], pd.Timestamp) else had[c] for c in names))
            yield pd.DataFrame({c: pd.Series([had[c]], dtype=object) for c in names})

    def close(self) -> None:
        pass


def corrected(stream: DataFrame, keys: list[str], order: list[str], guard: str, policy: dict[str, str] | None = None, ttl_days: float | None = None) -> DataFrame:
    """The record of a key, as it stands, whenever rows have changed it. A batch's rows are applied one after another in their order; rows
    that come late, in a later batch or after a restart too, are held against the guard in the key's state. With a time to live a
    key that isn't written for so long is forgotten, and its next row is its first."""
    ttl = None if ttl_days is None else round(ttl_days * DAY_MS)
    processor = _Corrections(keys, stream.schema, order, policy or {}, guard, ttl)
    return stream.groupBy(*keys).transformWithStateInPandas(processor, stream.schema, "Update", "ProcessingTime" if ttl else "None")


class _Seen(StatefulProcessor):
    def __init__(self, ttl_ms: int):
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "yes boolean", self.ttl)

    def handleInputRows(self, key, rows, timerValues):
        first = next(iter(rows)).head(1)
        for _ in rows:
            pass
        if not self.seen.exists():
            self.seen.update((True,))
            yield first

    def close(self) -> None:
        pass


def seen_once(stream: DataFrame, keys: list[str], days: float = RETENTION_DAYS) -> DataFrame:
    """The first row of each key; a key is remembered for so many days after it was first seen."""
    return stream.groupBy(*keys).transformWithStateInPandas(_Seen(round(days * DAY_MS)), stream.schema, "Append", "ProcessingTime")


class _Runs(StatefulProcessor):
    def __init__(self, key: str, at: str, processed: str, retention: int, look_back: int):
        self.key, self.at, self.processed, self.retention, self.look_back = key, at, processed, retention, look_back

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.runs = handle.getMapState("runs", "at long, n long", "processed long")

    def handleInputRows(self, key, rows, timerValues):
        held = {k: v[0] for k, v in self.runs.iterator()}
        for some in rows:
            for r in _plain(some):
                if r[self.at] is not None:
                    n = sum(k[0] == r[self.at] for k in held)  # runs of one second stay apart
                    held[(r[self.at], n)] = r[self.processed]
                    self.runs.updateValue((r[self.at], n), (r[self.processed],))
        if not held:
            return
        last = max(k[0] for k in held)
        for k in [k for k in held if k[0] < last - self.retention]:
            self.runs.removeKey(k)
            del held[k]
        recent = [v for k, v in held.items() if k[0] >= last - self.look_back]
        yield pd.DataFrame({self.key: [key[0]], "last_at": [last], "kept": [len(held)], "recent": [len(recent)], "idle": [sum(not v for v in recent)]})

    def close(self) -> None:
        pass


def recent_runs(stream: DataFrame, key: str, at: str, processed: str, retention_days: int = RETENTION_DAYS, look_back_days: int = LOOK_BACK_DAYS) -> DataFrame:
    """For each job that has run: last_at (epoch seconds), kept (runs that are remembered: none older than the retention, counted from the
    job's last), recent (of these within the look-back) and idle (recent ones that processed nothing)."""
    processor = _Runs(key, at, processed, retention_days * 86400, look_back_days * 86400)
    schema = T.StructType([stream.schema[key], *T._parse_datatype_string("last_at long, kept long, recent long, idle long").fields])
    return stream.groupBy(key).transformWithStateInPandas(processor, schema, "Update", "None")


def start(changes: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None], mode: str = "update", expires: bool = False) -> StreamingQuery:
    """Run a stream with state over what is there, handing each batch of changes on with its number. A stream whose state expires takes
    all that is there as one batch: Spark gives it a batch at every trigger, so it would never be through with what is available."""
    changes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    return changes.writeStream.outputMode(mode).foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**({"once": True} if expires else {"availableNow": True})).start()
