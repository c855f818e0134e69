"""Steps over a key's rows in the order of event time, however the rows arrive.

Rows wait in the state until the watermark passes them and are then handed on in order, so that the result doesn't depend
on how the input is cut into batches, nor on the order of rows that are late by less than the watermark. Waiting rows are
kept as blocks, sorted and bounded in rows, under the time of their first row: what is in memory at a time is one block
and those that overlap it, not all rows of a key. A key that has been idle leaves the state.

Calls of the state and frames cost far more than the few rows that a key has in a batch, so keys share a state: they are
dealt to GROUPS groups by hash, a group's waiting rows are in common blocks, and its keys are walked in plain arrays.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor

from millstream.operators.chunked import helper_columns

#: Rows of a waiting block.
BLOCK = 50_000
#: Groups of keys that share a state. A checkpoint holds for the number it was made with.
GROUPS = 2048
#: Session settings that a query with such a step is started with.
SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
Columns = Mapping[str, np.ndarray]
Step = Callable[[tuple, tuple | None, Columns], tuple[tuple, Columns | pd.DataFrame | None]]


def _packed(rows: pd.DataFrame) -> bytes:
    table, out = pa.Table.from_pandas(rows, preserve_index=False), io.BytesIO()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue()


def _unpacked(block: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(block).read_all().to_pandas()


class _Ordered(StatefulProcessor):
    """State of a group of keys: waiting blocks by the time of their first row, and one tuple with how many blocks there were, the
    timer that is set (0 for none), and a table of the keys seen: the time of the last row and the step's own state of each. One
    timer a group is set, for its first waiting row or the first key that will have been idle."""

    def __init__(self, step: Step, keys: T.StructType, held: T.StructType, order: list[str], columns: list[str], idle_us: int):
        self.step, self.keys, self.order, self.columns, self.idle_us = step, keys.names, order, columns, idle_us
        kept = T.StructType().add("last_us", "long").add("begun", "boolean")
        own = [T.StructField(f"own{i}", f.dataType) for i, f in enumerate(held)]
        self.seen = T.StructType([*keys, *kept, *own])

    def init(self, handle) -> None:
        self.handle = handle
        self.blocks = handle.getMapState("blocks", T.StructType().add("first", "long").add("number", "long"), T.StructType().add("block", "binary"))
        self.state = handle.getValueState("state", T.StructType().add("number", "long").add("timer", "long").add("seen", "binary"))

    def _known(self) -> tuple[int, int, dict[tuple, tuple[int, tuple | None]]]:
        found = self.state.get()
        if found is None:
            return 0, 0, {}
        n = len(self.keys)
        rows = zip(*(c.to_pylist() for c in pa.ipc.open_stream(found[2]).read_all().columns))
        return found[0], found[1], {r[:n]: (r[n], r[n + 2 :] if r[n + 1] else None) for r in rows}

    def _keep(self, number: int, timer: int, seen: dict[tuple, tuple[int, tuple | None]]) -> None:
        none = (None,) * (len(self.seen) - len(self.keys) - 2)
        rows = [(*k, last, own is not None, *(none if own is None else own)) for k, (last, own) in seen.items()]
        schema, out = to_arrow_schema(self.seen), io.BytesIO()
        table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        with pa.ipc.new_stream(out, schema) as writer:
            writer.write_table(table)
        self.state.update((number, timer, out.getvalue()))

    def _wait(self, rows: pd.DataFrame, number: int) -> int:
        """Puts sorted rows into the state as blocks from `number` on."""
        for at in range(0, len(rows), BLOCK):
            part = rows.iloc[at : at + BLOCK]
            self.blocks.updateValue((int(part["event_us"].iloc[0]), number), (_packed(part),))
            number += 1
        return number

    def _by_key(self, rows: pd.DataFrame) -> Iterator[tuple[tuple, Columns]]:
        """The columns of each key's rows, which stay in order."""
        codes = rows.groupby(self.keys, sort=False, dropna=False).ngroup().to_numpy()
        at = np.argsort(codes, kind="stable")
        starts = np.flatnonzero(np.diff(codes[at], prepend=-1))
        known = zip(*(rows[c].iloc[at[starts]].tolist() for c in self.keys))
        columns = {c: rows[c].to_numpy()[at] for c in self.columns}
        for k, a, z in zip(known, starts, [*starts[1:], len(at)]):
            yield k, {c: v[a:z] for c, v in columns.items()}

    def _stepped(self, rows: pd.DataFrame, seen: dict[tuple, tuple[int, tuple | None]]) -> Iterator[pd.DataFrame]:
        """What the step makes of sorted rows, as one frame if any; `seen` gets the new states."""
        found = []
        for k, columns in self._by_key(rows):
            last, own = seen[k]
            own, made = self.step(tuple(None if null else value for value, null in zip(k[::2], k[1::2])), own, columns)
            seen[k] = (last, own)
            if made is not None:
                found.append(made)
        if found and isinstance(found[0], pd.DataFrame):
            yield pd.concat(found)
        elif found:
            yield pd.DataFrame({c: np.concatenate([f[c] for f in found]) for c in found[0]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        number, timer, seen = self._known()
        before, first = number, None
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        for part in rows:
            part = part[part["event_us"] > passed] if passed > 0 else part
            if len(part):
                part = part[[*self.keys, *self.columns]].sort_values(self.order)
                least = int(part["event_us"].iloc[0])
                first = least if first is None else min(first, least)
                for k, columns in self._by_key(part):
                    last, own = seen.get(k, (None, None))
                    most = int(columns["event_us"][-1])
                    seen[k] = (most if last is None else max(last, most), own)
                number = self._wait(part, number)
        if number > before:
            at = -(-first // 1000)
            if not timer or at < timer:
                self.handle.registerTimer(at)
                timer = at
            self._keep(number, timer, seen)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        number, timer, seen = self._known()
        if expiredTimerInfo.getExpiryTimeInMs() != timer:
            return  # an earlier row has set another one since
        every = sorted(self.blocks.keys())
        keys, later = [k for k in every if k[0] <= until], [k[0] for k in every if k[0] > until]
        rest: pd.DataFrame | None = None
        for i, k in enumerate(keys):
            block = _unpacked(self.blocks.getValue(k)[0])
            self.blocks.removeKey(k)
            rest = block if rest is None or not len(rest) else pd.concat([rest, block]).sort_values(self.order)
            # What comes before the next block; rows that share their time with its first one wait for it.
            ready = rest["event_us"] <= until if i + 1 == len(keys) else rest["event_us"] < keys[i + 1][0]
            if ready.any():
                yield from self._stepped(rest[ready], seen)
                rest = rest[~ready]
        if rest is not None and len(rest):
            number = self._wait(rest, number)
            later.append(int(rest["event_us"].iloc[0]))
        # A key with waiting rows has its last row after `until`, and stays.
        seen = {k: kept for k, kept in seen.items() if until < kept[0] + self.idle_us}
        if not seen:
            self.state.clear()
            return
        timer = -(-min([*later, *(last + self.idle_us for last, _ in seen.values())]) // 1000)
        self.handle.registerTimer(timer)
        self._keep(number, timer, seen)

    def close(self) -> None:
        pass


def in_time_order(
    stream: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str], columns: Sequence[str], step: Step, held: str,
    output: str, watermark: str = "1 hour", idle: str = "30 days",
) -> DataFrame:
    """What `step` makes of each key's rows in the order of (ts, tiebreak).

    step(key, held, rows) gets consecutive rows of a key, sorted, as arrays of `event_us` (the time in microseconds), the tiebreaks
    and `columns`, and the tuple it returned for the rows before, None at first or after the key was idle; it returns that
    tuple, of the types `held` (DDL), and the rows of `output` (DDL), as arrays or a frame, or None. Rows later than the watermark are left out, as are
    rows without time. The query must be started with SETTINGS, which keep the state in RocksDB.
    """
    order = ["event_us", *tiebreak]
    sent = [*order, *[c for c in columns if c not in tiebreak]]
    # The time itself stays in the rows for the watermark.
    rows = stream.withWatermark(ts, watermark).filter(F.col(ts).isNotNull()).withColumn("event_us", F.unix_micros(F.col(ts)))
    # Frames rename columns that begin with two underscores.
    helpers = {f"key{n}": c for n, c in helper_columns(rows, keys).items()}
    group = F.pmod(F.xxhash64(*keys), F.lit(GROUPS)).alias("key__group")
    named = rows.select(group, *[c.alias(n) for n, c in helpers.items()], ts, *sent)
    types = T.StructType([named.schema[n] for n in helpers])
    processor = _Ordered(step, types, T.StructType.fromDDL(held), order, sent, pd.Timedelta(idle).value // 1000)
    return named.groupBy("key__group").transformWithStateInPandas(processor, output, "Append", "EventTime")
