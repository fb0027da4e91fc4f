"""Stateful processors for the streaming forms of the per-key state machines.

Used with ``groupBy(key).transformWithStateInPandas(.., timeMode="EventTime")``. Rows wait in
list state until the watermark has passed them and are then handled in (ts, ...) order, so
neither the order of arrival nor the cut into micro-batches shows in the result. A key holds
the rows of the lateness bound and of one micro-batch; streams bound the latter by files per
trigger. Rows travel to and from the state as packed tables, not one by one. Days follow the
zone that the caller gives.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from datetime import datetime
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

DAY_MS = 86_400_000
FLAT_COLS = ["mid", "ts", "offset", "last_page_id", "vc", "ch", "ar", "is_new",
             "during_time", "event_time"]
FLAT_SCHEMA = ("mid string, ts long, offset long, last_page_id string, vc string, "
               "ch string, ar string, is_new string, during_time long, event_time timestamp")


def fields_of(schema: str) -> list[tuple[str, str]]:
    """(name, type) of each column of a schema text, event_time left out."""
    out = [tuple(c.split()) for c in schema.split(",")]
    return [(n, t) for n, t in out if n != "event_time"]


def day_of(ts_ms: int, zone: str) -> int:
    """Days since 1970-01-01 of an epoch-ms time in a zone."""
    if zone == "UTC":
        return ts_ms // DAY_MS
    return datetime.fromtimestamp(ts_ms / 1000, ZoneInfo(zone)).toordinal() - 719_163


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def table_schema(fields: list[tuple[str, str]]) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in fields])


def pack(rows: pa.Table) -> bytes:
    """A table, which has rows, as one compressed value; the schema is known to the reader."""
    raw = rows.combine_chunks().to_batches()[0].serialize()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(value: bytes, schema: pa.Schema) -> pa.Table:
    raw = pa.decompress(bytes(value[8:]), int.from_bytes(value[:8], "little"), codec="zstd")
    return pa.Table.from_batches([pa.ipc.read_record_batch(raw, schema)])


def tuples(rows: pa.Table) -> list[tuple]:
    return list(zip(*[c.to_pylist() for c in rows.columns], strict=True))


GROUPS = 4096
PARTS = 16  # of what a group remembers: those that a micro-batch does not touch stay as they are


def group_of(key: str) -> Column:
    """The group of a key that shares its waiting rows and timers with others."""
    return F.pmod(F.xxhash64(key), F.lit(GROUPS)).cast("int")


def parts_of(keys: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.fromiter((zlib.crc32(str(k).encode("utf-8", "surrogatepass")) % PARTS
                        for k in keys.to_pylist()), np.int64, len(keys))


class GroupedProcessor(StatefulProcessor):
    """Hands each key's rows to ``step`` in event order, behind the watermark. Rows come in
    groups of keys (``group_of``), as streams have very many keys with few rows each: a group
    shares the waiting rows and the timers, and what its keys remember is kept in ``PARTS``
    packed tables, so calls are paid a group and not a key or a row. ``steps`` handles all
    keys of a group at once; a processor overrides it where columns can be worked on whole."""

    state_schema = ""

    def __init__(self, schema: str, sort: list[str], key: str, zone: str = "UTC"):
        self.fields = fields_of(schema)
        self.names = [n for n, _ in self.fields]
        self.at = {n: i for i, n in enumerate(self.names)}
        self.sort = sort
        self.zone = zone
        self.key = self.at[key]
        self.key_type = self.fields[self.key][1]
        self.out_cols = [c.split()[0] for c in schema.split(",")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.schema = table_schema(self.fields)
        # What a key remembers, and the time at which it must be seen again though no row of
        # it comes.
        self.kept_schema = table_schema([("_k", self.key_type), *fields_of(self.state_schema),
                                         ("_at", "long")])
        self.waiting = handle.getListState("waiting", "low long, rows binary")
        self.kept = handle.getMapState("kept", "part int", "rows binary")
        self.due = handle.getListState("due", "part int, at long")

    def step(self, rows: list[tuple], held: tuple | None,
             watermark: int) -> tuple[list[tuple], tuple | None, int | None]:
        """Rows to emit, what the key remembers now (None: nothing), and the time at which it
        must be seen again, given a key's next rows in order and what it remembers."""
        raise NotImplementedError

    def steps(self, rows: pa.Table, held: pa.Table,
              watermark: int) -> tuple[pd.DataFrame | None, pa.Table]:
        """Rows to emit and what is remembered now, given the next rows of several keys in
        order and what these and others remember."""
        before = {k: (tuple(state), at) for k, *state, at in tuples(held)}
        by_key: dict = {k: [] for k, (_, at) in before.items()
                        if at is not None and at <= watermark}
        for r in tuples(rows):
            by_key.setdefault(r[self.key], []).append(r)
        out: list[tuple] = []
        for k, own in by_key.items():
            emitted, now, at = self.step(own, before.pop(k, (None, None))[0], watermark)
            out += emitted
            if now is not None:
                before[k] = (now, at)
        cols = list(zip(*[(k, *state, at) for k, (state, at) in before.items()], strict=True))
        now = pa.table([pa.array(c, f.type) for c, f in
                        zip(cols or [[]] * len(self.kept_schema), self.kept_schema, strict=True)],
                       schema=self.kept_schema)
        return (self.output(out) if out else None), now

    def output(self, out: list[tuple]) -> pd.DataFrame:
        df = pd.DataFrame(out, columns=self.names)
        df["event_time"] = pd.to_datetime(df["ts"], unit="ms")
        return df[self.out_cols]

    def framed(self, out: pa.Table) -> pd.DataFrame | None:
        if not out.num_rows:
            return None
        df = out.to_pandas(integer_object_nulls=True)
        df["event_time"] = pd.to_datetime(df["ts"], unit="ms")
        return df[self.out_cols]

    def coded(self, rows: pa.Table, held: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Different keys (null is one), and which of them each row and each held key is."""
        keys = pa.concat_arrays([held.column("_k").combine_chunks(),
                                 rows.column(self.key).combine_chunks()])
        d = keys.dictionary_encode(null_encoding="encode")
        which = d.indices.to_numpy()
        return d.dictionary, which[held.num_rows:], which[:held.num_rows]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues):
        first = None
        for df in rows:
            if len(df):
                new = pa.Table.from_pandas(df[self.names], self.schema, preserve_index=False)
                if new.column("ts").null_count:
                    raise ValueError("a row without a time has no place in event order")
                low = pc.min(new.column("ts")).as_py()
                self.waiting.appendValue((low, pack(new)))
                first = low if first is None else min(first, low)
        if first is not None:
            self.handle.registerTimer(first + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs()
        ready, rest = [], []
        for low, value in (self.waiting.get() if self.waiting.exists() else ()):
            if low >= watermark:
                rest.append((low, value))
                continue
            t = unpack(value, self.schema)
            past = pc.less(t.column("ts"), watermark)
            ready.append(t.filter(past))
            t = t.filter(pc.invert(past))
            if t.num_rows:
                rest.append((pc.min(t.column("ts")).as_py(), pack(t)))
        if ready and rest:
            self.waiting.put(rest)
            self.handle.registerTimer(min(low for low, _ in rest) + 1)
        elif ready:
            self.waiting.clear()
        due = {p: at for p, at in self.due.get()} if self.due.exists() else {}
        now = pa.concat_tables(ready) if ready else self.schema.empty_table()
        touched = {p for p, at in due.items() if at <= watermark}
        if now.num_rows:
            now = now.take(pc.sort_indices(now, [(c, "ascending") for c in self.sort],
                                           null_placement="at_start"))
            touched |= set(parts_of(pc.unique(now.column(self.key))).tolist())
        if touched:
            out = self._advance(now, sorted(touched), due, watermark)
            if out is not None:
                yield out

    def _advance(self, rows: pa.Table, touched: list[int], due: dict[int, int],
                 watermark: int) -> pd.DataFrame | None:
        values = {p: self.kept.getValue((p,)) for p in touched}
        held = pa.concat_tables([self.kept_schema.empty_table(),
                                 *[unpack(v[0], self.kept_schema) for v in values.values()
                                   if v is not None]])
        out, now = self.steps(rows, held, watermark)
        of = parts_of(now.column("_k"))
        before = dict(due)
        for p in touched:
            mine = now.take(np.flatnonzero(of == p))
            due.pop(p, None)
            if mine.num_rows:
                value = pack(mine)
                if values[p] is None or bytes(values[p][0]) != value:
                    self.kept.updateValue((p,), (value,))
                at = pc.min(mine.column("_at")).as_py()
                if at is not None:
                    due[p] = at
            elif values[p] is not None:
                self.kept.removeKey((p,))
        if due:
            if due != before:
                self.due.put(list(due.items()))
            self.handle.registerTimer(min(due.values()))
        elif before:
            self.due.clear()
        return out

    def close(self) -> None:
        pass


class DailyFirstProcessor(GroupedProcessor):
    """First row of every (key, day) (T8 and the other "last active day" states). The day
    last emitted is forgotten once the watermark is two days past its start."""

    state_schema = "day long"

    def __init__(self, zone: str = "UTC"):
        super().__init__(FLAT_SCHEMA, ["ts", "offset"], "mid", zone)

    def step(self, rows, held, watermark):
        last = None if held is None else held[0]
        out = []
        for r in rows:
            d = day_of(r[self.at["ts"]], self.zone)
            if d != last:
                out.append(r)
                last = d
        if last is None or not out and watermark >= (last + 3) * DAY_MS:
            return out, None, None  # no row of that day or the day after can still come
        return out, (last,), (last + 3) * DAY_MS


class JumpProcessor(GroupedProcessor):
    """Bounced session starts (T9): a session start is emitted when the next row is another
    session start, or when no row follows within ``within_ms``; it is dropped when another
    page follows in time."""

    def __init__(self, within_ms: int = 10_000):
        super().__init__(FLAT_SCHEMA, ["ts", "offset"], "mid")
        self.within_ms = within_ms
        self.state_schema = ", ".join(f"{n} {t}" for n, t in self.fields)

    def step(self, rows, held, watermark):
        ts, page = self.at["ts"], self.at["last_page_id"]
        pending, out = held, []
        for r in rows:
            if pending is not None and (r[page] is None
                                        or r[ts] - pending[ts] >= self.within_ms):
                out.append(pending)
            pending = r if r[page] is None else None
        if pending is not None and watermark >= pending[ts] + self.within_ms:
            out.append(pending)
            pending = None
        if pending is None:
            return out, None, None
        return out, pending, pending[ts] + self.within_ms


class NewFlagProcessor(GroupedProcessor):
    """Repair ``is_new`` per device (T2): the first record fixes an anchor day (its own
    day when it claims new, else the day before); later '1' records on another day
    become '0'. The anchor is never changed, as in the reference (no TTL)."""

    state_schema = "day long"

    def __init__(self, zone: str = "UTC"):
        super().__init__(FLAT_SCHEMA, ["ts", "offset"], "mid", zone)

    def step(self, rows, held, watermark):
        anchor = None if held is None else held[0]
        flag, out = self.at["is_new"], []
        for r in rows:
            d = day_of(r[self.at["ts"]], self.zone)
            if anchor is None:
                anchor = d if r[flag] == "1" else d - 1
            fixed = "0" if r[flag] == "1" and d != anchor else r[flag]
            out.append((*r[:flag], fixed, *r[flag + 1:]))
        return out, (anchor,), None


ARRIVAL_SCHEMA = "mid string, ts long, offset long, is_new string, value string"


class ArrivalFlagProcessor(StatefulProcessor):
    """Repair ``is_new`` per device as records arrive (T2 in front of the log outputs): no
    record waits and none is late. The anchor day comes from the least record by (ts, offset,
    value) of the first micro-batch that has the device, and is never changed. Only that
    micro-batch's records of a device are held together."""

    def __init__(self, zone: str = "UTC"):
        self.zone = zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.anchor = handle.getValueState("anchor", "day long")

    def _days(self, ts: pd.Series) -> pd.Series:
        ts = ts.astype("int64")
        return ts // DAY_MS if self.zone == "UTC" else ts.map(lambda t: day_of(t, self.zone))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues):
        held = self.anchor.get()
        if held is None:
            rows = [f for f in rows if len(f)]
            if not rows:
                return
            first = pd.concat([f[["ts", "offset", "value", "is_new"]] for f in rows]).sort_values(
                ["ts", "offset", "value"]).iloc[0]
            anchor = day_of(int(first["ts"]), self.zone) - int(first["is_new"] != "1")
            self.anchor.update((anchor,))
        else:
            anchor = held[0]
        for f in rows:
            wrong = (f["is_new"] == "1") & (self._days(f["ts"]) != anchor)
            yield f.assign(is_new=f["is_new"].mask(wrong, "0"))[
                ["mid", "ts", "offset", "is_new", "value"]]

    def close(self) -> None:
        pass


LOGIN_IN = "uid string, ts long, offset long, event_time timestamp"
LOGIN_SCHEMA = ("uid string, ts long, offset long, event_time timestamp, dt string, "
                "uu_ct long, back_ct long")


class LoginProcessor(GroupedProcessor):
    """First login of every (user, day), flagged back-flow when the previous login day
    is ``back_days`` or more whole days earlier (T4). No TTL, as in the reference."""

    state_schema = "day long"

    def __init__(self, back_days: int = 8, zone: str = "UTC"):
        super().__init__(LOGIN_IN, ["ts", "offset"], "uid", zone)
        self.back_days = back_days

    def step(self, rows, held, watermark):
        last = None if held is None else held[0]
        out = []
        for r in rows:
            d = day_of(r[self.at["ts"]], self.zone)
            if d != last:
                back = int(last is not None and d - last >= self.back_days)
                out.append((*r, datetime.fromordinal(d + 719_163).strftime("%Y-%m-%d"), 1, back))
                last = d
        return out, None if last is None else (last,), None

    def output(self, out):
        df = pd.DataFrame(out, columns=[*self.names, "dt", "uu_ct", "back_ct"])
        df["event_time"] = pd.to_datetime(df["ts"], unit="ms")
        return df[["uid", "ts", "offset", "event_time", "dt", "uu_ct", "back_ct"]]


class GapProcessor(GroupedProcessor):
    """Rows that start a new burst of their key (T1b): emitted when no row of the key
    came in the previous ``gap_ms`` (the reference's state TTL is refreshed by every
    read). The last time is forgotten when the watermark is ``gap_ms`` past it."""

    state_schema = "last long"

    def __init__(self, gap_ms: int, schema: str, sort: list[str], key: str):
        super().__init__(schema, sort, key)
        self.gap_ms = gap_ms

    def steps(self, rows, held, watermark):
        keys, code, held_code = self.coded(rows, held)
        last, seen = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        last[held_code], seen[held_code] = held.column("last").to_numpy(), True
        order = np.argsort(code, kind="stable")  # by key, in event order
        code, ts = code[order], rows.column("ts").to_numpy()[order]
        head = np.r_[True, code[1:] != code[:-1]][:len(code)]
        before, known = np.r_[0, ts[:-1]][:len(ts)], ~head
        before[head], known[head] = last[code[head]], seen[code[head]]
        out = rows.take(np.sort(order[~known | (ts - before >= self.gap_ms)]))
        tail = np.r_[code[1:] != code[:-1], True][:len(code)]
        last[code[tail]] = ts[tail]
        keep = np.flatnonzero(watermark < last + self.gap_ms)
        return self.framed(out), pa.table(
            [keys.take(pa.array(keep)), pa.array(last[keep]), pa.array(last[keep] + self.gap_ms)],
            schema=self.kept_schema)
