"""Joins of two streams that answer with a change log.

A regular join of streams has no final rows: a left row without a partner may get one later.
So the join gives operations, "+I" (the row is part of the result) and "-D" (it no longer is),
as soon as rows arrive, and ``replay`` turns the operations seen so far into the result, which
equals the batch join of the rows seen so far. With ``ttl_ms`` a row is forgotten that long
after it was written, by the clock; such a stream never runs out of batches, so it is for
continuous triggers, not for ``availableNow``.

Keys share state in ``GROUPS`` groups by their hash, as packed tables: calls and state reads are
paid a group and micro-batch, not a key or a row. With ``ttl_ms`` a key is a group of its own, so that a row is written
once and its time counts from then.

Both sides come as one stream of (side, k, ord, row): "l" or "r", the join key, an order
(long) and the row as JSON text (``side``); ``rows`` turns results back into columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from tidewater.streaming.processors import fields_of, pack, table_schema, tuples, unpack

IN = "side string, k string, ord long, row string"
OUT = "op string, k string, seq long, l string, r string"
GROUPS = 4096
ROWS = table_schema(fields_of("k string, ord long, row string"))
COUNTS = table_schema(fields_of("k string, seq long"))


def side(df: DataFrame, which: str, key: str, order=None) -> DataFrame:
    """One input of the join; ``which`` is "l" or "r"."""
    return df.select(F.lit(which).alias("side"), F.col(key).cast("string").alias("k"),
                     (F.lit(0) if order is None else order).cast("long").alias("ord"),
                     F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row"))


class ChangelogJoin(StatefulProcessor):
    """Operations of a join by key (``k``; a group may hold many): ``how`` is inner, left, right
    or full. With ``latest`` a side holds a key's row of highest order only (ties: the greater
    text), which replaces the one before."""

    def __init__(self, how: str = "left", latest: bool = False, ttl_ms: int | None = None):
        self.how, self.latest, self.ttl_ms = how, latest, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = {s: handle.getListState(f"rows_{s}", "rows binary", self.ttl_ms)
                      for s in "lr"}
        self.count = handle.getListState("count", "rows binary", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues):
        new = [t for df in rows
               for t in zip(df["side"], df["k"], df["ord"], df["row"], strict=True)]
        touched = {t[1] for t in new}
        all_held: dict = {}
        others: dict = {s: [] for s in "lr"}
        for s in "lr":
            for k, order, row in self._read(self.state[s], ROWS):
                if k in touched:
                    all_held.setdefault(k, {"l": [], "r": []})[s].append((order, row))
                elif self.latest:
                    others[s].append((k, order, row))
        counts = dict(self._read(self.count, COUNTS))
        out: list[tuple] = []
        for s, k, order, row in new:
            ops: list[tuple] = []
            self._add(all_held.setdefault(k, {"l": [], "r": []}), s, (int(order), row), ops)
            at = counts.get(k, 0)
            out += [(op, k, at + i, l, r) for i, (op, l, r) in enumerate(ops)]
            if ops:
                counts[k] = at + len(ops)
        for s in "lr":
            mine = [(k, int(order), row) for t, k, order, row in new if t == s]
            if mine and self.latest:
                self.state[s].put([self._packed(others[s] + [
                    (k, *x) for k in sorted(touched) for x in all_held[k][s]], ROWS)])
            elif mine:
                self.state[s].appendValue(self._packed(mine, ROWS))
        if out:
            self.count.put([self._packed(list(counts.items()), COUNTS)])
            yield pd.DataFrame(out, columns=["op", "k", "seq", "l", "r"])

    @staticmethod
    def _read(state, schema: pa.Schema) -> list[tuple]:
        return [t for (value,) in (state.get() if state.exists() else ())
                for t in tuples(unpack(value, schema))]

    @staticmethod
    def _packed(rows: list[tuple], schema: pa.Schema) -> tuple[bytes]:
        return (pack(pa.table([pa.array(c, f.type) for c, f in
                               zip(zip(*rows, strict=True), schema, strict=True)],
                              schema=schema)),)

    def _add(self, held, s: str, item: tuple, ops: list[tuple]) -> None:
        own, other = held[s], held["r" if s == "l" else "l"]

        def pair(mine, theirs):
            return (mine, theirs) if s == "l" else (theirs, mine)

        keeps_own = self.how in ("full", "left" if s == "l" else "right")
        keeps_other = self.how in ("full", "right" if s == "l" else "left")
        if self.latest and own:
            if item <= own[0]:
                return
            gone = own.pop()[1]
            ops += [("-D", *pair(gone, t)) for _, t in other]
            if not other and keeps_own:
                ops.append(("-D", *pair(gone, None)))
        elif not own and keeps_other:  # the other side's rows were alone
            ops += [("-D", *pair(None, t)) for _, t in other]
        ops += [("+I", *pair(item[1], t)) for _, t in other]
        if not other and keeps_own:
            ops.append(("+I", *pair(item[1], None)))
        own.append(item)

    def close(self) -> None:
        pass


def join_stream(both: DataFrame, how: str = "left", latest: bool = False,
                ttl_ms: int | None = None) -> DataFrame:
    """Operations (op, k, seq, l, r) of the join of both sides (``side``, united). Rows
    without a key match nothing and are not kept: they never leave the batch they came in,
    so use the batch form where such rows must be returned."""
    rows = both.where("k IS NOT NULL")
    if ttl_ms is None:
        group = F.pmod(F.xxhash64("k"), F.lit(GROUPS)).cast("int")
    else:
        group = F.col("k")
    return rows.withColumn("_group", group).groupBy("_group").transformWithStateInPandas(
        ChangelogJoin(how, latest, ttl_ms), OUT, "Append",
        "None" if ttl_ms is None else "ProcessingTime")


def replay(operations: DataFrame) -> DataFrame:
    """k, l, r: the result after all operations, each row as often as it is in it."""
    left = (operations.groupBy("k", "l", "r")
            .agg(F.sum(F.when(F.col("op") == "+I", 1).otherwise(-1)).alias("n")))
    return (left.where("n > 0").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
            .select("k", "l", "r"))


def rows(result: DataFrame, left_schema: str, right_schema: str) -> DataFrame:
    """Columns of both sides of ``replay``; those of a missing side are null."""
    return result.select(F.from_json("l", left_schema).alias("l"),
                         F.from_json("r", right_schema).alias("r")).select("l.*", "r.*")
