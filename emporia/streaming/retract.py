"""Regular stream joins (J15): no time bound, results corrected by retractions.

A regular join cannot know that a row has no match, only that none has
come yet. It therefore emits a null-padded row first and, when a match
arrives, takes it back and emits the match. Both sides are kept as
multisets in the state store, one entry per distinct row, so a key's rows
are read one after the other and never held together.

The result is a change log: every row carries ``change`` = +n (n more
copies of the row hold) or -n. :func:`fold` adds the changes up to the
join of everything read so far, an upsert sink can apply them as they
come. Inputs may be change logs themselves (a ``change`` column), so
deletes and updates go through and joins can follow each other.

State is unbounded unless ``idle_ms`` is given: then a key that gets no
row for so long (processing time) is forgotten on both sides, without
retractions, as the source jobs' idle state retention does (F11).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from emporia.functions.packing import packed, unpacked

CHANGE = "change"
_OUT = "left_row string, right_row string, change long"


class RetractJoin(StatefulProcessor):
    """Join of one key's rows. Input: ``side`` (0 left, 1 right), ``row`` (JSON), ``change``, ``keyed`` (no key column
    is null: rows without a key match nothing)."""

    def __init__(self, keep: tuple[bool, bool], idle_ms: int | None = None):
        self.keep, self.idle_ms = keep, idle_ms  # keep: rows of that side appear without a match too

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = [handle.getMapState(name, "row string", "n long") for name in ("left_rows", "right_rows")]
        self.total = [handle.getValueState(name, "n long") for name in ("left_total", "right_total")]

    def _held(self, side: int) -> Iterator[tuple[str, int]]:
        for key, value in self.rows[side].iterator():
            yield key[0], value[0]

    def _add(self, side: int, changes: dict[str, int]) -> None:
        for row, n in changes.items():
            have = self.rows[side].getValue((row,))[0] if self.rows[side].containsKey((row,)) else 0
            if have + n:
                self.rows[side].updateValue((row,), (have + n,))
            elif have:
                self.rows[side].removeKey((row,))

    def _side(self, side: int, changes: dict[str, int]) -> Iterator[tuple]:
        """Changes of one side against what the other one holds; then they are stored."""
        other = 1 - side
        totals = [t.get()[0] if t.exists() else 0 for t in self.total]
        after = totals[side] + sum(changes.values())

        def pair(mine: str | None, its: str | None, n: int) -> tuple:
            return (mine, its, n) if side == 0 else (its, mine, n)

        if totals[other]:
            for its, m in self._held(other):
                for mine, n in changes.items():
                    yield pair(mine, its, n * m)
                # The other side's rows lose or get back their null-padded form.
                if self.keep[other] and bool(totals[side]) != bool(after):
                    yield pair(None, its, m if totals[side] else -m)
        elif self.keep[side]:
            for mine, n in changes.items():
                yield pair(mine, None, n)
        self._add(side, changes)
        self.total[side].update((after,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        sums = (Counter(), Counter())
        keyed = True
        for pdf in rows:
            keyed = keyed and bool(pdf["keyed"].iloc[0])
            for side, row, n in zip(pdf["side"].tolist(), pdf["row"].tolist(), pdf[CHANGE].tolist()):
                sums[side][row] += n
        if self.idle_ms and keyed:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        for side in (0, 1):
            changes = {row: n for row, n in sums[side].items() if n}
            if not changes:
                continue
            if keyed:
                out = self._side(side, changes)
            else:
                out = iter([(None, r, n) if side else (r, None, n) for r, n in changes.items()] if self.keep[side] else [])
            yield from _frames(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for state in (*self.rows, *self.total):
            state.clear()
        return iter([])

    def close(self) -> None:
        pass


def _frames(rows: Iterator[tuple], most: int = 10_000) -> Iterator[pd.DataFrame]:
    part = []
    for r in rows:
        part.append(r)
        if len(part) == most:
            yield pd.DataFrame(part, columns=["left_row", "right_row", CHANGE])
            part = []
    if part:
        yield pd.DataFrame(part, columns=["left_row", "right_row", CHANGE])


def _tagged(df: DataFrame, keys: list[str], side: int, names: list[str]) -> DataFrame:
    change = F.col(CHANGE) if CHANGE in df.columns else F.lit(1)
    no_null = F.lit(True)
    for k in keys:
        no_null = no_null & F.col(k).isNotNull()
    return df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.lit(side).alias("side"),
                     packed([c for c in df.columns if c != CHANGE]).alias("row"),
                     change.cast("long").alias(CHANGE), no_null.alias("keyed"))


def regular_join_stream(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "inner",
                        idle_ms: int | None = None) -> DataFrame:
    """J15 on streams: equi-join of two change logs on ``on`` (left column, right column) pairs.

    ``how``: inner, left, right or full. Result: the columns of both sides
    (they must differ in name) and ``change``.
    """
    keep = {"inner": (False, False), "left": (True, False), "right": (False, True), "full": (True, True)}[how]
    cols = [[f for f in df.schema if f.name != CHANGE] for df in (left, right)]
    if clash := {f.name for f in cols[0]} & {f.name for f in cols[1]}:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    names = [f"_k{i}" for i in range(len(on))]
    both = _tagged(left, [a for a, _ in on], 0, names).unionByName(_tagged(right, [b for _, b in on], 1, names))
    joined = both.groupBy(*names).transformWithStateInPandas(
        RetractJoin(keep, idle_ms), _OUT, "append", "ProcessingTime" if idle_ms else "None")

    return joined.select(*unpacked("left_row", cols[0]), *unpacked("right_row", cols[1]), CHANGE)


def fold(changes: DataFrame) -> DataFrame:
    """The rows that hold after all ``changes``, as often as they hold."""
    cols = [c for c in changes.columns if c != CHANGE]
    held = changes.groupBy(*cols).agg(F.sum(CHANGE).alias(CHANGE)).where(F.col(CHANGE) > 0)
    return held.withColumn(CHANGE, F.explode(F.sequence(F.lit(1), F.col(CHANGE).cast("int")))).drop(CHANGE)
