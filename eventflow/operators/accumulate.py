"""Windowed aggregates that the user gives as create, add, merge and result (the AggregateFunction of section 2.10).

For values that Spark's own aggregates do not give (``operators.windows`` has those, in the JVM). A state is a
tuple with typed columns, so partial states travel as plain rows:

1. each task folds its events into one state per (keys, pane of one slide), a bounded number of states at a time
   (``held``), before the only shuffle;
2. the partial states of a (keys, time block) meet in one task, sorted by pane: states of one pane are merged as they
   come, and a sliding window is the merge of its panes by two stacks, one merge a pane and step, although a state
   cannot be subtracted. Rows multiply only into the output.

A task holds the states of one block and the window before it (``block_windows`` windows of panes), whatever the key's
history; a hot key's blocks are many tasks. The shuffle carries at most one state per task, key, pane and ``held``
flush.

Rows without a time are in no window; null and NaN keys are keys; null values reach ``add`` as None; an empty
table has no window. Only windows that hold an event are given.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventflow.functions.time import duration_ms
from eventflow.operators.windows import _shuffle_partitions, _ts_ms

NAN = float("nan")


@dataclass(frozen=True)
class Accumulator:
    """A user's aggregate. ``add`` and ``merge`` give a new state and leave their arguments as they are; ``merge`` is
    associative and commutative."""

    create: Callable[[], tuple]
    add: Callable[[tuple, dict], tuple]  # a state and a row's fields by name
    merge: Callable[[tuple, tuple], tuple]
    result: Callable[[tuple], Any]
    state: str  # DDL of the state's columns, "total long, n long"
    output: str  # type of the result, "double"


def slide_over(panes: Sequence[tuple[int, tuple]], first: int, last: int, size: int, slide: int, merge) -> Iterator[tuple[int, tuple]]:
    """(end, state) of the windows that end from ``first`` to ``last`` and hold one of ``panes`` (end, state; by end).

    ``front`` holds the older panes of the window, each merged with the later ones there, the oldest on top;
    ``back`` the younger ones, with their merge so far. An emptied front takes the back over."""
    front, back, joined, at, end = [], [], None, 0, first
    while end <= last:
        while at < len(panes) and panes[at][0] <= end:
            back.append(panes[at])
            joined = panes[at][1] if joined is None else merge(joined, panes[at][1])
            at += 1
        while front or back:
            if not front:
                total = None
                for p, state in reversed(back):
                    total = state if total is None else merge(state, total)
                    front.append((p, total))
                back, joined = [], None
            if front[-1][0] > end - size:
                break
            front.pop()
        if front:
            yield end, front[-1][1] if joined is None else merge(front[-1][1], joined)
            end += slide
        elif at < len(panes):
            end = panes[at][0]
        else:
            return


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows as tuples, with one NaN, which then equals itself as a member of a tuple."""
    def column(c):
        values = c.to_pylist()
        return [v if v == v else NAN for v in values] if pa.types.is_floating(c.type) else values
    return zip(*(column(c) for c in batch.columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _fold(acc: Accumulator, n_keys: int, fields: list[str], slide: int, held: int, schema: pa.Schema):
    """Events (keys, fields, _t) to a state per (keys, pane end), for at most ``held`` of them at a time."""
    def run(batches):
        states: dict[tuple, tuple] = {}
        for batch in batches:
            for row in _rows(batch):
                key = (*row[:n_keys], row[-1] - row[-1] % slide + slide)
                known = states.get(key)
                if known is None:
                    if len(states) >= held:
                        yield _batch([(*k, *s) for k, s in states.items()], schema)
                        states = {}
                    known = acc.create()
                states[key] = acc.add(known, dict(zip(fields, row[n_keys:-1])))
        yield _batch([(*k, *s) for k, s in states.items()], schema)
    return run


def _windows(acc: Accumulator, n_keys: int, size: int, slide: int, block: int, schema: pa.Schema, out_rows: int = 10_000):
    """Partial states (keys, _block, _end, state), sorted, to the block's windows."""
    def windows(group, panes):
        first = group[-1] * block
        for end, state in slide_over(panes, first, first + block - slide, size, slide, acc.merge):
            yield (*group[:-1], end - size, end, acc.result(state))

    def grouped(batches):
        group, panes = None, []
        for batch in batches:
            for row in _rows(batch):
                if row[:n_keys + 1] != group:
                    if panes:
                        yield group, panes
                    group, panes = row[:n_keys + 1], []
                end, state = row[n_keys + 1], row[n_keys + 2:]
                if panes and panes[-1][0] == end:
                    panes[-1] = (end, acc.merge(panes[-1][1], state))
                else:
                    panes.append((end, state))
        if panes:
            yield group, panes

    def run(batches):
        out = []
        for group, panes in grouped(batches):
            for row in windows(group, panes):
                out.append(row)
                if len(out) >= out_rows:
                    yield _batch(out, schema)
                    out = []
        yield _batch(out, schema)
    return run


def accumulate(df: DataFrame, keys: Sequence[str], ts: str, size, acc: Accumulator, fields: Sequence[str], slide=None,
               out: str = "value", block_windows: int = 8, held: int = 50_000) -> DataFrame:
    """keys..., window_start, window_end (epoch ms), ``out`` of each window; tumbling when ``slide`` is None.

    ``fields`` are the columns that ``add`` sees; only they, the keys and the time are read. The result does not
    depend on ``block_windows`` and ``held``, which bound what a task holds."""
    keys, fields = list(keys), list(fields)
    size_ms = duration_ms(size)
    slide_ms = duration_ms(slide) if slide else size_ms
    if size_ms % slide_ms:
        raise ValueError("pane aggregation needs size to be a multiple of slide")
    block_ms = size_ms * block_windows
    events = df.where(F.col(ts).isNotNull()).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                                                    *[F.col(c).alias(f"_f{i}") for i, c in enumerate(fields)], _ts_ms(df, ts).cast("long").alias("_t"))
    held_keys = [f"_k{i}" for i in range(len(keys))]
    key_fields = events.select(*held_keys).schema.fields
    longs = lambda *names: StructType.fromDDL(", ".join(f"{n} long" for n in names)).fields
    state_fields = [*StructType.fromDDL(acc.state).fields]
    names = [f"_s{i}" for i in range(len(state_fields))]
    for f, n in zip(state_fields, names):
        f.name = n
    partial = StructType([*key_fields, *longs("_end"), *state_fields])
    result = StructType([*key_fields, *longs("window_start", "window_end"), *StructType.fromDDL(f"_out {acc.output}").fields])

    folded = events.mapInArrow(_fold(acc, len(keys), fields, slide_ms, held, to_arrow_schema(partial)), partial)
    first = F.floor(F.col("_end") / F.lit(block_ms))
    last = F.floor((F.col("_end") + F.lit(size_ms - slide_ms)) / F.lit(block_ms))
    routed = folded.withColumn("_block", F.explode(F.array_distinct(F.array(first, last))))
    # The stage after the exchange emits more rows than it reads, so its partition count is pinned.
    routed = routed.repartition(_shuffle_partitions(df), *held_keys, "_block").sortWithinPartitions(*held_keys, "_block", "_end")
    routed = routed.select(*held_keys, "_block", "_end", *names)
    found = routed.mapInArrow(_windows(acc, len(keys), size_ms, slide_ms, block_ms, to_arrow_schema(result)), result)
    return found.select(*[F.col(h).alias(k) for h, k in zip(held_keys, keys)], "window_start", "window_end", F.col("_out").alias(out))
