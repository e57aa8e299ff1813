"""Folds that open a group wherever a bound is passed, spread over all tasks whatever the number of keys.

A fold is given by two numbers a row, a mark and an anchor: the group that was opened at an anchor ends at the next row
whose mark is at least the anchor plus the limit. Which row opens the next group thus depends on the row that opened this
one alone, and the rows are places with a jump each. Rows are dealt in ranges of key and order. In a range, all jumps are
found by binary search over maxima of marks, and pointer doubling along them says from where the jumps of each place
leave the range. Only keys that span several ranges need more: the places at which a range may be entered, few, are
joined with where they lead to, again by pointer doubling, log2(ranges of a key) joins, and from the places reached
each range is numbered by itself.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from scribemill.operators.tables import stored

#: the mark of a row that ends no group
NEVER = np.iinfo(np.int64).min // 4


def next_at_least(marks: np.ndarray, after: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each pair the first place behind `after` whose mark is at least the bound, or len(marks).

    Maxima of blocks of 1, 2, 4, ... marks: from each place upwards as long as blocks stay below, then down again.
    """
    n = len(marks)
    depth = max(1, int(n + 1).bit_length())
    levels = [np.full(1 << depth, np.iinfo(np.int64).max)]
    levels[0][:n] = marks
    for _ in range(depth):
        levels.append(levels[-1].reshape(-1, 2).max(axis=1))
    at, found = after + 1, np.full(len(after), -1)
    for k, level in enumerate(levels):
        # a block starts at a multiple of its length; the last mark, which is above all bounds, ends every search
        asked = (found < 0) & ((at >> k) & 1 == 1) if k < depth else found < 0
        high = asked & (level[np.minimum(at >> k, len(level) - 1)] >= bounds)
        found[high] = k
        at = np.where(asked & ~high, at + (1 << k), at)
    for k in range(depth - 1, -1, -1):
        below = (found > k) & (levels[k][np.minimum(at >> k, len(levels[k]) - 1)] < bounds)
        at = np.where(below, at + (1 << k), at)
    return np.minimum(at, n)


def last_places(jumps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each place the last one of its jumps inside, and how many lead there, by pointer doubling. A jump to
    len(jumps) leads out."""
    inside = jumps < len(jumps)
    to, hops = np.where(inside, jumps, np.arange(len(jumps))), inside.astype(np.int64)
    while True:
        more = hops[to]
        if not more.any():
            return to, hops
        hops, to = hops + more, to[to]


def openings(marks: np.ndarray, anchors: np.ndarray, limit: int, first: int) -> np.ndarray:
    """The places that open a group, from the place `first` (itself one) on."""
    jumps = next_at_least(marks, np.arange(len(marks)), anchors + limit).tolist()
    out = []
    while first < len(jumps):
        out.append(first)
        first = jumps[first]
    return np.array(out, np.int64)


class Range(NamedTuple):
    """A key's rows within a task, and what is known of those before: how many groups they have opened, and the anchor
    that is open. entry: the row here that opens the next group (-1: to be found, in the key's first range; None: none)."""

    opened: int
    open_at: int
    entry: int | None
    shift: int


def jump_fold(rows: DataFrame, key: str, order: str, inputs: list[str], outputs: str, begin: Callable, step: Callable, numbers: Callable, limit: int, sums: bool) -> DataFrame:
    """rows with new columns from the fold over each key's rows in order.

    begin() -> state and step(state, *inputs) -> (state, mark, anchor, *outputs) do the fold over rows that come one after the
    other; marks and anchors are whole numbers or None. Where `sums`, they are counted from the key's first row of the
    range, and the first group opens at 0; else it opens at the first anchor. numbers(before, opened, open_at, inputs) -> arrays of
    the outputs, for ranges whose key has others: the groups opened before the range, those opened up to each row, itself
    included, and the open anchors. A null key is one. The order is total within a key: rows of equal order may stand in
    any order.
    """
    spark = rows.sparkSession
    names = [x.split()[0] for x in outputs.split(", ")]
    rows = rows.drop(*names)
    fields = [*rows.schema.fields, *_parse_datatype_string(outputs).fields]
    schema = StructType([*fields, *_parse_datatype_string("__range long, __place long, __mark long, __anchor long").fields])
    kinds = {f.name: f.type for f in to_arrow_schema(schema)}
    kept, parts = rows.columns, int(spark.conf.get("spark.sql.shuffle.partitions"))

    def fold(batches):
        from pyspark import TaskContext

        number, held, begun, state, place = (TaskContext.get().partitionId() << 32) - 1, None, False, None, 0
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
            values = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs]
            made = []
            for k, *x in zip(keys, *values, strict=True):
                if not begun or k != held:
                    held, begun, state, place, number = k, True, begin(), 0, number + 1
                state, mark, anchor, *new = step(state, *x)
                made.append((*new, number, place, mark, anchor))
                place += 1
            columns = list(zip(*made, strict=True)) or [()] * (len(schema) - len(kept))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, kinds[f]) for c, f in zip(columns, schema.names[len(kept) :], strict=True))], names=schema.names)

    dealt = stored(rows.repartitionByRange(parts, key, order).sortWithinPartitions(key, order).mapInArrow(fold, schema), "fold")
    last = F.max_by("__mark", "__place") if sums else F.lit(0)
    per = dealt.groupBy(F.col(key).alias("key"), F.col("__range").alias("range")).agg(F.max("__mark").alias("mark"), F.max("__anchor").alias("anchor"), F.min_by("__anchor", F.when(F.col("__anchor").isNotNull(), F.col("__place"))).alias("first"), last.alias("sum"))
    along, before = Window.partitionBy("key").orderBy("range"), Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({"n": F.count("*").over(Window.partitionBy("key")), "seq": F.row_number().over(along) - 1, "chain": F.min("range").over(Window.partitionBy("key")), "shift": F.coalesce(F.sum("sum").over(before), F.lit(0))})
    # of keys in several ranges: two a task at most
    several = sorted((r.asDict() for r in per.where("n > 1").drop("key").collect()), key=lambda r: (r["chain"], r["seq"]))
    if not several:
        return dealt.select(*kept, *names)
    ranges = entered(dealt, several, limit, sums)
    split = [r["range"] for r in several]
    own = dealt.where(~F.col("__range").isin(split)).select(*kept, *names)
    plain = to_arrow_schema(StructType(fields))

    def number(table: pa.Table) -> pa.Table:
        table = table.sort_by("__place")
        r = ranges[table.column("__range")[0].as_py()]
        marks, anchors = columns_of(table, r.shift)
        opened, open_at, first = np.full(len(marks), r.opened), np.full(len(marks), r.open_at), r.entry
        if first == -1:
            first = int(next_at_least(marks, np.array([-1]), np.array([r.open_at + limit]))[0])
        if first is not None and first < len(marks):
            at = openings(marks, anchors, limit, first)
            group = np.searchsorted(at, np.arange(len(marks)), side="right")
            opened, open_at = opened + group, np.where(group > 0, anchors[at[np.maximum(group - 1, 0)]], r.open_at)
        new = numbers(r.opened, opened, open_at, [table.column(c) for c in inputs])
        return pa.Table.from_arrays([*(table.column(c) for c in kept), *(pa.array(x, plain.field(c).type) for c, x in zip(names, new, strict=True))], schema=plain)

    return own.unionByName(dealt.where(F.col("__range").isin(split)).groupBy("__range").applyInArrow(number, StructType(fields)))


def columns_of(table: pa.Table, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Marks and anchors, counted from the key's start."""
    mark, anchor = table.column("__mark"), table.column("__anchor")
    none = mark.combine_chunks().is_null().to_numpy(zero_copy_only=False)
    marks, anchors = (x.combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + shift for x in (mark, anchor))
    return np.where(none, NEVER, marks), anchors


LINKS = "range long, place long, hops long, open_at long, to long, bound long"


def entered(dealt: DataFrame, several: list[dict], limit: int, sums: bool) -> dict[int, Range]:
    """What is known at the start of each range of a key that has several: see `Range`."""
    spark = dealt.sparkSession
    chains: dict[int, list[dict]] = {}
    for r in several:
        chains.setdefault(r["chain"], []).append(r)
    for chain in chains.values():
        base = 0 if sums else next((r["first"] for r in chain if r["first"] is not None), 0)
        highest = base
        for r in chain:
            r["base"], r["known"] = base, highest
            r["mark"] = NEVER if r["mark"] is None else r["mark"] + r["shift"]
            highest = max(highest, NEVER if r["anchor"] is None else r["anchor"] + r["shift"])
    known = {r["range"]: r for r in several}
    follows = {c: (np.array([r["range"] for r in x]), np.array([r["mark"] for r in x], np.int64)) for c, x in chains.items()}

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by("__place")
        r = known[table.column("__range")[0].as_py()]
        marks, anchors = columns_of(table, r["shift"])
        if r["seq"] == 0:
            # the key's first group, opened before its first row
            places = np.array([-1])
            jump = next_at_least(marks, places, np.array([r["base"] + limit]))
        else:
            # groups of other ranges end at a mark above all before it here, and not behind one above all their bounds
            high = np.concatenate([[NEVER], np.maximum.accumulate(marks)[:-1]])
            places = np.flatnonzero((marks > high) & (high < r["known"] + limit))
            jump = places
        to, hops = last_places(next_at_least(marks, np.arange(len(marks)), anchors + limit))
        there = jump < len(marks)
        at = np.where(there, jump, 0)
        open_at = np.where(there, anchors[to[at]], r["base"])
        hops = np.where(there, hops[at] + (r["seq"] == 0), 0)
        ids, highest = follows[r["chain"]]
        bound = open_at + limit
        after = next_at_least(highest, np.full(len(bound), r["seq"]), bound)
        out = np.append(ids, -1)[after]
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in (np.full(len(places), r["range"]), places, hops, open_at, out, bound)], names=["range", "place", "hops", "open_at", "to", "bound"])

    marked = dealt.where(F.col("__range").isin(list(known))).select("__range", "__place", "__mark", "__anchor")
    links = stored(marked.groupBy("__range").applyInArrow(link, LINKS), "links")

    def meet(asked: pa.Table, rows: pa.Table) -> pa.Table:
        """The row of a range that each bound leads to."""
        if not asked.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("range", "place", "to", "into")})
        rows = rows.sort_by("__place")
        r = known[asked.column("to")[0].as_py()]
        marks, _ = columns_of(rows, r["shift"])
        bounds = asked.column("bound").to_numpy()
        into = next_at_least(marks, np.full(len(bounds), -1), bounds)
        return pa.table({"range": asked.column("range"), "place": asked.column("place"), "to": asked.column("to"), "into": pa.array(into, pa.int64())})

    asked = links.where("to >= 0").select("range", "place", "to", "bound")
    jumps = stored(asked.groupBy("to").cogroup(marked.groupBy("__range")).applyInArrow(meet, "range long, place long, to long, into long"), "jumps")
    reached = spark.createDataFrame([(c, -1) for c in chains], "range long, place long")
    turns = (max(map(len, chains.values())) - 1).bit_length()
    for turn in range(turns):
        reached = stored(reached.unionByName(jumps.join(F.broadcast(reached), ["range", "place"]).select(F.col("to").alias("range"), F.col("into").alias("place"))), f"reached-{turn}")
        if turn < turns - 1:
            a, b = jumps.alias("a"), jumps.alias("b")
            twice = a.join(b, (F.col("a.to") == F.col("b.range")) & (F.col("a.into") == F.col("b.place")))
            jumps = stored(twice.select("a.range", "a.place", "b.to", "b.into"), f"jumps-{turn}")
    # one place a range, two ranges a task
    found = {r["range"]: r.asDict() for r in links.join(F.broadcast(reached), ["range", "place"]).collect()}
    out = {}
    for chain in chains.values():
        opened, open_at = 0, chain[0]["base"]
        for r in chain:
            x = found.get(r["range"])
            out[r["range"]] = Range(opened, open_at, x["place"] if x else None, r["shift"])
            if x:
                opened, open_at = opened + x["hops"] + (x["place"] >= 0), x["open_at"]
    return out
