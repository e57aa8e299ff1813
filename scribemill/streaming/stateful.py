"""Folds over files whose rows arrive bit by bit: state by file, and a timer that ends it.

A file's rows come in order, in any number of micro-batches. The folds are those of the batch operators, kept as a small
JSON text between batches, so that a file gives the rows that it would give at once. A file ends when the watermark
of its rows' arrival has passed the last of them by `idle`; rows of it that come later begin a file anew.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType, _parse_datatype_string

from scribemill.operators.sequence import CHUNK, Packer

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FileFold(StatefulProcessor):
    """State as JSON and one timer a file. Subclasses say what a row does and what the end of a file gives."""

    outputs = ""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms
        self.named = Row("file_id", *(x.split()[0] for x in self.outputs.split(", ")))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("fold", "state string")

    def begin(self):
        raise NotImplementedError

    def row(self, state, row: Row) -> tuple[object, list[tuple]]:
        raise NotImplementedError

    def end(self, state) -> list[tuple]:
        return []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 - Spark's names
        state = json.loads(self.kept.get()[0]) if self.kept.exists() else self.begin()
        latest = 0
        for row in sorted(rows, key=lambda r: (r["idx"] is not None, r["idx"])):
            latest = max(latest, int(row["arrived"].timestamp() * 1000))
            state, out = self.row(state, row)
            yield from (self.named(key[0], *x) for x in out)
        self.kept.update((json.dumps(state),))
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(latest + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.kept.exists():
            out = self.end(json.loads(self.kept.get()[0]))
            self.kept.clear()
            yield from (self.named(key[0], *x) for x in out)

    def close(self) -> None:
        pass


class Buckets(FileFold):
    """`bucket_spans`: the number and the start of the open bucket."""

    outputs = "idx int, start long, end long, text string, bucket int, since long"

    def __init__(self, idle_ms: int, limit: int):
        super().__init__(idle_ms)
        self.limit = limit

    def begin(self):
        return [0, None]

    def row(self, state, row):
        bucket, anchor = state
        start, end = row["start"], row["end"]
        if start is None or end is None:
            return state, [(row["idx"], start, end, row["text"], bucket, None)]
        anchor = start if anchor is None else anchor
        if end - anchor >= self.limit:
            bucket, anchor = bucket + 1, start
        return [bucket, anchor], [(row["idx"], start, end, row["text"], bucket, end - anchor)]


class Chunks(FileFold):
    """`pack_many`: of each range the chunk being filled and the next one's number; the row last met waits until another
    one shows that it is not the file's last, which goes, as the first does."""

    outputs = CHUNK

    def __init__(self, idle_ms: int, ranges: list[tuple[int, int]], options: dict):
        super().__init__(idle_ms)
        self.ranges, self.options = ranges, options

    def begin(self):
        return {"seen": 0, "held": None, "packers": [[None, 0] for _ in self.ranges]}

    def packed(self, state, act) -> list[tuple]:
        out = []
        for own, kept in zip(self.ranges, state["packers"], strict=True):
            packer = Packer(*own, **self.options, state=kept[0])
            act(packer)
            for chunk in packer.take():
                out.append((*own, kept[1], *chunk))
                kept[1] += 1
            kept[0] = packer.state()
        return out

    def row(self, state, row):
        if row["start"] is None or row["end"] is None:
            return state, []
        out, held = [], state["held"]
        if held is not None:
            out = self.packed(state, lambda p: p.feed(*held))
        if state["seen"] > 0:
            state["held"] = [state["seen"] - 1, row["start"], row["end"], row["text"] or "", bool(row["marked"])]
        state["seen"] += 1
        return state, out

    def end(self, state):
        return self.packed(state, Packer.finish)


def folded(rows: DataFrame, fold: FileFold, late: str) -> DataFrame:
    kind = rows.schema["file_id"].dataType.simpleString()
    schema = _parse_datatype_string(f"file_id {kind}, {fold.outputs}")
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return rows.withWatermark("arrived", late).groupBy("file_id").transformWithState(fold, StructType(schema.fields), "append", "eventTime")


def arriving_buckets(subs: DataFrame, limit: int = 30_000, idle_ms: int = 600_000, late: str = "10 minutes") -> DataFrame:
    """The rows of `bucket_spans` of a stream (file_id, idx, start, end, text, arrived), each once it has arrived."""
    return folded(subs.select("file_id", "idx", "start", "end", "text", "arrived"), Buckets(idle_ms, limit), late)


def arriving_chunks(subs: DataFrame, ranges: list[tuple[int, int]] = ((10_000, 30_000),), idle_ms: int = 600_000, late: str = "10 minutes", **options) -> DataFrame:
    """The chunks of `pack_many` of a stream (file_id, idx, start, end, text, live, duplicate, arrived), each once it is
    full, the last one of a file at its end. Options: surround, flush_marked, exclude, remove."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in subs.columns else F.lit(False)
    rows = subs.select("file_id", "idx", "start", "end", "text", (flag("live") | flag("duplicate")).alias("marked"), "arrived")
    return folded(rows, Chunks(idle_ms, [tuple(x) for x in ranges], options), late)
