"""Operators on subtitle streams: rows (file_id, idx, start, end, text) in the order of idx within a file.

All times are whole milliseconds. What has a closed form is windows over the file; chunk packing, which has none, is a
fold over one file's rows at a time.

Tables without rows give none, equal rows are rows of their own, further columns play no part and, where an operator
adds to the rows it gets, stay; what an operator does with nulls and ties is said where it is not that of Spark's
windows (nulls first, ties in any order).
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from scribemill.operators.folds import jump_fold
from scribemill.operators.seen import SeenTexts
from scribemill.operators.tables import stored

SILENCE = "<|silence|>"


def by_file(file: str = "file_id", idx: str = "idx") -> Window:
    return Window.partitionBy(file).orderBy(idx)


def digest(text: Column) -> Column:
    """The SHA-256 of a text, in bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def fuse(subs: DataFrame, renumbered: bool = True) -> DataFrame:
    """Runs of equal text become one subtitle, from the first start to the last end; those not longer than 0 go. idx is
    new; not `renumbered`, it is that of the run's first row, and what follows in its order needs no other sort."""
    w = by_file()
    new = (F.row_number().over(w) == 1) | ~F.col("text").eqNullSafe(F.lag("text").over(w))
    last = F.lead(F.lit(1)).over(w).isNull() | ~F.col("text").eqNullSafe(F.lead("text").over(w))
    ends = subs.select("file_id", "idx", "start", "end", "text", new.alias("new"), last.alias("last")).where(F.col("new") | F.col("last"))
    # the next one behind a first row that is not the last is the last row of its run
    out = ends.withColumn("end", F.when(F.col("last"), F.col("end")).otherwise(F.lead("end").over(w))).where("new").where(F.col("end") > F.col("start"))
    idx = (F.row_number().over(w) - 1).cast("int").alias("idx") if renumbered else F.col("idx")
    return out.select("file_id", idx, "start", "end", "text")


def fill_silence(subs: DataFrame, lead_in: bool = True, silence: str | Column = SILENCE) -> DataFrame:
    """A silence wherever a subtitle does not start at the end of the one before (an overlap gives a negative one);
    with lead_in the stream starts at 0, else at its first start. Adds duration and is_silence; idx is new, from 0.
    silence: its text, or what stands for it where texts are digests."""
    w, silence = by_file(), F.lit(silence)
    before = F.lag("end").over(w)
    before = F.coalesce(before, F.lit(0).cast("long") if lead_in else F.col("start"))
    rows = subs.withColumn("before", before).withColumn("gap", F.coalesce(F.col("before") != F.col("start"), F.lit(False)))
    at = (F.row_number().over(w) - 1 + F.sum(F.col("gap").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).cast("int")
    part = lambda at, start, end, text: F.struct(at.alias("idx"), start.alias("start"), end.alias("end"), text.alias("text"))
    own = part(F.col("at"), F.col("start"), F.col("end"), F.col("text"))
    gap = F.when(F.col("gap"), part(F.col("at") - 1, F.col("before"), F.col("start"), silence))
    rows = rows.withColumn("at", at).select("file_id", F.explode(F.array_compact(F.array(gap, own))).alias("x")).select("file_id", "x.*")
    return rows.select("file_id", "idx", "start", "end", (F.col("end") - F.col("start")).alias("duration"), "text", (F.col("text") == silence).alias("is_silence"))


def mark_live(subs: DataFrame) -> DataFrame:
    """Adds live: text that grows word by word, as live captions do. A row grows if its text begins with the text before
    it; three of the rows around it (three before, three after) must grow. Files of six rows or fewer have none."""
    w, n = by_file(), 3
    at, size = F.row_number().over(w) - 1, F.count("*").over(Window.partitionBy("file_id"))
    rows = subs.withColumns({"at": at, "size": size, "c": F.coalesce(F.startswith(F.col("text"), F.lag("text").over(w)), F.lit(False)).cast("int")})
    rows = rows.withColumn("c", F.when(F.col("at") == 0, 0).otherwise(F.col("c")))
    after = F.coalesce(F.lead("c").over(w), F.lit(0))
    rows = rows.withColumn("m", F.when(F.col("at") >= n, F.greatest("c", after)).otherwise(F.col("c")))
    first = [F.max(F.when(F.col("at") == k, F.col("c"))).over(Window.partitionBy("file_id")) for k in range(6)]
    first = [F.coalesce(x, F.lit(0)) for x in first]
    warm = F.col("at") < n
    before = F.when(warm, first[0] + first[1] + first[2]).otherwise(F.coalesce(F.sum("m").over(w.rowsBetween(-n, -1)), F.lit(0)))
    own = F.when(warm, F.when(F.col("at") == 0, first[3]).otherwise(F.greatest(first[3], first[4]))).otherwise(F.col("m"))
    foll = F.when(F.col("at") == 0, 0).when(F.col("at") == 1, first[4]).when(F.col("at") == 2, first[4] + first[5]).otherwise(F.coalesce(F.sum("c").over(w.rowsBetween(1, n)), F.lit(0)))
    rows = rows.withColumns({"before": before, "own": own, "foll": foll})
    ends = (F.col("before") == n) & (F.col("own") == 0) & (F.col("foll") == 0)
    live = (F.col("size") > 2 * n) & ~ends & (F.col("before") + F.col("own") + F.col("foll") >= n)
    return rows.withColumn("live", live).select(*subs.columns, "live")


#: a text that more than one in so many rows have is frequent
FREQUENT = 1000
#: bytes of frequent texts that are broadcast
FREQUENT_BYTES = 16 << 20


def with_first_places(subs: DataFrame, first: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """subs with `first` of their text, null where it has none, from rows (*keys, first, n) of texts; text: its column, or
    that of its digest.

    The few texts that one in FREQUENT of the rows counted there or more have meet their rows by a broadcast, if they are not too long for it;
    rows of these go through the join of all others under keys that no text has, spread over its tasks.
    """
    total = first.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = first.where(F.col("n") * FREQUENT > total)
    size = often.agg(F.coalesce(F.sum(F.octet_length(text) + 64), F.lit(0))).first()[0]
    names = [f"__{k}" for k in keys]
    equal = lambda left, right: functools.reduce(lambda a, b: a & b, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)))
    if size > FREQUENT_BYTES:
        renamed = first.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), "first")
        return subs.join(renamed, equal(keys, names), "left").drop(*names)
    of_often = often.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.col("first").alias("__often"))
    rows = subs.join(F.broadcast(of_often), equal(keys, names), "left").drop(*names)
    spread = F.concat(F.lit("\x00" * 33), F.xxhash64("file_id", "idx").cast("string")).cast(subs.schema[text].dataType)
    rows = rows.withColumn("__asked", F.when(F.col("__often").isNotNull(), spread).otherwise(F.col(text)))
    seldom = first.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.col("first").alias("__seldom"))
    asked = ["__asked" if k == text else k for k in keys]
    rows = rows.join(seldom, equal(asked, names), "left")
    return rows.withColumn("first", F.coalesce("__often", "__seldom")).drop("__often", "__seldom", "__asked", *names)


def mark_duplicates(subs: DataFrame, lookback: int = 4, scope: str = "global", offset: bool = True, seen: SeenTexts | None = None, run: str = "", digests: DataFrame | None = None) -> DataFrame:
    """Adds duplicate: runs of at least `lookback` rows whose text was met before, in the file or (scope global) in a
    file of a lower file_id. With `offset` the mark stands one row early, as far as the last `lookback` rows of the
    file, and from its first row goes round to its last; without it, on the run itself. `seen` holds the texts of
    earlier runs (of lower `run`), which count as met before (scope global).

    Whether a text was met before is a matter of the first (file_id, idx) of the text, which is aggregated before the
    rows meet it, so that a frequent text does not stand in one task; places of texts that one row alone has meet no
    other. Texts are met by their SHA-256, and the rows themselves move by file only: a file's marks come to them as one
    array. `digests`: the same rows again as (file_id, idx, digest), for whoever can make them without moving the texts;
    idx then numbers the rows of each file from 0.
    """
    if seen is not None and scope != "global":
        raise ValueError("texts of earlier runs count in all files")
    key, numbered = digest(F.col("text")), digests is not None
    places = subs.select("file_id", "idx", key.alias("__key")) if digests is None else digests.select("file_id", "idx", F.col("digest").alias("__key"))
    places = stored(places, "places")
    keys = ["__key"] if scope == "global" else ["file_id", "__key"]
    if seen is not None:
        first = seen.marked(subs.groupBy("text").agg(F.min(F.struct("file_id", "idx")).alias("first"), F.count("*").alias("n")), run).select(key.alias("__key"), "first", "n")
    else:
        first = places.groupBy(*keys).agg(F.struct(F.lit(False).alias("earlier"), F.min(F.struct("file_id", "idx")).alias("x")).alias("first"), F.count("*").alias("n"))
        first = first.where("n > 1").withColumn("first", F.struct("first.earlier", "first.x.*"))
    rows = with_first_places(places, stored(first, "first-places"), keys, "__key")
    w, whole = Window.partitionBy("file_id").orderBy("idx", *[] if numbered else ["__key"]), Window.partitionBy("file_id")
    rows = rows.withColumn("seen", F.when(F.col("first").isNull(), False).otherwise(F.col("first.earlier") | (F.struct("first.file_id", "first.idx") < F.struct("file_id", "idx"))))
    rows = rows.withColumns({"at": F.row_number().over(w) - 1, "size": F.count("*").over(whole), "run": F.sum((~F.col("seen")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))})
    of_run = Window.partitionBy("file_id", "run", "seen")
    long = F.col("seen") & (F.count("*").over(of_run) >= lookback)
    rows = rows.withColumn("long", long)
    if not offset:
        return with_marks(subs, rows, F.col("long"), numbered)
    wraps = F.coalesce(F.max(F.col("long") & (F.col("at") == 0)).over(whole), F.lit(False))
    shifted = F.coalesce(F.lead("long").over(w), F.lit(False))
    tail = F.col("long") & (F.col("at") >= F.col("size") - lookback)
    rows = rows.withColumns({"wraps": wraps, "shifted": shifted, "tail": tail})
    mark = F.col("shifted") | F.col("tail") | (F.col("wraps") & (F.col("at") == F.col("size") - 1))
    return with_marks(subs, rows, mark, numbered)


def with_marks(subs: DataFrame, rows: DataFrame, mark: Column, numbered: bool) -> DataFrame:
    """subs with duplicate: the mark of the row at the same place of the file, which idx is where rows are `numbered`; else
    places are in the order of idx and digest. Rows of a null file are one file's."""
    rows, marks = rows.withColumn("mark", mark), F.transform(F.array_sort(F.collect_list(F.struct("at", "mark"))), lambda x: x["mark"])
    # an equality that nulls take part in would deal out the rows of all files anew
    of_file = rows.where("file_id is not null").groupBy(F.col("file_id").alias("__file")).agg(marks.alias("__marks"))
    of_null = rows.where("file_id is null").agg(marks.alias("__of_null"))
    at = F.col("idx") if numbered else F.row_number().over(Window.partitionBy("file_id").orderBy("idx", digest(F.col("text")))) - 1
    out = subs.withColumn("__at", at).join(of_file, F.col("file_id") == F.col("__file"), "left").crossJoin(F.broadcast(of_null))
    return out.select(*subs.columns, F.get(F.when(F.col("file_id").isNull(), F.col("__of_null")).otherwise(F.col("__marks")), F.col("__at")).alias("duplicate"))


CHUNK = "least int, most int, chunk int, start long, end long, duration long, text string, text_timestamps string, sub_ids array<int>"


def _clock(ms: int) -> str:
    return f"<{ms // 20 * 20 // 1000}.{ms // 20 * 20 // 10 % 100:02d}>"


class Packer:
    """The chunk being filled: pieces (start, end, text) relative to it, and the ids of its subtitles; chunks that are
    done come out of `take`. What `state` gives goes on where this packer stands, as the last argument of another one."""

    def __init__(self, least: int, most: int, surround: bool = True, flush_marked: bool = True, exclude: tuple = (), remove: tuple = (), state: list | None = None):
        self.least, self.most, self.surround, self.flush_marked, self.exclude, self.remove = least, most, surround, flush_marked, exclude, remove
        self.done = []
        self.pieces, self.ids, self.total, self.start, self.end = state or ([], [], 0, 0, 0)

    def state(self) -> list:
        return [self.pieces, self.ids, self.total, self.start, self.end]

    def clear(self):
        self.pieces, self.ids, self.total, self.start, self.end = [], [], 0, 0, 0

    def add(self, i: int, start: int, end: int, duration: int, text: str):
        if not self.pieces:
            self.start = start
        self.end = end
        self.pieces.append((self.total, self.total + duration, text))
        self.ids.append(i)
        self.total += duration

    def emit(self):
        spoken = [p for p in self.pieces if p[2] != SILENCE]
        text = " ".join(p[2] for p in spoken)
        if text:
            marked = "".join(f"{_clock(a)}{t.replace(chr(10), ' ')}{_clock(b)}" for a, b, t in spoken)
            self.done.append((self.start, self.end, self.total, text, marked, list(self.ids)))

    def feed(self, i: int, start: int, end: int, text: str, marked: bool):
        """Take the next subtitle."""
        duration, silent = end - start, text == SILENCE
        i = -i if silent else i
        for pattern in self.remove:
            text = re.sub(pattern, "", text)
        barred = any(x in text for x in self.exclude)
        if self.flush_marked and marked:
            self.finish()
            self.clear()
            return
        if duration + self.total > self.most or barred:
            if silent:
                if self.surround:
                    room = self.most - self.total
                    self.add(i, start, start + room, room, SILENCE)
                    start, duration = start + room, duration - room
                self.emit()
                self.clear()
                full = max(0, -(-duration // self.most) - 1)  # silent chunks of the full length, which are dropped
                start, duration = start + full * self.most, duration - full * self.most
            else:
                self.emit()
                self.clear()
                if barred:
                    return
        if self.surround or (not self.pieces and not silent):
            self.add(i, start, end, duration, text)

    def finish(self):
        """The last chunk, if it is long enough."""
        if self.total >= self.least:
            self.emit()

    def take(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def pack(rows: list[tuple], least: int, most: int, surround: bool = True, flush_marked: bool = True, exclude: tuple = (), remove: tuple = ()) -> list[tuple]:
    """Chunks of one file's rows (id, start, end, text, marked): see pack_chunks."""
    packer = Packer(least, most, surround, flush_marked, exclude, remove)
    for row in rows:
        packer.feed(*row)
    packer.finish()
    return packer.take()


def by_key(rows: DataFrame, key: str, order: str, inputs: list[str], outputs: str, fold) -> DataFrame:
    """fold(rows of one key, in order) -> rows of outputs; the key goes before them.

    Rows are dealt by key and sorted by it in Spark, which costs nothing where they are already, and pass through a task
    as a stream that holds one key's rows at a time and puts them in order, of a whole number. Ties stand in any order,
    nulls first; rows of a null key are one key's.
    """
    names = [key, *(x.split()[0] for x in outputs.split(", "))]
    kind = rows.schema[key].dataType
    schema = StructType([StructField(key, kind), *_parse_datatype_string(outputs).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        held, own, out = None, [], []

        def made(rows_out):
            return pa.record_batch([pa.array([x[i] for x in rows_out], f.type) for i, f in enumerate(arrow)], names=names)

        def folded(rows_in):
            rows_in.sort(key=lambda x: (x[-1] is not None, x[-1]))
            return fold([x[:-1] for x in rows_in])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for k, *values in zip(*columns, strict=True):
                if own and k != held:
                    out += [(held, *x) for x in folded(own)]
                    own = []
                held = k
                own.append(tuple(values))
            if len(out) > 10_000:
                yield made(out)
                out = []
        if own:
            out += [(held, *x) for x in folded(own)]
        if out:
            yield made(out)

    return rows.select(key, *inputs, order).repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def pack_chunks(subs: DataFrame, least: int = 10_000, most: int = 30_000, **options) -> DataFrame:
    """Pack consecutive subtitles, but for a file's first and last, into chunks of at most `most` ms.

    A live or duplicate subtitle ends the chunk, which stays if it has at least `least` ms; one that does not fit ends
    it whatever its length, and a silence fills it up first. Chunks without speech are dropped. Options: surround (keep
    silences), flush_marked, exclude (a subtitle that contains one of the strings ends the chunk and goes), remove
    (patterns to take out of texts), first (so many subtitles of a file alone; None: all). A null text is empty, rows
    without start or end are left out, and files of two rows or fewer have no chunks.
    """
    return pack_many(subs, [(least, most)], **options).drop("least", "most")


def pack_many(subs: DataFrame, ranges: list[tuple[int, int]], surround: bool = True, flush_marked: bool = True, exclude: tuple = (), remove: tuple = (), first: dict[tuple[int, int], int] | int | None = None) -> DataFrame:
    """The chunks of each (least, most), in one pass over a file's rows; `first` may be given by range."""

    def fold(rows: list[tuple]) -> list[tuple]:
        items = [(k, *x) for k, x in enumerate(rows[1:-1])]
        found = []
        for own in ranges:
            upto = first.get(own) if isinstance(first, dict) else first
            found += [(*own, k, *x) for k, x in enumerate(pack(items[:upto], *own, surround, flush_marked, exclude, remove))]
        return found

    flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in subs.columns else F.lit(False)
    rows = subs.where("start is not null and end is not null").select("file_id", "idx", "start", "end", F.coalesce("text", F.lit("")).alias("text"), (flag("live") | flag("duplicate")).alias("marked"))
    return by_key(rows, "file_id", "idx", ["start", "end", "text", "marked"], CHUNK, fold)


def bucket_spans(subs: DataFrame, limit: int = 30_000) -> DataFrame:
    """Adds bucket and since (ms from the bucket's start to the row's end): a row that ends `limit` ms or more after the
    bucket's start opens the next one, which starts where the row does. Rows without times stay in the bucket. One file
    may hold all rows (`jump_fold`)."""

    def step(state, start, end):
        bucket, anchor = state
        if start is None or end is None:
            return state, None, None, bucket, None
        anchor = start if anchor is None else anchor
        if end - anchor >= limit:
            bucket, anchor = bucket + 1, start
        return (bucket, anchor), end, start, bucket, end - anchor

    def numbers(before, opened, open_at, inputs):
        times = zip(*(x.to_pylist() for x in inputs), open_at.tolist(), strict=True)
        return opened, [None if start is None or end is None else end - at for start, end, at in times]

    return jump_fold(subs, "file_id", "idx", ["start", "end"], "bucket int, since long", lambda: (0, None), step, numbers, limit, sums=False)


def shard_by_duration(rows: DataFrame, key: str, order: str, duration: str, limit: int = 90_000_000) -> DataFrame:
    """Adds shard, from 1: the row that takes the sum over the limit closes the shard, and the sum starts anew. A
    duration is a whole number, null is 0. One key may hold all rows (`jump_fold`)."""

    def step(state, length):
        opened, total, upto = state
        total, upto = total + (length or 0), upto + (length or 0)
        over = total > limit
        return (opened + over, 0 if over else total, upto), upto, upto, opened + 1

    def numbers(before, opened, open_at, inputs):
        # the row that opens the next shard is the last of its own
        return (np.concatenate([[before], opened[:-1]]) + 1,)

    return jump_fold(rows, key, order, [duration], "shard int", lambda: (0, 0, 0), step, numbers, limit + 1, sums=True)


def row_numbers(rows: DataFrame, key: str, order: str, name: str = "index", width: int = 4096) -> DataFrame:
    """Adds the number of each row, from 0, among its key's rows in the order of a whole number, nulls first. Rows are put
    in order within spans of `width` of that number and their counts added up before, so that a frequent key does not
    stand in one task; ties stand in any order."""
    spans = rows.withColumn("__span", F.floor(F.col(order) / width))
    counts = spans.groupBy(F.col(key).alias("__key"), F.col("__span").alias("__of")).agg(F.count("*").alias("__n"))
    upto = Window.partitionBy("__key").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(upto), F.lit(0)))
    met = spans[key].eqNullSafe(counts["__key"]) & F.col("__span").eqNullSafe(F.col("__of"))
    own = F.row_number().over(Window.partitionBy(key, "__span").orderBy(order)) - 1
    return spans.join(counts, met).withColumn(name, (F.col("__before") + own).cast("long")).drop("__span", "__key", "__of", "__n", "__before")


def interval_points(spans: DataFrame, points: DataFrame, at: str, grid: int) -> DataFrame:
    """Every span (start, end, ...) with each point (at, ...) that start <= at < end holds for. Both meet on cells of a
    grid, an equi-join; a grid about as wide as the spans gives each of them one or two cells. Spans and points with
    nulls, and empty spans, meet nothing."""
    cells = F.sequence(F.floor(F.col("start") / grid), F.floor((F.col("end") - 1) / grid))
    spans = spans.where("start < end").withColumn("__cell", F.explode(cells))
    points = points.where(F.col(at).isNotNull()).withColumn("__cell", F.floor(F.col(at) / grid))
    return spans.join(points, "__cell").where((F.col(at) >= F.col("start")) & (F.col(at) < F.col("end"))).drop("__cell")


def previous_text(chunks: DataFrame, key: str = "file_id", idx: str = "idx", no_speech: str = "<|nospeech|>") -> DataFrame:
    """Adds previous_text: the text of the row before, if this one starts where it ends and it is speech."""
    w = by_file(key, idx)
    text, end = F.lag("text").over(w), F.lag("end").over(w)
    return chunks.withColumn("previous_text", F.when(F.coalesce((F.col("start") == end) & (text != no_speech), F.lit(False)), text))


def bucket_texts(subs: DataFrame) -> DataFrame:
    """Of bucketed rows: start, end, duration and the joined text of each bucket, and the rows' times within it."""
    w = Window.partitionBy("file_id", "bucket")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text")).over(w)), lambda x: x["text"]), " ")
    out = subs.withColumns({"start_bucket": F.min("start").over(w), "end_bucket": F.max("end").over(w), "text_bucket": joined})
    return out.withColumns({"start_relative": F.col("start") - F.col("start_bucket"), "end_relative": F.col("end") - F.col("start_bucket"), "duration_bucket": F.col("end_bucket") - F.col("start_bucket")})


def first_rows(rows: DataFrame, key: list[str], idx: str) -> DataFrame:
    """The first row of every key, without the last of them all by (idx, key)."""
    w = Window.partitionBy(*key).orderBy(idx)
    kept = rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    last = kept.agg(F.max(F.struct(idx, *key)).alias("__last"))
    return kept.crossJoin(F.broadcast(last)).where(F.struct(idx, *key) < F.col("__last")).drop("__last")


def language_fallback(buckets: DataFrame, lang: str = "sv", least: float = 0.5) -> DataFrame:
    """Rows (file_id, bucket, language, p) of the language with more than `least`; or, failing that, whose bucket just
    before exists and is of the language."""
    # a join with the bucket before, which a large file does not hold in one task
    before = buckets.where(F.col("language") == lang).select(F.col("file_id").alias("__file"), (F.col("bucket") + 1).alias("__bucket")).distinct()
    met = F.col("file_id").eqNullSafe(F.col("__file")) & (F.col("bucket") == F.col("__bucket"))
    own = F.coalesce((F.col("language") == lang) & (F.col("p") > least), F.lit(False))
    return buckets.join(before, met, "left").where(own | F.col("__bucket").isNotNull()).drop("__file", "__bucket")
