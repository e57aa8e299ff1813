"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations.

A source's target in words over its size is what each of its documents is to appear on average: the whole part is
certain copies of every document, and the rest of the target is filled by a sample. A document's inclusion probability p
is in proportion to its size, at most 1, and such that the sample's expected words are those to fill; documents of
probability 1 are taken first. The others are ranked by (random odds) / (inclusion odds), u / (1 - u) over p / (1 - p),
and the smallest ranks are taken until the words are used up: a sample of fixed size in words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scribemill.llm._shared import written

WORDS = r"[^\x20\x09-\x0D]+"
#: copies of a document at most
MOST = 3
#: a source's ranks are summed up in so many classes, of which only the one at the limit is sorted
CLASSES = 4096
#: a table of sources of more rows than this is not broadcast
BROADCAST_ROWS = 100_000


def words(text):
    """Words of a text, 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = (1, 2, 3), most: int = MOST) -> DataFrame:
    """source, source_size, target from rows (source, size).

    Sources by code point, null last, have the weights in turn. They share all words by weight; a source that would
    get more than `most` times its size gets just that, and the excess goes to the others by weight. In ascending
    order of most * size / weight, the sources that stop are the first ones up to a point, so sums over that order say
    where (of equal ratios the first one's share, which is the largest). One row a source meets in a task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int")).cast("long"))
    per = per.withColumn("cap", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    share = (F.sum("source_size").over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    per = per.withColumn("share", share)
    level = F.min(F.when(F.col("share") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), -F.col("share")))).over(total)
    level = F.struct((-level["col2"]).alias("share"))
    return per.select("source", "source_size", F.least(F.col("cap").cast("double"), F.coalesce(level["share"], F.lit(0.0)) * F.col("weight")).alias("target"))


def inclusion(sizes: DataFrame, rest: DataFrame) -> DataFrame:
    """__source and __factor, by which inclusion probabilities are min(1, factor * size), from rows (__source, size) and
    (__source, rest).

    In descending order of size, the documents of probability 1 are the first ones up to a point; a row of each size of
    a source says what the factor is if those before it are certain, and the point is the first size for which that
    gives less than 1. The rows of a source's distinct sizes meet in a task, which the longest text bounds.
    """
    per = sizes.where("size > 0").groupBy(F.col("__source").alias("__s"), "size").agg(F.count("*").alias("n"))
    per = per.join(rest, F.col("__s").eqNullSafe(F.col("__source")))
    down = Window.partitionBy("__source").orderBy(F.col("size").desc())
    before = F.coalesce(F.sum(F.col("size") * F.col("n")).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    squares = F.sum(F.col("size").cast("decimal(38,0)") * F.col("size") * F.col("n")).over(down.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("factor", (F.col("rest") - before) / squares.cast("double")).where(F.col("factor") * F.col("size") < 1)
    return per.groupBy("__source").agg(F.max_by("factor", "size").alias("__factor"))


def mix(docs: DataFrame, weights: tuple = (1, 2, 3), most: int = MOST, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple | None = None) -> DataFrame:
    """The columns `keep` of docs (None: all; the id always), and size, source_size, target, copies, taken (size * copies).

    Random numbers come from an md5 of the seed and the id, so reruns agree. Null texts and texts without words have
    size 0 and are not sampled; a source of such texts alone has target 0. Equal rows and rows of one id are ranked
    together, ties in id order; equal rows may differ in copies. A null source is a source; an empty table gives no
    row. Columns of docs with the names of the new ones are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    unit = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 12), 16, 10).cast("long") + 0.5) / float(1 << 48)
    kept = docs.columns if keep is None else list(dict.fromkeys([id_col, *keep]))
    rows = docs.select(*kept, words(F.col(text_col)).alias("size"), F.col(source_col).alias("__source"), unit.alias("__u"))
    # sizes are counted once; all that follows reads this table
    rows = written(rows, "mix-sizes")
    per = targets(rows.select(F.col("__source").alias("source"), "size"), weights, most)
    per = per.withColumn("certain", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    per = per.withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size")).withColumnRenamed("source", "__source")
    factor = inclusion(rows.select("__source", "size"), per.select("__source", "rest")).withColumnRenamed("__source", "__f")
    per = per.join(factor, F.col("__source").eqNullSafe(F.col("__f")), "left").drop("__f")
    # no size gives less than 1 where (but for rounding) all words are to be taken
    per = written(per.withColumn("__factor", F.when(F.col("rest") > 0, F.coalesce("__factor", F.lit(1.0)))), "mix-sources")
    small = per.count() <= BROADCAST_ROWS
    factors = per.select(F.col("__source").alias("__of"), "__factor")
    rows = rows.join(F.broadcast(factors) if small else factors, F.col("__source").eqNullSafe(F.col("__of"))).drop("__of")
    # the rank's class is a monotone function of it; without words to fill, no document has a rank
    p = F.col("__factor") * F.col("size")
    rank = F.when(p >= 1, 0.0).when(p > 0, F.col("__u") / (1 - F.col("__u")) / (p / (1 - p)))
    rows = rows.withColumn("__rank", F.when(F.col("size") > 0, rank)).withColumn("__class", F.when(F.col("__rank") == 0, 0).otherwise(F.floor(CLASSES * (F.atan(F.log("__rank") / 4) / 3.141592653589793 + 0.5))).cast("int"))
    by_class = rows.where("__rank is not null").groupBy("__source", "__class").agg(F.sum("size").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__source").orderBy("__class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_class = by_class.withColumn("__before", before)
    bounded = per.select("__source", "rest")
    limit = by_class.alias("c").join(bounded.alias("p"), F.col("c.__source").eqNullSafe(F.col("p.__source"))).where("rest > __before").groupBy("p.__source").agg(F.max(F.struct("__class", "__before", "rest")).alias("x"))
    limit = limit.select("__source", F.col("x.__class").alias("__limit"), F.col("x.__before").alias("__before"))
    per = per.alias("p").join(limit.alias("l"), F.col("p.__source").eqNullSafe(F.col("l.__source")), "left").select("p.__source", "source_size", "target", "certain", "rest", "__limit", "__before")
    per = per.withColumnsRenamed({"__source": "__of", "certain": "__certain", "rest": "__rest"})
    rows = rows.join(F.broadcast(per) if small else per, F.col("__source").eqNullSafe(F.col("__of")))
    edge = F.coalesce(F.col("__class") == F.col("__limit"), F.lit(False))
    # only the documents of the class at the limit are put in order; all others meet no one
    place = Window.partitionBy("__source").orderBy("__rank", F.col(id_col))
    at = rows.where(edge).withColumn("__sum", F.col("__before") + F.sum("size").over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    at = at.withColumn("__extra", (F.col("__sum") - F.col("size") / 2 <= F.col("__rest")).cast("int"))
    off = rows.where(~edge).withColumn("__sum", F.lit(None).cast("long")).withColumn("__extra", F.coalesce(F.col("__class") < F.col("__limit"), F.lit(False)).cast("int"))
    out = off.unionByName(at).withColumn("copies", (F.col("__certain") + F.col("__extra")).cast("int"))
    return out.withColumn("taken", F.col("size") * F.col("copies")).select(*kept, "size", "source_size", "target", "copies", "taken")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each row as many times as it has copies, with the columns of docs."""
    out = mix(docs, **options).where("copies > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs, keep=("doc_id",)).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    (cast('0x' || substr(md5('1:' || coalesce(cast(doc_id as varchar), '')), 1, 12) as bigint) + 0.5::double) / 281474976710656.0::double as u from documents),
s as (select source, cast(sum(size) as bigint) as source_size, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from d group by source),
c as (select *, source_size * 3 as cap from s),
r as (select *, (sum(source_size) over () - coalesce(sum(cap) over w, 0))::double / (sum(weight) over () - coalesce(sum(weight) over w, 0))::double as share
  from c window w as (order by cap::double / weight, source nulls last rows between unbounded preceding and 1 preceding)),
t as (select source, source_size, least(cap::double, coalesce((select share from r where share * weight <= cap order by cap::double / weight, share desc limit 1), 0.0) * weight) as target from r),
p as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as certain from t),
q as (select p.*, target - certain * source_size as rest from p),
z as (select source, size, count(*) as n from d where size > 0 group by source, size),
g as (select q.source, size, (rest - coalesce(sum(size * n) over (w rows between unbounded preceding and 1 preceding), 0)) / cast(sum(size::hugeint * size * n) over (w rows between current row and unbounded following) as double) as factor
  from z join q on z.source is not distinct from q.source window w as (partition by q.source order by size desc)),
e as (select source, arg_max(factor, size) as factor from g where factor * size < 1 group by source),
f as (select q.*, case when rest > 0 then coalesce(factor, 1.0) end as factor from q left join e on q.source is not distinct from e.source),
k as (select d.doc_id, size, source_size, target, certain, rest, d.source, case when size > 0 then case when factor * size >= 1 then 0 when factor > 0 then u / (1 - u) / (factor * size / (1 - factor * size)) end end as rank
  from d join f on d.source is not distinct from f.source),
x as (select *, sum(size) over (partition by source order by rank nulls last, doc_id rows unbounded preceding) as upto from k)
select doc_id, size, source_size, target, cast(size * (certain + case when rank is not null and upto - size / 2 <= rest then 1 else 0 end) as bigint) as taken from x
"""
