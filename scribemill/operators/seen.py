"""Texts that earlier runs have met, with the first place of each, kept between runs."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def digest(text: Column) -> Column:
    """16 bytes for each text, another value for null."""
    return F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(b"null").cast("binary"))


class SeenTexts:
    """A table of text digests with the run, file and row that had the text first, in buckets of the digest.

    A run adds only texts that no run has had: files are appended to the buckets, what stands there is neither moved nor
    written again, and joins on the digest leave the table where it is and deal out the run's own distinct texts. The
    place of a text says by which run it was met, so that a run that is repeated under its name (a string; runs count in
    the order of their names) finds what it found the first time, and adds nothing.
    """

    def __init__(self, spark: SparkSession, path: str, file_type: str = "string", buckets: int = 64):
        """path: where the table is, in a store that all executors reach; made if there is none. buckets and
        file_type (of file_id) stay as they were then."""
        self.spark = spark
        self.name = "seen_texts_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, run STRING, file_id {file_type}, idx INT) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")
        self.buckets = buckets

    def places(self) -> DataFrame:
        """digest, run, file_id, idx of every text."""
        self.spark.sql(f"REFRESH TABLE {self.name}")
        return self.spark.table(self.name)

    def marked(self, first: DataFrame, run: str) -> DataFrame:
        """Rows (text, first, n) with, in `first`, whether an earlier run has met the text, and the first place in this run."""
        known = self.places().select(F.col("digest").alias("__digest"), F.col("run").alias("__run"), F.struct("file_id", "idx").alias("__place"))
        rows = first.withColumn("__own", digest(F.col("text"))).join(known, F.col("__own") == F.col("__digest"), "left")
        place = F.when(F.col("__run") == run, F.least("first", "__place")).otherwise(F.col("first"))
        return rows.select("text", F.struct((F.coalesce(F.col("__run") < run, F.lit(False))).alias("earlier"), place["file_id"].alias("file_id"), place["idx"].alias("idx")).alias("first"), "n")

    def add(self, subs: DataFrame, run: str) -> None:
        """Keep the texts of a run's rows that no run has had yet. To be called once the run's marks are written, or before."""
        first = subs.groupBy(digest(F.col("text")).alias("digest")).agg(F.min(F.struct("file_id", "idx")).alias("x"))
        new = first.join(self.places().select("digest"), "digest", "left_anti")
        new = new.select("digest", F.lit(run).alias("run"), F.col("x.file_id").alias("file_id"), F.col("x.idx").cast("int").alias("idx"))
        new.repartition(self.buckets, "digest").write.insertInto(self.name)
