"""From raw documents to token shards: toxicity, near-duplicates, benchmark passages, mix of sources, token ids.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last return the columns of
documents, further ones included. An empty table stays empty; texts that are null, empty or without words pass all
filters but have no words to mix; rows of a null id are judged like all others, by their texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribemill.llm._shared import temporary_tables, written
from scribemill.llm.decontamination import contamination
from scribemill.llm.mixing import mixed
from scribemill.llm.near_dedup import first_of_groups, text_hash
from scribemill.llm.token_output import token_digests
from scribemill.llm.toxicity import classify, fit


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels of documents still here, rejects go: each row by its own text, so
    equal rows share a fate. Without labels none goes."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classify(docs, model, keep=True, names=("__score", "__rejected")).where(~F.col("__rejected")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates one row stays, that of the least id; documents without words all stay."""
    return first_of_groups(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of ten consecutive words of a benchmark item, or a whole shorter item, go. A row is
    judged by its own text, whatever other rows have its id."""
    with temporary_tables(spark) as tables:
        found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").select(F.col("doc_id").alias("hit"), F.col("text_hash").alias("hit_hash")).distinct()
        found = tables.keep(written(found, "contaminated"))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["hit"]) & (text_hash(docs["text"]) == found["hit_hash"]), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; texts without words are not taken. A null source is a source,
    and equal rows may differ in copies."""
    return mixed(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards, and for each row: doc_id, start, n_tokens, ids_crc32, shard, first. Copies are rows of their own, a null
    id comes first, and a null text is the end id alone."""
    import public_tokenizers

    return token_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_token_ids),
]
#: the classifier has no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the rows stand in a table of the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
