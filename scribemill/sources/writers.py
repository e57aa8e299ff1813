"""Writers: subtitles, documents, statistics, reports."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructType

from scribemill.functions.text import clean_subtitle


def stamp(ms: Column) -> Column:
    """Milliseconds as hh:mm:ss,mmm."""
    part = lambda x, n: F.lpad(x.cast("long").cast("string"), n, "0")
    return F.concat(part(F.floor(ms / 3_600_000), 2), F.lit(":"), part(F.pmod(F.floor(ms / 60_000), F.lit(60)), 2), F.lit(":"), part(F.pmod(F.floor(ms / 1000), F.lit(60)), 2), F.lit(","), part(F.pmod(ms, F.lit(1000)), 3))


def srt_texts(subs: DataFrame) -> DataFrame:
    """file_id and the SRT text of its subtitles in order."""
    block = F.concat((F.col("idx") + 1).cast("string"), F.lit("\n"), stamp(F.col("start")), F.lit(" --> "), stamp(F.col("end")), F.lit("\n"), F.col("text"), F.lit("\n"))
    rows = subs.select("file_id", F.struct("idx", block.alias("b")).alias("x")).groupBy("file_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return rows.select("file_id", F.array_join(F.transform("x", lambda x: x["b"]), "\n").alias("value"))


def write_srt(subs: DataFrame, path: str) -> None:
    """A folder of files, one for each file_id (as partition)."""
    srt_texts(subs).repartition("file_id").write.partitionBy("file_id").text(path)


def nested(subs: DataFrame, chunks: DataFrame, metadata: DataFrame) -> DataFrame:
    """One document a file: metadata, subs and chunks in order. What has no subs or chunks has empty lists."""
    listed = lambda df, name: df.groupBy("file_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(*df.columns[1:]))), lambda x: x).alias(name))
    out = metadata.join(listed(subs, "subs"), "file_id", "left").join(listed(chunks, "chunks"), "file_id", "left")
    return out


def without_nan(value: Column, kind) -> Column:
    """The value with null for NaN, at any depth of structs and arrays."""
    if isinstance(kind, (DoubleType, FloatType)):
        return F.nanvl(value, F.lit(None).cast(kind))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: without_nan(x, kind.elementType))
    if isinstance(kind, StructType):
        fields = [without_nan(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def json_texts(docs: DataFrame, ascii_only: bool = False) -> DataFrame:
    """file_id and `value`, each row's other columns as a JSON object with null for NaN."""
    rest = [without_nan(F.col(f.name), f.dataType).alias(f.name) for f in docs.schema.fields if f.name != "file_id"]
    text = F.to_json(F.struct(*rest))
    if ascii_only:
        units = F.transform(F.split(text, ""), lambda ch: F.when(F.ascii(ch) < 128, ch).otherwise(F.concat(F.lit("\\u"), F.lower(F.array_join(F.regexp_extract_all(F.hex(F.encode(ch, "UTF-16BE")), F.lit("(.{4})"), F.lit(1)), "\\u")))))
        text = F.array_join(units, "")
    return docs.select("file_id", text.alias("value"))


def output_name(file_id: Column, suffix: str) -> Column:
    """A file's name with another suffix in the place of its own: a/b.json, _scores.json -> a/b_scores.json."""
    return F.concat(F.regexp_replace(file_id, r"\.[^./]*$", ""), F.lit(suffix))


def write_documents(docs: DataFrame, path: str, ascii_only: bool = False, suffix: str | None = None) -> None:
    """One JSON document for each file_id, in a folder of its own under path (as partition); with a suffix, under the
    file's name with that suffix instead of its own. NaN is written as null."""
    name = output_name(F.col("file_id"), suffix) if suffix else F.col("file_id")
    json_texts(docs, ascii_only).withColumn("file_id", name).repartition("file_id").write.partitionBy("file_id").text(path)


def write_chunks(rows: DataFrame, path: str, stage: str = "stage1_wav2vec", clean=clean_subtitle) -> None:
    """Chunks of a stage with their samples and cleaned texts, as Parquet by file."""
    kept = rows.where(F.col(stage)).withColumn("text", clean(F.col("text")))
    kept.repartition("file_id").write.partitionBy("file_id").parquet(path)


def write_stages(rows: DataFrame, path: str, by: list[str]) -> None:
    """Parquet, a folder for each stage, dataset or split."""
    rows.repartition(*by).write.partitionBy(*by).parquet(path)


def append_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("header", True).csv(path)


def write_json_object(rows: DataFrame, path: str) -> None:
    """A one-row table as one JSON object; of more rows, an error."""
    if len(rows.limit(2).collect()) != 1:
        raise ValueError("not one row")
    rows.coalesce(1).write.json(path)


def write_paths(files: DataFrame, path: str, column: str = "path") -> None:
    files.select(F.col(column).cast("string")).write.text(path)


def html_rows(rows: DataFrame, score: str = "wer", limit: float = 0.2) -> DataFrame:
    """`value`, a row of an HTML table for each row: scores over the limit in red, columns that end in _html as they are."""

    def cell(name: str) -> Column:
        text = F.coalesce(F.col(name).cast("string"), F.lit("None"))
        for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
            text = text if name.endswith("_html") else F.replace(text, F.lit(a), F.lit(b))
        plain = F.concat(F.lit("<td>"), text, F.lit("</td>"))
        if not name.startswith(score) or dict(rows.dtypes)[name] == "string":
            return plain
        return F.when(F.col(name) > limit, F.concat(F.lit('<td style="color:red">'), text, F.lit("</td>"))).otherwise(plain)

    return rows.select(F.concat(F.lit("<tr>"), *(cell(c) for c in rows.columns), F.lit("</tr>")).alias("value"))


def write_html(rows: DataFrame, path: str, **options) -> None:
    """All rows as text files of table rows, and the head of the table beside them (path/head)."""
    html_rows(rows, **options).write.text(f"{path}/rows")
    head = "<tr>" + "".join(f"<th>{html.escape(c)}</th>" for c in rows.columns) + "</tr>"
    rows.sparkSession.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/head")
