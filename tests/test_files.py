import json
import os
import wave

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from scribemill.sources import files, readers


def tree(path):
    return sorted(os.path.relpath(os.path.join(d, x), path) for d, _, names in os.walk(path) for x in names if not x.endswith(".crc"))


def test_one_file_a_row(spark, tmp_path):
    rows = [("a/b.json", "é"), ("c.json", None), ("a/d e.json", "x" * 100_000), ("c.json", None)]
    files.write_files(spark.createDataFrame(rows, "name string, content string").repartition(3), f"file://{tmp_path}/out")
    assert tree(tmp_path / "out") == ["_SUCCESS", "a/b.json", "a/d e.json", "c.json"]
    assert (tmp_path / "out/a/b.json").read_text() == "é" and (tmp_path / "out/c.json").read_bytes() == b"" and json.loads((tmp_path / "out/_SUCCESS").read_text()) == {"files": 3}
    # files of the same names are replaced, others stay
    files.write_files(spark.createDataFrame([("c.json", b"\x00\xff")], "name string, content binary"), str(tmp_path / "out"))
    assert (tmp_path / "out/c.json").read_bytes() == b"\x00\xff" and (tmp_path / "out/a/b.json").exists()
    files.write_files(spark.createDataFrame([], "name string, content string"), str(tmp_path / "none"))
    assert tree(tmp_path / "none") == ["_SUCCESS"]


@pytest.mark.parametrize("bad", ["../x", "/etc/x", "", None, "a//b", "_written/x"])
def test_bad_names(spark, tmp_path, bad):
    with pytest.raises(Exception, match="not a name of a file"):
        files.write_files(spark.createDataFrame([(bad, "x")], "name string, content string"), str(tmp_path / "out"))
    assert tree(tmp_path) == []


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    """Some tasks are through and one fails in the middle of its rows: no file, no part and no list stays."""

    @F.udf(BinaryType())
    def content(k):
        if k == 61:
            raise ValueError("no more")
        return b"x" * k

    rows = spark.range(100).repartitionByRange(4, "id").select(F.concat(F.lit("f/"), F.col("id").cast("string")).alias("name"), F.col("id"))
    with pytest.raises(Exception, match="no more"):
        files.write_files(rows.withColumn("content", content("id")), str(tmp_path / "out"))
    assert tree(tmp_path / "out") == []
    files.write_files(rows.where("id <> 61").withColumn("content", content("id")), str(tmp_path / "out"))
    assert len(tree(tmp_path / "out")) == 100 and os.path.getsize(tmp_path / "out/f/99") == 99


def test_documents_subtitles_and_chunks(spark, tmp_path):
    docs = spark.createDataFrame([("x/a.json", [("t", float("nan"))]), ("x/b.json", [])], "file_id string, chunks array<struct<text:string,score:double>>")
    files.write_document_files(docs, str(tmp_path / "d"), suffix="_scores.json")
    assert tree(tmp_path / "d") == ["_SUCCESS", "x/a_scores.json", "x/b_scores.json"]
    assert json.loads((tmp_path / "d/x/a_scores.json").read_text())["chunks"][0].get("score") is None
    subs = spark.createDataFrame([("x/a.json", 1, 3000, 4000, "två"), ("x/a.json", 0, 1000, 2500, "ett\nett")], "file_id string, idx int, start long, end long, text string")
    files.write_srt_files(subs, str(tmp_path / "s"))
    again = readers.read_srt(spark, str(tmp_path / "s")).orderBy("idx").collect()
    assert tree(tmp_path / "s") == ["_SUCCESS", "x/a.srt"] and [tuple(r)[1:] for r in again] == [(0, 1000, 2500, "ett\nett"), (1, 3000, 4000, "två")]
    chunks = [("x/a.json", 0, 20, "a  b", [0.5, -1.5, None], True), ("x/a.json", 20, 30, "no", [0.1], False)]
    files.write_chunk_files(spark.createDataFrame(chunks, "file_id string, start long, end long, text string, audio array<float>, stage1_wav2vec boolean"), str(tmp_path / "c"))
    assert tree(tmp_path / "c") == ["_SUCCESS", "x/a/chunks/0_20.txt", "x/a/chunks/0_20.wav"] and (tmp_path / "c/x/a/chunks/0_20.txt").read_text() == "a b"
    with wave.open(str(tmp_path / "c/x/a/chunks/0_20.wav")) as w:
        assert (w.getframerate(), w.getnchannels(), w.readframes(9)) == (16_000, 1, b"\x00\x40\x00\x80\x00\x00")


def test_files_are_listed_and_read_in_tasks(spark, tmp_path):
    """As many tasks as the cores ask for, whatever the number of files, and paths as Spark writes them."""
    (tmp_path / "a" / "b=1").mkdir(parents=True)
    (tmp_path / "_no").mkdir()
    for name in ("a/x y.txt", "a/b=1/å%.txt", "a/_x.txt", "a/.x.txt", "_no/x.txt", "a/x.md"):
        (tmp_path / name).write_bytes(b"1")
    (tmp_path / "a/none.txt").write_bytes(b"")
    (tmp_path / "a/bad.txt").write_bytes(b"\xff")
    found = readers.whole_files(spark, str(tmp_path), "*.txt")
    own = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(str(tmp_path), wholetext=True)
    want = own.select(F.col("_metadata.file_path"), F.hex("value")).collect()
    assert sorted(map(tuple, found.select("path", F.hex("value")).collect())) == sorted(map(tuple, want)) and len(want) == 3
    assert found.rdd.getNumPartitions() == 3 * spark.sparkContext.defaultParallelism
