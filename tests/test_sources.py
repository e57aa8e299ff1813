import json
import struct
import wave

import duckdb
import pytest

from scribemill import catalog
from scribemill.operators.sequence import SILENCE
from scribemill.sources import readers, writers
from scribemill.streaming import files

SRT = "1\r\n00:00:01,000 --> 00:00:02,500\r\n<i>Hej</i>\r\ndu\r\n\r\n2\r\n00:00:03,000 --> 00:00:04,000\r\nå\r\n"


def test_srt(spark, tmp_path):
    (tmp_path / "in" / "b").mkdir(parents=True)
    (tmp_path / "in" / "b" / "one.srt").write_text(SRT, newline="")
    (tmp_path / "in" / "bad.srt").write_bytes(b"1\n00:00:01,000 --> 00:00:02,500\n\xff\xfe\n")
    (tmp_path / "in" / "other.txt").write_text("no")
    got = readers.read_srt(spark, str(tmp_path / "in")).orderBy("idx").collect()
    assert [tuple(r)[1:] for r in got] == [(0, 1000, 2500, "Hej\ndu"), (1, 3000, 4000, "å")]
    rows = readers.read_srt(spark, str(tmp_path / "in")).withColumn("file_id", readers.F.lit("x"))
    writers.write_srt(rows, str(tmp_path / "out"))
    again = readers.read_srt(spark, str(tmp_path / "out"), "*.txt").orderBy("idx").collect()
    assert [tuple(r)[1:] for r in again] == [tuple(r)[1:] for r in got]


def test_failed_files(spark, tmp_path):
    for name, data in {"a.srt": SRT.encode(), "b.srt": b"\xff 00:00:01,000 --> 00:00:02,500", "c.srt": b"nothing", "d.srt": b"", "x.TextGrid": b"item", "m.json": b"{broken", "n.json": b'["p"]'}.items():
        (tmp_path / name).write_bytes(data)

    def failed(kind):
        return {r["file_id"].rsplit("/", 1)[1]: r["error"] for r in readers.failed_files(spark, str(tmp_path), kind).collect()}

    assert failed("srt") == {"b.srt": "not UTF-8", "c.srt": "no time line"}
    assert failed("textgrid") == {"x.TextGrid": "no interval"} and failed("manifest") == {"m.json": "not a JSON list"}
    read = {r["file_id"].rsplit("/", 1)[1] for r in readers.read_srt(spark, str(tmp_path)).collect()}
    assert read == {"a.srt"} and readers.read_manifest(spark, str(tmp_path / "m.json")).count() == 0


def test_textgrid(spark, tmp_path):
    item = lambda a, b, t: f'            xmin = {a}\n            xmax = {b}\n            text = "{t}"\n'
    (tmp_path / "a.TextGrid").write_text("header\n" + item(0, 0.5, " ") + item(0.5, 1.2345, 'sa ""ja""'))
    got = readers.read_textgrid(spark, str(tmp_path)).orderBy("idx").collect()
    assert [(r["start"], r["end"], r["text"]) for r in got] == [(0, 500, SILENCE), (500, 1234, 'sa "ja"')]
    # long texts, and many quotes
    (tmp_path / "a.TextGrid").write_text(item(0, 1, "long " * 40_000) + item(1, 2, 'a ""' * 300))
    got = readers.read_textgrid(spark, str(tmp_path)).orderBy("idx").collect()
    assert [r["text"] for r in got] == ["long " * 40_000, 'a "' * 300]


def test_transcripts(spark, tmp_path):
    """A file without a byte is an empty transcript, as for the reference; long runs of white space are passed once."""
    rows = lambda **x: dict(map(tuple, readers.read_transcripts(spark, str(tmp_path), **x).collect()))
    for name, text in {"a.txt": "", "b.txt": " \n", "c.txt": "c \u2003\xa0\r\n", "e.md": "e"}.items():
        (tmp_path / name).write_bytes(text.encode())
    assert rows() == {"a.txt": "", "b.txt": "", "c.txt": "c"}
    assert rows(space=r"[ \t\n\f\r]") == {"a.txt": "", "b.txt": "", "c.txt": "c \u2003\xa0"}
    (tmp_path / "a.txt").write_text(long := "a" + " " * 400_000 + "b")
    assert rows()["a.txt"] == long


def test_transcript_files_of_odd_rows(spark, tmp_path):
    """Rows without a text, with an empty one or other white space at the end, of one id, without an id, of any id."""
    ends = "\t \n \r\n \f \v \x1c \x85 \xa0 \u1680 \u2003 \u2028 \u2029 \u202f \u3000 \ufeff".split(" ")
    texts = ["", " ", " \n\t", " a  b \n\n c", *(f"a{x}" for x in ends), *(f"a \n{x}" for x in ends), *(f"a{x} \n" for x in ends), *(x for x in ends)]
    rows = [*enumerate(texts), (-5, "a "), (-(2**63), "b"), (2**63 - 1, None), (-7, None), (7, None), (8, ""), (9, "other"), (9, "other"), (None, "a "), (None, "a "), (None, ""), (None, None), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    c = duckdb.connect()
    c.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = c.execute(catalog.ORACLES["transcript_files"]).fetchall()
    got = catalog.QUERIES["transcript_files"](spark, str(tmp_path)).select("doc_id", "transcription").collect()
    assert len(want) == len(rows) and sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_documents(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.json").write_text(json.dumps({"metadata": {"channel": "c"}, "chunks": [{"text": "t", "transcription": [], "language_probs": {"m": {"sv": 0.5}}}]}, indent=1))
    (tmp_path / "d" / "b.json").write_text("{not json")
    good, bad = readers.read_documents(spark, str(tmp_path / "d"))
    r = good.first()
    assert good.count() == 1 and bad.count() == 1 and r["metadata"]["channel"] == "c"
    assert r["chunks"][0]["transcription"] == [] and r["chunks"][0]["language_probs"] == {"m": {"sv": 0.5}} and r["subs"] is None
    writers.write_documents(good.select("file_id", "chunks"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first()["chunks"][0]["text"] == "t"


def test_documents_are_written_by_file_under_names_of_their_own(spark, tmp_path):
    chunks = "array<struct<text:string,score:double,more:struct<p:double>>>"
    docs = spark.createDataFrame([("x/a.json", [("é😀", float("nan"), (float("nan"),))]), ("x/b.json", [])], f"file_id string, chunks {chunks}")
    writers.write_documents(docs, str(tmp_path / "out"), ascii_only=True, suffix="_scores.json")
    rows = spark.read.text(str(tmp_path / "out")).collect()
    got = {r["file_id"]: (r["value"], json.loads(r["value"])) for r in rows}
    assert set(got) == {"x/a_scores.json", "x/b_scores.json"} and got["x/a_scores.json"][0].isascii()
    first = got["x/a_scores.json"][1]["chunks"][0]
    assert first["text"] == "é😀" and first.get("score") is None and first["more"].get("p") is None and got["x/b_scores.json"][1]["chunks"] == []
    with pytest.raises(ValueError):
        writers.write_json_object(docs, str(tmp_path / "one"))


def test_shard_stats_literals_and_channels(spark, tmp_path):
    (tmp_path / "smdb").mkdir()
    (tmp_path / "smdb" / "s1.json").write_text('{"n": 3}')
    assert readers.read_shard_stats(spark, str(tmp_path)).select("n", "file", "dataset").collect() == [(3, "s1.json", "smdb")]
    rows = readers.literal_table(spark, {"a": {"n": 1}, "b": {"n": 2, "hours": 0.5}}).collect()
    assert [(r["name"], r["n"], r["hours"]) for r in rows] == [("a", 1, None), ("b", 2, 0.5)]
    files = spark.createDataFrame([("/d/tv4/a.srt",), ("/d/cmore/b.srt",)], "path string")
    assert [r["path"] for r in readers.of_channels(files, ["tv4"]).collect()] == ["/d/tv4/a.srt"]


def test_chunks_of_a_stage(spark, tmp_path):
    rows = spark.createDataFrame([("a", True, "x  y", [0.5]), ("a", False, "no", [0.1]), ("b", None, "no", [0.1])], "file_id string, stage1_wav2vec boolean, text string, audio array<float>")
    writers.write_chunks(rows, str(tmp_path / "chunks"))
    assert [(r["file_id"], r["text"], r["audio"]) for r in spark.read.parquet(str(tmp_path / "chunks")).collect()] == [("a", "x y", [0.5])]


def test_manifests_and_tables(spark, tmp_path):
    (tmp_path / "m.txt").write_text("a.json a.wav\n\nb.json\n")
    (tmp_path / "m.json").write_text('[["a.json", "a.wav"], ["b.json", "b.wav"]]')
    (tmp_path / "p.json").write_text('["a.json"]')
    rows = lambda n: sorted((tuple(r) for r in readers.read_manifest(spark, str(tmp_path / n)).collect()), key=str)
    assert rows("m.txt") == [("a.json", "a.wav"), ("b.json", None)] and rows("m.json")[1] == ("b.json", "b.wav") and rows("p.json") == [("a.json", None)]
    (tmp_path / "t.csv").write_text('1|"q|x\n')
    assert readers.read_pipe_csv(spark, str(tmp_path / "t.csv"), "a int, b string, c string", quoted=False).first()[1:] == ('"q', "x")
    df = spark.createDataFrame([(0.5, 1.25, "s1", "hej"), (1.0, 1.0, "s1", "x"), (0.0, 1.0, "trans1", "y")], "sub_start double, sub_end double, speaker_id string, text string")
    assert [(r["start"], r["end"], r["duration"]) for r in readers.speaker_subs(df).collect()] == [(500, 1250, 750)]
    streams = spark.createDataFrame([("f", 3, "swe"), ("f", 0, "Swedish"), ("g", 1, "eng")], "file_id string, stream int, language string")
    assert [tuple(r) for r in readers.swedish_stream(streams).collect()] == [("f", 0)]


def test_audio(spark, tmp_path):
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setparams((2, 2, 8000, 0, "NONE", ""))
        w.writeframes(b"".join(struct.pack("<hh", i * 100, i * 100) for i in range(80)))
    with wave.open(str(tmp_path / "c.wav"), "wb") as w:
        w.setparams((1, 3, 16000, 0, "NONE", ""))
        w.writeframes((-(1 << 22)).to_bytes(3, "little", signed=True) + (1 << 21).to_bytes(3, "little"))
    (tmp_path / "b.wav").write_bytes(b"broken")
    got = {r["path"][-5:]: r for r in readers.read_audio(spark, str(tmp_path)).collect()}
    # inside, a ramp comes through the low-pass as it was
    assert len(got["a.wav"]["audio"]) == 160 and got["a.wav"]["audio"][80] == pytest.approx(4000 / 32768, rel=0.01) and got["a.wav"]["rate"] == 8000
    assert got["c.wav"]["audio"] == [-0.5, 0.25]
    assert got["b.wav"]["audio"] is None and got["b.wav"]["error"]


def test_stream_takes_each_file_once(spark, tmp_path):
    schema = "file_id long, idx int, start long, end long, text string"
    write = lambda k: spark.createDataFrame([(k, 0, 100, 200, "a"), (k, 1, 200, 300, "a")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    for k in (1, 2):
        write(k)
        files.process_new(files.arriving(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["file_id"], r["start"], r["end"]) for r in got) == [(1, 0, 100), (1, 100, 300), (2, 0, 100), (2, 100, 300)]


def test_report(spark):
    rows = spark.createDataFrame([("<a>", 0.5, "<b>"), (None, 0.1, "")], "t string, wer double, d_html string")
    out = "".join(r["value"] for r in writers.html_rows(rows).collect())
    assert "&lt;a&gt;" in out and out.count("color:red") == 1 and "<td><b></td>" in out and "<td>None</td>" in out


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_queries_against_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    want = c.sql(catalog.ORACLES[name]).df()
    got = catalog.QUERIES[name](spark, folder).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    norm = lambda df: sorted(tuple(repr(round(float(x), 8)) if isinstance(x, float) else str(x) for x in r) for r in df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False))
    assert norm(got) == norm(want)
