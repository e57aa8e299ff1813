import os
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from scribemill.sources import audio, readers


def write(path, samples, rate=16_000, width=2, channels=1):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        x = np.repeat(samples, channels)
        if width == 1:
            w.writeframes((x * 127 + 128).astype("u1").tobytes())
        elif width == 3:
            w.writeframes((x * (2**31 - 1)).astype("<i4").view("u1").reshape(-1, 4)[:, 1:].tobytes())
        else:
            w.writeframes((x * (2 ** (8 * width - 1) - 1)).astype(f"<i{width}").tobytes())


def sine(hz, seconds, rate):
    return np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate)


@pytest.mark.parametrize("rate,width,channels", [(16_000, 2, 1), (48_000, 1, 2), (44_100, 3, 1), (8_000, 4, 2), (22_050, 2, 1)])
def test_chunks_are_slices_of_the_whole(spark, tmp_path, rate, width, channels):
    write(tmp_path / "a.wav", sine(300, 3, rate) * 0.5, rate, width, channels)
    rows = [(k, f"file://{tmp_path}/a.wav", a, b, "clash") for k, (a, b) in enumerate([(0, 3000), (500, 700), (2900, 5000), (10, 10), (1000, 500), (-50, 100), (None, 5)])]
    chunks = spark.createDataFrame(rows, "k int, path string, start long, end long, audio string").repartition(3)
    got = {r["k"]: r for r in audio.read_chunks(chunks).collect()}
    whole = np.array(got[0]["audio"])
    assert len(whole) == 48_000 and np.abs(whole[200:-200] - sine(300, 3, 16_000)[200:-200] * 0.5).max() < (0.02 if width == 1 else 0.002)
    assert np.allclose(got[1]["audio"], whole[8000:11_200], atol=1e-6) and np.allclose(got[2]["audio"], whole[46_400:], atol=1e-6)
    assert got[3]["audio"] == got[4]["audio"] == [] and np.allclose(got[5]["audio"], whole[:1600], atol=1e-6) and got[6]["audio"] is None
    assert all(r["error"] is None for r in got.values())
    full = readers.read_audio(spark, str(tmp_path)).first()
    assert full["rate"] == rate and np.allclose(full["audio"], whole, atol=1e-6)


def test_low_pass(spark, tmp_path):
    """What is above half of the new rate vanishes, and does not come back as another tone."""
    for hz, most, least in ((10_000, 0.002, 0), (8_600, 0.01, 0), (6_000, 1.01, 0.99), (200, 1.01, 0.99)):
        out = audio.resampled(sine(hz, 1, 48_000), 48_000, 0, 16_000)[400:-400]
        assert least <= np.abs(out).max() <= most, hz
    assert len(audio.resampled(np.zeros(0), 48_000, 0, 5)) == 5


def test_a_chunk_of_a_large_file(spark, tmp_path):
    """Two GB of samples, of which a chunk reads its own."""
    data = 2_000_000_000
    with open(tmp_path / "large.wav", "wb") as f:
        junk = 100_001
        f.write(b"RIFF" + struct.pack("<I", data + 44 + junk) + b"WAVE" + b"junk" + struct.pack("<I", junk) + bytes(junk + 1))
        f.write(b"fmt " + struct.pack("<IHHIIHH", 16, 1, 2, 48_000, 192_000, 4, 16) + b"data" + struct.pack("<I", data))
        first = f.tell()
        f.truncate(first + data)
        f.seek(first + 5_000 * 192_000)
        f.write(np.repeat(sine(440, 2, 48_000) * 20_000, 2).astype("<i2").tobytes())
    assert os.path.getsize(tmp_path / "large.wav") > data
    rows = spark.createDataFrame([(f"{tmp_path}/large.wav", 5_000_000, 5_002_000), (f"{tmp_path}/none.wav", 0, 5), (None, 0, 5)], "path string, start long, end long")
    got = {str(r["path"])[-9:]: r for r in audio.read_chunks(rows).collect()}
    found = got["large.wav"]
    assert found["bytes_read"] < 2_000_000 and np.abs(np.array(found["audio"])[100:-100] - sine(440, 2, 16_000)[100:-100] * 20_000 / 32_768).max() < 0.002
    assert got["/none.wav"]["audio"] is None and "FileNotFound" in got["/none.wav"]["error"] and got["None"]["error"] is None
    layout = audio.wav_format(rows.select("path", F.lit(1).alias("rate"))).collect()
    assert sorted((r["rate"] or 0, r["channels"], r["width"], r["samples"]) for r in layout)[-1] == (48_000, 2, 2, data // 4)


def test_broken_and_odd_files(spark, tmp_path):
    (tmp_path / "text.wav").write_bytes(b"no audio at all, just text")
    (tmp_path / "cut.wav").write_bytes(b"RIFF\x00\x00\x00\x00WAVEfmt ")
    (tmp_path / "law.wav").write_bytes(b"RIFF\x24\x00\x00\x00WAVEfmt " + struct.pack("<IHHIIHH", 16, 6, 1, 8000, 8000, 1, 8) + b"data\x04\x00\x00\x00abcd")
    floats = np.array([0.5, -0.25, 1.0], "<f4").tobytes()
    form = struct.pack("<IHHIIHHHHIH", 40, 0xFFFE, 1, 16_000, 64_000, 4, 32, 22, 32, 4, 3) + bytes(14)
    (tmp_path / "float.wav").write_bytes(b"RIFF\x24\x00\x00\x00WAVEfmt " + form + b"data" + struct.pack("<I", len(floats) + 50) + floats)
    got = {r["path"].rsplit("/", 1)[1]: r for r in readers.read_audio(spark, str(tmp_path)).collect()}
    assert {k: r["error"] for k, r in got.items()} == {"text.wav": "ValueError: not a WAV file", "cut.wav": "ValueError: no samples", "law.wav": "ValueError: samples of kind 6 and 1 bytes", "float.wav": None}
    assert got["float.wav"]["audio"] == [0.5, -0.25, 1.0]
