import hashlib
import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm import edge

from scribemill.llm import matroska as M
from scribemill.llm import token_output as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tab'stlé.,1  \x1c日<|endoftext|>", max_size=30), min_size=1, max_size=8))
def test_chunks_give_the_ids_of_the_whole_text(texts):
    raw = [x.encode() for x in texts]
    at = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    ids, ends = T.encode(np.frombuffer(b"".join(raw), np.uint8), at, PATH)
    for i, x in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == T.tokenizer(PATH).encode(x, add_special_tokens=False).ids


def test_shard_reader_takes_single_documents_and_checks_frames():
    docs = [np.arange(n, dtype=np.uint32) * 7 for n in (5, 0, 1, 1000)]
    file = io.BytesIO()
    writer = T.ShardWriter(file, frame_ids=300)
    for d in docs:
        writer.add(d)
    writer.finish()
    reader = T.ShardReader(file)
    assert reader.n_ids == 1006 and len(reader.frames) == 6
    assert reader.read(6, 1000).tolist() == docs[3].tolist() and reader.read(3, 4).tolist() == [21, 28, 0, 0]
    with pytest.raises(ValueError):
        reader.read(1000, 7)
    broken = bytearray(file.getvalue())
    broken[-9 - 6 * 12 + 8] ^= 1  # the first frame's checksum
    with pytest.raises(ValueError):
        T.ShardReader(io.BytesIO(bytes(broken))).read(0, 1)


def test_token_output(spark):
    got = T.token_digests(edge.documents(spark), PATH).toPandas().sort_values("start")
    want, start = [], 0
    for doc_id, text, *_ in sorted(edge.rows(), key=lambda x: x[0]):
        ids = T.tokenizer(PATH).encode(text or "", add_special_tokens=False).ids + [0]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(x) for x in got[["doc_id", "start", "n_tokens", "ids_crc32"]].itertuples(index=False)] == want
    assert T.token_digests(edge.empty(spark), PATH).count() == 0


@pytest.mark.parametrize("how", [M.NO_LACING, M.XIPH, M.FIXED, M.EBML_LACING])
@pytest.mark.parametrize("n", [0, 1, 191, 192, 193, 192 * 33 + 5, 100_000])
def test_matroska_round_trip(how, n):
    data = M.payload_of(bytes(np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8)))
    media = M.write(data, how=how)
    rows, cues = M.packets(media)
    assert b"".join(media[a:b] for _, _, a, b in rows) == data and len(data) % 192 == 0 and len(data) > 0
    assert [x[0] for x in rows] == [24 * i for i in range(len(rows))]
    assert all(media[p : p + 4] == M.CLUSTER.to_bytes(4, "big") for _, p in cues) and len(cues) == -(-len(rows) // M.PER_CLUSTER)


def of_unknown_size(kind, body):
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + b"\x01" + b"\xff" * 7 + body


def test_clusters_of_unknown_size_end_where_the_next_begins():
    data = M.payload_of(bytes(range(192)) * 64)
    whole = M.write(data)
    segment = next((a, b) for k, _, a, b in M.elements(whole, 0, len(whole)) if k == M.SEGMENT)
    body = b"".join(of_unknown_size(k, whole[a:b]) if k == M.CLUSTER else whole[s:b] for k, s, a, b in M.elements(whole, *segment))
    head = next(b for k, _, _, b in M.elements(whole, 0, len(whole)) if k == M.EBML)
    for media in (whole[:head] + M.element(M.SEGMENT, body), whole[:head] + of_unknown_size(M.SEGMENT, body)):
        rows, cues = M.packets(media)
        assert len(rows) == 64 and b"".join(media[a:b] for _, _, a, b in rows) == data and len(cues) == 2
        assert [x[0] for x in rows] == [24 * i for i in range(64)]
    with pytest.raises(ValueError):
        M.packets(whole[:head] + b"\x00" * 8)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=700), min_size=2, max_size=20))
def test_lacing_of_frames_of_any_size(frames):
    for how in (M.XIPH, M.EBML_LACING):
        x = M.lace(frames, how)
        assert [x[a:b] for a, b in M.laced(x, 0, len(x), how)] == frames


def test_media_columns(spark):
    docs = edge.documents(spark)
    got = {r["doc_id"]: r for r in M.digests(M.media_column(docs)).collect()}
    for doc_id, text, *_ in edge.rows():
        data = M.payload_of((text or "").encode())
        r = got[doc_id]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len((text or "").encode()), len(data), hashlib.sha256(data).hexdigest())
        assert r["tail_crc32"] == zlib.crc32(data[-16:])
    assert got[63]["media_sha256"] == got[64]["media_sha256"] and got[63]["feature"] == got[64]["feature"]
    tables = M.packet_table(M.media_column(docs)).where("doc_id = 65").first()
    assert tables["error"] is None and sum(p["end"] - p["first"] for p in tables["packets"]) == got[65]["payload_bytes"]
    for doc_id, text, *_ in edge.rows():  # features, from their meaning
        x = np.frombuffer(M.payload_of((text or "").encode()), np.uint8).astype(int) - 128
        n, r = len(x) // 192, got[doc_id]
        want = {"packets": n, "cues": -(-n // 32), "last_ms": 24 * (n - 1), "mean": int(x.sum()) * 1000 // len(x), "energy": int((x**2).sum()) * 1000 // len(x), "crossings": sum((a < 0) != (b < 0) for a, b in zip(x, x[1:], strict=False))}
        assert {k: int(v) for k, v in (y.split("=") for y in r["feature"].split(";"))} == want
        media = M.write(M.payload_of((text or "").encode()))
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
    bad = spark.createDataFrame([(1, bytearray(b"no media"), "clash"), (2, None, "clash")], "doc_id long, media binary, packets string")
    found = {r["doc_id"]: r for r in M.packet_table(bad).collect()}
    assert found[1]["error"] and found[1]["packets"] == [] and found[2]["packets"] == [] and found[2]["error"] is None
    assert M.digests(M.media_column(edge.empty(spark))).count() == 0
