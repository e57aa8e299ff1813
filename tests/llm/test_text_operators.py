import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tests.llm import edge

from scribemill.llm import decontamination as D
from scribemill.llm import line_dedup as L
from scribemill.llm import lm_scoring as S
from scribemill.llm import mixing as X
from scribemill.llm import near_dedup as N
from scribemill.llm import suffix_dedup as U

WORD, ALNUM = re.compile("[^\x20\x09-\x0d]+"), re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def counted(rows):
    return sorted(collections.Counter(rows).items(), key=repr)


def in_duckdb(sql: str, **tables):
    c = duckdb.connect()
    for name, df in tables.items():
        c.register(name, df.toPandas())
    return c.sql(sql).df()


@pytest.mark.parametrize("size,hot", [(500, 200), (1 << 20, 200), (500, 2), (1 << 20, 2), (3000, 6)])
def test_suffix_dedup(spark, size, hot):
    length = 40
    data = [(x[0], (x[1] or "").encode()) for x in edge.rows(null_ids=True)]
    seen = collections.Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    want = []
    for doc_id, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        want.append((doc_id, len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    found = U.dedup_substrings(edge.documents(spark, null_ids=True), length, 12, block_bytes=size, hot=hot).collect()
    assert counted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found) == counted(want)
    assert sum(x[2] for x in want) > 0 and U.dedup_substrings(edge.empty(spark)).count() == 0


def test_a_passage_of_many_texts_goes_once_a_block(spark):
    """A third of the texts share a passage amid texts of their own: what its shard gets is in proportion to the blocks,
    not to the texts, and the result is that of all strings."""
    r = random.Random(8)
    own = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage = own(150)
    texts = [own(80) + (passage if k % 3 == 0 else own(150)) + own(80) for k in range(240)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    data = [U.block_texts(x) for x in U.blocks(docs, "doc_id", "text", 12_000).collect()]
    served = [U.anchors(d, o, 60, 16) for d, o in data]
    h, n = np.unique(np.concatenate([x[3] for x in served]), return_counts=True)
    met, sizes, found = h[n >= 70], {}, {}
    for hot in (200, 20):
        rows = U.dedup_substrings(docs, 60, 16, block_bytes=12_000, hot=hot).collect()
        found[hot] = {x["doc_id"]: (x["n_removed"], x["n_spans"]) for x in rows}
        busy = h[n >= hot]
        strings, m = np.unique(np.concatenate([U.served_starts(x, busy, U.prefix_hashes(d), 60)[2] for x, (d, _) in zip(served, data, strict=True)]), return_counts=True)
        kept = [U.narrowed(d, x, U.Busy(busy, strings[m > 1], strings[m >= hot]), 60) for x, (d, _) in zip(served, data, strict=True)]
        # distinct surroundings that blocks send of the anchors that most texts have
        sizes[hot] = sum(len({(a, b) for a, b in zip(x[3].tolist(), x[4].tolist(), strict=True) if a in met}) for x in kept)
    assert found[20] == found[200] and all(x == (0, 0) if k % 3 else 150 <= x[0] < 160 and x[1] == 1 for k, x in found[20].items())
    assert len(met) and sizes[20] * 3 < sizes[200]


def test_anchors_spread_over_shards():
    data = np.frombuffer(random.Random(2).randbytes(400_000), np.uint8)
    h = np.unique(U.anchors(data, np.array([0, len(data)]))[3])
    sizes = [j - i for _, i, j in U.shard_runs(h, 64)]
    assert len(sizes) == 64 and max(sizes) < 2 * sorted(sizes)[32]


def test_suffix_sort():
    r = np.random.default_rng(3)
    data = r.integers(97, 99, 400, dtype=np.uint8)
    at = np.arange(380)
    segment = np.sort(r.integers(0, 4, 380))
    order = U.Suffixes(data, 20).sort(at, segment)
    assert [(segment[i], bytes(data[at[i] : at[i] + 20])) for i in order] == sorted((segment[i], bytes(data[at[i] : at[i] + 20])) for i in range(380))
    for width in (1, 2, 7, 64):
        values = r.integers(0, 50, 300).astype(np.uint64) << np.uint64(32)
        assert U.window_minima(values, width).tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(300 - width + 1)]


@pytest.mark.parametrize("size", [500, 1 << 20])
@pytest.mark.parametrize("sent", [0, L.BROADCAST_BYTES])
def test_line_dedup(spark, size, sent, monkeypatch):
    docs = edge.documents(spark)
    if not sent:
        monkeypatch.setattr(L, "SHARD_KEYS", 1)
        monkeypatch.setattr(L, "MEETING", 1)
    found = L.dedup_lines(docs, block_bytes=size, broadcast_bytes=sent).collect()
    got = counted((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in found)
    want = in_duckdb(L.OP6_SQL, documents=docs.select("doc_id", "text"))
    assert got == counted(map(tuple, want[["doc_id", "n_lines", "n_dropped", "kept_sha256"]].itertuples(index=False)))
    assert want["n_dropped"].sum() > 0 and L.dedup_lines(edge.empty(spark)).count() == 0


def test_lines_that_polynomial_hashes_take_for_equal_stay(spark):
    """A Thue-Morse line and its complement agree in every polynomial hash modulo a power of two."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    b = a.translate({97: 98, 98: 97})
    docs = spark.createDataFrame([(1, a), (2, a), (3, b), (4, b)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_dropped"] for r in L.dedup_lines(docs).collect()} == dict.fromkeys(range(1, 5), 0)


def test_arrays_refuse_what_is_not_in_them():
    r = np.random.default_rng(6)
    a, b, n, largest = (r.integers(0, 1 << 62, 5000, dtype=np.uint64) for _ in range(4))
    arrays = L.LineArrays(a[:4000], b[:4000], (n % 1000 + 3)[:4000], largest.view(np.int64)[:4000])
    docs, ids = arrays.probe(a, b)
    assert docs[:4000].tolist() == (n % 1000 + 3)[:4000].tolist() and ids[:4000].tolist() == largest[:4000].tolist()
    assert not docs[4000:].any() and (arrays.hash.find(a[4000:], b[4000:]) >= 0).any()


def test_minimal_perfect_hash():
    r = np.random.default_rng(5)
    for n in (0, 1, 2, 1000, 20_000):
        a, b = (np.unique(r.integers(0, 1 << 63, n + 50, dtype=np.uint64))[:n] for _ in range(2))
        a[: n // 2] = a[0] if n else 0  # the second hash tells keys of one first hash apart
        h = L.MinimalPerfectHash(a, b)
        assert np.sort(h.find(a, b)).tolist() == list(range(n))


def plain_steps(t, order):
    """For every token: its n-grams of each order, and their contexts."""
    padded = ["<s>"] * (order - 1) + t
    for i in range(len(t)):
        own = padded[: i + order]
        yield [tuple(own[-k:]) for k in range(1, order + 1)]


def plain_counts(texts, order):
    grams, after = collections.Counter(), collections.Counter()
    for t in texts:
        for own in plain_steps(t, order):
            for g in own:
                grams[g] += 1
                after[g[:-1]] += 1
    return grams, after


def plain_parts(t, grams, after, order, n):
    for own in plain_steps(t, order):
        yield [(grams[own[0]] / max(n, 1), 0)] + [(grams[g] / max(after[g[:-1]], 1), min(int(math.log2(after[g[:-1]] + 1)), S.BUCKETS - 1)) for g in own[1:]]


def plain_weights(rows, order):
    fit, tuned = ([t for i, t in rows if f(S.remainder(i, 10))] for f in (lambda r: r > 1, lambda r: r == 1))
    grams, after = plain_counts(fit, order)
    n, v = sum(map(len, fit)), len({w for t in fit for w in t})
    cells = collections.Counter()
    for t in tuned:
        for parts in plain_parts(t, grams, after, order, n):
            cells[tuple(b for _, b in parts[1:]), tuple(round(math.log2(x) * S.STEPS) if x > 0 else -2000 for x, _ in parts)] += 1
    return S.learn([(a, b, k) for (a, b), k in cells.items()], order, v)


def plain_probabilities(t, grams, after, order, n, v, weights):
    for parts in plain_parts(t, grams, after, order, n):
        p = 1 / (v + 1)
        for k, (x, b) in enumerate(parts):
            p = weights[k, b] * x + (1 - weights[k, b]) * p
        yield p


def test_counts_beyond_32_bits():
    for x in (np.array([[1, 2], [3, 0]]), np.array([[1 << 40, 2], [3, (1 << 32) - 1]])):
        assert S.unpacked_counts(S.packed_counts(x)).reshape(2, -1).tolist() == x.tolist()


@pytest.mark.parametrize("size", [500, 1 << 20])
@pytest.mark.parametrize("order", [2, 3])
def test_lm_scoring(spark, size, order):
    rows = [(x[0], WORD.findall(edge.ascii_lower(x[1] or "")) + [None]) for x in edge.rows()]
    train = [(i, t) for i, t in rows if S.remainder(i, 10)]
    c = collections.Counter(w for _, t in train for w in t)
    n, v = sum(c.values()), len(c)
    got = S.score(edge.documents(spark), order=order, block_bytes=size).toPandas().sort_values(["doc_id"], kind="stable")
    want = sorted(rows, key=lambda x: x[0])
    assert got["doc_id"].tolist() == [i for i, _ in want]
    for r, (i, t) in zip(got.itertuples(), want, strict=True):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 10 == 0, len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(base) and r.score < 0
    weights = plain_weights(rows, order)
    grams, after = plain_counts([t for _, t in train], order)
    for r, (_, t) in zip(got.itertuples(), want, strict=True):
        assert r.score == pytest.approx(sum(math.log10(p) for p in plain_probabilities(t, grams, after, order, n, v, weights)))
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()
    assert S.score(edge.empty(spark)).count() == 0


def test_lm_is_a_distribution():
    """Against a plain computation of the interpolated bigram probabilities; those of all words and one unknown sum to 1."""
    weights = np.full((2, S.BUCKETS), 0.3)
    weights[1, 3:] = 0.8
    words = ["a", "b", "a", "c", "a", "b", None]
    uni = collections.Counter(words)
    for context in "abc":
        after = collections.Counter(y for x, y in zip(words, words[1:], strict=False) if x == context)
        total = 0
        for w in [*uni, "unknown"]:
            ml = [np.array([uni[w] / 7]), np.array([after[w] / uni[context]])]
            at = [np.zeros(1, int), S.bucket(np.array([uni[context]]))]
            total += S.probability(ml, at, weights, len(uni))[0]
        assert total == pytest.approx(1)


def test_expectation_maximisation_raises_the_likelihood():
    rows = [((3,), (-2, -6), 50), ((3,), (-2000, -4), 30), ((8,), (-1, -9), 70), ((0,), (-2000, -2000), 5)]
    rows = [(a, (b[1], b[0]), n) for a, b, n in rows]
    likelihood = lambda w: sum(n * math.log(S.probability([np.array([2 ** (x / S.STEPS) if x > -1000 else 0]) for x in b], [np.zeros(1, int), np.array(a)], w, 100)[0]) for a, b, n in rows)
    assert likelihood(S.learn(rows, 2, 100)) > likelihood(np.full((2, S.BUCKETS), 0.5))


def test_decontamination(spark):
    docs = edge.documents(spark)
    texts = [x[1] for x in edge.rows() if x[1]]
    long = " ".join(ALNUM.findall(texts[2])[:14])
    items = [(1, long.upper()), (2, "x"), (3, None), (4, ""), (5, " ".join(ALNUM.findall(texts[4])[:6])), (10, long), (11, "never seen anywhere words of ten or more in this item here")]
    items = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")
    found = D.contamination(docs, items).collect()
    got = counted((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["contaminated"]) for r in found)
    want = in_duckdb(D.OP10_SQL, documents=docs.select("doc_id", "text"), benchmark=items.select("item_id", "text"))
    assert got == counted(map(tuple, want[["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]].itertuples(index=False)))
    assert want["contaminated"].sum() > 2
    assert D.contamination(edge.empty(spark), items).count() == 0
    assert not any(r["contaminated"] for r in D.contamination(docs, items.limit(0)).collect())


def test_decontamination_in_several_query_blocks(spark, monkeypatch):
    docs = edge.documents(spark)
    items = spark.createDataFrame([(k, " ".join(ALNUM.findall(x[1] or "")[:12])) for k, x in enumerate(edge.rows())], "item_id long, text string")
    key = lambda r: (r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]))
    one = counted(map(key, D.contamination(docs, items).collect()))
    monkeypatch.setattr(D, "QUERY_BYTES", 1000)
    assert len(list(D.query_blocks(items, "item_id", "text", 10))) > 2
    assert counted(map(key, D.contamination(docs, items).collect())) == one


def test_decontamination_lists_an_item_once(spark, monkeypatch):
    docs = edge.documents(spark)
    texts = [" ".join(ALNUM.findall(x[1] or "")[:12]) for x in edge.rows()]
    rows = [(1, texts[2]), (1, texts[2]), (2, texts[4]), (2, " ".join(texts[4].split()[:6])), (3, texts[4])]
    items = spark.createDataFrame(rows, "item_id long, text string")
    want = in_duckdb(D.OP10_SQL, documents=docs.select("doc_id", "text"), benchmark=items)
    want = counted(map(tuple, want[["doc_id", "n_hit", "n_items", "items_sha256"]].itertuples(index=False)))
    assert max(x[2] for x, _ in want) > 1
    for size in (D.QUERY_BYTES, 100):
        monkeypatch.setattr(D, "QUERY_BYTES", size)
        got = D.contamination(docs, items).collect()
        assert counted((r["doc_id"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest()) for r in got) == want
        found = [r["items"] for r in D.phrase_matches(D.build_index(docs), items).collect()]
        assert any(found) and all(len(x) == len(set(x)) for x in found)


def test_hardly_a_pair_at_the_limit_is_left_unconfirmed():
    below = -(-N.LEAST_ESTIMATE * N.REGISTERS // 1)
    lost = sum(math.comb(N.REGISTERS, k) * 0.75**k * 0.25 ** (N.REGISTERS - k) for k in range(int(below)))
    assert lost < 0.001 * (1 - 0.75**N.ROWS) ** (N.REGISTERS // N.ROWS)
    a = np.arange(N.REGISTERS, dtype="<u2")
    b = np.where(a < 66, a, a + 1000).astype("<u2")
    rows = {"own": [0, 0], "x": [0, 0], "y": [0, 0], "node": ["a", "b"], "root": ["a", "b"], "sketch": [a.tobytes(), b.tobytes()]}
    assert [(i, list(j)) for i, j in N.candidates(pa.table(rows))[2]] == [(0, [1])]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one two x x three"), (2, "three x x x x one x two"), (3, "one two"), (4, "three"), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "three one two")], "item_id long, text string")
    for within, want in ((4, set()), (5, {1}), (7, {1}), (8, {1, 2})):
        found = D.proximity_matches(D.build_index(docs.coalesce(1)), items, within).collect()
        assert {r["doc_id"] for r in found} == want


def test_mixing(spark):
    docs = edge.documents(spark)
    found = X.mix(docs).toPandas()
    want = in_duckdb(X.OP2_SQL, documents=docs.select("doc_id", "text", "source"))
    key = lambda df: counted((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in df.astype({"size": "int64"}).itertuples(index=False))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    assert key(found[columns].rename(columns={"size": "size"})) == key(want[columns])
    taken = lambda df: counted((r.doc_id, r.taken) for r in df[["doc_id", "taken"]].astype("int64").itertuples(index=False))
    assert taken(found) == taken(want) and (found["taken"] <= 3 * found["size"]).all()
    again = X.mix(docs.repartition(5)).toPandas()
    assert counted(map(tuple, again[["doc_id", "taken"]].itertuples(index=False))) == counted(map(tuple, found[["doc_id", "taken"]].itertuples(index=False)))
    assert X.mixed(docs).columns == docs.columns and X.mixed(docs).count() == found["copies"].sum()
    assert X.mix(edge.empty(spark)).count() == 0


def test_inclusion_follows_the_size_and_the_target(spark):
    """Over many sources with the same sizes, documents are taken as often as their inclusion probabilities say."""
    sizes = [1, 1, 2, 2, 3, 5, 8, 8, 13, 40] * 3
    rows = [(100 * s + k, " ".join("w" * n), f"{s:04}") for s in range(600) for k, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = X.mix(docs, weights=(3, 4, 5)).toPandas()
    for kind, own in found.groupby(found["source"].astype(int) % 3):
        rest = own["target"].iloc[0] % sum(sizes)
        certain = own["target"].iloc[0] // sum(sizes)
        p = dict.fromkeys(sizes, 0.0)
        for factor in np.linspace(0, 2, 20001):
            if sum(min(1, factor * n) * n for n in sizes) >= rest:
                p = {n: min(1, factor * n) for n in sizes}
                break
        for n, chosen in own.groupby("size"):
            assert (chosen["copies"] - certain).mean() == pytest.approx(p[n], abs=0.06 if 0 < p[n] < 1 else 1e-9), (kind, n)
        assert not rest or own.groupby("size")["copies"].mean().is_monotonic_increasing


def test_targets_stop_at_three_times_the_size(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 0), (None, 100)], "source string, size long")
    got = {r["source"]: r["target"] for r in X.targets(sizes).collect()}
    even = spark.createDataFrame([(f"s{k}", 100) for k in range(9)], "source string, size long")
    assert {r["source"]: round(r["target"], 6) for r in X.targets(even).collect()} == {f"s{k}": (50, 100, 150)[k % 3] for k in range(9)}
    assert got["b"] == 30 and got["c"] == 0 and got["a"] + got[None] == pytest.approx(1080) and got[None] == 300


def brute_components(rows):
    sets = []
    for _, text, *_ in rows:
        w = WORD.findall(edge.ascii_lower(text or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(rows):
        least[find(i)] = min(least.get(find(i), x[0]), x[0])
    return [(x[0], len(sets[i]), least[find(i)], x[0] == least[find(i)]) for i, x in enumerate(rows)]


def test_near_groups(spark):
    rows = edge.rows(n=120, seed=9)
    found = N.near_groups(edge.documents(spark, n=120, seed=9)).collect()
    assert counted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found) == counted(brute_components(rows))
    assert N.near_groups(edge.empty(spark)).count() == 0


def test_a_chain_of_near_copies_is_one_group(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(100 - k, " ".join(words[2 * k : 2 * k + 60])) for k in range(60)]  # neighbours are alike, the ends are not
    got = N.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(i, 41) for i, _ in rows}


def test_super_minhash_estimates_and_fills_small_sets():
    r = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        a = r.integers(0, 1 << 63, 500, dtype=np.uint64)
        b = np.concatenate([a[:400], r.integers(0, 1 << 63, 100, dtype=np.uint64)])
        s = N.super_minhash(np.concatenate([a, b]), np.array([0, 500, 1000]))
        errors.append((s[0] == s[1]).mean() - 400 / 600)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    s = N.super_minhash(a[:2], np.array([0, 2, 2]))
    assert (s[0] != N.UNSET).all() and (s[1] == N.UNSET).all()
    levels = np.sort(s[0] >> np.uint64(32))
    assert np.bincount(levels.astype(int)).max() <= 2  # each element gives every level to one register


def test_components(spark):
    links = [(b"a", b"b"), (b"c", b"b"), (b"d", b"e"), *[(f"p{i:03}".encode(), f"p{i + 1:03}".encode()) for i in range(60)]]
    got = {bytes(r["node"]): bytes(r["root"]) for r in N.components(spark.createDataFrame(links, "a binary, b binary")).collect()}
    assert got[b"c"] == b"a" and got[b"e"] == b"d" and got[b"p060"] == b"p000" and len(got) == 5 + 61


def test_copies_of_one_text_that_are_not_alike_themselves(spark, monkeypatch):
    """Copies are linked through the text they come from, whichever of them is a bucket's hub, and over chunks."""
    import random

    r = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = [(500, " ".join(base))]
    for k in range(60):
        copy = list(base)
        for at in r.sample(range(200), 5 if k % 3 else 7):
            copy[at] = f"x{k}y{at}"
        rows.append((k, " ".join(copy)))
    monkeypatch.setattr(N, "CHUNK", 20)
    found = N.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert counted((x["doc_id"], x["n_shingles"], x["component_id"], x["kept"]) for x in found) == counted(brute_components(rows))
    assert len({x["component_id"] for x in found}) > 5


def test_one_row_of_a_group_stays_whatever_the_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (1, base), (1, "quite another text with words of its own"), (2, base + " more"), (None, base), (None, "alone without an id one two three"), (None, None), (None, None), (3, ""), (0, base + " end")]
    docs = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, text_hash string").repartition(3)
    want = [(0, base + " end"), (1, "quite another text with words of its own"), (3, ""), (None, None), (None, None), (None, "alone without an id one two three")]
    assert collections.Counter((r["doc_id"], r["text"]) for r in N.first_of_groups(docs).collect()) == collections.Counter(want)
    equal = spark.createDataFrame([(5, base, "x")] * 4, docs.schema)
    assert [tuple(r) for r in N.first_of_groups(equal).collect()] == [(5, base, "x")]
    assert N.first_of_groups(docs.limit(0)).count() == 0
