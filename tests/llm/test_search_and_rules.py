import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from tests.llm import edge
from tests.llm.test_text_operators import counted, in_duckdb

from scribemill.llm import lexical_search as A
from scribemill.llm import resampling as R
from scribemill.llm import url_rules as U

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string, doc_id long, score string, rank string"


def terms(text):
    return ALNUM.findall(edge.ascii_lower(text or ""))


def features(text, runs=2):
    w = terms(text)
    return [" ".join(w[i : i + n]) for n in range(1, runs + 1) for i in range(len(w) - n + 1)]


def items(rows):
    texts = [x[1] for x in rows if x[1]]
    return [(0, texts[3][:200]), (1, texts[10][40:300] + " never seen"), (2, None), (3, ""), (4, "..."), (5, "x"), (5, texts[20]), (None, "X " + texts[5][:90]), (0, texts[3][:200])]


# ------------------------------------------------------------------ resampling


def resampled(rows, target, runs, buckets, least, percent, seed):
    bucket = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = (collections.Counter(bucket(f) for x in texts for f in features(x, runs)) for texts in ([x[1] for x in rows], target))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (n_s + float(buckets)) / ((s[b] + 1.0) * (n_t + float(buckets))))) for b in range(buckets)]
    out = []
    for x in rows:
        own = [gain[bucket(f)] for f in features(x[1], runs)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if x[0] is None else x[0]}".encode()).hexdigest()[:8], 16)
        out.append([x[0], len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(terms(x[1]))])
    asked = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for k, x in enumerate(asked[: percent * len(asked) // 100]):
        x[4] = k + 1
    return out


@pytest.mark.parametrize("runs,buckets,percent", [(2, 10_000, 25), (1, 7, 60), (3, 70_000, 100)])
def test_resampling(spark, monkeypatch, runs, buckets, percent):
    monkeypatch.setattr(R, "ROW_BYTES", 900)
    rows = edge.rows(null_ids=True)
    target = [x[1] for x in items(rows)]
    got = R.resampled(edge.documents(spark, null_ids=True), spark.createDataFrame(items(rows), "item_id long, text string"), runs, buckets, 20, percent)
    assert counted(map(str, (tuple(r[c] for c in ("doc_id", "n_features", "weight", "score")) for r in got.collect()))) == counted(str(tuple(x[:4])) for x in resampled(rows, target, runs, buckets, 20, percent, 7))
    # rows that share id and text may change places
    ranks = lambda rows: sorted((x["rank"], x["score"]) for x in rows if x["rank"] is not None)
    want = [dict(zip(("doc_id", "n_features", "weight", "score", "rank"), x, strict=False)) for x in resampled(rows, target, runs, buckets, 20, percent, 7)]
    assert ranks(got.collect()) == ranks(want) and ranks(want)


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert R.resampled(edge.empty(spark), none).count() == 0
    assert {r["rank"] for r in R.resampled(spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string"), none).collect()} == {None}


def test_scan_in_pieces():
    r = random.Random(5)
    text = " ".join("".join(r.choice("abcÅé-\x00") for _ in range(r.randint(1, 40))) for _ in range(400)) + "Q" * 9000 + " end"
    for size in (1, 7, 100, 5000, 1 << 20):
        ring, got = [], []
        for words in R.pieces(text.encode(), size):
            got += R.scan(words, 3, ring)
        assert sorted(got) == sorted(zlib.crc32(x.encode()) for x in features(text, 3))
    assert list(R.pieces(b"")) == []


def test_resampling_sql(spark):
    rows = [x for x in dict((x[0], x) for x in edge.rows(null_ids=True) if x[0] is not None).values()]
    docs, target = spark.createDataFrame(rows, edge.SCHEMA), spark.createDataFrame(items(rows), "item_id long, text string")
    want = in_duckdb(R.OP11_SQL, documents=docs, benchmark=target)
    got = R.resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank").toPandas()
    key = lambda df: sorted(map(str, df.astype(object).where(df.notna(), -1).astype(int).values.tolist()))
    assert key(got) == key(want)


# ------------------------------------------------------------------ search


def searched(docs, asked, k):
    texts = [(x[0], collections.Counter(terms(x[1]))) for x in docs]
    n_all, l_all = sum(bool(c) for _, c in texts), sum(c.total() for _, c in texts)
    df = collections.Counter(t for _, c in texts for t in c)
    out = []
    for item_id, text in asked:
        found = []
        for doc_id, c in texts:
            score = 0
            for t in set(terms(text)) & set(c):
                m = 100 - 50 + (50 * c.total() * n_all) // l_all
                score += math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("k,size,asked", [(50, 1 << 20, 1 << 24), (3, 2000, 1 << 24), (1, 1, 400), (1000, 3000, 1 << 24)])
def test_search(spark, monkeypatch, k, size, asked):
    monkeypatch.setattr(A, "QUERY_BYTES", asked)
    monkeypatch.setattr(A, "FIRST_TURN", 2)
    rows = edge.rows(null_ids=True)
    table = spark.createDataFrame([(*x, 0, "s", "r") for x in items(rows)], ITEMS)
    got = A.search(edge.documents(spark, null_ids=True), table, k, block_bytes=size)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert counted(map(str, (tuple(r) for r in got.collect()))) == counted(map(str, searched(rows, items(rows), k)))


def test_search_of_nothing(spark):
    table = spark.createDataFrame(items(edge.rows(null_ids=True)), "item_id long, text string")
    assert A.search(edge.empty(spark), table).count() == 0
    assert A.search(edge.documents(spark, null_ids=True), spark.createDataFrame([], "item_id string, text string")).count() == 0


def test_search_stops_early(spark):
    """With a list of many equal entries and a document that stands out, few documents are scored; equal scores all are."""
    texts = ["rare common"] * 3 + ["common " + "other " * (k % 7 + 1) for k in range(2000)]
    row = A.build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).first().asDict()
    asked = A.Items([0], ["rare common"])
    shelf = A.Shelf(row, asked.terms, 2003, row["n_terms"])
    scored = []
    scores = shelf.scores
    shelf.scores = lambda d, w: (scored.append(len(d)), scores(d, w))[1]
    weight_of = np.array([9000 if t.as_py() == b"rare" else 10 for t in asked.terms])
    documents, found = shelf.best(asked.of[0], weight_of, 2, 1)
    assert sorted(documents) == [0, 1, 2] and len(set(found)) == 1 and sum(scored) < 100
    assert len(shelf.best(asked.of[0], weight_of, 2, int(found[0]) + 1)[0]) == 0 and not shelf.seen.any()


def test_search_bounds():
    big = A.impacts(np.array([3, 1]), np.array([10**9, 5]), 10**12, 10**14)
    assert big.tolist() == [1_000_000_000 * c // (1000 * c + 20 * (50 + 50 * n * 10**12 // 10**14)) for c, n in ((3, 10**9), (1, 5))]


def test_search_sql(spark):
    rows = [x for x in dict((x[0], x) for x in edge.rows(null_ids=True) if x[0] is not None).values()]
    docs, table = spark.createDataFrame(rows, edge.SCHEMA), spark.createDataFrame(items(rows)[:6], "item_id long, text string")
    want = in_duckdb(A.OP12_SQL, documents=docs, benchmark=table)
    assert counted(map(tuple, A.search(docs, table).collect())) == counted(map(tuple, want.astype(int).values.tolist()))


# ------------------------------------------------------------------ url rules

URLS = [
    "http://example.org/es/1", "https://A.Example.ORG/en/123?x=1", "https://b.example.org/en/2", "http://example.org", "http://example.org?/es/", "http://org/x", "http://notexample.org/es/", "http://xorg/", "http://a.com/fr/1#top",
    "http://a.com/FR/1", "http://COM/de/", "http://a.net/casino", "http://a.net/casinos", "http://my-casino.net", "https://a.com/de/casino", "http://a.net/robots.txt", "http://adult.net/robots.txt", "http://a.net/x/robots.txt?",
    "no scheme/casino", "", None, "http://", "://h/p?q", "http://h#/x", "http://u\nv.org/\n", "http://é.org/ß", "http://x.net/" + "a-" * 40_000 + "casino", "a://b://c.org/", "http://a.net/cgi-bin", "http://a.net/cgi_bin", "http://a.net/wp-login.phpx", "http://org:80/x", "http://a.org./x", "http://.org/x", "http://a.org//es/",
]


def by_hand(url):
    place = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (edge.ascii_lower(place[1]), place[2]) if place else ("", "")
    fits = [(len(r), r, a) for a, r in U.PLACES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    low = edge.ascii_lower(url or "")
    words = [w for w in U.PATTERNS if re.fullmatch(r"\^[a-z-]+\^", w) and re.search(r"[^a-z0-9]" + w.strip("^") + r"([^a-z0-9]|\Z)", low)]
    words += ["^wp-login.php"] * bool(re.search(r"[^a-z0-9]wp-login\.php", low))
    pattern, verdict = max(((len(w), w) for w in words), default=(0, None))[1], "block" if words else "allow"
    if re.search(r"[^a-z0-9]robots\.txt\Z", low):
        pattern, verdict = "^robots.txt|", "allow"
    if fits:
        return host, path, max(fits)[1], max(fits)[2], None
    return host, path, None, verdict, pattern


@pytest.mark.parametrize("most", [U.BROADCAST_BYTES, 0])
def test_url_rules(spark, monkeypatch, most):
    monkeypatch.setattr(U, "BROADCAST_BYTES", most)
    rows = [(k, u, "h", "clash", "clash", "clash") for k, u in enumerate(URLS + URLS[:3] + [URLS[0]] * 200)] + [(None, URLS[1], None, None, None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, token string, number string").repartition(3)
    got = U.judged(pages)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "pattern"]
    assert counted(map(str, (tuple(r) for r in got.collect()))) == counted(str((x[0], *by_hand(x[1]))) for x in rows)
    assert U.judged(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in U.judged(pages, U.rule_table(spark, (), ())).collect()} == {"allow"}


def test_url_rules_sql(spark):
    pages = spark.createDataFrame(list(enumerate(URLS[:-10] * 2)), "page_id long, url string")
    want = in_duckdb(U.OP13_SQL, pages=pages)
    got = U.judged(pages).toPandas()
    key = lambda df: sorted(map(str, df[got.columns].astype(object).where(df.notna(), None).values.tolist()))
    assert key(got) == key(want)


def test_patterns(spark):
    """Each kind of anchor and wildcard, and the tokens that a rule may be indexed by."""
    rules = {"||ads.net^": ["ads", "net"], "|http://a*z|": ["http"], "foo*bar": [], "a.b/c": ["b"], "^x^": ["x"], "*": [], "(y)^q": ["y"], "@@||ok.com/f": ["ok", "com"], "end|": [], "A.B^": ["b"]}
    hits = {"||ads.net^": ["http://ads.net", "https://x.ads.net/1"], "|http://a*z|": ["http://abc/z"], "foo*bar": ["http://q/foo/1bar2"], "a.b/c": ["http://ba.b/cd"], "^x^": ["http://x"], "(y)^q": ["http://h/(y)/qq"], "@@||ok.com/f": ["http://ok.com/foo"], "end|": ["http://h/friend"], "A.B^": ["http://a.b"]}
    misses = {"||ads.net^": ["http://bads.net", "http://h/ads.net", "http://ads.network"], "|http://a*z|": ["http://abc/zy", "x http://az"], "foo*bar": ["http://bar/foo"], "a.b/c": ["http://axb/c"], "^x^": ["http://xx"], "(y)^q": ["http://h/yq"], "@@||ok.com/f": ["http://nook.com/f"], "end|": ["http://end/"], "A.B^": ["http://a.bc"]}
    table = {r["rule"]: r for r in U.compiled(U.rule_table(spark, (), tuple(rules))).collect()}
    assert {x: table[x.removeprefix("@@")]["words"] for x in rules} == rules
    for x in hits:
        pages = spark.createDataFrame([(1, u) for u in hits[x]] + [(0, u) for u in misses[x]], "page_id long, url string")
        found = U.judged(pages, U.rule_table(spark, (), (x, "@@never"))).collect()
        assert all((r["pattern"] is not None) == (r["page_id"] == 1) for r in found), x
    # of two tokens the one in fewer urls is the key
    pages = spark.createDataFrame([(1, "http://x.com/a"), (2, "http://y.com/b")], "page_id long, url string")
    index = U.rule_index(U.compiled(U.rule_table(spark, (("allow", "com/a/"), ("block", "org/")), ("*",))), pages).collect()
    assert sorted(r["token"] for r in index) == ["", "a", "org"]


def test_native_plan(spark):
    """No Python and no join but those with broadcast rules; one shuffle of the pages' rows."""
    pages = spark.createDataFrame([(1, "http://x.com/a")], "page_id long, url string")
    plan = U.judged(pages)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|SortMergeJoin|Cartesian", plan.split("== Physical Plan ==")[1])
