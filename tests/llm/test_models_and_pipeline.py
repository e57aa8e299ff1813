import html
import random
import re

import numpy as np
import pyarrow as pa
from tests.llm import edge

import corpus_pipeline
from scribemill.llm import html_extraction as H
from scribemill.llm import toxicity as T
from scribemill.llm._arrays import texts


def labelled(n=600, seed=2):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 5))) for _ in range(2000)]
    bad = ["nasty", "vile", "awful"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        w = [r.choice(words) for _ in range(r.randint(20, 120))]
        for _ in range(3 if toxic else 0):
            w.insert(r.randrange(len(w)), r.choice(bad) + r.choice(["", "!", "***"]))
        docs.append((i, " ".join(w), "en" if i % 2 else "de", "a", len(w)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled()
    docs = spark.createDataFrame([*docs, (900, None, None, None, None), (901, "", "en", "a", 0), (902, "nasty", "xx", "a", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([*labels, (5000, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    model = T.fit(docs, labels)
    got = {r["doc_id"]: r for r in T.classify(docs, model).collect()}
    assert len(got) == 603 and all(0 <= r["score"] <= 1 for r in got.values())
    import zlib

    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = [(got[i]["score"] >= 0.5) == (i % 6 == 0) for i in held]
    assert np.mean(right) > 0.95
    assert got[900]["score"] == got[901]["score"] < 0.5 and got[902]["score"] > 0.5
    assert all(t >= 0.5 for t in model.thresholds.values())
    again = T.fit(docs.repartition(3), labels.repartition(2))
    assert np.array_equal(again.tables, model.tables)


def test_toxicity_without_labels_and_rows(spark):
    docs = edge.documents(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = T.fit(docs, labels)
    assert all(r["score"] < 0.5 and not r["rejected"] for r in T.classify(docs, model).collect())
    kept = T.classify(docs, model, keep=True)
    assert kept.count() == docs.count()
    assert T.classify(edge.empty(spark), model).count() == 0


def test_pooling_is_the_largest_response_over_the_words():
    model = T.Model(buckets=64, dim=4, filters=3)
    data, offsets = texts(pa.array(["a b c d a", "", "b"]))
    distinct, codes, starts = T.padded(data, offsets)
    a, b = model.rows(distinct)
    table = np.concatenate([model.tables[0, a] + model.tables[1, b], np.zeros((1, 4), np.float32)])
    best, _ = model.pooled(table, codes, starts)
    bounds = [*starts, len(codes)]
    for d in range(3):
        e = table[codes[bounds[d] : bounds[d + 1]]]
        for w, kernel, top in zip(model.widths, model.kernels, best, strict=True):
            padded = np.concatenate([e, np.zeros((w, 4))])
            n_windows = len(e) - max(model.widths) + 1  # from each word and from the first padding word
            want = np.max([np.einsum("wd,wdf->f", padded[i : i + w], kernel) for i in range(n_windows)], axis=0)
            assert np.allclose(top[d], want, atol=1e-5)


def test_gradients_lower_the_loss():
    docs, labels = labelled(200)
    data, offsets = texts(pa.array([x[1] for x in docs]))
    distinct, codes, starts = T.padded(data, offsets)
    y = np.array([x[2] for x in labels], float)
    model = T.Model()
    T.seed_tables(model, distinct, codes, starts, y)
    loss = lambda p: -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    before = loss(np.clip(model.score(distinct, codes, starts), 1e-9, 1 - 1e-9))
    T.train(model, distinct, codes, starts, y)
    assert loss(np.clip(model.score(distinct, codes, starts), 1e-9, 1 - 1e-9)) < before / 2


def test_extraction_on_unseen_pages():
    field = H.trained()
    right = 0
    for k in range(100):
        page, main = H.labelled_page(77_000_000 + k)
        right += H.main_text(page, field) == "\n".join(main)
    assert right >= 92


def test_viterbi_and_marginals_against_all_labellings():
    r = np.random.default_rng(3)
    field = H.Field()
    field.moves, field.first = r.normal(size=(2, 2)), r.normal(size=2)
    potentials = r.normal(size=(5, 2))
    best, total, single, pairs = None, 0.0, np.zeros((5, 2)), np.zeros((2, 2))
    for code in range(32):
        y = [code >> i & 1 for i in range(5)]
        s = field.first[y[0]] + sum(potentials[i, y[i]] for i in range(5)) + sum(field.moves[a, b] for a, b in zip(y, y[1:], strict=False))
        best = max(best, (s, y)) if best else (s, y)
        total += np.exp(s)
        for i in range(5):
            single[i, y[i]] += np.exp(s)
        for a, b in zip(y, y[1:], strict=False):
            pairs[a, b] += np.exp(s)
    assert field.viterbi(potentials) == best[1]
    got = field.marginals(potentials)
    assert np.allclose(got[0], single / total) and np.allclose(got[1], pairs / total)


def test_leaf_blocks():
    page = '<!doctype html><head><title>no</title><body><p>a <b>b<br>c<p>d&nbsp;&amp;<!-- x --> e</p><ul><li>1<li>2</ul><script>"</p>"</script>tail <a href=x>l</a> 3 < 4'
    assert [x for x, _ in H.leaf_blocks(page)] == ["a b c", "d & e", "1", "2", "tail l 3 < 4"]
    assert H.leaf_blocks("") == [] and H.leaf_blocks("<p> </p>") == []
    for broken in ("<", "<p", '<a href="', "<!--", "<script>x", "</p></p>", "<p 'x>y", "&#xFFFFFFFF; &bogus;"):
        H.leaf_blocks(broken * 50)


def test_custom_elements_and_open_drawings_keep_the_page():
    article = "<article><p>Some words of the article stand here.</p></article>"
    for odd in ("<svg-icon name=a></svg-icon>", "<title-bar>", "<object-x/>", "<script-y>", '<svg width="1"/>', "<svg>", "<object data=x>", "<noscript>", "<!-->", "<!--->", "<!-- x --!>", "<svg><path d='M0'/></svg>", "<math/>"):
        assert [x for x, _ in H.leaf_blocks(odd + article)][-1] == "Some words of the article stand here.", odd
    assert [x for x, _ in H.leaf_blocks("<svg><text>no</text></svg><template><p>no</p></template>" + article)] == ["Some words of the article stand here."]
    assert H.leaf_blocks("<title>no") == [] and H.leaf_blocks("<script>if (a</script-b>) no</script >") == []


# Pages written by hand, in ways the generator does not use, with their main text.
BY_HAND = [
    (
        """<html><head><meta charset=utf-8><title>Tide tables</title></head><body>
<div id=masthead><a href="/">The Harbour Post</a> <span>Thursday edition</span></div>
<div role=navigation><a href=/a>News</a> | <a href=/b>Weather</a> | <a href=/c>Ships</a> | <a href=/d>Contact</a></div>
<div class="story-body"><h1>Tides will be higher than usual this week</h1>
<p>The harbour master expects water levels of up to two metres above the mean on Friday night, the highest since records began.</p>
<p>Boats moored along the eastern quay should be moved before noon, she said, and the lower car park will be closed until Monday.</p>
<div class="advertisement"><a href=/buy>Buy rope now</a></div>
<p>Similar levels were last seen eleven years ago, when several cellars in the old town were flooded.</p></div>
<div id=footer>&copy; The Harbour Post. All rights reserved. <a href=/terms>Terms</a></div></body></html>""",
        ["Tides will be higher than usual this week", "The harbour master expects water levels of up to two metres above the mean on Friday night, the highest since records began.", "Boats moored along the eastern quay should be moved before noon, she said, and the lower car park will be closed until Monday.", "Similar levels were last seen eleven years ago, when several cellars in the old town were flooded."],
    ),
    (
        """<!doctype html><body class=home><header><svg-icon></svg-icon><h2>Bread blog</h2><nav><ol><li><a href=1>Start</a><li><a href=2>Recipes</a><li><a href=3>About</a></ol></nav></header>
<main><article><header><h1>Rye bread in two days</h1></header><section><p>Mix the flour and the water in the evening, cover the bowl, and leave it in a warm place until the next day.</p>
<h3>What you need</h3><ul><li>Five hundred grams of rye flour<li>Three hundred grams of water<li>A spoon of salt</ul>
<p>Bake it for an hour, and let it rest for as long as you can wait.</p></section></article>
<aside class=related><h3>More recipes</h3><a href=4>Rolls</a><a href=5>Crackers</a></aside>
<section id=comments><h2>Comments</h2><div class=comment><p>I tried it and it was very good, thank you!</p></div></section></main>
<footer><p>Written at home.</p></footer><script>var p = "<p>not text</p>";</script></body>""",
        ["Rye bread in two days", "Mix the flour and the water in the evening, cover the bowl, and leave it in a warm place until the next day.", "What you need", "Five hundred grams of rye flour", "Three hundred grams of water", "A spoon of salt", "Bake it for an hour, and let it rest for as long as you can wait."],
    ),
]


def test_pages_of_another_author():
    right = wrong = missed = 0
    for page, main in BY_HAND:
        got = H.main_text(page, H.trained()).split("\n")
        right, wrong, missed = right + len(set(got) & set(main)), wrong + len(set(got) - set(main)), missed + len(set(main) - set(got))
    assert right >= 10 and wrong <= 1 and missed <= 1, (right, wrong, missed)


def test_training_earns_its_place():
    """Held-out ranking with the seeded tables alone, with training from random tables, and with both."""
    docs, labels = labelled(1500, seed=6)
    data, offsets = texts(pa.array([x[1] for x in docs]))
    distinct, codes, starts = T.padded(data, offsets)
    y = np.array([x[2] for x in labels], float)
    parts = np.split(codes, starts[1:])

    def part(of):
        own = [parts[i] for i in of]
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])[:-1]]).astype(np.int64)

    learn, test = np.arange(1000), np.arange(1000, 1500)
    got = {}
    for name in ("seeded", "trained", "both"):
        model = T.Model()
        if name != "trained":
            T.seed_tables(model, distinct, *part(learn), y[learn])
        if name != "seeded":
            T.train(model, distinct, *part(learn), y[learn])
        z = model.score(distinct, *part(test))
        loss = -np.mean(y[test] * np.log(z + 1e-9) + (1 - y[test]) * np.log(1 - z + 1e-9))
        order = np.argsort(np.argsort(z, kind="stable"))
        auc = (order[y[test] > 0].mean() - (y[test].sum() - 1) / 2) / (1 - y[test]).sum()
        got[name] = (round(float(auc), 3), round(float(loss), 3))
    print(got)
    assert got["both"][0] > 0.97 and got["both"][1] < got["seeded"][1], got


def test_extract(spark):
    article = "<html><body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>T &amp; t</h1><p>One.<p>Two  words\n here.</article><footer>&copy; me</footer>"
    rows = [(1, "u", article), (1, "u", article), (2, None, None), (3, "u", ""), (4, "u", "<p></p>"), (5, "u", "<article>" + "<p>" + html.escape("long & text. ") * 20_000 + "</article>")]
    pages = spark.createDataFrame([(*x, "clash", "clash") for x in rows], "page_id long, url string, html string, text string, n_chars string")
    got = sorted(H.extract(pages).collect(), key=lambda r: r["page_id"])
    assert [r["text"] for r in got[:5]] == ["T & t\nOne.\nTwo words here."] * 2 + [""] * 3
    assert got[5]["n_chars"] == len(got[5]["text"]) == len(("long & text. " * 20_000).strip())
    assert H.extract(pages.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    docs, labels = labelled()
    r = random.Random(1)
    passage = " ".join(f"q{i}" for i in range(30))
    rows = [(i, text, lang, r.choice(["a", "b", None]), n) for i, text, lang, _, n in docs]
    rows += [(1000 + k, rows[k][1] + " more", "en", "a", 1) for k in (1, 2, 3)] + [(2000, "start " + passage + " end", "en", "a", 1), (2001, None, None, None, None), (2002, "", "en", "b", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, df, str(tmp_path))
        if k < 4:
            assert after.columns == df.columns
        after.write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        ids.append([x["doc_id"] for x in df.select("doc_id").collect()])
    toxic = {i for i, text, *_ in rows if re.search("nasty|vile|awful", text or "")}
    assert len(toxic & set(ids[0])) <= 0.1 * len(toxic) and len(set(ids[0]) - toxic) >= 0.98 * (len(rows) - len(toxic))
    assert set(ids[0]) - set(ids[1]) == {1001, 1002, 1003} & set(ids[0])
    assert set(ids[1]) - set(ids[2]) == {2000}
    assert set(ids[3]) <= set(ids[2]) and sorted(ids[3]) == sorted(ids[4])
    run = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
