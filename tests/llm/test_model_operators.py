"""Embeddings, search, pages, the two classifiers and the pipeline."""

import collections
import html
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from twingraph.llm import embed_dedup, html_extract, quality, topk, toxicity
from twingraph.llm.common import fold_of
from twingraph.llm.queries import queries, quality_held_out, toxic_held_out

SF, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def plain_links(rows, threshold=0.98):
    """(links, component) of each (id, vector, label) by comparing all pairs."""
    def usable(v, label):
        return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        return math.fsum(x * y for x, y in zip(a, b)) / math.hypot(*a) / math.hypot(*b)

    near = [{j for j, (_, w, m) in enumerate(rows) if j != i and usable(v, k) and usable(w, m) and k == m and len(v) == len(w)
             and cosine(v, w) >= threshold} for i, (_, v, k) in enumerate(rows)]
    label = [r[0] for r in rows]
    for _ in rows:
        label = [min([label[i], *(label[j] for j in near[i])]) for i in range(len(rows))]
    return [len(n) for n in near], label


@pytest.mark.parametrize("window,block,part", [(8, 16, 5), (4, 4, 1000), (256, 2048, 1024)])
def test_embedding_dedup_against_plain(spark, window, block, part):
    rng = np.random.default_rng(2)
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.01], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [math.nan, 1.0], 1), (8, [1.0, 0.0], None), (9, [1e-300, 0.0], 1), (10, [1.0], 1), (11, [None, 1.0], 1),
            (12, [math.inf, 1.0], 1), (13, [], 1)]
    for g in range(12):
        center = rng.standard_normal(16)
        rows += [(100 * g + 200 + i, (center + 0.12 * rng.standard_normal(16) / 2).tolist(), g % 2) for i in range(15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as v", "2 as keys", "3 as rep", "4 as cid", "5 as h1", "6 as n")
    out = {r.vec_id: r for r in embed_dedup.near_duplicates(df, window=window, block=block, part=part).collect()}
    links, label = plain_links(rows)
    found = [out[r[0]].n_links for r in rows]
    assert all(f <= n for f, n in zip(found, links))
    assert sum(found) >= 0.98 * sum(links)
    if sum(found) == sum(links):
        assert [out[r[0]].component_id for r in rows] == label
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.values())
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_windows_on_a_large_label(spark):
    """Recall on a label far above a window, and windows that go on across blocks."""
    rng = np.random.default_rng(7)
    base = rng.standard_normal((6000, 24))
    near = base[:1500] + 0.1 * rng.standard_normal((1500, 24))
    far = base[1500:2500] + 0.5 * rng.standard_normal((1000, 24))
    m = np.concatenate((base, near, far))
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(u @ u.T >= 0.98, 1))
    want = np.bincount(np.concatenate((i, j)), minlength=len(m))
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(m)], "vec_id long, embedding array<double>, label int")
    got = np.zeros(len(m), int)
    for r in embed_dedup.near_duplicates(df, window=32, block=256).collect():
        got[r.vec_id] = r.n_links
    assert len(i) > 1000 and (got <= want).all() and got.sum() >= 0.97 * want.sum()


def test_top_k_against_plain(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(8) / 3).tolist()) for i in range(700)]
    rows += [(700 + i, rows[i][1]) for i in range(50)]  # ties
    rows += [(800, None), (900, [math.nan] * 8), (1000, [None] * 8), (1100, [0.0] * 8), (1200, [1.0]), (1201, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    table = df.select("vec_id", topk.quantised(F.col("embedding")).alias("vector"), F.lit(1).alias("id"))
    got = sorted(tuple(r) for r in topk.top_k(table, table.where("vec_id % 100 = 0"), 10, group=100, query_block=3).collect())
    vectors = {i: [math.floor(1024 * x) for x in v] for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in vectors if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], w)), i) for i, w in vectors.items() if i != q and len(w) == len(vectors[q]))
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10])]
    assert got == sorted(want)
    assert topk.top_k(table.limit(0), table.limit(0)).count() == 0


def test_top_k_of_empty_vectors(spark):
    df = spark.createDataFrame([(0, []), (1, []), (2, []), (3, [1.0]), (100, [2.0])], "vec_id long, embedding array<double>")
    table = df.select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    got = sorted(tuple(r) for r in topk.top_k(table, table.where("vec_id % 100 = 0"), 10).collect())
    assert got == [(0, 1, 1, 0), (0, 2, 2, 0), (100, 1, 3, 1024 * 2048)]


def test_top_k_beyond_doubles(spark):
    rows = [(0, [2**40, 3]), (1, [2**20, 1]), (2, [2**20, 2]), (3, [-(2**20), 5])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = [(r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id = 0"), 2).orderBy("rank").collect()]
    assert got == [(2, 2**60 + 6), (1, 2**60 + 3)]


def plain_article(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.S)
    return " ".join(html.unescape(" ".join(re.split(r"<[^>]*>", re.sub(r"</?b>", "", inside[1])))).split()) if inside else ""


def test_pages_against_plain(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{MID}/pages.parquet").collect()}
    out = html_extract.extract_pages(spark.read.parquet(f"{MID}/pages.parquet").selectExpr("*", "1 as host", "2 as frame", "3 as text")).collect()
    assert len(out) == len(pages)
    assert all(r.text == plain_article(pages[r.page_id]) for r in out)


LAYOUT = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div>
<div class="wrap"><div class="sidebar">side <p>x</p></div><div class="content"><h2>Title &amp; more</h2><p>Some <b>bo</b>ld te&#120;t&nbsp; here %d</p>
%s<p>Para two<div class="ad">buy</div>tail</p></div></div><section id="comments"><p>first!</p></section><form>name <input></form><footer>(c)</footer>"""


def test_wrapper_finds_the_article_without_landmarks(spark):
    rows = [(i, f"http://a.example/{i}", LAYOUT % (i, f"<p>extra {i}</p>" * (i % 4))) for i in range(12)]
    rows += [(50, None, None), (51, "x", ""), (52, "http://b.example/", "just text &lt;"), (0, "http://a.example/0", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = collections.defaultdict(list)
    for r in html_extract.extract_pages(df).collect():
        out[r.page_id].append(r.text)
    for i in range(12):
        extra = f"extra {i} " * (i % 4)
        assert set(out[i]) == {f"Title & more Some bold text here {i} {extra}Para two tail"}
    assert len(out[0]) == 2
    assert out[50] == [""] and out[51] == [""] and out[52] == ["just text <"]
    wrapper = [r for r in html_extract.infer_wrappers(df).collect() if r.host == "a.example"]
    assert len(wrapper) == 1 and ")+" in wrapper[0].expression and wrapper[0].container.endswith("div.content")
    assert html_extract.extract_pages(df.limit(0)).count() == 0


BOXED = """<html><body><div class="top">Our site</div><article><h1>Title %d</h1><p>Text number %d here</p>%s
<div class="qx1"><p>Get our letter</p><p>every week</p></div><p>The end of %d</p></article><div class="below">Imprint</div></body></html>"""
TEASED = """<html><body><article class="qx2"><p>Buy a boat today</p></article><div class="qx3"><h2>Head %d</h2>
<p>The running text of page %d</p></div></body></html>"""


def test_wrapper_cuts_template_text_and_chooses_the_region(spark):
    rows = [(i, f"http://a.example/{i}", BOXED % (i, i, f"<p>more {i}</p>" * (i % 3), i)) for i in range(9)]
    rows += [(20 + i, f"http://b.example/{i}", TEASED % (i, i)) for i in range(9)]
    rows += [(40 + i, "http://c.example/", BOXED % (1, 1, "", 1)) for i in range(5)]  # copies: nothing tells the box apart
    out = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(9):
        assert out[i] == f"Title {i} Text number {i} here " + f"more {i} " * (i % 3) + f"The end of {i}"
        assert out[20 + i] == f"Head {i} The running text of page {i}"
    assert {out[40 + i] for i in range(5)} == {"Title 1 Text number 1 here Get our letter every week The end of 1"}


def test_article_inside_dropped_parts_and_comments():
    assert html_extract.extract('<div class="ad">ad<article>art</article>', "") == "art"
    assert html_extract.extract('<article>a<article class="comment">no</article>b</article>', "") == "a b"
    assert html_extract.extract("<main><p>m</p><aside>no</aside></main>x", "") == "m"


@pytest.mark.parametrize("inner", [
    '<p style="overflow:hidden">x</p>', '<p title="hidden gems">x</p>', "<a href=/hidden/x>x</a>", '<div data-id="sidebar">x</div>',
    '<h2 id="related-work">x</h2>', '<p id="search-results">x</p>', '<section id="related-work">x</section>', '<h2 id="main">x</h2>',
    '<svg class="icon"/>x', "<math/>x", "<svg/>x<svg><text>no</text></svg>", "<title-block>x</title-block>"])
def test_article_text_that_only_looks_like_boilerplate(inner):
    assert html_extract.extract(f"<article><p>a</p>{inner}<p>b</p></article><p>c</p>", "") == "a x b"
    assert html_extract.extract(f"<div><p>a</p>{inner}<p>b</p></div>", "") == "a x b"


def test_hidden_and_named_containers_stay_out():
    assert html_extract.extract('<article id="alert-systems">a<p hidden>no</p><div HIDDEN="">no</div></article>b', "") == "a"
    assert html_extract.extract('<article>a<div id="cookie-notice">no</div><div class="promo-box">no</div></article>', "") == "a"


def accuracy(spark, name, label):
    out = queries()[name](spark, MID)
    assert out.count() == spark.read.parquet(f"{MID}/documents.parquet").count()
    held = out.where("held_out").join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id")
    bad = out.where("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.5 as int)").count()
    assert bad == 0
    return held.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


def test_toxicity_held_out_accuracy(spark):
    assert accuracy(spark, "op5_toxicity", "toxic") >= 0.9


def test_toxic_words_in_a_small_share_of_toxic_texts(spark):
    toxic = [(f"common{'x' if i % 2 else 'y'} w{i:04d}" if i >= 8 else f"plain rareslur words {'abcdefgh'[i]}", 1) for i in range(1000)]
    clean = [(f"plain filler words {chr(97 + i % 26)}{chr(97 + i // 26)}", 0) for i in range(600)]
    weights = toxicity.learn_lexicon(spark.createDataFrame(toxic + clean, "text string, toxic int"))
    m = toxicity.Matcher(weights, ())
    assert m.raw("plain rareslur") > 0 and m.raw("commonx") > 0 and m.raw("plain filler words") == 0


def test_quality_held_out_accuracy(spark):
    assert accuracy(spark, "op9_quality_classifier", "quality") >= 0.95


def test_folding_and_exceptions():
    assert toxicity.fold("You 1D10T m0r0n, $cum p@thetic мoron a$$$") == " you idiot moron scum pathetic moron a "
    m = toxicity.Matcher({" trash ": 2.0, " lowei": 3.0}, ("trash can",))
    assert m.raw("a trash can") == 0 and m.raw("TRASH man") > 0 and m.raw("loweischaft") > 0 and m.raw(None) == 0
    assert m.raw("trash " + "word " * 500) < m.raw("trash word")


@pytest.mark.parametrize("labels", ["[]", "one kind", "both"])
def test_filters_on_odd_tables(spark, labels):
    docs = spark.createDataFrame([(1, "good text here"), (2, None), (3, ""), (4, "x " * 5000), (4, "x " * 5000), (None, "z")],
                                 "doc_id long, text string").selectExpr("*", "1 as raw", "2 as stats", "3 as score0")
    given = {"[]": [], "one kind": [(1, 1, 0), (2, 1, 0)], "both": [(1, 1, 0), (4, 0, 1), (3, 1, 0), (9, None, None)]}[labels]
    known = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
    tox = toxicity.fit(docs, known, toxic_held_out).score(docs, ["doc_id"]).collect()
    good = quality.fit(docs, known, quality_held_out).score(docs, ["doc_id"]).collect()
    assert len(tox) == len(good) == 6
    assert all(0 <= r.score <= 1 for r in tox + good)
    if labels != "both":
        assert all(r.predicted == 0 for r in tox) and all(r.predicted == 1 for r in good)


def test_held_out_fold_is_crc32(spark):
    import zlib
    row = spark.range(50).select("id", fold_of(F.col("id"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in row)


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    from tests.llm.test_text_operators import plain_repeats
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        from twingraph.llm.common import materialise
        seen.append(materialise(stage(spark, seen[-1], MID), "stage")[0])
    assert all(d.columns == columns for d in seen[:-1])
    sizes = [d.count() for d in seen[:5]]
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4]
    rows = [(r.doc_id, r.text) for r in seen[3].collect()]
    want = {d: (n, gone, kept) for d, n, gone, kept in plain_repeats(rows, 35)}
    texts = dict(rows)
    for r in seen[4].collect():
        n, gone, kept = want[r.doc_id]
        assert r.text == (kept if gone else texts[r.doc_id])
    assert {r.doc_id for r in seen[5].select("doc_id").collect()} == {d for d, _ in rows}
    packed = {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in seen[5].collect()}
    again = {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, MID).collect()}
    assert packed == again


def test_pipeline_keeps_a_row_of_every_group_of_texts(spark):
    import corpus_pipeline
    texts = [" ".join(f"{w}{k}" for w in "abcdefghij") for k in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (None, texts[2]), (5, texts[3]), (5, texts[4]),
            (3, texts[3]), (None, texts[4]), (7, texts[5]), (7, texts[5])]
    docs = spark.createDataFrame([(*r, "en", "s", 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    want = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (3, texts[3]), (5, texts[4]), (7, texts[5])]
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, want))


def test_pipeline_filters_odd_rows(spark):
    import corpus_pipeline
    docs = spark.createDataFrame([(1, "a b c d", "en", "s", 7), (1, "a b c d", "en", "s", 7), (2, "A b c d", None, None, None),
                                  (3, None, None, None, None), (None, "q", "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "None"]
    out = corpus_pipeline.pack_sequences(spark, corpus_pipeline.drop_repeated_passages(spark, docs, SF), SF)
    assert out.count() == 5


WORKING_NAMES = ["raw", "score", "predicted", "_row", "_content", "_kept", "kept", "n_words", "n_removed", "spans", "_id", "_th", "stats", "fp",
                 "th", "runs", "component_id", "no id.x", "column_1"]


@pytest.mark.parametrize("rows", [True, False])
def test_pipeline_keeps_columns_of_any_name(spark, rows):
    """Extra columns named like the operators' own come through every stage unchanged; empty tables too."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120" if rows else "false")
    plain = docs
    for i, c in enumerate(WORKING_NAMES):
        docs = docs.withColumn(c, F.concat(F.lit(f"v{i} "), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert all(r[c] == f"v{i} {r.doc_id}" for r in got for i, c in enumerate(WORKING_NAMES)), name
        want = stage(spark, plain, SF).collect()
        assert sorted(map(str, ((r.doc_id, r.text, r.n_chars) for r in got))) == sorted(map(str, ((r.doc_id, r.text, r.n_chars) for r in want))), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_top_k_with_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, [1, 2]), (0, [3, 4]), (100, [5, 6]), (None, [7, 8]), (3, [1, 1]), (3, [1, 1]), (4, None)], "vec_id long, vector array<long>")
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 100 = 0 or vec_id is null"), k=3).collect())
    assert got == [(0, 1, 100, 39), (0, 2, 3, 7), (0, 3, 3, 7), (100, 1, 0, 39), (100, 2, 3, 11), (100, 3, 3, 11)]
