"""The operators on pages and embeddings, and the pipeline."""

from __future__ import annotations

import base64
import collections
import hashlib
import html
import io
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlake.llm import ann, common, extraction, semdedup, teaching, warc
from cohortlake.llm.dom import Page
from cohortlake.llm.queries import ORACLE_SQL, QUERIES


def article_blocks(source):
    inside = re.search(r"<article>(.*)</article>", source, re.S).group(1).replace("<br>", " ")
    blocks = (html.unescape(re.sub(r"<[^>]*>", "", x)) for x in re.split(r"</?(?:h1|p)[^>]*>", inside))
    return [b for b in (re.sub(r"\s+", " ", x).strip() for x in blocks) if b]


def test_extraction_query(spark, sf, given):
    rows = {r.page_id: r for r in QUERIES["op2_extraction"](spark, sf).collect()}
    pages = given("pages")
    assert len(rows) == len(pages)
    for i, url, source in pages[["page_id", "url", "html"]].itertuples(index=False):
        assert rows[i].text == "\n".join(article_blocks(source)) and rows[i].url == url
        assert rows[i].n_chars == len(rows[i].text)


def test_extraction_of_layouts_not_trained_on():
    trees = extraction.trained()
    right = wrong = 0
    for source, truth in teaching.pages(150, seed=77):
        page = Page(source)
        keep = extraction.decode(page, trees.logits(page.features()))
        kept = [k for k, text in zip(keep, page.text, strict=True) if text]
        right += sum(a == b for a, b in zip(kept, truth, strict=True))
        wrong += sum(a != b for a, b in zip(kept, truth, strict=True))
    assert right / (right + wrong) > 0.97


def test_a_kept_node_has_kept_ancestors():
    rng = np.random.default_rng(3)
    page = Page(teaching.pages(1, seed=5)[0][0])
    for _ in range(20):
        keep = extraction.decode(page, rng.normal(size=len(page.tag)))
        assert all(keep[page.parent[i]] for i in range(1, len(keep)) if keep[i])


def test_extraction_of_odd_pages(spark):
    long = "<article>" + "<p>A sentence that is of some length, here.</p>" * 3000 + "</article>"
    sources = [None, "", "   ", "<p", "</p></div>", "<script>x</p>", "a < b && c", long, "<!-- ", "<a href='>x"]
    rows = [(i, None if i % 2 else f"u{i}", s) for i, s in enumerate(sources)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text")
    found = {r.page_id: r for r in extraction.extract(pages).collect()}
    assert len(found) == len(sources) and found[0].text == found[1].text == found[2].text == ""
    assert found[7].text.count("\n") == 2999
    assert extraction.extract(pages.where("false")).count() == 0


@pytest.mark.parametrize(
    "unit", ["<div>", "<b>", "<b>x", "<p>x<div>", "</i>", "<li>", "<a>x", "<svg>", "<table><tr>", "</div>", "<ul><li>"]
)
def test_deep_pages_take_linear_time(unit):
    import time

    begin = time.perf_counter()
    page = Page(unit * 40_000)
    assert time.perf_counter() - begin < 5
    assert len(page.tag) == len(page.text)


def test_text_of_a_page():
    page = Page("<p>A &amp;\n b<b> c</b><br>d<p>e<script>f</script><ul><li>g<li>h</ul><style>x</style>&lt;i&gt;")
    assert [t for t in page.text if t] == ["A & b c d", "e", "g", "h", "<i>"]


def texts(source):
    return [t for t in Page(source).text if t]


def test_text_in_drawings_formulas_and_fallbacks():
    assert texts("<p>Let <math><msup><mi>x</mi><mn>2</mn></msup></math> be.</p>") == ["Let x2 be."]
    assert texts("<object data='a'><p>a</p></object><canvas>b</canvas><p>c</p>") == ["a", "b", "c"]
    assert texts("<object>a<object>b</object>c</object><p>d</p>") == ["a", "b", "c", "d"]
    assert texts("<p><a href='/'><svg><path d='M0'/></svg> a <svg/></a>b<noscript><img></noscript>") == ["a b"]
    assert texts("<p>a <object><param name='x'><embed></object> b</p>") == ["a b"]
    page = Page("<div><select><option>a<option>b</select><svg><g><text>c</text></g></svg></div><template>d</template>")
    assert [page.tag[page.parent[i]] for i, t in enumerate(page.text) if t] == ["select", "svg", "template"]
    assert [t for t in page.text if t] == ["a b", "c", "d"]


PROSE = "<p>The committee met on Tuesday to discuss the plan, and agreed on most of its points.</p>"


@pytest.mark.parametrize("tag", ["noscript", "template", "svg", "math", "object", "canvas", "select"])
@pytest.mark.parametrize("shape", ["before", "inside", "nested"])
def test_an_unclosed_element_takes_no_text_with_it(tag, shape):
    first = {"before": f"<div><{tag}></div><{tag}>", "inside": "", "nested": ""}[shape]
    inner = {"before": "", "inside": f"<{tag}>", "nested": f"<{tag}><{tag}></{tag}>"}[shape]
    article = f"<article><h1>On the plan</h1>{PROSE * 2}{inner}{PROSE * 4}</article>"
    source = f"<html><body><nav><ul><li><a href='/'>Home</a></ul></nav>{first}{article}<footer>Legal</footer></body>"
    (kept,) = extraction.main_texts([source], extraction.trained())
    assert kept == ["On the plan", *[PROSE[3:-4]] * 6]


#: Pages in layouts that ``teaching`` doesn't write, with the first words of their main blocks.
WRITTEN = {
    "table layout": (
        "<html><body><table width=100%><tr><td class=menu><a href=/a>Home</a> | <a href=/b>News</a> | <a href=/c>Shop</a></td>"
        "</tr><tr><td class=content><h1>River levels fall</h1><p>The river fell by two metres in May, after weeks "
        "without any rain in the hills.</p><p>Farmers along the bank have asked the council for help with water.</p>"
        "<p>A decision is expected next week, when the committee meets.</p></td></tr>"
        "<tr><td class=footer>Copyright 2019 <a href=/i>Imprint</a></td></tr></table></body></html>",
        ["River levels fall", "The river fell", "Farmers along the", "A decision is"],
    ),
    "deep wrappers": (
        "<body><div id=page><div id=inner><div role=navigation><ul><li><a href=/>Start</a><li><a href=/x>Travel</a></ul></div>"
        "<div><div><div class='post hentry'><h2>Three days in the north</h2><div class=entry-content>"
        "<p>We left early in the morning and took the slow train along the coast.</p>"
        "<p>By noon the fog had gone, and the islands could be seen from the window.</p>"
        "<ul><li>Take a warm coat with you.<li>Book the ferry well ahead.</ul></div></div></div></div>"
        "<div class=sidebar><h3>Archive</h3><ul><li><a href=/1>May</a><li><a href=/2>June</a></ul></div></div></div></body>",
        ["Three days in", "We left early", "By noon the", "Take a warm", "Book the ferry"],
    ),
    "article among cards": (
        "<body><header><a href=/>The Daily</a></header><main><article class=story><header><h1>New bridge opens</h1></header>"
        "<p>The new bridge was opened on Friday by the mayor, two years later than planned.</p>"
        "<figure><img src=b.jpg><figcaption>The bridge seen from the south bank.</figcaption></figure>"
        "<p>It cost more than first thought, but traffic in the old town is already down.</p></article></main>"
        "<section class=related><h3>Related</h3><div class=card><a href=/q>Old bridge to close</a></div>"
        "<div class=card><a href=/r>Town plans a tram</a></div></section><footer><p>All rights reserved.</p></footer></body>",
        ["New bridge opens", "The new bridge", "The bridge seen", "It cost more"],
    ),
}


@pytest.mark.parametrize("name", WRITTEN)
def test_extraction_of_layouts_that_are_not_generated(name):
    source, wanted = WRITTEN[name]
    (kept,) = extraction.main_texts([source], extraction.trained())
    assert [" ".join(t.split()[:3]) for t in kept] == [" ".join(w.split()[:3]) for w in wanted]


def test_warc_query(spark, sf, given):
    rows = {r.page_id: r for r in QUERIES["op7_warc"](spark, sf).collect()}
    pages, first = given("pages").sort_values("page_id"), {}
    assert len(rows) == len(pages)
    for i, source in zip(pages.page_id, pages.html, strict=True):
        data = source.encode()
        of = first.setdefault(data, i)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        kind = "response" if of == i else "revisit"
        assert tuple(rows[i]) == (i, len(data), digest, kind, None if of == i else of)


def test_archives_round_trip(spark, tmp_path):
    rows = [
        (3, "http://x/a b\r\nc", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "", None), (4, "u", ""),
        (5, "u", "x\r\n\r\nWARC/1.1" * 50_000), (None, "n", "<p>é</p>"), (1, None, "<p>é</p>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS first")
    count = warc.write_archives(pages, str(tmp_path))
    found = warc.read_archives(spark, str(tmp_path), count).collect()
    assert len(found) == 7 and all(r.digest_ok for r in found)
    kinds = collections.Counter((r.page_id, r.url, r.record_type, r.refers_to) for r in found)
    assert kinds[(3, "http://x/a b\r\nc", "revisit", 1)] == 1 and kinds[(1, None, "response", None)] == 2
    assert kinds[(2, "", "response", None)] == 1 and kinds[(4, "u", "revisit", 2)] == 1
    assert next(r.payload for r in found if r.page_id == 5).decode() == rows[4][2]
    assert warc.archived_pages(pages.where("false")).count() == 0


def test_small_payloads_are_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    kinds = lambda least: sorted(r.record_type for r in warc.archived_pages(pages, str(tmp_path / str(least)), least).collect())
    assert kinds(2) == ["response", "revisit"] and kinds(3) == ["response", "response"]


def test_damaged_archives_are_told():
    good = warc.page_record(1, "u", b"payload", None)
    assert [warc.parse(m)[0]["WARC-Type"] for m in warc.members(io.BytesIO(good * 3))] == ["response"] * 3
    with pytest.raises(warc.WarcError):
        list(warc.members(io.BytesIO(good[:-9])))
    member = next(iter(warc.members(io.BytesIO(good))))
    with pytest.raises(warc.WarcError):
        warc.parse(member.replace(b"payload", b"payl0ad"))


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 24))
    rows = []
    for i in range(900):
        v = centres[i % 40] + rng.normal(size=24) * 0.1
        rows.append((i * 10, v.astype(np.float32).tolist(), i % 3))
    rows += [(20_000 + i, rows[0][1], 0) for i in range(200)]
    return rows


def test_nearest_against_all_pairs(spark, clustered):
    found = ann.nearest(spark.createDataFrame(clustered, VECTORS), F.col("vec_id") % 50 == 0)
    got = collections.defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    ids = np.array([r[0] for r in clustered])
    v = np.array([r[1] for r in clustered], dtype=np.float32).astype(np.float64)
    unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
    right = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[q]
        score[q] = -9
        best = [int(ids[i]) for i in np.lexsort((ids, -np.round(score, 12)))[:5]]
        right += len({i for i, _ in got[ids[q]]} & set(best))
        total += 5
        assert all(math.isclose(s, score[np.flatnonzero(ids == i)[0]], rel_tol=1e-12) for i, s in got[ids[q]])
    assert right / total > 0.99


def recall_of(found, ids, v, asked, k=5):
    """The share of the true k nearest among those found, whose scores must be exact."""
    got = collections.defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
    place = {int(i): n for n, i in enumerate(ids)}
    right = total = 0
    for q in asked:
        score = unit @ unit[place[q]]
        score[place[q]] = -9
        best = {int(ids[i]) for i in np.argsort(-score)[:k]}
        assert len(got[q]) == k and [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
        assert all(math.isclose(s, score[place[i]], rel_tol=1e-12) for i, s in got[q])
        right += len({i for i, _ in got[q]} & best)
        total += k
    return right / total


def test_nearest_query(spark, given, sf):
    """The registered query on the whole given table, against all pairs."""
    table = given("embeddings")
    v = np.stack(table.embedding).astype(np.float64)
    asked = [int(i) for i in table.vec_id if i % 50 == 0]
    found = QUERIES["op6_ann"](spark, sf)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert recall_of(found, table.vec_id.to_numpy(), v, asked) >= 0.9


@pytest.mark.parametrize("shape", ["even", "clustered", "skewed"])
def test_recall_on_hard_vectors(spark, monkeypatch, shape):
    """Many small cells and blocks; vectors without any structure, in clusters, and nearly all alike."""
    for name, value in {"ROWS_IN_CELL": 100, "ROWS_IN_BLOCK": 150, "QUERIES_IN_BLOCK": 20}.items():
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(11)
    v = rng.normal(size=(6000, 96))
    if shape == "clustered":
        v = v * 0.3 + rng.normal(size=(40, 96))[rng.integers(0, 40, 6000)]
    if shape == "skewed":
        v = v * 0.02 + 1
    v = v.astype(np.float32).astype(np.float64)
    table = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], VECTORS)
    asked = list(range(0, 6000, 50))
    asks = F.col("vec_id") % 50 == 0
    assert recall_of(ann.nearest(table, asks), np.arange(6000), v, asked) >= 0.95
    assert recall_of(ann.nearest(table, asks, recall=1), np.arange(6000), v, asked) == 1


def test_counts_on_packed_bits_are_inner_products():
    rng = np.random.default_rng(12)
    for dim in (1, 7, 64, 65, 200):
        signs, turned = rng.integers(0, 2, (30, dim)), rng.normal(size=(9, dim))
        inner, rounding = ann.packed_inner(np.packbits(signs, axis=1), turned)
        exact = turned @ (signs * 2.0 - 1).T
        assert (np.abs(inner - exact) <= 6 * rounding[:, None] + 1e-9).all()


def test_bounds_hold():
    rng = np.random.default_rng(13)
    v = rng.normal(size=(2000, 128)) + 0.3
    unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
    centre = unit.mean(axis=0)
    estimate, width = ann.bounds(*ann.encode(unit, centre), unit[:50], centre)
    miss = np.abs(estimate - unit[:50] @ unit.T) > width
    assert miss.mean() < 0.06 and abs((estimate - unit[:50] @ unit.T).mean()) < 0.005


def test_queries_whose_cells_hold_copies_only(spark, monkeypatch):
    """A tight group of copies is a cell of its own; its queries still get k neighbours."""
    monkeypatch.setattr(ann, "ROWS_IN_CELL", 20)
    rng = np.random.default_rng(14)
    rows = [(0, [9.0] * 16, 0)] * 200 + [(i, rng.normal(size=16).tolist(), 0) for i in range(1, 200)]
    found = ann.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0)
    counts = collections.Counter(r.query_id for r in found.collect())
    assert counts == {0: 5, 50: 5, 100: 5, 150: 5}


@pytest.mark.parametrize("copies", [2, 6])
def test_copies_of_a_neighbour_take_one_place(spark, copies):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(10, 256))
    rows = [(i * 10, (centres[i % 10] + rng.normal(size=256) * 0.2).tolist(), 0) for i in range(40)]
    found = ann.nearest(spark.createDataFrame(rows * copies, VECTORS), F.col("vec_id") % 50 == 0)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in found.collect()}
    v = np.array([r[1] for r in rows], dtype=np.float32).astype(np.float64)
    unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
    score = unit @ unit.T
    np.fill_diagonal(score, -9)
    wanted = {(q * 10, n + 1): i for q in range(0, 40, 5) for n, i in enumerate(np.argsort(-score[q])[:5])}
    assert {at: i for at, (i, _) in got.items()} == {at: i * 10 for at, i in wanted.items()}
    assert all(math.isclose(s, score[q // 10, i // 10], rel_tol=1e-12) for (q, _), (i, s) in got.items())


@pytest.mark.parametrize("hot", [2, 1000])
def test_links_against_all_pairs(spark, clustered, monkeypatch, hot):
    """With many small cells, and with few copies taken for many."""
    monkeypatch.setattr(semdedup, "COPIES", hot)
    monkeypatch.setattr(semdedup, "HOT", 10_000)
    monkeypatch.setattr(semdedup, "ROWS_IN_CELL", 10 * hot)
    rows = semdedup.near_duplicates(spark.createDataFrame(clustered, VECTORS)).collect()
    v = np.array([r[1] for r in clustered], dtype=np.float32).astype(np.float64)
    unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
    label, ids = np.array([r[2] for r in clustered]), np.array([r[0] for r in clustered])
    link = (unit @ unit.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(link, False)
    assert 0 < link.sum() < link.size / 4
    component = ids.copy()
    while True:
        smallest = np.minimum(component, np.where(link, component[None], 10**9).min(axis=1))
        if (smallest == component).all():
            break
        component = smallest
    wanted = {int(i): (int(n), int(c)) for i, n, c in zip(ids, link.sum(axis=1), component, strict=True)}
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == wanted
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.0], None), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1),
        (6, [inf, 1.0], 1), (7, [1.0, None], 1), (8, [], 1), (9, [1.0, 0.0, 0.0], 1), (50, [1.0, 0.0], 2), (None, [1.0, 0.0], 1), (1, [2.0, 0.0], 1),
    ]
    table = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS entry", "2 AS home", "3 AS i")
    near = ann.nearest(table, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in near] == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 0), (50, 2, 1), (50, 3, 2)]
    found = semdedup.near_duplicates(table).collect()
    assert len(found) == len(rows)
    links = {r.vec_id: (r.n_links, r.component_id) for r in found}
    assert links[0] == (2, 0) and links[1] == (2, 0)
    assert all(links[i] == (0, i) for i in (2, 3, 4, 5, 6, 7, 8, 9, 50))
    none = table.where("false")
    assert ann.nearest(none, F.col("vec_id") % 50 == 0).count() == 0 and semdedup.near_duplicates(none).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 300), (7, 7), (5, None)]
    found = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {i: 1 for i in range(1, 61)} | {100: 100, 200: 100, 300: 100}


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept, columns = docs, docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.staged(stage(spark, kept, sf))
        assert kept.columns == columns
    rows = corpus_pipeline.run(spark, sf).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(r.doc_id for r in kept.select("doc_id").collect())
    toxic = {r.doc_id for r in QUERIES["op1_toxicity"](spark, sf).where("predicted = 1").collect()}
    assert toxic and not toxic & {r.doc_id for r in rows}
    assert max(collections.Counter(r.doc_id for r in rows).values()) <= 2


def test_pipeline_stages_on_odd_rows(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, sf).count() >= 0
