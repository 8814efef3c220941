"""Every operator on odd rows, empty tables and extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from eventide.llm import decontamination, html_main_text, jaccard_join, packing, quality_rules, segmentation, suffix_dedup, token_counts, toxicity, url_filter

ROWS = 10


def _labels(spark):
    return spark.createDataFrame([(1, 1), (5, 0), (7, 0), (None, 1), (8, None)], "doc_id bigint, toxic int")


def _benchmark(spark):
    return spark.createDataFrame([(1, "tok3 tok4 tok5 tok6 tok7 tok8 tok9 tok10 tok11 tok12 tok13 tok14 tok15"), (2, None), (3, ""), (1, "two words")], "item_id bigint, text string")


def _run(name, spark, docs):
    return {
        "tox": lambda: toxicity.toxicity(docs, _labels(spark)), "join": lambda: jaccard_join.jaccard_components(docs), "suffix": lambda: suffix_dedup.remove_repeats(docs),
        "quality": lambda: quality_rules.quality_rules(docs), "counts": lambda: token_counts.token_counts(docs),
        "bench": lambda: decontamination.decontaminate(docs, _benchmark(spark)), "seg": lambda: segmentation.sample_segmentations(docs),
    }[name]()


@pytest.mark.parametrize("name", ["tox", "join", "suffix", "quality", "counts", "bench", "seg"])
def test_odd_rows_and_empty_tables(spark, docs, no_docs, name):
    clash = docs.withColumns({c: F.lit("x") for c in ("n_words", "score", "kept", "n_tokens", "ids", "n_hit", "n_bytes", "path", "host")})
    assert _run(name, spark, clash).count() == ROWS
    assert _run(name, spark, no_docs).count() == 0


def test_packing_keeps_every_token(spark, docs, no_docs):
    import numpy as np

    got: dict = {}
    for r in packing.pack_tokens(docs, row=64).collect():
        ids, pos = np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["positions"], "<u2")
        assert len(ids) == 64 and r["cu_seqlens"][-1] == r["n_tokens"]
        for d, s, a, b in zip(r["doc_ids"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert (pos[a:b] == np.arange(b - a)).all()
            got.setdefault((d, s), []).append(ids[a:b])
    enc = packing.encoding(packing.tokenizer_path(packing.TOKENIZER))
    for r in docs.collect():
        want = [*enc.encode_ordinary(r["text"] or ""), packing.END_ID]
        assert np.concatenate([got[r["doc_id"], s][0] for s in range(0, len(want), 64)]).tolist() == want
    assert len(got[2, 0]) == 2  # the repeated row
    assert packing.pack_tokens(no_docs).count() == 0


def test_best_fit_decreasing():
    sizes = [5, 9, 3, 7, 2, 2, 8, 1]
    rows = packing.best_fit_decreasing(sizes, 10)
    assert sorted(k for r in rows for k in r) == list(range(8)) and all(sum(sizes[k] for k in r) <= 10 for r in rows)
    assert len(rows) == 4


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.org/x", "<body><nav><a>m</a></nav><article><h1>T &amp; t</h1><p>one  two<p>three</article><footer>f</footer>"), (2, None, None), (3, "no scheme", ""),
         (4, "http://a.org/y", "<html><body><div class='ad'>buy</div><article><p>Long text here</p></article><section class='comments'><p>me too</p></section>"),
         (4, "http://a.org/y", "plain words")], "page_id bigint, url string, html string")
    got = [r["text"] for r in html_main_text.main_text(pages.withColumn("text", F.lit(1)).withColumn("host", F.lit(2))).orderBy("page_id", F.desc("html")).collect()]
    assert got == ["T & t\none two\nthree", "", "", "plain words", "Long text here"]
    assert html_main_text.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "with-nav", "post tag-news", "elementor-widget", "post comments-open", "search-results", "widget-layout"])
def test_wrappers_with_marker_words_keep_their_text(name):
    text = "".join(f"<p>Paragraph {i} of the article</p>" for i in range(4))
    want = [f"Paragraph {i} of the article" for i in range(4)]
    rest = "<div class='sidebar'><p>aside</p></div><div class='comments'><article><p>me too</p></article></div>"
    for page in (f"<body><div class='{name}'>{text}{rest}</div>", f"<body><div>intro</div><div class='{name}'><article>{text}</article>{rest}</div>"):
        got = html_main_text.extract(page, None).split("\n")
        assert [x for x in got if x != "intro"] == want
    long = "<div class='comments'>" + "<p>very long comment of a reader</p>" * 9 + "</div>"
    assert html_main_text.extract(f"<body><div class='post'><p>short text</p></div>{long}", None) == "short text"
    assert html_main_text.extract("<body><div class='ad'>an advert longer than the article</div><article><p>short text</p></article>", None) == "short text"
    assert html_main_text.extract("<body><div class='comments'><p>nothing else</p></div>", None) == "nothing else"


def test_text_around_the_best_container(spark):
    p = lambda word, n: "".join(f"<p>{word} paragraph {i} with some words</p>" for i in range(n))
    wrap = {
        "a": lambda k: f"<article><h1>Title {k}</h1><div class='body w-1/2'>{p(k, 8)}</div></article>",
        "b": lambda k: f"<article><section class='intro'>{p('i', 9)}</section><section class='details'>{p(k, 12)}</section></article>",
        "c": lambda k: f"<div class='post'><h1>Title {k}</h1><div class='w-1/2'>{p(k, 8)}</div></div><div class='other'>x</div>",
        "d": lambda k: f"<div class='post'><table><tr><td class='one'>{p('i', 9)}</td><td class='two'>{p(k, 12)}</td></tr></table></div><div class='other'>x</div>",
    }
    pages = spark.createDataFrame([(f"http://{h}.org/{k}", f"<html><body><nav>m</nav>{f(k)}</body></html>") for h, f in wrap.items() for k in "uvw"], "url string, html string")
    lines = lambda word, n: [f"{word} paragraph {i} with some words" for i in range(n)]
    for r in html_main_text.main_text(pages).collect():
        host, k = r["url"][7], r["url"][-1]
        want = [f"Title {k}", *lines(k, 8)] if host in "ac" else [*lines("i", 9), *lines(k, 12)]
        assert r["text"].split("\n") == want == html_main_text.extract(r["html"], None).split("\n"), host


def test_all_containers_vote(spark):
    page = "".join(f"<section class='s{chr(97 + i)}'><p>{'word ' * (40 - i)}</p></section>" for i in range(20))
    pages = spark.createDataFrame([("h", page), ("h", page)], "host string, html string")
    got = {r["path"]: r["score"] for r in html_main_text.votes(pages).collect()}
    assert len(got) == 20 and got["/section.st"] == 2 * 4 * 21 * 1.25


def test_url_rules(spark):
    urls = ["http://Example.ORG/es/x", "http://a.example.org/en/12?q", "http://b.org", "http://b.org/", "x://c.com/de/", "x://c.com/fr/a", "http://free-casino.net/a", "nothing", None,
            "http://notexample.org/es/", "http://q.net/x.org/"]
    rows = url_filter.url_filter(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string").withColumn("rule", F.lit("z"))).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"]) for r in rows] == [
        ("example.org/es/", "block"), ("example.org/en/1", "block"), (None, "allow"), ("org/", "allow"), ("com/de/", "block"), ("com/fr/", "allow"), (None, "block"),
        (None, "allow"), (None, "allow"), ("org/", "allow"), (None, "allow")]


def test_a_newline_between_elements_is_a_space():
    page = "<html><body><article><p>one <b>bold</b>\n<i>it</i> end</p>\n<hr>two<hr>three</article></body></html>"
    assert html_main_text.extract(page, None).split("\n") == ["one bold it end", "two", "three"]


def test_deeply_nested_tags_cost_linear_time():
    import time

    from eventide.llm.html_main_text import DEPTH, extract

    took = []
    for n in (10_000, 40_000):
        for tag in ("div", "span", "li"):
            html = "<article><p>first</p>" + f"<{tag}>in " * n + "deep" + f"</{tag}>" * n + "<p>last</p></article><div class='sidebar'>other</div>"
            start = time.process_time()
            text = extract(html, None)
            took.append(time.process_time() - start)
            assert text.startswith("first") and text.endswith("last") and "other" not in text
            assert text.split().count("in") == n and text.split().count("deep") == 1
    assert sum(took[3:]) < 12 * sum(took[:3])  # four times the length; quadratic would be sixteen
    # what follows the closings of folded elements is outside of them
    n = DEPTH + 50
    assert extract("<article>" + "<div>" * n + "a" + "</div>" * n + "<p>b <b>c</b>\n<i>d</i></p></article>", None) == "a\nb c d"
