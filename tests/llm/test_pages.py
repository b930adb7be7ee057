"""Operators over pages: archives, URLs and main texts."""

import random

import brute
import pytest
from pyspark.sql import functions as F
from samples import prose

from incidentlens.llm import html, queries, urls, warc

PAGES = "page_id long, url string, html string, shard int, digest string, key string, text string, host string"


@pytest.fixture(scope="module")
def pages(spark):
    long = "<p>" + prose(31, 400) + "</p>"
    contents = [None, "", "short", "short", long, long, long, "é" * 500, "é" * 500, "a\r\n\r\nb" * 300, "\x00<b>", "<p>x " * 50_000]
    links = [None, "no scheme", "http://a/", "https://EXAMPLE.com/de/x", "https://example.com/en", "http://x.net", "http://sub.Example.NET/en/1?q#f",
             "http://notnet/", "ftp://u.org/fr/#", "http://org?x://y", "a\r\nb://c/d", "http://"]
    rows = [(i * 1000, u, c, 1, "d", "k", "t", "h") for i, (u, c) in enumerate(zip(links, contents, strict=True))]
    return spark.createDataFrame(rows, PAGES)


def pairs(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_archives(spark, small, pages, tmp_path):
    given = pairs(spark.read.parquet(f"{small}/pages.parquet"), "page_id", "html")
    assert set(pairs(queries.op3_warc(spark, small), "*")) == brute.archived(given)
    contents = pairs(pages, "page_id", "html")
    digests = []
    for name, df, options in (
        ("a", pages, {"file_bytes": 700, "shard_bytes": 5_000}),
        ("b", pages.repartition(7), {"file_bytes": 700, "shard_bytes": 5_000}),
        ("c", pages, {}),
    ):
        folder = f"file:{tmp_path}/{name}"
        manifest = warc.write(df, folder, **options)
        assert set(pairs(warc.read(manifest, folder), "*")) == brute.archived(contents)
        assert not list((tmp_path / name).glob("_temporary"))
        digests.append(sorted(pairs(manifest, "file", "records", "bytes", "sha1")))
    assert digests[0] == digests[1]
    assert len(digests[0]) > len(digests[2])
    empty = warc.write(pages.limit(0), f"file:{tmp_path}/empty")
    assert warc.read(empty, f"file:{tmp_path}/empty").isEmpty()


def test_archives_with_repeated_and_keyless_rows(spark, pages, tmp_path):
    twice = pages.union(pages).withColumn("page_id", F.expr("nullif(page_id, 0)"))
    folder = f"file:{tmp_path}/twice"
    found = warc.read(warc.write(twice, folder), folder)
    assert found.count() == twice.count()
    assert found.where("page_id IS NULL AND record_type = 'response'").count() == 2


@pytest.mark.parametrize("keys", ["outlier", "single", "missing", "third"])
def test_shards_are_even_under_any_keys(spark, tmp_path, keys):
    number = F.col("id")
    key = {
        "outlier": F.when(number == 0, F.lit(10**15)).otherwise(number),
        "single": F.lit(7).cast("long"),
        "missing": F.lit(None).cast("long"),
        "third": F.when(number % 3 == 0, F.lit(7).cast("long")).otherwise(number),
    }[keys]
    pages = spark.range(3000).select(key.alias("page_id"), F.lit("u").alias("url"), F.repeat(F.sha1(number.cast("string")), 30).alias("html"))
    folder = f"file:{tmp_path}/{keys}"
    manifest = warc.write(pages, folder, shard_bytes=100_000, file_bytes=10_000)
    shards = [r[0] for r in manifest.groupBy("shard").agg(F.sum("records")).select("sum(records)").collect()]
    assert sum(shards) == 3000 and len(shards) > 30 and max(shards) < 2 * 3000 / len(shards)
    assert manifest.count() > 2 * len(shards)
    assert warc.read(manifest, folder).count() == 3000


def test_files_do_not_depend_on_the_partitions_of_the_input(spark, tmp_path):
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.sha1(F.col("id").cast("string")), 50).alias("html"))
    found = []
    for name, df in (("a", pages.coalesce(1)), ("b", pages.repartition(9, "html"))):
        manifest = warc.write(df, f"file:{tmp_path}/{name}", shard_bytes=50_000, file_bytes=10_000)
        found.append(sorted(pairs(manifest, "file", "records", "bytes", "sha1")))
    assert found[0] == found[1] and len(found[0]) > 20


def test_writing_again(spark, pages, tmp_path, monkeypatch):
    """Complete archives are kept; what a run that was lost has left is written over."""
    contents, folder = pairs(pages, "page_id", "html"), f"file:{tmp_path}/again"
    with monkeypatch.context() as lost:
        lost.setattr(warc, "_namer", lambda folder: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            warc.write(pages, folder)
    manifest = warc.write(pages, folder)
    assert set(pairs(warc.read(manifest, folder), "*")) == brute.archived(contents)
    with pytest.raises(FileExistsError):
        warc.write(pages, folder)
    # A path without a scheme is one of the session's file system.
    plain = warc.write(pages, f"{tmp_path}/plain")
    assert set(pairs(warc.read(plain, f"{tmp_path}/plain"), "*")) == brute.archived(contents)


def test_rules_that_may_be_chance_are_not_kept(spark):
    """Labels that have nothing to do with the URLs make no rule; a word that goes with them does, whatever is around."""
    chance = random.Random(9)
    words = [prose(600 + i, 1) for i in range(40)]
    rows = [(f"https://{chance.choice(words)}-{chance.choice(words)}.example/{'/'.join(chance.sample(words, 4))}", chance.random() < 0.25) for _ in range(900)]
    noise = spark.createDataFrame(rows, "url string, unwanted boolean")
    assert urls.mine(noise).isEmpty()
    told = [(url.replace(".example", "-casino.example") if bad and i % 3 else url, bad) for i, (url, bad) in enumerate(rows)]
    mined = urls.mine(spark.createDataFrame(told, "url string, unwanted boolean"))
    assert [r["tokens"] for r in mined.select("tokens").collect()] == [["host:casino"]]


def test_parts_and_rules_of_urls(spark, small, pages):
    for df in (pages, spark.read.parquet(f"{small}/pages.parquet")):
        mined = urls.mine(queries.labelled_urls(spark, small))
        found = {r["page_id"]: r for r in urls.judged(df, mined, queries.URL_RULES).collect()}
        assert len(found) == df.count()
        for page, url in pairs(df, "page_id", "url"):
            host, path = brute.url_parts(url)
            rule, verdict = brute.url_rule(host, path, queries.URL_RULES)
            assert (found[page]["host"], found[page]["path"], found[page]["rule"]) == (host, path, rule)
            assert found[page]["verdict"] == verdict or (rule is None and found[page]["verdict"] in ("allow", "block"))


@pytest.mark.parametrize("most", [0, 50_000])
def test_mined_rules_block_what_they_were_mined_from(spark, most, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_RULES", most)
    rows = [(f"https://h{i % 7}.example/{'casino' if i % 3 == 0 else 'news'}/{i}", i % 3 == 0) for i in range(300)]
    labelled = spark.createDataFrame(rows, "url string, unwanted boolean")
    mined = urls.mine(labelled)
    assert [r["tokens"] for r in mined.select("tokens").collect()] == [["casino"]]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    found = dict(pairs(urls.judged(pages, mined, []), "page_id", "verdict"))
    assert found == {i: "block" if bad else "allow" for i, (_, bad) in enumerate(rows)}
    none = urls.mine(labelled.limit(0))
    assert urls.judged(pages, none, []).where("verdict <> 'allow'").isEmpty()
    assert urls.judged(pages.limit(0), mined, []).isEmpty()


ARTICLE = [prose(41, 60), prose(42, 50), prose(43, 70)]
PAGE = (
    "<!doctype html><html><head><title>t</title><style>p{}</style></head><body><header>Site name</header>"
    "<nav><ul><li><a href='/'>home</a></li><li><a href='/b'>more</a></li></ul></nav>"
    '<div class="cookie-notice">We use cookies</div><article><h1>A &amp; B</h1><script>var x = "<p>";</script>'
    f"<p>{ARTICLE[0]}</p><p>{ARTICLE[1].replace(' ', '  ' + chr(10), 3)}</p><div class='ad'>Buy now</div><p>{ARTICLE[2]} caf&eacute;</p>"
    "</article><aside>Related things</aside><section id='comments'><p>Nice text, thanks</p></section>"
    "<form><input><button>Go</button></form><footer>Imprint</footer></body></html>"
)


def test_main_text(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<br>" * 9), (5, "u", f"plain {ARTICLE[0]}")],
        "page_id long, url string, html string",
    )
    weights = html.learned(pages)
    found = {r["page_id"]: r for r in html.extracted(pages, weights).collect()}
    expected = " ".join(["A & B", ARTICLE[0], ARTICLE[1], ARTICLE[2] + " café"])
    assert found[1]["text"] == expected and found[1]["n_chars"] == len(expected)
    assert [found[i]["text"] for i in (2, 3, 4)] == [""] * 3
    assert found[5]["text"] == f"plain {ARTICLE[0]}"
    assert html.extracted(pages.limit(0), weights).isEmpty()
    assert html.extracted(pages, {}).count() == 5


INNER = f"<p>{ARTICLE[0]}</p><p>{ARTICLE[1]}</p>"
MENU = "<ul><li class='menu-item'><a href='/'>home</a></li></ul>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body class='has-sidebar'>{MENU}<article>{INNER}</article></body></html>",
        f"<html class='nav-fixed'><body id='menu'><article>{INNER}</article></body></html>",
        f"<body><div class='content no-sidebar'>{INNER}</div></body>",
        f"<body><div class='page-with-sidebar'>{INNER}</div></body>",
        f"<body><article class='post share-enabled'>{INNER}</article></body>",
        f"<body><article class='post share'>{INNER}</article></body>",
        f"<body><main class='with-sidebar'>{INNER}</main></body>",
        f"<body><main class='sidebar'>{INNER}</main></body>",
        f"<body><div class='widget'><main>{INNER}</main></div></body>",
        f"<body><main><div class='overlay'><div><article>{INNER}</article></div></div></main></body>",
        f"<body><div class='cookie'>We use cookies<article>{INNER}</article></body>",
        f"<body><article>{INNER}<section id='comments'><article>Nice text</article></section></article></body>",
        f"<body><article>{INNER}<article class='comment'>Nice text</article></article></body>",
        f"<body><div>{INNER}</div><div class='related'><article>Another one</article></div></body>",
        f"<body><article><p class='notice'>Read this{INNER}</article></body>",
        f"<body><article><ul><li class='ad'>Buy now<li>{ARTICLE[0]}<li>{ARTICLE[1]}</ul></article></body>",
        f"<body><table><tr><td class='sidebar'>Links here<td>{INNER}</table></body>",
    ],
)
def test_classes_do_not_hide_the_main_text(page):
    assert html.main_text(page, {}) == f"{ARTICLE[0]} {ARTICLE[1]}"


def test_parts_named_by_class_stay_hidden():
    aside = "<div class='left-sidebar'>Links <p>here</p></div><ul id='main-nav'><li>home</ul><p class='ad'>Buy</p>"
    assert html.main_text(f"<body>{aside}<div>{INNER}</div></body>", {}) == f"{ARTICLE[0]} {ARTICLE[1]}"


def test_main_text_of_given_pages(spark, small):
    for r in queries.op10_html(spark, small).collect():
        assert r["n_chars"] == len(r["text"]) and r["text"] == " ".join(r["text"].split())
        assert "<p>" not in r["text"]


def test_best_region_is_the_maximum(spark):
    """The scan's region scores as much as the best of all regions."""
    weights = {html.WORD: 1.0, html.OTHER: -2.5, "p": -2.5, "/p": -2.5}
    page = "a b <p>c d e f g</p> h <p>i</p><p></p><p>j k l m n o p q r s</p> t"
    texts = html.main_text(page, weights).split()
    assert texts == "j k l m n o p q r s".split()


def test_best_region_against_all_regions():
    chance = random.Random(6)
    for _ in range(400):
        scores = [chance.choice([-2.5, -1.0, -0.5, 0.0, 0.5, 1.0, 3.0]) for _ in range(chance.randint(0, 14))]
        regions = [(a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        best = max([0.0, *(sum(scores[a:b]) for a, b in regions)])
        first, last = html.best_region(scores)
        assert sum(scores[first:last]) == best and (best or first == last == 0)


LAST = prose(44, 4)
# As learned from the given pages.
GIVEN_WEIGHTS = {
    html.WORD: 2.0, html.OTHER: -4.0, "html": -4.0, "body": -4.0, "article": -0.2, "/article": -4.0, "/body": -4.0, "/html": -4.0,
    "h1": -0.2, "/h1": -0.2, "p": -0.2, "/p": -0.2, "b": -0.2, "br": -0.2,
}


@pytest.mark.parametrize(
    "page, expected",
    [
        (f"<article><div><h1>My Title here</h1></div><div><p>{ARTICLE[0]}</p></div><div><p>{LAST}</p></div></article>", f"My Title here {ARTICLE[0]} {LAST}"),
        (f"<article><p>{ARTICLE[0]}</p><div class='ad'>Buy</div><p>{LAST}</p></article>", f"{ARTICLE[0]} {LAST}"),
        (f"<article><h1>Title</h1><div class='ad'>Buy</div><p>{ARTICLE[0]}</p></article>", f"Title {ARTICLE[0]}"),
        (f"<article><h1>Title</h1><picture><source><img></picture><p>{ARTICLE[0]}</p></article>", f"Title {ARTICLE[0]}"),
        (f"<body><div class='social-history'><p>{ARTICLE[0]}</p><p>{LAST}</p></div></body>", f"{ARTICLE[0]} {LAST}"),
        (f"<body><div id='login-guide'><p>{ARTICLE[0]}</p><p>{LAST}</p></div></body>", f"{ARTICLE[0]} {LAST}"),
        (f"<body><div id='widget'><p>{ARTICLE[0]}</p></div><p class='sidebar-text'>here</p></body>", ARTICLE[0]),
        (
            f"<body><nav><ul><li><a>home</a></ul></nav><div class='content'><h1>My Title</h1><p>{ARTICLE[0]}</p><p>{LAST}</p></div>"
            "<footer>Imprint</footer></body>",
            f"My Title {ARTICLE[0]} {LAST}",
        ),
        (
            f"<body><div id='wrap'><ul><li><a href=x>one</a><li><a href=y>two</a></ul><div class='text'><h2>T</h2><p>{ARTICLE[0]}</p>"
            f"<p>{LAST}</p></div><ol class='comment-list'><li>nice</ol></div></body>",
            f"T {ARTICLE[0]} {LAST}",
        ),
        (f"<body><div class='page'><p>{ARTICLE[0]}</p></div><div class='comments'><p>{ARTICLE[1]} {ARTICLE[2]}</p></div></body>", ARTICLE[0]),
        (f"<body><main><h1>A</h1><section><p>{ARTICLE[0]}</p></section><section><h2>B</h2><p>c</p></section></main></body>", f"A {ARTICLE[0]} B c"),
    ],
)
def test_the_whole_main_text_is_kept(page, expected):
    for weights in ({}, GIVEN_WEIGHTS):
        assert html.main_text(page, weights) == expected


def test_main_texts_of_awkward_rows(spark):
    """A very long page, repeated rows, and columns that the operator uses itself."""
    long = "<article>" + f"<p>{ARTICLE[0]}</p><div class='ad'>Buy</div>" * 3000 + "</article>"
    rows = [(1, "u", long, "t", 5), (2, "u", PAGE, "t", 5), (2, "u", PAGE, "t", 5), (None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = html.extracted(pages, html.learned(pages)).collect()
    assert len(found) == 4 and found[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert [r["n_chars"] for r in found if r["page_id"] == 1] == [3000 * (len(ARTICLE[0]) + 1) - 1]
    assert len({r["text"] for r in found if r["page_id"] == 2}) == 1


def test_urls_of_awkward_rows(spark):
    """A very long URL, repeated rows, and columns that the operator uses itself."""
    labelled = spark.createDataFrame([(f"https://h{i}.example/{'bad' if i % 2 else 'fine'}/{i}", i % 2 == 1) for i in range(200)], "url string, unwanted boolean")
    long = "https://h.example/" + "/".join(f"part{i}" for i in range(20_000)) + "/bad"
    rows = [(1, long, "t", "h", 0), (2, "https://x.example/bad", "t", "h", 0), (2, "https://x.example/bad", "t", "h", 0), (None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, token string, host string, verdict int")
    found = urls.judged(pages, urls.mine(labelled), []).select("page_id", "verdict").collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, "block"), (2, "block"), (2, "block"), (None, "allow")], key=repr)
