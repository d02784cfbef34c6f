"""Main text by block density, and parsing only the pages asked for."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions import text as TX
from vigil.operators import fetch as FE

LONG = "The council met on Tuesday evening and after a debate of three hours voted to keep the library open all week."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style></head><body class="x">
<header><div id="menu"><a href="/">Home</a> | <a href="/news">News</a> | <a href="/sport">Sport</a></div></header>
<ul class="links"><li><a href="/1">Weather</a></li><li><a href="/2">Your horoscope for today and tomorrow and the day after that too</a></li></ul>
<section data-slot="7">Buy two, pay one!</section>
<div><h1>Library stays open after all</h1><p>{LONG}</p><p>&ldquo;A good day,&rdquo; said the mayor &amp; left.</p><p>{LONG}<br>{LONG}</p></div>
<!-- <p>{LONG}</p> --><script>var p = "<p>{LONG}</p>";</script>
<div class="promo">Subscribe now</div><div>Share this</div>
<p>More: <a href="/3">{LONG}</a></p><footer><p>{LONG}</p></footer></body></html>"""


def extract(spark, *pages):
    return [r.t for r in spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, h string").orderBy("i").select(TX.main_text("h").alias("t")).collect()]


def test_dense_blocks_stay_and_furniture_goes(spark):
    assert extract(spark, PAGE) == [f"Library stays open after all {LONG} A good day, said the mayor & left. {LONG} {LONG}"]


def test_odd_pages(spark):
    got = extract(spark, None, "", "<p>short</p>", LONG, f"<p>{LONG}", f"<DIV><P CLASS='a'>{LONG}</P></DIV>", f"<p>{LONG}</p>" * 500, "<a>" + LONG)
    assert got == [None, "", "", LONG, LONG, LONG, " ".join([LONG] * 500), LONG]


def test_blocks_count_words_and_links(spark):
    html = "<p>one <a href='x'>two three</a> four</p><div> </div><li><a>five</a></li>"
    r = spark.createDataFrame([(html,)], "h string").select(TX.html_blocks("h").alias("b")).first()
    assert [tuple(x) for x in r.b] == [("one two three four", 4, 2), ("five", 1, 1)]


def test_only_asked_pages_are_parsed(spark):
    pages = spark.createDataFrame([("u1", "<p>yes</p>"), ("u2", "boom"), ("u3", "<p>also</p>")], "original_url string, content string")
    stories = spark.createDataFrame([(1, "u1"), (2, "u3"), (3, "u1"), (4, "gone"), (5, None)], "project_id int, url string")

    def parser(content):
        return F.when(content == "boom", F.raise_error(F.lit("parsed"))).otherwise(F.upper(TX.html_to_text(content)))
    got = FE.attach_text(stories, pages, parser=parser).select("project_id", "story_text").collect()
    assert sorted(map(tuple, got)) == [(1, "YES"), (2, "ALSO"), (3, "YES")]
