"""Literal-row tests, modelled on the monitored system's own unit tests."""

import datetime as dt
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions import dates as DT
from vigil.functions import text as TX
from vigil.functions import urls as U
from vigil.operators import classify as C
from vigil.operators import dedupe as D
from vigil.operators import fetch as FE
from vigil.operators import output as O
from vigil.operators import reports as R
from vigil.operators import windows as W
from vigil.operators.common import number_rows, top_k
from vigil.sources import feeds as FD
from vigil.sources import fixtures
from vigil.sources.config import literal_table

AS_OF = dt.datetime(2024, 1, 31)


def test_threshold_is_inclusive(spark):
    # eleven scores 0.0 .. 1.0, threshold 0.5 -> six kept
    rows = [(i, 0, i / 10) for i in range(11)]
    scored = spark.createDataFrame(rows, "story_id long, project_id long, confidence double")
    projects = literal_table(spark, [(0, 0.5)], fixtures.schemas.PROJECT.__class__(
        [schemas.PROJECT["project_id"], schemas.PROJECT["min_confidence"]]))
    kept = C.above_threshold(scored, projects)
    assert kept.count() == 6
    assert min(r.confidence for r in kept.collect()) == 0.5


def test_threshold_defaults_to_zero(spark):
    scored = spark.createDataFrame([(1, 0, 0.0), (2, 0, 0.3)], "story_id long, project_id long, confidence double")
    projects = spark.createDataFrame([(0, None)], "project_id long, min_confidence double")
    assert C.above_threshold(scored, projects).count() == 2


@pytest.mark.parametrize("size,batches,last", [(10, 101, 1), (100, 11, 1)])
def test_batch_numbers_like_chunks(spark, size, batches, last):
    df = spark.range(1001).select(F.lit(7).cast("long").alias("project_id"), F.col("id").alias("pos"))
    out = D.batch_numbers(df, ["pos"], size=size)
    counts = {r.batch_no: r.n for r in out.groupBy("batch_no").agg(F.count("*").alias("n")).collect()}
    assert len(counts) == batches
    assert counts[batches - 1] == last
    assert all(v == size for k, v in counts.items() if k < batches - 1)


def test_number_rows_matches_window_under_skew(spark):
    # one hot project holds most rows; numbering must equal a plain row_number
    df = spark.range(5000).select(
        F.when(F.col("id") % 7 == 0, F.col("id") % 5).otherwise(F.lit(99)).cast("long").alias("g"),
        F.col("id").alias("k"))
    ours = number_rows(df, ["g"], ["k"], out_col="rn")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k")).cast("long"))
    assert sorted(ours.collect()) == sorted(ref.collect())
    glob = number_rows(df, [], ["k"], out_col="rn")
    assert sorted(r.rn for r in glob.collect()) == list(range(1, 5001))


def test_volume_alert_wording(spark):
    t = spark.createDataFrame([(20000,), (200000,)], "total_stories long")
    rows = {r.total_stories: r for r in R.volume_alert(t, days=4, threshold=40000).collect()}
    assert rows[20000].alert and rows[20000].average_per_day == 5000.0
    assert rows[20000].message == ("Warning: Average stories per day in the last 4 days is 5000.0, "
                                   "which is far below the expected value of >= 40000.")
    assert not rows[200000].alert and rows[200000].message is None


def test_group_by_host(spark):
    urls = [f"https://news{h}.example.org/story/{i}" for h in range(5) for i in range(h + 1)]
    urls += ["not a url", "/relative/path"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "pos long, url string")
    g = FE.group_by_host(df, "pos").collect()
    assert len({r.host for r in g}) == 5
    assert len(g) == 15
    by = {}
    for r in g:
        by.setdefault(r.host_order, []).append((r.pos_in_host, r.url))
    assert [sorted(v)[0][1].split("/")[2] for _, v in sorted(by.items())] == [f"news{h}.example.org" for h in range(5)]
    # unique hosts keep the input order, one per group
    uniq = spark.createDataFrame([(i, f"http://site{i}.example.com/a") for i in range(19)], "pos long, url string")
    g2 = FE.group_by_host(uniq, "pos").orderBy("host_order").collect()
    assert [r.url for r in g2] == [f"http://site{i}.example.com/a" for i in range(19)]
    b = FE.host_batches(uniq, "pos", 4).collect()
    assert {r.batch for r in b} == {0, 1, 2, 3}


def test_dedupe_first_wins(spark):
    rows = [(1, 0, "https://a.example.com/x/"), (2, 0, "http://a.example.com/x?utm_source=y"),
            (3, 1, "https://a.example.com/x"), (4, 0, "https://b.example.com/y"), (5, 0, "https://b.example.com/y#top")]
    df = spark.createDataFrame(rows, "pos long, project_id long, url string")
    out = sorted((r.pos, r.project_id) for r in D.dedupe(df, "pos").collect())
    assert out == [(1, 0), (3, 1), (4, 0)]
    ign = {r.project_id: r.ignored for r in D.ignored_counts(df, D.dedupe(df, "pos")).collect()}
    assert ign == {0: 2, 1: 0}


def test_cap_per_project_exact(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("project_id"), F.col("id").alias("ts"),
                                F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"))
    out = D.cap_per_project(df, 3, [F.desc("ts"), F.col("url")]).collect()
    assert sorted(r.ts for r in out) == [45, 46, 47, 48, 49, 44] or sorted(r.ts for r in out) == [44, 45, 46, 47, 48, 49]


def test_normalize_url_examples(spark):
    cases = {
        "HTTPS://www.Example.com/a/b/?utm_source=x&id=3&fbclid=z#frag": "example.com/a/b?id=3",
        "http://example.com/": "example.com",
        "https://example.com/a?ref=home": "example.com/a",
        "   ": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "url string")
    got = {r.url: r.n for r in df.select("url", U.normalize_url("url").alias("n")).collect()}
    assert got == cases


def test_normalize_url_is_idempotent(spark):
    """A grid of every combination of parts, the odd ones included."""
    heads = ["", " ", "http://", "HTTPS://", "http://http://", "http:// ", "www.", "www.www.", "http://www.http://www."]
    paths = ["", "/", "a.com", "A.com/x", "a.com/x //", "a.com/www.b", "a.com/a /", "?"]
    queries = ["", "?", "?utm_medium=a", "?a=1&ref=2", "?x=1 &utm_x=2& &y=3 ", "??", "?a=http://b"]
    tails = ["", "#top", " #a\nb", "#"]
    rows = [(h + p + q + t,) for h in heads for p in paths for q in queries for t in tails]
    once = spark.createDataFrame(rows, "url string").select("url", U.normalize_url("url").alias("a"))
    got = once.select("url", "a", U.normalize_url("a").alias("b")).collect()
    assert [r for r in got if r.a != r.b] == []
    assert len({r.a for r in got}) >= 20
    by = {r.url: r.a for r in got}
    assert by["http://http://a.com"] == by["www.www.a.com"] == by["HTTPS://a.com?utm_medium=a #a\nb"] == "a.com"


def test_hosts_and_domains(spark):
    df = spark.createDataFrame([("https://user@www.News.example.com:8080/x",), ("m.site.org",),
                                ("http://m.site.org/a",)], "url string")
    r = df.select(U.netloc("url").alias("n"), U.canonical_domain("url").alias("d"),
                  U.strip_trailing_slash(F.lit("a//")).alias("s")).collect()
    assert r[0].n == "user@www.News.example.com:8080" and r[0].d == "news.example.com"
    assert r[1].n == "" and r[2].d == "site.org" and r[0].s == "a"


def test_entities_filter(spark):
    rows = [("u1", [("Ana", "PERSON"), ("ACME", "ORG"), ("Lima", "GPE"), ("Ana", "PER")]), ("u2", None)]
    ents = spark.createDataFrame(rows, "url string, entities array<struct<text:string,type:string>>")
    stories = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    got = {r.url: r.entities for r in O.attach_entities(stories, ents).collect()}
    assert got == {"u1": ["ana", "lima", "ana"], "u2": None, "u3": None}


def test_dates_from_pages_and_urls(spark):
    df = spark.createDataFrame([
        ('<meta property="article:published_time" content="2024-01-05T10:00:00">', "https://x.com/a"),
        ('<time datetime="2024-02-01">Feb</time>', "https://x.com/b"),
        ("<p>none</p>", "https://x.com/2023/12/24/story"),
        ("<p>none</p>", "https://x.com/nothing")], "html string, url string")
    r = df.select(F.coalesce(TX.html_published_date("html"), U.url_date("url")).alias("d")).collect()
    assert [x.d for x in r] == [dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 2, 1),
                                dt.datetime(2023, 12, 24), None]


def test_lenient_dates(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02",), ("Jan 2 2024 garbage",), (None,)], "s string")
    r = df.select(DT.lenient_timestamp("s", DT.ts_lit(AS_OF)).alias("t"), DT.used_fallback("s").alias("f")).collect()
    assert r[0].t == dt.datetime(2024, 1, 2, 3, 4, 5) and not r[0].f
    assert r[1].t == dt.datetime(2024, 1, 2)
    assert r[2].t == AS_OF and r[2].f and r[3].t == AS_OF


def test_html_to_text_drops_furniture(spark):
    html = ('<html><head><title>T &amp; U</title><script>var a="</p>";</script></head><body><nav>menu</nav>'
            '<div class="ad">buy</div><article><p>Hello&nbsp;world &lt;3</p><!-- x --></article>'
            '<footer>foot</footer></body></html>')
    r = spark.createDataFrame([(html,)], "h string").select(TX.html_to_text("h").alias("t"),
                                                            TX.html_title("h").alias("ti")).first()
    assert r.t == "Hello world <3" and r.ti == "T & U"


def test_model_validation(spark):
    models = spark.createDataFrame([(1, "nb", "tfidf", False, None, None), (2, "svm", "tfidf", False, None, None),
                                    (3, "lr", "embeddings", True, "nb", "bow")],
                                   "model_id long, model_type_1 string, vectorizer_type_1 string, "
                                   "chained_models boolean, model_type_2 string, vectorizer_type_2 string")
    bad = {r.model_id: r.reason for r in C.validate_models(models).collect()}
    assert set(bad) == {2, 3} and "vectorizer_type_2" in bad[3]
    projects = spark.createDataFrame([(0, 9)], "project_id long, language_model_id long")
    with pytest.raises(C.ModelConfigError):
        C.with_model(projects, models.filter("model_id = 1"))


def test_read_projects(spark, tmp_path):
    p = tmp_path / "p.json"
    p.write_text(json.dumps([{"project_id": 1, "search_terms": "a b", "language": "en"}]))
    df = FD.read_projects(spark, str(p))
    assert df.first().search_terms == "a b"
    e = tmp_path / "e.json"
    e.write_text("[]")
    with pytest.raises(FD.ConfigError):
        FD.read_projects(spark, str(e))


def test_project_filters(spark):
    pr = fixtures.projects(spark)
    assert {r.project_id for r in FD.with_countries(pr).collect()} == {0, 1, 3, 5, 6, 7, 8, 9}
    re = FD.remap_collections(pr, {0: 40}).filter("project_id = 4").first()
    assert re.media_collections == [4, 40]


def test_query_window_rules(spark):
    pr = fixtures.projects(spark)
    empty = spark.createDataFrame([], schemas.HISTORY)
    w = {r.project_id: r for r in W.query_windows(pr, empty, schemas.SOURCE_MEDIA_CLOUD, AS_OF).collect()}
    assert w[2].start_date == dt.datetime(2024, 1, 26)       # default start (start date earlier)
    assert w[4].start_date == dt.datetime(2024, 1, 26)       # unparsable start date
    assert w[0].end_date == dt.datetime(2024, 1, 30)
    late = literal_table(spark, [(2, "2024-01-28T00:00:00Z")], schemas.PROJECT.__class__(
        [schemas.PROJECT["project_id"], schemas.PROJECT["start_date"]]))
    w2 = W.query_windows(late, empty, schemas.SOURCE_MEDIA_CLOUD, AS_OF).first()
    assert w2.start_date == dt.datetime(2024, 1, 28)
    hist = spark.createDataFrame([(2, "media-cloud", dt.datetime(2024, 1, 20), AS_OF),
                                  (2, "newscatcher", None, AS_OF)], schemas.HISTORY)
    assert W.query_windows(late, hist, "media-cloud", AS_OF).first().start_date == dt.datetime(2024, 1, 20)
    assert W.query_windows(late, hist, "newscatcher", AS_OF).first().start_date == dt.datetime(2024, 1, 26)


def test_daily_window_finds_stories_since_the_mark(spark):
    hist = spark.createDataFrame([(2, "media-cloud", dt.datetime(2024, 1, 30, 12), AS_OF)], schemas.HISTORY)
    w = W.query_windows(fixtures.projects(spark).filter("project_id = 2"), hist, "media-cloud", AS_OF)
    stories = spark.createDataFrame(
        [(1, 2, dt.datetime(2024, 1, 30, 13), dt.datetime(2024, 1, 29)), (2, 2, dt.datetime(2024, 1, 30, 12), dt.datetime(2024, 1, 29)),
         (3, 2, AS_OF, dt.datetime(2024, 1, 26, 5)), (4, 2, AS_OF, dt.datetime(2024, 1, 25, 23)),
         (5, 2, AS_OF, dt.datetime(2024, 1, 31)), (6, 2, AS_OF, None), (7, 3, None, dt.datetime(2024, 1, 29))],
        "story_id int, project_id long, indexed_date timestamp, publish_date timestamp")
    assert sorted(r.story_id for r in W.in_window(stories, w).collect()) == [1, 3]
    assert sorted(r.story_id for r in W.late_rows(stories, w).collect()) == [2, 4, 5, 6, 7]


def test_cap_and_cut_split_the_rows(spark):
    df = spark.createDataFrame([(p, f"https://a.org/{i}", i) for p in (1, None) for i in range(7)], "project_id long, url string, n int")
    order = [F.desc_nulls_last("n"), F.col("url")]
    kept, cut = D.cap_per_project(df, 3, order), D.cut_by_cap(df, 3, order)
    assert sorted(r.n for r in kept.collect()) == [4, 4, 5, 5, 6, 6]
    assert sorted(r.n for r in cut.collect()) == [0, 0, 1, 1, 2, 2, 3, 3]


def test_log_rows_without_a_publication_date(spark):
    from vigil.operators import log as L
    df = spark.createDataFrame([(1, 1, "u", "u", None), (1, 1, "v", "v", "nonsense"), (1, 1, "w", "w", "2024-01-02 03:04:05")],
                               "project_id long, model_id long, url string, normalized_url string, publish_date string")
    got = {r.url: r.published_date for r in L.log_rows(df, AS_OF, "x").collect()}
    assert got == {"u": AS_OF, "v": AS_OF, "w": dt.datetime(2024, 1, 2, 3, 4, 5)}


def test_domains_compare_without_www(spark):
    stories = spark.createDataFrame([(1, "https://www.nytimes.com/a"), (1, "https://m.b.org/x"), (2, "https://nytimes.com/a")],
                                    "project_id long, url string")
    domains = spark.createDataFrame([(1, "nytimes.com"), (1, "www.B.org")], "project_id long, domain string")
    assert sorted(r.url for r in FD.filter_domains(stories, domains).collect()) == ["https://m.b.org/x", "https://www.nytimes.com/a"]


def test_scoring_stops_without_weights(spark):
    from vigil.operators import classify as C
    stories = spark.createDataFrame([(1, 0, "a thing")], "story_id long, project_id long, story_text string")
    projects = fixtures.projects(spark).filter("project_id = 0")
    weights = spark.createDataFrame([(2, 1, None, None, 0.1)], "model_id long, stage int, term string, idf double, weight double")
    with pytest.raises(C.ModelConfigError, match="model 1 stage 1: no weights"):
        C.score(stories, projects, fixtures.models(spark), weights)
    embedded = fixtures.models(spark).withColumn("vectorizer_type_1", F.lit("embeddings"))
    with pytest.raises(C.ModelConfigError, match="embeddings"):
        C.score(stories, projects, embedded, weights.withColumn("model_id", F.lit(1).cast("long")))


def test_replay_safe_log_over_files_restarts_and_replays(spark, tmp_path):
    from vigil.streaming import ingest as J
    src, log = str(tmp_path / "in"), str(tmp_path / "log")
    schema = "feed_pos long, project_id long, url string, normalized_url string"

    def add(*rows):
        spark.createDataFrame([(i, 1, u, u) for i, u in rows], schema).coalesce(1).write.mode("append").parquet(src)

    def stream(checkpoint):
        feed = J.read_stream(spark, src, spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
        J.run_available(feed.writeStream.foreachBatch(J.replay_safe_log_writer(log, "feed_pos")), str(tmp_path / checkpoint))
        return sorted(r.url for r in spark.read.parquet(log).collect())

    add((1, "a"), (2, "b"))
    add((3, "b"), (4, "c"))
    assert stream("ck1") == ["a", "b", "c"]
    add((5, "d"), (6, "a"))
    assert stream("ck1") == ["a", "b", "c", "d"]        # goes on where it stopped
    assert stream("ck2") == ["a", "b", "c", "d"]        # a fresh checkpoint counts from batch 0 again
    write = J.replay_safe_log_writer(log, "feed_pos", run_id="x")
    batch = spark.createDataFrame([(7, 1, "e", "e"), (8, 1, "a", "a")], schema)
    write(batch, 0), write(batch, 0)
    assert sorted(r.url for r in spark.read.parquet(log).collect()) == ["a", "b", "c", "d", "e"]


def test_history_never_moves_back(spark):
    hist = spark.createDataFrame([(1, "newscatcher", dt.datetime(2024, 1, 20), AS_OF)], schemas.HISTORY)
    found = spark.createDataFrame([(1, dt.datetime(2024, 1, 10)), (2, dt.datetime(2024, 1, 25))],
                                  "project_id long, indexed_date timestamp")
    got = {r.project_id: r.latest_date for r in W.advance_history(hist, found, "newscatcher", AS_OF).collect()}
    assert got == {1: dt.datetime(2024, 1, 20), 2: dt.datetime(2024, 1, 25)}


def test_result_batches_payload(spark):
    rows = [(i, 0, f"https://x.org/{i}", 0.9, dt.datetime(2024, 1, 2, 3, 4, 5)) for i in range(250)]
    df = spark.createDataFrame(rows, "log_db_id long, project_id long, url string, confidence double, "
                               "publish_date timestamp")
    pr = fixtures.projects(spark)
    prepped = O.prep_for_posting(df, pr)
    b = O.result_batches(prepped.withColumn("log_db_id", F.col("log_db_id").cast("string")), pr).collect()
    assert sorted(r.n_stories for r in b) == [50, 100, 100]
    payload = json.loads(b[0].payload)
    assert payload["version"] == schemas.OUTPUT_VERSION and payload["project"]["project_id"] == 0
    assert payload["stories"][0]["publish_date"] == "2024-01-02 03:04:05"


def test_retention_keeps_null_dates(spark):
    log = spark.createDataFrame([(1, dt.datetime(2023, 1, 1)), (2, None), (3, dt.datetime(2024, 1, 30))],
                                "id long, queued_date timestamp")
    from vigil.operators.log import retain
    kept, deleted = retain(log, 62, AS_OF)
    assert sorted(r.id for r in kept.collect()) == [2, 3] and [r.id for r in deleted.collect()] == [1]


def test_top_k_ties_broken(spark):
    df = spark.createDataFrame([(0, 1, "b"), (0, 1, "a"), (0, 0, "c")], "g long, v long, u string")
    out = top_k(df, ["g"], [F.desc("v"), F.col("u")], 1).collect()
    assert [r.u for r in out] == ["a"]


def test_country_filter_and_drop_empty(spark):
    stories = spark.createDataFrame([(0, "us"), (0, "GB"), (3, "mx"), (None, "us")], "project_id long, country string")
    kept = FD.filter_country(FD.drop_empty(stories), fixtures.projects(spark)).collect()
    assert sorted((r.project_id, r.country) for r in kept) == [(0, "us"), (3, "mx")]


def test_prefer_source_date(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00", dt.datetime(2024, 1, 1)), ("garbage", dt.datetime(2024, 1, 2)),
                                (None, dt.datetime(2024, 1, 3))], "sp string, ex timestamp")
    got = [r.d for r in df.select(DT.prefer_source_date("sp", "ex").alias("d")).collect()]
    assert got == [dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)]


def test_clean_terms_and_entity_text(spark):
    df = spark.createDataFrame([("“climate change” AND x", "Title", "Body")], "t string, ti string, b string")
    r = df.select(TX.clean_terms("t").alias("c"), TX.entity_text("ti", "b").alias("e")).first()
    assert r.c == '"climate change" AND x' and r.e == "Title Body"


def test_filter_domains(spark):
    stories = spark.createDataFrame([(0, "https://www.News.example.com/a"), (0, "https://other.org/b"),
                                     (1, "https://www.news.example.com/c")], "project_id long, url string")
    domains = spark.createDataFrame([(0, "www.news.example.com")], "project_id long, domain string")
    assert [r.url for r in FD.filter_domains(stories, domains).collect()] == ["https://www.News.example.com/a"]


def test_bounded_broadcast_falls_back(spark):
    from vigil.operators.common import bounded_broadcast
    big = spark.range(1000).withColumn("s", F.lit("x"))
    small = bounded_broadcast(big, max_bytes=10_000_000)
    plain = bounded_broadcast(big, max_bytes=1_000)
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(small) and not hinted(plain)
    assert plain.count() == 1000 and small.count() == 1000


def test_bounded_broadcast_measures_wide_columns(spark):
    from vigil.operators.common import bounded_broadcast

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    ids = spark.range(100)
    wide = {
        "string": F.repeat(F.lit("x"), 4000),
        "longs": F.sequence(F.lit(1), F.lit(500)).cast("array<long>"),
        "strings": F.array_repeat(F.repeat(F.lit("x"), 100), 40),
        "map": F.create_map(F.lit("k"), F.repeat(F.lit("x"), 4000)),
        "struct": F.struct(F.lit(1).alias("a"), F.repeat(F.lit("x"), 4000).alias("b")),
    }
    for name, value in wide.items():
        df = ids.withColumn("a.b", value)
        assert not hinted(bounded_broadcast(df, max_bytes=200_000)), name
        assert hinted(bounded_broadcast(df, max_bytes=2_000_000)), name
        assert hinted(bounded_broadcast(ids.withColumn("v", F.lit(None).cast(df.schema["a.b"].dataType)), max_bytes=200_000)), name
    clash = ids.withColumn("s", F.lit("x")).select("s", F.col("s"))
    assert hinted(bounded_broadcast(clash, max_bytes=200_000))
    assert hinted(bounded_broadcast(ids.withColumn("s", F.lit("x")).limit(0)))


def test_shared_folder_is_needed_off_local_mode():
    from types import SimpleNamespace

    from vigil.session import checkpoint_dir
    settings = {"spark.master": "spark://host:7077"}
    cluster = SimpleNamespace(conf=SimpleNamespace(get=settings.get), sparkContext=SimpleNamespace(applicationId="app"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(cluster)


def test_logistic_regression_keeps_every_term_or_fails(spark):
    from vigil.operators import classify as C
    train = spark.createDataFrame([("alpha beta gamma", 1), ("delta epsilon beta", 0), ("alpha gamma", 1), ("delta", 0)],
                                  "text string, quality int")
    terms = C.fit_logistic_regression(train, "quality", max_iter=3).filter("term is not null")
    assert {r.term for r in terms.collect()} == {"alpha", "beta", "gamma", "delta", "epsilon"}
    with pytest.raises(ValueError, match="5 distinct terms"):
        C.fit_logistic_regression(train, "quality", max_terms=4)


def test_replayed_batch_adds_nothing(spark, tmp_path):
    from vigil.streaming.ingest import replay_safe_log_writer
    write = replay_safe_log_writer(str(tmp_path / "log"), "pos")
    b0 = spark.createDataFrame([(1, 0, "https://a.org/x"), (2, 0, "https://a.org/x/")], "pos long, project_id long, url string")
    b1 = spark.createDataFrame([(3, 0, "https://a.org/x"), (4, 1, "https://a.org/x")], "pos long, project_id long, url string")
    write(b0, 0)
    write(b1, 1)
    write(b1, 1)          # a retry of batch 1
    rows = sorted((r.pos, r.project_id) for r in spark.read.parquet(str(tmp_path / "log")).collect())
    assert rows == [(1, 0), (4, 1)]


def test_log_partitions_prune(spark, tmp_path):
    from vigil.operators.log import append_log, log_rows, retain
    stories = spark.createDataFrame(
        [(p, 1, f"https://x.org/{i}", f"x.org/{i}", dt.datetime(2024, 1, 1 + i % 5)) for i, p in enumerate([0, 1] * 5)],
        "project_id long, model_id long, url string, normalized_url string, publish_date timestamp")
    for d in range(5):
        append_log(log_rows(stories.filter(F.dayofmonth("publish_date") == d + 1),
                            dt.datetime(2024, 1, 1 + d), "media-cloud"), str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    kept, _ = retain(log, 2, dt.datetime(2024, 1, 5))
    import re
    plan = kept._jdf.queryExecution().executedPlan().toString()
    part = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "queued_day" in part
    assert kept.count() == 6 and log.select("id").distinct().count() == 10


def test_write_batches_round_trip(spark, tmp_path):
    rows = [(str(i), i % 2, f"https://x.org/{i}", 0.9) for i in range(130)]
    df = spark.createDataFrame(rows, "log_db_id string, project_id long, url string, confidence double")
    pr = fixtures.projects(spark)
    b = O.result_batches(O.prep_for_posting(df, pr), pr)
    O.write_batches(b, str(tmp_path / "out"))
    payloads = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(len(p["stories"]) for p in payloads) == [65, 65]
    assert {p["project"]["project_id"] for p in payloads} == {0, 1}
    with pytest.raises(Exception):
        O.write_batches(b, str(tmp_path / "out"))   # never over an existing run directory


def test_null_text_is_reported_not_scored(spark):
    stories = spark.createDataFrame([(1, 0, "thing erre"), (2, 0, None)], "story_id long, project_id long, story_text string")
    mt = spark.createDataFrame([(1, 1, "thing", 1.0, 2.0), (1, 1, None, None, -1.0)], fixtures.schemas.MODEL_TERMS)
    models = spark.createDataFrame([(1, "m", "m", "nb", "tfidf", False, None, None)], schemas.MODEL)
    projects = literal_table(spark, [(0, "t", "en", "x", [0], "US", None, 0.5, 1)], schemas.PROJECT)
    got = {r.story_id: r.model_score for r in C.score(stories, projects, models, mt).collect()}
    assert got[2] is None and got[1] is not None
    assert [r.story_id for r in C.unscorable(stories).collect()] == [2]
    texts = stories.select("story_id", "story_text")
    assert [r.story_id for r in C.unscorable(stories.drop("story_text"), texts).collect()] == [2]


def test_hot_key_holding_a_third_of_rows(spark):
    # project 0 and one URL hold a third of all rows
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 7 + 1).cast("long").alias("project_id"),
        F.when(F.col("id") % 3 == 0, F.lit("https://hot.example.com/story"))
        .otherwise(F.concat(F.lit("https://x.org/"), F.col("id").cast("string"))).alias("url"))
    kept = D.dedupe(df, "pos")
    assert kept.filter("project_id = 0").count() == 1
    assert kept.count() == 1 + (n - n // 3)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan        # combined in every task before the exchange
    capped = D.cap_per_project(df, 10, [F.col("pos")])
    assert capped.filter("project_id = 0").count() == 10
    nums = D.batch_numbers(df.filter("project_id = 0"), ["pos"], size=100)
    assert nums.agg(F.max("batch_no")).first()[0] == (n // 3 - 1) // 100


def test_json_feed_stream_with_explicit_schema(spark, tmp_path):
    from vigil.streaming.ingest import dedupe_stream, read_stream, run_available
    src = tmp_path / "feed"
    src.mkdir()
    lines = [{"project_id": 1, "url": "https://a.org/x", "normalized_url": "a.org/x",
              "indexed_date": "2024-01-30T10:00:00"},
             {"project_id": 1, "url": "https://a.org/x/", "normalized_url": "a.org/x",
              "indexed_date": "2024-01-30T11:00:00"},
             {"project_id": 2, "url": "https://a.org/x", "normalized_url": "a.org/x",
              "indexed_date": "2024-01-30T12:00:00"}]
    (src / "page-1.json").write_text("\n".join(json.dumps(x) for x in lines))
    s = read_stream(spark, str(src), schemas.STORY, file_glob="*.json", fmt="json")
    s = s.withColumn("queued_date", F.col("indexed_date"))
    out = tmp_path / "out"
    run_available(dedupe_stream(s).writeStream.format("parquet").option("path", str(out)), str(tmp_path / "ck"))
    got = sorted((r.project_id, r.normalized_url) for r in spark.read.parquet(str(out)).collect())
    assert got == [(1, "a.org/x"), (2, "a.org/x")]


def test_config_lists_keyed_by_id(spark, tmp_path):
    p = tmp_path / "projects.json"
    p.write_text(json.dumps([{"id": 7, "title": "x", "language": "en", "search_terms": "a\u00a0b",
                              "media_collections": [1, 2], "min_confidence": 0.5, "language_model_id": 3}]))
    r = FD.read_projects(spark, str(p)).first()
    assert (r.project_id, r.search_terms, r.media_collections, r.language_model_id) == (7, "a b", [1, 2], 3)
    m = tmp_path / "models.json"
    m.write_text(json.dumps([{"id": 3, "name": "m", "model_type_1": "nb", "vectorizer_type_1": "tfidf",
                              "chained_models": False}]))
    assert FD.read_models(spark, str(m)).first().model_id == 3


def test_checkpoint_dir_comes_from_the_session(spark):
    from vigil.session import checkpoint_dir
    from vigil.streaming.ingest import run_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    d = checkpoint_dir(spark)
    if named:                       # the cluster's shared folder is used as named
        assert d == named
    assert spark.sparkContext.getCheckpointDir() is not None
    assert run_dir(spark, "x").startswith(d.rstrip("/") + "/streams/x-")
    assert checkpoint_dir(spark) == d
    assert spark.range(10).checkpoint().count() == 10


def test_checkpoint_dir_when_unset_registers_private_folder():
    from vigil.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

        def set(self, key, value):
            raise AssertionError("the setting is fixed at start-up and must not be changed")

    class Context:
        applicationId = "app-without-shared-folder"
        registered = None

        def getCheckpointDir(self):
            return self.registered

        def setCheckpointDir(self, d):
            self.registered = d

    class Session:
        conf = Conf()
        sparkContext = Context()

    s = Session()
    d = checkpoint_dir(s)
    assert s.sparkContext.registered == d and checkpoint_dir(s) == d


def test_spread_only_touches_narrow_inputs(spark):
    from vigil.operators.common import spread
    cores = spark.sparkContext.defaultParallelism
    narrow = spark.range(100).coalesce(1)
    wide = spark.range(0, 1000, 1, cores * 2)
    assert spread(narrow).rdd.getNumPartitions() == cores
    assert spread(wide) is wide
