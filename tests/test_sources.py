"""Sources, sinks and the command line on small files."""

import http.server
import threading
import zipfile

import pytest
from pyspark.sql import functions as F

from presslens import cli
from presslens.functions import dates, scores, sql
from presslens.operators import media, merge
from presslens.sources import archive, feeds, files, gold, manifest
from presslens.sources.store import DayStore
from presslens.streaming import ingest

RSS = b"<rss><channel><item><title>One</title><link>http://a/1</link><pubDate>Wed, 08 Jul 2026 10:30:00 GMT</pubDate></item><item><title/><link>http://a/2</link></item></channel></rss>"


class Feeds(http.server.BaseHTTPRequestHandler):
    def do_GET(self):
        self.send_response(200 if self.path == "/ok" else 500)
        self.end_headers()
        self.wfile.write(RSS)

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def url():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Feeds)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def one(frame):
    return frame.collect()[0]


def test_feeds_are_fetched_and_failures_kept_apart(spark, url):
    listed = spark.createDataFrame([("A", f"{url}/ok"), ("B", f"{url}/broken"), ("C", f"{url}/ok")], "name string, url string")
    got = feeds.fetch_feeds(listed, timeout=5)
    assert {r.media: r.error is None for r in got.collect()} == {"A": True, "B": False, "C": True}
    new = feeds.collect(got.filter("error IS NULL"), spark.createDataFrame([], "hash string")).collect()
    assert [(r.media, r.titre, r.date) for r in new] == [("A", "One", "2026-07-08 10:30")]


def test_feed_forms():
    assert feeds.parse_feed(b"<rss><item>") == feeds.parse_feed(b"") == feeds.parse_feed(None) == []
    atom = b"<feed xmlns='http://www.w3.org/2005/Atom'><entry><title>T</title><link href=' u '/><published>d</published></entry></feed>"
    assert feeds.parse_feed(atom) == [{"title": "T", "link": "u", "date": "d"}]
    named = b"<rss xmlns:m='urn:m' xmlns:dc='http://purl.org/dc/elements/1.1/'><item><m:title>no</m:title><title>yes</title><link>l</link><dc:date>d</dc:date></item><m:item><title>no</title></m:item></rss>"
    assert feeds.parse_feed(named) == [{"title": "yes", "link": "l", "date": "d"}]


def test_pages_follow_the_link_header():
    pages = {"a": ([1, 2], '<b>; rel="next", <z>; rel="last"'), "b": ([3], '<a>; rel="prev"')}
    assert list(manifest.pages("a", pages.__getitem__)) == [1, 2, 3]


def test_local_files_and_freshness(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/x")
    local = manifest.local_files(spark, f"{tmp_path}/x")
    row = one(local)
    assets = spark.createDataFrame([(row.file, row.size, f"sha256:{row.digest}"), (row.file, row.size, "sha256:0"), (row.file, row.size + 1, None), ("missing.parquet", 1, None)], "file string, size long, digest string")
    assert manifest.stale(assets, local).count() == 3


def test_unreadable_dates_are_null(spark):
    assert one(archive.to_stored(spark.createDataFrame([("soon", "x")], "time_stamp string, official_rating string"))).time_stamp is None
    assert one(archive.to_stored(spark.createDataFrame([("2026-13-45 10:00", "2026-13-45")], "time_stamp string, official_rating string")))[:10] == (None,) * 10


def test_archive_schema_has_the_names_that_are_stored(spark, tmp_path):
    rows = archive.to_stored(spark.createDataFrame([("m", "0.5", "0.25")], "nom_du_media string, `fiabilité2` string, `intérêt marine calcul` string"))
    archive.write_days(rows.withColumn("day", F.lit("2026-07-08").cast("date")), f"{tmp_path}/a", "day")
    back = one(archive.read_days(spark, f"{tmp_path}/a"))
    assert (back["fiabilité2"], back["intérêt marine calcul"], back["langue"]) == (0.5, 0.25, "")


def test_merge_days_twice_adds_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("l1", "a", "2026-07-08"), ("", "b", "2026-07-08"), ("l2", "c", None)], "lien string, titre string, d string").selectExpr("lien", "titre", "cast(d AS date) AS day")
    order = [F.col("titre")]
    archive.merge_days(rows, f"{tmp_path}/a", order=order)
    archive.merge_days(rows.filter("lien <> ''"), f"{tmp_path}/a", order=order)
    assert sorted(r.lien for r in spark.read.parquet(f"{tmp_path}/a").collect()) == ["", "l1", "l2"]


def test_ingest_keeps_hashes_when_the_transform_drops_them(spark, tmp_path):
    schema = "id long, link string"
    for part in ([(1, "a"), (2, "a")], [(3, "a"), (4, "b")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        ingest.ingest(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/seen", f"{tmp_path}/state", "link", ["id"], lambda r: r.select("id"))
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 4]


def test_blank_links_may_be_hot_and_nulls_are_one_link(spark):
    rows = spark.createDataFrame([(3, None), (1, None), (2, ""), (4, ""), (5, "x")], "id long, link string")
    assert sorted(r.id for r in merge.dedup_first(rows, "link", [F.col("id")]).collect()) == [1, 2, 5]
    assert sorted(r.id for r in merge.dedup_first(rows, "link", [F.col("id")], blank_exempt=True).collect()) == [1, 2, 3, 4, 5]


def test_names_by_prefix(spark):
    rows = spark.createDataFrame([("X",), ("X News",), ("Xtra",), (" X  Two ",), (None,), ("Y",)], "media string")
    listed = media.patterns(spark, [("X *", "Ex"), ("X News", "Exact"), ("X  Two*", "Two")])
    assert {r.media: r.canonical for r in media.canonical_names(rows, listed).collect()} == {"X": "Ex", "X News": "Exact", "Xtra": "Xtra", " X  Two ": "Two", None: None, "Y": "Y"}
    assert {r.media for r in media.without_banned(rows, listed).collect()} == {"Xtra", "Y", None}


def test_date_vectors(spark):
    want = {
        "Wed, 08 Jul 2026 10:30:00 GMT": "2026-07-08 10:30", "Wed, 08 Jul 2026 10:30:00 +0530": "2026-07-08 10:30", "8 Jul 2026 10:30": "2026-07-08 10:30", "Jul 08, 2026 10:30": "2026-07-08 10:30",
        "2026-07-08T10:30:00Z": "2026-07-08 10:30", "2026-07-08T23:30:00-05:00": "2026-07-08 23:30", "2026-07-08 10:30:59": "2026-07-08 10:30", "2026-07-08": "2026-07-08 00:00", "20260708": "2026-07-08 00:00",
        "2026-W28-3": "2026-07-08 00:00", "2026W283": "2026-07-08 00:00", "2021-W53-1": "", "08/07/2026": "2026-07-08 00:00", "08 Jul 2026": "2026-07-08 00:00", "July 8, 2026": "2026-07-08 00:00",
        "2026/07/08 10:30": "2026-07-08 10:30", "08-07-2026 10:30": "2026-07-08 10:30", "2026-07-08 99:99": "2026-07-08 99:99", "garbage": "", "": "", "2026-07-08T10:30:00.123Z": "2026-07-08 10:30",
    }
    frame = spark.createDataFrame(list(want.items()), "t string, w string")
    assert [(r.t, r.got) for r in frame.select("t", dates.norm_date(F.col("t")).alias("got")).collect()] == list(want.items())


def test_security_on_exact_ties(spark):
    frame = spark.createDataFrame([(3.5, 5.0, 0.13), (4.5, 5.0, 0.07), (None, 10.0, 0.1), (1.0, None, 0.0)], "i double, n double, w double")
    assert all(r.got == r.w for r in frame.select("w", scores.security(F.col("i"), F.col("n")).alias("got")).collect())


def test_sql_functions(spark):
    sql.register(spark)
    got = one(spark.sql("SELECT norm_text('PERÚ') AS a, partition_day('2026-07-08 10:30') AS b, naval_bucket(11) AS c, is_broken_translation('ababababab', 'x') AS d, is_broken_translation('fine words', 'x') AS e, link_hash('x') AS f"))
    assert tuple(got) == ("perú", "2026-07-08", 2, True, False, "11f6ad8ec52a2984abaafd7c3b516503785c2072")


def test_gold_as_csv(spark, tmp_path):
    (tmp_path / "g.csv").write_text("nom_du_media;titre\nA;t1\nB;t2\n")
    assert [r.titre for r in gold.read_gold(spark, f"{tmp_path}/g.csv").orderBy("line").collect()] == ["t1", "t2"]


def test_gold_as_workbook(spark, tmp_path):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(tmp_path / "g.xlsx", "w") as book:
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>nom_du_media</t></si><si><r><t>ti</t></r><r><t>tre</t></r></si><si><t>A</t></si></sst>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row><c r="A2" t="s"><v>2</v></c><c r="B2" t="inlineStr"><is><t>t1</t></is></c></row><row><c r="B3"><v>7</v></c></row></sheetData></worksheet>')
        book.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
    assert [(r.line, r.nom_du_media, r.titre) for r in gold.read_gold(spark, f"{tmp_path}/g.xlsx").orderBy("line").collect()] == [(0, "A", "t1"), (1, None, "7")]


def test_command_line(spark, tmp_path):
    d = tmp_path / "dict"
    d.mkdir()
    for name, said in {
        "themes.txt": "Sport: match, *cup\n", "countries.txt": "Peru: *peru\n", "naval.txt": "5: strait\n", "zones.txt": "Gulf: strait\n", "rules.txt": "", "regions.json": '{"Peru": "Latin America"}',
        "media.csv": "media;pays_siege;theme_media;note;indice_fiabilite;notation\nA;Peru;Tech;1;2;b\n", "bans.txt": "Spam *\n", "aliases.csv": "alias;canonique\nOld *;A\n", "languages.csv": "media;langue\n",
    }.items():
        (d / name).write_text(said)
    (tmp_path / "log.csv").write_text('media;titre;lien;date\nOld A;"The cup; Perú and the strait";http://1;2026-07-08 10:30\nSpam Daily;The cup;http://2;2026-07-08 10:30\nB;;http://3;\nB;dans la rue pour une coupe;http://4;2026-07-09 10:30\n')
    for _ in range(2):
        cli.main(["classify", f"{tmp_path}/log.csv", str(d), f"{tmp_path}/archive"])
    store = DayStore(spark, f"{tmp_path}/archive")
    assert store.state().number == 1 and sorted(store.state().pending) == ["2026-07-08", "2026-07-09"]
    row = one(store.read(end="2026-07-08"))
    assert (row.nom_du_media, row.sujet_article, row.country_article, row.region, row.confiance_pays_article, row.indice_interet_naval, row.region_maritime) == ("A", "Sport", "Peru", "Latin America", "medium", 5.0, "Gulf")
    cli.main(["publish", f"{tmp_path}/archive", f"{tmp_path}/remote", "--until", "2026-07-08"])
    assert store.state().pending == ("2026-07-09",) and spark.read.parquet(f"{tmp_path}/remote/data-2026/2026-07-08.parquet").count() == 1
    cli.main(["retry", f"{tmp_path}/archive", str(d), "--model", "tests.test_sources:model"])
    told = {r.lien: (r.titre, r.titre_vo, r.sujet_article) for r in store.read().collect()}
    assert told["http://4"] == ("the cup match", "dans la rue pour une coupe", "Sport") and told["http://1"][1] == ""
    for more in ([], ["--everything"]):
        cli.main(["rescan", f"{tmp_path}/archive", str(d), f"{tmp_path}/again", *more])
    assert DayStore(spark, f"{tmp_path}/again").read().count() == 2
    cli.main(["csv", f"{tmp_path}/archive", f"{tmp_path}/csv", "--country", "Peru", "--search", "CUP"])
    assert [r.lien for r in spark.read.csv(f"{tmp_path}/csv", sep=";", header=True).collect()] == ["http://1"]
    cli.main(["migrate", f"{tmp_path}/csv", f"{tmp_path}/moved"])
    assert one(DayStore(spark, f"{tmp_path}/moved").read()).titre == row.titre
    cli.main(["sqlite", f"{tmp_path}/archive", f"{tmp_path}/a.db"])
    cli.main(["site", f"{tmp_path}/archive", f"{tmp_path}/site", "--date-ref", "2026-07-08", "--repo", "x/y"])
    assert spark.read.json(f"{tmp_path}/site/data").count() == 2 and one(spark.read.json(f"{tmp_path}/site/meta")).repo == "x/y"
    cli.main(["vacuum", f"{tmp_path}/archive"])
    assert store.read().count() == 2
    assert files.delete(spark, f"{tmp_path}/site") and not files.exists(spark, f"{tmp_path}/site")


def model():
    return lambda titles, code: ["the cup match" for _ in titles]
