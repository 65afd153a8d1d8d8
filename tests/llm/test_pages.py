"""HTML extraction, URL rules and WARC archives."""

from __future__ import annotations

import base64
import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from anonkit.llm import html_text, url_filters, warc
from anonkit.llm.common import table
from anonkit.llm.queries import ORACLE_SQL, QUERIES
from anonkit.sources.scratch import fresh_dir

# ---- main text --------------------------------------------------------------

LONG = "The article has a long story that differs on each page, told at length and with many words. "


def page(i, extra=""):
    return (
        f"<html><head><title>T{i}</title><style>p{{}}</style></head><body><header>Site</header><nav><a>Home</a></nav>"
        f"<div class=box>Join our club today &amp; save</div><div class=story><h1>Title {i}</h1><p>{LONG}{i * 7919}<p>More on {i}</div>"
        f"{extra}<footer>f</footer><script>var a='<p>';</script></body></html>"
    )


def extract(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    return {r.page_id: r for r in html_text.extract(df, **options).collect()}


def test_repeated_branches_of_a_host_are_removed(spark):
    got = extract(spark, [(i, f"http://a.example/{i}", page(i)) for i in range(40)])
    for i, r in got.items():
        assert r.text == f"Title {i}\n{LONG}{i * 7919}\nMore on {i}" and r.n_chars == len(r.text)


@pytest.mark.parametrize("list_paths", [html_text.LIST_PATHS, 0])
def test_a_box_on_few_pages_of_a_large_host_is_removed(spark, list_paths):
    """The same box on 20 of 2,000 pages; with ``list_paths=0`` every page gets its own paths by the join."""
    box = "<div class='teaser'><p>Ten tips that doctors hate</p></div>"
    rows = [(i, "http://big.example/", f"<body>{box if i % 100 == 0 else ''}<div class='text'><p>Story {i} {LONG}</p></div></body>") for i in range(2000)]
    rows += [(5000 + i, "http://big.example/", f"<body><div class='teaser{i}'><p>Once {i}</p></div><p>Story {LONG}</p></body>") for i in range(3)]
    rows += [(9000, None, None), (9000, None, None), (9001, "http://big.example/", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"host": F.lit("x"), "paths": F.lit("x"), "digest": F.lit("x")})
    got = {r.page_id: r for r in html_text.extract(df, list_paths=list_paths).collect()}
    assert html_text.extract(df, list_paths=list_paths).count() == len(rows)
    assert all(got[i].text == f"Story {i} {LONG}".strip() for i in range(2000))
    assert all(got[5000 + i].text == f"Once {i}\nStory {LONG}".strip() for i in range(3))
    assert got[9000].text == got[9001].text == ""


@pytest.mark.parametrize("list_paths", [html_text.LIST_PATHS, 0])
def test_small_hosts_are_judged_together(spark, list_paths):
    """Hosts of one to three pages: a site builder's box goes, what is a host's own or an article stays, copied articles too."""
    box = "<div class='builder'><p>Made with our builder, try it today</p></div>"
    rows, want = [], {}
    for i in range(120):
        url, kind = f"http://small{i // (1 + i % 3)}.example/{i}", i % 4
        story = f"Story {i} {LONG}".strip()
        if kind == 0:  # a box of its own
            body, text = f"{box}<div class='own{i}'><p>Own box</p></div><div class='text'><p>{story}</p></div>", f"Own box\n{story}"
        elif kind == 1:  # one article on all of them
            body, text = f"{box}<div class='copy'><h2>Copied</h2><p>{LONG}</p></div>", f"Copied\n{LONG}".strip()
        else:  # the box's style with texts of the page
            body, text = f"<div class='text'><p>{story}</p></div><div class='quote'><p>Said {i}</p></div>", f"{story}\nSaid {i}"
        rows.append((i, url, f"<html><body>{body}</body></html>"))
        want[i] = text
    got = extract(spark, rows, list_paths=list_paths)
    assert {i: r.text for i, r in got.items()} == want
    # the box on nine pages in all is too little to tell
    few = extract(spark, [r for r in rows if r[0] % 4 == 0][:9], list_paths=list_paths)
    assert all("Made with our builder" in r.text for r in few.values())


def test_both_ways_to_hand_out_paths_are_equal(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    assert sorted(html_text.extract(pages, list_paths=0).collect()) == sorted(html_text.extract(pages).collect())


def test_small_hosts_and_copies_keep_their_text(spark):
    rows = [(i, f"http://h{i}.example/", page(i)) for i in range(5)] + [(100 + i, "http://copies.example/", page(7)) for i in range(30)]
    got = extract(spark, rows)
    assert all("Join our club today & save\nTitle" in got[i].text for i in range(5))
    assert all(f"Title 7\n{LONG}" in got[100 + i].text for i in range(30))


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &lt;b&gt; text", "plain <b> text"),
        ("<p>a  b<p>c <b>d</b>e<br>f<ul><li>1<li>2</ul>", "a b\nc de\nf\n1\n2"),
        ("<main><h1>T</h1><header>kept</header></main><p>outside", "T\nkept"),
        ("<article>x<div class='comments'><p>nice</div>y</article><aside>z</aside>", "x\ny"),
        ("<body><div id=sidebar>s</div><div class='cookie-notice'>c</div><form>f</form>t", "t"),
        ('<a title="x>y">tail</a> 3 < 4 &amp', "tail 3 < 4 &"),
        ("cut <!-- off", "cut"),
        ("cut <p class='", "cut"),
        ("<script>if (a</b) {'<p>'}</script>t<textarea><p>no</textarea>", "t"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("</p></div>stray", "stray"),
    ],
)
def test_markup(source, text):
    assert html_text.Page(source).main_text(set()) == text


def test_deep_and_broken_markup_is_read_fast():
    for source in ("<div>" * 50_000 + "x", "<div a='" * 50_000, "<" * 200_000, "<p>x" * 50_000, "<!--" * 50_000):
        html_text.Page(source)


def test_op3_equals_the_article_of_each_page(spark, sf_dir):
    import html

    rows = QUERIES["op3_html_text"](spark, sf_dir).collect()
    sources = {r.page_id: r.html for r in table(spark, sf_dir, "pages").collect()}
    assert len(rows) == len(sources)
    for r in rows:
        article = re.split(r"</article>|<footer", sources[r.page_id].split("<article>")[1])[0]
        lines = re.sub(r"</?b>|<[a-z/]*\Z", "", re.sub(r"<br>|</?p>|</?h1>", "\x00", article)).split("\x00")
        want = [" ".join(html.unescape(line).split()) for line in lines]
        assert r.text == "\n".join(w for w in want if w)


def test_extraction_of_an_empty_table(spark):
    assert extract(spark, []) == {}
    assert extract(spark, [(None, None, None), (None, None, None), (1, "no host", "<p>x")])[1].text == "x"


# ---- URLs -------------------------------------------------------------------

URLS = [
    None, "", "no scheme/en/", "http://www.Example.com/en/a?b#c", "https://example.com/en/x", "https://example.com", "https://a.b.net/fr/",
    "http://notexample.com/en/", "http://x.org/xxx/1", "http://x.org/casino-poker", "http://x.org/casino?casino", "http://x.org/xxxl",
    "http://essex.org/sussex", "ftp://NET/es/q://x", "http://u@net:80/es/", "http://x.org/POKER/Casino", "a://b\nc/d\n?e", "://com/",
]


def test_op7_equals_its_sql(spark, sf_dir, tmp_path):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[3]), (None, "http://x.com/")]
    spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit("clash")).write.parquet(f"{tmp_path}/pages.parquet")
    for folder, glob in ((sf_dir, ""), (str(tmp_path), "/*.parquet")):
        con = duckdb.connect()
        con.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet{glob}'")
        want = con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLE_SQL['op7_url_filters']})").fetchall()
        got = [tuple(r) for r in QUERIES["op7_url_filters"](spark, folder).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_rules_override_the_vocabulary(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id bigint, url string")
    got = {r.url: (r.rule, r.verdict) for r in url_filters.judge_urls(df, "page_id", "url").join(df, "page_id").collect()}
    assert got["http://www.Example.com/en/a?b#c"] == ("www.example.com/en/", "allow")
    assert got["https://example.com/en/x"] == ("example.com/en/", "block")
    assert got["https://example.com"] == (None, "allow")
    assert got["https://a.b.net/fr/"] == ("net/fr/", "block")
    assert [got[u][1] for u in URLS[8:13]] == ["block", "block", "allow", "allow", "allow"]
    assert url_filters.judge_urls(df.limit(0), "page_id", "url").count() == 0


# ---- archives ---------------------------------------------------------------


def expected(rows, least_bytes=0):
    def digest(text):
        return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()

    least, seen, out = {}, set(), []
    for key, _, text in rows:
        least[digest(text)] = min(least.get(digest(text), key), key)
    for key, _, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        d, n = digest(text), len((text or "").encode())
        first = n < least_bytes or (key == least[d] and d not in seen)
        seen.add(d)
        out.append((key, n, d, "response" if first else "revisit", None if first else least[d]))
    return sorted(out, key=str)


ARCHIVED = [(i, f"http://x/{i}\n é", [None, "", "dup", f"page {i} ü" * 50][i % 4]) for i in range(300)]
ARCHIVED += [(2, "http://other", "dup")] * 3 + [(10**12, None, "z" * 300_000)]


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 20_000, "roll_bytes": 3_000}, {"least_bytes": 3}])
def test_archives_are_an_exact_round_trip(spark, options):
    df = spark.createDataFrame(ARCHIVED, "page_id bigint, url string, html string").withColumn("shard", F.lit("clash"))
    got = [tuple(r)[:5] for r in warc.archive(spark, df.repartition(4), **options).collect()]
    assert sorted(got, key=str) == expected(ARCHIVED, options.get("least_bytes", 0))


def test_op8_over_pages(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "pages").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in QUERIES["op8_warc"](spark, sf_dir).collect()), key=str) == expected(rows)


def test_the_same_rows_give_the_same_files(spark, tmp_path):
    df = spark.createDataFrame(ARCHIVED, "page_id bigint, url string, html string")
    found = []
    for i, parts in enumerate((3, 5)):
        manifest = warc.write_archives(df.repartition(parts), f"file://{tmp_path}/{i}", shard_bytes=20_000, roll_bytes=3_000).collect()
        found.append(sorted((r.path.rsplit("/", 1)[1], r.records, r.bytes, r.sha256) for r in manifest))
        for r in manifest:
            data = open(r.path.removeprefix("file://"), "rb").read()  # noqa: SIM115
            assert (len(data), hashlib.sha256(data).hexdigest()) == (r.bytes, r.sha256)
        assert sum(r.records for r in manifest) == len(ARCHIVED)
        order = [r.path for r in sorted(manifest, key=lambda r: (r.shard, r.part))]
        keys = [int(h["x-page-id"]) for p in order for h, _ in map(warc.parse, warc.members(p)) if "x-page-id" in h]
        assert len(keys) == len(ARCHIVED)
    assert found[0] == found[1] and len(found[0]) > 5


def test_payloads_come_back_and_damage_is_seen(spark, tmp_path):
    df = spark.createDataFrame(ARCHIVED[:20], "page_id bigint, url string, html string")
    manifest = warc.write_archives(df, f"file://{tmp_path}/a")
    rows = warc.read_archives(spark, manifest, with_payload=True).where("record_type = 'response'").collect()
    texts = {r[0]: r[2] or "" for r in ARCHIVED}
    assert all(bytes(r.payload).decode() == texts[r.page_id] for r in rows)
    record = next(iter(warc.members(manifest.first().path)))
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(record.replace(b"format", b"fermat"))


def test_archives_of_odd_tables(spark):
    df = spark.createDataFrame([(None, None, None), (None, "u", "x"), (5, "u", "x")], "page_id bigint, url string, html string")
    rows = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.archive(spark, df).collect()), key=str)
    assert rows == [(5, "revisit", None), (None, "response", None), (None, "response", None)]
    assert warc.archive(spark, df.limit(0)).count() == 0


def test_shards_follow_the_data(spark):
    """One far-off id, clustered ids, a third of the pages without html: shards stay even, and in key order."""
    rows = [(i, f"http://h/{i}", None if i % 3 == 0 else f"page {i} " * 40) for i in range(600)]
    rows += [(10**18, "http://far/", "far"), (-(2**63), "http://least/", "least"), (2**63 - 1, "http://most/", "most"), (None, "http://none/", "none")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    manifest = warc.write_archives(pages, fresh_dir(spark, "warc"), shard_bytes=40_000)
    records = {r.shard: r.n for r in manifest.groupBy("shard").agg(F.sum("records").alias("n")).collect()}
    assert len(records) >= 8 and max(records.values()) < 3 * len(rows) / len(records)
    found = warc.read_archives(spark, manifest).collect()
    assert sorted((r.page_id is not None, r.page_id or 0) for r in found) == sorted((r[0] is not None, r[0] or 0) for r in rows)
    empty = [r for r in found if r.payload_bytes == 0]
    assert [r.page_id for r in empty if r.record_type == "response"] == [0] and {r.refers_to for r in empty if r.page_id} == {0}
    narrow = pages.select(F.col("page_id").alias("key"), "url", F.sha1(F.coalesce("html", F.lit(""))).alias("digest"), F.lit(300).cast("bigint").alias("size"))
    borders = warc.plan_shards(narrow, 3_000)
    assert len(borders) > 100
    shards = narrow.select("key", "digest", warc.shard_column(borders).alias("shard")).collect()
    rank = lambda k, d: (k is not None, k or 0, d)
    assert all(r.shard == sum(rank(*b) <= rank(r.key, r.digest) for b in borders) for r in shards)
