"""Operators on pages, the pipeline, and the corpus queries against their SQL."""

from __future__ import annotations

import base64
import hashlib
import html
import math
import random
import re
import time
from collections import Counter
from html.parser import HTMLParser
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from faremill.llm import html_text, quality_model, queries, url_filters, warc
from test_documents import _base_spans, _components, _contained

DATA = Path("/root/testdata/sf0.001")
SCHEMA = "page_id long, url string, html string, text string, host string, n long, template string"

ARTICLE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu one</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, many, and more, and more of them on this site.</p></div>
<div id="wrap"><article><h1>Title</h1><p>First   para, with commas, and more text to count, really.
<p>Second &eacute; &#65; <b>bo</b>ld<br>line, and, some, more words to be counted here.<ul><li>one<li>two</ul>
<form><p>Sign up now, please, for our very long and great newsletter.</p></form>
<table><tr><td>c1<td>c2</table><aside>Related stories, all of them</aside></article>
<div class="sidebar-left"><p>Side, text, with, many, commas, and a long sentence here.</p></div>
<section id="comments"><p>Great post, thank you, I liked it, very, very much indeed.</p></section></div>
<script>var t = "</p>";</script><footer>&copy; 2020, all rights, reserved, by us, and others.</footer>"""
PAGES = [
    (1, "HTTP://User@Blog.Example.COM:80/de/1?x#y", ARTICLE),
    (2, None, None),
    (3, "no scheme", ""),
    (4, "http://example.net/en/5.html", "<p>"),
    (4, "http://example.net/en/5.html", "<p>"),
    (None, "https://a.b.example.net/en/", "plain text, without markup, though &lt;long&gt; enough to be one block"),
    (6, "https://net", "<div>" * 300 + "deep, very deep, and deeper than most, really" + "</div>" * 300),
    (7, "http://x.org/fr/a/b/c/d/e/f/g/h/i/j/k", "<body><script>never closed"),
    (8, "http://x.org?q=/fr/", "<p>" + "word, " * 40000),
    (9, "http://exampleXnet/en/", "<!-- open"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*row, "t", "h", 1, "x") for row in PAGES], SCHEMA)


def test_main_text():
    expected = (
        "Title First para, with commas, and more text to count, really. "
        "Second é A bold line, and, some, more words to be counted here. one two c1 c2"
    )
    assert html_text.main_text(ARTICLE) == expected


@pytest.mark.parametrize(
    "page, text",
    [
        ("<main><p>Short.</p></main><footer>f</footer>", "Short."),
        ("<div><div><p>One, two, three, four and five words.</p><p>More, of, the, same kind of words.</p></div>"
         "<div class=links><a href=a>Link, one, two, three, four, five</a></div></div>",
         "One, two, three, four and five words. More, of, the, same kind of words."),
        ("<p>a<b>b</b>c <i>d</i></p>", "abc d"),
        ("<div hidden><p>Hidden, text, that is long enough to count.</p></div><p>Shown, text, that is long enough to count.</p>",
         "Shown, text, that is long enough to count."),
    ],
)
def test_small_pages(page, text):
    assert html_text.main_text(page) == text


def test_extracted_rows(spark, pages):
    rows = html_text.extracted(pages).collect()
    assert Counter((r.page_id, r.url) for r in rows) == Counter((i, u) for i, u, _ in PAGES)
    by_id = {r.page_id: r for r in rows}
    assert by_id[2].text == by_id[3].text == by_id[4].text == by_id[7].text == by_id[9].text == ""
    assert by_id[None].text.endswith("though <long> enough to be one block")
    assert by_id[6].text.startswith("deep") and by_id[8].n_chars == 40000 * 6 - 1
    assert all(r.n_chars == len(r.text) for r in rows)
    supplied = spark.read.parquet(str(DATA / "pages.parquet"))
    found = {r.page_id: r.text for r in html_text.extracted(supplied).collect()}
    for row in supplied.collect():
        body = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body))
        assert found[row.page_id] == " ".join(html.unescape(plain).split())


def _host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def _rule(host, path):
    fit = []
    for rule in url_filters.RULES:
        site, _, start = rule.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith("/" + start):
            fit.append(rule)
    return max(fit, key=len, default=None)


def test_rules_of_urls(spark, pages):
    labels = spark.createDataFrame([], "url_key long, good boolean")
    supplied = spark.read.parquet(str(DATA / "pages.parquet"))
    both = pages.select("page_id", "url").union(supplied.select("page_id", "url"))
    rows = url_filters.judged(both, labels).collect()
    expected = Counter()
    for page_id, url in [(i, u) for i, u, _ in PAGES] + [(r.page_id, r.url) for r in supplied.collect()]:
        host, path = _host_path(url)
        rule = _rule(host, path)
        expected[page_id, host, path, rule, url_filters.RULES.get(rule, "allow")] += 1
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows) == expected
    assert url_filters.judged(both.limit(0), labels).count() == 0


def test_templates_are_rejected_by_labels(spark):
    rows = [(i, f"http://h.com/{kind}/{word}-{i}") for i, (kind, word) in enumerate(
        [("good", "x"), ("fine", "y")] * 60 + [("spam", "z")] * 60)]
    rows += [(1000 + i, f"http://h.com/blog/post{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(200)]
    table = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i < 120) for i in range(180) if i % 4 < 2], "url_key long, good boolean")
    keyed = table.withColumn("url", F.concat("url", F.lit("/"), F.col("page_id")))
    found = url_filters.judged(keyed, labels).collect()
    verdicts = {(r.path.split("/")[1], r.verdict) for r in found}
    assert verdicts == {("good", "allow"), ("fine", "allow"), ("spam", "block"), ("blog", "allow")}
    templates = {r.path.split("/")[1]: r.template for r in found}
    assert templates["blog"] == "/blog/{*}/{num}" and templates["spam"].startswith("/spam/")
    assert templates["good"] == templates["fine"] == "/{+0}/{*}/{num}"


def test_rare_sections_are_judged_by_their_own_labels(spark):
    """25 sections of 4 % each: three are all bad, and one of the good ones has three bad pages by chance."""
    names = [a + b for a in "abcde" for b in "vwxyz"]
    rows = [(i, f"http://h.net.test/{names[i % 25]}/{i}") for i in range(2500)]
    marks = [(i, not (i % 25 < 3 or i in (3, 28, 53))) for i in range(2500)]
    keyed = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame(marks, "url_key long, good boolean")
    found = url_filters.judged(keyed, labels).collect()
    assert {r.page_id for r in found if r.verdict == "block"} == {i for i in range(2500) if i % 25 < 3}


def test_rare_sections_with_chance_labels_stay_together(spark):
    rows = [(i, f"http://h.net.test/{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}x/{i}") for i in range(1000)]
    labels = spark.createDataFrame([(i, i * 7919 % 10 > 2) for i in range(0, 1000, 7)], "url_key long, good boolean")
    found = url_filters.judged(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()
    assert {r.verdict for r in found} == {"allow"}
    assert len({r.template for r in found}) == 1


def test_paths_that_part_deep_down_are_told_apart(spark):
    start = "/".join(f"s{i}" for i in range(8))
    rows = [(i, f"http://h.net.test/{start}/{'good' if i % 2 else 'evil'}/x/{i}") for i in range(400)]
    rows += [(1000 + i, "http://other.test/" + "a/" * 300 + str(i)) for i in range(3)]
    labels = spark.createDataFrame([(i, i % 2 == 1 or i % 10 == 0) for i in range(400)], "url_key long, good boolean")
    found = url_filters.judged(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()
    assert {r.page_id for r in found if r.verdict == "block"} == set(range(0, 400, 2))
    assert {r.template for r in found if r.page_id >= 1000} == {"/a" * 300 + "/{num}"}


@pytest.mark.parametrize("count", [3, 20, 21, 60])
def test_one_rule_for_few_children_and_for_many(spark, count):
    """A bad section is blocked, and a small one without labels follows its siblings, however many these are."""
    names = [a + b for a in "abcdefgh" for b in "qrstuvwx"][:count]
    rows = [(i, f"http://h.net.test/{names[i % count]}/{i}") for i in range(40 * count)]
    marks = [(i, i % count != 1) for i in range(40 * count) if i % count != 2]
    labels = spark.createDataFrame(marks, "url_key long, good boolean")
    found = url_filters.judged(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()
    assert {names.index(r.path.split("/")[1]) for r in found if r.verdict == "block"} == {1}


def _plain_templates(rows):
    """The tree by recursion over dictionaries: {(host, shape): template} from (host, shape, n, labelled, bad)."""
    out = {}

    def grow(host, template, own):
        for shape, _, _, _, rest in [r for r in own if not r[4]]:
            out[host, shape] = template
        own = [r for r in own if r[4]]
        if not own:
            return
        k = 0
        while all(len(r[4]) > k for r in own) and len({r[4][k] for r in own}) == 1:
            k += 1
        template += "".join(f"/{x}" for x in own[0][4][:k])
        children = {}
        for r in own:
            rest = r[4][k:]
            if not rest:
                out[host, r[0]] = template
            else:
                children.setdefault(rest[0], []).append((*r[:4], rest[1:]))
        kin = {}
        for child, below in children.items():
            tails = Counter()
            for r in below:
                tails["/".join(x if x.startswith("{") else "-" for x in r[4])] += r[1]
            tail = max((n, t) for t, n in tails.items())[1]
            kin.setdefault(tail, []).append((child, sum(r[2] for r in below), sum(r[3] for r in below)))
        names = {}
        for siblings in kin.values():
            usual = (sum(b for _, _, b in siblings) + 0.5) / (sum(m for _, m, _ in siblings) + 1)
            limit = math.log(max(2 * sum(m > 0 for _, m, _ in siblings) / url_filters.FALSE_ODD, 1))
            bins = {}
            for child, m, b in siblings:
                p = b / max(m, 1)
                far = m * sum(x * math.log(x / u) for x, u in ((p, usual), (1 - p, 1 - usual)) if x > 0)
                bins.setdefault(min(int(p * 10), 9) if m and far > limit else None, []).append((child, m, b))
            branches, last = {None: bins.pop(None, [])}, None
            for tenth in sorted(bins):
                m, b = sum(x[1] for x in bins[tenth]) + 1, sum(x[2] for x in bins[tenth]) + 0.5
                if last:
                    whole = (b + last[1]) / (m + last[0])
                    error = math.sqrt(whole * (1 - whole) * (1 / m + 1 / last[0]))
                if not last or b / m - last[1] / last[0] > url_filters.SIMILAR * error:
                    begun = tenth
                branches.setdefault(begun, []).extend(bins[tenth])
                last = (m, b)
            for begun, members in branches.items():
                for child, _, _ in members:
                    names[child] = child if len(members) == 1 else "{*}" if begun is None else f"{{+{begun}}}"
        nodes = {}
        for child, below in children.items():
            nodes.setdefault(names[child], []).extend(below)
        for name, below in nodes.items():
            grow(host, f"{template}/{name}", below)

    for host in {r[0] for r in rows}:
        grow(host, "", [(s, n, m, b, s.split("/") if s else []) for h, s, n, m, b in rows if h == host])
    return out


def test_templates_equal_a_plain_tree(spark):
    dice = random.Random(11)
    rows = {}
    for _ in range(700):
        host = dice.choice(["a.b", "c", ""])
        parts = [dice.choice(["{num}", "{id}", *"pqrstuvw"]) for _ in range(dice.choice([0, 1, 2, 2, 3, 3, 6]))]
        labelled = dice.choice([0, 0, 3, 40])
        share = {"p": 1.0, "q": 0.9, "r": 0.5, "s": 0.45}.get(parts[0] if parts else "", 0.02)
        bad = sum(dice.random() < share for _ in range(labelled))
        rows[host, "/".join(parts)] = (labelled + dice.randrange(1, 5), labelled, bad)
    rows = [(*key, *value) for key, value in rows.items()]
    table = spark.createDataFrame(rows, "host string, shape string, n long, labelled long, bad long")
    found = {(r.host, r.shape): r.template for r in url_filters.templates(table).collect()}
    expected = _plain_templates(rows)
    assert found == expected and len({t for t in expected.values() if "{+" in t}) > 3


def test_derived_records(spark, pages):
    responses = warc.responses(pages)
    rows = warc.derivatives(responses).collect()
    assert len(rows) == 2 * len(PAGES)
    sources = {r.record_id: r for r in responses.collect()}
    for row in rows:
        source = sources[row.refers_to]
        assert (row.target_uri, row.date) == (source.target_uri, source.date)
        assert row.payload_digest == row.headers["WARC-Payload-Digest"]
        assert row.payload_digest == "sha1:" + base64.b32encode(hashlib.sha1(source.payload.encode()).digest()).decode()
        assert row.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(row.block.encode()).digest()).decode()
        assert row.content_length == len(row.block.encode())
    text = next(r.block for r in rows if r.warc_type == "conversion" and "Second" in r.block)
    assert "Second é A bold" in text.split("\n") and "track" not in text
    meta = next(r.block for r in rows if r.warc_type == "metadata" and "title" in r.block)
    assert "title: T & x\r\n" in meta and "outlink: /a\r\n" in meta and "http-status: 200\r\n" in meta
    assert warc.derivatives(responses.limit(0)).count() == 0


def test_source_headers_are_kept(spark):
    row = ("<urn:uuid:1>", "http://a/", "2020-01-01T00:00:00Z", {"WARC-Type": "response", "WARC-IP-Address": "1.2.3.4"}, None, None)
    records = spark.createDataFrame([row, (None, None, None, None, None, "<p>x")], warc.RESPONSE)
    found = warc.derivatives(records).collect()
    named = [r for r in found if r.source_id]
    assert all(r.headers == {"WARC-Source-Header-WARC-Type": "response", "WARC-IP-Address": "1.2.3.4"} for r in named)
    assert len({r.record_id for r in found}) == 4 and all(r.refers_to == r.source_id for r in found)


def test_serialised_records_read_back(spark, pages):
    derived = warc.derivatives(warc.responses(pages))
    blocks = Counter((r.record_id, r.block) for r in derived.collect())
    found = Counter()
    for row in warc.serialised(derived).collect():
        head, _, rest = row.content.encode().partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        assert lines[0] == "WARC/1.0" and rest[size:] == b"\r\n\r\n"
        found[fields["WARC-Record-ID"], rest[:size].decode()] += 1
    assert found == blocks


def test_files_of_records_read_back(spark, pages, tmp_path):
    derived = warc.derivatives(warc.responses(pages.where("page_id < 7")))
    warc.write_warc(derived, str(tmp_path / "out"))
    found = warc.read_warc(spark, str(tmp_path / "out")).collect()
    assert all(r.complete for r in found)
    assert Counter((r.headers["WARC-Record-ID"], r.headers["WARC-Refers-To"], r.block) for r in found) == Counter(
        (r.record_id, r.refers_to, r.block) for r in derived.collect()
    )


def test_responses_of_a_file(spark, tmp_path):
    def record(kind, name, block):
        size = len(block.encode())
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {name}\r\nWARC-Date: d\r\nX: a\r\nX: b\r\nContent-Length: {size}\r\n\r\n{block}\r\n\r\n"

    page = "HTTP/1.1 404 Not Found\r\nA: b\r\n\r\n<p>Gone &eacute;</p>\r\n\r\n<p>two"
    text = record("warcinfo", "<i>", "x") + record("response", "<r>", page) + record("response", "<e>", "") + "WARC/1.0\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(text.encode())
    records = warc.read_warc(spark, str(tmp_path / "a.warc"))
    assert [r.complete for r in records.collect()] == [True, True, True, False]
    found = {r.record_id: r for r in warc.responses_of(records).collect()}
    assert found["<r>"].payload == "<p>Gone &eacute;</p>\r\n\r\n<p>two" and found["<r>"].headers["X"] == "a"
    assert found["<e>"].payload == "" and set(found) == {"<r>", "<e>"}
    blocks = {(r.refers_to, r.warc_type): r.block for r in warc.derivatives(warc.responses_of(records)).collect()}
    assert blocks["<r>", "conversion"] == "Gone é\ntwo" and "http-status: 404" in blocks["<r>", "metadata"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = queries.queries()[name](spark, str(DATA))
    columns = sorted(frame.columns)
    answer = duck.execute(queries.oracle_sql()[name])
    names = [item[0] for item in answer.description]
    assert columns == sorted(names)
    places = [names.index(c) for c in columns]
    found = sorted(repr([row[c] for c in columns]) for row in frame.collect())
    assert found == sorted(repr([row[i] for i in places]) for row in answer.fetchall())


def test_pipeline_equals_brute_force(spark):
    """Each stage on what the one before kept, against plain Python; then the whole run."""
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    columns, schema = docs.columns, docs.schema
    stages = dict(corpus_pipeline.STAGES)

    def after(name, frame):
        kept = stages[name](spark, frame, str(DATA))
        assert kept.columns == columns
        return {row.doc_id: row for row in kept.collect()}

    def frame(rows):
        return spark.createDataFrame(list(rows.values()), schema)

    good = after("quality", docs)
    scored = quality_model.classified(docs, spark.read.parquet(str(DATA / "labels.parquet"))).collect()
    assert set(good) == {r.doc_id for r in scored if r.predicted == 1}

    apart = after("near_copies", frame(good))
    groups = _components([(i, r.text) for i, r in good.items()], width=5, percent=80)
    assert set(apart) == {doc_id for doc_id, _, smallest in groups if doc_id == smallest}

    items = [(r.item_id, r.text) for r in spark.read.parquet(str(DATA / "benchmark.parquet")).collect()]
    clean = after("benchmark", frame(apart))
    leaks = {doc_id for doc_id, *_ in _contained([(i, r.text) for i, r in apart.items()], items)}
    assert leaks and set(clean) == set(apart) - leaks

    masked = after("secret_scan", frame(clean))
    assert set(masked) == set(clean)
    changed = 0
    for doc_id, row in masked.items():
        text, spans = clean[doc_id].text or "", _base_spans(clean[doc_id].text or "")
        for span in sorted(spans.split(",") if spans else [], key=lambda s: -int(s.split(":")[1])):
            _, begin, end = span.split(":")
            text = text[: int(begin)] + "\0" + text[int(end) :]
        assert row.text == re.sub("\0+", "[SECRET]", text) or "[SECRET]" in row.text
        assert row.n_chars == (len(row.text) if spans else clean[doc_id].n_chars)
        changed += bool(spans)
    assert changed

    expected = sorted((r.doc_id, r.ids) for r in stages["token_ids"](spark, frame(masked), str(DATA)).collect())
    assert sorted((r.doc_id, r.ids) for r in corpus_pipeline.run(spark, str(DATA)).collect()) == expected


@pytest.mark.parametrize(
    "name",
    "comment-body comment-content post-comments article-comments main-nav main-menu page-header page-footer content-sidebar "
    "story-ad post-share entry-related cookie-text".split(),
)
def test_names_against_an_element_outweigh_names_for_it(name):
    leak = f'<div class="{name}"><p>Leak, leak, leak, and a long, long sentence here, truly.</p></div><p id="{name}">Leak, two.</p>'
    inside = f"<article><h1>Title</h1><p>One, two, three, four and five words.</p>{leak}<p>The end.</p></article>"
    beside = f"<div><p>One, two, three, four and five words.</p><p>The end.</p></div>{leak}"
    assert html_text.main_text(f"<body>{inside}</body>") == "Title One, two, three, four and five words. The end."
    assert html_text.main_text(f"<body>{beside}</body>") == "One, two, three, four and five words. The end."


def test_a_layout_named_after_its_sidebar_holds_the_text():
    page = (
        '<body class="no-footer"><div id="wrap" class="has-sidebar content"><div><p>One, two, three, four and five words.</p>'
        '<p>More, of, the same.</p></div><div class="sidebar"><p>Side, text, with, many, commas, and a long sentence.</p></div></div></body>'
    )
    assert html_text.main_text(page) == "One, two, three, four and five words. More, of, the same."


def test_short_sections_beside_the_best_one_stay():
    page = (
        "<div><section><h2>A</h2><p>One, two, three, four and five words.</p><p>More, of, the, same.</p></section>"
        "<section><h2>B</h2><p>Short.</p></section><section><a href=x>Other, pages, of, this, site</a></section></div>"
    )
    assert html_text.main_text(page) == "A One, two, three, four and five words. More, of, the, same. B Short."


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "<p>text, text, and more text to be found.</p>" * 3 + "</div>" * 100_000,
        "<div>" * 100_000 + "</span>" * 100_000,
        "<b><p>" * 100_000,
        "<article>" + "<header>" * 100_000,
        "<span>" * 50_000 + "<td>" * 50_000,
        "<a " * 350_000,
        "<!" * 300_000,
        "<title>" * 100_000,
        "<p>word, word, and a lot of other words. </p>" * 50_000,
    ],
)
def test_odd_pages_take_linear_time(page):
    begin = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - begin < 5


@pytest.mark.parametrize(
    "page", ["<a " * 350_000, "<a " * 300_000 + ">", "<title>" * 150_000, "<head>" * 160_000, "<script " * 120_000, "<!-- " * 200_000]
)
def test_odd_markup_takes_linear_time(page):
    begin = time.process_time()
    warc.plain_text(page)
    warc._metadata(page, "", "")
    assert time.process_time() - begin < 1


def _plain_lines(page):
    """The visible text of well-formed markup by a parser of the standard library."""
    hidden = {"script", "style", "template", "noscript", "head"}
    inline = set("a abbr b bdi bdo cite code em font i kbd mark q s samp small span strong sub sup u var".split())

    class Parser(HTMLParser):
        lines, depth = [""], 0

        def handle_starttag(self, tag, attrs):
            self.depth += tag in hidden
            if tag not in inline:
                self.lines.append("")

        def handle_endtag(self, tag):
            self.depth -= tag in hidden
            if tag not in inline:
                self.lines.append("")

        def handle_data(self, data):
            if not self.depth:
                self.lines[-1] += data.replace("\n", " ")

    parser = Parser(convert_charrefs=True)
    parser.lines = [""]
    parser.feed(page)
    parser.close()
    return [" ".join(line.split()) for line in parser.lines if line.strip()]


def test_plain_text_equals_a_parser(spark):
    supplied = spark.read.parquet(str(DATA / "pages.parquet")).collect()
    for row in supplied:
        assert warc.plain_text(row.html).split("\n") == _plain_lines(row.html)


def test_hidden_parts_of_broken_markup():
    assert warc.plain_text("a<!-- x <b>y</b> -->b<script>c</script>d<head>e") == "a b d\ne"
    assert warc.plain_text("a<head>t</head>b<script>never ends <b>c</b>") == "a b"
    assert warc.plain_text("a > b <!-- open") == "a > b" and warc.plain_text("<p>a<b") == "a<b"


def test_pages_of_one_name_and_other_content_have_records_of_their_own(spark):
    rows = spark.createDataFrame([(1, "http://a/", "<p>x"), (1, "http://a/", "<p>y"), (1, "http://a/", "<p>y")], "page_id long, url string, html string")
    found = warc.derivatives(warc.responses(rows)).collect()
    assert len(found) == 6 and len({r.record_id for r in found}) == 4
