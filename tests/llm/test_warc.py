import base64
import gzip
import hashlib
from html.parser import HTMLParser

from tunelake.llm import queries, warc

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "source_key string, record_id string, target_uri string, warc_date string, http_headers string, payload string, "
    "block string, record int"
)


class _Text(HTMLParser):
    """The visible words, by the library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "head", "noscript", "template", "svg")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "head", "noscript", "template", "svg")

    def handle_data(self, data):
        if not self.hidden:
            self.words.append(data)


def test_records_of_given_pages(spark):
    pages = {str(r.page_id): r for r in queries.table(spark, SF, "pages").collect()}
    rows = warc.derivatives(warc.page_responses(queries.table(spark, SF, "pages"), "2024-01-01T00:00:00Z")).collect()
    assert len(rows) == 2 * len(pages) and len({r.record_id for r in rows}) == len(rows)
    for row in rows:
        page = pages[row.source_key]
        (headers, block), = warc.read_records(bytes(row.record))
        assert block.decode() == row.block and headers["WARC-Refers-To"] == row.refers_to
        assert headers["WARC-Target-URI"] == page.url and headers["WARC-Type"] == row.record_type
        assert headers["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        if row.record_type == "conversion":
            parser = _Text()
            parser.feed(page.html)
            parser.close()
            assert "".join(row.block.split()) == "".join("".join(parser.words).split())
        else:
            assert f"source-payload-digest: {warc.digest(page.html.encode())}\r\n" in row.block
            assert "source-http-header: Content-Type: text/html; charset=utf-8\r\n" in row.block


def test_query(spark):
    rows = queries.op3_warc_derivatives(spark, SF).collect()
    assert len(rows) == 2 * queries.table(spark, SF, "pages").count()
    assert {r.record_type for r in rows} == {"metadata", "conversion"}


def test_text_of_odd_pages():
    assert warc.plain_text("<p>a &amp; b<br>c</p><!-- x --><script>if (a<b) {}</script>1 < 2 <b>bo</b>ld") == (
        "a & b\nc\n1 < 2 bold"
    )
    assert warc.plain_text("<p>a<script>open") == "a" and warc.plain_text("x<!-- open") == "x"
    assert warc.plain_text("&lt;p&gt; &#233;&nbsp;z\r\n\r\n") == "<p> é z"
    assert warc.title("<TITLE>a\n &lt;b</title>") == "a <b" and warc.title(None) == ""
    assert warc.links("<a class=x href='/1'>a</a><A HREF=/2>b</a><a href=\"/1\">c</a><!-- <a href=/3> -->") == ["/1", "/2"]
    assert len(warc.plain_text("<p>word " * 200_000).split("\n")) == 200_000


def test_nulls_repeats_and_files(spark):
    row = ("k", "<urn:uuid:1>", "http://a", "2024-01-01T00:00:00Z", "H: 1\r\nX-Y: z\r\n\r\n", "<p>t</p>", "clash", 1)
    rows = [row, row, (None,) * 8, ("e", None, "http://b", None, None, "", None, None)]
    responses = spark.createDataFrame(rows, SCHEMA)
    got = warc.derivatives(responses).collect()
    assert len(got) == 8
    empty = [r for r in got if r.source_key is None]
    assert {r.record_type: r.content_length > 0 for r in empty} == {"metadata": True, "conversion": False}
    assert all(r.refers_to.startswith("<urn:uuid:") and b"None" not in bytes(r.record) for r in got)
    assert [r.refers_to for r in got].count("<urn:uuid:1>") == 4
    data = gzip.decompress(warc.compressed([bytes(r.record) for r in got]))
    assert [block.decode() for _, block in warc.read_records(data)] == [r.block for r in got]
    assert "source-http-header: X-Y: z" in next(r.block for r in got if r.source_key == "k")
    assert warc.derivatives(responses.limit(0)).count() == 0


def test_omitted_end_tags_hide_nothing():
    link, rest = "<a href=/1>b</a>", "<p>a " + "<a href=/1>b</a><p>c"
    head = "<!doctype html><html><head><title>T</title><meta charset=utf-8><style>p {}</style>"
    for page in (
        head + "</head><body>" + rest, head + "<body>" + rest, head + rest, head + "a " + link + "<p>c",
        head + "<script>x = '</head>'</script>" + rest, "<title>T" + rest, "<head><title>T</head>" + rest,
        "<title>How to <script> <!--</title>" + rest, "<svg width=1 />" + rest, "<svg/>" + rest,
        "<svg viewBox='0 0 1 1'/><p>a " + link + "<svg><title>x</title><text>y</text></svg><p>c",
        "<noscript>" + rest, "<template>" + rest, "<svg>" + rest, "<noscript>no</noscript>" + rest,
        "<svg><svg>x</svg>y</svg>" + rest, "<template><svg>x</template>" + rest, "<svg href=a/>x</svg>" + rest,
        "<svg><style>x</svg>" + rest, "<head><script>x</head>" + rest, rest + "<script>x" + rest, rest + "<!--" + rest,
        "<header-x>" + rest, "<svg-icon>" + rest,
    ):
        assert "".join(warc.plain_text(page).split()) == "abc", page
        assert warc.links(page) == ["/1"], page
    assert warc.title(head + rest) == "T" and warc.title("<title>T" + rest) == "T"
    assert warc.title("<head><title>a <b> c</title>") == "a c"


def test_many_unclosed_elements_take_time_in_proportion():
    for tag in ("noscript", "svg", "template", "title", "head"):
        page = f"<{tag}>word<p>" * 50_000
        assert warc.plain_text(page) == ("" if tag == "title" else "\n".join(["word"] * 50_000))
