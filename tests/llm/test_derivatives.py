import base64
import gzip
import hashlib
import random
from html.parser import HTMLParser

import pytest

from corpusloom.llm import derivatives as dv
from corpusloom.llm.registry import op10_warc_derivatives

PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style><script>var t="<p>no</p>";</script></head>
<body><!-- gone <b>too</b> --><h1>Head  line</h1><p>One <b>two</b>&nbsp;three<br>four &lt;five&gt;</p>
<a href="/x?a=1&amp;b=2">link</a> <img src='i.png'> <a class=c href=y>again</a><a href="/x?a=1&amp;b=2">link</a></body></html>"""
SCHEMA = "page_id bigint, record_id string, target_uri string, date string, block binary, payload_digest string, block_digest int"


def response(page, head="HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nServer: s\r\n\r\n", code="utf-8"):
    return head.encode() + page.encode(code)


def test_text_and_links():
    assert dv.plain_text(PAGE) == "Head line\nOne two three\nfour <five>\nlink againlink"
    assert dv.outlinks(PAGE) == ["/x?a=1&b=2 a/@href", "i.png img/@src", "y a/@href"]
    assert dv.plain_text("") == "" and dv.plain_text("a < b & c") == "a < b & c"
    assert dv.decode("é".encode("latin-1"), "text/html; charset=ISO-8859-1") == "é"
    assert dv.decode(b"\xff", "text/html; charset=unheard-of") == "�"


def test_records_round_trip(spark, tmp_path):
    rows = [(1, "<urn:uuid:1>", "http://a/", "2024-01-01T00:00:00Z", response(PAGE), "sha1:GIVEN", 5),
            (2, "<urn:uuid:2>", "http://b/", "2024-01-02T00:00:00Z", "no header é".encode(), None, 5),
            (3, None, None, None, None, None, 5), (4, "<urn:uuid:4>", "http://c/", None, b"", None, 5),
            (5, "<urn:uuid:5>", "http://d/", "2024-01-01T00:00:00Z", response("<p>long text</p>" * 60000), None, 5),
            (1, "<urn:uuid:1>", "http://a/", "2024-01-01T00:00:00Z", response(PAGE), "sha1:GIVEN", 5)]
    made = dv.build_derivatives(spark.createDataFrame(rows, SCHEMA), "page_id").collect()
    assert len(made) == 2 * len(rows)
    for r in made:
        body = r["block"].encode()
        assert r["content_length"] == len(body)
        assert r["block_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
        source = next(x for x in rows if x[0] == r["page_id"])
        assert (r["refers_to"], r["target_uri"], r["date"]) == (source[1], source[2], source[3])
        again = list(dv.parse_records(dv.record_bytes(r["headers"], body)))
        assert [(x["type"], x["record_id"], x["block"]) for x in again] == [(r["record_type"], r["record_id"], body)]
        if source[1]:
            assert f"WARC-Refers-To: {source[1]}\r\n" in r["headers"]
    first = {r["record_type"]: r for r in made if r["page_id"] == 1}
    assert first["conversion"]["block"] == dv.plain_text(PAGE)
    for line in ("source-header: Server: s", "source-payload-digest: sha1:GIVEN", "title: A & B", "outlink: i.png img/@src"):
        assert line + "\r\n" in first["metadata"]["block"]
    ids = {(r["page_id"], r["record_type"]): r["record_id"] for r in made}
    assert len(set(ids.values())) == len(ids)


def test_archives_are_read(spark, tmp_path):
    head = dv.warc_header([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:9>"), ("WARC-Target-URI", "http://z/"),
                           ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Length", str(len(response(PAGE))))])
    info = "WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n"
    archive = dv.record_bytes(info, b"{}") + dv.record_bytes("WARC/1.0\r\n" + head, response(PAGE))
    (tmp_path / "a.warc.gz").write_bytes(archive)
    got = dv.read_responses(spark, str(tmp_path)).collect()
    assert [(r["record_id"], bytes(r["block"])) for r in got] == [("<urn:uuid:9>", response(PAGE))]
    assert "source-warc-header: WARC-Record-ID: <urn:uuid:9>" in dv.derive(got[0].asDict())[0]["block"]


def archive_of(blocks, compressed=True):
    made = []
    for i, block in enumerate(blocks):
        head = "WARC/1.0\r\n" + dv.warc_header([
            ("WARC-Type", "response" if i % 3 else "warcinfo"), ("WARC-Record-ID", f"<{i}>"), ("Content-Length", str(len(block)))])
        made.append(dv.record_bytes(head, block) if compressed else head.encode() + b"\r\n" + block + b"\r\n\r\n")
    return made


BLOCKS = [b"first", b"HTTP/1.1 200 OK\r\n\r\n<p>WARC/1.0</p>", b"", b"x" * 300_000, bytes(range(256)) * 40, b"last"]


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("part", [7, 1000, 1 << 18])
def test_records_in_parts_of_any_size(monkeypatch, compressed, part):
    monkeypatch.setattr(dv, "PART_BYTES", part)
    blocks = BLOCKS[:3] + BLOCKS[4:] if part == 7 else BLOCKS
    made = b"".join(archive_of(blocks, compressed))
    assert [r["block"] for r in dv.parse_records(made)] == blocks
    if compressed:  # one member for the whole file
        whole = gzip.compress(b"".join(archive_of(blocks, False)))
        assert [r["block"] for r in dv.parse_records(whole)] == blocks


def test_damaged_records_are_skipped_and_counted(spark, tmp_path):
    good = archive_of(BLOCKS)
    plain = archive_of(BLOCKS, False)

    def read(data):
        found = list(dv.parse_records(data))
        return [r["record_id"] for r in found if r["type"] != "damaged"], [r["problem"] for r in found if r["type"] == "damaged"]
    ids = [f"<{i}>" for i in range(len(BLOCKS))]
    broken = bytearray(good[3])
    broken[len(broken) // 2] ^= 0xFF
    assert read(b"".join([*good[:3], bytes(broken), *good[4:]])) == ([*ids[:3], *ids[4:]], ["compression"])
    assert read(b"".join(good)[:-5])[1] in (["compression"], ["truncated"], [])
    assert read(b"".join(plain)[:-6]) == (ids[:-1], ["truncated"])
    headless = plain[4].replace(b"Content-Length: 10240\r\n", b"")
    assert read(plain[0] + headless + plain[5]) == ([ids[0], ids[5]], ["length"])
    assert read(plain[0] + plain[5].replace(b"Length: 4", b"Length: four") + plain[1])[0] == [ids[0], ids[1], ]
    assert read(plain[0] + b"WARC/1.0\r\nno end of the header") == ([ids[0]], ["truncated"])
    assert read(b"") == ([], []) and read(b"no archive at all") == ([], []) and read(b"\x1f\x8bno gzip")[0] == []
    assert read(b"".join(plain)[30:])[0] == ids[1:]
    for name, data in (("a.warc.gz", b"".join([*good[:3], bytes(broken), *good[4:]])), ("b.warc", b"".join(plain)), ("c.warc", b"")):
        (tmp_path / name).write_bytes(data)
    report = {r["path"].rsplit("/", 1)[1]: tuple(r)[1:] for r in dv.archive_report(spark, str(tmp_path)).collect()}
    assert report == {"a.warc.gz": (5, 4, 1), "b.warc": (6, 4, 0)}
    assert dv.read_responses(spark, str(tmp_path)).count() == 8


def test_any_cut_ends_quietly():
    rng = random.Random(1)
    data = b"".join(archive_of([b"abc", b"WARC/1.0 inside", b"d" * 50]))
    for _ in range(200):
        at = rng.randrange(len(data))
        changed = bytearray(data[: rng.randrange(len(data))] if rng.random() < 0.5 else data)
        if at < len(changed):
            changed[at] ^= 1 << rng.randrange(8)
        assert sum(1 for _ in dv.parse_records(bytes(changed))) <= 8


class Visitor(HTMLParser):
    """A page read by an event parser: its lines, links and title."""

    UNSEEN = {"script", "style", "noscript", "template", "head"}
    LINES = set("address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li "
                "main nav ol p pre section table td th tr ul".split())

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.shown, self.links, self.hidden, self.titled, self.title = [""], {}, 0, False, ""
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attributes):
        self.titled = tag == "title"
        self.hidden += tag in self.UNSEEN
        if tag in self.LINES:
            self.shown.append("")
        for name, value in attributes:
            if (tag, name) in {("a", "href"), ("img", "src"), ("link", "href"), ("script", "src"), ("iframe", "src"), ("area", "href")}:
                self.links[f"{value.strip()} {tag}/@{name}"] = None

    def handle_endtag(self, tag):
        self.titled = False
        self.hidden -= tag in self.UNSEEN
        if tag in self.LINES:
            self.shown.append("")

    def handle_data(self, data):
        if self.titled:
            self.title += data
        if not self.hidden:
            self.shown[-1] += data.replace("\n", " ")

    def text(self):
        lines = (" ".join(line.split()) for line in self.shown)
        return "\n".join(line for line in lines if line)


def test_pages_equal_an_event_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    made = {(r["page_id"], r["record_type"]): r for r in op10_warc_derivatives(spark, "/root/testdata/sf0.001").collect()}
    for page in pages:
        seen = Visitor(page["html"])
        text, facts = made[page["page_id"], "conversion"], made[page["page_id"], "metadata"]
        assert text["block"] == seen.text()
        lines = facts["block"].split("\r\n")
        assert [line[9:] for line in lines if line.startswith("outlink: ")] == list(seen.links)
        assert f"title: {' '.join(seen.title.split())}" in lines
        source = "sha1:" + base64.b32encode(hashlib.sha1(page["html"].encode()).digest()).decode()
        assert text["source_digest"] == facts["source_digest"] == source
        assert text["target_uri"] == page["url"] and text["refers_to"] == facts["refers_to"]


def test_every_page_has_both_records(spark):
    rows = op10_warc_derivatives(spark, "/root/testdata/sf0.001").select("page_id", "record_type").collect()
    assert len(rows) == len(set(rows)) == 2 * spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()


def test_no_rows(spark):
    assert dv.build_derivatives(spark.createDataFrame([], SCHEMA), "page_id").count() == 0
