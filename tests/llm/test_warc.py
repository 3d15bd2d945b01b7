import base64
import hashlib
import html as stdlib_html

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import empty_like
from tiers.llm import warc

RESPONSE = "record_id string, target_uri string, date string, http_headers string, payload string"


def text_of(spark, payload):
    df = spark.createDataFrame([("<r>", "u", "d", "h", payload)], RESPONSE)
    return warc.derive(df).filter("record_type = 'conversion'").first().block


@pytest.mark.parametrize("payload,text", [
    (None, ""), ("", ""), ("plain  text\n\n\nmore", "plain text\nmore"),
    ("<p>a</p><p>b<br>c</p>", "a\nb\nc"), ("a<b>b</b>c", "abc"),
    ("<script>var t=\"</p>\";</script>x<style>p{}</style>y<!-- <p>no</p> -->z", "xyz"),
    ("<SCRIPT src=x>1</SCRIPT >in", "in"), ("before<script>never closed", "before"), ("x<!-- open", "x"),
    ("1 &lt; 2 &amp;&amp; 3 &gt; 2 &amp", "1 < 2 && 3 > 2 &"), ("&amp;lt;", "&lt;"), ("&#65;&#x42;&#8364;&#0;&#xD800;&#; &#99999999;", "AB€��&#; &#99999999;"),
    ("a\xa0&nbsp;b", "a b"), ("<title>T</title><h1>H</h1>", "T\nH"), ("3 < 4", "3 < 4"), ("cut <a href='", "cut")])
def test_text(spark, payload, text):
    assert text_of(spark, payload) == text


def test_very_long_page(spark):
    page = "<div>" + "word <b>bold</b>&amp; " * 100_000 + "</div>"
    assert text_of(spark, page) == ("word bold& " * 100_000).rstrip()


def test_references_agree_with_the_standard_library(spark):
    for name, char in warc.REFERENCES:
        assert text_of(spark, f"x&{name};y") == "x" + stdlib_html.unescape(f"&{name};").replace("\xa0", " ") + "y" == f"x{char}y"


def test_records_link_to_their_response_and_carry_right_digests(spark):
    page = '<title>A &amp; B</title><a href="/x?a=1&amp;b=2">l</a><a class=c href=\'y\'>m</a><p>é</p>'
    df = spark.createDataFrame([("<urn:uuid:1>", "http://h/p", "2024-01-02T03:04:05Z", "HTTP/1.1 200 OK\r\nA: b", page),
                                (None, None, None, None, None)], RESPONSE)
    rows = {(r.refers_to, r.record_type): r for r in warc.derive(df).collect()}
    assert len(rows) == 4

    def sha(x):
        return "sha1:" + base64.b32encode(hashlib.sha1(x.encode()).digest()).decode()
    for (source, kind), r in rows.items():
        assert r.block_digest == sha(r.block) and r.content_length == len(r.block.encode())
        assert r.record_id.startswith("<urn:uuid:") and len(r.record_id) == 47
        assert r.source_digest == sha(page if source else "")
    meta = rows["<urn:uuid:1>", "metadata"]
    assert meta.block == "title: A & B\r\noutlink: /x?a=1&b=2\r\noutlink: y\r\n"
    assert (meta.target_uri, meta.date, meta.source_headers) == ("http://h/p", "2024-01-02T03:04:05Z", "HTTP/1.1 200 OK\r\nA: b")
    assert len({r.record_id for r in rows.values()}) == 4
    assert rows[None, "conversion"].block == ""


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(f"<r{i}>", f"http://h/{i}", "d", "HTTP/1.1 200 OK\r\nX: y", f"<p>line {i}</p><p>b\r\n\r\nc</p>" * i)
                                for i in range(20)], RESPONSE).repartition(3)
    made = warc.derive(df)
    warc.write_records(made, str(tmp_path / "out"))
    back = warc.read_records(spark, str(tmp_path / "out"))
    cols = ["record_type", "record_id", "refers_to", "target_uri", "date", "block_digest", "source_digest", "content_type", "block"]
    assert sorted(map(tuple, made.select(cols).collect())) == sorted(map(tuple, back.select(cols).collect()))


def test_odd_rows(spark):
    assert warc.derive(empty_like(spark, RESPONSE)).count() == 0
    df = spark.createDataFrame([("a", "b", "c", "d", "<p>x</p>", 1, "t")] * 2, RESPONSE + ", BLOCK int, Payload string")
    assert warc.derive(df).count() == 4


def test_outlinks_in_every_form_of_an_attribute(spark):
    page = ("<a href=/bare>1</a><a href=\"/it's\">2</a><a href='/a\"b'>3</a><a title=\"x href=no\" data-href=no href=/c?d=1&amp;e>4</a>"
            "<A CLASS=x HREF = '/f'>5</A><a name=no>6</a><a href=\"\">7</a>")
    df = spark.createDataFrame([("<urn:uuid:1>", "http://h/p", "2024-01-02T03:04:05Z", "HTTP/1.1 200 OK", page)], RESPONSE)
    meta = [r.block for r in warc.derive(df).collect() if r.record_type == "metadata"]
    assert meta == ["title: \r\n" + "".join(f"outlink: {u}\r\n" for u in ("/bare", "/it's", '/a"b', "/c?d=1&e", "/f", ""))]


BROKEN = ["<a x ", "<script x ", "<style ", "<noscript ", "<!--", "<!x ", "<title", "<title x ", "<a x=\"", "<a x='y\" ",
          "<a href=\"", "<a href=' ", "<p ", "</script ", "<a/", "&#", "&amp", "& ", " \n", "<"]


def test_broken_pages_of_a_megabyte_take_no_longer_than_whole_ones(spark):
    """However a page's tags are broken, it is passed a fixed number of times."""
    import time

    def seconds(page):
        t = time.perf_counter()
        warc.derive(spark.createDataFrame([("<r>", "u", "d", "h", page)], RESPONSE)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t
    size = 1 << 20
    whole = '<div><a href="/x">word</a> &amp; <b>bold</b></div>\n'
    seconds(whole)
    normal = max(seconds(whole * (size // len(whole))) for _ in range(2))
    slow = {b: round(t, 1) for b in BROKEN if (t := seconds(b * (size // len(b)))) > 2 * normal + 2}
    assert not slow, (normal, slow)
    assert seconds("<a " + "x " * 20_000 + "href=/y>") < 2 * normal + 2


def test_tags_that_never_end(spark):
    for page, text in (("a<script x", "a"), ("a<style", "a"), ("a<noscript b c", "a"), ("<title never", ""), ("a<title", "a")):
        assert text_of(spark, page) == text
    df = spark.createDataFrame([("<r>", "u", "d", "h", "<a x <a href=/y>z</a><title t")], RESPONSE)
    assert warc.derive(df).filter("record_type = 'metadata'").first().block == "title: \r\noutlink: /y\r\n"
