import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from kredo.llm import warc

PAGE = ('<!DOCTYPE html><html lang="en"><head><title>A &amp; B</title><script>var t="</p>";</script></head><body>'
        '<nav><a href="/x?a=1&amp;b=2">X</a> <a title="a>b" href=\'y\'>Y</a></nav><!-- no <p> here -->'
        '<p>One&nbsp;two<br>three <b>bold</b></p><style>p{}</style><pre>4 &lt; 5</pre></body></html>')
ROWS = [(1, "http://a.example/1", PAGE), (2, None, None), (3, "http://a.example/3", ""), (None, "u", "<p>x"),
        (4, "http://a.example/4", "<p>" + "long text " * 200_000), (5, "http://a\r\nX: y/", "bad < tag <b a='x"),
        (5, "http://a\r\nX: y/", "bad < tag <b a='x"), (6, "http://a.example/6", "<!-- open"), (7, "u", "<script>x")]


def pages(spark):
    return (spark.createDataFrame(ROWS, "page_id long, url string, html string")
                 .withColumn("record", F.lit("clash")).withColumn("warc_type", F.lit("clash")))


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_links_between_records_and_round_trip(spark):
    sources = {(r["page_id"], r["record_id"]): bytes(r["record"]) for r in warc.responses(pages(spark)).collect()}
    out = warc.derivatives(warc.responses(pages(spark))).collect()
    assert len(out) == 2 * len(ROWS) and all(r["error"] is None and r["digest_ok"] for r in out)
    for r in out:
        fields, block = warc.parse(bytes(r["record"]))
        source, body = warc.parse(sources[r["page_id"], r["refers_to"]])
        assert fields["warc-type"] == r["warc_type"] and fields["warc-record-id"] == r["record_id"]
        assert fields["warc-refers-to"] == source["warc-record-id"] == r["refers_to"]
        assert fields.get("warc-target-uri") == source.get("warc-target-uri") and fields["warc-date"] == source["warc-date"]
        assert fields["warc-block-digest"] == sha(block) == r["block_digest"] and len(block) == r["content_length"]
        payload = body.partition(b"\r\n\r\n")[2]
        assert r["source_payload_digest"] == sha(payload) == source["warc-payload-digest"]
    assert len({r["record_id"] for r in out}) == 2 * len(set(ROWS))


def test_metadata_and_text_of_a_page(spark):
    name, record = warc.response_record(1, "http://a.example/1", PAGE)
    meta, text = warc.derive(record)
    fields = warc.parse(meta[-1])[1].decode().split("\r\n")
    assert "title: A & B" in fields and "language: en" in fields and "source-status: HTTP/1.1 200 OK" in fields
    assert [f for f in fields if f.startswith("outlink")] == ["outlink: /x?a=1&b=2", "outlink: y"]
    assert "source-header-Content-Type: text/html; charset=utf-8" in fields
    assert warc.parse(text[-1])[1].decode() == "X Y\nOne two\nthree bold\n4 < 5\n"
    assert f"conversion: {text[1]}" in fields and text[2] == name


@pytest.mark.parametrize("top", ["<head><title>T</title>", "<head><title>T</title></head>",
                                 "<HEAD lang=x><meta a='>'><title>T</title><style>p{}</style><script>x</script>"])
def test_a_page_whose_head_is_not_closed_keeps_its_text_and_links(top):
    page = f"<html>{top}<body><p>Real text <a href='/z'>Z</a></p></body></html>"
    meta, text = warc.derive(warc.response_record(1, "u", page)[1])
    assert warc.parse(text[-1])[1].decode() == "Real text Z\n"
    fields = warc.parse(meta[-1])[1].decode().split("\r\n")
    assert "outlink: /z" in fields and "title: T" in fields and meta[7] == 1


def test_same_records_again():
    assert warc.derive(warc.response_record(1, "u", PAGE)[1]) == warc.derive(warc.response_record(1, "u", PAGE)[1])


def test_broken_records_are_reported(spark):
    whole = warc.response_record(1, "u", "text")[1]
    bad = [(1, bytearray(whole[:len(whole) // 2])), (2, bytearray(b"no header")), (3, None),
           (4, bytearray(warc.derive(whole)[0][-1])), (5, bytearray(whole.replace(b"text", b"teXt")))]
    out = {r["page_id"]: r for r in warc.derivatives(spark.createDataFrame(bad, "page_id long, record binary")).collect()}
    assert all(out[k]["error"] and out[k]["record"] is None for k in (1, 2, 3, 4))
    assert out[5]["error"] is None and out[5]["digest_ok"] is False


@pytest.mark.parametrize("page", ["<" * 50_000, "<a " * 30_000, "<!--" * 30_000, "<script>" * 20_000, "<a href=\"" * 20_000,
                                  "&" * 50_000, "<p " + "'" * 50_000, "<title>" * 20_000])
def test_odd_markup_takes_linear_time(page):
    warc.derive(warc.response_record(1, "u", page)[1])


def test_empty_table(spark):
    assert warc.derivatives(warc.responses(pages(spark).where("false"))).count() == 0
