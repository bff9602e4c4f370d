import base64
import gzip
import hashlib

from histlake.llm import queries
from histlake.llm import warc as W
from histlake.llm.common import table


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def read_warc(data):
    """Records of WARC bytes, by their declared lengths."""
    out = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        assert rest[n:n + 4] == b"\r\n\r\n"
        out.append((fields, rest[:n]))
        data = rest[n + 4:]
    return out


def test_whole_table_round_trips(spark, sf, tmp_path):
    pages = {r.page_id: r for r in table(spark, sf, "pages").collect()}
    records = queries.op7_warc(spark, sf)
    rows = records.collect()
    assert sorted((r.page_id, r.warc_type) for r in rows) == sorted((p, t) for p in pages for t in ("conversion", "metadata"))
    by = {r.record_id: r for r in rows}
    assert len(by) == len(rows)
    for r in rows:
        body = pages[r.page_id].html.encode()
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
        assert r.target_uri == pages[r.page_id].url
        assert (r.source_payload_digest, r.source_block_digest) == (sha(body), sha(http + body))
        assert (r.block_digest, r.content_length) == (sha(r.block.encode()), len(r.block.encode()))
    W.write_warc(records, str(tmp_path / "out"))
    read = [x for f in sorted((tmp_path / "out").glob("*.gz")) for x in read_warc(gzip.decompress(f.read_bytes()))]
    assert len(read) == len(rows)
    for fields, block in read:
        r = by[fields["WARC-Record-ID"]]
        assert block.decode() == r.block and fields["WARC-Refers-To"] == r.refers_to
        assert fields["WARC-Type"] == r.warc_type and fields["WARC-Block-Digest"] == sha(block)


def test_text_of_pages():
    html = ('<!DOCTYPE html><html lang="pt-BR"><head><title> A &amp; B </title><style>p{}</style></head><body><!-- no <p>text</p> -->'
            '<p>One<b>two</b> &lt;three&gt;<br>four</p><script>var t="</p>";</script><a class=x href="/a b?x=1&amp;y=2">link</a><a href=\'/c\'>c</a><a name=z>z</a></body></html>')
    assert W.read_html(html) == ("Onetwo <three>\nfour\nlinkcz", "A & B", "pt-BR", ["/a b?x=1&y=2", "/c"])
    assert W.read_html("") == ("", "", "", [])
    assert W.read_html("a < b <p>c <!-- open <p>d") == ("a < b\nc", "", "", [])
    assert W.read_html("x<script>y") == ("x", "", "", [])
    assert W.read_html("<a<a<a" * 50_000)[0].startswith("<a<a")


def test_edges(spark):
    cols = "key long, record_id string, target_uri string, warc_date string, http string, payload string"
    rows = [(1, "<urn:uuid:1>", None, "2020-01-01T00:00:00Z", None, None), (2, "<urn:uuid:2>", "", "2020-01-01T00:00:00Z", "HTTP/1.1 404 Not Found\r\nX-A: b:c\r\n\r\n", ""),
            (3, None, "http://x", None, "HTTP/1.1 200 OK", "gone"), (4, "<urn:uuid:4>", "http://x", None, "HTTP/1.1 200 OK\r\n\r\n", "<p>é</p>" * 50_000),
            (2, "<urn:uuid:2>", "", "2020-01-01T00:00:00Z", "HTTP/1.1 404 Not Found\r\nX-A: b:c\r\n\r\n", "")]
    df = spark.createDataFrame(rows, cols).selectExpr("*", "1 as block", "'x' as warc_type")
    got = W.derivatives(df).collect()
    assert sorted(r.key for r in got) == [1, 1, 2, 2, 2, 2, 4, 4]
    meta = {r.key: r.block for r in got if r.warc_type == "metadata"}
    assert "source-status: HTTP/1.1 404 Not Found\r\nsource-header-x-a: b:c\r\n" in meta[2] and "source-status" not in meta[1]
    text = {r.key: r.block for r in got if r.warc_type == "conversion"}
    assert text[1] == "" and text[4] == "\n".join(["é"] * 50_000)
    assert "WARC-Target-URI" not in W.serialised(W.derivatives(df.filter("key = 1"))).first().record
    pages = spark.createDataFrame([(None, "u", "x"), (1, None, None)], "page_id long, url string, html string")
    assert [r.key for r in W.derivatives(W.responses(pages)).collect()] == [1, 1]
    assert W.derivatives(df.limit(0)).collect() == []
