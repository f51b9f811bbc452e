import hashlib
from pathlib import Path

from pyspark.sql import functions as F

from repolume.llm.warc import derive, plain_text, read_warc, responses, write_warc

PAGE = (
    "<!DOCTYPE html><html><head><title>A &amp;\n title</title><style>p{}</style></head><body><script>var t='</p>';</script>"
    "<!-- no\n --><h1>Head</h1><p>One&nbsp;two &lt;b&gt; <a class=x href='/y'>link</a></p>\r\n\r\n<ul><li>é</li><li>ß</li></ul></body></html>"
)


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id long, url string, html string, record_id int, header int, block int")


def test_plain_text(spark):
    text = spark.createDataFrame([(PAGE,)], "html string").select(plain_text(F.col("html"))).first()[0]
    assert text == "Head\nOne two <b> link\né\nß"


def test_a_header_before_a_script_is_text_and_references_are_decoded(spark):
    page = (
        "<html><head lang=en><script>var a='</head>';</script><style>b{}</style><title>T</title><meta name=x></head><body>"
        "<header class=top><p>Top</p></header><!-- <script> --><article>A &copy; b &middot; &#233;&#xe9; &amp;lt;&#160;c"
        "</article><SCRIPT >var d='<!--';</script ><p>End</p><noscript>no</noscript></body></html>"
    )
    text = spark.createDataFrame([(page,), (None,)], "html string").select(plain_text(F.col("html")).alias("text")).collect()
    assert [row["text"] for row in text] == ["Top\nA © b · éé &lt; c End", None]


def test_what_is_never_closed_goes_on_to_the_end(spark):
    html = ["<p>a</p><script>var leak=1;", "<p>b</p><!-- open <p>c</p>", "<p>d</p><style>p{}</style><p>e</p>"]
    text = spark.createDataFrame([(page,) for page in html], "html string").select(plain_text(F.col("html")).alias("t"))
    assert [row["t"] for row in text.collect()] == ["a", "b", "d\ne"]


def test_a_url_adds_no_header_and_nulls_are_values_of_their_own(spark):
    table = pages(spark, (1, "u\r\nWARC-Type: evil", "x", 0, 0, 0), (None, "1", "x", 0, 0, 0), (1, None, "x", 0, 0, 0), (1, "", "x", 0, 0, 0))
    records = derive(responses(table)).collect()
    assert len({row["record_id"] for row in records}) == 12
    assert all(row["header"].count("WARC-Type") - row["header"].count("%0AWARC-Type") == 1 for row in records)


def test_records_are_linked_and_read_back_from_their_files(spark, tmp_path):
    table = pages(spark, (1, "http://a/", PAGE, 0, 0, 0), (2, None, None, 0, 0, 0), (3, "http://b/", "", 0, 0, 0), (None, "http://c/", "x" * 200_000, 0, 0, 0))
    records = derive(responses(table))
    assert records.count() == 12
    write_warc(records, str(tmp_path / "out"))
    found = [record for file in sorted(Path(tmp_path / "out").glob("part-*")) for record in read_warc(file.read_bytes())]
    assert len(found) == 12
    by_id = {fields["WARC-Record-ID"]: (fields, block) for fields, block in found}
    assert len(by_id) == 12
    for fields, block in found:
        assert fields["version"] == "WARC/1.1"
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
        if fields["WARC-Type"] == "response":
            payload = block.split(b"\r\n\r\n", 1)[1]
            assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
            continue
        source = by_id[fields["WARC-Refers-To"]][0]
        assert source["WARC-Type"] == "response" and fields["WARC-Source-Payload-Digest"] == source["WARC-Payload-Digest"]
        assert fields.get("WARC-Refers-To-Target-URI") == source.get("WARC-Target-URI")
        assert fields["WARC-Refers-To-Date"] == source["WARC-Date"]
        if fields["WARC-Type"] == "metadata":
            assert by_id[fields["WARC-Concurrent-To"]][0]["WARC-Type"] == "conversion"
            facts = dict(line.split(": ", 1) for line in block.decode().split("\r\n"))
            assert facts["source-status"] == "200 OK" and facts["source-content-type"] == "text/html; charset=utf-8"
    first = next(block for fields, block in found if fields["WARC-Type"] == "metadata" and fields["WARC-Target-URI"] == "http://a/")
    assert b"title: A &amp; title" in first and b"n-links: 1" in first


def test_reruns_agree_repeated_rows_repeat_and_no_pages_give_no_records(spark):
    table = pages(spark, (1, "u", "x", 0, 0, 0), (1, "u", "x", 0, 0, 0))
    records = sorted(map(tuple, derive(responses(table)).collect()))
    assert records == sorted(map(tuple, derive(responses(table)).collect()))
    assert len(records) == 6 and len(set(records)) == 3
    assert derive(responses(table.where("false"))).count() == 0
