"""Payloads that meet the line ends of their record."""

from wearline.llm import warc


def test_payloads_that_meet_the_line_ends_of_their_record(spark, folder):
    payloads = [
        "WARC/1.1\r\nWARC-Type: response\r\n\r\nbody", "\r\nWARC/1.1\r\nx", "x\r\n\r\nWARC/1.1", "WARC/1.1",
        "\r\n\r\nWARC/1.1\r\n\r\nWARC/1.1\r\n\r\nWARC/1.1", "\r\nWARC/1.1", "WARC/1.1\r\n\r\nWARC/1.1\r\n\r\n",
    ]
    rows = [(k, f"http://a/{k}", p) for k, p in enumerate(payloads)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, folder + "/a")
    captures = warc.assemble(warc.with_payload(warc.read_records(spark, folder + "/a"))).collect()
    assert len(captures) == len(rows)
    read = {c["response"]["target_uri"]: c["response"] for c in captures}
    assert {u: bytes(r["payload"]).decode() for u, r in read.items()} == {u: p for _, u, p in rows}
    assert all(r["complete"] and r["payload_bytes"] == len(r["payload"]) for r in read.values())


def test_urls_with_line_ends_and_pages_without_ids(spark, folder):
    rows = [
        (1, "http://x/\r\n\r\nfoo", "same"), (2, "http://x/%0D%25\n", "other"), (3, "http://x/%0D%25", "other"),
        (None, "http://n/1", "same payload"), (None, "http://n/2", "same payload"), (None, "http://n/3", "alone"),
        (7, "http://t/1", "twins"), (7, "http://t/2", "twins"), (7, "http://t/3", "same"), (5, "http://t/4", "twins"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, folder + "/a")
    captures = warc.assemble(warc.with_payload(warc.read_records(spark, folder + "/a"))).collect()
    assert len(captures) == len(rows)
    read = {c["response"]["target_uri"]: c["response"] for c in captures}
    assert set(read) == {u for _, u, _ in rows}
    names = {c["capture_id"]: c["response"]["target_uri"] for c in captures}
    by_payload = {}
    for page, url, html in rows:
        r = read[url]
        assert r["complete"] and r["payload_bytes"] == len(html)
        by_payload.setdefault(html, []).append((page, r["record_type"], names.get(r["refers_to"])))
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() == html
    for html, found in by_payload.items():
        (original,) = [u for u in read if read[u]["record_type"] == "response" and bytes(read[u]["payload"]).decode() == html]
        assert all(to == original for _, kind, to in found if kind == "revisit")
        assert next(p for p, u, _ in rows if u == original) == max((p for p, *_ in found), key=lambda p: (p is not None, p or 0))


def test_no_record_is_lost_between_read_buffers(spark, folder):
    """Records that end in line ends, at every place of the reader's buffers: each is found by itself."""
    pages = spark.range(40_000).selectExpr("id as page_id", "concat('http://a/', id) as url", "repeat('x\r\n', cast(id % 97 as int)) as html")
    warc.write_archives(pages.coalesce(4), folder + "/a")
    found = warc.with_payload(warc.read_records(spark, folder + "/a"))
    assert found.count() == 120_000 and found.filter("not complete").isEmpty()
    captures = warc.assemble(found).selectExpr("response is not null and size(requests) = 1 and size(metadata) = 1 as whole")
    assert captures.groupBy("whole").count().collect() == [(True, 40_000)]


def test_version_lines_in_urls_and_payloads(spark, folder):
    rows = [(1, "http://x/WARC/1.1", "WARC/1.1"), (2, "WARC/1.1", "a WARC/1.1\r\nb WARC/1.1\r\n"), (3, "http://x/WARC%2F1.1", "WARC/1.1\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, folder + "/a")
    captures = warc.assemble(warc.with_payload(warc.read_records(spark, folder + "/a"))).collect()
    read = {c["response"]["target_uri"]: bytes(c["response"]["payload"]).decode() for c in captures}
    assert read == {url: html for _, url, html in rows}
