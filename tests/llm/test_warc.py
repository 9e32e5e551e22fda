import gzip
import random

import brute
import pytest
from helpers import SF, rows_of
from pyspark.sql import functions as F

from arrears.llm import warc
from arrears.llm.common import scratch, table
from arrears.llm.token_shards import _open_fs


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.choices(range(50), k=rng.randint(0, 20))) for _ in range(k)]
        assert list(warc.LoserTree([iter((x,) for x in r) for r in runs])) == sorted((x,) for r in runs for x in r)


def test_driver_table(spark):
    pages = table(spark, SF, "pages")
    assert rows_of(warc.archive_report(pages)) == sorted(brute.captures([(r.page_id, r.html) for r in pages.collect()]), key=str)


def test_revisits_nulls_and_repeats(spark):
    big = "é" * 50
    rows = [(5, "http://a.org/", big), (3, "http://b.org/", big), (9, None, big), (4, "x", "é" * 49 + "e"), (1, "u", "short"), (2, "u", "short"),
            (6, "http://c.org", None), (7, "", ""), (8, "http://[bad", "x" * 200_000), (3, "http://b.org/", big), (10, "a\r\nb", "\r\n\r\n" * 30)]
    got = rows_of(warc.archive_report(_pages(spark, rows).withColumns({"digest": F.lit(1), "time": F.lit(5), "run": F.lit(2)})))
    assert got == sorted(brute.captures([(p, h) for p, _, h in rows]), key=str)
    assert warc.archive_report(_pages(spark, [])).collect() == []


def test_null_page_id_and_null_time(spark):
    big = "x" * 200
    rows = [(None, "http://a/", big, 7), (None, "http://a/", big, 7), (None, "http://a/", "t", None), (4, "http://a/", big, 7), (6, "http://a/", big, None), (None, None, None, None), (2, "http://a/", "t", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, time long").repartition(3)
    want = [(None, 200, brute.sha(big), "response", None)] * 2 + [(None, 1, brute.sha("t"), "response", None), (None, 0, brute.sha(""), "response", None)]
    want += [(4, 200, brute.sha(big), "response", None), (6, 200, brute.sha(big), "revisit", 4), (2, 1, brute.sha("t"), "response", None)]
    assert rows_of(warc.archive_report(pages)) == sorted(want, key=str)
    assert rows_of(warc.archive_report(pages.drop("time"))) == sorted(want, key=str)
    index, folder = warc.archive(pages)
    got = [(r["url_key"], r["time"], r["page_id"]) for r in warc.read_archives(index, folder).orderBy("range", "position").collect()]
    none_first = lambda x: (*x[:2], x[2] is not None, x[2] or 0)
    assert got == sorted(((warc.url_key(u), warc.FIRST_CAPTURE if t is None else t, p) for p, u, _, t in rows), key=none_first)


def test_index_is_one_global_order(spark):
    hosts = ["a.com", "www.b.com", "x.b.com"]
    rows = [(i, f"http://{hosts[i * 7 % 3]}/p{i % 20}?q={i % 3}", f"page {i}") for i in range(600)]
    folder = scratch(spark, "warc")
    runs = warc.write_archives(warc.roles(_pages(spark, rows)).repartition(5), folder).checkpoint()
    index = warc.merge_runs(runs).checkpoint()
    got = index.orderBy("range", "position").collect()
    keys = [(r["url_key"], r["time"], r["page_id"]) for r in got]
    assert keys == sorted((warc.url_key(u), warc.FIRST_CAPTURE + i, i) for i, u, _ in rows)
    assert len({r["run"] for r in got}) == 5
    fs, path = _open_fs(folder)
    r = got[17]
    with fs.open_input_file(f"{path}/{r['file']}") as f:  # a gzip member for each record: the rest is not needed
        f.seek(r["at"])
        raw = gzip.decompress(f.read(r["size"]))
    assert raw.startswith(b"WARC/1.1\r\n") and warc.parse_record(raw)["page_id"] == r["page_id"]


def test_small_files_and_damage(spark):
    rows = [(i, f"http://h/{i}", f"text {i} " * 50) for i in range(60)]
    folder = scratch(spark, "warc")
    runs = warc.write_archives(warc.roles(_pages(spark, rows)), folder, file_bytes=500)
    index = warc.merge_runs(runs.checkpoint())
    assert index.select("file").distinct().count() > 10
    assert rows_of(warc.read_archives(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == sorted(
        brute.captures([(p, h) for p, _, h in rows]), key=str)
    raw = warc.record(1, "u", 0, b"abc", "00", None)
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(raw)


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.com:80/A?b=2&a=1#f") == "com,example)/a?a=1&b=2"
    assert warc.url_key("https://example.com:8443") == "com,example:8443)/" and warc.url_key(None) == ""
