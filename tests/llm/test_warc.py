"""Archives and their capture index against the rows they were written from."""

import gzip
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm_cases import prose
from viewstats.llm import warc
from viewstats.llm.common import scratch

PAGES = "page_id long, url string, html string"


def rows():
    """A page that a third of the rows share, a host that most share, odd urls and bodies."""
    rng = random.Random(7)
    out = [(i, f"http://www.Hot.example.com/{rng.randrange(40)}?q=é {i % 3}", "<p>shared</p>") for i in range(200)]
    out += [(1000 + i, f"https://h{i % 9}.example.org:80/a#b", f"<p>{prose(rng, i % 30)}é\r\n\r\nx</p>") for i in range(300)]
    return out + [(5000, None, None), (5001, "", ""), (5002, "no scheme", "\x00\r\n"), (None, None, None),
                  (None, "http://x/", "only"), (5003, "http://a\r\nb/ü", "<p>shared</p>"), (5003, "//c", "twice"),
                  (5003, "//c", "twice"), (5004, "http://long.example/", "z" * 300_000)]


def pages(spark, given=None, partitions=4):
    df = spark.createDataFrame(rows() if given is None else given, PAGES).repartition(partitions)
    return df.select("*", *[F.lit("clash").alias(n) for n in ("key", "body", "file", "offset", "record")])


def expected(given):
    same = defaultdict(list)
    for k, _, html in given:
        same[html or ""].append(k)
    out = []
    for k, _, html in given:
        body, keys = (html or "").encode(), [x for x in same[html or ""] if x is not None]
        first = min(keys) if keys else None
        refers = None if k == first or first is None else first
        out.append((k, len(body), warc.sha1_digest(body), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("archive_bytes,lines,blocks", [(1 << 25, 512, 2048), (4000, 3, 4)])
def test_every_record_is_found_again(spark, archive_bytes, lines, blocks):
    path, given = scratch(spark, "t"), pages(spark)
    captures = warc.write_archives(given, f"{path}/a", archive_bytes=archive_bytes)
    warc.write_index(captures, f"{path}/i", lines, blocks)
    asked = given.select(warc.surt(F.col("url")).alias("surt"),
                         F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("record"))
    found = warc.look_up(asked, f"{path}/i")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, captures.collect()))
    got = warc.read_records(found, f"{path}/a").select(
        F.expr("try_cast(record as long)"), "payload_bytes", "payload_digest", "record_type",
        F.expr("cast(refers_to as long)"))
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows())


def test_what_is_not_there_is_not_found(spark):
    path = scratch(spark, "t")
    warc.archive(spark, pages(spark), path)
    asked = spark.createDataFrame([("aaa)/", "1"), ("zzz)/", "1"), ("com,example,hot,www)/1?q=é 0", "x")],
                                  "surt string, record string")
    assert warc.look_up(asked, f"{path}/index").count() == 0


def test_no_pages(spark):
    path, none = scratch(spark, "t"), pages(spark, [])
    assert warc.archive(spark, none, path).count() == 0
    asked = spark.createDataFrame([], "surt string, record string")
    assert warc.read_records(warc.look_up(asked, f"{path}/index"), f"{path}/archives").count() == 0


def test_surt(spark):
    urls = ["http://WWW.a.Example/x?y=B", "//h:80/p", None, "", "plain/path", "ftp://h"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(warc.surt(F.col("u")))
    assert [r[0] for r in df.collect()] == ["example,a,www)/x?y=B", "h:80)/p", ")", ")", ")plain/path", "h)"]


def test_payloads_below_the_limit_are_all_responses(spark):
    path = scratch(spark, "t")
    captures = warc.write_archives(pages(spark), path, least_bytes=1000)
    kinds = warc.read_records(captures, path).groupBy("record_type").count().collect()
    assert [r[0] for r in kinds] == ["response"]


def test_records_are_gzip_members_of_warc(spark):
    record = warc.build_record(7, "http://x/", b"abc", None, "2024-01-01T00:00:00Z")
    assert warc.parse_record(gzip.decompress(gzip.compress(record)))["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"abc", b"abd"))
