import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tideline.llm import warc
from tideline.session import scratch_dir

PAGES = "page_id long, url string, html string"


def pages(spark):
    rows = [(i, None if i % 7 == 0 else f"http://x/{i} a\r\nb", None if i % 5 == 0 else f"<p>é{i % 9}</p>" * (i % 50 + 1)) for i in range(300)]
    return spark.createDataFrame(rows + [(300, "u", "x" * 3_000_000), (3, "u", "<p>é3</p>"), (None, None, "<p>null</p>"), (None, "z", "<p>null</p>")], PAGES)


@pytest.mark.parametrize("split", [1 << 25, 1000, 137])
def test_every_record_is_read_once_at_any_split(spark, split):
    own = pages(spark).withColumn("payload", F.lit(1)).withColumn("latest", F.lit(1))
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    files = warc.write(warc.with_revisits(own.repartition(3), "page_id", "url", payload), scratch_dir(spark, "warc"))
    rows = warc.read(files, split).collect()
    assert len(rows) == 304 and len({(r["file"], r["position"]) for r in rows}) == 304
    texts = {}
    for r in own.collect():
        texts.setdefault(r["page_id"], set()).add((r["html"] or "").encode())
    latest = {}
    for page, some in texts.items():
        for t in some:
            latest[t] = max(latest.get(t, -1), -1 if page is None else page)
    for r in rows:
        page = int(r["record_id"].removeprefix("urn:page:")) if r["record_id"] != "urn:page:" else None
        digests = {base64.b32encode(hashlib.sha1(t).digest()).decode(): t for t in texts[page]}
        body = digests[r["payload_digest"]]
        assert r["payload_bytes"] == len(body)
        if r["record_type"] == "response":
            assert r["payload"] == body and r["refers_to"] is None
            assert page is None or latest[body] == page
        else:
            assert r["payload"] is None and r["refers_to"] == f"urn:page:{latest[body]}"
    assert {r["url"] for r in rows if r["record_id"] == "urn:page:1"} == {"http://x/1%20a%0D%0Ab"}


def test_false_magic_and_foreign_members(spark, tmp_path):
    noise = gzip.compress(b"not a record")
    real = warc.record("urn:page:1", "u", warc.MAGIC * 50 + b"WARC/1.1", warc.base32(hashlib.sha1(warc.MAGIC * 50 + b"WARC/1.1").digest()), None)
    broken = real[:40]
    two = gzip.compress(gzip.decompress(warc.record("urn:page:2", None, b"", "X", None)) + gzip.decompress(warc.record("urn:page:3", None, b"z", "Y", "urn:page:2")))
    body = noise + real + two + noise + real + broken
    (tmp_path / "a.warc.gz").write_bytes(body)
    (tmp_path / "b.warc.gz").write_bytes(b"")
    files = spark.createDataFrame([(str(tmp_path / "a.warc.gz"), len(body)), (str(tmp_path / "b.warc.gz"), 0)], "file string, bytes long")
    for split in (50, 1 << 20):
        rows = warc.read(files, split).collect()
        assert sorted(r["record_id"] for r in rows) == ["urn:page:1", "urn:page:1", "urn:page:2", "urn:page:3"]


def test_empty_table(spark):
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


def test_members_with_padding_between_them(spark, tmp_path):
    one, two = (warc.record(f"urn:page:{i}", None, b"x" * i, "X", None) for i in (1, 2))
    body = one + b"\0" * 16 + two + b"\0" * 3_000_000 + one + b"\0"
    (tmp_path / "a.warc.gz").write_bytes(body)
    files = spark.createDataFrame([(str(tmp_path / "a.warc.gz"), len(body))], "file string, bytes long")
    for split in (1 << 18, 1 << 25):
        assert sorted(r["record_id"] for r in warc.read(files, split).collect()) == ["urn:page:1", "urn:page:1", "urn:page:2"]


def test_there_is_a_task_for_every_range(spark):
    files = spark.createDataFrame([(f"/nowhere/{i}", 1000) for i in range(7)], "file string, bytes long")
    ranges = warc.read(files, 100)
    assert ranges.rdd.getNumPartitions() == 70 and warc.read(files, 100, most_tasks=9).rdd.getNumPartitions() == 9


def test_archives_lie_in_the_default_file_system(spark, tmp_path):
    files = warc.write(warc.with_revisits(pages(spark).limit(3), "page_id", "url", F.lit(b"x")), str(tmp_path / "out"))
    assert {r["file"].partition(":")[0] for r in files.collect()} == {"file"}
    assert warc.read(files).count() == 3
