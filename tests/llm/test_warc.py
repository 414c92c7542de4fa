import gzip
import os

import pytest

from rosterlake.llm import warc
from rosterlake.llm.common import Scratch

PAGES = "page_id bigint, url string, html string, size string, digest int, same string"


def pages(spark, n=120):
    rows = [(i, f"http://h{i % 7}.example/{i}", f"<p>{'é' * (i % 11)}{i % 40}</p>" * 20, "x", 1, "y") for i in range(n)]
    rows += [
        (500, None, None, "x", 1, "y"), (501, "http://a/\r\nX: y", "", "x", 1, "y"), (502, "u", "x" * 300_000, "x", 1, "y"),
        (3, "again", "<p>3</p>", "x", 1, "y"), (None, "none", "<b>null id</b>", "x", 1, "y"),
    ]
    return spark.createDataFrame(rows, PAGES), rows


def brute(rows):
    first = {}
    for page, _, html, *_ in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        low = first.get(html or "")
        revisit = page is not None and page != low
        out.append((page, len(data), warc.base32_sha1(data), "revisit" if revisit else "response", low if revisit else None))
    return sorted(out, key=str)


def archives(root):
    folder = root.removeprefix("file:")
    return {n: open(f"{folder}/{n}", "rb").read() for n in sorted(os.listdir(folder)) if n.endswith(".gz")}


def test_round_trip(spark):
    frame, rows = pages(spark)
    found = warc.round_trip(frame, Scratch(spark, "t"), shard_bytes=8000, file_bytes=2000).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_rerun_repeats_the_files(spark):
    frame, _ = pages(spark)
    held = []
    for partitions in (1, 5):
        scratch = Scratch(spark, "t")
        root = f"{scratch.root}/archive"
        listed = warc.write_archives(frame.repartition(partitions), root, scratch, shard_bytes=8000, file_bytes=2000)
        held.append(archives(root))
        assert len(held[-1]) == listed.count() > 5
        ids = [(r.first_id, r.last_id) for r in listed.where("first_id is not null").orderBy("name").collect()]
        assert ids == sorted(ids)
    assert held[0] == held[1]
    # What is left below a temporary name can be committed again without harm.
    warc.commit(spark, root, f"{root}/manifest")
    assert archives(root) == held[1]


def test_records_are_well_formed(spark):
    frame, _ = pages(spark, 10)
    scratch = Scratch(spark, "t")
    warc.write_archives(frame, f"{scratch.root}/archive", scratch)
    for data in archives(f"{scratch.root}/archive").values():
        plain = gzip.decompress(data)
        while plain:
            head, _, rest = plain.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
            size = int(headers["Content-Length"])
            block, plain = rest[:size], rest[size:]
            assert headers["WARC-Block-Digest"] == "sha1:" + warc.base32_sha1(block)
            assert plain[:4] == b"\r\n\r\n"
            plain = plain[4:]
            if headers["WARC-Type"] == "response":
                payload = block.partition(b"\r\n\r\n")[2]
                assert headers["WARC-Payload-Digest"] == "sha1:" + warc.base32_sha1(payload)


def test_small_payloads_stay_responses(spark):
    frame = spark.createDataFrame([(1, "u", "ab", "", 1, ""), (2, "u", "ab", "", 1, ""), (3, "u", "abc", "", 1, ""), (4, "u", "abc", "", 1, "")], PAGES)
    found = warc.round_trip(frame, Scratch(spark, "t"), min_revisit_bytes=3).orderBy("page_id").collect()
    assert [r.record_type for r in found] == ["response", "response", "response", "revisit"]


def test_empty_table_and_lost_file(spark):
    empty = spark.createDataFrame([], PAGES)
    assert warc.round_trip(empty, Scratch(spark, "t")).collect() == []
    frame, _ = pages(spark, 3)
    scratch = Scratch(spark, "t")
    root = f"{scratch.root}/archive"
    warc.write_archives(frame, root, scratch)
    for name in archives(root):
        os.rename(f"{root.removeprefix('file:')}/{name}", f"{root.removeprefix('file:')}/gone-{name}")
    with pytest.raises(Exception, match="FileNotFoundError"):
        warc.commit(spark, root, f"{root}/manifest")


def test_a_shard_is_a_task(spark):
    frame, _ = pages(spark, 400)
    scratch = Scratch(spark, "t")
    listed = warc.write_archives(frame, f"{scratch.root}/archive", scratch, shard_bytes=4_000, file_bytes=1 << 20)
    shards = [r.shard for r in listed.collect()]
    assert len(set(shards)) > 15
    parts = spark.read.parquet(f"{scratch.root}/archive/manifest").selectExpr("_metadata.file_name AS f", "shard")
    assert parts.groupBy("f").agg({"shard": "approx_count_distinct"}).where("`approx_count_distinct(shard)` > 1").isEmpty()


def test_repeated_id_is_cut(spark):
    """Rows of one id fill several shards, copies of their payloads among them."""
    rows = [(7, f"u{i}", f"<p>{i % 30}</p>" * 100, "x", 1, "y") for i in range(90)]
    rows += [(i, "u", f"<p>{i}</p>" * 100, "x", 1, "y") for i in range(20)]
    frame = spark.createDataFrame(rows, PAGES)
    scratch = Scratch(spark, "t")
    root = f"{scratch.root}/archive"
    listed = warc.write_archives(frame, root, scratch, shard_bytes=20_000, file_bytes=1 << 20)
    sevens = listed.where("first_id = 7 AND last_id = 7").select("shard").distinct()
    assert sevens.count() >= 2
    found = warc.read_archives(spark, root, listed).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)
