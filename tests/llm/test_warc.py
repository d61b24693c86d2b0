from __future__ import annotations

import base64
import gzip
import hashlib
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string, sha string, kind int, first long"


@pytest.fixture(scope="module")
def rows(prose):
    texts = prose(30, seed=11)
    out = [(i, f"http://host/{i}", f"<p>{t}</p>") for i, t in enumerate(texts)]
    out += [(100 + i, "http://host/copy\r\nX-Bad: 1", f"<p>{texts[3]}</p>") for i in range(20)]
    out += [(200, None, None), (201, "u", ""), (202, "u é", "é" * 50_000), (None, "u", "only"), (None, "u", f"<p>{texts[4]}</p>")]
    return out


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, 6) for r in rows], SCHEMA)


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None:
            first[data] = min(first.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        visit = len(data) >= least and first.get(data) is not None and first[data] != i
        out.append((i, len(data), digest, "revisit" if visit else "response", first[data] if visit else None))
    return sorted(out, key=str)


def test_query(spark, rows):
    found = warc.warc_query(pages(spark, rows)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)


def test_payloads_and_urls_come_back(spark, rows, tmp_path):
    folder = f"file://{tmp_path}/out"
    warc.write_warc(pages(spark, rows), folder, least=10, roll=4000)
    found = warc.read_warc(spark, folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == expected(rows, 10)
    html = {i: (h or "").encode() for i, _, h in rows}
    for r in found:
        if r.page_id is not None:
            assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == html[r.page_id]
    urls = {r.page_id: r.url for r in found}
    assert urls[5] == "http://host/5" and urls[200] is None and "\n" not in urls[100]


def test_files_roll_and_are_as_the_manifest_says(spark, rows, tmp_path):
    folder = f"file://{tmp_path}/out"
    manifest = spark.read.parquet(warc.write_warc(pages(spark, rows), folder, roll=3000)).collect()
    names = {f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".warc.gz")}
    assert names == {m["name"] for m in manifest} and len(names) > 4
    for m in manifest:
        data = open(f"{tmp_path}/out/{m['name']}", "rb").read()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (m["bytes"], m["sha256"])
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == m["records"]


SESSIONS = """
import sys
from pyspark.sql import SparkSession
from tidemark.llm import warc
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", sys.argv[2]).config("spark.checkpoint.dir", sys.argv[3]).getOrCreate()
pages = spark.read.parquet(sys.argv[3] + "/pages").repartition(int(sys.argv[2]) + 2)
warc.write_warc(pages, "file://" + sys.argv[1], roll=100_000, shard_bytes=300_000)
"""


def files_of(folder):
    return {f: hashlib.sha256(open(f"{folder}/{f}", "rb").read()).hexdigest() for f in os.listdir(folder) if f.endswith(".warc.gz")}


def test_equal_input_gives_equal_files(spark, prose, tmp_path):
    """40,000 pages through two sessions, partitionings and numbers of shuffle partitions, and twice in one session."""
    texts = prose(50, words=12, seed=12)
    some = spark.range(40_000).selectExpr("id * id % 1000003 AS page_id", "concat('http://host/', id) AS url", "id % 45000 AS n")
    some = some.join(spark.createDataFrame(list(enumerate(texts)), "m long, text string"), F.col("n") % 50 == F.col("m"))
    some = some.select("page_id", "url", F.concat("text", F.lit(" "), (F.col("n") % 30_000).cast("string")).alias("html"))
    some.write.parquet(f"{tmp_path}/pages")
    found = []
    for n, parts in enumerate(("3", "11")):
        run = [sys.executable, "-c", SESSIONS, f"{tmp_path}/session-{n}", parts, str(tmp_path)]
        subprocess.run(run, check=True, timeout=300, capture_output=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(__file__))))
        found.append(files_of(f"{tmp_path}/session-{n}"))
    for n in range(2):
        warc.write_warc(spark.read.parquet(f"{tmp_path}/pages"), f"file://{tmp_path}/here-{n}", roll=100_000, shard_bytes=300_000)
        found.append(files_of(f"{tmp_path}/here-{n}"))
    assert len(found[0]) > 20 and all(f == found[0] for f in found)
    assert not [f for f in os.listdir(f"{tmp_path}/here-0") if f.startswith("temporary-")]


def test_shards_are_ranges_of_ids(spark):
    rows = [(None, "b"), (None, "d"), (-5, "x"), (1, "a"), (1, "b"), (1, "c"), (7, "a"), (9, "z")]
    df = spark.createDataFrame(rows, "page_id long, sha string")
    starts = [(None, "c"), (1, "b"), (7, "a"), (8, "q")]
    assert [r.shard for r in df.select(warc.shard_of(starts).alias("shard")).collect()] == [0, 1, 1, 1, 2, 2, 3, 4]
    assert df.select(warc.shard_of([]).alias("shard")).distinct().count() == 1


def test_a_reader_between_manifest_and_commit(spark, rows, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/out"
    monkeypatch.setattr(warc, "commit", lambda *_: None)
    warc.write_warc(pages(spark, rows), folder)
    assert all(f.startswith("temporary-") for f in os.listdir(f"{tmp_path}/out") if f.endswith(".warc.gz"))
    assert warc.read_warc(spark, folder).count() == len(rows)


def test_commit_can_be_repeated(spark, rows, tmp_path):
    folder = f"file://{tmp_path}/out"
    warc.write_warc(pages(spark, rows), folder)
    name = next(f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".warc.gz"))
    temporary = next(m["temporary"] for m in spark.read.parquet(f"{folder}/manifest.parquet").collect() if m["name"] == name)
    os.rename(f"{tmp_path}/out/{name}", f"{tmp_path}/out/{temporary}")  # as if the commit had died before this file
    open(f"{tmp_path}/out/temporary-999-part-000000-00000.warc.gz", "wb").write(b"remains of a lost task")
    warc.commit(spark, folder)
    assert warc.read_warc(spark, folder).count() == len(rows)
    assert not [f for f in os.listdir(f"{tmp_path}/out") if f.startswith("temporary-")]


def test_repeated_rows_give_one_response(spark):
    again = [(7, "u", "same")] * 3 + [(8, "u", "same")]
    found = warc.warc_query(pages(spark, again)).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in found if r.record_type == "revisit") == [(7, "revisit", 7), (7, "revisit", 7), (8, "revisit", 7)]
    assert sum(r.record_type == "response" for r in found) == 1


def test_damage_is_noticed(spark, rows, tmp_path):
    folder = f"file://{tmp_path}/out"
    warc.write_warc(pages(spark, rows[:3]).coalesce(1), folder)
    name = next(f for f in sorted(os.listdir(f"{tmp_path}/out")) if f.endswith(".warc.gz"))
    data = open(f"{tmp_path}/out/{name}", "rb").read()
    open(f"{tmp_path}/out/{name}", "wb").write(data[:-20])
    with pytest.raises(Exception, match="ends within|records|digest"):
        warc.read_warc(spark, folder).collect()


def test_empty(spark):
    assert warc.warc_query(pages(spark, [])).collect() == []
