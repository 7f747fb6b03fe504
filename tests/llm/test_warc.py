from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from precis.llm import warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {}\r\n\r\nHTTP/1.1 200 OK\r\n\r\nfake"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark, prose):
    odd = [
        "plain",
        "",
        None,
        "ends with gap\r\n\r\n",
        "ends with break\r\n",
        "\r\n\r\nstarts with gap",
        "\r\n\r\n\r\n\r\n",
        "x\r\n\r\n" + FAKE.format(23) + "\r\n\r\nmore",
        "x\r\n\r\n" + FAKE.format(10**9) + "\r\n\r\n" + FAKE.format(0),
        "\r\n" + FAKE.format(5) + "\nWARC/1.1\r\n",
        "éü日本\r\n\r\n語",
        "big " + "payload \r\n\r\n" * 20_000,
        prose(3000, 1),
    ]
    rows = [(i, f"http://h/{i}", t) for i, t in enumerate(odd)]
    rows += [(100 + i, f"http://c\r\n/{i}", "copy of a page") for i in range(40)] + [(200, None, odd[7]), (None, "u", "plain"), (None, "v", "alone")]
    rows += [(300 + i, "f", FAKE.format(i)) for i in range(60)]
    return rows


def expected(rows):
    first = {}
    for key, _, html in rows:
        if key is not None:
            first[html or ""] = min(first.get(html or "", key), key)
    out = []
    for key, url, html in rows:
        low = first.get(html or "")
        revisit = low is not None and low != key
        out.append((key, (url or "").replace("\r\n", "") if url else None, len((html or "").encode()), digest(html), "revisit" if revisit else "response", low if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", ["128m", "20k", "700b"])
def test_round_trip(spark, pages, tmp_path, split):
    df = spark.createDataFrame([(*r, 1, "x") for r in pages], "page_id long, url string, html string, _key long, record string")
    warc.write(df.repartition(2, "page_id"), f"{tmp_path}/w", records_per_file=50)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = warc.read(spark, f"{tmp_path}/w", payload=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = [(r["key"], r["url"], r["payload_bytes"], r["payload_digest"], r["kind"], r["refers_to"]) for r in found]
    assert sorted(got, key=str) == expected(pages)
    assert all(r["intact"] for r in found)
    body = {r["key"]: r["payload"] for r in found if r["kind"] == "response" and r["key"] is not None}
    assert all(body[k] == (t or "").encode() for k, _, t in pages if k in body)


def test_least_size_of_a_revisit(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    warc.write(df, f"{tmp_path}/w", least=3)
    got = {r["key"]: (r["kind"], r["refers_to"]) for r in warc.read(spark, f"{tmp_path}/w").collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_empty_table(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/w")
    assert warc.read(spark, f"{tmp_path}/w").count() == 0


def test_damage_shows(spark, tmp_path):
    rows = [(1, "u", "first page"), (2, "u", "second page"), (3, "u", "third page")]
    made = warc.records(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("record")
    made = made.coalesce(1).withColumn("record", F.regexp_replace("record", "second page", "sec0nd page"))
    made.write.option("lineSep", warc.GAP).text(f"{tmp_path}/w")
    assert {r["key"]: r["intact"] for r in warc.read(spark, f"{tmp_path}/w").collect()} == {1: True, 2: False, 3: True}


def test_digest_in_sql(spark):
    texts = ["", "a", "é" * 100]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(warc.payload_digest(F.encode("t", "UTF-8")).alias("d"))
    assert [r["d"] for r in df.collect()] == [digest(t) for t in texts]


def test_pieces_of_whole_records_are_not_shuffled(spark, tmp_path, capsys):
    """Only the few spans of open records are sent to the pieces, however large Spark takes them to be."""
    df = spark.createDataFrame([(i, "u", "x" * 2000) for i in range(40)], "page_id long, url string, html string")
    warc.write(df, f"{tmp_path}/w")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        warc.read(spark, f"{tmp_path}/w").explain()
        assert "BroadcastHashJoin [file" in capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
