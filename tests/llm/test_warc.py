"""Archives: round trips, and what can be saved of damaged ones."""

from __future__ import annotations

import base64
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from riskloom.llm import warc

SCHEMA = "page_id long, url string, html string, page string, first int, sha1 int"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def round_trip(spark, rows, **options):
    df = spark.createDataFrame([(i, u, h, "x", 1, 2) for i, u, h in rows], SCHEMA)
    return warc.read_archives(warc.write_archives(df, **options)).collect()


def test_round_trip(spark):
    rows = [(5, "http://a/\r\nx", "same"), (3, None, "same"), (9, "u", "same"), (1, "ü", ""), (2, "", None), (4, "x", "ä€\r\n\r\nWARC/1.1\r\n" * 9)]
    rows += [(None, "u", "same"), (None, "n", "alone"), (7, "l", "long " * 300_000), (4, "x", "other")]
    got = round_trip(spark, rows)
    assert all(r.gap_reason is None for r in got) and len(got) == len(rows)
    want = []
    for i, _, h in rows:
        payload = (h or "").encode()
        first = min((j for j, _, o in rows if (o or "") == (h or "") and j is not None), default=None)
        again = first is not None and i != first
        want.append((str(i), len(payload), digest(payload), "revisit" if again else "response", first if again else None))
    assert sorted(map(str, want)) == sorted(
        str((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got
    )
    by_id = {r.page_id: r for r in got if r.record_type == "response"}
    assert bytes(by_id[7].payload) == b"long " * 300_000
    assert {bytes(r.payload) for r in got if r.page_id == 4} == {("ä€\r\n\r\nWARC/1.1\r\n" * 9).encode(), b"other"}
    assert all(r.payload is None for r in got if r.record_type == "revisit")


def test_long_headers(spark):
    rows = [(1, "http://h/" + "\x01" * 100_000, "same"), (2, "http://h/" + "y" * 2_000_000, "same"), (3, "u", "other")]
    got = {r.page_id: (r.gap_reason, r.refers_to, len(r.url or "")) for r in round_trip(spark, rows)}
    assert got == {1: (None, None, 300_009), 2: (None, 1, 2_000_009), 3: (None, None, 1)}


def test_records_read_are_counted(spark):
    df = spark.createDataFrame([(i, "u", f"page {i}", "x", 1, 2) for i in range(6)], SCHEMA).coalesce(1)
    files = warc.write_archives(df)
    assert warc.read_archives(files, complete=True).count() == 6
    more = files.withColumn("records", files.records + 1)
    assert warc.read_archives(more).count() == 6
    with pytest.raises(Exception, match="6 records read of 7 written"):
        warc.read_archives(more.coalesce(1), complete=True).collect()


def test_small_payloads_are_never_revisits(spark):
    got = round_trip(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "xyz"), (4, "d", "xyz")], least_bytes=3)
    assert {r.page_id: r.refers_to for r in got} == {1: None, 2: None, 3: None, 4: 3}


def test_files_roll_over(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1)
    df = spark.createDataFrame([(i, "u", f"page {i}", "x", 1, 2) for i in range(6)], SCHEMA).coalesce(1)
    files = warc.write_archives(df)
    assert files.count() >= 1 and files.selectExpr("sum(records)").first()[0] == 6


def test_empty(spark):
    assert round_trip(spark, []) == []


def records(plain=False):
    made = [warc.encode_record(i, f"http://h/{i}", f"payload {i} ".encode() * 40, None, False) for i in range(5)]
    return made if plain else [warc.compress_member(x) for x in made]


def saved(data):
    found = list(warc.salvage(io.BytesIO(data).read))
    good = [warc._page(x.headers["warc-record-id"]) for x in found if isinstance(x, warc.Record)]
    return good, [(x.start, x.end) for x in found if isinstance(x, warc.Gap)]


@pytest.mark.parametrize("plain", [True, False])
def test_undamaged(plain):
    assert saved(b"".join(records(plain))) == ([0, 1, 2, 3, 4], [])


@pytest.mark.parametrize("plain", [True, False])
def test_flipped_byte(plain):
    parts = records(plain)
    hurt = bytearray(parts[2])
    hurt[len(hurt) // 2] ^= 0x55
    start = len(parts[0] + parts[1])
    assert saved(b"".join([*parts[:2], bytes(hurt), *parts[3:]])) == ([0, 1, 3, 4], [(start, start + len(hurt))])


@pytest.mark.parametrize("plain", [True, False])
def test_garbage_and_cut_end(plain):
    parts = records(plain)
    noise = b"\x1f\x8b\x08 no member WARC/1.0\r\n no record" + bytes(3000)
    data = parts[0] + noise + parts[1] + parts[2][:-9]
    a = len(parts[0])
    b = a + len(noise)
    assert saved(data) == ([0, 1], [(a, b), (b + len(parts[1]), len(data))])


def test_wrong_length_and_lost_middle():
    parts = records(plain=True)
    wrong = parts[1].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    cut = parts[3][len(parts[3]) // 2 :]
    assert saved(parts[0] + wrong + parts[2] + cut + parts[4])[0] == [0, 2, 4]


def test_mixed_and_nothing():
    assert saved(records()[0] + records(plain=True)[1] + records()[2])[0] == [0, 1, 2]
    assert saved(b"") == ([], [])
    assert saved(b"just text, much of it " * 99_999) == ([], [(0, 22 * 99_999)])


def test_damage_inside_a_member():
    a, b = records(plain=True)[:2]
    found = list(warc.salvage(io.BytesIO(warc.compress_member(a[:-30] + b)).read))
    assert [type(x).__name__ for x in found] == ["Gap", "Record"]


def test_a_frequent_payload_is_split(spark):
    """Half of all pages share one payload; their rows are split over tasks in the join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 4000, 1, 8).select(
            F.col("id").alias("page"),
            F.sha1(F.when(F.col("id") % 2 == 0, "same").otherwise(F.col("id").cast("string")).cast("binary")).alias("sha1"),
        )
        joined = warc._with_first(rows)
        assert joined.filter("first = 0").count() == 2000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
