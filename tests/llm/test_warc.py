"""WARC archives: round trips, framing, digests and broken files."""

import base64
import gzip
import hashlib
import io
import os
import random

import pytest
from cases import workspace

from scoreloom.llm.warc import COMMITTED, Broken, archive_rows, member, members, page_record, parsed, read_archives, record, record_types, write_archives


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id BIGINT, url STRING, html STRING, kept STRING, size INT")


def brute(rows, least=0):
    out = []
    for i, _, h in rows:
        payload = (h or "").encode()
        ids = [j for j, _, g in rows if (g or "").encode() == payload and j is not None]
        refers = max(ids) if len(payload) >= least and ids and i != max(ids) else None
        out.append((i, len(payload), sha(payload), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/é b\r\nX: y", "same"), (2, None, "same"), (3, "http://c", None), (4, "http://d", ""), (5, "", "ünï\r\n\r\ncode"), (5, "", "ünï\r\n\r\ncode"),
    (None, "http://e", "same"), (None, "http://f", "alone"), (2**62, "http://g", "WARC/1.1\r\n\r\n"), (7, "http://h", "long " * 400_000), (8, "http://h", "long " * 400_000),
]


def round_trip(spark, rows, archive_bytes=1 << 20, least=0, **options):
    work = workspace(spark)
    path = f"{work.root}/archives"
    write_archives(record_types(pages(spark, rows), work, least), path, archive_bytes)
    return path, read_archives(spark, path, **options)


def result(df):
    kept = df.where("record_type <> 'warcinfo'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted([tuple(r) for r in kept.collect()], key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip_equals_brute_force(spark, least):
    _, got = round_trip(spark, ROWS, archive_bytes=2000, least=least)
    assert result(got) == brute(ROWS, least)


def test_a_third_of_the_rows_equal(spark):
    rng = random.Random(1)
    rows = [(i, f"http://x/{i}", "hot" if i % 3 == 0 else f"page {rng.randint(0, 50)}") for i in range(600)]
    path, got = round_trip(spark, rows, archive_bytes=5000)
    assert result(got) == brute(rows)
    assert got.select("archive").distinct().count() > 3


def test_payloads_and_headers_come_back(spark):
    _, got = round_trip(spark, ROWS, payload="keep")
    kept = {r["page_id"]: r for r in got.where("record_type = 'response'").collect()}
    assert bytes(kept[5]["payload"]).decode() == "ünï\r\n\r\ncode" and bytes(kept[8]["payload"]).decode() == "long " * 400_000
    assert kept[2]["url"] is None and kept[2**62]["url"] == "http://g"
    assert got.where("page_id = 1").first()["url"] == "http://a/%C3%A9%20b%0D%0AX:%20y"


def test_empty_table(spark):
    _, got = round_trip(spark, [])
    assert result(got) == []


def test_archives_of_failed_tasks_are_not_read(spark):
    path, got = round_trip(spark, ROWS)
    before = result(got)
    with open(f"{path.removeprefix('file://')}/stray.warc.gz", "wb") as f:
        f.write(member(page_record(99, None, b"stray", "response", None)))
    assert result(read_archives(spark, path)) == before
    assert any(name == COMMITTED for name in os.listdir(path.removeprefix("file://")))


def test_every_member_is_a_record_for_other_readers(spark):
    path, _ = round_trip(spark, ROWS, archive_bytes=1 << 30)
    root = path.removeprefix("file://")
    seen = 0
    for name in [x for x in os.listdir(root) if x.endswith(".gz")]:
        whole = gzip.open(f"{root}/{name}").read()
        while whole:
            head, _, rest = whole.partition(b"\r\n\r\n")
            size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")).split(b":")[1])
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and rest[size : size + 4] == b"\r\n\r\n"
            whole, seen = rest[size + 4 :], seen + (b"WARC-Type: warcinfo" not in head)
    assert seen == len(ROWS)


def read_members(raw, block=1 << 18):
    return [(place, b"".join(pieces)) for place, pieces in members(io.BytesIO(raw), block)]


def test_members_do_not_depend_on_the_block_size():
    parts = [member(page_record(i, "u", os.urandom(i * 37) + b"z" * 50_000 * (i % 2), "response", None)) for i in range(6)]
    raw, places = b"".join(parts), [sum(map(len, parts[:i])) for i in range(6)]
    whole = [gzip.decompress(p) for p in parts]
    for block in (1, 13, 100, 4096, 1 << 20):
        assert read_members(raw, block) == list(zip(places, whole, strict=True))
    for place, pieces in members(io.BytesIO(raw), 11):
        assert parsed(pieces, True)["page_id"] == places.index(place)


GOOD = page_record(1, "u", b"payload", "response", None)
BAD = {
    "payload": record({"WARC-Type": "response", "WARC-Payload-Digest": "sha1:" + sha(b"other")}, b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"),
    "block": GOOD.replace(b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:A"),
    "short": GOOD[:-6], "long": GOOD + b"more", "version": GOOD.replace(b"WARC/1.1", b"WARC/9.9"), "length": GOOD.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9", 1),
    "no length": b"WARC/1.1\r\nWARC-Type: response\r\n\r\nabc\r\n\r\n", "no header": b"WARC/1.1",
}


@pytest.mark.parametrize("fault", BAD)
def test_broken_records_are_named(tmp_path, fault):
    good = member(GOOD)
    (tmp_path / "a.warc.gz").write_bytes(good + member(BAD[fault]) + good)
    with pytest.raises(Broken, match=f"a.warc.gz, from byte {len(good)} on"):
        list(archive_rows(str(tmp_path), "a.warc.gz", False, False))
    rows = list(archive_rows(str(tmp_path), "a.warc.gz", False, True))
    assert [r["fault"] is None for r in rows] == [True, False, True] and rows[2]["page_id"] == 1


@pytest.mark.parametrize("cut", [1, 9, 40])
def test_archives_cut_short(tmp_path, cut):
    good = member(GOOD)
    (tmp_path / "a.warc.gz").write_bytes(good + good[:-cut])
    rows = list(archive_rows(str(tmp_path), "a.warc.gz", False, True))
    assert [r["fault"] is None for r in rows] == [True, False]
    (tmp_path / "b.warc.gz").write_bytes(good + b"garbage")
    assert [r["fault"] is None for r in archive_rows(str(tmp_path), "b.warc.gz", False, True)] == [True, False]
