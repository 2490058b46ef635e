import base64
import gzip
import hashlib

import pytest

from lectern.llm import warc

ROWS = [
    (1, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (3, None, None), (4, "", ""),
    (5, "http://a/?q=1%20\r\nx", "line\r\n\r\nWARC/1.1\r\n\r\nend"), (None, "u", "<p>same</p>"),
    (2, "http://c/", "<p>same</p>"), (6, "é", "ß" * 400_000), (6, "é", "ß" * 400_000),
]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "pages.parquet")
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, archive string")
    df.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def expected():
    """(page, url, payload) with the kind of record and what it refers to."""
    last = {}
    for k, (page, _, html) in enumerate(ROWS):
        key = html or ""
        rank = (page is not None, page or 0, k)
        last[key] = max(last.get(key, rank), rank)
    out = []
    for k, (page, url, html) in enumerate(ROWS):
        payload = (html or "").encode()
        best = last[html or ""]
        revisit = best[2] != k
        sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, url, None if revisit else payload, len(payload), sha,
                    "revisit" if revisit else "response", best[1] if revisit else None))
    return sorted(map(repr, out))


@pytest.mark.parametrize("gap", [0, 1 << 20])
@pytest.mark.parametrize("archive_bytes", [200, 1 << 30])
def test_round_trip(spark, stored, gap, archive_bytes):
    index, folder = warc.write_archives(stored, archive_bytes=archive_bytes)
    assert index.count() == len(ROWS)
    got = warc.read_records(index, folder, gap_bytes=gap).collect()
    rows = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got]
    assert sorted(map(repr, rows)) == expected()


def test_selected_records(spark, stored):
    index, folder = warc.write_archives(stored)
    some = index.where("url like 'http%'")
    assert sorted(r["url"] for r in warc.read_records(some, folder).collect()) == sorted(
        u for _, u, _ in ROWS if u and u.startswith("http")
    )


def test_archives_are_members_of_records(spark, stored):
    index, folder = warc.write_archives(stored)
    rows = index.collect()
    root = folder.removeprefix("file://")
    for name in {r["archive"] for r in rows}:
        own = sorted((r["offset"], r["length"]) for r in rows if r["archive"] == name)
        data = open(f"{root}/{name}", "rb").read()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) == len(data)
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_short_payloads_stay_responses(spark, stored):
    index, _ = warc.write_archives(stored, min_bytes=100)
    kinds = [(r["payload_digest"], r["record_type"]) for r in index.collect()]
    assert sum(k == "revisit" for _, k in kinds) == 1


def test_empty(spark, stored):
    index, folder = warc.write_archives(stored.where("false"))
    assert index.count() == 0 and warc.read_records(index, folder).count() == 0


def test_a_damaged_payload_is_noticed():
    record = warc.encode_record(1, "u", b"abc", "response", None).replace(b"abc", b"abd")
    with pytest.raises(ValueError):
        warc.decode_record(record)
    with pytest.raises(ValueError):
        warc.decode_record(record[3:])
