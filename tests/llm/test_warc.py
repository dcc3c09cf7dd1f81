import base64
import hashlib

import pytest

from logsieve.llm.warc import open_archive, read_back, reconstruct, write_archive

PAGES = [
    (3, "http://a/3", "<p>same</p>"),
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2\r\nWARC-Type: evil", "<p>ünlike</p>"),
    (4, None, None),
    (5, "http://a/5", ""),
    (None, "http://a/n", "<p>same</p>"),
    (6, "http://a/6", "long " * 200_000),
    (7, "http://a/7", "twice"),
    (7, "http://a/7", "twice"),
]


def expected(pages, least):
    groups = {}
    for i, _, h in pages:
        groups.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in pages:
        data = (h or "").encode()
        first = min(groups[h or ""], key=lambda x: (x is None, x or 0))
        revisit = len(data) >= least and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 8])
def test_read_back(spark, least):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, sha1 string")
    got = read_back(write_archive(pages, least=least)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(PAGES, least)


def test_records_are_exact_and_payloads_stored_once(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    write_archive(pages, path=str(tmp_path / "a"))
    archive = open_archive(spark, str(tmp_path / "a"))
    assert archive.payloads.count() == len({h or "" for _, _, h in PAGES})
    for row in reconstruct(archive).collect():
        record = bytes(row.record)
        head, rest = record.split(b"\r\n\r\n", 1)
        lines = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert lines["WARC-Type"] == row.record_type
        assert int(lines["Content-Length"]) == len(rest) - 4 and record.endswith(b"\r\n\r\n")
        if row.record_type == "response":
            assert rest[:-4].split(b"\r\n\r\n", 1)[1] == bytes(row.payload)


def test_damage_is_noticed(spark):
    archive = write_archive(spark.createDataFrame(PAGES, "page_id long, url string, html string"))
    swapped = archive.payloads.selectExpr("sha256", "length", "first(body) OVER (ORDER BY length DESC) AS body")
    with pytest.raises(Exception, match="damaged|Decompress|decompress"):
        reconstruct(type(archive)(archive.headers, swapped)).collect()


def test_empty(spark):
    assert read_back(write_archive(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0
