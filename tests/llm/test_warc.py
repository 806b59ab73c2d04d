"""Archives read back, record types against a plain rule, and writers that run twice."""

import base64
import gzip
import hashlib
import os

import pytest
from churnkit.llm import warc as W

PAGES = [(1, "http://a/x", "same"), (2, "http://a/y", "same"), (9, "http://b/\n z", "same"), (3, None, None), (4, "u", ""), (5, "é", "é" * 9),
         (6, "big", "word " * 60_000), (2, "http://a/y", "same"), (7, "q", "only"), (7, "q", "only"), (7, "q", "other"), (None, "n", "only"),
         (None, "n", "alone"), (None, "n", "alone"), (-4, "low", "x\r\n\r\ny")]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "response", 1) for r in rows], "page_id long, url string, html string, record_type string, shard int")


def plain(rows, min_bytes=0):
    top, seen, out = {}, set(), []
    for page, _, html in rows:
        if page is not None:
            top[html or ""] = max(top.get(html or "", page), page)
    for page, _, html in rows:
        payload = (html or "").encode()
        head = top.get(html or "") if len(payload) >= min_bytes else None
        again = (page, payload) in seen
        seen.add((page, payload))
        refers = head if head is not None and (page != head or again) else None
        out.append((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_records_come_back(spark, tmp_path, min_bytes):
    folder = str(tmp_path / "w")
    manifest = W.write_archives(frame(spark).repartition(4), folder, min_bytes, shard_bytes=2000, roll_bytes=400)
    got = W.read_archives(spark, folder, payloads=True)
    assert rows_of(got) == plain(PAGES, min_bytes)
    texts = {base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(): (h or "").encode() for _, _, h in PAGES}
    assert all(bytes(r.payload) == texts[r.payload_digest] for r in got.where("record_type = 'response'").collect())
    listed = {r.file: r for r in manifest.collect()}
    assert len(listed) > 4 and any("-0001." in f for f in listed)
    assert {f for f in os.listdir(folder) if not f.startswith(("manifest", ".", "_"))} == set(listed)
    pages = []
    for name in sorted(listed):
        with gzip.open(f"{folder}/{name}") as file:  # the members are one plain gzip stream
            raw = file.read()
        assert raw.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        pages += [line.split(b":")[3] for line in raw.split(b"\r\n") if line.startswith(b"WARC-Record-ID: <urn:x-page")]
    ids = [int(p) if p else None for p in pages]
    assert ids == [None] * 3 + sorted(i for i in ids if i is not None)


def test_two_runs_write_the_same_files(spark, tmp_path):
    found = []
    for n in (1, 6):
        folder = str(tmp_path / f"w{n}")
        W.write_archives(frame(spark).repartition(n), folder, shard_bytes=2000, roll_bytes=400)
        found.append({(r.file, r.crc32, r.bytes) for r in spark.read.parquet(f"{folder}/manifest").collect()})
    assert found[0] == found[1]


def test_damage_is_seen(spark, tmp_path):
    folder = str(tmp_path / "w")
    name = W.write_archives(frame(spark), folder).first().file
    with open(f"{folder}/{name}", "r+b") as file:
        file.truncate(os.path.getsize(f"{folder}/{name}") - 3)
    with pytest.raises(Exception, match="ends inside a record|not as it was written"):
        W.read_archives(spark, folder).collect()


def test_query_form_and_empty_table(spark):
    assert rows_of(W.archive_pages(frame(spark))) == plain(PAGES)
    assert W.archive_pages(frame(spark).limit(0)).count() == 0
