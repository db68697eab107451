import base64
import hashlib
import struct

import pytest
import zstandard

from funnelwright.llm import warc

KIND = "page_id long, url string, html string, payload string, first long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "other", 7) for r in rows], KIND)


def rows_of(prose):
    rows = [(i, f"http://x/é {i}", prose(30)) for i in range(40)]
    rows += [(100 + i, None, rows[3][2]) for i in range(20)] + [(50, "u", None), (51, "u", ""), (52, "u\r\nx: y", "")]
    return rows + [(3, "again", rows[3][2]), (104, None, rows[3][2]), (None, "u", rows[4][2]), (None, "u", "only here")] + [
        (60, "u", "\r\n\r\nWARC/1.1\r\n" + "long " * 200_000)
    ]


def expected(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        smallest = first.get(html or "")
        kind = "response" if smallest is None or i == smallest else "revisit"
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, None if kind == "response" else smallest))
    return sorted(out, key=repr)


def test_round_trip(spark, prose):
    rows = rows_of(prose)
    got = warc.warc_report(table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_small_frames_and_bundles(spark, prose, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 700)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 2000)
    writer, index = warc._Writer(str(tmp_path)), []
    payloads = {i: prose(i).encode() for i in range(60)}
    for i, payload in payloads.items():
        for made in writer.add(i, warc.record(i, None, payload, None)):
            index += made
    for made in writer.finish():
        index += made
    assert len({r[1] for r in index}) > 3 and [r[0] for r in index] == list(payloads)
    for page_id, address, frame, at, size in index:
        raw = warc.Bundle(address).frame(frame)
        fields, payload, end = warc.parsed(raw, at)
        assert payload == payloads[page_id] and end - at == size
        assert fields["WARC-Payload-Digest"] == "sha1:" + warc.digest(payload)


def test_any_zstandard_reader_reads_a_bundle(tmp_path):
    writer = warc._Writer(str(tmp_path))
    made = warc.record(1, "http://x", b"payload", None)
    index = [r for rows in (*writer.add(1, made), *writer.finish()) for r in rows]
    with open(index[0][1], "rb") as f:
        raw = f.read()
    assert struct.unpack("<I", raw[-4:])[0] == warc.SEEKABLE_MAGIC
    assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == made


def test_records_by_id(spark, prose):
    rows = rows_of(prose)
    index = warc.write_bundles(table(spark, rows))
    wanted = spark.createDataFrame([(3,), (104,), (999,)], "page_id long")
    got = {r["page_id"]: r["payload"] for r in warc.fetch(index, wanted).collect()}
    assert bytes(got[3]) == rows[3][2].encode() and got[104] is None and 999 not in got


def test_least_payload_and_empty_table(spark):
    rows = [(1, None, "same"), (2, None, "same")]
    kinds = {r["page_id"]: r["record_type"] for r in warc.read_bundles(warc.write_bundles(table(spark, rows), 5)).collect()}
    assert kinds == {1: "response", 2: "response"}
    assert warc.warc_report(table(spark, [])).count() == 0


def test_damage_is_noticed():
    raw = warc.record(1, None, b"payload", None).replace(b"payload\r\n\r\n", b"paxload\r\n\r\n")
    fields, payload, _ = warc.parsed(raw)
    with pytest.raises(ValueError):
        warc._row(fields, payload)
