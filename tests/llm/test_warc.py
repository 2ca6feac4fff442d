import pytest

from skyloom.llm import warc

SCHEMA = "page_id long, url string, html string, record string, row int"


def test_round_trip(spark, tmp_path):
    long = "<p>é𝒳 " * 9000
    pages = [(1, "http://a/1", "<p>x"), (2, "http://a/ü b\r\nX: y", "<p>x"), (3, None, long), (4, "u", None), (5, "u", ""), (6, "u", "WARC/1.1\r\n\r\n\r\nWARC/1.0\r\n"), (None, "u", "<p>x"), (7, "u", long + "!"), (7, "u", long + "!"), (8, "u", "z" * 16_384)]
    df = spark.createDataFrame([(*p, "r", 1) for p in pages], SCHEMA).repartition(3)
    got = sorted(warc.round_trip(df).collect(), key=lambda r: (r.page_id or 0, r.record_type))
    assert len(got) == len(pages)
    for r in got:
        raw = next((h or "") for i, _, h in pages if i == r.page_id).encode()
        assert r.payload_bytes == len(raw) and r.payload_digest == warc.payload_digest(raw)
    kinds = [(r.page_id, r.record_type, r.refers_to) for r in got]
    assert kinds[:3] == [(None, "revisit", 2), (1, "revisit", 2), (2, "response", None)]
    assert (4, "revisit", 5) in kinds and (5, "response", None) in kinds
    assert sorted(k[1:] for k in kinds if k[0] == 7) == [("response", None), ("revisit", 7)]
    all_full = warc.round_trip(df, min_revisit_bytes=10**6)
    assert {r.record_type for r in all_full.collect()} == {"response"}


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_framing():
    assert warc.dechunk(b"4;x=1\r\nabcd\r\n2\r\nef\r\n0\r\n\r\n") == b"abcdef"
    body = "é" * 5000
    assert warc.dechunk(warc.chunked(body).encode()) == body.encode() and warc.chunked("") == "0\r\n\r\n"
    with pytest.raises(ValueError, match="size"):
        warc.dechunk(b"4\r\nabcdef\r\n0\r\n\r\n")
    parts = warc.records("urn:x", "http://a", "é" * 30_000, "response", "D", None)
    assert len(parts) > 2
    back = list(warc.parse("".join(p + warc.END for p in parts).encode()))
    assert [h.get("warc-segment-number") for h, _ in back] == [str(k + 1) for k in range(len(parts))]
    assert warc.http_payload(b"".join(b for _, b in back)) == ("é" * 30_000).encode()


def test_missing_segment_is_an_error(spark, tmp_path):
    parts = warc.records("urn:x", "http://a", "é" * 30_000, "response", warc.payload_digest(("é" * 30_000).encode()), None)
    spark.createDataFrame([(p,) for p in parts[:-1]], "value string").coalesce(1).write.option("lineSep", warc.END).text(str(tmp_path / "w"))
    with pytest.raises(Exception, match="missing"):
        warc.read_warc(spark, str(tmp_path / "w")).collect()
