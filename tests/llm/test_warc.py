"""Archives: exact round trip, foreign files, and what the reader skips."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

from shelfwright.llm import warc as W

BIG, SMALL = "<p>" + "é" * 600 + "</p>", "<p>x</p>"
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, "http://b/3\r\nX: y", SMALL), (4, None, SMALL), (5, "u", None), (6, "u", ""),
         (7, "u", "z" * 999), (8, "u", "z" * 999), (9, "u", "y" * 1000), (9, "u", "y" * 1000), (None, "u", BIG), (None, "u", "q" * 2000), (10, "u", "a\r\n\r\nb" * 300)]


@pytest.fixture(scope="module")
def archived(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('warc')}/files"
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as key", "2 as first", "3 as digest").repartition(3)
    W.write(spark, df, path)
    return path


def by_hand():
    largest = {}
    for page, _, html in PAGES:
        if page is not None:
            largest[html or ""] = max(largest.get(html or "", page), page)
    rows = []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        first = largest.get(html or "")
        again = len(payload) >= 1000 and first is not None and first != page and sum((h or "") == (html or "") for _, _, h in PAGES) > 1
        rows.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(rows, key=str)


def test_round_trip(spark, archived):
    assert sorted(map(tuple, W.pages_of(W.read(spark, archived)).collect()), key=str) == by_hand()
    payloads = {r.record_id: r.payload for r in W.read(spark, archived).where("record_type = 'response'").collect()}
    assert payloads["<urn:page:10>"].decode() == PAGES[-1][2] and payloads["<urn:page:2>"].decode() == BIG


def test_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    path = f"file://{tmp_path}/none"
    W.write(spark, empty, path)
    assert W.pages_of(W.read(spark, path)).count() == 0


def test_filters_reach_the_reader(spark, archived):
    reader = W.WarcReader({"path": archived})
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("payload_length",), 3), In(("target_uri",), ("u",)), StringStartsWith(("record_id",), "<urn")]))
    assert [type(f) for f in left] == [GreaterThan] and len(reader.pushed) == 3
    rows = W.read(spark, archived).where((F.col("record_type") == "revisit") & (F.col("target_uri") == "http://a/1"))
    assert [(r.record_id, r.refers_to, r.payload) for r in rows.collect()] == [("<urn:page:1>", "<urn:page:2>", None)]
    assert W.read(spark, archived, payloads=False).where("payload is not null").count() == 0


def test_refused_members_are_stepped_over(archived, monkeypatch):
    """A member that the filters refuse is decoded no further than its headers."""
    decoded = []
    whole = W._Member.more
    monkeypatch.setattr(W, "CHUNK", 256)

    def counted(self):
        decoded.append(1)
        return whole(self)

    monkeypatch.setattr(W._Member, "more", counted)
    paths = [a.path for a in W.WarcReader({"path": archived}).partitions()]
    for path in paths:
        list(W.records(path, []))
    every = len(decoded)
    decoded.clear()
    refuse = W._test(EqualTo(("record_type",), "no such type"))
    assert [r for path in paths for r in W.records(path, [refuse])] == [] and len(decoded) < every


@pytest.mark.parametrize("name", ["plain.warc", "foreign.warc.gz"])
def test_files_of_others(spark, tmp_path, name):
    """Records without sizes in the gzip header, and files that are not packed."""
    body = b"HTTP/1.0 200 OK\r\nX: 1\r\n\r\nhello" + b"w" * 50000
    records = [W._record("response", [("WARC-Record-ID", f"<urn:page:{i}>")], body) for i in range(3)] + [W._record("metadata", [], b"m")]
    data = b"".join(records) if name == "plain.warc" else b"".join(map(gzip.compress, records))
    (tmp_path / name).write_bytes(data)
    rows = W.read(spark, f"file://{tmp_path}").where("record_type = 'response'").collect()
    assert [(r.record_id, r.payload) for r in rows] == [(f"<urn:page:{i}>", body.split(b"\r\n\r\n")[1]) for i in range(3)]
    assert gzip.decompress(W._member(records[0])) == records[0]


@pytest.fixture(params=["own", "plain", "foreign"])
def archive(request, tmp_path):
    """Bytes of three records, where each begins, and a function that writes the archive to a folder of its own."""
    body = b"HTTP/1.0 200 OK\r\nX: 1\r\n\r\n" + random.Random(1).randbytes(20000)
    records = [W._record("response", [("WARC-Record-ID", f"<urn:page:{i}>")], body) for i in range(3)]
    parts = [{"own": W._member, "plain": bytes, "foreign": gzip.compress}[request.param](r) for r in records]
    name = "a.warc" if request.param == "plain" else "a.warc.gz"

    def put(data: bytes) -> str:
        (tmp_path / name).write_bytes(data)
        return f"file://{tmp_path / name}"

    return b"".join(parts), [0, len(parts[0]), len(parts[0]) + len(parts[1])], put


@pytest.mark.parametrize("payloads", [True, False])
def test_damaged_archives_are_reported(archive, payloads):
    data, starts, put = archive
    assert len(list(W.records(put(data), [], payloads))) == 3
    for cut, whole in ((len(data) - len(data) // 8, 2), (starts[1] + 8, 1), (starts[1] + 30, 1), (starts[2] - 900, 1)):
        rows = W.records(put(data[:cut]), [], payloads)
        with pytest.raises(W.Damaged, match="a.warc"):
            seen = []
            for row in rows:
                seen.append(row)
        assert [r[1] for r in seen][:whole] == [f"<urn:page:{i}>" for i in range(whole)] and all(r[-1] is None or len(r[-1]) == 20000 for r in seen)
        kept = list(W.records(put(data[:cut]), [], payloads, keep_damaged=True))
        assert kept[:-1] == seen and kept[-1][0] == "damaged" and "at byte" in kept[-1][1]


def test_wrong_bytes_are_reported(archive):
    data, starts, put = archive
    if not put(data).endswith(".gz"):
        return
    spot = starts[1] - 7
    with pytest.raises(W.Damaged):
        list(W.records(put(data[:spot] + bytes([data[spot] ^ 1]) + data[spot + 1:]), []))


def test_damaged_rows_through_spark(spark, archive):
    data, _, put = archive
    path = put(data[:-5000])
    rows = W.read(spark, path, damaged="keep")
    assert sorted(r.record_type for r in rows.collect()) == ["damaged", "response", "response"]
    assert rows.where("record_type = 'damaged'").count() == 1 and rows.where("record_type = 'response'").count() == 2
    with pytest.raises(Exception, match="ends inside|shorter than"):
        W.read(spark, path).collect()


def test_lengths_that_are_no_numbers(tmp_path):
    (tmp_path / "a.warc").write_bytes(W._record("response", [("WARC-Record-ID", "x")], b"").replace(b"Content-Length: 0", b"Content-Length: -4"))
    with pytest.raises(W.Damaged, match="length"):
        list(W.records(f"file://{tmp_path}/a.warc", []))
    (tmp_path / "c.warc").write_bytes(b"\r\n")
    assert list(W.records(f"file://{tmp_path}/c.warc", [])) == []
