"""WARC archives: exact round trips, records that other tools write, pushed predicates, and lost or repeated attempts."""

import base64
import gzip
import hashlib
import io
import os
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, IsNull, Not, StringStartsWith
from pyspark.sql.types import StructType

from waymark.llm import queries, warc

DATA = "/root/testdata/sf0.001"
ODD = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n"


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.fixture(scope="module")
def edges(spark):
    """Nulls in every column, empty, odd and very long payloads, equal ones, repeated rows, and columns named like results."""
    rows = [
        (5, "http://a/1", "<p>x</p>"), (3, "http://a/2", "<p>x</p>"), (3, "http://a/2", "<p>x</p>"), (None, "http://a/3", "<p>x</p>"), (9, None, None), (8, "u", ""), (7, " http://b/\r\nX: y ", ODD), (6, "é", "é ü 漢" * 50),
        (4, "big", "<b>long</b>" * 400_000), (None, None, "alone"), (None, "n", "alone"), (2, "http://a/2", "<p>y</p>"), (-1, "neg", "é ü 漢" * 50),
    ]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"payload": F.lit(1), "digest": F.lit("d"), "first": F.lit(2), "salt": F.lit(3), "headers": F.lit("h")})


def brute(rows, least_bytes=0):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        ids = [i for i, _, h in rows if (h or "").encode() == payload and i is not None]
        revisit = len(payload) >= least_bytes and bool(ids) and page != min(ids)
        out.append((page, len(payload), sha(payload), "revisit" if revisit else "response", min(ids) if revisit else None))
    return sorted(out, key=str)


def told(df):
    page, first = (F.col("headers")[n].cast("long") for n in ("page-id", "refers-to-page-id"))
    return sorted((tuple(r) for r in df.select(page, "payload_bytes", "payload_digest", "record_type", first).collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"compression": "none"}, {"filebytes": 300}])
def test_round_trip(spark, edges, tmp_path, options):
    rows, df = edges
    path = str(tmp_path / "w")
    warc.write(warc.records(df), path, **options)
    back = warc.read(spark, path).cache()
    assert told(back) == brute(rows)
    by_type = {k: [r for r in back.collect() if r.record_type == k] for k in ("response", "revisit")}
    assert sorted(bytes(r.payload) for r in by_type["response"]) == sorted((h or "").encode() for (i, _, h) in rows if (i, h) not in [(5, "<p>x</p>"), (None, "<p>x</p>"), (9, None), (6, "é ü 漢" * 50)])
    assert all(r.payload is None for r in by_type["revisit"])
    ids = {r.record_id for r in by_type["response"]}
    assert all(r.refers_to in ids for r in by_type["revisit"]) and all(r.record_id.startswith("urn:uuid:") for r in back.collect())
    uris = {r.headers.get("page-id"): r.target_uri for r in back.collect()}
    assert uris["7"] == "%20http://b/%0D%0AX: y%20" and uris["6"] == "é" and uris["9"] is None
    files = os.listdir(path)
    assert all(f.endswith((".warc", ".warc.gz")) or f == "_temporary" for f in files)
    if options.get("filebytes"):
        assert len(files) > 5


def test_smaller_payloads_are_responses(spark, edges, tmp_path):
    rows, df = edges
    warc.write(warc.records(df, least_bytes=9), str(tmp_path / "w"))
    assert told(warc.read(spark, str(tmp_path / "w"))) == brute(rows, 9)


def test_empty_table_and_folder(spark, edges, tmp_path):
    _, df = edges
    path = str(tmp_path / "w")
    warc.write(warc.records(df.filter("false")), path)
    assert warc.read(spark, path).count() == 0 and warc.read(spark, str(tmp_path / "none")).count() == 0


def test_other_tools_read_it(spark, edges, tmp_path):
    """Each record is a gzip member; the whole archive is what gunzip gives."""
    _, df = edges
    warc.write(warc.records(df).coalesce(1), str(tmp_path / "w"))
    (name,) = [f for f in os.listdir(tmp_path / "w") if f.endswith(".gz")]
    text = gzip.decompress((tmp_path / "w" / name).read_bytes())
    at = seen = 0
    while at < len(text):
        end = text.index(b"\r\n\r\n", at)
        head = dict(x.split(": ", 1) for x in text[at:end].decode().split("\r\n")[1:])
        assert text[at:].startswith(b"WARC/1.1\r\n") and head["WARC-Date"].endswith("Z")
        at = end + 4 + int(head["Content-Length"])
        assert text[at : at + 4] == b"\r\n\r\n"
        at, seen = at + 4, seen + 1
    assert seen == 13


def foreign(spaces=""):
    """Records as other tools write them: other header case, folded lines, resource and request records."""
    body = b"HTTP/1.0 200 OK\r\ncontent-type: text/html\r\n\r\n<html>1</html>"
    first = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Target-URI: http://x/\r\n y\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
    second = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Type: text/plain\r\nWARC-Payload-Digest: md5:zz\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    third = b"WARC/1.0\r\nWARC-Type: request\r\nContent-Type: application/http; msgtype=request\r\nContent-Length: 70000\r\n\r\n" + b"GET / HTTP/1.0\r\n\r\n" + b"q" * (70000 - 18) + b"\r\n\r\n"
    return [first, third, second]


@pytest.mark.parametrize("kind", ["plain", "member", "sized"])
def test_reads_foreign_archives(spark, tmp_path, kind):
    made = {"plain": lambda x: x, "member": gzip.compress, "sized": warc.member}[kind]
    (tmp_path / ("x.warc" if kind == "plain" else "x.warc.gz")).write_bytes(b"".join(made(x) for x in foreign()))
    (tmp_path / "notes.txt").write_text("no archive")
    rows = warc.read(spark, str(tmp_path)).orderBy("record_type").collect()
    assert [(r.record_type, r.target_uri, r.record_id, bytes(r.payload), r.payload_bytes) for r in rows] == [
        ("request", None, None, b"q" * (70000 - 18), 70000 - 18), ("resource", None, None, b"abc", 3), ("response", "http://x/ y", "urn:uuid:1", b"<html>1</html>", 14),
    ]
    assert [bytes(r.payload) for r in warc.read(spark, str(tmp_path), "record_type = 'resource'").collect()] == [b"abc"]


def reader(path, filters, columns=warc.COLUMNS):
    made = warc.WarcReader({"path": str(path), "pushdown": "true"}, StructType.fromDDL(columns))
    left = list(made.pushFilters(filters))
    return made, left


def test_predicates_are_pushed(spark, edges, tmp_path):
    rows, df = edges
    path = str(tmp_path / "w")
    warc.write(warc.records(df), path)
    back = warc.read(spark, path)
    whole = back.collect()
    for condition, test in [
        ("record_type = 'revisit'", lambda r: r.record_type == "revisit"), ("record_type <> 'revisit'", lambda r: r.record_type != "revisit"), ("target_uri like 'http://a/%'", lambda r: (r.target_uri or "").startswith("http://a/")),
        ("target_uri is null", lambda r: r.target_uri is None), ("target_uri > 'http://a/1' and record_type in ('response', 'x')", lambda r: r.target_uri is not None and r.target_uri > "http://a/1" and r.record_type == "response"),
        ("refers_to is not null and payload_bytes > 8", lambda r: r.refers_to is not None and r.payload_bytes > 8), (f"payload_digest = '{sha(b'')}'", lambda r: r.payload_digest == sha(b"")),
        ("not (target_uri = 'u')", lambda r: r.target_uri is not None and r.target_uri != "u"), ("target_uri = 'u' or record_type = 'revisit'", lambda r: r.target_uri == "u" or r.record_type == "revisit"),
    ]:
        for found in (back.filter(condition), warc.read(spark, path, condition)):
            assert sorted(map(str, found.collect())) == sorted(str(r) for r in whole if test(r)), condition
    pushed = warc.read(spark, path, "record_type = 'revisit'")
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert "(record_type" not in plan and "record_type" in plan
    # One DataFrame with several filters, in one plan and after each other.
    n = {k: sum(r.record_type == k for r in whole) for k in ("revisit", "response")}
    some = warc.read(spark, path, "record_type in ('revisit', 'response')")
    assert some.filter("record_type = 'revisit'").union(some.filter("record_type = 'response'")).count() == some.count() == len(whole)
    assert pushed.filter("target_uri = 'neg'").count() == 0 and pushed.count() == n["revisit"] and back.count() == len(whole)
    assert back.filter("record_type = 'revisit'").union(back.filter("record_type = 'response'")).count() == len(whole)
    made, left = reader(path, [EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 8), Not(In(("target_uri",), ("a", "b"))), IsNull(("refers_to",)), IsNotNull(("headers",)), StringStartsWith(("date",), "19")])
    assert [type(f) for f in left] == [GreaterThan, IsNotNull] and len(made.filters) == 4


@pytest.mark.parametrize("compress", [True, False])
def test_unwanted_payloads_are_not_read(tmp_path, monkeypatch, compress):
    """Bytes read and inflated for a record that a predicate drops, or when no payload is asked for: its head only."""
    noise = os.urandom(3 << 20)
    data = [warc.record({"record_id": f"r{i}", "record_type": "response" if i % 2 else "other", "payload": noise}) for i in range(4)]
    name = "x.warc.gz" if compress else "x.warc"
    (tmp_path / name).write_bytes(b"".join(warc.member(x) if compress else x for x in data))
    inflated = []

    class Counted:
        def __init__(self, bits):
            self.real = zlib_object(bits)

        def decompress(self, *a):
            inflated.append(len(out := self.real.decompress(*a)))
            return out

        def __getattr__(self, name):
            return getattr(self.real, name)

    zlib_object = zlib.decompressobj
    monkeypatch.setattr(warc.zlib, "decompressobj", Counted)

    class Raw(io.FileIO):
        taken = 0

        def readinto(self, b):
            n = super().readinto(b)
            Raw.taken += n
            return n

    for filters, columns, want, most in [
        ([EqualTo(("record_type",), "none")], warc.COLUMNS, [], 100_000), ([], "record_id string, headers map<string,string>", ["r0", "r1", "r2", "r3"], 100_000),
        ([EqualTo(("record_id",), "r2")], "record_id string, payload binary", ["r2"], (3 << 20) + 200_000),
    ]:
        inflated.clear()
        Raw.taken = 0
        made, left = reader(tmp_path / name, filters, columns)
        source = io.BufferedReader(Raw(tmp_path / name), 1 << 12)
        rows = list(made.rows((warc.Zipped if compress else warc.Plain)(source), [warc.test(f) for f in filters]))
        assert not left and [r["record_id"] for r in rows] == want and all(r.get("payload", noise) == noise for r in rows)
        assert sum(inflated) <= most and Raw.taken <= 1.01 * most + 300_000


def test_changed_payload_is_noticed(spark, tmp_path):
    data = warc.record({"record_id": "r", "payload": b"payload"}).replace(b"\r\n\r\npayload", b"\r\n\r\npayl0ad")
    (tmp_path / "x.warc").write_bytes(data)
    with pytest.raises(Exception, match="not the one that was written"):
        warc.read(spark, str(tmp_path)).collect()
    assert bytes(warc.read(spark, str(tmp_path), verify="false").first().payload) == b"payl0ad"
    assert warc.read(spark, str(tmp_path), columns="record_id string").collect() == [("r",)]
    with pytest.raises(Exception, match="no such columns"):
        warc.read(spark, str(tmp_path), columns="text string").collect()
    with pytest.raises(ValueError, match="name an extra header"):
        warc.record({"headers": {"Content-Length": "4"}})


def test_overwrite_append_and_lost_attempts(spark, edges, tmp_path):
    rows, df = edges
    path = str(tmp_path / "w")
    warc.write(warc.records(df), path)
    warc.write(warc.records(df), path)
    assert told(warc.read(spark, path)) == sorted(brute(rows) * 2, key=str)
    warc.write(warc.records(df), path, mode="overwrite")
    assert told(warc.read(spark, path)) == brute(rows)
    # An attempt that was lost leaves files of its own, which no reader sees; the one that succeeds is told to the commit.
    writer = warc.WarcWriter({"path": path}, False)
    batch = warc.pa.RecordBatch.from_pylist([{"record_id": "z", "payload": b"z"}])
    lost, good = writer.write(iter([batch])), writer.write(iter([batch]))
    assert lost.files != good.files and told(warc.read(spark, path)) == brute(rows)
    writer.commit([good])
    assert warc.read(spark, path).filter("record_id = 'z'").count() == 1
    failed = warc.WarcWriter({"path": path}, False)
    failed.abort([failed.write(iter([batch]))])
    assert warc.read(spark, path).filter("record_id = 'z'").count() == 1 and not os.listdir(f"{path}/_temporary")


def test_partitions_pack_small_archives(tmp_path):
    for i in range(7):
        (tmp_path / f"{i}.warc").write_bytes(b"x" * 100)
    made = warc.WarcReader({"path": str(tmp_path), "splitbytes": "250"}, StructType.fromDDL(warc.COLUMNS))
    assert [[os.path.basename(p) for p in x.paths] for x in made.partitions()] == [["0.warc", "1.warc"], ["2.warc", "3.warc"], ["4.warc", "5.warc"], ["6.warc"]]


def test_query(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    assert sorted(map(tuple, queries.op13_warc(spark, DATA).collect()), key=str) == brute(rows)
