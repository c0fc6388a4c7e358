"""Operator 4: exact round trip, broken archives, edge tables."""

import gzip
import hashlib
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from visitlens.llm import warc


def expected(rows, least=1000):
    facts = [(p, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest())
             for p, _, h in rows]
    best = {}
    for p, n, d in facts:
        if n >= least and p is not None:
            best[d] = max(best.get(d, p), p)
    out = []
    for p, n, d in facts:
        refers = best.get(d) if best.get(d) != p else None
        out.append((p, n, d, "revisit" if refers is not None else "response", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment,chunk", [(16 << 10, 4 << 10), (700, 130)])
def test_round_trip(spark, segment, chunk):
    rng = random.Random(8)
    pages = [(i, f"http://h{i}.net/é", "".join(rng.choice("abé中🙂\r\n WARC/1.1\r\n\r\n0\r\n")
                                               for _ in range(rng.choice([0, 5, 900, 5000]))))
             for i in range(40)]
    pages += [(100 + i, None, "same " * 300) for i in range(6)] + [(200, "u\r\nX: y", None),
                                                                   (201, "", ""), (100, None,
                                                                                   "same " * 300),
                                                                   (None, "x", "same " * 300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    path = tempfile.mkdtemp() + "/w"
    warc.write_archives(df, path, segment, chunk, records_a_file=7)
    got = warc.read_archives(spark, path).collect()
    assert all(r.error is None for r in got)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got), key=repr) == expected(pages)
    stored = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    for p, _, h in pages:
        if p in stored:
            assert stored[p] == (h or "").encode()


def test_broken_segments_are_reported(spark):
    parts = [warc.record_texts(1, "u", "x" * 5000, hashlib.sha1(b"x" * 5000).hexdigest(), None,
                               None, 1000, 400, "a"),
             warc.record_texts(2, "u", "y" * 5000, hashlib.sha1(b"y" * 5000).hexdigest(), None,
                               None, 1000, 400, "b"),
             warc.record_texts(3, "u", "z" * 10, hashlib.sha1(b"other").hexdigest(), None, None,
                               1000, 400, "c")]
    one, two, three = (list(p) for p in parts)
    del one[2]
    two[-1] = two[-1].replace("Total-Length: ", "Total-Length: 1")
    folder = tempfile.mkdtemp()
    text = "".join(t + "\r\n\r\n" for t in one + two + three) + "WARC/1.1\r\nbroken"
    with gzip.open(f"{folder}/a.gz", "wb") as f:
        f.write(text.encode())
    got = {(r.page_id, r.error) for r in warc.read_archives(spark, folder).collect()}
    assert got == {(1, "segments missing"), (2, "total length differs"),
                   (3, "payload digest differs"), (None, "no record header")}


def test_bad_chunks():
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    assert warc.decode_http(head + b"3\r\nabc\r\n0\r\n\r\n") == (b"abc", None)
    assert warc.decode_http(head + b"3;x=1\r\nabc\r\nzz")[1] == "bad chunk size"
    assert warc.decode_http(head + b"9\r\nabc\r\n0\r\n\r\n")[1] == "short chunk"
    assert warc.decode_http(b"no header")[1] == "no HTTP header"


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string, records string")
    path = tempfile.mkdtemp() + "/w"
    warc.write_archives(df, path)
    assert warc.read_archives(spark, path).count() == 0


def test_revisits_refer_to_a_record_of_the_archive(spark):
    """Also for a payload of several segments, and for a repeated row."""
    pages = [(i, "u", "same " * 900) for i in range(5)] + [(4, "u", "same " * 900),
                                                           (9, "u", "long " * 9000),
                                                           (8, "u", "long " * 9000),
                                                           (7, "u", "only " * 9000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn(
        "digest", F.lit("x")).withColumn("copies", F.lit(1)).repartition(4)
    path = tempfile.mkdtemp() + "/w"
    warc.write_archives(df, path, 1000, 400)
    refers, ids, types = [], [], {}
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect():
        for head, _ in warc.parse_records(gzip.decompress(r.content)):
            ids.append(head["warc-record-id"])
            types[head["warc-record-id"]] = head["warc-type"]
            refers += [head["warc-refers-to"]] if "warc-refers-to" in head else []
    assert len(refers) == 5 and set(refers) == {"<urn:page:4>", "<urn:page:9>"}
    assert all(types[x] == "response" for x in refers)
    assert len(ids) - len(set(ids)) == 1            # only the repeated row repeats its id
    got = warc.read_archives(spark, path).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got), key=repr) == expected(pages)
    assert all(r.error is None for r in got)


def test_a_very_large_payload_and_clashing_columns(spark):
    unit = F.concat(F.lit("0123456789abcde"), F.col("page_id").cast("string"))
    df = spark.createDataFrame([(1, "u"), (2, "v")], "page_id long, url string").withColumn(
        "html", F.when(F.col("page_id") == 1, F.repeat(unit, 2 << 20)))            # 32 MB
    for name in ("bytes", "stored", "refers_to", "n", "payload", "origin", "number"):
        df = df.withColumn(name, F.lit("x"))
    path = tempfile.mkdtemp() + "/w"
    warc.write_archives(df, path)
    got = {r.page_id: r for r in warc.read_archives(spark, path, with_payload=False).collect()}
    assert got[1].payload_bytes == 32 << 20 and got[1].error is None
    assert got[1].payload_digest == hashlib.sha1(b"0123456789abcde1" * (2 << 20)).hexdigest()
    assert got[2].payload_bytes == 0 and got[2].record_type == "response"
