"""Operator 11: exact round trips of blocks, segments and files."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from visitlens.llm import pfor, token_files
from visitlens.llm.queries import op11_token_files, tokenizer_json
from visitlens.session import scratch_dir
from edge_rows import edge_docs, no_docs  # noqa: F401


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_str(tokenizer_json())


@pytest.mark.parametrize("block", [32, 96, 1024])
def test_blocks_round_trip(block):
    rng = np.random.default_rng(block)
    for n in (0, 1, 31, block, block + 1, 5 * block + 7):
        for ids in (rng.integers(0, 2**32, n), rng.zipf(1.3, n) % 49_408, np.full(n, 2**32 - 1),
                    np.where(rng.random(n) < 0.02, 2**32 - 1, rng.integers(7, 40, n)),
                    rng.integers(0, 2, n)):
            ids = ids.astype(np.uint32)
            data, starts = pfor.encode(ids, block)
            assert len(starts) == -(-n // block) + 1 and starts[-1] == len(data)
            assert (pfor.decode(data, starts[:-1], block)[:n] == ids).all()


def test_outliers_go_to_the_exception_list():
    ids = np.full(1024, 100, np.uint32)
    ids[::2] += 3
    ids[[5, 77]] = 40_000
    data, starts = pfor.encode(ids)
    # 2 bits a number, two exceptions of 6 bytes
    assert len(data) == pfor.HEAD + 1024 * 2 // 8 + 2 * 6
    assert (pfor.decode(data, starts[:-1]) == ids).all()
    skewed = (np.random.default_rng(1).zipf(1.5, 1 << 16) % 49_408).astype(np.uint32)
    assert len(pfor.encode(skewed)[0]) < 0.7 * 2 * len(skewed)


def test_segment_reads_any_range_by_its_index():
    rng = np.random.default_rng(2)
    counts = np.array([1, 5000, 3, 1, 2500])
    ids = (rng.zipf(1.2, counts.sum()) % 49_408).astype(np.uint32)
    data = token_files.segment(3, 17, ids, pa.array([None, -4, 0, 9, 9], pa.int64()), counts)
    for tail in (b"", b"\n"):
        seg = token_files.Segment(data + tail)
        assert (seg.part, seg.before, seg.n_ids) == (3, 17, len(ids))
        assert seg.table["doc_id"].tolist() == [0, -4, 0, 9, 9]
        assert seg.table["null"].tolist() == [1, 0, 0, 0, 0]
        assert seg.table["n"].tolist() == counts.tolist()
        for a, b in ((0, len(ids)), (0, 1), (1023, 1025), (4096, 4097), (7000, 10**9), (9, 9)):
            assert (seg.block_range(a, b) == ids[a:b]).all()
    # a range touches its own blocks alone
    seg.data = seg.data.copy()
    seg.data[seg.starts[0]:seg.starts[2]] = 255
    assert (seg.block_range(2048, 4000) == ids[2048:4000]).all()


@pytest.fixture
def all_partitions(spark):
    """Small inputs keep their partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _want(tokenizer, docs):
    """Brute force: (doc_id, start, n, crc) in ascending doc_id order, ties in any order."""
    out, start = [], 0
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_hold_all_ids_in_doc_id_order(spark, tokenizer, all_partitions):
    rng = random.Random(6)
    docs = [(i * 3 - 90, " ".join(rng.choice(["tree", "Haus.", "éé,", "x" * 9])
                                  for _ in range(rng.choice([0, 3, 30, 300]))))
            for i in range(200)] + [(None, "no id"), (-1, None), (-2, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    path = scratch_dir(spark, "token-files-test")
    token_files.write_token_files(df, path, tokenizer_json(), segment_ids=3000)
    rows = token_files.read_token_files(spark, path).cache()
    assert rows.select("part").distinct().count() > 1
    assert spark.read.format("binaryFile").load(path).where("length > 0").count() > 8
    got = token_files.with_starts(rows, chunk=2).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == _want(tokenizer, docs)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)


def test_a_hot_doc_id_is_dealt_over_partitions(spark, tokenizer, all_partitions):
    docs = [(7, f"copy {i % 50} of a text") for i in range(3000)] + [(i, "a") for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    path = scratch_dir(spark, "token-files-hot")
    token_files.write_token_files(df, path, tokenizer_json())
    rows = token_files.with_starts(token_files.read_token_files(spark, path, False)).cache()
    assert rows.where("doc_id = 7").select("part").distinct().count() > 4
    ends = rows.orderBy("start").collect()
    assert [r.doc_id for r in ends] == sorted(r.doc_id for r in ends)
    at = 0
    for r in ends:
        assert r.start == at
        at += r.n_tokens
    assert sorted(r.ids_crc32 for r in ends) == sorted(c for *_, c in _want(tokenizer, docs))


def test_edge_rows(spark, edge_docs, no_docs, tokenizer):
    got = token_files.token_digests(edge_docs, scratch_dir(spark, "tf"), tokenizer_json())
    want = _want(tokenizer, [(r.doc_id, r.text) for r in edge_docs.collect()])
    key = lambda r: (r[0] is not None, r[0], r[2:])
    assert sorted(((r.doc_id, 0, r.n_tokens, r.ids_crc32) for r in got.collect()), key=key) == \
        sorted(((d, 0, n, c) for d, _, n, c in want), key=key)
    assert token_files.token_digests(no_docs, scratch_dir(spark, "tf"),
                                     tokenizer_json()).count() == 0


def test_query_equals_brute_force(spark, tokenizer):
    docs = [(r.doc_id, r.text) for r in
            spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = op11_token_files(spark, "/root/testdata/sf0.001").orderBy("start").collect()
    assert [tuple(r) for r in got] == _want(tokenizer, docs)
    assert got[0].asDict().keys() == {"doc_id", "start", "n_tokens", "ids_crc32"}
