import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from logweave.llm.packing import Encoder, Packer, pack, packed_digest

SF = "/root/testdata/sf0.01"


def whole():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_tokenizers(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["", " ", "a ", " a", "a  b", "a\n\nb", "a \nb", "a\n b", "\n", "x\n", "\tx y", "it's we'll", "<|endoftext|> a <|endoftext|>", "a\x00b c", "é b 　c", "a\r\nb", "1 2 34,5!"]
    encode, plain = Encoder(), whole()
    for t in texts:
        assert encode(t).tolist() == plain.encode(t, add_special_tokens=False).ids


def check(rows, docs, size=1024):
    plain = whole()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    want = {}
    for doc_id, text in docs:
        want.setdefault(doc_id, []).append(plain.encode(text or "", add_special_tokens=False).ids + [0])
    assert set(by_doc) == set(want)
    for doc_id, ids in want.items():
        if len(ids) == 1:
            at = 0
            for r in sorted(by_doc[doc_id], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids[0]) and r.length > 0
                assert r.ids_crc32 == zlib.crc32(np.array(ids[0][at : at + r.length], "<u4").tobytes())
                at += r.length
            assert at == len(ids[0])
        else:
            assert sum(r.length for r in by_doc[doc_id]) == sum(map(len, ids))
    lengths = []
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        lengths.append(at)
    assert max(lengths) <= size and sum(n < size for n in lengths) <= 1
    return lengths


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(packed_digest(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_many_partitions_and_edge_cases(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "x", "Zürich"]) for _ in range(rng.choice([0, 1, 5, 90, 700, 3000])))) for i in range(200)]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "twice"), (502, "twice"), (503, "long " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'a' as ids", "1 as start").repartition(7)
    out = packed_digest(docs)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check(out.collect(), rows)
    assert pack(docs).columns[3] == "ids"


def test_empty(spark):
    assert packed_digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_partitions_without_a_full_window(spark):
    for rows in ([(1, "a short text")], [(1, None)], [(None, None), (2, ""), (3, "x")], [(i, f"text number {i}") for i in range(40)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        check(packed_digest(docs).collect(), rows)


def test_partition_whose_last_row_flushes(spark, monkeypatch):
    from logweave.llm import packing

    monkeypatch.setattr(packing, "FLUSH_PIECES", 1)
    rows = [(1, "word " * 40), (2, "word " * 3000)]  # the last row fills windows, which are passed on at once
    pieces = run_pack(packing, rows)
    assert pieces and all(b.num_rows and b.schema.equals(pieces[0].schema) for b in pieces)
    assert sum(sum(b.column("length").to_pylist()) for b in pieces) == sum(len(whole().encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)


def run_pack(packing, rows):
    import pyarrow as pa
    from pyspark import TaskContext

    class Here:
        @staticmethod
        def partitionId():
            return 0

    old, TaskContext.get = TaskContext.get, staticmethod(lambda: Here)
    try:
        return list(packing._pack(packing.VOCABULARY, 64, 4, 0)(iter([pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], names=["doc_id", "text"])])))
    finally:
        TaskContext.get = old


def test_packer_is_best_fit_in_bounded_space():
    p = Packer(size=100, limit=3)
    for doc, n in enumerate([60, 50, 45, 40, 30]):
        p.add(doc, np.zeros(n, np.uint32))
    # 45 joins 50 (room 50 is the least that takes it), 40 fills 60, 30 opens a window
    assert [(x[0][0], x[1]) for x in p.done] == [(0, 0), (3, 0)]
    assert sorted(f for f, _ in p.room) == [5, 70]
    p.add(9, np.zeros(250, np.uint32))
    assert len(p.room) <= 3
    p.add(10, np.zeros(99, np.uint32))
    assert [f for f, _ in p.room] == [1, 5, 20]
    p.add(11, np.zeros(99, np.uint32))  # none fits: the fullest is topped up and emitted
    assert [f for f, _ in p.room] == [2, 5, 20] and sum(x[0][0] == 11 for x in p.done) == 1
