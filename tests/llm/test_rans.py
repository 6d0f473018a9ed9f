import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from innsight.llm import rans, tokens


@pytest.mark.parametrize("n,size,lanes,every", [(0, 3, 4, 2), (1, 1, 8, 4), (5_000, 700, 16, 50), (100_003, 49_000, 512, 64), (777, 2, 5, 10)])
def test_round_trip_from_every_checkpoint(n, size, lanes, every):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % size).astype(np.uint32)
    table = rans.Table(np.bincount(ids, minlength=size))
    assert int(table.freq.sum()) in (0, 1 << table.bits)
    data = rans.to_block([(7, ids[: n // 3]), (None, ids[n // 3 :])], table, lanes, every)
    block = rans.Block(data)
    assert (block.doc_ids, list(block.lengths)) == ([7, None], [n // 3, n - n // 3])
    assert np.array_equal(block.ids(table), ids)
    alone = [block.part(table, k) for k in range(len(block.places))]
    assert np.array_equal(np.concatenate(alone), ids) and len(alone) == max(1, -(-(-(-n // lanes)) // every))
    if n > 1000:
        entropy = -np.sum((p := np.bincount(ids) / n)[p > 0] * np.log2(p[p > 0])) / 8 * n
        assert 4 * len(block.words) < 1.05 * entropy + 8 * lanes
        with pytest.raises(ValueError):
            rans.Block(data[:-1] + bytes([data[-1] ^ 1]))


def test_files_give_back_every_document(spark):
    library = Tokenizer.from_file(tokens.default_path())
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(5)
    extra = spark.createDataFrame([(-4, None), (10**12, ""), (10**13, "long " * 30_000)], "doc_id long, text string")
    docs = rows.union(extra).selectExpr("*", "1 AS start", "2 AS shard")
    want, at = [], 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = (library.encode(r.text, add_special_tokens=False).ids if r.text else []) + [1]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = rans.round_trip(docs).collect()
    assert sorted(map(tuple, got)) == want


def test_null_repeated_and_empty(spark):
    df = spark.createDataFrame([(None, "a b"), (3, "same"), (3, "same"), (2, None)], "doc_id long, text string")
    got = rans.round_trip(df).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(None, 0, 3), (2, 3, 1), (3, 4, 2), (3, 6, 2)]
    assert rans.round_trip(df.limit(0)).collect() == []
