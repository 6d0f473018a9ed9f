import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from innsight.llm import packing, tokens

PATH = tokens.default_path()


def test_encoder_equals_the_library():
    texts = list(pd.read_parquet("/root/testdata/sf0.001/documents.parquet")["text"])
    texts += ["It's DON'T we'll x² ½ µm ÀÉß ÷×  a b", "İstanbul ΑΣ ﬁ é 日本 <|endoftext|>", "<|startoftext|> a", "\x1c\x1d tab\tnew\r\n", "", None, "a" * 5000, "!!!'s's", "­ soft"]
    library = Tokenizer.from_file(PATH)
    encoder = tokens.Encoder(PATH, most=100)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert list(ids) == (library.encode(text, add_special_tokens=False).ids if text else [])


def check(rows, texts, window=2048):
    library = Tokenizer.from_file(PATH)
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(want)
    for i, ids in want.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or (at < window and at & (at - 1) == 0)
    return sequences


@pytest.mark.parametrize("block", [packing.BLOCK_TOKENS, 20_000])
def test_every_id_lies_in_one_piece(spark, block):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    check(packing.pack(docs, block_tokens=block).collect(), {r.doc_id: r.text for r in docs.collect()})


def test_neighbours_share_a_window():
    topics = [np.arange(k * 100, k * 100 + 50, dtype="<u4") for k in range(4)]
    docs = [(i, topics[i % 4]) for i in range(40)]
    packer = packing.Packer(500, 0)
    packer.block(docs)
    packer.finish()
    windows = defaultdict(set)
    for doc_id, *_, sequence, _offset in packer.rows:
        windows[sequence].add(doc_id % 4)
    assert all(len(w) == 1 for w in windows.values())


def test_null_empty_repeated_and_clashing(spark):
    rows = [(1, None), (2, ""), (None, "one two"), (3, "word " * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS start", "8 AS length").coalesce(1)
    check(packing.pack(df).collect(), dict(rows))
    twice = packing.pack(df.where("doc_id = 2").union(df.where("doc_id = 2"))).collect()
    assert sorted((r.start, r.length) for r in twice) == [(0, 1), (0, 1)]
    assert packing.pack(df.limit(0)).collect() == []


def test_neighbours_of_other_tasks_share_a_window(spark):
    topics = ["guitar violin piano trumpet", "granite basalt marble quartz", "salmon trout herring tuna", "maple birch willow cedar"]
    rows = [(k, f"{topics[k % 4]} " * 12) for k in range(80)]
    frames = [spark.createDataFrame(rows[k : k + 4], "doc_id long, text string").coalesce(1) for k in range(0, 80, 4)]
    df = frames[0]
    for f in frames[1:]:
        df = df.union(f)
    sequences = check(packing.pack(df, window=128, block_tokens=1100).collect(), dict(rows), 128)
    full = [{r.doc_id % 4 for r in own} for own in sequences.values() if sum(r.length for r in own) == 128]
    assert len(full) >= 20 and sum(len(w) == 1 for w in full) >= 0.8 * len(full)
