import struct

import pandas as pd
import pytest
import sentencepiece

from innsight.llm import pieces

HARD = ["", " ", "a  b", " a ", "\n\n a\tb", "▁x ▁▁y", "日本　x ﬁ", "\u0000\u0007 ퟿ 🎉🎉 é é", "<s> </s> <unk> <0x41>", "aaaaaaaaaaaaaaaaa " * 3, " " * 50, "a" * 3000, "https://x.y/?q=1&&&&====----____"]


def test_every_id_equals_the_library():
    path = pieces.default_path()
    texts = list(pd.read_parquet("/root/testdata/sf0.001/documents.parquet")["text"]) + HARD
    known, library = pieces.Backend(path), sentencepiece.SentencePieceProcessor(model_file=path)
    got = known.encode(texts)
    want = library.encode(texts)
    assert [x.tolist() for x in got] == want
    assert known.encode([None])[0].tolist() == []
    decoded = known.decode(got)
    assert decoded == [library.decode(x) for x in want]
    assert [d == t for d, t in zip(decoded, texts)] == ["▁" not in t for t in texts]


def test_parity_is_seen_to_fail():
    known = pieces.Backend(pieces.default_path(), verify=True)
    ids = known.encode(["plain words here"])
    assert known.agrees("plain words here", ids[0])
    known.wrong.add("▁words")
    assert not known.agrees("plain words here", ids[0]) and known.agrees("plain", ids[0])


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def varint(x):
    out = b""
    while x > 127:
        out, x = out + bytes([x & 127 | 128]), x >> 7
    return out + bytes([x])


@pytest.mark.parametrize("fallback", [0, 1])
def test_unigram_scores_and_byte_fallback(tmp_path_factory, fallback):
    vocabulary = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256) if fallback]
    vocabulary += [("▁", -2.0, 1), ("▁he", -3.0, 1), ("llo", -3.5, 1), ("▁hello", -7.0, 1), ("h", -5.0, 1), ("e", -5.0, 1), ("l", -5.0, 1), ("o", -5.0, 1), ("lo", -4.0, 1)]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in vocabulary)
    data += message((2, message((3, 1), (35, fallback), (40, 0), (41, 1), (42, 2)))) + message((3, message((1, b"identity"), (3, 1), (4, 1), (5, 1))))
    path = str(tmp_path_factory.mktemp("m") / "unigram.model")
    with open(path, "wb") as file:
        file.write(data)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["hello", "  hello   hell  ", "ole hé o", "lolo", "h☃e"]
    assert [x.tolist() for x in pieces.Backend(path).encode(texts)] == library.encode(texts)


def test_null_repeated_and_clashing(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "One two"), (3, "One two"), (4, "long text " * 50_000)], "doc_id long, text string").selectExpr("*", "1 AS n_tokens", "2 AS pieces")
    got = pieces.with_pieces(df).collect()
    assert len(got) == 5 and all(r.pieces.parity and r.pieces.round_trip for r in got)
    assert {r.doc_id: r.pieces.n_tokens for r in got}[1] == 0
    back = pieces.with_text(pieces.with_ids(df, into="ids"), into="back").collect()
    assert all(r.back == (r.text or "") for r in back)
    assert pieces.with_pieces(df.limit(0)).collect() == []
