import hashlib

import numpy as np
import pytest

from cohortlens.llm import bpe

from .small import odd_documents, save


def test_encode_and_decode_whole_texts(spark, tmp_path):
    rows = odd_documents()
    out = {r.doc_id: r for r in bpe.op1_byte_bpe(spark, save(spark, tmp_path, rows)).collect()}
    enc = bpe._encoding(bpe.public_tokenizers.path(bpe.RANKS), bpe.public_tokenizers.PATTERN)
    assert len(out) == len({r[0] for r in rows})
    for i, text, *_ in rows:
        ids = enc.encode_ordinary(text or "")
        assert out[i].n_tokens == len(ids)
        assert out[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("limit", [1, 7, 50])
def test_safe_pieces_keep_the_ids(limit):
    enc = bpe._encoding(bpe.public_tokenizers.path(bpe.RANKS), bpe.public_tokenizers.PATTERN)
    for text in ["It's 12 o'clock,\n\n  they'll   say... 3x4 don't", "a" * 300, "日本語。テキスト、です" * 9, " \n\t " * 40 + "x", "über-éa 10%\r\n" * 20]:
        pieces = bpe.safe_pieces(text, limit)
        assert "".join(pieces) == text
        assert bpe.encode_text(text, enc, limit).tolist() == enc.encode_ordinary(text)


def test_decoding_joins_raw_bytes_and_refuses_unknown_ids(spark):
    table = bpe._token_bytes(bpe.public_tokenizers.path(bpe.RANKS))
    enc = bpe._encoding(bpe.public_tokenizers.path(bpe.RANKS), bpe.public_tokenizers.PATTERN)
    ids = np.array(enc.encode_ordinary("naïve 日本"), "<u4")
    assert bpe.decode_ids(ids, table).decode() == "naïve 日本"
    assert bpe.decode_ids(ids[:1], table) + bpe.decode_ids(ids[1:], table) == "naïve 日本".encode()
    with pytest.raises(ValueError):
        bpe.decode_ids(np.array([10**6]), table)


def test_ids_array_and_empty_table(spark):
    df = spark.createDataFrame([(1, "hello there", "x"), (2, None, "y")], "doc_id long, text string, ids string")
    coded = bpe.encode(df, keep=("doc_id", "ids"))  # the kept column gives way
    assert coded.columns == ["doc_id", "ids"]
    arrays = {r.doc_id: r.tokens for r in bpe.ids_array(coded).collect()}
    assert len(arrays[1]) == 2 or len(arrays[1]) > 0
    assert arrays[2] == []
    assert bpe.encode(df.limit(0)).count() == 0
