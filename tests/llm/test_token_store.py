import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohortlens.llm import mixing_coder as mix
from cohortlens.llm import token_store as store

from .small import mirrored_words, odd_documents, save


def round_trip(ids, block=mix.BLOCK):
    ids = np.asarray(ids)
    freq = mix.order0(np.bincount(ids, minlength=1))
    blocks = [ids[i : i + block] for i in range(0, len(ids), block)]
    codes = mix.encode_blocks(blocks, freq)
    back = mix.decode_blocks(codes, np.array([len(b) for b in blocks]), freq)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))
    return sum(map(len, codes))


@pytest.mark.parametrize("seed", range(6))
def test_coder_round_trip(seed):
    rng = np.random.default_rng(seed)
    for ids in (
        rng.integers(0, 65535, 3000),
        np.minimum(rng.zipf(1.2, 4000), 49407),
        np.full(2500, 49407),
        np.tile(rng.integers(0, 300, 17), 200),
        np.array([5]),
        np.concatenate([np.full(700, 3), rng.integers(0, 60000, 200), np.full(700, 3)]),
    ):
        round_trip(ids, int(rng.integers(1, 900)))
    assert mix.encode_blocks([], np.zeros(0, np.int64)) == []


def test_contexts_beat_order0():
    rng = random.Random(1)
    words = [[rng.randrange(2000) for _ in range(rng.randint(2, 6))] for _ in range(150)]
    ids = np.array([i for _ in range(6000) for i in rng.choice(words)])
    share = np.bincount(ids) / len(ids)
    order0 = -np.sum(share[share > 0] * np.log2(share[share > 0])) / 8 * len(ids)
    assert round_trip(ids) < 0.65 * order0


def test_file_round_trip_and_checksum():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 500, 20000)
    content = store.file_bytes([None, 3, 9], np.array([1, 0, 19999]), ids)
    docs, lengths, back = store.read_file(content)
    assert docs == [None, 3, 9] and lengths.tolist() == [1, 0, 19999] and np.array_equal(back, ids)
    spoilt = bytearray(content)
    spoilt[-9] ^= 1
    with pytest.raises(ValueError):
        store.read_file(bytes(spoilt))
    with pytest.raises(ValueError):
        store.read_file(b"x" * 60)


def expected(rows):
    k = store._tokenizer(store.public_tokenizers.path(store.VOCABULARY))
    out, start = [], 0
    for i, text, *_ in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] or "")):
        ids = np.array(k.encode(text or "", add_special_tokens=False).ids + [store.END], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_reads_the_files_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "FILE_IDS", 5000)
    rows = odd_documents() + [(70, "It's İstanbul ΣΑΣ <|endoftext|>   é ́x", None, None), (71, None, None, None)]
    out = store.op6_mixing_coder(spark, save(spark, tmp_path, rows)).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out) == sorted(expected(rows))


def test_null_ids_repeated_rows_and_empty(spark, tmp_path):
    rows = [(None, "b c", None, None), (2, "x", None, None), (2, "x", None, None), (2, "a", None, None), (1, "", None, None)]
    out = store.op6_mixing_coder(spark, save(spark, tmp_path / "a", rows)).collect()
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out), key=key) == sorted(expected(rows), key=key)
    assert store.op6_mixing_coder(spark, save(spark, tmp_path / "b", [])).count() == 0


#: Upper-case letters without a composed form, whose lower-case ones have one.
DECOMPOSED = ["H\u0331amza", "J\u030c", "T\u0308.", "W\u030aX", "abc Y\u030a", "H\u0331. J\u030c! ΣΑΣ", "Don'T STOP. É E\u0301 X1."]


def ids_of(texts):
    """Ids and lengths of the texts by the store, and by the library on each whole text."""
    path = store.public_tokenizers.path(store.VOCABULARY)
    library = Tokenizer.from_file(path)
    whole = [library.encode(t, add_special_tokens=False).ids + [store.END] for t in texts]
    ids, n = store.encode_texts(pa.array(texts), store.WordIds(path))
    ends = np.cumsum(n)
    return [ids[e - k : e].tolist() for e, k in zip(ends, n)], whole


def test_letters_compose_before_case_is_lowered():
    found, whole = ids_of(DECOMPOSED)
    assert found == whole
    assert whole[0] == [327, 136, 365, 548, 2186, store.END]


def test_added_tokens_as_in_the_library():
    plain = "x <|ENDOFTEXT|> y"
    texts = ["x <|endoftext|> y", plain, "A<|endoftext|>B.", "<|startoftext|>", "<|EndOfText|>. <|endoftext|>.", "H\u0331<|startoftext|>\u0331", "<", "|endoftext|>"]
    found, whole = ids_of(texts)
    assert found == whole
    assert whole[0] == [343, 49407, 344, store.END] and len(whole[1]) > 4
    assert all(t["content"].startswith(store._ADDED.decode()) for t in added_tokens())


def added_tokens():
    with open(store.public_tokenizers.path(store.VOCABULARY)) as f:
        return json.load(f)["added_tokens"]


def test_pieces_are_the_librarys():
    """Random strings of letters, digits, marks, apostrophes, accents and other scripts, as the library cuts them."""
    rng = random.Random(3)
    atoms = ["a", "B", "it's", "'", "''", "'S", "'re", "'VE", "'ll", "'lx", "'d", "'é", "s", "t", "7", "42", "é", "É", "ß", "×", "÷", "ÿ", "À", "Þ", "́", "ª", "µ", "²", " ", " ", "œ", "Σ", "日", "!", "***", "...", "-", "\x00", "\x1f", "\x7f", "<", "|", "<|", "\u0085", "𝟐", " ", " ", "\n", "\t"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += ["'s", "s's", "'", "don't", "x'", "'ll'll", "'re", "'r", "'v", "we've'd", "É's", "''s", "1's", "a" * 5000, "é" * 3000, "7" * 2000, "it's" * 500, ""]
    found, whole = ids_of(texts)
    assert found == whole


def test_words_of_one_hash_are_told_apart(monkeypatch):
    """With a hash that is the same for all, pieces are still compared as bytes."""
    monkeypatch.setattr(store, "byte_hash", lambda raw, start, end: np.zeros(len(start), np.uint64))
    found, whole = ids_of(["alphabetical beta alphabetical", "beta, alphanumeric! longerwords otherwords", ""])
    assert found == whole
    monkeypatch.setattr(store, "_names", lambda raw, start, end: np.zeros(len(start), np.uint64))
    found, whole = ids_of(["alpha beta alpha", "beta, gamma!", ""])
    assert found == whole


@pytest.mark.parametrize("n", [512, 1024, 2048])
def test_mirrored_words(n):
    """Two words that every polynomial modulo 2**64 takes for one."""
    found, whole = ids_of(list(mirrored_words(n)))
    assert found == whole and found[0] != found[1]
