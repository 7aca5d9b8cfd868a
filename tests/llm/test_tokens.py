import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from llm_cases import DOCS, documents, rows
from tokenizers import Tokenizer

from changeflow.llm import piece_bpe, tokenfile, wordcodes
from changeflow.session import work_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ALPHABET = ["a", "B", "the", " ", "\n", "  ", "'s", "1", "é", "ß", " ", "́", "!", "<|endoftext|>", "日", "\t", "\x85", "\x1c", "▁", "İ"]


def fuzz(n=3000):
    rng = random.Random(5)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_word_pieces_give_the_ids_of_the_library(path):
    texts = fuzz() + [t or "" for _, t, *_ in DOCS]
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    encoder = wordcodes.load_library(path)
    for part in (texts[:1500], texts[1500:], texts[:1500]):  # the last one from what is held
        encoder.limit = 100
        ids, offsets = encoder.encode(pa.array(part, pa.large_string()), end=7)
        for i, t in enumerate(part):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids + [7], repr(t)


def test_merge_rounds_give_the_ids_of_sentencepiece():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(3)
    texts = fuzz() + [t or "" for _, t, *_ in DOCS] + ["".join(rng.choices("abehtn ", k=rng.randint(0, 60))) for _ in range(3000)]
    texts += [" " * k + "x" + " " * (20 - k) for k in range(20)] + ["=" * k for k in range(100)] + ["ha" * 50, "the" * 400]
    merges = piece_bpe.Merges(PIECES)
    encoder = wordcodes.PieceIds(merges.encode_many, at_signs=False)
    ids, offsets = encoder.encode(piece_bpe.marked(pa.array(texts, pa.large_string())), end=2)
    for i, t in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == library.encode(t) + [2], repr(t)


def test_piece_query_and_round_trip(spark):
    docs = documents(spark, clash=True)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = []
    for i, t, *_ in DOCS:
        ids = library.encode(t or "") + [library.eos_id()]
        expected.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert rows(piece_bpe.encode_texts(docs, PIECES, digest=True)) == sorted(expected, key=repr)
    back = piece_bpe.decode_ids(piece_bpe.encode_texts(docs, PIECES), PIECES)
    assert rows(back) == sorted(((i, (t or "").replace("▁", " ")) for i, t, *_ in DOCS), key=repr)
    assert piece_bpe.encode_texts(documents(spark, []), PIECES).count() == 0


@pytest.mark.parametrize("n", [1, 2, 31, 33, 5000, 70_000, 300_000])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_000).astype(np.int32)
    row = tokenfile.encode_segment(ids) | {"n_tokens": n}
    assert (tokenfile.decode_segment(row) == ids).all()
    blocks, steps, _ = tokenfile.shape(n)
    if blocks > 2:  # blocks are read on their own
        size = steps * tokenfile.LANES
        assert (tokenfile.decode_segment(row, 1, 2) == ids[size:2 * size]).all()
        assert len(row["words"]) < 2 * n


def test_rans_with_all_ids_once_and_one_id_only():
    for ids in (np.arange(60_000, dtype=np.int32), np.full(70_000, 9, np.int32)):
        row = tokenfile.encode_segment(ids) | {"n_tokens": len(ids)}
        assert (tokenfile.decode_segment(row) == ids).all()


def test_rans_checksum_finds_damage():
    ids = np.arange(1000, dtype=np.int32) % 17
    row = tokenfile.encode_segment(ids) | {"n_tokens": 1000}
    words = bytearray(row["words"])
    words[len(words) // 2] ^= 1
    with pytest.raises(ValueError):
        tokenfile.decode_segment(row | {"words": bytes(words)})


def test_token_files(spark, monkeypatch):
    path = work_dir(spark, "t")
    tokenfile.write_tokens(documents(spark, clash=True), WORDS, path)
    got = tokenfile.read_documents(spark, path, ids=True).collect()
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    expected = sorted((-1 if i is None else i, tuple(library.encode(t or "", add_special_tokens=False).ids + [1])) for i, t, *_ in DOCS)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], tuple(r["ids"])) for r in got) == expected
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):  # gapless, ascending ids
        assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order)
    empty = work_dir(spark, "t")
    tokenfile.write_tokens(documents(spark, []), WORDS, empty)
    assert tokenfile.read_documents(spark, empty).count() == 0
