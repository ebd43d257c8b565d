from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import AddedToken, Tokenizer

from tests.llm.data import frame, odd_rows
from uidloom.llm import textops, token_output

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    rng = random.Random(3)
    parts = ["a", "B", "é", "ß", "×", "÷", "1", "'", "'s", "'ll", ".", ",", " ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", " ",
             " ", "\x1c", "\x85", "\x0b", "|", "日", "🙂", "$$$", "word", " the", "<|endoftext|>", "_"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5000)] + ["", None]
    encoder = token_output.Encoder(tokenizer.to_str())
    for chunk in textops.chunks(pa.array(texts, pa.string()), 1 << 12):
        ids, counts = encoder.encode(chunk)
        for k, own in enumerate(np.split(ids, np.cumsum(counts)[:-1])):
            text = texts[chunk.first + k] or ""
            assert own.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_files_hold_all_documents_in_order(spark, tmp_path, tokenizer, monkeypatch):
    monkeypatch.setattr(token_output, "PAGE_IDS", 50)
    rows = odd_rows()
    path = str(tmp_path / "tokens")
    token_output.write_tokens(frame(spark, rows), path, PATH)
    found = sorted(map(tuple, token_output.read_tokens(spark, path).collect()), key=lambda r: r[1])
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expected = 0, []
    for doc_id, text in ordered:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == expected


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_output.write_tokens(frame(spark, [(1, "a")]).where("doc_id = 2"), path, PATH)
    assert token_output.read_tokens(spark, path).collect() == []


MARK = "<|endoftext|>"


def same_ids(tokenizer, texts, most):
    encoder = token_output.Encoder(tokenizer.to_str(), encode_special_tokens=False)
    for chunk in textops.chunks(pa.array(texts, pa.string()), most):
        ids, counts = encoder.encode(chunk)
        for k, own in enumerate(np.split(ids, np.cumsum(counts)[:-1])):
            text = texts[chunk.first + k] or ""
            assert own.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("flags", [None, {}, {"lstrip": True}, {"rstrip": True}, {"single_word": True}])
def test_strings_of_added_tokens(flags):
    plain = Tokenizer.from_file(PATH)
    if flags is not None:
        plain.add_tokens([AddedToken("<|end", normalized=False, **flags), AddedToken("word", normalized=False)])
    rng = random.Random(5)
    parts = ["a", "é", "1", "'", "'s", ".", " ", "  ", "\n", "\n\n", "\t", "日", "🙂", "word", " the", MARK, MARK, "<|end", "oftext|>", "|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    texts += ["x<|endof", "text|>y", "", None, "<|end", "oftext|>", MARK, MARK * 3]
    same_ids(plain, texts, 1 << 12)


def test_files_hold_the_ids_of_the_plain_call(spark, tmp_path):
    plain = Tokenizer.from_file(PATH)
    rows = [(1, f"a word {MARK} next"), (2, "two"), (3, MARK), (4, f"end{MARK}"), (5, "<|endof"), (6, "text|>")]
    path = str(tmp_path / "tokens")
    token_output.write_tokens(frame(spark, rows), path, PATH)
    found = sorted(map(tuple, token_output.read_tokens(spark, path).collect()))
    assert plain.encode(rows[0][1], add_special_tokens=False).ids == [64, 1573, 220, 50256, 1306]
    start, expected = 0, []
    for doc_id, text in rows:
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == expected


def alternating(turns):
    word = "a"
    for _ in range(turns):
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_patterns_that_cancel_out_modulo_powers_of_two(spark, tmp_path):
    one = alternating(10)
    two = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one), (2, two), (3, two), (4, one + " " + two)]
    path = str(tmp_path / "tokens")
    token_output.write_tokens(frame(spark, rows), path, PATH)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    found = {r["doc_id"]: r["ids_crc32"] for r in token_output.read_tokens(spark, path).collect()}
    for doc, text in rows:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert found[doc] == zlib.crc32(ids.tobytes())


def test_each_distinct_piece_is_encoded_once(tokenizer):
    one = alternating(10)
    two = one.translate(str.maketrans("ab", "ba"))
    texts = [" ".join([one, two, "word", "w" * 15, "w" * 16, "a" * 8, "a"] * 50)] * 3

    class Counted:
        def __init__(self):
            self.asked = []

        def encode_batch_fast(self, pieces, add_special_tokens):
            self.asked += pieces
            return tokenizer.encode_batch_fast(pieces, add_special_tokens=add_special_tokens)

    encoder = token_output.Encoder(tokenizer.to_str())
    encoder.tokenizer = Counted()
    for chunk in textops.chunks(pa.array(texts), 1):
        ids, _ = encoder.encode(chunk)
        assert ids.tolist() == tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert len(encoder.tokenizer.asked) == len(set(encoder.tokenizer.asked)) < 20


def test_pieces_forgotten_and_looked_up_in_portions(tokenizer, monkeypatch):
    monkeypatch.setattr(token_output, "MOST_PIECES", 8)
    monkeypatch.setattr(token_output, "CACHED_PIECES", 20)
    monkeypatch.setattr(token_output, "CACHED_BYTES", 100)
    monkeypatch.setattr(token_output, "SLOT_BITS", 5)  # 32 slots for 28 pieces, so most share one
    rng = random.Random(7)
    parts = ["a", "a\0", "a\0\0", "\0", "b" * 7, "b" * 8, "b" * 15, "b" * 16, "b" * 15 + "\0", "日" * 5, "日" * 9, "c", "dd", " ", "\n", ".", "1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    encoder = token_output.Encoder(tokenizer.to_str())
    for chunk in textops.chunks(pa.array(texts), 500):
        ids, counts = encoder.encode(chunk)
        for k, own in enumerate(np.split(ids, np.cumsum(counts)[:-1])):
            assert own.tolist() == tokenizer.encode(texts[chunk.first + k], add_special_tokens=False).ids


def test_pages_are_read_without_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "PAGE_IDS", 50)
    path = str(tmp_path / "tokens")
    token_output.write_tokens(frame(spark, [(k, "some words " * 20) for k in range(30)]), path, PATH)
    plan = token_output.read_tokens(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan and "Join" not in plan
