from __future__ import annotations

import json
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.data import frame, odd_rows
from uidloom.llm import textops, token_count

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as f:
        return token_count.Counter(f.read())


def same(counter, library, texts):
    chunks = textops.chunks(pa.array(texts, pa.string()), token_count.CHUNK_BYTES)
    got = np.concatenate([counter.count(c) for c in chunks]).tolist()
    assert got == [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_letters_marks_white_space_and_endings(counter, library):
    rng = random.Random(1)
    alphabet = "ab re've'll's't'd'm\n\t  \r!?-_'0129éßñ 日本ーĀ𝄞  　ſ½ⅷ́\x1c\x00"
    same(counter, library, ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(6000)])


def test_all_sequences_of_a_few_code_points(counter, library):
    from itertools import product

    same(counter, library, ["".join(p) for k in range(6) for p in product(" 'lr\n", repeat=k)])


def test_added_tokens_inside_texts(counter, library):
    parts = ["a", "<|endoftext|>", "'re", "!'s", "  ", "\n\n", "'lll", "<|endoftext", "|>"]
    rng = random.Random(2)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 10))) for _ in range(4000)]
    same(counter, library, [*texts, "", None, "<|endoftext|>", "<|endof", "text|>"])


def test_each_kind_of_code_point(counter, library):
    codes = [c for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    same(counter, library, [f"a{chr(c)}b 1{chr(c)}2 !{chr(c)}" for c in codes])


def test_long_texts_in_sections(counter, library, monkeypatch):
    monkeypatch.setattr(token_count, "CHUNK_BYTES", 500)
    rng = random.Random(3)
    words = ["don't", "  ", "\n", "word", "日本語", "x" * 700, " " * 900, "<|endoftext|>", "'ll", "!!", "9" * 40]
    for k in range(20):
        text = "".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(400))
        same(counter, library, [text, "short", None])
    for one in ("a" * 3000, " " * 3000, "<|endoftext|>" * 200, "'re" * 1000, "\n " * 1500):
        same(counter, library, [one])


def test_forgetting_states_changes_nothing(counter, library, monkeypatch):
    monkeypatch.setattr(token_count, "MOST_STATES", 50)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(300)]
    for low in range(0, 300, 50):
        same(counter, library, texts[low : low + 50])


def test_maps_of_chunks_compose_like_one_run_after_the_other():
    rng = np.random.default_rng(5)
    kinds = rng.integers(0, token_count.N_CLASSES, 3001).astype(np.uint8)
    kinds[0] += token_count.FIRST
    state, flags = token_count.BEGIN, []
    for k in kinds.tolist():
        flags.append(bool(token_count._STARTS[k, state]))
        state = int(token_count._FOLLOW[k, state])
    assert token_count.start_flags(kinds).tolist() == flags


def test_rows_of_a_table(spark, library):
    rows = odd_rows()
    df = token_count.count_tokens(frame(spark, rows), PATH, limit=5)
    assert df.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = []
    for doc, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc, len((text or "").encode()), n, n > 5))
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(expected, key=repr)
    assert token_count.count_tokens(frame(spark, []), PATH).collect() == []


def test_a_tokenizer_that_it_cannot_compile_is_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        with pytest.raises(ValueError):
            token_count.Counter(f.read())
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError):
        token_count.Counter(json.dumps(spec))


def test_tokens_that_may_follow_each_other_are_those_that_merging_leaves_apart(counter):
    merges = counter.transducer.merges
    assert merges.in_order
    rng = random.Random(6)
    tokens = [t for t in merges.token if t is not None]
    parts = [(a, b) for a, b in merges.rank]
    for k in range(6000):
        last, token = rng.choice(parts) if k % 3 == 0 else (rng.choice(tokens), rng.choice(tokens))
        if k % 3 == 1:
            token = rng.choice([last, last[-1:], last[:1], token[:1]])
        if merges.encode(last) == [last]:
            assert merges.may_follow(last, token) == (merges.encode(last + token) == [last, token])


def test_rules_out_of_order_are_followed_by_merging():
    merges = token_count.Merges({"a": 0, "b": 1, "ab": 2, "abab": 3, "ba": 4}, ["ab ab", "a b", "b a"])
    assert not merges.in_order
    for last in (b"a", b"b", b"ab", b"ba"):
        for token in (b"a", b"b", b"ab", b"ba"):
            assert merges.may_follow(last, token) == (merges.encode(last + token) == [last, token])
