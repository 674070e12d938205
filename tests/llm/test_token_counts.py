import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import queries, token_counts, tokenizing
from ledgerloom.llm.token_counts import counter
from ledgerloom.llm.tokenizing import TextEncoder
from ledgerloom.llm.wordcode import mixed, piece_codes

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")


def library(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text or ""))
    plain = Tokenizer.from_file(path)
    return lambda text: len(plain.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    return counter(public_tokenizers.path(request.param)), library(request.param)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|end", " ", "\n", "a", "Word", "é", "中", ".", "'s", "  ", "7"]), max_size=12).map("".join), max_size=5))
def test_counts_equal_the_library(pair, texts):
    count, plain = pair
    assert count([t.encode() for t in texts]).tolist() == [plain(t) for t in texts]


def test_long_texts_are_cut_safely(pair, texts, monkeypatch):
    """Parts of some dozens of bytes add up to the count of the text."""
    count, plain = pair
    monkeypatch.setattr(token_counts, "RUN", 64)
    some = list(texts.values())[:30] + ["x" * 500, "中文" * 90, " " * 300, "a. b, " * 60, "<|endoftext|>" * 9 + "é." * 70]
    assert count([t.encode() for t in some]).tolist() == [plain(t) for t in some]


@pytest.mark.parametrize("name", FILES[:2])
def test_parts_are_the_text(name):
    encoder, text = TextEncoder(public_tokenizers.path(name)), ("some words, and. more\nlines " * 40 + "中" * 50).encode()
    parts = list(encoder.split(text, 50))
    assert b"".join(parts) == text and len(parts) > 10 and list(encoder.split(b"", 50)) == [b""]


def test_query_equals_the_library(spark, sf_dir, texts):
    plain = library("byte_bpe_50k.json")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op11_token_counts(spark, sf_dir).collect()}
    assert got == {i: (len((t or "").encode()), plain(t), plain(t) > 1024) for i, t in texts.items()}


def test_odd_rows(spark, hard, empty, clashing):
    path, plain = public_tokenizers.path("byte_bpe_50k.json"), library("byte_bpe_50k.json")
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), plain(r.text)) for r in hard.collect())
    for df in (hard, clashing):
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(df, path).collect()) == want
    assert token_counts.token_counts(empty, path).collect() == []


def clashing_words():
    """Two words of sixteen letters, different but under one code of `piece_codes`: their second halves make up for their first ones."""
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    halves = letters[rng.integers(0, 26, (2, 4_000_000, 8))].copy().view("<u8")[:, :, 0]
    factor = np.uint64(0x9E3779B97F4A7C15)
    first, second = (mixed(np.uint64(16) * factor + h) * factor for h in halves)
    gap = first - second  # what the second word's second half has to have more than the first one's
    borrow, low, ok = np.zeros(len(gap), np.int64), [], np.ones(len(gap), bool)
    for i in range(8):
        step = (gap >> np.uint64(8 * i) & np.uint64(255)).astype(np.int64) + borrow
        step, borrow = np.where(step >= 128, step - 256, step), (step >= 128).astype(np.int64)
        ok &= np.abs(step) <= 25
        low.append(step)
    at = int(np.flatnonzero(ok)[0])
    ends = [97 + max(0, -int(s[at])) for s in low]
    one = halves[0, at].tobytes() + bytes(ends)
    two = halves[1, at].tobytes() + bytes(e + int(s[at]) for e, s in zip(ends, low, strict=True))
    return one, two


def test_words_under_one_code():
    """A code says where to look; what is found there is compared."""
    words = clashing_words()
    codes = piece_codes(b"".join(words), np.array([0, 16]), np.array([16, 16]))
    assert words[0] != words[1] and codes[0] == codes[1]
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for order in (words, words[::-1]):
        texts = [order[0], order[1], b"x. " + order[1] + b"," + order[0], b"-" * 100, b"-" * 101]
        ids, n = TextEncoder(public_tokenizers.path("byte_bpe_50k.json")).encode_many(texts)
        want = [plain.encode(t.decode(), add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for w in want for i in w] and n.tolist() == [len(w) for w in want]


def test_the_table_grows_while_codes_clash():
    words = clashing_words()
    encoder = TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.table.bits = 3
    encoder.table.clear()
    texts = [words[0], *(f"w{'abcdefghij'[i % 10]}{'k' * (i // 10)}".encode() for i in range(200)), words[1], words[0]]
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for _ in range(2):
        assert encoder.count_many(texts).tolist() == [len(plain.encode(t.decode(), add_special_tokens=False).ids) for t in texts]


def test_counts_of_a_table_begun_anew(monkeypatch):
    """A fuller table is dropped between runs; counts are those of the new one."""
    monkeypatch.setattr(tokenizing, "PIECES", 20)
    encoder, plain = TextEncoder(public_tokenizers.path("byte_bpe_50k.json")), library("byte_bpe_50k.json")
    for i in range(6):
        texts = [f"{'abcdefghijklmnop'[(i + j) % 16]}x{'qwertz'[i]} and{'yz' * j} unbelievably{j}, " for j in range(30)]
        assert encoder.count_many([t.encode() for t in texts]).tolist() == [plain(t) for t in texts]


def test_a_table_takes_memory_by_what_it_holds():
    """Each worker keeps one from stage to stage: some 100 bytes a piece, whatever it may grow to."""
    encoder, plain = TextEncoder(public_tokenizers.path("word_bpe_49k.json")), library("word_bpe_49k.json")
    texts = [" ".join(f"w{i}q{j}" for j in range(400)) for i in range(100)]
    assert encoder.count_many([t.encode() for t in texts]).tolist() == [plain(t) for t in texts]
    arrays = [x for x in vars(encoder.table).values() if hasattr(x, "nbytes")]
    assert encoder.table.held >= 40_000 and sum(x.nbytes for x in arrays) < 8 << 20
