import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from stemma.llm import byte_bpe as B


@pytest.fixture(scope="module")
def reference():
    ranks = B.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def slow(ranks, word):
    parts = [bytes([b]) for b in word]
    while True:
        pairs = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, k = min(pairs)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_queue_against_slow_merging():
    """Random rank tables, in which a merge may bring up a lower rank than its own."""
    random.seed(10)
    for _ in range(60):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 256 + 40:
            tokens.add(bytes(random.choice(b"abc") for _ in range(random.randint(2, 5))))
        many = sorted(t for t in tokens if len(t) > 1)
        random.shuffle(many)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + k for k, t in enumerate(many)}
        bpe = B.Bpe(ranks, r"\S+")
        words = [bytes(random.choice(b"abc") for _ in range(random.randint(0, 30))) for _ in range(30)]
        assert bpe.merge_all(words) == [slow(ranks, w) for w in words]
    assert bpe.merge_all([]) == [] and bpe.merge_all([b"", b""]) == [[], []]


def test_like_tiktoken(reference):
    random.seed(11)
    texts = ["", " ", "aaaaaaaaaaaaaaaaaaaaaa", "ab" * 20000, "\u0000x", "don't 12 漢字😀 \n\n x", "a" * 50000]
    texts += ["".join(random.choice(" \nabcdeé'1漢😀ing the") for _ in range(random.randint(0, 200))) for _ in range(300)]
    bpe = B.loaded(*B.vocabulary())
    got = bpe.encode_batch(texts)
    assert got == [np.array(reference.encode_ordinary(t), "<u4").tobytes() for t in texts]
    assert [bpe.decode(x) for x in got] == [t.encode() for t in texts]


def test_table(spark, docs, odd_texts, reference):
    got = B.encode_table(docs(odd_texts).repartition(3)).collect()
    want = []
    for i, t in odd_texts:
        ids = np.array(reference.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert B.encode_table(docs([])).collect() == []


def test_the_cache_is_bounded_by_bytes(monkeypatch, reference):
    monkeypatch.setattr(B, "CACHE", 100_000)
    bpe = B.Bpe(B.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    texts = [" ".join(f"w{i}x{k}" for i in range(200)) for k in range(40)] + ["q" * 60_000, "after"]
    got = [x for t in texts for x in bpe.encode_batch([t])]
    assert got == [np.array(reference.encode_ordinary(t), "<u4").tobytes() for t in texts] and bpe.held <= 100_000 and len(bpe.known) < 600
