import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stemma.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_tree_is_first_fit():
    random.seed(4)
    for _ in range(30):
        sizes = sorted((random.randint(1, 100) for _ in range(random.randint(1, 80))), reverse=True)
        bins, want = [], []
        for s in sizes:
            k = next((i for i, b in enumerate(bins) if b >= s), None)
            if k is None:
                bins.append(100)
                k = len(bins) - 1
            bins[k] -= s
            want.append(k)
        assert P.first_fit_decreasing(sizes, 100) == want
    assert P.first_fit_decreasing([]) == []
    with pytest.raises(ValueError):
        P.Tree(1, 10).place(11)


def test_ids(tokenizer):
    random.seed(3)
    texts = ["", "a", " a", "a ", "  a  b", "a\n b", "x \n y", "don't  stop's", "a \u3000b", "a\x1cb \x1c c", "ab" * 3000, "<|endoftext|> hi", "a <|endoftext|> b", "x" * 9000 + "<|endoftext|>" * 3 + " y", "<|endoftext", " ", "\n", "a\n", " \n a"]
    texts += ["".join(random.choice(" \n\tab'sé1. 漢😀") for _ in range(random.randint(1, 60))) for _ in range(400)]
    got = P.loaded(None).encode_batch(texts)
    assert got == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_pieces(spark, docs, odd_texts, tokenizer):
    random.seed(5)
    rows = odd_texts + [(100 + i, " ".join(random.choice(["alpha", "beta", "gamma"]) for _ in range(random.randint(0, 3000)))) for i in range(60)]
    ids = defaultdict(list)
    for i, t in rows:
        ids[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])
    got = P.pack(docs(rows).repartition(3), group=20).collect()
    per_doc, per_sequence = defaultdict(int), defaultdict(list)
    for r in got:
        assert any(len(x) == r.doc_tokens and zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in ids[r.doc_id])
        per_doc[r.doc_id] += r.length
        per_sequence[r.sequence_id].append((r.offset, r.length))
    assert per_doc == {i: sum(map(len, x)) for i, x in ids.items()}
    for s in per_sequence.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(per_doc.values())
    assert total / (1024 * len(per_sequence)) > 0.85  # three small groups


def test_empty(spark, docs):
    assert P.pack(docs([])).collect() == []


def test_a_full_cache_changes_nothing(monkeypatch, tokenizer):
    random.seed(12)
    monkeypatch.setattr(P, "CACHE", 8000)
    t = P.Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" ".join(random.choice(["ab", "cd", "e", "f."]) + str(random.randint(0, 30)) for _ in range(20)) for _ in range(1200)]
    got = t.encode_batch(texts)
    assert got == [np.array(tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_equal_rows_are_dealt_over_all_groups(spark):
    same = spark.range(0, 20000, 1, 1).selectExpr("cast(null as bigint) doc_id", "cast(null as string) text")
    got = P.pack(same).groupBy((P.F.col("sequence_id") / 2**32).cast("long").alias("g")).count().collect()
    assert len(got) == 10 and max(r["count"] for r in got) < 3 * P.GROUP and sum(r["count"] for r in got) == 20000


def test_long_parts_are_not_remembered():
    t = P.Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_batch(["a " + "b" * 100_000 + " c"])
    assert t.held < 10_000 and max(map(len, [*t.first, *t.later, ""])) <= P.LONG
