import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stemma.llm import components as C
from stemma.llm import simhash_dedup as S


def slow(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def parts(fps, bits=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    f = np.array(fps, np.uint64)
    for a in range(len(f)):
        for b in np.flatnonzero(np.bitwise_count(f[a + 1 :] ^ f[a]) <= bits) + a + 1:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(x) for x in range(len(f))]


def test_fingerprint(odd_texts):
    for _, t in odd_texts:
        assert S.fingerprint(t) % (1 << 64) == slow(t)
    for n in range(1, 8):
        t = " ".join(f"W{i}" for i in range(n))
        assert S.fingerprint(t) % (1 << 64) == slow(t)


def test_code():
    bit, errors = S.code()
    assert len(np.unique(bit)) == 23 and errors.shape == (2048, 6)
    six = sum(len(set(e)) == 6 for e in errors.tolist())
    assert six == 1771 and sum(len(set(e)) == 1 for e in errors.tolist()) == 277


def test_segments_within_two_bits_share_a_codeword():
    r = np.random.default_rng(1)
    x = r.integers(0, 1 << 23, 3000)
    for flips in (0, 1, 2):
        y = x.copy()
        for k in range(len(x)):
            for b in r.choice(23, flips, replace=False):
                y[k] ^= 1 << int(b)
        assert all(set(a) & set(b) for a, b in zip(S.codewords(x).tolist(), S.codewords(y).tolist(), strict=True))


def test_fingerprints_within_four_bits_share_a_key():
    r = np.random.default_rng(2)
    for flips in range(5):
        x = r.integers(-(1 << 63), (1 << 63) - 1, 400)
        y = x.copy()
        for k in range(len(x)):
            for b in r.choice(64, flips, replace=False):
                y[k] ^= np.int64(np.uint64(1 << int(b)).astype(np.int64))
        (kx, fx), (ky, fy) = S.keys_of(x), S.keys_of(y)
        of = lambda keys, fps, v: set(keys[fps == v].tolist())
        assert all(of(kx, fx, a) & of(ky, fy, b) for a, b in zip(x, y, strict=True))


@pytest.mark.parametrize("hot", [2, 7, 5000])
def test_links(spark, hot):
    r = np.random.default_rng(3)
    base = r.integers(-(1 << 63), (1 << 63) - 1, 30)
    fps = set(base.tolist())
    for b in base[:10].tolist():
        for _ in range(12):
            x = b
            for k in r.choice(64, int(r.integers(1, 7)), replace=False):
                x ^= int(np.uint64(1 << int(k)).astype(np.int64))
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp bigint").repartition(3)
    links = S.near_links(df, hot).collect()
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    mine = [find(x) for x in fps]
    want = parts([x % (1 << 64) for x in fps])
    assert len(set(zip(mine, want, strict=True))) == len(set(mine)) == len(set(want))


def test_components(spark):
    random.seed(4)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20] + [(100, 200), (200, 150), (150, 100), (7, 7), (None, 3)] + [(500, 501 + i) for i in range(100)]
    random.shuffle(edges)
    got = dict(map(tuple, C.components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()))
    assert got == {**{i: 1 + i // 20 * 20 if i % 20 else (i - 20) + 1 for i in range(2, 61) if i % 20 != 1}, 150: 100, 200: 100, **{501 + i: 500 for i in range(100)}}
    assert C.components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").collect() == []


def corpus():
    random.seed(7)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.randint(2, 7)))
    rows = []
    for g in range(8):
        w = [word() for _ in range(random.randint(80, 200))]
        for c in range(6):
            v = list(w)
            for _ in range(c // 2):
                v[random.randrange(len(v))] = word()
            rows.append((1000 - g * 10 - c, " ".join(v)))
    return rows


def test_table(spark, docs, odd_texts):
    rows = odd_texts + corpus()
    got = Counter(map(tuple, S.dedup_table(docs(rows).repartition(3), hot=3).collect()))
    fps = [slow(t) for _, t in rows]
    root = parts(fps)
    least = {}
    for (i, _), k in zip(rows, root, strict=True):
        if i is not None:
            least[k] = min(i, least.get(k, i))
    assert got == Counter((i, f"{f:016x}", least.get(k)) for (i, _), f, k in zip(rows, fps, root, strict=True))


def test_keep_first(spark, docs, odd_texts):
    rows = odd_texts + corpus() + [(None, "another text whose id is missing too")] * 2
    d = docs(rows)
    kept = S.keep_first(spark, d.repartition(3), "")
    assert kept.columns == d.columns
    fps = [slow(t) for _, t in rows]
    groups = {}
    for (i, t), k in zip(rows, parts(fps), strict=True):
        groups.setdefault(k, []).append(float("inf") if i is None else i)
    assert sorted(float("inf") if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted(min(g) for g in groups.values())
    assert S.keep_first(spark, docs([]), "").collect() == S.dedup_table(docs([])).collect() == []
