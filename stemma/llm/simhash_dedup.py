"""Near-duplicates by SimHash fingerprints that differ in few bits, found with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of at most 23 bits. Each segment is decoded to the codewords of the
perfect [23, 12, 7] Golay code within distance 4 (one, or six): two segments that differ in at most two bits share one.
With four differing bits in all, pigeonhole leaves only these cases, and each has keys of 33 bits or more:
  some segment is equal and another has at most two errors: key (equal segment, codeword of the other);
  no segment is equal, so two have one error each and the third at most two: key (the half without error of the first,
  the same of the second, codeword of the third).
Fingerprints that share a key are compared (exclusive or, count of bits). Equal fingerprints are one node from the start,
so copies never make pairs.

Keys that very many different fingerprints share are not compared all with all: beyond HOT fingerprints, each of them
names its neighbours within two bits, and two fingerprints within four bits always share such a neighbour; at most
2,081 can meet there. That is exact and its work is in proportion to the fingerprints.

Defined cases: a null text is an empty one; a text without words has fingerprint zero; repeated rows get a row each; a
null doc_id is never a component's smallest id, and a component of null ids only has a null component_id; an empty
table gives no rows; texts are read whole at any length. Extra columns are ignored by dedup_table and kept by keep_first,
whatever their names."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, only, pick, quoted, small_batches, table, unused
from .components import components

WORDS = 4
SEED = 42
BITS = 4
#: Different fingerprints under one key that a task compares in memory.
HOT = 4096
#: Generator polynomial of the binary Golay code (fixed value), and the segments' first bits and sizes.
GOLAY = 0xAE3
SEGMENTS = ((0, 22), (22, 21), (43, 21))
NONE = (1 << 63) - 1


def fingerprint(text: str | None) -> int:
    """The SimHash of a whole text, as a signed 64-bit integer."""
    joined = b" ".join((text or "").encode("utf-8", "replace").lower().split())
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    if len(gaps) < WORDS - 1:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        starts, ends = [0, *(gaps[: len(gaps) - WORDS + 1] + 1).tolist()], [*gaps[WORDS - 1 :].tolist(), len(joined)]
        hash_, seed = xxhash.xxh64_intdigest, SEED
        hashes = [hash_(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)]
    h = np.array(hashes, np.uint64)
    n = np.zeros(64, np.int64)
    for k in range(0, len(h), 65536):
        n += np.unpackbits(h[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * n > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(text: Column) -> Column:
    """The text column's fingerprints."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        only(None)
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return of(F.coalesce(text.cast("string"), F.lit("")))


@lru_cache(1)
def code() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the 23 single bits; for each syndrome the error patterns of weight 4 at most, six or one (repeated)."""
    bit = []
    for i in range(23):
        r = 1 << i
        for k in range(22, 10, -1):
            if r >> k & 1:
                r ^= GOLAY << (k - 11)
        bit.append(r)
    by: dict[int, list[int]] = {}
    for weight in range(5):
        for places in combinations(range(23), weight):
            s = e = 0
            for p in places:
                s, e = s ^ bit[p], e | 1 << p
            by.setdefault(s, []).append(e)
    return np.array(bit, np.int64), np.array([(by[s] + [by[s][0]] * 6)[:6] for s in range(2048)], np.int64)


@lru_cache(1)
def syndromes() -> np.ndarray:
    """Of every value of 12 and of 11 bits: the low part's, then the high part's."""
    bit, _ = code()
    out = np.zeros((2, 4096), np.int64)
    for part, first in enumerate((0, 12)):
        v = np.arange(4096)
        for k in range(min(12, 23 - first)):
            out[part] ^= np.where(v >> k & 1, bit[first + k], 0)
    return out


def codewords(segment: np.ndarray) -> np.ndarray:
    """The 12-bit numbers of the codewords near each 23-bit value: six columns, a single one repeated."""
    s = syndromes()
    return (segment[:, None] ^ code()[1][s[0][segment & 4095] ^ s[1][segment >> 12]]) >> 11


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, fingerprints): a row for each different key of each fingerprint."""
    u = fp.view(np.uint64)
    seg = [((u >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    near = [codewords(x) for x in seg]
    half = [(x & 0x7FF, x >> 11) for x in seg]
    columns, tag = [], 0
    for i in range(3):
        for j in range(3):
            if i != j:
                columns.append((tag << 34 | seg[i] << 12)[:, None] | near[j])
                tag += 1
    for k in range(3):
        i, j = (x for x in range(3) if x != k)
        for a in range(2):
            for b in range(2):
                columns.append((tag << 34 | half[i][a] << 23 | half[j][b] << 12)[:, None] | near[k])
                tag += 1
    six = near_is_six(seg)
    keys, of = [], []
    for c, (which, col) in enumerate(zip(single_columns(), columns, strict=True)):
        keep = np.ones(col.shape, bool)
        keep[:, 1:] = six[which][:, None]
        keys.append(col[keep])
        of.append(np.broadcast_to(fp[:, None], col.shape)[keep])
    return np.concatenate(keys), np.concatenate(of)


def single_columns() -> list[int]:
    """For each column block of keys_of, the segment whose codewords it holds."""
    return [j for i in range(3) for j in range(3) if i != j] + [k for k in range(3) for _ in range(4)]


def near_is_six(seg: list[np.ndarray]) -> list[np.ndarray]:
    """Whether each segment has six near codewords, not one."""
    out = []
    for x in seg:
        c = codewords(x)
        out.append(c[:, 0] != c[:, 1])
    return out


def link_all(f: np.ndarray, bits: int = BITS) -> tuple[list, list]:
    """Links that join the fingerprints f (uint64, all different) as all links of up to `bits` bits would: each to one of
    its component."""
    a, b = [], []
    while len(f):
        root, f = f[0], f[1:]
        queue = [root]
        while queue and len(f):
            near = np.bitwise_count(f ^ queue.pop()) <= bits
            if near.any():
                found = f[near]
                f = f[~near]
                a += found.tolist()
                b += [int(root)] * len(found)
                queue += list(found)
    return a, b


def linked(batches: Iterator[pa.RecordBatch], hot: int = HOT) -> Iterator[pa.RecordBatch]:
    """From (key, fp) sorted by key: links (a, b), and rows (fp, null) for the members of keys with more than `hot`."""
    held_key, held, over = None, np.zeros(0, np.int64), False

    def out(a, b):
        return pa.record_batch({"a": pa.array(np.asarray(a, np.uint64).view(np.int64)), "b": pa.array(np.asarray(b, np.uint64).view(np.int64)) if b is not None else pa.nulls(len(a), pa.int64())})

    def close():
        if not over and len(held) > 1:
            a, b = link_all(held.view(np.uint64))
            if a:
                yield out(a, b)

    for batch in batches:
        key, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp"))
        if not len(key):
            continue
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        ends = np.append(starts[1:], len(key))
        if key[0] == held_key:  # the run that the batch before left open goes on
            more = fp[: ends[0]]
            if over:
                yield out(more.view(np.uint64), None)
            else:
                held = np.append(held, more)
            starts, ends = starts[1:], ends[1:]
        else:
            yield from close()
            held_key = None
        if held_key is not None and not over and len(held) > hot:
            yield out(held.view(np.uint64), None)
            over, held = True, held[:0]
        if not len(starts):
            continue
        if held_key is not None:
            yield from close()
        last, starts, ends = starts[-1], starts[:-1], ends[:-1]
        two = starts[ends - starts == 2]
        x, y = fp[two].view(np.uint64), fp[two + 1].view(np.uint64)
        near = np.bitwise_count(x ^ y) <= BITS
        a, b = [x[near]], [y[near]]
        for s, e in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
            if e - s > hot:
                yield out(fp[s:e].view(np.uint64), None)
                continue
            p, q = link_all(fp[s:e].view(np.uint64))
            a.append(np.array(p, np.uint64))
            b.append(np.array(q, np.uint64))
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            yield out(a, b)
        held_key, held, over = key[last], fp[last:].copy(), False
        if len(held) > hot:
            yield out(held.view(np.uint64), None)
            over, held = True, held[:0]
    yield from close()


def near_links(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """Links (a, b) among different fingerprints (column fp, no repeats) that connect what links of up to four differing
    bits connect."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            for k in range(0, len(fp), 4096):
                keys, of = keys_of(np.ascontiguousarray(fp[k : k + 4096]))
                yield pa.record_batch({"key": pa.array(keys), "fp": pa.array(of)})

    def flips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.uint64(1) << np.arange(64, dtype=np.uint64)
        masks = np.concatenate([[np.uint64(0)], one, [a | b for a, b in combinations(one, 2)]]).astype(np.uint64)
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(fp), 64):
                part = fp[k : k + 64]
                yield pa.record_batch({"w": pa.array((part[:, None] ^ masks).ravel().view(np.int64)), "fp": pa.array(np.repeat(part, len(masks)).view(np.int64))})

    keyed = fps.select("fp").mapInArrow(expand, "key bigint, fp bigint")
    found = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(lambda it: linked(it, hot), "a bigint, b bigint")
    found = cut(found.distinct())
    crowd = found.where("b is null").select(F.col("a").alias("fp"))
    links = found.where("b is not null")
    if crowd.isEmpty():
        return links
    met = crowd.mapInArrow(flips, "w bigint, fp bigint").groupBy("w").agg(F.collect_set("fp").alias("f")).where(F.size("f") > 1)
    star = met.select(F.array_min("f").alias("b"), F.explode("f").alias("a")).where("a <> b").select("a", "b").distinct()
    return links.union(star)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def grouped(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, fp, th (a plain hash of the text), comp, the smallest id of the component (NONE: null ids only), and class,
    one of its fingerprints, for every row of docs."""
    small_batches(docs.sparkSession)
    d = cut(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), fingerprints(docs["text"]).alias("fp"), text_hash(docs["text"]).alias("th")))
    nodes = cut(d.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(NONE))).alias("rep")))
    roots = components(near_links(nodes, hot), "a", "b")
    # Only fingerprints with a link are relabelled; all others are their own component.
    member = roots.select(F.col("node").alias("fp"), "root").union(roots.select("root", "root").distinct())
    least = member.join(nodes, "fp").groupBy("root").agg(F.min("rep").alias("least"))
    label = cut(nodes.join(member.join(least, "root").select("fp", "least", "root"), "fp", "left").select("fp", F.coalesce("least", "rep").alias("comp"), F.coalesce("root", "fp").alias("class")))
    return d.join(label, "fp").select("doc_id", "fp", "th", "comp", "class")


def dedup_table(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of docs."""
    g = grouped(docs, hot)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("comp") != NONE, F.col("comp")).alias("component_id"))


def keep_first(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id, one row, with all its columns."""
    first = grouped(docs).where(F.coalesce("doc_id", F.lit(NONE)) == F.col("comp")).groupBy("class", "comp").agg(F.min("th").alias("first_th"))
    id_, th = unused(docs, "first_id"), unused(docs, "first_th")
    marked = docs.withColumn(id_, F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NONE))).withColumn(th, text_hash(docs["text"]))
    # Of null ids there may be several components: their id is told apart by the text's hash only.
    kept = marked.join(first.select(F.col("comp").alias(id_), F.col("first_th").alias(th)), [id_, th], "left_semi")
    return kept.dropDuplicates([id_, th]).select(*map(quoted, docs.columns))


def op4_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_table(pick(table(spark, sf_dir, "documents"), doc_id="bigint", text="string"))
