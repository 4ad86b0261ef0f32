"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Many pre-tokens, laid out one after another with gaps between, are merged together: each merge rank has a bucket of
linked-list positions; a two-level bitmap tells the lowest rank with a bucket (find-first-set on a summary word, then on
a block); an entry is stale, and skipped, if the pair at its position has changed since. Work is in proportion to the
bytes and merges, also for a single pre-token of any length.

Within a rank, positions are taken from left to right, and a lower rank that a merge brings up is served before the rest
of the bucket: that is the order of merging one pre-token at a time.

Defined cases: a null text is an empty one (no ids, digests of nothing); a null doc_id stays null; repeated rows are
encoded each; characters that UTF-8 can't hold become "?" as Python's "replace" does; texts are encoded whole at any
length; an empty table gives no rows. Extra columns are ignored."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from .common import kept, map_texts, only, table

#: Bytes of pre-tokens and ids up to which a worker remembers them, and what an entry costs besides.
CACHE, ENTRY = 300_000_000, 200
BLOCK = 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Bpe:
    """Encoder and decoder for one table of ranks (token bytes -> id, a lower id merges first)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        #: (left id << 32 | right id) -> id of the two joined, which is also the rank of that merge
        self.pairs = {}
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 32 | b] = r
        two = np.full((256, 256), -1, np.int64)
        for token, r in ranks.items():
            if len(token) == 2:
                two[token[0], token[1]] = r
        self.two = two
        self.vocab = [b""] * self.size
        for token, r in ranks.items():
            self.vocab[r] = token
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, bytes] = {}
        self.held = 0  # about so many bytes

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each of these byte strings."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(words), np.uint8)
        n = len(raw)
        if not n:
            return [[] for _ in words]
        ids = self.single[raw].tolist()
        first = np.zeros(n + 1, bool)
        first[ends] = True  # a word begins there (or the list ends)
        first[0] = True
        nxt = np.arange(1, n + 1)
        nxt[first[1:]] = -1  # no neighbour across words
        prv = np.arange(-1, n - 1)
        prv[first[:-1]] = -1
        start = np.full(n, -1, np.int64)
        if n > 1:
            start[:-1] = self.two[raw[:-1], raw[1:]]
        start[nxt < 0] = -1
        here = np.flatnonzero(start >= 0)
        order = here[np.argsort(start[here], kind="stable")]
        values, cuts = np.unique(start[order], return_index=True)
        buckets: dict[int, list[int]] = {}
        blocks, summary = [0] * (self.size // BLOCK + 1), 0
        for r, part in zip(values.tolist(), np.split(order, cuts[1:]) if len(order) else [], strict=True):
            buckets[r] = part.tolist()
            blocks[r // BLOCK] |= 1 << r % BLOCK
            summary |= 1 << r // BLOCK
        nxt, prv, pairs = nxt.tolist(), prv.tolist(), self.pairs
        while summary:
            block = (summary & -summary).bit_length() - 1
            bits = blocks[block]
            low = (bits & -bits).bit_length() - 1
            rank = block * BLOCK + low
            blocks[block] = bits & (bits - 1)
            if not blocks[block]:
                summary &= ~(1 << block)
            places = buckets.pop(rank)
            places.sort()
            for k, p in enumerate(places):
                q = nxt[p]
                if q < 0 or ids[p] < 0 or pairs.get(ids[p] << 32 | ids[q]) != rank:
                    continue  # stale
                ids[p], ids[q] = rank, -1
                after = nxt[p] = nxt[q]
                if after >= 0:
                    prv[after] = p
                fresh = []
                if after >= 0 and (r := pairs.get(rank << 32 | ids[after])) is not None:
                    fresh.append((r, p))
                if (b := prv[p]) >= 0 and (r := pairs.get(ids[b] << 32 | rank)) is not None:
                    fresh.append((r, b))
                sooner = False
                for r, at in fresh:
                    if r in buckets:
                        buckets[r].append(at)
                    else:
                        buckets[r] = [at]
                        blocks[r // BLOCK] |= 1 << r % BLOCK
                        summary |= 1 << r // BLOCK
                    sooner |= r <= rank
                if sooner and k + 1 < len(places):  # it comes first; the rest of this bucket waits
                    rest = buckets.setdefault(rank, [])
                    rest += places[k + 1 :]
                    blocks[rank // BLOCK] |= 1 << rank % BLOCK
                    summary |= 1 << rank // BLOCK
                    break
        out, at = [], 0
        for e in ends.tolist():
            out.append([x for x in ids[at:e] if x >= 0])
            at = e
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        known, find, out = self.known, self.pattern.findall, []
        for some in batches_of(texts):
            split = [find(t) for t in some]
            new = list({w for ws in split for w in ws if w not in known})
            got = [w.encode("utf-8", "replace") for w in new]
            whole = [self.ranks.get(b) for b in got]  # a pre-token that is a token needs no merging
            for w, r in zip(new, whole, strict=True):
                if r is not None:
                    known[w] = r.to_bytes(4, "little")
            left = [k for k, r in enumerate(whole) if r is None]
            for k, ids in zip(left, self.merge_all([got[k] for k in left]), strict=True):
                known[new[k]] = np.array(ids, "<u4").tobytes()
            out += [b"".join(map(known.__getitem__, ws)) for ws in split]
            self.held += ENTRY * len(new) + 8 * sum(map(len, new))
            if self.held > CACHE:
                self.clear()
                known = self.known
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocab.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def batches_of(texts: list[str], most: int = 2_000_000) -> Iterator[list[str]]:
    """Runs of texts of about so many characters; a longer text is alone."""
    some, n = [], 0
    for t in texts:
        if some and n + len(t) > most:
            yield some
            some, n = [], 0
        some.append(t)
        n += len(t)
    if some:
        yield some


@lru_cache(2)
def loaded(path: str, pattern: str) -> Bpe:
    return kept(Bpe(read_ranks(path), pattern))


def vocabulary() -> tuple[str, str]:
    """Path of the ranks and the pattern, as the public tokenizer package gives them on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode_table(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes for every row of docs. path: of a rank file that every
    executor has (or that was given to addFile); without it, the installed public vocabulary."""

    def work():
        file, pat = vocabulary() if path is None else (path, pattern)
        bpe = loaded(file if "/" in file else SparkFiles.get(file), pat)
        only(bpe)

        def of(texts: list) -> dict:
            ids = bpe.encode_batch([t or "" for t in texts])
            return {"n_tokens": [len(x) // 4 for x in ids], "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids], "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]}

        return of

    return map_texts(docs, work, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_table(table(spark, sf_dir, "documents"))
