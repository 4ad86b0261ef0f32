"""Packing of tokenised documents into sequences by first-fit decreasing with a tournament tree of bin capacities, run
independently in randomised groups of documents.

A document's ids are cut into full sequences and one remainder; the remainders of a group are packed. Groups are dealt
by a hash of their place in the table, some thousand documents each, so that no group grows with the input, whatever
recurs in it; only sizes and checksums are shuffled.

Defined cases: a null text is an empty one (one sequence id, the end mark); repeated rows are packed each, told apart by
nothing but their pieces' places; a null doc_id is a document like any other; ties of length are packed by doc_id, then
by checksum; a string of the tokenizer's special tokens in a text is that token, as the tokenizer has it; texts are
encoded whole at any length; an empty table gives no rows. Extra columns are ignored."""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, map_texts, only, pick, table

LIMIT = 1024
END = 0
GROUP = 2048
#: Bytes up to which a worker remembers ids, what an entry costs besides its characters, and the longest part remembered.
CACHE, ENTRY, LONG = 300_000_000, 200, 4096
#: How byte-level vocabularies write a space, and how many parts are encoded as one text.
SPACE, RUN = "Ġ", 512
CUTS = re.compile(r"(?<=\S) (?=\S)")
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class Tree:
    """First bin with room for an item, by a tournament of the bins' free room; bins are opened from left to right."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [room] * (2 * self.leaves)

    def place(self, item: int) -> int:
        best, k = self.best, 1
        if best[1] < item:
            raise ValueError(f"no room for {item}")
        while k < self.leaves:
            k *= 2
            if best[k] < item:
                k += 1
        bin_ = k - self.leaves
        best[k] -= item
        while k > 1:
            k //= 2
            best[k] = max(best[2 * k], best[2 * k + 1])
        return bin_


def first_fit_decreasing(sizes: list[int], room: int = LIMIT) -> list[int]:
    """The bin of each item; sizes in descending order, none over room."""
    if not sizes:
        return []
    tree = Tree(len(sizes), room)
    return [tree.place(x) for x in sizes]


class Tokens:
    """Whole texts to id bytes (little-endian unsigned 32-bit), by the tokenizer as its file gives it. A space between two
    other characters always begins a pre-token, so texts are cut there, and what recurs between spaces is encoded once.
    Texts that hold a string of the tokenizer's added tokens are encoded uncut."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

        spaced = [k for t, k in self.tokenizer.get_vocab().items() if t.startswith(SPACE)]
        self.opens = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)  # tokens that begin with a space
        self.opens[spaced] = True

    def clear(self) -> None:
        self.first: dict[str, bytes] = {}  # of what stands before the first space
        self.later: dict[str, bytes] = {}  # of a space with what follows it
        self.held = 0  # about so many bytes in both

    def ids(self, strings: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def spaced_ids(self, parts: list[str]) -> list[bytes]:
        """The ids of each part with a space before it. Many parts are encoded as one text; as no part holds a space, each
        begins at a token that begins with one."""
        out = []
        runs = [parts[k : k + RUN] for k in range(0, len(parts), RUN)]
        for some, raw in zip(runs, self.ids([" " + " ".join(x) for x in runs]), strict=True):
            starts = np.flatnonzero(self.opens[np.frombuffer(raw, "<u4")])
            if len(starts) != len(some):
                out += self.ids([" " + x for x in some])  # an unusual vocabulary
                continue
            at = (4 * starts).tolist()
            out += [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)], strict=True)]
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        for at in range(0, len(texts), 256):
            if self.held > CACHE:
                self.clear()
            later, split, odd, whole = self.later, {}, [], []
            heads, news = set(), set()
            for k in range(at, min(at + 256, len(texts))):
                if any(x in texts[k] for x in self.added):
                    whole.append(k)
                    continue
                head, *tail = texts[k].split(" ")
                got = list(map(later.get, tail))
                gaps = [i for i, x in enumerate(got) if x is None] if None in got else []
                new = [tail[i] for i in gaps]
                if not head or head[-1].isspace() or "" in new or list(map(str.strip, new)) != new or new and max(map(len, new)) > LONG:
                    odd.append(k)  # more white space than single spaces, or huge parts: cut only where it is safe, nothing kept
                    continue
                split[k] = head, got, gaps, new
                heads.add(head)
                news.update(new)
            self.remember(self.first, [x for x in heads if x not in self.first], self.ids)
            self.remember(later, list(news), self.spaced_ids)
            for k, (head, got, gaps, new) in split.items():
                for i, x in zip(gaps, new, strict=True):
                    got[i] = later[x]
                out[k] = self.first[head] + b"".join(got)
            for k in odd:
                head, *tail = CUTS.split(texts[k])
                out[k] = b"".join(self.ids([head, *[" " + x for x in tail]]))
            for k, ids in zip(whole, self.ids([texts[k] for k in whole]), strict=True):
                out[k] = ids
        return out

    def remember(self, where: dict[str, bytes], parts: list[str], encode) -> None:
        where.update(zip(parts, encode(parts), strict=True))
        self.held += ENTRY * len(parts) + 8 * sum(map(len, parts))


@lru_cache(2)
def loaded(path: str | None) -> Tokens:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return kept(Tokens(path))


def tokenised(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, tokens (with the end mark) and the checksum of each piece of `limit` ids. Ids don't leave the task."""

    def work():
        bpe, end = loaded(path), END.to_bytes(4, "little")
        only(bpe)

        def of(texts: list) -> dict:
            ids = [memoryview(x + end) for x in bpe.encode_batch([t or "" for t in texts])]
            return {"tokens": [len(x) // 4 for x in ids], "sums": [[zlib.crc32(x[k : k + 4 * limit]) for k in range(0, len(x), 4 * limit)] for x in ids]}

        return of

    return map_texts(docs, work, "tokens bigint, sums array<bigint>")


def pack_group(group: pa.Table, limit: int = LIMIT) -> pa.Table:
    """The pieces of one group; sequence ids count from its number times 2^32."""
    docs = list(zip(*(group.column(c).to_pylist() for c in ("doc_id", "tokens", "sums")), strict=True))
    docs.sort(key=lambda d: (-(d[1] % limit), d[0] is not None, d[0] or 0, d[2]))
    some = [d for d in docs if d[1] % limit]
    bins = first_fit_decreasing([n % limit for _, n, _ in some], limit)
    first, filled, rows = group.column("g")[0].as_py() << 32, {}, []
    for (doc, n, sums), b in zip(some, bins, strict=True):
        rest, at = n % limit, filled.get(b, 0)
        rows.append((doc, n - rest, rest, sums[-1], n, first + b, at))
        filled[b] = at + rest
    free = first + len(filled)
    for doc, n, sums in docs:
        for k in range(n // limit):
            rows.append((doc, k * limit, limit, sums[k], n, free, 0))
            free += 1
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(columns, zip(*rows, strict=True), strict=True)})


def pack(docs: DataFrame, path: str | None = None, group: int = GROUP) -> DataFrame:
    """The pieces of all documents."""
    d = pick(docs, doc_id="bigint", text="string")
    groups = max(1, -(-docs.count() // group))
    # Dealt by the row's place: rows that are equal in everything must not meet in one group.
    g = F.pmod(F.xxhash64(F.monotonically_increasing_id(), "tokens", F.col("sums")[0]), F.lit(groups))
    return tokenised(d, path).withColumn("g", g).groupBy("g").applyInArrow(lambda t: pack_group(t), PIECES)


def pack_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
