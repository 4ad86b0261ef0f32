"""Keyed state in a Parquet folder: rows lie in buckets by a hash of their key, a change writes the buckets that it touches
as a new version, and a small manifest says which versions make up the state. Nothing is overwritten while it is read, a
change that is repeated gives the same state, and an untouched bucket is never read or written."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import last_wins
from ..operators.joins import insert_absent, overlay
from .snapshots import folders


class State:
    def __init__(self, spark: SparkSession, root: str, schema: str, key: str, buckets: int = 16):
        self.spark, self.root, self.schema, self.key, self.buckets = spark, root, schema, key, buckets
        self.columns = spark.createDataFrame([], schema).columns

    def _file(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        """The numbers of the finished versions, in order: those with a manifest, which is written last."""
        some = (n for n in folders(self.spark, self.root) if n.startswith("v="))
        return sorted(int(n[2:]) for n in some if "_manifest" in folders(self.spark, f"{self.root}/{n}"))

    def version(self) -> int:
        return max(self.versions(), default=-1)

    def manifest(self, version: int) -> dict[int, list[int]]:
        """Bucket -> the versions that hold its rows."""
        if version < 0:
            return {}
        fs, p = self._file(f"{self.root}/v={version}/_manifest")
        stream = fs.open(p)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return {int(b): v for b, v in json.loads(text).items()}

    def bucket(self) -> Column:
        return F.pmod(F.hash(self.key), F.lit(self.buckets))

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The state, or only these of its buckets."""
        m = self.manifest(self.version())
        paths = [f"{self.root}/v={v}/bucket={b}" for b, versions in m.items() if only is None or b in only for v in versions]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _commit(self, rows: DataFrame, keep: dict[int, list[int]]) -> int:
        """Writes rows as a version whose other buckets are as in keep; returns its number."""
        v = self.version() + 1
        out = rows.select(self.columns).withColumn("bucket", self.bucket())
        out = out.repartition("bucket", F.pmod(F.xxhash64(self.key), F.lit(4)))  # a bucket is written by up to four tasks
        out.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/v={v}")
        m = {b: list(x) for b, x in keep.items()}
        for n in folders(self.spark, f"{self.root}/v={v}"):
            if n.startswith("bucket="):
                m.setdefault(int(n[7:]), []).append(v)
        fs, p = self._file(f"{self.root}/v={v}/_manifest")
        stream = fs.create(p, True)
        stream.write(bytearray(json.dumps(m).encode()))
        stream.close()
        return v

    def _touched(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in rows.select(self.bucket()).distinct().collect()]  # at most one for each bucket

    def _without(self, some: list[int]) -> dict[int, list[int]]:
        return {b: v for b, v in self.manifest(self.version()).items() if b not in some}

    def upsert(self, rows: DataFrame, order: list) -> int:
        """Rows by key: later rows replace earlier ones, new keys are added."""
        new = last_wins(rows, self.key, order).select(self.columns)
        some = self._touched(rows)
        return self._commit(overlay(self.read(some), new, self.key), self._without(some))

    def replace_all(self, rows: DataFrame, by: str) -> int:
        """All rows of the units that rows speak of (column by) are replaced, so a unit can be run again."""
        new = rows.select(self.columns)
        some = self._touched(new)
        if by != self.key:  # a unit's old rows may lie in any bucket
            some = sorted({*some, *self._touched(self.read().join(new.select(by).distinct(), by, "left_semi"))})
        return self._commit(overlay(self.read(some), new, by), self._without(some))

    def append(self, rows: DataFrame) -> int:
        """New rows beside the old ones, which are neither read nor written."""
        return self._commit(rows, self.manifest(self.version()))

    def insert(self, rows: DataFrame, order: list) -> int:
        """The first row in this order of every key that the state lacks."""
        some = self._touched(rows)
        return self._commit(insert_absent(self.read(some), rows.select(self.columns), [self.key], order), self._without(some))

    def clean(self, keep: int = 2) -> None:
        """Deletes the buckets that none of the last `keep` versions needs."""
        last = self.versions()[-keep:]
        needed = {(v, b) for x in last for b, versions in self.manifest(x).items() for v in versions}
        for n in folders(self.spark, self.root):
            v = int(n[2:]) if n.startswith("v=") else None
            if v is None or v in last:
                continue
            for f in folders(self.spark, f"{self.root}/{n}"):
                if not f.startswith("bucket=") or (v, int(f[7:])) not in needed:
                    fs, p = self._file(f"{self.root}/{n}/{f}")
                    fs.delete(p, True)


def changed(summary: DataFrame, last: str | None) -> tuple[str, bool]:
    """The digest of a one-row summary and whether it differs from the last one (so that nothing is sent twice)."""
    now = summary.select(F.sha1(F.to_json(F.struct("*"))).alias("d")).first().d
    return now, now != last
