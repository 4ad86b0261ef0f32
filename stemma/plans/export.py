"""Tables as files: each with its declared columns, in its declared order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources import csvio
from . import schemas as S


def export(tables: dict[str, DataFrame], folder: str, single: bool = False) -> list[str]:
    """Writes every table that EXPORTS knows as <folder>/<name>.csv, a folder of files in order, or, for small releases, one
    file; returns the names."""
    done = []
    for name, t in tables.items():
        if name not in S.EXPORTS:
            continue
        columns, order = S.EXPORTS[name]
        target = f"{folder}/{name}.csv"
        if not single:
            csvio.write(t, target, columns, order)
        else:
            parts = f"{folder}/_{name}"
            csvio.write(t, parts, columns, order)
            csvio.join_files(t.sparkSession, parts, target)
            csvio.remove(t.sparkSession, parts)
        done.append(name)
    return done


def text(spark, path: str, content: str) -> None:
    """A small text, such as a report, as one file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(content.encode()))
    out.close()
