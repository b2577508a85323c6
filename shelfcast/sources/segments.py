"""Aggregates that many reports read: computed once per session and input, kept as parquet in the shared folder.

The sales of a (series, day) cell are the smallest grain of every report, and far fewer than
the lines they are summed from. The first report that needs them writes them; all others,
also the bounds and the list of series of a panel, read the stored cells. Which version of
the input a stored aggregate belongs to is decided by the names, sizes and times of its
files: after a change, it is computed anew and the old one is deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.session import discard, materialize

_KEPT: dict[tuple[str, str, str], tuple[tuple, DataFrame]] = {}


def input_version(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> tuple:
    """(name, bytes, time) of all files of the tables, as Spark's file systems list them."""
    sc, out = spark.sparkContext, []
    for name in tables:
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        found = path.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(path)
        out += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in found]
    return tuple(sorted(out))


def stored(spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...], build: Callable[[], DataFrame]) -> DataFrame:
    """The stored result of `build`, which reads `tables` of `sf_dir`; written if this session hasn't it yet."""
    key, version = (spark.sparkContext.applicationId, sf_dir, name), input_version(spark, sf_dir, tables)
    if key not in _KEPT or _KEPT[key][0] != version:
        if key in _KEPT:
            discard(_KEPT[key][1])
        _KEPT[key] = (version, materialize(build(), name))
    return _KEPT[key][1]


def forget(spark: SparkSession) -> None:
    """Delete all stored aggregates of this session."""
    for key in [k for k in _KEPT if k[0] == spark.sparkContext.applicationId]:
        discard(_KEPT.pop(key)[1])
