"""Parquet layers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from podium.versions import VersionedTable
from podium.sources.lake import layer_path


def write_layer(
    df: DataFrame, root: str, layer: str, table: str, versions: bool = False, keep: int = 2
) -> str:
    """Replace a table of a layer with `df` and return its path.

    A plain folder of Parquet files is replaced as Spark does it: the old files go before the new ones
    are computed, and a folder that `df` is itself read from is refused. With `versions`, the old table
    stays until the new one is complete, and a write that fails changes nothing; the newest `keep`
    versions are kept, and :func:`podium.sources.lake.read_layer` reads the last one.
    """
    target = layer_path(root, layer, table)
    if versions:
        layered = VersionedTable(df.sparkSession, target)
        layered.replace(df)
        layered.retire(keep)
        return target
    if any(_inside(source, target) for source in _scanned_paths(df)):
        raise ValueError(f"{target} is an input of the frame written to it")
    df.write.mode("overwrite").parquet(target)
    return target


def _scanned_paths(df: DataFrame) -> list[str]:
    """Root folders of the file scans in a plan: a handful, however many files are below them."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    paths = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            roots = relation.location().rootPaths()
            paths += [roots.apply(j).toString() for j in range(roots.size())]
    return paths


def _inside(path: str, folder: str) -> bool:
    def plain(p: str) -> str:
        scheme, colon, rest = p.partition(":")
        if colon and scheme == "file":
            p = "/" + rest.lstrip("/")
        return p.rstrip("/") + "/"

    return plain(path).startswith(plain(folder))
