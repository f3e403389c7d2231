"""Scans of named tables and saves of derived ones."""

from __future__ import annotations

import contextvars
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lumbre.session import prepare, scratch_path, settings

_SCOPE: contextvars.ContextVar[Scratch | None] = contextvars.ContextVar("scratch", default=None)


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder, lazily."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def register(spark: SparkSession, folder: str, *names: str) -> None:
    """Make tables available to SQL text under their own names."""
    for name in names:
        scan(spark, folder, name).createOrReplaceTempView(name)


def save(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` by ``df`` and return it as read back.

    Also the way to hand a stage's result to the next one: typed (arrays stay arrays) and free of
    the lineage behind it.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_scratch(df: DataFrame, name: str) -> DataFrame:
    """``save`` below the shared folder of the session; inside ``scratch`` the folder ends with the scope."""
    return save(df, scratch_folder(df.sparkSession, name))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; inside ``scratch`` what is there ends with the scope."""
    path, scope = scratch_path(spark, name), _SCOPE.get()
    if scope is not None:
        scope.paths.append(path)
    return path


class Scratch:
    """The scratch folders written while this scope is the innermost one."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths, self.kept = spark, [], set()

    def keep(self, df: DataFrame) -> DataFrame:
        """Let the folders that ``df`` reads outlive the scope: they pass to the scope around it, if there is one."""
        self.kept |= _folders_of(df, self.paths)
        return df

    def drop(self, df: DataFrame) -> None:
        """Remove the folders of this scope that ``df`` reads, once what was made of it is written."""
        self.remove(_folders_of(df, self.paths))

    def remove(self, gone: set[str]) -> None:
        """Remove these folders of the scope."""
        self._remove(gone)
        self.paths = [p for p in self.paths if p not in gone]

    def _remove(self, paths: set[str]) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        for path in paths:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def _folders_of(df: DataFrame, paths: list[str]) -> set[str]:
    """Those of ``paths`` that the plan of ``df`` reads; all of them if the plan has leaves that do not tell."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots, told = set(), ("LocalRelation", "OneRowRelation", "Range", "LogicalRDD")
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        kind = leaf.getClass().getSimpleName()
        if kind == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            found = leaf.relation().location().rootPaths()
            roots |= {found.apply(i).toUri().getPath() for i in range(found.size())}
        elif kind not in told:
            return set(paths)
    return {p for p in paths if any(r == _plain(p) or r.startswith(_plain(p) + "/") for r in roots)}


def _plain(path: str) -> str:
    """A path without scheme and host."""
    rest = path.split("://", 1)[-1] if "://" in path else path.removeprefix("file:")
    return "/" + rest.split("/", 1)[-1] if "://" in path else rest


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A scope that owns the scratch folders written in it and removes them at its end, also when it fails.

    What a result still has to read is named with ``keep``. Folders go only after their last reader has run: hand out
    of a scope nothing lazy that was not kept.
    """
    scope, outer = Scratch(spark), _SCOPE.get()
    token = _SCOPE.set(scope)
    try:
        yield scope
    except BaseException:
        scope.kept = set()
        raise
    finally:
        _SCOPE.reset(token)
        scope._remove({p for p in scope.paths if p not in scope.kept})
        if outer is not None:
            outer.paths.extend(p for p in scope.paths if p in scope.kept)


#: Bucket files that a task keeps open at once where its rows come dealt by bucket; with more it sorts what is left.
OPEN_FILES = 32


def save_bucketed(df: DataFrame, table: str, buckets: int, *keys: str, path: str | None = None, dealt: bool = False) -> DataFrame:
    """Replace a catalog table, bucketed and sorted by ``keys`` so that later joins and groupings on them do
    not shuffle; its files are at ``path`` or, without one, in the warehouse.

    Rows that come ``dealt`` by bucket are not sorted once more: a task has few buckets, and each keeps the order in
    which its rows come (that of the join).
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, *keys).format("parquet")
    writer = writer if dealt else writer.sortBy(*keys)
    with settings(df.sparkSession, spark__sql__maxConcurrentOutputFileWriters=str(OPEN_FILES if dealt else 0)):
        (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


#: Versions of a named table that stay: the one its name points to, and the one before for those who still read it.
VERSIONS = 2


def replace_table(df: DataFrame, table: str, *keys: str, dealt: bool = False) -> DataFrame:
    """Replace a named table by ``df``, in as many buckets as shuffles have partitions.

    Rows are dealt by their keys first, as otherwise every task writes a file for every bucket; adaptive execution puts
    small buckets together and splits large ones. Say ``dealt`` where a join by the keys has just done so.

    The rows go into a new version (a table of its own, with files in the shared folder); then the name, a view, is
    pointed at it in one change of the catalog. A failed write leaves the name as it was, and who reads the version
    before is not disturbed; older ones are dropped with their files.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, table)
    version = f"{table}__{path.rsplit('-', 1)[1]}"
    try:
        rows = df if dealt else df.hint("rebalance", buckets, *keys)
        save_bucketed(rows, version, buckets, *keys, path=path, dealt=dealt)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        Scratch(spark)._remove({path})
        raise
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {table}")  # a plain table of that name has no versions
    versions = [*_versions(spark, table), version]
    noted, columns = ",".join(versions[-VERSIONS:]), ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('versions' = '{noted}') AS SELECT {columns} FROM {version}")
    for old in versions[:-VERSIONS]:
        Scratch(spark)._remove({_location(spark, old)})
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(table)


def _versions(spark: SparkSession, table: str) -> list[str]:
    """Versions of a named table, oldest first, as its view notes them."""
    if not spark.catalog.tableExists(table):
        return []
    noted = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return noted["versions"].split(",") if "versions" in noted else []


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]
