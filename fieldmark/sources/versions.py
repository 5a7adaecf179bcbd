"""Tables in versions: new files beside the old ones, and one atomic step from one to the next.

    path/schema             schema of the table, as JSON
    path/data/__write=<w>/__cell=<c>/  files, never changed; a cell is a value of the partition column
    path/manifest/<number>  which write holds each cell, in that version

A write puts whole new cells into a folder of its own and a manifest into a hidden one.
Renaming that folder to the next number is the only step that changes the table: whatever
fails before it leaves the last version as it was, and of two writers that start from
one version only one can take the number.  Renames are atomic and refuse an existing target on
HDFS and local file systems; an object store needs a committer that gives the same.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WRITE, CELL = "__write", "__cell"
MANIFEST = "__write STRING, __cell STRING, __rows BIGINT"


class ConcurrentWrite(RuntimeError):
    """Another writer has made the next version first."""


def _paths(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop, root, root.getFileSystem(conf), conf


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all versions that are kept, ascending."""
    hadoop, root, fs, _ = _paths(spark, path)
    folder = hadoop.Path(root, "manifest")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def cell(partition: str) -> Column:
    """The folder name of a partition value; NULL has one as well."""
    return F.concat(F.lit("c"), F.coalesce(F.concat(F.lit("="), F.col(partition).cast("string")), F.lit("")))


def _manifest(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    known = versions(spark, path)
    if version is not None and version not in known:
        raise LookupError(f"version {version} of {path} is not kept")
    if not known:
        return spark.createDataFrame([], MANIFEST)
    number = known[-1] if version is None else version
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest/{number:012d}")


def _cells(spark: SparkSession, path: str, live: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of the (write, cell) pairs of `live`; other folders are pruned by the join at run time."""
    full = T.StructType([*schema.fields, T.StructField(WRITE, T.StringType()), T.StructField(CELL, T.StringType())])
    rows = spark.read.schema(full).option("basePath", f"{path}/data").parquet(f"{path}/data")
    wanted = live.filter(F.col("__rows") > 0).select(F.col(WRITE).alias("__w"), F.col(CELL).alias("__c"))
    joined = rows.join(wanted, (rows[WRITE] == wanted["__w"]) & (rows[CELL] == wanted["__c"]))
    return joined.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the latest version, or of one that is still kept."""
    live = _manifest(spark, path, version)
    if not versions(spark, path):
        raise LookupError(f"there is no table at {path}")
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()[0]))
    return _cells(spark, path, live, schema)


def _swap(spark: SparkSession, path: str, hidden: str, number: int) -> None:
    hadoop, root, _, conf = _paths(spark, path)
    context = hadoop.FileContext.getFileContext(root.toUri(), conf)
    nothing = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(hadoop.Path(root, f"manifest/{hidden}"), hadoop.Path(root, f"manifest/{number:012d}"), nothing)
    except Exception as error:
        if number in versions(spark, path):
            raise ConcurrentWrite(f"version {number} of {path} is another writer's") from error
        raise


def replace_cells(rows: DataFrame, path: str, partition: str, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> int:
    """Write new contents of the cells that `rows` touches, as the next version; its number.

    `merge(stored, rows)` gives the new contents from the stored rows of those cells; without
    it the cells are replaced by `rows`.  All other cells stay where they are.  Which cells are
    touched is found and joined by Spark; the driver sees the version number only.  Without
    rows no version is made, and the number is the last one's, or 0.
    """
    spark = rows.sparkSession
    last = max(versions(spark, path), default=0)
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = kept.select(cell(partition).alias("__t")).distinct()
        if touched.isEmpty():
            return last
        described = spark.createDataFrame([(rows.schema.json(),)], "value STRING").coalesce(1)
        described.write.mode("ignore").text(f"{path}/schema")
        live = _manifest(spark, path, last or None)
        new = kept
        if merge is not None and last:
            mine = live.join(touched, live[CELL] == touched["__t"], "left_semi")
            new = merge(_cells(spark, path, mine, rows.schema), kept)
        elif merge is not None:
            new = merge(spark.createDataFrame([], rows.schema), kept)
        write = uuid.uuid4().hex
        folder = f"{path}/data/{WRITE}=w{write}"
        new.select(*rows.columns, cell(partition).alias(CELL)).write.partitionBy(CELL).parquet(folder)
        stored = T.StructType([*rows.schema.fields, T.StructField(CELL, T.StringType())])
        made = spark.read.schema(stored).parquet(folder).groupBy(CELL).agg(F.count(F.lit(1)).alias("__rows"))
        others = live.join(touched, live[CELL] == touched["__t"], "left_anti")
        manifest = others.unionByName(made.select(F.lit(f"w{write}").alias(WRITE), CELL, "__rows"))
        manifest.write.parquet(f"{path}/manifest/.{write}")
        _swap(spark, path, f".{write}", last + 1)
        return last + 1
    finally:
        kept.unpersist()


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest `keep` versions, and the files that only they, or broken writes, have.

    Not to be run while another job writes to or reads an older version of the table.
    """
    if keep < 1:
        raise ValueError("at least one version is kept")
    hadoop, root, fs, _ = _paths(spark, path)
    known = versions(spark, path)
    if not known:
        return
    for number in known[:-keep]:
        fs.delete(hadoop.Path(root, f"manifest/{number:012d}"), True)
    used = spark.read.schema(MANIFEST).parquet(*[f"{path}/manifest/{n:012d}" for n in known[-keep:]])
    # Writes, not rows or cells: as many as there have been runs since the last call.
    names = {r[0] for r in used.select(WRITE).distinct().collect()}
    for status in fs.listStatus(hadoop.Path(root, "data")):
        if status.getPath().getName().removeprefix(f"{WRITE}=") not in names:
            fs.delete(status.getPath(), True)
    for status in fs.listStatus(hadoop.Path(root, "manifest")):
        if status.getPath().getName().startswith("."):
            fs.delete(status.getPath(), True)
