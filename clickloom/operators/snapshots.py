"""Tables that change as a whole: a version is a list of files, published by one rename.

Under a table's folder lie

* ``data/commit=<id>/<partitions>/``: Parquet files, each written once and never changed;
* ``keys/commit=<id>/bucket=<n>/``: the key index, the hash of every key and the file that holds it;
* ``versions/<number>/``: what a version consists of: its ``files``, and ``about`` the table (schema, partitions, keys).

A change writes new files, their index and the next version under a name that nobody reads, and then renames the version.
A reader that starts before the rename sees the old table, after it the new one, and a run that stops anywhere leaves one
of the two. Two writers cannot publish the same number: the second fails. An upsert asks the index which files may hold its
keys and opens only these. ``vacuum`` removes the files that only older versions name; erasure does so at once.

Only file names come to the driver, as they do when Spark lists a folder.
"""

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickloom.operators.warehouse import by_partition, upsert as upserted
from clickloom.session import stored

BUCKETS = 64
FILE = "_file"


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(conf)


def _versions(spark: SparkSession, path: str) -> list[int]:
    place, files = _hadoop(spark, f"{path}/versions")
    names = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    return sorted(int(n) for n in names if n.isdigit())


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_versions(spark, path))


def key_hash(keys: list[str]) -> Column:
    """A hash of the key columns; null where one of them is null, since such a row matches nothing."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return F.when(known, F.xxhash64(*keys))


@dataclass(frozen=True)
class Snapshot:
    """One version of a table."""

    spark: SparkSession
    path: str
    number: int
    schema: StructType
    partitions: list[str]
    keys: list[str]

    @property
    def files(self) -> DataFrame:
        """``_file`` (below the data folder), ``commit`` and the number of ``rows`` of each file."""
        return self.spark.read.schema(f"{FILE} string, commit string, rows long").parquet(
            f"{self.path}/versions/{self.number}/files")

    def rows(self, files: DataFrame | None = None) -> DataFrame:
        """The rows of the version, or of some of its files, with the file's name as ``_file``."""
        names = sorted(r[FILE] for r in (self.files if files is None else files).select(FILE).distinct().toLocalIterator())
        if not names:
            return self.spark.createDataFrame([], _with(self.schema, FILE))
        found = _reader(self.spark, self.path, self.schema).parquet(*[f"{self.path}/data/{n}" for n in names])
        return found.select(*[F.col(f"`{c}`") for c in self.schema.names], _file_name().alias(FILE))

    def data(self) -> DataFrame:
        return self.rows().drop(FILE)

    def holding(self, changed: DataFrame, keys: list[str]) -> DataFrame:
        """The files that may hold a row with the ``keys`` of ``changed``: by the index if it is on these columns."""
        if keys != self.keys:
            return self.files
        asked = changed.select(key_hash(keys).alias("hash")).where("hash IS NOT NULL").distinct()
        asked = stored(asked.withColumn("bucket", _bucket()), "asked")
        buckets = [r[0] for r in asked.select("bucket").distinct().collect()]
        place, files = _hadoop(self.spark, f"{self.path}/keys")
        if not buckets or not files.exists(place):
            return self.files.limit(0)
        index = self.spark.read.schema("hash long, _file string, commit string, bucket int").parquet(f"{self.path}/keys")
        hits = index.where(F.col("bucket").isin(buckets)).join(asked, ["bucket", "hash"], "left_semi").select(FILE).distinct()
        return self.files.join(hits, FILE, "left_semi")

    def matched(self, changed: DataFrame, keys: list[str]) -> DataFrame:
        """The files that do hold such a row."""
        rows = self.rows(self.holding(changed, keys)).select(FILE, *keys)
        return stored(rows.join(changed.select(*keys).distinct(), keys, "left_semi").select(FILE).distinct(), "matched")

    def replace(self, removed: DataFrame, rows: DataFrame) -> "Snapshot":
        """The next version: without the ``removed`` files, with ``rows``, which may read them."""
        commit = uuid.uuid4().hex
        _write_data(self, rows, commit)
        _write_keys(self, commit)
        _write_version(self, removed, commit)
        return _publish(self, commit)


def _file_name() -> Column:
    """The file of a row, as named below the data folder: the metadata has it as a URI."""
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(plain, "/(commit=[0-9a-f]{32}/.*)$", 1)


def _bucket() -> Column:
    return F.pmod(F.col("hash"), F.lit(BUCKETS)).cast("int")


def _reader(spark: SparkSession, path: str, schema: StructType):
    return spark.read.schema(_with(schema, "commit")).option("basePath", f"{path}/data")


def _with(schema: StructType, name: str) -> StructType:
    return StructType([*schema.fields, StructField(name, StringType())])


def _new_files(table: Snapshot, commit: str) -> DataFrame | None:
    """The rows of a commit, if it wrote any, with their files."""
    folder = f"{table.path}/data/commit={commit}"
    place, files = _hadoop(table.spark, folder)
    if not any(s.isDirectory() or s.getPath().getName().endswith(".parquet") for s in files.listStatus(place)):
        return None
    return _reader(table.spark, table.path, table.schema).parquet(folder).withColumn(FILE, _file_name())


def _write_data(table: Snapshot, rows: DataFrame, commit: str) -> None:
    rows = rows.select(*[F.col(f"`{c}`") for c in table.schema.names])
    writer = by_partition(rows, table.partitions).write.partitionBy(*table.partitions)
    writer.parquet(f"{table.path}/data/commit={commit}")


def _write_keys(table: Snapshot, commit: str) -> None:
    rows = _new_files(table, commit)
    if rows is not None and table.keys:
        index = rows.select(key_hash(table.keys).alias("hash"), FILE).where("hash IS NOT NULL").withColumn("bucket", _bucket())
        index.repartition("bucket").sortWithinPartitions("bucket", "hash").write.partitionBy("bucket").parquet(
            f"{table.path}/keys/commit={commit}")


def _write_version(table: Snapshot, removed: DataFrame | None, commit: str) -> None:
    kind = f"{FILE} string, commit string, rows long"
    files = table.files if table.number else table.spark.createDataFrame([], kind)
    if removed is not None:
        files = files.join(removed.select(FILE), FILE, "left_anti")
    rows = _new_files(table, commit)
    if rows is not None:
        new = rows.groupBy(FILE).agg(F.count("*").alias("rows"))
        files = files.select(FILE, "commit", "rows").unionByName(new.select(FILE, F.lit(commit).alias("commit"), "rows"))
    folder = f"{table.path}/versions/_{commit}"
    files.write.parquet(f"{folder}/files")
    about = {"schema": table.schema.jsonValue(), "partitions": table.partitions, "keys": table.keys}
    table.spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{folder}/about")


def _publish(table: Snapshot, commit: str) -> Snapshot:
    """The rename that makes a version the current one; it fails if somebody else has published this number."""
    jvm, gateway = table.spark.sparkContext._jvm, table.spark.sparkContext._gateway
    place, _ = _hadoop(table.spark, f"{table.path}/versions/_{commit}")
    number = table.number + 1
    target, _ = _hadoop(table.spark, f"{table.path}/versions/{number}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), table.spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(place, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    return Snapshot(table.spark, table.path, number, table.schema, table.partitions, table.keys)


def create(spark: SparkSession, path: str, rows: DataFrame, partitions: list[str], keys: list[str]) -> Snapshot:
    """A new table of ``rows``, with an index on ``keys`` (none for no index)."""
    names = [c for c in rows.columns if c not in partitions] + partitions
    schema = StructType([rows.schema[n] for n in names])
    return Snapshot(spark, path, 0, schema, partitions, keys).replace(None, rows)


def current(spark: SparkSession, path: str, number: int | None = None) -> Snapshot:
    """The latest version of a table, or an older one."""
    number = max(_versions(spark, path)) if number is None else number
    about = json.loads(spark.read.text(f"{path}/versions/{number}/about").first()["value"])
    return Snapshot(spark, path, number, StructType.fromJson(about["schema"]), about["partitions"], about["keys"])


def read(spark: SparkSession, path: str) -> DataFrame:
    return current(spark, path).data()


def upsert(spark: SparkSession, path: str, staging: DataFrame, as_of: Column | None = None, key: str = "event_id",
           order: tuple[str, ...] = ("timestamp",), updated: list[str] | None = None) -> Snapshot:
    """Update the rows whose key is staged and add the others; of the old files those with such a key are rewritten."""
    table = current(spark, path)
    touched = table.matched(staging, [key])
    rows = table.rows(touched).drop(FILE)
    return table.replace(touched, upserted(rows, staging, as_of, order, key, updated))


def replace_rows(spark: SparkSession, path: str, rows: DataFrame, keys: list[str]) -> Snapshot:
    """Put ``rows`` in place of all rows of the table that share their keys."""
    table, rows = current(spark, path), stored(rows, "rows")
    touched = table.matched(rows, keys)
    kept = table.rows(touched).drop(FILE).join(rows.select(*keys).distinct(), keys, "left_anti")
    return table.replace(touched, kept.unionByName(rows))


def erase(spark: SparkSession, path: str, erased: DataFrame, keys: list[str]) -> Snapshot:
    """Remove all rows that share the ``keys`` of ``erased``, from the table and from its folder."""
    table = current(spark, path)
    touched = table.matched(erased, keys)
    kept = table.rows(touched).drop(FILE).join(erased.select(*keys).distinct(), keys, "left_anti")
    table = table.replace(touched, kept)
    vacuum(spark, path)
    return table


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete the files that only older versions name, then these versions: a stopped run can be repeated."""
    table = current(spark, path)
    older = [n for n in _versions(spark, path) if n < table.number]
    if not older:
        return
    named = reduce(DataFrame.unionByName, [current(spark, path, n).files for n in older]).select(FILE, "commit").distinct()
    dead = stored(named.join(table.files, FILE, "left_anti"), "dead")
    commits = named.select("commit").distinct().join(table.files.select("commit").distinct(), "commit", "left_anti")
    gone = [f"data/{r[FILE]}" for r in dead.select(FILE).toLocalIterator()]
    gone += [f"{part}/commit={r['commit']}" for r in commits.collect() for part in ("data", "keys")]
    for name in [*gone, *(f"versions/{n}" for n in older)]:
        place, files = _hadoop(spark, f"{path}/{name}")
        if files.exists(place) and not files.delete(place, True):
            raise OSError(f"{place} is still there")
