"""Small helpers shared by the operators of this package."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from clickloom.session import configure, fresh_path

# The separators of words in the contracts: space and the five ASCII control spaces.
SPACES = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text between ASCII white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_, name__, ... that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns of ``like`` alone."""
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and kept when executors are lost."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """About ``n`` rows, and never more than 2 * n: those with the smallest hashes of ``keys``.

    The rows are counted first, so that a hash bound picks them where they are; no task sends more than its share.
    """
    total = df.count()
    if total > n:
        df = df.where(F.xxhash64(*keys) < F.lit(int((1 << 64) * n / total) - (1 << 63)))
    return df.limit(2 * n)


def held_out(doc_id: Column) -> Column:
    """The fold of the contracts: crc32 of the id as text leaves remainder 1 by 3. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def annotated(docs: DataFrame, column: str, kind: DataType, compute: Callable[[list], pa.Array]) -> DataFrame:
    """``docs`` with all its columns and ``column``, computed from the texts of a batch; an older one is replaced."""
    docs = docs.drop(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                yield batch.append_column(column, compute(batch.column("text").to_pylist()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, kind)]))
