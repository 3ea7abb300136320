"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.session import new_work_dir

#: ASCII white space, the only separators of a word: ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    computes it once, and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{new_work_dir(spark, 'llm')}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def remove_table(table: DataFrame) -> None:
    """Remove a table of ``shared_table`` that nothing will read again."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.shared_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path.getParent(), True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text is empty."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def hash_share(place: Column, wanted: int, total) -> Column:
    """Whether a row, by its hash ``place``, is among about twice ``wanted`` of
    ``total`` rows. Ahead of an exact choice of the first ``wanted`` by hash:
    what is gathered to rank stays bounded, however many tasks give rows."""
    share = F.least(F.lit(1.0), F.lit(2.0 * wanted + 100) / total)
    return F.shiftrightunsigned(place, 11) < share * F.lit(float(1 << 53))


def schema_with(docs: DataFrame, added: list[tuple[str, str]], text_col: str | None = None) -> T.StructType:
    """``docs``' schema without columns that clash with ``added``, then ``added``."""
    names = {n for n, _ in added}
    out = T.StructType([f for f in docs.schema.fields if f.name not in names])
    if text_col:
        out = T.StructType([T.StructField(f.name, T.StringType()) if f.name == text_col else f for f in out])
    return T.StructType(out.fields + [T.StructField(n, T.StructType.fromDDL(f"c {kind}")["c"].dataType) for n, kind in added])


def batch_of(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    """A record batch from numpy arrays, lists or Arrow arrays."""
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=t)
              for c, (_, t) in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in schema])
