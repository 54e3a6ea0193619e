"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

#: Rows per Arrow batch sent to Python. Texts may be long, so batches are small.
ARROW_ROWS = 256
#: Code points that a task works on at once inside a batch.
GROUP_CHARS = 2_000_000
#: Bits of a map of ids: 4 MB to broadcast, whatever the corpus.
ID_BITS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Send this library to the Python workers, once per application, so that
    tasks can import it wherever they run."""
    sc = spark.sparkContext
    if any(os.path.basename(str(f)) == "starforge.zip" for f in sc.listFiles):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="starforge-code-"), "starforge.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Arrow batches of whole texts."""
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def flag_ids(df: DataFrame, id_col: str, ids: DataFrame, flag: str) -> DataFrame:
    """``df`` with the boolean column ``flag``, false only for rows whose id is
    none of the one column of ``ids`` (null counts as an id). A bit map of fixed
    size is broadcast, so no row of ``df`` is shuffled; the fuller it is, the
    more other rows are flagged too."""
    def slot(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << ID_BITS)) + 1

    own = slot(ids[ids.columns[0]])
    bits = (ids.select(F.bitmap_bucket_number(own).alias("bucket"), F.bitmap_bit_position(own).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
    bucket, held = fresh(df, "_bucket"), fresh(df, "_bits")
    found = df.join(F.broadcast(bits.select(F.col("bucket").alias(bucket), F.col("bits").alias(held))), F.bitmap_bucket_number(slot(df[id_col])) == F.col(bucket), "left")
    at = F.bitmap_bit_position(slot(df[id_col]))
    byte = F.conv(F.hex(F.substring(held, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    set_ = F.coalesce(F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
    return found.withColumn(flag, set_).drop(bucket, held)


def text_groups(texts: list, chars: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Runs of rows holding about ``chars`` code points; a longer text is a run
    of its own."""
    a, size = 0, 0
    for b, t in enumerate(texts):
        n = len(t) if t else 0
        if b > a and size + n > chars:
            yield a, b
            a, size = b, 0
        size += n
    if len(texts) > a:
        yield a, len(texts)


def map_texts(df: DataFrame, id_col: str, text_col: str, fn, fields: list[tuple[str, pa.DataType]], carry: bool = False) -> DataFrame:
    """``fn(ids, texts) -> dict of lists`` over runs of whole texts (None
    becomes the empty text), without a shuffle. The result has the columns of
    ``fields``; with ``carry`` they follow all columns of ``df``, and ``fn``
    must give one value per row."""
    small_batches(df.sparkSession)
    new = pa.schema(fields)
    added = [T.StructField(f.name, from_arrow_type(f.type)) for f in new]
    source = df if carry else df.select(df[id_col], df[text_col])
    at = [source.columns.index(id_col), source.columns.index(text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (batch.column(i).to_pylist() for i in at)
            for a, b in text_groups(texts):
                cols = fn(ids[a:b], [t or "" for t in texts[a:b]])
                made = [pa.array(cols[f.name], type=f.type) for f in new]
                if carry:
                    part = batch.slice(a, b - a)
                    yield pa.RecordBatch.from_arrays([*part.columns, *made], schema=pa.schema([*part.schema, *new]))
                else:
                    yield pa.RecordBatch.from_arrays(made, schema=new)

    return source.mapInArrow(run, T.StructType([*(df.schema.fields if carry else []), *added]))
