"""What several operators share: words, the learning split, and passes over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text leaves 1 modulo 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def texts_as_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_texts(df: DataFrame, schema: str, build: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """Map Arrow batches to columns of ``schema``; each task holds one batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = build(batch)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return df.mapInArrow(run, schema)


def hash_sample(df: DataFrame, size: int, by: str) -> DataFrame:
    """At most ``size`` different rows for each value of ``by``, the same ones on every run.

    Rows are drawn by a hash of all their columns, so equal rows are one and an id that repeats with
    other texts is drawn like any other. The hash thins the table to a little more than is wanted,
    what is left is made distinct inside the tasks first, and a limit ends it exactly. ``by`` is to
    have few values, which are listed on the driver.
    """
    drawn = df.withColumn("draw", F.xxhash64(F.lit("sample"), *df.columns))
    counts = drawn.groupBy(by).agg(F.approx_count_distinct("draw", 0.02).alias("n")).collect()
    out = df.limit(0)
    for value, n in counts:
        own = drawn.where(F.col(by).eqNullSafe(F.lit(value)))
        thinned = own.where(F.pmod("draw", F.lit(1_000_000)) < int(1_200_000 * size / n)) if n > size else own
        once = thinned.groupBy("draw").agg(F.min(F.struct(*df.columns)).alias("row"))
        out = out.union(once.orderBy("draw").limit(size).select("row.*"))
    return out


def spread_join(rows: DataFrame, table: DataFrame, key: str, shares: int = 1000) -> DataFrame:
    """``rows`` with the columns of ``table``, which has a row per key and the key's number of ``rows`` in n.

    A key that holds over a ``shares``-th of all rows would put them into one task. There are fewer than
    ``shares`` such keys, whatever the size, so their part of the table is broadcast and their rows stay
    where they are; the rest is joined by key.
    """
    total = table.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * shares > F.lit(total)
    few, rest = F.broadcast(table.where(hot).drop("n")), table.where(~hot).drop("n")
    return rows.join(few, key).unionByName(rows.join(F.broadcast(table.where(hot).select(key)), key, "left_anti").join(rest, key))
