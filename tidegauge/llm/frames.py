"""Small steps that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegauge.llm.tokens import pieces
from tidegauge.sources.workspace import Scratch

#: Copies of the small side of a lookup whose keys may hold a third of all rows.
SALTS = 16
#: Times the bytes of a written table that its rows may take in memory.
IN_MEMORY = 4
#: Hashes that are looked up in a bitmap at once.
LOOKED_UP = 1 << 16


Work = Callable[[pa.RecordBatch], pa.RecordBatch]


def as_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` as bigint and ``text`` as string, and no other column."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def by_piece(
    df: DataFrame, columns: list[str], work: Work, schema: str, most: int | None = None
) -> DataFrame:
    """Apply ``work`` to Arrow batches of ``columns`` with a bounded amount of text.

    ``text`` must be among the columns; a row is whole, whatever its length. ``most`` is
    as in :func:`pieces`: less for work that holds much per byte of text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, batch.column("text"), most):
                yield work(piece)

    return df.select(*columns).mapInArrow(run, schema)


def with_columns_by_piece(
    docs: DataFrame, work: Callable[[pa.Array], list[pa.Array]], added: str
) -> DataFrame:
    """``row`` with all columns of ``docs``, whatever their names, and columns made of its text.

    ``work`` gets a bounded number of texts and returns the arrays of ``added``.
    """
    rows = docs.select(F.struct("*").alias("row"))
    schema = StructType(rows.schema.fields + StructType.fromDDL(added).fields)
    names = schema.fieldNames()

    def texts_of(batch: pa.RecordBatch) -> pa.Array:
        return batch.column("row").field("text").cast(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, texts_of(batch)):
                yield pa.RecordBatch.from_arrays([piece.column("row"), *work(texts_of(piece))], names)

    return rows.mapInArrow(run, schema)


def _bit_place(hashed: Column, bits: int) -> Column:
    """Spark's bit functions count from 1."""
    return hashed.bitwiseAND(F.lit((1 << bits) - 1)) + 1


def bitmap_table(hashes: DataFrame, bits: int, scratch: Scratch, label: str) -> DataFrame:
    """``bucket, bits`` of the residues modulo 2**bits that the one column of ``hashes`` takes.

    Of fixed size whatever the number of rows, 2**bits / 8 bytes, for :func:`split_by`.
    """
    place = _bit_place(F.col(hashes.columns[0]), bits)
    parts = hashes.select(
        F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_position")
    )
    table = parts.groupBy("_bucket").agg(F.bitmap_construct_agg("_position").alias("_bits"))
    return scratch.table(table.coalesce(1), label)


def split_by(rows: DataFrame, hashed: Column, bitmap: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows whose hash may be in a table of :func:`bitmap_table`, and those whose can't.

    ``bitmap`` is broadcast, as its size is fixed. No row is shuffled, so that a join has
    to move the first part only; both parts read ``rows`` anew.
    """
    place = _bit_place(hashed, bits)
    position = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, (position % 8).cast("int"))
    marked = rows.withColumn("_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(bitmap), "_bucket", "left")
    marked = marked.withColumn("_may", F.coalesce(bit, F.lit(0)) == 1)
    may, cannot = marked.where("_may"), marked.where("not _may")
    return may.select(*rows.columns), cannot.select(*rows.columns)


def hash_bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which residues modulo 2**bits the hashes in ``column`` take, as packed bits.

    A filter of fixed size, whatever the number of rows: 2**bits / 8 bytes reach the
    driver. It never misses a hash that is present; others may pass, so an exact join
    must follow. ``bits`` is 15 or more.
    """
    parts = (
        df.select(_bit_place(F.col(column), bits).alias("residue"))
        .groupBy(F.bitmap_bucket_number("residue").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("residue")).alias("bits"))
        .collect()
    )
    bitmap = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for bucket, part in parts:
        begin = (bucket - 1) * 4096
        bitmap[begin : begin + 4096] = np.frombuffer(bytes(part), dtype=np.uint8)
    return bitmap


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which ``hashes`` may be in a bitmap of :func:`hash_bitmap`, some at a time to hold little."""
    found = np.empty(len(hashes), dtype=bool)
    for at in range(0, len(hashes), LOOKED_UP):
        place = hashes[at : at + LOOKED_UP] & np.uint64(8 * len(bitmap) - 1)
        shift = (place & np.uint64(7)).astype(np.uint8)
        found[at : at + LOOKED_UP] = (bitmap[place >> np.uint64(3)] >> shift) & 1
    return found


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def _is_small(df: DataFrame) -> bool:
    """Whether Spark's estimate of ``df``, in bytes, is well below what it broadcasts."""
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size * IN_MEMORY <= most


def lookup(
    many: DataFrame, few: DataFrame, key: str, spread: list[str], how: str = "inner", keep_salt: bool = False
) -> DataFrame:
    """Join rows with the one row of ``few`` for their key, without gathering a hot key.

    Where the size of ``few`` is known to be small, as of a written table, it is
    broadcast. Otherwise the rows of a key are dealt to ``SALTS`` tasks by ``spread``, to
    each of which goes a copy of the key's row. Both give the same rows. ``keep_salt``
    leaves the task's number as ``_salt``.
    """
    many = many.withColumn("_salt", salt(*spread))
    if _is_small(few):
        found = many.join(F.broadcast(few), key, how)
    else:
        copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = many.join(copies.hint("merge"), [key, "_salt"], how)
    return found if keep_salt else found.drop("_salt")
