"""What the corpus operators share: reading tables, cutting lineage in the shared folder, words and hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookfold.session import shared_folder

#: Words of a text: runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back: lost executors re-read files, not lineage."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def words_of(text: str | None) -> list[bytes]:
    """Words of the whole text, as bytes, A-Z lower-cased. ``bytes.split`` splits at the six characters of WORD."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x + _GOLDEN).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_sequence(words: list[bytes], width: int) -> np.ndarray:
    """Hash of each run of ``width`` words in text order; of the whole sequence if it is shorter; empty without words."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    width = min(width, len(words))
    count = len(words) - width + 1
    rolled = np.full(count, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            rolled = mixed(rolled * _MIX1 + hashes[k : k + count])
    return rolled


def arrow_rows(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that what a task holds does not depend on the batch size."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_slices(batches: Iterable[pa.RecordBatch], rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows and, unless one row is larger, ``size`` bytes of text."""
    for batch in arrow_rows(batches, rows):
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])


def long_lists(arrays: list[np.ndarray]) -> pa.Array:
    """Integer arrays as one Arrow column of lists, bits kept."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def only(frame: DataFrame, **columns: str) -> DataFrame:
    """The named columns under internal names; other columns, whatever they are called, do not take part."""
    return frame.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


#: A key with this many of the sampled rows is heavy: it stands for about 64 times as many.
HEAVY_SAMPLED = 16


def heavy_keys(sampled: DataFrame, key: str) -> DataFrame:
    """Keys frequent in a sample of one row owner in 64: at most rows / (64 * HEAVY_SAMPLED) of them, written out."""
    return stored(sampled.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") >= HEAVY_SAMPLED).select(key, F.lit(True).alias("heavy")), "heavy-keys")


def shared_by_two(rows: DataFrame, key: str, owner: str, heavy: DataFrame) -> DataFrame:
    """The rows whose key occurs more than once. One shuffle by key; heavy keys, which surely do, are dealt out by owner
    instead, so that no task gets all rows of one."""
    marked = rows.join(heavy, key, "left")
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64(owner), F.lit(1 << 20))).otherwise(0)
    order = Window.partitionBy(key, salt).orderBy(owner)
    marked = marked.withColumns({"before": F.lag(owner).over(order), "after": F.lead(owner).over(order)})
    return marked.filter("before is not null or after is not null or heavy").drop("before", "after", "heavy")
