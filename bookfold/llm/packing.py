"""Length buckets that minimise padding, and token-budget batches inside each bucket.

The global histogram of lengths has a bounded number of bins (one per length up to 512, then 64 per doubling).
Dynamic programming over it picks the bucket boundaries with the least total padding. Within a bucket, documents
are numbered without a gap, and each run of ``budget // boundary`` documents (one at least) is a batch, so that only
the last batch of a bucket can be short.

Numbering is distributed: a bucket is cut into segments of about ``SEGMENT_ROWS`` rows by a hash of the row, rows
are numbered within a segment, and the running total of segment counts is added.

Edge cases: a null or empty text has length 1 (its end token). A document longer than the budget is a batch of its
own. An empty table gives no rows. Repeated rows are packed as documents of their own. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookfold.llm.common import WORD, only, stored

SEGMENT_ROWS = 5_000
_EXACT, _FINE = 512, 6


def word_length(text: Column) -> Column:
    """Words of the text and one end token."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long") + 1


def length_bin(length: Column) -> Column:
    """The length itself up to 512; above, rounded up to one of 64 steps per doubling."""
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(length.cast("double"))) - _FINE, F.lit(0))).cast("long")
    return F.when(length <= _EXACT, length).otherwise((F.ceil(length / step) * step).cast("long"))


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, n_buckets: int) -> list[int]:
    """Upper ends of at most ``n_buckets`` buckets over sorted ``lengths`` that minimise the summed padded length."""
    size = len(lengths)
    if not size:
        return []
    below = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    tops = lengths.astype(np.float64)
    cost = np.where(np.arange(size + 1) == 0, 0.0, np.inf)
    chosen = []
    for _ in range(min(n_buckets, size)):
        nxt, back = np.full(size + 1, np.inf), np.zeros(size + 1, np.int64)
        for j in range(1, size + 1):
            options = cost[:j] + tops[j - 1] * (below[j] - below[:j])
            back[j] = int(np.argmin(options))
            nxt[j] = options[back[j]]
        chosen.append(back)
        cost = nxt
    # Using every bucket is never worse than using fewer, as lengths are distinct.
    ends, j = [], size
    for back in reversed(chosen):
        ends.append(int(lengths[j - 1]))
        j = int(back[j])
    return ends[::-1]


def pack_documents(docs: DataFrame, n_buckets: int = 16, budget: int = 16_384, length: Column | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, bucket (from 0), padded (the bucket's boundary), batch_id and slot (from 0)."""
    spark = docs.sparkSession
    measure = word_length(F.col(f"`{text_column}`")) if length is None else length
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), measure.alias("n_tokens"), F.xxhash64(f"`{id_column}`", f"`{text_column}`").alias("place"))
    rows = stored(rows, "lengths")
    bins = rows.groupBy(length_bin(F.col("n_tokens")).alias("bin")).agg(F.max("n_tokens").alias("top"), F.count("*").alias("n"))
    histogram = sorted((r["top"], r["n"]) for r in bins.collect())
    ends = best_boundaries(np.array([t for t, _ in histogram], np.int64), np.array([n for _, n in histogram], np.int64), n_buckets)
    if not ends:
        return spark.createDataFrame([], f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, bucket int, padded long, batch_id string, slot int")
    sizes = [sum(n for t, n in histogram if low < t <= high) for low, high in zip([0, *ends], ends)]
    segments = [max(1, -(-n // SEGMENT_ROWS)) for n in sizes]

    bucket = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e < F.col("n_tokens")))
    dealt = rows.withColumn("bucket", bucket).withColumns({
        "padded": F.get(F.array(*[F.lit(e).cast("long") for e in ends]), F.col("bucket")),
        "segment": F.floor((F.shiftrightunsigned("place", 11) / F.lit(2.0**53)) * F.get(F.array(*[F.lit(s) for s in segments]), F.col("bucket"))),
    })
    counts = dealt.groupBy("bucket", "segment").agg(F.count("*").alias("n"))
    before = counts.select("bucket", "segment", (F.sum("n").over(Window.partitionBy("bucket").orderBy("segment")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("bucket", "segment").orderBy("place", "doc_id", "n_tokens"))
    numbered = dealt.withColumn("within", within).join(stored(before, "segments"), ["bucket", "segment"])
    number = (F.col("before") + F.col("within") - 1).cast("long")
    capacity = F.greatest(F.lit(1).cast("long"), F.expr(f"cast({int(budget)} as bigint) div padded"))
    packed = numbered.withColumns({"number": number, "capacity": capacity})
    return packed.select(
        "doc_id",
        "n_tokens",
        "bucket",
        "padded",
        F.concat_ws("-", F.col("bucket").cast("string"), F.expr("cast(number div capacity as string)")).alias("batch_id"),
        (F.col("number") % F.col("capacity")).cast("int").alias("slot"),
    )
