"""N-gram Jaccard join by parity sketches.

A document is its set of distinct runs of ``width`` words (the whole sequence if shorter). Two documents link when
``100 * intersection >= percent * union``. The join is exact up to collisions of 64-bit hashes.

*Sketch.* A set's hashes are XORed into a bit sketch: each hash has a chunk and a place in it, and each element flips one
place. Sets that differ in d elements have sketches that differ in at most d places, hence in at most d chunks. A chunk is
a word of 2^64 virtual bits kept as the XOR of its hashes. Two more sketches bound the symmetric difference from below by
their Hamming distance: a dense one of ``DENSE_BITS`` bits, and a broad one of at least two bits an element.

*Pigeonhole per size band.* Linked sets of n elements (the smaller) differ in at most ``D = n (100 - percent) / percent``
elements. A size band has one number of chunks; a set with K non-empty chunks shares K - D of them at least with any
partner, so its first D + 1 non-empty chunks in chunk order contain a shared one, and its first D + 1 + x at
least 1 + x. Sets emit those as keys, in their own band and, if a larger partner may lie there, in the next.
Sets that share fewer than the guaranteed number of keys with others have no partner and leave early.

*Groups without all pairs.* Equal sets are one node from the start. Within a key, every set is first tried against the
smallest one there (stars); verified links are contracted to components; after that only pairs of different components
that still share a key are tried, and only those whose dense sketches allow a link and that share the guaranteed number of
keys. No link between components is lost, and pairs inside a component are never listed.

*Verification* first compares the broad sketches, a thirtieth of the sets' size. Exact sets are fetched for the pairs
that are left: a scan keeps the documents whose ids fall in a bitmap of fixed size, and the exact join follows.

Edge cases: null or empty texts, or texts without words, have the empty set and link with nothing. Rows without an id get
no component (null) and link nothing. Rows that share an id and differ in text are separate rows of one document: their
sets count as one node where that id is the smallest of the set's. Repeated rows repeat in the result. Empty tables give
no rows. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookfold.llm.common import arrow_rows, heavy_keys, long_lists, mixed, only, shared_by_two, shingle_sequence, stored, words_of
from bookfold.llm.components import components

DENSE_BITS = 512
#: Bits of the bitmap that thins a scan to candidate documents: 2 MiB whatever the table's size.
BITMAP_BITS = 1 << 24
#: Sets below this size have one element per chunk; bands above grow by the ratio of 7 to 2.
SMALL_SET = 128
_ROWS = 256
_WHOLE = np.uint64(0xFFFFFFFF)


def band_start(band: int) -> int:
    """Smallest set size of a band; band 0 starts at 0."""
    return 0 if band == 0 else SMALL_SET * 7 ** (band - 1) // 2 ** (band - 1)


def band_of(size: int) -> int:
    band = 0
    while size >= band_start(band + 1):
        band += 1
    return band


def band_chunks(band: int) -> int:
    """Chunks of a band's sketches: at most 2.1 elements a chunk, so that far more than D + 1 chunks hold any."""
    return 1 << 32 if band == 0 else -(-band_start(band + 1) * 10 // 21)


def difference_bound(size: int, percent: int) -> int:
    """Most elements in which a set of this size can differ from a linked one that is not smaller."""
    return size * (100 - percent) // percent


def spare_keys(size: int, percent: int) -> int:
    return difference_bound(size, percent) // 8


def keys_shared(size: int, percent: int) -> int:
    """Keys that a set shares at least with every partner; partners can be smaller by ``percent``."""
    return 1 + spare_keys(-(-size * percent // 100), percent)


def sketch_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set in its own size band and, where larger partners may be, in the next."""
    size = len(hashes)
    count = difference_bound(size, percent) + 1 + spare_keys(size, percent)
    band = band_of(size)
    bands = [band, band + 1] if size * 100 // percent >= band_start(band + 1) else [band]
    keys = []
    for b in bands:
        chunk = (hashes >> np.uint64(17)) % np.uint64(band_chunks(b))
        order = np.argsort(chunk, kind="stable")
        chunk = chunk[order]
        first = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
        folded = np.bitwise_xor.reduceat(hashes[order], first)
        place = mixed(chunk[first] ^ (np.uint64(b + 1) << np.uint64(40)))
        keys.append(mixed(folded ^ place)[:count])
    return np.concatenate(keys)


def dense_sketch(hashes: np.ndarray) -> np.ndarray:
    places = (hashes >> np.uint64(64 - DENSE_BITS.bit_length() + 1)).astype(np.int64)
    parity = (np.bincount(places, minlength=DENSE_BITS) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.uint64)


def broad_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity sketch with two to four bits an element, 64 at least; its size is a power of two."""
    bits = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    parity = (np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.uint64)


def folded_to(sketch: np.ndarray, words: int) -> np.ndarray:
    """A broad sketch brought to a smaller size: places that coincide there are XORed."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    return np.unique(shingle_sequence(words_of(text), width))


def _sketched(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, two halves of the set's fingerprint, keys, dense and broad sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.uint64)
        for batch in arrow_rows(batches, _ROWS):
            sets = [shingle_set(t, width) for t in batch.column("text").to_pylist()]
            prints = np.array([[np.bitwise_xor.reduce(s), mixed(s ^ _WHOLE).sum(dtype=np.uint64)] if len(s) else [0, 0] for s in sets], np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(prints[:, 0].copy().view(np.int64)),
                    pa.array(prints[:, 1].copy().view(np.int64)),
                    long_lists([sketch_keys(s, percent) if len(s) else none for s in sets]),
                    long_lists([dense_sketch(s) if len(s) else none for s in sets]),
                    long_lists([broad_sketch(s) if len(s) else none for s in sets]),
                ],
                names=["doc_id", "n", "print1", "print2", "keys", "dense", "broad"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sketch, f"doc_id {kind}, n long, print1 long, print2 long, keys array<long>, dense array<long>, broad array<long>")


def id_bitmap(ids: DataFrame) -> bytes:
    """Which of BITMAP_BITS hash places are taken by the ids (column id)."""
    place = F.pmod(F.xxhash64("id"), F.lit(BITMAP_BITS))
    taken = ids.select((place / 32768).cast("int").alias("block"), (place % 32768).alias("bit"))
    blocks = taken.groupBy("block").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect()
    whole = bytearray(BITMAP_BITS // 8)
    for row in blocks:
        whole[row["block"] * 4096 : (row["block"] + 1) * 4096] = row["bits"]
    return bytes(whole)


def in_bitmap(batches: Iterator[pa.RecordBatch], bitmap: bytes) -> Iterator[pa.RecordBatch]:
    """The rows whose hash place (column place) is taken."""
    bits = np.frombuffer(bitmap, np.uint8)
    for batch in batches:
        place = batch.column("place").to_numpy()
        yield batch.filter(pa.array((bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)))


def exact_sets(rows: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """set_id and its sorted hashes, for the documents named by ``ids`` (column id)."""
    taken = rows.sparkSession.sparkContext.broadcast(id_bitmap(ids))
    placed = rows.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS)).alias("place"), "text")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_rows(in_bitmap(batches, taken.value), _ROWS):
            sets = [shingle_set(t, width) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), long_lists(sets)], names=["set_id", "hashes"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    fetched = placed.filter("doc_id is not null").mapInArrow(fetch, f"set_id {kind}, hashes array<long>")
    return fetched.join(ids.select(F.col("id").alias("set_id")), "set_id", "left_semi")


def _plausible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and broad sketches allow a link."""
    both = pairs
    for side in "ab":
        both = both.join(sketches.select(F.col("set_id").alias(side), F.col("n").alias(f"n_{side}"), F.col("broad").alias(f"broad_{side}")), side)
    both = both.filter(_near("n_a", "n_b", percent))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            apart = np.empty(batch.num_rows, np.int64)
            for i, (a, b) in enumerate(zip(batch.column("broad_a"), batch.column("broad_b"))):
                x, y = np.asarray(a.values).view(np.uint64), np.asarray(b.values).view(np.uint64)
                words = min(len(x), len(y))
                apart[i] = np.bitwise_count(folded_to(x, words) ^ folded_to(y, words)).sum()
            yield batch.select(["a", "b"]).filter(pa.array(apart * (100 + percent) <= total * (100 - percent)))

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(compared, f"a {kind}, b {kind}")


def _linked(pairs: DataFrame, rows: DataFrame, sketches: DataFrame, width: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) that link: by their broad sketches, then by their exact sets."""
    left = stored(_plausible(pairs, sketches, percent).distinct(), f"{name}-pairs")
    sets = exact_sets(rows, left.select(F.col("a").alias("id")).union(left.select("b")).distinct(), width)
    return stored(_verified(left, stored(sets, f"{name}-sets"), percent), f"{name}-links")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their exact sets."""
    both = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("hashes").alias("set_a")), "a")
    both = both.join(sets.select(F.col("set_id").alias("b"), F.col("hashes").alias("set_b")), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return both.filter(shared * 100 >= union * percent).select("a", "b")


def _near(n_a: str, n_b: str, percent: int) -> Column:
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent


def _may_link(percent: int) -> Column:
    """Sizes within the ratio, and a Hamming distance that the sizes allow: |a ^ b| <= (n_a + n_b)(100 - p)/(100 + p)."""
    # Written out word by word: higher-order functions would leave the compiled join condition.
    apart = sum((F.bit_count(F.col("dense_a")[i].bitwiseXOR(F.col("dense_b")[i])) for i in range(DENSE_BITS // 64)), F.lit(0))
    return _near("n_a", "n_b", percent) & (apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included)."""
    rows = only(docs, doc_id=id_column, text=text_column)
    sketches = stored(_sketched(rows, width, percent), "sketches")
    fingerprint = ["print1", "print2", "n"]
    full = sketches.filter("n > 0 and doc_id is not null")
    # Equal sets have equal keys and sketches, so any row's will do; map-side sums leave one row per set and task.
    sets = full.groupBy(*fingerprint).agg(F.min("doc_id").alias("set_id"), F.first("keys").alias("keys"), F.first("dense").alias("dense"))

    held = sets.select("set_id", "n", F.explode("keys").alias("key"))
    sampled = full.filter(F.pmod("print1", F.lit(64)) == 0).dropDuplicates(fingerprint)
    heavy = heavy_keys(sampled.select(F.explode("keys").alias("key")), "key")
    shared = stored(shared_by_two(held, "key", "set_id", heavy).select("key", "set_id", "n"), "shared-keys")
    needed = F.lit(1) + F.floor(F.floor(F.ceil(F.col("n") * percent / 100) * (100 - percent) / percent) / 8)
    alive = shared.groupBy("set_id", "n").agg(F.count("*").alias("keys")).filter(F.col("keys") >= needed)
    alive = stored(alive.select("set_id", "n"), "alive")
    keys = stored(shared.join(alive.select("set_id"), "set_id", "left_semi"), "keys")

    sketched = full.select(F.col("doc_id").alias("set_id"), "n", "dense", "broad")
    sketched = stored(sketched.join(alive, ["set_id", "n"], "left_semi"), "live-sketches")
    links = _linked(_stars(keys), rows, sketched, width, percent, "star")
    named = components(links)
    links = links.union(_linked(_cross_pairs(_marked(keys, named), sketched, percent), rows, sketched, width, percent, "cross"))
    named = components(links)

    members = sketches.select("doc_id", *fingerprint)
    owners = stored(full.groupBy(*fingerprint).agg(F.min("doc_id").alias("set_id")), "owners")
    owned = members.join(owners, fingerprint, "left")
    labelled = owned.join(named.withColumnRenamed("node", "set_id"), "set_id", "left")
    return labelled.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "set_id", "doc_id").alias("component_id"))


def _marked(keys: DataFrame, named: DataFrame) -> DataFrame:
    """Keys that still hold different components, with each set's component."""
    marked = keys.join(named.withColumnRenamed("node", "set_id"), "set_id", "left")
    marked = stored(marked.withColumn("component", F.coalesce("component", "set_id")), "marked")
    mixed_keys = marked.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    return stored(marked.join(mixed_keys.select("key"), "key", "left_semi"), "mixed-keys")


def _stars(keys: DataFrame) -> DataFrame:
    """Each set with the centre, first in its keys, with which it shares most keys."""
    first = keys.groupBy("key").agg(F.min("set_id").alias("a"))
    centred = keys.join(first, "key").filter("a <> set_id")
    shared = centred.groupBy("set_id", "a").agg(F.count("*").alias("keys"))
    return shared.groupBy(F.col("set_id").alias("b")).agg(F.max_by("a", F.struct("keys", -F.col("a"))).alias("a")).select("a", "b")


def _cross_pairs(marked: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Sets of different components that share as many keys as linked sets do."""
    whole = stored(marked.join(sketches.select("set_id", "n", "dense"), ["set_id", "n"]), "marked-sketches")
    left, right = (whole.select([F.col(c).alias(f"{c}_{side}") for c in whole.columns]) for side in "ab")
    joined = left.join(right, (F.col("key_a") == F.col("key_b")) & (F.col("component_a") < F.col("component_b")) & _may_link(percent))
    pairs = joined.groupBy(F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b")).agg(F.count("*").alias("keys"), F.min(F.least("n_a", "n_b")).alias("n"))
    guaranteed = F.lit(1) + F.floor(F.floor(F.col("n") * (100 - percent) / percent) / 8)
    return pairs.filter(F.col("keys") >= guaranteed).select("a", "b")
