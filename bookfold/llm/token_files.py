"""Token-id files: one concatenated id array, document boundaries in Elias-Fano code.

Documents are range-partitioned and sorted by id, encoded with the ``tokenizers`` library, and written as
segments of about ``SEGMENT_IDS`` ids. A segment is one record of a Parquet dataset (atomic commit, any store
that Spark can write to):

===========  ==========================================================================================
part, seq    place of the segment in document order
doc_ids      the documents' ids, in order
n_ids        ids in the segment
id_bytes     2 if the vocabulary fits 16 bits, else 4
ids          all ids, little-endian, ``id_bytes`` each
low_bits     l = floor(log2(n_ids / documents)), 0 at least
low          the l low bits of each document's end, packed
high         bit vector: the i-th one is at (end_i >> l) + i
samples      position in ``high`` of every 64th one, 32 bits each: the select structure
===========  ==========================================================================================

The end of document i is ``(select(i) - i) << l | low_i``: 2 + l bits a document instead of 64.

Beside them an index holds, for each segment, the ids before it. It has one row per segment.

Edge cases: a null or empty text is a document of the end id alone. Ties of ids are ordered by a hash of the text;
null ids come first. Repeated rows are documents of their own. An empty table gives files without records. Other
columns play no part.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookfold.llm.common import arrow_rows, only, text_slices
from bookfold.llm.pieces import BARE, PieceMemory, piece_text

SEGMENT_IDS = 2_000_000
MEMO_PIECES = 400_000
#: Index rows up to which the index is broadcast (32 bytes each); beyond, it is joined by a shuffle.
BROADCAST_SEGMENTS = 200_000
_SAMPLE = 64
#: Pieces that go to the library as one text, and texts of one call.
_TOGETHER = 64
_CALL = 64
#: Rows and bytes of text that are encoded at once.
_ROWS = 2048
_BYTES = 4 << 20
_SEGMENT = "part int, seq int, doc_ids array<{kind}>, n_ids long, id_bytes int, ids binary, low_bits int, low binary, high binary, samples binary"


class EliasFano:
    """A sorted sequence of non-negative integers."""

    def __init__(self, count: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.count, self.low_bits, self.low, self.high = count, low_bits, low, high
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        count = len(values)
        most = int(values[-1]) if count else 0
        low_bits = max(0, (most // count).bit_length() - 1) if count else 0
        places = (values >> low_bits) + np.arange(count)
        bits = np.zeros(int(places[-1]) + 1 if count else 0, np.uint8)
        bits[places] = 1
        low = (values[:, None] >> np.arange(low_bits)) & 1
        packed = np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes()
        return cls(count, low_bits, packed, np.packbits(bits, bitorder="little").tobytes(), places[::_SAMPLE].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """Place of the i-th one of the high bits, from the nearest sample before it."""
        place = int(self.samples[i // _SAMPLE])
        missing = i % _SAMPLE
        byte = place >> 3
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8, 1, byte), bitorder="little"))
        ones = ones[ones >= (place & 7)]
        while missing >= len(ones):
            missing -= len(ones)
            byte += 1
            ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8, 1, byte), bitorder="little"))
        return byte * 8 + int(ones[missing])

    def __getitem__(self, i: int) -> int:
        start = i * self.low_bits
        window = int.from_bytes(self.low[start >> 3 : (start + self.low_bits + 7) >> 3], "little")
        return (self.select(i) - i) << self.low_bits | (window >> (start & 7)) & ((1 << self.low_bits) - 1)

    def values(self) -> np.ndarray:
        high = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.count] - np.arange(self.count)
        low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.count * self.low_bits].reshape(self.count, self.low_bits)
        return (high << self.low_bits) + low.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))


class PieceEncoder(PieceMemory):
    """The library's encoder with a memory of pieces: a text is parted at spaces that stand alone, which no token crosses."""

    def __init__(self, content: str, kind: np.dtype):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(content)
        self._library.no_truncation()
        self._library.no_padding()
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        size = self._library.get_vocab_size(with_added_tokens=True)
        # Byte-level vocabularies write a space as U+0120.
        self._begins = np.array([(self._library.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        super().__init__(kind, MEMO_PIECES)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self._kind) for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self._ids(texts)]

    def _has_special(self, text: str) -> bool:
        return any(s in text for s in self._special)

    def _coded(self, pieces: list[str]) -> list[bytes]:
        """Pieces that follow a space and have no white space go many to a text: each begins with the one token of theirs
        that begins with a space."""
        found: dict[str, bytes] = {}
        after_space = [p for p in pieces if p[:1] != BARE and "\n" not in p and p]
        groups = [after_space[at : at + _TOGETHER] for at in range(0, len(after_space), _TOGETHER)]
        for at in range(0, len(groups), _CALL):
            some = groups[at : at + _CALL]
            for group, ids in zip(some, self._ids([" " + " ".join(g) for g in some])):
                starts = np.flatnonzero(self._begins[ids])
                if len(starts) == len(group):
                    data, width = ids.tobytes(), self._kind.itemsize
                    cuts = [*(starts * width).tolist(), len(data)]
                    found.update(zip(group, [data[a:b] for a, b in zip(cuts, cuts[1:])]))
        single = [p for p in pieces if p not in found]
        found.update(zip(single, self._whole([piece_text(p) for p in single])))
        return list(map(found.__getitem__, pieces))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text as bytes."""
        return self.encode_many(texts)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return text_slices(batches, _ROWS, _BYTES)


@lru_cache(maxsize=1)
def _encoder(content: str, kind: str) -> PieceEncoder:
    """One encoder in each Python worker, whichever tasks it runs: the memory stays warm."""
    return PieceEncoder(content, np.dtype(kind))


def write_token_files(docs: DataFrame, path: str, vocabulary_path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Writes ``path/segments`` and ``path/index``."""
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        content = file.read()
    from tokenizers import Tokenizer

    largest = max(end_id, Tokenizer.from_str(content).get_vocab_size(with_added_tokens=True) - 1)
    kind = np.dtype("<u2" if largest < 1 << 16 else "<u4")
    shared = spark.sparkContext.broadcast(content)
    id_kind = docs.schema[id_column].dataType.simpleString()
    rows = only(docs, doc_id=id_column, text=text_column).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    schema = _SEGMENT.format(kind=id_kind)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, kind.str)
        end = np.array([end_id], kind).tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, parts, size = [], [], 0
        for batch in _slices(batches):
            names = batch.column("doc_id").to_pylist()
            for name, ids in zip(names, encoder.encode(batch.column("text").to_pylist())):
                doc_ids.append(name)
                parts.append(ids + end)
                size += len(parts[-1])
                if size >= SEGMENT_IDS * kind.itemsize:
                    yield _segment(part, seq, doc_ids, parts, kind, batch.schema.field("doc_id").type)
                    doc_ids, parts, size, seq = [], [], 0, seq + 1
        if doc_ids:
            yield _segment(part, seq, doc_ids, parts, kind, batch.schema.field("doc_id").type)

    ordered.mapInArrow(segments, schema).write.parquet(f"{path}/segments")
    sizes = spark.read.schema(schema).parquet(f"{path}/segments").select("part", "seq", "n_ids", F.size("doc_ids").alias("n_docs"))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # One row per range partition; their running total is the only ordered pass over all of them.
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    index = sizes.withColumn("within", within).join(before, "part")
    index.select("part", "seq", "n_docs", "n_ids", (F.col("before") + F.col("within")).alias("base")).coalesce(1).write.parquet(f"{path}/index")


def _segment(part: int, seq: int, doc_ids: list, parts: list[bytes], kind: np.dtype, id_type: pa.DataType) -> pa.RecordBatch:
    ends = np.cumsum([len(p) for p in parts]) // kind.itemsize
    code = EliasFano.of(ends)
    values = [part, seq, doc_ids, int(ends[-1]), kind.itemsize, b"".join(parts), code.low_bits, code.low, code.high, code.samples.tobytes()]
    kinds = [pa.int32(), pa.int32(), pa.list_(id_type), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = ["part", "seq", "doc_ids", "n_ids", "id_bytes", "ids", "low_bits", "low", "high", "samples"]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids (32-bit little-endian integers)."""
    segments = spark.read.parquet(f"{path}/segments")
    id_kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    index = spark.read.parquet(f"{path}/index").select("part", "seq", "base")
    if index.count() <= BROADCAST_SEGMENTS:
        index = F.broadcast(index)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in arrow_rows(batches, 1):
            row = {name: segment.column(name)[0] for name in segment.schema.names}
            doc_ids = segment.column("doc_ids").flatten()
            fields = {k: row[k].as_py() for k in ("part", "seq", "low_bits", "low", "high", "samples", "id_bytes")}
            ends = EliasFano(len(doc_ids), *(fields[k] for k in ("low_bits", "low", "high", "samples"))).values()
            starts = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(row["ids"].as_buffer(), f"<u{fields['id_bytes']}").astype("<u4")
            for at in range(0, len(doc_ids), 4096):
                some = slice(at, at + 4096)
                shift = starts[at] * 4
                offsets = np.concatenate([starts[some], ends[some][-1:]]) * 4 - shift
                data = ids[starts[at] : ends[some][-1]].tobytes()
                n = len(offsets) - 1
                held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
                columns = [
                    pa.array(np.full(n, fields["part"], np.int32)),
                    pa.array(np.full(n, fields["seq"], np.int32)),
                    doc_ids.slice(at, n),
                    pa.array(starts[some].astype(np.int64)),
                    pa.array((ends[some] - starts[some]).astype(np.int64)),
                    held,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "seq", "doc_id", "place", "n_tokens", "ids"])

    rows = segments.mapInArrow(documents, f"part int, seq int, doc_id {id_kind}, place long, n_tokens long, ids binary")
    return rows.join(index, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids")
