"""Alignment of two tokenizers over a corpus: which token of one stands where which token of the other stands.

A byte-level BPE (A) reads a space and the text, a sentence-piece model (B) the text, before which it sets a space
itself. Where tokens of both end at the same byte, the text is cut into groups; all A-B token pairs of a group are
links.

The corpus-wide counts come from inverted bitmaps. Each writing task numbers its documents in blocks of ``BLOCK``; for
each id pair and block there is a compressed bitmap of the documents that hold the pair linked (their places as 16-bit
integers, or a plain bitmap of ``BLOCK`` bits where that is smaller), and planes of the multiplicity less one, bit by
bit. A task writes fragments whenever ``FRAGMENT_LINKS`` postings have come together, so its memory is bounded. The
fragments of a pair and block are OR-merged and popcounted: documents of a pair = popcount of its bitmaps, links = that
plus 2^k times the popcount of plane k. A pair's blocks are merged in different tasks and their counts added, so a pair
that stands in every document is no hot spot. The postings return the scores: each bitmap gets its pair's count, and
one pass over the bitmaps of a block adds up, for each of its documents, the counts of its links.

An id pair is written as a * 65536 + b; A and B have at most 65,536 ids each, so there are at most 65,536 pairs of one
A id.

Edge cases: null and empty texts, and texts whose tokens of A or B do not join to the space and the text, have no
tokens: zeros, and groups_sha256 ''. The strings of special tokens are plain text. Repeated rows are documents of their
own, a null id stays null. An empty table gives no rows. Other columns play no part. Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookfold.llm.bpe import byte_symbols
from bookfold.llm.common import arrow_rows, only, stored
from bookfold.llm.pieces import BARE, piece_text, pieces_of

BLOCK = 1 << 16
FRAGMENT_LINKS = 2_000_000
#: Links of one group that are spelled out; larger groups are counted by distinct ids.
_PLAIN_GROUP = 4096
#: Pieces above which the memory of a worker starts anew.
MEMO_PIECES = 500_000
_ROWS = 128
#: Pieces read as one text.
_TOGETHER = 256
_DENSE = BLOCK // 16
_DOC = {"doc_id": None, "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string()}
_POST = {"pair": pa.int64(), "plane": pa.int32(), "dense": pa.bool_(), "places": pa.binary()}
#: One table of both, so that texts are read once.
_SCHEMA = (
    "block long, place int, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair long, plane int, dense boolean, places binary, kind string"
)


@dataclass
class Read:
    """What was read of some items (texts or pieces): counts and spelled groups of each, and the links of all, sorted by item."""

    valid: np.ndarray
    counts: np.ndarray
    spelled: list[bytes]
    item: np.ndarray
    pair: np.ndarray
    times: np.ndarray


class PieceMemory:
    """Pieces by number, with their counts, spelled groups and links. New pieces are noted in ``fresh`` when looked up."""

    def __init__(self) -> None:
        self.fresh: list[str] = []
        self.valid = np.empty(0, bool)
        self.counts = np.empty((0, 4), np.int64)
        self.spelled: list[bytes] = []
        self.starts = np.zeros(1, np.int64)
        self.pair = np.empty(0, np.int64)
        self.times = np.empty(0, np.int64)
        self.numbers: dict[str, int] = _Numbers(self.fresh)

    def learn(self, read: Read) -> None:
        """Takes in what was read of the fresh pieces."""
        self.fresh.clear()
        self.valid = np.concatenate([self.valid, read.valid])
        self.counts = np.concatenate([self.counts, read.counts])
        self.spelled += read.spelled
        sizes = np.bincount(read.item, minlength=len(read.valid))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.pair, self.times = np.concatenate([self.pair, read.pair]), np.concatenate([self.times, read.times])


class _Numbers(dict):
    def __init__(self, fresh: list[str]):
        self._fresh = fresh

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self._fresh.append(piece)
        return number


class Aligner:
    """Ids, groups and links of batches of texts.

    A text without runs of white space is parted at its spaces and newlines, which no token of either crosses; what was
    read of a piece is kept, up to ``MEMO_PIECES`` pieces. Other texts, and all if the model of B has pieces that cross a
    space or a newline, are read whole.
    """

    def __init__(self, vocabulary: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(vocabulary)
        self._a.no_truncation()
        self._a.no_padding()
        self._a.encode_special_tokens = True
        self._b = SentencePieceProcessor(model_proto=model)
        symbols = byte_symbols()
        tokens = {i: token for token, i in json.loads(vocabulary)["model"]["vocab"].items()}
        self._a_bytes = [bytes(symbols[c] for c in tokens[i]) if set(tokens.get(i, "\n")) <= symbols.keys() else b"" for i in range(max(tokens) + 1)]
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._b_bytes = [bytes([int(p[1:-1], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self._a_sizes, self._b_sizes = (np.array([*map(len, held)], np.int64) for held in (self._a_bytes, self._b_bytes))
        self._most = max(len(self._a_bytes), len(self._b_bytes))
        if self._most > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        self._written = [f"{i}{after}".encode() for after in (",", "|", ";", ";\n") for i in range(self._most)]
        self._parted = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self._memory = PieceMemory()

    def read(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """For each text n_a, n_b, n_groups, n_links, groups_sha256; then the distinct (pair << 16 | place of the text)
        of all links, sorted, and how often each stands."""
        rows: list[tuple] = [(0, 0, 0, 0, "")] * len(texts)
        whole, parted, sizes, numbers = [], [], [], []
        if len(self._memory.numbers) > MEMO_PIECES:
            self._memory = PieceMemory()
        number_of = self._memory.numbers.__getitem__
        for k, text in enumerate(texts):
            if not text:
                continue
            pieces = pieces_of(" " + text) if self._parted and "▁" not in text else None
            if pieces is None:
                whole.append(k)
            else:
                parted.append(k)
                sizes.append(len(pieces) - 1)
                numbers += map(number_of, pieces[1:])
        found = []
        if parted:
            found.append(self._from_pieces(rows, whole, np.array(parted), np.array(sizes), np.array(numbers)))
        if whole:
            asked = [texts[k] for k in whole]
            read = self._grouped(asked, [[len(t.encode()) + 1] for t in asked])
            self._note(rows, whole, read.valid, read.counts, read.spelled)
            found.append((read.pair << 16 | np.array(whole)[read.item], read.times))
        return rows, *(_added(found) if found else (np.empty(0, np.int64),) * 2)

    @staticmethod
    def _note(rows: list[tuple], places: list[int], valid: np.ndarray, counts: np.ndarray, spelled: list[bytes]) -> None:
        for k, good, numbers, text in zip(places, valid.tolist(), counts.tolist(), spelled):
            if good:
                rows[k] = (*numbers, hashlib.sha256(text[:-1]).hexdigest())

    def _from_pieces(self, rows: list[tuple], whole: list[int], parted: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Adds up the pieces of the ``parted`` texts; a text with a piece that could not be read goes to ``whole``."""
        memory = self._memory
        if memory.fresh:
            memory.learn(self._read_pieces(memory.fresh))
        starts = np.cumsum(sizes) - sizes
        good = np.logical_and.reduceat(memory.valid[numbers], starts)
        counts = np.add.reduceat(memory.counts[numbers], starts)
        spelled = memory.spelled.__getitem__
        listed = numbers.tolist()
        texts = [b"".join(map(spelled, listed[start : start + size])) for start, size in zip(starts.tolist(), sizes.tolist())]
        self._note(rows, parted.tolist(), good, counts, texts)
        whole += parted[~good].tolist()
        wanted = np.repeat(good, sizes)
        numbers, text = numbers[wanted], np.repeat(parted, sizes)[wanted]
        first, held = memory.starts[numbers], memory.starts[numbers + 1] - memory.starts[numbers]
        at = np.repeat(first - (np.cumsum(held) - held), held) + np.arange(held.sum())
        return memory.pair[at] << 16 | np.repeat(text, held), memory.times[at]

    def _read_pieces(self, pieces: list[str]) -> Read:
        """Pieces are read many to a text, each behind a space, or a newline if it is bare; those that hold newlines
        themselves stand alone. Pieces of a text that could not be read are read again one by one."""
        together = [k for k, p in enumerate(pieces) if "\n" not in p]
        lots = [together[at : at + _TOGETHER] for at in range(0, len(together), _TOGETHER)] + [[k] for k, p in enumerate(pieces) if "\n" in p]
        read = self._read_lots(pieces, lots)
        bad = np.flatnonzero(~read.valid).tolist()
        if not bad:
            return read
        again = self._read_lots(pieces, [[k] for k in bad])
        read.valid[bad], read.counts[bad] = again.valid[bad], again.counts[bad]
        for k in bad:
            read.spelled[k] = again.spelled[k]
        parts = [np.concatenate(c) for c in ((read.item, again.item), (read.pair, again.pair), (read.times, again.times))]
        order = np.argsort(parts[0], kind="stable")
        return Read(read.valid, read.counts, read.spelled, *(c[order] for c in parts))

    def _read_lots(self, pieces: list[str], lots: list[list[int]]) -> Read:
        """A lot begins with the word x. A newline before a piece that holds newlines would run into them, so such a
        piece, if bare, is read behind an x without space; it is the only one of its lot."""
        texts, sizes, owners = [], [], []
        for lot in lots:
            parts, sizes_of, owner = ["x"], [2], [-1]
            for k in lot:
                piece, before = pieces[k], " "
                if piece[:1] == BARE:
                    piece, before = piece[1:], "" if "\n" in piece else "\n"
                parts.append(before + piece)
                if before == "\n":
                    sizes_of.append(1)
                    owner.append(-1)
                sizes_of.append(len(piece.encode()) + (before == " "))
                owner.append(k)
            texts.append("".join(parts))
            sizes.append(sizes_of)
            owners += owner
        read = self._grouped(texts, sizes)
        owner = np.array(owners)
        own = owner >= 0
        valid, counts, spelled = np.zeros(len(pieces), bool), np.zeros((len(pieces), 4), np.int64), [b""] * len(pieces)
        valid[owner[own]], counts[owner[own]] = read.valid[own], read.counts[own]
        for k, text in zip(owners, read.spelled):
            if k >= 0:
                spelled[k] = text
        kept = own[read.item]
        item = owner[read.item[kept]]
        order = np.argsort(item, kind="stable")
        return Read(valid, counts, spelled, item[order], read.pair[kept][order], read.times[kept][order])

    def _grouped(self, texts: list[str], item_sizes: list[list[int]]) -> Read:
        """Reads texts and parts what was read into items of so many bytes of the space and the text. Items of a text
        whose tokens do not join to it, or do not end where its items end, are not valid."""
        a_read = [e.ids for e in self._a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)] if texts else []
        b_read = self._b.encode(texts, num_threads=1) if texts else []
        good = []
        for text, a, b in zip(texts, a_read, b_read):
            whole = (" " + text).encode()
            good.append(b"".join(map(self._a_bytes.__getitem__, a)) == whole == b"".join(map(self._b_bytes.__getitem__, b)))
        return self._cut(a_read, b_read, good, item_sizes)

    def _cut(self, a_read: list[list[int]], b_read: list[list[int]], good: list[bool], item_sizes: list[list[int]]) -> Read:
        n_items = [*map(len, item_sizes)]
        valid = np.repeat(np.array(good, bool), n_items)
        counts, spelled = np.zeros((len(valid), 4), np.int64), [b""] * len(valid)
        read = [k for k, held in enumerate(good) if held]
        if not read:
            return Read(valid, counts, spelled, *(np.empty(0, np.int64),) * 3)
        a, b = (np.fromiter(chain.from_iterable(ids[k] for k in read), np.int64) for ids in (a_read, b_read))
        item_ends = np.cumsum(np.fromiter(chain.from_iterable(item_sizes[k] for k in read), np.int64))
        # Both read the same bytes, so ends can be compared over all items at once.
        a_ends, b_ends = np.cumsum(self._a_sizes[a]), np.cumsum(self._b_sizes[b])
        a_cuts = b_ends[np.searchsorted(b_ends, a_ends)] == a_ends
        b_cuts = a_ends[np.searchsorted(a_ends, b_ends)] == b_ends
        a_group, b_group = (np.cumsum(cuts) - cuts for cuts in (a_cuts, b_cuts))
        in_a, in_b = np.bincount(a_group), np.bincount(b_group)
        a_first, b_first = (np.cumsum(held) - held for held in (in_a, in_b))
        links = in_a * in_b
        group_ends = a_ends[a_cuts]
        # Items without bytes end where the one before them ends, and get nothing.
        item_of = np.searchsorted(item_ends, group_ends)
        names = np.flatnonzero(valid)
        crossed = (item_ends > 0) & ~np.isin(item_ends, group_ends)
        if crossed.any():
            text_of = np.repeat(np.arange(len(good)), n_items)
            bad = set(text_of[names[crossed]].tolist())
            return self._cut(a_read, b_read, [held and k not in bad for k, held in enumerate(good)], item_sizes)
        item_of = names[item_of]
        first = np.flatnonzero(np.diff(item_of, prepend=-1))
        numbers = [np.add.reduceat(in_a, first), np.add.reduceat(in_b, first), np.diff([*first, len(item_of)]), np.add.reduceat(links, first)]
        counts[item_of[first]] = np.stack(numbers, axis=1)
        last = np.zeros(len(item_of), np.int64)
        last[np.append(first[1:], len(item_of)) - 1] = 1
        sequence = np.empty(len(a) + len(b), np.int64)
        sequence[np.arange(len(a)) + b_first[a_group]] = a + self._most * a_cuts
        sequence[np.arange(len(b)) + (a_first + in_a)[b_group]] = b + (2 + last[b_group]) * self._most * b_cuts
        for k, text in zip(item_of[first].tolist(), b"".join(map(self._written.__getitem__, sequence.tolist())).split(b"\n")):
            spelled[k] = text

        times = np.where(links <= _PLAIN_GROUP, in_b, 0)[a_group]
        place = np.repeat(b_first[a_group] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        parts = [(np.repeat(item_of[a_group], times) << 32 | np.repeat(a, times) << 16 | b[place], np.ones(len(place), np.int64))]
        for g in np.flatnonzero(links > _PLAIN_GROUP):
            ua, na = np.unique(a[a_first[g] : a_first[g] + in_a[g]], return_counts=True)
            ub, nb = np.unique(b[b_first[g] : b_first[g] + in_b[g]], return_counts=True)
            parts.append(((item_of[g] << 32 | ua[:, None] << 16 | ub).ravel(), (na[:, None] * nb).ravel()))
        keys, times = _added(parts)
        return Read(valid, counts, spelled, keys >> 32, keys & 0xFFFFFFFF, times)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    keys, counts = (np.concatenate(c) for c in zip(*parts))
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first)


@lru_cache(maxsize=1)
def _aligner(vocabulary: str, model: bytes) -> Aligner:
    """One in each Python worker, whichever tasks it runs."""
    return Aligner(vocabulary, model)


def write_alignment(docs: DataFrame, path: str, vocabulary_path: str, model_path: str, id_column: str = "doc_id", text_column: str = "text", fragment_links: int = FRAGMENT_LINKS) -> None:
    """Writes ``path/kind=document`` (a row per document, by block and place) and ``path/kind=posting`` (fragments)."""
    rows = only(docs, doc_id=id_column, text=text_column)
    with open(vocabulary_path, encoding="utf-8") as file, open(model_path, "rb") as model:
        shared = docs.sparkSession.sparkContext.broadcast((file.read(), model.read()))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = _SCHEMA.format(kind=kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, id_type = _aligner(*shared.value), pa.null()
        block, done, waiting, links = TaskContext.get().partitionId() << 24, 0, [], 0
        for batch in arrow_rows(batches, _ROWS):
            id_type = batch.schema.field("doc_id").type
            if done + batch.num_rows > BLOCK:
                yield from _fragments(block, waiting, id_type)
                block, done, waiting, links = block + 1, 0, [], 0
            found, keys, counts = aligner.read(batch.column("text").to_pylist())
            yield _documents(block, done, batch.column("doc_id"), found)
            waiting.append((keys + done, counts))
            done += batch.num_rows
            links += len(keys)
            if links >= fragment_links:
                yield from _fragments(block, waiting, id_type)
                waiting, links = [], 0
        yield from _fragments(block, waiting, id_type)

    rows.mapInArrow(read, schema).write.partitionBy("kind").parquet(path)


def _batch(columns: dict[str, pa.Array], id_type: pa.DataType, kind: str) -> pa.RecordBatch:
    size = len(columns["block"])
    kinds = {"block": pa.int64(), "place": pa.int32(), **_DOC, "doc_id": id_type, **_POST}
    held = [columns[name] if name in columns else pa.nulls(size, t) for name, t in kinds.items()]
    return pa.RecordBatch.from_arrays([*held, pa.array([kind] * size)], names=[*kinds, "kind"])


def _documents(block: int, first: int, ids: pa.Array, found: list[tuple]) -> pa.RecordBatch:
    size = len(found)
    columns = {"block": pa.array([block] * size, pa.int64()), "place": pa.array(range(first, first + size), pa.int32()), "doc_id": ids}
    names = [name for name in _DOC if name != "doc_id"]
    return _batch(columns | {name: pa.array(c, _DOC[name]) for name, c in zip(names, zip(*found))}, ids.type, "document")


def packed_places(pairs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Sorted pairs with the places that hold them -> each pair once, whether its bitmap is plain, and its bytes."""
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    sizes = np.diff([*first, len(pairs)])
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64) * 2
    data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(places.astype("<u2").tobytes())])
    dense = sizes > _DENSE
    if dense.any():
        listed = data.to_pylist()
        for k in np.flatnonzero(dense):
            listed[k] = plain_bitmap(np.frombuffer(listed[k], "<u2"))
        data = pa.array(listed, pa.large_binary())
    return pairs[first], pa.array(dense), data.cast(pa.binary())


def plain_bitmap(places: np.ndarray) -> bytes:
    bits = np.zeros(BLOCK, np.uint8)
    bits[places] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def places_in(dense: bool, data: bytes) -> np.ndarray:
    if not dense:
        return np.frombuffer(data, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")).astype("<u2")


def _fragments(block: int, waiting: list[tuple[np.ndarray, np.ndarray]], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Plane -1 has the documents of each pair, plane k bit k of the multiplicity less one."""
    if not sum(len(keys) for keys, _ in waiting):
        return
    keys, counts = (np.concatenate(c) for c in zip(*waiting))
    order = np.argsort(keys)
    keys, more = keys[order], counts[order] - 1
    for plane in range(-1, int(more.max()).bit_length()):
        held = keys if plane < 0 else keys[(more >> plane & 1).astype(bool)]
        for start, stop in _slices(held >> 16):
            pairs, dense, places = packed_places(held[start:stop] >> 16, held[start:stop] & 0xFFFF)
            size = len(pairs)
            columns = {"block": pa.array(np.full(size, block)), "pair": pa.array(pairs), "plane": pa.array(np.full(size, plane, np.int32)), "dense": dense, "places": places}
            yield _batch(columns, id_type, "posting")


def _slices(pairs: np.ndarray, rows: int = 100_000) -> Iterator[tuple[int, int]]:
    """Ranges of about ``rows`` postings that do not cut a pair."""
    start = 0
    while start < len(pairs):
        stop = min(start + rows, len(pairs))
        stop = int(np.searchsorted(pairs, pairs[stop - 1], "right"))
        yield start, stop
        start = stop


def read_documents(spark: SparkSession, path: str, id_kind: str = "long") -> DataFrame:
    """Per document: block, place, doc_id, n_a, n_b, n_groups, n_links, groups_sha256."""
    return _written(spark, path, id_kind).filter("kind = 'document'").select("block", "place", *_DOC)


def read_postings(spark: SparkSession, path: str, id_kind: str = "long") -> DataFrame:
    return _written(spark, path, id_kind).filter("kind = 'posting'").select("block", *_POST)


def _written(spark: SparkSession, path: str, id_kind: str) -> DataFrame:
    return spark.read.schema(_SCHEMA.format(kind=id_kind)).parquet(path)


def merged_postings(postings: DataFrame) -> DataFrame:
    """Fragments of a pair, block and plane OR-merged: block, pair, plane, dense, places."""
    order = ["pair", "block", "plane"]
    rows = postings.select(*order, "dense", "places").repartition("pair", "block").sortWithinPartitions(*order)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None
        for batch in batches:
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            names = np.stack([batch.column(c).to_numpy() for c in order], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]).any(axis=1)]))
            # What the batch ends with may go on in the next one.
            yield _or_merged(batch.slice(0, starts[-1]), starts[:-1])
            last = batch.slice(starts[-1])
        if last is not None:
            yield _or_merged(last, np.zeros(1, np.int64))

    return rows.mapInArrow(merge, "pair long, block long, plane int, dense boolean, places binary")


def _places(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """How many places each row has, and the places of all rows."""
    column, dense = batch.column("places"), batch.column("dense").to_numpy(zero_copy_only=False)
    if dense.any():
        held = [places_in(d, p) for d, p in zip(dense.tolist(), column.to_pylist())]
        return np.array([*map(len, held)]), np.concatenate(held)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.diff(offsets) // 2, np.frombuffer(data, "<u2", (offsets[-1] - offsets[0]) // 2, offsets[0]) if data else np.empty(0, "<u2")


def _or_merged(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
    """The runs of rows from each start on, merged. A union of places is an OR of bitmaps."""
    if len(starts) == batch.num_rows:
        return batch
    sizes, places = _places(batch)
    run = np.repeat(np.arange(len(starts)), np.diff([*starts, batch.num_rows]))
    keys = np.unique(np.repeat(run, sizes) << 16 | places)
    _, dense, packed = packed_places(keys >> 16, keys & 0xFFFF)
    merged = batch.take(pa.array(starts))
    columns = [merged.column(c) for c in ("pair", "block", "plane")]
    return pa.RecordBatch.from_arrays([*columns, dense, packed], names=["pair", "block", "plane", "dense", "places"])


def pair_counts(postings: DataFrame) -> DataFrame:
    """Per id pair: pair, a, b, n_docs (documents that hold it linked), n_links, and whether no other pair of its A id
    stands in more documents (best)."""
    ones = F.when(F.col("dense"), F.bitmap_count("places")).otherwise((F.octet_length("places") / 2).cast("long"))
    planes = merged_postings(postings).select("pair", "plane", ones.alias("ones"))
    weight = F.when(F.col("plane") < 0, F.lit(1)).otherwise(F.pow(F.lit(2), F.col("plane"))).cast("long")
    counts = planes.groupBy("pair").agg(F.sum(F.when(F.col("plane") < 0, F.col("ones"))).alias("n_docs"), F.sum(F.col("ones") * weight).alias("n_links"))
    counts = counts.withColumns({"a": F.shiftright("pair", 16), "b": F.col("pair").bitwiseAND(0xFFFF)})
    # At most as many rows of one A id as B has ids.
    return counts.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a")))


def document_scores(postings: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per document with links: block, place, n_best (links whose count is the highest of their A id), count_sum."""
    scored = postings.join(pairs.select("pair", "n_docs", "best"), "pair").select("block", "plane", "dense", "places", "n_docs", "best")
    rows = scored.repartition("block").sortWithinPartitions("block")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sums = None, np.zeros((3, BLOCK), np.int64)
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for start, stop in zip(starts, starts[1:]):
                if start == stop:
                    continue
                if block is not None and blocks[start] != block:
                    yield _sums(block, sums)
                    sums[:] = 0
                block = int(blocks[start])
                _add_postings(sums, batch.slice(start, stop - start))
        if block is not None:
            yield _sums(block, sums)

    return rows.mapInArrow(score, "block long, place int, n_best long, count_sum long")


def _add_postings(sums: np.ndarray, batch: pa.RecordBatch) -> None:
    planes = batch.column("plane").to_numpy()
    weights = np.where(planes < 0, 1, 1 << np.maximum(planes, 0).astype(np.int64))
    counts = batch.column("n_docs").to_numpy() * weights
    best = batch.column("best").to_numpy(zero_copy_only=False) * weights
    sizes, places = _places(batch)
    sums[0] += np.bincount(places, minlength=BLOCK)
    # Sums of one batch stay far below 2^53, so doubles hold them exactly.
    sums[1] += np.bincount(places, np.repeat(best, sizes), BLOCK).astype(np.int64)
    sums[2] += np.bincount(places, np.repeat(counts, sizes), BLOCK).astype(np.int64)


def _sums(block: int, sums: np.ndarray) -> pa.RecordBatch:
    places = np.flatnonzero(sums[0])
    columns = [pa.array(np.full(len(places), block)), pa.array(places.astype(np.int32)), pa.array(sums[1][places]), pa.array(sums[2][places])]
    return pa.RecordBatch.from_arrays(columns, names=["block", "place", "n_best", "count_sum"])


def aligned_documents(spark: SparkSession, path: str, id_kind: str = "long") -> DataFrame:
    """Per document what was written of it, with n_best and count_sum. ``id_kind``: type of the ids."""
    postings = read_postings(spark, path, id_kind)
    pairs = stored(pair_counts(postings), "pair-counts")
    scores = document_scores(postings, pairs)
    joined = read_documents(spark, path, id_kind).join(scores, ["block", "place"], "left")
    return joined.select(*_DOC, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")])
