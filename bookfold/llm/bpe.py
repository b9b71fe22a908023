"""Byte-level BPE encoding and decoding of whole texts with a published vocabulary.

A word is a contiguous array of parts with, beside it, the array of ranks of adjacent parts. The smallest rank is
found by a scan, the boundary there is deleted, and the two neighbouring ranks are refreshed, until no adjacent
parts can merge. Many words of like length are the rows of one array of parts and one of ranks, and merge together.
Words above ``LONG_WORD`` bytes, for which repeated scans would cost the square of the length, merge through a heap
to the same result.

Each worker keeps the ids of pieces already seen, in two generations of at most ``MEMO_PIECES`` each. The vocabulary file is read once
by the driver (its size is fixed) and broadcast.

Edge cases: null and empty texts have no ids and decode to the empty text. The vocabulary's special tokens are
found first, wherever their strings stand, as the library does by default. Rows repeat as often as in the input;
null ids stay null; other columns play no part. Texts of any length are encoded whole.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from bookfold.llm.common import only, text_slices
from bookfold.llm.pieces import PieceMemory, piece_text

LONG_WORD = 256
MEMO_PIECES = 400_000
#: Words that merge together.
_WORDS = 4096
#: Rows and bytes of text that are encoded at once.
_ROWS = 2048
_BYTES = 4 << 20
_NONE = 1 << 60
#: Fixed value: the published pattern that parts a text into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files: itself if it is printable, else one from 256 on."""
    shown = {b for first, last in ((33, 126), (161, 172), (174, 255)) for b in range(first, last + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class BytePairCoder(PieceMemory):
    """Encodes and decodes with the vocabulary and merges of a ``tokenizers`` file, given as its JSON text."""

    def __init__(self, content: str):
        described = json.loads(content)
        model = described["model"]
        symbols = byte_symbols()
        ids = {bytes(symbols[c] for c in token): i for token, i in model["vocab"].items() if all(c in symbols for c in token)}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.token_bytes = {i: token for token, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        self.token_bytes.update({i: content.encode() for content, i in self.special.items()})
        self.pair_ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = (bytes(symbols[c] for c in part) for part in (left, right))
            self.pair_ranks.setdefault(ids[a] << 32 | ids[b], rank)
            self.merged.append(ids[a + b])
        self._words = regex.compile(PATTERN)
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._byte_ids = np.array(self.byte_ids, np.int64)
        #: Stands behind the last part of a word that is shorter than its row.
        self._nothing = max(self.token_bytes) + 1
        # Without merges, one pair that no parts make.
        pairs, ranks = [*self.pair_ranks] or [-1], [*self.pair_ranks.values()] or [_NONE]
        by_pair = np.argsort(pairs)
        self._pairs, self._pair_ranks = np.array(pairs, np.int64)[by_pair], np.array(ranks, np.int64)[by_pair]
        self._merged = np.array(self.merged, np.int64)
        self._tokens = pa.array([self.token_bytes.get(i, b"") for i in range(self._nothing)], pa.large_binary())
        super().__init__(np.dtype("<i4"), MEMO_PIECES)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as bytes, 32 bits each. Words of like length are the rows of one array and merge together: in
        each round every row that can still merge loses the boundary of its smallest rank."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        some = int(np.searchsorted(lengths[order], 1)), int(np.searchsorted(lengths[order], LONG_WORD, side="right"))
        for at in range(*some, _WORDS):
            rows = order[at : min(at + _WORDS, some[1])]
            self._merge_rows([words[i] for i in rows.tolist()], lengths[rows], rows, out)
        for i in order[some[1] :].tolist():
            out[i] = np.array(self._encode_long(words[i]), "<i4").tobytes()
        return out

    def _merge_rows(self, words: list[bytes], lengths: np.ndarray, rows: np.ndarray, out: list[bytes]) -> None:
        width = int(lengths[-1])
        symbols = np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width)
        parts = np.where(np.arange(width) < lengths[:, None], self._byte_ids[symbols], self._nothing)
        ranks = self._ranks(parts[:, :-1], parts[:, 1:])
        while len(rows):
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(rows)), at]
                merges = best < _NONE
            else:
                merges = np.zeros(len(rows), bool)
            if not merges.all():
                done = parts[~merges]
                held = done != self._nothing
                data = done[held].astype("<i4").tobytes()
                cuts = [0, *(np.cumsum(held.sum(axis=1)) * 4).tolist()]
                for i, start, end in zip(rows[~merges].tolist(), cuts, cuts[1:]):
                    out[i] = data[start:end]
                rows = rows[merges]
                if not len(rows):
                    return
                parts, ranks, at, best = parts[merges], ranks[merges], at[merges], best[merges]
            row, place = np.arange(len(rows)), np.arange(parts.shape[1] - 1)
            parts = np.where(place <= at[:, None], parts[:, :-1], parts[:, 1:])
            parts[row, at] = self._merged[best]
            ranks = np.where(place[:-1] < at[:, None], ranks[:, :-1], ranks[:, 1:])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self._ranks(parts[left, at[left] - 1], parts[left, at[left]])
            right = np.flatnonzero(at < ranks.shape[1])
            ranks[right, at[right]] = self._ranks(parts[right, at[right]], parts[right, at[right] + 1])

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of adjacent parts; _NONE if they do not merge."""
        pairs = left << 32 | right
        place = np.minimum(np.searchsorted(self._pairs, pairs), len(self._pairs) - 1)
        return np.where(self._pairs[place] == pairs, self._pair_ranks[place], _NONE)

    def _encode_long(self, word: bytes) -> list[int]:
        parts = [self.byte_ids[b] for b in word]
        end = len(parts)
        following, before = list(range(1, end + 1)), list(range(-1, end - 1))
        rank_of = self.pair_ranks.get
        waiting = [(r, i) for i in range(end - 1) if (r := rank_of(parts[i] << 32 | parts[i + 1], _NONE)) < _NONE]
        heapq.heapify(waiting)
        while waiting:
            rank, i = heapq.heappop(waiting)
            j = following[i]
            if parts[i] < 0 or j >= end or rank_of(parts[i] << 32 | parts[j], _NONE) != rank:
                continue
            parts[i], parts[j] = self.merged[rank], -1
            following[i] = following[j]
            if following[i] < end:
                before[following[i]] = i
            for k in (before[i], i):
                if k >= 0 and (n := following[k]) < end and (r := rank_of(parts[k] << 32 | parts[n], _NONE)) < _NONE:
                    heapq.heappush(waiting, (r, k))
        return [p for p in parts if p >= 0]

    def _encode_stretch(self, text: str) -> bytes:
        found = self._words.findall(text)
        words = list(dict.fromkeys(found))
        ids = dict(zip(words, self.encode_words([w.encode("utf-8", "replace") for w in words])))
        return b"".join(map(ids.__getitem__, found))

    def _encode_parted(self, text: str) -> bytes:
        if self._special is None:
            return self._encode_stretch(text)
        out: list[bytes] = []
        done = 0
        for found in self._special.finditer(text):
            out += (self._encode_stretch(text[done : found.start()]), np.array([self.special[found[0]]], "<i4").tobytes())
            done = found.end()
        return b"".join([*out, self._encode_stretch(text[done:])])

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._encode_parted(text) for text in texts]

    def _has_special(self, text: str) -> bool:
        return self._special is not None and self._special.search(text) is not None

    def _coded(self, pieces: list[str]) -> list[bytes]:
        # ASCII letters after a space are one word by any version of the pattern's classes.
        parted = [(" " + p,) if p.isascii() and p.isalpha() else self._words.findall(piece_text(p)) for p in pieces]
        words = list(dict.fromkeys(chain.from_iterable(parted)))
        ids = dict(zip(words, self.encode_words([w.encode("utf-8", "replace") for w in words])))
        return [ids[p[0]] if len(p) == 1 else b"".join(map(ids.__getitem__, p)) for p in parted]

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_many([text])[0], "<i4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """Bytes of all tokens, special ones too; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")

    def decode_many(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The decoded text of each row of ids, row i from ``offsets[i]`` on."""
        held = self._tokens.take(pa.array(ids))
        cuts = np.frombuffer(held.buffers()[1], np.int64)[offsets].astype(np.int32)
        decoded = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), held.buffers()[2])
        try:
            decoded.validate(full=True)
        except pa.ArrowInvalid:
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:])], pa.string())
        return decoded


@lru_cache(maxsize=1)
def _coder(content: str) -> BytePairCoder:
    """One coder in each Python worker, whichever tasks it runs: the memory stays warm."""
    return BytePairCoder(content)


def encode_and_decode(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns doc_id, ids (array<int>) and decoded (the text decoded from those ids)."""
    rows = only(docs, doc_id=id_column, text=text_column)
    with open(vocabulary_path, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(content.value)
        for batch in text_slices(batches, _ROWS, _BYTES):
            coded = coder.encode_many(batch.column("text").to_pylist())
            ids = np.frombuffer(b"".join(coded), "<i4")
            offsets = np.cumsum([0, *map(len, coded)]) // 4
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, coder.decode_many(ids, offsets)], names=["doc_id", "ids", "decoded"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(code, f"doc_id {kind}, ids array<int>, decoded string")
