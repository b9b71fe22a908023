"""Pieces of a text that byte-level BPE with the published word pattern encodes on their own.

A word of that pattern never crosses a single space before a non-space, nor a single newline. Pieces between such
places recur all over a corpus, so a coder can keep what it has encoded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space other than space and newline, by any definition in use.
_OTHER_SPACE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\0"
#: Marks a piece that no space stands before.
BARE = "\0"
#: Marks that the word pattern parts from a letter before them.
_TAILS = ",."


def marked_pieces(text: str) -> str | None:
    """The pieces in order, one space between any two: after BARE as they are, others after one space. None if the text must
    stay whole."""
    if "  " in text or " \n" in text or text[-1:] == " " or any(c in text for c in _OTHER_SPACE):
        return None
    if "\n\n" not in text:
        text = text.replace("\n", " \0\n \0")
    return BARE + text


def pieces_of(text: str) -> list[str] | None:
    marked = marked_pieces(text)
    return None if marked is None else marked.split(" ")


def piece_text(piece: str) -> str:
    return piece[1:] if piece[:1] == BARE else " " + piece


def _without_tails(split: pa.Array) -> tuple[pa.Array, dict[str, np.ndarray], np.ndarray]:
    """The pieces of all texts with null after each that ends in a letter and a mark of _TAILS, which it loses; the places
    of the nulls by mark; and where each text begins."""
    flat = split.flatten()
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)
    ends = offsets[1:]
    marks = {mark: np.flatnonzero((offsets[:-1] + 2 <= ends) & (data[ends - 1] == ord(mark))) for mark in _TAILS} if len(data) else {}
    for mark, at in marks.items():
        last, lead = data[ends[at] - 2], data[np.maximum(ends[at] - 3, 0)]
        # Letters as every Unicode version has them: A to Z, and U+00C0 to U+023F but for two signs.
        plain = (last | 32) - ord("a") < 26
        latin = (last >= 0x80) & (last < 0xC0) & (lead >= 0xC3) & (lead <= 0xC8) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
        marks[mark] = at[plain | latin]
    cut = np.sort(np.concatenate([np.empty(0, np.int64), *marks.values()]))
    bounds = np.insert(offsets, cut + 1, ends[cut] - 1)
    tails = {mark: at + np.searchsorted(cut, at) + 1 for mark, at in marks.items()}
    held = np.ones(len(bounds) - 1, bool)
    for places in tails.values():
        held[places] = False
    bitmap = pa.py_buffer(np.packbits(held, bitorder="little").tobytes())
    pieces = pa.LargeStringArray.from_buffers(len(held), pa.py_buffer(bounds), flat.buffers()[2], bitmap)
    starts = split.offsets.to_numpy()
    return pieces, tails, starts + np.searchsorted(cut, starts)


class PieceMemory:
    """Encodes texts by their pieces and keeps the ids of pieces already seen. Arrow finds the distinct pieces of many texts,
    each of which is looked up once; a comma or full stop after a letter is a word of its own and is remembered apart.

    The memory has two generations of at most ``size`` pieces; what the young one lacks is taken from the old one,
    so that pieces in use survive when the old one goes. Subclasses say how texts and pieces are encoded.
    """

    def __init__(self, kind: np.dtype, size: int):
        self._kind = kind
        self._size = size
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._tails = dict(zip(_TAILS, self._whole(list(_TAILS))))

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, encoded without the memory."""
        raise NotImplementedError

    def _coded(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of the distinct pieces, encoded without the memory."""
        raise NotImplementedError

    def _has_special(self, text: str) -> bool:
        raise NotImplementedError

    def _known(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of the distinct pieces."""
        if len(self._young) > self._size:
            self._old, self._young = self._young, {}
        young, old = self._young, self._old
        ids = list(map(young.get, pieces))
        later = [at for at, held in enumerate(ids) if held is None]
        unseen = list(map(pieces.__getitem__, later))
        held = list(map(old.get, unseen))
        new = [piece for piece, found in zip(unseen, held) if found is None]
        coded = iter(self._coded(new))
        held = [next(coded) if found is None else found for found in held]
        young.update(zip(unseen, held))
        for at, found in zip(later, held):
            ids[at] = found
        return ids

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text as bytes."""
        out: list[bytes] = [b""] * len(texts)
        whole, parted, marked = [], [], []
        for at, text in enumerate(texts):
            if not text:
                continue
            pieces = None if self._has_special(text) else marked_pieces(text)
            if pieces is None:
                whole.append(at)
            else:
                parted.append(at)
                marked.append(pieces)
        if parted:
            pieces, tails, starts = _without_tails(pc.split_pattern(pa.array(marked, pa.large_string()), " "))
            coded = pieces.dictionary_encode()
            known = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            which = coded.indices.fill_null(0).to_numpy().copy()
            for mark, places in tails.items():
                which[places] = len(known)
                known.append(self._tails[mark])
            held = pa.array(known, pa.large_binary()).take(pa.array(which))
            data = held.buffers()[2].to_pybytes()
            cuts = np.frombuffer(held.buffers()[1], np.int64)[starts].tolist()
            for at, start, end in zip(parted, cuts, cuts[1:]):
                out[at] = data[start:end]
        for at, ids in zip(whole, self._whole([texts[at] for at in whole])):
            out[at] = ids
        return out
