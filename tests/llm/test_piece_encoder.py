"""The encoder of token files: the same ids as the library's, from few pieces and bounded slices."""

import numpy as np
import pyarrow as pa

from bookfold.llm import bpe, token_files
from bookfold.llm.queries import vocabulary_path

TEXTS = ["Word word, word. word", "word,\nword.\n\nword, .", "1, 1. é, 中. it's, foo!, ,", "", None, "two  spaces, here.", "<|endoftext|>, a.", "\0a, b", "a ,b , c"]


def _encoder() -> token_files.PieceEncoder:
    with open(vocabulary_path(), encoding="utf-8") as file:
        return token_files.PieceEncoder(file.read(), np.dtype("<u2"))


def test_ids_are_the_librarys():
    encoder = _encoder()
    for texts in (TEXTS, TEXTS[::-1], []):
        plain = [np.array(encoder._library.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
        assert encoder.encode(texts) == plain


def test_a_mark_after_a_letter_makes_no_piece_of_its_own():
    encoder = _encoder()
    encoder.encode(["so word, word. word"])
    assert set(encoder._young) == {"\0so", "word"}


def test_slices_are_bounded_by_bytes_of_text():
    half = "x" * (token_files._BYTES // 2)
    batch = pa.RecordBatch.from_pydict({"text": [half, half, None, "y", half * 3, "z"]})
    assert [s.num_rows for s in token_files._slices(iter([batch]))] == [3, 1, 1, 1]


def test_a_mark_after_a_letter_is_parted_before_pieces_are_looked_up(monkeypatch):
    encoder, looked_up = _encoder(), []
    known = encoder._known
    monkeypatch.setattr(encoder, "_known", lambda pieces: looked_up.extend(pieces) or known(pieces))
    encoder.encode(["so word, word. word \u00e9t\u00e9, 1, !. \u00d7. , ."])
    assert looked_up == ["\0so", "word", "\u00e9t\u00e9", "1,", "!.", "\u00d7.", ",", "."]


def _coder() -> bpe.BytePairCoder:
    with open(vocabulary_path(), encoding="utf-8") as file:
        return bpe.BytePairCoder(file.read())


def test_words_of_like_length_merge_together(monkeypatch):
    coder, rows = _coder(), []
    merge = coder._merge_rows
    monkeypatch.setattr(coder, "_merge_rows", lambda words, *rest: rows.append(len(words)) or merge(words, *rest))
    words = [w.encode() for w in (" the", "a", " antidisestablishmentarianism", "aaaa" * 9, "\0", "\u00e9\u00e9", " zzz", "b" * 256, "ab" * 200, "")]
    library = _encoder()._library
    assert [np.frombuffer(ids, "<i4").tolist() for ids in coder.encode_words(words)] == [library.encode(w.decode(), add_special_tokens=False).ids for w in words]
    assert rows == [len(words) - 2]


def test_many_texts_are_encoded_as_by_the_library_and_decoded():
    coder, library = _coder(), _encoder()._library
    for texts in (TEXTS, TEXTS[::-1], []):
        coded = coder.encode_many(texts)
        assert [np.frombuffer(ids, "<i4").tolist() for ids in coded] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        ids, offsets = np.frombuffer(b"".join(coded), "<i4"), np.cumsum([0, *map(len, coded)]) // 4
        assert coder.decode_many(ids, offsets).to_pylist() == [t or "" for t in texts]
    half = coder.encode("\u4e2d\u0301")[:1]
    assert coder.decode_many(np.array(half * 2, "<i4"), np.array([0, 1, 2])).to_pylist() == [coder.decode(half)] * 2


def test_memory_of_two_generations_keeps_what_is_in_use(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_PIECES", 2)
    coder, library = _coder(), _encoder()._library
    for texts in (["a b c d"], ["c d e, f."], ["a b c d"], ["x y z c"], ["c"]):
        assert [np.frombuffer(ids, "<i4").tolist() for ids in coder.encode_many(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(coder._old) <= 6 and len(coder._young) <= 6
