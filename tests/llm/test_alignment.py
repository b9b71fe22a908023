"""Alignment of two tokenizers against a plain version."""

import collections
import hashlib
import random

import duckdb
import numpy as np
import pytest

from bookfold.llm import token_alignment
from bookfold.llm.bpe import byte_symbols
from bookfold.llm.queries import QUERIES, vocabulary_path

SF = "/root/testdata/sf0.001"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary_path())
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))


def plain_groups(libraries, text):
    """Lists of (A ids, B ids), or none."""
    if not text:
        return []
    a, b = libraries
    symbols = byte_symbols()
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(symbols[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return []
    a_ends, b_ends = ([sum(map(len, held[: k + 1])) for k in range(len(held))] if len(held) < 50 else np.cumsum([*map(len, held)]).tolist() for held in (a_bytes, b_bytes))
    groups, cuts = collections.defaultdict(lambda: ([], [])), sorted(set(a_ends) & set(b_ends))
    for side, ids, ends in ((0, a_ids, a_ends), (1, b_ids, b_ends)):
        at = np.searchsorted(cuts, ends)
        for i, g in zip(ids, at):
            groups[g][side].append(i)
    return [groups[g] for g in sorted(groups)]


def plain(libraries, docs):
    read = [plain_groups(libraries, text) for _, text in docs]
    held = collections.Counter()
    links = []
    for groups in read:
        links.append(collections.Counter(p for a, b in groups for x, n in collections.Counter(a).items() for y, m in collections.Counter(b).items() for p in [(x, y)] * (n * m)))
        held.update(links[-1].keys())
    top = collections.Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for (i, _), groups, own in zip(docs, read, links):
        spelled = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        best = sum(n for (x, y), n in own.items() if held[x, y] == top[x])
        numbers = (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()), best, sum(n * held[p] for p, n in own.items()))
        out.append((i, *numbers, hashlib.sha256(spelled.encode()).hexdigest() if groups else ""))
    return out, held, sum(links, collections.Counter())


def rows_of(frame):
    return sorted(map(tuple, frame.select("doc_id", *COLUMNS).collect()), key=repr)


def odd_documents():
    rng = random.Random(6)
    odd = "abc éè中文\U0001f600▁\t\n\x00　 <s></s><|endoftext|>'s 0123"
    docs = [(k, "".join(rng.choice(odd) for _ in range(rng.randrange(200)))) for k in range(150)]
    docs += [(None, "no id"), (3, None), (4, ""), (5, " "), (6, "  two  spaces "), (7, "\n"), (8, "x" * 30_000), (9, "\U0001f9ff" * 3000), (10, "1234567890" * 700), (11, "<|endoftext|> and </s>"), (12, "ﬁ ½ café")]
    return docs + docs[:5]


def test_query(spark, libraries):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert rows_of(QUERIES["op13_token_alignment"](spark, SF)) == sorted(plain(libraries, docs)[0], key=repr)


def test_odd_texts_in_small_fragments(spark, libraries, folder):
    """Bitmaps of one pair and block come from several fragments."""
    docs = odd_documents() * 3
    expected, held, links = plain(libraries, docs)
    frame = spark.createDataFrame([(i, t, "x", 2) for i, t in docs], "doc_id long, text string, pair string, block int").coalesce(1)
    token_alignment.write_alignment(frame, folder + "/a", vocabulary_path(), vocabulary_path("piece_bpe_32k.model"), fragment_links=30)
    postings = token_alignment.read_postings(spark, folder + "/a")
    assert postings.count() > token_alignment.merged_postings(postings).count()
    assert rows_of(token_alignment.aligned_documents(spark, folder + "/a")) == sorted(expected, key=repr)
    counts = token_alignment.pair_counts(postings).collect()
    assert {(r.a, r.b): r.n_docs for r in counts} == dict(held)
    assert {(r.a, r.b): r.n_links for r in counts} == dict(links)


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    with open(vocabulary_path(), encoding="utf-8") as file, open(vocabulary_path("piece_bpe_32k.model"), "rb") as model:
        aligner = token_alignment.Aligner(file.read(), model.read())
    texts = [t for _, t in odd_documents()]
    rows, keys, counts = aligner.read(texts)
    monkeypatch.setattr(token_alignment, "_PLAIN_GROUP", 1)
    again = aligner.read(texts)
    assert again[0] == rows and (again[1] == keys).all() and (again[2] == counts).all()


def test_fragments_merge_to_one_bitmap(spark):
    rng = np.random.default_rng(7)
    rows, expected = [], {}
    for pair in range(5):
        for block in (1, 2):
            held = rng.choice(token_alignment.BLOCK, (10, 3000, 9000)[pair % 3], replace=False)
            expected[pair, block] = sorted(held.tolist())
            for part in np.array_split(rng.permutation(held), 3):
                places = np.sort(part)
                dense = len(places) > 2000
                rows.append((block, pair, -1, dense, bytearray(token_alignment.plain_bitmap(places) if dense else places.astype("<u2").tobytes())))
    frame = spark.createDataFrame(rows, "block long, pair long, plane int, dense boolean, places binary")
    merged = token_alignment.merged_postings(frame).collect()
    assert len(merged) == len(expected)
    assert {(r.pair, r.block): token_alignment.places_in(r.dense, bytes(r.places)).tolist() for r in merged} == expected


def test_empty_table(spark, folder):
    token_alignment.write_alignment(spark.createDataFrame([], "doc_id long, text string"), folder + "/a", vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))
    assert token_alignment.aligned_documents(spark, folder + "/a").count() == 0


def test_items_that_tokens_cross_are_not_valid():
    with open(vocabulary_path(), encoding="utf-8") as file, open(vocabulary_path("piece_bpe_32k.model"), "rb") as model:
        aligner = token_alignment.Aligner(file.read(), model.read())
    read = aligner._grouped(["good one", "token here", "▁bad"], [[5, 4], [3, 8], [6]])
    assert read.valid.tolist() == [True, True, False, False, False]
    assert set(read.item.tolist()) == {0, 1} and read.counts[2:].sum() == 0
