"""Corpus operators against plain versions on the smallest tables and on tables of edge cases."""

import hashlib
import html
import json
import random
import re
import zlib

import duckdb
import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from bookfold.llm import bpe, html_content, line_dedup, ngram_join, packing, quality, stages, substring_dedup, token_files, topk, url_filter
from bookfold.llm.boosting import train_boosted_trees
from bookfold.llm.components import components
from bookfold.llm.html_tree import parse_page
from bookfold.llm.pieces import piece_text, pieces_of
from bookfold.llm.queries import ORACLE, QUERIES, vocabulary_path

SF = "/root/testdata/sf0.001"
TABLES = "documents pages embeddings labels".split()


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def odd_texts():
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [rng.choice(vocabulary) for _ in range(300)]
    near = [*base[:150], "other", *base[151:]]
    long = " ".join(rng.choice(vocabulary) for _ in range(30_000))
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    return [
        None, "", " \n\t ", "one", "a b c d", "A B C D", "a b c d e", "same " * 500, "x" * 5000, long, long,
        " ".join(base), " ".join(near), " ".join(base).upper(), " ".join(base) + "\r\n",
        "lead " + passage + " tail one two", "other words here " + passage, "<|endoftext|> and <|endoftext|>", "tabs\t\tand  spaces \n\n here", "caf\u00e9 \u4e2d\u6587 \U0001f600 it's",
    ]


@pytest.fixture(scope="module")
def odd(spark):
    """Edge-case texts with repeated rows, a null id, and columns whose names operators use inside."""
    rows = [(i, t) for i, t in enumerate(odd_texts())] + [(3, "one"), (None, "no id here")]
    frame = spark.createDataFrame([(i, t, "s", 1, "x") for i, t in rows], "doc_id long, text string, source string, n int, `key` string")
    return rows, frame.select("doc_id", "text", "source", "n", "key", F.lit(1).alias("place"), F.lit(2).alias("set_id"), F.lit("u").alias("url"))


def empty(spark, name):
    return spark.createDataFrame([], spark.read.parquet(f"{SF}/{name}.parquet").schema)


def by_id(frame, *columns):
    return {r[0]: tuple(r[1:]) for r in frame.select("doc_id", *columns).collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    from compare import canonical

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    ours = QUERIES[name](spark, SF)
    theirs = con.execute(ORACLE[name])
    assert canonical(ours.columns, [tuple(r) for r in ours.collect()]) == canonical([d[0] for d in theirs.description], theirs.fetchall())


def test_near_duplicates(spark, docs, odd):
    rows, frame = odd
    expected = plain.near_duplicates(docs)
    assert by_id(QUERIES["op1_ngram_jaccard_join"](spark, SF), "n_shingles", "component_id") == expected
    named = [(i, t) for i, t in rows if i is not None]
    found = by_id(ngram_join.near_duplicates(frame), "n_shingles", "component_id")
    assert found.pop(None)[1] is None
    assert found == plain.near_duplicates(named)
    assert ngram_join.near_duplicates(frame).count() == len(rows)
    assert ngram_join.near_duplicates(empty(spark, "documents")).count() == 0


def test_near_duplicates_at_the_threshold(spark):
    """Chains at and just below the similarity asked for, over all size bands."""
    rng = random.Random(2)
    rows = []
    for size in (4, 5, 9, 40, 127, 128, 300, 447, 448, 900, 1600):
        base = [f"b{size}-{k}" for k in range(size + 4)]
        for cut in range(0, size // 3 + 2, max(1, size // 12)):
            rows.append((len(rows), " ".join(base[cut:])))
            changed = [w if rng.random() > cut / size / 10 else f"c{rng.random()}" for w in base]
            rows.append((len(rows), " ".join(changed)))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(ngram_join.near_duplicates(frame), "n_shingles", "component_id") == plain.near_duplicates(rows)


def test_pigeonhole_holds():
    """Linked sets share at least the guaranteed number of keys, and their sketches differ in no more places than the sets."""
    rng = np.random.default_rng(3)
    for size in (1, 4, 8, 50, 127, 128, 200, 447, 448, 1000, 5000):
        for _ in range(20):
            base = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            changes = int(rng.integers(0, len(base) // 4 + 1))
            drop = int(rng.integers(0, changes + 1))
            other = np.unique(np.concatenate([base[drop:], rng.integers(0, 2**63, changes - drop).astype(np.uint64)]))
            shared = len(np.intersect1d(base, other))
            distance = len(base) + len(other) - 2 * shared
            dense = np.bitwise_count(ngram_join.dense_sketch(base) ^ ngram_join.dense_sketch(other)).sum()
            assert dense <= distance
            if len(other):
                broad = [ngram_join.broad_sketch(s) for s in (base, other)]
                folded = [ngram_join.folded_to(b, min(map(len, broad))) for b in broad]
                assert np.bitwise_count(folded[0] ^ folded[1]).sum() <= distance
            if len(other) and 100 * shared >= 80 * (len(base) + len(other) - shared):
                common = np.intersect1d(ngram_join.sketch_keys(base, 80), ngram_join.sketch_keys(other, 80))
                assert len(common) >= max(ngram_join.keys_shared(len(base), 80), ngram_join.keys_shared(len(other), 80))
                assert len(common) >= 1 + ngram_join.spare_keys(min(len(base), len(other)), 80)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(100, 160)] + [(0, k) for k in range(1, 50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    groups = plain.Groups()
    for a, b in links:
        groups.join(a, b)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: groups.find(x) for a, b in links if a != b for x in (a, b)}


def test_url_rules_edge_cases(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.NET/x", "http://net/", "http://notnet/", "http://a.net", "http://x.example.net/en/1", "http://x.example.net/EN/1",
            "s://example.com/de/?q=/fr/", "http://example.com/den", "http://a.org/fr/#x", "http://www.free-bets.example.com/en/?a=1", "http://my.casino.org/en", "a://b://c.net/", "http://casinos.org/", "http://a.org/en/casino"]
    frame = spark.createDataFrame([(i, u, "p", "t") for i, u in enumerate([*urls, urls[4]])], "page_id long, url string, path string, token string")
    rows = {r["page_id"]: r for r in url_filter.judge_urls(frame, [*url_filter.PATH_RULES, *url_filter.BLOCK_LIST]).collect()}
    assert len(rows) == len(urls) + 1
    told = {u: (rows[i]["host"], rows[i]["path"], rows[i]["rule"], rows[i]["verdict"]) for i, u in enumerate(urls)}
    assert told[None] == told[""] == told["no scheme"] == told["http://"] == ("", "", None, "allow")
    assert told["HTTP://A.NET/x"] == ("a.net", "/x", "net/", "block")
    assert told["http://net/"][2:] == ("net/", "block")
    assert told["http://notnet/"][2:] == told["http://a.net"][2:] == (None, "allow")
    assert told["http://x.example.net/en/1"][2:] == ("example.net/en/", "allow")
    assert told["http://x.example.net/EN/1"][2:] == ("net/", "block")
    assert told["s://example.com/de/?q=/fr/"] == ("example.com", "/de/", "example.com/de/", "block")
    assert told["http://example.com/den"][2] is None
    assert told["http://a.org/fr/#x"] == ("a.org", "/fr/", "org/fr/", "allow")
    assert told["http://www.free-bets.example.com/en/?a=1"][2:] == (None, "block")
    assert told["http://my.casino.org/en"][3] == "block"
    assert told["http://casinos.org/"][3] == told["http://a.org/en/casino"][3] == "allow"
    assert url_filter.judge_urls(empty(spark, "pages"), url_filter.PATH_RULES).count() == 0


def test_boundaries_minimise_padding():
    rng = np.random.default_rng(5)
    lengths = np.sort(rng.choice(np.arange(1, 60), 9, replace=False))
    counts = rng.integers(1, 9, 9)
    from itertools import combinations

    padded = lambda ends: sum(n * min(e for e in ends if e >= x) for x, n in zip(lengths, counts))
    for k in (1, 2, 3, 4):
        best = min(padded([*c, lengths[-1]]) for c in combinations(lengths[:-1], k - 1))
        assert padded(packing.best_boundaries(lengths, counts, k)) == best


def test_packing(spark, docs, odd):
    rows, frame = odd
    for table, source in ((docs, spark.read.parquet(f"{SF}/documents.parquet")), (rows, frame)):
        packed = packing.pack_documents(source, n_buckets=4, budget=2000).collect()
        assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"]) for r in packed) == sorted((i if i is not None else -1, len(plain.words(t)) + 1) for i, t in table)
        batches = {}
        for r in packed:
            assert r["n_tokens"] <= r["padded"]
            batches.setdefault(r["batch_id"], []).append((r["slot"], r["padded"], r["bucket"]))
        short = {}
        for held in batches.values():
            assert sorted(s for s, _, _ in held) == list(range(len(held)))
            capacity = max(1, 2000 // held[0][1])
            assert len(held) <= capacity
            short[held[0][2]] = short.get(held[0][2], 0) + (len(held) < capacity)
        assert all(n <= 1 for n in short.values())
    assert packing.pack_documents(empty(spark, "documents")).count() == 0


def test_html_extraction(spark):
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in QUERIES["op4_html_extraction"](spark, SF).collect()}
    for page, source in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        expected = "\n".join(b for b in blocks if b)
        assert got[page] == (expected, len(expected))


def test_html_furniture_and_edge_cases(spark):
    model = html_content.train_content_model(html_content.labelled_pages(empty(spark, "pages")))
    prose = "It was a long day, and the river carried the boats past the town; the people watched them go until the evening came."
    page = (
        "<html><head><title>T</title></head><body><div id='top-menu'><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></div><div class=cookie-banner><p>We use cookies, " + prose + "</div>"
        "<article><h1>Head&shy;line &amp; more</h1><p>" + prose + "<p>Line<br>break &lt;b&gt; <b>bold</b>text.<aside class=related><p>" + prose + "</aside><script>if (a<b) {}</script><p>" + prose + "</article>"
        "<div class='comments'><p>" + prose + "</p></div><form><p>" + prose + "</p></form><!-- x --><footer>" + prose + "</footer>"
    )
    assert html_content.extract_text(page, model).split("\n") == ["Head\xadline & more", prose, "Line break <b> boldtext.", prose]
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p>"), (4, "u", "<p>"), (5, "u", "<div>" * 3000 + "<p>x")]
    frame = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    found = html_content.extract_main_text(frame, model).collect()
    assert len(found) == len(rows) and all(r["text"] == "" for r in found if r["page_id"] in (2, 3, 4))
    assert html_content.extract_main_text(empty(spark, "pages"), model).count() == 0


def test_marginals_are_exact():
    """Sum-product on a tree equals the sum over all labellings."""
    from itertools import product
    from math import exp, log

    nodes = parse_page("<div class=ad><p>Some text here.</p><p>More <a>text</a></p></div><p>End.</p>")
    model = html_content.ContentModel({"": 0.2, "text": 0.7, "name:furniture": -1.5, "tag:paragraph": 0.4, "chars1": -0.3}, ((0.8, -0.6), (-1.1, 0.5)))
    own = [sum(model.weights.get(f, 0.0) for f in ["", *html_content.node_features(n)]) for n in nodes]
    total = [[0.0, 0.0] for _ in nodes]
    for labels in product((0, 1), repeat=len(nodes)):
        weight = exp(sum(o * x for o, x in zip(own, labels)) + sum(model.edges[labels[n.parent]][x] for n, x in zip(nodes[1:], labels[1:])))
        for t, x in zip(total, labels):
            t[x] += weight
    assert np.allclose(html_content.content_marginals(nodes, model), [log(t[1] / t[0]) for t in total])


def texts_of(rows):
    return [t or "" for _, t in rows]


def test_bpe(spark, docs, odd, tokenizer):
    rows, frame = odd
    for table, source in ((docs, spark.read.parquet(f"{SF}/documents.parquet")), (rows, frame)):
        found = bpe.encode_and_decode(source, vocabulary_path()).collect()
        ids = [e.ids for e in tokenizer.encode_batch(texts_of(table), add_special_tokens=False)]
        key = lambda x: (x[0] is None, x[0] or 0, x[1])
        expected = sorted(((i, e, tokenizer.decode(e, skip_special_tokens=False)) for (i, _), e in zip(table, ids)), key=key)
        assert sorted(((r["doc_id"], list(r["ids"]), r["decoded"]) for r in found), key=key) == expected
    digests = by_id(QUERIES["op10_bpe"](spark, SF), "n_tokens", "ids_sha256", "decoded_sha256")
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    encoded = [e.ids for e in tokenizer.encode_batch(texts_of(docs), add_special_tokens=False)]
    assert digests == {i: (len(e), sha(",".join(map(str, e))), sha(t or "")) for (i, t), e in zip(docs, encoded)}
    assert bpe.encode_and_decode(empty(spark, "documents"), vocabulary_path()).count() == 0


def test_bpe_odd_strings(tokenizer):
    with open(vocabulary_path(), encoding="utf-8") as file:
        coder = bpe.BytePairCoder(file.read())
    encoder = token_files.PieceEncoder(open(vocabulary_path(), encoding="utf-8").read(), np.dtype("<u2"))
    rng = random.Random(6)
    alphabet = ["a", "B", "1", " ", " ", "  ", "\n", "\n\n", "\t", "\xa0", "\u3000", "\x1c", "\x85", "'s", "'", "\u00e9", "\u4e2d", "!", "<|endoftext|>", "\0", "the", "\r\n", "\U0001f600"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 14))) for _ in range(3000)] + ["ab" * 2000, "x" * 700, " ", "\n", "a ", " a", "a\n b", "a \nb", "a\n "]
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [coder.encode(t) for t in texts] == expected
    assert [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(texts)] == expected
    for text in texts:
        if pieces := pieces_of(text):
            assert "".join(map(piece_text, pieces)) == text


def test_elias_fano():
    rng = np.random.default_rng(7)
    for values in ([], [0], [5], [0, 0, 0], list(range(1000)), [1 << 40], np.sort(rng.integers(0, 1 << 33, 500)).tolist(), [1] * 300 + [10**9]):
        code = token_files.EliasFano.of(np.array(values, np.int64))
        again = token_files.EliasFano(code.count, code.low_bits, code.low, code.high, code.samples.tobytes())
        assert again.values().tolist() == values == [again[i] for i in range(len(values))]


def test_token_files(spark, docs, odd, tokenizer, folder):
    found = by_id(QUERIES["op5_token_files"](spark, SF), "start", "n_tokens", "ids_crc32")
    start = 0
    for (i, _), e in zip(docs, tokenizer.encode_batch(texts_of(docs), add_special_tokens=False)):
        ids = [*e.ids, 2]
        assert found[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    rows, frame = odd
    token_files.write_token_files(frame, f"{folder}/odd", vocabulary_path(), 2)
    read = sorted(token_files.read_token_files(spark, f"{folder}/odd").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in read] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    whole = sum((np.frombuffer(r["ids"], "<u4").tolist() for r in read), [])
    assert [r["start"] for r in read] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in read])])[:-1].tolist() and len(whole) == sum(r["n_tokens"] for r in read)
    token_files.write_token_files(empty(spark, "documents"), f"{folder}/none", vocabulary_path(), 2)
    assert token_files.read_token_files(spark, f"{folder}/none").count() == 0


def test_quality(spark, docs, odd):
    found = by_id(QUERIES["op7_quality_rules"](spark, SF), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for i, text in docs:
        stats = plain.statistics(text)
        failed = stats[0] < 50 or 100 * stats[4] > 50 * stats[0]
        assert found[i][:6] == (*stats, failed)
        assert not (failed and found[i][6])
    rows, frame = odd
    judged = quality.judge_quality(frame, None).collect()
    assert len(judged) == len(rows) and all(r["kept"] != r["base_failed"] for r in judged)
    assert quality.train_quality(frame, empty(spark, "labels")) is None
    assert quality.judge_quality(empty(spark, "documents"), None).count() == 0


def test_quality_held_out(spark):
    """Trained on even ids of labelled documents, tried on odd ones."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    trees = quality.train_quality(docs, labels.filter("doc_id % 2 = 0"))
    tried = quality.judge_quality(docs, trees).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed").collect()
    right = sum(r["kept"] == bool(r["quality"]) for r in tried) / len(tried)
    assert right >= 0.95


def test_trees_are_monotonic():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=600) > 0).astype(float)
    trees = train_boosted_trees(x, y, [1, -1, 0], trees=20)
    grid = np.linspace(-3, 3, 50)
    for feature, sign in ((0, 1), (1, -1)):
        points = np.repeat(rng.normal(size=(20, 1, 3)), 50, axis=1)
        points[:, :, feature] = grid
        steps = np.diff(trees.margin(points.reshape(-1, 3)).reshape(20, 50), axis=1) * sign
        assert (steps >= -1e-12).all()
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.75


def brute_top_k(rows, queries, k):
    out = []
    for q, v in queries:
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def test_top_k(spark):
    table = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    rows = [(i, np.floor(np.array(v, np.float64) * 64).astype(int).tolist()) for i, v in table]
    found = sorted(tuple(r) for r in QUERIES["op8_top_k"](spark, SF).select("query_id", "rank", "vec_id", "score").collect())
    assert found == brute_top_k(rows, [r for r in rows if r[0] % 20 == 0], 20)


def test_top_k_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.5]), (20, [1.0, 0.5]), (1, None), (2, []), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [1.0]), (7, [-1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [1e200, 0.0]), (9, [1.0, 0.5])]
    frame = spark.createDataFrame([(i, v, 1, 1) for i, v in vectors], "vec_id long, embedding array<double>, id int, q int")
    found = sorted(tuple(r) for r in topk.top_k(frame, F.col("id") % 20 == 0, k=3).collect())
    usable = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in vectors if i in (0, 20, 6, 7, 9)]
    assert found == brute_top_k(usable, [r for r in usable if r[0] % 20 == 0], 3)
    assert topk.top_k(empty(spark, "embeddings"), F.col("id") % 20 == 0).count() == 0
    # Two query rows of one id, a repeated one, and candidates.
    rows = [(20, [64, 0]), (20, [0, 64]), (20, [0, 64]), (1, [64, 64]), (2, [128, 0]), (3, [0, 192])]
    frame = spark.createDataFrame([(i, [x / 64 for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    found = sorted(tuple(r) for r in topk.top_k(frame, F.col("id") == 20, k=2).collect())
    assert found == brute_top_k(rows, rows[:2], 2)


def test_line_dedup_edge_cases(spark):
    rows = [(i, "s", f"banner \nline {i}\n\nbanner") for i in range(30)] + [(30, "t", "banner"), (31, None, None), (32, None, "banner"), (33, "s", ""), (33, "s", "")]
    # Columns that are named like the operator's own come back as they were.
    frame = spark.createDataFrame([(*r, 1, "h", "k", [7]) for r in rows], "doc_id long, source string, text string, `line` int, host_key string, kept string, lines array<int>")
    found = line_dedup.drop_boilerplate_lines(frame, ratio=0.5, min_pages=3, dropped="gone").collect()
    assert len(found) == len(rows) and list(found[0].asDict()) == [*frame.columns, "gone"]
    assert {(r["host_key"], r["kept"], *r["lines"]) for r in found} == {("h", "k", 7)}
    assert line_dedup.drop_boilerplate_lines(frame).columns == frame.columns
    texts = {r["doc_id"]: (r["text"], r["gone"]) for r in found}
    assert texts[4] == ("line 4\n", 2) and texts[30] == ("banner", 0) and texts[31] == (None, 0) and texts[32] == ("banner", 0) and texts[33] == ("", 0)
    assert line_dedup.drop_boilerplate_lines(empty(spark, "documents")).count() == 0


def test_lines_of_small_and_hot_hosts(spark):
    """One rule for hosts of any size; a host with most rows is not gathered: the join is a broadcast, or split."""
    rows = [("small", f"banner\nown {i}") for i in range(4)] + [("pair", "twice\nx"), ("pair", "twice\ny")] + [("hot", f"top\nbody {i}") for i in range(300)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, text string")
    found = {r["doc_id"]: r["text"] for r in line_dedup.drop_boilerplate_lines(frame, ratio=0.1).collect()}
    assert found[0] == "own 0" and found[4] == "twice\nx" and found[6] == "body 0" and found[305] == "body 299"
    plan = line_dedup.drop_boilerplate_lines(frame, ratio=0.1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Aggregate" not in plan and "Generate" not in plan


def test_compact_windows_part_all_stretches():
    rng = np.random.default_rng(9)
    for values in (rng.integers(0, 5, 40), rng.integers(0, 1000, 60), np.zeros(30, int)):
        windows = substring_dedup.compact_windows(values, 8)
        for i in range(len(values)):
            for j in range(i + 7, len(values)):
                holding = [(low, c, high) for low, c, high in windows if low <= i <= c <= j <= high]
                assert len(holding) == 1 and values[holding[0][1]] == values[i : j + 1].min()


def test_repeated_passages(spark, docs, odd):
    for table, frame in ((docs, spark.read.parquet(f"{SF}/documents.parquet")), odd):
        expected = plain.repeated_words([(i, t) for i, t in dict(table).items() if i is not None])
        found = {}
        for r in substring_dedup.repeated_passages(frame).collect():
            found.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["start_word"] + r["n_words"]))
        assert set(expected) <= set(found)
        held = sum(len(expected[i] & found[i]) for i in expected) / sum(map(len, expected.values()))
        assert held >= 0.98
    assert substring_dedup.repeated_passages(empty(spark, "documents")).count() == 0


def test_passage_with_changes_is_found_and_clean_text_is_not(spark):
    rng = random.Random(10)
    word = lambda: f"v{rng.randrange(5000)}"
    passage = [word() for _ in range(120)]
    changed = [*passage[:50], "x", *passage[51:90], "y", "z", *passage[90:]]
    rows = [(1, [word() for _ in range(200)] + passage), (2, passage + [word() for _ in range(90)]), (3, [word() for _ in range(60)] + changed), (4, [word() for _ in range(400)]), (5, passage[:40] + [word() for _ in range(100)])]
    found = substring_dedup.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()
    spans = {r["doc_id"]: (r["start_word"], r["n_words"], r["is_first"]) for r in found}
    assert set(spans) == {1, 2, 3}
    assert spans[1] == (200, 120, True) and spans[2] == (0, 120, False) and spans[3] == (60, 122, False)


def test_runs_count_by_themselves_where_joins_fail():
    fresh = iter(range(10_000, 99_999))
    new = lambda n: np.array([next(fresh) for _ in range(n)], np.int32)
    line, five = np.tile(new(10), 20), new(5)
    a, b = np.concatenate([line, new(20), five]), np.concatenate([line, new(20), five])
    assert substring_dedup.similar_stretches(a, b, 0, 46, 80) == [(0, 200, 0, 200)]
    run, next_run = new(50), new(30)
    a, b = np.concatenate([run, new(10), next_run]), np.concatenate([run, new(14), next_run])
    assert substring_dedup.similar_stretches(a, b, 0, 46, 80) == [(0, 50, 0, 50)]
    text = np.concatenate([five[:3], five[:3], five[:3], new(60), five[:3], five[:3]])
    assert substring_dedup.similar_stretches(text, text, 3, 46, 80, before=0) == []


def test_pair_of_texts_on_many_diagonals():
    """All diagonals of a pair together cover what each of them covers alone."""
    rng = np.random.default_rng(7)
    line = rng.integers(0, 1 << 31, 12)
    rest = rng.integers(0, 1 << 31, 400)
    a = np.concatenate([np.tile(line, 20), rest[:60], np.tile(line, 9), rest[60:200]])
    b = np.concatenate([rest[200:], np.tile(line, 15), rest[:60]])
    tries = [(a_at - b_at, a_at, a_at) for a_at in (3, 120, 305, 360) for b_at in (203, 215, 263, 330)] + [(-140, 245, 290)]
    alone = np.zeros((2, len(a) + len(b)), bool)
    together = alone.copy()
    for one in tries:
        for start, end, first, last in substring_dedup.pair_stretches(a, b, [one], 46, 80):
            alone[0, start:end] = alone[1, first:last] = True
    for start, end, first, last in substring_dedup.pair_stretches(a, b, tries, 46, 80):
        together[0, start:end] = together[1, first:last] = True
    assert alone.any() and (together == alone).all()


def test_near_copies_with_insertions(spark):
    rng = random.Random(12)
    some = lambda n: [f"v{rng.randrange(50_000)}" for _ in range(n)]
    rows, expected = [], {}
    for length, inserted in ((80, 5), (80, 10), (95, 8), (400, 60)):
        passage, more = some(length), some(inserted)
        rows += [(len(rows), some(70) + passage + some(90)), (len(rows) + 1, some(30) + passage[: length // 2] + more + passage[length // 2 :] + some(50))]
        expected |= {len(rows) - 2: {(70, length, True)}, len(rows) - 1: {(30, length + inserted, False)}}
    found = {}
    for r in substring_dedup.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect():
        found.setdefault(r["doc_id"], set()).add((r["start_word"], r["n_words"], r["is_first"]))
    assert found == expected


def test_each_passage_survives_once(spark):
    rng = random.Random(11)
    some = lambda n: [f"v{rng.randrange(50_000)}" for _ in range(n)]
    b, c, line = some(60), some(120), some(7)
    rows = [(1, some(90) + b + some(80)), (5, some(150) + b + c + some(200)), (9, b + c + some(400)), (20, some(30) + line * 30 + some(30)), (21, line * 12 + some(90)), (30, some(40) + b + some(70))]
    rows.append((31, rows[-1][1]))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    spans = {(r["doc_id"], r["start_word"], r["n_words"], r["is_first"]) for r in substring_dedup.repeated_passages(docs).collect()}
    assert {(1, 90, 60, True), (5, 150, 60, False), (5, 150, 180, True), (9, 0, 180, False), (30, 40, 60, False), (30, 0, 170, True), (31, 0, 170, False)} <= spans
    left = " ".join(t + " |" for t in dict(stages.drop_repeated_passages(spark, docs, "").collect()).values())
    for passage in (b, c, rows[-1][1][:40], rows[-1][1][100:], *((line * 9)[k : k + 50] for k in range(7))):
        assert left.count(" ".join(passage)) == 1, passage


def test_cutting_words():
    text = " a  b\nc d\te "
    assert stages.without_words(text, [(1, 3)]) == " a  d\te "
    assert stages.without_words(text, [(0, 1), (3, 9)]) == " b\nc "
    assert stages.without_words(text, [(0, 2), (1, 5)]) == " "


def test_stages_keep_columns_and_rows(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    source = docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), source.schema)
        assert docs.columns == source.columns
        texts.append(dict(docs.select("doc_id", "text").collect()))
    labels = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    assert set(texts[1]) == set(texts[0]) < set(labels)
    groups = plain.near_duplicates(list(texts[1].items()))
    assert set(texts[2]) == {i for i, (_, c) in groups.items() if c == i}
    assert not [i for i, places in plain.repeated_words(list(texts[3].items()), 60).items() if len(places) > 60]
    packed = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"]: r["n_tokens"] for r in packed.collect()} == {i: len(plain.words(t)) + 1 for i, t in texts[3].items()}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark, "documents"), sf).count() == 0, name


def test_vocabulary_is_not_copied():
    assert json.load(open(vocabulary_path(), encoding="utf-8"))["model"]["type"] == "BPE"
