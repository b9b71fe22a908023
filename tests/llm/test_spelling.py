"""Spelling variants against plain versions."""

import collections
import itertools
import random
import re
import zlib

from bookfold.llm import spelling


def plain_words(docs, least_length=7, least_count=2):
    counts = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least_count}


def is_near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(v) - len(u) > 1 or u == v:
        return False
    p = next((k for k, (x, y) in enumerate(zip(u, v)) if x != y), len(u))
    return u[p + 1 :] == v[p + 1 :] if len(u) == len(v) else u[p:] == v[p + 1 :]


def plain_groups(words, factor=10):
    near = collections.defaultdict(list)
    for u, v in itertools.combinations(words, 2):
        if is_near(u, v):
            near[u].append(v)
            near[v].append(u)
    forms = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= factor * n:
                forms[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out[w] = (n, len(near[w]), forms.get(w), words[forms[w]] if w in forms else None, root)
    return out


def grouped(frame):
    rows = frame.select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def made_words(seed, count, alphabet, lengths):
    rng = random.Random(seed)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.choice(lengths))) for _ in range(count)}
    for w in rng.sample(sorted(words), count // 3):
        at = rng.randrange(len(w) + 1)
        words |= {w[:at] + rng.choice(alphabet) + w[at:], w[:at] + w[at + 1 :], w[:at] + rng.choice(alphabet) + w[at + 1 :]}
    words.discard("")
    return {w: 2 + int(rng.paretovariate(0.4)) % 5000 for w in words}


def test_pairs_of_crowded_vocabularies(spark):
    """Two and three letters, words of all lengths from one: runs, ends, and partitions that must be parted again."""
    for seed, alphabet, lengths, most in ((1, "ab", range(1, 9), 20_000), (2, "abé", range(4, 12), 5), (3, "ab", range(6, 14), 8), (4, "xyzñ", range(7, 10), 20_000)):
        words = made_words(seed, 250, alphabet, list(lengths))
        frame = spark.createDataFrame(list(words.items()), "word string, n long")
        assert grouped(spelling.grouped_variants(frame, most_words=most)) == plain_groups(words)
        pairs = [(r.a, r.b) for r in spelling.near_pairs(frame, most_words=most).collect()]
        assert len({frozenset(p) for p in pairs}) == len(pairs)


def test_acceptor_is_minimal():
    machine = spelling.Acceptors()
    words = sorted({"".join(w) for w in itertools.product("abc", repeat=6)})
    machine.accept(words)
    assert len(machine.arcs) == 7
    assert machine.accept(words) == len(machine.arcs) - 1


def test_long_words_and_chains(spark):
    long = "x" * 3000
    words = {long: 5, long + "x": 60, long[:-1] + "y": 2, long[:1500] + "z" + long[1500:]: 9, "chained": 1000, "chaineds": 100, "chaynedss": 1, "chainedss": 10, "chainedsss": 2}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = grouped(spelling.grouped_variants(frame))
    assert found == plain_groups(words)
    assert found["chaynedss"][4] == "chained"


def test_words_of_documents(spark):
    rng = random.Random(5)
    base = ["spelling", "Variante", "Ährenfeld", "variétés", "sevenor", "neighbour", "neighbor", "a×b÷cdefg"]
    docs = [(k, " ".join(rng.choices(base, k=40)) + "," + "-".join(rng.choices(base, k=5))) for k in range(60)]
    docs += [(None, "spelling spelling"), (3, None), (4, ""), (5, "12 34"), (6, "x" * 4000 + " " + "x" * 4000), *docs[:3]]
    frame = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    expected = plain_words(docs)
    words = spelling.counted_words(frame)
    assert dict(words.collect()) == expected
    assert any(w not in {b.lower() for b in base} for w in expected)
    assert grouped(spelling.grouped_variants(words, least_length=7)) == plain_groups(expected)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.grouped_variants(spelling.counted_words(frame)).count() == 0
