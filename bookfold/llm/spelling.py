"""Spelling variants: words one insertion, deletion or replacement apart, each led to a far more frequent neighbour.

Pairs come from composing finite-state machines: the minimised acceptor of the vocabulary, a transducer that edits one
code point, and the acceptor again. A path of the composition reads two words in step: before the edit both are in one
state, at the edit they part, after it they read the same symbols. Pairs of states whose right languages share nothing
are not followed (kept as known for the task), so the work follows the pairs that are accepted.

The composition is enumerated by initial state. The edit of a pair stands at its first difference. For an edit in the
second half of the shorter word, both words pass the state that the first half leads to: words that share it form one
partition, and the composition starts there. For an edit in the first half, they share what follows instead. A word of
n code points takes part with the words of its length and one more, and with those one shorter: four partitions. One of
more than ``MOST_WORDS`` words is parted again, the span of the edit halved each time: at a single place, words of one length
differ in one letter and those of one more in two, which bounds the partition by the alphabet (4,160 words). So each pair is found in exactly one partition, whatever its size was, and no task holds more.

Edge cases: null and empty texts have no words. A null id has the empty text before the colon. Words of any length take
part; an empty table gives no rows. Repeated rows count as often as they stand. Ties of n go to the smaller word in
code-point order. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookfold.llm.common import only, stored

#: Letters whose runs are words.
LETTERS = r"[A-Za-zÀ-ÿ]"
#: Words of a partition above which it is parted again.
MOST_WORDS = 20_000
#: States and pairs of states that a task keeps.
_KEPT = 400_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def counted_words(docs: DataFrame, least_length: int = 7, least_count: int = 2, typo_every: int = 31, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns word and n: runs of letters, A-Z lower-cased. Where ``typo_every`` divides the crc32 of "id:run", the run
    lost the code point at crc32 % length. Kept with ``least_length`` code points and ``least_count`` occurrences."""
    rows = only(docs, doc_id=id_column, text=text_column)
    # A shorter run can't become a word; the greedy pattern takes whole runs.
    found = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    runs = rows.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(found).alias("run"))
    runs = runs.withColumn("run", F.translate("run", _UPPER, _UPPER.lower()))
    runs = runs.withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % typo_every == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _member(length: Column, first: Column, last: Column) -> Column:
    """Membership of a word in the partition of edits in [first, last) between words of ``length`` and of one more."""
    behind = F.greatest(length - last, F.lit(0))
    key = F.concat_ws("|", *[c.cast("string") for c in (length, first, last)], F.substring("word", F.lit(1), first), F.substring("word", F.length("word") - behind + 1, behind))
    return F.struct(length.alias("length"), first.alias("first"), last.alias("last"), key.alias("key"))


def _members(words: DataFrame, least_length: int) -> DataFrame:
    size = F.length("word")
    spans = []
    for length in (size, size - 1):
        half = F.floor(length / 2).cast("int")
        spans += [_member(length, F.lit(0), half), _member(length, half, length + 1)]
    return words.select("word", "n", F.explode(F.array(*spans)).alias("m")).select("word", "n", "m.*").filter((F.col("length") >= least_length) & (F.col("first") < F.col("last")))


def _halved(members: DataFrame) -> DataFrame:
    middle = F.floor((F.col("first") + F.col("last")) / 2).cast("int")
    parts = F.array(_member(F.col("length"), F.col("first"), middle), _member(F.col("length"), middle, F.col("last")))
    return members.select("word", "n", F.explode(parts).alias("m")).select("word", "n", "m.*")


def near_pairs(words: DataFrame, least_length: int = 1, most_words: int = MOST_WORDS) -> DataFrame:
    """``words``: distinct word and n, no word shorter than ``least_length``. Each pair of near words once: columns a, n_a, b, n_b; b is the longer one, or the
    one with the greater code point at the place where they differ."""
    members = stored(_members(words, least_length), "spelling-members")
    pairs: DataFrame | None = None
    while True:
        parted = members.filter("last - first > 1").groupBy("key").agg(F.count("*").alias("held"))
        large = stored(parted.filter(F.col("held") > most_words).select("key"), "spelling-large")
        done = large.isEmpty()
        small = members if done else members.join(large, "key", "left_anti")
        found = stored(_enumerated(small), "spelling-pairs")
        pairs = found if pairs is None else pairs.union(found)
        if done:
            return pairs
        members = stored(_halved(members.join(large, "key", "left_semi")), "spelling-members")


def _enumerated(members: DataFrame) -> DataFrame:
    rows = members.select("key", "word", "n", "length", "first", "last").repartition("key").sortWithinPartitions("key", "word")

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Acceptors()
        out: list[tuple[str, int, str, int]] = []
        for length, first, last, held in _partitions(batches):
            if len(held) > 1:
                out += machine.near(held, length, first, last)
            if len(out) >= 10_000:
                yield _pair_batch(out)
                out = []
        if out:
            yield _pair_batch(out)

    return rows.mapInArrow(pairs, "a string, n_a long, b string, n_b long")


def _pair_batch(rows: list[tuple[str, int, str, int]]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["a", "n_a", "b", "n_b"])


def _partitions(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, int, list[tuple[str, int]]]]:
    """length, first, last and the (word, n) of each key, rows being sorted by key."""
    current, span, held = None, (0, 0, 0), []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "word", "n", "length", "first", "last")]
        for key, word, n, *place in zip(*columns):
            if key != current:
                if held:
                    yield *span, held
                current, span, held = key, tuple(place), []
            held.append((word, n))
    if held:
        yield *span, held


class Acceptors:
    """Minimised acyclic acceptors that share their states, and the pairs that one edit leads to between them."""

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.arcs: list[dict[str, int]] = []
        self._states: dict[tuple, int] = {}
        self._meet: dict[tuple[int, int], bool] = {}

    def _state(self, arcs: dict[str, int]) -> int:
        """All words of an acceptor have one length, so a state is final exactly if it has no arcs."""
        signature = tuple(arcs.items())
        found = self._states.get(signature)
        if found is None:
            found = self._states[signature] = len(self.arcs)
            self.arcs.append(arcs)
        return found

    def accept(self, words: list[str]) -> int | None:
        """Initial state of the minimal acceptor of sorted, distinct words of one length: a state is looked up among
        the known ones as soon as no further word can pass it."""
        if not words:
            return None
        path: list[dict[str, int]] = [{}]
        before = ""
        for word in words:
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            self._close(path, before, shared)
            path.extend({} for _ in range(len(word) - shared))
            before = word
        self._close(path, before, 0)
        return self._state(path[0])

    def _close(self, path: list[dict[str, int]], word: str, keep: int) -> None:
        while len(path) - 1 > keep:
            state = self._state(path.pop())
            path[-1][word[len(path) - 1]] = state

    def meets(self, p: int, q: int) -> bool:
        """Whether some word is accepted from both states."""
        if p == q:
            return True
        arcs, meet = self.arcs, self._meet
        waiting = [(p, q) if p < q else (q, p)]
        while waiting:
            pair = waiting[-1]
            if pair in meet:
                waiting.pop()
                continue
            left, right = arcs[pair[0]], arcs[pair[1]]
            unknown, found = [], False
            for c, x in left.items():
                y = right.get(c)
                if y is None:
                    continue
                known = True if x == y else meet.get((x, y) if x < y else (y, x))
                if known:
                    found = True
                    break
                if known is None:
                    unknown.append((x, y) if x < y else (y, x))
            if found or not unknown:
                meet[pair] = found
                waiting.pop()
            else:
                waiting.append(unknown[0])
        return meet[(p, q) if p < q else (q, p)]

    def shared(self, p: int, q: int) -> Iterator[str]:
        """The words accepted from both states."""
        waiting = [(p, q, "")]
        while waiting:
            p, q, text = waiting.pop()
            left, right = self.arcs[p], self.arcs[q]
            if not left and not right:
                yield text
            for c, x in left.items():
                y = right.get(c)
                if y is not None and self.meets(x, y):
                    waiting.append((x, y, text + c))

    def near(self, held: list[tuple[str, int]], length: int, first: int, last: int) -> Iterator[tuple[str, int, str, int]]:
        """Pairs of one partition: words of ``length`` and of one more that agree before ``first`` and from ``last`` on."""
        if len(self.arcs) > _KEPT or len(self._meet) > _KEPT:
            self._clear()
        behind = max(length - last, 0)
        short = {w[first : len(w) - behind]: (w, n) for w, n in held if len(w) == length}
        long = {w[first : len(w) - behind]: (w, n) for w, n in held if len(w) > length}
        p, r = self.accept(sorted(short)), self.accept(sorted(long))
        if p is None:
            return
        arcs = self.arcs
        waiting: list[tuple[int, int | None, str]] = [(p, r, "")]
        while waiting:
            p, r, text = waiting.pop()
            left = arcs[p]
            symbols = list(left)
            for i, c in enumerate(symbols):
                for d in symbols[i + 1 :]:
                    if self.meets(left[c], left[d]):
                        for end in self.shared(left[c], left[d]):
                            yield (*short[text + c + end], *short[text + d + end])
            right = arcs[r] if r is not None else {}
            if first + len(text) < last:
                for d, x in right.items():
                    if not left and not arcs[x]:
                        yield (*short[text], *long[text + d])
                    # The edit stands at the first difference, so the shorter word goes on with another symbol.
                    for c, y in left.items():
                        z = arcs[x].get(c) if c != d else None
                        if z is not None and self.meets(y, z):
                            for end in self.shared(y, z):
                                yield (*short[text + c + end], *long[text + d + c + end])
            for c, x in left.items():
                waiting.append((x, right.get(c), text + c))


def grouped_variants(words: DataFrame, factor: int = 10, least_length: int = 1, most_words: int = MOST_WORDS) -> DataFrame:
    """``words``: distinct word and n, no word shorter than ``least_length``. Returns word, n, n_near, form (the near word of largest n, if that is at least
    ``factor`` times the word's n), form_n, root (the last of the chain of forms, the word itself if it has none)."""
    words = stored(words, "spelling-words")
    pairs = near_pairs(words, least_length, most_words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n"))
    both = both.union(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    leads = -F.col("best.less") >= F.col("n") * factor
    joined = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("best.near")).alias("form"),
        F.when(leads, -F.col("best.less")).alias("form_n"),
    )
    formed = stored(joined, "spelling-forms")
    roots = _roots(formed.filter("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(forms: DataFrame) -> DataFrame:
    """Pointers followed to their ends: each pass doubles the steps taken. n grows along a chain, so it ends."""
    pointers = stored(forms, "spelling-roots")
    while True:
        further = pointers.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(pointers.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        pointers = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return pointers
