"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir); all but ``pack`` return the columns of docs.

``n_chars``, where docs have it, follows a changed text. Rows without an id pass every stage but the quality rules
unchanged. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.llm.common import arrow_rows, read_table, stored
from bookfold.llm.line_dedup import drop_boilerplate_lines
from bookfold.llm.ngram_join import near_duplicates
from bookfold.llm.packing import pack_documents
from bookfold.llm.quality import keep_good, train_quality
from bookfold.llm.substring_dedup import repeated_passages

#: Lines on more than this share of a host's pages, and on so many of them at least, are boilerplate.
LINE_RATIO, LINE_MIN_PAGES = 0.1, 3
_SPACES = " \t\n\x0b\x0c\r"


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))


def drop_poor_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the base rules or the trees reject go."""
    return keep_good(docs, train_quality(docs, read_table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: each host's boilerplate lines go from its documents."""
    return _recounted(drop_boilerplate_lines(docs, LINE_RATIO, LINE_MIN_PAGES))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component of near-duplicates the document of smallest id stays."""
    joined = near_duplicates(docs).select("doc_id", "component_id")
    leaving = stored(joined.filter("component_id <> doc_id").select("doc_id").distinct(), "leaving")
    return docs.join(leaving, "doc_id", "left_anti").select(docs.columns)


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words from..to (exclusive) of each span, and without the white space after them."""
    places, inside = [], False
    for i, c in enumerate(text):
        space = c in _SPACES
        if not space and not inside:
            places.append(i)
        inside = not space
    places.append(len(text))
    kept, done = [], 0
    for start, end in sorted(spans):
        kept.append(text[done : places[min(start, len(places) - 1)]])
        done = max(done, places[min(end, len(places) - 1)])
    return "".join([*kept, text[done:]])


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: a passage that repeats an earlier one is cut out of the text; first occurrences stay."""
    passages = repeated_passages(docs).filter(~F.col("is_first"))
    spans = passages.groupBy("doc_id").agg(F.collect_list(F.array("start_word", F.col("start_word") + F.col("n_words"))).alias("__spans"))
    joined = docs.join(stored(spans, "cuts"), "doc_id", "left").select(*docs.columns, "__spans")
    place = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 512):
            texts = batch.column(place).to_pylist()
            for i, found in enumerate(batch.column("__spans").to_pylist()):
                if found and texts[i] is not None:
                    texts[i] = without_words(texts[i], [tuple(s) for s in found])
            columns = [pa.array(texts, pa.string()) if k == place else batch.column(k) for k in range(len(docs_columns))]
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = docs.columns
    return _recounted(joined.mapInArrow(cut, docs.schema))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: every document's bucket, batch and slot."""
    return pack_documents(docs)
