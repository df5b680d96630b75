"""Quality rules: base statistics of a text and the cross-document frequency of its lines.

Lines are normalised (ASCII lower case, white space collapsed, digits as 0) and hashed. For each host the documents with
a line are counted; a line above the host's limit is boilerplate and is removed, and a document of which too little is
left is rejected.

The statistics are computed once, in Arrow batches, and stored with one array of line hashes per document. Counts per
(host, line) are summed before they are shuffled, so a line that a third of all documents share costs one row a task.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .shared import bitmap_words, map_batches, marked, row_key

# The symbols that the base rules count.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
DIGITS = bytes.maketrans(b"123456789", b"000000000")
STATISTICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<struct<line: long, words: int>>"
)


def repeated_words(words: list, size: int = 3) -> int:
    """How many words lie in a window of `size` words that the text holds twice or more, the first one included."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    seen: set = set()
    again = {w for w in windows if w in seen or seen.add(w)}
    count, end = 0, 0  # words before `end` are counted
    for at, window in enumerate(windows):
        if window in again:
            count += at + size - max(at, end)
            end = at + size
    return count


def line_key(parts: list[bytes]) -> int:
    """The hash of a normalised line, given its words."""
    from xxhash import xxh3_64_intdigest as digest

    return digest(b" ".join(parts).lower().translate(DIGITS)) - (1 << 63)


def text_statistics(text: str | None) -> tuple[int, int, int, int, int, list[dict]]:
    """The columns of STATISTICS for one text; null is no text."""
    if not text:
        return 0, 0, 0, 0, 0, []
    content = text.encode("utf-8", "surrogatepass")
    words = content.split()
    seen: set[bytes] = set()
    duplicates = 0
    lines: dict[int, int] = {}
    for line in content.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        if line in seen:
            duplicates += 1
        seen.add(line)
        key = line_key(parts)
        lines[key] = lines.get(key, 0) + len(parts)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        duplicates,
        repeated_words(words),
        [{"line": key, "words": count} for key, count in lines.items()],
    )


def content_key(host: str) -> Column:
    return row_key(F.col("doc_id"), F.col("text"), F.col(host).cast("string"))


def statistics(documents: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, key and the STATISTICS of each row; equal rows have equal keys. A line that repeats within a text is listed once, with all its words."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = [part.split()[0] for part in STATISTICS.split(", ")[:6]]

    def run(batch: pa.RecordBatch) -> dict:
        rows = list(zip(*map(text_statistics, batch.column(2).to_pylist())))
        return {"doc_id": batch.column(0), "host": batch.column(1), "key": batch.column(3), **dict(zip(names, map(list, rows)))}

    rows = documents.select("doc_id", F.col(host).cast("string").alias("host"), "text", content_key(host).alias("key"))
    return map_batches(rows, run, f"doc_id {kind}, host string, key long, {STATISTICS}")


def frequent_lines(lines: DataFrame, hosts: DataFrame, documents: int = 20, share: float = 0.01) -> DataFrame:
    """(host, line, n_docs) of the lines that more than `documents` documents of a host hold and more than `share` of them.

    `lines` has n, the documents, for each host and line, in parts, `hosts` the number of documents of each host.
    """
    counts = lines.groupBy("host", "line").agg(F.sum("n").alias("n_docs")).filter(F.col("n_docs") > documents)
    joined = counts.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).filter(F.col("n_docs") > share * F.col("host_docs"))
    return joined.select("host", "line", "n_docs")


def without_lines(text: str, frequent: set[int]) -> tuple[str, int]:
    """The text without its frequent lines, and the number of words in these."""
    kept, removed = [], 0
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        parts = line.split()
        if parts and line_key(parts) in frequent:
            removed += len(parts)
        else:
            kept.append(line)
    return b"\n".join(kept).decode("utf-8", "surrogatepass"), removed


def distinct_documents(rows: DataFrame, again: DataFrame, *keys: str) -> DataFrame:
    """(*keys, n) of rows (*keys, document): the number of distinct documents in parts, to be summed.

    Only documents in `again`, those of more than one row, are made distinct; all others are counted before a shuffle.
    """
    marks = marked(rows, F.col("document"), bitmap_words(again, "document"), "repeats")
    parts = [marks.filter("NOT repeats"), marks.filter("repeats").select(*keys, "document").distinct()]
    counted = [p.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) for p in parts]
    return counted[0].unionByName(counted[1])


def clean_lines(
    documents: DataFrame,
    host: str = "source",
    line_documents: int = 20,
    line_share: float = 0.01,
    least_words: int = 20,
    least_share: float = 0.3,
) -> DataFrame:
    """doc_id, text, the base columns, base_failed, kept, removed_words of each row of `documents` (doc_id, text, `host`).

    text: without the lines above the limits; the base columns are those of the given text. A null text stays null.

    removed_words: words in these lines, which more than `line_documents` documents of the row's host hold, and more than the
    share `line_share` of the host's documents. A row is depleted, and not kept, if lines were removed from it and fewer
    than `least_words` words or less than `least_share` of its words are left. Rows of a null host form one host. Rows
    with the same doc_id are one document; each row without one is a document. A null text is empty and fails the base rules, as do all texts
    of fewer than 50 words.
    """
    stats = store(statistics(documents, host).withColumn("row", F.monotonically_increasing_id()), "rules")
    document = F.when(F.col("doc_id").isNotNull(), row_key(F.col("doc_id"))).otherwise(F.col("row")).alias("document")
    named = stats.select("*", document).withColumn("host", F.coalesce("host", F.lit("\x00null")))
    again = store(named.groupBy("document").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("document"), "repeated-documents")
    lines = named.select("key", "document", "host", F.explode("lines.line").alias("line"))
    hosts = distinct_documents(named.select("host", "document"), again, "host").groupBy(F.col("host").alias("of_host"))
    hosts = hosts.agg(F.sum("n").alias("host_docs"))
    counts = distinct_documents(lines.drop("key"), again, "host", "line")
    frequent = frequent_lines(counts, hosts, line_documents, line_share).drop("n_docs")
    of_rows = lines.join(frequent, ["host", "line"]).groupBy("key").agg(F.collect_set("line").alias("frequent"))
    of_rows = store(of_rows, "frequent-lines")

    def cut(batch: pa.RecordBatch) -> dict:
        pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        rows = [without_lines(text, set(found)) for text, found in pairs]
        return {"key": batch.column(0), "text": [r[0] for r in rows], "removed_words": [r[1] for r in rows]}

    texts = documents.select(content_key(host).alias("key"), "text")
    texts = marked(texts, F.col("key"), bitmap_words(of_rows, "key"), "affected").filter("affected").drop("affected")
    texts = texts.join(of_rows, "key").dropDuplicates(["key"]).select("key", "text", "frequent")
    changed = map_batches(texts, cut, "key long, text string, removed_words long", rows=500)
    changed = changed.withColumnRenamed("text", "cleaned")
    stats = stats.drop("lines", "host", "row").dropDuplicates(["key"])
    given = documents.select("text", content_key(host).alias("key"))
    joined = given.join(stats, "key").join(changed, "key", "left")
    taken = F.coalesce("removed_words", F.lit(0)).cast("long")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - taken
    depleted = (taken > 0) & ((left < least_words) | (left < least_share * F.col("n_words")))
    return joined.select(
        "doc_id", F.coalesce("cleaned", "text").alias("text"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), taken.alias("removed_words"),
    )


def quality_rules(documents: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The columns of `clean_lines` without the text."""
    return clean_lines(documents, host, **limits).drop("text")
