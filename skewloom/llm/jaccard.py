"""Exact n-gram Jaccard join with rare-first prefixes.

A document is the set of its word n-grams (hashes). Two documents link if their sets' Jaccard similarity reaches a
percentage. Sets are ordered from rare to frequent n-grams; linked sets then share one of their first few. So:

1. Documents with equal sets form a class; one of each class goes on.
2. n-gram frequencies are estimated by one array of counters of fixed size. Any order gives right results; a good one
   keeps the n-grams of common passages out of the prefixes.
3. Documents are joined on the n-grams of their prefixes. Size and position of the shared n-gram bound the similarity.
   First each document only meets, for each of its n-grams, the one that has it earliest in its order. These links are
   verified and merged into components; then documents of different components meet. Pairs within a component need no
   further link, so a group of near copies costs about one pair for each of its documents.
4. Each pair is verified once, by a suffix filter and then by the whole sets.

64-bit hashes stand for n-grams and classes. Two n-grams of one pair collide with a chance of about |A| |B| / 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .components import components
from .shared import arrow_schema, in_arrow, map_batches, narrowed, record_batches, release, slices

COUNTER_BITS = 21
SLICES = 32
ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest as digest

        if len(self) > 300_000:
            self.clear()
        found = self[word] = digest(word)
        return found


def mixed(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return values ^ (values >> np.uint64(30))


def gram_set(text: str | None, size: int, known: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of the text's n-grams of `size` words; all words as one if there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    length = min(size, len(words))
    n = len(words) - length + 1
    with np.errstate(over="ignore"):
        grams = np.full(n, length, np.uint64)
        for i in range(length):
            grams = mixed(grams * ODD + hashes[i : i + n])
    return np.unique(grams)


def at_least(percent: int, n: int) -> int:
    """The least number of members that `percent` of n makes."""
    return -(-percent * n // 100)


def overlap_bound(percent: int, a: int, b: int) -> int:
    """The least intersection of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def frequencies(documents: DataFrame, size: int) -> bytes:
    """How often n-grams fall on each of 2**COUNTER_BITS counters, as 16-bit numbers: 4 MB, whatever the input."""
    schema = "slice int, part int, counts binary"
    kinds = arrow_schema(documents.sparkSession, schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = WordHashes(), np.zeros(1 << COUNTER_BITS, np.int32)
        held, n = [], 0
        for batch in (part for whole in batches for part in slices(whole, 1000)):
            for text in batch.column(0).to_pylist():
                grams = gram_set(text, size, known)
                held.append((grams >> np.uint64(64 - COUNTER_BITS)).astype(np.int32))
                n += len(grams)
                if n > 1_000_000:
                    total += np.bincount(np.concatenate(held), minlength=len(total)).astype(np.int32)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total)).astype(np.int32)
        part = TaskContext.get().partitionId() % 64
        parts = np.split(np.minimum(total, 0xFFFF).astype("<u2"), SLICES)
        yield from record_batches({"slice": list(range(SLICES)), "part": [part] * SLICES, "counts": [p.tobytes() for p in parts]}, kinds)
        known = None
        release()

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, "<u2").astype(np.int64) for c in table.column("counts").to_pylist())
        counts = np.minimum(total, 0xFFFF).astype("<u2").tobytes()
        return pa.table({"slice": table.column("slice")[:1], "part": table.column("part")[:1], "counts": [counts]}, schema=kinds)

    counted = in_arrow(documents.select("text"), count, schema)
    for keys in (["slice", "part"], ["slice"]):
        counted = counted.groupBy(*keys).applyInArrow(add, schema)
    rows = {row["slice"]: bytes(row["counts"]) for row in counted.collect()}
    return b"".join(rows[i] for i in range(SLICES)) if rows else bytes(2 << COUNTER_BITS)


def prefixes(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, class, n, prefix) for each row: its class key, the size of its set, and its rarest n-grams in order."""
    counters = documents.sparkSession.sparkContext.broadcast(frequencies(documents, size))
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        frequency, known = np.frombuffer(counters.value, "<u2"), WordHashes()
        classes, sizes, starts = [], [], []
        for text in batch.column(1).to_pylist():
            grams = gram_set(text, size, known)
            classes.append(class_key(grams))
            sizes.append(len(grams))
            count = frequency[grams >> np.uint64(64 - COUNTER_BITS)]
            order = np.argsort(count, kind="stable")[: len(grams) - at_least(percent, len(grams)) + 1]
            starts.append(grams[order].view(np.int64) if len(grams) else [])
        return {"doc_id": batch.column(0), "class": classes, "n": sizes, "prefix": starts}

    return map_batches(documents.select("doc_id", "text"), run, f"doc_id {kind}, class long, n long, prefix array<long>")


def class_key(grams: np.ndarray) -> int | None:
    from xxhash import xxh3_64_intdigest as digest

    return digest(grams.tobytes()) - (1 << 63) if len(grams) else None


def may_link(percent: int, a: str, b: str) -> Column:
    """Bounds for two prefix entries (n, position) that share an n-gram and no earlier one."""
    na, nb, pa_, pb = (F.col(f"{side}.{field}") for field in ("n", "position") for side in (a, b))
    sizes = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    return sizes & ((100 + percent) * F.least(na - pa_, nb - pb) >= percent * (na + nb))


def suffix_bound(a: np.ndarray, b: np.ndarray, depth: int = 3) -> int:
    """An upper bound of the intersection of two sorted sets, from the sizes of their parts around common pivots."""
    if not depth or not len(a) or not len(b):
        return min(len(a), len(b))
    middle = len(b) // 2
    at = int(np.searchsorted(a, b[middle]))
    same = at < len(a) and a[at] == b[middle]
    return suffix_bound(a[:at], b[:middle], depth - 1) + same + suffix_bound(a[at + same :], b[middle + 1 :], depth - 1)


def verified(pairs: DataFrame, documents: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b: class keys) whose sets link. Only sets of classes that occur in a pair are made."""
    pairs = store(pairs.distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct().join(classes, "class")
    keys = wanted.select(F.xxhash64("doc_id").alias("key"))
    near = narrowed(documents.select("doc_id", "text"), F.xxhash64("doc_id"), keys, "key")

    def sets(batch: pa.RecordBatch) -> dict:
        known = WordHashes()
        found = [gram_set(text, size, known) for text in batch.column(0).to_pylist()]
        return {"class": list(map(class_key, found)), "grams": [g.tobytes() for g in found]}

    # Some sets that no pair asks for come along, as the bitmap may let them pass; the joins leave them out.
    made = store(map_batches(near.select("text"), sets, "class long, grams binary"), "sets")

    def check(batch: pa.RecordBatch) -> dict:
        rows = zip(*(batch.column(i).to_pylist() for i in range(4)))
        kept = []
        for a, b, x, y in rows:
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            least = overlap_bound(percent, len(x), len(y))
            if suffix_bound(x, y) >= least and len(np.intersect1d(x, y, assume_unique=True)) >= least:
                kept.append((a, b))
        return {"a": [a for a, _ in kept], "b": [b for _, b in kept]}

    left = made.select(F.col("class").alias("a"), F.col("grams").alias("x"))
    right = made.select(F.col("class").alias("b"), F.col("grams").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return store(map_batches(joined, check, "a long, b long", rows=500), "links")


def jaccard_classes(documents: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, class, component) of each row of `documents` (doc_id, text).

    class: rows with equal sets have equal keys; null for an empty set. component: the least class key that links reach.
    Null and empty texts have no class and link with nothing; a text of fewer than `size` words is one n-gram. Rows that
    repeat are one class. Rows without a doc_id link like all others.
    """
    rows = store(prefixes(documents, size, percent), "prefixes")
    classes = store(rows.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("doc_id")), "classes")
    least = classes.select(F.col("class").alias("of"), F.col("doc_id").alias("least"))  # null if no row of the class has an id
    first = rows.join(least, (F.col("class") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("least")))
    first = first.select("class", "n", F.posexplode("prefix").alias("position", "gram"))
    entries = first.select("gram", F.struct("position", "n", "class").alias("entry"))
    leaders = entries.groupBy("gram").agg(F.min("entry").alias("leader"), F.count(F.lit(1)).alias("entries"))
    leaders = store(leaders.filter("entries > 1").drop("entries"), "leaders")
    shared = store(narrowed(entries, F.col("gram"), leaders, "gram").join(leaders, "gram"), "shared")
    stars = shared.filter("leader.class <> entry.class").filter(may_link(percent, "leader", "entry"))
    pair = [F.least("entry.class", "leader.class").alias("a"), F.greatest("entry.class", "leader.class").alias("b")]
    links = verified(stars.select(*pair), documents, classes, size, percent)
    merged = components(links)

    # Documents of different components that share an n-gram of their prefixes.
    label = F.coalesce("component", F.col("entry.class"))
    placed = shared.join(merged, F.col("entry.class") == F.col("node"), "left").select("gram", "entry", label.alias("component"))
    split = placed.groupBy("gram").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    placed = placed.join(split.filter("least <> most").select("gram"), "gram")
    ours = placed.select("gram", F.col("entry").alias("left"), F.col("component").alias("of_left"))
    theirs = placed.select("gram", F.col("entry").alias("right"), F.col("component").alias("of_right"))
    met = ours.join(theirs, "gram").filter("of_left <> of_right AND left.class < right.class")
    met = met.filter(may_link(percent, "left", "right")).select(F.col("left.class").alias("a"), F.col("right.class").alias("b"))
    met = met.join(store(stars.select(*pair).distinct(), "stars"), ["a", "b"], "left_anti")
    more = verified(met, documents, classes, size, percent)
    final = components(links.unionByName(more)) if more.limit(1).take(1) else merged
    component = F.coalesce("component", "class").alias("component")
    return rows.join(final, F.col("class") == F.col("node"), "left").select("doc_id", F.col("n").alias("n_shingles"), "class", component)


def jaccard_components(documents: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of each row: the smallest doc_id that links reach, the row's own included.

    Null ids are passed over; where links reach no other, component_id is null.
    """
    rows = jaccard_classes(documents, size, percent)
    least = rows.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "component", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
