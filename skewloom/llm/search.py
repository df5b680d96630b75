"""Ranked lexical search over bit-sliced Bloom signatures.

A document's signature is a Bloom filter of its terms, and of its terms that occur twice or more, three times or more, five
times or more and so on. Signatures of equal width are stored in blocks, turned: a slice holds one bit of each document, so
the documents that may hold a term are the AND of a few slices. Filters never miss a term, and a term's share of a score
grows with its occurrences, so the weighted sum of these bitmaps is an upper bound of each document's score.

A query takes two passes over the blocks. The first gives the documents with the highest bounds of each item; their exact
scores give the score that the last place takes at least. The second gives all documents whose bound reaches that score,
and these are scored exactly. Nothing else is left out, except copies of a text beyond those that can be listed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import store
from .jaccard import WordHashes
from .shared import arrow_schema, bitmap_words, in_arrow, map_batches, marked, record_batches, release, row_key

# What ends a term becomes a space, A-Z lower case; every byte of a character beyond ASCII belongs to a term.
TERM_BYTES = bytes(c if c >= 128 or bytes([c]).isalnum() else 32 for c in range(256)).lower()

ENTRY_BITS = 12
HASHES = 3
BLOCK_DOCS = 256
BLOCK_BITS = 1 << 25
MAX_WIDTH = 1 << 20
HELD_TERMS = 200_000
FLAT_ROWS = 4096
PROBES = 4
ITEM_BLOCK = 500
# A term belongs to a tier if it occurs so often at least.
TIERS = [1, 2, *(2**i + 1 for i in range(1, 40))]


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split() if text else []


def tier_keys(keys: np.ndarray, tier: int) -> np.ndarray:
    """Other hashes for the same terms in each tier."""
    if not tier:
        return keys
    mixed = (keys ^ np.uint64(TIERS[tier])) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def slots(keys: np.ndarray, width: int) -> np.ndarray:
    """The bits of each key in a signature of `width` bits, a power of two: one row for each of HASHES."""
    low, step = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)[:, None]
    return ((low + steps * step) & np.uint64(width - 1)).astype(np.int64)


def signature(keys: np.ndarray, counts: np.ndarray) -> tuple[int, np.ndarray]:
    """Width and set bits. Beyond MAX_WIDTH a signature only gets denser, which loosens its bounds."""
    entries = [keys]
    for tier in range(1, len(TIERS)):
        often = counts >= TIERS[tier]
        if not often.any():
            break
        entries.append(tier_keys(keys[often], tier))
    every = np.concatenate(entries)
    width = min(MAX_WIDTH, 1 << max(6, (ENTRY_BITS * len(every) - 1).bit_length()))
    return width, np.unique(slots(every, width)).astype(np.int32)


def block_docs(width: int) -> int:
    return min(BLOCK_DOCS, BLOCK_BITS // width)


def sliced(width: int, signatures: list[np.ndarray]) -> bytes:
    """`width` slices of one bit for each signature."""
    bits = np.zeros((width, len(signatures)), bool)
    for place, held in enumerate(signatures):
        bits[held, place] = True
    return np.packbits(bits, axis=1, bitorder="little").tobytes()


def build_index(documents: DataFrame) -> DataFrame:
    """A stored table with a row (width, doc_id, content, n, slices) for each block and rows (term, df) of partial counts.

    content: a digest of the text; n: terms with repeats. Documents without a term have no part in it.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"width int, doc_id array<{kind}>, content array<string>, n array<long>, slices binary, term array<long>, df array<long>"
    kinds = arrow_schema(documents.sparkSession, schema)

    def row(**values) -> Iterator[pa.RecordBatch]:
        return record_batches({f.name: [values.get(f.name)] for f in kinds}, kinds)

    def counted(held: Counter) -> Iterator[pa.RecordBatch]:
        keys = np.fromiter(held.keys(), np.uint64, len(held))
        return row(term=keys.view(np.int64), df=list(held.values()))

    def block(width: int, docs: list) -> Iterator[pa.RecordBatch]:
        ids, contents, n, signatures = zip(*docs)
        return row(width=width, doc_id=list(ids), content=list(contents), n=list(n), slices=sliced(width, signatures))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list] = {}
        known, held = WordHashes(), Counter()
        for batch in batches:
            for i in range(batch.num_rows):
                found = Counter(terms(batch.column(2)[i].as_py()))
                if not found:
                    continue
                keys = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
                counts = np.fromiter(found.values(), np.int64, len(found))
                held.update(keys.tolist())
                width, bits = signature(keys, counts)
                docs = blocks.setdefault(width, [])
                docs.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), int(counts.sum()), bits))
                if len(docs) == block_docs(width):
                    yield from block(width, blocks.pop(width))
                if len(held) > HELD_TERMS:
                    yield from counted(held)
                    held = Counter()
        for width, docs in blocks.items():
            yield from block(width, docs)
        if held:
            yield from counted(held)
        blocks = held = known = None
        release()

    texts = documents.filter("text IS NOT NULL").select("doc_id", F.md5("text").alias("content"), "text")
    return store(in_arrow(texts, run, schema), "signatures")


@dataclass
class Plan:
    """What the tasks need of a block of items. Flat arrays have a row for each distinct term of each item, by item."""

    documents: int
    length: int
    keys: np.ndarray  # of all terms
    words: list[dict[bytes, int]]  # per item: term -> weight times repeats
    item: np.ndarray  # flat
    term: np.ndarray  # flat, into keys
    weight: np.ndarray  # flat

    def norm(self, n):
        return 100 - 75 + (75 * n * self.documents) // self.length

    def score(self, item: int, counts: dict[bytes, int], n: int) -> int:
        extra = 8 * self.norm(n)
        words = self.words[item]
        shared = words.keys() & counts.keys()
        return sum(words[t] * (1_000_000_000 * counts[t] // (1000 * counts[t] + extra)) for t in shared)

    def bounds(self, width: int, n: np.ndarray, slices: bytes) -> np.ndarray:
        """At least the score of each item (rows) in each document of a block."""
        table = np.frombuffer(slices, np.uint8).reshape(width, -1)
        extra = 8 * self.norm(n)
        total = np.zeros((len(self.words), len(n)))
        shares, held = np.zeros(len(n)), None
        flat = np.arange(len(self.term))
        for tier in range(len(TIERS) - 1):
            at = slots(tier_keys(self.keys, tier), width)
            rows = np.bitwise_and.reduce(table[at], axis=0)
            held = rows if held is None else held & rows
            flat = flat[held.any(axis=1)[self.term[flat]]]
            if not len(flat):
                break
            most = np.minimum(TIERS[tier + 1] - 1, n)
            share = (1_000_000_000 * most // (1000 * most + extra)).astype(float)
            bits = np.unpackbits(held, axis=1, count=len(n), bitorder="little")
            for start in range(0, len(flat), FLAT_ROWS):
                some = flat[start : start + FLAT_ROWS]
                first = np.flatnonzero(np.diff(self.item[some], prepend=-1))
                sums = np.add.reduceat(self.weight[some, None] * bits[self.term[some]], first, axis=0)
                total[self.item[some[first]]] += sums * (share - shares)
            shares = share
        return total * (1 + 1e-12)


def make_plan(index: DataFrame, frequencies: DataFrame, texts: list[str | None]) -> Plan:
    """Weights of the terms of some items, from the counts over all documents."""
    spark = index.sparkSession
    known, repeats = WordHashes(), [Counter(terms(text)) for text in texts]
    every = sorted({t for words in repeats for t in words})
    keys = np.fromiter(map(known.__getitem__, every), np.uint64, len(every))
    wanted = spark.createDataFrame([(k,) for k in keys.view(np.int64).tolist()], "term long")
    df = {row["term"]: row["df"] for row in frequencies.join(F.broadcast(wanted), "term").collect()}
    sizes = index.filter("width IS NOT NULL").select(F.size("n").alias("docs"), F.expr("aggregate(n, 0L, (a, x) -> a + x)").alias("terms"))
    documents, length = (x or 0 for x in sizes.agg(F.sum("docs"), F.sum("terms")).first())
    place = {t: i for i, t in enumerate(every)}
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(k, 0) + 1))) for k in keys.view(np.int64).tolist()]
    words = [{t: weight[place[t]] * c for t, c in found.items() if weight[place[t]]} for found in repeats]
    flat = [(i, place[t], w) for i, found in enumerate(words) for t, w in found.items()]
    item, term, weights = (np.array([x[k] for x in flat], kind) for k, kind in enumerate((np.int64, np.int64, float)))
    return Plan(documents, max(1, length), keys, words, item, term, weights)


def smallest_copies(contents: list[str], ids: list, limit: int) -> np.ndarray:
    """Of the copies of a text in a block the `limit` with the least ids; no result can list others."""
    kept, seen = np.zeros(len(ids), bool), Counter()
    for i in sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i])):
        kept[i] = seen[contents[i]] < limit
        seen[contents[i]] += 1
    return kept


def bounded(index: DataFrame, plan, kind: str, limit: int, probes: int = 0, least: list[int] | None = None) -> DataFrame:
    """(item, bound, doc_id, content): documents with a bound of `least` or more of the item, all there are; or with
    `probes` those that may have the highest bounds of all."""
    schema = f"item int, bound double, doc_id {kind}, content string"
    kinds = arrow_schema(index.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = len(plan.value.words)
        floor = np.array(least or [0] * items, float)
        best = np.zeros((items, max(1, probes)))
        for batch in batches:
            for i in range(batch.num_rows):
                width, ids, contents, n, slices = (batch.column(k)[i].as_py() for k in range(5))
                bound = plan.value.bounds(width, np.array(n, np.int64), slices)
                bound[:, ~smallest_copies(contents, ids, limit)] = 0
                if probes:
                    best = np.partition(np.concatenate([best, bound], axis=1), -probes, axis=1)[:, -probes:]
                    floor = best.min(axis=1)
                    if len(n) > probes:  # not all of many equal ones
                        high = np.argpartition(bound, -probes, axis=1)[:, -probes:]
                        some = np.zeros_like(bound)
                        np.put_along_axis(some, high, np.take_along_axis(bound, high, axis=1), axis=1)
                        bound = some
                of, doc = np.nonzero((bound > 0) & (bound >= floor[:, None]))
                if len(of):
                    columns = {"item": of, "bound": bound[of, doc], "doc_id": [ids[d] for d in doc], "content": [contents[d] for d in doc]}
                    yield from record_batches(columns, kinds)

    return in_arrow(index.filter("width IS NOT NULL").select("width", "doc_id", "content", "n", "slices"), run, schema)


def first_rows(rows: DataFrame, groups: list[str], order: list, limit: int, name: str = "rank") -> DataFrame:
    """The first rows of each group; Spark cuts groups to `limit` rows before it shuffles them."""
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return rows.withColumn(name, place).filter(F.col(name) <= limit)


def scored(pairs: DataFrame, documents: DataFrame, plan) -> DataFrame:
    """`pairs` (item, doc_id, content) with their exact `score`. A text is scored once, however many copies it has."""
    asked = pairs.groupBy("content").agg(F.min("doc_id").alias("doc_id"), F.collect_set("item").alias("items"))
    asked = store(asked.select("content", "items", row_key(F.col("doc_id"), F.col("content")).alias("row")), "asked-texts")
    texts = documents.filter("text IS NOT NULL").select("doc_id", "text", F.md5("text").alias("content"))
    texts = texts.select("text", row_key(F.col("doc_id"), F.col("content")).alias("row"))
    near = marked(texts, F.col("row"), bitmap_words(asked, "row"), "possible").filter("possible").select("text", "row")
    joined = near.join(asked, "row").select("content", "text", "items")

    def run(batch: pa.RecordBatch) -> dict:
        found = []
        for i in range(batch.num_rows):
            content, text, items = (batch.column(k)[i].as_py() for k in range(3))
            counts = Counter(terms(text))
            n = counts.total()
            found += [(content, item, plan.value.score(item, counts, n)) for item in items]
        return {"content": [x[0] for x in found], "item": [x[1] for x in found], "score": [x[2] for x in found]}

    # Rows that repeat are scored alike.
    made = map_batches(joined, run, "content string, item int, score long", rows=500).dropDuplicates(["content", "item"])
    return pairs.join(made, ["content", "item"])


def search(index: DataFrame, documents: DataFrame, items: DataFrame, limit: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the `limit` documents with the highest score above 0 for each of `items`.

    items: (item_id, text); rows that repeat are one item, items without a term have no result. Equal scores go by
    ascending doc_id, null first. Each row of `documents` is a document, so a row that repeats may be listed twice. Items
    are taken in blocks of about ITEM_BLOCK, by a hash, so the tasks hold a bounded number of them.
    """
    spark = documents.sparkSession
    kind, item_kind = (df.schema[c].dataType.simpleString() for df, c in ((documents, "doc_id"), (items, "item_id")))
    items = store(items.filter("text IS NOT NULL").select("item_id", "text").distinct(), "items")
    blocks = -(-items.count() // ITEM_BLOCK)
    counts = index.filter("term IS NOT NULL").select(F.explode(F.arrays_zip("term", "df")).alias("x"))
    frequencies = store(counts.groupBy("x.term").agg(F.sum("x.df").alias("df")), "document-frequencies")
    ordered = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    results = spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    for number in range(blocks):
        some = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        plan = spark.sparkContext.broadcast(make_plan(index, frequencies, [row["text"] for row in some]))
        probes = first_rows(bounded(index, plan, kind, limit, PROBES * limit), ["item"], [F.col("bound").desc()], PROBES * limit)
        probes = store(probes.select("item", "doc_id", "content"), "probes")
        last = first_rows(scored(probes, documents, plan), ["item"], ordered, limit).filter(F.col("rank") == limit)
        least = [0] * len(some)
        for row in last.select("item", "score").collect():
            least[row["item"]] = row["score"]
        pairs = bounded(index, plan, kind, limit, least=least).select("item", "doc_id", "content")
        # More copies of one text than places cannot be listed.
        pairs = store(first_rows(pairs, ["item", "content"], [F.col("doc_id").asc_nulls_first()], limit).drop("rank"), "candidates")
        found = first_rows(scored(pairs, documents, plan).filter("score > 0"), ["item"], ordered, limit)
        ids = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(some)], f"item int, item_id {item_kind}")
        found = store(found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
        plan.destroy()
        results = results.unionByName(found)
    return results


def ranked_search(documents: DataFrame, items: DataFrame, limit: int = 10) -> DataFrame:
    """`search` for all of `items` (item_id, text) over an index of all of `documents` (doc_id, text)."""
    return search(build_index(documents), documents, items, limit)
