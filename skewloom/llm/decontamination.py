"""Benchmark decontamination by the q-gram lemma.

If a window of `window` characters of a document aligns with a benchmark item within `edits` edits, both share at least
window + 1 - q * (edits + 1) q-grams, and all of them lie near one diagonal (document position minus item position). So:

1. The characters' q-grams are looked up in an index of the item q-grams; windows with too few hits of any item are left.
2. The hits that are left are counted by item and by overlapping diagonal bands, in windows of the document.
3. Regions that reach the bound are verified by an alignment that is banded around the diagonal.

Items are a query set: they are taken in blocks of bounded size, each of which meets all documents in one scan.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .shared import map_batches, row_key

WORD = re.compile(r"\w+(?:[^\w\s]+\w+)*")
FILTER_BITS = 20
ODD = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each q-gram, by doubling; empty for fewer than q characters."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part, size = codes.astype(np.uint64) * ODD, 1
    result, done = None, 0
    with np.errstate(over="ignore"):
        while size <= q:
            if q & size:
                piece = part[done : done + n]
                result = piece.copy() if result is None else result * (ODD ** np.uint64(size)) + piece
                done += size
            if size * 2 <= q:
                part = part[:-size] * (ODD ** np.uint64(size)) + part[size:]
            size *= 2
        return result ^ (result >> np.uint64(29))


class ItemIndex:
    """The q-grams of a block of items, with a bitmap in front of the sorted list."""

    def __init__(self, items: list[str], q: int):
        self.codes = [characters(item) for item in items]
        hashes = [gram_hashes(codes, q) for codes in self.codes]
        grams = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        position = np.concatenate([*(np.arange(len(h)) for h in hashes), np.zeros(0, int)])
        order = np.argsort(grams, kind="stable")
        self.grams, self.item, self.position = grams[order], item[order], position[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.slots(self.grams)] = True

    @staticmethod
    def slots(grams: np.ndarray) -> np.ndarray:
        return (grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def hits(self, grams: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document position, item, item position) of the q-grams at `places`."""
        wanted = grams[places]
        low = np.searchsorted(self.grams, wanted, "left")
        count = np.searchsorted(self.grams, wanted, "right") - low
        at = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(places, count), self.item[at], self.position[at]


def windows_with_hits(hit: np.ndarray, span: int, least: int) -> np.ndarray:
    """The hit positions that lie in some run of `span` positions with at least `least` hits."""
    total = np.concatenate([[0], np.cumsum(hit)])
    n = len(hit)
    starts = np.arange(max(1, n - span + 1))
    enough = total[np.minimum(starts + span, n)] - total[starts] >= least
    if not enough.any():
        return np.zeros(0, np.int64)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, starts[enough], 1)
    np.add.at(cover, np.minimum(starts[enough] + span, n), -1)
    return np.flatnonzero(hit & (np.cumsum(cover[:n]) > 0))


def candidate_bands(place, item, position, span: int, least: int, width: int) -> set[tuple[int, int, int]]:
    """(item, least and greatest diagonal) of the bands in which some window of the document reaches the bound.

    Bands of 2 * width diagonals overlap by half, so that any width + 1 neighbouring diagonals lie together in one.
    """
    found = set()
    diagonal = place - position
    for shift in (0, width):
        band = (diagonal + shift) // (2 * width)
        order = np.lexsort((place, band, item))
        p, i, b = place[order], item[order], band[order]
        if len(p) < least:
            continue
        ends = np.arange(least - 1, len(p))
        starts = ends - least + 1
        good = (i[ends] == i[starts]) & (b[ends] == b[starts]) & (p[ends] - p[starts] < span)
        if not good.any():
            continue
        # An alignment uses each q-gram of the item once: text that only repeats itself does not reach the bound.
        bands, of_band = np.unique(np.stack([i, b], axis=1), axis=0, return_inverse=True)
        used = np.unique(np.stack([of_band.ravel(), position[order]], axis=1), axis=0)[:, 0]
        reached = (np.bincount(used, minlength=len(bands)) >= least) & np.isin(np.arange(len(bands)), of_band.ravel()[starts[good]])
        found |= {(int(n), int(k) * 2 * width - shift, (int(k) + 1) * 2 * width - shift - 1) for n, k in bands[reached]}
    return found


def banded_match(text: np.ndarray, item: np.ndarray, low: int, high: int, window: int, edits: int) -> tuple[int, int, int] | None:
    """The best (document start, document end, edits) of aligning a window of the item, within the band.

    Every window of `window` item characters is aligned, all at once, with the document over the diagonals from `low` to
    `high` (document minus item position), widened by `edits`. None if none is within `edits`. The end is exact, the
    start is the end less the window's length.
    """
    if not len(text):
        return None
    low, high = low - edits, high + edits
    width, size = high - low + 1, min(window, len(item))
    starts = np.arange(len(item) - size + 1)[:, None]
    big, steps = 2 * window, np.arange(width)
    cost = np.zeros((len(starts), width), np.int32)  # before the first character the start is free within the band
    for row in range(size):
        at = starts + (low + row) + steps
        inside = (at >= 0) & (at < len(text))
        same = text[np.where(inside, at, 0)] == item[starts + row]
        new = np.where(inside, cost + ~same, big)
        new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)  # an item character that the text lacks
        new = np.minimum.accumulate(new - steps, axis=1) + steps  # characters that only the text has
        keep = new.min(axis=1) <= edits
        if not keep.any():
            return None
        starts, cost = starts[keep], new[keep]
    first, d = np.unravel_index(int(cost.argmin()), cost.shape)
    end = min(len(text), int(starts[first, 0]) + size + low + int(d))
    begin = int(starts[first, 0])
    return aligned_start(text[:end], item[begin : begin + size], edits), end, int(cost[first, d])


def aligned_start(text: np.ndarray, item: np.ndarray, edits: int) -> int:
    """Where the best alignment of the whole item with the end of the text begins; of equal ones the shortest."""
    backward = text[max(0, len(text) - len(item) - edits) :][::-1]
    steps = np.arange(len(backward) + 1)
    cost = steps.copy()
    for row, code in enumerate(item[::-1], 1):
        new = np.append(row, np.minimum(cost[1:] + 1, cost[:-1] + (backward != code)))
        cost = np.minimum.accumulate(new - steps) + steps
    return len(text) - int(cost.argmin())


def leaks(text: str | None, index: ItemIndex, window: int, q: int, edits: int) -> list[tuple[int, int, int, int]]:
    """(item number, start, end, edits) of the items of which a window occurs in the text, in the normalised text."""
    content = characters(normal(text or ""))
    grams = gram_hashes(content, q)
    least = window + 1 - q * (edits + 1)
    if len(grams) < least:
        return []
    places = windows_with_hits(index.filter[index.slots(grams)], window - q + 1 + edits, least)
    if not len(places):
        return []
    place, item, position = index.hits(grams, places)
    best: dict[int, tuple[int, int, int]] = {}
    tried = set()
    for number, low, high in sorted(candidate_bands(place, item, position, window - q + 1 + edits, least, edits + 1)):
        if (number, low) in tried or best.get(number, (0, 0, 1))[2] == 0:
            continue
        tried.add((number, low))
        match = banded_match(content, index.codes[number], low, high, window, edits)
        if match and (number not in best or match[2] < best[number][2]):
            best[number] = match
    return [(number, *match) for number, match in sorted(best.items())]


def plain_words(text: str) -> list[tuple[str, int]]:
    """The words of a normalised text without signs around them, and where they start."""
    return [(m.group(), m.start()) for m in WORD.finditer(text)]


def exact_words(text: str, items: dict[tuple[str, ...], list]) -> list[tuple]:
    """(item, start, end) of the first place of each item whose words follow one another in the text."""
    if not items:
        return []
    words = plain_words(normal(text))
    found: dict[tuple[str, ...], tuple[int, int]] = {}
    for size in {len(key) for key in items}:
        for at in range(len(words) - size + 1):
            key = tuple(word for word, _ in words[at : at + size])
            if key in items and key not in found:
                last, start = words[at + size - 1]
                found[key] = words[at][1], start + len(last)
    return [(number, *place) for key, place in sorted(found.items()) for number in items[key]]


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 80,
    q: int = 10,
    edits: int = 6,
    block_chars: int = 2_000_000,
) -> DataFrame:
    """doc_id and leaks (item_id, start, end, edits) of the rows of `documents` that hold a passage of a benchmark item.

    Texts are compared in lower case with white space collapsed; start and end are code points of that form. A passage
    is a window of `window` characters of an item, within `edits` edits. An item shorter than the window counts as a
    whole, if it has q-grams enough for the bound at its own share of the edits, and otherwise only exactly; an item
    shorter than q counts where its words follow one another in the text. Null texts hold nothing, null and empty items
    are left out, repeated rows have equal results. Items are gathered in blocks of at most `block_chars` characters (or
    one item); each block costs one scan, and what the blocks find in a row is then put together.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    leaked = f"leaks array<struct<item_id: {item_kind}, start: int, end: int, edits: int>>"
    scans = [_scan(documents, block, window, q, edits, f"row long, doc_id {kind}, {leaked}") for block in _blocks(benchmark, block_chars)]
    if not scans:
        return documents.sparkSession.createDataFrame([], f"doc_id {kind}, {leaked}")
    if len(scans) == 1:
        return scans[0].drop("row")
    each = [store(scan.withColumn("block", F.lit(number)), "leaks") for number, scan in enumerate(scans)]
    # Rows that repeat have one key, and are found by a block as often as they repeat.
    rows = reduce(DataFrame.unionByName, each).groupBy("row", "block")
    rows = rows.agg(F.first("doc_id").alias("doc_id"), F.first("leaks").alias("leaks"), F.count(F.lit(1)).alias("times"))
    rows = rows.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.flatten(F.collect_list("leaks"))).alias("leaks"), F.max("times").alias("times")
    )
    return rows.select("doc_id", "leaks", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("col")


def _blocks(benchmark: DataFrame, block_chars: int):
    """Lists of (item_id, text), read from the benchmark one partition at a time."""
    block, size = [], 0
    for row in benchmark.filter(F.col("text").isNotNull()).select("item_id", "text").toLocalIterator():
        text = normal(row["text"])
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def _scan(documents: DataFrame, block: list, window: int, q: int, edits: int, schema: str) -> DataFrame:
    """One scan of the documents for a block: items by length class, as short ones have a smaller window."""
    groups: dict[tuple[int, int], list] = {}
    short: dict[tuple[str, ...], list] = {}
    for number, text in block:
        if len(text) >= window:
            groups.setdefault((window, edits), []).append((number, text))
        elif len(text) >= q:
            size = len(text)
            allowed = max(k for k in range(edits * size // window + 1) if k == 0 or size + 1 - q * (k + 1) >= q)
            groups.setdefault((size, allowed), []).append((number, text))
        elif words := tuple(word for word, _ in plain_words(text)):
            short.setdefault(words, []).append(number)
    shared = documents.sparkSession.sparkContext.broadcast((groups, short))

    def indexed() -> tuple:
        groups, short = shared.value
        indexes = [(key, [n for n, _ in items], ItemIndex([t for _, t in items], q)) for key, items in groups.items()]
        return indexes, short

    def run(batch: pa.RecordBatch, held: tuple) -> dict:
        indexes, short = held
        keys, ids, found = [], [], []
        for key, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            rows = [{"item_id": number, "start": start, "end": end, "edits": 0} for number, start, end in exact_words(text, short)]
            rows += [
                {"item_id": names[number], "start": start, "end": end, "edits": cost}
                for (size, allowed), names, index in indexes
                for number, start, end, cost in leaks(text, index, size, q, allowed)
            ]
            if rows:
                keys.append(key)
                ids.append(doc_id)
                found.append(rows)
        return {"row": keys, "doc_id": ids, "leaks": found}

    rows = documents.filter(F.col("text").isNotNull())
    rows = rows.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), "doc_id", "text")
    return map_batches(rows, run, schema, setup=indexed)
