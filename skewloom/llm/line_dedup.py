"""Removing repeated passages by winnowing over word hashes.

Every run of `min_words` words that a document has and an earlier place of the corpus has too is deleted; places are in
the order of (doc_id, row key, position). No such run is left out:

- A gram is a piece of min_words // `window` words. Of the grams that a run of `min_words` words holds, the one with the
  least hash is the run's fingerprint, so equal runs have equal fingerprints, with or without lines or sentences in them.
- Neighbouring runs with one fingerprint are one context. Contexts with equal words are joined with the first of them,
  and all of the later ones go, so a passage of a million documents makes a million rows.
- Where a fingerprint stands in contexts that differ, as at the ends of a passage, the first holder of each context lists
  its single runs, and each run has its own first place.

Rows have hashes and no text. Documents without a repeated fingerprint are not shuffled and not read again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .shared import bitmap_words, map_batches, marked, narrowed, row_key

SHORT_LINE = 4
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xBF58476D1CE4E5B9)
LOWER = np.uint64((1 << 32) - 1)
# Bytes of texts that are hashed together, and of the words that are hashed by eights.
GROUP_BYTES = 1 << 18
WORD_BYTES = 64
IN_WORD = bytes(b not in b"\x20\x09\x0a\x0b\x0c\x0d" for b in range(256))
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def line_words(text: str) -> list[list[bytes]]:
    """The words of each line that has one, in ASCII lower case. A line ends at a line feed or with . ! ? and a space."""
    content = text.encode("utf-8", "surrogatepass").lower()
    for stop in (b".", b"!", b"?"):
        content = content.replace(stop + b" ", stop + b"\n")
    return [words for line in content.split(b"\n") if (words := line.split())]


def least(keys: np.ndarray, window: int) -> np.ndarray:
    """For each `window` neighbouring keys the place of the least; of equal ones the last. Spans are doubled up to `window`."""
    at, span = np.arange(len(keys)), 1
    while span < window:
        step = min(span, window - span)
        right = keys[step:] <= keys[:-step]
        at = np.where(right, at[step:], at[:-step])
        keys = np.minimum(keys[step:], keys[:-step])
        span += step
    return at


def least_grams(grams: np.ndarray, window: int) -> np.ndarray:
    """As `least`, by the upper halves of the hashes: the lower half of a key is its place, so one minimum finds both.

    Which gram stands for a run depends on nothing but the run's words, also where upper halves are equal.
    """
    keys, span = (grams | LOWER) - np.arange(len(grams), dtype=np.uint64), 1
    while span < window:
        step = min(span, window - span)
        keys = np.minimum(keys[step:], keys[:-step])
        span += step
    return (LOWER - (keys & LOWER)).astype(np.int64)


def winnow(hashes: list[int], lengths: list[int], window: int) -> list[int]:
    """Numbers of the lines that are least in some window; of equal ones the last. Short lines come after all others."""
    keys = np.array(hashes, np.uint64) >> np.uint64(1)
    keys |= (np.array(lengths) < SHORT_LINE).astype(np.uint64) << np.uint64(63)
    return np.unique(least(keys, min(window, len(keys)))).tolist()


POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of BASE and of its inverse modulo 2**64, from 0 to size - 1. Those of usual sizes are kept in the worker."""
    if size in POWERS:
        return POWERS[size]
    made = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        values = np.full(size, base, np.uint64)
        values[0] = 1
        made.append(np.cumprod(values, dtype=np.uint64))
    if size <= 1 << 17:
        POWERS[size] = made[0], made[1]
    return made[0], made[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """The values, changed in place, each by a one-to-one map."""
    values ^= values >> np.uint64(32)
    values *= MIX
    values ^= values >> np.uint64(29)
    return values


def word_bounds(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of UTF-8 text start and end, in bytes."""
    inside = np.frombuffer(b"\0" + content.translate(IN_WORD) + b"\0", bool)
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def word_hashes(content: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word: of its length and its bytes, eight at a time; few are longer than WORD_BYTES."""
    from xxhash import xxh3_64_intdigest as digest

    eights = np.ndarray(len(content) + 1, "<u8", content + bytes(8), strides=(1,))
    sizes = ends - starts
    values = sizes.astype(np.uint64) * np.uint64(BASE)
    values += eights[starts] & MASKS[np.minimum(sizes, 8)]
    mixed(values)
    longer, at = np.flatnonzero(sizes > 8), 8
    while len(longer) and at < WORD_BYTES:
        part = eights[starts[longer] + at] & MASKS[np.minimum(sizes[longer] - at, 8)]
        values[longer] = mixed(values[longer] + part)
        at += 8
        longer = longer[sizes[longer] > at]
    for n in longer.tolist():
        values[n] = digest(content[starts[n] : ends[n]])
    return values


def groups(texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, firsts, sums) of neighbouring texts, which have GROUP_BYTES together unless one has more.

    Words are in ASCII lower case. The words of text `place` + n are firsts[n], ..., firsts[n + 1] - 1 of the group; `sums`
    are sums of their hashes times powers, from which `run_hashes` hashes any run.
    """
    held: list[bytes] = []
    place = size = 0
    for text in texts:
        content = (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(content) > GROUP_BYTES:
            yield place, *prefix_sums(held)
            place, held, size = place + len(held), [], 0
        held.append(content)
        size += len(content) + 1
    if held:
        yield place, *prefix_sums(held)


def prefix_sums(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, contents), np.int64, len(contents)) + 1
    content = b"\n".join(contents).lower()
    starts, ends = word_bounds(content)
    firsts = np.searchsorted(starts, np.cumsum(sizes) - sizes)
    values = word_hashes(content, starts, ends)
    up, _ = powers(1 << len(values).bit_length())
    values *= up[: len(values)]
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return np.append(firsts, len(values)), sums


def run_hashes(sums: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
    """A hash of the words of each run, wherever it stands."""
    _, down = powers(1 << (len(sums) - 1).bit_length())
    values = sums[ends] - sums[starts]
    values *= down[starts]
    return mixed(values)


def contexts(firsts: np.ndarray, sums: np.ndarray, min_words: int, window: int) -> tuple[np.ndarray, ...]:
    """(text, gram, context, start, runs) of a group: runs `start`, ..., start + runs - 1 of `text` have the fingerprint `gram`."""
    size = max(1, min_words // window)
    words = len(sums) - 1
    if words < min_words:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    grams = run_hashes(sums, slice(0, words + 1 - size), slice(size, words + 1))
    chosen = least_grams(grams, min_words - size + 1)
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    # Runs that begin in one text and end in another are left out.
    whole = np.flatnonzero(text[: len(chosen)] == text[min_words - 1 :])
    turns = np.flatnonzero(np.diff(chosen[whole], prepend=-1))
    starts = whole[turns]
    runs = np.diff(turns, append=len(whole))
    text = text[starts]
    context = run_hashes(sums, starts, starts + runs - 1 + min_words)
    return text, grams[chosen[starts]], context, starts - firsts[text], runs


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (start, end) in order, with those that touch made one."""
    found: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if found and a <= found[-1][1]:
            found[-1] = (found[-1][0], max(b, found[-1][1]))
        else:
            found.append((a, b))
    return found


def covered(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rows (text, start, end): the spans of each text, in order, with those that touch made one."""
    spans: dict[int, list[tuple[int, int]]] = {}
    for n, a, b in zip(text.tolist(), start.tolist(), end.tolist()):
        spans.setdefault(n, []).append((a, b))
    return np.array([(n, a, b) for n in spans for a, b in merged(spans[n])], np.int64).reshape(-1, 3)


def fingerprints(documents: DataFrame, min_words: int, window: int) -> DataFrame:
    """(doc_id, row, gram, context, start, runs, again) for each context of each row.

    Of equal contexts of one text the first has a row; what the others cover are rows with `again`, without hashes. Texts
    of fewer than `min_words` words have no row.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        parts: list[list[np.ndarray]] = [[], [], [], [], [], []]
        for place, firsts, sums in groups(batch.column(2).to_pylist()):
            text, gram, context, start, runs = contexts(firsts, sums, min_words, window)
            first = np.unique(context + text.view(np.uint64) * np.uint64(BASE), return_index=True)[1]
            rest = np.ones(len(context), bool)
            rest[first] = False
            spans = covered(text[rest], start[rest], start[rest] + runs[rest] - 1 + min_words)
            none = np.zeros(len(spans), np.uint64)
            again = np.repeat([False, True], [len(first), len(spans)])
            first.sort()
            rows = (
                np.concatenate([text[first], spans[:, 0]]) + place,
                np.concatenate([gram[first], none]),
                np.concatenate([context[first], none]),
                np.concatenate([start[first], spans[:, 1]]),
                np.concatenate([runs[first], spans[:, 2] - spans[:, 1] + 1 - min_words]),
                again,
            )
            for held, values in zip(parts, rows):
                held.append(values)
        kinds = (np.int64, np.uint64, np.uint64, np.int64, np.int64, bool)
        places, gram, context, start, runs, again = (np.concatenate([np.zeros(0, k), *held]) for k, held in zip(kinds, parts))
        of_rows = pa.array(places)
        return {
            "doc_id": batch.column(0).take(of_rows), "row": batch.column(1).take(of_rows), "gram": gram.view(np.int64),
            "context": context.view(np.int64), "start": start, "runs": runs, "again": again,
        }

    schema = f"doc_id {kind}, row long, gram long, context long, start int, runs int, again boolean"
    return map_batches(documents.select("doc_id", "row", "text"), run, schema, rows=500)


def single_runs(firsts: DataFrame, documents: DataFrame, min_words: int) -> DataFrame:
    """(gram, run, doc_id, row, start): each run of the contexts `firsts` (gram, first, runs), with its hash."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        # Of each run that is asked for: its text, and where in the list of the requests of all texts its request stands.
        column = batch.column(3)
        asked = column.flatten()
        of_request = column.value_parent_indices().to_numpy()
        first, runs = (asked.field(name).to_numpy().astype(np.int64) for name in ("start", "runs"))
        request = np.repeat(np.arange(len(runs)), runs)
        places = of_request[request]
        starts = np.arange(len(request)) - np.repeat(np.cumsum(runs) - runs, runs) + first[request]
        gram = asked.field("gram").to_numpy()[request]
        parts = [np.zeros(0, np.uint64)]
        for place, firsts, sums in groups(batch.column(2).to_pylist()):
            here = slice(*np.searchsorted(places, [place, place + len(firsts) - 1]))
            at = firsts[places[here] - place] + starts[here]
            parts.append(run_hashes(sums, at, at + min_words))
        hashes, of_rows = np.concatenate(parts), pa.array(places)
        return {
            "doc_id": batch.column(0).take(of_rows), "row": batch.column(1).take(of_rows), "gram": gram,
            "run": hashes.view(np.int64), "start": starts,
        }

    request = F.struct("gram", "first.start", "runs")
    asked = store(firsts.groupBy("first.row").agg(F.collect_list(request).alias("asked")), "run-requests")
    texts = narrowed(documents.select("doc_id", "row", "text"), F.col("row"), asked, "row").dropDuplicates(["row"])
    joined = texts.join(asked, "row").select("doc_id", "row", "text", "asked")
    return map_batches(joined, run, f"doc_id {kind}, row long, gram long, run long, start int", rows=500)


def repeated(prints: DataFrame, documents: DataFrame, min_words: int) -> DataFrame:
    """(row, spans): the words, as start and end, of each row that an earlier place has in runs of `min_words`."""
    place = F.struct("doc_id", "row", "start")
    own = prints.filter("NOT again").drop("again")
    shared = store(own.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "shared-grams")
    near = store(narrowed(own, F.col("gram"), shared, "gram"), "shared-contexts")
    held = (F.min("row") != F.max("row")).alias("copied")
    firsts = near.groupBy("gram", "context").agg(F.min(place).alias("first"), F.first("runs").alias("runs"), held)
    firsts = store(firsts, "first-contexts")
    later = (F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start"))
    end = F.col("start") + F.col("runs") - 1 + min_words
    copies = near.join(firsts.filter("copied").select("gram", "context", "first"), ["gram", "context"]).filter(later)
    differ = firsts.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    runs = store(single_runs(firsts.join(differ, "gram").select("gram", "first", "runs"), documents, min_words), "runs")
    first_runs = runs.groupBy("gram", "run").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    others = runs.join(first_runs.drop("n"), ["gram", "run"]).filter(later)
    found = copies.select("row", "start", end.alias("end"))
    found = found.union(others.select("row", "start", (F.col("start") + min_words).alias("end")))
    found = found.union(prints.filter("again").select("row", "start", end.alias("end")))
    return found.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def without(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[dict]]:
    """The text without the words in `spans`, and what was deleted in code points."""
    content = text.encode("utf-8", "surrogatepass")
    starts = np.append(word_bounds(content)[0], len(content))
    gone = [(int(starts[a]), int(starts[b])) for a, b in merged(spans)]
    kept, removed, at, point = [], [], 0, 0
    for a, b in gone:
        stays, goes = (content[i:j].decode("utf-8", "surrogatepass") for i, j in ((at, a), (a, b)))
        removed.append({"start": point + len(stays), "end": point + len(stays) + len(goes)})
        kept.append(stays)
        at, point = b, removed[-1]["end"]
    kept.append(content[at:].decode("utf-8", "surrogatepass"))
    return "".join(kept), removed


def line_dedup(documents: DataFrame, min_words: int = 50, window: int = 2) -> DataFrame:
    """All columns of `documents` (doc_id, text, ...) with the text cleaned, and `removed`, the spans that were deleted.

    removed: start and end in code points of the given text. Earlier means a smaller doc_id; a null id comes first. Rows
    with the same id and text are one document, so they keep the same text; an exact copy under another id loses all of
    it. A repeated run within one text is deleted too. Null texts stay null, with nothing removed; texts of fewer than
    `min_words` words stay as they are. `window` pieces of equal length make a run: it sets the number of fingerprints,
    not the result. Columns named row, spans or removed may exist; removed is replaced.
    """
    names = [c for c in documents.columns if c != "removed"]
    rest = [c for c in names if c != "text"]
    body = documents.select(F.struct(*rest).alias("body"), "doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("row"))
    texts = body.filter(F.col("text").isNotNull()).select("doc_id", "row", "text")
    prints = store(fingerprints(texts, min_words, window), "fingerprints")
    found = store(repeated(prints, texts, min_words), "repeated")
    body = marked(body, F.col("row"), bitmap_words(found, "row"), "affected")
    kind = documents.select(*names).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)
    removed = "array<struct<start: int, end: int>>"
    whole = [F.col("text") if c == "text" else F.col("body").getField(c).alias(c) for c in names]
    alone = body.filter("NOT affected").select(*whole, F.array().cast(removed).alias("removed"))

    def run(batch: pa.RecordBatch) -> dict:
        cleaned, gone = [], []
        for text, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text, spans = without(text, [(p["start"], p["end"]) for p in parts]) if parts else (text, [])
            cleaned.append(text)
            gone.append(spans)
        body = batch.column(2)
        columns = {name: body.field(name) for name in rest}
        return {**columns, "text": cleaned, "removed": gone}

    joined = body.filter("affected").join(found, "row", "left").select("text", "spans", "body")
    return alone.unionByName(map_batches(joined, run, f"{schema}, removed {removed}", rows=500))
