"""Personal data: direct identifiers by pattern, and terms that reveal them by information theory.

Mail addresses, IP addresses, card and phone numbers are found by pattern, keys and tokens by the information in their
characters. Each distinct value is a protected entity. The corpus then tells which other terms give an entity away: the pointwise mutual information of entity c and term t, from
documents that hold both, is set against the information of c itself,

    disclosure(t, c) = log(N n_ct / (n_c n_t)) / log(N / n_c),

which is 1 if t occurs with c alone. Whole documents are counted, and a term counts wherever it stands outside of
identifiers. Documents with one text count once, so copies are no evidence. A term at or above `remove_at` is removed from
all documents that hold c. One at or above `generalise_at` is replaced by the narrowest class, all terms with its first four
or two letters, that itself stays below the limit, else by a mark for any word; classes are counted like terms. Pairs in
fewer than `support` texts are no evidence.

Entities that stand in exactly the same texts tell and are told alike, so one stands for all of them: thousands of addresses
of one log file are paired with its terms once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .shared import bitmap, bitmap_words, in_bitmap, map_batches, marked, row_key

# The kinds in their order, and their patterns.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "term", "hint")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W\d_]+")
LEAST_LETTERS = 3
CLASS_LETTERS = (4, 2)
KEY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,200}+(?![A-Za-z0-9+/_-])")
KEY_BITS = 3.0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain. Only the text next to each @ is looked at."""
    found, done, at = [], 0, text.find("@")
    while at != -1:
        start = at
        while start > done and text[start - 1] in LOCAL_PART:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            found.append((start, done))
        at = text.find("@", max(at + 1, done))
    return found


def ips(text: str) -> list[tuple[int, int]]:
    """Four dotted numbers: a longer dotted run is taken four numbers at a time, and each four must be at most 255."""
    found = []
    for run in DOTTED.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in four):
                found.append((at, end))
            at = end + 1
    return found


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2]) % 10 == -sum(sum(divmod(2 * d, 10)) for d in values[1::2]) % 10


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for match in DIGITS.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(match.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    spans = [m.span() for m in PHONE.finditer(text)] if "+" in text else []
    return [(a, b) for a, b in spans if 9 <= sum("0" <= c <= "9" for c in text[a:b]) <= 15]


def secrets(text: str) -> list[tuple[int, int]]:
    """Keys and tokens: runs of 20 to 200 signs with letters and digits mixed, of KEY_BITS bits a sign or more."""
    found = []
    for match in KEY.finditer(text):
        value = match.group()
        digits = sum("0" <= c <= "9" for c in value)
        letters = sum(c.isalpha() for c in value)
        if digits < 4 or letters < 4:
            continue
        counts = np.array(list(Counter(value).values())) / len(value)
        if -(counts * np.log2(counts)).sum() >= KEY_BITS:
            found.append(match.span())
    return found


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """Base spans, and secrets that overlap none of them."""
    spans = base_spans(text)
    keys = [(a, KINDS.index("secret"), b) for a, b in secrets(text) if not any(s < b and a < e for s, _, e in spans)]
    return sorted(spans + keys) if keys else spans


FINDERS = (emails, ips, cards, phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), by start and then kind."""
    return sorted((a, kind, b) for kind, find in enumerate(FINDERS) for a, b in find(text))


def term_hash(word: str) -> int:
    from xxhash import xxh3_64_intdigest as digest

    return digest(word.lower().encode()) - (1 << 63)


def entities(text: str, spans: list[tuple[int, int, int]]) -> list[int]:
    """The distinct entities of a text. Card and phone numbers are the same with or without separators."""
    from xxhash import xxh3_64_intdigest as digest

    found = set()
    for start, kind, end in spans:
        value = text[start:end].lower()
        plain = re.sub(r"[^0-9]", "", value) if KINDS[kind] in ("card", "phone") else value
        found.add(digest(f"{KINDS[kind]}:{plain}".encode()) - (1 << 63))
    return sorted(found)


def free_words(text: str, spans: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """The words of a text. Parts of identifiers are none."""
    at, far = 0, 0
    for m in WORD.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            far = max(far, spans[at][2])
            at += 1
        if m.start() >= far:
            yield m


def terms(text: str, spans: list[tuple[int, int, int]], least: int = LEAST_LETTERS) -> set[str]:
    """The distinct terms of a text in lower case, those of `least` letters or more, and their classes."""
    words = (m.group() for m in free_words(text, spans)) if spans else WORD.findall(text)
    found = {w.lower() for w in words if len(w) >= least}
    return found.union(*({class_name(w, n) for w in found if len(w) > n} for n in CLASS_LETTERS))


def class_name(word: str, letters: int) -> str:
    return f"{word[:letters].lower()}*"


def distinct_texts(documents: DataFrame) -> DataFrame:
    """`documents` (row, text) with one row for each row key; only texts that repeat are shuffled, one of each a task."""
    again = store(documents.groupBy("row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("row"), "repeated-texts")
    marks = marked(documents.select("row", "text"), F.col("row"), bitmap_words(again, "row"), "repeats")
    return marks.filter("NOT repeats").select("row", "text").unionByName(marks.filter("repeats").groupBy("row").agg(F.first("text").alias("text")))


def disclosures(texts: DataFrame, support: int, generalise_at: float, least: int = LEAST_LETTERS) -> tuple[DataFrame, DataFrame]:
    """Of distinct texts (row, text): the entities (row, entity) and (entity, term, disclosure) at or above the limit.

    entity: a number for all entities of the same texts. Entities in fewer than `support` texts are in neither.
    """

    def held(batch: pa.RecordBatch) -> dict:
        rows, of_row, words = [], [], []
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if spans := identifiers(text):
                rows.append(row)
                of_row.append(entities(text, spans))
                words.append(sorted(map(term_hash, terms(text, spans, least))))
        return {"row": rows, "entities": of_row, "terms": words}

    found = store(map_batches(texts, held, "row long, entities array<long>, terms array<long>", rows=500), "mentions")
    every = found.select("row", F.explode("entities").alias("value"))
    places = [F.bit_xor(F.xxhash64(F.col("row"), F.lit(n))).alias(f"places{n}") for n in range(2)]
    of_values = every.groupBy("value").agg(F.count(F.lit(1)).alias("n_c"), *places).filter(F.col("n_c") >= support)
    of_values = store(of_values.select("value", "n_c", F.xxhash64("n_c", "places0", "places1").alias("entity")), "entities")
    of_entities = of_values.select("entity", "n_c").distinct()
    mentions = store(every.join(of_values.select("value", "entity"), "value").select("row", "entity").distinct(), "entity-rows")
    of_rows = mentions.groupBy("row").agg(F.collect_list("entity").alias("entities"))
    both = found.select("row", "terms").join(of_rows, "row").select("entities", F.explode("terms").alias("term"))
    both = both.select(F.explode("entities").alias("entity"), "term")
    pairs = both.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_ct")).filter(F.col("n_ct") >= support)
    pairs = store(pairs, "entity-terms")
    filled = texts.sparkSession.sparkContext.broadcast(bitmap(pairs, "term"))

    def frequencies(batch: pa.RecordBatch) -> dict:
        counts: Counter = Counter()
        for text in batch.column(0).to_pylist():
            counts.update(terms(text, identifiers(text), least))
        hashes = np.fromiter(map(term_hash, counts), np.int64, len(counts))
        wanted = in_bitmap(filled.value, hashes)
        return {"term": hashes[wanted], "n_t": np.fromiter(counts.values(), np.int64, len(counts))[wanted]}

    of_terms = map_batches(texts.select("text"), frequencies, "term long, n_t long").groupBy("term").agg(F.sum("n_t").alias("n_t"))
    n = F.lit(texts.select("row").count()).cast("double")
    joined = pairs.join(of_terms, "term").join(of_entities, "entity").filter(F.col("n_c") < n)
    value = F.log2(n * F.col("n_ct") / (F.col("n_c") * F.col("n_t"))) / F.log2(n / F.col("n_c"))
    told = joined.select("entity", "term", value.alias("disclosure")).filter(F.col("disclosure") >= generalise_at)
    return mentions, store(told, "disclosures")


def sanitise(
    documents: DataFrame, support: int = 2, generalise_at: float = 0.7, remove_at: float = 0.85, least_letters: int = LEAST_LETTERS
) -> DataFrame:
    """doc_id, text, spans of each row of `documents` (doc_id, text).

    spans: kind, start, end (code points of the given text) by start and then kind: the identifiers, `secret` for keys and
    tokens, and as `term` and `hint` the words that are removed or generalised. text: identifiers replaced by their kind,
    terms by nothing, hints by their class, as in [abcd*], or by [word]. Words of fewer than `least_letters` letters are never
    terms; languages that write names in one or two signs need a lesser limit. A null text is empty. Rows with one text have
    equal results and count once.
    """
    body = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    body = body.withColumn("row", row_key(F.col("text")))
    mentions, told = disclosures(distinct_texts(body), support, generalise_at, least_letters)
    removed = F.max(F.col("disclosure") >= remove_at).alias("removed")
    telling = mentions.join(told, "entity").groupBy("row", "term").agg(removed)
    telling = store(telling.groupBy("row").agg(F.collect_list(F.struct("term", "removed")).alias("terms")), "telling")
    body = marked(body, F.col("row"), bitmap_words(telling, "row"), "affected")
    alone = body.filter("NOT affected").withColumn("terms", F.lit(None).cast("array<struct<term: long, removed: boolean>>"))
    joined = body.filter("affected").join(telling, "row", "left").select(*alone.columns)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        texts, spans = [], []
        for text, terms in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            told = {t["term"]: t["removed"] for t in terms or []}
            found = all_spans(text, told)
            spans.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in found])
            texts.append(redacted(text, found, told))
        return {"doc_id": batch.column(0), "text": texts, "spans": spans}

    rows = alone.unionByName(joined).select("doc_id", "text", "terms")
    return map_batches(rows, run, f"doc_id {kind}, text string, spans array<struct<kind: string, start: int, end: int>>")


def all_spans(text: str, told: dict[int, bool]) -> list[tuple[int, int, int]]:
    """Identifiers and the told terms outside of them."""
    spans = identifiers(text)
    if not told:
        return spans
    words = []
    for m in free_words(text, spans):
        removed = told.get(term_hash(m.group()))
        if removed is not None:
            words.append((m.start(), KINDS.index("term" if removed else "hint"), m.end()))
    return sorted(spans + words)


def generalised(word: str, told: dict[int, bool]) -> str:
    """The narrowest class of a word that is not told itself."""
    names = (class_name(word, n) for n in CLASS_LETTERS if len(word) > n)
    return f"[{next((name for name in names if term_hash(name) not in told), 'word')}]"


def redacted(text: str, spans: list[tuple[int, int, int]], told: dict[int, bool]) -> str:
    """The text with its spans replaced; overlapping spans are replaced once, by the first."""
    parts, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            parts.append(text[at:start])
            if KINDS[kind] == "hint":
                parts.append(generalised(text[start:end], told))
            elif KINDS[kind] != "term":
                parts.append(f"[{KINDS[kind]}]")
        at = max(at, end)
    return "".join([*parts, text[at:]])


def digest_columns(found: DataFrame) -> DataFrame:
    """doc_id, the number of each kind, base_sha256 and spans (kind:start:end, comma-joined) of `sanitise`."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of([kind])).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(of(BASE_KINDS)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
