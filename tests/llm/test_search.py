import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings as checks
from hypothesis import strategies as st

from skewloom.llm import search as module
from skewloom.llm.jaccard import WordHashes
from skewloom.llm.queries import QUERIES
from skewloom.llm.search import Plan, ranked_search, signature, sliced, terms

from .conftest import ODD

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(rows, items, limit=10):
    """Every document scored for every item."""
    counts = [Counter(plain_terms(text)) for _, text in rows]
    documents, length = sum(map(bool, counts)), sum(c.total() for c in counts)
    df = Counter(t for c in counts for t in c)
    found = []
    for item, text in items:
        scores = []
        for (doc_id, _), c in zip(rows, counts):
            extra = 8 * (25 + 75 * c.total() * documents // length)
            score = 0
            for t in plain_terms(text):
                if c[t]:
                    weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                    score += weight * (10**9 * c[t] // (1000 * c[t] + extra))
            if score:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        found += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:limit], 1)]
    return sorted(map(str, found))


def got(frame):
    return sorted(str(tuple(r)) for r in frame.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("text", ["", "a b", "A-b_c 1é漢Z", "\x00\x1cx\x7f\x80y", "ÀÉ İ ß"])
def test_terms(text):
    assert [t.decode() for t in terms(text)] == plain_terms(text)


def test_odd_rows_copies_ties_and_blocks_of_items(spark, docs, monkeypatch):
    monkeypatch.setattr(module, "ITEM_BLOCK", 3)
    monkeypatch.setattr(module, "BLOCK_DOCS", 16)
    texts = [(100 + i, "one copied text of seven common words") for i in range(60)]
    texts += [(200 + i, f"word{i % 9} a b c " * (1 + i % 4)) for i in range(60)] + [(None, "one"), (None, "one"), (300, "one"), (300, "one")]
    made = docs(*texts, *ODD)
    items = [(1, "one copied"), (2, "word3 word4 WORD4 a"), (3, None), (4, "..."), (5, "nowhere"), (6, "same words x"), (7, "é 漢字 end")]
    items += [(None, "copied text"), (8, "one"), (8, "one"), (9, "a b c " * 2000 + "common")]
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS rank", "'y' AS doc_id")
    rows = [(r.doc_id, r.text) for r in made.collect()]
    assert got(ranked_search(made, frame)) == brute_force(rows, list(dict.fromkeys(items)))
    assert got(ranked_search(made, frame, limit=2)) == brute_force(rows, list(dict.fromkeys(items)), 2)


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "x")], "item_id long, text string")
    assert ranked_search(docs((1, "x")).limit(0), items).count() == 0
    assert ranked_search(docs((1, "x")), items.limit(0)).count() == 0
    assert got(ranked_search(docs((1, "x")), items)) == brute_force([(1, "x")], [(1, "x")])


def test_query_against_every_score(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(QUERIES["op11_bit_sliced_search"](spark, folder)) == brute_force(rows, items)


WORDS = st.lists(st.sampled_from("abcdefghij"), min_size=1, max_size=200)


@checks(max_examples=60, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=12), st.lists(WORDS, min_size=1, max_size=4), st.sampled_from([64, 1 << 20]))
def test_bounds_are_never_below_scores(texts, queries, widest):
    known, held = WordHashes(), module.MAX_WIDTH
    module.MAX_WIDTH = widest  # 64: every signature is far too dense
    try:
        counts = [Counter(w.encode() for w in words) for words in texts]
        every = sorted({t for words in queries for t in (w.encode() for w in words)})
        keys = np.array([known[t] for t in every], np.uint64)
        repeats = [Counter(w.encode() for w in words) for words in queries]
        flat = [(i, every.index(t), 37 * c) for i, q in enumerate(repeats) for t, c in q.items()]
        arrays = [np.array([x[k] for x in flat], kind) for k, kind in enumerate((np.int64, np.int64, float))]
        words = [{t: 37 * c for t, c in q.items()} for q in repeats]
        plan = Plan(len(texts), sum(c.total() for c in counts), keys, words, *arrays)
        for c in counts:
            width, bits = signature(np.array([known[t] for t in c], np.uint64), np.array(list(c.values())))
            assert width <= widest
            bounds = plan.bounds(width, np.array([c.total()]), sliced(width, [bits]))
            assert all(bounds[i, 0] >= plan.score(i, c, c.total()) for i in range(len(queries)))
    finally:
        module.MAX_WIDTH = held
