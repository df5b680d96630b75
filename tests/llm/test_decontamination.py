import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skewloom.llm.decontamination import ItemIndex, aligned_start, banded_match, characters, decontaminate, gram_hashes, leaks, normal
from skewloom.llm.shared import table

from .conftest import ODD


def distance(pattern, text):
    """Least edits of the pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("ab", min_size=8, max_size=30), st.text("ab", max_size=60))
def test_banded_match_is_the_edit_distance(item, text):
    window, edits = 8, 2
    found = banded_match(characters(text), characters(item), -len(item), len(text), window, edits)
    best = min(distance(item[i : i + window], text) for i in range(len(item) - window + 1))
    assert (found[2] if found else None) == (best if best <= edits else None)


@settings(max_examples=50, deadline=None)
@given(st.text("abc", max_size=40), st.integers(1, 12))
def test_equal_grams_have_equal_hashes(text, q):
    grams = [text[i : i + q] for i in range(max(0, len(text) - q + 1))]
    hashes = gram_hashes(characters(text), q)
    assert len(hashes) == len(grams)
    assert len(set(zip(grams, hashes.tolist()))) == len(set(grams)) == len(set(hashes.tolist()))


def edited(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        kind = rng.random()
        if kind < 0.4:
            letters[at] = "z"
        elif kind < 0.7:
            del letters[at]
        else:
            letters.insert(at, "z")
    return "".join(letters)


def test_every_passage_within_the_budget_is_found():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choices("abcdefghij ", k=n))
    items = [normal(text(rng.randint(90, 200))) for _ in range(20)]
    index = ItemIndex(items, 10)
    for _ in range(150):
        which = rng.randrange(20)
        start = rng.randint(0, len(items[which]) - 80)
        passage = edited(rng, items[which][start : start + 80], rng.randint(0, 6))
        document = text(rng.randint(0, 200)) + passage + text(rng.randint(0, 200))
        assert [n for n, *_ in leaks(document, index, 80, 10, 6)] == [which]
        assert leaks(text(500), index, 80, 10, 6) == []


def test_given_tables(spark, folder):
    """Each document that holds a whole item, and none that shares no 8 words with one."""
    documents = table(spark, folder, "documents").collect()
    items = [normal(r.text) for r in table(spark, folder, "benchmark").collect()]
    found = {r.doc_id for r in decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark")).collect()}
    whole = {d.doc_id for d in documents if any(item in normal(d.text) for item in items)}
    runs = {tuple(w[i : i + 8]) for w in map(str.split, items) for i in range(len(w) - 7)}
    near = {d.doc_id for d in documents if (w := normal(d.text).split()) and any(tuple(w[i : i + 8]) in runs for i in range(len(w)))}
    assert whole <= found <= near and whole


@pytest.fixture
def items(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "item_id long, text string")


LONG = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of mint and thyme at noon"


def test_odd_rows(docs, items):
    rows = [*ODD, (50, f"before. {LONG.upper().replace(' ', '  ')} after"), (50, f"x {LONG}"), (51, LONG[:60]), (52, "tiny item here")]
    found = decontaminate(docs(*rows), items((1, LONG), (2, None), (3, ""), (4, "tiny item here"), (None, "no id but text"), (1, LONG))).collect()
    assert sorted(r.doc_id for r in found) == [50, 50, 52]
    assert all({leak.item_id for leak in r.leaks} == {1} for r in found if r.doc_id == 50)


def test_blocks_and_empty_tables(docs, items):
    documents = docs((1, LONG), (2, LONG[::-1]))
    benchmark = items((1, LONG), (2, LONG[::-1]))
    found = decontaminate(documents, benchmark, block_chars=10).collect()
    assert sorted((r.doc_id, r.leaks[0].item_id) for r in found) == [(1, 1), (2, 2)]
    documents = docs((1, f"{LONG} and {LONG[::-1]}"), (1, f"{LONG} and {LONG[::-1]}"), (2, LONG), (None, LONG), (3, "none"))
    one, many = (decontaminate(documents, benchmark, block_chars=size).collect() for size in (10**6, 10))
    assert sorted(map(str, one)) == sorted(map(str, many))
    assert sorted(((r.doc_id, [x.item_id for x in r.leaks]) for r in many), key=str) == [(1, [1, 2]), (1, [1, 2]), (2, [1]), (None, [1])]


def test_items_shorter_than_a_gram(docs, items):
    documents = docs((1, "a tiny  ITEM here"), (2, "tinyitem"), (3, "itemtiny item"), (4, "(tiny item)"), (5, "漢字"), (6, "漢字 x"))
    found = decontaminate(documents, items((1, "Tiny item"), (2, "漢字"), (3, "?!"))).collect()
    assert {r.doc_id: [tuple(x) for x in r.leaks] for r in found} == {1: [(1, 2, 11, 0)], 4: [(1, 1, 10, 0)], 5: [(2, 0, 2, 0)], 6: [(2, 0, 2, 0)]}


@settings(max_examples=150, deadline=None)
@given(st.text("ab", min_size=1, max_size=12), st.text("ab", max_size=30))
def test_aligned_start(item, text):
    edits = len(item)
    cost = lambda part: whole_distance(item, part)
    starts = {a: cost(text[a:]) for a in range(max(0, len(text) - len(item) - edits), len(text) + 1)}
    assert aligned_start(characters(text), characters(item), edits) == max(starts, key=lambda a: (-starts[a], a))


def whole_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]
    assert decontaminate(documents, items((1, "x")).limit(0)).count() == 0
    assert decontaminate(documents.limit(0), benchmark).count() == 0


def test_repeated_text_alone_is_no_leak(docs, items):
    item = f"{LONG} the the the the {LONG[::-1]}"
    assert decontaminate(docs((1, "the " * 5000)), items((1, item))).count() == 0


def test_hash_spread():
    assert len(np.unique(gram_hashes(characters("".join(map(chr, range(32, 5000)))), 10))) == 4968 - 9
