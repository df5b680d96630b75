"""The join against all pairs."""

import random
from itertools import combinations

import pytest

from skewloom.llm.components import components
from skewloom.llm.jaccard import jaccard_components, overlap_bound
from skewloom.llm.shared import table

from .conftest import ODD


def grams(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute_force(rows, size, percent):
    """doc_id -> (set size, least doc_id reached); ids are unique."""
    sets = {doc_id: grams(text, size) for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {doc_id: (len(s), find(doc_id)) for doc_id, s in sets.items()}


def found(frame, size, percent):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(frame, size, percent).collect()}


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (1, 50)])
def test_near_copies(docs, size, percent):
    rng = random.Random(size)
    rows = []
    for group in range(12):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([1, 2, 3, 30, 120]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            words = list(base)
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(len(words))] = f"w{rng.randint(0, 4000)}"
            rows.append((len(rows) * 7 + 3, " ".join(words).title()))
    assert found(docs(*rows), size, percent) == brute_force(rows, size, percent)


def test_given_tables(spark, folder):
    documents = table(spark, folder, "documents")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(documents, 3, 90) == brute_force(rows, 3, 90)


def test_odd_rows(docs):
    rows = jaccard_components(docs(*ODD, (20, "word"), (21, "SAME\twords here " + "same words here " * 79))).collect()
    assert len(rows) == len(ODD) + 2
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[3] == (0, 3)
    assert by_id[4] == by_id[20] == (1, 4) and by_id[5] == by_id[21] == (3, 5)
    assert by_id[None] == (9, None)
    assert jaccard_components(docs((1, "x")).limit(0)).count() == 0


def test_rows_without_an_id_link_like_all_others(docs):
    words = [f"w{n}" for n in range(60)]
    copy, near = " ".join(words), " ".join([*words[:-1], "other"])
    rows = jaccard_components(docs((7, copy), (None, near), (5, " ".join(["first", *words[1:]]))), 3, 90).collect()
    assert [r.component_id for r in rows] == [5, 5, 5]
    rows = jaccard_components(docs((None, copy), (None, near), (None, copy), (9, "else")), 3, 90).collect()
    assert sorted(str(r.component_id) for r in rows) == ["9", "None", "None", "None"]


def test_components(spark):
    rng = random.Random(1)
    edges = [(n, n + 1) for n in range(100, 160)] + [(500, n) for n in range(501, 700)] + [(rng.randint(800, 900), rng.randint(800, 900)) for _ in range(60)]
    parent = {n: n for edge in edges for n in edge}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {n: find(n) for n in parent if any(n in e and e[0] != e[1] for e in edges)}


def test_overlap_bound():
    for a in range(1, 60):
        for b in range(1, 60):
            least = next(k for k in range(200) if 100 * k >= 90 * (a + b - k))
            assert overlap_bound(90, a, b) == least
