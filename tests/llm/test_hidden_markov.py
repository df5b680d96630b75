import math
import zlib
from collections import Counter
from itertools import product

import numpy as np

from skewloom.llm.hidden_markov import Model, expected_counts, forward, hidden_markov_scores
from skewloom.llm.shared import table

from .conftest import ODD


def test_forward_and_counts_against_all_paths():
    rng = np.random.default_rng(1)
    draw = lambda *shape: (lambda x: x / x.sum(axis=-1, keepdims=True))(rng.random(shape))
    model = Model(draw(3), draw(3, 3), draw(3, 5).T)
    pieces = [np.array(p) for p in ([4, 1, 0, 2, 2], [1, 3], [0])]
    starts, moves, emits, total = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), []
    for piece in pieces:
        paths = {}
        for path in product(range(3), repeat=len(piece)):
            p = model.start[path[0]] * model.emit[piece[0], path[0]]
            for a, b, symbol in zip(path, path[1:], piece[1:]):
                p *= model.move[a, b] * model.emit[symbol, b]
            paths[path] = p
        whole = sum(paths.values())
        total.append(math.log10(whole))
        for path, p in paths.items():
            starts[path[0]] += p / whole
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / whole
            for state, symbol in zip(path, piece):
                emits[symbol, state] += p / whole
    assert np.allclose(forward(model, pieces), total, atol=1e-5)
    found = expected_counts(model, pieces)
    for mine, theirs in zip(found, (starts, moves, emits, sum(total))):
        assert np.allclose(mine, theirs, atol=1e-4)


def test_long_texts_do_not_underflow():
    model = Model(np.full(2, 0.5), np.array([[0.9, 0.1], [0.2, 0.8]]), np.full((1000, 2), 1e-3))
    assert np.allclose(forward(model, [np.zeros(50_000, int), np.zeros(3, int)]), [-150_000, -9], rtol=1e-4)


def checked(rows, texts):
    """The base columns by their definition; texts: (doc_id, text) of all rows."""
    counts = Counter()
    for doc_id, text in texts:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 != 1:
            counts.update([*(text or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    by_id = dict(texts)
    for r in rows:
        words = [*(by_id[r.doc_id] or "").encode().lower().split(), None]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert abs(r.base_score - base) <= 1e-9 * len(words) * 10
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1)


def test_given_tables(spark, folder):
    documents = table(spark, folder, "documents")
    rows = hidden_markov_scores(documents).collect()
    checked(rows, [(r.doc_id, r.text) for r in documents.collect()])
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.95 * sum(r.base_score for r in held)  # a better model of unseen texts


def test_odd_rows(docs):
    rows = hidden_markov_scores(docs(*ODD), steps=2).collect()
    assert len(rows) == len(ODD)
    checked(rows, ODD)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert hidden_markov_scores(docs((1, "x")).limit(0), steps=1).count() == 0


def test_score_is_a_distribution(spark):
    """All texts of one known vocabulary of one-word classes: their probabilities do not sum to more than one."""
    rows = [(n, f"w{n % 3}") for n in range(40)]
    texts = [" ".join(t) for length in range(4) for t in product(["w0", "w1", "w2"], repeat=length)]
    frame = spark.createDataFrame(rows + [(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    scores = [r.score for r in hidden_markov_scores(frame, states=2, steps=3).collect() if r.doc_id >= 1000]
    assert 0.5 < sum(10**s for s in scores) < 1
