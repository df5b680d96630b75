import numpy as np

from skewloom.llm.shared import table
from skewloom.llm.toxicity import BUCKETS, SentenceScorer, features, fit, score, sentence_words, sentences, toxicity

from .conftest import ODD


def taught():
    rng = np.random.default_rng(0)
    words = [f"{a}{b}{c}" for a in ("ba", "de", "fo") for b in ("ri", "mu", "ka") for c in ("n", "s", "")]
    rows = []
    for n in range(200):
        text = [" ".join(rng.choice(words, 6)) for _ in range(6)]
        if n % 3 == 0:
            text[n % 6] += " nasty"
        rows.append((". ".join(text) + ".", int(n % 3 == 0)))
    return rows


def test_document_labels_find_the_sentence():
    weights, bias = fit(taught())
    scorer = SentenceScorer(weights, bias)
    total, parts = scorer.score("Bari muka. A nasty one here! Deri kas.")
    assert total > 0.5
    assert [p > 0.5 for _, _, p in parts] == [False, True, False]
    assert abs(total - (1 - np.prod([1 - p for _, _, p in parts]))) < 1e-9
    assert scorer.score("Bari muka. Deri kas.")[0] < 0.5


def test_held_out_labels(spark, folder):
    labels = table(spark, folder, "labels")
    found = toxicity(table(spark, folder, "documents"), labels).join(labels, "doc_id").toPandas()
    assert ((found.score >= 0.5) == (found.predicted == 1)).all() and found.score.between(0, 1).all()
    held = found[found.held_out]
    assert (held.predicted == held.toxic).mean() > 0.8


def test_odd_rows(docs, labelled):
    taught_rows = [(1000 + n, text) for n, (text, _) in enumerate(taught())]
    marks = [(1000 + n, 1, label) for n, (_, label) in enumerate(taught())]
    marks += [(None, 1, 1), (1000, None, None), (99_999, 1, 1), (1, 0, 1)]
    rows = toxicity(docs(*taught_rows, *ODD), labelled(*marks)).collect()
    assert len(rows) == len(taught_rows) + len(ODD)
    odd = [r for r in rows if r.doc_id is None or r.doc_id < 1000]
    assert all(r.score == 0 for r in odd if r.doc_id in (1, 2, 3)) and all(0 <= r.score <= 1 for r in odd)
    assert [r for r in odd if r.doc_id is None][0].held_out is False
    first, second = [r for r in odd if r.doc_id == 5]
    assert first == second


def test_one_kind_of_label_or_none(docs, labelled):
    assert [r.predicted for r in toxicity(docs((1, "a b")), labelled()).collect()] == [0]
    assert [r.predicted for r in toxicity(docs((1, "a b")), labelled((1, 1, 1))).collect()] == [1]
    assert toxicity(docs((1, "x")).limit(0), labelled((1, 1, 1))).count() == 0


def test_columns_stay(docs):
    frame = docs((1, "a text."))
    result = score(frame.drop("score"), np.zeros(BUCKETS, np.float32), -9.0)
    assert set(frame.columns) - {"text", "score"} <= set(result.columns)


def test_sentences():
    text = "One. Two!\n\n  ... three"
    assert [text[a:b].strip() for a, b in sentences(text)] == ["One.", "Two!", "three"]


def test_a_letter_that_grows_in_lower_case_changes_nothing_else():
    scorer = SentenceScorer(*fit(taught()))
    plain, longer = scorer.score("A NASTY one. Bari muka."), scorer.score("A NASTY one. Bari muka. \u0130")
    assert plain[0] > 0.5 and abs(plain[0] - longer[0]) < 0.1
    assert [(a, b) for a, b, _ in longer[1][:2]] == [(a, b) for a, b, _ in plain[1]]


def test_columns_with_the_names_of_results_are_replaced(docs):
    weights, bias = fit(taught())
    frame = docs((1, "nasty")).selectExpr("doc_id", "text", "'x' AS score", "'y' AS spans", "'z' AS predicted", "'kept' AS other")
    row = score(frame, weights, bias).first()
    assert row.other == "kept" and row.predicted in (0, 1) and 0 <= row.score <= 1


def likelihood(theta, bias, rows):
    """The noisy-or log likelihood of labelled texts, one document after the other."""
    total = 0.0
    for text, label in rows:
        clean = 1.0
        for a, b in sentences(text):
            z = bias + sum(theta[features(w)].sum() for w in sentence_words(text, a, b))
            clean *= 1 - 1 / (1 + np.exp(-z))
        total += np.log(max(1e-12, 1 - clean if label else clean))
    return total / len(rows)


def test_fitting_raises_the_likelihood_to_a_flat_place():
    rows = taught()
    steps = [fit(rows, steps=n, sparsity=0.0) for n in (1, 40, 300)]
    values = [likelihood(w, b, rows) for w, b in steps]
    assert values[0] < values[1] < values[2] <= 0
    weights, bias = steps[-1]
    used = np.flatnonzero(weights)[:5]
    for bucket in used:  # no small change of a weight helps much
        for by in (-1e-2, 1e-2):
            changed = weights.copy()
            changed[bucket] += by
            assert likelihood(changed, bias, rows) < values[2] + 1e-3
