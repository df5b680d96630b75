"""Line deduplication: what must go, what must stay, and that something of every passage stays."""

import random
import time

import numpy as np
from xxhash import xxh3_64_intdigest

from skewloom.llm.line_dedup import contexts, groups, least, least_grams, line_dedup, line_words, prefix_sums, winnow, without
from skewloom.llm.shared import table

from .conftest import ODD


def sentence(rng, n):
    return " ".join("".join(rng.choices("bcdfglmnprst", k=1) + rng.choices("aeiou", k=1) + rng.choices("bcdfgh", k=2)) + str(rng.randint(0, 999)) for _ in range(n)).capitalize() + "."


def windows(text, size):
    words = text.lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def test_passages_go_from_later_documents(docs):
    rng = random.Random(2)
    passages = [" ".join(sentence(rng, rng.randint(6, 12)) for _ in range(8)) for _ in range(6)]
    rows, own = [], {}
    for n in range(60):
        before, after = (" ".join(sentence(rng, 9) for _ in range(rng.randint(1, 5))) for _ in range(2))
        passage = passages[n % 6] if n % 2 else ""
        own[n] = (before.rstrip("."), after)
        rows.append((n, f"{before.rstrip('.')} {passage} {after}"))
    given = dict(rows)
    found = {r.doc_id: r for r in line_dedup(docs(*rows)).collect()}
    seen = set()
    for n in sorted(found):
        assert not seen & windows(found[n].text, 51)
        seen |= windows(found[n].text, 51)
        assert all(part in " ".join(found[n].text.split()) for part in own[n])  # what is the document's own stays
        kept = "".join(given[n][a:b] for a, b in zip([0, *(s.end for s in found[n].removed)], [*(s.start for s in found[n].removed), None]))
        assert kept == found[n].text
    assert all(windows(p, 51) <= seen for p in passages[1::2])  # the first of each passage stays


def test_given_tables(spark, folder):
    """Of the 51-word windows that documents share, all with sentence ends inside go from the later ones."""
    documents = table(spark, folder, "documents")
    given = {r.doc_id: r.text for r in documents.collect()}
    found = {r.doc_id: r.text for r in line_dedup(documents).collect()}
    seen, before, left = set(), 0, 0
    for doc_id in sorted(given):
        old, new = windows(given[doc_id], 51), windows(found[doc_id], 51)
        before += bool(old & seen)
        left += bool(new & seen)
        seen |= old
    assert before and left <= before * 0.1


def test_copies_and_repeats_within(docs):
    text = "\n".join(f"line {n} has some words of its own, number {n}" for n in range(20))
    rows = [(7, text), (3, text), (3, text), (9, "start " + text + "\n" + text)]
    found = line_dedup(docs(*rows)).collect()
    texts = sorted((r.doc_id, r.text) for r in found)
    assert texts[0] == texts[1] == (3, text)
    assert texts[2] == (7, "") and texts[3][1].split() == ["start"]


def test_short_runs_stay(docs):
    line = "Licensed under some licence that many documents carry with them, version 2.0."
    rows = [(n, f"Own words {n} of document {n} come first here.\n{line}\nAnd then {n} again.") for n in range(50)]
    assert all(not r.removed for r in line_dedup(docs(*rows)).collect())


def test_odd_rows(docs):
    frame = docs(*ODD)
    found = line_dedup(frame)
    assert set(found.columns) == set(frame.columns) | {"removed"}
    rows = found.collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].text is None and by_id[1].removed == [] and by_id[2].text == "" and by_id[3].text == " \n\t \n"
    assert by_id[8].text == dict((i, t) for i, t in ODD)[8]
    first, second = [r for r in rows if r.doc_id == 5]
    assert first.text == second.text
    assert line_dedup(frame.limit(0)).count() == 0


def test_winnowing_guarantee():
    rng = random.Random(4)
    for window in (1, 2, 5):
        hashes = [rng.getrandbits(64) for _ in range(40)]
        chosen = winnow(hashes, [9] * 40, window)
        assert all(any(i <= c < i + window for c in chosen) for i in range(40 - window + 1))
    assert winnow([5, 5, 5], [9, 9, 9], 2) == [1, 2]
    assert winnow([1, 9], [1, 9], 2) == [1]  # a short line only if there is no other


def test_lines():
    assert line_words("One two. Three!\nFour\n\n five?") == [[b"one", b"two."], [b"three!"], [b"four"], [b"five?"]]


def expected_words(rows, min_words):
    """(doc_id, words left) by definition: a word goes if it is in a run of `min_words` that an earlier place has."""
    seen, left = set(), {}
    for doc_id, text in sorted(rows):
        words = text.lower().split()
        gone = [False] * len(words)
        for i in range(len(words) - min_words + 1):
            run = tuple(words[i : i + min_words])
            if run in seen:
                gone[i : i + min_words] = [True] * min_words
            seen.add(run)
        left[doc_id] = [w for w, g in zip(words, gone) if not g]
    return left


def test_first_holder_has_the_line_in_another_context(docs):
    """The lines that two later documents share are all held before, by documents that have nothing else of the passage."""
    rng = random.Random(12)
    lines = [sentence(rng, 11) for _ in range(7)]
    passage = " ".join(lines)
    rows = [(n, f"{sentence(rng, 20)} {line} {sentence(rng, 20)}") for n, line in enumerate(lines)]
    rows += [(20, " ".join(passage.split()[:40])), (21, " ".join(passage.split()[30:75]))]
    rows += [(n, f"{sentence(rng, 9)} {passage} {sentence(rng, 9)}") for n in (30, 31, 32)]
    rows += [(40, " ".join([*lines[:2], sentence(rng, 60), *lines, sentence(rng, 30), *lines]))]
    found = {r.doc_id: r.text.lower().split() for r in line_dedup(docs(*rows)).collect()}
    expected = expected_words(rows, 50)
    assert found == expected
    assert len(expected[30]) == 95 and len(expected[31]) == 18 and len(expected[40]) == 22 + 60 + 30


def test_every_run_goes_that_an_earlier_place_has(spark, folder):
    documents = table(spark, folder, "documents")
    given = [(r.doc_id, r.text) for r in documents.collect()]
    assert len({doc_id for doc_id, _ in given}) == len(given)
    for window in (1, 2, 3):
        found = {r.doc_id: r.text.lower().split() for r in line_dedup(documents, window=window).collect()}
        assert found == expected_words(given, 50)


def test_passages_without_whole_lines_go(docs):
    """Passages of one long line, of a line with parts at its ends, and without any break."""
    rng = random.Random(13)
    long_line = sentence(rng, 61)
    parts = f"{sentence(rng, 30)} {sentence(rng, 9)} {sentence(rng, 30)}".split()
    unbroken = " ".join(sentence(rng, 3000).rstrip(".").split())
    rows = [(n, f"{sentence(rng, 15)} {sentence(rng, 8)} {long_line} {sentence(rng, 7)}") for n in range(20)]
    rows += [(100 + n, f"{sentence(rng, 12)[:-1]} {' '.join(parts[10:62])} {sentence(rng, 12)}") for n in range(20)]
    rows += [(200 + n, f"{sentence(rng, 40)[:-1]} {' '.join(unbroken.split()[n * 40 : n * 40 + 400])} {sentence(rng, 5)}") for n in range(20)]
    found = {r.doc_id: r.text.lower().split() for r in line_dedup(docs(*rows)).collect()}
    expected = expected_words(rows, 50)
    assert found == expected
    assert all(len(expected[n]) == 30 for n in range(1, 20)) and all(len(expected[100 + n]) == 24 for n in range(1, 20))


def test_texts_hashed_together_have_their_own_runs():
    """Whatever stands beside a text, its runs, fingerprints and contexts are its own, also with long words and other spaces."""
    rng = random.Random(14)
    words = ["a", "B", "eight888", "nine99999", "é中", "x" * 64, "y" * 65, "z" * 300, "\x00", "\x85", "\x1c"]
    texts = ["".join(rng.choice(words) + rng.choice(" \t\n\x0b\x0c\r") * rng.randint(1, 2) for _ in range(n)) for n in (0, 1, 5, 6, 40, 9, 200)]
    texts = [None, "", " \n", *texts, " ".join(f"Word{n}" for n in range(60_000)), texts[-1].lower()]
    found = {}
    for place, firsts, sums in groups(texts):
        text, gram, context, start, runs = contexts(firsts, sums, 6, 2)
        for n, *values in zip((text + place).tolist(), gram.tolist(), context.tolist(), start.tolist(), runs.tolist()):
            found.setdefault(n, []).append(values)
    for n, text in enumerate(texts):
        size = len((text or "").encode().split())
        ((_, firsts, sums),) = groups([text])
        alone = list(zip(*(values.tolist() for values in contexts(firsts, sums, 6, 2)[1:])))
        assert len(sums) == size + 1 and [tuple(x) for x in found.get(n, [])] == alone
        assert [s + i for _, _, s, r in alone for i in range(r)] == list(range(size - 5))
    assert found[9] == found[11]
    different = words + [w + "\x00" for w in words]
    assert len({prefix_sums([w.encode()])[1][1] for w in different}) == len(different)


def test_least_of_neighbours():
    rng = random.Random(15)
    for _ in range(200):
        window, size = rng.randint(1, 9), rng.randint(9, 60)
        keys = [rng.getrandbits(3) for _ in range(size)]
        expected = [min(range(i, i + window), key=lambda at: (keys[at], -at)) for i in range(size - window + 1)]
        assert least(np.array(keys, np.uint64), window).tolist() == expected
        assert least_grams(np.array(keys, np.uint64) << np.uint64(32), window).tolist() == expected


def test_fingerprints_cost_less_than_hashing_words_one_by_one():
    rng = random.Random(16)
    text = " ".join(sentence(rng, 10) for _ in range(20_000))

    def seconds(work):
        times = []
        for _ in range(3):
            began = time.process_time()
            work()
            times.append(time.process_time() - began)
        return min(times)

    found = seconds(lambda: [contexts(firsts, sums, 50, 2) for _, firsts, sums in groups([text])])
    one_by_one = seconds(lambda: np.fromiter(map(xxh3_64_intdigest, text.encode().lower().split()), np.uint64))
    assert found < one_by_one


def test_deleted_spans_count_code_points():
    text = "\tÉa  b\U0001f600 c\x0bd\n"
    assert without(text, [(1, 2), (3, 4)]) == ("\tÉa  c\x0b", [{"start": 5, "end": 8}, {"start": 10, "end": 12}])
    assert without(text, [(0, 2), (1, 4)]) == ("\t", [{"start": 1, "end": 12}])
