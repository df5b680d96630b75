import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from skewloom.llm.rules import clean_lines, quality_rules, repeated_words, text_statistics
from skewloom.llm.shared import table

from .conftest import ODD

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    """The base columns by their definition."""
    text = text or ""
    words = WORD.findall(text)
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        duplicates += line in seen and bool(WORD.search(line))
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered)


def test_base_columns(spark, folder):
    documents = table(spark, folder, "documents")
    rows = quality_rules(documents).join(documents.select("doc_id", "text"), "doc_id").collect()
    for r in rows:
        expected = plain(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (r.kept and r.base_failed)


def test_base_columns_of_odd_texts():
    for _, text in ODD:
        assert text_statistics(text)[:5] == plain(text)
    assert repeated_words("a a a a".split()) == 4 and repeated_words("a b c x a b c".split()) == 6 and repeated_words(["a"]) == 0


def test_rows_whose_columns_change_places(docs):
    """A null text does not take the counts of a row whose text is the other's source."""
    found = {r.text: r.n_words for r in clean_lines(docs((1, None, "en", "x y z"), (1, "x y z", "en", None))).collect()}
    assert found == {None: 0, "x y z": 3}


def test_line_frequency_against_brute_force(spark, docs):
    boiler = " ".join(f"boiler{n}" for n in range(60))
    rows = [(n, f"{boiler.upper() if n % 2 else boiler}\nown {n} words", "en", "hot" if n % 3 else "cold") for n in range(90)]
    rows += [(100 + n, " ".join(f"w{n}x{k}" for k in range(60)) + "\n" + boiler, "en", "hot") for n in range(9)]
    rows += [(200, boiler, "en", "rare"), (300, boiler, "en", None)]
    found = {r.doc_id: r for r in quality_rules(docs(*rows), line_documents=10).collect()}
    holders = defaultdict(set)
    for doc_id, text, _, host in rows:
        for line in set(text.lower().split("\n")):
            holders[host, re.sub("[1-9]", "0", line)].add(doc_id)
    for doc_id, text, _, host in rows:
        removed = sum(len(x.split()) for x in text.split("\n") if len(holders[host, re.sub("[1-9]", "0", x.lower())]) > 10)
        left = len(text.split()) - removed
        depleted = removed and (left < 20 or left < 0.3 * len(text.split()))
        assert (found[doc_id].removed_words, found[doc_id].kept) == (removed, not depleted)
    assert found[200].kept and found[300].kept and not found[1].kept and found[100].kept


def test_odd_rows(docs):
    rows = quality_rules(docs(*ODD)).collect()
    assert len(rows) == len(ODD)
    assert all(r.base_failed and not r.kept for r in rows)
    assert quality_rules(docs((1, "x")).filter(F.lit(False))).count() == 0


def test_frequent_lines_are_removed_from_the_text(docs):
    own = {n: " ".join(f"own{n}x{k}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(60)) for n in range(30)}
    rows = [(n, f"Share this 1 page\n{own[n]}\n\nshare  THIS 2 page\nend of {own[n]}") for n in range(30)]
    repeated = "\n".join(f"{own[0]} again {word}" for word in ("one", "two"))
    rows += [(500, repeated)] * 40
    found = clean_lines(docs(*rows), line_share=0.0).collect()
    assert len(found) == 70
    for r in found:
        if r.doc_id == 500:
            assert (r.text, r.removed_words) == (repeated, 0)
        else:
            assert (r.text, r.removed_words, r.kept) == (f"{own[r.doc_id]}\n\nend of {own[r.doc_id]}", 8, False if r.base_failed else True)
