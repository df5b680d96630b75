import random
import zlib

from pyspark.sql import functions as F

from skewloom.llm.language import classify, dictionaries, language_id, spread
from skewloom.llm.shared import table

from .conftest import ODD


def test_held_out_accuracy(spark, folder):
    documents = table(spark, folder, "documents")
    found = language_id(documents).join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    assert [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id] == found.held_out.tolist()
    held = found[found.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.95
    assert found.score.between(0, 1).all()


def made(rng, syllables, n):
    return " ".join("".join(rng.choices(syllables, k=3)) for _ in range(n))


def test_odd_rows(docs):
    rng = random.Random(1)
    taught = [(100 + n, made(rng, ["ba", "do", "ki"], 60), "aa", "s") for n in range(30)]
    taught += [(200 + n, made(rng, ["sch", "lü", "eng"], 60), "bb", "s") for n in range(30)]
    taught += [(300, "no language", None, "s"), (301, "12 34", "cc", "s")]
    rows = language_id(docs(*taught, *((i, t, None, None) for i, t in ODD))).collect()
    assert len(rows) == len(taught) + len(ODD)
    for row in rows:
        if row.doc_id in (1, 2, 3, 9, 301):
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
        else:
            assert row.lang_pred in ("aa", "bb")
        if row.doc_id is not None and 100 <= row.doc_id < 300:
            assert row.lang_pred == ("aa" if row.doc_id < 200 else "bb") and not row.rejected
    (null,) = [r for r in rows if r.doc_id is None]
    assert null.held_out is False
    first, second = [r for r in rows if r.doc_id == 5]
    assert first == second


def test_copies_count_once_in_a_dictionary(docs):
    rows = [(n, "copy of one text", "aa", "s") for n in range(500)] + [(1000 + n, f"other{chr(97 + n)} text", "aa", "s") for n in range(9)]
    content = dictionaries(docs(*rows), texts=10)["aa"]
    assert content.count(b"copy") == 1 and all(f"other{chr(97 + n)}".encode() in content for n in range(9))


def test_ties_take_the_first_language_and_are_rejected(docs):
    same = b"alpha beta gamma delta"
    row = classify(docs((1, "alpha beta"), extra=False).select("doc_id", "text"), {"b": same, "a": same}).first()
    assert (row.lang_pred, row.rejected, row.score) == ("a", True, 0.5)


def test_nothing_learned(docs, spark):
    row = language_id(docs((1, "word", None, None))).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert language_id(docs((1, "x")).filter(F.lit(False))).count() == 0


def test_columns_with_the_names_of_results_are_replaced(docs):
    frame = docs((1, "some words")).selectExpr("doc_id", "text", "'x' AS score", "'y' AS lang_pred", "'z' AS rejected", "'kept' AS other")
    row = classify(frame, {"en": b"some words of english", "de": b"einige deutsche"}).first()
    assert (row.other, row.lang_pred) == ("kept", "en") and 0 <= row.score <= 1


def test_sizes_are_those_of_the_plain_interface(docs):
    """The smallest of zstandard's own encodings wins, with all words in one piece."""
    import zstandard

    from skewloom.llm.language import TAIL, letters

    learned = {"a": b"lorem ipsum dolor sit amet " * 20, "b": b"the quick brown fox jumps " * 20, "c": b"der schnelle braune fuchs " * 20}
    texts = ["Lorem dolor quick", "quick fox, brown!", "schnelle fuchs ipsum der", "nothing alike at all", "der the sit"]
    for row in classify(docs(*enumerate(texts)), learned).collect():
        sizes = []
        for name in sorted(learned):
            content = zstandard.ZstdCompressionDict(learned[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            parameters = zstandard.ZstdCompressionParameters.from_level(
                6, source_size=4096, dict_size=len(learned[name]), min_match=4, write_content_size=False, write_dict_id=False
            )
            encoder = zstandard.ZstdCompressor(compression_params=parameters, dict_data=content)
            sizes.append((len(encoder.compress(letters(texts[row.doc_id]) + TAIL)), name))
        assert row.lang_pred == min(sizes)[1]


def test_the_end_of_a_long_text_teaches_too(docs):
    text = "the head of it " * 20_000 + " ".join(f"{a}{b}ende" for a in "bcdfg" for b in "aeiou") * 400
    found = dictionaries(docs((1, text, "de", "s"), (2, "x", "fr", "s")))
    assert b"ende" in found["de"] and b"head" in found["de"] and len(found["de"]) <= 64 * 1024 and found["fr"] == b"x "
    words = [b"%05d" % n for n in range(4000)]
    taken = spread(words, 1200).split()
    assert taken[0] == words[0] and taken[-1] > b"03900" and 150 < len(taken) <= 200
