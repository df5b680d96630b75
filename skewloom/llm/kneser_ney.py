"""Text quality by an interpolated modified Kneser-Ney model of character n-grams.

For each language the n-grams of trusted texts are counted, and continuation counts give the lower orders. Discounts for
counts of one, two and more come from the counts of counts of each language and order. Counts, contexts and the n-grams
that occur anywhere are tables keyed by language and n-gram; joins on these keys, so sharded by n-gram, give every n-gram
its probability. A document's perplexity is then the geometric mean of its n-grams' inverse probabilities, and a document
is kept if it is at most the quantile that trusted documents of its language have.

The symbols are the 16-bit units of UTF-16, so every character of every script is told from all others (those beyond U+FFFF
by two units) and an n-gram of four is a 64-bit number. The tables of n-grams have no bound then. The most widespread
n-grams, SENT at most, are sent to all tasks with their probabilities; a text's other n-grams are joined with theirs. Joining
every single position of the corpus instead would shuffle many times the text.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .shared import map_batches, narrowed

ORDER = 4
BITS = 16
SENT = 1 << 20
NO_LANGUAGE = "und"


def alphabet() -> np.ndarray:
    """Symbol of each UTF-16 unit: the unit itself. 0 is the start, so U+0000 counts as U+FFFD, the replacement character."""
    table = np.arange(1 << BITS, dtype=np.uint16)
    table[0] = 0xFFFD
    return table


def plain(text: str) -> str:
    """The text in lower case with white space collapsed."""
    return " ".join(text.lower().split())


def gram_codes(text: str, table: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each symbol of the plain text."""
    units = np.frombuffer(plain(text).encode("utf-16-le", "surrogatepass"), "<u2")
    symbols = np.concatenate([np.zeros(ORDER - 1, np.uint64), table[units].astype(np.uint64)])
    n = len(units)
    codes = symbols[:n]
    for i in range(1, ORDER):
        codes = (codes << np.uint64(BITS)) | symbols[i : i + n]
    return codes


def last_symbols(gram: str, order: int) -> Column:
    """The n-gram of the last `order` symbols."""
    return F.col(gram) if order == ORDER else F.col(gram).bitwiseAND((1 << (BITS * order)) - 1)


def by_language(batch: pa.RecordBatch) -> dict[str, list[int]]:
    found: dict[str, list[int]] = {}
    for row, language in enumerate(batch.column(0).to_pylist()):
        found.setdefault(language, []).append(row)
    return found


def gram_counts(texts: DataFrame, counted: bool) -> DataFrame:
    """(lang, gram, count) of texts (lang, text), summed within each batch; without counts, the number of batches that hold it."""

    def run(batch: pa.RecordBatch) -> dict:
        table, values = alphabet(), batch.column(1).to_pylist()
        languages, grams, counts = [], [], []
        for language, rows in by_language(batch).items():
            found, count = np.unique(np.concatenate([gram_codes(values[row], table) for row in rows]), return_counts=True)
            languages += [language] * len(found)
            grams.append(found.view(np.int64))
            counts.append(count if counted else np.ones(len(found), np.int64))
        return {"lang": languages, "gram": np.concatenate(grams), "count": np.concatenate(counts)}

    return map_batches(texts.select("lang", "text"), run, "lang string, gram long, count long").groupBy("lang", "gram").agg(
        F.sum("count").alias("count")
    )


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) from the counts of counts; the usual values where some of these are missing."""
    n = [F.sum((F.col("count") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(k: int):
        value = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        bounded = F.greatest(F.lit(0.1), F.least(value, F.lit(k - 0.1)))
        return F.when(value.isNotNull(), bounded).otherwise(F.lit(k * 0.5)).alias(f"d{k}")

    rows = counts.groupBy("lang").agg(*n)
    safe = rows.select("lang", *(F.when(F.col(f"n{k}") > 0, F.col(f"n{k}")).alias(f"n{k}") for k in (1, 2, 3, 4)))
    return safe.select("lang", *(discount(k) for k in (1, 2, 3)))


def probabilities(trusted: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lang, gram, p) for each `wanted` (lang, gram) of a language that `trusted` (lang, gram, count) has."""
    tables = [trusted]
    for order in range(ORDER - 1, 0, -1):
        suffix = last_symbols("gram", order)
        tables.append(store(tables[-1].groupBy("lang", suffix.alias("gram")).agg(F.count(F.lit(1)).alias("count")), "continuations"))
    lower = None
    for order, counts in enumerate(reversed(tables), 1):
        found = discounts(counts)
        amount = F.when(F.col("count") >= 3, F.col("d3")).when(F.col("count") == 2, F.col("d2")).when(F.col("count") == 1, F.col("d1"))
        spared = counts.join(F.broadcast(found), "lang").withColumn("held", amount)  # a row for each language
        context = spared.groupBy("lang", F.shiftrightunsigned("gram", BITS).alias("context")).agg(
            F.sum("count").alias("total"), (F.sum("held") / F.sum("count")).alias("rest")
        )
        mine = spared.select("lang", "gram", (F.col("count") - F.col("held")).alias("kept"))
        suffix = last_symbols("gram", order)
        asked = wanted.select("lang", suffix.alias("gram")).distinct().withColumn("context", F.shiftrightunsigned("gram", BITS))
        rows = asked.join(mine, ["lang", "gram"], "left").join(context, ["lang", "context"], "left")
        if lower is None:
            rows = rows.filter(F.col("total").isNotNull()).withColumn("below", F.lit(1.0 / (1 << BITS)))
        else:
            rows = rows.withColumn("shorter", last_symbols("gram", order - 1))
            below = lower.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("below"))
            rows = rows.join(below, ["lang", "shorter"])
        p = F.coalesce(F.col("kept") / F.col("total"), F.lit(0.0)) + F.coalesce("rest", F.lit(1.0)) * F.col("below")
        lower = store(rows.select("lang", "gram", p.alias("p")), "probabilities")
    return lower


def widespread(wanted: DataFrame, most: int) -> DataFrame:
    """The n-grams of `wanted` (lang, gram, count) with the highest counts, at most `most`: all above one count."""
    sizes = wanted.groupBy("count").agg(F.count(F.lit(1)).alias("grams"))  # a row for each number of batches at most
    least, total = None, 0
    for row in sorted(sizes.collect(), key=lambda r: -r["count"]):
        total += row["grams"]
        if total > most:
            break
        least = row["count"]
    return wanted.filter(F.col("count") >= least if least is not None else F.lit(False)).select("lang", "gram")


def perplexities(documents: DataFrame, model: DataFrame, wanted: DataFrame, sent: int = SENT) -> DataFrame:
    """lang, doc_id, n_chars, perplexity of each row of documents (doc_id, lang, text).

    perplexity is null for an empty text and where the model does not know the language. At most `sent` n-grams go to all tasks.
    """
    model = model.withColumn("p", F.log10("p"))
    rows = model.join(widespread(wanted, sent), ["lang", "gram"], "left_semi").orderBy("lang", "gram").toArrow()
    learned = {row["lang"]: (np.empty(0, np.int64), np.empty(0)) for row in model.select("lang").distinct().collect()}
    of_row = rows.column("lang").combine_chunks().dictionary_encode()
    numbers = of_row.indices.to_numpy(zero_copy_only=False)
    for number, language in enumerate(of_row.dictionary.to_pylist()):
        learned[language] = tuple(rows.column(c).to_numpy()[numbers == number] for c in ("gram", "p"))
    shared = documents.sparkSession.sparkContext.broadcast(learned)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        table, texts = alphabet(), batch.column(1).to_pylist()
        found = {"lang": batch.column(0), "doc_id": batch.column(2), "row": [], "n_chars": [], "symbols": [], "logs": [], "grams": [], "counts": []}
        for language, text in zip(batch.column(0).to_pylist(), texts):
            codes, logs, others = gram_codes(text, table).view(np.int64), None, np.empty(0, np.int64)
            if len(codes) and language in shared.value:
                grams, p = shared.value[language]
                at = np.searchsorted(grams, codes)
                known = grams[np.minimum(at, len(grams) - 1)] == codes if len(grams) else np.zeros(len(codes), bool)
                logs, others = float(p[at[known]].sum()), codes[~known]
            others, counts = np.unique(others, return_counts=True)
            cells = (uuid.uuid4().hex if len(others) else None, len(plain(text)), len(codes), logs, others, counts)
            for name, cell in zip(("row", "n_chars", "symbols", "logs", "grams", "counts"), cells):
                found[name].append(cell)
        return found

    schema = f"lang string, doc_id {kind}, row string, n_chars long, symbols long, logs double, grams array<long>, counts array<long>"
    scored = store(map_batches(documents.select("lang", "text", "doc_id"), run, schema, rows=2_000), "scored")
    others = scored.select("row", "lang", F.inline(F.arrays_zip("grams", "counts"))).withColumnRenamed("grams", "gram")
    rest = others.join(model, ["lang", "gram"]).groupBy("row").agg(F.sum(F.col("counts") * F.col("p")).alias("rest"))
    logs = F.col("logs") + F.coalesce("rest", F.lit(0.0))
    perplexity = F.pow(F.lit(10.0), -logs / F.col("symbols")).alias("perplexity")
    return scored.drop("grams", "counts").join(rest, "row", "left").select("lang", "doc_id", "n_chars", perplexity)


def kneser_ney_quality(documents: DataFrame, labels: DataFrame, quantile: float = 0.99, slack: float = 1.1, sent: int = SENT) -> DataFrame:
    """doc_id, lang, n_chars, perplexity, threshold, kept of each row of `documents` (doc_id, text, lang).

    Trusted are the documents with a label of quality 1 and none of 0. threshold: `slack` times the `quantile` of the
    perplexities of the language's trusted documents. kept: perplexity at most threshold; also where there is none, as
    for an empty text or a language without trusted text. A null language is the language "und"; a null text is empty.
    Rows that repeat have equal results, and count as often as they occur.
    """
    good = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    good = store(good.select("doc_id", F.xxhash64("doc_id").alias("key")), "trusted")
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"))
    near = narrowed(rows, F.xxhash64("doc_id"), good, "key")
    trusted = store(gram_counts(near.join(good.hint("merge"), "doc_id"), counted=True), "gram-counts")
    wanted = store(gram_counts(rows, counted=False), "grams")
    model = probabilities(trusted, wanted)
    scored = store(perplexities(rows, model, wanted, sent), "perplexities")
    limit = (F.percentile_approx("perplexity", quantile, 10_000) * slack).alias("threshold")
    limits = scored.join(good.select("doc_id"), "doc_id", "left_semi").groupBy("lang").agg(limit)
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept")
    joined = scored.join(F.broadcast(limits), "lang", "left")  # a row for each language
    return joined.select("doc_id", "lang", "n_chars", "perplexity", "threshold", kept)
