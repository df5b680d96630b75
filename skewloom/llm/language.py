"""Language identification by compression.

For each language a zstandard dictionary of raw content is made from texts of that language. A text is encoded with
every dictionary, and the language whose encoding is smallest wins: its dictionary had most of the text's letter
sequences already. If the next smallest is too close, the row is marked as rejected.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import in_fold, map_batches, out_of_fold

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
HAS_LETTER = r"\p{L}"
CHUNK_BYTES = 4096
PARTS = 64
TAIL = b"\n" * 64  # so compressible that zstandard encodes even a short text by matches instead of storing it


def letters(text: str) -> bytes:
    """The distinct words of a text in order, as lower-case letters: a repeated word would only match itself."""
    return " ".join(dict.fromkeys(LETTERS.findall(text.lower()))).encode()


def spread(words: list[bytes], size: int) -> bytes:
    """Words from all over a text, at even distances, of about `size` bytes in all."""
    total = sum(map(len, words)) + len(words)
    step = max(1.0, total / size)
    return b" ".join(words[int(n * step)] for n in range(int(len(words) / step)))


def dictionaries(
    labelled: DataFrame, texts: int = 64, size: int = 64 * 1024, text_bytes: int = CHUNK_BYTES, pieces: int = 16
) -> dict[str, bytes]:
    """A raw-content dictionary of at most `size` bytes for each non-null lang of `labelled` (text, lang).

    The sample: of each language, the `texts` distinct texts with the smallest hash, so that copies count once. Only
    hashes are ranked, and the few chosen texts are then read. A text longer than `size` characters gives `pieces` pieces
    of equal length and distance, `size` characters in all, and of its words those at even distances, about `text_bytes`
    of them: its end teaches as much as its beginning. Rows without a letter or language teach nothing.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(HAS_LETTER))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("hash"))
    hashes = rows.select("lang", "hash").distinct().withColumn("part", F.pmod("hash", F.lit(PARTS)))
    chosen = hashes
    for keys in (["lang", "part"], ["lang"]):  # the smallest of the smallest of each part
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("hash"))
        chosen = chosen.withColumn("rank", rank).filter(F.col("rank") <= texts).drop("rank")
    chosen = chosen.drop("part")
    # At most `texts` short rows for each language, whatever the input.
    sample = rows.join(F.broadcast(chosen), ["lang", "hash"]).dropDuplicates(["lang", "hash"])
    length, piece = F.length("text"), size // pieces
    starts = [(length * n / pieces).cast("int") + 1 for n in range(pieces)]
    some = F.concat_ws(" ", *[F.substring(F.col("text"), start, F.lit(piece)) for start in starts])
    cut = sample.select("lang", "hash", F.when(length <= size, F.col("text")).otherwise(some).alias("text"))
    found: dict[str, bytes] = {}
    for row in sorted(cut.toLocalIterator(), key=lambda r: (r["lang"], r["hash"])):
        kept = found.get(row["lang"], b"")
        if len(kept) < size:
            found[row["lang"]] = (kept + spread(letters(row["text"]).split(), text_bytes) + b" ")[:size]
    return found


def classify(documents: DataFrame, learned: dict[str, bytes], level: int = 6, margin: float = 0.01) -> DataFrame:
    """`documents` (text and any other columns but text are kept as they are) with lang_pred, score and rejected.

    lang_pred: the language of the smallest encoding; the first in alphabetical order among equals; "und" if the text
    is null or has no letter, or nothing was learned. score: the share of the winner when each language weighs
    2^-(its bytes / 2); 0 for "und". rejected: the second smallest encoding is within `margin` of the smallest, or
    "und". Whole texts are encoded, in pieces of 4 KB each of which meets the whole dictionary. Columns of these names
    are replaced.
    """
    names = sorted(learned)
    kept = [c for c in documents.columns if c not in ("text", "lang_pred", "score", "rejected")]
    schema = ", ".join(
        [f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in kept]
        + ["lang_pred string", "score double", "rejected boolean"]
    )

    def run(batch: pa.RecordBatch, encoders: list) -> dict:
        languages, scores, rejected = [], [], []
        for text in batch.column(len(kept)).to_pylist():
            content = letters(text) if text else b""
            if not content or not encoders:
                languages.append(UNKNOWN)
                scores.append(0.0)
                rejected.append(True)
                continue
            sizes = [0] * len(encoders)
            for at in range(0, len(content), CHUNK_BYTES):
                piece = content[at : at + CHUNK_BYTES] + TAIL
                sizes = [size + len(encode(piece)) for size, encode in zip(sizes, encoders)]
            least = min(sizes)
            best = sizes.index(least)
            others = sizes[:best] + sizes[best + 1 :]
            languages.append(names[best])
            scores.append(1 / sum(2.0 ** max(-60.0, (least - size) / 2) for size in sizes))
            rejected.append(bool(others) and min(others) <= least * (1 + margin))
        columns = {c: batch.column(i) for i, c in enumerate(kept)}
        return {**columns, "lang_pred": languages, "score": scores, "rejected": rejected}

    return map_batches(documents.select(*kept, "text"), run, schema, setup=lambda: _encoders([learned[name] for name in names], level))


def _encoders(contents: list[bytes], level: int) -> list:
    import zstandard

    made = []
    for content in contents:
        parameters = zstandard.ZstdCompressionParameters.from_level(
            level, source_size=CHUNK_BYTES, dict_size=len(content), min_match=4,
            write_content_size=False, write_dict_id=False, write_checksum=False,
        )
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=parameters)
        made.append(zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary).compress)
    return made


def language_id(documents: DataFrame, parts: int = 3, part: int = 1, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of each row; learned from the rows that are not held out.

    held_out: crc32 of the id modulo `parts` is `part`. Rows without an id are neither learned from nor held out.
    """
    learned = dictionaries(documents.filter(out_of_fold(F.col("doc_id"), parts, part)))
    rows = documents.select("doc_id", in_fold(F.col("doc_id"), parts, part).alias("held_out"), "text")
    return classify(rows, learned, **options)
