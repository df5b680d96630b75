"""A hidden Markov language model over words.

A text is its words and one end token. Each latent state emits symbols: the most frequent words and the end token have a
symbol of their own, all other words share symbols by their last letters. P(text) is the likelihood of the symbols, from
the scaled forward recursion over the whole text, times P(word | symbol) for each word, from add-half counts; so it is a
proper distribution over texts of known words and one unknown word per class. Baum-Welch trains transitions and emissions:
each task sums the expected counts of its own texts, Spark adds them up, and the driver only holds the model, whose size
is fixed by `states`, `own_symbols` and CLASSES.

Word counts grow with the corpus, so they stay in Spark. Texts are cut into chunks of whole documents, each with a list of
its distinct words; these lists, not the tokens, are summed into the vocabulary, joined with it and brought back to their
chunk. Words and chunks are stored tables that all later passes read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .shared import arrow_schema, in_fold, out_of_fold, record_batches

CLASSES = 512
CHUNK_TOKENS = 2_000_000
SEGMENT = 256
END = b" end"  # no word holds a space
DOCUMENT = "struct<doc_id: {kind}, learn: boolean, held_out: boolean, tokens: int>"


def word_class(word: bytes) -> int:
    from xxhash import xxh3_64_intdigest as digest

    return digest(word.rstrip(b".,;:!?")[-3:]) % CLASSES


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers, compressed byte plane by byte plane: their high bytes are nearly all alike."""
    import zstandard

    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 3)


def unpacked(content: bytes, kind: str) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(content), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def chunks(documents: DataFrame) -> DataFrame:
    """(chunk, docs, codes, words, counts, classes) of documents (doc_id, learn, held_out, text).

    codes: for each token of the chunk's texts the number of its word in `words` (hashes); counts: how often each word
    occurs in the texts to learn from. A chunk holds whole texts, up to CHUNK_TOKENS tokens or one text.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"chunk long, docs array<{DOCUMENT.format(kind=kind)}>, codes binary, words array<long>, counts array<int>, classes array<int>"
    kinds = arrow_schema(documents.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        number = TaskContext.get().partitionId() << 32
        local: dict[bytes, int] = {END: 0}
        docs, codes, size = [], [], 0

        def finish():
            nonlocal local, docs, codes, size, number
            learned = [c for c, d in zip(codes, docs) if d["learn"]]
            counts = np.bincount(np.concatenate([*learned, np.zeros(0, np.int32)]), minlength=len(local))
            row = {
                "chunk": [number],
                "docs": [docs],
                "codes": [packed(np.concatenate(codes).astype("<u4"))],
                "words": [[digest(w) - (1 << 63) for w in local]],
                "counts": [counts],
                "classes": [[word_class(w) for w in local]],
            }
            local, docs, codes, size, number = {END: 0}, [], [], 0, number + 1
            return record_batches(row, kinds)

        for batch in batches:
            for doc_id, learn, held_out, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                if docs and size + len(words) >= CHUNK_TOKENS:
                    yield from finish()
                for word in words:
                    if word not in local:
                        local[word] = len(local)
                codes.append(np.fromiter((local[w] for w in (*words, END)), np.int32, len(words) + 1))
                docs.append({"doc_id": doc_id, "learn": learn, "held_out": held_out, "tokens": len(words) + 1})
                size += len(words) + 1
        if docs:
            yield from finish()

    return documents.select("doc_id", "learn", "held_out", "text").mapInArrow(run, schema)


@dataclass
class Symbols:
    """The symbols of a vocabulary, and what the base and class probabilities need."""

    own: dict[int, int]  # hash -> symbol
    count: np.ndarray  # learned tokens of each symbol
    distinct: np.ndarray  # words of each symbol
    tokens: int
    words: int

    def __len__(self) -> int:
        return len(self.own) + CLASSES


def symbols(vocabulary: DataFrame, own_symbols: int) -> Symbols:
    """At most `own_symbols` words and CLASSES totals reach the driver, whatever the vocabulary."""
    from xxhash import xxh3_64_intdigest as digest

    end = digest(END) - (1 << 63)
    total = vocabulary.agg(F.sum("count").alias("tokens"), F.count(F.lit(1)).alias("words")).first()
    first = vocabulary.orderBy((F.col("word") == end).desc(), F.desc("count"), "word").limit(own_symbols).collect()
    own = {row["word"]: i for i, row in enumerate(first)}
    own.setdefault(end, len(own))
    count, distinct = np.zeros(len(own) + CLASSES), np.ones(len(own) + CLASSES)
    for row in first:
        count[own[row["word"]]] = row["count"]
    chosen = vocabulary.sparkSession.createDataFrame([(w,) for w in own], "word long")
    for row in vocabulary.join(F.broadcast(chosen), "word", "left_anti").groupBy("class").agg(
        F.sum("count").alias("count"), F.count(F.lit(1)).alias("words")
    ).collect():
        count[len(own) + row["class"]], distinct[len(own) + row["class"]] = row["count"], row["words"]
    distinct[len(own) :][count[len(own) :] == 0] = 0
    return Symbols(own, count, distinct, int(total["tokens"] or 0), int(total["words"]))


def sequences(parts: DataFrame, vocabulary: DataFrame, found: Symbols) -> DataFrame:
    """(chunk, docs, symbols): docs with the base columns of each text and log10 P(word | symbol), summed."""
    document = parts.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    schema = (
        f"chunk long, docs array<struct<doc_id: {document}, learn: boolean, held_out: boolean, tokens: int, known: int, "
        "base: double, within: double>>, symbols binary"
    )
    kinds = arrow_schema(parts.sparkSession, schema)
    words = parts.select(F.col("chunk").alias("of_chunk"), F.posexplode("words").alias("number", "word"))
    known = words.join(vocabulary.select("word", "count"), "word").select("of_chunk", "number", "count")
    shared = parts.sparkSession.sparkContext.broadcast(tuple(vars(found).values()))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model = Symbols(*shared.value)
        rows: dict[str, list] = {"chunk": [], "docs": [], "symbols": []}
        for chunk, docs, codes, hashes, classes in zip(*(left.column(c).to_pylist() for c in ("chunk", "docs", "codes", "words", "classes"))):
            count = np.zeros(len(hashes), np.int64)
            count[right.column("number").to_numpy()] = right.column("count").to_numpy()
            symbol = len(model.own) + np.array(classes)
            for number, word in enumerate(hashes):
                if word in model.own:
                    symbol[number] = model.own[word]
            base = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
            shared_by = model.count[symbol] + 0.5 * (model.distinct[symbol] + 1)
            within = np.where(symbol < len(model.own), 0.0, np.log10((count + 0.5) / shared_by))
            codes = unpacked(codes, "<u4")
            starts = np.cumsum([0, *(d["tokens"] for d in docs)])[:-1]
            totals = [np.add.reduceat(x[codes], starts) for x in ((count > 0).astype(np.int64), base, within)]
            rows["chunk"].append(chunk)
            rows["docs"].append([{**d, "known": int(k), "base": float(b), "within": float(w)} for d, k, b, w in zip(docs, *totals)])
            rows["symbols"].append(packed(symbol[codes].astype("<u2")))
        return pa.table(rows, schema=kinds)

    return parts.groupBy("chunk").cogroup(known.groupBy("of_chunk")).applyInArrow(run, schema)


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols x states


def first_model(found: Symbols, states: int, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    share = (found.count + 0.5)[:, None] * rng.gamma(1.0, 1.0, (len(found), states))
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, share / share.sum(axis=0))


def _ragged(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces, longest first, as a table (step, piece), the number of pieces still going on at each step, and the order."""
    lengths = np.array([len(p) for p in pieces])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    table = np.zeros((lengths[0], len(pieces)), np.int32)
    for column, i in enumerate(order):
        table[: lengths[column], column] = pieces[i]
    going = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    return table, going, order


def forward(model: Model, pieces: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each symbol sequence, by the scaled recursion over all of its symbols."""
    result = np.zeros(len(pieces))
    block, size = [], 0
    emit, move = model.emit.astype(np.float32), model.move.astype(np.float32)
    for i in np.argsort([-len(p) for p in pieces], kind="stable").tolist() + [None]:
        if i is None or block and size + len(pieces[block[0]]) > 4_000_000:
            if block:
                table, going, order = _ragged([pieces[b] for b in block])
                scale = np.zeros(len(block))
                a = model.start.astype(np.float32) * emit[table[0]]
                for step, n in enumerate(going):
                    if step:
                        a = (a[:n] @ move) * emit[table[step, :n]]
                    total = a.sum(axis=1)
                    a /= total[:, None]
                    scale[:n] += np.log10(total)
                result[np.array(block)[order]] = scale
            block, size = [], 0
        if i is not None:
            block.append(i)
            size += len(pieces[block[0]])
    return result


def expected_counts(model: Model, pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions (symbols x states), and the log10 likelihood, of symbol sequences."""
    states = len(model.start)
    starts, moves, emits, likelihood = np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.shape), 0.0
    emit, move = model.emit.astype(np.float32), model.move.astype(np.float32)
    for at in range(0, len(pieces), 2000):
        table, going, _ = _ragged(pieces[at : at + 2000])
        alphas, scales, emitted = [], [], []
        for step, n in enumerate(going):
            e = emit[table[step, :n]]
            a = (model.start.astype(np.float32) if not step else alphas[-1][:n] @ move) * e
            total = a.sum(axis=1, keepdims=True)
            alphas.append(a / total)
            scales.append(total)
            emitted.append(e)
            likelihood += float(np.log10(total).sum())
        beta = np.ones_like(alphas[-1])
        gammas = [None] * len(going)
        gammas[-1] = alphas[-1]
        for step in range(len(going) - 2, -1, -1):
            n, after = going[step], going[step + 1]
            seen = emitted[step + 1] * beta / scales[step + 1]
            moves += alphas[step][:after].T @ seen
            beta = np.ones((n, states), np.float32)
            beta[:after] = seen @ move.T
            gammas[step] = alphas[step] * beta
        starts += gammas[0].sum(axis=0)
        flat = np.concatenate([table[step, :n] for step, n in enumerate(going)])
        gamma = np.concatenate(gammas)
        for k in range(states):
            emits[:, k] += np.bincount(flat, gamma[:, k], len(emits))
    return starts, moves * model.move, emits, likelihood


def _texts(docs: list[dict], symbols: bytes) -> list[np.ndarray]:
    codes = unpacked(symbols, "<u2")
    return np.split(codes, np.cumsum([d["tokens"] for d in docs])[:-1])


def baum_welch(texts: DataFrame, model: Model, found: Symbols) -> tuple[Model, float]:
    """One step over all texts to learn from, cut into segments of SEGMENT symbols that each start afresh."""
    states, size = len(model.start), len(found)
    shared = texts.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))
    schema = "cell long, value double"
    kinds = arrow_schema(texts.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(states + states * states + size * states + 1)
        for batch in batches:
            for docs, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                learned = [t for d, t in zip(docs, _texts(docs, codes)) if d["learn"]]
                pieces = [t[i : i + SEGMENT] for t in learned for i in range(0, len(t), SEGMENT)]
                if pieces:
                    a, b, c, d = expected_counts(Model(*shared.value), sorted(pieces, key=len, reverse=True))
                    total += np.concatenate([a, b.ravel(), c.ravel(), [d]])
        cells = np.flatnonzero(total)
        yield from record_batches({"cell": cells, "value": total[cells]}, kinds)

    summed = texts.select("docs", "symbols").mapInArrow(run, schema).groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros(states + states * states + size * states + 1)
    total[summed["cell"].to_numpy("int64")] = summed["value"].to_numpy()
    starts, moves, emits = np.split(total[:-1], [states, states + states * states])
    starts, moves = starts + 0.1, moves.reshape(states, states) + 0.1
    prior = (found.count + 0.5) / (found.count + 0.5).sum()
    emits = emits.reshape(size, states) + prior[:, None]
    return Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0)), float(total[-1])


def hidden_markov_scores(
    documents: DataFrame, parts: int = 5, part: int = 1, states: int = 8, own_symbols: int = 2000, steps: int = 8
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of `documents` (doc_id, text).

    Learned from the rows whose crc32 of the id modulo `parts` is not `part`; those are held out. base_score: log10
    probability of the add-half unigram model; score: of the hidden Markov model. A null text is empty: the end token
    alone. Rows without an id are neither learned from nor held out. Rows that repeat count as often as they occur.
    With nothing to learn from, each probability is that of an untrained model.
    """
    rows = documents.select(
        "doc_id", out_of_fold(F.col("doc_id"), parts, part).alias("learn"), in_fold(F.col("doc_id"), parts, part).alias("held_out"), "text"
    )
    made = store(chunks(rows), "chunks")
    listed = made.select(F.explode(F.arrays_zip("words", "counts", "classes")).alias("w")).select("w.*").filter("counts > 0")
    vocabulary = listed.groupBy(F.col("words").alias("word")).agg(F.sum("counts").alias("count"), F.first("classes").alias("class"))
    vocabulary = store(vocabulary, "vocabulary")
    found = symbols(vocabulary, own_symbols)
    texts = store(sequences(made, vocabulary, found), "symbols")
    model = first_model(found, states)
    for _ in range(steps):
        model, _ = baum_welch(texts, model, found)
    shared = documents.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))
    kind = documents.schema["doc_id"].dataType.simpleString()
    tokens = found.tokens
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    kinds = arrow_schema(documents.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                likelihood = forward(Model(*shared.value), _texts(docs, codes))
                columns = {
                    "doc_id": [d["doc_id"] for d in docs],
                    "held_out": [d["held_out"] for d in docs],
                    "n_tokens": [d["tokens"] for d in docs],
                    "n_known": [d["known"] for d in docs],
                    "train_tokens": [tokens] * len(docs),
                    "base_score": [d["base"] for d in docs],
                    "score": likelihood + np.array([d["within"] for d in docs]),
                }
                yield from record_batches(columns, kinds)

    return texts.select("docs", "symbols").mapInArrow(run, schema)
