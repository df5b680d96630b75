"""Packing documents into fixed windows by the sum-of-squares rule.

A document is its token ids and one end id. Whole windows are cut off its front; what is left, less than a window, is
placed online: into an open window of that fill level for which the sum over all levels of (number of open windows at
this level) squared becomes least. The level array holds, for each fill level, the open windows with that fill. A full
window leaves the array. Only some windows may be open, one and one more for every PIECES_PER_OPEN pieces, up to `max_open`;
while that many are, a piece may also fill up a window that is too full for it, and its end opens another, if that makes the
sum least. When a task ends, the few open windows are settled: windows filled to a power of two need no padding and stay, the
pieces of the others are cut anew along one line of windows, and the last, partly filled one is split into powers of two. So
nothing is padded, and nearly all pieces lie where the rule put them, however few a task has.

Each task packs what it reads, without a shuffle, in memory bounded by `max_open` windows; a task that runs again makes
the same windows. Sequence ids are the task's number and a running number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .shared import arrow_schema, in_arrow, record_batches, release, slices

WINDOW = 1024
END_ID = 0
MAX_OPEN = 4096
PIECES_PER_OPEN = 64
PIECES = "piece long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def byte_bpe(path: str | None = None):
    """text -> ids of the byte-level vocabulary; the file is a parameter.

    tiktoken applies the same merges several times faster than the tokenizers library, so it does the work; a text in
    which the special token is spelled out goes to the tokenizers library, which alone knows it.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    reference = Tokenizer.from_file(path)
    special = {token.content: number for number, token in reference.get_added_tokens_decoder().items()}
    letters = _byte_letters()
    ranks = {
        bytes(letters[c] for c in token): number
        for token, number in reference.get_vocab(with_added_tokens=True).items()
        if token not in special
    }
    fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(name in text for name in special):
            return reference.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies spell a byte that is no printable Latin-1 character by a letter from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class SquaresPacker:
    """Online sum-of-squares packing of pieces shorter than `window`; pieces are any objects with a length."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN, pieces_per_open: int | None = None):
        self.window, self.max_open, self.pieces_per_open = window, max_open, pieces_per_open
        self.levels: list[list[list[tuple[int, int, int]]]] = [[] for _ in range(window)]
        self.counts = np.zeros(window + 1, np.int64)
        self.open = self.placed = 0

    def bound(self) -> int:
        """How many windows may be open: `max_open`, or with `pieces_per_open` fewer while few pieces were placed."""
        return min(self.max_open, 1 + self.placed // self.pieces_per_open) if self.pieces_per_open else self.max_open

    def place(self, piece: int, start: int, size: int) -> list[tuple[int, int, int]] | None:
        """Place `size` tokens of document `piece` from `start` on; returns the window's pieces if one is full now."""
        counts, window = self.counts, self.window
        never = np.iinfo(np.int64).max
        # Moving a window from level h to h + s changes the sum by 2(N[h+s] - N[h]) + 2; a new window by 2 N[s] + 1.
        change = np.full(window + 1, never)
        last = window - size
        there = counts[1 : last + 1]
        reached = counts[size + 1 : window + 1]
        change[1 : last + 1] = np.where(there > 0, 2 * (reached - there) + 2, never)
        if counts[last] > 0:  # a full window leaves the array: its level only loses one
            change[last] = 1 - 2 * counts[last]
        if self.open < self.bound():
            change[0] = 2 * counts[size] + 1
        else:  # a window that is too full for the piece may be filled with its beginning; its end then opens another
            there, ends = counts[last + 1 : window], counts[1:size]
            change[last + 1 : window] = np.where(there > 0, 2 * (ends - there) + 2, never)
        level = int(change.argmin())
        held = []
        if level:
            held = self.levels[level].pop()
            counts[level] -= 1
            self.open -= 1
        self.placed += 1
        taken = min(size, window - level)
        held.append((piece, start, taken))
        if taken < size:
            self._open([(piece, start + taken, size - taken)], size - taken)
        if level + taken == window:
            return held
        self._open(held, level + taken)
        return None

    def _open(self, held: list[tuple[int, int, int]], level: int) -> None:
        self.levels[level].append(held)
        self.counts[level] += 1
        self.open += 1

    def settle(self) -> Iterator[list[tuple[int, int, int]]]:
        """Close all open windows without padding."""
        rest = []
        for level in range(1, self.window):
            for held in self.levels[level]:
                if level & (level - 1) == 0:
                    yield held
                else:
                    rest += held
            self.levels[level] = []
        self.counts[:] = 0
        self.open = 0
        total = sum(size for _, _, size in rest)
        sizes = [self.window] * (total // self.window)
        sizes += [1 << b for b in range(self.window.bit_length() - 2, -1, -1) if total % self.window >> b & 1]
        at, left = 0, rest[0] if rest else None
        for size in sizes:
            held = []
            while size:
                piece, start, length = left
                taken = min(size, length)
                held.append((piece, start, taken))
                size -= taken
                if taken < length:
                    left = (piece, start + taken, length - taken)
                else:
                    at += 1
                    left = rest[at] if at < len(rest) else None
            yield held


def pack(documents: DataFrame, window: int = WINDOW, max_open: int = MAX_OPEN, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    `documents` needs doc_id and text; other columns do not matter. A null text is empty: one piece, the end id. Rows
    that repeat are packed as often as they occur. No row, no result.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("the window must be a power of two")
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {PIECES.removeprefix('piece long, ')}"
    kinds = arrow_schema(documents.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer)
        packer = SquaresPacker(window, max_open, PIECES_PER_OPEN)
        number = TaskContext.get().partitionId() << 40
        docs: dict[int, list] = {}  # of documents in open windows: id, held ids, start of these, tokens in all, held
        rows: dict[str, list] = {name: [] for name in kinds.names}
        seen = 0

        def emit(held):
            nonlocal number
            offset = 0
            for piece, start, size in held:
                doc = docs[piece]
                found = doc[1][(start - doc[2]) * 4 : (start - doc[2] + size) * 4]
                for name, value in zip(kinds.names, (doc[0], start, size, zlib.crc32(found), doc[3], number, offset)):
                    rows[name].append(value)
                offset += size
                doc[4] -= size
                if not doc[4]:
                    del docs[piece]
            number += 1

        for batch in (part for whole in batches for part in slices(whole, 1000)):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encode(text or ""), END_ID], "<u4").tobytes()
                total = len(ids) // 4
                docs[seen] = [doc_id, ids, 0, total, total]
                whole = total // window * window
                for start in range(0, whole, window):
                    emit([(seen, start, window)])
                if whole < total:
                    docs[seen][1:3] = ids[whole * 4 :], whole
                if whole < total and (full := packer.place(seen, whole, total - whole)):
                    emit(full)
                seen += 1
            yield from record_batches(rows, kinds)
            rows = {name: [] for name in kinds.names}
        for held in packer.settle():
            emit(held)
        yield from record_batches(rows, kinds)
        release()

    return in_arrow(documents.select("doc_id", "text"), run, schema)
