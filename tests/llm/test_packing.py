"""Packing against a plain recomputation of every piece."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skewloom.llm.packing import SquaresPacker, byte_bpe, pack

from .conftest import ODD

REFERENCE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ENCODE = byte_bpe()


def ids_of(text):
    return [*REFERENCE.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t\x1c 　'sé0"))))
def test_same_ids_as_the_tokenizers_library(text):
    assert ENCODE(text) == REFERENCE.encode(text, add_special_tokens=False).ids


def test_special_token_in_a_text():
    assert ENCODE("a<|endoftext|>b") == REFERENCE.encode("a<|endoftext|>b", add_special_tokens=False).ids


@pytest.mark.parametrize("window", [16, 1024])
def test_every_token_is_in_one_piece(docs, window):
    rows = [*ODD, *((n, "some words " * (n % 37)) for n in range(20, 90))]
    pieces = pack(docs(*rows), window=window).toPandas()
    spread = pieces.sort_values(["sequence_id", "offset"])
    ends = (spread.offset + spread.length).groupby(spread.sequence_id).shift().fillna(0)
    assert (ends == spread.offset).all()
    sizes = spread.groupby("sequence_id").length.sum()
    assert sizes.map(lambda n: n <= window and n & (n - 1) == 0).all()  # no padding at all
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(ids_of(text))
    for doc_id, found in texts.items():
        mine = pieces[pieces.doc_id.isna() if doc_id is None else pieces.doc_id == doc_id]
        assert mine.length.sum() == sum(map(len, found))
        if len(found) == 1:
            at = 0
            for piece in mine.sort_values("start").itertuples():
                cut = np.array(found[0][piece.start : piece.start + piece.length], "<u4").tobytes()
                assert (piece.start, piece.ids_crc32, piece.doc_tokens) == (at, zlib.crc32(cut), len(found[0]))
                at += piece.length


def test_no_documents(docs):
    assert pack(docs((1, "x")).limit(0)).count() == 0


def test_window_must_be_a_power_of_two(docs):
    with pytest.raises(ValueError):
        pack(docs((1, "x")), window=1000)


def test_level_of_least_squares():
    """Each placement leaves the sum of squared counts as small as any other would."""
    rng = np.random.default_rng(3)
    packer = SquaresPacker(window=16)
    for number, size in enumerate(rng.integers(1, 16, 400).tolist()):
        before = packer.counts.copy()
        options = []
        for level in range(16):
            if level and not before[level] or level + size > 16:
                continue
            after = before.copy()
            after[level] -= level > 0
            if level + size < 16:
                after[level + size] += 1
            options.append((after[1:16] ** 2).sum())
        packer.place(number, 0, size)
        assert (packer.counts[1:16] ** 2).sum() == min(options)
        assert [len(x) for x in packer.levels[1:]] == packer.counts[1:16].tolist()


def test_level_of_least_squares_when_no_more_windows_may_open():
    """At the bound a piece may also fill up a window that is too full for it; again no other choice has a smaller sum."""
    rng = np.random.default_rng(4)
    packer, most = SquaresPacker(window=16, max_open=64, pieces_per_open=40), 0
    for size in rng.integers(1, 16, 600).tolist():
        before, at_bound = packer.counts.copy(), packer.open >= packer.bound()
        options = []
        for level in range(16):
            if level and not before[level] or not level and at_bound or level + size > 16 and not at_bound:
                continue
            after = before.copy()
            after[level] -= level > 0
            if level + size < 16:
                after[level + size] += 1
            elif level + size > 16:
                after[level + size - 16] += 1
            options.append((after[1:16] ** 2).sum())
        packer.place(0, 0, size)
        assert (packer.counts[1:16] ** 2).sum() == min(options)
        most = max(most, packer.open)
        assert packer.open <= packer.bound()
    assert most > 5


@pytest.mark.parametrize("n", [31, 300, 1600])
def test_nearly_all_pieces_lie_where_the_rule_put_them(spark, folder, n):
    """Pieces below a window of `n` documents in one task, without padding."""
    sizes = [len(ids_of(r.text)) % 1024 for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    sizes = ([s for s in sizes if s] * 20)[:n]
    packer = SquaresPacker(pieces_per_open=64)
    placed = sum(len(full) for i, s in enumerate(sizes) if (full := packer.place(i, 0, s)))
    settled = [held for held in packer.settle()]
    assert all((total := sum(x[2] for x in held)) & (total - 1) == 0 for held in settled)
    assert placed >= 0.9 * (placed + sum(map(len, settled)))
