"""Word limits, hashes and shingles against plain Python."""

import random

import numpy as np
import pyarrow as pa

from reportlake.llm import words as W

TEXTS = ["", None, "a b", " lead and trail ", "ünï cödé\tx\n\ny", "A a A", "日本語 text", "end", "start"]


def spans_of(texts, keep):
    data, offsets = W.text_buffers(pa.array(texts, pa.string()))
    starts, ends, owner = W.word_spans(data, offsets, keep)
    return data, starts, ends, owner


def test_words_are_those_of_bytes_split():
    data, starts, ends, owner = spans_of(TEXTS, W.SPACED)
    got = [(int(o), data[s:e].tobytes()) for s, e, o in zip(starts, ends, owner)]
    assert got == [(i, w) for i, t in enumerate(TEXTS) for w in (t or "").encode().split()]


def test_sliced_columns_keep_their_texts():
    column = pa.array(TEXTS * 3, pa.string()).slice(4, 11)
    data, offsets = W.text_buffers(column)
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])] == [t or "" for t in column.to_pylist()]


def test_hashes_fold_ascii_case_only_and_tell_words_apart():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    data, starts, ends, _ = spans_of([" ".join(words)], W.SPACED)
    h = W.word_hashes(data, starts, ends)
    assert len(set(h.tolist())) == len(set(words))
    assert W.hash_text("WORD") == W.hash_text("word") != W.hash_text("wörd")
    assert W.hash_text("É") != W.hash_text("é")


def test_blocks_do_not_change_hashes(monkeypatch):
    data, starts, ends, _ = spans_of(["x" * 50 + " yy " + "z" * 300 + " x " + "yy"], W.SPACED)
    whole = W.word_hashes(data, starts, ends)
    monkeypatch.setattr(W, "BLOCK", 16)
    assert (W.word_hashes(data, starts, ends) == whole).all()
    assert whole[1] == whole[4]


def test_shingles_stay_within_texts():
    h, owner = np.arange(1, 12, dtype=np.uint64), np.array([0] * 6 + [1] * 5)
    got, belongs = W.shingles(h, owner, 5)
    assert belongs.tolist() == [0, 0, 1]
    assert len(set(got.tolist())) == 3


def test_slices_cover_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 100, 1, 1, 1, 90, 3)])], names=["text"])
    parts = list(W.slices(iter([batch]), most=10))
    assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(parts) > 3
