"""Token ids of whole texts with a public tokenizer file, a unit of text at a time.

The tokenizers used here (byte-level BPE with word ends, white space dropped) never join text across white space,
nor across a border between an ASCII letter and another ASCII character that isn't an apostrophe.
Texts are cut there into units; each distinct unit is encoded once a worker and its ids are kept in
sorted numpy arrays, so the tokenizer only runs for units a worker has not seen. The strings of
special tokens count as ordinary text. The units of one slice bound what is held at once; the kept
ids are dropped when they exceed KEEP_UNITS.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from reportlake.llm import words as W

KEEP_UNITS = 3_000_000
DEFAULT_FILE = "word_bpe_49k.json"

_KIND = np.zeros(256, np.int8)  # 0: other ASCII, 1: ASCII letter, 2: joins either
for _b in range(256):
    if chr(_b).isascii() and chr(_b).isalpha():
        _KIND[_b] = 1
    elif _b == 0x27 or _b >= 0x80:
        _KIND[_b] = 2
_SENTENCE = W.byte_table(lambda b: b in b".!?")


def public_file(name: str = DEFAULT_FILE) -> str:
    """Path of an installed public tokenizer file (the same package is on every worker)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text number, sentence ends here) of every unit."""
    starts, ends, _ = W.word_spans(data, offsets, W.SPACED)
    kind = _KIND[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[1:-1] = kind[:-1] + kind[1:] == 1
    inside &= np.concatenate([W.SPACED[data], [False]]) & np.concatenate([[False], W.SPACED[data]])
    inside[offsets] = False
    cuts = np.flatnonzero(inside)
    sentence_end = np.zeros(len(data) + 1, bool)
    sentence_end[ends] = True
    starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    sentence = _SENTENCE[data[ends - 1]] & sentence_end[ends] if len(ends) else np.zeros(0, bool)
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1, sentence


class Encoder:
    """Ids of units, encoded once each."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[number for piece, number in vocabulary.items() if piece.endswith("</w>")]] = True
        mark = self.tokenizer.encode("\x01", add_special_tokens=False).ids
        if len(mark) != 1 or not self.closes[mark[0]]:
            raise ValueError(f"{path} isn't a byte-level vocabulary with word ends")
        self.mark = mark[0]
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode_new(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, number of ids of each). Units of letters alone are one pre-token each,
        so their ends show in the ids; others are told apart by a mark between them."""
        texts = [b.decode() for b in raw]
        alone = np.array([t.lower().isalpha() for t in texts], bool)
        marked = np.flatnonzero(~alone)
        if any("\x01" in texts[k] for k in marked):
            got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([x for ids in got for x in ids], np.uint32), np.array([len(ids) for ids in got], np.int64)
        size = np.zeros(len(texts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for numbers, between in ((np.flatnonzero(alone), " "), (marked, " \x01 ")):
            for k in range(0, len(numbers), 4096):
                some = numbers[k : k + 4096]
                joined = between.join([texts[i] for i in some] + [""] * (between != " "))
                ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
                if between == " ":
                    size[some] = np.diff(np.flatnonzero(self.closes[ids]), prepend=-1)
                else:
                    limit = ids == self.mark
                    size[some] = np.diff(np.flatnonzero(limit), prepend=-1) - 1
                    ids = ids[~limit]
                parts.append((some, ids))
        at = np.cumsum(size) - size
        flat = np.empty(size.sum(), np.uint32)
        for some, ids in parts:
            n = size[some]
            flat[np.repeat(at[some] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return flat, size

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in order, number of ids of each unit)."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        hashes = W.word_hashes(data, starts, ends)
        order = np.argsort(hashes)
        ordered = hashes[order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        distinct, example = ordered[first], order[first]
        if len(self.keys) + len(distinct) > KEEP_UNITS:
            self._clear()
        place = np.searchsorted(self.keys, distinct)
        old = np.zeros(len(distinct), bool)
        if len(self.keys):
            old = self.keys[np.minimum(place, len(self.keys) - 1)] == distinct
        if not old.all():
            new = ~old
            raw = data.tobytes()
            flat, size = self._encode_new([raw[s:e] for s, e in zip(starts[example[new]].tolist(), ends[example[new]].tolist())])
            at = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate([self.ids, flat])
            self.at, self.size = np.insert(self.at, place[new], at), np.insert(self.size, place[new], size)
            self.keys = np.insert(self.keys, place[new], distinct[new])
            place = np.searchsorted(self.keys, distinct)
        number = np.empty(len(hashes), np.int64)
        number[order] = place[np.cumsum(first) - 1]
        size, at = self.size[number], self.at[number]
        total = np.cumsum(size)
        index = np.repeat(at - (total - size), size) + np.arange(total[-1])
        return self.ids[index], size


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file (kept between tasks of the same worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_column(column: pa.Array, coder: Encoder, end_id: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all texts, text offsets in ids, places in ids after which a sentence ends).
    ``end_id`` is put after each text; a null or empty text has only that id."""
    data, offsets = W.text_buffers(column)
    n = len(offsets) - 1
    starts, ends, owner, sentence = units(data, offsets)
    ids, size = coder.encode(data, starts, ends)
    per_text = np.bincount(owner, weights=size, minlength=n).astype(np.int64)
    extra = 0 if end_id is None else 1
    limits = np.concatenate([[0], np.cumsum(per_text + extra)])
    after = np.cumsum(size)[sentence] + extra * owner[sentence]
    if end_id is not None:
        ids = np.insert(ids, np.cumsum(per_text), np.uint32(end_id))
    return ids, limits, after
