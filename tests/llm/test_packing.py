"""Token ids against the tokenizer, exact round trips of both packings, best cuts against search."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from reportlake.llm import token_matrix as M
from reportlake.llm import tokens as K
from reportlake.llm import window_packing as P

ODD = ["", None, "a.'s x'st. don't I'll é .́x  b\x01c \x01 —.x 12ab3,4'4 ẞİ K. ÅB", "　x y z  ...!!! end.", "l'été c'est 'S 'T'LL x’s", "<|endoftext|> x <|startoftext|>", "ﬁn é É ½ ² ① 日本語。日", "😀😀 👨‍👩‍👧 a​b"]


@pytest.fixture(scope="module")
def coder():
    return K.Encoder(K.public_file())


def plain(coder, text):
    return coder.tokenizer.encode(text or "", add_special_tokens=False).ids + [P.END_ID]


def test_ids_are_the_tokenizers(coder):
    rng = random.Random(6)
    texts = ODD + ["".join(rng.choice("aB9.'é —,\n\x01!ñ") for _ in range(60)) for _ in range(200)]
    for _ in range(2):  # new units, then kept ones
        ids, limits, _ = K.encode_column(pa.array(texts, pa.string()), coder, P.END_ID)
        for k, t in enumerate(texts):
            assert ids[limits[k] : limits[k + 1]].tolist() == plain(coder, t), t


def test_sentence_ends(coder):
    ids, limits, ends = K.encode_column(pa.array(["One two. Three! Four", "x. y"]), coder, P.END_ID)
    one = len(coder.tokenizer.encode("One two.", add_special_tokens=False).ids)
    two = len(coder.tokenizer.encode("One two. Three!", add_special_tokens=False).ids)
    assert ends.tolist() == [one, two, int(limits[1]) + 2]


def check_pieces(rows, documents, coder, window):
    want = defaultdict(list)
    for r in documents.collect():
        want[r["doc_id"]].append(plain(coder, r["text"]))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = want[r["doc_id"]][0]
        assert r["doc_tokens"] == len(ids)
        part = ids[r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, copies in want.items():
        assert sum(n for _, n in by_doc[i]) == sum(map(len, copies))
        if len(copies) == 1:
            at = 0
            for a, n in sorted(by_doc[i]):
                assert a == at
                at += n
    for parts in by_sequence.values():
        at = 0
        for a, n in sorted(parts):
            assert a == at
            at += n
        assert 0 < at <= window


@pytest.mark.parametrize("window", [4096, 64])
def test_pieces_round_trip(documents, coder, window):
    rows = P.pack(documents, K.public_file(), window=window).collect()
    check_pieces(rows, documents, coder, window)


def brute(p, c, window, cut):
    cost = [0] + [10**9] * (len(p) - 1)
    for i in range(1, len(p)):
        for j in range(i):
            if p[i] - p[j] <= window:
                cost[i] = min(cost[i], cost[j] + c[i] + window - (p[i] - p[j]))
                if i == len(p) - 1:
                    cost[i] = min(cost[i], cost[j] + (bin(p[i] - p[j]).count("1") - 1) * cut)
    return cost[-1]


def cost_of(cuts, price, window, cut):
    best = 10**9
    for k in range(len(cuts) - 1):
        head, tail = cuts[: k + 1], np.diff(cuts[k:])
        if all(x in price for x in head) and cuts[-1] - cuts[k] <= window:
            spent = sum(price[b] + window - (b - a) for a, b in zip(head, head[1:]))
            if all(n & (n - 1) == 0 for n in tail.tolist()):
                best = min(best, spent + (len(tail) - 1) * cut)
            if len(tail) == 1:
                best = min(best, spent + window - int(tail[0]))
    return best


def test_cuts_cost_least():
    rng = np.random.default_rng(1)
    for _ in range(150):
        p = [0, *np.cumsum(rng.integers(1, 7, rng.integers(1, 25))).tolist()]
        c = [0, *rng.integers(0, 5, len(p) - 1).tolist()]
        c[-1] = 0
        cuts = P.best_cuts(np.array(p), np.array(c), 16, 3)
        assert cuts[0] == 0 and cuts[-1] == p[-1] and all(0 < b - a <= 16 for a, b in zip(cuts, cuts[1:]))
        assert cost_of(cuts, dict(zip(p, c)), 16, 3) == brute(p, c, 16, 3)


def test_matrix_round_trip(documents, coder):
    rows = M.pack(documents, K.public_file(), row_tokens=128).collect()
    got = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == 128 and (ids[r["n_tokens"] :] == M.PAD_ID).all()
        assert r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] and r["position_resets"] == r["cu_seqlens"][:-1]
        for i, at, a, b in zip(r["doc_ids"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            got[i].setdefault(at, []).append(ids[a:b].tolist())
    copies = defaultdict(int)
    for r in documents.collect():
        copies[r["doc_id"]] += 1
    for r in documents.collect():
        parts = got[r["doc_id"]]
        assert all(len(x) == copies[r["doc_id"]] for x in parts.values())
        assert sum((parts[at][0] for at in sorted(parts)), []) == plain(coder, r["text"])


def test_best_fit_decreasing_takes_the_tightest_row():
    rng = random.Random(2)
    for _ in range(40):
        lengths, most = [rng.randint(1, 50) for _ in range(80)], 50
        rows = M.best_fit_decreasing(lengths, most)
        rooms: list[int] = []
        for piece in sorted(range(80), key=lambda k: (-lengths[k], k)):
            fit = [r for r in rooms if r >= lengths[piece]]
            if fit:
                rooms.remove(min(fit))
            rooms.append((min(fit) if fit else most) - lengths[piece])
        assert sorted(most - sum(lengths[k] for k in row) for row in rows) == sorted(rooms)
        assert sorted(k for row in rows for k in row) == list(range(80))


def test_empty(empty):
    assert P.pack(empty, K.public_file()).count() == 0
    assert M.pack(empty, K.public_file()).count() == 0
