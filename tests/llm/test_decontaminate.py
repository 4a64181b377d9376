"""Hits against a brute-force search of every window."""

import hashlib
import random

import pytest

from reportlake.llm import decontaminate as D

ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then it rests a while."), (2, "Short item here"), (3, "alpha beta gamma alpha beta gamma alpha beta gamma alpha beta gamma"), (4, None), (5, " .,; "), (6, "Short item here"), (None, "one more item")]


def brute(text, items, window=10):
    words, hit, found = D.normalise(text), set(), set()
    for name, item in items:
        x = D.normalise(item)
        size = min(window, len(x))
        for j in range(len(x) - size + 1) if x else ():
            for k in range(len(words) - size + 1):
                if words[k : k + size] == x[j : j + size]:
                    hit |= set(range(k, k + size))
                    found.add("" if name is None else str(name))
    return len(words), len(hit), sorted(found)


def texts():
    rng = random.Random(8)
    pool = D.normalise(" ".join(t or "" for _, t in ITEMS)) + ["other", "words"]
    out = [None, "", "...", "SHORT, item; here!", ITEMS[0][1] * 2, "x " + ITEMS[2][1] + " gamma alpha", "quick brown fox jumps over the lazy dog and", "Short item. Short item here", "before one more item after"]
    out += [" ".join(rng.choice(pool) for _ in range(30)) for _ in range(20)]
    for _ in range(20):
        w = D.normalise(rng.choice([ITEMS[0][1], ITEMS[2][1]]))
        a = rng.randrange(4)
        out.append(" ".join(["pre"] * rng.randrange(3) + w[a : a + rng.randint(8, 12)] + ["post"]))
    return out


@pytest.mark.parametrize("block_words", [1_000_000, 4])
def test_matches_brute_force(spark, block_words):
    rows = list(enumerate(texts()))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r["doc_id"]: r for r in D.digest(D.match_items(documents, items, block_words=block_words)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        n, hit, found = brute(text, ITEMS)
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(found), hit > 0), text
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()


def test_removal_leaves_nothing_and_keeps_clean_rows(spark, widened):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    same = D.remove_matches(widened, items)
    assert same.schema == widened.schema
    assert sorted(map(str, same.collect())) == sorted(map(str, widened.collect()))
    dirty = spark.createDataFrame([(1, "Keep this part, then short item here and this part too."), (2, "short item here")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in D.remove_matches(dirty, items).collect()}
    assert out == {1: "Keep this part, then   and this part too."}


def test_edges(spark, documents, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.match_items(empty, items).count() == 0
    assert D.digest(D.match_items(documents, none)).where("contaminated").count() == 0
    assert D.match_items(documents, items).count() == documents.count()


def test_automaton_tracks_the_longest_match():
    automaton = D.Automaton([[1, 2, 3, 4, 2, 3], [9, 2, 3, 5]], window=3)
    state = matched = 0
    lengths = []
    for word in [2, 3, 5, 1, 2, 3, 4, 7, 3, 4, 2, 3, 5]:
        state, matched = automaton.advance(state, matched, word)
        lengths.append(matched)
    assert lengths == [1, 2, 3, 1, 2, 3, 4, 0, 1, 2, 3, 4, 3]


def test_blocks_change_nothing(spark):
    """Repeated and null ids, spans that touch or overlap, and coverage summed over the blocks."""
    words = [f"v{k}" for k in range(60)]
    items = spark.createDataFrame([(k, " ".join(words[a : a + 14])) for k, a in enumerate(range(0, 46, 5))] + [(90, "lone item"), (91, "item here")], "item_id long, text string")
    most = " ".join(words[:10] + words[20:30]) + " x y z"  # 20 of 23 words, no item of them has more than 10
    rows = [(1, most), (1, "a lone item here b"), (1, "clean"), (None, "lone item"), (None, " ".join(["p"] * 30 + words)), (None, None), (2, ""), (3, " ".join(["q r s"] * 20 + words[3:40] + ["t"]))]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    listed = lambda frame: sorted(map(str, frame.collect()))
    for each in (D.match_items, D.remove_matches):
        whole, parts = listed(each(documents, items)), listed(each(documents, items, block_words=4))
        assert parts == whole
    assert len(listed(D.match_items(documents, items, block_words=4))) == len(rows)
    assert not any("v1" in str(r) for r in D.remove_matches(documents, items, block_words=4).collect())
