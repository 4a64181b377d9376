"""Repeated passages against a brute-force search of all 50-word runs."""

import random
from collections import defaultdict

import numpy as np

from reportlake.llm import passages as P


def runs(rows, n=50):
    """row id -> word numbers in a run of n words that another text has too."""
    docs = {i: (t or "").encode().lower().split() for i, t in rows}
    where = defaultdict(set)
    for i, w in docs.items():
        for j in range(len(w) - n + 1):
            where[tuple(w[j : j + n])].add(i)
    out = defaultdict(set)
    for i, w in docs.items():
        for j in range(len(w) - n + 1):
            if len(where[tuple(w[j : j + n])]) > 1:
                out[i] |= set(range(j, j + n))
    return out


def found(frame):
    out = defaultdict(set)
    for r in frame.collect():
        out[r["doc_id"]] |= set(range(r["start"], r["end"]))
        out[r["other_doc_id"]] |= set(range(r["other_start"], r["other_end"]))
        assert r["end"] - r["start"] >= P.LEAST_WORDS and r["similarity"] >= 0.75
    return out


def corpus(rng):
    words = lambda n: [f"w{rng.randrange(2000)}" for _ in range(n)]
    line, shared, texts = words(12), [words(n) for n in (51, 70, 200)], []
    for k in range(90):
        body = words(rng.randint(10, 150))
        if k % 2:
            body += line  # a common line, too short for a passage
        if k % 3 == 0:
            at = rng.randrange(len(body))
            body = body[:at] + shared[k % len(shared)] + body[at:]
        texts.append(" ".join(body))
    lone = words(80)
    return texts + [" ".join(words(30) + lone + words(20)), " ".join(lone[:49]), " ".join(lone[3:77]), None, "", " ".join(shared[0][:40])]


def test_every_repeated_run_is_covered_and_clean_texts_are_not(spark):
    rows = list(enumerate(corpus(random.Random(12))))
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want, got = runs(rows), found(P.repeated_passages(documents))
    assert set(got) == set(want)
    for i, places in want.items():
        assert places <= got[i]


def test_near_copies_of_a_passage(spark):
    rng = random.Random(3)
    passage = [f"p{k}" for k in range(120)]
    other = list(passage)
    other[60] = "changed"
    rows = [(1, " ".join(["a b c"] + passage + ["x"])), (2, " ".join(["d"] * 3 + other)), (3, " ".join(f"q{rng.random()}" for _ in range(150)))]
    out = P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["other_doc_id"]) for r in out} in ({(1, 2)}, {(2, 1)})
    assert max(r["end"] - r["start"] for r in out) == 120


def test_compact_windows_cover_every_long_stretch_once():
    h = np.random.default_rng(4).permutation(60)
    least = 7
    windows = P.compact_windows(h, least)
    for i in range(60):
        for j in range(i + least - 1, 60):
            c = i + int(h[i : j + 1].argmin())
            assert sum(left <= i and j <= right and w == c for left, w, right in windows) == 1
    assert len(windows) <= 2 * 60 / least + 10


def test_edges(documents, empty, widened):
    assert P.repeated_passages(empty).count() == 0
    ids = {r["doc_id"] for r in P.repeated_passages(documents).collect()} | {r["other_doc_id"] for r in P.repeated_passages(documents).collect()}
    by_text = defaultdict(list)
    for r in documents.select("doc_id", "text").distinct().collect():
        by_text[r["text"]].append(r["doc_id"])
    long = [i for t, i in by_text.items() if t and len(t.split()) > 5000]
    assert {x for i in long for x in i} <= ids
    assert P.repeated_passages(widened).count() == P.repeated_passages(documents).count()


def test_rows_by_document_lose_nothing(spark):
    documents = spark.createDataFrame(list(enumerate(corpus(random.Random(5)))), "doc_id long, text string")
    pairs = P.repeated_passages(documents).collect()
    rows = P.by_document(P.repeated_passages(documents)).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows)
    assert sorted((r["doc_id"], *p) for r in rows for p in r["passages"]) == sorted((r["doc_id"], r["start"], r["end"], r["other_doc_id"], r["other_start"], r["other_end"], r["met"], r["similarity"]) for r in pairs)
    assert all(r["other_doc_ids"] == sorted({p["other_doc_id"] for p in r["passages"]}) for r in rows)


def edited(rng, passage, kind):
    """The passage with inserted, deleted or replaced words, more than 0.75 alike."""
    w, new = list(passage), lambda: f"n{rng.randrange(10**9)}"
    if kind == "inserted":
        return w[: len(w) // 2] + [new()] + w[len(w) // 2 :]
    if kind == "deleted":
        return w[: len(w) // 2] + w[len(w) // 2 + 1 :]
    if kind == "replaced":  # a block of 8 to 12 words by another one
        return w[: len(w) // 2] + [new() for _ in range(9)] + w[len(w) // 2 + 8 + rng.randrange(5) :]
    return [x for k, v in enumerate(w) for x in ([new(), v] if k % 45 == 40 else [v])]


def planted(rng, copies=40):
    """Rows, and (kind, id, other id, first word, end word) of each planted near copy."""
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows, plants = [], []
    for kind, n in (("inserted", 60), ("deleted", 60), ("replaced", 150), ("each 45", 400)):
        for _ in range(copies):
            passage, lead = words(n), words(rng.randint(5, 60))
            i = len(rows)
            rows += [(i, " ".join(lead + passage + words(40))), (i + 1, " ".join(words(rng.randint(5, 60)) + edited(rng, passage, kind) + words(40)))]
            plants.append((kind, i, i + 1, len(lead), len(lead) + n))
    return rows, plants


def recall(frame, plants):
    """Share of each kind's plants that have a passage over nine tenths of them."""
    best = defaultdict(set)
    for r in frame.collect():
        best[r["doc_id"], r["other_doc_id"]] |= set(range(r["start"], r["end"]))
        best[r["other_doc_id"], r["doc_id"]] |= set(range(r["other_start"], r["other_end"]))
    got = defaultdict(list)
    for kind, i, other, a, b in plants:
        got[kind].append(len(best[i, other] & set(range(a, b))) >= 0.9 * (b - a))
    return {kind: float(np.mean(v)) for kind, v in got.items()}


def test_recall_of_planted_edits(spark):
    rows, plants = planted(random.Random(21))
    got = recall(P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")), plants)
    assert min(got.values()) >= 0.85


def test_every_near_passage_of_a_shift_is_found(spark):
    """Forms: near copies at the same shift, parted by other text."""
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    x, z, places = [], [], []
    for k in range(5):
        if k in (0, 4):
            passage = near = words(30)  # a short common line
        else:
            passage = words(90)
            near = [f"n{k}x{j}" if j in (30, 60) else w for j, w in enumerate(passage)]
            places.append((len(x), len(x) + 90))
        x, z = x + passage + words(80), z + near + words(80)
    out = P.repeated_passages(spark.createDataFrame([(1, " ".join(x)), (2, " ".join(z))], "doc_id long, text string")).collect()
    for a, b in places:
        assert any(r["start"] <= a and b <= r["end"] for r in out), (a, b, out)


def test_passages_inside_frequent_lines_lose_no_link(spark):
    """Two documents share a passage; twenty others share only a frequent line inside it."""
    rng = random.Random(17)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts, pairs = [], []
    for length, size in ((50, 40), (60, 46)):
        for _ in range(30):
            line = words(size)
            at = rng.randint(0, length - size)
            passage = words(at) + line + words(length - size - at)
            group = [passage, passage] + [line] * 20
            ids = list(range(len(texts), len(texts) + len(group)))
            texts += [words(rng.randint(3, 60)) + g + words(rng.randint(3, 60)) for g in group]
            pairs.append((ids[0], ids[1]))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    random.Random(2).shuffle(rows)
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    out = P.repeated_passages(documents)
    got = {tuple(sorted((r["doc_id"], r["other_doc_id"]))) for r in out.collect()}
    assert sum(p in got for p in pairs) == len(pairs)
    assert got == set(pairs)


def test_the_first_window_takes_part_where_slices_hide_it(spark):
    """Passages around one line in many copies each, over many slices, two of them in some documents."""
    rng = random.Random(31)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for _ in range(12):
        line = words(30)
        kinds = [words(12) + line + words(12) for _ in range(3)] + [line]
        for k in range(16):
            one, two = rng.sample(range(4), 2)
            texts.append(words(20) + kinds[one] + words(20) + (kinds[two] + words(9) if k % 5 == 0 else []))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = runs(rows)
    for parts in (1, 3, 40):
        got = found(P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)))
        for i, places in want.items():
            assert places <= got[i]


def test_words_that_come_back_in_one_document_are_all_covered(spark):
    """Lines repeated inside documents, at any shift, also where the document is its group's first."""
    rng = random.Random(41)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for _ in range(25):
        line, cycle = words(55), words(9)
        texts += [words(20) + line * 4 + words(20), words(30) + line + words(5), words(9) + cycle * 9 + words(20), words(4) + (cycle * 9)[3:70] + words(7)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = runs(rows)
    for parts in (1, 25):
        got = found(P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)))
        for i, places in want.items():
            assert places <= got[i]


def test_near_passages_around_a_frequent_line(spark):
    """Two documents share a passage with a word changed; twenty others share only a line inside it."""
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts, pairs = [], []
    for length, size in ((60, 40), (60, 46)):
        for _ in range(40):
            line = words(size)
            at = rng.choice([0, 1, length - size - 1, length - size]) if size == 40 else rng.choice([0, length - size])
            passage = words(at) + line + words(length - size - at)
            other = list(passage)
            other[3 if at > 5 else length - 4] = "changed"
            ids = list(range(len(texts), len(texts) + 22))
            texts += [words(rng.randint(3, 60)) + g + words(rng.randint(3, 60)) for g in [passage, other] + [line] * 20]
            pairs.append((ids[0], ids[1]))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    random.Random(2).shuffle(rows)
    out = P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    got = {tuple(sorted((r["doc_id"], r["other_doc_id"]))) for r in out}
    assert sum(p in got for p in pairs) >= 78  # of 80


def test_every_document_with_a_passage_has_a_row(spark):
    rng = random.Random(6)
    line = [f"p{k}" for k in range(80)]
    rows = [(i, " ".join([f"w{rng.random()}" for _ in range(5 + i)] + line)) for i in range(12)]
    got = {r["doc_id"]: r for r in P.by_document(P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))).collect()}
    assert set(got) == set(range(12))
    assert sum(r["n_links"] for r in got.values()) == 2 * sum(len(r["other_doc_ids"]) for r in got.values())
    assert all((5 + i, 85 + i) in [tuple(p) for p in r["places"]] for i, r in got.items())


def test_windows_of_many_equal_tokens():
    h = np.zeros(300, np.uint64)
    assert P.compact_windows(h, 46) == [(c, c, 299) for c in range(300 - 45)]


def test_windows_of_many_stretches_against_a_plain_search():
    rng = np.random.default_rng(6)
    for least, values in ((1, 3), (2, 50), (7, 2), (7, 1 << 40), (46, 4), (46, 1 << 40)):
        sizes = rng.integers(0, 120, 9)
        limits, want = np.concatenate([[0], np.cumsum(sizes)]), []
        h = rng.integers(0, values, int(limits[-1])).astype(np.uint64)
        rows = np.flatnonzero(sizes >= least)
        for k, row in enumerate(rows):
            a, b = int(limits[row]), int(limits[row + 1])
            for c in range(a, b):
                left = max([a] + [j + 1 for j in range(a, c) if h[j] <= h[c]])
                right = min([b - 1] + [j - 1 for j in range(c + 1, b) if h[j] < h[c]])
                want += [(k, left, c, right)] * (right - left + 1 >= least)
        found = P._all_windows(h, limits[rows], limits[rows + 1], least)
        assert list(zip(*(v.tolist() for v in found))) == want


def test_windows_that_are_alone_stay_out_of_python_and_are_sorted_by_one_key(spark, capsys):
    documents = spark.createDataFrame(list(enumerate(corpus(random.Random(2)))), "doc long, text string").where("text IS NOT NULL")
    P._links(P._windows(documents, P.LEAST_WORDS - P.SHINGLE + 1)).explain()
    plan = capsys.readouterr().out
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and all("key#" in line and "doc#" not in line for line in sorts)
    above = plan[: plan.index("Window [count")]
    assert "MapInArrow" in above and "Filter ((size#" in above


def test_groups_that_go_over_many_batches_lose_no_link(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = list(enumerate(corpus(random.Random(23))))
    want = runs(rows)
    before = spark.conf.get(name)
    for most in (1, 3):
        spark.conf.set(name, most)
        try:
            got = found(P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(20)))
        finally:
            spark.conf.set(name, before)
        assert set(got) == set(want)
        assert all(places <= got[i] for i, places in want.items())


def test_near_passages_with_edits_on_both_sides_of_a_frequent_line(spark):
    """Two documents share a passage but for a word on either side of a line that many others have, too,
    in every slice."""
    rng = random.Random(13)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts, pairs = [], []
    for _ in range(60):
        line, before, after = words(45), words(19), words(19)
        other = before[:-1] + ["changed"] + line + ["altered"] + after[1:]
        group = [before + line + after, other] + [line] * 30
        pairs.append((len(texts), len(texts) + 1))
        texts += [words(rng.randint(30, 60)) + g + words(rng.randint(30, 60)) for g in group]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    random.Random(4).shuffle(rows)
    for parts in (1, 8):
        out = P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
        got = {tuple(sorted((r["doc_id"], r["other_doc_id"]))) for r in out}
        share = sum(p in got for p in pairs) / len(pairs)
        assert share >= 0.95, (parts, share)
        assert got <= set(pairs)
