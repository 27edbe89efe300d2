"""Lexical search, hard negatives and the positional index beside plain versions, on odd rows too."""

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticeworks.llm import lexical, negatives, positional, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}

# Further columns whose names differ from those used only in case, or are names that the operators use.
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("TEXT", T.IntegerType()), T.StructField("n", T.StringType()), T.StructField("segment", T.StringType())])
ITEMS = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("Item_ID", T.IntegerType()), T.StructField("block", T.StringType())])
VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("Label", T.StringType()), T.StructField("norm", T.StringType())])


def words(text):
    return TERM.findall((text or "").translate(UPPER))


def sample(seed, docs, items):
    """Texts over few words, so that phrases, ties and repeated rows are common."""
    rng = random.Random(seed)
    some = ["the", "of", "Ünique", "日本", "rain", "COLD", "x1", "don't", "valley", "farm"]
    make = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choices(some, weights=range(10, 0, -1), k=n))
    texts = [make(rng.randint(1, 60)) for _ in range(docs)]
    queries = [make(rng.randint(1, 24)) for _ in range(items)]
    for i in range(0, docs, 3):  # passages
        texts[i] += " " + rng.choice(queries)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[1]), (None, texts[1]), (-5, None), (-6, ""), (-7, " .\n"), (-8, make(30_000))]
    asked = [(i, t) for i, t in enumerate(queries)]
    asked += [asked[0], (None, queries[1]), (90, None), (91, ""), (92, "rain"), (93, "zebra unknown words"), (94, make(2000))]
    return rows, asked


def frames(spark, rows, asked):
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], DOCS)
    return docs, spark.createDataFrame([(*r, 1, "b") for r in asked], ITEMS)


def first_null(x):
    return (x is not None, x or 0)


# 11
def searched(rows, asked, k):
    docs = [(i, words(t)) for i, t in rows]
    full = sum(1 for _, w in docs if w)
    total = sum(len(w) for _, w in docs)
    counts = [collections.Counter(w) for _, w in docs]
    df = collections.Counter(t for c in counts for t in c)
    out = collections.Counter()
    for item, text in asked:
        scores = []
        for (doc, own), c in zip(docs, counts):
            m = 100 - 25 + (25 * len(own) * full) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * full + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in words(text) if t in c)
            if score > 0:
                scores.append((-score, first_null(doc), doc))
        for rank, (score, _, doc) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, doc, -score] += 1
    return out


@pytest.mark.parametrize("seed,k,chars", [(1, 20, 4_000_000), (2, 3, 100), (3, 1, 4_000_000)])
def test_search_against_all_scores(spark, seed, k, chars, monkeypatch):
    monkeypatch.setattr(lexical, "DOCUMENTS", 16)  # several blocks in a task
    rows, asked = sample(seed, 120, 12)
    docs, items = frames(spark, rows, asked)
    got = lexical.search(docs.repartition(3), items, k, chars)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(map(tuple, got.collect())) == searched(rows, asked, k)


def test_a_block_gives_up_only_what_cannot_win():
    import numpy as np

    rng = np.random.default_rng(3)
    for k in (1, 3, 7):
        n = rng.integers(5, 40, 300)
        lengths = rng.integers(1, 6, 300)
        own = np.concatenate([rng.choice(12, size, replace=False, p=np.arange(1, 13) / 78) for size in lengths])
        block = lexical.Block(n, own, rng.integers(1, 4, len(own)), lengths, 12, 300, int(n.sum()))
        frequency = np.bincount(own, minlength=12)
        order = np.argsort(frequency, kind="stable")
        weight = np.sort(rng.integers(1, 9000, 12))[::-1].copy()
        full = np.zeros(300, np.int64)
        for t, w in zip(order, weight):
            a, b = block.start[t], block.start[t + 1]
            full[block.doc[a:b]] += w * block.impact[a:b]
        held, score = block.rank(order, weight, k, 1)
        assert (full[held] == score).all() and len(held) < 300
        cut = np.sort(full)[-k]
        assert set(np.flatnonzero(full >= cut)) <= set(held.tolist())


def test_search_of_empty_tables(spark):
    rows, asked = sample(4, 5, 3)
    docs, items = frames(spark, rows, asked)
    none, nothing = frames(spark, [], [])
    assert lexical.search(none, items).collect() == [] and lexical.search(docs, nothing).collect() == []
    blank, _ = frames(spark, [(1, None), (2, " ")], [])
    assert lexical.search(blank, items).collect() == []


# 12
def mined(rows, positives=5, negatives_=3):
    own = []
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = collections.Counter()
    for anchor, label, vector in {(a, b, tuple(c)) for a, b, c in own if a % 50 == 0}:
        scored = sorted((-dot(vector, v), i, lab) for i, lab, v in own if i != anchor)
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(n, j) for n, j, lab in scored if lab != label and -50 * p <= -100 * n <= -95 * p]
            for rank, (n, j) in enumerate(fit[:negatives_], 1):
                out[anchor, i, rank, j, -p, -n] += 1
    return out


def vectors(seed, n, dim, labels):
    import numpy as np

    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(labels, dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        rows.append((i, np.float32(middle[label] * rng.uniform(0.2, 1.5) + rng.normal(size=dim) * 0.6).tolist(), label))
    rows += [rows[50], rows[50], rows[3], (None, rows[1][1], 1), (1001, None, 1), (1002, rows[1][1], None), (1003, [1.0, None], 2)]
    rows += [(1050, [0.0] * dim, 2), (1100, rows[2][1][: dim // 2], 1), (1150, [], 3), (1004, [float("nan")] * dim, 1),
             (1005, [float("inf")] + [0.0] * (dim - 1), 1), (1200, rows[7][1], 5), (1201, rows[7][1], 6), (50, rows[9][1], 2)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)


def mine(df, **more):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(df, F.col("vec_id") % 50 == 0, label, **more)


@pytest.mark.parametrize("seed,dim,block", [(1, 8, 2048), (2, 3, 2), (3, 1, 5)])
def test_hard_negatives_against_all_scores(spark, seed, dim, block):
    rows = vectors(seed, 300, dim, 4)
    got = mine(frame(spark, rows).repartition(3), block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert collections.Counter(map(tuple, got.collect())) == mined(rows)


def test_bounds_hold_every_score(spark):
    import numpy as np

    table, width = negatives.with_angles(frame(spark, vectors(5, 200, 6, 3)), F.col("label"))
    rows = table.toArrow().combine_chunks().to_batches()[0]
    held = negatives.Rows(rows, width)
    every = np.arange(len(held.ids))
    narrow = 0
    for anchor in negatives._anchors(table.limit(40).collect(), width):
        low, high = held.bounds(anchor, every)
        scores = held.scores(anchor, every)
        assert (low <= scores).all() and (scores <= high).all()
        narrow += (high - low < 0.5 * held.norm * anchor["norm"]).sum()
    assert narrow > 0


def test_hard_negatives_of_empty_tables(spark):
    assert mine(frame(spark, [])).collect() == []
    assert mine(frame(spark, [(50, None, 1), (100, [1.0], None)])).collect() == []
    assert mine(frame(spark, [(50, [1.0], 1)])).collect() == []


# 13
def decontaminated(rows, asked, width=10):
    out = collections.Counter()
    windows = []
    for item, text in asked:
        own = words(text)
        k = min(width, len(own))
        windows += [("" if item is None else str(item), tuple(own[i:i + k])) for i in range(len(own) - k + 1 if own else 0)]
    by = collections.defaultdict(set)
    for item, w in windows:
        by[w].add(item)
    sizes = {len(w) for w in by}
    for doc, text in rows:
        own = words(text)
        hit, items = set(), set()
        for k in sizes:
            for i in range(len(own) - k + 1):
                found = by.get(tuple(own[i:i + k]))
                if found:
                    hit.update(range(i, i + k))
                    items |= found
        out[doc, len(own), len(hit), len(items), tuple(sorted(items)), bool(hit)] += 1
    return out


@pytest.mark.parametrize("seed,segment,chars", [(1, 1 << 19, 4_000_000), (2, 50, 4_000_000), (3, 500, 60)])
def test_decontamination_against_every_window(spark, seed, segment, chars, monkeypatch):
    rows, asked = sample(seed, 150, 15)
    docs, items = frames(spark, rows, asked)
    monkeypatch.setattr(positional, "build", lambda d, build=positional.build: build(d, segment))
    monkeypatch.setattr(positional, "phrases", lambda i, t, w, phrases=positional.phrases: phrases(i, t, w, chars))
    got = positional.contamination(docs.repartition(3), items)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated"]
    assert collections.Counter((*r[:4], tuple(r[4]), r[5]) for r in got.collect()) == decontaminated(rows, asked)


def test_phrase_spans(spark):
    docs, items = frames(spark, [(1, "a b c d e b c d"), (2, "b c"), (3, "d b c d")], [(7, "B c, d"), (8, "e b")])
    got = positional.phrases(positional.build(docs), items)
    assert {r.doc_id: ([tuple(s) for s in r.spans], r["items"]) for r in got.collect()} == {
        1: ([(1, 4), (4, 6), (5, 8)], ["7", "8"]), 2: ([], []), 3: ([(1, 4)], ["7"])}


def near(rows, asked, within, width=10):
    """The shortest stretch around each occurrence of a window's rarest term, for single documents."""
    out = set()
    for doc, text in rows:
        own = words(text)
        count = collections.Counter(own)
        for item, query in asked:
            terms_ = words(query)
            k = min(width, len(terms_))
            seen = set()
            for at in range(len(terms_) - k + 1 if terms_ else 0):
                window = tuple(terms_[at:at + k])
                if window in seen or any(t not in count for t in window):
                    continue
                seen.add(window)
                rarest = min(set(window), key=lambda t: (count[t], t.encode()))
                for p, term in enumerate(own):
                    if term != rarest:
                        continue
                    fits = [
                        (b - a, a, b) for a in range(max(0, p - within + 1), p + 1)
                        for b in range(p + 1, min(len(own), a + within) + 1) if set(window) <= set(own[a:b])]
                    if fits:
                        _, a, b = min(fits)
                        out.add((doc, item, at, a, b))
    return out


def test_proximity_against_every_stretch(spark):
    rng = random.Random(9)
    some = [f"w{i}" for i in range(14)]
    rows = [(i, " ".join(rng.choices(some, k=rng.randint(0, 60)))) for i in range(25)]
    asked = [(1, "w1 w2 w3"), (2, "w5 w5 w9 w0"), (3, " ".join(rng.choices(some, k=13))), (None, "w13")]
    docs, items = frames(spark, rows, asked)
    # One document to a segment: the rarest term of a segment is then that of the document.
    got = positional.proximity(positional.build(docs, 1), items, within=8)
    assert {tuple(r) for r in got.collect()} == near(rows, asked, 8)
    # Stretches never reach over the end of a document.
    whole = positional.proximity(positional.build(docs), items, within=8)
    sizes = {i: len(words(t)) for i, t in rows}
    assert whole.count() > 0 and all(0 <= r.first < r.end <= sizes[r.doc_id] for r in whole.collect())


def test_decontamination_of_empty_tables(spark):
    rows, asked = sample(4, 5, 3)
    docs, items = frames(spark, rows, asked)
    none, nothing = frames(spark, [], [])
    assert positional.contamination(none, items).collect() == []
    clean = positional.contamination(docs, nothing).collect()
    assert len(clean) == len(rows) and not any(r.contaminated or r.n_hit for r in clean)
    assert positional.proximity(positional.build(none), items).collect() == []


def test_terms_follow_their_pattern():
    every = "".join(map(chr, range(0x250))) + "aB9_-é日 z"
    assert [t.decode() for t in terms.terms_of(every.encode())] == words(every)
