"""Each operator on odd rows, an empty table, and against a plain version."""

import collections
import math
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from noticeworks.llm import classify, divergence, licenses, linedup, lm, mix, packing, partenum, tokenfiles, topk

SF = "/root/testdata/sf0.001"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("size", T.StringType()), T.StructField("Target", T.StringType()), T.StructField("label", T.StringType())])

PROSE = "the rain in the valley was cold and of the kind that a farmer would know for days on end as it fell"
LONG = " ".join(f"word{i} of the {PROSE}" for i in range(400))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", None, "y")


ODD = [
    row(1, PROSE + " Licensed under the MIT License."), row(2, PROSE), row(2, PROSE), row(3, None), row(4, ""), row(5, " \n\t "),
    row(6, LONG), row(7, LONG + " end"), row(None, "a row without an id, of the mit licence"), row(8, PROSE, None, None),
    row(9, "one"), row(10, "é ü ñ 日本 don't <|endoftext|> x"), row(11, "same line\nsame line\nsame line"),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


def vocabulary(name):
    return pytest.importorskip("public_tokenizers").path(name)


def rows(df):
    return [r.asDict() for r in df.collect()]


rows_of = rows


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


def words(text):
    return (text or "").encode().translate(LOWER).split()


# 1
def test_mix_meets_targets(documents):
    got = rows(mix.mix(documents).join(documents.select("doc_id", "source"), "doc_id"))
    by = collections.defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert math.isclose(sum(v[0]["target"] for v in by.values()), 1.5 * sum(r["size"] for r in got), rel_tol=1e-9)
    for source, part in by.items():
        assert abs(sum(r["taken"] for r in part) - part[0]["target"]) <= max(r["size"] for r in part)
        assert part[0]["target"] <= 2 * part[0]["source_size"] + 1e-6
    again = {(r["doc_id"], r["taken"]) for r in rows(mix.mix(documents.repartition(3)))}
    assert again == {(r["doc_id"], r["taken"]) for r in got}


def test_mix_odd(odd, empty):
    got = rows(mix.mix(odd))
    assert len(got) == odd.count()
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mix.mix(empty).count() == 0
    assert mix.mixed(odd).columns == odd.columns


def test_mix_comes_near_every_target(spark):
    """Within 1 % or the smallest documents, though the sizes of a source differ a thousandfold."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    by = collections.defaultdict(list)
    for r in rows(mix.mix(docs).join(docs.select("doc_id", "source"), "doc_id")):
        by[r["source"]].append(r)
    for part in by.values():
        off = abs(sum(r["taken"] for r in part) - part[0]["target"])
        assert off <= max(0.01 * part[0]["target"], sorted(r["size"] for r in part)[min(2, len(part) - 1)])


def test_mix_keeps_expectations():
    """Over many draws documents are taken as often as their fractions say, and each draw keeps the sum."""
    import numpy as np
    import pyarrow as pa

    size, x = list(range(1, 201)), [0.3] * 200
    table = pa.table({"part": [0] * 200, "doc_id": list(range(200)), "size": size, "tie": [0] * 200, "x": x})
    drawn = [mix._pivot((pa.scalar(i), pa.scalar(0)), table).column("x").to_numpy() for i in range(600)]
    assert all(((d > 0) & (d < 1)).sum() <= 1 and abs(d @ np.sort(size)[::-1] - np.dot(x, size)) < 1e-6 for d in drawn)
    assert np.abs(np.mean(drawn, axis=0) - 0.3)[:170].max() < 0.09


def test_mix_deals_equal_rows(spark):
    """5,000 equal rows, of a null source and without an id, in several blocks; half of them are taken twice."""
    docs = spark.range(5000).selectExpr(
        "CAST(NULL AS LONG) AS doc_id", "CAST(NULL AS STRING) AS source", "'two words' AS text").unionByName(
        spark.createDataFrame([(1, "a", "one")], "doc_id long, source string, text string"))
    sizes = []
    pivot = mix.rounded
    try:
        mix.rounded = lambda part, blocks: sizes.extend(r["count"] for r in rows(part.groupBy("place", "part").count())) or pivot(part, blocks)
        got = rows(mix.mix(docs, total=1.5))
    finally:
        mix.rounded = pivot
    assert len(sizes) == 5 and max(sizes) < 1300
    taken = collections.Counter(r["taken"] for r in got if r["doc_id"] is None)
    target = next(r["target"] for r in got if r["doc_id"] is None)
    assert set(taken) == {2, 4} and abs(2 * taken[2] + 4 * taken[4] - target) <= 2


# 2
def test_line_dedup(spark, odd, empty):
    pages = [(i, "a", f"own {i}\n menu ") for i in range(4)] + [(9, "b", "menu")]
    pages = spark.createDataFrame(pages, "doc_id long, source string, text string")
    got = rows(linedup.line_dedup(pages, percent=50, min_pages=3))
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in got} == {
        i: (2, 1, f"own {i}") for i in range(4)} | {9: (1, 0, "menu")}
    odd_rows = rows(linedup.line_dedup(odd))
    assert len(odd_rows) == odd.count() and [r["text"] for r in odd_rows if r["doc_id"] == 3] == [None]
    assert linedup.line_dedup(empty).count() == 0
    assert linedup.drop_boilerplate(odd).columns == odd.columns


# 3
def test_licenses(odd, empty):
    got = {r["doc_id"]: r for r in rows(licenses.scan(odd)) if r["doc_id"] != 2}
    assert (got[1]["base_labels"], got[1]["n_base"], got[1]["score"]) == ("mit", 1, 1.0)
    assert (got[3]["n_words"], got[3]["labels"], got[3]["first_word"]) == (0, "", None)
    assert licenses.scan(empty).count() == 0
    scanner = licenses.Scanner()
    found = scanner.scan("x Redistribution and use in sorce and binary forms, with or without modification, are permitted y")
    assert (found[5], found[7]) == ("bsd", [("bsd", 1, 14, 1)])
    assert scanner.scan("emit licenses permitted")[5] == ""


def test_every_bounded_error_is_found():
    scanner = licenses.Scanner([("mozilla public license", "mpl", 2)])
    for i in range(22):
        for j in range(i + 1, 22):
            text = list("mozilla public license")
            text[i], text[j] = "q", "q"
            assert scanner.scan("so " + "".join(text) + " it is")[5] == "mpl"


def test_notices_side_by_side_and_at_letters_beyond_ascii():
    scanner = licenses.Scanner()
    assert scanner.scan("mozilla public licence mozilla public license")[7] == [("mpl", 0, 2, 1), ("mpl", 3, 5, 0)]
    assert scanner.scan("mozilla public license mozilla public licence mozila public licence")[7] == [
        ("mpl", 0, 2, 0), ("mpl", 3, 5, 1), ("mpl", 6, 8, 2)]
    assert scanner.scan("cafémozilla public license")[5] == "" and scanner.scan("mozilla public licenseéé")[5] == ""
    text = "so " + "x " * 50000 + "all rights reserved " * 1000 + "y " * 50000
    assert len(scanner.scan(text)[7]) == 1000


# 4
def test_classifier(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in rows(classify.quality(docs, labels))}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    known = [(r.quality, got[r.doc_id]["predicted"]) for r in labels.collect() if got[r.doc_id]["held_out"]]
    assert sum(a == b for a, b in known) / len(known) > 0.95
    none = labels.where("false")
    assert {r["score"] for r in rows(classify.quality(odd, none))} == {0.5}
    assert classify.quality(empty, labels).count() == 0


# 5
def test_quality_measures(odd, empty):
    got = {r["doc_id"]: r for r in rows(divergence.quality_rules(odd))}
    assert (got[11]["n_dup_lines"], got[11]["n_words"], got[11]["n_repeat_words"]) == (2, 6, 0)  # its two 5-word windows differ
    assert got[3]["base_failed"] and got[3]["n_words"] == 0 and not got[3]["kept"]
    assert divergence.quality_rules(empty).count() == 0
    assert divergence.keep_good(odd).columns == odd.columns


def test_quality_rules_measure_every_text_once(spark, odd, monkeypatch):
    """The references come from the stored measures; the rows are those of references made apart."""
    profile, calls = divergence._profile, []
    monkeypatch.setattr(divergence, "_profile", lambda *a: calls.append(a) or profile(*a))
    got = divergence.quality_rules(odd)
    assert len(calls) == 1
    own = odd.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    want = divergence.judged(own, divergence.references(own), F.col("doc_id"))
    assert got.columns == want.columns
    assert sorted(map(repr, got.drop("class_distance", "word_distance").collect())) == sorted(
        map(repr, want.drop("class_distance", "word_distance").collect()))


# 6
def test_top_k_odd(spark):
    data = [(i, [((i * 7 + d * 3) % 11) / 10 - 0.5 for d in range(5)]) for i in range(0, 60)]
    data += [(100, None), (101, [1.0, None]), (102, [float("nan")]), (None, [1.0]), (103, []), (20, data[20][1]), (104, [0.5])]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(vectors, "vec_id % 20 = 0", k=7).collect()]
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in data if i is not None and v and all(x is not None and x == x for x in v)]
    want = []
    for q in {(i, tuple(v)) for i, v in whole if i % 20 == 0}:
        best = sorted((-sum(a * b for a, b in zip(q[1], v)), i) for i, v in whole if i != q[0])[:7]
        want += [(q[0], k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(got) == sorted(want)
    assert topk.top_k(vectors.where("false"), "vec_id % 20 = 0").count() == 0


# 7
def plain_components(texts):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    changed = True
    pairs = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in pairs:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_jaccard_components(documents, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(partenum.jaccard_components(documents))}
    assert got == plain_components(texts)


def test_jaccard_odd(odd, empty):
    got = collections.defaultdict(set)
    for r in rows(partenum.jaccard_components(odd)):
        got[r["doc_id"]].add(r["component_id"])
    assert got[7] == {6} and got[2] == {1} and got[8] == {1} and got[3] == {3} and got[5] == {5}
    kept = [r["doc_id"] for r in rows(partenum.one_of_each(odd))]
    assert kept.count(1) == 1 and not {2, 7, 8} & set(kept) and {3, 4, 5, 6, 9, None} <= set(kept)
    assert partenum.jaccard_components(empty).count() == 0 and partenum.one_of_each(empty).count() == 0


def test_similar_sets_share_a_signature():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 5, 15, 16, 17, 63, 64, 80, 257, 1100):
        for _ in range(20):
            base = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            same = -(-6 * n // 7)
            x, y = np.unique(base[:n]), np.unique(base[n - same:n + n // 7])
            inter = len(np.intersect1d(x, y))
            if 4 * inter >= 3 * (len(x) + len(y) - inter):
                frequent = np.sort(base[: n // 2])
                assert np.intersect1d(partenum.signatures(x, frequent), partenum.signatures(y, frequent)).size


def near_copies(size, components):
    """A block of near copies as the join deals it: cls, n, label and sketches."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    base, sets = rng.integers(0, 1 << 63, 200, dtype=np.uint64), []
    for _ in range(size):
        copy = base.copy()
        copy[rng.choice(200, 10, replace=False)] = rng.integers(0, 1 << 63, 10, dtype=np.uint64)
        sets.append(np.unique(copy))
    cls = rng.permutation(7 * size)[:size].astype(np.int64)
    label = cls[rng.integers(0, components, size)] if components else cls
    return cls, np.array([len(x) for x in sets], np.int32), label, pa.array([partenum.sketch(x) for x in sets], pa.binary())


def test_a_block_of_near_copies_takes_the_memory_of_a_strip():
    import tracemalloc

    block = near_copies(2000, None)
    tracemalloc.start()
    found = sum(len(x) for x, _ in partenum._near(*block, partenum.NEAREST))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == partenum.NEAREST * 2000 and peak < 80e6


@pytest.mark.parametrize("components", [None, 4])
@pytest.mark.parametrize("nearest", [partenum.NEAREST, None])
def test_strips_find_the_pairs_of_the_whole_block(monkeypatch, components, nearest):
    def pairs():
        return {(min(p), max(p)) for x, y in partenum._near(*block, nearest) for p in zip(x.tolist(), y.tolist())}

    block = near_copies(150, components)
    whole = pairs()
    monkeypatch.setattr(partenum, "STRIP", 700)
    assert whole and pairs() == whole


def near_texts(copies, each):
    """Texts of 120 words in families; the copies of a family differ in two words."""
    return {
        100 * f + c + 1: " ".join(f"w{f}x{i}" if i not in (10, 60 + 3 * c) else f"z{f}x{c}x{i}" for i in range(120))
        for f in range(copies) for c in range(each)}


@pytest.mark.parametrize(("each", "times"), [(2, 1), (9, 2)])
def test_groups_whose_pairs_were_written_whole_do_not_come_back(spark, monkeypatch, each, times):
    rounds, candidates = [], partenum._candidates
    monkeypatch.setattr(partenum, "_candidates", lambda *given: rounds.append(1) or candidates(*given))
    texts = near_texts(4, each)
    found = rows(partenum.jaccard_components(spark.createDataFrame([row(*t) for t in texts.items()], DOCS)))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == plain_components(texts)
    assert len(rounds) == times


def test_pairs_beyond_the_nearest_are_reported():
    block, cut = near_copies(150, None), []
    list(partenum._near(*block, partenum.NEAREST, lambda: cut.append(1)))
    assert cut
    for nearest in (150, None):
        cut.clear()
        assert sum(len(x) for x, _ in partenum._near(*block, nearest, lambda: cut.append(1))) >= 150 * 149 // 2 and not cut


def test_written_tables_leave_no_shuffle_files(spark, documents, monkeypatch):
    import os
    import time

    folders = [str(x) for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    left, write = [], partenum.stored_alone

    def files():
        return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    def watched(df, name):
        before, end = files(), time.time() + 10
        out = write(df, name)
        while files() - before and time.time() < end:  # Spark removes them in the background
            time.sleep(0.1)
        left.append((name, files() - before))
        return out

    monkeypatch.setattr(partenum, "stored_alone", watched)
    partenum.jaccard_components(documents)
    assert {"shingled", "groups", "pairs", "sets", "links", "near"} <= {n for n, _ in left} and not any(f for _, f in left)


# 8
def test_packing(documents, texts):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    check_packing(rows(packing.pack(documents, path)), {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()})


def check_packing(got, ids):
    import struct

    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part)) and r["doc_tokens"] == len(ids[r["doc_id"]])
    for key, parts, size in [(d, p, len(ids[d])) for d, p in pieces.items()]:
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["length"]
        assert at == size
    assert set(pieces) == set(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == 2048 or at & (at - 1) == 0 and at < 2048


def test_packing_odd(odd, empty):
    got = rows(packing.pack(odd, vocabulary("word_bpe_49k.json"), segments=3))
    per = collections.Counter(r["sequence_id"] for r in got)
    assert max(per.values()) <= 3 and packing.pack(empty, vocabulary("word_bpe_49k.json")).count() == 0
    assert sum(r["length"] for r in got if r["doc_id"] == 3) == 1


def packed(sizes, prompts=None, **limits):
    """Sequences of a packer; checks that every token lies in one piece and that all limits hold."""
    out = []
    packer = packing.Packer(lambda pieces: out.append(list(pieces)), **limits)
    for i, n in enumerate(sizes):
        packer.add(i, n, prompts[i] if prompts else 0)
        if packer.tokens >= packing.POOL:
            packer.pack()
    packer.pack(last=True)
    at = collections.defaultdict(list)
    for pieces in out:
        n = sum(e - s for _, s, e in pieces)
        assert n == 2048 or n < 2048 and n & (n - 1) == 0
        assert len(pieces) <= limits.get("segments", packing.SEGMENTS)
        assert sum(packer._loss(*p) for p in pieces) <= (limits.get("loss") or 2048)
        for doc, start, end in pieces:
            at[doc].append((start, end))
    for i, n in enumerate(sizes):
        spans = sorted(at[i])
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    return out


def test_packing_keeps_all_limits():
    import random

    draw = random.Random(3)
    sizes = [draw.choice([1, 7, 300, draw.randrange(1, 2500), 9000]) for _ in range(600)]
    prompts = [draw.randrange(n + 1) for n in sizes]
    plain = packed(sizes)
    assert sum(sum(e - s for _, s, e in p) == 2048 for p in plain) == sum(sizes) // 2048
    packed(sizes, loss=1500)
    packed(sizes, prompts, loss=700)
    packed(sizes, prompts, loss=700, segments=4)


def test_packing_many_tiny_documents():
    import time

    began = time.time()
    assert len(packed([10] * 200_000)) >= 200_000 * 10 // 2048 and time.time() - began < 30


# 9
def test_lm_scores(documents, texts):
    unigrams, bigrams = collections.Counter(), collections.Counter()
    for t in texts.values():
        unigrams.update(words(t))
        bigrams.update(zip(words(t), words(t)[1:]))
    total = sum(unigrams.values())
    for r in rows(lm.lm_scores(documents, order=2, min_count=2, own=True)):
        w, score = words(texts[r["doc_id"]]), 0.0
        for k, x in enumerate(w):
            seen = k and bigrams[w[k - 1], x] >= 2
            score += math.log(bigrams[w[k - 1], x] / unigrams[w[k - 1]]) if seen else math.log(unigrams[x] / total) + (math.log(0.4) if k else 0)
        assert r["n_words"] == len(w) and math.isclose(r["score"], score, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("own,min_count", [(False, 1), (True, 1), (False, 2)])
def test_lm_trigrams(documents, texts, own, min_count):
    """All n-grams of up to three words count, single ones too; a document's own only where asked for."""

    def counts(w):
        return collections.Counter(tuple(w[k:k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1))

    whole = collections.Counter()
    for t in texts.values():
        whole.update(counts(words(t)))
    total = sum(n for gram, n in whole.items() if len(gram) == 1)
    backed_off = 0
    for r in rows(lm.lm_scores(documents, min_count=min_count, own=own)):
        w, score, full = words(texts[r["doc_id"]]), 0.0, 0
        mine = collections.Counter() if own else counts(w)
        count = lambda gram: whole[gram] - mine[gram]
        for k in range(len(w)):
            for n in range(min(3, k + 1), 0, -1):
                gram, dropped = tuple(w[k + 1 - n:k + 1]), (min(3, k + 1) - n) * math.log(0.4)
                if n == 1:
                    score += math.log(max(1, count(gram)) / total) + dropped
                elif count(gram) >= min_count:
                    score += math.log(count(gram) / count(gram[:-1])) + dropped
                    break
            full += n == 3
            backed_off += n < min(3, k + 1)
        assert (r["n_words"], r["n_full"]) == (len(w), full) and math.isclose(r["score"], score, rel_tol=1e-9, abs_tol=1e-9)
    assert bool(backed_off) != (own and min_count == 1)


def test_lm_rows_grow_with_ngrams(odd):
    """However many ranges of hashes there are, a block has no row for a range without its n-grams."""
    blocks = lm._blocks(odd.coalesce(1))
    few, many = (rows(lm._requests(blocks, 3, 52, n)) for n in (1, 1 << 31))
    grams = sum(len(lm._numbers(r["grams"], "u8")) for r in few)
    assert len(few) == blocks.count() and grams * 0.9 < len(many) <= grams


def test_lm_repeated_rows(spark):
    """Each of two equal rows is scored by the other; a text of its own backs off to unknown words."""
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "x y"), (3, None)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_full"], round(r["score"], 9)) for r in rows(lm.lm_scores(docs)))
    first, alone = round(math.log(1 / 10), 9), round(2 * math.log(1 / 10) + math.log(0.4), 9)
    assert got == [(1, 2, first), (1, 2, first), (2, 0, alone), (3, 0, 0.0)]


def test_lm_odd(odd, empty):
    got = rows(lm.lm_scores(odd))
    assert len(got) == odd.count() and all(r["score"] == 0 for r in got if r["n_words"] == 0)
    assert lm.lm_scores(empty).count() == 0


# 10
def test_token_files(spark, documents, texts, tmp_path):
    import struct

    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    tokenizer, start = Tokenizer.from_file(path), 0
    files = tokenfiles.write(documents, path, str(tmp_path))
    got = {r["doc_id"]: r for r in rows(tokenfiles.read(spark, files, str(tmp_path)))}
    for i in sorted(texts):
        ids = [*tokenizer.encode(texts[i], add_special_tokens=False).ids, 0]
        want = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == want
        start += len(ids)
    some = {r["doc_id"]: r for r in rows(tokenfiles.read(spark, files, str(tmp_path), {3, 77}))}
    assert some == {3: got[3], 77: got[77]}
    damaged = next(iter(tmp_path.glob("part-*")))
    data = bytearray(damaged.read_bytes())
    data[len(data) // 3] ^= 1
    damaged.write_bytes(bytes(data))
    with pytest.raises(Exception):
        tokenfiles.read(spark, files, str(tmp_path)).count() and tokenfiles.read(spark, files, str(tmp_path)).collect()


def test_rows_of_one_id_go_to_several_files(spark, tmp_path):
    """500 rows with one id, half of them with one text, and 500 without an id."""
    rows = [row(7, f"text {i}" if i % 2 else "same") for i in range(500)] + [row(None, f"other {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, DOCS).repartition(8)
    files = tokenfiles.write(docs, vocabulary("byte_bpe_50k.json"), str(tmp_path / "f"))
    sizes = sorted(r["n_documents"] for r in files.collect())
    assert len(sizes) == 4 and sizes[-1] < 500 and sum(sizes) == 1000
    got = sorted(rows_of(tokenfiles.read(spark, files, str(tmp_path / "f"))), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None] * 500 + [7] * 500
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))


def test_token_files_odd(odd, empty):
    path = vocabulary("byte_bpe_50k.json")
    got = rows(tokenfiles.round_trip(odd, path))
    assert len(got) == odd.count() and [r["n_tokens"] for r in got if r["doc_id"] in (3, 4)] == [1, 1]
    assert tokenfiles.round_trip(empty, path).count() == 0


@pytest.mark.parametrize("name,spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_pieces_are_exact(name, spaced):
    import numpy as np
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    from noticeworks.llm.tokens import Encoder

    path = vocabulary(name)
    encoder, tokenizer = Encoder(path, spaced), Tokenizer.from_file(path)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.sampled_from(list(" \n\t\r\x1c\xa0abTHE.,!'s12éÉß<|>Σς́日")), max_size=40))
    def same(text):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == want

    same()


# pipeline
def test_pipeline(spark, odd, empty):
    for docs in (odd, empty):
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if i < 4:
                assert out.columns == docs.columns
                docs = spark.createDataFrame(out.collect(), out.schema)
            else:
                out.collect()
