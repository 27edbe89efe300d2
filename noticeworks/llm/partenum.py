"""N-gram Jaccard join with PartEnum signatures; near-duplicate components.

A document's set is its distinct five-word shingles. Sets of size a and b whose Jaccard
similarity is 3/4 or more differ in at most (a + b) / 7 shingles, which is a / 3 for either side.
Sets fall into size bands [L, 4L); a set near a band's lower end also takes part in the band
below, so similar sets share a band. In a band the domain of shingles is cut into 3L partitions;
the subsets that are enumerated are single partitions (n2 - k2 = 1), which five-word shingles
make selective enough. A signature is the partition with the projection of the set on it. At
most k = a / 3 of a set's signatures can be missing from a similar set, so in any common order
the first k + 1 signatures of two similar sets have one in common, and only those are written;
a set with no more than k of them writes one more that all such sets share. Signatures made of
frequent shingles alone come last in the order, which keeps shared passages from becoming
candidates; which shingles count as frequent never changes a result.

Sets that share a signature are held against each other in blocks by parity sketches, whose
distance never exceeds that of the sets, and what passes is verified on the sets. The first
round takes the nearest partners of every set, the second those in other components, the third
all pairs in different components that are left. Pairs inside a component need no check, and a
group whose pairs a round wrote whole does not come back in the next. Every table is written by a
job of its own whose shuffles go with it, so that one step's files at a time are on the disks.

Defined results: null, empty and blank texts have size 0 and are linked with nothing, each its
own component; ties of ids do not matter, equal sets are one class; repeated rows share their
component; null doc_ids are smaller than any id; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import columns, numbered, place_of, stored_alone

WORDS = 5                  # words of a shingle; the bound below is for a similarity of 3/4
BUCKET = 2_000_000         # signatures that meet in one task, about
CHUNK = 2048               # sets of a group that are held against each other at once
STRIP = 500_000            # pairs that are looked at, or written, at once
SAMPLE, OFTEN = 20_000, 8  # a shingle in this many of about so many sampled documents is frequent
NEAREST = 3                # partners of a set, or of a set in another component, in rounds 1 and 2
CACHED_WORDS = 500_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class Shingler:
    """Sorted 64-bit hashes of the distinct shingles of whole texts."""

    def __init__(self):
        import numpy as np
        import xxhash

        class Words(dict):
            def __missing__(self, word):
                if len(self) >= CACHED_WORDS:
                    self.clear()
                self[word] = h = xxhash.xxh3_64_intdigest(word)
                return h

        self.words = Words()
        self.factors = np.random.default_rng(5).integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, text: str | None):
        import numpy as np

        words = (text or "").encode().translate(_LOWER).split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        width = min(WORDS, len(h))
        n = len(h) - width + 1
        # The words' hashes are spread already: a sum with odd factors by place, mixed once, will do.
        total = np.full(n, width, np.uint64)
        for k in range(width):
            total += h[k:k + n] * self.factors[k]
        shingles = _mixed(total)
        shingles.sort()
        return shingles[np.r_[True, shingles[1:] != shingles[:-1]]]


def _mixed(x):
    """A bijection of 64-bit numbers that spreads their bits."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(shingles, frequent):
    """The signatures that a set writes. ``frequent``: sorted hashes of frequent shingles."""
    import numpy as np

    n = len(shingles)
    if n == 0:
        return np.empty(0, np.uint64)
    k = n // 3
    low = 1
    while 4 * low <= n:
        low *= 4
    out = []
    for band in [low] + ([low // 4] if low > 1 and 3 * n < 4 * low else []):
        part = _mixed(shingles ^ np.uint64(band)) % np.uint64(max(64, 3 * band))
        order = np.argsort(part, kind="stable")
        ordered = part[order]
        starts = np.r_[0, np.flatnonzero(ordered[1:] != ordered[:-1]) + 1]
        sums = np.add.reduceat(_mixed(shingles[order] + np.uint64(1)), starts)
        values = _mixed(sums + _mixed(ordered[starts] * np.uint64(2654435761) + np.uint64(band)))
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
            common = np.logical_and.reduceat((frequent[at] == shingles)[order], starts)
        else:
            common = np.zeros(len(values), bool)
        if len(values) > k:
            values = values[np.lexsort((values, common))[: k + 1]]
        else:
            values = np.append(values, _mixed(np.array([band], np.uint64)))
        out.append(values)
    return np.concatenate(out)


def sketch(shingles) -> bytes:
    """Parities of shingle counts in 2^j bits, at least two bits per shingle."""
    import numpy as np

    bits = 64
    while bits < 2 * len(shingles):
        bits *= 2
    counts = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _frequent(docs: DataFrame, rows: int):
    """Hashes of frequent shingles: at most SAMPLE / OFTEN times the size of a mean set."""
    import numpy as np

    step = max(1, rows // SAMPLE)
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0).select("text").distinct()

    def task(batches):
        import pyarrow as pa

        shingler = Shingler()
        for batch in batches:
            sets = [shingler.of(t) for t in batch.column("text").to_pylist()]
            if sets:
                yield pa.RecordBatch.from_pydict({"shingle": pa.array(np.concatenate(sets).view(np.int64))})

    counts = sample.mapInArrow(task, "shingle long").groupBy("shingle").count().where(F.col("count") >= OFTEN)
    found = stored_alone(counts.select("shingle"), "frequent").toPandas()["shingle"].to_numpy(np.int64).view(np.uint64)
    return np.sort(found)


def _first_pass(docs: DataFrame, frequent, buckets: int) -> DataFrame:
    """Rows of two kinds: documents with their class, and packed signatures of new classes."""
    schema = (
        "doc_id long, tie long, n long, cls long, sketch binary, "
        "bucket int, signatures binary, owners binary, sizes binary, counts binary")

    def task(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        arrow = pa.schema([
            ("doc_id", pa.int64()), ("tie", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("sketch", pa.binary()),
            ("bucket", pa.int32()), ("signatures", pa.binary()), ("owners", pa.binary()), ("sizes", pa.binary()), ("counts", pa.binary())])
        shingler, seen, waiting, held = Shingler(), set(), [], 0

        def packs():
            values = np.concatenate([v for _, _, v in waiting])
            place = np.repeat(np.arange(len(waiting)), [len(v) for _, _, v in waiting])
            bucket = (values >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            values, place, bucket = values[order].astype(np.uint32), place[order], bucket[order]
            owner = np.array([c for c, _, _ in waiting], np.int64)
            size = np.array([n for _, n, _ in waiting], np.int32)
            cuts = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)]
            out = {name: [] for name in ("bucket", "signatures", "owners", "sizes", "counts")}
            for a, b in zip(cuts[:-1], cuts[1:]):
                runs = np.r_[0, np.flatnonzero(place[a + 1:b] != place[a:b - 1]) + 1]
                who = place[a:b][runs]
                out["bucket"].append(int(bucket[a]))
                out["signatures"].append(values[a:b].tobytes())
                out["owners"].append(owner[who].tobytes())
                out["sizes"].append(size[who].tobytes())
                out["counts"].append(np.diff(np.r_[runs, b - a]).astype(np.int32).tobytes())
            n = len(out["bucket"])
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(out.get(f.name, [None] * n), f.type) for f in arrow], schema=arrow)

        for batch in batches:
            sizes, classes, sketches = [], [], []
            for text in batch.column("text"):
                shingles = shingler.of(text.as_py())
                cls = xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)
                new = len(shingles) > 0 and cls not in seen
                if new:
                    seen.add(cls)
                    waiting.append((cls, len(shingles), signatures(shingles, frequent)))
                    held += len(waiting[-1][2])
                sizes.append(len(shingles))
                classes.append(cls)
                sketches.append(sketch(shingles) if new else None)
            none = [None] * batch.num_rows
            given = {"doc_id": batch.column("doc_id"), "tie": batch.column("tie"), "n": sizes, "cls": classes, "sketch": sketches}
            yield pa.RecordBatch.from_arrays(
                [g if isinstance(g := given.get(f.name, none), pa.Array) else pa.array(g, f.type) for f in arrow], schema=arrow)
            if held >= 500_000:
                yield packs()
                held = 0
        if waiting:
            yield packs()

    return docs.select("doc_id", F.xxhash64("text").alias("tie"), "text").mapInArrow(task, schema)


def _groups(packed: DataFrame) -> DataFrame:
    """gid and members of the sets that share a signature, each list of members once."""

    def bucket(table):
        import numpy as np
        import pyarrow as pa
        import xxhash

        column = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])
        counts = column("counts", np.int32)
        values = column("signatures", np.uint32)
        place = np.repeat(np.arange(len(counts)), counts)
        owner, size = column("owners", np.int64)[place], column("sizes", np.int32)[place]
        order = np.lexsort((owner, values))
        values, owner, size = values[order], owner[order], size[order]
        new = np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])]
        values, owner, size = values[new], owner[new], size[new]
        starts = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1, len(values)]
        width = np.diff(starts)
        two = starts[:-1][width == 2]
        fits = 4 * np.minimum(size[two], size[two + 1]) >= 3 * np.maximum(size[two], size[two + 1])
        lists = {(a, b) for a, b in zip(owner[two[fits]].tolist(), owner[two[fits] + 1].tolist())}
        found = {xxhash.xxh3_64_intdigest(np.array(x, np.int64).tobytes()) - (1 << 63): list(x) for x in lists}
        for a, n in zip(starts[:-1][width > 2].tolist(), width[width > 2].tolist()):
            members = owner[a:a + n]
            found.setdefault(xxhash.xxh3_64_intdigest(members.tobytes()) - (1 << 63), members)
        return pa.Table.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))], ["gid", "members"])

    lists = packed.groupBy("bucket").applyInArrow(bucket, "gid long, members array<long>")
    return lists.groupBy("gid").agg(F.first("members").alias("members"))


def _candidates(groups: DataFrame, classes: DataFrame, labels: DataFrame | None, nearest: int | None) -> DataFrame:
    """Pairs of classes a < b in different components whose sketches allow a link.

    Rows without a pair name the groups of which ``nearest`` left pairs out.
    """
    members = groups.select(
        "gid", F.explode("members").alias("cls"), F.ceil(F.size("members") / CHUNK).cast("int").alias("chunks"))
    if labels is None:
        labelled = members.withColumn("label", F.col("cls"))
    else:
        named = members.join(labels, "cls", "left")
        labelled = named.withColumn("label", F.coalesce("label", "cls"))
        mixed = labelled.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        labelled = labelled.join(mixed.where("low < high").select("gid"), "gid", "left_semi")
    full = labelled.join(classes, "cls")
    # Large groups meet chunk by chunk: each pair of chunks is a task's work of its own.
    own = full.withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    dealt = own.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).select(
        "gid", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
        F.struct("cls", "n", "label", "sketch").alias("member"))
    blocks = dealt.groupBy("gid", "i", "j").agg(F.collect_list("member").alias("block")).select("gid", "block")

    def task(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found, held, cut = [], 0, []
            gids, column = batch.column("gid"), batch.column("block")
            offsets, flat = column.offsets.to_numpy(), column.values
            cls, n, label = (flat.field(f).to_numpy() for f in ("cls", "n", "label"))
            sketches = flat.field("sketch")
            for gid, a, b in zip(gids, offsets[:-1], offsets[1:]):
                for pair in _near(cls[a:b], n[a:b], label[a:b], sketches[int(a):int(b)], nearest, lambda: cut.append(gid)):
                    found.append(pair)
                    held += len(pair[0])
                    if held >= STRIP:
                        yield table(found)
                        found, held = [], 0
            if found:
                yield table(found)
            if cut:
                none = pa.nulls(len(cut), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array([g.as_py() for g in cut], pa.int64())], ["a", "b", "gid"])

    def table(found):
        import numpy as np
        import pyarrow as pa

        x, y = (np.concatenate(side) for side in zip(*found))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.nulls(len(x), pa.int64())], ["a", "b", "gid"])

    return blocks.mapInArrow(task, "a long, b long, gid long").distinct()


def _near(cls, n, label, sketches, nearest, on_cut=lambda: None):
    """Pairs of a block in different components that sizes and sketches allow, a strip of sets at a time.

    The memory is that of a strip, however many pairs the block has: where a block takes several
    strips, each set of a strip meets all others of the block, so that its nearest are known at once.
    ``on_cut`` is called for a strip of which pairs beyond the nearest are left out.
    """
    import numpy as np

    widths = np.array([len(s.as_py()) for s in sketches])
    least = int(widths.min())
    words = np.empty((len(cls), least // 8), np.uint64)
    for i, s in enumerate(sketches):
        bits = np.frombuffer(s.as_py(), np.uint64).reshape(-1, least // 8)
        words[i] = np.bitwise_xor.reduce(bits, axis=0)  # folded to the smallest: parities stay parities
    step = max(1, STRIP // len(cls))
    whole = nearest is not None and step < len(cls)
    goals = label if nearest and len(np.unique(label)) < len(label) else np.zeros(len(cls), np.int64)
    for first in range(0, len(cls), step):
        out = []
        for i in range(first, min(first + step, len(cls))):
            k = 0 if whole else i + 1
            far = np.bitwise_count(words[k:] ^ words[i]).sum(axis=1, dtype=np.int64)
            ok = (7 * far <= n[i] + n[k:]) & (label[k:] != label[i]) & (
                4 * np.minimum(n[i], n[k:]) >= 3 * np.maximum(n[i], n[k:]))
            j = np.flatnonzero(ok)
            if len(j):
                out.append((np.full(len(j), i), j + k, far[j]))
        if not out:
            continue
        x, y, far = (np.concatenate(part) for part in zip(*out))
        if nearest is not None and len(x) > nearest:
            if not whole:  # both directions
                x, y, far = np.r_[x, y], np.r_[y, x], np.r_[far, far]
            # The nearest partners of each set in each other component.
            order = np.lexsort((cls[y], far, goals[y], x))
            x, y = x[order], y[order]
            start = np.r_[0, np.flatnonzero((x[1:] != x[:-1]) | (goals[y[1:]] != goals[y[:-1]])) + 1]
            rank = np.arange(len(x)) - np.repeat(start, np.diff(np.r_[start, len(x)]))
            if (rank >= nearest).any():
                on_cut()
            x, y = x[rank < nearest], y[rank < nearest]
        yield cls[x], cls[y]


def _sets(docs: DataFrame, members: DataFrame, wanted: DataFrame) -> DataFrame:
    """cls and set of the wanted classes, from one document of each."""
    chosen = members.where("n > 0").join(wanted, "cls", "left_semi").groupBy("cls").agg(
        F.min(F.struct("doc_id", "tie")).alias("key"))
    # Written first, so that few keys are known to be few and no text is moved for them.
    keys = stored_alone(
        chosen.select(F.col("key.doc_id").alias("key_id"), F.col("key.tie").alias("key_tie")).distinct(), "keys")
    texts = docs.withColumn("tie", F.xxhash64("text")).join(
        keys, F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("tie") == F.col("key_tie"))).select("text")

    def task(batches):
        import pyarrow as pa
        import xxhash

        shingler = Shingler()
        for batch in batches:
            sets = [shingler.of(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "cls": pa.array([xxhash.xxh3_64_intdigest(s) - (1 << 63) for s in sets], pa.int64()),
                "shingles": pa.array(sets, pa.binary())})

    return texts.mapInArrow(task, "cls long, shingles binary").dropDuplicates(["cls"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets have a similarity of 3/4 or more."""
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b")

    def task(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= 75 * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(task, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """cls and label (the smallest cls reachable) of all linked classes, by alternating stars."""
    edges = stored_alone(links.where("a <> b").distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(
            F.struct(F.greatest("v", "m").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = stored_alone(small.where("a <> b").distinct(), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("a").alias("cls"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("cls"), F.col("b").alias("label"))).distinct()


def classes_of(docs: DataFrame) -> DataFrame:
    """doc_id, tie, n_shingles and label of every document; ``docs`` has doc_id and text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows, size = docs.agg(F.count("*"), F.sum(F.length("text"))).first()
    buckets = max(12, (size or 0) // 18 // BUCKET)  # about one signature for 18 characters
    first = stored_alone(_first_pass(docs, _frequent(docs, rows), buckets), "shingled")
    members = first.where("cls IS NOT NULL").select("doc_id", "tie", "n", "cls")
    sketches = first.where("sketch IS NOT NULL").groupBy("cls").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    packed = first.where("bucket IS NOT NULL").select("bucket", "signatures", "owners", "sizes", "counts")
    groups = stored_alone(_groups(packed), "groups")
    labels = None
    for nearest in (NEAREST, NEAREST, None):
        met = stored_alone(_candidates(groups, sketches, labels, nearest), "pairs")
        pairs, cut = met.where("a IS NOT NULL").select("a", "b"), met.where("a IS NULL").select("gid")
        wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
        found = _verified(pairs, stored_alone(_sets(docs, members, wanted), "sets"))
        known = found if labels is None else found.union(labels.select(F.col("cls"), F.col("label")))
        labels = stored_alone(components(known), "labels")
        if cut.isEmpty():
            break
        groups = groups.join(cut, "gid", "left_semi")
    return members.join(labels, "cls", "left").select(
        "doc_id", "tie", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("label", "cls")).alias("label"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    found = stored_alone(classes_of(columns(docs, "doc_id", "text")), "near")
    ids = found.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    both = found.join(ids, "label", "left")
    return both.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest doc_id."""
    found = stored_alone(classes_of(columns(docs, "doc_id", "text")), "near")
    one = found.where("label IS NOT NULL").groupBy("label").agg(F.min(F.struct("doc_id", "tie")).alias("key"))
    times = found.groupBy("doc_id", "tie").count()
    chosen = one.select(F.col("key.doc_id").alias("key_id"), F.col("key.tie").alias("key_tie"))
    keys = chosen.join(times, F.col("key_id").eqNullSafe(F.col("doc_id")) & (F.col("key_tie") == F.col("tie"))).select(
        "key_id", "key_tie", "count")
    plain = numbered(docs)
    text = F.coalesce(place_of(docs, "text"), F.lit(""))
    tied = plain.withColumn("tie_of_row", F.xxhash64(text))
    kept = tied.join(stored_alone(keys, "kept"), place_of(docs, "doc_id").eqNullSafe(F.col("key_id")) & (
        F.col("tie_of_row") == F.col("key_tie")))
    single = kept.where("count = 1").select(*plain.columns)
    several = kept.where("count > 1").dropDuplicates(["key_id", "key_tie"]).select(*plain.columns)
    blank = plain.where(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")) == "")
    return single.union(several).union(blank).toDF(*docs.columns)
