"""Hard negatives by angular triangle filtering.

Each row is stored with its norm and its angles to a few reference directions. For an anchor and a
row, the angles of both to one reference bound the angle between them: it is no less than their
difference and no more than their sum (or what the sum lacks to a full turn). All references
together give an interval of the cosine; norms turn it into bounds of the score, which are widened
beyond any rounding of the angles. Only rows whose interval overlaps what is looked for get an
integer score: for the positives, what reaches the lowest of the scores that the best rows are sure
of; for the negatives, the windows between half and 95 % of the positives' scores, above the last
negative that is already known in them. So the answer is exact, whatever the directions are.

Directions are rows far from each other, picked from a sample of ``SAMPLE`` rows (those with the
smallest hashes); only the amount of scoring depends on them. Anchors go to the tasks in blocks of
bounded size, rows stay where they are read, and a task hands on its few best rows of each anchor.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take
no part; components missing at the end of a shorter vector count as 0, and so does an empty vector;
equal anchors are one anchor (of anchors with one id and different values, each is one); rows with
the anchor's id are its own, neither positives nor negatives; other repeated rows count one by one;
ties go to the smaller id; empty tables give an empty table. Products must stay below 2^53.
"""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import columns, ranked, stored
from noticeworks.llm.terms import Parts, best

SCALE = 256          # components become floor(SCALE * x)
BLOCK = 2048         # anchors that go to the tasks at once
DIRECTIONS = 12
SAMPLE = 2000        # rows among which directions are picked
SLACK = 1e-6         # radians; stored angles are exact to about 3e-8
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _matrix(column, width: int):
    """The vectors of an Arrow column as rows of a matrix, zeros where they end early."""
    import numpy as np

    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy()
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width))
    cell = np.arange(width)[None, :] < lengths[:, None]
    out[cell] = flat[offsets[0]:offsets[-1]]
    return out


def _angles(matrix, norms, directions):
    """Angles of all rows to all directions; of a zero vector any angle will do."""
    import numpy as np

    cosine = (matrix @ directions.T) / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1))


def _directions(table: DataFrame, width: int):
    """Unit vectors of sampled rows, each far from those before it."""
    import numpy as np

    rows = table.select("numbers", F.xxhash64("vec_id", "numbers").alias("h")).orderBy("h", "numbers").limit(SAMPLE).collect()
    x = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        x[i, : len(r.numbers)] = r.numbers
    norms = np.linalg.norm(x, axis=1)
    x = x[norms > 0] / norms[norms > 0, None]
    chosen = []
    far = np.full(len(x), np.inf)
    for _ in range(min(DIRECTIONS, len(x))):
        i = int(np.argmax(far))
        chosen.append(x[i])
        far = np.minimum(far, 1 - x @ x[i])
    return np.array(chosen).reshape(len(chosen), width)


def with_angles(vectors: DataFrame, label: Column, scale: int = SCALE) -> tuple[DataFrame, int]:
    """The rows that take part: vec_id, label, numbers, norm and angles, stored; and the longest vector's length."""
    own = columns(vectors, "vec_id", "embedding", "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = own.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = stored(some.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("numbers")), "whole_numbers")
    width = whole.agg(F.max(F.size("numbers"))).first()[0] or 0
    shared = whole.sparkSession.sparkContext.broadcast(_directions(whole, width))

    def task(batches):
        import numpy as np
        import pyarrow as pa

        directions = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("numbers"), width)
            norms = np.linalg.norm(x, axis=1)
            angles = _angles(x, norms, directions)
            offsets = pa.array(np.arange(len(x) + 1) * len(directions), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norms), pa.ListArray.from_arrays(offsets, pa.array(angles.ravel()))],
                [*batch.schema.names, "norm", "angles"])

    schema = "vec_id long, label long, numbers array<long>, norm double, angles array<double>"
    return stored(whole.mapInArrow(task, schema), "angles"), width


class Rows:
    """A batch of rows with what bounds their scores."""

    def __init__(self, batch, width: int):
        import numpy as np

        self.ids = batch.column("vec_id").to_numpy()
        self.label = batch.column("label").to_numpy()
        self.norm = batch.column("norm").to_numpy()
        column = batch.column("angles")
        self.angles = np.ascontiguousarray(column.values.to_numpy()[column.offsets[0].as_py():].reshape(len(self.ids), -1).T)
        self.numbers = _matrix(batch.column("numbers"), width)

    def bounds(self, anchor, rows):
        """Lower and upper bounds of the anchor's scores with the rows."""
        import numpy as np

        size = self.norm[rows] * anchor["norm"]
        if not len(self.angles):
            return -size - 1, size + 1
        theirs, own = self.angles[:, rows], anchor["angles"][:, None]
        least = np.maximum(np.abs(theirs - own).max(axis=0) - SLACK, 0)
        both = theirs + own
        most = np.minimum(np.minimum(both, 2 * np.pi - both).min(axis=0) + SLACK, np.pi)
        return size * np.cos(most) - size * SLACK - 1, size * np.cos(least) + size * SLACK + 1

    def scores(self, anchor, rows):
        import numpy as np

        return (self.numbers[rows] @ anchor["numbers"]).astype(np.int64)


def _first(ids, scores, k: int):
    import numpy as np

    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _anchors(block: list, width: int) -> list[dict]:
    import numpy as np

    out = []
    for r in block:
        numbers = np.zeros(width)
        numbers[: len(r.numbers)] = r.numbers
        out.append({"id": r.vec_id, "label": r.label, "numbers": numbers, "norm": r.norm, "angles": np.array(r.angles)})
    return out


def _positives(table: DataFrame, shared, width: int, k: int) -> DataFrame:
    def task(batches):
        import numpy as np
        import pyarrow as pa

        anchors = shared.value
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in anchors]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = Rows(batch, width)
            order = np.argsort(rows.label, kind="stable")
            labels = rows.label[order]
            for i, anchor in enumerate(anchors):
                same = order[np.searchsorted(labels, anchor["label"]):np.searchsorted(labels, anchor["label"], "right")]
                same = same[rows.ids[same] != anchor["id"]]
                if not len(same):
                    continue
                low, high = rows.bounds(anchor, same)
                need = -np.inf if len(same) < k else np.partition(low, -k)[-k]  # k rows are sure to reach it
                if len(found[i][0]) >= k:
                    need = max(need, found[i][1][-1])
                same = same[high >= need]
                ids, scores = np.append(found[i][0], rows.ids[same]), np.append(found[i][1], rows.scores(anchor, same))
                found[i] = _first(ids, scores, k)
        number = TaskContext.get().partitionId()
        for i, (ids, scores) in enumerate(found):
            if len(ids):
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array(np.full(len(ids), i, np.int32)), "vec_id": pa.array(ids), "score": pa.array(scores),
                    "task": pa.array(np.full(len(ids), number, np.int32))})

    rows = table.mapInArrow(task, "anchor int, vec_id long, score long, task int")
    return best(rows, ["anchor"], [F.desc("score"), F.col("vec_id")], k)


def _negatives(table: DataFrame, shared, wanted, width: int, k: int) -> DataFrame:
    """``wanted`` has, for each anchor, (place, positive_id, positive_score, lowest, highest)."""

    def task(batches):
        import numpy as np
        import pyarrow as pa

        anchors, windows = shared.value, wanted.value
        found = {(i, p[0]): (np.empty(0, np.int64), np.empty(0, np.int64)) for i, own in enumerate(windows) for p in own}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = Rows(batch, width)
            for i, anchor in enumerate(anchors):
                if not windows[i]:
                    continue
                other = np.flatnonzero((rows.label != anchor["label"]) & (rows.ids != anchor["id"]))
                low, high = rows.bounds(anchor, other)
                overlap = np.zeros(len(other), bool)
                for place, _, _, least, most in windows[i]:
                    known = found[i, place][1]
                    overlap |= (high >= (max(least, known[-1]) if len(known) >= k else least)) & (low <= most)
                other = other[overlap]
                if not len(other):
                    continue
                scores = rows.scores(anchor, other)
                for place, _, _, least, most in windows[i]:
                    inside = (scores >= least) & (scores <= most)
                    if inside.any():
                        ids, known = found[i, place]
                        found[i, place] = _first(
                            np.append(ids, rows.ids[other[inside]]), np.append(known, scores[inside]), k)
        number = TaskContext.get().partitionId()
        for i, own in enumerate(windows):
            for place, positive, score, _, _ in own:
                ids, scores = found[i, place]
                if len(ids):
                    n = len(ids)
                    yield pa.RecordBatch.from_pydict({
                        "anchor": pa.array(np.full(n, i, np.int32)), "place": pa.array(np.full(n, place, np.int32)),
                        "anchor_id": pa.array(np.full(n, anchors[i]["id"], np.int64)),
                        "positive_id": pa.array(np.full(n, positive, np.int64)),
                        "positive_score": pa.array(np.full(n, score, np.int64)),
                        "negative_id": pa.array(ids), "negative_score": pa.array(scores),
                        "task": pa.array(np.full(n, number, np.int32))})

    rows = table.mapInArrow(
        task, "anchor int, place int, anchor_id long, positive_id long, positive_score long, negative_id long, "
        "negative_score long, task int")
    return best(
        rows, ["anchor", "place"], [F.desc("negative_score"), F.col("negative_id")], k).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3,
    least_percent: int = 50, most_percent: int = 95, scale: int = SCALE, block: int = BLOCK,
) -> DataFrame:
    """The first negatives of each anchor and positive whose score lies in the window of percentages of the
    positive's score. ``is_anchor`` and ``label`` are expressions over vec_id and label."""
    spark = vectors.sparkSession
    table, width = with_angles(vectors, label, scale)
    anchors = table.where(is_anchor).distinct()
    placed = stored(ranked(anchors, [F.col("vec_id"), F.xxhash64("label", "numbers")], "place"), "anchors")
    count = placed.count()
    out = Parts(spark, "negatives")
    for start in range(0, count, block):
        own = placed.where((F.col("place") >= start) & (F.col("place") < start + block)).orderBy("place").collect()
        shared = spark.sparkContext.broadcast(_anchors(own, width))
        wanted: list[list] = [[] for _ in own]
        for r in _positives(table, shared, width, positives).orderBy("anchor", "rank").collect():  # a few per anchor
            least, most = -(-least_percent * r.score // 100), most_percent * r.score // 100
            if least <= most:
                wanted[r.anchor].append((r["rank"], r.vec_id, r.score, least, most))
        out.add(_negatives(table, shared, spark.sparkContext.broadcast(wanted), width, negatives))
    return out.read(SCHEMA)
