"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features are the words of a text in lower case and the pairs of neighbours, hashed into a table
of 2^20 weights; a text's feature values are its square roots of counts, scaled to length one, and
a bias. Training runs FTRL-proximal, which keeps weights of rare features at zero, over a sample
of labelled rows that is bounded by a parameter; shards of the sample are trained apart and their
weights averaged. Scoring is one pass over all documents: each text's weights are looked up and
summed, nothing is shuffled, and the model is broadcast at its fixed size.

Defined results: null and empty texts get the score of the bias; labels that are null or not 0 or
1 are not learnt from; documents with several labels are learnt from once per label; without any
labelled row all scores are one half; repeated rows get equal scores; empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import columns

BITS = 20                                  # the table has 2^20 weights: 4 MB are broadcast
SAMPLE = 12_000                            # labelled rows that training reads, about, at most
SHARD = 2_000                              # rows that are trained together; models are averaged
EPOCHS = 4
ALPHA, BETA, L1, L2 = 20.0, 1.0, 0.001, 0.0005   # rates and penalties of FTRL-proximal
CACHED_WORDS = 500_000

_SEPARATORS = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class Features:
    """Hashed indices and values of a text."""

    def __init__(self, bits: int = BITS):
        import xxhash

        class Words(dict):
            def __missing__(self, word):
                if len(self) >= CACHED_WORDS:
                    self.clear()
                self[word] = h = xxhash.xxh3_64_intdigest(word)
                return h

        self.words, self.bits = Words(), bits

    def of(self, text: str | None):
        import numpy as np

        words = (text or "").encode().translate(_SEPARATORS).split()
        shift = np.uint64(64 - self.bits)
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
        index, count = np.unique(np.r_[h * np.uint64(0x9E3779B97F4A7C15), pairs] >> shift, return_counts=True)
        values = np.sqrt(count)
        return index.astype(np.int64), values / max(1e-9, float(np.sqrt((values**2).sum())))


def trained(rows, bits: int = BITS, epochs: int = EPOCHS):
    """Weights and, last, the bias of FTRL-proximal over (index, values, label) rows."""
    import numpy as np

    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    rows = [(np.append(i, 1 << bits), np.append(v, 1.0), y) for i, v, y in rows]

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) > L1, w, 0.0)

    for epoch in range(epochs):
        for at in np.random.default_rng(epoch).permutation(len(rows)).tolist():
            i, v, y = rows[at]
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ v, -35, 35))) - y) * v
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(np.arange(len(z)))


def fit(labelled: DataFrame, sample: int = SAMPLE, bits: int = BITS):
    """The averaged weights. ``labelled`` has doc_id, text and label; at most about ``sample`` rows are read."""
    import numpy as np

    some = labelled.where(F.col("label").isin(0, 1)).select("doc_id", "label", "text")
    keys = some.agg(F.count("*")).first()[0]
    # Rows are drawn by the hash of their id, whatever the number of labelled rows.
    share = min(1.0, sample / max(1, keys))
    shards = max(1, -(-min(sample, keys) // SHARD))
    drawn = some.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    shard = F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(shards)).cast("int")

    def train(table):
        import pyarrow as pa

        features = Features(bits)
        order = sorted(zip(table.column("doc_id").to_pylist(), table.column("label").to_pylist(), table.column("text").to_pylist()),
                       key=lambda r: (r[0], r[1], r[2] or ""))
        rows = [(*features.of(t), y) for _, y, t in order]
        w = trained(rows, bits).astype("<f4")
        return pa.table({"weights": pa.array([w.tobytes()], pa.binary()), "n": pa.array([len(rows)], pa.int64())})

    models = drawn.withColumn("shard", shard).groupBy("shard").applyInArrow(train, "weights binary, n long").collect()
    if not models:
        return np.zeros((1 << bits) + 1, np.float32)
    total = sum(m.n for m in models)
    return sum(np.frombuffer(m.weights, "<f4").astype(float) * (m.n / total) for m in models).astype(np.float32)


def score(docs: DataFrame, weights, bits: int = BITS) -> DataFrame:
    """doc_id and score of every document; ``docs`` has doc_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches):
        import numpy as np
        import pyarrow as pa

        features, w = Features(bits), shared.value
        for batch in batches:
            out = []
            for text in batch.column("text"):
                i, v = features.of(text.as_py())
                out.append(float(w[i] @ v) + float(w[-1]))
            scores = 1 / (1 + np.exp(-np.clip(np.array(out), -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(task, f"doc_id {kind}, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted."""
    own = columns(docs, "doc_id", "text")
    marks = columns(labels, "doc_id", "quality").select(F.col("doc_id").alias("label_id"), F.col("quality").alias("label"))
    known = own.join(marks, F.col("doc_id") == F.col("label_id")).where(~held_out(F.col("doc_id")))
    out = score(own, fit(known.select("doc_id", "text", "label"), sample))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))
