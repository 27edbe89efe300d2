"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target: its share, by weight, of a total number of words; no target exceeds
``most`` times its source, and what is cut off is shared out again by weight. A document of a
source with target T and size S is wanted T / S times. The whole part is certain; the fractions
are rounded by the pivotal method, weighted by document size: two fractions exchange mass at
random until one of them is whole, which keeps the number of words of the two together and every
document's expectation. The partner of a document are the next smaller ones in its block, as
many as have the mass to make it whole; they move as one, each fraction along its distance to the
nearer whole number. So large documents are settled first and their mass is passed on to small
ones. A document that all smaller ones cannot balance goes to the nearer whole number, if they can
take the difference: the target comes before that document's odds. One small document at
most stays fractional in each block; these meet in the blocks of the next level of a tree, up to
one per source, which goes to the nearer whole number. The words taken from a source differ from
its target by half of that document at most. Documents are dealt into blocks by their hashes; of rows that are equal
more than ``FAN_IN`` times, also by their places in the files, so that no block is hot.

Defined results: a null text has size 0; documents of size 0 are taken as often as the whole part
says; a null source is a source of its own, ranked last; repeated rows are documents of their
own; sources of size 0 have target 0; an empty table gives an empty table. All draws depend on
the rows and the seed alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import SPACE_CLASS, SPACES, columns, numbered, place_of, ranked, stored

WEIGHTS = (3, 1, 2)   # of the sources in order, repeating
TOTAL = 1.5           # words wanted, as a share of all words
MOST = 2              # times a source may be taken at most
FAN_IN = 1024         # documents of a block, blocks of a block of the next level
SEED = 20


def size_of(text) -> F.Column:
    inner = F.btrim(text, F.lit(SPACES))
    words = F.size(F.split(inner, f"[{SPACE_CLASS}]+")).cast("long")
    return F.when(F.coalesce(inner, F.lit("")) == "", F.lit(0).cast("long")).otherwise(words)


def targets(sized: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """One row per source: name, place in code point order, source_size, n_documents, target."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_documents"))
    order = [F.col("source").isNull(), F.col("source")]
    placed = ranked(sums, order, "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = stored(placed.withColumn("weight", weight.cast("double")), "sources")
    wanted = total * (table.agg(F.sum("source_size")).first()[0] or 0)
    # The level that target = min(most * size, level * weight) must have. It only rises while sources
    # reach their limit; each round is one aggregate over the sources and brings three numbers here.
    level, full = 0.0, -1
    while True:
        at_limit = F.col("weight") * level > most * F.col("source_size")
        used, free, now = table.agg(
            F.sum(F.when(at_limit, most * F.col("source_size"))), F.sum(F.when(~at_limit, F.col("weight"))),
            F.count_if(at_limit)).first()
        if not free or now == full:
            break
        level, full = max(level, (wanted - (used or 0)) / free), now
    target = F.least(most * F.col("source_size").cast("double"), F.col("weight") * level)
    return table.select("source", "place", "source_size", "n_documents", target.alias("target"))


def _pivot(key, table):
    """Round the fractions x of one block; at most one stays fractional."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    order = [("size", "descending"), ("doc_id", "ascending"), ("tie", "ascending"), ("x", "ascending")]
    table = table.take(pc.sort_indices(table.select(["size", "doc_id", "tie", "x"]), order))
    x, w = table.column("x").to_numpy().copy(), table.column("size").to_numpy().astype(float)
    random = np.random.default_rng([SEED, *(k.as_py() for k in key), len(x)])
    for a in range(len(x) - 1):
        while 0 < x[a] < 1:
            n, need = 1, w[a] * max(x[a], 1 - x[a])
            while True:
                rest = x[a + 1:a + 1 + n]
                reach = np.minimum(rest, 1 - rest)     # how far each fraction can go both ways
                mass = float(w[a + 1:a + 1 + n] @ reach)
                if mass >= need or a + 1 + n >= len(x):
                    break
                n *= 2
            if mass < need:                            # too large to be balanced, whichever way it goes
                whole = round(x[a])
                over = (x[a] - whole) * w[a]
                room = 1 - rest if over > 0 else rest
                total = float(w[a + 1:] @ room)
                if total >= abs(over):
                    x[a], rest[:] = whole, np.clip(rest + room * (over / total if total else 0.0), 0.0, 1.0)
                    break
            if not mass:
                break
            up, down = min((1 - x[a]) * w[a], mass), min(x[a] * w[a], mass)
            give = -down if random.random() * (up + down) >= down else up
            x[a] = 1.0 if give == (1 - x[a]) * w[a] else 0.0 if -give == x[a] * w[a] else x[a] + give / w[a]
            rest -= reach * (give / mass)
            rest[rest < 1e-12] = 0.0
            rest[rest > 1 - 1e-12] = 1.0
    return table.set_column(table.column_names.index("x"), "x", pa.array(x))


def rounded(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows with fractions x of 0 or 1: ``rows`` has place, part, doc_id, size, tie, x and more.

    ``blocks`` is the largest number of blocks (part) of a source; a level of the tree divides it
    by the fan-in. What a level has settled is stored and not touched again.
    """
    done = []
    while True:
        level = stored(rows.groupBy("place", "part").applyInArrow(_pivot, rows.schema), "pivot_level")
        whole = (F.col("x") == 0) | (F.col("x") == 1)
        done.append(level.where(whole))
        rest = level.where(~whole)
        if blocks <= 1:
            break
        rows, blocks = rest.withColumn("part", F.floor(F.col("part") / FAN_IN)), -(-blocks // FAN_IN)
    done.append(rest.withColumn("x", F.round("x")))
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out


def copies(docs: DataFrame, *keep: str, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """``docs`` has doc_id, source, size, tie and ``keep``; adds source_size, target and copies."""
    table = targets(docs, weights, total, most)
    names = table.select(
        F.col("source").alias("source_name"), "place", "source_size", "target",
        F.ceil(F.col("n_documents") / FAN_IN).alias("parts"))
    both = docs.join(names, docs["source"].eqNullSafe(F.col("source_name")))
    wanted = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    # Rows are equal for the rounding if doc_id, text, size and source are; the aggregate counts them
    # in each task before the shuffle, and no more than one group in FAN_IN rows is left of it.
    many = docs.groupBy("source", "doc_id", "tie").count().where(F.col("count") > FAN_IN).select(
        F.col("source").alias("many_source"), F.col("doc_id").alias("many_id"), F.col("tie").alias("many_tie"), F.lit(1).alias("many"))
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("source", "many_source"), ("doc_id", "many_id"), ("tie", "many_tie"))]
    both = both.withColumn("place_in_files", F.monotonically_increasing_id()).join(many, same, "left")
    placed = both.select(
        *keep, "doc_id", "size", "tie", "place", "source_size", "target",
        F.floor(wanted).cast("long").alias("base"), (wanted - F.floor(wanted)).alias("x"),
        F.pmod(F.xxhash64("doc_id", "tie", F.when(F.col("many") == 1, F.col("place_in_files"))), F.col("parts")).alias("part"))
    split = (F.col("x") > 0) & (F.col("size") > 0)
    blocks = table.agg(F.max("n_documents")).first()[0] or 1
    settled = rounded(placed.where(split), -(-blocks // FAN_IN))
    both_kinds = settled.unionByName(placed.where(~split).withColumn("x", F.lit(0.0)))
    return both_kinds.select(
        *keep, "doc_id", "size", "source_size", "target", (F.col("base") + F.col("x").cast("long")).alias("copies"))


def mix(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and copies."""
    own = columns(docs, "doc_id", "source", "text")
    sized = own.select("doc_id", "source", size_of("text").alias("size"), F.xxhash64("text").alias("tie"))
    out = copies(sized, weights=weights, total=total, most=most)
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """The documents of the mix, all columns unchanged, each as often as it is taken."""
    plain = numbered(docs)
    text = place_of(docs, "text")
    sized = plain.select(
        F.struct(*plain.columns).alias("row_of_document"), place_of(docs, "doc_id").alias("doc_id"),
        place_of(docs, "source").alias("source"), size_of(text).alias("size"), F.xxhash64(text).alias("tie"))
    out = copies(sized, "row_of_document", weights=weights, total=total, most=most).where("copies > 0")
    again = out.select("row_of_document", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return again.select("row_of_document.*").toDF(*docs.columns)
