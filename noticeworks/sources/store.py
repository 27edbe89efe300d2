"""Keyed tables: bucketed, sorted Parquet (ORC for vectors), one folder per write, one small pointer per version.

Notices and their vectors are two tables with the same buckets of the notice key; job states are a
table of their own. A version is registered with the session's catalog as a bucketed table, so merges, write-backs and look-ups by
key read the stored side bucket by bucket: it is neither shuffled nor sorted, only the batch is. A
write rewrites the buckets that its batch touches, of the table it changes, into a new folder and
then adds the next pointer, which lists the folder and a few counts of every bucket. Readers see the
old or the new state, and a lost executor (or driver) leaves the table as it was.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from noticeworks import model as M
from noticeworks.operators import merge, metrics
from noticeworks.session import file_system, read_text

_POINTER = "_pointer"


class BucketedTable:
    """One or more tables with one key below ``path``. ``buckets`` and ``formats`` are fixed when they are created.

    ``formats`` names the file format of the tables that are not Parquet.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: list[str], schemas: dict[str, str], buckets: int = 64,
        formats: dict[str, str] | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.schemas = schemas
        state = self._load()
        self.buckets = state["buckets"] if state else buckets
        self.formats = state.get("formats", {}) if state else formats or {}

    # A pointer holds {table: {bucket: folder and counts}}: its size depends on the bucket count only.
    def _place(self, name: str):
        jvm, fs = file_system(self.spark, self.path)
        return fs, jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _versions(self) -> list[int]:
        fs, folder = self._place(_POINTER)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def _load(self) -> dict | None:
        versions = self._versions()
        return self._at(versions[-1]) | {"version": versions[-1]} if versions else None

    def _at(self, version: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/{_POINTER}/{version}"))

    def _draft(self, state: dict):
        fs, draft = self._place(f"_draft-{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        return fs, draft

    def _save(self, state: dict, version: int) -> bool:
        """Add the pointer of a version, whole and only if there is none; false if there is.

        Each way is a single step that fails where the name is taken, with no look beforehand: a
        hard link on local disks, a conditional create on object stores that offer it, and elsewhere
        (HDFS) a rename, which never replaces a file there.
        """
        fs, target = self._place(f"{_POINTER}/{version}")
        fs.mkdirs(target.getParent())
        fs, draft = self._draft(state)
        jvm = self.spark.sparkContext._jvm
        conditional = "fs.option.create.conditional.overwrite"
        try:
            if fs.getScheme() == "file":
                local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
                jvm.java.nio.file.Files.createLink(local(target), local(draft))
                return True
            if fs.hasPathCapability(target, conditional):
                out = fs.createFile(target).overwrite(False).opt(conditional, True).build()
                out.write(bytearray(json.dumps(state).encode()))
                out.close()
                return True
            return fs.rename(draft, target)
        except Exception as taken:
            if "AlreadyExists" in str(taken):
                return False
            raise
        finally:
            fs.delete(draft, False)

    def _bucket(self) -> Column:
        """The bucket that Spark's own bucketing gives a key."""
        return F.pmod(F.hash(*self.key), F.lit(self.buckets)).cast("int")

    def _format(self, kind: str) -> str:
        return self.formats.get(kind, "parquet")

    def _stats(self, kind: str) -> list[Column]:
        """What a pointer keeps of a bucket beside its folder."""
        return [F.count("*").alias("rows")]

    def _scan(self, state: dict | None, kind: str, wanted: list[int] | None = None) -> DataFrame:
        """A table of a version, or those of its buckets that are wanted."""
        parts = (state or {}).get(kind, {})
        if not parts:
            return self.spark.createDataFrame([], self.schemas[kind])
        folders = {int(b): p["folder"] for b, p in parts.items()}
        which = json.dumps([self.path, kind, sorted(folders.items())])
        name = f"{kind}_{hashlib.md5(which.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            key = ", ".join(self.key)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({self.schemas[kind]}, bucket INT) USING {self._format(kind)} PARTITIONED BY (bucket) "
                f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/none'")
            places = [f"PARTITION (bucket={b}) LOCATION '{self.path}/{f}/bucket={b}'" for b, f in sorted(folders.items())]
            for i in range(0, len(places), 1000):
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(places[i:i + 1000]))
        table = self.spark.table(name)
        return (table if wanted is None else table.where(F.col("bucket").isin(wanted))).drop("bucket")

    def _write(self, rows: DataFrame, kind: str, in_order: bool = False) -> dict:
        """Write rows to a new folder, one sorted file for each bucket; what the pointer keeps of them.

        ``in_order``: each task has the rows of one bucket, sorted by key. They are then written as they come.
        """
        folder, name = f"data/{uuid.uuid4().hex}", f"draft_{uuid.uuid4().hex}"
        writer = rows.withColumn("bucket", self._bucket()).write.partitionBy("bucket").bucketBy(self.buckets, *self.key)
        # Without concurrent writers Spark would sort them by bucket and lose the order of the keys.
        if not in_order or int(self.spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) < 1:
            writer = writer.sortBy(*self.key)
        writer.format(self._format(kind)).option("path", f"{self.path}/{folder}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay
        written = self.spark.read.format(self._format(kind)).schema(f"{self.schemas[kind]}, bucket INT").load(f"{self.path}/{folder}")
        stats = written.groupBy("bucket").agg(*self._stats(kind)).collect()  # <= buckets
        plain = lambda v: v.isoformat() if isinstance(v, dt.datetime) else v
        return {str(r["bucket"]): {"folder": folder} | {k: plain(v) for k, v in r.asDict().items() if k != "bucket"} for r in stats}

    def _commit(self, staged: DataFrame, kind: str, change, batch) -> None:
        """Rewrite the buckets of the staged rows with ``change`` and add the next pointer.

        Everything is computed from one pinned version. If another writer took the next version
        in the meantime, the change is computed anew from that writer's state.
        """
        sizes = dict(staged.groupBy(self._bucket().alias("bucket")).count().collect())  # <= buckets
        wanted = sorted(sizes)
        while wanted:
            state = self._load() or {"version": 0, "buckets": self.buckets, "formats": self.formats} | {k: {} for k in self.schemas}
            if self._holds(state, batch):
                return
            known = any(str(b) in state[kind] for b in wanted)
            new = staged if known else staged.repartition(self.buckets, *self.key)
            parts = self._write(change(state, self._scan(state, kind, wanted) if known else None, new, wanted), kind)
            if not parts:
                return
            if self._publish(state, kind, parts, batch, sum(sizes.values())):
                return

    def _publish(self, state: dict, kind: str, parts: dict, batch, rows: int) -> bool:
        """Add the pointer of the version after ``state``, with the rewritten buckets of a table and the
        rows of the batch; false, and the buckets are gone again, if another writer has taken that version."""
        self._mark(state)
        after = {k: v for k, v in state.items() if k not in ("version", "batch", "batch_rows")}
        after[kind] = state[kind] | parts
        if isinstance(batch, tuple):
            after["streams"] = state.get("streams", {}) | {batch[0]: batch[1]}
        elif batch:
            after |= {"batch": batch, "batch_rows": rows}
        if self._save(after, state["version"] + 1):
            return True
        self._delete(next(iter(parts.values()))["folder"])
        return False

    # A pointer names its own batch only. Its marker is written before the next pointer, so a batch
    # is known by its marker or, if it was the last one, by the pointer.
    def _marker(self, batch: str) -> str:
        return f"_batches/{hashlib.sha256(batch.encode()).hexdigest()}"

    def _mark(self, state: dict) -> None:
        if state.get("batch"):
            fs, marker = self._place(self._marker(state["batch"]))
            out = fs.create(marker, True)
            out.write(bytearray(str(state["batch_rows"]).encode()))
            out.close()

    def batch_rows(self, batch: str) -> int:
        """Rows (one per key) that a named batch brought; 0 for a batch that changed nothing."""
        state = self._load() or {}
        if state.get("batch") == batch:
            return state["batch_rows"]
        fs, marker = self._place(self._marker(batch))
        return int(read_text(self.spark, f"{self.path}/{self._marker(batch)}")) if fs.exists(marker) else 0

    def _holds(self, state: dict | None, batch) -> bool:
        """Whether the table has the batch: by name, or by the last number of its stream."""
        if not state or not batch:
            return False
        if isinstance(batch, tuple):
            return batch[1] <= state.get("streams", {}).get(batch[0], -1)
        if state.get("batch") == batch:
            return True
        fs, marker = self._place(self._marker(batch))
        return fs.exists(marker)

    def _delete(self, name: str) -> None:
        fs, place = self._place(name)
        fs.delete(place, True)

    def clean_up(self, keep: int = 2) -> int:
        """Delete data folders that none of the last ``keep`` versions uses, and left-over stages.

        Run it while nobody writes; readers of the kept versions are not disturbed. Returns the
        number of data folders that went.
        """
        kept = [self._at(v) for v in self._versions()[-keep:]]
        used = {p["folder"] for state in kept for kind in self.schemas for p in state[kind].values()}
        fs, data = self._place("data")
        names = [f"data/{s.getPath().getName()}" for s in fs.listStatus(data)] if fs.exists(data) else []
        gone = [n for n in names if n not in used]
        for folder in [*gone, "staging"]:
            self._delete(folder)
        return len(gone)

    def _staged(self, rows: DataFrame, kind: str, change, batch) -> None:
        """Write a batch once below the table, since the bucket list and the merge both read it; then commit."""
        if self._holds(self._load(), batch):
            return
        stage = f"staging/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{stage}")
        self._commit(self.spark.read.schema(rows.schema).parquet(f"{self.path}/{stage}"), kind, change, batch)
        self._delete(stage)


class NoticeTable(BucketedTable):
    """The notice table: notices, and their vectors beside them."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        # The ORC writer takes a long array in half the time of the Parquet writer.
        super().__init__(
            spark, path, M.NOTICE_KEY, {"notices": M.STORED_SCHEMA, "vectors": M.VECTOR_SCHEMA}, buckets, {"vectors": "orc"})

    def _stats(self, kind: str) -> list[Column]:
        if kind == "vectors":
            return super()._stats(kind)
        return [
            *super()._stats(kind), F.count_if("detail_scraped").alias("detailed"),
            F.count_if(~F.col("detail_scraped")).alias("undetailed"), F.max("updated_at").alias("updated_at")]

    def notices(self) -> DataFrame:
        """The stored notices without their vectors."""
        return self._scan(self._load(), "notices")

    def vectors(self) -> DataFrame:
        return self._scan(self._load(), "vectors")

    def read(self) -> DataFrame:
        """The stored notices with their vectors, joined bucket by bucket."""
        state = self._load()
        return self._scan(state, "notices").join(self._scan(state, "vectors"), M.NOTICE_KEY, "left")

    def pending(self) -> DataFrame:
        """The notices without a vector; only the keys of the vectors are read."""
        return self._pending(self._load())

    def _pending(self, state: dict | None) -> DataFrame:
        return self._scan(state, "notices").join(self._scan(state, "vectors").select(*M.NOTICE_KEY), M.NOTICE_KEY, "left_anti")

    def status(self, crawl_enabled: bool = True) -> DataFrame:
        """The status metrics of the stored notices, from the counts that the pointer holds: no file is read."""
        state = self._load() or {}
        when = lambda t: dt.datetime.fromisoformat(t) if t else None
        rows = [(p["rows"], p["detailed"], p["undetailed"], when(p["updated_at"]), 0) for p in state.get("notices", {}).values()]
        rows += [(0, 0, 0, None, p["rows"]) for p in state.get("vectors", {}).values()]
        parts = self.spark.createDataFrame(
            rows, "rows bigint, detailed bigint, undetailed bigint, updated_at timestamp_ntz, embedded bigint")
        return metrics.status_of_parts(parts, crawl_enabled)

    def upsert(self, incoming: DataFrame, updated_at, batch: str | tuple[str, int] | None = None) -> None:
        """Upsert notice rows (any number per key; the last one by ``ingest_ord`` counts).

        ``batch`` names the write, by a name or by (stream id, batch number): a batch that is
        already in the table is skipped, which makes replays harmless. Names are kept for good, each
        in a marker of its own; of a stream the last number only.
        """
        columns = self.spark.createDataFrame([], self.schemas["notices"]).schema
        latest = merge.latest_per_key(incoming).drop("ingest_ord").withColumn(
            "updated_at", F.lit(updated_at).cast("timestamp_ntz"))

        def change(state, current, new, wanted):
            if current is not None:
                return merge.merge_notices(current, new)
            return new.select(*[F.col(f.name) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in columns])

        self._staged(latest, "notices", change, batch)

    def hold(self, rows: DataFrame, stream: str, number: int) -> None:
        """Leave the notice rows of a stream's batch beside the table, for ``take_held``; a replay replaces them."""
        if not self._holds(self._load(), (stream, number)):
            rows.write.mode("overwrite").parquet(f"{self.path}/held/{stream}/batch={number}")

    def take_held(self, stream: str, updated_at) -> None:
        """Upsert what the batches of a stream have left, as if one after the other, in one write."""
        fs, folder = self._place(f"held/{stream}")
        if not fs.exists(folder):
            return
        numbers = sorted(int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(folder))
        state = self._load()
        new = [n for n in numbers if not self._holds(state, (stream, n))]
        if new:
            rows = self.spark.read.option("basePath", f"{self.path}/held/{stream}").parquet(
                *[f"{self.path}/held/{stream}/batch={n}" for n in new])
            one = rows.drop("batch") if len(new) == 1 else merge.fold_batches(rows, "batch")
            self.upsert(one, updated_at, (stream, new[-1]))
        self._delete(f"held/{stream}")

    def insert_new(self, rows: DataFrame, updated_at, batch: str | tuple[str, int] | None = None) -> None:
        """Insert rows whose keys are not stored; a stored key would be updated, never doubled."""
        self.upsert(rows.withColumn("ingest_ord", F.lit(0)), updated_at, batch)

    def set_embeddings(self, vectors: DataFrame, batch: str | None = None) -> None:
        """Write vectors (ref_no, source, embedding; one row per key) back to their notices.

        Null vectors change nothing, and vectors of keys that are not stored are left out.
        """
        new = vectors.where(F.col("embedding").isNotNull()).select(*M.NOTICE_KEY, "embedding")

        def change(state, current, new, wanted):
            keys = self._scan(state, "notices", wanted).select(*M.NOTICE_KEY)
            known = new.join(keys, M.NOTICE_KEY, "left_semi")
            return known if current is None else merge.newer(current, known, M.NOTICE_KEY)

        self._staged(new, "vectors", change, batch)

    def embed_pending(self, choose, embed, batch: str | None = None, narrow: bool = False) -> None:
        """Vectors that ``embed`` makes for the pending notices that ``choose`` picks, written back in one pass.

        The notices are dealt out to their buckets before they get their vectors, so that no vector is
        staged or moved. ``narrow`` states that ``embed`` leaves every row in its task and place: then the
        notices are sorted before, too, instead of the vectors after. All of it is computed from one pinned version; if another writer took the next
        version in the meantime, the notices are chosen anew. Null vectors change nothing.
        """
        while (state := self._load()) and not self._holds(state, batch):
            chosen = choose(self._pending(state).dropna(subset=M.NOTICE_KEY))  # a null key is never found again
            wanted = sorted(r[0] for r in chosen.select(self._bucket()).distinct().collect())  # <= buckets
            if not wanted:
                return
            stored = [state["vectors"][str(b)]["rows"] for b in wanted if str(b) in state["vectors"]]
            if not stored:
                # By the bucket itself: a deal by key gives way to that of the stored notices, whose scan may then be split.
                chosen = chosen.repartitionById(self.buckets, self._bucket())
                chosen = chosen.sortWithinPartitions(*self.key) if narrow else chosen
            made = embed(chosen).where(F.col("embedding").isNotNull()).select(*M.NOTICE_KEY, "embedding")
            parts = self._write(
                merge.newer(self._scan(state, "vectors", wanted), made, M.NOTICE_KEY) if stored else made, "vectors",
                in_order=narrow and not stored)
            # A pending notice has no vector in that version, so each new row is one of this batch.
            rows = sum(p["rows"] for p in parts.values()) - sum(stored)
            if not rows:
                if parts:
                    self._delete(next(iter(parts.values()))["folder"])
                return
            if self._publish(state, "vectors", parts, batch, rows):
                return


class JobTable(BucketedTable):
    """States of crawl jobs: one row for each stretch of polls that a stream has followed."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        super().__init__(spark, path, ["job_id", "segment"], {"jobs": M.JOB_SCHEMA}, buckets)

    def put(self, rows: DataFrame, batch: tuple[str, int]) -> None:
        """Rows with their latest values, one per key."""
        self._staged(
            rows, "jobs",
            lambda state, current, new, wanted: new if current is None else merge.newer(current, new, self.key), batch)

    def segments(self) -> DataFrame:
        return self._scan(self._load(), "jobs")


def write_back(table: DataFrame, vectors: DataFrame, keys: list[str]) -> DataFrame:
    """The table with new vectors where there are any; rows and other columns stay."""
    new = vectors.select(*keys, F.col("embedding").alias("_new"))
    joined = table.join(new, keys, "left")
    return joined.withColumn("embedding", F.coalesce("_new", "embedding")).select(*table.columns)
