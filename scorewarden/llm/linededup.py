"""Drop lines that many documents share, with levelled sorted runs of line keys.

A run is a table of (line key, documents with it) in buckets sorted by key, the
same number of buckets for all runs. Each new batch is merge-anti-joined with the
runs, one after the other and without moving or sorting them: keys already known
to be frequent are not added again, the others form a new run of level 0. When a
level holds ``fanout`` runs they are compacted into one run of the next level.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewarden.llm.common import SPACE, settled, text_key
from scorewarden.storage import use_checkpoint_folder

#: Keys and texts of at least one in so many documents are hot.
HOT_SHARE = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ID, _TEXT = ["_a", "_b"], ["_k1", "_k2"]
_RUN = "_a long, _b long, documents long"
_COUNTS = ("_n_lines", "_n_dropped")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the session names for checkpoints."""
    use_checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


@contextmanager
def _sorted_scans(spark: SparkSession) -> Iterator[None]:
    """Plans made meanwhile take a bucket of one file as sorted, which it is by the way runs are written."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LineRuns:
    """Counted line keys of all batches so far, in levels of sorted runs.

    A run is a table with one sorted file per bucket, in a database of its own in the shared folder; ``drop`` removes it.
    The number of buckets is that of the shuffle partitions, so a batch is shuffled once, when it is added up. A key moves
    again only when its run is compacted, once per level.
    """

    def __init__(self, spark: SparkSession, *, least_documents: int = 10, fanout: int = 3, folder: str | None = None):
        self.spark, self.least, self.fanout = spark, least_documents, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = folder or shared_folder(spark, "line-runs")
        self.database = f"line_runs_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{self.folder}'")
        self.levels: list[list[str]] = []

    def _run(self, counts: DataFrame, level: int) -> str:
        name = f"level{level}_{uuid.uuid4().hex}"
        counts.write.format("parquet").bucketBy(self.buckets, *_ID).sortBy(*_ID).saveAsTable(f"{self.database}.{name}")
        return name

    def _added(self, runs: list[str]) -> DataFrame:
        # Read as plain files: Spark 4.1 takes a columnar union of bucketed tables as bucketed, but does not line the
        # buckets up, so that equal keys would not be added up.
        every = self.spark.read.schema(_RUN).parquet(*(f"{self.folder}/{name}" for name in runs))
        return every.groupBy(*_ID).agg(F.sum("documents").alias("documents")) if len(runs) > 1 else every

    def counts(self) -> DataFrame | None:
        """(key, documents) of every key over all runs; what came after a run knew a key as frequent is not counted."""
        runs = [run for level in self.levels for run in level]
        return self._added(runs) if runs else None

    def frequent(self) -> DataFrame | None:
        counts = self.counts()
        return None if counts is None else counts.where(F.col("documents") >= self.least).select(*_ID)

    def unknown(self, keys: DataFrame) -> DataFrame:
        """The added up keys of a batch without those that a run knows as frequent."""
        batch = keys.groupBy(*_ID).agg(F.sum("documents").alias("documents"))
        for name in (name for level in self.levels for name in level):
            run = self.spark.table(f"{self.database}.{name}")
            batch = batch.join(run.where(F.col("documents") >= self.least).select(*_ID).hint("merge"), _ID, "left_anti")
        return batch

    def add(self, keys: DataFrame) -> None:
        """Add a batch: rows of (_a, _b, documents), any number per key."""
        if not self.levels:
            self.levels.append([])
        with _sorted_scans(self.spark):
            self.levels[0].append(self._run(self.unknown(keys), 0))
            level = 0
            while len(self.levels[level]) >= self.fanout:
                runs, self.levels[level] = self.levels[level], []
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._run(self._added(runs), level + 1))
                level += 1

    def drop(self) -> None:
        """Remove the runs and their files; tables read from them must have been settled."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")
        self.levels = []


def drop_frequent_lines(
    docs: DataFrame, *, text: str = "text", least_documents: int = 10, least_chars: int = 1, batches: int = 4, fanout: int = 3,
) -> DataFrame:
    """The documents without lines whose key occurs in at least ``least_documents`` of them.

    Keeps all columns of ``docs``; ``text`` loses the lines, and ``_n_lines`` and ``_n_dropped`` count them. A key is the
    line without white space at its ends and with A-Z in lower case; keys under ``least_chars`` code points stay. A key
    counts once per document, and a repeated row is a document of its own. A null text is one empty line and comes back
    as an empty text. Other columns may have any name; ``_n_lines`` and ``_n_dropped`` are replaced. An empty table stays empty.

    Documents are told apart by a 128-bit key of their text: equal texts lose equal lines, so the lines of copies are
    looked up once, and what is brought to a text is the places of its lost lines. Texts of at least one document in
    HOT_SHARE get them in place, so that copies of one text do not meet in one task.
    """
    # each line is hashed once: _keys has the key and the place of every line that can be lost
    line_keys = F.transform(lines_of(F.col(text)), line_key)
    hashed = F.transform(line_keys, lambda k, i: F.struct(
        *text_key(k, *_ID), i.alias("_place"), (F.length(k) >= least_chars).alias("_long")))
    listed = F.transform(F.filter(hashed, lambda k: k["_long"]), lambda k: F.struct(k["_a"].alias("_a"), k["_b"].alias("_b"), k["_place"].alias("_place")))
    texts = settled(docs.select(*text_key(F.col(text)), listed.alias("_keys")).groupBy("_k1", "_k2").agg(
        F.first("_keys").alias("_keys"), F.count("*").alias("_copies")))
    runs = LineRuns(docs.sparkSession, least_documents=least_documents, fanout=fanout)
    once = F.array_distinct(F.transform("_keys", lambda k: F.struct(k["_a"].alias("_a"), k["_b"].alias("_b"))))
    for i in range(batches):
        part = texts.where(F.pmod("_k1", F.lit(batches)) == i)
        runs.add(part.select(F.explode(once).alias("_key"), "_copies").select("_key.*", F.col("_copies").alias("documents")))
    frequent = settled(runs.counts().where(F.col("documents") >= least_documents))
    runs.drop()
    total = texts.agg(F.sum("_copies")).first()[0] or 0
    # Keys of at least one document in HOT_SHARE: their number is at most HOT_SHARE times the mean number of keys of a
    # document. They are marked in place, so that the join by key moves no hot key.
    hot = frequent.where(F.col("documents") * HOT_SHARE >= total).select(*_ID, F.lit(True).alias("_hot"))
    placed = texts.select(*_TEXT, "_copies", F.explode("_keys").alias("_key")).select(*_TEXT, "_copies", "_key.*").join(F.broadcast(hot), _ID, "left")
    cold = placed.where("_hot is null").join(frequent.select(*_ID), _ID)
    hits = settled(placed.where("_hot").unionByName(cold.select(*placed.columns)).groupBy(*_TEXT).agg(
        F.first("_copies").alias("_copies"), F.collect_list("_place").alias("_bad")))
    # at most HOT_SHARE texts, with at most HOT_SHARE times the mean number of lines between them
    near = hits.where(F.col("_copies") * HOT_SHARE >= total).select(*_TEXT, F.col("_bad").alias("_near"))
    far = hits.where(F.col("_copies") * HOT_SHARE < total).select(F.col("_k1").alias("_by"), "_k2", F.col("_bad").alias("_far"))
    # the row travels as one value, so that no name of its columns can clash
    rows = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text"), *text_key(F.col(text))).join(F.broadcast(near), _TEXT, "left")
    spread = rows.withColumn("_by", F.when(F.col("_near").isNull(), F.col("_k1")).otherwise(F.xxhash64(F.monotonically_increasing_id())))
    joined = spread.join(far.hint("merge"), ["_by", "_k2"], "left").withColumn("_bad", F.coalesce("_near", "_far"))
    lines = joined.select("_row", "_bad", lines_of(F.col("_text")).alias("_lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_bad")
    good = F.when(F.col("_bad").isNull(), F.col("_lines")).otherwise(F.transform(places, lambda i: F.get("_lines", i)))
    return lines.select("_row", F.size("_lines").alias("_n"), good.alias("_good")).select(
        *(F.array_join("_good", "\n").alias(text) if c == text else F.col("_row")[c].alias(c) for c in docs.columns if c not in _COUNTS),
        F.col("_n").cast("long").alias(_COUNTS[0]), (F.col("_n") - F.size("_good")).cast("long").alias(_COUNTS[1]))
