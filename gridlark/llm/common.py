"""Shared helpers of the training-data operators: scratch tables, Arrow streaming, components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and SQL character class of the separators between words: \x20 and \x09-\x0D.
SPACE_CLASS = r"[ \t-\r]"
WORD_CLASS = r"[^ \t-\r]"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """URI of the folder all executors share, from ``spark.checkpoint.dir``.

    Only where that is unset (single-machine tests) a temporary folder is made, and removed at exit.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        local = tempfile.mkdtemp(prefix="gridlark-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        root = f"file://{local}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Scratch:
    """Written tables in the shared folder. They cut lineage, and an executor that is lost takes none of them along."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/gridlark/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        # Shuffle files go as soon as the table is written, not when the driver happens to collect its garbage.
        before = self.spark.conf.get(SHUFFLE_CLEANUP, "false")
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._gridlark_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Deletes a saved table that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._gridlark_path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch to parts of about ``limit`` bytes of ``column``, a row at least each."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The strings of a column; a null is the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a column; a null is the empty text."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys in batches sorted by these keys; a run may cross batches."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[lo] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


class UnionFind:
    """Disjoint sets over 0..n-1 whose root is the smallest member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of a batch's edges: each node but the roots, with its root (the smallest node)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        sets = UnionFind(len(nodes))
        for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
            sets.union(x, y)
        root = np.fromiter((sets.find(i) for i in range(len(nodes))), np.int64, len(nodes))
        keep = root != np.arange(len(nodes))
        yield pa.record_batch([pa.array(nodes[keep]), pa.array(nodes[root[keep]])], names=["a", "b"])


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: ``(node, component)``, without nodes that have no edge.

    The component is the smallest node. Alternating large-star and small-star rounds (Kiveris et al., 2014) after a
    contraction within each batch; each round is written to the shared folder. Aggregates combine before the shuffle, and
    adaptive execution splits the joins of a hub. Nothing is gathered on the driver but a count and a checksum a round.
    """
    seen = None
    now = scratch.save(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(_contract, "a long, b long"), "edges")
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b"), F.col("b")).distinct())
        seen = mark
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least)
        after = scratch.save(small.mapInArrow(_contract, "a long, b long").distinct(), "edges")
        scratch.drop(now)
        now = after
