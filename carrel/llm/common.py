"""Small helpers the training-data operators share."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """Some columns by their exact names, whatever other columns are called (also in other case)."""
    places = {n: df.columns.index(n) for n in names}
    return df.toDF(*(f"c{k}" for k in range(len(df.columns)))).select(*(F.col(f"c{k}").alias(n) for n, k in places.items()))


def neutral(df: DataFrame, *names: str) -> DataFrame:
    """All columns; those not in ``names`` (or named twice) get names that no operator uses."""
    seen: set[str] = set()
    out = []
    for k, c in enumerate(df.columns):
        out.append(c if c in names and c not in seen else f"extra_column_{k}")
        seen.add(c)
    return df.toDF(*out)


def restored(df: DataFrame, like: DataFrame, *names: str) -> DataFrame:
    """The columns of ``like``, in its order and by its names, from a frame made out of neutral(like, *names)."""
    return df.select(*neutral(like, *names).columns).toDF(*like.columns)


def smallest(df: DataFrame, k: int, *keys: str, rows: int | None = None) -> DataFrame:
    """The k rows with the smallest hash of ``keys``: the same sample on every run and layout.

    A bound on the hash leaves about twice k rows before they are sorted, so that no task and no
    driver gets k rows of every partition.
    """
    n = df.count() if rows is None else rows
    h = F.xxhash64(*keys)
    if n > 4 * k + 400:
        df = df.where(h < F.lit(int(-(2**63) + 2**64 * (2 * k + 200) / n)))
    return df.orderBy(h, *keys).limit(k)


def pieces(batches: Iterator[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches by rows so that one piece holds about ``limit`` bytes (at least one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(limit * batch.num_rows / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def returned() -> None:
    """Give freed memory back to the system: Arrow's pool and the C heap keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: bytes of an Arrow batch between the JVM and a worker, where the session has Spark's own default
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def mapped(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """df.mapInArrow with batches of bounded bytes; a worker that stays alive holds little between tasks."""

    def run(batches):
        yield from work(batches)
        returned()

    conf = df.sparkSession.conf
    if conf.get(_BATCH) in ("64MB", str(64 << 20), f"{64 << 20}b"):
        conf.set(_BATCH, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [x or "" for x in batch.column(name).to_pylist()]


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; in local mode, where none is set, one of our own."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if context.getCheckpointDir() is None:
        if context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="carrel-"))
    return context.getCheckpointDir()


def _drop(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # noqa: BLE001  the session may have ended before the clean-up
        pass


#: the shuffle files of a query go when it ends, not when the driver happens to collect its garbage
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back; nothing else stays on disk of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANED, None)
    spark.conf.set(_CLEANED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANED) if before is None else spark.conf.set(_CLEANED, before)
    atexit.register(_drop, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete what written() wrote for ``df``, once nothing will read it any more."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        _drop(df.sparkSession, folder)


#: rows and bytes (as JSON) that a broadcast may have
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20


def small(df: DataFrame) -> DataFrame:
    """With the hint to broadcast, if the counted rows and bytes allow; else as it is, for a shuffled join."""
    rows, size = df.agg(F.count("*"), F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else df


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every vertex: (id, component).

    ``edges`` has columns a and b (same orderable type, no nulls). Alternates large-star and
    small-star steps, which keep the edge count at most as it was and need a number of rounds that
    grows with the logarithm of the longest chain. A very common vertex is a key of one
    aggregation with map-side minima and of one join that adaptive execution may split.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    pairs = written(pairs, "edges")
    marks = None
    for _ in range(rounds):
        # large star: every larger neighbour of v is linked to the smallest vertex around v
        both = pairs.select(F.col("hi").alias("v"), F.col("lo").alias("n")).union(pairs.select(F.col("lo"), F.col("hi")))
        least = both.groupBy("v").agg(F.min("n").alias("m")).select("v", F.least("m", "v").alias("m"))
        large = both.where("n > v").join(least, "v").select(F.col("n").alias("hi"), F.col("m").alias("lo")).distinct()
        # small star: v and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        linked = large.join(least, "hi")
        small = linked.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").union(least.select("hi", F.col("m")))
        before, pairs = pairs, written(small.distinct(), "stars")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
        settled = now == marks and before.exceptAll(pairs).isEmpty()
        dropped(before)
        if settled:
            break
        marks = now
    else:
        raise RuntimeError("the components did not settle")
    roots = pairs.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return pairs.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(roots)


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of consecutive rows with equal ``keys`` (no nulls), over batch boundaries."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(n, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        cuts = [0, *np.flatnonzero(new).tolist(), n]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if held and not (k == 0 and first == last):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)
