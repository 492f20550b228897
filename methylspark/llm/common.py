"""What the operators share: reading tables, intermediate tables in the shared folder, streaming groups."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words everywhere here: U+0020 and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the session names none, a local master (as in tests) gets a folder of its own, one for each application; on a
    cluster executors would write where nobody reads, so that raises. The session's settings stay as they are.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _local_dirs.setdefault(context.applicationId, f"file://{tempfile.mkdtemp(prefix='methylspark-')}")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    if jvm is not None:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: Bytes of rows that Spark sends to Python at once. Its own default, 64 MB, is held several times over on both sides.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Bounds the session's Arrow batches by bytes, however long texts are, unless it has a bound of its own.

    Only the registered queries and the pipeline, which stand for an application, call this; operators work under
    whatever bound their caller's session has.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "67108864", "64MB", "64m"):
        spark.conf.set(key, str(BATCH_BYTES))
    return spark


class Workspace:
    """Intermediate tables of one run, as Parquet in the shared folder.

    ``put`` writes a frame and reads it again: it cuts the lineage, survives lost executors (any executor can read
    the files again) and lets joins on it be plain shuffles that Spark can split when a key is hot.
    ``drop`` frees a table that nothing needs any more. What a lazy result still reads stays until ``close``, which
    ``release`` calls for all runs of a session, or until the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._n = 0
        _open.add(self)
        atexit.register(self.close)

    def path(self, tag: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{tag}"

    def put(self, df: DataFrame, tag: str, narrow: bool = False) -> DataFrame:
        """``narrow``: rows of a few numbers, of which a partition's share is a small file; they go into a quarter as many."""
        path = self.path(tag)
        if narrow:
            df = few_files(df)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        out._workspace = self  # lives as long as the frame
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        for df in frames:
            if df is not None and (path := self._paths.pop(id(df), None)):
                _delete(self.spark, path)

    def close(self) -> None:
        _open.discard(self)
        atexit.unregister(self.close)
        try:
            _delete(self.spark, self.root)
        except Exception:  # noqa: BLE001 - the session may have ended before the interpreter does
            pass


_open: set[Workspace] = set()


def release() -> None:
    """Frees the tables of all runs so far; for long sessions, when their results have been written or collected."""
    for space in list(_open):
        space.close()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def columns_of(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, whatever they are called."""
    return df.select(*[F.col(quoted(c)) for c in like.columns])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def few_files(df: DataFrame) -> DataFrame:
    """Rows of a few numbers, in a quarter as many partitions as a shuffle has, or as many as there are cores."""
    spark = df.sparkSession
    return df.coalesce(max(spark.sparkContext.defaultParallelism, shuffle_partitions(spark) // 4))


def larger_files(docs: DataFrame) -> DataFrame:
    """Documents in a quarter as many partitions as they are read in, or twice as many as there are cores: what a stage writes
    from them, split by split, is then a few splits large. For frames that are only read, not computed."""
    n, cores = docs.rdd.getNumPartitions(), docs.sparkSession.sparkContext.defaultParallelism
    return docs.coalesce(max(2 * cores, -(-n // 4)))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Splits a stream of batches, sorted by ``keys``, into tables that end where a key ends.

    One table holds as many whole groups as came together; only the last, open group is carried over.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
        at = batch.num_rows - 1
        low, high = 0, at  # first row of the last group in this batch
        while low < high:
            mid = (low + high) // 2
            if tuple(batch.column(k)[mid].as_py() for k in keys) == last:
                high = mid
            else:
                low = mid + 1
        start = low
        if held and start == 0:
            before = held[-1]
            same = tuple(before.column(k)[before.num_rows - 1].as_py() for k in keys) == last
            if same:
                held.append(batch)
                continue
        if start > 0:
            held.append(batch.slice(0, start))
        if held:
            yield pa.Table.from_batches(held)
        held = [batch.slice(start)]
    if held:
        yield pa.Table.from_batches(held)


def arrow(rows: Iterable[dict] | dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(rows, schema=schema)


Query = Callable[[SparkSession, str], DataFrame]
