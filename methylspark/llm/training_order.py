"""Training-order materialisation of token ids.

All documents become one stream of ids, in the order of the data, cut into sequences of equal length. A keyed Feistel
permutation with cycle-walking gives every sequence a global slot. Range partitions over slots write shards of fixed
stride, so the record of any slot lies at a known byte and a reader resumes anywhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from methylspark.llm.common import Workspace, shuffle_partitions, table

#: Rounds of the Feistel network.
ROUNDS = 6


def _round_keys(key: int) -> np.ndarray:
    return np.random.default_rng(key).integers(0, 2**63, size=ROUNDS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def permute(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """A keyed permutation of 0 .. n-1, or its inverse.

    The network permutes 0 .. 4^h - 1, the least such power not under n; a value that falls outside 0 .. n-1 walks on along
    its cycle until it is inside, which ends since the cycle leads back to where it began. Under four steps on average.
    """
    half = np.uint64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
    low = np.uint64((1 << int(half)) - 1)
    keys = _round_keys(key)
    out = np.asarray(index).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & low
        for k in keys[::-1] if back else keys:
            if back:
                left, right = right ^ (_mix(left ^ k) & low), left
            else:
                left, right = right, left ^ (_mix(right ^ k) & low)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


#: Runs whose places may be broadcast; beyond it (splits by the hundred thousand) a shuffle join.
BROADCAST_RUNS = 200_000
#: Ids that a stored piece of the stream holds, in sequences.
PIECE = 16


def _stream(tokenizer: str, end_id: int, length: int, dtype: str):
    """mapInArrow: (path, row, text) -> pieces of the streams of runs. A run is what a task reads of one file without a
    gap, so its place among the data doesn't depend on how the reader splits files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from methylspark.llm.tokens import encoder as encoder_of

        encoder, squeeze = encoder_of(tokenizer), pa.Codec("zstd", compression_level=6)
        end, most = np.array([end_id], dtype=dtype), PIECE * length
        path, first, row, at, have = None, -1, -1, 0, 0
        held: list[np.ndarray] = []

        def piece() -> pa.RecordBatch:
            nonlocal at, have, held
            ids = np.concatenate(held)
            out = [path, first, at, len(ids), squeeze.compress(ids.tobytes(), asbytes=True)]
            at, have, held = at + len(ids), 0, []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["path", "first", "at", "n", "ids"])

        for batch in batches:
            for file, number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if file != path or number != row + 1:
                    if have:
                        yield piece()
                    path, first, at = file, number, 0
                row = number
                held += [encoder.encode(text.as_py() or "").astype(dtype), end]
                have += len(held[-2]) + 1
                if have >= most:
                    yield piece()
        if have:
            yield piece()

    return run


def _cut(length: int, sequences: int, key: int, dtype: str):
    """mapInArrow: pieces with the place of their run in the whole stream -> parts of sequences, with their slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = pa.Codec("zstd", compression_level=3)
        width = np.dtype(dtype).itemsize
        for batch in batches:
            for at, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = memoryview(squeeze.decompress(ids.as_buffer(), n * width, asbytes=True))
                numbers = np.arange(at // length, (at + n - 1) // length + 1)
                starts = np.maximum(numbers * length, at)
                ends = np.minimum((numbers + 1) * length, at + n)
                parts = [squeeze.compress(raw[(a - at) * width : (b - at) * width], asbytes=True) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(permute(numbers, sequences, key)), pa.array(numbers), pa.array(starts - numbers * length), pa.array(ends - starts), pa.array(parts, pa.binary())],
                    names=["slot", "sequence", "offset", "n", "ids"],
                )

    return run


_TABLE = "sequence long, slot long, shard long, byte_offset long, n_tokens long, crc32 long, path string"


def _write(out_dir: str, length: int, shard_records: int, end_id: int, dtype: str):
    """mapInArrow over parts of sequences, sorted by slot and offset, whole shards in a partition: writes the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(out_dir)
        store.create_dir(root, recursive=True)
        squeeze, width, attempt = pa.Codec("zstd"), np.dtype(dtype).itemsize, TaskContext.get().taskAttemptId()
        open_, path, shard, slot, sequence = None, "", -1, -1, -1
        parts: list[bytes] = []
        rows: list[tuple] = []

        def record() -> None:
            ids = b"".join(parts)
            n = len(ids) // width
            ids += np.full(length - n, end_id, dtype=dtype).tobytes()
            open_.write(ids)
            rows.append((sequence, slot, shard, slot % shard_records * length * width, n, zlib.crc32(ids), f"{out_dir}/shard-{shard:08d}.bin"))
            parts.clear()

        def close() -> pa.RecordBatch:
            nonlocal rows
            open_.close()
            store.move(path, f"{root}/shard-{shard:08d}.bin")  # whole shards appear at once; a retried task writes the same bytes again
            done, rows = rows, []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == 6 else pa.int64()) for n, c in enumerate(zip(*done))], names=["sequence", "slot", "shard", "byte_offset", "n_tokens", "crc32", "path"])

        for batch in batches:
            for s, q, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                if s != slot:
                    if parts:
                        record()
                    if s // shard_records != shard:
                        if open_ is not None:
                            yield close()
                        shard = s // shard_records
                        path = f"{root}/.shard-{shard:08d}.{attempt}"
                        open_ = store.open_output_stream(path)
                    slot, sequence = s, q
                parts.append(squeeze.decompress(ids.as_buffer(), n * width, asbytes=True))
        if parts:
            record()
            yield close()

    return run


def materialise(
    docs: DataFrame, tokenizer: str, out_dir: str | None = None, end_id: int = 50256, length: int = 2048, shard_records: int = 2048, key: int = 20240607,
    text_col: str = "text", place: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Writes the shards below the URI ``out_dir``, which all executors reach (by default below the shared folder), and gives
    their table: sequence, slot, shard, byte_offset, n_tokens, crc32 (of the record), path.

    A record is ``length`` ids, little-endian, two bytes each where the vocabulary allows and else four; ``n_tokens``
    counts ids before padding, which the last sequence alone has. ``shard`` is slot div shard_records and byte_offset its
    place there. ``place`` is where each row of ``docs`` comes from, a file and its number there, as Parquet's
    ``_metadata`` tells: documents follow each other by file and number, however files are split among tasks, so slots
    depend on the data and the key alone. Without it a task's rows stand for a file.

    Texts are tokenised once, in place; the stream is written in compressed pieces. Its runs, a row for each split of the
    input, are numbered through; the shuffle moves each id once, to the range of slots that its task writes. Slots are
    spread evenly, so none is hot. Lost tasks write their shards again, with the same bytes.

    Null text is empty and gives ``end_id`` alone, like the end of every document. Ids, other columns and their names have
    no effect. Repeated rows are written each. An empty table gives no rows and no shard.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    space = Workspace(spark, "order")
    out_dir = out_dir or space.path("shards")
    dtype = "<u2" if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    if place is None:
        number = F.monotonically_increasing_id()
        place = F.lpad(F.shiftright(number, 33).cast("string"), 10, "0"), number
    rows = docs.select(place[0].alias("path"), place[1].cast("long").alias("row"), F.col(text_col).alias("text"))
    pieces = space.put(rows.mapInArrow(_stream(tokenizer, end_id, length, dtype), "path string, first long, at long, n long, ids binary"), "stream")
    before = Window.orderBy("path", "first").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split of the input
    runs = pieces.groupBy("path", "first").agg(F.sum("n").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    runs = space.put(runs, "runs", narrow=True)
    sequences = -(-(runs.agg(F.sum("n")).first()[0] or 0) // length)
    if not sequences:
        return spark.createDataFrame([], _TABLE)
    small = runs.limit(BROADCAST_RUNS + 1).count() <= BROADCAST_RUNS
    bases = runs.select("path", "first", "base")
    placed = pieces.select("path", "first", "at", "n", "ids").join(F.broadcast(bases) if small else bases, ["path", "first"])
    parts = placed.select((F.col("base") + F.col("at")).alias("at"), "n", "ids").mapInArrow(_cut(length, sequences, key, dtype), "slot long, sequence long, offset long, n long, ids binary")
    shards = -(-sequences // shard_records)
    tasks = min(shards, shuffle_partitions(spark))
    own = F.floor(F.floor(F.col("slot") / shard_records) * tasks / shards).cast("int")  # ranges of shards, one for each task
    parts = parts.repartitionById(tasks, own).sortWithinPartitions("slot", "offset")
    written = parts.select("slot", "sequence", "n", "ids").mapInArrow(_write(out_dir, length, shard_records, end_id, dtype), _TABLE)
    out = space.put(written, "table")
    space.drop(pieces, runs)
    return out


def read_slots(out_dir: str, first: int, n: int, length: int = 2048, shard_records: int = 2048, dtype: str = "<u2") -> Iterator[np.ndarray]:
    """The records of ``n`` slots from ``first`` on, one after another: each shard is opened at its byte and read forward."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(out_dir)
    stride = length * np.dtype(dtype).itemsize
    slot = first
    while slot < first + n:
        upto = min(first + n, (slot // shard_records + 1) * shard_records)
        with store.open_input_file(f"{root}/shard-{slot // shard_records:08d}.bin") as f:
            f.seek(slot % shard_records * stride)
            for _ in range(slot, upto):
                record = f.read(stride)
                if len(record) < stride:
                    return
                yield np.frombuffer(record, dtype=dtype)
        slot = upto


def op3_training_order(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All documents as records in training order, in shards; the table of the records."""
    from methylspark.llm.packing import vocabulary

    docs = table(spark, sf_dir, "documents")
    return materialise(docs.select("text", "_metadata"), tokenizer or vocabulary(), place=(F.col("_metadata.file_path"), F.col("_metadata.row_index")))
