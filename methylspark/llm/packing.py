"""Packing token sequences: bounded-space online best fit.

Each partition keeps a fixed number of open windows. A document's whole windows go out at once; its rest goes to the open
window that it fits best. When none fits and no more may be opened, the fullest is completed with the beginning of the
rest and emitted. At a partition's end its open windows are brought together, and what remains, less than one window for
each partition, is merged in a tree over partitions.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.llm.common import Workspace, larger_files, table

#: Windows that a partition keeps open.
OPEN_WINDOWS = 64
#: Partitions (then groups of them) whose rests one merging task brings together.
FAN_IN = 32

_FIELDS = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("open_part", pa.int64()), ("ids", pa.binary()),
]
_ARROW = pa.schema(_FIELDS)
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, open_part long, ids binary"


class Packer:
    """Open windows and the pieces in them. ``out`` gets the rows of each window that is full."""

    def __init__(self, window: int, most: int, first_id: int, keep_ids: bool):
        self.window, self.most, self.next_id, self.keep = window, most, first_id, keep_ids
        self.free: list[tuple[int, int]] = []  # (room left, number of the window), ascending
        self.parts: dict[int, list[tuple]] = {}
        self.n = 0
        self.out: list[tuple] = []

    def _rows(self, pieces: list[tuple], open_part: int | None) -> None:
        sequence, at = self.next_id, 0
        self.next_id += 1
        for doc, start, ids, total in pieces:
            raw = ids.tobytes()
            self.out.append((doc, start, len(ids), zlib.crc32(raw), total, sequence, at, open_part, raw if self.keep or open_part is not None else None))
            at += len(ids)

    def _put(self, number: int, room: int, piece: tuple) -> None:
        self.parts[number].append(piece)
        if room == len(piece[2]):
            self._rows(self.parts.pop(number), None)
        else:
            insort(self.free, (room - len(piece[2]), number))

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids) >= self.window:
            self._rows([(doc, start, ids[: self.window], total)], None)
            start, ids = start + self.window, ids[self.window :]
        while len(ids):
            at = bisect_left(self.free, (len(ids), -1))
            if at < len(self.free):
                room, number = self.free.pop(at)
                self._put(number, room, (doc, start, ids, total))
                return
            if len(self.free) < self.most:
                self.n += 1
                self.parts[self.n] = []
                self._put(self.n, self.window, (doc, start, ids, total))
                return
            room, number = self.free.pop(0)  # the fullest
            self._put(number, room, (doc, start, ids[:room], total))
            start, ids = start + room, ids[room:]

    def finish(self, open_part: int) -> None:
        """Brings the open windows together: all full but for one, whose pieces keep their ids for merging."""
        rest = [piece for _, number in self.free for piece in self.parts[number]]
        self.free, self.parts = [], {}
        last: list[tuple] = []
        room = self.window
        for doc, start, ids, total in rest:
            while len(ids):
                last.append((doc, start, ids[:room], total))
                start, ids, room = start + len(last[-1][2]), ids[len(last[-1][2]) :], room - len(last[-1][2])
                if not room:
                    self._rows(last, None)
                    last, room = [], self.window
        if last:
            self._rows(last, open_part)

    def take(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(zip(*rows) if rows else [[]] * len(_FIELDS), _FIELDS)], schema=_ARROW)


def _pack(tokenizer: str, end_id: int, window: int, most: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from methylspark.llm.tokens import encoder as encoder_of

        encoder, part = encoder_of(tokenizer), TaskContext.get().partitionId()
        packer = Packer(window, most, part << 36, keep_ids)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):  # one document at a time is held as text and as ids
                ids = np.concatenate([encoder.encode(text.as_py() or ""), end])
                packer.add(doc.as_py(), 0, ids, len(ids))
                if len(packer.out) >= 4096:
                    yield packer.take()
        packer.finish(part)
        yield packer.take()

    return run


def _merge(window: int, keep_ids: bool, level: int):
    def run(key, table):
        group = key[0].as_py()
        packer = Packer(window, 1, (1 << 62) | (level << 56) | (group << 20), keep_ids)
        for row in table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist():
            packer.n += 1
            packer.parts[packer.n] = [(row["doc_id"], row["start"], np.frombuffer(row["ids"], dtype="<u4"), row["doc_tokens"])]
            packer.free.append((0, packer.n))
        packer.finish(group)
        return pa.Table.from_batches([packer.take()])

    return run


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, open_windows: int = OPEN_WINDOWS,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with ``keep_ids``, ids.

    A document is its ids by ``tokenizer`` and then ``end_id``. Every id lies in exactly one piece; the pieces of a
    sequence cover it from 0 without gaps. All sequences are full but the very last. ``ids`` are little-endian unsigned
    32-bit. Documents are packed where they are read: no text and no full window is shuffled, only the rest of each
    partition. A task holds ``open_windows`` windows and one document.

    Null text is empty: one piece with ``end_id`` alone. Null doc_id stays null. Repeated rows are packed each; a cut
    document's pieces may lie anywhere, and ``start`` orders them. An empty table gives no rows. Columns beside the named
    ones have no effect.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "packing")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = max(1, rows.rdd.getNumPartitions())
    pieces = space.put(rows.mapInArrow(_pack(tokenizer, end_id, window, open_windows, keep_ids), _DDL), "pieces")
    done, rest = [pieces.where("open_part is null")], pieces.where("open_part is not null")
    level = 0
    while parts > 1:
        parts, level = -(-parts // FAN_IN), level + 1
        merged = rest.groupBy(F.floor(F.col("open_part") / FAN_IN).alias("group")).applyInArrow(_merge(window, keep_ids, level), _DDL)
        merged = space.put(merged, f"merged{level}")
        done.append(merged.where("open_part is null"))
        rest = merged.where("open_part is not null")
    out = rest
    for more in done:
        out = out.unionByName(more)
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(*cols, *(["ids"] if keep_ids else []))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_pack_sequences(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All documents in sequences of 2048 tokens; a digest of each piece in place of its ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, tokenizer or vocabulary(), end_id=1, window=2048, keep_ids=False)


def stage_pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the corpus as packed sequences, ids included."""
    return pack(larger_files(docs), vocabulary(), end_id=1, window=2048)
