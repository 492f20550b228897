"""Substring dedup by sliding sentence spans.

Every run of consecutive sentences is hashed; a run that occurs elsewhere before removes the sentences it covers. Of a
passage that begins or ends amid a sentence, what belongs to that sentence stays.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.llm.common import Workspace, table

#: A run is the shortest sequence from a sentence on that has this many sentences and words.
LEAST_SENTENCES, LEAST_WORDS = 2, 15
#: A sentence with more words than the first is cut behind pairs of words whose hash is 0 modulo the second, and at the
#: latest after as many words as the first; so the same words are cut alike whatever stands before them.
LONG, PART = 30, 8

#: Scripts written without spaces (Han, kana, Thai, Lao, Tibetan, Burmese, Khmer): each character counts as a word.
_ALONE = "\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff\u0e01-\u0e7f\u0e80-\u0eff\u0f40-\u0fbc\u1000-\u109f\u1780-\u17d3"
_BREAK = re.compile(r"[.!?]*[。！？｡][.!?。！？｡]*\s*|[.!?]+\s+|\n\s*")
_WORD = re.compile(r"\S+")
_UNSPACED = re.compile(f"[{_ALONE}]")
_UNIT = re.compile(rf"[{_ALONE}]|[^\s{_ALONE}]+")


def sentences(text: str) -> list[tuple[int, int, int]]:
    """(start, end, words) of the text's sentences in code points; they cover it without gaps.

    A sentence ends after . ! ? and white space, after their full-width forms, or after a new line. Words are separated by
    white space; characters of scripts without spaces are words of their own.
    """
    out: list[tuple[int, int, int]] = []
    any_unspaced = not text.isascii() and _UNSPACED.search(text) is not None

    def add(a: int, b: int) -> None:
        unspaced = any_unspaced and _UNSPACED.search(text, a, b) is not None
        count = (lambda a, b: len(_UNIT.findall(text, a, b))) if unspaced else (lambda a, b: len(text[a:b].split()))
        n = count(a, b)
        if n > LONG:
            at, words, before = a, 0, ""
            for m in (_UNIT if unspaced else _WORD).finditer(text, a, b):
                if words and (words >= LONG or cut_here):
                    out.append((at, m.start(), words))
                    at, words = m.start(), 0
                now, words = m[0].lower(), words + 1
                cut_here = not zlib.crc32(f"{before} {now}".encode("utf-8", "replace")) % PART
                before = now
            out.append((at, b, words))
        elif b > a:
            out.append((a, b, n))

    at = 0
    for m in _BREAK.finditer(text):
        add(at, m.end())
        at = m.end()
    add(at, len(text))
    return out


def _hash(text: str) -> tuple[int, int]:
    raw = blake2b(text.encode("utf-8", "replace"), digest_size=12).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def run_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(h1, h2, first sentence, sentences) of every run: 96 bits of its words, lower-cased, with single spaces."""
    parts = sentences(text)
    if len(parts) < LEAST_SENTENCES:
        return []
    words = [" ".join(text[a:b].lower().split()) for a, b, _ in parts]
    sums = np.concatenate([[0], np.cumsum([n for _, _, n in parts])])
    ends = np.maximum(np.searchsorted(sums, sums[:-1] + LEAST_WORDS), np.arange(len(parts)) + LEAST_SENTENCES)
    return [(*_hash(" ".join(words[i:j])), i, j - i) for i, j in enumerate(ends.tolist()) if j <= len(parts)]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["h1", "h2", "doc_id", "at", "length"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
    for batch in batches:
        cols: list[list] = [[], [], [], [], []]
        for doc, text in zip(batch.column(0), batch.column(1)):
            doc = doc.as_py()
            for h1, h2, at, length in run_spans(text.as_py() or ""):
                for c, v in zip(cols, (h1, h2, doc, at, length)):
                    c.append(v)
            if len(cols[0]) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
                cols = [[], [], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def cut(text: str | None, runs: list[dict] | None) -> tuple[str | None, int, list[tuple[int, int]]]:
    """The text without the sentences that ``runs`` cover, how many they are, and their spans in code points."""
    if not text or not runs:
        return text, 0, []
    parts = sentences(text)
    gone = np.zeros(len(parts) + 1, dtype=np.int64)
    for r in runs:
        if r["at"] < len(parts):
            gone[r["at"]] += 1
            gone[min(r["at"] + r["length"], len(parts))] -= 1
    covered = np.cumsum(gone[:-1]) > 0
    spans: list[tuple[int, int]] = []
    for (a, b, _), c in zip(parts, covered):
        if c and spans and spans[-1][1] == a:
            spans[-1] = (spans[-1][0], b)
        elif c:
            spans.append((a, b))
    return "".join(text[a:b] for (a, b, _), c in zip(parts, covered) if not c), int(covered.sum()), spans


_CUT_DDL = "struct<text: string, n_removed: long, removed: array<struct<start: long, end: long>>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
    out = [cut(t.as_py(), r.as_py()) for t, r in zip(texts, runs)]
    spans = [[{"start": a, "end": b} for a, b in o[2]] for o in out]
    return pa.StructArray.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()), pa.array(spans, _SPANS)], names=["text", "n_removed", "removed"])


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (what is left), n_removed (sentences), removed (their spans in code points).

    Of equal runs the one with the smallest (doc_id, sentence) is first and stays; the sentences of every other one go.
    Repeats within a document count too. Runs are written once; first places are aggregated before the shuffle; the join
    back meets plain tables, so a run that a third of all documents share is split over tasks.

    Null text stays null, empty text empty, and both have no runs; so have texts with fewer than LEAST_SENTENCES sentences
    or LEAST_WORDS words. Null doc_id: the row stays as it is and its runs count for no other. Rows that repeat a doc_id are one
    document: equal texts remove nothing from each other, and what goes from one text goes at the same sentences from the
    others. An empty table gives no rows. Other columns have no effect.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "spans")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    runs = space.put(texts.where("doc_id is not null").mapInArrow(_runs, "h1 long, h2 int, doc_id long, at int, length int"), "runs")
    first = runs.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = space.put(first.select("h1", "h2", F.col("first.doc_id").alias("first_id"), F.col("first.at").alias("first_at")), "repeated")
    later = runs.join(first, ["h1", "h2"]).where("doc_id <> first_id or at <> first_at")
    later = later.groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_set(F.struct("at", "length")).alias("runs"))
    out = texts.join(later, F.col("doc_id") == F.col("__doc"), "left")
    return out.withColumn("__cut", F.arrow_udf(_cut, _CUT_DDL)(F.col("text"), F.col("runs"))).select("doc_id", "__cut.text", "__cut.n_removed", "__cut.removed")


def op4_span_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without sentences that repeat earlier ones."""
    return dedup_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
