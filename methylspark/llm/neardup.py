"""Near-duplicate documents: fast similarity sketches, banding, exact verification, connected components.

1. Every text becomes its set of word shingles and a sketch. Equal sets are one class from here on.
2. Classes that share a band key share a bucket. Each class is compared, on whole sets, with the smallest member of the
   bucket it shares most often. This links nearly all that is to be linked, one comparison for each class.
3. Buckets whose members lie in more than one component so far are searched in blocks: sketches tell which pairs of
   different components can reach the threshold at all. They come out as a spanning forest, a row for each class at most.
4. Trees of that forest are groups in which links may be missing. Their whole sets meet in blocks again, and all
   intersections in a block are counted through an inverted list; pairs are never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from methylspark.llm import shingles
from methylspark.llm.common import Workspace, columns_of, few_files, larger_files, runs, shuffle_partitions, table
from methylspark.llm.components import components

#: Similarity, as a percentage, from which documents are linked.
PERCENT = 75
#: Ids that ``stage_near_duplicates`` may broadcast (8 MB); beyond it, a shuffle join.
BROADCAST_IDS = 1_000_000
#: Members of a bucket that meet at once: sketches; whole sets, of which a chunk has so many shingles at most (2 MB) or one set.
SKETCH_BLOCK, SET_BLOCK, SET_SHINGLES = 1024, 512, 1 << 18
#: Entries of the inverted list that are gone through at once.
POSTINGS = 1 << 20


def least_matches(percent: int) -> int:
    """Equal coordinates below which a sketch rules a pair out: 4.5 standard deviations under the threshold."""
    p, t = percent / 100, shingles.COORDINATES
    return max(1, int(t * p - 4.5 * (t * p * (1 - p)) ** 0.5))


def _reach(small, large, percent: int):
    """Whether sizes alone allow the similarity."""
    return 100 * small >= percent * large


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, members in shingles.sets(batch.column(1), k):
                full = [n for n, m in enumerate(members) if len(m)]
                sketch = shingles.sketches([members[n] for n in full])
                keys, brief = shingles.bands(sketch), shingles.short(sketch)
                digests, where = [shingles.digest(m) for m in members], {n: i for i, n in enumerate(full)}
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(members)), pa.array([len(m) for m in members], pa.int64()),
                        pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                        pa.array([brief[where[n]].tobytes() if n in where else None for n in range(len(members))], pa.binary()),
                        pa.array([keys[where[n]] if n in where else None for n in range(len(members))], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "s1", "s2", "sketch", "bands"],
                )

    return run


def _bytes(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width)


def _matches(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y = (_bytes(v, shingles.COORDINATES) for v in (a, b))
    return pa.array((x == y).sum(axis=1), pa.int32())


def _verify(k: int, percent: int):
    """mapInArrow: (rep, pivot, text, other) -> the pairs that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            pivots = batch.column(1).to_pylist()
            new = list(dict.fromkeys(p for p in pivots if p not in held))
            held = {p: held[p] for p in set(pivots) if p in held}
            rows = [pivots.index(p) for p in new]
            for at, members in shingles.sets(batch.column(3).take(pa.array(rows, pa.int64())), k):
                held.update(zip(new[at : at + len(members)], members))
            ok = []
            for at, members in shingles.sets(batch.column(2), k):
                for n, m in enumerate(members):
                    other = held[pivots[at + n]]
                    both = len(np.intersect1d(m, other, assume_unique=True))
                    ok.append(100 * both >= percent * (len(m) + len(other) - both) and both > 0)
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return run


class _Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _groups(tables: Iterator[pa.Table], keys: list[str]) -> Iterator[pa.Table]:
    """Each group of the sorted stream as a table."""
    for part in tables:
        part = part.combine_chunks()
        change = np.zeros(len(part), dtype=bool)
        for k in keys:
            v = part.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        starts = [0, *np.flatnonzero(change), len(part)]
        for a, b in zip(starts, starts[1:]):
            if b - a > 1:
                yield part.slice(a, b - a)


def _possible(percent: int):
    """mapInArrow over blocks (key, x, y; sorted): pairs of different components that the sketches allow, as a forest."""
    least = least_matches(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a: list[int] = []
        out_b: list[int] = []
        for group in _groups(runs(batches, ["key", "x", "y"]), ["key", "x", "y"]):
            comp = group.column("comp").to_numpy()
            if (comp == comp[0]).all():
                continue
            reps, size, chunk = (group.column(c).to_numpy() for c in ("rep", "n", "chunk"))
            sketch = _bytes(group.column("sketch"), shingles.COORDINATES)
            cross = group.column("x")[0] != group.column("y")[0]
            forest = _Forest(len(reps))
            for i in range(len(reps) - 1):
                rest = slice(i + 1, None)
                may = comp[rest] != comp[i]
                if cross:
                    may &= chunk[rest] != chunk[i]
                may &= _reach(np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i]), percent)
                js = np.flatnonzero(may)
                if not len(js):
                    continue
                js = js[(sketch[js + i + 1] == sketch[i]).sum(axis=1) >= least] + i + 1
                for j in js.tolist():
                    if forest.join(i, j):
                        out_a.append(int(reps[i]))
                        out_b.append(int(reps[j]))
            if len(out_a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])
                out_a, out_b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return run


def _shared(terms: np.ndarray, count: np.ndarray, first: np.ndarray, posting: np.ndarray, sets: int) -> np.ndarray:
    """How many of ``terms`` each set has, by the inverted list, POSTINGS entries at a time."""
    both, lengths = np.zeros(sets, dtype=np.int64), count[terms]
    upto, a = np.cumsum(lengths), 0
    while a < len(terms):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + POSTINGS, side="right")))
        n = lengths[a:b]
        at = np.repeat(first[terms[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both += np.bincount(posting[at], minlength=sets)
        a = b
    return both


def _linked(k: int, percent: int):
    """mapInArrow over blocks (key, x, y; sorted) with whole texts: links between different components, as a forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(runs(batches, ["key", "x", "y"]), ["key", "x", "y"]):
            comp = group.column("comp").to_numpy()
            if (comp == comp[0]).all():
                continue
            reps, chunk = group.column("rep").to_numpy(), group.column("chunk").to_numpy()
            members: list[np.ndarray] = []
            for _, some in shingles.sets(group.column("text"), k):
                members += some
            size = np.array([len(m) for m in members])
            owner = np.repeat(np.arange(len(members)), size)
            _, term = np.unique(np.concatenate(members), return_inverse=True)
            order = np.argsort(term, kind="stable")
            posting, count = owner[order], np.bincount(term)
            first, begin = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(size)])
            cross = group.column("x")[0] != group.column("y")[0]
            forest = _Forest(len(reps))
            root = {}
            for n, c in enumerate(comp.tolist()):  # components known so far
                forest.join(n, root.setdefault(c, n))
            a, b = [], []
            for i in range(len(reps)):
                both = _shared(term[begin[i] : begin[i + 1]], count, first, posting, len(reps))
                ok = (100 * both >= percent * (size + size[i] - both)) & (comp != comp[i]) & (both > 0)
                if cross:
                    ok &= chunk != chunk[i]
                for j in np.flatnonzero(ok).tolist():
                    if forest.join(i, j):
                        a.append(int(reps[i]))
                        b.append(int(reps[j]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _blocks(rows: DataFrame, chunks: Column, spark) -> DataFrame:
    """Deals each group ``key`` over pairs (x <= y) of ``chunks`` chunks, for mapInArrow.

    Any two members of a group meet in one block, however large the group is, and no task gets a whole large group.
    """
    dealt = rows.withColumn("chunks", F.ceil(chunks).cast("long")).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.withColumn("x", F.least("chunk", "with")).withColumn("y", F.greatest("chunk", "with")).drop("with", "chunks")
    return dealt.repartition(shuffle_partitions(spark), "key", "x", "y").sortWithinPartitions("key", "x", "y", "rep")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles long, component_id long, kept boolean: one row per row of ``docs``.

    Documents are linked when 100 * intersection >= percent * union of their sets of k-word shingles, counted on whole
    sets (as 64-bit hashes of shingles: two sets of 20 000 shingles have a count off by one with odds of 1 in 10^10);
    component_id is the smallest doc_id reachable. The one approximate step is which pairs meet: a pair at the
    threshold shares no band with probability (1 - 0.75^4)^32 = 5e-6, and is ruled out by its sketches in step 3 with
    about 3e-6; more similar pairs less.

    Null text, empty text and text without words: an empty set, linked with nothing. Fewer than k words: one shingle, so
    linked with equal sequences only. Null doc_id: a row of its own with null component_id, kept, linking nothing. Rows
    that repeat a doc_id are one document: links of any of its texts count, and all rows get its component. An empty table
    gives no rows. Columns beside the named ones have no effect.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "neardup")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = space.put(texts.mapInArrow(_signatures(k), "doc_id long, n long, s1 long, s2 long, sketch binary, bands array<long>"), "signatures")
    nodes = rows.where("doc_id is not null and n > 0").groupBy("s1", "s2", "n").agg(
        F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")
    )
    nodes = space.put(nodes, "classes")
    # Buckets of two or more, their members, and each class's best pivot.
    banded = nodes.select("rep", F.explode("bands").alias("key"))
    buckets = space.put(banded.groupBy("key").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("members")).where("members > 1"), "buckets", narrow=True)
    members = space.put(banded.join(buckets, "key").select("key", "rep", "pivot", "members"), "members", narrow=True)
    space.drop(buckets)
    hits = members.where("rep <> pivot").groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("hits"))
    pairs = hits.groupBy("rep").agg(F.max_by("pivot", F.struct("hits", -F.col("pivot"))).alias("pivot"))
    brief = nodes.select("rep", "n", "sketch")
    other = brief.select(F.col("rep").alias("pivot"), F.col("n").alias("n2"), F.col("sketch").alias("sketch2"))
    pairs = pairs.join(brief, "rep").join(other, "pivot").where(_reach(F.least("n", "n2"), F.greatest("n", "n2"), percent))
    pairs = pairs.withColumn("matches", F.arrow_udf(_matches, "int")(F.col("sketch"), F.col("sketch2"))).where(F.col("matches") >= least_matches(percent))
    pairs = space.put(pairs.select("rep", "pivot"), "pairs", narrow=True)
    shown = texts.where("doc_id is not null")
    both = pairs.join(shown.select(F.col("doc_id").alias("rep"), "text"), "rep").join(
        shown.select(F.col("doc_id").alias("pivot"), F.col("text").alias("other")), "pivot"
    )
    links = space.put(both.select("rep", "pivot", "text", "other").mapInArrow(_verify(k, percent), "a long, b long"), "links")
    # A doc_id with several texts ties their classes together.
    placed = rows.join(nodes.select("s1", "s2", "n", "rep"), ["s1", "s2", "n"], "left").select("doc_id", "n", "rep")
    placed = space.put(placed, "placed", narrow=True)
    tied = placed.where("doc_id is not null and rep is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z")
    tied = placed.join(tied.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b"))
    label = components(links.unionByName(tied), space)
    space.drop(rows, pairs, links)
    # Buckets that still hold several components.
    label_of = label.select(F.col("node").alias("rep"), F.col("label").alias("comp"))
    labelled = space.put(members.join(label_of, "rep", "left").select("key", "rep", "members", F.coalesce("comp", "rep").alias("comp")), "members", narrow=True)
    space.drop(members)
    members = labelled
    open_ = space.put(members.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key"), "open", narrow=True)
    unsure = members.join(open_, "key").join(brief, "rep").select("key", "rep", "comp", "n", "sketch", "members")
    unsure = _blocks(unsure, F.col("members") / F.lit(SKETCH_BLOCK), spark).select("key", "x", "y", "chunk", "rep", "comp", "n", "sketch")
    possible = space.put(unsure.mapInArrow(_possible(percent), "a long, b long"), "possible")
    trees = components(possible, space)
    trees = space.put(trees.join(brief.select(F.col("rep").alias("node"), "n"), "node"), "trees", narrow=True)
    space.drop(nodes, members, open_, possible)
    counts = trees.groupBy("label").agg(F.greatest(F.count(F.lit(1)) / F.lit(SET_BLOCK), F.sum("n") / F.lit(SET_SHINGLES)).alias("chunks"))
    group = trees.join(counts, "label").select(F.col("node").alias("rep"), F.col("label").alias("key"), "chunks").join(label_of, "rep", "left")
    group = group.select("key", "rep", "chunks", F.coalesce("comp", "rep").alias("comp")).join(shown.select(F.col("doc_id").alias("rep"), "text"), "rep")
    group = _blocks(group, F.col("chunks"), spark).select("key", "x", "y", "chunk", "rep", "comp", "text")
    more = space.put(group.mapInArrow(_linked(k, percent), "a long, b long"), "links")
    # Components of components.
    for end in ("a", "b"):
        up = label.select(F.col("node").alias(end), F.col("label").alias(f"up_{end}"))
        more = more.join(up, end, "left").withColumn(end, F.coalesce(f"up_{end}", end)).select("a", "b")
    above = components(more, space).select(F.col("node").alias("low"), F.col("label").alias("lowest"))
    final = placed.join(label_of, "rep", "left").withColumn("low", F.coalesce("comp", "rep")).join(above, "low", "left")
    out = final.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("lowest", "low", "doc_id").alias("component_id"))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op8_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return few_files(near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")))


def stage_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group stays, the one with the smallest doc_id; of rows that repeat its id, one."""
    space = Workspace(spark, "dedup")
    found = space.put(near_duplicates(docs), "found", narrow=True)
    gone = space.put(found.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct(), "gone", narrow=True)
    small = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    kept = larger_files(docs).join(F.broadcast(gone) if small else gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    again = space.put(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__again")), "again", narrow=True)
    if not again.isEmpty():
        once = kept.join(again, F.col("doc_id") == F.col("__again"), "left_semi").dropDuplicates(["doc_id"])
        kept = kept.join(again, F.col("doc_id") == F.col("__again"), "left_anti").unionByName(once)
    return columns_of(kept, docs)
