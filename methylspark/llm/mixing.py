"""Mixing sources to target weights by weighted fair queueing.

Every source runs through its documents in a shuffled order, again from the start when the target asks for more than it
has. A document's virtual finish time is its source's cumulative size divided by the source's target. Documents are
range-sorted by finish time and the sequence is cut at the total budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from methylspark.llm.common import WORD, Workspace, columns_of, few_files, larger_files, table

#: Sources whose cutoffs may be broadcast in ``apply_mix``; beyond it a shuffle join is used.
BROADCAST_SOURCES = 20_000


_SPACE = " \t\n\x0b\f\r"


def n_words(text: Column) -> Column:
    """Number of words of the text, 0 for null.

    Each word, with the white space before it, becomes one character; what is left behind the last is white space. Nothing
    is made for each word, unlike an array of them.
    """
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), rf"[\x20\x09-\x0D]*{WORD}", "x")
    return F.length(F.rtrim(marks, F.lit(_SPACE))).cast("long")


def shuffle_key(doc_id: Column, seed: int) -> Column:
    """A random-looking but reproducible position, which SQL engines other than Spark can compute too."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """``sizes`` (source, source_size, others) with weight and target.

    Sources in code-point order, null last, get ``weights`` in turn and share ``share`` times all sizes. A target stops
    at ``most`` times its source's size and the excess goes to the others by weight, until none is above: that is the
    level L with sum(min(most * size, weight * L)) = budget, found by running sums in the order of size / weight.
    One row per source: the windows here run over the table of sources, not over documents.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    w = w.withColumn("cap", F.col("source_size") * most)
    rise = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    upto, everything = rise.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    w = (
        w.withColumn("cap_before", F.sum("cap").over(upto) - F.col("cap"))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
    )
    w = w.withColumn("level", (F.col("budget") - F.col("cap_before")) / F.col("weight_left"))
    # The first source whose cap lies above the level its group could reach fixes the level; all before it are capped.
    above = F.col("level") * F.col("weight") <= F.col("cap")
    w = w.withColumn("level", F.min_by(F.when(above, F.col("level")), F.when(above, F.col("cap_before"))).over(everything))
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    )
    return w.withColumn("target", target).select(*sizes.columns, "weight", "target")


def schedule(
    docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5, most: int = 2, seed: int = 17,
) -> DataFrame:
    """What the mix takes of every row of ``docs``: (doc_id, source, size, key, source_size, target, taken, passes).

    ``taken``: units taken, repeats counted; ``passes``: how often the row appears. All windows over documents run in
    buckets of bounded size: within a source by the shuffle key (uniform, so no bucket is hot), in the merged order by
    virtual finish time (each source advances evenly, so none is hot either); running sums cross buckets by a table of
    bucket totals. Only (doc_id, source, size, key) is shuffled, never text.

    Null source: a source of its own, ordered last. Null text: size 0, which takes nothing. Null doc_id: an ordinary
    row. Rows that repeat a doc_id share a key and follow each other. Sources without any words have target 0. An empty
    table gives no rows. Columns beside the named ones have no effect.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "mixing")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.cast("long").alias("size"), shuffle_key(F.col(id_col), seed).alias("key")
    )
    rows = space.put(rows, "rows")  # texts are read once
    counted = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    plan = space.put(targets(counted, weights, share, most), "targets", narrow=True)
    total = plan.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    budget, ranges = int(total["size"] * share), max(1, int(total["n"] ** 0.5))
    # About sqrt(n) buckets of sqrt(n) rows per source.
    fraction = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") / F.lit(float(2**32))
    placed = _with_plan(rows, plan, spark).withColumn("slot", F.floor(fraction * F.ceil(F.sqrt("n"))))
    totals = placed.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    before = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("source").alias("s2"), F.col("slot").alias("b2"), F.coalesce(F.sum("slot_size").over(before), F.lit(0)).alias("base"))
    placed = placed.join(totals, F.col("source").eqNullSafe(F.col("s2")) & (F.col("slot") == F.col("b2"))).drop("s2", "b2")
    own = Window.partitionBy("source", "slot").orderBy("key", F.col("doc_id").isNull(), "doc_id", "size")
    placed = placed.withColumn("done", F.col("base") + F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0))).withColumn("nr", F.row_number().over(own))
    placed = space.put(placed.select("doc_id", "source", "size", "key", "source_size", "target", "slot", "nr", "done"), "placed", narrow=True)
    space.drop(rows)
    # Virtual finish times, one for each pass; the merged order and its running sum. Rows without words finish nowhere
    # (null) and take nothing.
    passes = placed.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    finish = F.when((F.col("target") > 0) & (F.col("size") > 0), (F.col("pass") * F.col("source_size") + F.col("done")) / F.col("target"))
    # Without a finish a row has a range of its own kind, dealt by its place, so that such rows gather nowhere.
    passes = passes.withColumn("finish", finish).withColumn("range", F.coalesce(F.floor(F.col("finish") * ranges), -1 - F.pmod(F.xxhash64("slot", "nr"), F.lit(ranges))))
    sums = passes.groupBy("range").agg(F.sum(F.when(F.col("finish").isNotNull(), F.col("size"))).alias("range_size"))
    sums = sums.select(F.col("range").alias("r2"), F.coalesce(F.sum("range_size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    merged = Window.partitionBy("range").orderBy("finish", F.col("source").isNull(), "source", "pass", "slot", "nr").rowsBetween(Window.unboundedPreceding, 0)
    passes = passes.join(sums, F.col("range") == F.col("r2")).withColumn("upto", F.col("base") + F.sum("size").over(merged))
    took = F.when(F.col("finish").isNotNull(), F.greatest(F.lit(0), F.least(F.col("size"), F.lit(budget) - F.col("upto") + F.col("size")))).otherwise(0).cast("long")
    # A row's passes meet again by its place; all else is equal in them.
    out = passes.withColumn("took", took).groupBy("source", "slot", "nr").agg(
        *[F.any_value(c).alias(c) for c in ("doc_id", "size", "key", "source_size", "target", "done")],
        F.sum("took").alias("taken"), F.sum((F.col("took") > 0).cast("int")).cast("int").alias("passes"),
    )
    return out.select("doc_id", "source", "size", "key", "source_size", "target", "taken", "passes", "done")


def _with_plan(rows: DataFrame, plan: DataFrame, spark) -> DataFrame:
    """Each row with its source's target. The plan is broadcast if it has BROADCAST_SOURCES rows at most."""
    small = plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    plan = plan.drop("weight").withColumnRenamed("source", "s2")
    return rows.join(F.broadcast(plan) if small else plan, F.col("source").eqNullSafe(F.col("s2"))).drop("s2")


def apply_mix(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", seed: int = 17, **kw) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it, columns unchanged.

    In each pass a source is taken up to a cutoff in its shuffled order, so two cutoffs per source decide for every row;
    texts aren't shuffled. The one document per source that the budget cuts stays whole. Rows without words are in
    no mix and go. Null sources, ties and repeated rows: see ``schedule``; rows of one doc_id share the cutoff test.
    """
    spark = docs.sparkSession
    plan = schedule(docs, size, id_col, source_col, seed=seed, **kw)
    most = kw.get("most", 2)
    cut = plan.where("passes > 0").groupBy("source").agg(
        *[F.max(F.when(F.col("passes") >= p, F.col("key"))).alias(f"cut{p}") for p in range(1, most + 1)]
    )
    cut = Workspace(spark, "mix").put(cut, "cut", narrow=True)
    small = cut.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    cut = cut.select(F.col("source").alias("__mix_source"), *[F.col(f"cut{p}").alias(f"__mix_cut{p}") for p in range(1, most + 1)])
    marked = docs.withColumn("__mix_key", shuffle_key(F.col(id_col), seed)).withColumn("__mix_size", size)
    marked = marked.join(F.broadcast(cut) if small else cut, F.col(source_col).eqNullSafe(F.col("__mix_source")))
    times = sum((F.coalesce(F.col("__mix_key") <= F.col(f"__mix_cut{p}"), F.lit(False)).cast("int") for p in range(1, most + 1)), F.lit(0))
    marked = marked.where(F.col("__mix_size") > 0).withColumn("__mix_pass", F.explode(F.array_repeat(F.lit(1), times)))
    return columns_of(marked, docs)


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All documents mixed with weights 3, 1, 2, 1.5 times their size in all, none more than twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return few_files(schedule(docs, n_words(F.col("text")))).select("doc_id", "size", "source_size", "target", "taken")


def stage_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents as often as the mix takes them."""
    return apply_mix(larger_files(docs), n_words(F.col("text")))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5(concat('17:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS key FROM documents
), s AS (
  SELECT source, sum(size) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, source_size * 2 AS cap FROM s
), r AS (
  SELECT *, sum(cap) OVER upto - cap AS cap_before, sum(weight) OVER () - sum(weight) OVER upto + weight AS weight_left,
    CAST(sum(source_size) OVER () AS DOUBLE) * 1.5e0 AS budget
  FROM w WINDOW upto AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), l AS (
  SELECT *, (budget - CAST(cap_before AS DOUBLE)) / CAST(weight_left AS DOUBLE) AS own FROM r
), t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * (SELECT min_by(own, cap_before) FROM l WHERE own * weight <= cap)) AS target FROM l
), p AS (
  SELECT d.doc_id, d.source, d.size, d.key, t.source_size, t.target,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS LAST, d.size ROWS UNBOUNDED PRECEDING) AS done,
    row_number() OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS LAST, d.size) AS nr
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT p.*, pass, CAST(pass * source_size + done AS DOUBLE) / target AS finish FROM p, (SELECT unnest([0, 1]) AS pass) WHERE target > 0 AND size > 0
), g AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, pass, nr ROWS UNBOUNDED PRECEDING) AS upto FROM e
), k AS (
  SELECT source, nr, sum(greatest(0, least(size, (SELECT CAST(floor(sum(size) * 1.5e0) AS BIGINT) FROM d) - upto + size))) AS taken FROM g GROUP BY source, nr
)
SELECT p.doc_id, CAST(p.size AS BIGINT) AS size, CAST(p.source_size AS BIGINT) AS source_size, p.target, CAST(coalesce(k.taken, 0) AS BIGINT) AS taken
FROM p LEFT JOIN k ON p.source IS NOT DISTINCT FROM k.source AND p.nr = k.nr
"""
