"""Interval operators: overlap join by bins, islands, sweep-line coverage, tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def binned(start: Column, end: Column, width: int) -> Column:
    """Bins that a half-open interval touches; none for an empty one."""
    return F.when(end > start, F.sequence(F.floor(start / width), F.floor((end - 1) / width)))


def overlap_join(a: DataFrame, b: DataFrame, a_cols: tuple[str, str, str], b_cols: tuple[str, str, str], width: int, how: str = "inner") -> DataFrame:
    """Pairs of half-open intervals on one chromosome that overlap.

    Both sides are dealt to fixed bins and meet on (chromosome, bin), an equi-join that Spark can shuffle and split; a pair
    that shares several bins counts in the first of them only. ``width`` should be near the longer side's usual length.
    Column names of the two sides must differ. ``how``: inner, or left_semi (rows of ``a`` with an overlap).
    """
    (ac, as_, ae), (bc, bs, be) = a_cols, b_cols
    left = a.withColumn("__bin_a", F.explode(binned(F.col(as_), F.col(ae), width)))
    right = b.withColumn("__bin_b", F.explode(binned(F.col(bs), F.col(be), width)))
    on = (
        (F.col(ac) == F.col(bc)) & (F.col("__bin_a") == F.col("__bin_b")) & (F.col(as_) < F.col(be)) & (F.col(bs) < F.col(ae))
        & (F.col("__bin_a") == F.floor(F.greatest(as_, bs) / width))
    )
    return left.join(right, on, how).drop("__bin_a", "__bin_b")


def not_overlapping(a: DataFrame, b: DataFrame, a_cols: tuple[str, str, str], b_cols: tuple[str, str, str], width: int, key: str) -> DataFrame:
    """Rows of ``a`` (unique ``key``) that no interval of ``b`` touches."""
    hit = overlap_join(a, b, a_cols, b_cols, width, "left_semi").select(key).distinct()
    return a.join(hit, key, "left_anti")


def outside(a: DataFrame, b: DataFrame, point: tuple[str, str], b_cols: tuple[str, str, str], width: int) -> DataFrame:
    """Rows of ``a`` whose ``point`` (chromosome, position) lies in no interval of ``b``. A point has one bin, so rows need no key."""
    (chrom, pos), (bc, bs, be) = point, b_cols
    bins = b.withColumn("__bin", F.explode(binned(F.col(bs), F.col(be), width)))
    on = (F.col(chrom) == F.col(bc)) & (F.floor(F.col(pos) / width) == F.col("__bin")) & (F.col(pos) >= F.col(bs)) & (F.col(pos) < F.col(be))
    return a.join(bins, on, "left_anti")


#: How a value is carried from tile to tile.
_CARRY = {"sum": F.sum, "max": F.max, "min": F.min}


def carried(
    df: DataFrame, keys: list[str], tile: str, before: dict[str, tuple[Column, str]] | None = None, after: dict[str, tuple[Column, str]] | None = None, whole: dict[str, tuple[Column, str]] | None = None
) -> DataFrame:
    """Adds to each row what other tiles of its keys hold: aggregates (column, how) over all tiles before its own, after it,
    or over all; null where there are none.

    Windows over rows can then stay inside a tile: neither a chromosome nor a whole table has to fit in one task. What
    is carried comes from a table of one row for each tile, which the rows join; a row without keys or tile goes.
    """
    named = {**(before or {}), **(after or {}), **(whole or {})}
    t = df.groupBy(*keys, tile).agg(*[_CARRY[how](c).alias(n) for n, (c, how) in named.items()])
    up, down = Window.partitionBy(*keys).orderBy(F.asc(tile)), Window.partitionBy(*keys).orderBy(F.desc(tile))
    cols = [_CARRY[how](n).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias(n) for some, w in ((before, up), (after, down)) for n, (_, how) in (some or {}).items()]
    cols += [_CARRY[how](n).over(Window.partitionBy(*keys)).alias(n) for n, (_, how) in (whole or {}).items()]
    return df.join(t.select(*keys, tile, *cols), [*keys, tile])


def islands(df: DataFrame, keys: list[str], start: str, end: str, gap: int, tile: int = 1 << 20) -> DataFrame:
    """Adds ``island``: a new one begins where a row starts more than ``gap`` after all before it ended.

    Islands are found inside tiles first; the islands of all tiles, far fewer than rows, are then merged in turn, and each
    row gets the number that its own one ended up with.
    """
    inside = Window.partitionBy(*keys, "__tile").orderBy(start, end)
    upto, before = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    far = F.max(end).over(before)
    d = df.withColumn("__tile", F.floor(F.col(start) / tile)).withColumn("__new", F.when(far.isNull() | (F.col(start) - far > gap), 1).otherwise(0))
    d = d.withColumn("__own", F.sum("__new").over(upto)).drop("__new")
    own = d.groupBy(*keys, "__tile", "__own").agg(F.min(start).alias("__a"), F.max(end).alias("__b"))
    w = Window.partitionBy(*keys).orderBy("__a", "__tile", "__own")
    far = F.max("__b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    own = own.withColumn("__new", F.when(far.isNull() | (F.col("__a") - far > gap), 1).otherwise(0))
    own = own.select(*keys, "__tile", "__own", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long").alias("island"))
    return d.join(own, [*keys, "__tile", "__own"]).drop("__tile", "__own")


def coverage(df: DataFrame, keys: list[str], start: str, end: str, tile: int = 1 << 20) -> DataFrame:
    """Depth intervals (keys, start, end, depth) with depth over 0, neighbours of equal depth merged.

    Starts add 1 and ends take 1; equal positions are summed before any sort. The running sum goes over tiles of the
    chromosome with offsets from a table of tile totals, so no chromosome has to fit in one task.
    """
    ev = df.select(*keys, F.inline(F.array(F.struct(F.col(start).alias("pos"), F.lit(1).alias("d")), F.struct(F.col(end).alias("pos"), F.lit(-1).alias("d")))))
    net = ev.groupBy(*keys, "pos").agg(F.sum("d").alias("d")).where("d <> 0").withColumn("tile", F.floor(F.col("pos") / tile))
    total = net.groupBy(*keys, "tile").agg(F.sum("d").alias("sum"), F.min("pos").alias("first"))
    by_tile = Window.partitionBy(*keys).orderBy("tile")
    total = total.select(*keys, "tile", F.coalesce(F.sum("sum").over(by_tile.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.lead("first").over(by_tile).alias("next_first"))
    inside = Window.partitionBy(*keys, "tile").orderBy("pos")
    out = net.join(total, [*keys, "tile"]).withColumn("depth", F.col("base") + F.sum("d").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.withColumn("until", F.coalesce(F.lead("pos").over(inside), "next_first"))
    return out.where("depth > 0").select(*keys, F.col("pos").cast("long").alias("start"), F.col("until").cast("long").alias("end"), F.col("depth").cast("long").alias("depth"))


def binned_track(depth: DataFrame, keys: list[str], width: int, scale: float = 1.0) -> DataFrame:
    """Mean depth of the intervals that start in each bin, divided by ``scale``."""
    out = depth.groupBy(*keys, F.floor(F.col("start") / width).alias("bin")).agg(F.sum("depth").alias("sum"), F.count(F.lit(1)).alias("n"))
    return out.select(*keys, (F.col("bin") * width).cast("long").alias("start"), (F.col("sum") / F.col("n") / scale).alias("value"))


def tiles(sizes: DataFrame, chrom: str, size: str, width: int) -> DataFrame:
    """Half-open tiles of each chromosome, the last one cut."""
    out = sizes.where(F.col(size) > 0).withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col(size).cast("long") - 1, F.lit(width).cast("long"))))
    return out.select(chrom, "start", F.least(F.col("start") + width, F.col(size)).cast("long").alias("end"))


def count_features(reads: DataFrame, genes: DataFrame, width: int = 2048) -> DataFrame:
    """Reads per gene, (cell_id, gene_id, n): a read counts where it overlaps exactly one gene.

    reads: read_id, cell_id, chrom, pos_start, pos_end; genes: gene_id, g_chrom, g_start, g_end.
    """
    hits = overlap_join(reads, genes, ("chrom", "pos_start", "pos_end"), ("g_chrom", "g_start", "g_end"), width)
    one = hits.groupBy("read_id", "cell_id").agg(F.min("gene_id").alias("gene_id"), F.max("gene_id").alias("other")).where("gene_id = other")
    return one.groupBy("cell_id", "gene_id").agg(F.count(F.lit(1)).alias("n"))
