"""Cell and plate summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assemble(tables: list[DataFrame], key: str = "cell_id") -> DataFrame:
    """One wide row per cell from several narrow tables, as a full outer join on the cell."""
    return reduce(lambda a, b: a.join(b, key, "full_outer"), tables)


def from_long(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Wide rows from (cell_id, metric, value): one aggregate in place of many joins."""
    return metrics.groupBy("cell_id").agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])


def barcode_ratio(df: DataFrame, count: str = "CellInputReadPairs", group: str = "PCRIndex") -> DataFrame:
    """A cell's share of the reads of its library."""
    return df.withColumn("CellBarcodeRatio", F.col(count) / F.sum(count).over(Window.partitionBy(group)))


def _ratio(a: str, b: str, scale: int = 1) -> Column:
    return F.try_divide(F.col(a), F.col(b)) * scale if scale != 1 else F.try_divide(F.col(a), F.col(b))


def mc_columns(df: DataFrame) -> DataFrame:
    out = df.withColumn("CellInputReadPairs", F.col("R1InputReads").cast("long")).withColumn("FinalmCReads", F.col("R1FinalBismarkReads") + F.col("R2FinalBismarkReads"))
    return barcode_ratio(out) if "PCRIndex" in df.columns else out


def mct_columns(df: DataFrame, genes: DataFrame | None = None) -> DataFrame:
    out = mc_columns(df)
    if genes is not None:
        out = out.join(genes, "cell_id", "left")
    out = out.withColumn("DNAReadsYield", F.try_divide(F.col("FinalDNAReads"), F.col("CellInputReadPairs") * 2)).withColumn("RNAReadsYield", _ratio("FinalRNAReads", "CellInputReadPairs"))
    return out.withColumn("RNA/(DNA+RNA)", F.coalesce("FinalRNAReads", F.lit(0)) / (F.coalesce("R1FinalBismarkReads", F.lit(0)) + 1))


def m3c_columns(df: DataFrame) -> DataFrame:
    """Rates are percentages in this mode."""
    out = df.withColumn("FinalmCReads", F.col("R1DeduppedReads") + F.col("R2DeduppedReads")).withColumn("CellInputReadPairs", F.col("R1InputReads"))
    for r in ("R1", "R2"):
        out = out.withColumn(f"{r}MappingRate", _ratio(f"{r}UniqueMappedReads", f"{r}TrimmedReads", 100))
        out = out.withColumn(f"{r}DuplicationRate", (1 - _ratio(f"{r}DeduppedReads", f"{r}UniqueMappedReads")) * 100)
    if "PCRIndex" in df.columns:
        out = barcode_ratio(out)
    kinds = ("CisShortContact", "CisLongContact", "TransContact")
    out = out.withColumn("TotalContacts", sum((F.coalesce(k, F.lit(0)) for k in kinds[1:]), F.coalesce(kinds[0], F.lit(0))))
    for k in kinds:
        out = out.withColumn(k.replace("Contact", "Ratio"), _ratio(k, "TotalContacts"))
    return out


def selected_dna(profile: DataFrame, max_rate: float, min_cov: int) -> DataFrame:
    """Reads under the rate (percent, not equal) with coverage, and their share."""
    hit = (F.col("cov") >= min_cov) & (F.col("mc_frac") < max_rate * 100)
    out = profile.groupBy("cell_id").agg(F.sum(F.when(hit, F.col("count"))).alias("FinalDNAReads"), F.sum("count").alias("__n"))
    return out.withColumn("SelectedDNAReadsRatio", F.try_divide("FinalDNAReads", "__n")).drop("__n")


def genes_detected(counts: DataFrame) -> DataFrame:
    """(cell_id, GenesDetected) from (cell_id, gene_id, n)."""
    return counts.groupBy("cell_id", "gene_id").agg(F.sum("n").alias("n")).groupBy("cell_id").agg(F.count_if(F.col("n") > 0).alias("GenesDetected"))


def reads_per_group(reads: DataFrame, header: DataFrame, rg: str = "rg") -> DataFrame:
    """Reads of each read group that the header names, 0 included."""
    n = reads.groupBy(rg).agg(F.count(F.lit(1)).alias("n"))
    return header.join(n, rg, "left").select(rg, F.coalesce("n", F.lit(0)).alias("n"))


def quality_flags(df: DataFrame, ccc: str, reads: str, high: int, low: int, mean_cut: int, ccc_cut: float = 0.03) -> DataFrame:
    """``high_ccc`` and ``low_reads``; the cutoff for reads depends on their mean over all cells."""
    mean = df.agg(F.avg(reads).alias("__mean"))
    out = df.crossJoin(F.broadcast(mean))  # one row
    out = out.withColumn("low_reads", F.col(reads) < F.when(F.col("__mean") < mean_cut, low).otherwise(high)).withColumn("high_ccc", F.col(ccc) > ccc_cut)
    return out.drop("__mean")


def plate_grid(df: DataFrame, plate: str, value: str, rows: int = 16, cols: int = 24, reduce_=F.avg) -> DataFrame:
    """Every position of every plate with the reduced value of its cells, null where there are none."""
    grid = df.select(plate).distinct().withColumn("Row384", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rows - 1).cast("long")))).withColumn(
        "Col384", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cols - 1).cast("long")))
    )
    have = df.groupBy(plate, "Row384", "Col384").agg(reduce_(value).alias(value))
    return grid.join(have, [plate, "Row384", "Col384"], "left")


def survival(df: DataFrame, value: str, points: int = 500, low: float = 0.001, high: float = 0.999) -> DataFrame:
    """Share of rows over each of evenly spaced cutoffs between two exact quantiles: (cutoff, percent).

    Each row is put under the last cutoff that it passes, cutoffs are summed from the top; rows don't meet all cutoffs."""
    q = df.agg(F.percentile(value, F.lit(low)).alias("lo"), F.percentile(value, F.lit(high)).alias("hi"), F.count(value).alias("n"))
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    d = df.select(value).where(F.col(value).isNotNull()).crossJoin(F.broadcast(q))
    k = F.when(step > 0, F.ceil((F.col(value) - F.col("lo")) / step) - 1).otherwise(F.when(F.col(value) > F.col("lo"), points - 1).otherwise(-1))
    passed = d.groupBy(F.least(k, F.lit(points - 1)).alias("k")).agg(F.count(F.lit(1)).alias("m")).where("k >= 0")
    grid = q.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    grid = grid.select("i", (F.col("lo") + step * F.col("i")).alias("cutoff"), "n").join(passed, F.col("i") == F.col("k"), "left")
    w = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)  # one row per cutoff
    return grid.select("i", "cutoff", (F.coalesce(F.sum("m").over(w), F.lit(0)) / F.col("n") * 100).alias("percent"))


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Projection by a table of names: DELETE drops, an empty name keeps, others rename; unnamed columns stay."""
    keep = [(c, names.get(c) or c) for c in df.columns if names.get(c) != "DELETE"]
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in keep])


def rna_summary(features: DataFrame, mapped: DataFrame) -> DataFrame:
    """Counted and final RNA reads from (cell_id, status, n), and their share of mapped reads (cell_id, mapped)."""
    out = features.groupBy("cell_id").agg(F.sum(F.when(F.col("status") == "Assigned", F.col("n")).otherwise(0)).alias("FinalCountedReads"), F.sum("n").alias("FinalRNAReads"))
    out = out.join(mapped.withColumnRenamed("mapped", "RNAUniqueMappedReads"), "cell_id", "left")
    return out.withColumn("SelectedRNAReadsRatio", F.try_divide("FinalRNAReads", "RNAUniqueMappedReads"))


def positions_or_none(df: DataFrame, positions: dict[str, Column]) -> DataFrame:
    """Plate positions for all cells, or for none of them if any id is malformed."""
    ok = df.agg(F.coalesce(F.bool_and(F.coalesce(positions["Plate"].isNotNull(), F.lit(False))), F.lit(True)).alias("__ok"))
    return df.crossJoin(F.broadcast(ok)).select(*df.columns, *[F.when(F.col("__ok"), c).alias(n) for n, c in positions.items()])  # one row


def durations(jobs: DataFrame, start: str = "start", end: str = "end", code: str = "return_code") -> DataFrame:
    """Jobs and seconds by return code, from times like 13:05:59-12/31/24."""
    t = {c: F.unix_timestamp(F.to_timestamp(c, "HH:mm:ss-MM/dd/yy")) for c in (start, end)}
    return jobs.groupBy(code).agg(F.count(F.lit(1)).alias("n"), F.min(t[end] - t[start]).alias("least"), F.avg(t[end] - t[start]).alias("mean"), F.max(t[end] - t[start]).alias("most"))


def four_m_columns(df: DataFrame, genes: DataFrame | None = None) -> DataFrame:
    """Contacts and RNA in one library: the columns of both modes; the share of RNA goes by deduplicated reads."""
    out = m3c_columns(df)
    if genes is not None:
        out = out.join(genes, "cell_id", "left")
    out = out.withColumn("DNAReadsYield", F.try_divide(F.col("FinalDNAReads"), F.col("CellInputReadPairs") * 2)).withColumn("RNAReadsYield", _ratio("FinalRNAReads", "CellInputReadPairs"))
    return out.withColumn("RNA/(DNA+RNA)", F.coalesce("FinalRNAReads", F.lit(0)) / (F.coalesce("R1DeduppedReads", F.lit(0)) + 1))


#: What each mode adds to the statistics of its cells.
MODES = {"mc": mc_columns, "mct": mct_columns, "m3c": m3c_columns, "4m": four_m_columns}


def mapping_summary(mode: str, tables: list[DataFrame], positions: dict[str, Column] | None = None, genes: DataFrame | None = None) -> DataFrame:
    """The summary of a library: the cells' statistics side by side, plate positions before them, the mode's columns behind.

    ``positions``: columns over cell_id (``position_v1`` or ``position_v2``); if any cell's name is malformed no cell has any.
    ``genes``: (cell_id, GenesDetected), for the modes with RNA.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, got {mode}")
    out = assemble(tables)
    if positions is not None:
        named = positions_or_none(out.select("cell_id"), positions)
        out = named.join(out, "cell_id")
    return MODES[mode](out, genes) if genes is not None and mode in ("mct", "4m") else MODES[mode](out)


def with_gene_info(counts: DataFrame, genes: DataFrame) -> DataFrame:
    """Counts summed over files by cell and gene, with the gene's columns."""
    return counts.groupBy("cell_id", "gene_id").agg(F.sum("n").alias("n")).join(genes, "gene_id", "left")


def unique_reads(df: DataFrame, key: str = "cell_id", read: str = "pair_id") -> DataFrame:
    """Reads of each cell, however many alignments they have. Two aggregates, so that no cell's reads meet in one task."""
    return df.groupBy(key, read).agg(F.lit(1).alias("one")).groupBy(key).agg(F.count("one").alias("n"))


def assign_clusters(df: DataFrame, clusters: DataFrame, key: str = "cell_id") -> DataFrame:
    """``df`` with the cluster of each row's cell; rows without one go. A cell without a cluster name counts as having none."""
    return df.join(clusters.where(F.col("cluster").isNotNull()), key)


def cluster_counts(df: DataFrame, per: float = 1.0) -> DataFrame:
    """Rows of each cluster, in units of ``per``."""
    return df.groupBy("cluster").agg((F.count(F.lit(1)) / F.lit(per)).alias("n"))


def report_totals(cells: DataFrame, reads: str, plate: str = "Plate", positions: int = 384) -> DataFrame:
    """One row: cells, their reads and mean, and how many cells the plates could hold."""
    return cells.agg(F.count(F.lit(1)).alias("cells"), F.sum(reads).alias("reads"), F.avg(reads).alias("mean_reads"), (F.count_distinct(plate) * positions).alias("capacity"))


def unfinished(jobs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Jobs that have not succeeded yet: (key)."""
    return jobs.select(key).distinct().join(done.select(key), key, "left_anti")
