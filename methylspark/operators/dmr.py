"""Differentially methylated regions from tests of single sites."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from methylspark.operators.intervals import carried


#: Base pairs of a tile in the running steps below.
TILE = 1 << 20


def bh_fdr(df: DataFrame, keys: list[str], p: str = "pval", out: str = "fdr") -> DataFrame:
    """Benjamini-Hochberg: the least p * n / rank of this and all larger p, 1 at most. Rows without a p go.

    Ranks run inside ranges of p, whose bounds are in geometric steps of 1 in 256 (below 1e-300 all is one range); what the
    ranges before and behind hold is carried. So a table with many sites, even without keys, is no single task.
    """
    d = df.where(F.col(p).isNotNull()).withColumn("__p", F.floor(F.log2(F.greatest(F.col(p), F.lit(1e-300))) * 256).cast("int"))
    d = carried(d, keys, "__p", {"__less": (F.lit(1), "sum")}, whole={"__n": (F.lit(1), "sum")})
    inside = Window.partitionBy(*keys, "__p")
    # Equal p share the last rank among them, which is where their quotient is least.
    rank = F.coalesce("__less", F.lit(0)) + F.count(F.lit(1)).over(inside.orderBy(p).rangeBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("__q", F.col(p) * F.col("__n") / rank)
    d = carried(d, keys, "__p", after={"__behind": (F.col("__q"), "min")})
    here = F.min("__q").over(inside.orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, 0))
    return d.withColumn(out, F.least(here, F.col("__behind"), F.lit(1.0))).drop("__p", "__q", "__n", "__less", "__behind")


def significant(df: DataFrame, p_threshold: float = 0.001, delta: float = 0.1) -> DataFrame:
    """``sig``: FDR under the threshold and the difference beyond ``delta`` with that confidence. The normal distribution
    is monotone, so its inverse at the threshold, a constant, decides."""
    z = NormalDist().inv_cdf(1 - p_threshold)
    return df.withColumn("sig", (F.col("fdr") < p_threshold) & (F.abs("diff") - delta > F.lit(z) * F.col("diff_se")))


def indexed(df: DataFrame, tile: int = TILE) -> DataFrame:
    """``idx``: 0-based position of a site on its chromosome."""
    d = carried(df.withColumn("__tile", F.floor(F.col("pos") / tile)), ["chrom"], "__tile", {"__less": (F.lit(1), "sum")})
    nr = F.row_number().over(Window.partitionBy("chrom", "__tile").orderBy("pos"))
    return d.withColumn("idx", (F.coalesce("__less", F.lit(0)) + nr - 1).cast("long")).drop("__tile", "__less")


def regions(df: DataFrame, gap: int = 250, tile: int = TILE) -> DataFrame:
    """Significant sites merged where gaps are ``gap`` at most, with means over all sites from the first to the last one.

    df: chrom, pos, sig, mu1, mu2, stat. idx_start and idx_end are 0-based positions of sites on their chromosome. Each
    tile falls into stretches: significant sites that merge there, with what lies between them, and sites outside. The
    stretches, far fewer than sites, are then merged along the chromosome; no site is shuffled but to its tile.
    """
    w = Window.partitionBy("chrom", "__tile").orderBy("pos")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("chrom", "__tile").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    hit = F.when(F.col("sig"), F.col("pos"))
    near = lambda a, b: F.coalesce(b - (a + 1) <= gap, F.lit(False))
    d = df.withColumn("__tile", F.floor(F.col("pos") / tile)).withColumns({"__left": F.max(hit).over(before), "__right": F.min(hit).over(back)})
    inside = F.col("sig") | near(F.col("__left"), F.col("__right"))
    # A stretch is told by the significant site that begins it, or by the last one before it and the next one.
    begins = F.when(F.col("sig") & ~near(F.col("__left"), F.col("pos")), F.col("pos"))
    d = d.withColumn("__in", inside).withColumn("__from", F.when(inside, F.max(begins).over(upto)).otherwise(F.col("__left")))
    s = d.groupBy("chrom", "__tile", "__in", "__from").agg(
        F.min("pos").alias("at"), F.min(hit).alias("first"), F.max(hit).alias("last"), F.count(F.lit(1)).alias("n"), F.count_if("sig").alias("n_sig"),
        *[F.sum(c).alias(c) for c in ("mu1", "mu2", "stat")], *[F.count(c).alias(f"n_{c}") for c in ("mu1", "mu2")],
    )
    along, down = Window.partitionBy("chrom").orderBy("at"), Window.partitionBy("chrom").orderBy(F.desc("at"))
    s = s.withColumns({
        "left": F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1)), "right": F.min("first").over(down.rowsBetween(Window.unboundedPreceding, -1)),
        "idx": F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"),
    })
    s = s.where(F.col("__in") | near(F.col("left"), F.col("right")))
    opens = F.when(F.col("__in") & ~near(F.col("left"), F.col("first")), F.col("first"))
    s = s.withColumn("island", F.max(opens).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    out = s.groupBy("chrom", "island").agg(
        F.min("first").alias("start"), (F.max("last") + 1).alias("end"), F.min("idx").alias("idx_start"), F.sum("n").alias("total_dml"), F.sum("n_sig").alias("n_sig"),
        *[F.try_divide(F.sum(c), F.sum(f"n_{c}")).alias(c) for c in ("mu1", "mu2")], F.sum("stat").alias("stat"),
    )
    out = out.select("chrom", "start", "end", "idx_start", (F.col("idx_start") + F.col("total_dml") - 1).alias("idx_end"), "n_sig", "mu1", "mu2", "stat", "total_dml")
    return out.withColumn("sig_ratio", F.col("n_sig") / F.col("total_dml")).withColumn("diff", F.col("mu1") - F.col("mu2")).withColumn("length", F.col("end") - F.col("start"))


def select_regions(df: DataFrame, min_cg: int = 1, min_len: int = 1, sig_ratio: float = 0.5, delta: float | None = 0.1) -> DataFrame:
    """``selected_dmr``; rows stay. Without ``delta`` (several groups) the difference doesn't count."""
    ok = (F.col("n_sig") >= min_cg) & (F.col("sig_ratio") > sig_ratio) & (F.col("length") >= min_len)
    return df.withColumn("selected_dmr", ok & (F.abs("diff") > delta) if delta is not None else ok)


def call_regions(dml: DataFrame, p_threshold: float = 0.001, delta: float = 0.1, min_cg: int = 1, min_len: int = 1, sig_ratio: float = 0.5, gap: int = 250) -> DataFrame:
    """From single-site tests (chrom, pos, mu1, mu2, diff, diff_se, stat, pval) to regions."""
    d = significant(bh_fdr(dml, ["chrom"]), p_threshold, delta)
    return select_regions(regions(d, gap), min_cg, min_len, sig_ratio, delta)


def covered_in_all(sites: DataFrame, group: str, groups: list[str]) -> DataFrame:
    """Sites with coverage in every group: (chrom, pos)."""
    return sites.groupBy("chrom", "pos").agg(*[F.sum(F.when(F.col(group) == g, F.col("cov")).otherwise(0)).alias(f"c{n}") for n, g in enumerate(groups)]).where(
        " and ".join(f"c{n} > 0" for n in range(len(groups)))
    ).select("chrom", "pos")


def call_multigroup_regions(dml: DataFrame, p_threshold: float = 0.001, min_cg: int = 1, min_len: int = 1, sig_ratio: float = 0.5, gap: int = 250) -> DataFrame:
    """From tests of single sites over several groups (chrom, pos, stat, pval) to regions: the FDR alone decides, and there
    are no group means."""
    d = bh_fdr(dml, ["chrom"]).withColumn("sig", F.col("fdr") < p_threshold)
    none = F.lit(None).cast("double")
    out = regions(d.withColumn("mu1", none).withColumn("mu2", none), gap).drop("mu1", "mu2", "diff")
    return select_regions(out, min_cg, min_len, sig_ratio, None)


def tested_regions(df: DataFrame, q_threshold: float = 0.05, min_cg: int = 5, chroms: list[str] | None = None) -> DataFrame:
    """Regions that an external model has tested whole (chrom, start, end, n_cg, beta, stat, pval): FDR over all chromosomes,
    and ``selected_dmr`` by FDR and number of sites; regions on chromosomes not listed go."""
    d = df if chroms is None else df.where(F.col("chrom").isin(chroms))
    return bh_fdr(d, []).withColumn("selected_dmr", (F.col("fdr") < q_threshold) & (F.col("n_cg") >= min_cg))
