"""Methylation sites: context statistics, pseudo-bulk merging, strand merging, tracks, read duplicates, pileup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from methylspark.functions.sequence import contexts_of, matches_pattern


def read_contexts(df: DataFrame) -> DataFrame:
    """Sites whose context was read: none of its bases is N."""
    return df.where(~F.col("context").contains("N"))


def all_cells(stats: DataFrame, cells: DataFrame, coverage: DataFrame | None = None, key: str = "cell_id") -> DataFrame:
    """``stats`` for every one of ``cells``, null where a cell has none, with its GenomeCov from (cell, genome_cov)."""
    out = cells.select(key).distinct().join(stats, key, "left")
    return out if coverage is None else out.join(coverage.groupBy(key).agg(F.max("genome_cov").alias("GenomeCov")), key, "left")


def pattern_stats(df: DataFrame, keys: list[str], patterns: dict[str, str]) -> DataFrame:
    """mC, coverage and fraction of each IUPAC pattern (pattern -> alias). A context may count for several patterns.

    Sites are summed by context first, so the wide aggregate sees at most a few hundred rows for each key."""
    by = df.groupBy(*keys, "context").agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"))
    cols: list[Column] = []
    for pattern, alias in patterns.items():
        hit = matches_pattern(F.col("context"), pattern)
        mc, cov = (F.sum(F.when(hit, F.col(c))) for c in ("mc", "cov"))
        cols += [mc.alias(f"{alias}mC"), cov.alias(f"{alias}Cov"), F.try_divide(mc, cov).alias(f"{alias}Frac")]
    return by.groupBy(*keys).agg(*cols)


def pattern_dimension(spark, patterns: list[str]) -> DataFrame:
    """(pattern, context) of IUPAC patterns, for joins."""
    return spark.createDataFrame([(p, c) for p in patterns for c in contexts_of(p)], "pattern string, context string")


def context_counts(df: DataFrame, keys: list[str], c_pos: int = 0) -> DataFrame:
    """mCG, mCH and mCCC: mC, Cov and Frac (with a small denominator term). Contexts with N don't count.

    ``c_pos``: where in the context the C lies. Past 0 (NOMe) classes get a prefix for the base before: G or H, and CCC
    after G doesn't count; its rows are summed.
    """
    ctx = F.col("context")
    kind = F.when(F.substring(ctx, c_pos + 2, 1) == "G", "mCG").otherwise("mCH")
    names = ["mCG", "mCH"]
    ccc = F.substring(ctx, c_pos + 1, 3).rlike("^C+$")
    if c_pos:
        before = F.substring(ctx, c_pos, 1) == "G"
        kind, names, ccc = F.concat(F.when(before, "G").otherwise("H"), kind), [p + k for p in "GH" for k in names], ccc & ~before
    d = read_contexts(df).withColumn("__kind", kind).withColumn("__ccc", ccc)
    cols = []
    for name in ["mCCC", *names]:
        hit = F.col("__ccc") if name == "mCCC" else F.col("__kind") == name
        mc, cov = (F.coalesce(F.sum(F.when(hit, F.col(c))), F.lit(0)) for c in ("mc", "cov"))
        cols += [mc.alias(f"{name}mC"), cov.alias(f"{name}Cov"), (mc / (cov + 0.00001)).alias(f"{name}Frac")]
    return d.groupBy(*keys).agg(*cols)


def lambda_fraction(df: DataFrame, keys: list[str], upstream: int = 0, chrom: str = "chrL") -> DataFrame:
    """mCY fraction and coverage on the spike-in chromosome; 0 for samples without it."""
    two = F.substring("context", upstream + 1, 2)
    hit = (F.col("chrom") == chrom) & two.isin("CC", "CT")
    mc, cov = (F.coalesce(F.sum(F.when(hit, F.col(c))), F.lit(0)) for c in ("mc", "cov"))
    return df.groupBy(*keys).agg(F.coalesce(F.try_divide(mc, cov), F.lit(0.0)).alias("LambdaCYFrac"), cov.alias("LambdaCYCov"))


def merge_sites(df: DataFrame, keys: list[str]) -> DataFrame:
    """Pseudo-bulk: mc and cov of each site summed over the cells of a group."""
    return df.groupBy(*keys, "chrom", "pos", "strand", "context").agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"))


def merge_categories(df: DataFrame, categories: list[str]) -> DataFrame:
    """Pseudo-bulk by several categories at once: (category, value, chrom, pos, strand, context, mc, cov).

    Sites are summed once by combination of labels; each category then sums combinations, not cells.
    """
    element = merge_sites(df, categories)
    out = element.select("*", F.inline(F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("value")) for c in categories])))
    return merge_sites(out, ["category", "value"])


def merge_strands(df: DataFrame, keys: list[str], pattern: str = "CGN") -> DataFrame:
    """CpGs of both strands as one, at the forward position."""
    d = df.where(matches_pattern(F.col("context"), pattern)).withColumn("pos", F.when(F.col("strand") == "-", F.col("pos") - 1).otherwise(F.col("pos")))
    return d.groupBy(*keys, "chrom", "pos").agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"))


def bin_track(df: DataFrame, keys: list[str], width: int) -> DataFrame:
    d = df.groupBy(*keys, "chrom", F.floor(F.col("pos") / width).alias("bin")).agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"))
    return d.withColumn("frac", F.try_divide("mc", "cov"))


def site_matrix(df: DataFrame, samples: list[str]) -> DataFrame:
    """Coverage and mC of every site in every sample, 0 where it has none: full outer join as one aggregate."""
    cols = [F.sum(F.when(F.col("sample") == s, F.col(c)).otherwise(0)).alias(f"{s}_{c}") for s in samples for c in ("mc", "cov")]
    return df.groupBy("chrom", "pos").agg(*cols)


def remove_duplicates(df: DataFrame, keys: list[str], score: str, tie: str, mate: list[str] | None = None) -> DataFrame:
    """The best read of each 5' position and strand (``keys``). Pair-aware with ``mate``, the mate's position and strand,
    null for reads without one: pairs compete with pairs, and a single read goes where a pair has its position."""
    if not mate:
        w = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
        return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
    single = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in mate])
    own, place = Window.partitionBy(*keys, *mate).orderBy(F.desc(score), tie), Window.partitionBy(*keys)
    d = df.withColumn("__r", F.row_number().over(own)).withColumn("__pairs", F.max((~single).cast("int")).over(place))
    return d.where((F.col("__r") == 1) & (~single | (F.col("__pairs") == 0))).drop("__r", "__pairs")


def pileup(df: DataFrame, keys: list[str], min_mapq: int | None = None, up: int = 0, down: int = 2) -> DataFrame:
    """mc, cov and context of each cytosine from reads: keys, chrom, pos_start, reverse, seq, ref, and mapq for ``min_mapq``.

    ``ref`` is the reference under the read, base for base: - in ``ref`` for inserted bases, - in ``seq`` for deleted or
    skipped ones. On the forward strand a C read as C is methylated and as T isn't; on the reverse strand the same for G
    and A. ``context``: the C with ``up`` bases before and ``down`` behind it on its strand; bases the read doesn't show
    count as N; the context that most reads see stands for the site (the first in order of those).
    """
    from methylspark.functions.sequence import complement

    d = df if min_mapq is None else df.where(F.col("mapq") >= min_mapq)
    # Inserted bases have no place on the reference.
    d = d.withColumn("__pairs", F.filter(F.arrays_zip(F.split("ref", "").alias("r"), F.split("seq", "").alias("b")), lambda x: (x["r"] != "-") & (x["r"] != "")))
    d = d.withColumn("__ref", F.concat(F.lit("N" * max(up, down)), F.array_join(F.transform("__pairs", lambda x: x["r"]), ""), F.lit("N" * max(up, down))))
    d = d.select(*keys, "chrom", "pos_start", "reverse", "__ref", F.posexplode("__pairs").alias("at", "x"))
    target, other = F.when(F.col("reverse"), "G").otherwise("C"), F.when(F.col("reverse"), "A").otherwise("T")
    d = d.where((F.col("x.r") == target) & ((F.col("x.b") == target) | (F.col("x.b") == other)))
    m = F.col("at") + max(up, down) + 1  # of the base, from 1
    seen = F.when(F.col("reverse"), F.reverse(complement(F.substring("__ref", m - down, F.lit(up + down + 1))))).otherwise(F.substring("__ref", m - up, F.lit(up + down + 1)))
    d = d.select(*keys, "chrom", (F.col("pos_start") + F.col("at")).cast("long").alias("pos"), F.when(F.col("reverse"), "-").otherwise("+").alias("strand"), (F.col("x.b") == target).cast("int").alias("mc"), seen.alias("context"))
    by = d.groupBy(*keys, "chrom", "pos", "strand", "context").agg(F.sum("mc").alias("mc"), F.count(F.lit(1)).alias("cov"))
    return by.groupBy(*keys, "chrom", "pos", "strand").agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"), F.min_by("context", F.struct(-F.col("cov"), "context")).alias("context"))
