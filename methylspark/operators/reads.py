"""Read-level operators: classes, strands, methylation levels, splitting at cut sites, trimming."""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from methylspark.functions.sequence import count_letters

SECONDARY, REVERSE, MATE_REVERSE, PAIRED = 256, 16, 32, 1

#: Cut sites with their bisulfite forms, by read type.
CUT_SITES = {1: ("CATG", "CATA", "GATC", "AATC"), 2: ("CATG", "TATG", "GATC", "GATT")}


def classify_alignments(df: DataFrame, mapq_cutoff: int = 10, qlen_cutoff: int = 30, primary_only: bool = True, qlen: str = "qlen") -> DataFrame:
    """Adds ``align_class``: unique (mapq over the cutoff), multi (mapq over 0), unmappable. Short reads go, and so do
    secondary alignments of multi-mapped reads if ``primary_only``."""
    kind = F.when(F.col("mapq") > mapq_cutoff, "unique").when(F.col("mapq") > 0, "multi").otherwise("unmappable")
    out = df.where(F.col(qlen) >= qlen_cutoff).withColumn("align_class", kind)
    return out.where(~((F.col("align_class") == "multi") & (F.col("flag").bitwiseAND(SECONDARY) != 0))) if primary_only else out


def min_mapq(df: DataFrame, q: int = 10) -> DataFrame:
    return df.where(F.col("mapq") >= q)


def strand_flag(flag: Column, yz: Column) -> Column:
    """Flag with strands set by conversion: ``+`` forward, with the mate of a paired read, anything else reverse."""
    both = REVERSE | MATE_REVERSE
    mask = F.when(flag.bitwiseAND(PAIRED) != 0, F.lit(both)).otherwise(F.lit(REVERSE))
    return F.when(yz == "+", flag - flag.bitwiseAND(mask)).otherwise(flag.bitwiseOR(mask))


def to_fastq(name: Column, read_type: Column, seq: Column, qual: Column) -> Column:
    return F.concat_ws("\n", F.concat(F.lit("@"), name, F.lit("_"), read_type.cast("string")), seq, F.lit("+"), qual)


def conversion(yz: Column, is_read1: Column) -> Column:
    """GA or CT: by tag, else by which read of the pair it is. A tag of another value raises."""
    unknown = F.raise_error(F.concat(F.lit("unknown conversion tag "), yz))
    return F.when(yz == "-", "GA").when(yz == "+", "CT").when(yz.isNull() & is_read1, "GA").when(yz.isNull(), "CT").otherwise(unknown)


def base_context(ref: Column, before: Column, after: Column, conv: Column, nome: bool = False) -> Column:
    """Whether a reference base is the C of a CH context on the converted strand. ``before`` and ``after`` are the
    neighbouring aligned reference bases, null where the alignment has none."""
    ga = (ref == "G") & before.isin("G", "A", "T")
    ct = (ref == "C") & after.isin("C", "T", "A")
    if nome:
        ga, ct = ga & (F.coalesce(after, F.lit("")) != "G"), ct & (F.coalesce(before, F.lit("")) != "G")
    return F.coalesce(F.when(conv == "GA", ga).otherwise(ct), F.lit(False))


def read_methylation(pairs: DataFrame, nome: bool = False) -> DataFrame:
    """Per read: ``mch``, ``cov``, ``other_snp``, ``frac``. ``pairs``: read_id, conv, ref_pos, ref, base, one row per aligned base."""
    from pyspark.sql import Window

    w = Window.partitionBy("read_id").orderBy("ref_pos")
    near = pairs.withColumn("before", F.when(F.lag("ref_pos").over(w) == F.col("ref_pos") - 1, F.lag("ref").over(w)))
    near = near.withColumn("after", F.when(F.lead("ref_pos").over(w) == F.col("ref_pos") + 1, F.lead("ref").over(w)))
    ch = base_context(F.col("ref"), F.col("before"), F.col("after"), F.col("conv"), nome)
    two = F.concat("ref", "base")
    kept = two.isin("CC", "GG")
    lost = two.isin("CT", "GA")
    out = near.groupBy("read_id").agg(
        F.count_if(ch & kept).alias("mch"), F.count_if(ch & (kept | lost)).alias("cov"), F.count_if(ch & ~kept & ~lost).alias("other_snp")
    )
    return out.withColumn("frac", F.coalesce(F.try_divide("mch", "cov"), F.lit(0.0)))


def aligned_pairs(ref_pos: Column, ref: Column, base: Column) -> Column:
    """Aligned bases of a read as one string: an upper-case reference base and a lower-case read base for each, ``--`` where
    the reference goes on without the read. From arrays; loaders may build it from text at once."""
    at = F.when(F.size(ref_pos) > 0, F.sequence(F.lit(0), F.size(ref_pos) - 1)).otherwise(F.array().cast("array<int>"))
    gap = lambda i: F.when((i > 0) & (F.get(ref_pos, i) != F.get(ref_pos, i - 1) + 1), "--").otherwise("")
    return F.array_join(F.transform(at, lambda i: F.concat(gap(i), F.upper(F.get(ref, i)), F.lower(F.get(base, i)))), "")


def read_methylation_strings(df: DataFrame, nome: bool = False, pairs: str = "pairs") -> DataFrame:
    """The same from one row per read: read_id, conv and ``pairs`` (see ``aligned_pairs``).

    A context is a pattern over neighbouring pairs, so levels are counts of matches: nothing is exploded, shuffled or
    gone through element by element.
    """
    before, after = ("(?<=[GAT].)", "(?!G)" if nome else ""), ("(?<!G.)" if nome else "", "(?=[CTA])")

    def count(ga: str, ct: str) -> Column:
        return F.when(F.col("conv") == "GA", F.regexp_count(pairs, F.lit(f"{before[0]}G{ga}{before[1]}"))).otherwise(F.regexp_count(pairs, F.lit(f"{after[0]}C{ct}{after[1]}"))).cast("long")

    out = df.select("read_id", count("g", "c").alias("mch"), count("[ga]", "[ct]").alias("cov"), count("[^ga-]", "[^ct-]").alias("other_snp"))
    return out.withColumn("frac", F.coalesce(F.try_divide("mch", "cov"), F.lit(0.0)))


def pairs_of_alignments(seq: Column, cigar: Column, md: Column) -> Column:
    """Aligned pairs (see ``aligned_pairs``) of alignments from sequence, CIGAR and MD tag; null where one is missing or they
    disagree. The reference isn't read. In Arrow batches: the two run-length codes are walked through together."""

    @F.arrow_udf("string")
    def walk(seqs: pa.Array, cigars: pa.Array, tags: pa.Array) -> pa.Array:
        out = []
        for s, c, m in zip(seqs.to_pylist(), cigars.to_pylist(), tags.to_pylist()):
            try:
                out.append(None if s is None or c is None or m is None else _pairs(s, c, m))
            except (IndexError, ValueError):
                out.append(None)
        return pa.array(out, pa.string())

    return walk(seq, cigar, md)


def _pairs(seq: str, cigar: str, md: str) -> str:
    ref: list[str | None] = []  # reference bases of aligned positions; None where they equal the read's
    for number, letters in re.findall(r"(\d+)|(\^?[A-Za-z]+)", md):
        if number:
            ref += [None] * int(number)
        elif letters[0] != "^":  # deleted bases have no pair
            ref += letters.upper()
    out, at, k = [], 0, 0
    for n, op in ((int(n), op) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar)):
        if op in "M=X":
            out += [(r or b.upper()) + b.lower() for r, b in zip(ref[k : k + n], seq[at : at + n], strict=True)]
            at, k = at + n, k + n
        elif op in "IS":
            at += n
        elif op in "DN" and out:
            out.append("--")
    if k != len(ref) or at != len(seq):
        raise ValueError("sequence, CIGAR and MD tag disagree")
    return "".join(out)


def spliced_methylation(df: DataFrame, nome: bool = False, pairs: str = "pairs") -> DataFrame:
    """Levels of reads of a spliced aligner, by their strand: read_id, reverse and ``pairs`` -> mch, cov, other_snp, frac.

    Reverse reads count C before A, C or T, others G behind A, T or G. NOMe: a C behind G, or a G before C, doesn't count,
    and neither does one whose neighbour there isn't known.
    """
    ct, ga = ("(?<=[ACTN].)" if nome else "", "(?=[ACT])"), ("(?<=[ATG].)", "(?=[AGTN])" if nome else "")

    def count(c: str, g: str) -> Column:
        return F.when(F.col("reverse"), F.regexp_count(pairs, F.lit(f"{ct[0]}C{c}{ct[1]}"))).otherwise(F.regexp_count(pairs, F.lit(f"{ga[0]}G{g}{ga[1]}"))).cast("long")

    out = df.select("read_id", count("c", "g").alias("mch"), count("[ct]", "[ga]").alias("cov"), count("[^ct-]", "[^ga-]").alias("other_snp"))
    return out.withColumn("frac", F.coalesce(F.try_divide("mch", "cov"), F.lit(0.0)))


def adapter_cut(seq: Column, adapter: str, overlap: int = 6, errors: float = 0.1) -> Column:
    """Length to keep before a 3' adapter: up to where the adapter, or a beginning of it of ``overlap`` bases at least that
    ends the read, begins first, with a share of ``errors`` mismatches at most; the whole length where there is none.

    Every place of the read is compared base by base, in one expression; N in the adapter fits any base.
    """
    n = F.length(seq)
    starts = F.when(n >= overlap, F.sequence(F.lit(0), n - overlap)).otherwise(F.array().cast("array<int>"))

    def wrong(i: Column) -> Column:
        misses = [F.when((i + k < n) & (F.substring(seq, i + k + 1, F.lit(1)) != b), 1).otherwise(0) for k, b in enumerate(adapter) if b != "N"]
        return reduce(lambda a, b: a + b, misses)

    fits = F.filter(starts, lambda i: wrong(i) <= F.floor(F.least(n - i, F.lit(len(adapter))) * errors))
    return F.coalesce(F.array_min(fits), n)


def trim_pairs(
    df: DataFrame, adapters: tuple[str, str] = ("AGATCGGAAGAGCACACGTCTGAAC", "AGATCGGAAGAGCGTCGTGTAGGGA"), quality: int = 20, left: int = 10, right: int = 10, least: int = 30, overlap: int = 6
) -> DataFrame:
    """Read pairs trimmed in one step: adapter, then 3' quality, then fixed cuts on both ends, then the length filter, which
    drops a pair only if both reads are short. df: seq1, qual1, seq2, qual2 (qualities as characters from !)."""
    out = df
    for r, adapter in zip("12", adapters):
        s, q = f"seq{r}", f"qual{r}"
        out = out.withColumn("__n", adapter_cut(F.col(s), adapter, overlap))
        out = out.withColumn(s, F.substring(F.col(s), F.lit(1), F.col("__n"))).withColumn(q, F.substring(F.col(q), F.lit(1), F.col("__n")))
        out = out.withColumn("__n", quality_cut(F.transform(F.filter(F.split(q, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33), quality))
        out = out.withColumn(s, F.substring(F.col(s), F.lit(1), F.col("__n"))).withColumn(q, F.substring(F.col(q), F.lit(1), F.col("__n")))
        out = out.withColumn(s, fixed_trim(F.col(s), left, right)).withColumn(q, fixed_trim(F.col(q), left, right))
    return keep_pairs(out.drop("__n"), least)


def contact_read_type(flag: Column, st: Column) -> Column:
    """1 or 2: by the mate bits of the flag, else by the split tag (F1, S2, ...)."""
    return F.when(flag.bitwiseAND(64) != 0, 1).when(flag.bitwiseAND(128) != 0, 2).otherwise(F.when(F.substring(st, 2, 1) == "1", 1).otherwise(2))


def call_string_level(df: DataFrame, call: str = "xm") -> DataFrame:
    """mC level of bisulfite call strings: X and H methylated, x and h not."""
    mc = count_letters(F.col(call), "XH")
    cov = mc + count_letters(F.col(call), "xh")
    return df.withColumn("mc", mc).withColumn("cov", cov).withColumn("frac", F.coalesce(F.try_divide(mc, cov), F.lit(0.0)))


def call_string_level_nome(call: Column, seq: Column, reverse: Column) -> Column:
    """struct(mc, cov) of call strings from NOMe libraries: GpC sites are skipped. On the reverse strand the base after
    tells, on the forward strand the base before (the first position counts as GpC)."""
    at = F.sequence(F.lit(1), F.length(call))
    letters = F.transform(
        F.when(F.length(call) > 0, at).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.substring(call, i, F.lit(1)).alias("x"),
            F.when(reverse, F.substring(seq, i + 1, F.lit(1)) == "C").otherwise((i == 1) | (F.substring(seq, i - 1, F.lit(1)) == "G")).alias("gpc"),
        ),
    )
    ok = F.filter(letters, lambda s: ~s["gpc"] & s["x"].isin("X", "H", "x", "h"))
    return F.struct(F.size(F.filter(ok, lambda s: s["x"].isin("X", "H"))).cast("long").alias("mc"), F.size(ok).cast("long").alias("cov"))


def select_reads(df: DataFrame, mode: str, max_rate: float = 0.5, min_rate: float = 0.9, min_cov: int = 3) -> DataFrame:
    """DNA reads have a fraction of ``max_rate`` at most, RNA reads ``min_rate`` at least; both need coverage."""
    if mode not in ("dna", "rna"):
        raise ValueError(f"mode must be dna or rna, got {mode}")
    rate = F.col("frac") <= max_rate if mode == "dna" else F.col("frac") >= min_rate
    return df.where(rate & (F.col("cov") >= min_cov))


def parent_level(df: DataFrame, name: str = "read_name") -> DataFrame:
    """Parts of split reads (suffix -l, -r, -m) summed to their parent; percentage cut to an integer."""
    out = df.groupBy(F.regexp_replace(name, "-[lrm]$", "").alias("parent")).agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"))
    return out.withColumn("frac", F.floor(100 * F.col("mc") / (F.col("cov") + 0.001)).cast("long"))


def profile(df: DataFrame, seed: bool = False) -> DataFrame:
    """How many reads have each (mc percentage, coverage). ``seed``: (50, 50) is there even if no read has it, as DNA profiles
    are written."""
    d = df.select(F.floor(100 * F.col("frac")).cast("long").alias("mc_frac"), F.col("cov").cast("long").alias("cov"), F.lit(1).alias("n"))
    if seed:
        d = d.unionByName(df.sparkSession.createDataFrame([(50, 50, 0)], "mc_frac long, cov long, n int"))
    return d.groupBy("mc_frac", "cov").agg(F.sum("n").alias("count"))


def split_ends(df: DataFrame, seq: str = "seq", trim: int = 0, left: int = 40, right: int = 40, middle: int = 30) -> DataFrame:
    """Left, right and middle parts of reads: (part, part_seq). Reads not longer than a side have none."""
    s = F.col(seq) if not trim else F.substring(F.col(seq), F.lit(trim + 1), F.length(seq) - 2 * trim)
    n = F.length(s)
    parts = F.array(
        F.struct(F.lit("l").alias("part"), F.substring(s, F.lit(1), F.lit(left)).alias("part_seq"), F.lit(True).alias("on")),
        F.struct(F.lit("r").alias("part"), F.substring(s, n - right + 1, F.lit(right)).alias("part_seq"), F.lit(True).alias("on")),
        F.struct(F.lit("m").alias("part"), F.substring(s, F.lit(left + 1), n - left - right).alias("part_seq"), (n >= left + right + middle).alias("on")),
    )
    out = df.where(n > max(left, right)).withColumn("__part", F.explode(F.filter(parts, lambda p: p["on"])))
    return out.withColumn("part", F.col("__part.part")).withColumn("part_seq", F.col("__part.part_seq")).drop("__part")


_NO_SPANS = "array<struct<b: int, e: int>>"


def sites_in(seq: Column, read_type: int) -> Column:
    """Array of struct(b, e): the cut sites in order."""
    pieces = F.split(seq, "|".join(CUT_SITES[read_type]), -1)
    spans = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("at"), F.array().cast(_NO_SPANS).alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p) + 4).alias("at"),
            F.array_append(acc["spans"], F.struct((acc["at"] + F.length(p)).alias("b"), (acc["at"] + F.length(p) + 4).alias("e"))).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return F.slice(spans, 1, F.size(pieces) - 1)  # a site follows every piece but the last


def with_ends(sites: Column, seq: Column) -> Column:
    """Sites with empty spans at the read's ends where no site lies there. ``sites`` should be a column, not an expression."""
    empty, n = F.array().cast(_NO_SPANS), F.length(seq)
    first = F.when(F.coalesce(F.get(sites, F.lit(0))["b"], F.lit(-1)) != 0, F.array(F.struct(F.lit(0).alias("b"), F.lit(0).alias("e")))).otherwise(empty)
    last = F.when(F.coalesce(F.try_element_at(sites, F.lit(-1))["e"], F.lit(-1)) != n, F.array(F.struct(n.alias("b"), n.alias("e")))).otherwise(empty)
    return F.concat(first, sites, last)


def cut_spans(seq: Column, read_type: int) -> Column:
    return with_ends(sites_in(seq, read_type), seq)


def span_slices(spans: Column, min_length: int = 30) -> Column:
    """All slices from one span's beginning to a later span's end that are long enough."""
    at = F.sequence(F.lit(0), F.greatest(F.size(spans) - 1, F.lit(0)))
    every = F.flatten(
        F.transform(
            at,
            lambda i: F.filter(
                F.transform(at, lambda j: F.struct(F.get(spans, i)["b"].alias("b"), F.get(spans, j)["e"].alias("e"), (j > i).alias("on"))), lambda s: s["on"] & (s["e"] - s["b"] >= min_length)
            ),
        )
    )
    one = F.transform(spans, lambda s: F.struct(s["b"].alias("b"), s["e"].alias("e"), F.lit(True).alias("on")))
    return F.when(F.size(spans) == 1, one).otherwise(every)


def trim_slice(seq: Column, b: Column, e: Column, read_type: int) -> tuple[Column, Column]:
    """New begin and end: the right one of two parts keeps a DpnII or MboI site, the left one a NlaIII site."""
    s = F.substring(seq, b + 1, e - b)
    n = e - b
    if read_type == 1:
        tail, head = F.substring(s, n - 2, F.lit(3)) == "ATC", F.substring(s, 1, 3) == "CAT"
    else:
        tail, head = F.substring(s, n - 3, F.lit(3)) == "GAT", F.substring(s, 2, 3) == "ATG"
    return b + F.when(head, 4).otherwise(0), e - F.when(tail, 4).otherwise(0)


def split_at_cut_sites(df: DataFrame, seq: str = "seq", min_length: int = 30) -> DataFrame:
    """Parts of reads between cut sites: (begin, end, part_seq), distinct per read, long enough after trimming.

    ``df`` has read_type 1 or 2 and the sequence; each type has its own sites.
    """
    outs = []
    for kind in (1, 2):
        d = df.where(F.col("read_type") == kind)
        # One column a step: an expression inside a lambda would be computed again for every element.
        d = d.withColumn("__sites", sites_in(F.col(seq), kind)).withColumn("__spans", with_ends(F.col("__sites"), F.col(seq)))
        d = d.withColumn("__s", F.explode(F.array_distinct(span_slices(F.col("__spans"), min_length)))).drop("__sites", "__spans")
        b, e = trim_slice(F.col(seq), F.col("__s.b"), F.col("__s.e"), kind)
        outs.append(d.withColumn("begin", b).withColumn("end", e).drop("__s"))
    out = outs[0].unionByName(outs[1]).where(F.col("end") - F.col("begin") >= min_length).dropDuplicates(["read_id", "read_type", "begin", "end"])
    return out.withColumn("part_seq", F.substring(F.col(seq), F.col("begin") + 1, F.col("end") - F.col("begin")))


def quality_cut(quals: Column, cutoff: int = 20) -> Column:
    """Length to keep after 3' quality trimming: before the minimum of the running sum of (quality - cutoff) from the end."""
    back = F.reverse(quals)
    state = F.aggregate(
        back,
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("least"), F.lit(0).alias("n"), F.lit(0).alias("cut"), F.lit(True).alias("on")),
        lambda acc, q: F.struct(
            (acc["sum"] + q - cutoff).alias("sum"),
            F.when(acc["on"] & (acc["sum"] + q - cutoff < acc["least"]), acc["sum"] + q - cutoff).otherwise(acc["least"]).alias("least"),
            (acc["n"] + 1).alias("n"),
            F.when(acc["on"] & (acc["sum"] + q - cutoff < acc["least"]), acc["n"] + 1).otherwise(acc["cut"]).alias("cut"),
            (acc["on"] & (acc["sum"] + q - cutoff <= 0)).alias("on"),
        ),
    )
    return F.size(quals) - state["cut"]


def fixed_trim(seq: Column, left: int = 10, right: int = 10) -> Column:
    return F.substring(seq, F.lit(left + 1), F.greatest(F.length(seq) - left - right, F.lit(0)))


def keep_pairs(df: DataFrame, min_length: int = 30) -> DataFrame:
    """A pair goes only if both reads are short."""
    return df.where((F.length("seq1") >= min_length) | (F.length("seq2") >= min_length))




def qname_fields(df: DataFrame, qname: str = "qname", illumina: bool = True) -> DataFrame:
    """read_name, st, ss, se of names like ``read_1:20:80``: the type and slice of a split read. Whole reads, whose names
    have no slice, get (0, qlen) and their type as F1 or F2; a split part is S1 or S2."""
    last = F.substring_index(qname, "_", -1)
    sliced = last.rlike("^[12]:[0-9]+:[0-9]+$")
    name = F.substring_index(qname, "_", 1) if illumina else F.when(sliced, F.regexp_replace(F.col(qname), "_[12]:[0-9]+:[0-9]+$", "")).otherwise(F.col(qname))
    part = F.split(last, ":")
    whole = F.concat(F.lit("F"), F.when(F.col("flag").bitwiseAND(64) != 0, "1").otherwise("2"))
    return df.withColumns({
        "read_name": name, "st": F.when(sliced, F.concat(F.lit("S"), part[0])).otherwise(whole),
        "ss": F.when(sliced, F.get(part, F.lit(1)).cast("long")).otherwise(F.lit(0).cast("long")), "se": F.when(sliced, F.get(part, F.lit(2)).cast("long")).otherwise(F.col("qlen").cast("long")),
    })


def select_parents(parts: DataFrame, mode: str, max_rate: float = 0.5, min_rate: float = 0.9, min_cov: int = 3, legacy_percent: bool = False) -> DataFrame:
    """Parts whose parent read passes: parts are summed, parents tested, parts of passing parents stay (a semi-join).

    ``legacy_percent``: the threshold, a fraction, is compared with the whole percentage as older pipelines did.
    """
    levels = parent_level(parts)
    scale = 1 if legacy_percent else 100
    rate = F.col("frac") < max_rate * scale if mode == "dna" else F.col("frac") > min_rate * scale
    passing = levels.where(rate & (F.col("cov") >= min_cov)).select("parent")
    return parts.withColumn("parent", F.regexp_replace("read_name", "-[lrm]$", "")).join(passing, "parent", "left_semi").drop("parent")
