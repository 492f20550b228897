"""Tool reports as DataFrames: text lines in, one row per file out.

Every parser takes lines (cell_id, nr, line) as ``lines_of`` gives them, so all files of a library are parsed in one pass and
small files are read many to a task. Missing values are 0 or null as stated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(cell_id, nr, line): the cell is the file name up to its first dot, ``nr`` the line's number in its file. Reports are
    small, so a file is read whole."""
    d = spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    name = F.substring_index(F.element_at(F.split("path", "/"), -1), ".", 1)
    return d.select(name.alias("cell_id"), F.posexplode(F.split("value", "\r?\n")).alias("nr", "line"))


def with_read_type(lines: DataFrame) -> DataFrame:
    """Splits cell names like ``cell-R1`` into cell_id and read_type."""
    last = F.substring_index("cell_id", "-", -1)
    return lines.withColumn("read_type", last).withColumn("cell_id", F.expr("substring(cell_id, 1, length(cell_id) - length(substring_index(cell_id, '-', -1)) - 1)"))


def by_read_type(stats: DataFrame, read_types: tuple[str, ...] = ("R1", "R2")) -> DataFrame:
    """One row per cell from (cell_id, read_type, columns): each column once for each read type, named after it."""
    names = [c for c in stats.columns if c not in ("cell_id", "read_type")]
    return stats.groupBy("cell_id").agg(*[F.max(F.when(F.col("read_type") == r, F.col(f"`{c}`"))).alias(f"{r}{c}") for r in read_types for c in names])


def _tables(lines: DataFrame, keys: list[str], keep: Column) -> DataFrame:
    """(keys, rows): the lines of each file that ``keep``, in order."""
    rows = F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("nr", "line")))), lambda x: x["line"])
    return lines.groupBy(*keys).agg(rows.alias("rows"))


def _row(header: Column, row: Column) -> Column:
    """A tab-separated row as a map from the header's names; null where either is missing."""
    names = F.split(header, "\t", -1)
    return F.when(header.isNotNull() & row.isNotNull(), F.map_from_arrays(names, F.slice(F.concat(F.split(row, "\t", -1), F.array_repeat(F.lit(None).cast("string"), F.size(names))), F.lit(1), F.size(names))))


def _long(m: str, name: str) -> Column:
    return F.expr(f"try_cast({m}['{name}'] as bigint)")


def _terms(lines: DataFrame, terms: dict[str, str]) -> DataFrame:
    """Integer values of ``term: value ...`` lines, 0 where a report lacks the term."""
    parts = F.split("line", ":")
    d = lines.withColumn("__t", F.when(F.size(parts) == 2, F.trim(F.get(parts, F.lit(0)), F.lit(" \t"))))
    d = d.withColumn("__v", F.regexp_extract(F.trim(F.get(parts, F.lit(1)), F.lit(" \t")), "^([0-9]+)", 1))
    return d.groupBy("cell_id").agg(*[F.coalesce(F.max(F.when(F.col("__t") == t, F.expr("try_cast(__v as bigint)"))), F.lit(0)).alias(n) for t, n in terms.items()])


#: Terms of the aligner's paired-end and single-end summaries and the names of their values.
PAIRED_TERMS = {
    "Total pairs": "ReadPairsMappedInPE",
    "Aligned concordantly or discordantly 0 time": "PEUnmappableReadPairs",
    "Aligned concordantly 1 time": "PEUniqueMappedReadPairs",
    "Aligned concordantly >1 times": "PEMultiMappedReadPairs",
    "Aligned discordantly 1 time": "PEDiscordantlyUniqueMappedReadPairs",
    "Total unpaired reads": "ReadsMappedInSE",
    "Aligned 0 time": "SEUnmappableReads",
    "Aligned 1 time": "SEUniqueMappedReads",
    "Aligned >1 times": "SEMultiMappedReads",
}
SINGLE_TERMS = {"Total reads": "ReadsMappedInSE", "Aligned 0 time": "SEUnmappableReads", "Aligned 1 time": "SEUniqueMappedReads", "Aligned >1 times": "SEMultiMappedReads"}


def _rates(d: DataFrame, total: Column, unique: Column, multi: Column) -> DataFrame:
    def rate(x: Column) -> Column:
        return F.bround(x / (total + 0.00001) * 100).cast("long")

    return d.withColumns({
        "UniqueMappedReads": unique, "UniqueMappingRate": rate(unique), "MultiMappedReads": multi,
        "MultiMappingRate": rate(multi), "OverallMappingRate": rate(unique + multi),
    })


def paired_summary(lines: DataFrame) -> DataFrame:
    """Paired-end alignment summary; a pair counts as two reads, rates are rounded half to even."""
    d, c = _terms(lines, PAIRED_TERMS), F.col
    return _rates(
        d, c("ReadPairsMappedInPE") * 2 + c("ReadsMappedInSE"),
        c("PEUniqueMappedReadPairs") * 2 + c("PEDiscordantlyUniqueMappedReadPairs") * 2 + c("SEUniqueMappedReads"), c("PEMultiMappedReadPairs") * 2 + c("SEMultiMappedReads"),
    )


def single_summary(lines: DataFrame) -> DataFrame:
    d, c = _terms(lines, SINGLE_TERMS), F.col
    return _rates(d, c("ReadsMappedInSE"), c("SEUniqueMappedReads"), c("SEMultiMappedReads"))


def _metrics(lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, m: the metrics row of each file, the line after the one that begins with LIBRARY; null in an empty file. What
    follows (a histogram) doesn't count."""
    shown = ~F.col("line").startswith("#") & (F.trim("line") != "")
    d = _tables(lines, keys, shown).withColumn("at", F.array_position(F.transform("rows", lambda x: x.startswith("LIBRARY")), F.lit(True)).cast("int"))
    head, row = F.when(F.col("at") > 0, F.get("rows", F.col("at") - 1)), F.when(F.col("at") > 0, F.get("rows", F.col("at")))
    return d.select(*keys, _row(head, row).alias("m"))


def duplicate_metrics(lines: DataFrame) -> DataFrame:
    """Duplicate metrics of paired and single reads: FinalReads, DuplicatedReads, PCRDuplicationRate (whole percent). An
    empty file gives nulls."""
    row = _metrics(lines, ["cell_id"])
    v = lambda name: _long("m", name)
    final = v("UNPAIRED_READS_EXAMINED") - v("UNPAIRED_READ_DUPLICATES") + (v("READ_PAIRS_EXAMINED") - v("READ_PAIR_DUPLICATES")) * 2
    dup = v("UNPAIRED_READ_DUPLICATES") + v("READ_PAIR_DUPLICATES") * 2
    out = row.select("cell_id", final.alias("FinalReads"), dup.alias("DuplicatedReads"))
    return out.withColumn("PCRDuplicationRate", ((1 - F.try_divide(F.col("FinalReads"), F.col("FinalReads") + F.col("DuplicatedReads"))) * 100).cast("long"))


def read_duplicate_metrics(lines: DataFrame) -> DataFrame:
    """Duplicate metrics of single reads by read type: MAPQFilteredReads, DuplicatedReads, DuplicationRate (as reported) and
    FinalBismarkReads; zeros for an empty file."""
    row = _metrics(with_read_type(lines), ["cell_id", "read_type"])
    zero = lambda c, t: F.coalesce(c, F.lit(0).cast(t))
    n, dup = zero(_long("m", "UNPAIRED_READS_EXAMINED"), "long"), zero(_long("m", "UNPAIRED_READ_DUPLICATES"), "long")
    rate = zero(F.expr("try_cast(m['PERCENT_DUPLICATION'] as double)"), "double")
    return row.select("cell_id", "read_type", n.alias("MAPQFilteredReads"), dup.alias("DuplicatedReads"), rate.alias("DuplicationRate"), (n - dup).alias("FinalBismarkReads"))


def demultiplex_report(lines: DataFrame) -> DataFrame:
    """Adapters of a trimming report: (cell_id, Sequence, Type, Length, Trimmed, TotalPair, Ratio)."""
    total = lines.withColumn("n", F.regexp_extract("line", r"^Total read pairs processed:\s+([\d,]+)", 1)).where("n <> ''")
    total = total.groupBy("cell_id").agg(F.max(F.regexp_replace("n", ",", "").cast("long")).alias("TotalPair"))
    pattern = r"Sequence: ([^;]+); Type: ([^;]+); Length: (\d+); Trimmed: (\d+) times"
    d = lines.where(F.col("line").rlike(pattern))
    d = d.select("cell_id", *[F.regexp_extract("line", pattern, n).alias(c) for n, c in enumerate(("Sequence", "Type", "Length", "Trimmed"), 1)])
    d = d.withColumn("Length", F.col("Length").cast("long")).withColumn("Trimmed", F.col("Trimmed").cast("long")).join(total, "cell_id", "left")
    return d.withColumn("Ratio", F.try_divide("Trimmed", "TotalPair"))


def read_profile(lines: DataFrame) -> DataFrame:
    """Selected reads from a read profile: ``#key=value`` lines, then mc_frac,cov,count. Thresholds up to 1 are fractions."""
    kv = lines.where(F.col("line").startswith("#") & F.col("line").contains("=")).groupBy("cell_id").agg(
        F.map_from_entries(F.collect_list(F.struct(F.substring(F.split("line", "=")[0], 2, 100), F.trim(F.split("line", "=")[1])))).alias("p")
    )
    row = lines.where(F.col("line").rlike(r"^-?\d+,\d+,\d+$")).withColumn("x", F.split("line", ",").cast("array<bigint>"))
    d = row.join(kv, "cell_id")

    def limit(key: str) -> Column:
        v = F.expr(f"try_cast(p['{key}'] as double)")
        return F.when(v <= 1, v * 100).otherwise(v)

    mode = F.upper(F.col("p")["mode"])
    ok = (d["x"][1] >= F.col("p")["cov_min_threshold"].cast("bigint")) & F.when(mode == "DNA", F.col("x")[0] <= limit("mc_rate_max_threshold")).otherwise(F.col("x")[0] >= limit("mc_rate_min_threshold"))
    out = d.groupBy("cell_id", mode.alias("mode")).agg(F.coalesce(F.sum(F.when(ok, F.col("x")[2])), F.lit(0)).alias("FinalReads"), F.sum(F.col("x")[2]).alias("n"))
    return out.select("cell_id", "mode", "FinalReads", (F.col("FinalReads") / (F.col("n") + 0.0001)).alias("SelectedReadsRatio"))


def feature_summary(lines: DataFrame) -> DataFrame:
    """Counting summary: assigned reads, all Unassigned categories, rate in whole percent."""
    parts = F.split("line", "\t")
    d = lines.select("cell_id", F.get(parts, F.lit(0)).alias("status"), F.expr("try_cast(get(split(line, '\t'), 1) as bigint)").alias("n")).where("n is not null")
    out = d.groupBy("cell_id").agg(
        F.coalesce(F.sum(F.when(F.col("status") == "Assigned", F.col("n"))), F.lit(0)).alias("Assigned"),
        F.coalesce(F.sum(F.when(F.col("status").startswith("Unassigned"), F.col("n"))), F.lit(0)).alias("Unassigned_Total"), F.sum("n").alias("__all"),
    )
    return out.withColumn("AssignedRNAReadsRate", (F.col("Assigned") / (F.col("__all") + 0.00001) * 100).cast("long")).drop("__all")


def barcode_fasta(text: str) -> list[tuple[str, str]]:
    """(index_name, sequence) of alternating lines; > and ^ go."""
    lines = [x.strip() for x in text.splitlines() if x.strip()]
    return [(a.lstrip(">"), b.lstrip("^")) for a, b in zip(lines[::2], lines[1::2])]


def flat_ini(text: str) -> dict[str, str]:
    """Keys of all sections in one dict; a later section wins."""
    import configparser

    c = configparser.ConfigParser()
    c.read_string(text)
    return {k: v for s in c.sections() for k, v in c[s].items()}


SECTIONS = ("CriticalInfo", "LibraryInfo", "PlateInfo")
CRITICAL = ("n_random_index", "input_plate_size", "pool_id", "tube_label", "email")


def plate_info(text: str) -> tuple[dict[str, str], list[dict[str, str]]]:
    """Critical settings and plate rows of a plate-info text: three sections in order, all critical keys, no key twice.

    A plate row has its own columns, those of [LibraryInfo], ``sample_id_prefix`` (all but the plate's fixed columns, joined
    by -) and the critical settings. A plate (V1), or a plate and multiplex group (V2), stands once; of rows with one
    primer_name the first stays.
    """
    critical: dict[str, str] = {}
    library: dict[str, str] = {}
    order: list[str] = []
    header: list[str] = []
    plates: list[dict[str, str]] = []
    for raw in text.splitlines():
        line = raw.split("#")[0].strip()
        if not line:
            continue
        if line.startswith("["):
            order.append(line.strip("[]"))
            if tuple(order) != SECTIONS[: len(order)]:
                raise ValueError(f"sections must be {', '.join(SECTIONS)}, in this order")
        elif order and order[-1] == "PlateInfo":
            row = line.replace(",", " ").split()
            if not header:
                header = row
            else:
                plates.append(dict(zip(header, row)))
        else:
            key, sep, value = (x.strip() for x in line.partition("="))
            if not sep or not order:
                raise ValueError(f"not understood: {line}")
            value = value if key == "email" else "".join(c if c.isascii() and c.isalnum() else "_" for c in value)
            if key in critical or key in library:
                raise ValueError(f"key {key} appears twice")
            if order[-1] == "CriticalInfo" and key not in CRITICAL:
                raise ValueError(f"unknown key {key}")
            (critical if order[-1] == "CriticalInfo" else library)[key] = value
    if tuple(order) != SECTIONS:
        raise ValueError(f"sections must be {', '.join(SECTIONS)}, in this order")
    if missing := [k for k in CRITICAL if k not in critical]:
        raise ValueError(f"missing {', '.join(missing)}")
    if twice := set(header) & (library.keys() | critical.keys()) | library.keys() & critical.keys():
        raise ValueError(f"key {', '.join(sorted(twice))} appears twice")
    if critical["n_random_index"] not in ("8", "384"):
        raise ValueError(f"n_random_index must be 8 or 384, got {critical['n_random_index']}")
    fixed = 2 if critical["n_random_index"] == "8" else 3
    unique = header[: fixed - 1]
    if len({tuple(p.get(c) for c in unique) for p in plates}) != len(plates):
        raise ValueError(f"{', '.join(unique)} repeats")
    out: dict[str, dict[str, str]] = {}
    for p in plates:
        more = [*library.values(), *(p.get(c, "") for c in header[fixed:])]
        row = p | library | {"sample_id_prefix": "-".join(more)} | critical
        out.setdefault(row.get("primer_name") or str(len(out)), row)
    return critical, list(out.values())


#: Terms of the bisulfite aligner's report; values are kept as text.
BISULFITE_TERMS = {
    "Sequence pairs analysed in total": "TotalReads", "Sequences analysed in total": "TotalReads", "Number of alignments with a unique best hit from the different alignments": "UniqueMappedReads",
    "Mapping efficiency": "MappingRate", "Sequences with no alignments under any condition": "UnmappedReads", "Sequences did not map uniquely": "MultiMappedReads",
    "CT/CT": "OT", "CT/GA": "OB", "GA/CT": "CTOT", "GA/GA": "CTOB", "Total number of C's analysed": "TotalC",
    "C methylated in CpG context": "TotalmCGRate", "C methylated in CHG context": "TotalmCHGRate", "C methylated in CHH context": "TotalmCHHRate",
}


def bisulfite_report(lines: DataFrame) -> DataFrame:
    """One text column per known term of ``term: value`` lines, null where missing."""
    parts = F.split("line", ":")
    d = lines.where(F.size(parts) == 2).select("cell_id", F.trim(parts[0], F.lit(" \t")).alias("t"), F.split(F.trim(F.get(parts, F.lit(1)), F.lit(" \t")), "[ \t]")[0].alias("v"))
    names = sorted(set(BISULFITE_TERMS.values()))
    return d.groupBy("cell_id").agg(*[F.max(F.when(F.col("t").isin(*[t for t, m in BISULFITE_TERMS.items() if m == n]), F.col("v"))).alias(n) for n in names])


def trim_table(lines: DataFrame) -> DataFrame:
    """Trimming statistics of one pass: the row below the header of a tab-separated table, as (cell_id, metric, value)."""
    d = _tables(lines, ["cell_id"], F.col("line").contains("\t")).withColumn("m", _row(F.get("rows", F.lit(0)), F.get("rows", F.lit(1))))
    out = d.where("m is not null").select("cell_id", F.explode("m").alias("metric", "value"))
    return out.withColumn("value", F.expr("try_cast(value as bigint)")).where("value is not null")


def trim_stats(lines: DataFrame) -> DataFrame:
    """Trimming statistics of two passes, stacked in one table (header, first row, header, second row), by read type: what
    goes in and its adapters from the first, quality trimming and what comes out from the second."""
    d = _tables(with_read_type(lines), ["cell_id", "read_type"], F.col("line").contains("\t"))
    d = d.withColumn("a", _row(F.get("rows", F.lit(0)), F.get("rows", F.lit(1)))).withColumn("b", _row(F.get("rows", F.lit(2)), F.get("rows", F.lit(3))))
    pick = {"InputReads": ("a", "in_reads"), "InputReadsBP": ("a", "in_bp"), "WithAdapters": ("a", "w/adapters"), "QualTrimBP": ("b", "qualtrim_bp"), "TrimmedReads": ("b", "out_reads"), "TrimmedReadsBP": ("b", "out_bp")}
    out = d.select("cell_id", "read_type", *[_long(m, n).alias(c) for c, (m, n) in pick.items()])
    return out.withColumn("TrimmedReadsRate", F.try_divide("TrimmedReads", "InputReads"))


def adapter_stats(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of a report on several adapters that ends with a two-line table: (cell_id, read_type, InputReads, QualTrimBP,
    TrimmedReads, TrimmedReadsBP, TrimmedReadsRate), and (cell_id, read_type, adapter, trimmed)."""
    d = _tables(with_read_type(lines), ["cell_id", "read_type"], F.trim("line") != "")
    n = F.size("rows")
    d = d.withColumn("m", _row(F.get("rows", n - 2), F.get("rows", n - 1))).withColumn("text", F.array_join("rows", "\n"))
    total = F.regexp_replace(F.regexp_extract("text", r"=== Summary ===\n[^\n]*?([\d,]+)(?:\n|$)", 1), ",", "")
    out = d.select("cell_id", "read_type", total.try_cast("bigint").alias("InputReads"), _long("m", "qualtrim_bp").alias("QualTrimBP"), _long("m", "out_reads").alias("TrimmedReads"), _long("m", "out_bp").alias("TrimmedReadsBP"))
    pattern = r"=== Adapter ([^=\n]*?) *===\n[^\n]*?Trimmed: (\d+) times"
    names, counts = (F.regexp_extract_all("text", F.lit(pattern), F.lit(k)) for k in (1, 2))
    adapters = d.select("cell_id", "read_type", F.inline(F.arrays_zip(names.alias("adapter"), counts.alias("trimmed")))).withColumn("trimmed", F.col("trimmed").cast("long"))
    return out.withColumn("TrimmedReadsRate", F.try_divide("TrimmedReads", "InputReads")), adapters


#: Parsers of cell reports by name; a caller may add its own: lines (cell_id, nr, line) in, one row per cell out.
PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "paired_summary": paired_summary, "single_summary": single_summary, "duplicate_metrics": duplicate_metrics, "read_profile": read_profile, "feature_summary": feature_summary,
    "trim_stats": trim_stats, "read_duplicate_metrics": read_duplicate_metrics, "bisulfite_report": bisulfite_report,
}


def parse_reports(spark: SparkSession, path: str | list[str], parser: str | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All reports below a path through one parser, by name or given."""
    if isinstance(parser, str) and parser not in PARSERS:
        raise ValueError(f"parser must be one of {', '.join(PARSERS)}, got {parser}")
    return (PARSERS[parser] if isinstance(parser, str) else parser)(lines_of(spark, path))


def fixed_width(lines: DataFrame, header: str, names: list[str]) -> DataFrame:
    """Columns of scheduler listings, cut where each name begins in the header line."""
    at = [header.index(n) for n in names]
    ends = [*at[1:], 1 << 16]
    cols = [F.trim(F.substring("line", a + 1, b - a)).alias(n) for n, a, b in zip(names, at, ends)]
    return lines.where((F.col("line") != header) & ~F.col("line").rlike("^[- ]*$")).select(*cols)


def mapping_config(ini: list[str], overrides: list[dict] = ()) -> dict[str, str]:
    """Settings of several INI texts, later ones win; ``overrides`` (from YAML) win over all."""
    out: dict[str, str] = {}
    for text in ini:
        out |= flat_ini(text)
    for more in overrides:
        out |= {k: str(v) for k, v in more.items()}
    return out


def find_config(folder: str = ".") -> dict[str, str]:
    """Settings of the run in ``folder``: of YAML files named mapping_config or config, there or one folder up, the last found in
    the order config, config above, mapping_config, mapping_config above counts; without any, INI files in the same way;
    without those, none."""
    from pathlib import Path

    places = [Path(d) / name for name in ("config", "mapping_config") for d in (folder, f"{folder}/..")]
    yaml = [p for place in places for end in (".yaml", ".yml") if (p := place.with_name(place.name + end)).exists()]
    ini = [p for place in places if (p := place.with_name(place.name + ".ini")).exists()]
    if yaml:
        return flat_yaml(yaml[-1].read_text())
    return flat_ini(ini[-1].read_text()) if ini else {}


def flat_yaml(text: str) -> dict[str, str]:
    """``key: value`` lines, at any depth; quotes and comments go."""
    out: dict[str, str] = {}
    for raw in text.splitlines():
        key, sep, value = raw.partition(":")
        value = value.strip()
        value = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value.split(" #")[0].strip()
        if sep and key.strip() and not key.lstrip().startswith(("#", "-")) and value:
            out[key.strip()] = value
    return out


REQUIRED = object()
_ADAPTERS = {"r1_adapter": "AGATCGGAAGAGCACACGTCTGAAC", "r2_adapter": "AGATCGGAAGAGCGTCGTGTAGGGA"}
#: Defaults of a mapping run, with their types; REQUIRED ones have none.
DEFAULTS: dict[str, dict[str, object]] = {
    "mc": {
        "overlap": 6, "r1_left_cut": 10, "r1_right_cut": 10, "r2_left_cut": 10, "r2_right_cut": 10, "quality_threshold": 20, "length_threshold": 30, "total_read_pairs_min": 1, "total_read_pairs_max": 6_000_000,
        "mapq_threshold": 10, "num_upstr_bases": 0, "num_downstr_bases": 2, "compress_level": 5, "unmapped_fastq": False, "mc_stat_feature": "CHN CGN CCC", "mc_stat_alias": "mCH mCG mCCC",
        "barcode_version": REQUIRED, "bismark_reference": REQUIRED, "hisat3n_dna_reference": REQUIRED, "hisat3n_repeat_index_type": "no-repeat", "reference_fasta": REQUIRED, "chrom_size_path": REQUIRED, **_ADAPTERS,
    },
    "mct": {
        "mc_rate_max_threshold": 0.5, "mc_rate_min_threshold": 0.9, "dna_cov_min_threshold": 3, "rna_cov_min_threshold": 3, "hisat3n_rna_reference": REQUIRED, "star_reference": REQUIRED, "gtf_path": REQUIRED,
        "feature_type": "gene", "id_type": "gene_id", "nome_flag_str": "",
    },
    "m3c": {"split_left_size": 40, "split_right_size": 40, "split_middle_min_size": 30, "trim_on_both_end": 5, "min_gap": 2500},
    "4m": {"nome_flag_str": "--nome"},
}
#: Settings of one aligner; those of the other aren't required.
_GENERAL, _SPLICED = ("hisat3n_dna_reference", "hisat3n_rna_reference", "hisat3n_repeat_index_type"), ("bismark_reference", "star_reference")


def typed_config(mode: str, given: dict[str, str], strict: bool = False) -> dict[str, object]:
    """Defaults of a mode with the given values in their types; unknown modes and values that don't fit raise. ``strict``: so
    do settings without a default that aren't given, but for those of the aligner that isn't used."""
    parts = {"mc": ("mc",), "mct": ("mc", "mct"), "m3c": ("mc", "m3c"), "4m": ("mc", "mct", "m3c", "4m")}
    if mode not in parts:
        raise ValueError(f"mode must be one of {', '.join(parts)}, got {mode}")
    out: dict[str, object] = {k: v for p in parts[mode] for k, v in DEFAULTS[p].items()}
    for k in _SPLICED if "hisat3n_dna_reference" in given else _GENERAL:
        out.pop(k, None)

    def typed(k: str, v: str) -> object:
        default = out.get(k, REQUIRED)
        if isinstance(default, bool):
            return str(v).strip().lower() in ("true", "1", "yes")
        return v if default is REQUIRED else type(default)(v)

    out |= {k: typed(k, v) for k, v in given.items()}
    missing = sorted(k for k, v in out.items() if v is REQUIRED)
    if strict and missing:
        raise ValueError(f"missing {', '.join(missing)}")
    return {k: v for k, v in out.items() if v is not REQUIRED}


def sample_sheet_text(header: str, rows: list[dict[str, str]]) -> str:
    """A sheet of a few thousand rows: header, column line, one line per sample."""
    if not rows:
        return header
    names = list(rows[0])
    return header.rstrip("\n") + "\n" + "\n".join([",".join(names), *[",".join(str(r[n]) for n in names) for r in rows]]) + "\n"
