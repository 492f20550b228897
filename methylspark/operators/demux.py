"""Demultiplexing: file names, barcodes, statistics, cell selection, sample sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_fastq_name(path: Column, version: str) -> dict[str, Column]:
    """Fields of a raw FASTQ file name, null where malformed.

    V1: ...-plate1-plate2-A1_S1_L001_R1_001.fastq.gz with rows A-H and columns 1-12 and two different plates;
    V2: ...-plate-group-A1_S1_L001_R1_001.fastq.gz with groups 1-6, rows A-P and columns 1-24.
    """
    name = F.element_at(F.split(path, "/"), -1)
    well = "[A-H](?:[1-9]|1[0-2])" if version == "V1" else "[A-P](?:[1-9]|1[0-9]|2[0-4])"
    second = "[^-_]+" if version == "V1" else "[1-6]"
    pattern = rf"^(?:.*-)?([^-_]+)-({second})-({well})_[^_]+_(L00[1-4])_(R[12])_[^_]+$"
    a, b, c, lane, read = (F.nullif(F.regexp_extract(name, pattern, n), F.lit("")) for n in range(1, 6))
    ok = a.isNotNull() if version == "V2" else a.isNotNull() & (a != b)
    fields = ("plate1", "plate2", "plate_pos") if version == "V1" else ("plate", "multiplex_group", "primer_name")
    out = {f: F.when(ok, v) for f, v in zip((*fields, "lane", "read_type"), (a, b, c, lane, read))}
    return out | {"uid": F.when(ok, F.concat_ws("-", a, b, c)), "valid": F.coalesce(ok, F.lit(False))}


def repeated_uids(catalog: DataFrame) -> DataFrame:
    """Libraries named twice in one lane and read type."""
    return catalog.groupBy("lane", "read_type", "uid").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


#: Cell FASTQ names: the cell, - or _, the read in either case, the suffix.
CELL_FASTQ = r"^(.+)[-_]([Rr][12])\.(?:fastq|fq)(?:\.gz)?$"


def cell_fastqs(files: DataFrame, path: str = "path") -> DataFrame:
    """(cell_id, read_type, path) of cell FASTQ files; names that don't fit, and trimmed ones, go."""
    name = F.substring_index(path, "/", -1)
    d = files.select(F.regexp_extract(name, CELL_FASTQ, 1).alias("cell_id"), F.upper(F.regexp_extract(name, CELL_FASTQ, 2)).alias("read_type"), F.col(path).alias("path"))
    return d.where((F.col("cell_id") != "") & ~F.substring_index("path", "/", -1).contains("trim"))


def pair_reads(files: DataFrame) -> DataFrame:
    """R1 and R2 path of each cell (cell_id, read_type, path); a missing mate is null, of two of a kind the last name counts."""
    return files.groupBy("cell_id").agg(*[F.max(F.when(F.col("read_type") == r, F.col("path"))).alias(r) for r in ("R1", "R2")])


def checked_pairs(files: DataFrame) -> DataFrame:
    """``pair_reads`` of cells that have each mate once; raises where a cell lacks a mate or has one twice, or there is none."""
    wrong = files.groupBy("cell_id").agg(F.count_if(F.col("read_type") == "R1").alias("n1"), F.count_if(F.col("read_type") == "R2").alias("n2"))
    if files.isEmpty():
        raise ValueError("no FASTQ file has the expected name")
    if bad := wrong.where("n1 <> 1 or n2 <> 1").orderBy("cell_id").take(3):
        raise ValueError(f"not one R1 and one R2: {', '.join(r['cell_id'] for r in bad)}")
    return pair_reads(files)


def deal_groups(cells: DataFrame, n: int = 64, seed: int = 0) -> DataFrame:
    """Cells in ``n`` groups of nearly equal number, in a shuffled but reproducible order: by rank of a hash, which is
    counted inside 4096 ranges of the hash."""
    from pyspark.sql import Window

    from methylspark.operators.intervals import carried

    d = cells.withColumn("__hash", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("cell_id", F.lit(""))))).withColumn("__range", F.substring("__hash", 1, 3))
    d = carried(d, [], "__range", {"__less": (F.lit(1), "sum")})
    nr = F.row_number().over(Window.partitionBy("__range").orderBy("__hash", "cell_id"))
    return d.withColumn("group", F.pmod(F.coalesce("__less", F.lit(0)) + nr - 1, F.lit(n)).cast("long")).drop("__hash", "__range", "__less")


def demultiplex(reads: DataFrame, barcodes: DataFrame, length: int, by_group: bool = False) -> DataFrame:
    """Adds index_name (null if unknown) and strips the barcode that begins R1.

    At the usual error rate of 0.01 no error fits in 6 or 8 bases, so the match is an equi-join on the prefix. ``by_group``:
    barcodes also have the multiplex group of the read's library. The table of barcodes has at most 384 rows.
    """
    b = barcodes.select(F.col("barcode").alias("__b"), "index_name", *([F.col("multiplex_group").alias("__g")] if by_group else []))
    on = F.substring("seq", 1, length) == F.col("__b")
    if by_group:
        on &= F.col("multiplex_group") == F.col("__g")
    out = reads.join(F.broadcast(b), on, "left")
    out = out.withColumn("seq", F.when(F.col("__b").isNotNull(), F.substring("seq", F.lit(length + 1), F.length("seq"))).otherwise(F.col("seq")))
    return out.drop("__b", "__g")


def demultiplex_stats(df: DataFrame) -> DataFrame:
    """Per cell over lanes: trimmed reads, all pairs, their ratio. df: uid, index_name, trimmed, total_pair."""
    out = df.groupBy(F.concat_ws("-", "uid", "index_name").alias("cell_id")).agg(
        F.sum("trimmed").alias("CellInputReadPairs"), F.sum("total_pair").alias("MultiplexedTotalReadPairs"), F.min("index_name").alias("IndexName"), F.min("uid").alias("UID")
    )
    return out.withColumn("CellBarcodeRate", F.try_divide("CellInputReadPairs", "MultiplexedTotalReadPairs"))


def select_cells(df: DataFrame, count: str, least: int = 1, most: int = 6_000_000) -> DataFrame:
    """``kept``: whether a cell has neither too few nor too many read pairs."""
    return df.withColumn("kept", F.col(count).between(least, most))


def uid_priority(df: DataFrame, count: str) -> DataFrame:
    """Libraries by descending input."""
    return df.where("kept").groupBy("UID").agg(F.sum(count).alias("input")).orderBy(F.desc("input"), "UID")


def barcode_groups(reads: DataFrame, group: str = "multiplex_group") -> bool:
    """Whether barcodes have to be looked up by multiplex group: the library has more than one."""
    return reads.select(group).distinct().limit(2).count() > 1


SHEET = ("Sample_ID", "Sample_Name", "Sample_Plate", "Sample_Well", "I7_Index_ID", "index", "I5_Index_ID", "index2", "Sample_Project", "Description")


def sample_rows(plates: DataFrame, primers: DataFrame, version: str, reverse_i5: bool = False) -> DataFrame:
    """The samples of a run as rows of a sheet.

    V1: two plates share a primer quarter (alone, a plate goes with GHOST_PLATE) and each of the 96 positions of the quarter
    is a sample; V2: each plate row is one, by its primer_name. plates: plate_id, sample_id_prefix, tube_label, email, and
    primer_quarter with ``nr``, the row's number (V1), or multiplex_group and primer_name (V2); primers: i7, i5, and
    primer_quarter, plate_pos (V1), or primer_name (V2). Raises where three plates share a quarter or a primer is unknown.
    """
    from methylspark.functions.sequence import clean_name, reverse_complement

    if version == "V1":
        quarter = plates.groupBy("primer_quarter").agg(F.array_sort(F.collect_list(F.struct("nr", "plate_id", "sample_id_prefix", "tube_label", "email"))).alias("p"))
        if bad := quarter.where(F.size("p") > 2).select("primer_quarter").take(1):
            raise ValueError(f"{bad[0][0]} has more than two plates")
        first, second = F.get("p", F.lit(0)), F.coalesce(F.get("p", F.lit(1))["plate_id"], F.lit("GHOST_PLATE"))
        d = quarter.select("primer_quarter", first["sample_id_prefix"].alias("sample_id_prefix"), first["tube_label"].alias("tube_label"), first["email"].alias("email"),
                           clean_name(first["plate_id"]).alias("p1"), clean_name(second).alias("p2"))
        key, parts = "primer_quarter", ("sample_id_prefix", "p1", "p2", "plate_pos")
    elif version == "V2":
        d, key, parts = plates.withColumn("p1", clean_name(F.col("plate_id"))), "primer_name", ("sample_id_prefix", "p1", "multiplex_group", "primer_name")
    else:
        raise ValueError(f"version must be V1 or V2, got {version}")
    if bad := d.join(F.broadcast(primers.select(key).distinct()), key, "left_anti").select(key).take(1):  # a few hundred primers
        raise ValueError(f"unknown {key} {bad[0][0]}")
    d = d.join(F.broadcast(primers), key)
    i5 = reverse_complement(F.col("i5")) if reverse_i5 else F.col("i5")
    none = F.lit("")
    return d.select(
        F.concat_ws("-", *parts).alias("Sample_ID"), none.alias("Sample_Name"), F.lit("Plate").alias("Sample_Plate"), none.alias("Sample_Well"), none.alias("I7_Index_ID"),
        F.col("i7").alias("index"), none.alias("I5_Index_ID"), i5.alias("index2"), F.col("tube_label").alias("Sample_Project"), F.col("email").alias("Description"),
    )


def by_lane(sheet: DataFrame, lanes: int = 4) -> DataFrame:
    """The sheet once for each lane of a flow cell."""
    return sheet.withColumn("Lane", F.explode(F.sequence(F.lit(1), F.lit(lanes)))).select("Lane", *sheet.columns)


def sample_sheets(plates: DataFrame, primers: DataFrame, version: str) -> dict[str, DataFrame]:
    """The three sheets of a run: ``miseq``, ``novaseq.v1`` (once a lane) and ``novaseq.V1.5`` (with i5 reversed and complemented)."""
    rows = sample_rows(plates, primers, version)
    return {"miseq": rows, "novaseq.v1": by_lane(rows), "novaseq.V1.5": by_lane(sample_rows(plates, primers, version, True))}


def fastq_paths(spark, where: str | list[str]) -> list[str]:
    """Paths from a list, a glob, or a text file that has one a line."""
    if not isinstance(where, str):
        return list(where)
    if not any(c in where for c in "*?[{") and not where.endswith((".fastq", ".fq", ".gz")):
        return [r[0].strip() for r in spark.read.text(where).collect() if r[0].strip()]
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(where)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [])


def fastq_catalog(spark, paths: str | list[str], version: str) -> DataFrame:
    """The files of a run (a list, a glob or a file of paths), one row each; raises if there is none, a name is malformed or
    a library appears twice in a lane and read type."""
    names = fastq_paths(spark, paths)
    if not names:
        raise ValueError("no FASTQ file found")
    df = spark.createDataFrame([(p,) for p in names], "fastq_path string")
    out = df.select("fastq_path", *[c.alias(n) for n, c in parse_fastq_name(F.col("fastq_path"), version).items()])
    if bad := out.where(~F.col("valid")).select("fastq_path").take(3):
        raise ValueError(f"file names not understood: {', '.join(r[0] for r in bad)}")
    if twice := repeated_uids(out).take(3):
        raise ValueError(f"libraries named twice: {', '.join(r['uid'] for r in twice)}")
    return out.drop("valid")
