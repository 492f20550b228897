"""Record formats: FASTQ and SAM text in, ALLC, contact and summary tables in and out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALLC = T.StructType([
    T.StructField("chrom", T.StringType()), T.StructField("pos", T.LongType()), T.StructField("strand", T.StringType()), T.StructField("context", T.StringType()),
    T.StructField("mc", T.IntegerType()), T.StructField("cov", T.IntegerType()), T.StructField("sig", T.IntegerType()),
])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bool, pa.RecordBatch]]:
    """((path, at), whether it begins here, rows) for each stretch of rows of one split; columns value, path, at."""
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at, path = batch.column(2).to_numpy(), batch.column(1).dictionary_encode()
        code = path.indices.to_numpy()
        starts = [0, *(np.flatnonzero((at[1:] != at[:-1]) | (code[1:] != code[:-1])) + 1).tolist(), len(at)]
        for a, b in zip(starts, starts[1:]):
            now = (path.dictionary[int(code[a])].as_py(), int(at[a]))
            yield now, now != key, batch.slice(a, b - a)
            key = now


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split: how many lines it has, the first three and the last three."""
    key, n, head, tail = None, 0, [], []

    def row() -> pa.RecordBatch:
        texts = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((key[0], pa.string()), (key[1], pa.int64()), (n, pa.int64()), (head, texts), (tail, texts))], names=["path", "at", "n", "head", "tail"])

    for now, fresh, rows in _runs(batches):
        if fresh:
            if key is not None:
                yield row()
            key, n, head, tail = now, 0, [], []
        lines = rows.column(0)
        head = (head + lines.slice(0, 3 - len(head)).to_pylist()) if len(head) < 3 else head
        tail = (tail + lines.slice(max(0, len(lines) - 3)).to_pylist())[-3:]
        n += len(lines)
    if key is not None:
        yield row()


def _record(name: Column, seq: Column, qual: Column, path: Column) -> list[Column]:
    return [F.regexp_extract(name, "^.?([^ ]*)", 1).alias("read_name"), seq.alias("seq"), qual.alias("qual"), path.alias("path")]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that lie in one split; column ``phase`` tells how far into a record the split begins."""
    held, skip = pa.array([], pa.string()), 0
    for (path, _), fresh, rows in _runs(batches):
        if fresh:
            held, skip = pa.array([], pa.string()), -int(rows.column(3)[0].as_py()) % 4
        lines = rows.column(0)
        cut = min(skip, len(lines))
        skip -= cut
        lines = pa.concat_arrays([held, lines.slice(cut)])
        m = len(lines) // 4
        held = lines.slice(4 * m)
        names, seqs, quals = (lines.take(pa.array(np.arange(k, 4 * m, 4))) for k in (0, 1, 3))
        yield pa.RecordBatch.from_arrays([names, seqs, quals, pa.array([path] * m, pa.string())], names=["name", "seq", "qual", "path"])


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Four-line records: read_name (to the first space), seq, qual, path.

    Spark splits plain files at any line. A first pass counts the lines of each split and keeps the three at either end;
    with the counts, each task knows where records begin in its split, and records that cross splits are put together
    from the kept lines alone. Compressed files are one split each and need no first pass.
    """
    d = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    schema = "name string, seq string, qual string, path string"
    if all(f.endswith((".gz", ".bz2", ".zst", ".xz")) for f in d.inputFiles()):
        found = d.withColumn("phase", F.lit(0).cast("long")).mapInArrow(_whole, schema)
        return found.select(*_record(*map(F.col, ("name", "seq", "qual", "path"))))
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    edges = d.mapInArrow(_edges, "path string, at long, n long, head array<string>, tail array<string>").withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    phases = edges.select("path", "at", F.pmod("base", F.lit(4)).alias("phase"))
    found = d.join(F.broadcast(phases), ["path", "at"]).select("value", "path", "at", "phase")  # a row for each split; lines stay in order
    inside = found.mapInArrow(_whole, schema).select(*_record(*map(F.col, ("name", "seq", "qual", "path"))))
    lead = F.least(F.pmod(-F.col("base"), F.lit(4)), F.col("n"))  # lines that belong to a record begun before
    rest = F.when(F.col("n") > lead, F.pmod(F.col("base") + F.col("n"), F.lit(4))).otherwise(0)  # and to one not ended
    numbered = lambda lines, first: F.transform(lines, lambda x, k: F.struct((first + k).alias("nr"), x.alias("line")))
    first = numbered(F.slice("head", F.lit(1), lead.cast("int")), F.col("base"))
    last = numbered(F.slice("tail", (F.size("tail") - rest + 1).cast("int"), rest.cast("int")), F.col("base") + F.col("n") - rest)
    cross = edges.select("path", F.inline(F.concat(first, last))).groupBy("path", F.floor(F.col("nr") / 4).alias("k")).agg(F.array_sort(F.collect_list(F.struct("nr", "line"))).alias("x"))
    cross = cross.where(F.size("x") == 4).select(*_record(F.col("x")[0]["line"], F.col("x")[1]["line"], F.col("x")[3]["line"], F.col("path")))
    return inside.unionByName(cross)


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text with 0-based positions and hot tags as columns."""
    f = F.split("value", "\t")
    d = spark.read.text(path).where(~F.col("value").startswith("@")).withColumn("f", f)
    tags = F.map_from_entries(F.transform(F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, 6, 1 << 20))))
    d = d.select(
        F.col("f")[0].alias("qname"), F.col("f")[1].cast("int").alias("flag"), F.col("f")[2].alias("chrom"), (F.col("f")[3].cast("long") - 1).alias("pos"), F.col("f")[4].cast("int").alias("mapq"),
        F.col("f")[5].alias("cigar"), F.col("f")[9].alias("seq"), F.col("f")[10].alias("qual"), tags.alias("tags"),
    )
    ref = F.aggregate(F.transform(F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), F.lit(1)), lambda n: n.cast("long")), F.lit(0).cast("long"), lambda a, n: a + n)
    get = {"yz": "YZ", "xm": "XM", "rg": "RG", "st": "ST"}
    d = d.withColumn("ref_len", ref).withColumn("end", F.col("pos") + ref).withColumn("qlen", F.length("seq"))
    d = d.withColumns({c: F.col("tags")[t] for c, t in get.items()})
    return d.withColumns({c: F.expr(f"try_cast(tags['{t}'] as int)") for c, t in {"as_score": "AS", "ss": "SS", "se": "SE"}.items()})


def read_allc(spark: SparkSession, path: str) -> DataFrame:
    """Site tables, tab-separated, plain or gzip, with the sample from the file name."""
    d = spark.read.schema(ALLC).csv(path, sep="\t")
    return d.withColumn("sample", F.substring_index(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), ".", 1))


def write_sites(df: DataFrame, path: str, partitions: int) -> None:
    """Site store: a folder per chromosome, files sorted by position, so a range read prunes folders and row groups."""
    df.repartitionByRange(partitions, "chrom", "pos").sortWithinPartitions("chrom", "pos").write.partitionBy("chrom").mode("overwrite").parquet(path)


def in_region(sites: DataFrame, chrom: str, start: int, end: int) -> DataFrame:
    """Sites with start <= pos < end of one chromosome."""
    return sites.where((F.col("chrom") == chrom) & (F.col("pos") >= start) & (F.col("pos") < end))


def fetch_region(spark: SparkSession, path: str, chrom: str, start: int, end: int) -> DataFrame:
    """``in_region`` of a site store: only the chromosome's folder and the row groups around the range are read."""
    return in_region(spark.read.parquet(path), chrom, start, end)


def write_summary(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def write_contacts(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("cell_id").option("sep", "\t").csv(path)


def split_by_cluster(df: DataFrame, clusters: DataFrame, path: str, key: str = "rg") -> None:
    """Reads of known groups into a folder for each cluster."""
    df.join(clusters, key).write.mode("overwrite").partitionBy("cluster").parquet(path)


def allc_paths(spark: SparkSession, path: str) -> DataFrame:
    """(cell_id, path) of the site tables below a path."""
    d = spark.read.format("binaryFile").load(path).select("path")
    return d.select(F.substring_index(F.element_at(F.split("path", "/"), -1), ".", 1).alias("cell_id"), "path")


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Named tables, one folder each below ``path``, as Parquet; None is left out."""
    for name, df in tables.items():
        if df is not None:
            df.write.mode("overwrite").parquet(f"{path}/{name}")


def name_sorted(reads: DataFrame, name: str = "read_name") -> DataFrame:
    """Reads in the order of their names."""
    return reads.orderBy(name)


def coordinate_sorted(df: DataFrame, partitions: int, chrom: str = "chrom", pos: str = "pos") -> DataFrame:
    """Rows in the order of chromosome and position over all partitions: what a coordinate-sorted file holds."""
    return df.repartitionByRange(partitions, chrom, pos).sortWithinPartitions(chrom, pos)
