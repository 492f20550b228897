"""Queries over the carrier views, each with the same result in DuckDB SQL."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from methylspark.catalog import register
from methylspark.functions import sequence as X
from methylspark.operators import contacts as C
from methylspark.operators import demux as D
from methylspark.operators import dmr as M
from methylspark.operators import intervals as I
from methylspark.operators import reads as R
from methylspark.operators import sites as S
from methylspark.operators import summary as Y
from methylspark.plans.carriers import oracle, view
from methylspark.sources import formats, reports
from methylspark.streaming import cells as ST

PATTERNS = {"CHN": "mCH", "CGN": "mCG", "CCC": "mCCC"}
_RC = "translate(reverse(seq), 'ACGTacgtnN', 'TGCAtGCanN')"


def _regex(pattern: str) -> str:
    return "^" + "".join(f"[{X.IUPAC[b]}]" for b in pattern) + "$"


# Scalars


@register("x1_reverse_complement", oracle(f"SELECT read_id, {_RC} AS rc FROM v_reads", "v_reads"))
def x1(spark, d):
    return view(spark, d, "v_reads").select("read_id", X.reverse_complement(F.col("seq")).alias("rc"))


@register("x2_complement", oracle("SELECT read_id, CASE WHEN regexp_matches(seq, '^[ACGTN]*$') THEN translate(seq, 'ACGTN', 'TGCAN') ELSE seq END AS c FROM v_reads", "v_reads"))
def x2(spark, d):
    return view(spark, d, "v_reads").select("read_id", X.complement(F.col("seq")).alias("c"))


@register(
    "x3_pattern_contexts",
    oracle(" UNION ALL ".join(f"SELECT '{p}' AS pattern, count(*) AS n_sites, CAST(sum(mc) AS BIGINT) AS mc FROM v_allc WHERE regexp_matches(context, '{_regex(p)}')" for p in ("CHN", "CGN", "CYN")), "v_allc"),
)
def x3(spark, d):
    """Site counts by pattern through the broadcast dimension of expanded contexts (J13)."""
    dim = F.broadcast(S.pattern_dimension(spark, ["CHN", "CGN", "CYN"]))  # at most 5^3 contexts a pattern
    by = view(spark, d, "v_allc").groupBy("context").agg(F.count(F.lit(1)).alias("n"), F.sum("mc").alias("mc"))
    return by.join(dim, "context").groupBy("pattern").agg(F.sum("n").alias("n_sites"), F.sum("mc").alias("mc"))


@register("x4_clean_name", "SELECT c_custkey, regexp_replace(trim(c_name), '[^a-zA-Z0-9]', '_', 'g') AS name FROM customer")
def x4(spark, d):
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", X.clean_name(F.col("c_name")).alias("name"))


@register(
    "x6_plate_position_v2",
    oracle(
        """SELECT cell_id, split_part(cell_id,'-',1) AS "Plate", split_part(cell_id,'-',2) AS "MultiplexGroup", split_part(cell_id,'-',3) AS "PCRIndex", split_part(cell_id,'-',4) AS "RandomIndex",
        CAST(substring(split_part(cell_id,'-',4),2) AS BIGINT) - 1 AS "Col384", CAST(ascii(split_part(cell_id,'-',4)) - 65 AS BIGINT) AS "Row384" FROM v_cell""",
        "v_cell",
    ),
)
def x6(spark, d):
    return view(spark, d, "v_cell").select("cell_id", *[c.alias(n) for n, c in X.position_v2(F.col("cell_id")).items()])


@register(
    "x8_regroup_v2",
    oracle(
        """SELECT cell_no, concat(split_part(cell_id,'-',1), '-', CAST(CAST(((CAST(substring(split_part(cell_id,'-',4),2) AS INT) - 1) % 12) // 2 + 1 AS BIGINT) AS VARCHAR), '-', split_part(cell_id,'-',3), '-', split_part(cell_id,'-',4)) AS cell_id FROM v_cell""",
        "v_cell",
    ),
)
def x8(spark, d):
    return view(spark, d, "v_cell").select("cell_no", X.regroup_v2(F.col("cell_id")).alias("cell_id"))


@register("x16_region_string", oracle("SELECT gene_id, concat(chrom, ':', CAST(g_start AS VARCHAR), '-', CAST(g_end AS VARCHAR)) AS region FROM v_gene", "v_gene"))
def x16(spark, d):
    return view(spark, d, "v_gene").select("gene_id", X.region(F.col("chrom"), F.col("g_start"), F.col("g_end")).alias("region"))


# Reads


@register(
    "f1_unique_multi",
    oracle(
        """SELECT align_class, read_type, count(*) AS n FROM (SELECT *, CASE WHEN mapq > 10 THEN 'unique' WHEN mapq > 0 THEN 'multi' ELSE 'unmappable' END AS align_class FROM v_align WHERE ref_len >= 40) t
        WHERE NOT (align_class = 'multi' AND (flag & 256) <> 0) GROUP BY align_class, read_type""",
        "v_align",
    ),
)
def f1(spark, d):
    out = R.classify_alignments(view(spark, d, "v_align"), qlen_cutoff=40, qlen="ref_len")
    return out.groupBy("align_class", "read_type").agg(F.count(F.lit(1)).alias("n"))


@register("f2_min_mapq", oracle("SELECT seq, mapq FROM v_align WHERE mapq >= 10", "v_align"))
def f2(spark, d):
    return R.min_mapq(view(spark, d, "v_align"), 10).select("seq", "mapq")


@register("f3_strand_flag", oracle("SELECT seq, CASE WHEN yz = '+' THEN f - (f & m) ELSE f | m END AS flag FROM (SELECT seq, yz, f, CASE WHEN f % 2 = 1 THEN 48 ELSE 16 END AS m FROM (SELECT seq, yz, flag + CAST(seq % 2 AS INT) + CASE WHEN seq % 4 < 2 THEN 32 ELSE 0 END AS f FROM v_align) a) b", "v_align"))
def f3(spark, d):
    """Half the reads are paired, and half have a reverse mate."""
    v = view(spark, d, "v_align").withColumn("flag", F.col("flag") + (F.col("seq") % 2).cast("int") + F.when(F.col("seq") % 4 < 2, 32).otherwise(0))
    return v.select("seq", R.strand_flag(F.col("flag"), F.col("yz")).alias("flag"))


@register("f4_to_fastq", oracle("SELECT read_id, concat('@', CAST(read_id AS VARCHAR), '_', CAST(read_type AS VARCHAR), chr(10), seq, chr(10), '+', chr(10), repeat('I', length(seq))) AS record FROM v_reads", "v_reads"))
def f4(spark, d):
    v = view(spark, d, "v_reads")
    return v.select("read_id", R.to_fastq(F.col("read_id").cast("string"), F.col("read_type"), F.col("seq"), F.expr("repeat('I', length(seq))")).alias("record"))


_LEVEL = """lv AS (SELECT *, length(xm) - length(translate(xm,'XH','')) AS mc, length(xm) - length(translate(xm,'XHxh','')) AS cov FROM v_calls),
 lf AS (SELECT *, coalesce(CAST(mc AS DOUBLE) / nullif(cov, 0), 0e0) AS frac FROM lv)"""


@register("r4_call_string_level", oracle(f"WITH {_LEVEL} SELECT read_id, CAST(mc AS BIGINT) AS mc, CAST(cov AS BIGINT) AS cov, frac FROM lf", "v_calls", "v_reads"))
def r4(spark, d):
    return R.call_string_level(view(spark, d, "v_calls")).select("read_id", "mc", "cov", "frac")


@register("f5_select_dna_reads", oracle(f"WITH {_LEVEL} SELECT cell_id, count(*) AS n FROM lf WHERE frac <= 5e-1 AND cov >= 3 GROUP BY cell_id", "v_calls", "v_reads"))
def f5(spark, d):
    return R.select_reads(R.call_string_level(view(spark, d, "v_calls")), "dna", max_rate=0.5, min_cov=3).groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))


@register("f7_select_rna_reads", oracle(f"WITH {_LEVEL} SELECT cell_id, count(*) AS n FROM lf WHERE frac >= 4.5e-1 AND cov >= 3 GROUP BY cell_id", "v_calls", "v_reads"))
def f7(spark, d):
    return R.select_reads(R.call_string_level(view(spark, d, "v_calls")), "rna", min_rate=0.45, min_cov=3).groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))


@register(
    "r5_spliced_reads",
    oracle(
        """WITH b AS (SELECT read_id, cell_id, read_type = 1 AS rev, i, substring(seq, i, 1) AS r, CASE WHEN i % 4 = 0 THEN translate(substring(seq, i, 1), 'CGAT', 'TACG') ELSE substring(seq, i, 1) END AS b,
        CASE WHEN i <> 65 THEN substring(seq, i - 1, 1) ELSE '' END AS p, CASE WHEN i <> 64 THEN substring(seq, i + 1, 1) ELSE '' END AS n FROM v_reads, range(1, 129) t(i)),
        c AS (SELECT *, CASE WHEN rev THEN r = 'C' AND n IN ('A','C','T') ELSE r = 'G' AND i > 1 AND p IN ('A','T','G') END AS ch FROM b),
        g AS (SELECT read_id, cell_id, count(*) FILTER (ch AND b = r) AS mch, count(*) FILTER (ch AND (b = r OR concat(r, b) IN ('CT','GA'))) AS cov, count(*) FILTER (ch AND NOT (b = r OR concat(r, b) IN ('CT','GA'))) AS other_snp FROM c GROUP BY 1, 2)
        SELECT read_id, mch, cov, other_snp, coalesce(CAST(mch AS DOUBLE) / nullif(cov, 0), 0e0) AS frac FROM g""",
        "v_reads",
    ),
)
def r5(spark, d):
    """Reads with MD tags, 3 bases clipped and 10 skipped; they differ from the reference at every fourth base."""
    v = view(spark, d, "v_reads")
    changed = F.array_join(F.transform(F.split("seq", ""), lambda b, i: F.when((i + 1) % 4 == 0, F.translate(b, "CGAT", "TACG")).otherwise(b)), "")
    md = F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(32)), lambda k: F.concat(F.lit("3"), F.substring("seq", 4 * k, F.lit(1)))), ""), F.lit("0"))
    v = v.withColumn("pairs", R.pairs_of_alignments(F.concat(F.lit("ACG"), changed), F.lit("3S64M10N64M"), md)).withColumn("reverse", F.col("read_type") == 1)
    return R.spliced_methylation(v)


@register("a1_seeded_profile", oracle(f"WITH {_LEVEL}, p AS (SELECT CAST(floor(100 * frac) AS BIGINT) AS mc_frac, CAST(cov AS BIGINT) AS cov, 1 AS n FROM lf UNION ALL SELECT 50, 50, 0) SELECT mc_frac, cov, CAST(sum(n) AS BIGINT) AS count FROM p GROUP BY ALL", "v_calls", "v_reads"))
def a1_seeded(spark, d):
    return R.profile(R.call_string_level(view(spark, d, "v_calls")), seed=True)


@register("a1_read_profile", oracle(f"WITH {_LEVEL} SELECT CAST(floor(100 * frac) AS BIGINT) AS mc_frac, CAST(cov AS BIGINT) AS cov, count(*) AS count FROM lf GROUP BY ALL", "v_calls", "v_reads"))
def a1(spark, d):
    return R.profile(R.call_string_level(view(spark, d, "v_calls")))


@register(
    "r6_parent_reads",
    oracle(f"WITH {_LEVEL} SELECT CAST(read_id // 3 AS VARCHAR) AS parent, CAST(sum(mc) AS BIGINT) AS mc, CAST(sum(cov) AS BIGINT) AS cov, CAST(floor(100 * CAST(sum(mc) AS BIGINT) / (CAST(sum(cov) AS BIGINT) + 1e-3)) AS BIGINT) AS frac FROM lf GROUP BY 1", "v_calls", "v_reads"),
)
def r6(spark, d):
    name = F.concat(F.floor(F.col("read_id") / 3).cast("string"), F.element_at(F.array(F.lit("-l"), F.lit("-r"), F.lit("-m")), (F.pmod("read_id", F.lit(3)) + 1).cast("int")))
    return R.parent_level(R.call_string_level(view(spark, d, "v_calls")).withColumn("read_name", name))


_PAIRS = """WITH pairs AS (SELECT read_id, CASE WHEN read_id % 3 = 0 THEN 'GA' WHEN read_id % 3 = 1 THEN 'CT' WHEN read_type = 1 THEN 'GA' ELSE 'CT' END AS conv, i AS ref_pos, substring(seq, i, 1) AS ref,
 CASE WHEN i % 3 = 0 THEN translate(substring(seq, i, 1), 'CG', 'TA') ELSE substring(seq, i, 1) END AS base FROM v_reads, range(1, 129) t(i) WHERE i % 7 <> 0)"""


def _levels_sql(ga: str, ct: str) -> str:
    return (
        _PAIRS
        + f""", near AS (SELECT *, CASE WHEN lag(ref_pos) OVER w = ref_pos - 1 THEN lag(ref) OVER w END AS b, CASE WHEN lead(ref_pos) OVER w = ref_pos + 1 THEN lead(ref) OVER w END AS a FROM pairs WINDOW w AS (PARTITION BY read_id ORDER BY ref_pos)),
 c AS (SELECT *, coalesce(CASE WHEN conv = 'GA' THEN ref = 'G' AND b IN ('G','A','T'){ga} ELSE ref = 'C' AND a IN ('C','T','A'){ct} END, false) AS ch, concat(ref, base) AS two FROM near),
 g AS (SELECT read_id, count(*) FILTER (ch AND two IN ('CC','GG')) AS mch, count(*) FILTER (ch AND two IN ('CC','GG','CT','GA')) AS cov, count(*) FILTER (ch AND two NOT IN ('CC','GG','CT','GA')) AS other_snp FROM c GROUP BY read_id)
 SELECT *, coalesce(CAST(mch AS DOUBLE) / nullif(cov, 0), 0e0) AS frac FROM g"""
    )


def _aligned(spark, d) -> DataFrame:
    """Reads with every seventh base missing from the alignment and every third converted; two in three have a tag."""
    v = view(spark, d, "v_reads")
    pairs = F.col("seq")
    for b in "ACGT":
        pairs = F.replace(pairs, F.lit(b), F.lit(b + b.lower()))
    for a, b in ("Ct", "Ga"):  # \\G: from where the last match ended, so thirds are counted from the read's beginning
        pairs = F.regexp_replace(pairs, rf"\G((?:.{{6}})*?.{{4}}{a}){a.lower()}", f"$1{b}")
    tag = F.when(F.col("read_id") % 3 == 0, "-").when(F.col("read_id") % 3 == 1, "+")
    return v.select("read_id", F.regexp_replace(pairs, "(.{12})..", "$1--").alias("pairs"), R.conversion(tag, F.col("read_type") == 1).alias("conv"))


@register("r3_read_methylation", oracle(_levels_sql("", ""), "v_reads"))
def r3(spark, d):
    """R1 and R2 too: conversion by tag or by read, contexts by neighbours."""
    return R.read_methylation_strings(_aligned(spark, d))


@register("r3_nome_methylation", oracle(_levels_sql(" AND coalesce(a, '') <> 'G'", " AND coalesce(b, '') <> 'G'"), "v_reads"))
def r3_nome(spark, d):
    return R.read_methylation_strings(_aligned(spark, d), nome=True)


@register(
    "r4_nome_call_strings",
    oracle(
        """WITH c AS (SELECT c.read_id, i, substring(xm, i, 1) AS x, CASE WHEN r.read_type = 1 THEN substring(seq, i + 1, 1) = 'C' ELSE i = 1 OR substring(seq, i - 1, 1) = 'G' END AS gpc FROM v_calls c JOIN v_reads r ON r.read_id = c.read_id, range(1, 129) t(i))
        SELECT read_id, count(*) FILTER (NOT gpc AND x IN ('X','H')) AS mc, count(*) FILTER (NOT gpc AND x IN ('X','H','x','h')) AS cov FROM c GROUP BY 1""",
        "v_calls", "v_reads",
    ),
)
def r4_nome(spark, d):
    v = view(spark, d, "v_reads").withColumn("xm", F.translate("seq", "ACGT", "hXZx"))
    level = R.call_string_level_nome(F.col("xm"), F.col("seq"), F.col("read_type") == 1)
    return v.select("read_id", level.alias("x")).select("read_id", "x.mc", "x.cov")


@register(
    "u1_split_ends",
    oracle(
        """SELECT read_id, 'l' AS part, substring(s, 1, 40) AS part_seq FROM (SELECT read_id, substring(seq, 6, length(seq) - 10) AS s FROM v_reads) t WHERE length(s) > 40
        UNION ALL SELECT read_id, 'r', right(s, 40) FROM (SELECT read_id, substring(seq, 6, length(seq) - 10) AS s FROM v_reads) t WHERE length(s) > 40
        UNION ALL SELECT read_id, 'm', substring(s, 41, length(s) - 80) FROM (SELECT read_id, substring(seq, 6, length(seq) - 10) AS s FROM v_reads) t WHERE length(s) >= 110""",
        "v_reads",
    ),
)
def u1(spark, d):
    return R.split_ends(view(spark, d, "v_reads"), trim=5).select("read_id", "part", "part_seq")


def _cut_sql(kind: int) -> str:
    sites = "|".join(R.CUT_SITES[kind])
    tail, head = ("substring(s, length(s) - 2, 3) = 'ATC'", "substring(s, 1, 3) = 'CAT'") if kind == 1 else ("substring(s, length(s) - 3, 3) = 'GAT'", "substring(s, 2, 3) = 'ATG'")
    return f"""SELECT read_id, read_type, b + CASE WHEN {head} THEN 4 ELSE 0 END AS "begin", e - CASE WHEN {tail} THEN 4 ELSE 0 END AS "end", seq FROM (
 SELECT read_id, read_type, seq, p.b AS b, q.e AS e, substring(seq, p.b + 1, q.e - p.b) AS s FROM (SELECT read_id, read_type, seq, sp FROM (
  SELECT read_id, read_type, seq, list_concat(CASE WHEN len(k) = 0 OR k[1].b <> 0 THEN [{{'b': 0, 'e': 0}}] ELSE [] END, k, CASE WHEN len(k) = 0 OR k[-1].e <> length(seq) THEN [{{'b': CAST(length(seq) AS INT), 'e': CAST(length(seq) AS INT)}}] ELSE [] END) AS sp FROM (
   SELECT read_id, read_type, seq, list_transform(range(1, len(pc)), lambda i: {{'b': CAST(list_sum(list_transform(pc[1:i], lambda x: length(x))) + 4 * (i - 1) AS INT), 'e': CAST(list_sum(list_transform(pc[1:i], lambda x: length(x))) + 4 * i AS INT)}}) AS k
   FROM (SELECT *, regexp_split_to_array(seq, '{sites}') AS pc FROM v_reads WHERE read_type = {kind}) a) b0) c0) c1, unnest(range(1, len(sp) + 1)) ti(i), unnest(range(1, len(sp) + 1)) tj(j), (SELECT 1) one, LATERAL (SELECT sp[i] AS p) lp, LATERAL (SELECT sp[j] AS q) lq WHERE j > i AND q.e - p.b >= 30) z"""


@register("u4_split_at_cut_sites", oracle(f"SELECT DISTINCT read_id, read_type, \"begin\", \"end\", substring(seq, \"begin\" + 1, \"end\" - \"begin\") AS part_seq FROM ({_cut_sql(1)} UNION ALL {_cut_sql(2)}) u WHERE \"end\" - \"begin\" >= 30", "v_reads"))
def u4(spark, d):
    return R.split_at_cut_sites(view(spark, d, "v_reads")).select("read_id", "read_type", "begin", "end", "part_seq")


@register("t1_fixed_trim", oracle("SELECT read_id, substring(seq, 11, length(seq) - 20) AS seq FROM v_reads", "v_reads"))
def t1(spark, d):
    return view(spark, d, "v_reads").select("read_id", R.fixed_trim(F.col("seq")).alias("seq"))


# Demultiplexing

_CODES = [("I" + str(n), a + b + c) for n, (a, b, c) in enumerate((x, y, z) for x in "ACGT" for y in "ACGT" for z in "AG")]


@register(
    "j1_demultiplex",
    oracle(
        f"WITH codes(index_name, barcode) AS (VALUES {', '.join(map(repr, _CODES))}) SELECT read_id, index_name, CASE WHEN barcode IS NULL THEN seq ELSE substring(seq, 4) END AS seq FROM v_reads LEFT JOIN codes ON substring(seq, 1, 3) = barcode",
        "v_reads",
    ),
)
def j1(spark, d):
    codes = spark.createDataFrame(_CODES, "index_name string, barcode string")
    return D.demultiplex(view(spark, d, "v_reads"), codes, 3).select("read_id", "index_name", "seq")


@register(
    "a5_demultiplex_stats",
    """SELECT concat(CAST(l_suppkey AS VARCHAR), '-', l_returnflag) AS cell_id, CAST(sum(l_linenumber) AS BIGINT) AS "CellInputReadPairs", CAST(sum(l_orderkey) AS BIGINT) AS "MultiplexedTotalReadPairs", min(l_returnflag) AS "IndexName", min(CAST(l_suppkey AS VARCHAR)) AS "UID",
    CAST(sum(l_linenumber) AS DOUBLE) / nullif(CAST(sum(l_orderkey) AS DOUBLE), 0) AS "CellBarcodeRate" FROM lineitem GROUP BY 1""",
)
def a5(spark, d):
    v = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_suppkey").cast("string").alias("uid"), F.col("l_returnflag").alias("index_name"), F.col("l_linenumber").cast("long").alias("trimmed"), F.col("l_orderkey").alias("total_pair"))
    return D.demultiplex_stats(v)


@register("f8_select_cells", oracle("SELECT input_reads BETWEEN 1000 AND 8000 AS kept, count(*) AS n, CAST(sum(input_reads) AS BIGINT) AS reads FROM v_cell GROUP BY 1", "v_cell"))
def f8(spark, d):
    return D.select_cells(view(spark, d, "v_cell"), "input_reads", 1000, 8000).groupBy("kept").agg(F.count(F.lit(1)).alias("n"), F.sum("input_reads").alias("reads"))


@register("o4_uid_priority", oracle("SELECT \"UID\", CAST(sum(input_reads) AS BIGINT) AS input FROM (SELECT split_part(cell_id,'-',1) AS \"UID\", input_reads FROM v_cell WHERE input_reads BETWEEN 1000 AND 8000) t GROUP BY 1", "v_cell"))
def o4(spark, d):
    return D.uid_priority(D.select_cells(view(spark, d, "v_cell").withColumn("UID", F.split("cell_id", "-")[0]), "input_reads", 1000, 8000), "input_reads")


@register("s5_deal_groups", oracle("SELECT cell_id, CAST((row_number() OVER (ORDER BY md5(concat('0:', cell_id)), cell_id) - 1) % 64 AS BIGINT) AS \"group\" FROM v_cell", "v_cell"))
def s5(spark, d):
    return D.deal_groups(view(spark, d, "v_cell").select("cell_id"))


_NAMES = "SELECT c_custkey, concat('/d/x-', c_mktsegment, '-', CAST(c_custkey % 8 AS VARCHAR), '-', substring('ABCDEFGHIJKLMNOPQR', CAST(c_custkey % 18 + 1 AS INT), 1), CAST(c_custkey % 26 AS VARCHAR), '_S1_L00', CAST(c_custkey % 5 + 1 AS VARCHAR), '_R', CAST(c_custkey % 2 + 1 AS VARCHAR), '_001.fastq.gz') AS path FROM {customer}"


@register(
    "s3_fastq_names",
    "SELECT c_custkey, ok AS valid, CASE WHEN ok THEN concat(a, '-', b, '-', c) END AS uid, CASE WHEN ok THEN regexp_extract(path, 'L00[1-5]') END AS lane FROM (SELECT *, regexp_matches(b, '^[1-6]$') AND regexp_matches(c, '^[A-P]([1-9]|1[0-9]|2[0-4])$') AND regexp_matches(path, '_L00[1-4]_') AS ok FROM (SELECT c_custkey, path, split_part(path, '-', 2) AS a, split_part(path, '-', 3) AS b, split_part(split_part(path, '-', 4), '_', 1) AS c FROM ("
    + _NAMES.format(customer="customer")
    + ") p) q) r",
)
def s3(spark, d):
    names = spark.sql(_NAMES.replace("VARCHAR", "STRING"), customer=spark.read.parquet(f"{d}/customer.parquet"))
    f = D.parse_fastq_name(F.col("path"), "V2")
    return names.select("c_custkey", f["valid"].alias("valid"), f["uid"].alias("uid"), f["lane"].alias("lane"))


# Contacts


@register(
    "c2_best_parts",
    oracle(
        """WITH RECURSIVE ranked AS (SELECT cell_id, pair_id, read_type, seq, ss, se, row_number() OVER (PARTITION BY pair_id, read_type ORDER BY ref_len + as_score DESC, seq DESC) AS r FROM v_align),
        fold AS (SELECT pair_id, read_type, CAST(1 AS BIGINT) AS r, [{'seq': seq, 'ss': ss, 'se': se}] AS kept FROM ranked WHERE r = 1
        UNION ALL SELECT f.pair_id, f.read_type, k.r, CASE WHEN len(list_filter(f.kept, lambda q: NOT (k.ss >= q.se OR k.se <= q.ss))) > 0 THEN f.kept ELSE list_append(f.kept, {'seq': k.seq, 'ss': k.ss, 'se': k.se}) END
        FROM fold f JOIN ranked k ON k.pair_id = f.pair_id AND k.read_type = f.read_type AND k.r = f.r + 1),
        last AS (SELECT pair_id, read_type, max_by(kept, r) AS kept FROM fold GROUP BY 1, 2)
        SELECT pair_id, read_type, unnest(kept).seq AS seq FROM last""",
        "v_align",
    ),
)
def c2(spark, d):
    return C.best_parts(view(spark, d, "v_align"), ["pair_id", "read_type"]).select("pair_id", "read_type", "seq")


@register(
    "c1_remove_overlaps",
    oracle(
        """WITH RECURSIVE ranked AS (SELECT pair_id, read_type, seq, flag, ss, se, row_number() OVER (PARTITION BY pair_id, read_type ORDER BY ref_len + as_score DESC, seq DESC) AS r FROM v_align),
        fold AS (SELECT pair_id, read_type, CAST(1 AS BIGINT) AS r, [{'seq': seq, 'ss': ss, 'se': se}] AS kept FROM ranked WHERE r = 1
        UNION ALL SELECT f.pair_id, f.read_type, k.r, CASE WHEN len(list_filter(f.kept, lambda q: NOT (k.ss >= q.se OR k.se <= q.ss))) > 0 THEN f.kept ELSE list_append(f.kept, {'seq': k.seq, 'ss': k.ss, 'se': k.se}) END
        FROM fold f JOIN ranked k ON k.pair_id = f.pair_id AND k.read_type = f.read_type AND k.r = f.r + 1),
        last AS (SELECT pair_id, read_type, max_by(kept, r) AS kept FROM fold GROUP BY 1, 2), stay AS (SELECT unnest(kept).seq AS seq FROM last)
        SELECT a.seq, concat('r', CAST(pair_id AS VARCHAR)) AS read_name, concat('S', CAST(read_type AS VARCHAR)) AS st, a.ss, a.se, CAST(flag - (flag & 192) AS INT) AS flag FROM v_align a JOIN stay s ON s.seq = a.seq""",
        "v_align",
    ),
)
def c1(spark, d):
    """X12 and C2 too, from names as an aligner of split reads gives them."""
    v = view(spark, d, "v_align").withColumn("qname", F.concat(F.lit("r"), F.col("pair_id").cast("string"), F.lit("_"), F.concat_ws(":", "read_type", "ss", "se"))).withColumn("qlen", F.col("ref_len"))
    return C.remove_overlapping_parts(v, ["cell_id"]).select("seq", "read_name", "st", "ss", "se", F.col("flag").cast("int").alias("flag"))


@register("t3_sliding_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) - to_hours(CAST(k AS INT)) AS start, event_type, count(*) AS n FROM events, range(0, 3) t(k) GROUP BY 1, 2")
def t3_sliding(spark, d):
    out = ST.windowed_counts(spark.read.parquet(f"{d}/events.parquet"), size="3 hours", slide="1 hour")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def _parts(spark, d) -> DataFrame:
    return view(spark, d, "v_align").withColumn("strand", F.lit(0))


@register(
    "c5_two_part_contacts",
    oracle(
        """WITH p AS (SELECT pair_id, min_by(struct_pack(chrom, pos_start, pos_end, ss, se, read_type), seq) AS a, max_by(struct_pack(chrom, pos_start, pos_end, ss, se, read_type), seq) AS b FROM v_align GROUP BY pair_id HAVING count(*) = 2),
        k AS (SELECT pair_id, a, b, a.chrom = b.chrom AND a.pos_end + 2500 > b.pos_start - 2500 AND b.pos_end + 2500 > a.pos_start - 2500 AS near FROM p)
        SELECT pair_id, CASE WHEN near THEN 'no' WHEN a.read_type <> b.read_type THEN CASE WHEN a.chrom = b.chrom THEN 'cis' ELSE 'trans' END
        WHEN a.ss = b.se OR a.se = b.ss THEN CASE WHEN a.chrom = b.chrom THEN 'ciscut' ELSE 'transcut' END ELSE 'chimeric' END AS contact_type FROM k""",
        "v_align",
    ),
)
def c5_two(spark, d):
    v = _parts(spark, d)
    two = v.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select("pair_id")
    return C.call_contacts(v.join(two, "pair_id", "left_semi"), ["pair_id"]).select("pair_id", "contact_type")


# First-fit fragments as a recursion over the parts of a pair, then the best relation of every two fragments.
_CONTACTS = """p AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY seq) AS i FROM v_align),
 fold AS (SELECT pair_id, CAST(1 AS BIGINT) AS i, [{'chrom': chrom, 'lo': pos_start - 2500, 'hi': pos_end + 2500}] AS bounds, [CAST(1 AS BIGINT)] AS frag FROM p WHERE i = 1
  UNION ALL SELECT pair_id, i, CASE WHEN k = 0 THEN list_append(bounds, mine) ELSE list_concat(list_concat(bounds[1:k - 1], [{'chrom': mine.chrom, 'lo': least(bounds[k].lo, mine.lo), 'hi': greatest(bounds[k].hi, mine.hi)}]), bounds[k + 1:]) END,
   list_append(frag, CASE WHEN k = 0 THEN len(bounds) + 1 ELSE k END) FROM (
   SELECT f.pair_id, p.i, f.bounds, f.frag, {'chrom': p.chrom, 'lo': p.pos_start - 2500, 'hi': p.pos_end + 2500} AS mine,
    CAST(coalesce(list_position(list_transform(f.bounds, lambda x: x.chrom = p.chrom AND x.lo < p.pos_end + 2500 AND p.pos_start - 2500 < x.hi), true), 0) AS BIGINT) AS k
   FROM fold f JOIN p ON p.pair_id = f.pair_id AND p.i = f.i + 1) z),
 whole AS (SELECT pair_id, max_by(frag, i) AS frag, max_by(len(bounds), i) AS n FROM fold GROUP BY pair_id),
 placed AS (SELECT p.*, w.frag[p.i] AS g, w.n FROM p JOIN whole w ON w.pair_id = p.pair_id),
 slices AS (SELECT pair_id, list({'t': read_type, 's': ss, 'e': se}) AS has FROM p GROUP BY pair_id),
 met AS (SELECT a.cell_id, a.pair_id, a.n, a.g AS g, b.g AS h, a.i AS i, b.i AS j, a AS a, b AS b, CASE WHEN a.read_type <> b.read_type THEN CASE WHEN a.chrom = b.chrom THEN 3 ELSE 4 END
   WHEN a.se = b.ss OR b.se = a.ss THEN CASE WHEN a.chrom = b.chrom THEN 0 ELSE 1 END
   WHEN NOT (a.n > 2 AND (list_contains(s.has, {'t': a.read_type, 's': a.se, 'e': b.ss}) OR list_contains(s.has, {'t': a.read_type, 's': b.se, 'e': a.ss}))) THEN 2 END AS rank
  FROM placed a JOIN placed b ON a.pair_id = b.pair_id AND a.g < b.g JOIN slices s ON s.pair_id = a.pair_id),
 best AS (SELECT * FROM met WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pair_id, g, h ORDER BY rank, i DESC, j DESC) = 1),
 calls AS (SELECT cell_id, pair_id, CASE WHEN rank = 2 THEN 'chimeric' ELSE concat(['ciscut', 'transcut', 'chimeric', 'cis', 'trans'][rank + 1], CASE WHEN n > 2 THEN '_multi' ELSE '' END) END AS contact_type,
   CASE WHEN rank <> 2 THEN a END AS a, CASE WHEN rank <> 2 THEN b END AS b FROM best
  UNION ALL SELECT cell_id, pair_id, 'no', NULL, NULL FROM placed WHERE n = 1 AND i = 1)"""
_CALLED = "cell_id, pair_id, contact_type, " + ", ".join(
    f"{x}.{f} AS {name}{n}" if f != "strand" else f"CASE WHEN {x}.chrom IS NOT NULL THEN 0 END AS strand{n}"
    for n, x in ((1, "a"), (2, "b")) for name, f in (("chrom", "chrom"), ("start", "pos_start"), ("end", "pos_end"), ("strand", "strand"), ("read_start", "ss"), ("read_end", "se"), ("read_type", "read_type"))
)


@register("c11_call_contacts", oracle(f"WITH RECURSIVE {_CONTACTS} SELECT {_CALLED} FROM calls", "v_align"))
def c11(spark, d):
    """Contacts of all pairs, any number of parts."""
    return C.call_contacts(_parts(spark, d), ["cell_id", "pair_id"])


_KINDS = ", ".join(f"count(*) FILTER (contact_type = '{k}') AS {k}" for k in C.KINDS)


@register("c11_contact_pipeline", oracle(
    f"""WITH RECURSIVE {_CONTACTS}, raw AS (SELECT *, dense_rank() OVER (PARTITION BY cell_id ORDER BY pair_id) - 1 AS no FROM (SELECT {_CALLED} FROM calls) t),
    lagged AS (SELECT cell_id, coalesce(lag(start1) OVER x = start1 OR lag(end1) OVER x = end1, false) AND coalesce(lag(start2) OVER y = start2 OR lag(end2) OVER y = end2, false) AS gone FROM raw WHERE chrom1 IS NOT NULL
     WINDOW x AS (PARTITION BY cell_id, chrom1, chrom2 ORDER BY start1, end1, start2, end2, no, read_type1, read_start1, read_type2, read_start2),
      y AS (PARTITION BY cell_id, chrom1, chrom2 ORDER BY start2, end2, start1, end1, no, read_type1, read_start1, read_type2, read_start2)),
    n AS (SELECT cell_id, {_KINDS}, count(DISTINCT pair_id) AS mapped_frag FROM calls GROUP BY 1), k AS (SELECT cell_id, count(*) AS written, count(*) FILTER (NOT gone) AS dedup_frag FROM lagged GROUP BY 1)
    SELECT n.*, coalesce(dedup_frag, 0) AS dedup_frag, CAST(coalesce(written, 0) - coalesce(dedup_frag, 0) AS DOUBLE) / (coalesce(written, 0) + 1e-5) AS dup_rate FROM n LEFT JOIN k USING (cell_id)""", "v_align"))  # fmt: skip
def c11_pipeline(spark, d):
    return C.contact_pipeline(_parts(spark, d), ["cell_id"])["stats"]


@register("s22_contact_summary", oracle(
    f"""WITH RECURSIVE {_CONTACTS}, n AS (SELECT cell_id, {_KINDS}, count(DISTINCT pair_id) AS mapped_frag FROM calls GROUP BY 1),
    t AS (SELECT *, cis + ciscut + cis_multi + ciscut_multi AS "TotalCisContacts", trans + transcut + trans_multi + transcut_multi AS "TotalTransContacts", cis_multi + ciscut_multi + trans_multi + transcut_multi AS "TotalMultiContacts" FROM n)
    SELECT *, "TotalCisContacts" / (mapped_frag + 1e-5) AS "CisContactsRatio", "TotalTransContacts" / (mapped_frag + 1e-5) AS "TransContactsRatio", "TotalMultiContacts" / (mapped_frag + 1e-5) AS "MultiContactsRatio" FROM t""", "v_align"))  # fmt: skip
def s22(spark, d):
    return C.contact_summary(C.contact_counts(C.call_contacts(_parts(spark, d), ["cell_id", "pair_id"]), ["cell_id"]))


_DEDUP = """d AS (SELECT *, coalesce(lag(start1) OVER a = start1 OR lag(end1) OVER a = end1, false) AS d1, coalesce(lag(start2) OVER b = start2 OR lag(end2) OVER b = end2, false) AS d2 FROM v_contact
 WINDOW a AS (PARTITION BY cell_id, chrom1, chrom2 ORDER BY start1, end1, start2, end2, seq), b AS (PARTITION BY cell_id, chrom1, chrom2 ORDER BY start2, end2, start1, end1, seq))"""


@register("c8_contact_dedup", oracle(f"WITH {_DEDUP} SELECT cell_id, seq, chrom1, start1, end1, chrom2, start2, end2 FROM d WHERE NOT (d1 AND d2)", "v_contact", "v_align"))
def c8(spark, d):
    return C.dedup_contacts(view(spark, d, "v_contact"), ["cell_id"]).select("cell_id", "seq", "chrom1", "start1", "end1", "chrom2", "start2", "end2")


@register(
    "c9_duplicate_rate",
    oracle(f"WITH {_DEDUP} SELECT cell_id, count(*) AS n_raw, count(*) FILTER (NOT (d1 AND d2)) AS n_dedup, CAST(count(*) FILTER (d1 AND d2) AS DOUBLE) / (count(*) + 1e-5) AS dup_rate FROM d GROUP BY cell_id", "v_contact", "v_align"),
)
def c9(spark, d):
    v = view(spark, d, "v_contact")
    return C.duplicate_rate(v, C.dedup_contacts(v, ["cell_id"]), ["cell_id"])


@register("c10_short_format", oracle("SELECT 0 AS str1, chrom1 AS chr1, start1 AS pos1, 0 AS frag1, 1 AS str2, chrom2 AS chr2, start2 AS pos2, 1 AS frag2 FROM v_contact", "v_contact", "v_align"))
def c10(spark, d):
    return C.short_format(view(spark, d, "v_contact").withColumn("strand1", F.lit(0)).withColumn("strand2", F.lit(1)))


_SLOT = "CASE l % 8 WHEN 0 THEN '1' WHEN 1 THEN '1-1' WHEN 2 THEN '1-3' WHEN 3 THEN '1-2' WHEN 4 THEN '2-2' WHEN 5 THEN '2-3' WHEN 6 THEN '2-1' ELSE '2' END"
_WIDE = (
    f"""s AS (SELECT pair_id AS read_id, seq, {_SLOT} AS slot, flag, chrom, pos_start, ref_len FROM (SELECT *, ss // 20 + read_type * 4 AS l FROM v_align) t),
 loc AS (SELECT *, ((flag & 16) <> 0) <> (slot[1] = '1') AS fw FROM s),
 w AS (SELECT read_id, """
    + ", ".join(f"max_by({{'strand': CAST(fw AS INT), 'chrom': chrom, 'pos': CASE WHEN fw THEN pos_start + 1 ELSE pos_start + ref_len END}}, seq) FILTER (slot = '{s}') AS s{n}" for n, s in enumerate(C.SLOTS))
    + f""" FROM loc GROUP BY read_id), w2 AS (SELECT {", ".join(f"s{n}" for n in range(8))}, min(read_id) AS read_id FROM w WHERE {" + ".join(f"CAST(s{n} IS NOT NULL AS INT)" for n in range(8))} >= 2 GROUP BY ALL)"""
)


def _slotted(spark, d) -> DataFrame:
    v = view(spark, d, "v_align").withColumn("l", F.floor(F.col("ss") / 20) + F.col("read_type") * 4)
    slot = F.element_at(F.array(*map(F.lit, C.SLOTS)), (F.pmod("l", F.lit(8)) + 1).cast("int"))
    return v.select(F.col("pair_id").alias("read_id"), "seq", slot.alias("slot"), "flag", "chrom", F.col("pos_start").alias("pos"), F.col("ref_len").alias("length"))


def _wide(spark, d) -> DataFrame:
    return C.split_table(_slotted(spark, d))


@register("c12_split_table", oracle(f"WITH {_WIDE} SELECT read_id, coalesce(s0.chrom, '') AS c0, coalesce(s4.chrom, '') AS c4, coalesce(s7.pos, -1) AS p7 FROM w2", "v_align"))
def c12(spark, d):
    return _wide(spark, d).select("read_id", F.coalesce("s0.chrom", F.lit("")).alias("c0"), F.coalesce("s4.chrom", F.lit("")).alias("c4"), F.coalesce("s7.pos", F.lit(-1)).alias("p7"))


@register(
    "c13_split_contacts",
    oracle(
        f"""WITH {_WIDE}, e AS (SELECT coalesce(s0,s1,s2,s3,s4,s5,s6,s7) AS a, coalesce(s7,s6,s5,s4,s3,s2,s1,s0) AS b FROM w2),
        o AS (SELECT CASE WHEN a.chrom > b.chrom OR (a.chrom = b.chrom AND a.pos > b.pos) THEN b ELSE a END AS a, CASE WHEN a.chrom > b.chrom OR (a.chrom = b.chrom AND a.pos > b.pos) THEN a ELSE b END AS b FROM e WHERE a.chrom IN ('chr1','chr2') AND b.chrom IN ('chr1','chr2'))
        SELECT a.strand AS strand1, a.chrom AS chrom1, a.pos AS pos1, b.strand AS strand2, b.chrom AS chrom2, b.pos AS pos2, CASE WHEN a.chrom <> b.chrom THEN 'trans' WHEN abs(a.pos - b.pos) > 2500 THEN 'cis_long' ELSE 'cis_short' END AS kind FROM o""",
        "v_align",
    ),
)
def c13(spark, d):
    return C.split_contacts(_wide(spark, d), ["chr1", "chr2"])


@register(
    "c14_generate_contacts",
    oracle(
        f"""WITH {_WIDE}, e AS (SELECT coalesce(s0,s1,s2,s3,s4,s5,s6,s7) AS a, coalesce(s7,s6,s5,s4,s3,s2,s1,s0) AS b FROM w2 WHERE true),
        k AS (SELECT CASE WHEN a.chrom <> b.chrom THEN 't' WHEN abs(a.pos - b.pos) > 2500 THEN 'l' ELSE 's' END AS k FROM e WHERE a.chrom IN ('chr1','chr2','chr3') AND b.chrom IN ('chr1','chr2','chr3'))
        SELECT count(*) FILTER (k = 's') AS "CisShortContact", count(*) FILTER (k = 'l') AS "CisLongContact", count(*) FILTER (k = 't') AS "TransContact" FROM k""",
        "v_align",
    ),
)
def c14(spark, d):
    return C.generate_contacts(_slotted(spark, d), ["chr1", "chr2", "chr3"])["counts"]


@register(
    "c15_contact_matrix",
    oracle("SELECT cell_id, chrom1 AS chrom, least(start1 // 10000, start2 // 10000) AS bin1, greatest(start1 // 10000, start2 // 10000) AS bin2, count(*) AS n FROM v_contact WHERE chrom1 = chrom2 AND abs(start1 - start2) > 2500 GROUP BY ALL", "v_contact", "v_align"),
)
def c15(spark, d):
    return C.contact_matrix(view(spark, d, "v_contact"), 10_000, ["cell_id"])


@register("a12_unique_reads", oracle("SELECT cell_id, count(DISTINCT pair_id) AS n FROM v_align GROUP BY cell_id", "v_align"))
def a12(spark, d):
    return Y.unique_reads(view(spark, d, "v_align"))


# Sites


def _pattern_sql(keys: str, source: str) -> str:
    cols = []
    for p, alias in PATTERNS.items():
        hit = f"regexp_matches(context, '{_regex(p)}')"
        mc, cov = (f"CAST(sum({c}) FILTER ({hit}) AS BIGINT)" for c in ("mc", "cov"))
        cols += [f'{mc} AS "{alias}mC"', f'{cov} AS "{alias}Cov"', f'CAST({mc} AS DOUBLE) / nullif({cov}, 0) AS "{alias}Frac"']
    return f"SELECT {keys}, {', '.join(cols)} FROM {source} GROUP BY {keys}"


@register("a3_allc_pattern_stats", oracle(_pattern_sql("sample", "v_allc"), "v_allc"))
def a3(spark, d):
    return S.pattern_stats(view(spark, d, "v_allc"), ["sample"], PATTERNS)


def _context_sql() -> str:
    cols = []
    for name, hit in (("mCCC", "context = 'CCC'"), ("mCG", "substring(context, 2, 1) = 'G'"), ("mCH", "substring(context, 2, 1) <> 'G'")):
        mc, cov = (f"CAST(coalesce(sum({c}) FILTER ({hit}), 0) AS BIGINT)" for c in ("mc", "cov"))
        cols += [f'{mc} AS "{name}mC"', f'{cov} AS "{name}Cov"', f'CAST({mc} AS DOUBLE) / ({cov} + 1e-5) AS "{name}Frac"']
    return f"SELECT sample, {', '.join(cols)} FROM v_allc GROUP BY sample"


@register("a2_context_counts", oracle(_context_sql(), "v_allc"))
def a2(spark, d):
    return S.context_counts(view(spark, d, "v_allc"), ["sample"])


@register(
    "a4_lambda_fraction",
    oracle(
        """SELECT sample, coalesce(CAST(sum(mc) FILTER (h) AS DOUBLE) / nullif(CAST(sum(cov) FILTER (h) AS DOUBLE), 0), 0e0) AS "LambdaCYFrac", CAST(coalesce(sum(cov) FILTER (h), 0) AS BIGINT) AS "LambdaCYCov"
        FROM (SELECT *, chrom = 'chrL' AND substring(context, 1, 2) IN ('CC','CT') AS h FROM v_allc) t GROUP BY sample""",
        "v_allc",
    ),
)
def a4(spark, d):
    return S.lambda_fraction(view(spark, d, "v_allc"), ["sample"])


@register("a14_pseudobulk_merge", oracle("SELECT CASE WHEN sample < 's3' THEN 'g0' ELSE 'g1' END AS grp, chrom, pos, strand, context, CAST(sum(mc) AS BIGINT) AS mc, CAST(sum(cov) AS BIGINT) AS cov FROM v_allc GROUP BY ALL", "v_allc"))
def a14(spark, d):
    return S.merge_sites(view(spark, d, "v_allc").withColumn("grp", F.when(F.col("sample") < "s3", "g0").otherwise("g1")), ["grp"])


@register(
    "a15_multigroup_merge",
    oracle(
        """WITH l AS (SELECT *, CASE WHEN sample < 's3' THEN 'a' ELSE 'b' END AS major, CASE WHEN sample IN ('s0','s3') THEN 'x' ELSE 'y' END AS minor FROM v_allc)
        SELECT CASE WHEN grouping(major) = 0 THEN 'major' ELSE 'minor' END AS category, coalesce(major, minor) AS value, chrom, pos, strand, context, CAST(sum(mc) AS BIGINT) AS mc, CAST(sum(cov) AS BIGINT) AS cov
        FROM l GROUP BY GROUPING SETS ((major, chrom, pos, strand, context), (minor, chrom, pos, strand, context))""",
        "v_allc",
    ),
)
def a15(spark, d):
    v = view(spark, d, "v_allc").withColumn("major", F.when(F.col("sample") < "s3", "a").otherwise("b")).withColumn("minor", F.when(F.col("sample").isin("s0", "s3"), "x").otherwise("y"))
    return S.merge_categories(v, ["major", "minor"])


@register("a16_strand_merge", oracle(f"SELECT sample, chrom, CASE WHEN strand = '-' THEN pos - 1 ELSE pos END AS pos, CAST(sum(mc) AS BIGINT) AS mc, CAST(sum(cov) AS BIGINT) AS cov FROM v_allc WHERE regexp_matches(context, '{_regex('CGN')}') GROUP BY 1, 2, 3", "v_allc"))
def a16(spark, d):
    return S.merge_strands(view(spark, d, "v_allc"), ["sample"])


@register("a17_binned_track", oracle("SELECT sample, chrom, pos // 50 AS bin, CAST(sum(mc) AS BIGINT) AS mc, CAST(sum(cov) AS BIGINT) AS cov, CAST(sum(mc) AS DOUBLE) / nullif(CAST(sum(cov) AS DOUBLE), 0) AS frac FROM v_allc GROUP BY 1, 2, 3", "v_allc"))
def a17(spark, d):
    return S.bin_track(view(spark, d, "v_allc"), ["sample"], 50)


@register("s23_region_fetch", oracle("SELECT sample, chrom, pos, mc, cov FROM v_allc WHERE chrom = 'chr1' AND pos >= 1000 AND pos < 5000", "v_allc"))
def s23(spark, d):
    return formats.in_region(view(spark, d, "v_allc"), "chr1", 1000, 5000).select("sample", "chrom", "pos", "mc", "cov")


@register("j11_site_matrix", oracle("SELECT chrom, pos, " + ", ".join(f"CAST(sum(CASE WHEN sample = 's{k}' THEN {c} ELSE 0 END) AS BIGINT) AS s{k}_{c}" for k in range(6) for c in ("mc", "cov")) + " FROM v_allc GROUP BY chrom, pos", "v_allc"))
def j11(spark, d):
    return S.site_matrix(view(spark, d, "v_allc"), [f"s{k}" for k in range(6)])


@register("f12_covered_in_all", oracle("SELECT chrom, pos FROM v_allc GROUP BY chrom, pos HAVING sum(CASE WHEN sample < 's3' THEN cov ELSE 0 END) > 0 AND sum(CASE WHEN sample >= 's3' THEN cov ELSE 0 END) > 0", "v_allc"))
def f12(spark, d):
    return M.covered_in_all(view(spark, d, "v_allc").withColumn("g", F.when(F.col("sample") < "s3", "a").otherwise("b")), "g", ["a", "b"])


@register("w10_mark_duplicates", oracle("SELECT cell_id, chrom, pos_start, seq FROM (SELECT *, row_number() OVER (PARTITION BY cell_id, chrom, pos_start, flag & 16 ORDER BY ref_len DESC, seq) AS r FROM v_align) t WHERE r = 1", "v_align"))
def w10(spark, d):
    v = view(spark, d, "v_align").withColumn("strand", F.col("flag").bitwiseAND(16))
    return S.remove_duplicates(v, ["cell_id", "chrom", "pos_start", "strand"], "ref_len", "seq").select("cell_id", "chrom", "pos_start", "seq")


@register(
    "a20_pileup",
    oracle(
        """WITH b AS (SELECT cell_id, read_id, read_type = 1 AS rev, (read_id % 50) * 10 + i - 1 AS pos, i, substring(seq, i, 1) AS r, concat('NN', seq, 'NN') AS ref FROM v_reads, range(1, 129) t(i) WHERE read_id % 7 <> 0 AND i % 11 <> 0),
        c AS (SELECT cell_id, pos, rev, CASE WHEN i % 2 = 0 THEN 1 ELSE 0 END AS mc, CASE WHEN rev THEN translate(reverse(substring(ref, i, 3)), 'ACGT', 'TGCA') ELSE substring(ref, i + 2, 3) END AS context FROM b WHERE r = CASE WHEN rev THEN 'G' ELSE 'C' END),
        g AS (SELECT cell_id, pos, rev, context, sum(mc) AS mc, count(*) AS cov FROM c GROUP BY ALL)
        SELECT cell_id, 'chr1' AS chrom, pos, CASE WHEN rev THEN '-' ELSE '+' END AS strand, CAST(sum(mc) AS BIGINT) AS mc, CAST(sum(cov) AS BIGINT) AS cov, min_by(context, {'n': -cov, 'c': context}) AS context FROM g GROUP BY cell_id, pos, rev""",
        "v_reads",
    ),
)
def a20(spark, d):
    """Reads over their own sequence as reference; odd bases are converted, every eleventh is deleted, and after the second
    stands an inserted base. One read in seven has a low mapping quality."""
    v = view(spark, d, "v_reads").withColumn("reverse", F.col("read_type") == 1)
    read = lambda b, i: F.when((i + 1) % 11 == 0, "-").when((i + 1) % 2 == 0, b).otherwise(F.when(F.col("reverse"), F.translate(b, "G", "A")).otherwise(F.translate(b, "C", "T")))
    seq = F.array_join(F.transform(F.split("seq", ""), read), "")
    put = lambda c, x: F.concat(F.substring(c, F.lit(1), F.lit(2)), F.lit(x), F.substring(c, F.lit(3), F.lit(200)))
    v = v.select("cell_id", F.lit("chr1").alias("chrom"), ((F.col("read_id") % 50) * 10).alias("pos_start"), "reverse", put(F.col("seq"), "-").alias("ref"), put(seq, "T").alias("seq"), F.when(F.col("read_id") % 7 == 0, 3).otherwise(30).alias("mapq"))
    return S.pileup(v, ["cell_id"], min_mapq=10)


@register(
    "w10_paired_duplicates",
    oracle(
        """WITH m AS (SELECT *, CASE WHEN seq % 3 > 0 THEN pos_end // 1000 END AS mate_pos, CASE WHEN seq % 3 > 0 THEN flag & 16 END AS mate_strand FROM v_align),
        k AS (SELECT *, row_number() OVER (PARTITION BY cell_id, chrom, pos_start, flag & 16, mate_pos, mate_strand ORDER BY ref_len DESC, seq) AS r, max(CASE WHEN mate_pos IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY cell_id, chrom, pos_start, flag & 16) AS pairs FROM m)
        SELECT cell_id, seq FROM k WHERE r = 1 AND (mate_pos IS NOT NULL OR pairs = 0)""",
        "v_align",
    ),
)
def w10_paired(spark, d):
    v = view(spark, d, "v_align").withColumn("strand", F.col("flag").bitwiseAND(16)).withColumn("mate_pos", F.when(F.col("seq") % 3 > 0, F.floor(F.col("pos_end") / 1000))).withColumn("mate_strand", F.when(F.col("seq") % 3 > 0, F.col("strand")))
    return S.remove_duplicates(v, ["cell_id", "chrom", "pos_start", "strand"], "ref_len", "seq", ["mate_pos", "mate_strand"]).select("cell_id", "seq")


# Intervals and regions

_HIT = "v_align a JOIN v_gene g ON a.chrom = g.chrom AND a.pos_start < g.g_end AND g.g_start < a.pos_end"


def _genes(spark, d) -> DataFrame:
    return view(spark, d, "v_gene").withColumnRenamed("chrom", "g_chrom")


@register("j9_interval_join", oracle(f"SELECT a.seq, g.gene_id FROM {_HIT}", "v_align", "v_gene"))
def j9(spark, d):
    return I.overlap_join(view(spark, d, "v_align"), _genes(spark, d), ("chrom", "pos_start", "pos_end"), ("g_chrom", "g_start", "g_end"), 2048).select("seq", "gene_id")


@register("j12_feature_counts", oracle(f"SELECT cell_id, gene_id, count(*) AS n FROM (SELECT a.seq, a.cell_id, min(g.gene_id) AS gene_id FROM {_HIT} GROUP BY 1, 2 HAVING count(DISTINCT g.gene_id) = 1) t GROUP BY 1, 2", "v_align", "v_gene"))
def j12(spark, d):
    return I.count_features(view(spark, d, "v_align").withColumnRenamed("seq", "read_id"), _genes(spark, d))


@register("a13_genes_detected", oracle(f"SELECT cell_id, count(DISTINCT gene_id) AS \"GenesDetected\" FROM (SELECT a.seq, a.cell_id, min(g.gene_id) AS gene_id FROM {_HIT} GROUP BY 1, 2 HAVING count(DISTINCT g.gene_id) = 1) t GROUP BY 1", "v_align", "v_gene"))
def a13(spark, d):
    return Y.genes_detected(I.count_features(view(spark, d, "v_align").withColumnRenamed("seq", "read_id"), _genes(spark, d)))


@register("f10_blacklist", oracle("SELECT a.seq FROM v_align a WHERE NOT EXISTS (SELECT 1 FROM v_gene g WHERE g.g_end - g.g_start >= 1600 AND a.chrom = g.chrom AND a.pos_start < g.g_end AND g.g_start < a.pos_end)", "v_align", "v_gene"))
def f10(spark, d):
    return I.not_overlapping(view(spark, d, "v_align"), _genes(spark, d).where("g_end - g_start >= 1600"), ("chrom", "pos_start", "pos_end"), ("g_chrom", "g_start", "g_end"), 2048, "seq").select("seq")


_DEPTH = """ev AS (SELECT chrom, cluster, frag_start AS pos, 1 AS s FROM v_frag UNION ALL SELECT chrom, cluster, frag_end, -1 FROM v_frag),
 net AS (SELECT chrom, cluster, pos, sum(s) AS s FROM ev GROUP BY 1, 2, 3 HAVING sum(s) <> 0),
 dep AS (SELECT chrom, cluster, pos AS start, lead(pos) OVER w AS "end", sum(s) OVER (PARTITION BY chrom, cluster ORDER BY pos) AS depth FROM net WINDOW w AS (PARTITION BY chrom, cluster ORDER BY pos)),
 cov AS (SELECT chrom, cluster, start, "end", CAST(depth AS BIGINT) AS depth FROM dep WHERE depth > 0)"""


@register("w8_coverage", oracle(f"WITH {_DEPTH} SELECT * FROM cov", "v_frag"))
def w8(spark, d):
    return I.coverage(view(spark, d, "v_frag"), ["chrom", "cluster"], "frag_start", "frag_end", tile=4096)


@register("k4_scaled_track", oracle(f"WITH {_DEPTH} SELECT chrom, cluster, (start // 50) * 50 AS start, CAST(sum(depth) AS DOUBLE) / count(*) / 2e0 AS value FROM cov GROUP BY 1, 2, 3", "v_frag"))
def k4(spark, d):
    return I.binned_track(I.coverage(view(spark, d, "v_frag"), ["chrom", "cluster"], "frag_start", "frag_end", tile=4096), ["chrom", "cluster"], 50, 2.0)


@register("a23_fragments_per_cluster", oracle("SELECT cluster, CAST(count(*) AS DOUBLE) / 1e6 AS millions FROM v_frag GROUP BY 1", "v_frag"))
def a23(spark, d):
    return Y.cluster_counts(view(spark, d, "v_frag"), 1e6).withColumnRenamed("n", "millions")


@register("w9_tiles", oracle("SELECT chrom, t.s AS start, least(t.s + 5000, size) AS \"end\" FROM (SELECT chrom, max(g_end) AS size FROM v_gene GROUP BY 1) z, range(0, 100000000, 5000) t(s) WHERE t.s < size", "v_gene"))
def w9(spark, d):
    return I.tiles(view(spark, d, "v_gene").groupBy("chrom").agg(F.max("g_end").alias("size")), "chrom", "size", 5000)


@register("w5_islands", oracle("WITH m AS (SELECT *, max(g_end) OVER (PARTITION BY chrom ORDER BY g_start, g_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM v_gene) SELECT gene_id, CAST(sum(CASE WHEN far IS NULL OR g_start - far > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY g_start, g_end ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM m", "v_gene"))
def w5(spark, d):
    return I.islands(view(spark, d, "v_gene"), ["chrom"], "g_start", "g_end", 100).select("gene_id", "island")


def _dml(spark, d) -> DataFrame:
    return view(spark, d, "v_dml")


_FDR = """q AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY pval) AS r, count(*) OVER (PARTITION BY chrom) AS n FROM v_dml),
 f AS (SELECT *, least(min(pval * n / r) OVER (PARTITION BY chrom ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1e0) AS fdr FROM q)"""
_SIG = f"""s AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY pos) - 1 AS idx, fdr < 1e-3 AND abs(diff) - 1e-1 > {NormalDist().inv_cdf(1 - 0.001)!r}::DOUBLE * diff_se AS sig FROM f)"""


@register("w3_bh_fdr", oracle(f"WITH {_FDR} SELECT chrom, pos, fdr FROM f", "v_dml"))
def w3(spark, d):
    return M.bh_fdr(_dml(spark, d), ["chrom"]).select("chrom", "pos", "fdr")


@register("w4_positional_index", oracle("SELECT chrom, pos, CAST(row_number() OVER (PARTITION BY chrom ORDER BY pos) - 1 AS BIGINT) AS idx FROM v_dml", "v_dml"))
def w4(spark, d):
    return M.indexed(_dml(spark, d)).select("chrom", "pos", "idx")


@register("w6_delta_significance", oracle(f"WITH {_FDR}, {_SIG} SELECT chrom, pos, sig FROM s", "v_dml"))
def w6(spark, d):
    return M.significant(M.bh_fdr(_dml(spark, d), ["chrom"])).select("chrom", "pos", "sig")


@register(
    "w7_dmr_regions",
    oracle(
        f"""WITH {_FDR}, {_SIG}, g AS (SELECT *, CASE WHEN pos - lag(pos + 1) OVER (PARTITION BY chrom ORDER BY pos) <= 250 THEN 0 ELSE 1 END AS fresh FROM s WHERE sig),
        i AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY pos) AS island FROM g),
        b AS (SELECT chrom, island, min(pos) AS start, max(pos) + 1 AS "end", min(idx) AS idx_start, max(idx) AS idx_end, count(*) AS n_sig FROM i GROUP BY 1, 2),
        a AS (SELECT b.chrom, b.start, b."end", b.idx_start, b.idx_end, b.n_sig, avg(s.mu1) AS mu1, avg(s.mu2) AS mu2, sum(s.stat) AS stat FROM b JOIN s ON s.chrom = b.chrom AND s.idx BETWEEN b.idx_start AND b.idx_end GROUP BY ALL),
        z AS (SELECT *, idx_end - idx_start + 1 AS total_dml, CAST(n_sig AS DOUBLE) / (idx_end - idx_start + 1) AS sig_ratio, mu1 - mu2 AS diff, "end" - start AS length FROM a)
        SELECT chrom, start, "end", idx_start, idx_end, n_sig, round(mu1, 9) AS mu1, round(mu2, 9) AS mu2, round(stat, 9) AS stat, total_dml, sig_ratio, round(diff, 9) AS diff, length, n_sig >= 1 AND sig_ratio > 5e-1 AND length >= 1 AND abs(diff) > 1e-1 AS selected_dmr FROM z""",
        "v_dml",
    ),
)
def w7(spark, d):
    out = M.call_regions(_dml(spark, d))
    return out.withColumns({c: F.round(c, 9) for c in ("mu1", "mu2", "stat", "diff")})


# Summaries


def _cells(spark, d) -> DataFrame:
    v = view(spark, d, "v_cell")
    return v.select("cell_id", "input_reads", *[c.alias(n) for n, c in X.position_v2(F.col("cell_id")).items()])


@register("a7_barcode_ratio", oracle("SELECT cell_id, CAST(input_reads AS DOUBLE) / CAST(sum(input_reads) OVER (PARTITION BY split_part(cell_id,'-',3)) AS DOUBLE) AS ratio FROM v_cell", "v_cell"))
def a7(spark, d):
    return Y.barcode_ratio(_cells(spark, d), "input_reads").select("cell_id", F.col("CellBarcodeRatio").alias("ratio"))


_GRID = """WITH p AS (SELECT split_part(cell_id,'-',1) AS "Plate", CAST(ascii(split_part(cell_id,'-',4)) - 65 AS BIGINT) AS r, CAST(substring(split_part(cell_id,'-',4),2) AS BIGINT) - 1 AS c, input_reads FROM v_cell),
 h AS (SELECT "Plate", r, c, avg(input_reads) AS v FROM p GROUP BY 1, 2, 3)
 SELECT g."Plate", i AS "Row384", j AS "Col384", h.v AS input_reads FROM (SELECT DISTINCT "Plate" FROM p) g, range(0, 16) a(i), range(0, 24) b(j) LEFT JOIN h ON h."Plate" = g."Plate" AND h.r = i AND h.c = j"""


@register("a18_plate_grid", oracle(_GRID.replace('FROM (SELECT DISTINCT "Plate" FROM p) g, range(0, 16) a(i), range(0, 24) b(j) LEFT', 'FROM (SELECT DISTINCT "Plate" FROM p) g CROSS JOIN range(0, 16) a(i) CROSS JOIN range(0, 24) b(j) LEFT'), "v_cell"))
def a18(spark, d):
    return Y.plate_grid(_cells(spark, d), "Plate", "input_reads")


@register(
    "a19_survival_curve",
    oracle(
        """WITH q AS (SELECT quantile_cont(input_reads, 1e-3) AS lo, quantile_cont(input_reads, 0.999e0) AS hi, count(*) AS n FROM v_cell)
        SELECT CAST(i AS INT) AS i, round(lo + (hi - lo) / 49 * i, 6) AS cutoff, round(CAST((SELECT count(*) FROM v_cell WHERE input_reads > lo + (hi - lo) / 49 * i) AS DOUBLE) / n * 100, 6) AS percent FROM q, range(0, 50) t(i)""",
        "v_cell",
    ),
)
def a19(spark, d):
    out = Y.survival(view(spark, d, "v_cell"), "input_reads", points=50)
    return out.select("i", F.round("cutoff", 6).alias("cutoff"), F.round("percent", 6).alias("percent"))


@register("a9_selected_dna", oracle(f"WITH {_LEVEL}, p AS (SELECT cell_id, CAST(floor(100 * frac) AS BIGINT) AS mc_frac, cov, count(*) AS c FROM lf GROUP BY ALL) SELECT cell_id, CAST(sum(c) FILTER (cov >= 3 AND mc_frac < 50) AS BIGINT) AS \"FinalDNAReads\", CAST(sum(c) FILTER (cov >= 3 AND mc_frac < 50) AS DOUBLE) / CAST(sum(c) AS DOUBLE) AS \"SelectedDNAReadsRatio\" FROM p GROUP BY cell_id", "v_calls", "v_reads"))
def a9(spark, d):
    v = R.call_string_level(view(spark, d, "v_calls"))
    p = v.groupBy("cell_id", F.floor(100 * F.col("frac")).cast("long").alias("mc_frac"), "cov").agg(F.count(F.lit(1)).alias("count"))
    return Y.selected_dna(p, 0.5, 3)


@register("a11_reads_per_group", "SELECT CAST(s_suppkey AS BIGINT) AS rg, count(l_orderkey) AS n FROM (SELECT s_suppkey FROM supplier UNION ALL SELECT -1) h LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1")
def a11(spark, d):
    header = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("rg")).unionByName(spark.range(-1, 0).withColumnRenamed("id", "rg"))
    return Y.reads_per_group(spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_suppkey").alias("rg")), header)


@register("f13_quality_flags", oracle("SELECT cell_id, input_reads < CASE WHEN (SELECT avg(input_reads) FROM v_cell) < 50000 THEN 2000 ELSE 500000 END AS low_reads, CAST(input_reads % 100 AS DOUBLE) / 1e3 > 3e-2 AS high_ccc FROM v_cell", "v_cell"))
def f13(spark, d):
    v = view(spark, d, "v_cell").withColumn("ccc", (F.col("input_reads") % 100) / F.lit(1e3))
    return Y.quality_flags(v, "ccc", "input_reads", 500_000, 2000, 50_000).select("cell_id", "low_reads", "high_ccc")


@register(
    "j4_summary_assembly",
    oracle(
        """WITH a AS (SELECT cell_id, count(*) AS n_parts FROM v_align WHERE mapq > 10 GROUP BY 1), b AS (SELECT cell_id, count(*) AS n_reads FROM v_reads GROUP BY 1), c AS (SELECT concat('cell', CAST(cell_no % 12 AS VARCHAR)) AS cell_id, CAST(sum(input_reads) AS BIGINT) AS input FROM v_cell GROUP BY 1)
        SELECT cell_id, n_parts, n_reads, input FROM a FULL JOIN b USING (cell_id) FULL JOIN c USING (cell_id)""",
        "v_align", "v_reads", "v_cell",
    ),
)
def j4(spark, d):
    a = view(spark, d, "v_align").where("mapq > 10").groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_parts"))
    b = view(spark, d, "v_reads").groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_reads"))
    c = view(spark, d, "v_cell").groupBy(F.concat(F.lit("cell"), (F.col("cell_no") % 12).cast("string")).alias("cell_id")).agg(F.sum("input_reads").alias("input"))
    return Y.assemble([a, b, c])


@register("a21_report_totals", oracle('SELECT count(*) AS cells, CAST(sum(input_reads) AS BIGINT) AS reads, avg(input_reads) AS mean_reads, count(DISTINCT split_part(cell_id,\'-\',1)) * 384 AS capacity FROM v_cell', "v_cell"))
def a21(spark, d):
    return Y.report_totals(_cells(spark, d), "input_reads")


@register(
    "a22_job_report",
    """SELECT event_type AS return_code, count(*) AS n, min(s) AS least, avg(s) AS mean, max(s) AS most FROM (SELECT event_type, CAST(epoch(date_trunc('second', ts) + to_seconds(user_id * 37 % 100000)) - epoch(date_trunc('second', ts)) AS BIGINT) AS s FROM events) t GROUP BY 1""",
)
def a22(spark, d):
    """X18 too: begin and end as schedulers write them."""
    e = spark.read.parquet(f"{d}/events.parquet").select(F.date_trunc("second", F.col("ts").cast("timestamp")).alias("t"), (F.col("user_id") * 37 % 100000).alias("s"), F.col("event_type").alias("return_code"))
    stamp = lambda t: F.date_format(t, "HH:mm:ss-MM/dd/yy")
    return Y.durations(e.select("return_code", stamp(F.col("t")).alias("start"), stamp(F.timestamp_seconds(F.unix_timestamp("t") + F.col("s"))).alias("end")))


@register("o7_distinct_labels", oracle("SELECT DISTINCT split_part(cell_id,'-',1) AS plate, split_part(cell_id,'-',2) AS grp FROM v_cell", "v_cell"))
def o7(spark, d):
    s = F.split("cell_id", "-")
    return view(spark, d, "v_cell").select(s[0].alias("plate"), s[1].alias("grp")).distinct()


@register("o8_intersect", oracle("SELECT chrom, pos FROM v_allc WHERE sample = 's0' INTERSECT SELECT chrom, pos FROM v_allc WHERE sample = 's1'", "v_allc"))
def o8(spark, d):
    v = view(spark, d, "v_allc")
    return v.where("sample = 's0'").select("chrom", "pos").intersect(v.where("sample = 's1'").select("chrom", "pos"))


@register("o9_not_finished", oracle("SELECT DISTINCT pair_id FROM v_align WHERE pair_id NOT IN (SELECT pair_id FROM v_align WHERE mapq = 60)", "v_align"))
def o9(spark, d):
    v = view(spark, d, "v_align")
    return Y.unfinished(v, v.where("mapq = 60"), "pair_id")


@register("o10_lanes", "SELECT s_suppkey, lane FROM supplier, range(1, 5) t(lane)")
def o10(spark, d):
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey").crossJoin(F.broadcast(spark.range(1, 5).withColumnRenamed("id", "lane")))


@register("t3_windowed_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def t3(spark, d):
    out = ST.windowed_counts(spark.read.parquet(f"{d}/events.parquet"))
    return out.withColumn("total", F.round("total", 6)).withColumn("start", F.col("start").cast("timestamp_ntz"))


# Further forms


@register("f6_select_split_reads", oracle(f"WITH {_LEVEL}, p AS (SELECT read_id // 3 AS parent, sum(mc) AS m, sum(cov) AS c FROM lf GROUP BY 1 HAVING floor(100 * CAST(sum(mc) AS BIGINT) / (CAST(sum(cov) AS BIGINT) + 1e-3)) < 50 AND sum(cov) >= 3) SELECT read_id FROM lf WHERE read_id // 3 IN (SELECT parent FROM p)", "v_calls", "v_reads"))
def f6(spark, d):
    """J10 too: parts of parents that pass."""
    name = F.concat(F.floor(F.col("read_id") / 3).cast("string"), F.element_at(F.array(F.lit("-l"), F.lit("-r"), F.lit("-m")), (F.pmod("read_id", F.lit(3)) + 1).cast("int")))
    return R.select_parents(R.call_string_level(view(spark, d, "v_calls")).withColumn("read_name", name), "dna").select("read_id")


@register(
    "x12_qname_fields",
    oracle(
        """WITH q AS (SELECT seq, flag, ref_len, CASE WHEN seq % 3 = 0 THEN concat('r', CAST(pair_id AS VARCHAR)) ELSE concat('r', CAST(pair_id AS VARCHAR), '_', CAST(read_type AS VARCHAR), ':', CAST(ss AS VARCHAR), ':', CAST(se AS VARCHAR)) END AS qname, read_type, ss, se, pair_id FROM v_align)
        SELECT seq, concat('r', CAST(pair_id AS VARCHAR)) AS read_name, CASE WHEN seq % 3 = 0 THEN CASE WHEN (flag & 64) <> 0 THEN 'F1' ELSE 'F2' END ELSE concat('S', CAST(read_type AS VARCHAR)) END AS st, CASE WHEN seq % 3 = 0 THEN 0 ELSE ss END AS ss, CASE WHEN seq % 3 = 0 THEN ref_len ELSE se END AS se FROM q""",
        "v_align",
    ),
)
def x12(spark, d):
    """X13 too: defaults where the name has no slice."""
    v = view(spark, d, "v_align")
    whole = F.concat(F.lit("r"), F.col("pair_id").cast("string"))
    v = v.withColumn("qname", F.when(F.col("seq") % 3 == 0, whole).otherwise(F.concat(whole, F.lit("_"), F.concat_ws(":", "read_type", "ss", "se")))).withColumn("qlen", F.col("ref_len"))
    return R.qname_fields(v.drop("ss", "se")).select("seq", "read_name", "st", "ss", "se")


@register("f9_enough_contacts", oracle("SELECT cell_id, count(*) AS n FROM v_contact WHERE cell_id IN (SELECT cell_id FROM v_contact GROUP BY 1 HAVING count(*) FILTER (chrom1 = chrom2 AND abs(start1 - start2) > 2500) > 190) GROUP BY 1", "v_contact", "v_align"))
def f9(spark, d):
    v = view(spark, d, "v_contact")
    counts = v.groupBy("cell_id").agg(F.count_if((F.col("chrom1") == F.col("chrom2")) & (F.abs(F.col("start1") - F.col("start2")) > 2500)).alias("CisLongContact"))
    return C.with_enough_contacts(v, counts, least=190).groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))


@register("f16_no_unread_bases", oracle("SELECT sample, count(*) AS n FROM (SELECT sample, CASE WHEN cov < 10 THEN concat(context[1:2], 'N') ELSE context END AS context FROM v_allc) t WHERE context NOT LIKE '%N%' GROUP BY 1", "v_allc"))
def f16(spark, d):
    """The last base of thinly covered sites counts as unread."""
    v = view(spark, d, "v_allc").withColumn("context", F.when(F.col("cov") < 10, F.concat(F.substring("context", 1, 2), F.lit("N"))).otherwise(F.col("context")))
    return S.read_contexts(v).groupBy("sample").agg(F.count(F.lit(1)).alias("n"))


@register("j6_reads_by_cluster", oracle("SELECT CAST(k.c AS VARCHAR) AS cluster, count(*) AS n FROM v_align a JOIN (SELECT concat('cell', CAST(i AS VARCHAR)) AS cell_id, i % 3 AS c FROM range(0, 6) t(i)) k ON a.cell_id = k.cell_id GROUP BY 1", "v_align"))
def j6(spark, d):
    """J7 too: reads of cells without a cluster go."""
    clusters = spark.range(6).select(F.concat(F.lit("cell"), F.col("id").cast("string")).alias("cell_id"), (F.col("id") % 3).cast("string").alias("cluster"))
    clusters = clusters.unionByName(spark.createDataFrame([("cell7", None)], "cell_id string, cluster string"))
    return Y.cluster_counts(Y.assign_clusters(view(spark, d, "v_align"), clusters)).withColumn("n", F.col("n").cast("long"))


@register(
    "a8_mc_columns",
    oracle(
        """WITH t AS (SELECT cell_id, split_part(cell_id,'-',3) AS "PCRIndex", input_reads AS r1, input_reads // 2 AS f1, input_reads // 3 AS f2 FROM v_cell)
        SELECT cell_id, r1 AS "CellInputReadPairs", f1 + f2 AS "FinalmCReads", CAST(r1 AS DOUBLE) / CAST(sum(r1) OVER (PARTITION BY "PCRIndex") AS DOUBLE) AS "CellBarcodeRatio" FROM t""",
        "v_cell",
    ),
)
def a8(spark, d):
    v = _cells(spark, d).select("cell_id", "PCRIndex", F.col("input_reads").alias("R1InputReads"), F.floor(F.col("input_reads") / 2).alias("R1FinalBismarkReads"), F.floor(F.col("input_reads") / 3).alias("R2FinalBismarkReads"))
    return Y.mc_columns(v).select("cell_id", "CellInputReadPairs", "FinalmCReads", "CellBarcodeRatio")


@register(
    "a8_m3c_columns",
    oracle(
        """WITH t AS (SELECT cell_id, input_reads AS x, input_reads % 7 AS a, input_reads % 5 AS b, input_reads % 3 AS c FROM v_cell)
        SELECT cell_id, CAST((x // 2) AS DOUBLE) / nullif(x, 0) * 100 AS "R1MappingRate", (1 - CAST((x // 4) AS DOUBLE) / nullif(x // 2, 0)) * 100 AS "R1DuplicationRate", a + b + c AS "TotalContacts", CAST(c AS DOUBLE) / nullif(a + b + c, 0) AS "TransRatio" FROM t""",
        "v_cell",
    ),
)
def a8_m3c(spark, d):
    x = F.col("input_reads")
    v = view(spark, d, "v_cell").select(
        "cell_id", *[c.alias(f"{r}{n}") for r in ("R1", "R2") for n, c in (("InputReads", x), ("TrimmedReads", x), ("UniqueMappedReads", F.floor(x / 2)), ("DeduppedReads", F.floor(x / 4)))],
        (x % 7).alias("CisShortContact"), (x % 5).alias("CisLongContact"), (x % 3).alias("TransContact"),
    )
    return Y.m3c_columns(v).select("cell_id", "R1MappingRate", "R1DuplicationRate", "TotalContacts", "TransRatio")


@register(
    "a10_rna_summary",
    oracle(
        """WITH f AS (SELECT cell_id, CASE WHEN mapq = 60 THEN 'Assigned' ELSE 'Unassigned' END AS status, count(*) AS n FROM v_align GROUP BY 1, 2), m AS (SELECT cell_id, count(DISTINCT pair_id) AS mapped FROM v_align GROUP BY 1)
        SELECT f.cell_id, CAST(sum(CASE WHEN status = 'Assigned' THEN n ELSE 0 END) AS BIGINT) AS "FinalCountedReads", CAST(sum(n) AS BIGINT) AS "FinalRNAReads", any_value(mapped) AS "RNAUniqueMappedReads", CAST(sum(n) AS DOUBLE) / any_value(mapped) AS "SelectedRNAReadsRatio" FROM f JOIN m USING (cell_id) GROUP BY 1""",
        "v_align",
    ),
)
def a10(spark, d):
    v = view(spark, d, "v_align")
    f = v.groupBy("cell_id", F.when(F.col("mapq") == 60, "Assigned").otherwise("Unassigned").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return Y.rna_summary(f, v.groupBy("cell_id").agg(F.count_distinct("pair_id").alias("mapped")))


@register(
    "x7_positions_or_none",
    oracle("SELECT cell_id, 'all' AS \"of\", split_part(cell_id,'-',1) AS \"Plate\", CAST(ascii(split_part(cell_id,'-',4)) - 65 AS BIGINT) AS \"Row384\" FROM v_cell UNION ALL SELECT cell_id, 'one bad', NULL, NULL FROM (SELECT cell_id FROM v_cell UNION ALL SELECT 'bad') t", "v_cell"),
)
def x7(spark, d):
    """With good names only, and with a bad one among them."""
    cells = view(spark, d, "v_cell").select("cell_id")
    mixed = cells.unionByName(spark.createDataFrame([("bad",)], "cell_id string"))
    outs = [Y.positions_or_none(c, X.position_v2(F.col("cell_id"))).select("cell_id", F.lit(n).alias("of"), "Plate", "Row384") for n, c in (("all", cells), ("one bad", mixed))]
    return outs[0].unionByName(outs[1])


@register("o6_union_lanes", "SELECT 1 AS lane, count(*) AS n FROM lineitem WHERE l_linenumber <= 3 UNION ALL SELECT 2, count(*) FROM lineitem WHERE l_linenumber > 3")
def o6(spark, d):
    v = spark.read.parquet(f"{d}/lineitem.parquet")
    lanes = [v.where(cond).select(F.lit(n).alias("lane")) for n, cond in ((1, "l_linenumber <= 3"), (2, "l_linenumber > 3"))]
    return lanes[0].unionByName(lanes[1]).groupBy("lane").agg(F.count(F.lit(1)).alias("n"))


@register("c16_impute")
def c16(spark, d):
    """Imputed matrices at a coarse resolution (no SQL form: iterates to a tolerance)."""
    m = C.contact_matrix(view(spark, d, "v_contact"), 50_000, ["cell_id"])
    return C.impute(m, bins=256).withColumn("value", F.round("value", 6))


_MATRIX = """m AS (SELECT cell_id, chrom1 AS chrom, least(start1 // 50000, start2 // 50000) AS bin1, greatest(start1 // 50000, start2 // 50000) AS bin2, count(*) AS n FROM v_contact WHERE chrom1 = chrom2 AND abs(start1 - start2) > 2500 GROUP BY ALL)"""


def _matrix(spark, d) -> DataFrame:
    return C.contact_matrix(view(spark, d, "v_contact"), 50_000, ["cell_id"])


_INSULATION = f"""{_MATRIX}, i AS (SELECT cell_id, chrom, b AS bin, CAST(sum(n) AS DOUBLE) / 25e0 AS score FROM (SELECT cell_id, chrom, n, unnest(range(greatest(bin1 + 1, bin2 - 4), least(bin2, bin1 + 5) + 1)) AS b FROM m) t GROUP BY ALL)"""


@register("c17_insulation", oracle(f"WITH {_INSULATION} SELECT * FROM i", "v_contact", "v_align"))
def c17_insulation(spark, d):
    return C.insulation(_matrix(spark, d), 5)


@register("c17_domain_boundaries", oracle(f"WITH {_INSULATION}, e AS (SELECT cell_id, chrom, unnest([bin - 1, bin, bin + 1]) AS bin FROM i), u AS (SELECT DISTINCT * FROM e) SELECT u.cell_id, u.chrom, u.bin, coalesce(x.score, 0e0) AS score FROM u LEFT JOIN i x ON (x.cell_id, x.chrom, x.bin) = (u.cell_id, u.chrom, u.bin) LEFT JOIN i l ON (l.cell_id, l.chrom, l.bin) = (u.cell_id, u.chrom, u.bin - 1) LEFT JOIN i r ON (r.cell_id, r.chrom, r.bin) = (u.cell_id, u.chrom, u.bin + 1) WHERE coalesce(x.score, 0) < coalesce(l.score, 0) AND coalesce(x.score, 0) < coalesce(r.score, 0)", "v_contact", "v_align"))
def c17_boundaries(spark, d):
    return C.domain_boundaries(C.insulation(_matrix(spark, d), 5))


_CPG = "cp AS (SELECT concat('chr', CAST(read_id % 3 + 1 AS STRING)) AS chrom, read_id % 400 AS bin, string_agg(seq, '' ORDER BY read_id) AS seq FROM v_reads GROUP BY 1, 2)"


@register(
    "c17_compartments",
    oracle(
        f"""WITH {_MATRIX}, {_CPG}, g AS (SELECT chrom, bin, CAST((length(seq) - length(replace(seq, 'CG', ''))) // 2 AS DOUBLE) / length(seq) AS cpg FROM cp), d AS (SELECT *, bin2 - bin1 AS d FROM m WHERE bin2 > bin1), o AS (SELECT *, CAST(n AS DOUBLE) / avg(n) OVER (PARTITION BY cell_id, chrom, d) AS w FROM d),
        e AS (SELECT cell_id, chrom, bin1 AS bin, bin2 AS other, w FROM o UNION ALL SELECT cell_id, chrom, bin2, bin1, w FROM o) SELECT e.cell_id, e.chrom, e.bin, round(sum(w * cpg) / sum(w), 9) AS score FROM e JOIN g ON g.chrom = e.chrom AND g.bin = e.other GROUP BY 1, 2, 3""",
        "v_contact", "v_align", "v_reads",
    ),
)
def c17_compartments(spark, d):
    """CpG ratio too, of sequences put together from reads."""
    v = view(spark, d, "v_reads").select(F.concat(F.lit("chr"), (F.col("read_id") % 3 + 1).cast("string")).alias("chrom"), (F.col("read_id") % 400).alias("bin"), "read_id", "seq")
    v = v.groupBy("chrom", "bin").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("read_id", "seq"))), lambda x: x["seq"]), "").alias("seq"))
    return C.compartments(_matrix(spark, d), C.cpg_ratio(v)).withColumn("score", F.round("score", 9))


@register("c17_embedding")
def c17(spark, d):
    return C.embed(C.contact_matrix(view(spark, d, "v_contact"), 50_000, ["cell_id"]), dims=3)


# Reports, made from the tables line by line and then parsed


def _orders_sql(body: str) -> str:
    return f"SELECT concat('c', CAST(o_orderkey AS VARCHAR)) AS cell_id, {body} FROM (SELECT o_orderkey, o_orderkey % 97 AS a, o_orderkey % 89 AS b, o_custkey % 83 AS c, o_custkey % 79 AS e FROM orders) t"


def _numbers(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/orders.parquet").selectExpr("concat('c', CAST(o_orderkey AS STRING)) AS cell_id", "o_orderkey % 97 AS a", "o_orderkey % 89 AS b", "o_custkey % 83 AS c", "o_custkey % 79 AS e")


def _as_lines(df: DataFrame, *lines: str) -> DataFrame:
    return df.select("cell_id", F.posexplode(F.array(*map(F.expr, lines))).alias("nr", "line"))


@register(
    "s11_paired_summary",
    _orders_sql("""2 * (a + b) + c AS total, 2 * a + 2 * e + b AS "UniqueMappedReads", 2 * b + c AS "MultiMappedReads", a AS "PEUniqueMappedReadPairs", b AS "SEUniqueMappedReads", c AS "ReadsMappedInSE" """).replace("2 * (a + b) + c AS total, ", ""),
)
def s11(spark, d):
    text = _as_lines(
        _numbers(spark, d), "'HISAT2 summary stats:'", "concat('\tTotal pairs: ', a + b)", "concat('\t\tAligned concordantly 1 time: ', a, ' (1.00%)')", "concat('\t\tAligned concordantly >1 times: ', b, ' (2.00%)')",
        "concat('\t\tAligned discordantly 1 time: ', e, ' (0.10%)')", "concat('\tTotal unpaired reads: ', c)", "concat('\t\tAligned 1 time: ', b, ' (3.00%)')", "concat('\t\tAligned >1 times: ', c, ' (3.00%)')", "'\tOverall alignment rate: 90.0%'",
    )
    return reports.paired_summary(text).select("cell_id", "UniqueMappedReads", "MultiMappedReads", "PEUniqueMappedReadPairs", "SEUniqueMappedReads", "ReadsMappedInSE")


@register("s12_single_summary", _orders_sql('a + b + c AS "ReadsMappedInSE", a AS "UniqueMappedReads", b AS "MultiMappedReads"'))
def s12(spark, d):
    text = _as_lines(_numbers(spark, d), "'HISAT2 summary stats:'", "concat('\tTotal reads: ', a + b + c)", "concat('\t\tAligned 0 time: ', c, ' (1%)')", "concat('\t\tAligned 1 time: ', a, ' (1%)')", "concat('\t\tAligned >1 times: ', b, ' (1%)')")
    return reports.single_summary(text).select("cell_id", "ReadsMappedInSE", "UniqueMappedReads", "MultiMappedReads")


_PICARD = ("'## htsjdk.samtools.metrics.StringHeader'", "'LIBRARY\tUNPAIRED_READS_EXAMINED\tREAD_PAIRS_EXAMINED\tUNPAIRED_READ_DUPLICATES\tREAD_PAIR_DUPLICATES\tPERCENT_DUPLICATION'",
           "concat_ws('\t', 'lib', a + c, b + e, c, e, '0.25')", "''", "'## HISTOGRAM\tjava.lang.Double'", "'BIN\tVALUE'", "concat('1.0\t', a)")


@register("s13_duplicate_metrics", _orders_sql("""a + 2 * b AS "FinalReads", c + 2 * e AS "DuplicatedReads", CAST(trunc((1 - CAST(a + 2 * b AS DOUBLE) / nullif(a + 2 * b + c + 2 * e, 0)) * 100) AS BIGINT) AS "PCRDuplicationRate" """))
def s13(spark, d):
    return reports.duplicate_metrics(_as_lines(_numbers(spark, d), *_PICARD))


@register("s14_read_duplicate_metrics", _orders_sql("""'R1' AS read_type, a + c AS "MAPQFilteredReads", c AS "DuplicatedReads", 0.25e0 AS "DuplicationRate", a AS "FinalBismarkReads" """))
def s14(spark, d):
    text = _as_lines(_numbers(spark, d), *_PICARD).withColumn("cell_id", F.concat("cell_id", F.lit("-R1")))
    return reports.read_duplicate_metrics(text)


_TRIM = "status\tin_reads\tin_bp\ttoo_short\ttoo_long\ttoo_many_n\tout_reads\tw/adapters\tqualtrim_bp\tout_bp"


@register("s15_trim_table", _orders_sql("'out_reads' AS metric, b AS value") + " UNION ALL " + _orders_sql("'in_reads' AS metric, a AS value"))
def s15(spark, d):
    return reports.trim_table(_as_lines(_numbers(spark, d), f"'{_TRIM}'", "concat_ws('\t', 'OK', a, a, 0, 0, 0, b, c, e, 9)")).where("metric in ('in_reads', 'out_reads')")


@register("s16_trim_stats", _orders_sql("""a + 1 AS "R1InputReads", 150 * a AS "R1InputReadsBP", c AS "R1WithAdapters", e AS "R1QualTrimBP", b AS "R1TrimmedReads", 90 * b AS "R1TrimmedReadsBP", CAST(b AS DOUBLE) / (a + 1) AS "R1TrimmedReadsRate" """))
def s16(spark, d):
    text = _as_lines(_numbers(spark, d), f"'{_TRIM}'", "concat_ws('\t', 'OK', a + 1, 150 * a, 0, 0, 0, a + 1, c, 0, 140 * a)", f"'{_TRIM}'", "concat_ws('\t', 'OK', a + 1, 140 * a, 0, 0, 0, b, 0, e, 90 * b)")
    return reports.by_read_type(reports.trim_stats(text.withColumn("cell_id", F.concat("cell_id", F.lit("-R1")))), ("R1",))


_ADAPTERS = ("'=== Summary ==='", "''", "concat('Total reads processed:      1,', lpad(a, 3, '0'))", "'=== Adapter Tn5 ==='", "''", "concat('Sequence: ACGT; Type: regular 3\\'; Length: 4; Trimmed: ', b, ' times')",
             "'=== Adapter polyA ==='", "''", "concat('Sequence: AAAA; Type: regular 3\\'; Length: 4; Trimmed: ', c, ' times')", f"'{_TRIM}'", "concat_ws('\t', 'OK', 1, 1, 0, 0, 0, b, 0, e, 7)")


@register("s17_adapter_stats", _orders_sql("""'R2' AS read_type, 1000 + a AS "InputReads", e AS "QualTrimBP", b AS "TrimmedReads", CAST(7 AS BIGINT) AS "TrimmedReadsBP", CAST(b AS DOUBLE) / (1000 + a) AS "TrimmedReadsRate", b AS "Tn5", c AS "polyA" """))
def s17(spark, d):
    total, adapters = reports.adapter_stats(_as_lines(_numbers(spark, d), *_ADAPTERS).withColumn("cell_id", F.concat("cell_id", F.lit("-R2"))))
    wide = adapters.groupBy("cell_id").agg(*[F.max(F.when(F.col("adapter") == a, F.col("trimmed"))).alias(a) for a in ("Tn5", "polyA")])
    return total.join(wide, "cell_id")


@register("s18_bisulfite_report", _orders_sql("""CAST(a AS VARCHAR) AS "TotalReads", concat(CAST(b AS VARCHAR), '.5%') AS "MappingRate", CAST(c AS VARCHAR) AS "UniqueMappedReads", CAST(e AS VARCHAR) AS "OT", CAST(NULL AS VARCHAR) AS "CTOB" """))
def s18(spark, d):
    text = _as_lines(_numbers(spark, d), "concat('Sequences analysed in total:\t', a)", "concat('Number of alignments with a unique best hit from the different alignments:\t', c)", "concat('Mapping efficiency:\t', b, '.5%  ')", "concat('CT/CT:\t', e, '\t((converted) top strand)')", "'x:y:z'")
    return reports.bisulfite_report(text).select("cell_id", "TotalReads", "MappingRate", "UniqueMappedReads", "OT", "CTOB")


@register("s19_feature_summary", _orders_sql("""a AS "Assigned", b + c AS "Unassigned_Total", CAST(trunc(a / (a + b + c + 1e-5) * 100) AS BIGINT) AS "AssignedRNAReadsRate" """))
def s19(spark, d):
    return reports.feature_summary(_as_lines(_numbers(spark, d), "'Status\tx.bam'", "concat('Assigned\t', a)", "concat('Unassigned_NoFeatures\t', b)", "concat('Unassigned_Ambiguity\t', c)"))


@register("s21_read_profile", _orders_sql("""'DNA' AS mode, CASE WHEN e >= 3 THEN a ELSE 0 END AS "FinalReads", CASE WHEN e >= 3 THEN a ELSE 0 END / (a + b + c + 1e-4) AS "SelectedReadsRatio" """))
def s21(spark, d):
    text = _as_lines(_numbers(spark, d), "'#mode=dna'", "'#mc_rate_max_threshold=0.5'", "'#cov_min_threshold=3'", "'mc_frac,cov,count'", "concat_ws(',', 50, e, a)", "concat_ws(',', 51, 9, b)", "concat_ws(',', 10, 2, c)")
    return reports.read_profile(text)


@register(
    "s10_demultiplex_report",
    _orders_sql("""'ACGT' AS "Sequence", concat('anchored 5', chr(39)) AS "Type", CAST(4 AS BIGINT) AS "Length", b AS "Trimmed", 1000 + a AS "TotalPair", CAST(b AS DOUBLE) / (1000 + a) AS "Ratio" """),
)
def s10(spark, d):
    return reports.demultiplex_report(_as_lines(_numbers(spark, d), "concat('Total read pairs processed:            1,', lpad(a, 3, '0'))", "concat('Sequence: ACGT; Type: anchored 5\\'; Length: 4; Trimmed: ', b, ' times')"))


@register("s27_fixed_width", "SELECT CAST(o_orderkey AS VARCHAR) AS \"JOBID\", o_orderstatus AS \"STATE\", o_orderpriority AS \"TIME\" FROM orders")
def s27(spark, d):
    head = "JOBID     STATE  TIME"
    text = spark.read.parquet(f"{d}/orders.parquet").select(F.concat(F.rpad(F.col("o_orderkey").cast("string"), 10, " "), F.rpad("o_orderstatus", 7, " "), "o_orderpriority").alias("line"))
    return reports.fixed_width(text, head, ["JOBID", "STATE", "TIME"])


# Names, sheets, cells and trimming


@register(
    "s4_cell_fastqs",
    "SELECT concat('cell', CAST(c_custkey % 50 AS VARCHAR)) AS cell_id, concat('/d/cell', CAST(c_custkey % 50 AS VARCHAR), '-R1.fq.gz') AS \"R1\", CASE WHEN max(c_custkey // 50 % 2) > 0 THEN concat('/d/cell', CAST(c_custkey % 50 AS VARCHAR), '_r2.fastq') END AS \"R2\" FROM customer GROUP BY c_custkey % 50",
)
def s4(spark, d):
    """Names of both kinds, trimmed files and others among them."""
    cell = F.concat(F.lit("/d/cell"), (F.col("c_custkey") % 50).cast("string"))
    names = F.array(F.concat(cell, F.lit("-R1.fq.gz")), F.when(F.floor(F.col("c_custkey") / 50) % 2 > 0, F.concat(cell, F.lit("_r2.fastq"))).otherwise(F.concat(cell, F.lit("-R2.trimmed.fq.gz"))), F.concat(cell, F.lit(".bam")))
    return D.pair_reads(D.cell_fastqs(spark.read.parquet(f"{d}/customer.parquet").select(F.explode(names).alias("path"))))


@register(
    "s2_v1_names",
    "SELECT c_custkey, CASE WHEN ok THEN concat(a, '-', b, '-', p) END AS uid FROM (SELECT *, a <> b AND regexp_matches(p, '^[A-H]([1-9]|1[0-2])$') AS ok FROM (SELECT c_custkey, concat('P', CAST(c_custkey % 5 AS VARCHAR)) AS a, concat('P', CAST(c_nationkey % 5 AS VARCHAR)) AS b, concat(substring('ABCDEFGHIJ', CAST(c_custkey % 10 + 1 AS INT), 1), CAST(c_custkey % 14 AS VARCHAR)) AS p FROM customer) t) u",
)
def s2(spark, d):
    v = spark.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey", "concat('/d/x-P', c_custkey % 5, '-P', c_nationkey % 5, '-', substring('ABCDEFGHIJ', CAST(c_custkey % 10 + 1 AS INT), 1), c_custkey % 14, '_S1_L001_R1_001.fastq.gz') AS path")
    return v.select("c_custkey", D.parse_fastq_name(F.col("path"), "V1")["uid"].alias("uid"))


@register(
    "x5_plate_position_v1",
    "SELECT c_custkey, concat('X', CAST(c_custkey % 3 AS VARCHAR)) AS \"Plate\", p AS \"PCRIndex\", concat('AD00', CAST(i AS VARCHAR)) AS \"RandomIndex\" FROM (SELECT c_custkey, [1,2,4,6][CAST(c_custkey % 4 + 1 AS INT)] AS i, concat(substring('ABCDEFGH', CAST(c_custkey % 8 + 1 AS INT), 1), CAST(c_custkey % 12 + 1 AS VARCHAR)) AS p FROM customer) t",
)
def x5(spark, d):
    v = spark.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey", "concat('X', c_custkey % 3, '-Y-', substring('ABCDEFGH', CAST(c_custkey % 8 + 1 AS INT), 1), c_custkey % 12 + 1, '-AD00', element_at(array(1, 2, 4, 6), CAST(c_custkey % 4 + 1 AS INT))) AS cell_id")
    at = X.position_v1(F.col("cell_id"))
    return v.select("c_custkey", *[at[n].alias(n) for n in ("Plate", "PCRIndex", "RandomIndex")])


_PRIMERS = [(f"{r}{c}", "".join("ACGT"[(n * 7 + k * k) % 4] for k in range(8)), "".join("ACGT"[(n * 5 + k) % 4] for k in range(8))) for n, (r, c) in enumerate((r, c) for r in "ABCDEFGHIJKLMNOP" for c in range(1, 25))]


@register(
    "j3_sample_sheet",
    f"WITH primers(primer_name, i7, i5) AS (VALUES {', '.join(map(repr, _PRIMERS))}), p AS (SELECT concat('P ', CAST(c_custkey % 100 AS VARCHAR)) AS plate, CAST(c_custkey % 6 + 1 AS VARCHAR) AS g, concat(substring('ABCDEFGHIJKLMNOP', CAST(c_custkey % 16 + 1 AS INT), 1), CAST(c_custkey % 24 + 1 AS VARCHAR)) AS primer_name FROM customer)"
    " SELECT lane AS \"Lane\", concat('lib-', replace(plate, ' ', '_'), '-', g, '-', primer_name) AS \"Sample_ID\", i7 AS \"index\", translate(reverse(i5), 'ACGT', 'TGCA') AS index2 FROM p JOIN primers USING (primer_name), range(1, 5) t(lane)",
)
def j3(spark, d):
    """T-10 and O10 too: the sheet with reversed i5, once a lane."""
    v = spark.read.parquet(f"{d}/customer.parquet").selectExpr("concat('P ', c_custkey % 100) AS plate_id", "CAST(c_custkey % 6 + 1 AS STRING) AS multiplex_group", "concat(substring('ABCDEFGHIJKLMNOP', CAST(c_custkey % 16 + 1 AS INT), 1), c_custkey % 24 + 1) AS primer_name", "'lib' AS sample_id_prefix", "'t' AS tube_label", "'e' AS email")
    primers = spark.createDataFrame(_PRIMERS, "primer_name string, i7 string, i5 string")
    return D.sample_sheets(v, primers, "V2")["novaseq.V1.5"].select(F.col("Lane").cast("long").alias("Lane"), "Sample_ID", "index", "index2")


@register(
    "j2_demultiplex_by_group",
    oracle(
        f"WITH codes(index_name, barcode, g) AS (VALUES {', '.join(repr((n, b, g)) for g in (1, 2) for n, b in _CODES[g::3])}) SELECT read_id, index_name FROM (SELECT *, read_id % 2 + 1 AS g FROM v_reads) r LEFT JOIN codes ON substring(seq, 1, 3) = barcode AND codes.g = r.g", "v_reads",
    ),
)
def j2(spark, d):
    v = view(spark, d, "v_reads").withColumn("multiplex_group", (F.col("read_id") % 2 + 1).cast("int"))
    codes = spark.createDataFrame([(n, b, g) for g in (1, 2) for n, b in _CODES[g::3]], "index_name string, barcode string, multiplex_group int")
    return D.demultiplex(v, codes, 3, by_group=D.barcode_groups(v)).select("read_id", "index_name")


@register(
    "t1_quality_cut",
    oracle(
        """WITH q AS (SELECT read_id, i, ascii(substring(md5(CAST(read_id AS VARCHAR)), i, 1)) % 42 AS q FROM v_reads, range(1, 33) t(i)),
        s AS (SELECT *, sum(q - 20) OVER (PARTITION BY read_id ORDER BY i DESC) AS run FROM q),
        stop AS (SELECT *, max(CASE WHEN run > 0 THEN i ELSE 0 END) OVER (PARTITION BY read_id) AS last FROM s)
        SELECT read_id, CAST(coalesce(max_by(i, {'m': -run, 'i': i}) FILTER (i > last AND run < 0) - 1, 32) AS INT) AS n FROM stop GROUP BY 1""",
        "v_reads",
    ),
)
def t1_quality(spark, d):
    quals = F.transform(F.filter(F.split(F.md5(F.col("read_id").cast("string")), ""), lambda c: c != ""), lambda c: F.ascii(c) % 42)
    return view(spark, d, "v_reads").select("read_id", quals.alias("q")).select("read_id", R.quality_cut(F.col("q")).cast("int").alias("n"))


@register(
    "t1_adapter_cut",
    oracle(
        """WITH h AS (SELECT read_id, length(seq) AS n, i, list_sum([CASE WHEN i + k <= 128 AND substring(seq, CAST(i + k AS INT), 1) <> substring('ACGTACGT', CAST(k + 1 AS INT), 1) THEN 1 ELSE 0 END for k in range(0, 8)]) AS wrong FROM v_reads, range(1, 125) t(i))
        SELECT r.read_id, CAST(coalesce(min(i) FILTER (wrong <= floor(least(n - i + 1, 8) * 0.3e0)) - 1, 128) AS INT) AS n FROM v_reads r LEFT JOIN h ON h.read_id = r.read_id GROUP BY 1""",
        "v_reads",
    ),
)
def t1_adapter(spark, d):
    return view(spark, d, "v_reads").select("read_id", R.adapter_cut(F.col("seq"), "ACGTACGT", overlap=5, errors=0.3).alias("n"))


@register("t1_pair_filter", oracle("SELECT read_id FROM v_reads WHERE read_id % 60 >= 30 OR read_id % 70 >= 30", "v_reads"))
def t1_pairs(spark, d):
    v = view(spark, d, "v_reads").select("read_id", F.substring("seq", F.lit(1), (F.col("read_id") % 60).cast("int")).alias("seq1"), F.substring("seq", F.lit(1), (F.col("read_id") % 70).cast("int")).alias("seq2"))
    return R.keep_pairs(v).select("read_id")


@register("x14_read_type", oracle("SELECT seq, CAST(CASE WHEN seq % 3 = 0 THEN read_type WHEN seq % 2 = 0 THEN 1 ELSE 2 END AS INT) AS t FROM v_align", "v_align"))
def x14(spark, d):
    v = view(spark, d, "v_align").withColumn("flag", F.when(F.col("seq") % 3 == 0, F.col("flag")).otherwise(0)).withColumn("st", F.when(F.col("seq") % 2 == 0, "S1").otherwise("S2"))
    return v.select("seq", R.contact_read_type(F.col("flag"), F.col("st")).alias("t"))


@register("o2_name_sort", oracle("SELECT CAST(read_id AS VARCHAR) AS read_name, row_number() OVER (ORDER BY CAST(read_id AS VARCHAR)) - 1 AS at FROM v_reads", "v_reads"))
def o2(spark, d):
    """The place of a read in the sorted table: the rows before its partition, and its own place there."""
    v = formats.name_sorted(view(spark, d, "v_reads").select(F.col("read_id").cast("string").alias("read_name")))
    return v.withColumn("at", F.row_number().over(Window.orderBy("read_name")).cast("long") - 1)


@register(
    "f10_contact_filter",
    oracle(
        """WITH far AS (SELECT * FROM v_contact WHERE NOT (chrom1 = chrom2 AND abs(start1 - start2) <= 2500)), clean AS (SELECT * FROM far f WHERE NOT EXISTS (SELECT 1 FROM v_gene g WHERE g.g_end - g.g_start >= 1900 AND ((g.chrom = f.chrom1 AND f.start1 >= g.g_start AND f.start1 < g.g_end) OR (g.chrom = f.chrom2 AND f.start2 >= g.g_start AND f.start2 < g.g_end))))
        SELECT DISTINCT cell_id, chrom1, start1, chrom2, start2 FROM clean WHERE NOT (chrom1 = 'chr1' AND start1 // 10000 IN (0, 1, 2) AND chrom2 = 'chr2' AND start2 // 10000 IN (3, 4)) AND NOT (chrom1 = 'chr2' AND start1 // 10000 IN (3, 4) AND chrom2 = 'chr1' AND start2 // 10000 IN (0, 1, 2))""",
        "v_contact", "v_gene", "v_align",
    ),
)
def f10_contacts(spark, d):
    genes = view(spark, d, "v_gene").where("g_end - g_start >= 1900").select("chrom", F.col("g_start").alias("start"), F.col("g_end").alias("end"))
    pairs = spark.createDataFrame([("chr1", 0, 30_000, "chr2", 30_000, 50_000)], "chrom1 string, bstart1 long, bend1 long, chrom2 string, bstart2 long, bend2 long")
    return C.filter_contacts(view(spark, d, "v_contact"), genes, pairs, remove_duplicates=True).select("cell_id", "chrom1", "start1", "chrom2", "start2")


@register("a3_all_cells", oracle(f"SELECT c.sample, mCG_mC, cov AS \"GenomeCov\" FROM (SELECT DISTINCT sample FROM v_allc UNION SELECT 's9') c LEFT JOIN (SELECT sample, CAST(sum(mc) AS BIGINT) AS mCG_mC FROM v_allc WHERE regexp_matches(context, '{_regex('CGN')}') AND sample <> 's0' GROUP BY 1) p ON p.sample = c.sample LEFT JOIN (SELECT sample, CAST(count(*) AS DOUBLE) / 1e6 AS cov FROM v_allc GROUP BY 1) g ON g.sample = c.sample", "v_allc"))
def a3_all(spark, d):
    v = view(spark, d, "v_allc")
    stats = S.pattern_stats(v.where("sample <> 's0'"), ["sample"], {"CGN": "mCG"}).select("sample", F.col("mCGmC").alias("mCG_mC"))
    cells = v.select("sample").unionByName(spark.createDataFrame([("s9",)], "sample string"))
    return S.all_cells(stats, cells, v.groupBy("sample").agg((F.count(F.lit(1)) / F.lit(1e6)).alias("genome_cov")), "sample")


_RNA = """t AS (SELECT cell_id, split_part(cell_id,'-',1) AS plate, split_part(cell_id,'-',3) AS pcr, x, x // 5 AS f, x // 7 AS r FROM (SELECT cell_id, CAST(sum(input_reads) AS BIGINT) AS x FROM v_cell GROUP BY 1) u)"""


def _rna_tables(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    v, x = view(spark, d, "v_cell").groupBy("cell_id").agg(F.sum("input_reads").alias("input_reads")), F.col("input_reads")
    base = v.select("cell_id", *[c.alias(f"{r}{n}") for r in ("R1", "R2") for n, c in (("InputReads", x), ("TrimmedReads", x), ("UniqueMappedReads", F.floor(x / 2)), ("DeduppedReads", F.floor(x / 4)), ("FinalBismarkReads", F.floor(x / 3)))],
                    (x % 7).alias("CisShortContact"), (x % 5).alias("CisLongContact"), (x % 3).alias("TransContact"))
    return base, v.select("cell_id", F.floor(x / 5).alias("FinalDNAReads")), v.select("cell_id", F.floor(x / 7).alias("FinalRNAReads"))


@register(
    "a8_mct_summary",
    oracle(f"""WITH {_RNA} SELECT cell_id, plate AS "Plate", CAST(x AS DOUBLE) / CAST(sum(x) OVER (PARTITION BY pcr) AS DOUBLE) AS "CellBarcodeRatio", x // 3 * 2 AS "FinalmCReads", CAST(f AS DOUBLE) / nullif(2 * x, 0) AS "DNAReadsYield", CAST(r AS DOUBLE) / nullif(x, 0) AS "RNAReadsYield", CAST(r AS DOUBLE) / (x // 3 + 1) AS share FROM t""", "v_cell"),
)
def a8_mct(spark, d):
    """J4 and J5 too: tables side by side, with plate positions."""
    out = Y.mapping_summary("mct", list(_rna_tables(spark, d)), X.position_v2(F.col("cell_id")))
    return out.select("cell_id", "Plate", "CellBarcodeRatio", "FinalmCReads", "DNAReadsYield", "RNAReadsYield", F.col("`RNA/(DNA+RNA)`").alias("share"))


@register(
    "a8_4m_summary",
    oracle(f"""WITH {_RNA} SELECT cell_id, plate AS "Plate", x // 4 * 2 AS "FinalmCReads", x % 7 + x % 5 + x % 3 AS "TotalContacts", CAST(f AS DOUBLE) / nullif(2 * x, 0) AS "DNAReadsYield", CAST(r AS DOUBLE) / (x // 4 + 1) AS share FROM t""", "v_cell"),
)
def a8_4m(spark, d):
    out = Y.mapping_summary("4m", list(_rna_tables(spark, d)), X.position_v2(F.col("cell_id")))
    return out.select("cell_id", "Plate", "FinalmCReads", "TotalContacts", "DNAReadsYield", F.col("`RNA/(DNA+RNA)`").alias("share"))


@register("a13_gene_info", oracle("SELECT cell_id, gene_id, count(*) AS n, any_value(chrom) AS g_chrom, any_value(len) AS length FROM (SELECT a.cell_id, g.gene_id, g.chrom, g.g_end - g.g_start AS len FROM v_align a JOIN v_gene g ON a.chrom = g.chrom AND a.pos_start >= g.g_start AND a.pos_start < g.g_end) t GROUP BY 1, 2", "v_align", "v_gene"))
def a13_info(spark, d):
    g = _genes(spark, d)
    hits = I.overlap_join(view(spark, d, "v_align").withColumn("at_end", F.col("pos_start") + 1), g, ("chrom", "pos_start", "at_end"), ("g_chrom", "g_start", "g_end"), 2048).select("cell_id", "gene_id", F.lit(1).alias("n"))
    return Y.with_gene_info(hits, g.select("gene_id", "g_chrom", (F.col("g_end") - F.col("g_start")).alias("length")))


@register(
    "t9_multigroup_regions",
    oracle(
        f"""WITH {_FDR}, s AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY pos) - 1 AS idx, fdr < 1e-3 AS sig FROM f),
        g AS (SELECT *, CASE WHEN pos - lag(pos + 1) OVER (PARTITION BY chrom ORDER BY pos) <= 250 THEN 0 ELSE 1 END AS fresh FROM s WHERE sig),
        i AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY pos) AS island FROM g),
        b AS (SELECT chrom, min(pos) AS start, max(pos) + 1 AS "end", min(idx) AS idx_start, max(idx) AS idx_end, count(*) AS n_sig FROM i GROUP BY chrom, island),
        a AS (SELECT b.chrom, b.start, b."end", b.n_sig, b.idx_end - b.idx_start + 1 AS total_dml, sum(s.stat) AS stat FROM b JOIN s ON s.chrom = b.chrom AND s.idx BETWEEN b.idx_start AND b.idx_end GROUP BY ALL)
        SELECT chrom, start, "end", n_sig, total_dml, round(stat, 9) AS stat, CAST(n_sig AS DOUBLE) / total_dml > 5e-1 AS selected_dmr FROM a""",
        "v_dml",
    ),
)
def t9(spark, d):
    return M.call_multigroup_regions(_dml(spark, d).drop("mu1", "mu2", "diff", "diff_se")).select("chrom", "start", "end", "n_sig", "total_dml", F.round("stat", 9).alias("stat"), "selected_dmr")


@register("t9_tested_regions", oracle("WITH q AS (SELECT *, row_number() OVER (ORDER BY pval) AS r, count(*) OVER () AS n FROM v_dml), f AS (SELECT *, least(min(pval * n / r) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1e0) AS fdr FROM q) SELECT chrom, pos, fdr, fdr < 5e-2 AND pos % 11 >= 5 AS selected_dmr FROM f", "v_dml"))
def t9_tested(spark, d):
    v = _dml(spark, d).withColumn("n_cg", F.col("pos") % 11)
    return M.tested_regions(v).select("chrom", "pos", "fdr", "selected_dmr")


@register(
    "t3_sessions",
    """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k""",
)
def t3_sessions(spark, d):
    out = ST.sessions(spark.read.parquet(f"{d}/events.parquet"))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})
