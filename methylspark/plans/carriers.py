"""Genomic-shaped views over the driver tables. The same SQL text runs in Spark and in DuckDB."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

_BASES = "'0123456789abcdef','ACGTACGTACGTACGT'"

#: Tables in braces are the driver's; views in braces are others of these.
VIEWS: dict[str, str] = {
    # One read of 128 bases per order.
    "v_reads": f"""SELECT o_orderkey AS read_id, CAST(o_orderkey % 2 + 1 AS INT) AS read_type, concat('cell', CAST(o_custkey % 8 AS STRING)) AS cell_id,
 concat({", ".join(f"translate(md5(concat(CAST(o_orderkey AS STRING),'{c}')),{_BASES})" for c in "abcd")}) AS seq FROM {{orders}}""",
    # One read part per line item; an order is a read pair.
    "v_align": """SELECT l_orderkey * 1000 + CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS BIGINT) AS seq,
 l_orderkey AS pair_id, concat('cell', CAST(l_orderkey % 8 AS STRING)) AS cell_id, CAST(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS INT) AS read_type,
 concat('chr', CAST(l_suppkey % 3 + 1 AS STRING)) AS chrom, l_partkey * 500 AS pos_start, l_partkey * 500 + 30 + CAST(l_quantity AS BIGINT) AS pos_end,
 CAST(CASE WHEN l_linestatus = 'O' THEN 60 ELSE l_linenumber - 1 END AS INT) AS mapq,
 CAST(CASE WHEN l_linenumber % 3 = 0 THEN 256 ELSE 0 END + CASE WHEN l_partkey % 2 = 0 THEN 16 ELSE 0 END + CASE WHEN l_returnflag = 'A' THEN 64 ELSE 128 END AS INT) AS flag,
 CASE WHEN l_partkey % 3 = 0 THEN '+' WHEN l_partkey % 3 = 1 THEN '-' END AS yz,
 CAST(l_linenumber * 20 AS BIGINT) AS ss, l_linenumber * 20 + 5 + CAST(l_quantity AS BIGINT) AS se,
 30 + CAST(l_quantity AS BIGINT) AS ref_len, 0 - CAST(round(l_discount * 1e2) AS BIGINT) AS as_score FROM {lineitem}""",
    # Cytosine sites.
    "v_allc": f"""SELECT sample, chrom, pos, CASE WHEN pos % 2 = 0 THEN '+' ELSE '-' END AS strand,
 concat('C', substring(translate(md5(CAST(pos AS STRING)),{_BASES}), 1, 2)) AS context, CAST(sum(mc) AS BIGINT) AS mc, CAST(sum(cov) AS BIGINT) AS cov FROM (
 SELECT concat('s', CAST(l_suppkey % 6 AS STRING)) AS sample, CASE WHEN l_orderkey % 37 = 0 THEN 'chrL' ELSE concat('chr', CAST(l_orderkey % 3 + 1 AS STRING)) END AS chrom,
 l_partkey * 10 + l_linenumber AS pos, CAST(floor(l_quantity * round(l_discount * 1e2) / 1e1) AS BIGINT) AS mc, CAST(l_quantity AS BIGINT) AS cov FROM {{lineitem}}) t GROUP BY sample, chrom, pos""",
    # Open-chromatin fragments of clusters.
    "v_frag": """SELECT concat('chr', CAST(l_suppkey % 3 + 1 AS STRING)) AS chrom, l_returnflag AS cluster, l_partkey * 20 AS frag_start, l_partkey * 20 + CAST(l_quantity AS BIGINT) * 4 AS frag_end FROM {lineitem}""",
    "v_gene": """SELECT p_partkey AS gene_id, concat('chr', CAST(p_partkey % 3 + 1 AS STRING)) AS chrom, p_partkey * 500 AS g_start, p_partkey * 500 + CAST(p_size AS BIGINT) * 40 AS g_end FROM {part}""",
    # Tests of single CpGs.
    "v_dml": """SELECT concat('chr', CAST(p_partkey % 3 + 1 AS STRING)) AS chrom, p_partkey * 60 AS pos,
 CAST((p_partkey * 7919) % 1000 + 1 AS DOUBLE) / CASE WHEN p_partkey % 40 < 12 THEN 1e8 ELSE 1e3 END AS pval,
 CAST(p_size - 25 AS DOUBLE) / 5e1 AS diff, CAST(p_size % 7 + 1 AS DOUBLE) / 1e2 AS diff_se, CAST(p_size AS DOUBLE) / 5e1 AS mu1, CAST(25 AS DOUBLE) / 5e1 AS mu2,
 CAST(p_size % 11 - 5 AS DOUBLE) AS stat FROM {part}""",
    "v_cell": """SELECT c_custkey AS cell_no, concat('P', CAST(c_nationkey AS STRING), '-', CAST(c_custkey % 6 + 1 AS STRING), '-',
 substring('ABCDEFGHIJKLMNOP', CAST(c_custkey % 16 + 1 AS INT), 1), CAST(c_custkey % 24 + 1 AS STRING), '-',
 substring('ABCDEFGHIJKLMNOP', CAST(floor(c_custkey / 24) AS INT) % 16 + 1, 1), CAST(c_custkey % 24 + 1 AS STRING)) AS cell_id,
 CAST(round(abs(c_acctbal)) AS BIGINT) AS input_reads FROM {customer}""",
    # Contacts between neighbouring parts of a pair.
    "v_contact": """SELECT seq, cell_id, pair_id, chrom1, start1, end1, chrom2, start2, end2 FROM (
 SELECT seq, cell_id, pair_id, lag(chrom) OVER w AS chrom1, lag(pos_start) OVER w AS start1, lag(pos_end) OVER w AS end1, chrom AS chrom2, pos_start AS start2, pos_end AS end2
 FROM {v_align} a WINDOW w AS (PARTITION BY pair_id ORDER BY seq)) t WHERE chrom1 IS NOT NULL""",
    # Bisulfite call strings: one per read.
    "v_calls": """SELECT read_id, cell_id, read_type, translate(seq, 'ACGT', 'hXZx') AS xm FROM {v_reads} r""",
}


def _expand(name: str) -> str:
    inner = {v: f"({_expand(v)})" for v in VIEWS if "{" + v + "}" in VIEWS[name]}
    return reduce(lambda s, kv: s.replace("{" + kv[0] + "}", kv[1]), inner.items(), VIEWS[name])


TABLES = ("orders", "lineitem", "part", "customer", "events", "supplier", "nation", "region")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = _expand(name)
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def oracle(body: str, *names: str) -> str:
    """DuckDB SQL with the named views as common table expressions before ``body`` (which may begin with its own WITH)."""

    def duck(name: str) -> str:
        text = _expand(name)
        for t in TABLES:
            text = text.replace("{" + t + "}", t)
        return f"{name} AS ({text})"

    ctes, body = ", ".join(map(duck, names)), body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
