"""Goldens written by hand from the rules, and properties."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from methylspark.functions import sequence as X
from methylspark.operators import contacts as C
from methylspark.operators import demux as D
from methylspark.operators import dmr as M
from methylspark.operators import intervals as I
from methylspark.operators import reads as R
from methylspark.operators import sites as S
from methylspark.operators import summary as Y
from methylspark.sources import formats, reports


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {'boolean' if isinstance(v, bool) else 'int' if isinstance(v, int) else 'string'}" for n, v in values.items()))
    assert names == df.columns
    return df.select(column.alias("x")).first()["x"]


def test_complements(spark):
    assert one(spark, X.reverse_complement(F.col("s")), s="AACCGTNacgt") == "aCGtNACGGTT"
    assert one(spark, X.complement(F.col("s")), s="ACGTN") == "TGCAN"
    assert one(spark, X.complement(F.col("s")), s="ACX") == "ACX"


def test_patterns():
    assert X.contexts_of("CCC") == ["CCC"]
    assert X.contexts_of("CGN") == ["CGA", "CGC", "CGG", "CGN", "CGT"]
    assert len(X.contexts_of("CHN")) == 15
    with pytest.raises(KeyError):
        X.contexts_of("CXN")


def test_plate_positions(spark):
    v1 = {k: one(spark, c, s="X-Y-B3-AD004") for k, c in X.position_v1(F.col("s")).items()}
    assert v1 == {"Plate": "X", "PCRIndex": "B3", "RandomIndex": "AD004", "Col384": 5, "Row384": 2}
    v2 = {k: one(spark, c, s="X-1-A1-C7") for k, c in X.position_v2(F.col("s")).items()}
    assert (v2["Col384"], v2["Row384"], v2["MultiplexGroup"]) == (6, 2, "1")
    assert {one(spark, c, s="nonsense") for c in X.position_v1(F.col("s")).values()} == {None}


def test_span_slices(spark):
    spans = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(e).alias("e")) for b, e in ((3, 7), (7, 11), (68, 72), (144, 148))])
    got = spark.range(1).select(R.span_slices(spans).alias("s")).first()["s"]
    assert sorted((s["b"], s["e"]) for s in got) == [(3, 72), (3, 148), (7, 72), (7, 148), (68, 148)]


@pytest.mark.parametrize(("seq", "want"), [("AAAA", [(0, 0), (4, 4)]), ("CATGAA", [(0, 4), (6, 6)]), ("AACATG", [(0, 0), (2, 6)]), ("CATG", [(0, 4)]), ("CATGGATC", [(0, 4), (4, 8)])])
def test_cut_spans(spark, seq, want):
    got = spark.createDataFrame([(seq,)], "s string").select(R.cut_spans(F.col("s"), 1).alias("x")).first()["x"]
    assert [(s["b"], s["e"]) for s in got] == want


def test_nome_call_string(spark):
    df = spark.createDataFrame([("XhZH", "CGCA", False), ("XhZH", "CCAC", True), ("", "", False)], "xm string, seq string, rev boolean")
    got = [tuple(r["x"]) for r in df.select(R.call_string_level_nome(F.col("xm"), F.col("seq"), F.col("rev")).alias("x")).collect()]
    assert got[0] == (1, 2)  # the first position counts as GpC, h and H stay
    assert got[2] == (0, 0)


def test_quality_cut(spark):
    df = spark.createDataFrame([([40, 40, 10, 10],), ([40, 40],), ([2, 2],), ([],)], "q array<int>")
    assert [r["n"] for r in df.select(R.quality_cut(F.col("q")).alias("n")).collect()] == [2, 2, 0, 0]


def part(seq, chrom, start, end, ss, se, read_type=2):
    return {"seq": seq, "chrom": chrom, "pos_start": start, "pos_end": end, "strand": 0, "ss": ss, "se": se, "read_type": read_type}


def called(spark, pairs, span=2500):
    """(contact_type, seq of one end, seq of the other) per pair; parts are told by where they start."""
    rows = [(n, *p.values()) for n, parts in enumerate(pairs) for p in parts]
    df = spark.createDataFrame(rows, "pair_id long, seq long, chrom string, pos_start long, pos_end long, strand int, ss long, se long, read_type int")
    out = [[] for _ in pairs]
    for r in C.call_contacts(df, ["pair_id"], span).collect():
        out[r["pair_id"]].append((r["contact_type"], (r["chrom1"], r["start1"], r["read_start1"]), (r["chrom2"], r["start2"], r["read_start2"])))
    return [sorted(x, key=repr) for x in out]


def plain_contacts(parts, span=2500):
    """The rules on small lists: a part's fragment is the first whose widened interval meets its own."""
    frags, of = [], []
    for p in parts:
        lo, hi = p["pos_start"] - span, p["pos_end"] + span
        k = next((k for k, (c, a, b) in enumerate(frags) if c == p["chrom"] and a < hi and lo < b), len(frags))
        if k == len(frags):
            frags.append((p["chrom"], lo, hi))
        frags[k] = (p["chrom"], min(frags[k][1], lo), max(frags[k][2], hi))
        of.append(k)
    nothing = (None, None, None)
    if len(frags) < 2:
        return [("no", nothing, nothing)]
    slices, best = {(p["read_type"], p["ss"], p["se"]) for p in parts}, {}
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            if of[i] < of[j]:
                place = "cis" if a["chrom"] == b["chrom"] else "trans"
                if a["read_type"] == b["read_type"]:
                    t = a["read_type"]
                    if a["se"] == b["ss"] or b["se"] == a["ss"]:
                        place += "cut"
                    elif len(frags) > 2 and ((t, a["se"], b["ss"]) in slices or (t, b["se"], a["ss"]) in slices):
                        continue
                    else:
                        place = "chimeric"
                key = (-C.PRIORITY.index(place), i, j)
                best[of[i], of[j]] = max(best.get((of[i], of[j]), key), key)
    ends = lambda p: (p["chrom"], p["pos_start"], p["ss"])
    many = "_multi" * (len(frags) > 2)
    out = [("chimeric", nothing, nothing) if C.PRIORITY[-r] == "chimeric" else (C.PRIORITY[-r] + many, ends(parts[i]), ends(parts[j])) for r, i, j in best.values()]
    return sorted(out, key=repr)


def test_contact_types(spark):
    a, b = part(1, "chr1", 0, 50, 0, 43), part(2, "chr2", 0, 50, 43, 82)
    pairs = [[a], [a, part(2, "chr1", 5040, 5060, 50, 90)], [a, part(2, "chr1", 5050, 5060, 50, 90)], [a, b], [a, part(2, "chr1", 90_000, 90_050, 0, 30, 1)]]
    assert [[t for t, *_ in x] for x in called(spark, pairs)] == [["no"], ["no"], ["chimeric"], ["transcut"], ["cis"]]


def test_bridged_parts_are_no_chimera(spark):
    parts = [part(1, "chr11", 17030146, 17030195, 82, 131), part(2, "chr4", 74624619, 74624658, 43, 82), part(3, "chr1", 45747948, 45747992, 0, 43)]
    assert [t for t, *_ in called(spark, [parts])[0]] == ["transcut_multi", "transcut_multi"]


def test_contacts_agree_with_the_plain_rules(spark):
    rng = np.random.default_rng(4)
    pairs = []
    for _ in range(400):
        n, cuts = int(rng.integers(1, 8)), np.arange(0, 200, 20)
        parts = []
        for k in range(n):
            start, ss = int(rng.integers(0, 6)) * 3000, int(rng.choice(cuts))
            parts.append(part(k, f"chr{rng.integers(1, 3)}", start, start + 50, ss, ss + 20 * int(rng.integers(1, 4)), int(rng.integers(1, 3))))
        pairs.append(parts)
    assert called(spark, pairs) == [plain_contacts(p) for p in pairs]
    kinds = {t for x in pairs for t, *_ in plain_contacts(x)}
    assert kinds == set(C.KINDS)


def test_contact_pipeline(spark):
    parts = [(c, n, k, "chr1", 100_000 * k, 100_000 * k + 50, 0, 40 * k, 40 * k + 40, 2) for c in ("x", "y") for n in range(3) for k in range(2)]
    df = spark.createDataFrame(parts, "cell_id string, pair_id long, seq long, chrom string, pos_start long, pos_end long, strand int, ss long, se long, read_type int")
    out = C.contact_pipeline(df, ["cell_id"], save_raw=True, drop_last_pair=True)
    assert out["raw"].count() == 6 and out["dedup"].count() == 2 and out["short"].columns == ["str1", "chr1", "pos1", "frag1", "str2", "chr2", "pos2", "frag2"]
    assert sorted(r["read_pair_id"] for r in out["raw"].where("cell_id = 'x'").collect()) == [0, 1, 2]
    for r in out["stats"].collect():
        assert (r["ciscut"], r["mapped_frag"], r["dedup_frag"], r["dup_rate"]) == (3, 2, 1, pytest.approx(2 / 3, abs=1e-4))
    assert C.contact_pipeline(df.limit(0), ["cell_id"])["stats"].count() == 0


def test_best_parts_tie_goes_to_the_later(spark):
    df = spark.createDataFrame([(1, 1, 0, 50, 50, 0), (1, 2, 0, 50, 50, 0), (1, 3, 50, 90, 40, 0)], "pair long, seq long, ss long, se long, ref_len long, as_score long")
    assert sorted(r["seq"] for r in C.best_parts(df, ["pair"]).collect()) == [2, 3]


def test_dedup_needs_both_anchors(spark):
    rows = [(1, "a", 10, 20, "b", 5, 9), (2, "a", 10, 21, "b", 50, 60), (3, "a", 10, 20, "b", 5, 9)]
    df = spark.createDataFrame(rows, "seq long, chrom1 string, start1 long, end1 long, chrom2 string, start2 long, end2 long")
    kept = {r["seq"] for r in C.dedup_contacts(df, []).collect()}
    assert len(kept) == 2 and 2 in kept
    assert C.dedup_contacts(df.limit(0), []).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 20)), min_size=1, max_size=20))
def test_coverage_integral(spark, frags):
    df = spark.createDataFrame([("c", s, s + n) for s, n in frags], "chrom string, s long, e long")
    got = I.coverage(df, ["chrom"], "s", "e", tile=8).collect()
    assert sum((r["end"] - r["start"]) * r["depth"] for r in got) == sum(n for _, n in frags)
    dense = {p: sum(s <= p < s + n for s, n in frags) for p in range(90)}
    assert {p: r["depth"] for r in got for p in range(r["start"], r["end"])} == {p: d for p, d in dense.items() if d}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(1, 30)), max_size=12), st.lists(st.tuples(st.integers(0, 50), st.integers(1, 30)), max_size=12))
def test_overlap_join_is_complete(spark, a, b):
    x = spark.createDataFrame([(n, "c", s, s + k) for n, (s, k) in enumerate(a)], "i int, ac string, a0 long, a1 long")
    y = spark.createDataFrame([(n, "c", s, s + k) for n, (s, k) in enumerate(b)], "j int, bc string, b0 long, b1 long")
    got = sorted((r["i"], r["j"]) for r in I.overlap_join(x, y, ("ac", "a0", "a1"), ("bc", "b0", "b1"), 7).collect())
    assert got == sorted((i, j) for i, (s, k) in enumerate(a) for j, (t, m) in enumerate(b) if s < t + m and t < s + k)


def test_bh_is_monotone_and_drops_nulls(spark):
    df = spark.createDataFrame([("c", 0.01), ("c", 0.02), ("c", 0.02), ("c", 0.9), ("c", None)], "chrom string, pval double")
    got = sorted((r["pval"], r["fdr"]) for r in M.bh_fdr(df, ["chrom"]).collect())
    assert len(got) == 4 and all(q >= p for p, q in got) and [q for _, q in got] == sorted(q for _, q in got)
    assert got[0][1] == pytest.approx(0.08 / 3)


def test_regions_gap(spark):
    rows = [("c", 100, True), ("c", 351, True), ("c", 400, False), ("c", 603, True), ("c", 2000, False)]
    df = spark.createDataFrame([(c, p, n, s, 0.5, 0.1, 1.0) for n, (c, p, s) in enumerate(rows)], "chrom string, pos long, idx long, sig boolean, mu1 double, mu2 double, stat double")
    got = sorted((r["start"], r["end"], r["n_sig"], r["total_dml"]) for r in M.regions(df).collect())
    assert got == [(100, 352, 2, 2), (603, 604, 1, 1)]
    assert M.regions(df.where("not sig")).count() == 0


def test_nome_context_counts(spark):
    df = spark.createDataFrame([("s", "GCC", 1, 2), ("s", "ACG", 3, 4), ("s", "ACCC"[:3], 5, 6), ("s", "ACN", 9, 9)], "sample string, context string, mc int, cov int")
    r = S.context_counts(df, ["sample"], c_pos=1).first()
    assert (r["GmCHmC"], r["HmCGmC"], r["HmCHCov"]) == (1, 3, 6)


def test_fastq_names(spark):
    f = D.parse_fastq_name(F.col("s"), "V1")
    assert one(spark, f["uid"], s="/d/x-P1-P2-A1_S1_L001_R1_001.fastq.gz") == "P1-P2-A1"
    for bad in ("x-P1-P2-I1_S1_L001_R1_001.fastq.gz", "x-P1-P2-A13_S1_L001_R1_001.fastq.gz", "x-P1-P2-A1_S1_L005_R1_001.fastq.gz", "x-P1-P2-A1_S1_L001_R3_001.fastq.gz", "x-P1-P1-A1_S1_L001_R1_001.fastq.gz"):
        assert one(spark, f["valid"], s=bad) is False
    assert one(spark, D.parse_fastq_name(F.col("s"), "V2")["uid"], s="/d/x-PL-3-D11_S1_L002_R2_001.fastq.gz") == "PL-3-D11"


def test_plate_info():
    text = "[CriticalInfo]\nn_random_index=8\ninput_plate_size=384\npool_id=P-1\ntube_label=t\nemail=a@b.c\n[LibraryInfo]\nlib=x\n[PlateInfo]\nplate_id primer_quarter\nA Set1_Q1\nB Set1_Q2\n"
    info, plates = reports.plate_info(text)
    assert info["pool_id"] == "P_1" and info["email"] == "a@b.c" and [p["plate_id"] for p in plates] == ["A", "B"]
    assert plates[0]["sample_id_prefix"] == "x" and plates[0]["lib"] == "x" and plates[0]["tube_label"] == "t"
    v2 = text.replace("=8", "=384").replace("plate_id primer_quarter\nA Set1_Q1\nB Set1_Q2", "plate_id multiplex_group primer_name note\nA 1 B1 n1\nA 2 B1 n2\nA 3 B2 n3")
    assert [(p["multiplex_group"], p["sample_id_prefix"]) for p in reports.plate_info(v2)[1]] == [("1", "x-n1"), ("3", "x-n3")]
    for bad in (text.replace("lib=x", "pool_id=y"), text.replace("B Set", "A Set"), text.replace("email=a@b.c\n", ""), text.replace("[LibraryInfo]\n", "")):
        with pytest.raises(ValueError):
            reports.plate_info(bad)


def lines(spark, **files):
    return spark.createDataFrame([(c.replace("_", "-"), n, x) for c, t in files.items() for n, x in enumerate(t.split("\n"))], "cell_id string, nr int, line string").repartition(3)


def test_alignment_summary(spark):
    text = "HISAT2 summary stats:\n\tTotal pairs: 100\n\t\tAligned concordantly 1 time: 40 (40.00%)\n\t\tAligned concordantly >1 times: 5 (5%)\n\tTotal unpaired reads: 50\n\t\tAligned 1 time: 5 (10%)"
    r = {x["cell_id"]: x for x in reports.paired_summary(lines(spark, a=text, b="nothing")).collect()}
    assert (r["a"]["UniqueMappedReads"], r["a"]["UniqueMappingRate"], r["a"]["MultiMappedReads"]) == (85, 34, 10)
    assert r["b"]["UniqueMappingRate"] == 0


def test_duplicate_metrics(spark):
    text = "## METRICS\nLIBRARY\tUNPAIRED_READS_EXAMINED\tREAD_PAIRS_EXAMINED\tUNPAIRED_READ_DUPLICATES\tREAD_PAIR_DUPLICATES\nlib\t10\t20\t2\t5\n\n## HISTOGRAM\tx\nBIN\tVALUE\n1.0\t1.2\n2.0\t1.3"
    r = {x["cell_id"]: x for x in reports.duplicate_metrics(lines(spark, a=text, b="# empty")).collect()}
    assert (r["a"]["FinalReads"], r["a"]["DuplicatedReads"], r["a"]["PCRDuplicationRate"]) == (38, 12, 24)
    assert r["b"]["FinalReads"] is None


def test_other_reports(spark):
    r = reports.feature_summary(lines(spark, a="Status\tx\nAssigned\t30\nUnassigned_A\t50\nUnassigned_B\t20")).first()
    assert (r["Assigned"], r["Unassigned_Total"], r["AssignedRNAReadsRate"]) == (30, 70, 29)
    p = reports.read_profile(lines(spark, a="#mode=dna\n#mc_rate_max_threshold=0.5\n#cov_min_threshold=3\nmc_frac,cov,count\n50,3,4\n51,3,5\n10,2,6")).first()
    assert p["FinalReads"] == 4
    assert reports.barcode_fasta(">A1\n^ACGT\n>A2\n^TTTT\n") == [("A1", "ACGT"), ("A2", "TTTT")]
    assert reports.flat_ini("[a]\nx=1\n[b]\nx=2\ny=3\n") == {"x": "2", "y": "3"}


def test_reports_by_name(spark, tmp_path):
    (tmp_path / "c1.txt").write_text("Status\tx\nAssigned\t3\nUnassigned_A\t1\n")
    assert reports.parse_reports(spark, str(tmp_path), "feature_summary").first()["Assigned"] == 3
    assert reports.parse_reports(spark, str(tmp_path), lambda d: d.where("nr = 1")).first()["line"] == "Assigned\t3"
    with pytest.raises(ValueError):
        reports.parse_reports(spark, str(tmp_path), "nothing")


def test_formats(spark, tmp_path):
    (tmp_path / "c1.fq").write_text("@r1 x\nACGT\n+\nIIII\n@r2\nGG\n+\nII\n")
    assert [tuple(r)[:3] for r in formats.read_fastq(spark, str(tmp_path / "c1.fq")).collect()] == [("r1", "ACGT", "IIII"), ("r2", "GG", "II")]
    (tmp_path / "a.sam").write_text("@HD\tx\nq\t16\tchr1\t101\t60\t3M1D2M1S\t*\t0\t0\tACGTAC\tIIIIII\tYZ:A:+\tAS:i:-3\n")
    r = formats.read_sam(spark, str(tmp_path / "a.sam")).first()
    assert (r["pos"], r["end"], r["yz"], r["as_score"], r["qlen"]) == (100, 106, "+", -3, 6)
    sites = spark.createDataFrame([("chr1", p, "+", "CGA", 1, 2) for p in range(100)] + [("chr2", 5, "+", "CGA", 1, 2)], "chrom string, pos long, strand string, context string, mc int, cov int")
    formats.write_sites(sites, str(tmp_path / "sites"), 2)
    assert formats.fetch_region(spark, str(tmp_path / "sites"), "chr1", 10, 20).count() == 10


@pytest.mark.parametrize("size", ["64m", "1k", "300", "90"])
def test_fastq_of_split_files(spark, tmp_path, size):
    rng = np.random.default_rng(1)
    want = []
    for name in ("a.fq", "b.fq"):
        records = [(f"r{name[0]}{n}", "".join(rng.choice(list("ACGT"), k)), "".join(rng.choice(list("@I+F"), k))) for n, k in enumerate(rng.integers(1, 60, 150).tolist())]
        (tmp_path / name).write_text("".join(f"@{r} x y\n{s}\n+\n{q}\n" for r, s, q in records))
        want += records
    keys = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = formats.read_fastq(spark, str(tmp_path))
        assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(want)
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_summaries(spark):
    df = spark.createDataFrame([("a", 10, 4, 5)], "cell_id string, R1InputReads int, R1FinalBismarkReads int, R2FinalBismarkReads int")
    assert Y.mc_columns(df).first()["FinalmCReads"] == 9
    assert Y.renamed(df, {"cell_id": "", "R1InputReads": "n", "R1FinalBismarkReads": "DELETE"}).columns == ["cell_id", "n", "R2FinalBismarkReads"]
    m = spark.createDataFrame([("a", 8, 6, 10, 10, 8, 6, 10, 10, 1, 2, 3)], "cell_id string, R1UniqueMappedReads int, R1DeduppedReads int, R1TrimmedReads int, R1InputReads int, R2UniqueMappedReads int, R2DeduppedReads int, R2TrimmedReads int, R2InputReads int, CisShortContact int, CisLongContact int, TransContact int")
    r = Y.m3c_columns(m).first()
    assert (r["R1MappingRate"], r["R1DuplicationRate"], r["TotalContacts"], r["TransRatio"]) == (80.0, 25.0, 6, 0.5)


def test_streaming_matches_batch(spark, tmp_path):
    from methylspark.streaming.cells import windowed_counts

    df = spark.createDataFrame([(1, "x", 1.0), (3700, "x", 2.0), (10, "y", 3.0)], "s long, event_type string, value double").select(F.timestamp_seconds("s").alias("ts"), "event_type", "value")
    df.write.parquet(str(tmp_path / "in"))
    q = windowed_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, windowed_counts(df).collect()))


def test_bisulfite_and_trim_reports(spark):
    r = {x["cell_id"]: x for x in reports.bisulfite_report(lines(spark, a="Sequences analysed in total:\t120\nMapping efficiency:\t45.0% \na:b:c", b="x")).collect()}
    assert (r["a"]["TotalReads"], r["a"]["MappingRate"], r["a"]["OT"]) == ("120", "45.0%", None) and "b" not in r
    two = "status\tin_reads\tin_bp\ttoo_short\ttoo_long\ttoo_many_n\tout_reads\tw/adapters\tqualtrim_bp\tout_bp\nOK\t1490\t213724\t0\t0\t0\t1490\t4\t0\t213712\nstatus\tin_reads\tin_bp\ttoo_short\ttoo_long\ttoo_many_n\tout_reads\tw/adapters\tqualtrim_bp\tout_bp\nOK\t1490\t213712\t0\t0\t0\t1482\t0\t1300\t182546"
    t = reports.trim_stats(lines(spark, a_b_R1=two, a_b_R2=two.replace("1482", "9"))).where("read_type = 'R1'").first()
    assert tuple(t)[:8] == ("a-b", "R1", 1490, 213724, 4, 1300, 1482, 182546) and t["TrimmedReadsRate"] == 1482 / 1490
    wide = reports.by_read_type(reports.trim_stats(lines(spark, a_b_R1=two, a_b_R2=two.replace("1482", "9")))).first()
    assert (wide["R1TrimmedReads"], wide["R2TrimmedReads"]) == (1482, 9)
    several = "=== Summary ===\n\nTotal reads processed:   1,490\n\n=== Adapter Tn5 ===\n\nSequence: ACGT; Type: regular 3'; Length: 4; Trimmed: 12 times\n\n=== Adapter polyA ===\n\nSequence: AAA; Type: x; Length: 3; Trimmed: 7 times\nstatus\tout_reads\tqualtrim_bp\tout_bp\nOK\t1400\t30\t999\n"
    total, adapters = reports.adapter_stats(lines(spark, c_R2=several))
    assert tuple(total.first())[:6] == ("c", "R2", 1490, 30, 1400, 999) and sorted((r["adapter"], r["trimmed"]) for r in adapters.collect()) == [("Tn5", 12), ("polyA", 7)]
    text = "# x\nLIBRARY\tUNPAIRED_READS_EXAMINED\tUNPAIRED_READ_DUPLICATES\tPERCENT_DUPLICATION\nlib\t10\t4\t0.4\n\nBIN\tV\n1\t2"
    got = sorted(map(tuple, reports.read_duplicate_metrics(lines(spark, a_R1=text, a_R2="# empty")).collect()))
    assert got == [("a", "R1", 10, 4, 0.4, 6), ("a", "R2", 0, 0, 0.0, 0)]
    t = {x["metric"]: x["value"] for x in reports.trim_table(lines(spark, a="status\tin_reads\tout_reads\nOK\t10\t8")).collect()}
    assert t == {"in_reads": 10, "out_reads": 8}


def test_fixed_width(spark):
    head = "JOBID  STATE     TIME"
    got = reports.fixed_width(lines(spark, q=f"{head}\n------ --------- ----\n12     RUNNING   1:00\n13     DONE      2:00"), head, ["JOBID", "STATE", "TIME"]).collect()
    assert sorted(tuple(r) for r in got) == [("12", "RUNNING", "1:00"), ("13", "DONE", "2:00")]


def test_configuration(tmp_path):
    assert reports.mapping_config(["[a]\nx=1\n", "[b]\nx=2\n"], [{"y": 3}]) == {"x": "2", "y": "3"}
    assert reports.typed_config("m3c", {"min_gap": "100"})["min_gap"] == 100
    with pytest.raises(ValueError):
        reports.typed_config("nope", {})
    full = {"barcode_version": "V2", "hisat3n_dna_reference": "/g", "hisat3n_rna_reference": "/r", "reference_fasta": "/f", "chrom_size_path": "/c", "gtf_path": "/t", "unmapped_fastq": "true"}
    four = reports.typed_config("4m", full, strict=True)
    assert (four["nome_flag_str"], four["unmapped_fastq"], four["min_gap"]) == ("--nome", True, 2500) and "star_reference" not in four
    with pytest.raises(ValueError):
        reports.typed_config("4m", full | {"mapq_threshold": "x"})
    with pytest.raises(ValueError):
        reports.typed_config("mc", {}, strict=True)
    (tmp_path / "run").mkdir()
    assert reports.find_config(str(tmp_path / "run")) == {}
    (tmp_path / "config.ini").write_text("[a]\nx=1\n")
    assert reports.find_config(str(tmp_path / "run")) == {"x": "1"}
    (tmp_path / "run" / "mapping_config.yml").write_text("# c\nx: '2' \nhardware:\n  y: 3 # more\n")
    assert reports.find_config(str(tmp_path / "run")) == {"x": "2", "y": "3"}
    assert reports.sample_sheet_text("[Data]", [{"Lane": "1", "Sample_ID": "a"}]) == "[Data]\nLane,Sample_ID\n1,a\n"


def test_fastq_catalog(spark):
    good = ["/d/x-P1-P2-A1_S1_L001_R1_001.fastq.gz", "/d/x-P1-P2-A1_S1_L001_R2_001.fastq.gz"]
    assert D.fastq_catalog(spark, good, "V1").count() == 2
    for bad in ([*good, good[0]], ["/d/x-P1-P2-Z1_S1_L001_R1_001.fastq.gz"]):
        with pytest.raises(ValueError):
            D.fastq_catalog(spark, bad, "V1")


def test_job_durations(spark):
    df = spark.createDataFrame([("10:00:00-12/31/24", "10:00:30-12/31/24", 0), ("23:59:50-12/31/24", "00:00:20-01/01/25", 0)], "start string, end string, return_code int")
    assert tuple(Y.durations(df).first()) == (0, 2, 30, 30.0, 30)


def test_legacy_percent(spark):
    df = spark.createDataFrame([("r1-l", 0, 10), ("r1-r", 1, 10), ("r2", 0, 10)], "read_name string, mc long, cov long")
    assert {r["read_name"] for r in R.select_parents(df, "dna").collect()} == {"r1-l", "r1-r", "r2"}
    assert {r["read_name"] for r in R.select_parents(df, "dna", legacy_percent=True).collect()} == {"r2"}


def test_imputed_matrix_is_symmetric_and_local(spark):
    m = spark.createDataFrame([("c", "chr1", 0, 1, 5), ("c", "chr1", 3, 4, 2)], "cell_id string, chrom string, bin1 long, bin2 long, n long")
    got = {(r["bin1"], r["bin2"]): r["value"] for r in C.impute(m, 8).collect()}
    assert all(i <= j for i, j in got) and got[0, 1] > got.get((0, 4), 0)
    assert C.impute(m.limit(0), 8).count() == 0


def dense_imputed(cells, n, restart=0.5, tol=0.01):
    m = np.zeros((n, n))
    for i, j, c in cells:
        m[i, j] = m[j, i] = c
    wide = np.pad(m, 1)
    m = sum(wide[i : i + n, j : j + n] for i in range(3) for j in range(3)) / 9
    np.fill_diagonal(m, 1)
    p, q, change = m / m.sum(axis=1, keepdims=True), np.eye(n), tol
    while change >= tol:
        new = restart * q @ p + (1 - restart) * np.eye(n)
        change, q = np.abs(new - q).sum(), new
    q = q + q.T
    d = np.sqrt(q.sum(axis=1))
    q = q / d[:, None] / d[None, :]
    return {(i, j): q[i, j] for i in range(n) for j in range(i, n) if q[i, j] > 1e-5}


def test_imputation_leaves_out_no_bin(spark):
    cells = [(0, 1, 5), (3, 4, 2), (2, 17, 3), (18, 21, 4), (22, 22, 1), (20, 22, 7)]
    m = spark.createDataFrame([("c", "chr1", *c) for c in cells] + [(None, "chr2", 0, 9, 1)], "cell_id string, chrom string, bin1 long, bin2 long, n long")
    for bins in (8, 22, 256):  # rows at a time: they don't change the result
        got = C.impute(m, bins).collect()
        for cell, want in (("c", dense_imputed(cells, 23)), (None, dense_imputed([(0, 9, 1)], 10))):
            one = {(r["bin1"], r["bin2"]): r["value"] for r in got if r["cell_id"] == cell}
            assert one.keys() == want.keys() and all(one[k] == pytest.approx(v, abs=1e-9) for k, v in want.items())


def test_embedding_keeps_every_bin_pair_apart(spark):
    rng = np.random.default_rng(5)
    for cells, dims in ((7, 3), (40, 2)):  # all cells in one step, and by subspace steps
        x = rng.poisson(1.0, (cells, 600)) + np.outer(rng.poisson(9.0, cells), np.arange(600) % 7 == 0) + np.outer(rng.poisson(4.0, cells), np.arange(600) % 5 == 0)
        m = spark.createDataFrame([(f"c{i}", "chr1", j, j + 9, int(x[i, j])) for i, j in np.argwhere(x).tolist()], "cell_id string, chrom string, bin1 long, bin2 long, n long")
        got = {r["cell_id"]: r["embedding"] for r in C.embed(m, dims).collect()}
        v = np.log1p(x)
        axes = np.linalg.svd(v - v.mean(axis=0), full_matrices=False)[2][:dims]
        assert np.allclose(np.abs([got[f"c{i}"] for i in range(cells)]), np.abs(v @ axes.T), atol=1e-4)
    assert C.embed(m.limit(0), 2).count() == 0


@pytest.mark.parametrize("nome", [False, True])
def test_both_forms_of_read_methylation_agree(spark, nome):
    rows = [(1, "CT", [1, 2, 3, 5, 6], list("CCAGC"), list("CTAGA")), (2, "GA", [1, 2, 3, 4], list("AGGT"), list("AGAT")), (3, "CT", [], [], [])]
    df = spark.createDataFrame(rows, "read_id long, conv string, ref_pos array<int>, ref array<string>, base array<string>")
    flat = df.select("read_id", "conv", F.inline(F.arrays_zip("ref_pos", "ref", "base")))
    text = df.select("read_id", "conv", R.aligned_pairs(F.col("ref_pos"), F.col("ref"), F.col("base")).alias("pairs"))
    one = {r["read_id"]: tuple(r) for r in R.read_methylation_strings(text, nome).collect()}
    two = {r["read_id"]: tuple(r) for r in R.read_methylation(flat, nome).collect()}
    assert one.pop(3) == (3, 0, 0, 0, 0.0) and one == two


def test_cell_fastqs(spark, tmp_path):
    names = ["/d/a-b-R1.fq.gz", "/d/a-b_r2.fastq", "/d/c-R1.fastq", "/d/c-R1.trimmed.fq.gz", "/d/c.bam"]
    files = D.cell_fastqs(spark.createDataFrame([(n,) for n in names], "path string"))
    assert [tuple(r) for r in D.pair_reads(files).orderBy("cell_id").collect()] == [("a-b", names[0], names[1]), ("c", names[2], None)]
    with pytest.raises(ValueError):
        D.checked_pairs(files)
    assert D.checked_pairs(files.where("cell_id = 'a-b'")).count() == 1
    for bad in (files.limit(0), files.unionByName(files.where("read_type = 'R2'"))):
        with pytest.raises(ValueError):
            D.checked_pairs(bad)
    for n in ("x-P1-P2-A1_S1_L001_R1_001.fastq.gz", "x-P1-P2-A1_S1_L001_R2_001.fastq.gz"):
        (tmp_path / n).write_text("")
    (tmp_path / "list.txt").write_text(f"{tmp_path}/x-P1-P2-A1_S1_L001_R1_001.fastq.gz\n\n")
    assert D.fastq_catalog(spark, f"{tmp_path}/*.fastq.gz", "V1").count() == 2
    assert D.fastq_catalog(spark, f"{tmp_path}/list.txt", "V1").count() == 1
    with pytest.raises(ValueError):
        D.fastq_catalog(spark, f"{tmp_path}/*.nothing", "V1")


def test_sample_sheets(spark):
    plates = spark.createDataFrame([(0, "P 1", "lib", "t", "e", "Q1"), (1, "P2", "lib", "t", "e", "Q1"), (2, "P3", "lib", "t", "e", "Q2")], "nr int, plate_id string, sample_id_prefix string, tube_label string, email string, primer_quarter string")
    primers = spark.createDataFrame([(q, f"{r}{c}", "AACG", "TTGA") for q in ("Q1", "Q2") for r in "ABCDEFGH" for c in range(1, 13)], "primer_quarter string, plate_pos string, i7 string, i5 string")
    sheets = D.sample_sheets(plates, primers, "V1")
    assert {k: v.count() for k, v in sheets.items()} == {"miseq": 192, "novaseq.v1": 768, "novaseq.V1.5": 768}
    assert sheets["miseq"].columns == list(D.SHEET) and sheets["novaseq.V1.5"].first()["index2"] == "TCAA"
    ids = {r["Sample_ID"] for r in sheets["miseq"].collect()}
    assert {"lib-P_1-P2-A1", "lib-P3-GHOST_PLATE-H12"} <= ids
    for bad in (plates.unionByName(plates.where("nr = 0")), plates.withColumn("primer_quarter", F.lit("Q9"))):
        with pytest.raises(ValueError):
            D.sample_sheets(bad, primers, "V1")


def test_pairs_of_alignments(spark):
    rows = [("ACGTT", "5M", "2A2"), ("GGACTT", "2S2M3D2M", "1A0^CCC2"), ("ACGT", "2M1I1M", "3"), ("ACGT", "2M5N2M", "4"), ("ACGT", "5M", "4"), (None, "4M", "4"), ("ACGT", "4M", "3")]
    df = spark.createDataFrame(rows, "seq string, cigar string, md string")
    got = [r["p"] for r in df.select(R.pairs_of_alignments(F.col("seq"), F.col("cigar"), F.col("md")).alias("p")).collect()]
    assert got == ["AaCcAgTtTt", "AaAc--TtTt", "AaCcTt", "AaCc--GgTt", None, None, None]


def test_spliced_methylation_skips_unknown_neighbours(spark):
    df = spark.createDataFrame([(1, True, "CcAaGgCcCt"), (2, False, "AgGgTtGaCc"), (3, True, "Cc"), (4, True, "")], "read_id long, reverse boolean, pairs string")
    plain = {r["read_id"]: tuple(r)[1:4] for r in R.spliced_methylation(df).collect()}
    assert plain == {1: (2, 2, 0), 2: (1, 2, 0), 3: (0, 0, 0), 4: (0, 0, 0)}
    nome = {r["read_id"]: tuple(r)[1:4] for r in R.spliced_methylation(df, True).collect()}
    assert nome == {1: (0, 0, 0), 2: (1, 1, 0), 3: (0, 0, 0), 4: (0, 0, 0)}


def test_unknown_conversion_tag_raises(spark):
    assert one(spark, R.conversion(F.col("t"), F.lit(True)), t="+") == "CT"
    with pytest.raises(Exception, match="unknown conversion tag"):
        one(spark, R.conversion(F.col("t"), F.lit(True)), t="x")


def test_trim_pairs(spark):
    body = "TTGACCATTGCA" * 4
    df = spark.createDataFrame([(body + "AGATCGGAAGAGCACACG", "I" * 66, "A" * 20, "I" * 20), ("AC", "II", "AC", "II"), (body, "I" * 40 + "!" * 8, body + "AGATCG", "I" * 54)], "seq1 string, qual1 string, seq2 string, qual2 string")
    got = [tuple(r) for r in R.trim_pairs(df, left=5, right=5).collect()]
    assert [(len(r[0]), len(r[2])) for r in got] == [(38, 10), (30, 38)] and all(len(r[0]) == len(r[1]) and len(r[2]) == len(r[3]) for r in got)
    assert got[0][0] == body[5:-5]


def test_pair_aware_duplicates(spark):
    rows = [(1, 5, 9, 10), (2, 5, 9, 20), (3, 5, 8, 1), (4, 5, None, 99), (5, 7, None, 1), (6, 7, None, 2)]
    df = spark.createDataFrame(rows, "id int, pos int, mate int, score int")
    assert sorted(r["id"] for r in S.remove_duplicates(df, ["pos"], "score", "id", ["mate"]).collect()) == [2, 3, 6]


@pytest.mark.parametrize("tile", [4, 1 << 20])
def test_running_steps_in_tiles(spark, tile):
    rng = np.random.default_rng(7)
    rows = [(c, int(p), int(p) + int(n)) for c in "ab" for p, n in zip(np.sort(rng.choice(400, 60, replace=False)), rng.integers(1, 9, 60))]
    df = spark.createDataFrame(rows, "chrom string, s long, e long")
    got = {(r["chrom"], r["s"]): r["island"] for r in I.islands(df, ["chrom"], "s", "e", 3, tile).collect()}
    for c in "ab":
        far, n = None, 0
        for _, s, e in (r for r in rows if r[0] == c):
            n += far is None or s - far > 3
            far = max(far or e, e)
            assert got[c, s] == n
    sites = spark.createDataFrame([(c, s, bool(rng.integers(2)), 0.5, 0.1, 1.0) for c, s, _ in rows], "chrom string, pos long, sig boolean, mu1 double, mu2 double, stat double")
    known = M.indexed(sites, tile)
    assert all([r["idx"] for r in known.where(F.col("chrom") == c).orderBy("pos").collect()] == list(range(60)) for c in "ab")
    out = sorted((r["chrom"], r["start"], r["end"], r["n_sig"], r["total_dml"]) for r in M.regions(known, 6, tile).collect())
    want = []
    for c in "ab":
        here = [(r["pos"], r["sig"]) for r in known.where(F.col("chrom") == c).orderBy("pos").collect()]
        hits, groups = [p for p, sig in here if sig], []
        for p in hits:
            if groups and p - (groups[-1][-1] + 1) <= 6:
                groups[-1].append(p)
            else:
                groups.append([p])
        want += [(c, g[0], g[-1] + 1, len(g), sum(g[0] <= p <= g[-1] for p, _ in here)) for g in groups]
    assert out == sorted(want)


def test_fdr_over_many_ranges(spark):
    rng = np.random.default_rng(9)
    p = np.concatenate([rng.uniform(0, 1, 300), 10.0 ** rng.uniform(-320, 0, 200), np.repeat([0.0, 1e-5, 0.25, 1.0], 5)])
    got = sorted((r["pval"], r["fdr"]) for r in M.bh_fdr(spark.createDataFrame([(float(x),) for x in p], "pval double"), []).collect())
    s = np.sort(p)
    want = np.minimum(np.minimum.accumulate((s * len(s) / np.arange(1, len(s) + 1))[::-1])[::-1], 1)
    want = np.array([want[np.searchsorted(s, x)] for x in s])
    assert np.allclose([q for _, q in got], want, rtol=1e-12, atol=0)


def test_tables_and_paths(spark, tmp_path):
    formats.write_tables({"a": spark.range(3), "b": None}, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t" / "a")).count() == 3 and not (tmp_path / "t" / "b").exists()
    (tmp_path / "x.allc.tsv").write_text("chr1\t5\n")
    assert formats.allc_paths(spark, str(tmp_path / "*.tsv")).first()["cell_id"] == "x"
    df = spark.createDataFrame([("c2", 1), ("c1", 9), ("c1", 3)], "chrom string, pos long")
    assert [tuple(r) for r in formats.coordinate_sorted(df, 2).collect()] == [("c1", 3), ("c1", 9), ("c2", 1)]
