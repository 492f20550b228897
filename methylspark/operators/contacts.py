"""Chromatin contacts: overlap resolution of read parts, contact types, duplicates, formats, matrices."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from methylspark.operators.intervals import outside
from methylspark.operators.reads import qname_fields

KINDS = ("cis", "ciscut", "cis_multi", "ciscut_multi", "trans", "transcut", "trans_multi", "transcut_multi", "chimeric", "no")
#: Of several types between two groups the first of these counts; a chimeric relation is no contact.
PRIORITY = ("ciscut", "transcut", "chimeric", "cis", "trans")
#: Order of the eight parts of a pair in the split table.
SLOTS = ("1", "1-1", "1-3", "1-2", "2-2", "2-3", "2-1", "2")


def best_parts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of overlapping parts of a read the best ones: highest ref_len + as_score first (the later in a tie), then any that
    doesn't overlap those already taken. df: keys, seq, ss, se, ref_len, as_score; the rows that stay are returned.

    A fold over each read's parts, best first, in one expression; parts of a read are few.
    """
    part = F.struct((F.col("ref_len") + F.col("as_score")).alias("score"), F.col("seq").alias("seq"), F.col("ss").alias("ss"), F.col("se").alias("se"))
    ranked = F.reverse(F.array_sort(F.collect_list(part)))
    empty = F.array().cast("array<struct<score: bigint, seq: bigint, ss: bigint, se: bigint>>")
    taken = F.aggregate(
        "parts", empty, lambda acc, p: F.when(F.exists(acc, lambda q: ~((p["ss"] >= q["se"]) | (p["se"] <= q["ss"]))), acc).otherwise(F.array_append(acc, p))
    )
    kept = df.groupBy(*keys).agg(ranked.alias("parts")).select(*keys, F.explode(F.transform(taken, lambda p: p["seq"])).alias("seq"))
    return df.join(kept, [*keys, "seq"], "left_semi")


def remove_overlapping_parts(df: DataFrame, keys: list[str], illumina: bool = True) -> DataFrame:
    """From alignments of split reads to the parts that stay: names are taken apart into read_name, st, ss and se, of
    overlapping parts of a read the best stay, and the mate bits of the flags go. df: keys, seq, qname, flag, qlen, ref_len, as_score."""
    d = qname_fields(df.drop("ss", "se", "st", "read_name"), illumina=illumina)
    kept = best_parts(d, [*keys, "read_name", "st"])
    return kept.withColumn("flag", F.col("flag") - F.col("flag").bitwiseAND(64 | 128))


def sorted_contacts(df: DataFrame) -> DataFrame:
    return df.orderBy("chrom1", "chrom2", "start1", "start2", "end1", "end2")


_END = ("chrom", "pos_start", "pos_end", "strand", "ss", "se", "read_type")


def _fragments(parts: Column, span: int) -> Column:
    """For each part the number of its fragment, from 0: the first one, in order of their first parts, whose interval comes
    within twice ``span`` of the part's on one chromosome, else a new one. A fragment's interval grows with each part.

    A fold in one expression over the bounds found so far; bounds are widened by ``span`` on both sides.
    """
    own = lambda p: F.struct(p["chrom"].alias("chrom"), (p["pos_start"] - span).alias("lo"), (p["pos_end"] + span).alias("hi"))
    empty = F.struct(F.array().cast("array<struct<chrom: string, lo: bigint, hi: bigint>>").alias("bounds"), F.array().cast("array<int>").alias("of"))

    def place(state: Column, p: Column) -> Column:
        bounds, mine = state["bounds"], own(p)
        near = F.transform(bounds, lambda f: F.coalesce((f["chrom"] == mine["chrom"]) & (f["lo"] < mine["hi"]) & (mine["lo"] < f["hi"]), F.lit(False)))
        at = F.array_position(near, F.lit(True)).cast("int") - 1  # -1: none is near
        grown = F.transform(
            bounds, lambda f, n: F.when(n == at, F.struct(f["chrom"].alias("chrom"), F.least(f["lo"], mine["lo"]).alias("lo"), F.greatest(f["hi"], mine["hi"]).alias("hi"))).otherwise(f)
        )
        return F.struct(
            F.when(at < 0, F.array_append(bounds, mine)).otherwise(grown).alias("bounds"),
            F.array_append(state["of"], F.when(at < 0, F.size(bounds)).otherwise(at)).alias("of"),
        )

    return F.aggregate(parts, empty, place, lambda state: state["of"])


def _rank(a: Column, b: Column, parts: Column, several: Column) -> Column:
    """Place in PRIORITY of what two parts of different fragments are to each other; null: a third part joins them without
    a gap, which counts only where there are more than two fragments (``several``)."""
    cis, same = a["chrom"] == b["chrom"], a["read_type"] == b["read_type"]
    cut = (a["se"] == b["ss"]) | (b["se"] == a["ss"])
    joins = lambda p: (p["read_type"] == a["read_type"]) & (((p["ss"] == a["se"]) & (p["se"] == b["ss"])) | ((p["ss"] == b["se"]) & (p["se"] == a["ss"])))
    rank = {k: F.lit(n) for n, k in enumerate(PRIORITY)}
    return (
        F.when(~same, F.when(cis, rank["cis"]).otherwise(rank["trans"]))
        .when(cut, F.when(cis, rank["ciscut"]).otherwise(rank["transcut"]))
        .when(~(several & F.exists(parts, joins)), rank["chimeric"])
    )


def call_contacts(df: DataFrame, keys: list[str], span: int = 2500) -> DataFrame:
    """One row per outcome: keys, contact_type, and chrom, start, end, strand, read_start, read_end, read_type of both ends.

    df: keys (a read pair), seq, chrom, pos_start, pos_end, strand, ss, se, read_type. Parts form fragments (``_fragments``);
    every two fragments have one outcome, that of their parts which comes first in PRIORITY, shown by the last such two parts;
    with more than two fragments it is ``_multi``. A pair with one fragment is one row ``no``, a chimeric outcome a row
    without ends. All in DataFrame functions: a pair's parts, which are few, are gathered in one row, the only shuffle.
    """
    d = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("seq", *_END))).alias("__p"))
    # One column a step: an expression inside a lambda would be computed again for every element.
    d = d.withColumn("__of", F.when(F.size("__p") > 1, _fragments(F.col("__p"), span)).otherwise(F.array(F.lit(0))))
    d = d.withColumn("__n", F.array_max("__of") + 1)
    p, of, several = F.col("__p"), F.col("__of"), F.col("__n") > 2
    at = F.sequence(F.lit(0), F.size("__p") - 1)

    def meet(i: Column) -> Column:
        others = F.filter(at, lambda j: F.get(of, i) < F.get(of, j))
        return F.transform(others, lambda j: F.struct(
            F.get(of, i).alias("g"), F.get(of, j).alias("h"), _rank(F.get(p, i), F.get(p, j), p, several).alias("rank"), (-i).alias("i"), (-j).alias("j"),
        ))

    met = F.when(F.col("__n") > 1, F.array_sort(F.filter(F.flatten(F.transform(at, meet)), lambda m: m["rank"].isNotNull())))
    d = d.withColumn("__met", met)
    before = lambda n: F.get("__met", n - 1)
    first = F.filter("__met", lambda m, n: (n == 0) | (before(n)["g"] != m["g"]) | (before(n)["h"] != m["h"]))
    name = F.array(*map(F.lit, PRIORITY))
    chimeric = PRIORITY.index("chimeric")

    def outcome(m: Column) -> Column:
        kind = F.when(m["rank"] == chimeric, "chimeric").otherwise(F.concat(F.get(name, m["rank"]), F.when(several, "_multi").otherwise("")))
        end = lambda k: F.when(m["rank"] != chimeric, F.get(p, -m[k]))
        return F.struct(kind.alias("contact_type"), end("i").alias("a"), end("j").alias("b"))

    none = F.when(F.lit(False), F.get(p, F.lit(0)))
    no = F.array(F.struct(F.lit("no").alias("contact_type"), none.alias("a"), none.alias("b")))
    out = d.select(*keys, F.inline(F.when(F.col("__n") < 2, no).otherwise(F.transform(first, outcome))))
    flat = {"chrom": "chrom", "start": "pos_start", "end": "pos_end", "strand": "strand", "read_start": "ss", "read_end": "se", "read_type": "read_type"}
    return out.select(*keys, "contact_type", *[F.col(f"{side}.{f}").alias(f"{name}{n}") for n, side in ((1, "a"), (2, "b")) for name, f in flat.items()])


def numbered_pairs(contacts: DataFrame, keys: list[str], pair: str = "pair_id") -> DataFrame:
    """Adds ``read_pair_id``: the pair's ordinal, from 0, in the order of its name within ``keys`` (a cell)."""
    return contacts.withColumn("read_pair_id", (F.dense_rank().over(Window.partitionBy(*keys).orderBy(pair)) - 1).cast("long"))


def contact_counts(contacts: DataFrame, keys: list[str], pair: str = "pair_id") -> DataFrame:
    """Outcomes by type, and mapped_frag, the number of pairs.

    Pairs are summed up first (they are the shuffle key of the calls already), then keys: no distinct over rows.
    """
    by = contacts.groupBy(*keys, pair).agg(*[F.count_if(F.col("contact_type") == k).alias(k) for k in KINDS])
    return by.groupBy(*keys).agg(*[F.sum(k).alias(k) for k in KINDS], F.count(F.lit(1)).alias("mapped_frag"))


def contact_summary(df: DataFrame) -> DataFrame:
    """Totals and ratios over mapped fragments of counts by type."""

    def total(kinds: list[str]) -> Column:
        return sum((F.col(k) for k in kinds[1:]), F.col(kinds[0]))

    out = df.withColumn("TotalCisContacts", total([k for k in KINDS if k.startswith("cis")]))
    out = out.withColumn("TotalTransContacts", total([k for k in KINDS if k.startswith("trans")]))
    out = out.withColumn("TotalMultiContacts", total([k for k in KINDS if k.endswith("_multi")]))
    for k in ("Cis", "Trans", "Multi"):
        out = out.withColumn(f"{k}ContactsRatio", F.col(f"Total{k}Contacts") / (F.col("mapped_frag") + 0.00001))
    return out


def dedup_contacts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Contacts without duplicates: a row goes if at both anchors its start or its end equals the one before it, in the order
    of that anchor within (keys, chrom1, chrom2)."""

    def repeats(n: int, other: int) -> Column:
        w = Window.partitionBy(*keys, "chrom1", "chrom2").orderBy(f"start{n}", f"end{n}", f"start{other}", f"end{other}", "seq")
        same = (F.lag(f"start{n}").over(w) == F.col(f"start{n}")) | (F.lag(f"end{n}").over(w) == F.col(f"end{n}"))
        return F.coalesce(same, F.lit(False))

    return df.withColumn("__d1", repeats(1, 2)).withColumn("__d2", repeats(2, 1)).where("not (__d1 and __d2)").drop("__d1", "__d2")


def duplicate_rate(raw: DataFrame, dedup: DataFrame, keys: list[str]) -> DataFrame:
    a, b = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_raw")), dedup.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_dedup"))
    out = a.join(b, keys, "left").withColumn("n_dedup", F.coalesce("n_dedup", F.lit(0)))
    return out.withColumn("dup_rate", (F.col("n_raw") - F.col("n_dedup")) / (F.col("n_raw") + 0.00001))


def contact_pipeline(parts: DataFrame, keys: list[str], pair: str = "pair_id", span: int = 2500, save_raw: bool = False, save_short: bool = True, drop_last_pair: bool = False) -> dict[str, DataFrame]:
    """From the parts of read pairs to contacts, in one call: ``dedup``, ``stats``, and, if asked for, ``raw`` and ``short``.

    keys: what a table of contacts is for (a cell). raw: contacts with both ends, their pairs numbered; dedup: without
    duplicates; short: see ``short_format``; stats per key: outcomes by type, mapped_frag, dedup_frag, dup_rate.
    ``drop_last_pair`` takes one from mapped_frag, as older pipelines counted.
    """
    called = numbered_pairs(call_contacts(parts, [*keys, pair], span), keys, pair)
    raw = called.where("chrom1 is not null").withColumn("seq", F.struct("read_pair_id", "read_type1", "read_start1", "read_type2", "read_start2"))
    dedup = dedup_contacts(raw, keys).drop("seq")
    raw = raw.drop("seq")
    counts = contact_counts(called, keys, pair)
    if drop_last_pair:
        counts = counts.withColumn("mapped_frag", F.greatest(F.col("mapped_frag") - 1, F.lit(0)))
    frag = dedup.groupBy(*keys).agg(F.count(F.lit(1)).alias("dedup_frag"))
    written = sum((F.col(k) for k in KINDS if k not in ("chimeric", "no")), F.lit(0))
    stats = counts.join(frag, keys, "left").withColumn("dedup_frag", F.coalesce("dedup_frag", F.lit(0)))
    stats = stats.withColumn("dup_rate", (written - F.col("dedup_frag")) / (written + 0.00001))
    return {"dedup": dedup, "stats": stats} | ({"raw": raw} if save_raw else {}) | ({"short": short_format(dedup)} if save_short else {})


def short_format(df: DataFrame) -> DataFrame:
    """Eight columns: strand, chromosome, position, fragment (0 and 1) of both ends."""
    return df.select(
        F.col("strand1").alias("str1"), F.col("chrom1").alias("chr1"), F.col("start1").alias("pos1"), F.lit(0).alias("frag1"),
        F.col("strand2").alias("str2"), F.col("chrom2").alias("chr2"), F.col("start2").alias("pos2"), F.lit(1).alias("frag2"),
    )


def split_table(df: DataFrame) -> DataFrame:
    """The eight slots of each read pair as columns s0 to s7, struct(strand, chrom, pos); the last part of a slot counts.

    df: read_id, seq, slot, flag, chrom, pos (0-based), length. Pairs with one slot go; of pairs with equal slots one stays.
    """
    first = F.substring("slot", 1, 1) == "1"
    forward = (F.col("flag").bitwiseAND(16) != 0) != first
    loc = F.struct(forward.cast("int").alias("strand"), F.col("chrom"), F.when(forward, F.col("pos") + 1).otherwise(F.col("pos") + F.col("length")).alias("pos"))
    d = df.withColumn("__loc", loc)
    wide = d.groupBy("read_id").agg(*[F.max_by(F.when(F.col("slot") == s, F.col("__loc")), F.when(F.col("slot") == s, F.col("seq"))).alias(f"s{n}") for n, s in enumerate(SLOTS)])
    slots = [f"s{n}" for n in range(8)]
    filled = sum((F.col(s).isNotNull().cast("int") for s in slots), F.lit(0))
    return wide.where(filled >= 2).groupBy(*slots).agg(F.min("read_id").alias("read_id"))


def split_contacts(wide: DataFrame, chroms: list[str], min_gap: int = 2500) -> DataFrame:
    """First and last slot of each pair, ordered by chromosome and position: strand1, chrom1, pos1, strand2, chrom2, pos2, kind
    (cis_long, cis_short, trans). Chromosomes not listed go."""
    slots = [f"s{n}" for n in range(8)]
    rank = F.create_map(*[x for n, c in enumerate(chroms) for x in (F.lit(c), F.lit(n))]) if chroms else None
    if rank is None:
        return wide.sparkSession.createDataFrame([], "strand1 int, chrom1 string, pos1 long, strand2 int, chrom2 string, pos2 long, kind string")
    d = wide.select(F.coalesce(*slots).alias("a"), F.coalesce(*slots[::-1]).alias("b"))
    d = d.withColumn("ra", F.element_at(rank, F.col("a.chrom"))).withColumn("rb", F.element_at(rank, F.col("b.chrom"))).where("ra is not null and rb is not null")
    swap = (F.col("ra") > F.col("rb")) | ((F.col("ra") == F.col("rb")) & (F.col("a.pos") > F.col("b.pos")))
    d = d.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"))
    kind = F.when(F.col("a.chrom") != F.col("b.chrom"), "trans").when(F.abs(F.col("a.pos") - F.col("b.pos")) > min_gap, "cis_long").otherwise("cis_short")
    return d.select(*[F.col(f"{s}.{f}").alias(f"{f}{n}") for n, s in ((1, "a"), (2, "b")) for f in ("strand", "chrom", "pos")], kind.alias("kind"))


def generate_contacts(alignments: DataFrame, chroms: list[str], min_gap: int = 2500, keep_split_table: bool = False) -> dict[str, DataFrame]:
    """From slotted alignments (see ``split_table``) to contacts, in one call: ``contacts`` (long-range and trans, in the order
    chrom1, chrom2, strand1, strand2, pos1), ``counts`` (CisShortContact, CisLongContact, TransContact) and, if asked for, ``split``."""
    wide = split_table(alignments)
    found = split_contacts(wide, chroms, min_gap)
    kinds = {"CisShortContact": "cis_short", "CisLongContact": "cis_long", "TransContact": "trans"}
    counts = found.agg(*[F.count_if(F.col("kind") == k).alias(n) for n, k in kinds.items()])
    contacts = found.where("kind <> 'cis_short'").drop("kind").orderBy("chrom1", "chrom2", "strand1", "strand2", "pos1")
    return {"contacts": contacts, "counts": counts} | ({"split": wide} if keep_split_table else {})


def contact_matrix(df: DataFrame, resolution: int, keys: list[str], min_distance: int = 2500) -> DataFrame:
    """Contacts of a chromosome by pair of bins, those nearer than ``min_distance`` left out."""
    d = df.where((F.col("chrom1") == F.col("chrom2")) & (F.abs(F.col("start1") - F.col("start2")) > min_distance))
    a, b = F.floor(F.col("start1") / resolution), F.floor(F.col("start2") / resolution)
    return d.groupBy(*keys, F.col("chrom1").alias("chrom"), F.least(a, b).alias("bin1"), F.greatest(a, b).alias("bin2")).agg(F.count(F.lit(1)).alias("n"))


def filter_contacts(
    df: DataFrame, blacklist: DataFrame | None = None, pairs: DataFrame | None = None, min_distance: int = 2500, resolution: int = 10_000, remove_duplicates: bool = False, width: int = 1 << 16
) -> DataFrame:
    """Contacts fit for a matrix. ``df``: keys such as cell_id, chrom1, start1, chrom2, start2.

    Those with an anchor in an interval of ``blacklist`` (chrom, start, end) go, those whose anchors lie in two bins of
    ``resolution`` that a pair of intervals of ``pairs`` (chrom1, bstart1, bend1, chrom2, bstart2, bend2) covers in either order,
    and those on one chromosome that are not more than ``min_distance`` apart; with ``remove_duplicates`` all but one of those
    with equal anchors in a cell.
    """
    near = (F.col("chrom1") == F.col("chrom2")) & (F.abs(F.col("start1") - F.col("start2")) <= min_distance)
    d = df.where(~near)
    if blacklist is not None:
        b = blacklist.select(F.col("chrom").alias("__chrom"), F.col("start").alias("__start"), F.col("end").alias("__end"))
        for n in (1, 2):
            d = outside(d, b, (f"chrom{n}", f"start{n}"), ("__chrom", "__start", "__end"), width)
    if pairs is not None:
        bins = lambda a, b: F.sequence(F.floor(F.col(a) / resolution), F.floor((F.col(b) - 1) / resolution))
        p = pairs.select(F.col("chrom1").alias("c1"), F.explode(bins("bstart1", "bend1")).alias("b1"), F.col("chrom2").alias("c2"), "bstart2", "bend2")
        p = p.select("c1", "b1", "c2", F.explode(bins("bstart2", "bend2")).alias("b2"))
        p = p.unionByName(p.select(F.col("c2").alias("c1"), F.col("b2").alias("b1"), F.col("c1").alias("c2"), F.col("b1").alias("b2"))).distinct()
        on = (F.col("chrom1") == F.col("c1")) & (F.col("chrom2") == F.col("c2")) & (F.floor(F.col("start1") / resolution) == F.col("b1")) & (F.floor(F.col("start2") / resolution) == F.col("b2"))
        d = d.join(p, on, "left_anti")
    if remove_duplicates:
        d = d.dropDuplicates([c for c in ("cell_id",) if c in d.columns] + ["chrom1", "start1", "chrom2", "start2"])
    return d


def with_enough_contacts(contacts: DataFrame, counts: DataFrame, column: str = "CisLongContact", least: int = 50_000) -> DataFrame:
    """Contacts of cells that have more than ``least``."""
    return contacts.join(counts.where(F.col(column) > least).select("cell_id"), "cell_id", "left_semi")


def _transitions(pdf, n: int, pad: int):
    """Rows, columns and values, by column, of the smoothed symmetric matrix with diagonal 1, its rows scaled to sum 1."""
    import numpy as np

    def summed(key, value, how):
        key, at = np.unique(key, return_inverse=True)
        out = np.zeros(len(key))
        how.at(out, at, value)
        return key, out

    i, j, v = (pdf[c].to_numpy() for c in ("bin1", "bin2", "n"))
    key, v = summed(i.astype(np.int64) * n + j, v, np.add)
    key, v = summed(np.concatenate([key, key % n * n + key // n]), np.concatenate([v, v]), np.maximum)
    shifts = [(x, y) for x in range(-pad, pad + 1) for y in range(-pad, pad + 1)]
    i, j, v = np.concatenate([key // n + x for x, _ in shifts]), np.concatenate([key % n + y for _, y in shifts]), np.tile(v, len(shifts))
    inside = (i >= 0) & (i < n) & (j >= 0) & (j < n) & (i != j)
    key, v = summed(i[inside] * n + j[inside], v[inside], np.add)
    i, j, v = np.concatenate([key // n, np.arange(n)]), np.concatenate([key % n, np.arange(n)]), np.concatenate([v / len(shifts), np.ones(n)])
    v = v / np.bincount(i, v, n)[i]
    by = np.argsort(j, kind="stable")
    return i[by], j[by], v[by]


def _step(q, lo: int, p, restart: float, width: int):
    """The next step of rows ``lo`` on of the walk; of the matrix ``p`` only ``width`` columns are dense at a time."""
    import numpy as np

    (i, j, v), n = p, q.shape[1]
    new = np.empty_like(q)
    for at in range(0, n, width):
        a, b = np.searchsorted(j, [at, at + width])
        panel = np.zeros((n, min(width, n - at)))
        panel[i[a:b], j[a:b] - at] = v[a:b]
        new[:, at : at + width] = restart * (q @ panel)
    own = np.arange(len(q))
    new[own, lo + own] += 1 - restart
    return new


def impute(matrix: DataFrame, bins: int, pad: int = 1, restart: float = 0.5, tol: float = 0.01, cutoff: float = 1e-5) -> DataFrame:
    """Imputed contact matrices, (cell_id, chrom, bin1, bin2, value): mean over neighbouring bins, then a random walk with
    restart until it changes by less than ``tol``. The side of a matrix is its largest bin + 1, whatever ``bins`` is.

    A task holds the contacts of one chromosome of one cell and ``bins`` rows of its walk. Rows walk alone, and so do
    columns, as powers of one matrix commute; a first pass over wider matrices finds at which step all rows together
    change by less than ``tol``. Stands in for an external tool, whose figures it doesn't claim to reproduce.
    """
    import numpy as np
    import pandas as pd

    def rows(n, lo):
        return np.eye(min(bins, n - lo), n, lo)

    def changes(key, pdf):
        n, lo = int(pdf["side"].iloc[0]), int(key[2])
        p, q, out = _transitions(pdf, n, pad), rows(n, lo), []
        for _ in range(int(np.ceil(np.log(2 * n / tol) / np.log(1 / restart))) + 1):  # a row changes by 2 * restart ** step at most
            new = _step(q, lo, p, restart, bins)
            out.append(np.abs(new - q).sum())
            q = new
        return pd.DataFrame({"cell_id": key[0], "chrom": key[1], "step": np.arange(1, len(out) + 1), "change": out})

    def walk(key, pdf):
        n, lo = int(pdf["side"].iloc[0]), int(key[2])
        i, j, v = p = _transitions(pdf, n, pad)
        q, steps = rows(n, lo), 0
        known = None if n <= bins else int(pdf["steps"].iloc[0])
        while True:
            new, steps = _step(q, lo, p, restart, bins), steps + 1
            done = np.abs(new - q).sum() < tol if known is None else steps == known
            q = new
            if done:
                break
        by = np.argsort(i, kind="stable")
        back, columns, d = (j[by], i[by], v[by]), rows(n, lo), [np.ones(n), np.ones(n)]
        for _ in range(steps):
            columns = _step(columns, lo, back, restart, bins)
            d = [restart * np.bincount(to, d_[of] * v, n) + 1 - restart for d_, of, to in zip(d, (i, j), (j, i))]
        q, d = q + columns, np.sqrt(d[0] + d[1])
        q = q / d[lo : lo + len(q), None] / d[None, :]
        i, j = np.nonzero(np.triu(q, lo) > cutoff)
        return pd.DataFrame({"cell_id": key[0], "chrom": key[1], "bin1": i + lo, "bin2": j, "value": q[i, j]})

    side = F.max(F.greatest("bin1", "bin2")).over(Window.partitionBy("cell_id", "chrom")) + 1
    blocks = matrix.select("cell_id", "chrom", "bin1", "bin2", "n", side.cast("long").alias("side"))
    blocks = blocks.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("side") - 1, F.lit(bins).cast("long"))))
    change = blocks.where(F.col("side") > bins).groupBy("cell_id", "chrom", "lo").applyInPandas(changes, "cell_id string, chrom string, step int, change double")
    change = change.groupBy("cell_id", "chrom", "step").agg(F.sum("change").alias("change")).where(F.col("change") < tol)
    steps = change.groupBy(F.col("cell_id").alias("__cell"), F.col("chrom").alias("__chrom")).agg(F.min("step").alias("steps"))
    blocks = blocks.join(steps, F.col("cell_id").eqNullSafe(F.col("__cell")) & F.col("chrom").eqNullSafe(F.col("__chrom")), "left").drop("__cell", "__chrom")
    return blocks.groupBy("cell_id", "chrom", "lo").applyInPandas(walk, "cell_id string, chrom string, bin1 long, bin2 long, value double")


def cpg_ratio(sequence: DataFrame) -> DataFrame:
    """Share of CpG pairs among the bases of each bin: (chrom, bin, cpg) from (chrom, bin, seq); bins without bases go."""
    n = F.length("seq")
    return sequence.where(n > 0).select("chrom", "bin", (F.regexp_count(F.upper("seq"), F.lit("CG")) / n).alias("cpg"))


def compartments(matrix: DataFrame, cpg: DataFrame) -> DataFrame:
    """(cell_id, chrom, bin, score): the mean CpG ratio of the bins that a bin has contacts with, each contact weighing as
    much as it exceeds the mean of its distance; bins of one kind meet each other. Stands in for an external tool.

    matrix: cell_id, chrom, bin1 <= bin2, n. Distances have a row each and are joined, no matrix is dense.
    """
    d = matrix.withColumn("d", F.col("bin2") - F.col("bin1")).where("d > 0")
    mean = d.groupBy("cell_id", "chrom", "d").agg(F.avg("n").alias("mean"))
    d = d.join(mean, ["cell_id", "chrom", "d"]).withColumn("w", F.col("n") / F.col("mean"))
    ends = F.inline(F.array(F.struct(F.col("bin1").alias("bin"), F.col("bin2").alias("other")), F.struct(F.col("bin2").alias("bin"), F.col("bin1").alias("other"))))
    d = d.select("cell_id", "chrom", "w", ends).join(cpg.select("chrom", F.col("bin").alias("other"), "cpg"), ["chrom", "other"])
    return d.groupBy("cell_id", "chrom", "bin").agg((F.sum(F.col("w") * F.col("cpg")) / F.sum("w")).alias("score"))


def insulation(matrix: DataFrame, window: int = 10) -> DataFrame:
    """(cell_id, chrom, bin, score): contacts between the ``window`` bins before a bin and the ``window`` from it on, over their
    number of pairs. A contact counts for the bins that it spans, of which there are fewer than ``window`` on either side."""
    low, high = F.greatest(F.col("bin1") + 1, F.col("bin2") - window + 1), F.least(F.col("bin2"), F.col("bin1") + window)
    d = matrix.where(low <= high).withColumn("bin", F.explode(F.sequence(low, high)))
    return d.groupBy("cell_id", "chrom", "bin").agg((F.sum("n") / F.lit(float(window * window))).alias("score"))


def domain_boundaries(scores: DataFrame) -> DataFrame:
    """Bins whose insulation score is lower than that of both bins beside them; a bin without contacts across it scores 0."""
    near = scores.select("cell_id", "chrom", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"), F.col("bin").alias("of"), "score")
    by = near.groupBy("cell_id", "chrom", "bin").agg(*[F.coalesce(F.sum(F.when(F.col("of") == F.col("bin") + k, F.col("score"))), F.lit(0.0)).alias(n) for n, k in (("left", -1), ("score", 0), ("right", 1))])
    return by.where((F.col("score") < F.col("left")) & (F.col("score") < F.col("right"))).select("cell_id", "chrom", "bin", "score")


def embed(matrix: DataFrame, dims: int = 10, rounds: int = 100, tol: float = 1e-8) -> DataFrame:
    """(cell_id, embedding): cells along the principal components of log1p contacts by bin pair, every pair a feature.

    Subspace steps over cells: a row of the distributed table holds one pair in all its cells, the driver a few numbers a
    cell. Components beyond the rank are 0; the cell that weighs most in a component is positive there.
    """
    import numpy as np

    spark = matrix.sparkSession
    cells = [r[0] for r in matrix.select("cell_id").distinct().collect()]
    cells.sort(key=lambda c: (c is not None, c))
    of = matrix.schema["cell_id"].dataType
    schema = T.StructType([T.StructField("cell_id", of), T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    if not cells:
        return spark.createDataFrame([], schema)
    n = len(cells)
    index = spark.createDataFrame([(c, k) for k, c in enumerate(cells)], T.StructType([T.StructField("__cell", of), T.StructField("at", T.IntegerType())]))
    values = matrix.groupBy("cell_id", "chrom", "bin1", "bin2").agg(F.log1p(F.sum("n")).alias("v")).join(F.broadcast(index), F.col("cell_id").eqNullSafe(F.col("__cell")))
    pairs = values.groupBy("chrom", "bin1", "bin2").agg(F.collect_list(F.struct("at", "v")).alias("cells")).select("cells.at", "cells.v").persist()

    def times(u, centred: bool):
        """x @ y.T @ u, where y is x (cells by pairs) less its means, and so is x if ``centred``."""
        held, width = spark.sparkContext.broadcast(u), u.shape[1]

        def part(batches):
            u, z = held.value, np.zeros((n, width))
            for batch in batches:
                at, v = (batch.column(k).flatten().to_numpy() for k in (0, 1))
                m = batch.num_rows
                f = np.repeat(np.arange(m), batch.column(0).value_lengths().to_numpy())
                mean = np.bincount(f, v, m) / n
                for k in range(width):
                    t = np.bincount(f, v * u[at, k], m) - mean * u[:, k].sum()
                    z[:, k] += np.bincount(at, v * t[f], n) - (mean @ t if centred else 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(z.tolist(), pa.list_(pa.float64()))], names=["at", "z"])

        sums = pairs.mapInArrow(part, "at int, z array<double>").groupBy("at").agg(F.array(*[F.sum(F.col("z")[k]) for k in range(width)]).alias("z"))
        out = np.zeros((n, width))
        for r in sums.collect():
            out[r["at"]] = r["z"]
        held.unpersist()
        return out

    u = np.linalg.qr(np.random.default_rng(0).normal(size=(n, min(n, 2 * dims + 8))))[0]
    for _ in range(rounds):
        z = times(u, True)
        size, w = np.linalg.eigh((u.T @ z + z.T @ u) / 2)
        size, w = size[::-1][:dims], w[:, ::-1][:, :dims]
        axes = u @ w
        if u.shape[1] == n or np.abs(z @ w - axes * size).max() <= tol * max(size[0], tol):
            break
        u = np.linalg.qr(z)[0]
    else:
        raise RuntimeError(f"components have not settled in {rounds} rounds")
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None], 0) < 0, -1, 1)
    real = size > 1e-10 * max(size[0], 1e-10)
    found = np.zeros((n, dims))
    found[:, : len(size)] = times(axes, False) * np.where(real, 1 / np.sqrt(np.where(real, size, 1)), 0)
    pairs.unpersist()
    return spark.createDataFrame(list(zip(cells, found.tolist())), schema)
