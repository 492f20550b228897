"""Column functions over sequences, names and call strings."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bases that an IUPAC letter stands for; N also stands for an unread base.
IUPAC = {
    "A": "A", "T": "T", "C": "C", "G": "G", "R": "AG", "Y": "CT", "S": "GC", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ATC", "V": "ACG", "N": "ATCGN",
}


def reverse_complement(seq: Column) -> Column:
    """Lower-case a and t stay lower-case, c and g become upper-case."""
    return F.translate(F.reverse(seq), "ACGTacgtnN", "TGCAtGCanN")


def complement(seq: Column) -> Column:
    """Complement of A, C, G, T, N; any other letter leaves the whole sequence as it is."""
    return F.when(seq.rlike("^[ACGTN]*$"), F.translate(seq, "ACGTN", "TGCAN")).otherwise(seq)


def contexts_of(pattern: str) -> list[str]:
    """All contexts that an IUPAC pattern stands for, sorted."""
    unknown = set(pattern.upper()) - IUPAC.keys()
    if unknown:
        raise KeyError(f"not in the IUPAC table: {', '.join(sorted(unknown))}")
    return sorted("".join(p) for p in product(*(IUPAC[b] for b in pattern.upper())))


def matches_pattern(context: Column, pattern: str) -> Column:
    return context.rlike("^" + "".join(f"[{IUPAC[b]}]" for b in pattern.upper()) + "$")


def clean_name(name: Column) -> Column:
    """A name safe for paths: no field separators, only letters, digits and underscores."""
    return F.regexp_replace(F.trim(name), "[^a-zA-Z0-9]", "_")


def count_letters(s: Column, letters: str) -> Column:
    """How many characters of ``s`` are among ``letters``; no loop, no array."""
    return (F.length(s) - F.length(F.translate(s, letters, ""))).cast("long")


def position_v2(cell_id: Column) -> dict[str, Column]:
    """Plate, MultiplexGroup, PCRIndex, RandomIndex, Col384, Row384 of ids like plate-group-primer-index; null where malformed."""
    parts = F.split(cell_id, "-")
    ok = (F.size(parts) == 4) & F.get(parts, F.lit(3)).rlike("^[A-P][0-9]+$")

    def of(k: int) -> Column:
        return F.when(ok, F.get(parts, F.lit(k)))

    index = of(3)
    return {
        "Plate": of(0), "MultiplexGroup": of(1), "PCRIndex": of(2), "RandomIndex": index,
        "Col384": (F.substring(index, 2, 10).cast("int") - 1).cast("long"), "Row384": (F.ascii(index) - 65).cast("long"),
    }


#: Shift of (column, row) inside a 2 x 2 block, by random index; the first four belong to the first plate.
INDEX_V1 = {
    "AD001": (0, 0), "AD002": (0, 1), "AD004": (1, 0), "AD006": (1, 1),
    "AD007": (0, 0), "AD008": (0, 1), "AD010": (1, 0), "AD012": (1, 1),
}
FIRST_PLATE_V1 = ("AD001", "AD002", "AD004", "AD006")


def position_v1(cell_id: Column) -> dict[str, Column]:
    """Plate, PCRIndex, RandomIndex, Col384, Row384 of ids like plate1-plate2-A1-AD001; null where malformed."""
    parts = F.split(cell_id, "-")
    index, pcr = F.get(parts, F.lit(3)), F.get(parts, F.lit(2))
    ok = (F.size(parts) == 4) & F.upper(index).isin(*INDEX_V1) & pcr.rlike("^[A-H][0-9]+$")
    shift = F.create_map(*[x for k, (c, r) in INDEX_V1.items() for x in (F.lit(k), F.struct(F.lit(c).alias("c"), F.lit(r).alias("r")))])
    at = F.element_at(shift, F.upper(index))
    return {
        "Plate": F.when(ok, F.when(F.upper(index).isin(*FIRST_PLATE_V1), F.get(parts, F.lit(0))).otherwise(F.get(parts, F.lit(1)))),
        "PCRIndex": F.when(ok, pcr), "RandomIndex": F.when(ok, index),
        "Col384": F.when(ok, 2 * (F.substring(pcr, 2, 10).cast("int") - 1) + at["c"]).cast("long"),
        "Row384": F.when(ok, 2 * (F.ascii(pcr) - 65) + at["r"]).cast("long"),
    }


def regroup_v2(cell_id: Column) -> Column:
    """The id with the multiplex group that its random index's column implies: six groups of two columns, twice."""
    parts = F.split(cell_id, "-")
    col = F.substring(F.element_at(parts, 4), 2, 10).cast("int")
    group = F.floor(F.pmod(col - 1, F.lit(12)) / 2) + 1
    return F.concat_ws("-", F.element_at(parts, 1), group.cast("string"), F.element_at(parts, 3), F.element_at(parts, 4))


def region(chrom: Column, start: Column, end: Column) -> Column:
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))
