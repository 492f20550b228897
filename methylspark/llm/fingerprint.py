"""Canonical exact digests: normal form, folded case and white space, wide xxhash, byte comparison inside equal buckets.

DataFrame functions only. Normal form and case folding are ICU's, which Spark carries for its collations, called through
the SQL function ``reflect``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from methylspark.llm.common import Workspace, shuffle_partitions, table


def canonical(text: Column) -> Column:
    """NFKC, full case folding, NFKC again; each run of white space becomes one space, none at the ends. Null: empty."""

    def call(cls: str, method: str, x: Column) -> Column:
        return F.reflect(F.lit(cls), F.lit(method), x, F.lit(True))

    x = call("com.ibm.icu.text.Normalizer", "compose", F.coalesce(text, F.lit("")))
    x = call("com.ibm.icu.text.Normalizer", "compose", call("com.ibm.icu.lang.UCharacter", "foldCase", x))
    return F.trim(F.regexp_replace(x, r"[\s\p{Z}]+", " "))


def digest(canon: Column, words: int = 2, bits: int = 64) -> list[Column]:
    """``words`` independent 64-bit xxhashes of the canonical text. Fewer ``bits`` let tests see collisions."""
    return [F.shiftright(F.xxhash64(F.lit(k), canon), 64 - bits) for k in range(words)]


def as_text(words: list[Column]) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(w), 16, "0") for w in words]))


def _same(a: str, b: str) -> Column:
    return (F.col(f"{a}1") == F.col(f"{b}1")) & (F.col(f"{a}2") == F.col(f"{b}2"))


def neighbours(ids: DataFrame, space: Workspace) -> DataFrame:
    """Each doc_id's predecessor in ascending order, the first one's being the last: adds before_id, before_n, before_1, before_2, before_rows.

    ``ids``: doc_id (distinct, not null), n, d1, d2, rows. The ids are range-sorted once; windows run inside ranges and
    a table of one row per range passes the last id of each on to the next.
    """
    spark = ids.sparkSession
    ranked = ids.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id").withColumn("at", F.monotonically_increasing_id())
    ranked = space.put(ranked, "ranked").withColumn("range", F.shiftright("at", 33))
    me = F.struct("doc_id", "n", "d1", "d2", "rows")
    ends = ranked.groupBy("range").agg(F.min("doc_id").alias("first_id"), F.max_by(me, "at").alias("last"))
    order = Window.orderBy("range")
    ends = ends.select("first_id", F.coalesce(F.lag("last").over(order), F.max_by("last", "range").over(Window.partitionBy())).alias("across"))
    out = ranked.withColumn("within", F.lag(me).over(Window.partitionBy("range").orderBy("at")))
    out = out.join(F.broadcast(ends), F.col("doc_id") == F.col("first_id"), "left")  # one row per range
    before = F.coalesce("within", "across")
    return out.select(
        "doc_id", "d1", "d2", before["doc_id"].alias("before_id"), before["n"].alias("before_n"), before["d1"].alias("before_1"), before["d2"].alias("before_2"), before["rows"].alias("before_rows")
    )


def copies(members: DataFrame, buckets: DataFrame, space: Workspace) -> tuple[DataFrame, DataFrame | None]:
    """Byte comparison inside buckets of two or more rows.

    ``members``: doc_id, d1, d2, canon of the rows in ``buckets`` (d1, d2, rows, copy_of). Each text is compared with
    the one before it; a bucket of m rows is dealt over sqrt(m) parts, and the parts' first texts are compared in turn, so
    no task gets a whole hot bucket. Returns the buckets in which all bytes agree and, should any differ, the exact
    classes (d1, d2, canon_sha, copy_of, rows) of those that collide.
    """
    salted = members.join(buckets, ["d1", "d2"]).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.ceil(F.sqrt("rows"))))
    part = Window.partitionBy("d1", "d2", "salt").orderBy("doc_id", "canon")
    compared = salted.withColumn("ok", F.coalesce(F.lag("canon").over(part) == F.col("canon"), F.lit(True))).withColumn("nr", F.row_number().over(part))
    heads = compared.where("nr = 1")
    heads = heads.withColumn("ok", F.coalesce(F.lag("canon").over(Window.partitionBy("d1", "d2").orderBy("salt")) == F.col("canon"), F.lit(True)))
    wrong = compared.where(~F.col("ok")).select("d1", "d2").unionByName(heads.where(~F.col("ok")).select("d1", "d2"))
    wrong = space.put(wrong.distinct(), "collided")
    if wrong.isEmpty():
        return buckets, None
    exact = members.join(wrong, ["d1", "d2"]).groupBy("d1", "d2", F.sha2("canon", 256).alias("canon_sha"), "canon").agg(
        F.min("doc_id").alias("copy_of"), F.count(F.lit(1)).alias("rows")
    )
    return buckets.join(wrong, ["d1", "d2"], "left_anti"), exact.drop("canon")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """Fingerprints of every text and of its edited text, and the group of exact copies.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; copy_of: the smallest doc_id
    with the same canonical bytes; copies: how many rows have them. The edited text has its last floor(n_chars / 2) code
    points replaced by the first as many of the next document, ascending doc_id, the first one following the last.
    Likeness is 1.0 where canonical bytes agree, else 0.0: equal hashes are confirmed on bytes.

    Whole texts are shuffled once, by doc_id; what passes to the preceding document is at most half as long as that one.
    Null text: empty. Null doc_id: an ordinary text without a next document, so nothing replaces the end it loses, and
    near_next is 0. Rows that repeat a doc_id: each gets a result; as a next document the one with the smallest hash
    stands for all. One document alone follows itself. An empty table gives no rows. Other columns have no effect.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "fingerprint")
    # A cast or alias that changes nothing would be kept in one of two equal plans and hide that they are equal.
    same = id_col == "doc_id" and dict(docs.dtypes)[id_col] == "bigint"
    texts = docs.select(F.col(id_col) if same else F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d1, d2 = digest(F.col("canon"), bits=bits)
    rows = texts.select("doc_id", F.char_length("text").alias("n"), F.xxhash64("text").alias("raw"), canonical(F.col("text")).alias("canon"))
    rows = space.put(rows.select("doc_id", "n", "raw", d1.alias("d1"), d2.alias("d2")), "rows")
    ids = rows.where("doc_id is not null").groupBy("doc_id").agg(
        F.max("n").alias("n"), F.min(F.struct("raw", "d1", "d2")).alias("rep"), F.count(F.lit(1)).alias("rows")
    )
    ids = space.put(ids.select("doc_id", "n", "rep.raw", "rep.d1", "rep.d2", "rows"), "ids")
    repeats = not ids.where("rows > 1").isEmpty()
    buckets = rows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("copy_of")).where("rows > 1")
    buckets = space.put(buckets, "buckets")
    twins = rows.where("doc_id is not null").join(buckets.select("d1", "d2"), ["d1", "d2"], "left_semi").select("doc_id").distinct()
    twins = twins.select(F.col("doc_id").alias("twin_id"))
    order = space.put(neighbours(ids.drop("raw"), space), "order")
    # What each document passes to the one before it: as much of its beginning as that one needs, and the whole text only
    # where hashes agree and bytes must be compared.
    shown = texts.where("doc_id is not null")
    source = shown.join(order, "doc_id")
    if repeats:
        source = source.join(ids.select("doc_id", F.col("raw").alias("rep_raw")), "doc_id").where(F.xxhash64("text") == F.col("rep_raw")).dropDuplicates(["doc_id"])
    passed = source.select(
        F.col("before_id"),
        F.substring("text", F.lit(1), F.floor(F.col("before_n") / 2).cast("int")).alias("head"),
        F.when(_same("d", "before_") | (F.col("before_rows") > 1), F.col("text")).alias("full"),
        F.col("d1").alias("next_1"), F.col("d2").alias("next_2"),
    )
    # Both joins deal ``shown`` by doc_id in the same way, so Spark shuffles it once; rows without an id stay where they are.
    joined = shown.join(passed, F.col("doc_id") == F.col("before_id"), "left").join(twins, F.col("doc_id") == F.col("twin_id"), "left")
    joined = joined.unionByName(texts.where("doc_id is null"), allowMissingColumns=True)
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.coalesce("head", F.lit("")), F.lit(1), half))
    out = joined.select("doc_id", "twin_id", "full", "next_1", "next_2", n.cast("long").alias("n_chars"), canonical(F.col("text")).alias("canon"), edited.alias("edited"))
    out = out.select("*", F.sha2("edited", 256).alias("edited_sha256"), canonical(F.col("edited")).alias("edited_canon"), d1.alias("d1"), d2.alias("d2"))
    e1, e2 = digest(F.col("edited_canon"), bits=bits)
    out = out.withColumn("near_next", F.col("full").isNotNull() & _same("d", "next_"))
    # canonical() is kept out of conditions: reflect is only evaluated in projections.
    out = out.withColumn("full_canon", canonical(F.when(F.col("near_next"), F.col("full"))))
    out = out.select(
        "doc_id", "n_chars", "edited_sha256", as_text([F.col("d1"), F.col("d2")]).alias("fingerprint"), as_text([e1, e2]).alias("edited_fingerprint"),
        (F.col("canon") == F.col("edited_canon")).cast("double").alias("near_edited"),
        F.coalesce(F.col("near_next") & (F.col("full_canon") == F.col("canon")), F.lit(False)).cast("double").alias("near_next"),
        "d1", "d2", F.when(F.col("twin_id").isNotNull() | F.col("doc_id").isNull(), F.col("canon")).alias("canon"),
    )
    out = space.put(out, "out")
    members = out.join(buckets.select("d1", "d2"), ["d1", "d2"], "left_semi").select("doc_id", "d1", "d2", "canon")
    agreed, exact = copies(members, buckets, space)
    result = out.join(agreed.select("d1", "d2", "copy_of", F.col("rows").alias("copies")), ["d1", "d2"], "left")
    if exact is not None:
        other = exact.select(F.col("d1").alias("x1"), F.col("d2").alias("x2"), "canon_sha", F.col("copy_of").alias("copy_x"), F.col("rows").alias("copies_x"))
        result = result.join(other, (F.col("d1") == F.col("x1")) & (F.col("d2") == F.col("x2")) & (F.sha2("canon", 256) == F.col("canon_sha")), "left")
        result = result.withColumn("copy_of", F.coalesce("copy_of", "copy_x")).withColumn("copies", F.coalesce("copies", "copies_x"))
    return result.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        F.coalesce("copy_of", "doc_id").alias("copy_of"), F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, whole and edited."""
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
