"""Language identification by error-correcting output codes.

Each language has a binary codeword; for each bit a logistic classifier over hashed character n-grams says which side a
text lies on. Decoding picks the codeword with the smallest sum of logistic losses and flags texts where two are close.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from methylspark.llm.common import Workspace, columns_of, larger_files, table

#: Hashed features; n-grams of two and three bytes share them.
DIM = 4096
#: The bounded training sample: labelled documents for each language, and of all languages together. Of every language at
#: least one document is learned, however many languages there are.
PER_LANGUAGE, SAMPLE = 500, 10_000
#: Difference in decoding loss, in nats, under which the two best languages count as close.
CLOSE = 0.4
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
#: ASCII letters and all bytes of other characters stay, the rest is a space.
_KEEP = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_SPACES = re.compile(b" {2,}")


def has_letter(text: str) -> bool:
    """Whether any character is a letter; superscripts, Roman numerals and the like are none."""
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def features(text: str) -> np.ndarray:
    """Square roots of hashed 2- and 3-gram counts over the whole text, as a unit vector."""
    raw = _SPACES.sub(b" ", b" " + text.lower().encode("utf-8", "replace").translate(_KEEP) + b" ")
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    two = b[:-1] << np.uint32(8) | b[1:]
    out = np.bincount((two * np.uint32(2654435761)) >> np.uint32(20), minlength=DIM)
    if len(b) > 2:
        three = two[:-1] << np.uint32(8) | b[2:]
        out = out + np.bincount((three * np.uint32(2246822519)) >> np.uint32(20), minlength=DIM)
    out = np.sqrt(out).astype(np.float32)
    return out / max(1e-9, float(np.linalg.norm(out)))


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n x bits of -1 and 1. Up to seven languages every split into two sides; beyond, the best of some random codes."""
    if n <= 1:
        return np.ones((n, 0), dtype=np.float32)
    if n <= 7:
        code = [[1 if k == 0 or (split >> (k - 1)) & 1 else -1 for k in range(n)] for split in range(2 ** (n - 1) - 1)]
        return np.array(code, dtype=np.float32).T
    rng, best, far = np.random.default_rng(seed), None, -1
    bits = int(np.ceil(10 * np.log2(n)))
    for _ in range(64):
        code = rng.choice(np.array([-1, 1], dtype=np.float32), size=(n, bits))
        flat = np.abs(code.sum(axis=0)) == n  # a column that separates nothing
        code[0, flat] *= -1
        least = int(((bits - code @ code.T) / 2 + bits * np.eye(n)).min())
        if least > far:
            best, far = code, least
    return best


def fit_bits(x: np.ndarray, y: np.ndarray, penalty: float = 1e-5, steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions, all bits at once, by accelerated gradient descent. x: rows x DIM of unit length; y: rows x bits of -1, 1.

    The constant feature 0.3 is kept beside ``x``, so that rows are held once.
    """
    n, rate, one = len(x), 3.5, np.float32(0.3)
    w = np.zeros((x.shape[1] + 1, y.shape[1]), dtype=np.float32)
    v = w.copy()
    for t in range(steps):
        margin = y * (x @ v[:-1] + one * v[-1])
        pull = y / (1 + np.exp(np.clip(margin, -30, 30)))
        grad = np.vstack([x.T @ pull, one * pull.sum(axis=0, keepdims=True)])
        new = v - rate * (penalty * v - grad / n)
        v = new + (t / (t + 3)) * (new - w)
        w = new
    return w[:-1], w[-1] * one


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    code: np.ndarray = field(default_factory=lambda: codewords(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((DIM, 0), dtype=np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.float32))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, probability, whether another comes close). Without text, letters or learned languages: und."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        side = features(text) @ self.weights + self.bias
        loss = np.logaddexp(0, -self.code * side).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        share = np.exp(loss[order[0]] - loss)
        return self.languages[order[0]], float(1 / share.sum()), bool(loss[order[1]] - loss[order[0]] < CLOSE)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        keep = [n for n, t in enumerate(texts) if t and has_letter(t)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keep, pa.int64())), pa.array([features(texts[n]).astype(np.float16).tobytes() for n in keep], pa.binary())], names=["lang", "x"]
        )


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fits the model on a bounded sample: of the rows with ``learn`` and a language, PER_LANGUAGE of each language, or as
    many as SAMPLE rows of all allow, chosen by a hash of the id. Only their feature vectors (8 kB each, so 80 MB) come to
    the driver. No language is left out. Rows without text or letters teach nothing; of rows that repeat an id and
    language one is used. An empty table, or one without languages, gives a model that knows none."""
    spark = docs.sparkSession
    labelled = docs.where(learn & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(lang_col).alias("l"))
    # One row per language; its share leaves about twice as many rows as needed, by the hash that then chooses among them,
    # so their number is bounded before rows of a language meet.
    known = Workspace(spark, "language").put(labelled.groupBy("l").count(), "known", narrow=True)
    most = max(1, min(PER_LANGUAGE, SAMPLE // max(1, known.count())))
    share = known.select("l", (F.lit(2 * most + 100) / F.col("count")).alias("share"))
    first = Window.partitionBy("l").orderBy(F.xxhash64("i"), "i")
    near = F.shiftrightunsigned(F.xxhash64("i"), 11) / F.lit(float(2**53)) < F.col("share")
    chosen = labelled.join(share, "l").where(near).withColumn("nr", F.row_number().over(first)).where(F.col("nr") <= most).select("i", "l").distinct()
    texts = docs.where(learn).select(F.col(id_col).alias("i"), F.col(lang_col).alias("l"), F.col(text_col).alias("t"))
    sample = texts.join(F.broadcast(chosen), ["i", "l"]).dropDuplicates(["i", "l"])  # SAMPLE ids, or one for each language
    rows = sample.select("l", "t").mapInArrow(_vectors, "lang string, x binary").collect()
    languages = sorted({r.lang for r in rows})
    model = Model(languages, codewords(len(languages)))
    if len(languages) > 1:
        rows.sort(key=lambda r: (r.lang, r.x))
        x = np.stack([np.frombuffer(r.x, dtype=np.float16) for r in rows]).astype(np.float32)
        at = {lang: n for n, lang in enumerate(languages)}
        model.weights, model.bias = fit_bits(x, model.code[[at[r.lang] for r in rows]])
    return model


def predictor(model: Model):
    """A column function: text -> struct<lang_pred, score, ambiguous>."""
    sent = model

    @F.arrow_udf("struct<lang_pred: string, score: double, ambiguous: boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        langs, scores, close = [], [], []
        for text in texts:
            lang, score, near = sent.predict(text.as_py())
            langs.append(lang)
            scores.append(score)
            close.append(near)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(close, pa.bool_())], names=["lang_pred", "score", "ambiguous"])

    return predict


def held_out(doc_id: Column) -> Column:
    """Whether crc32(doc_id as text) mod 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learned_from(doc_id: Column) -> Column:
    return doc_id.isNotNull() & ~held_out(doc_id)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``__lang`` (lang_pred, score, ambiguous), predicted from whole texts alone.

    Null or empty text, or one without a letter: ``und``, score 0, ambiguous. Without labelled rows all are ``und``; with
    one language all are that one. Repeated rows get equal results; other columns pass unchanged.
    """
    return docs.withColumn("__lang", predictor(model)(F.col(text_col)))


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, learned_from(F.col("doc_id")))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "__lang.lang_pred", "__lang.score", "__lang.ambiguous")


def stage_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a recognisable language go: no letters, or no language at least half as likely
    as all others together."""
    model = train(docs, learned_from(F.col("doc_id")))
    kept = identify(larger_files(docs), model).where((F.col("__lang.lang_pred") != UNKNOWN) & ~(F.col("__lang.ambiguous") & (F.col("__lang.score") < 1 / 3)))
    return columns_of(kept, docs)
