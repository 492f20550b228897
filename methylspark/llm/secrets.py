"""Secret scans: three patterns, and values after credential words whose guess cost is high.

The guess cost of a value is the least number of guesses, in bits, over all ways to cut it into words, dates, repeats,
sequences, keyboard walks and brute-force spans.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from methylspark.llm.common import columns_of, larger_files, table

KINDS = ("assign", "access", "hex", "guess")
#: Guess cost in bits from which a value in credential context is a secret.
GUESS_BITS = 36.0
#: Bits a letter from which a value of one word, letters alone, is no word of any language.
WORD_BITS = 3.75
MASK = "[SECRET]"

_ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")
_IS_HEX = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))
#: Words that announce a credential, more freely than the base pattern, then a separator and a value. No letter stands
#: before the word but where a capital begins a new one (dbPassword).
_CONTEXT = re.compile(
    r"""(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))(?i:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[-_\x20]?key|access[-_\x20]?key|private[-_\x20]?key|credentials?|auth|bearer)["']?\x20*(?:=>|:=|[:=])\x20*["'`]?([^\s"'`<>,;()\[\]{}]{6,})""",
    re.ASCII,
)
#: An address; group 1: the password in it, if any. Without one it is no credential.
_ADDRESS = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@\s:]*:([^/@\s]+)@)?")

#: What people choose or put in place of a value most often, from the most guessed on. They come before the
#: words of the vocabularies.
WORDS = (
    "password", "qwerty", "admin", "welcome", "letmein", "monkey", "dragon", "login", "master", "hello", "secret", "token", "changeme", "default",
    "example", "test", "user", "root", "guest", "love", "iloveyou", "princess", "sunshine", "football", "baseball", "shadow", "superman", "placeholder",
)
#: Longer words than this are found in parts.
LONGEST_WORD = 20
_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
#: Bits of a character that separates words, of a year, of a date.
SEPARATORS, SEPARATOR, YEAR, DATE = "_-./:", 2.0, 7.0, 15.5
_LEET = str.maketrans("4@31!0$57", "aaeiiosst")
_DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d|(?:19|20)\d\d)")


#: Runs (repeats, walks, sequences) may be cut anywhere up to this length; a longer one only counts whole.
RUN = 16


def vocabularies() -> tuple[str, ...]:
    """Files whose entries, in their order, rank words by how common they are: English, then many languages."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _entries(path: str) -> list[str]:
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        return [w.removesuffix("</w>") for w in sorted(vocab, key=vocab.get)]
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]).decode("utf-8", "replace").strip() for line in f]


@lru_cache(4)
def ranked(paths: tuple[str, ...]) -> dict[str, float]:
    """Bits of each word: the logarithm of its best rank in WORDS and then in any of the vocabularies, which have their
    entries in order of frequency. Words are three to LONGEST_WORD letters, lower-cased."""
    out: dict[str, int] = {w: n for n, w in enumerate(WORDS)}
    for path in paths:
        words = (w.lower() for w in _entries(path) if 3 <= len(w) <= LONGEST_WORD and w.isalpha())
        for n, w in enumerate(dict.fromkeys(words)):
            out[w] = min(out.get(w, n + len(WORDS)), n + len(WORDS))
    return {w: log2(n + 2) for w, n in out.items()}


@lru_cache(1)
def _near() -> dict[str, set[str]]:
    """Keys beside each other: in a row, or in rows that touch (each row lies half a key further right)."""
    at = {c: (r, k) for r, row in enumerate(_ROWS) for k, c in enumerate(row)}
    return {c: {d for d, (s, m) in at.items() if d != c and ((s == r and abs(m - k) == 1) or (s == r - 1 and m - k in (0, 1)) or (s == r + 1 and m - k in (-1, 0)))} for c, (r, k) in at.items()}


def _per_character(value: str) -> float:
    """Bits of one brute-force character: the size of the alphabet that the value draws on."""
    size = 10 * any(c.isdigit() for c in value) + 26 * any(c.islower() for c in value) + 26 * any(c.isupper() for c in value) + 33 * any(not c.isalnum() for c in value)
    if size == 36 and all(c in "0123456789abcdef" for c in value):
        size = 16
    return log2(max(size, 2))


def guess_bits(value: str, words: dict[str, float] | None = None) -> float:
    """Least guess cost over all segmentations into words, dates, repeats, sequences, walks and brute-force characters.

    Linear in the length: spans are bounded but for whole runs, of which each place has three at most. A structured span
    adds one bit for the choice of its kind; a word one for capitals and one for digits in place of letters.
    """
    words = ranked(vocabularies()) if words is None else words
    n, low, near = len(value), value.lower(), _near()
    if len(low) != n:  # some capitals have longer small forms
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain, brute = low.translate(_LEET), _per_character(value)
    best = [0.0] + [float("inf")] * n
    walk, run, same = [0] * n, [0] * n, [0] * n  # how far a walk, a sequence, a repeat goes on from each place
    for i in range(n - 1, -1, -1):
        on = i + 1 < n
        walk[i] = walk[i + 1] + 1 if on and low[i + 1] in near.get(low[i], ()) else 1
        same[i] = same[i + 1] + 1 if on and value[i] == value[i + 1] else 1
        step = ord(value[i + 1]) - ord(value[i]) if on else 0
        run[i] = (run[i + 1] + 1 if i + 2 < n and ord(value[i + 2]) - ord(value[i + 1]) == step else 2) if step in (1, -1) else 1
    kinds = ((same, brute), (walk, log2(len(near)) + 1.5), (run, brute + 1))
    for i in range(n):
        if (b := best[i] + (SEPARATOR if value[i] in SEPARATORS else brute)) < best[i + 1]:
            best[i + 1] = b
        at = best[i] + 1
        if plain[i].isalpha():
            for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
                rank = words.get(plain[i:j])
                if rank is not None:
                    best[j] = min(best[j], at + rank + (plain[i:j] != low[i:j]) + (value[i:j] != low[i:j]))
        for lengths, bits in kinds:
            if (length := lengths[i]) >= 3:
                for j in (*range(i + 3, i + min(length, RUN)), i + length):
                    best[j] = min(best[j], at + bits + log2(j - i))
        if "0" <= value[i] <= "9":
            for j in range(i + 4, min(n, i + 10) + 1):
                if _DATE.fullmatch(value, i, j):
                    best[j] = min(best[j], at + (YEAR if j - i == 4 and value[i : i + 2] in ("19", "20") else DATE))
    return best[n]


def is_secret(value: str, bits: float) -> bool:
    """Whether a value in credential context is too dear to guess. Of a plain word, which no vocabulary need have, each letter must be."""
    plain = value.isalpha() and (value[1:].islower() or value.isupper())
    return bits >= GUESS_BITS and not (plain and bits < WORD_BITS * len(value))


def spans(text: str | None) -> list[tuple[str, int, int, int, int, float]]:
    """(kind, start, end, value_start, value_end, guess bits) in code points, by start, then kind as listed in KINDS.

    Base spans are leftmost and non-overlapping for each kind. Guess spans are values in credential context that no base
    span contains and whose guess cost is GUESS_BITS or more; a value that a base span covers in part counts whatever its
    cost, since the base span has found that it is secret.
    """
    out: list[tuple[str, int, int, int, int, float]] = []
    if not text:
        return out
    separated = "=" in text or ":" in text
    if separated:
        out += [("assign", m.start(), m.end(), m.start(1), m.end(1), guess_bits(m[1])) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start(), m.end(), guess_bits(m[0])) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if b"1" * 32 in text.encode("utf-8", "replace").translate(_IS_HEX):
        out += [("hex", m.start(), m.end(), m.start(), m.end(), guess_bits(m[0])) for m in _LONG_HEX.finditer(text)]
    if separated:
        base, at = [(s[1], s[2]) for s in out], 0
        while m := _CONTEXT.search(text, at):
            (a, b), at = m.span(1), m.end()
            if address := _ADDRESS.match(text, a, b):
                at = address.end()  # a credential may follow in its path
                if address[1] is None:
                    continue
                a, b = address.span(1)
            while b > a and text[b - 1] in ".:!?":  # the sentence's own mark
                b -= 1
            if b - a < 6 or any(s <= a and b <= e for s, e in base):
                continue
            bits = guess_bits(text[a:b])
            if is_secret(text[a:b], bits) or any(s < b and a < e for s, e in base):
                out.append(("guess", a, b, a, b, bits))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value_start", pa.int64()), ("value_end", pa.int64()), ("bits", pa.float64())])
_SPAN_DDL = "array<struct<kind: string, start: long, end: long, value_start: long, value_end: long, bits: double>>"


def _find(texts: pa.Array) -> pa.Array:
    keys = [f.name for f in _SPAN]
    return pa.array([[dict(zip(keys, s)) for s in spans(t.as_py())] for t in texts], pa.list_(_SPAN))


def mask(text: str | None) -> str | None:
    """The text with each secret value replaced by MASK; overlapping values become one."""
    found = sorted((s[3], s[4]) for s in spans(text))
    if not found:
        return text
    out, at = [], 0
    for a, b in found:
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join(out) + text[at:]


def _mask(texts: pa.Array) -> pa.Array:
    return pa.array([mask(t.as_py()) for t in texts], pa.string())


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__spans``, the secrets of each whole text (see ``spans``).

    Null and empty texts have none. Rows are independent: repeated rows get equal results, an empty table none, other
    columns pass unchanged. A task holds one batch of texts.
    """
    return docs.withColumn("__spans", F.arrow_udf(_find, _SPAN_DDL)(F.col(text_col)))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    """The secrets of every document: counts and places."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("__spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"),
        F.array_max(F.transform("__spans", lambda s: s["bits"])).alias("most_bits"),
    )


def stage_secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secret values are masked; every document stays."""
    masked = larger_files(docs).withColumn("text", F.arrow_udf(_mask, "string")(F.col("text")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))
    return columns_of(masked, docs)
