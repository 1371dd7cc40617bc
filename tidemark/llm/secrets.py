"""Secrets in texts: three patterns, and Markov models of random strings for what they miss.

Everything runs as DataFrame expressions. The patterns give the base spans. Candidates are
the other unbroken runs of 16 or more key characters; two first-order character models, one
of random strings (the values the patterns found) and one of ordinary words, are counted
over a bounded sample of documents, and a candidate whose log-likelihood ratio is above the
threshold becomes a span of kind ``markov``. Offsets count code points, ends are exclusive.

Defined cases: a null text is empty and has no span; without any labelled random string the
model of random strings is uniform; repeated rows each get their own result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table

# The base patterns, and the least length of group 2 or of the match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
# A run of hex digits or of AKIA's letters is matched whole or, being short, not at all: the
# length can stand in the pattern. (An assignment that is too short still uses up its text.)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

#: Candidates for the models, and the words they learn ordinary text from.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{6,}"
#: Documents, picked by hash, that the models learn from (expected number).
TRAIN_DOCS = 20_000
#: Log-likelihood ratio, in nats, for each character beyond which a candidate is a secret.
THRESHOLD = 0.5
#: Strength of the smoothing, in transitions.
SMOOTH_RANDOM, SMOOTH_WORDS = 40.0, 5.0
#: The models' characters are coded from the first of the candidates' characters.
FIRST, CODES = ord("+"), ord("z") - ord("+") + 1
ALPHABET = 26 + 26 + 10 + 5

SPAN = "array<struct<start:int,end:int,kind:int>>"


def _none() -> Column:
    return F.array().cast(SPAN)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _spans(text: Column, pattern: str, kind: int, valid: str | None = None) -> Column:
    """Spans of the pattern's leftmost non-overlapping matches, in order.

    The text between the matches and the matches follow each other, so the running sum
    of their lengths gives the offsets. ``valid``: the group that must be long enough.
    """

    def build(found: Column) -> Column:
        gap, match, value = found["gap"], found["match"], found["value"]
        steps = F.arrays_zip(F.transform(gap, F.length).alias("g"), F.transform(match, F.length).alias("m"), F.transform(value, F.length).alias("v"))
        start = F.struct(F.lit(0).alias("at"), _none().alias("out"))

        def add(acc: Column, x: Column) -> Column:
            a = acc["at"] + x["g"]
            b = a + F.coalesce(x["m"], F.lit(0))
            span = F.array(F.struct(a.alias("start"), b.alias("end"), F.lit(kind).alias("kind")))
            keep = x["m"].isNotNull() & (x["v"] >= ASSIGN_LEAST if valid else F.lit(True))
            return F.struct(b.alias("at"), F.when(keep, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(steps, start, add, lambda acc: acc["out"])

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if valid else matches
    found = F.struct(F.split(text, pattern, -1).alias("gap"), matches.alias("match"), values.alias("value"))
    return F.when(text.rlike(pattern), _let(found, build)).otherwise(_none())


def base_spans(text: Column) -> Column:
    """The three patterns' spans by start, then kind."""
    found = F.concat(_spans(text, ASSIGN, 0, "value"), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    by = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.transform(F.array_sort(by), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def _transitions(tokens: DataFrame) -> DataFrame:
    """(label, cell, n): how often one character follows another in the tokens."""
    pairs = F.transform(
        F.array(F.split("token", "")),
        lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), _cell),
    )[0]
    return tokens.where(F.length("token") > 1).select("label", F.explode(pairs).alias("cell")).groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n"))


def _cell(a: Column, b: Column) -> Column:
    return (F.ascii(a) - FIRST) * CODES + F.ascii(b) - FIRST


def _picked(docs: DataFrame, most: int) -> DataFrame:
    share = min(1.0, most / max(1, docs.count()))
    return docs.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < math.ceil(share * (1 << 20))) if share < 1 else docs


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> list[float]:
    """Log-likelihood ratio of each transition, random against ordinary (CODES x CODES, by row).

    Labelled samples: the values the patterns match are random strings; the words of
    the text without them are ordinary.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = _picked(docs, train_docs).select(text)
    values = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_LEAST),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    clean_value = lambda v: F.regexp_replace(v, r"[^A-Za-z0-9+/_=-]", "")
    secret = F.col("text").rlike(f"{ASSIGN}|{ACCESS}|{HEX}")
    random = rows.where(secret).select(F.lit(1).alias("label"), F.explode(F.transform(F.array_distinct(values), clean_value)).alias("token"))
    # Ordinary words: of documents no pattern matches, an eighth of the sample.
    plain = _picked(docs, max(1, train_docs // 8)).select(text).where(~secret)
    words = plain.select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("token"))
    # At most 2 * CODES * CODES rows.
    counts = {0: {}, 1: {}}
    for r in _transitions(random.distinct().union(words)).collect():
        counts[r["label"]][r["cell"]] = r["n"]
    used = [c for c in range(CODES) if chr(FIRST + c).isalnum() or chr(FIRST + c) in "+/_=-"]
    ratio = [0.0] * (CODES * CODES)
    overall = {b: sum(counts[0].get(a * CODES + b, 0) for a in used) + 1.0 for b in used}
    every = sum(overall.values())
    for a in used:
        n1 = sum(counts[1].get(a * CODES + b, 0) for b in used)
        n0 = sum(counts[0].get(a * CODES + b, 0) for b in used)
        for b in used:
            p1 = (counts[1].get(a * CODES + b, 0) + SMOOTH_RANDOM / ALPHABET) / (n1 + SMOOTH_RANDOM)
            p0 = (counts[0].get(a * CODES + b, 0) + SMOOTH_WORDS * overall[b] / every) / (n0 + SMOOTH_WORDS)
            ratio[a * CODES + b] = round(math.log(p1 / p0), 6)
    return ratio


def markov_spans(text: Column, base: Column, ratio: list[float], threshold: float = THRESHOLD) -> Column:
    """Candidates that don't overlap a base span and score above the threshold for each transition."""
    table = F.split(F.lit(",".join(map(repr, ratio))), ",").cast("array<double>")

    def score(chars: Column) -> Column:
        pairs = F.zip_with(F.slice(chars, 1, F.size(chars) - 1), F.slice(chars, 2, F.size(chars) - 1), lambda a, b: F.get(table, _cell(a, b)))
        return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x) / F.size(pairs)

    secret = lambda s: _let(F.split(F.substring(text, s["start"] + 1, s["end"] - s["start"]), ""), score) > threshold
    apart = lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"]))
    return F.filter(F.filter(_spans(text, CANDIDATE, 3), apart), secret)


def _joined(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def _scanned(text: Column, ratio: list[float]) -> Column:
    """A struct of base and spans."""

    def both(base: Column) -> Column:
        by = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
        back = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        every = F.concat(base, markov_spans(text, base, ratio))
        return F.struct(base.alias("base"), F.transform(F.array_sort(F.transform(every, by)), back).alias("spans"))

    return _let(base_spans(text), both)


def scan(docs: DataFrame, ratio: list[float]) -> DataFrame:
    """(doc_id, base, spans) for each row: arrays of (start, end, kind), by start, then kind."""
    found = docs.select("doc_id", _scanned(F.coalesce("text", F.lit("")), ratio).alias("found"))
    return found.select("doc_id", "found.base", "found.spans")


def redact(docs: DataFrame, ratio: list[float], mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of the text replaced; n_chars, where there is one, follows."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def replaced(spans: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            fresh = s["start"] >= acc["at"]
            cut = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
            return F.struct(F.when(fresh, cut).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
        whole = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
        return F.when(F.size(spans) > 0, whole).otherwise(F.col("text"))

    new = _let(_scanned(text, ratio)["spans"], replaced)
    out = docs.select(*(new.alias(c) if c == "text" else F.col(c) for c in docs.columns))
    if "n_chars" not in docs.columns:
        return out
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("text").contains(mark), length).otherwise(F.col("n_chars")))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", count(0), count(1), count(2), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
