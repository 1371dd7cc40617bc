"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values.

Fit. Over a bounded sample of labelled documents each token gets its log-odds between
toxic and other documents under a Dirichlet prior made of the sample's own token
frequencies; tokens whose log-odds are not significant stay unlisted. Significance counts
documents, one of each group of near copies, so a text that was copied often lends its
words no weight; the odds are of occurrences, of which a document counts 1 + ln(n), so one
that repeats a word a thousand times settles nothing. A token is a word or a word's beginning of 4 to 6 letters. The listed
toxic tokens and the (slightly negative) score of every other token are log-likelihood
ratios.

Score. A linear-time scan finds all maximal-scoring segments of a text. A segment of
score S in a text of n tokens has the Karlin-Altschul expectation E = K n exp(-lambda S);
segments with E below the bound are the toxic passages. Only they count: each has the reduced
Gumbel variate lambda * S - ln(K n) = -ln E, and a logistic curve turns their sum into a
probability. Every passage pays for the text's length, so chance hits don't add up to a
verdict however long a text is. K, lambda and the curve are fitted on these same segments.

Defined cases: texts without a toxic passage, null and empty ones too, score as the training
documents without one do; without labels of both classes no token is listed and every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import MAX_PER_CLASS, held_out, labelled_sample, materialize, read_table

TOKEN = re.compile(r"[^\W\d_]+")
#: Lengths of the word beginnings that count as tokens, written with a star.
STEMS = (4, 5, 6)
#: Words in a shingle, and minimum hashes by which near copies are told in the sample.
SHINGLE, HASHES = 5, 3
#: The prior's weight for each token: a constant and a share of its document count.
PRIOR_LEAST, PRIOR_SHARE = 0.5, 0.01
#: A document's weight for a token is counted in this part of one, so that sums don't depend on their order.
WEIGHT = 1000
#: Nats of evidence above the log of the number of tokens, the least log-odds, and the most tokens listed.
EVIDENCE, LEAST_ODDS, MAX_LISTED = 3.0, 1.5, 50_000
#: A segment with a larger expectation is no passage.
MAX_E = 0.5
THRESHOLD = 0.5


@dataclass
class ToxicModel:
    scores: dict[str, float] = field(default_factory=dict)
    other: float = -0.01  # score of an unlisted token
    lam: float = 1.0
    k: float = 1e-3
    base: float = 0.0  # score of a text without a passage
    slope: float = 1.0
    shift: float = 0.0


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def segments(hits: list[tuple[int, float]], other: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first token, last token, score) in linear time.

    ``hits`` lists the positive tokens as (position, score); every token between them
    scores ``other`` < 0. Candidates are kept with the cumulative score on their left
    and right, and the nearest earlier one that is lower on its left: a new candidate
    only follows these, so those it has passed are never looked at again.
    """
    out: list[tuple[int, int, float, float, int]] = []  # first, last, left sum, right sum, lower one
    total, seen = 0.0, 0
    for at, score in hits:
        left = total + other * (at - seen)
        total, seen = left + score, at + 1
        first, j = at, len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= left:
                j = out[j][4]
            if j < 0 or out[j][3] >= total:
                out.append((first, at, left, total, j))
                break
            first, left, lower = out[j][0], out[j][2], out[j][4]
            del out[j:]
            j = lower
    return [(a, b, r - x) for a, b, x, r, _ in out]


class Lexicon(dict):
    """Word to score or None; a word's score is the best of its listed tokens'. Filled as words come."""

    def __init__(self, scores: dict[str, float], most: int = 300_000):
        super().__init__()
        self.scores, self.most = scores, most

    def __missing__(self, word: str) -> float | None:
        if len(self) >= self.most:
            self.clear()
        found = [s for t in features(word) if (s := self.scores.get(t)) is not None]
        self[word] = best = max(found, default=None)
        return best


def features(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in STEMS if len(word) >= k)]


def _hits(words: list[str], lexicon: Lexicon) -> list[tuple[int, float]]:
    return [(i, s) for i, s in enumerate(map(lexicon.__getitem__, words)) if s is not None]


def significant(hits: list[tuple[int, float]], n: int, model: ToxicModel) -> list[tuple[int, int, float, float]]:
    """The segments (first, last, score, E) that chance hardly gives a text of ``n`` tokens."""
    found = segments(hits, model.other)
    return [(a, b, s, e) for a, b, s in found if (e := model.k * n * math.exp(-min(600.0, model.lam * s))) <= MAX_E]


def passages(words: list[str], model: ToxicModel, lexicon: Lexicon) -> list[tuple[int, int, float, float]]:
    return significant(_hits(words, lexicon), len(words), model)


def strength(kept: list[tuple[int, int, float, float]]) -> float:
    """The passages' reduced variates, summed: 0 without one, else above 0."""
    return -sum(math.log(e) for *_, e in kept)


def probability(kept: list[tuple[int, int, float, float]], model: ToxicModel) -> float:
    if not kept:
        return model.base
    return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, model.slope * strength(kept) + model.shift))))


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """HASHES minimum hashes of each text's shingles (fewer words: of all of them)."""
    for batch in batches:
        keys = []
        for text in batch["text"]:
            words = tokens(text)
            grams = {" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}
            keys.append([min(xxhash.xxh64_intdigest(g, k) for g in grams) - (1 << 63) for k in range(HASHES)])
        out = batch[["doc_id", "label", "text"]].copy()
        for k in range(HASHES):
            out[f"k{k}"] = [x[k] for x in keys]
        yield out


def one_of_each(sample: DataFrame) -> DataFrame:
    """The bounded sample without the documents that share a minimum hash with one of a smaller id."""
    keys = ", ".join(f"k{k} long" for k in range(HASHES))
    rows = materialize(sample.mapInPandas(_signatures, f"doc_id long, label int, text string, {keys}"), "toxic-signatures")
    long = rows.select("doc_id", F.posexplode(F.array(*(f"k{k}" for k in range(HASHES)))).alias("which", "hash"))
    firsts = long.groupBy("which", "hash").agg(F.min("doc_id").alias("first"))
    copies = long.join(firsts, ["which", "hash"]).where("doc_id > first").select("doc_id").distinct()
    return rows.select("doc_id", "label", "text").join(copies, "doc_id", "left_anti")


def _count_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each token, by label: the documents that hold it, and their weights 1 + ln(occurrences)."""
    for batch in batches:
        held: tuple[Counter, Counter] = (Counter(), Counter())
        weighed: tuple[Counter, Counter] = (Counter(), Counter())
        for text, label in zip(batch["text"], batch["label"], strict=True):
            found = Counter()
            for word, n in Counter(tokens(text)).items():
                for token in features(word):
                    found[token] += n
            held[label].update(found.keys())
            for token, n in found.items():
                weighed[label][token] += round(WEIGHT * (1.0 + math.log(n)))
        words = list(held[0].keys() | held[1].keys())
        columns = [[x[w] for w in words] for x in (*held, *weighed)]
        yield pd.DataFrame(dict(zip(("token", "clean", "toxic", "clean_w", "toxic_w"), (words, *columns), strict=True)))


def _log_odds(sample: DataFrame, docs_by_label: dict[int, int]) -> dict[str, float]:
    """Significant toxic tokens and their log-odds."""
    n0, n1 = float(docs_by_label.get(0, 0)), float(docs_by_label.get(1, 0))
    if not n0 or not n1:
        return {}
    rho = n1 / (n0 + n1)
    counts = materialize(
        sample.select("text", "label")
        .mapInPandas(_count_tokens, "token string, clean long, toxic long, clean_w long, toxic_w long")
        .groupBy("token")
        .agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"), (F.sum("clean_w") / WEIGHT).alias("cw"), (F.sum("toxic_w") / WEIGHT).alias("tw")),
        "toxic-counts",
    )
    words = counts.agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.when(~F.col("token").endswith("*"), F.col(x))).alias(x) for x in ("cw", "tw"))).first()
    least = math.log(max(2, words["n"])) + EVIDENCE
    t, c, tw, cw = map(F.col, ("t", "c", "tw", "cw"))
    prior = PRIOR_LEAST + PRIOR_SHARE * (tw + cw)
    delta = F.log((tw + prior * rho) / (F.lit(words["tw"] or 0.0) + 1.0)) - F.log((cw + prior * (1 - rho)) / (F.lit(words["cw"] or 0.0) + 1.0))
    part = lambda x, share: F.when(x > 0, x * F.log(x / ((t + c) * share))).otherwise(0.0)
    listed = (
        counts.where((t >= 2) & (t > rho * (t + c)))
        .select("token", delta.alias("d"), (part(t, rho) + part(c, 1 - rho)).alias("g"))
        .where((F.col("g") >= least) & (F.col("d") >= LEAST_ODDS))
        .orderBy(F.desc("g"), "token")
        .limit(MAX_LISTED)
    )
    return {r["token"]: float(r["d"]) for r in listed.collect()}


def _logistic(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted one-variable logistic fit with a weak pull to slope 1."""
    mid = float(np.average(z, weights=w)) if len(z) else 0.0
    a, b = 1.0, -mid
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -500, 500)))
        g = np.array([np.sum(w * (p - y) * z) + (a - 1.0), np.sum(w * (p - y)) + 1e-3 * (b + mid)])
        s = w * p * (1 - p)
        h = np.array([[np.sum(s * z * z) + 1.0, np.sum(s * z)], [np.sum(s * z), np.sum(s) + 1e-3]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return max(a, 0.05), b


def _find(scores: dict[str, float]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(scores)
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"], batch["label"], strict=True):
                words = tokens(text)
                hits = _hits(words, lexicon)
                rows.append((label, len(words), [i for i, _ in hits], [s for _, s in hits]))
            yield pd.DataFrame(rows, columns=["label", "n", "at", "hit"])

    return run


def _tails(other: float, least: float, most: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For each text its segments that score ``least`` or more, those of them below ``most``, and what all have above ``least``, up to ``most``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for at, hit in zip(batch["at"], batch["hit"], strict=True):
                over = [s for *_, s in segments(list(zip(at, hit, strict=True)), other) if s >= least]
                rows.append((len(over), sum(s < most for s in over), math.fsum(min(s, most) - least for s in over)))
            yield pd.DataFrame(rows, columns=["over", "below", "excess"])

    return run


def _strengths(model: ToxicModel) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = zip(batch["n"], batch["at"], batch["hit"], strict=True)
            z = [strength(significant(list(zip(at, hit, strict=True)), n, model)) for n, at, hit in found]
            yield pd.DataFrame({"label": batch["label"], "z": z})

    return run


def fit(docs: DataFrame, labels: DataFrame, per_class: int = MAX_PER_CLASS) -> ToxicModel:
    """Learn from at most ``per_class`` documents of each class outside the held-out fold."""
    rows, sizes = labelled_sample(docs, labels, "toxic", per_class)
    sample = materialize(one_of_each(rows), "toxic-sample")
    got = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    scores = _log_odds(sample, got)
    model = ToxicModel(scores)
    if not scores:
        return model
    found = materialize(sample.select("text", "label").mapInPandas(_find(scores), "label int, n long, at array<int>, hit array<double>"), "toxic-hits")
    gain = F.aggregate("hit", F.lit(0.0), lambda a, x: a + x)
    with_hits = F.when(F.size("at") > 0, F.col("n"))
    sums = found.groupBy("label").agg(F.sum("n").alias("n"), F.sum(with_hits).alias("with_hits"), F.sum(F.size("at")).alias("hits"), F.sum(gain).alias("gain"))
    seen = {r["label"]: r for r in sums.collect()}
    rate = lambda hits, words: ((hits or 0) + 0.5) / ((words or 0) + 1.0)
    in_toxic, in_clean = rate(seen[1]["hits"], seen[1]["with_hits"]), rate(seen[0]["hits"], seen[0]["n"])
    # A token that isn't listed is this much rarer inside a toxic passage than outside. It
    # takes more than chance hits give, or a clean text's segments would grow with its length.
    drift = 2.0 * seen[0]["gain"] / max(1, seen[0]["n"])
    model.other = min(-1e-4, math.log((1 - min(0.5, in_toxic)) / (1 - min(0.4, in_clean))), -drift)
    # Clean documents' segments reach a score x in K * n * exp(-lambda * x) cases: lambda and K
    # by maximum likelihood. Segments above two best hits count as at least that, so that a
    # mislabelled text can't set lambda; listed scores are log-likelihood ratios, for which it is 1 at most.
    least, most = min(scores.values()), 2.0 * max(scores.values())
    tails = found.where("label = 0").mapInPandas(_tails(model.other, least, most), "over long, below long, excess double")
    tail = tails.toPandas()  # of at most per_class documents
    model.lam = min(1.0, (int(tail["below"].sum()) + 1.0) / (math.fsum(tail["excess"]) + 1.0))
    model.k = float((tail["over"].sum() + 0.5) / (max(1.0, seen[0]["n"]) * math.exp(-model.lam * least)))
    measured = found.mapInPandas(_strengths(model), "label int, z double").toPandas()  # at most 2 * per_class rows
    toxic, z = (measured["label"] == 1).to_numpy(), measured["z"].to_numpy()
    weight = np.array([sizes.get(v, 0) / max(1, got.get(v, 0)) for v in (0, 1)])[measured["label"].to_numpy()]
    some = z > 0
    none = ~some
    model.base = min(0.45, float(weight[none & toxic].sum() / max(1.0, weight[none].sum())))
    if some.any():
        model.slope, model.shift = _logistic(z[some], toxic[some].astype(float), weight[some])
    return model


PASSAGE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e", pa.float64())])
SCORED = "doc_id long, score double, predicted int, passages array<struct<start:int,end:int,score:double,e:double>>"


def _scorer(model: ToxicModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.scores)
        for batch in batches:
            scores, spans = [], []
            for text in batch.column("text").to_pylist():
                words = tokens(text)
                kept = passages(words, model, lexicon)
                scores.append(probability(kept, model))
                if kept:  # offsets only where there is a passage: into the lower-cased text
                    at = [m.span() for m in TOKEN.finditer(text.lower())]
                    spans.append([{"start": at[a][0], "end": at[b][1], "score": s, "e": e} for a, b, s, e in kept])
                else:
                    spans.append([])
            predicted = pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), predicted, pa.array(spans, pa.list_(PASSAGE))],
                names=["doc_id", "score", "predicted", "passages"],
            )

    return run


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, score, predicted and passages of every document (offsets in the lower-cased text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_scorer(model), SCORED)


def _clean_rows(model: ToxicModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.scores)
        for batch in batches:
            keep = []
            for text in batch.column("text").to_pylist():
                keep.append(probability(passages(tokens(text or ""), model, lexicon), model) < THRESHOLD)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def drop_toxic(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    return docs.mapInArrow(_clean_rows(model), docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))
