"""Quality classifier from trusted positives and unlabelled text (positive-unlabelled learning).

``measure`` turns each whole text into the figures in ``FIGURES``. ``train`` fits
a logistic model over binned figures by minimising the non-negative unbiased risk

    pi * R_P(+) + max(0, R_U(-) - pi * R_P(-))

with P the trusted positives, U the unlabelled texts and pi the share of
positives in U. Negative labels are never looked at. pi is estimated over *all*
rows learnt from: a first model that tells P from U ranks the texts, and
pi <= U(score >= t) / P(score >= t) holds for every t, so the least ratio, with a
margin for chance, is taken.

The fit itself uses at most ``FIT_ROWS`` rows of P and as many of U, chosen by a
hash of the key.

Defined results: a NULL or empty text has figures of zero and gets a score like
any other; a NULL key is scored, never learnt from, and counts as not held out;
repeated rows are scored alike, a key with contradicting labels is no positive;
without any positive row every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded, crc_mod, discard, scan, stored

FIT_ROWS = 8_000
BINS = 8
PRIOR_BINS = 200

PUNCTUATION = string.punctuation.encode()
NAMES = (
    "log_words", "word_length", "distinct_words", "repeated_neighbours", "short_words", "long_words", "upper",
    "digits", "non_ascii", "white_space", "lines_per_word", "repeated_lines", "other_bytes",
)
FIGURES = len(NAMES) + len(PUNCTUATION)

_UPPER, _LOWER, _DIGIT = (np.frombuffer(x.encode(), np.uint8) for x in (string.ascii_uppercase, string.ascii_lowercase, string.digits))
_SPACE = np.frombuffer(b" \t\n\v\f\r", np.uint8)
_PUNCTUATION = np.frombuffer(PUNCTUATION, np.uint8)


def figures(raw: bytes) -> np.ndarray:
    """The figures of one text, all in proportion to its length but the first."""
    out = np.zeros(FIGURES, np.float32)
    words = raw.split()
    if not words:
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, size = len(words), len(raw)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    upper, lower = int(counts[_UPPER].sum()), int(counts[_LOWER].sum())
    out[: len(NAMES)] = (
        np.log1p(n),
        lengths.mean(),
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        (lengths <= 3).mean(),
        (lengths >= 12).mean(),
        upper / max(1, upper + lower),
        counts[_DIGIT].sum() / size,
        counts[128:].sum() / size,
        counts[_SPACE].sum() / size,
        counts[10] / n,
        1 - len(set(lines)) / max(1, len(lines)),
        counts[:9].sum() / size,
    )
    out[len(NAMES) :] = counts[_PUNCTUATION] / n
    return out


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the figures of every whole text."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("raw"))

    def run(batches):
        for batch in batches:
            yield {"key": batch.column(0), "figures": [figures(x or b"").tolist() for x in batch.column(1).to_pylist()]}

    return scan(rows, f"key {kind}, figures array<float>", run)


@dataclass(frozen=True)
class Model:
    """Bin edges of each figure, one weight for each bin, and a bias."""

    edges: np.ndarray
    weights: np.ndarray
    bias: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for j in range(x.shape[1]):
            out += self.weights[j][np.searchsorted(self.edges[j], x[:, j], side="left")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def bin_edges(x: np.ndarray) -> np.ndarray:
    """Quantiles of the values of each figure that are not zero; zero has a bin of its own."""
    edges = np.zeros((x.shape[1], BINS - 1), np.float32)
    for j, column in enumerate(x.T):
        some = column[column > 0]
        if len(some):
            edges[j, 1:] = np.quantile(some, np.linspace(0, 1, BINS)[1:-1])
    return edges


def _one_hot(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    bins = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(x.shape[1])], 1)
    out = np.zeros((len(x), x.shape[1] * BINS), np.float32)
    out[np.arange(len(x))[:, None], bins + np.arange(x.shape[1]) * BINS] = 1
    return out


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int = 200) -> Model:
    """Minimise the non-negative risk; without a prior, tell the two sets apart by plain logistic loss."""
    edges = bin_edges(np.concatenate([positive, unlabelled]))
    p, u = _one_hot(positive, edges), _one_hot(unlabelled, edges)
    w, m, v = (np.zeros(p.shape[1] + 1) for _ in range(3))
    shrink = min(1e-2, 2 / max(1, len(p)))  # few positives: keep to what they show clearly
    for step in range(1, steps + 1):
        zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        sp, su = (1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (zp, zu))
        # gradients of the mean logistic losses by the logit
        gp_pos, gp_neg, gu_neg = (sp - 1) / len(sp), sp / len(sp), su / len(su)
        if prior is None:
            gp, gu = gp_pos, gu_neg
        else:
            negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if negative_risk >= 0:
                gp, gu = prior * (gp_pos - gp_neg), gu_neg
            else:  # the estimate fell below any possible risk: step back out of it
                gp, gu = prior * gp_neg, -gu_neg
        gradient = np.concatenate([p.T @ gp + u.T @ gu, [gp.sum() + gu.sum()]])
        gradient[:-1] += shrink * w[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(edges, w[:-1].reshape(-1, BINS), float(w[-1]))


def score_rows(measured: DataFrame, model: Model | None) -> DataFrame:
    """Scores of measured rows; all 0.5 without a model."""
    kind = measured.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            x = batch.column("figures").flatten().to_numpy(zero_copy_only=False).reshape(n, FIGURES)
            rest = {name: batch.column(name) for name in batch.schema.names if name != "figures"}
            yield rest | {"score": model.scores(x) if model else np.full(n, 0.5)}

    others = [f"{f.name} {f.dataType.simpleString()}" for f in measured.schema.fields if f.name not in ("key", "figures")]
    return scan(measured, ", ".join([f"key {kind}", *others, "score double"]), run)


def estimate_prior(ranked: DataFrame) -> float:
    """Share of positives among all rows, from ``positive`` and ``score`` of each."""
    bins = (
        ranked.groupBy(F.least(F.floor(F.col("score") * PRIOR_BINS), F.lit(PRIOR_BINS - 1)).alias("bin"))
        .agg(F.count("*").alias("u"), F.sum(F.col("positive").cast("long")).alias("p"))
        .collect()  # at most PRIOR_BINS rows
    )
    u, p = np.zeros(PRIOR_BINS), np.zeros(PRIOR_BINS)
    for row in bins:
        u[int(row.bin)], p[int(row.bin)] = row.u, row.p
    above_u, above_p = u[::-1].cumsum()[::-1], p[::-1].cumsum()[::-1]
    n_u, n_p = above_u[0], above_p[0]
    share_u, share_p = above_u / n_u, above_p / n_p
    enough = share_p >= 0.2
    chance = 0.5 * np.sqrt(np.log(4 * PRIOR_BINS) / 2) * (1 / np.sqrt(n_u) + 1 / np.sqrt(n_p))
    ratios = (share_u[enough] + chance * share_p[enough]) / share_p[enough]
    return float(np.clip(ratios.min(), 0.05, 0.98))


def train(measured: DataFrame, positives: DataFrame, learn: Column) -> tuple[Model | None, float]:
    """Fit on rows of ``measured`` for which ``learn`` holds; ``positives`` has their trusted ``key``s."""
    rows = measured.where(learn & F.col("key").isNotNull()).join(
        positives.select("key").distinct().withColumn("positive", F.lit(True)), "key", "left"
    )
    rows = rows.select("key", "figures", F.coalesce("positive", F.lit(False)).alias("positive"))
    totals = rows.agg(F.count("*").alias("u"), F.sum(F.col("positive").cast("long")).alias("p")).first()
    if not totals.p:
        return None, 0.5
    # U has the positives too, as the risk demands
    p = bounded(rows.where("positive"), F.col("key"), FIT_ROWS, totals.p)
    u = bounded(rows, F.col("key"), FIT_ROWS, totals.u)
    sample = [(r.kind, r.key, r.figures) for r in _kinds(p, u).collect()]  # about 2 * FIT_ROWS rows of FIGURES numbers
    sample.sort(key=lambda r: (r[0], str(r[1])))
    positive, unlabelled = (np.array([x for k, _, x in sample if k == kind], np.float32) for kind in ("p", "u"))
    first = fit(positive, unlabelled, None)
    prior = estimate_prior(score_rows(rows, first))
    return fit(positive, unlabelled, prior), prior


def _kinds(p: DataFrame, u: DataFrame) -> DataFrame:
    columns = ["key", "figures"]
    return p.select(F.lit("p").alias("kind"), *columns).union(u.select(F.lit("u").alias("kind"), *columns))


def score_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    held_out: Column | None = None,
) -> DataFrame:
    """``key``, ``held_out`` and ``score`` (likelihood of quality) of every row of ``docs``."""
    held = F.coalesce(held_out if held_out is not None else crc_mod(F.col("key"), 5) == 0, F.lit(False))
    measured = stored(measure(docs, key, text), "quality-figures")
    positives = (
        labels.groupBy(F.col(key).alias("key"))
        .agg(F.min(label).alias("least"))
        .where((F.col("least") == 1) & F.col("key").isNotNull())
    )
    model, _ = train(measured, positives, ~held)
    return score_rows(measured, model).select(F.col("key").alias(key), held.alias("held_out"), "score")
