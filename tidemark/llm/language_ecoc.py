"""Language identification by error-correcting output codes.

Each language gets a codeword; for each bit, a binary classifier over byte
trigrams tells the languages with a one from those with a zero. Its weights are
log ratios of trigram frequencies, counted by Spark over all rows learnt from
(one row of counts for each language and trigram bucket, so the driver gets
``languages * 2**BUCKET_BITS`` counts at most). The margins of a bounded sample
of labelled rows (``FIT_ROWS`` by a hash of the key) then centre and scale each
classifier and weigh its bit by how well it separates. Decoding takes the
codeword with the least weighted logistic loss; a text is ambiguous if the
runner-up is almost as near.

Defined results: ``und`` with score 0 for a text that is NULL or has no letter;
rows without a language or key are never learnt from; languages are those seen
in training, and without any every text is ``und``; ties go to the language that
sorts first; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded, crc_mod, scan

BUCKET_BITS = 15
FIT_ROWS = 4000
CHUNK = 1 << 20
AMBIGUOUS = 0.6
MOST_BITS = 31

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
# Letters of ASCII and all bytes of other characters stay, anything else is a space.
_SEPARATED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigrams(text: str):
    """Bucket numbers of the byte trigrams of a lower-case text, in chunks."""
    raw = np.frombuffer((" " + text.lower() + " ").encode().translate(_SEPARATED), np.uint8)
    for at in range(0, max(1, len(raw) - 2), CHUNK):
        part = raw[at : at + CHUNK + 2].astype(np.uint32)
        first, second, third = part[:-2], part[1:-1], part[2:]
        inside = (second != 32) | ((first != 32) & (third != 32))
        yield (((first << 16) | (second << 8) | third)[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)


def codewords(languages: int, seed: int = 11) -> np.ndarray:
    """A row of +1 and -1 for each language; columns split the languages and differ from each other.

    Up to five languages every split is a bit, beyond that MOST_BITS random
    balanced splits or twice the languages, if more.
    """
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= 5:
        splits = [[(n >> i) & 1 for i in range(languages)] for n in range(1, 2 ** (languages - 1))]
        return np.array(splits, np.int8).T * 2 - 1
    random, best = np.random.default_rng(seed), None
    for _ in range(50):  # keep the code whose nearest two codewords are farthest apart
        half = np.tile([1, -1], languages)[:languages]
        code = np.stack([random.permutation(half) for _ in range(max(MOST_BITS, 2 * languages))], 1)
        apart = min((code[i] != code[j]).sum() for i in range(languages) for j in range(i))
        if best is None or apart > best[0]:
            best = (apart, code)
    return best[1].astype(np.int8)


@dataclass(frozen=True)
class Codes:
    """Languages, their codewords, and for each bit the trigram weights, centre, scale and vote."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    vote: np.ndarray

    def margins(self, text: str) -> np.ndarray:
        """Mean weight of the text's trigrams for each bit."""
        total, n = np.zeros(self.code.shape[1]), 0
        for buckets in trigrams(text):
            seen = np.bincount(buckets, minlength=1)
            some = np.flatnonzero(seen)
            total += seen[some] @ self.weights[some]
            n += len(buckets)
        return total / max(1, n)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        z = (self.margins(text) - self.centre) / self.scale
        loss = np.logaddexp(0, -self.code * z) @ self.vote
        # the losses as log likelihoods of the codewords
        odds = np.exp(-(loss - loss.min()))
        best = int(loss.argmin())
        score = float(odds[best] / odds.sum())
        return self.languages[best], score, score < AMBIGUOUS


def count_trigrams(rows: DataFrame) -> DataFrame:
    """Trigram counts of each language over all rows: ``lang, bucket, n``."""

    def run(batches):
        size = 1 << BUCKET_BITS
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mine = totals.setdefault(lang, np.zeros(size, np.int64))
                for buckets in trigrams(text):
                    mine += np.bincount(buckets, minlength=size)
        for lang, mine in totals.items():
            some = np.flatnonzero(mine)
            yield {"lang": [lang] * len(some), "bucket": some, "n": mine[some]}

    counts = scan(rows.select("lang", "text"), "lang string, bucket long, n long", run)
    return counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(rows: DataFrame) -> Codes:
    """Learn from all ``key, text, lang`` rows, none of them NULL."""
    counts = count_trigrams(rows).toArrow().to_pandas()
    languages = tuple(sorted(counts["lang"].unique()))
    code = codewords(len(languages))
    bits = code.shape[1]
    table = np.zeros((len(languages), 1 << BUCKET_BITS))
    table[[languages.index(x) for x in counts["lang"]], counts["bucket"]] = counts["n"]
    table = (table + 0.5) / (table + 0.5).sum(1, keepdims=True) if languages else table
    weights = np.zeros((1 << BUCKET_BITS, bits))
    for b in range(bits if len(languages) > 1 else 0):
        weights[:, b] = np.log(table[code[:, b] > 0].mean(0)) - np.log(table[code[:, b] < 0].mean(0))
    blank = Codes(languages, code, weights, np.zeros(bits), np.ones(bits), np.ones(bits))
    if len(languages) < 2:
        return blank
    total = rows.count()
    sample = bounded(rows, F.col("key"), FIT_ROWS, total).select("lang", "text")

    def run(batches):
        for batch in batches:
            pairs = [(lang, blank.margins(t)) for lang, t in zip(*(c.to_pylist() for c in batch.columns)) if _LETTER.search(t)]
            if pairs:
                yield {"lang": [p[0] for p in pairs], "margins": [p[1] for p in pairs]}

    seen = scan(sample, "lang string, margins array<double>", run).collect()  # about FIT_ROWS rows of ``bits`` numbers
    if not seen:
        return blank
    x = np.array([r.margins for r in seen])
    y = code[[languages.index(r.lang) for r in seen]]
    centre, scale, vote = blank.centre.copy(), blank.scale.copy(), blank.vote.copy()
    for b in range(bits):
        ones, zeros = x[y[:, b] > 0, b], x[y[:, b] < 0, b]
        if len(ones) > 1 and len(zeros) > 1:
            centre[b] = (np.median(ones) + np.median(zeros)) / 2
            gap = max(1e-6, np.median(ones) - np.median(zeros))
            scale[b] = gap / 8
            right = ((x[:, b] - centre[b]) * y[:, b] > 0).mean()
            vote[b] = max(0.01, 2 * right - 1)
    return Codes(languages, code, weights, centre, scale, vote / vote.mean())


def identify(docs: DataFrame, codes: Codes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred``, ``score`` and ``ambiguous`` of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = [codes.predict(x) for x in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield {"key": batch.column(0), **dict(zip(("lang_pred", "score", "ambiguous"), map(list, columns)))}

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return scan(rows, f"key {kind}, lang_pred string, score double, ambiguous boolean", run).withColumnRenamed("key", key)


def learn_and_identify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", held_out: Column | None = None
) -> DataFrame:
    """Learn from the rows that are not held out, then identify all; adds ``held_out``."""
    held = F.coalesce(held_out if held_out is not None else crc_mod(F.col(key), 3) == 1, F.lit(False))
    rows = docs.where(~held & F.col(key).isNotNull() & F.col(lang).isNotNull() & F.col(text).isNotNull())
    codes = train(rows.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")))
    return identify(docs, codes, key, text).withColumn("held_out", held)
