"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, packed, released, slices

#: Hashed n-gram features, n from 1 to 3.
DIM = 1 << 13
#: Labelled rows that are fitted on: for each language, in all, and for each language whatever their number.
SAMPLE, SAMPLE_ALL, SAMPLE_LEAST = 600, 300_000, 20
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.05, 0.1
#: Every fifth sampled row sets the temperature instead of the weights.
CALIBRATE = 5
BLOCK = 1 << 18
FOLDS, HELD_OUT = 4, 2

_ALPHABET: list[np.ndarray] = []


def alphabet() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _ALPHABET:
        _ALPHABET.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _ALPHABET[0]


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed n-grams of the whole text in lower case, with one space for each run of non-letters; None without letters."""
    counts, seen, tail = np.zeros(DIM, np.int64), False, np.array([32], np.uint32)
    for at in range(0, len(text), BLOCK):
        points = np.frombuffer(text[at : at + BLOCK].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        letter = alphabet()[points]
        seen = seen or bool(letter.any())
        points = np.where(letter, points, np.uint32(32))
        before = np.r_[tail[-1] != 32, letter[:-1]]
        chars = np.r_[tail, points[letter | before]].astype(np.uint32)
        if at + BLOCK >= len(text):
            chars = np.r_[chars, np.uint32(32)] if chars[-1] != 32 else chars
        with np.errstate(over="ignore"):
            one = chars * np.uint32(0x9E3779B1)
            two = one[:-1] * np.uint32(31) + one[1:] + np.uint32(7)
            three = two[:-1] * np.uint32(31) + one[2:] + np.uint32(13)
        new = len(tail)
        for n, codes in ((1, one), (2, two), (3, three)):
            fresh = codes[max(0, new - n + 1) :] if at else codes
            counts += np.bincount((fresh * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 13), minlength=DIM)
        tail = chars[-2:]
    return counts if seen else None


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / max(1e-12, float(np.sqrt(x @ x)))


class LanguageModel:
    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.langs, self.idf, self.weights, self.temperature = langs, idf, weights.astype(np.float32), temperature
        self.idf = idf.astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text) if text else None
        if counts is None or not self.langs:
            return "und", 0.0
        logits = (tf_idf(counts.astype(np.float32), self.idf) @ self.weights).astype(np.float64) / self.temperature
        p = np.exp(logits - logits.max())
        best = int(p.argmax())
        return self.langs[best], float(p[best] / p.sum())


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: list[int], n_langs: int) -> np.ndarray:
    """Weights (DIM, n_langs) by follow-the-regularised-leader with elastic-net penalties, one sparse row at a time."""
    z, n = np.zeros((DIM, n_langs)), np.zeros((DIM, n_langs))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[at]) <= L1, 0.0, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for (at, x), k in zip(rows, y, strict=True):
            w = weights(at)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[k] -= 1
            g = x[:, None] * p[None, :]
            more = g * g
            z[at] += g - (np.sqrt(n[at] + more) - np.sqrt(n[at])) / ALPHA * w
            n[at] += more
    return weights(slice(None))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits that makes the held labels likeliest; labels count as sure but for one in n + 2."""
    slack = 1 / (len(y) + 2)
    best = (np.inf, 1.0)
    for t in np.geomspace(0.02, 10, 120):
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(s).sum(axis=1)) - (1 - slack) * s[np.arange(len(y)), y] - slack * s.mean(axis=1)))
        best = min(best, (loss, float(t)))
    return best[1]


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """How many of all texts with letters have each feature, and how many texts those are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for texts in slices(batch.column(0)):
                for text in texts:
                    if text and (counts := gram_counts(text)) is not None:
                        have += counts > 0
                        n += 1
        yield pa.RecordBatch.from_pydict({"feature": pa.array(np.r_[np.arange(DIM), -1], pa.int32()), "n": pa.array(np.r_[have, n], pa.int64())})
        released()

    sums = docs.select(F.col(text_col).alias("t")).mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    out, total = np.zeros(DIM), 0
    for feature, n in sums:
        if feature < 0:
            total = n
        else:
            out[feature] = n
    return out, total


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learns from rows outside the held-out fold that have text and lang: document frequencies from all of them,
    weights from at most about SAMPLE rows of each language, drawn by a digest of the id. Every language is learned; where
    there are over SAMPLE_ALL / SAMPLE of them, each has its even part of SAMPLE_ALL, and SAMPLE_LEAST rows at least."""
    train = docs.where((F.coalesce(crc_mod(id_col, FOLDS), F.lit(0)) != HELD_OUT) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in train.groupBy(F.col(lang_col).cast("string").alias("l")).count().collect()}
    langs = sorted(counts)
    if not langs:
        return LanguageModel([], np.zeros(DIM), np.zeros((DIM, 0)), 1.0)
    each = min(SAMPLE, max(SAMPLE_LEAST, SAMPLE_ALL // len(langs)))
    have, total = document_frequencies(train, text_col)
    idf = np.log((1 + total) / (1 + have)) + 0.1

    @F.pandas_udf("at array<int>, n array<int>")
    def features(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            c = gram_counts(text)
            at = np.zeros(0, np.int64) if c is None else np.flatnonzero(c)
            out.append((at.astype(np.int32), np.zeros(0, np.int32) if c is None else c[at].astype(np.int32)))
        return pd.DataFrame(out, columns=["at", "n"])

    draw = F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))])
    sample = train.where(draw < shares[F.col(lang_col).cast("string")]).select(F.col(lang_col).cast("string").alias("l"), F.md5(F.col(id_col).cast("string")).alias("o"), features(F.col(text_col)).alias("f"))
    rows, y, held, held_y = [], [], [], []
    place = {lang: n for n, lang in enumerate(langs)}
    for n, r in enumerate(sorted(sample.collect(), key=lambda r: (r["o"] or "", r["l"]))):
        if not r["f"]["at"]:
            continue
        at = np.array(r["f"]["at"])
        x = np.log1p(np.array(r["f"]["n"], float)) * idf[at]
        x /= max(1e-12, float(np.sqrt(x @ x)))
        first = n % CALIBRATE == CALIBRATE - 1
        (held if first else rows).append((at, x))
        (held_y if first else y).append(place[r["l"]])
    if not rows:
        return LanguageModel([], idf, np.zeros((DIM, 0)), 1.0)
    weights = ftrl(rows, y, len(langs))
    logits = np.array([x @ weights[at] for at, x in held or rows])
    return LanguageModel(langs, idf, weights, temperature(logits, np.array(held_y or y)))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """docs with a column lang_found: struct(lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for batch in batches:
            found = [own.predict(t) for texts in slices(batch) for t in texts]
            yield pa.StructArray.from_arrays([pa.array([r[0] for r in found], pa.string()), pa.array([r[1] for r in found], pa.float64())], ["lang_pred", "score"])
        released()

    return docs.withColumn("lang_found", language(F.col(text_col)))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score.

    A text that is null or without letters is `und` with score 0, as is every text when no row is labelled. Whole texts
    count, in blocks where very long. Only the text enters a prediction. Repeated rows each return; a null id
    belongs to the learning part. The model broadcast is DIM x languages numbers.
    """
    model = fit(docs, id_col, text_col, lang_col)
    held = F.coalesce(crc_mod(id_col, FOLDS) == HELD_OUT, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), held.alias("held_out"), F.col(text_col).alias("t"))
    return predict(rows, model, "t").select(F.col("id").alias(id_col), "held_out", "lang_found.lang_pred", "lang_found.score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least_lift: float = 1.2) -> DataFrame:
    """The rows of docs that have a language, with all their columns, whatever these are called.

    A text has one if its score is at least least_lift times that of a blind guess among the languages learned. Texts that are null
    or without letters go; without labelled rows no language is learned and all go. Repeated rows and null ids
    are kept or go by their text alone. An empty table gives an empty table.
    """
    model = fit(docs, id_col, text_col, lang_col)
    least = min(1.0, least_lift / max(1, len(model.langs)))
    found = predict(packed(docs, t=F.col(text_col)), model, "t")
    return found.where((F.col("lang_found.lang_pred") != "und") & (F.col("lang_found.score") >= least)).select("row.*")
