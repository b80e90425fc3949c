"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod
from .words import NON_LETTERS, word_hashes

DIM = 1 << 20
#: Besides whole words, terms are the first so many bytes of longer words: stems that take many endings.
PREFIXES = (4, 5, 6)
FACTORS = 8
#: Labelled rows that are fitted on, for each label.
SAMPLE = 2500
#: Terms of the model: in so many sampled texts, so many standard errors apart between the labels, at most so many.
LEAST_TEXTS, LEAST_Z, MOST_TERMS = 5, 2.5, 4096
EPOCHS, BATCH, RATE, DECAY = 30, 256, 0.1, 1e-3
FOLDS, HELD_OUT = 5, 0
CALIBRATE = 5


def term_lists(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, hashed term), repeats included, of the words of letters in lower case, and their prefixes."""
    data = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    for owner, h in word_hashes(data, NON_LETTERS, PREFIXES):
        yield owner, (h >> np.uint64(44)).astype(np.int64)


class ToxicityModel:
    """score = sigmoid(bias + sum of weights + pairwise products of factors) over a text's distinct terms."""

    def __init__(self, terms: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.terms, self.bias, self.weights, self.factors = terms, bias, weights, factors
        self._place: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_place": None}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self._place is None:
            self._place = np.full(DIM, -1, np.int32)
            self._place[self.terms] = np.arange(len(self.terms))
        pairs = [np.zeros(0, np.int64)]
        wide = max(1, len(self.terms))
        for owner, term in term_lists(texts):
            place = self._place[term]
            pairs.append(np.unique(owner[place >= 0] * wide + place[place >= 0]))
        both = np.unique(np.concatenate(pairs))
        return 1 / (1 + np.exp(-margins(both // wide, both % wide, len(texts), self.bias, self.weights, self.factors)))


def margins(row: np.ndarray, term: np.ndarray, n: int, bias: float, weights: np.ndarray, factors: np.ndarray) -> np.ndarray:
    out = bias + np.bincount(row, weights[term], n)
    for f in factors.T:
        v = f[term]
        out += 0.5 * (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n))
    return np.clip(out, -30, 30)


def fit_machine(rows: list[np.ndarray], y: np.ndarray, share: float) -> ToxicityModel:
    """rows: distinct terms of each sampled text. share: how many of all labelled rows are toxic, which the
    sample's own share is corrected to."""
    n, ones = len(rows), int(y.sum())
    every = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    if not 0 < ones < n:
        return ToxicityModel(np.zeros(0, np.int64), 30.0 if ones else -30.0, np.zeros(0), np.zeros((0, FACTORS)))
    by_row = np.repeat(np.arange(n), [len(r) for r in rows])
    has, has_1 = np.bincount(every, minlength=DIM), np.bincount(every[y[by_row] == 1], minlength=DIM)
    p, p1, p0 = has / n, has_1 / ones, (has - has_1) / (n - ones)
    z = np.abs(p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / ones + 1 / (n - ones)))
    z[has < LEAST_TEXTS] = 0
    terms = np.sort(np.argsort(-z, kind="stable")[: min(MOST_TERMS, int((z >= LEAST_Z).sum()))])
    place = np.full(DIM, -1)
    place[terms] = np.arange(len(terms))
    own = [place[r][place[r] >= 0] for r in rows]
    rng = np.random.default_rng(7)
    bias, w, v = 0.0, np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), FACTORS))
    gb, gw, gv = 1.0, np.ones(len(terms)), np.ones((len(terms), FACTORS))
    learn = np.array([i for i in range(n) if i % CALIBRATE != CALIBRATE - 1])
    for _ in range(EPOCHS):
        order = rng.permutation(learn)
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            row = np.repeat(np.arange(len(batch)), [len(own[i]) for i in batch])
            term = np.concatenate([own[i] for i in batch]).astype(np.int64)
            g = 1 / (1 + np.exp(-margins(row, term, len(batch), bias, w, v))) - y[batch]
            g /= len(batch)
            sums = np.zeros((len(batch), FACTORS))
            np.add.at(sums, row, v[term])
            d_w = np.bincount(term, g[row], len(terms)) + DECAY * w / len(batch)
            d_v = np.zeros_like(v)
            np.add.at(d_v, term, g[row][:, None] * (sums[row] - v[term]))
            d_v += DECAY * v / len(batch)
            gb, gw, gv = gb * 0.99 + g.sum() ** 2, gw * 0.99 + d_w**2, gv * 0.99 + d_v**2
            bias -= RATE * g.sum() / np.sqrt(gb) * 5
            w -= RATE * d_w / np.sqrt(gw + 1e-8) * 10
            v -= RATE * d_v / np.sqrt(gv + 1e-8) * 10
    odds = lambda s: np.log(max(s, 1e-6) / max(1 - s, 1e-6))
    return ToxicityModel(terms, bias + odds(share) - odds(ones / n), w, v)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Learns from labels outside the held-out fold, at most about SAMPLE rows of each label, drawn by a digest of the id.

    An id with several labels is toxic if one of them says so. The sampled ids, at most a few thousand, are
    sent to the scan of the documents, so texts aren't shuffled.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (crc_mod(id_col, FOLDS) != HELD_OUT)).groupBy(F.col(id_col).alias("_k")).agg(F.max(label_col).cast("int").alias("_y"))
    n = {r[0]: r[1] for r in known.groupBy("_y").count().collect()}
    draw = F.conv(F.substring(F.md5(F.col("_k").cast("string")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    wanted = draw < F.when(F.col("_y") == 1, F.lit(min(1.0, SAMPLE / max(1, n.get(1, 0))))).otherwise(F.lit(min(1.0, SAMPLE / max(1, n.get(0, 0)))))

    @F.pandas_udf("array<int>")
    def terms(texts: pd.Series) -> pd.Series:
        found: list[list[np.ndarray]] = [[] for _ in texts]
        for owner, term in term_lists(list(texts)):
            for i in np.unique(owner):
                found[i].append(np.unique(term[owner == i]))
        return pd.Series([np.unique(np.concatenate(x)).astype(np.int32) if x else np.zeros(0, np.int32) for x in found])

    sample = docs.select(F.col(id_col), F.col(text_col)).join(F.broadcast(known.where(wanted)), F.col(id_col) == F.col("_k")).select("_k", "_y", terms(F.col(text_col)).alias("terms"))
    rows = sorted(sample.collect(), key=lambda r: (str(r["_k"]), r["terms"]))
    return fit_machine([np.array(r["terms"], np.int64) for r in rows], np.array([r["_y"] for r in rows], np.int64), n.get(1, 0) / max(1, sum(n.values())))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Scores come from the whole text alone. Null and empty texts have no terms and get the bias's score, as does a text
    of unknown terms. Without labels of both kinds every score is near the one that there is, or 0. Repeated
    rows each return. The model broadcast is at most MOST_TERMS x (FACTORS + 2) numbers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col))

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield pd.Series(own.scores(list(texts)), dtype=float)

    held = F.coalesce(crc_mod(id_col, FOLDS) == HELD_OUT, F.lit(False))
    return docs.select(F.col(id_col), held.alias("held_out"), toxic(F.col(text_col)).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
