"""Approximate nearest neighbours by shifted Hilbert curves."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

K = 5
#: Orderings, projected dimensions and bits for each of them; a key has DIMS x BITS bits.
CURVES, DIMS, BITS = 12, 12, 5
#: Orderings that are used at least: a single one parts some neighbours however near they are.
LEAST_CURVES = 3
#: Entries that one task holds of an ordering, and queries that it holds against them; more of either are dealt to more tasks.
CHUNK, ASKED = 4096, 4096
#: Windows are as wide as it takes for RECALL of the true neighbours of PROBES sampled queries, which brute force finds.
RECALL, PROBES = 0.96, 64
#: Queries that one product of matrices takes.
ROWS = 256
#: Cosines count as equal where they round to the same multiple of 1 / TICKS.
TICKS = float(1 << 43)
#: Rows that the projections are fitted on.
SAMPLE = 4000
#: Rows of one ordering that one task is meant to rank.
RUN = 1 << 14


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points (n, dims) with coordinates of so many bits, as big-endian bytes.

    Skilling's transform of coordinates (AIP Conf. Proc. 707, 2004), whole columns at a time.
    """
    x = cells.astype(np.uint32).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint32(q - 1)
        for i in range(dims):
            on = (x[i] & np.uint32(q)) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p).astype(np.uint32)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.uint32)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & np.uint32(q)) != 0, t ^ np.uint32(q - 1), t)
        q >>= 1
    x ^= t
    planes = [(x[i] >> np.uint32(b)) & 1 for b in range(bits - 1, -1, -1) for i in range(dims)]
    return np.packbits(np.array(planes, np.uint8).T, axis=1)


class Curves:
    """For each ordering a projection to DIMS dimensions, spread evenly over the cells of the curve's grid, and a shift.

    Odd orderings turn the sample's principal axes at random, even ones are wholly random; every one has its own shift.
    Coordinates go through the sample's own distribution, so that cells are filled alike.
    """

    def __init__(self, sample: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        dims = sample.shape[1]
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        _, _, axes = np.linalg.svd(unit - unit.mean(axis=0), full_matrices=True)
        self.projections, self.edges, self.shifts = [], [], rng.random((CURVES, DIMS))
        for n in range(CURVES):
            if n % 2:
                lead = axes[: min(dims, 2 * DIMS)]
                turn, _ = np.linalg.qr(rng.normal(size=(len(lead), len(lead))))
                p = (turn @ lead)[:DIMS]
            else:
                p = np.linalg.qr(rng.normal(size=(dims, dims)))[0][:DIMS]
            if len(p) < DIMS:
                p = np.vstack([p, rng.normal(size=(DIMS - len(p), dims)) / np.sqrt(dims)])
            self.projections.append(p.T)
            self.edges.append(np.quantile(unit @ p.T, np.linspace(0, 1, 257), axis=0))

    def keys(self, vectors: np.ndarray, n: int) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        y = unit @ self.projections[n]
        place = np.stack([np.interp(y[:, i], self.edges[n][:, i], np.linspace(0, 1, 257)) for i in range(DIMS)], axis=1)
        top = (1 << BITS) - 1
        cells = np.minimum(top, ((place + self.shifts[n]) * ((1 << BITS) / 2)).astype(np.int64))
        return hilbert_keys(cells, BITS)


def usable(vec_col: str) -> Column:
    v = F.col(vec_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of rows, component after component as the SQL expression adds them, so that both round alike."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def closest(a: np.ndarray, b: np.ndarray, ids: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, id of a row of b, cosine) of the nearest `keep` rows of b for each row of a; ties go to smaller ids.

    The product of matrices only rules out: whatever may round to the last place that counts is
    scored again component by component, and ordered by that score and the id.
    """
    s = (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)[None, :]
    keep = min(len(b), keep)
    least = np.partition(s, len(b) - keep, axis=1)[:, len(b) - keep]
    row, col = np.nonzero(s >= least[:, None] - 1e-9)
    long_a, long_b = np.sqrt(fold(a, a)), np.sqrt(fold(b, b))
    exact = np.concatenate([fold(a[row[at : at + CHUNK]], b[col[at : at + CHUNK]]) for at in range(0, len(row), CHUNK)]) / (long_a[row] * long_b[col])
    order = np.lexsort((ids[col], -np.floor(exact * TICKS + 0.5), row))
    row, col, exact = row[order], col[order], exact[order]
    first = np.searchsorted(row, row)
    best = np.arange(len(row)) - first < keep
    return row[best], ids[col[best]], exact[best]


def some(rows: DataFrame, wanted: int, n: int) -> DataFrame:
    """About `wanted` of n rows, drawn by a hash of the entry; each partition gives its share alone."""
    drawn = F.pmod(F.xxhash64("entry"), F.lit(1 << 30)) < math.ceil((1 << 30) * min(1.0, wanted / max(1, n)))
    return rows.where(drawn | (F.lit(n <= wanted)))


def windows(entries: DataFrame, ranks: DataFrame, queries: DataFrame, k: int, n: int) -> tuple[int, int]:
    """(orderings, places on either side) that cost least of those by which RECALL of the probes' true neighbours are met.

    Few orderings need wide windows and all of them narrow ones. With vectors that follow no fewer dimensions than they
    have, even all need most of the table, and the fewest cost least.
    """
    probes = some(queries, PROBES, queries.count()).join(entries, "entry").select("entry", "v").collect()
    if not probes or n <= CHUNK:
        return LEAST_CURVES, n
    own, a = np.array([r["entry"] for r in probes]), np.array([r["v"] for r in probes], np.float64)

    def brute(batches):
        for batch in batches:
            if len(batch):
                row, entry, near = closest(a, matrix(batch["v"]), batch["entry"].to_numpy(), k + 1)
                yield pd.DataFrame({"q": own[row], "entry": entry, "near": near})

    order = W.partitionBy("q").orderBy(F.desc("near"), "entry")
    found = entries.select("entry", "v").mapInPandas(brute, "q long, entry long, near double").where("q <> entry")
    true = [(r[0], r[1]) for r in found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).select("q", "entry").collect()]
    wanted = sorted({x for pair in true for x in pair} | set(own.tolist()))
    table = entries.sparkSession.createDataFrame([(x,) for x in wanted], "entry long")
    places = {(r["entry"], r["curve"]): r["place"] for r in ranks.join(F.broadcast(table), "entry").collect()}
    apart = np.array([[abs(places[q, c] - places[e, c]) for c in range(CURVES)] for q, e in true] or [[0] * CURVES])
    reach = np.sort(np.minimum.accumulate(apart, axis=1), axis=0)[math.ceil(RECALL * len(apart)) - 1]
    cost = (np.arange(CURVES) + 1) * np.minimum(n, 2 * reach + CHUNK)
    best = LEAST_CURVES - 1 + int(cost[LEAST_CURVES - 1 :].argmin())
    return best + 1, int(reach[best])


def nearest(vectors: DataFrame, every: int = 50, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by every, by cosine.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do null ids. Shorter vectors count as
    if zeros followed. Ties go to smaller ids, however many. Fewer candidates than k all return. A repeated id is
    a row like any other: each of its rows is a candidate, and each a query of its own.
    Equal vectors are one entry of the index, with their k + 1 smallest ids, and all their queries; so a vector that
    many rows share fills no windows.

    Each ordering ranks the entries along its Hilbert keys, by a range partitioning and counts by partition. A query
    meets the entries some places before and after its own, in chunks of CHUNK entries; a chunk's matrix
    gives cosines, and the best over all chunks and orderings are merged. However wide the windows and however many the
    queries, a task holds one chunk and ASKED queries. How many orderings and how wide a window the
    wanted recall takes is measured on a few queries, and depends on how far the vectors follow fewer dimensions than they have.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(id_col).isNotNull() & usable(vec_col)).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    wide = rows.agg(F.max(F.size("v"))).first()[0]
    if wide is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fill = F.array_repeat(F.lit(0), F.lit(wide) - F.size("v")).cast(rows.schema["v"].dataType)
    rows = rows.select("id", F.when(F.size("v") < wide, F.concat("v", fill)).otherwise(F.col("v")).alias("v"))
    own = rows.groupBy("v").agg(F.min("id").alias("low"))
    smallest = W.partitionBy("v").orderBy("id")
    few = rows.withColumn("_r", F.row_number().over(smallest)).where(F.col("_r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    # Entries are numbered in the order of their smallest ids, which vectors of a repeated id may share.
    numbered = own.join(few, "v").repartitionByRange("low", "v").sortWithinPartitions("low", "v")
    entries = written(numbered.select(F.monotonically_increasing_id().alias("entry"), "v", "ids"), "ann-entries")
    asked = rows.where(F.col("id") % every == 0).groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies")).join(entries.select("v", "entry"), "v").select(F.col("id").alias("query_id"), "entry", "copies")
    n = entries.count()
    sample = some(entries, SAMPLE, n).select("v").toPandas()["v"]
    curves = spark.sparkContext.broadcast(Curves(matrix(sample)))

    def keyed(batches):
        for batch in batches:
            if len(batch):
                v = matrix(batch["v"])
                for c in range(CURVES):
                    yield pd.DataFrame({"curve": np.int32(c), "key": [x.tobytes() for x in curves.value.keys(v, c)], "entry": batch["entry"]})

    keys = entries.select("entry", "v").mapInPandas(keyed, "curve int, key binary, entry long")
    parts = max(1, -(-n * CURVES // RUN))
    ranked = written(keys.repartitionByRange(parts, "curve", "key", "entry").withColumn("part", F.spark_partition_id()), "ann-keys")
    before = ranked.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.sum("_n").over(W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n"))
    place = F.row_number().over(W.partitionBy("curve", "part").orderBy("key", "entry")) - 1
    ranks = written(ranked.withColumn("_p", place).join(before, ["curve", "part"]).select("curve", "entry", (F.col("_p") + F.col("_before")).alias("place")), "ann-ranks")
    queries = written(asked.select("entry").distinct(), "ann-queries")
    used, reach = windows(entries, ranks, queries, k, n)
    meeting = queries.count() * min(1.0, (2 * reach + CHUNK) / n)
    turns = max(1, math.ceil(meeting / ASKED))
    vecs = entries.select("entry", "v")
    chunks = ranks.where(F.col("curve") < used).withColumn("chunk", F.floor(F.col("place") / CHUNK))
    first, last = F.floor(F.greatest(F.col("place") - reach, F.lit(0)) / CHUNK), F.floor(F.least(F.col("place") + reach, F.lit(n - 1)) / CHUNK)
    seen = chunks.join(queries, "entry").select(F.col("entry").alias("q"), "curve", F.explode(F.sequence(first, last)).alias("chunk"), F.pmod(F.xxhash64("entry"), F.lit(turns)).alias("turn"))
    left = seen.join(vecs, seen["q"] == vecs["entry"]).select("curve", "chunk", "turn", "q", "v")
    right = chunks.join(vecs, "entry").select(F.col("curve").alias("c"), F.col("chunk").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))).alias("s"), "entry", F.col("v").alias("w"))

    def rerank(q: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"q": np.zeros(0, np.int64), "entry": np.zeros(0, np.int64), "near": np.zeros(0)})]
        if len(q) and len(e):
            ids, them = e["entry"].to_numpy(), matrix(e["w"])
            for at in range(0, len(q), ROWS):
                some = q.iloc[at : at + ROWS]
                row, entry, near = closest(matrix(some["v"]), them, ids, k + 1)
                out.append(pd.DataFrame({"q": some["q"].to_numpy()[row], "entry": entry, "near": near}))
        return pd.concat(out)

    pairs = left.groupBy("curve", "chunk", "turn").cogroup(right.groupBy("c", "b", "s")).applyInPandas(rerank, "q long, entry long, near double").groupBy("q", "entry").agg(F.max("near").alias("near"))
    ticks = lambda c: F.floor(c * F.lit(TICKS) + F.lit(0.5))
    order = W.partitionBy("q").orderBy(F.desc(ticks(F.col("near"))), "entry")
    top = pairs.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1)
    qv, ev = entries.select(F.col("entry").alias("q"), F.col("v").alias("a")), entries.select("entry", F.col("v").alias("b"), "ids")
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda s, t: s.cast("double") * t.cast("double")), F.lit(0.0), lambda s, t: s + t)
    scored = top.join(qv, "q").join(ev, "entry").withColumn("score", dot(F.col("a"), F.col("b")) / (F.sqrt(dot(F.col("a"), F.col("a"))) * F.sqrt(dot(F.col("b"), F.col("b")))))
    hits = asked.join(scored.select("q", "score", F.col("entry").alias("e"), "ids"), F.col("entry") == F.col("q"))
    # Of the query's own vector one occurrence of its id is the query itself.
    at = F.when(F.col("e") == F.col("q"), F.array_position("ids", F.col("query_id"))).otherwise(F.lit(0))
    others = hits.withColumn("_self", at).select("query_id", "q", "copies", "score", "_self", F.posexplode("ids").alias("_at", "vec_id")).where("_at + 1 <> _self")
    rank = F.row_number().over(W.partitionBy("query_id", "q").orderBy(F.desc(ticks(F.col("score"))), "vec_id"))
    best = others.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")
