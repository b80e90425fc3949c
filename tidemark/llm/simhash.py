"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, one_of_each, released, slices, text_of, written
from .components import components

WORDS = 4
SEED = 42
BITS = 64
RADIUS = 4
#: Variants of fingerprints that one bucket is meant to hold; the number of buckets follows from it and the input.
BUCKET_VARIANTS = 1 << 20
#: Variants that a bucket holds in memory at once, some 30 MB with their order; a fuller one is worked through in passes over slices of the keys.
PASS_VARIANTS = 1 << 20
MOST_GROUPS = 24
BLOCK = 1 << 16


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the text's 4-word shingles, repeats included; 0 without words."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space matter
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= WORDS:
        h = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
        return int(h[0])
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n, counts = len(words) - WORDS + 1, np.zeros(BITS, np.int64)
    digest, seed = xxhash.xxh64_intdigest, SEED
    for at in range(0, n, BLOCK):
        to = min(n, at + BLOCK)
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at:to].tolist(), ends[at + WORDS - 1 : to + WORDS - 1].tolist(), strict=True)], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = len(bits) // 255 * 255
        if full:
            counts += np.add.reduce(bits[:full].reshape(-1, 255, BITS), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[full:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, fp, more): fp as a signed long with the fingerprint's 64 bits."""

    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.array([fingerprint(t) for texts in slices(batch) for t in texts], np.uint64).view(np.int64))
        released()

    return docs.select(F.col(id_col).alias("id"), simhash(F.col(text_col)).alias("fp"), *more)


def parity_groups(groups: int) -> list[list[int]]:
    """The 64 bits dealt into groups. A key's bucket has one bit for each group: the parity of the group's bits."""
    return [list(range(g, BITS, groups)) for g in range(groups)]


def flips(groups: int, half: int = RADIUS // 2) -> dict[int, np.ndarray]:
    """Bucket distance -> masks of at most half flipped bits that lead there."""
    group_of = {bit: 1 << g for g, own in enumerate(parity_groups(groups)) for bit in own}
    out: dict[int, list[int]] = {}
    for size in range(half + 1):
        for bits in combinations(range(BITS), size):
            far = 0
            for bit in bits:
                far ^= group_of.get(bit, 0)
            out.setdefault(far, []).append(sum(1 << bit for bit in bits))
    return {far: np.array(masks, np.uint64) for far, masks in out.items()}


def bucket_of(fps: np.ndarray, groups: int) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for g, own in enumerate(parity_groups(groups)):
        mask = np.uint64(sum(1 << bit for bit in own))
        out |= (np.bitwise_count(fps & mask).astype(np.int64) & 1) << g
    return out


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as (a, b) do, each node to the smallest that it reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = np.arange(len(nodes))
    x, y = at[: len(a)], at[len(a) :]
    while True:
        low = np.minimum(up[x], up[y])
        new = up.copy()
        np.minimum.at(new, up[x], low)
        np.minimum.at(new, up[y], low)
        while (jump := new[new]).tolist() != new.tolist():
            new = jump
        if np.array_equal(new, up):
            break
        up = new
    far = up != np.arange(len(nodes))
    return nodes[far], nodes[up[far]]


def bucket_links(fps: np.ndarray, reps: np.ndarray, far: np.ndarray, masks: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints that have a variant in one bucket.

    far: each fingerprint's distance from the bucket. Two fingerprints that share a variant lie within half the radius
    of it, so all that share it link with each other; a star from the smallest loses no connection and
    avoids all pairs.
    """
    blocks = [(fps[own := far == d], reps[own], masks[int(d)]) for d in np.unique(far)]
    total = sum(len(f) * len(m) for f, _, m in blocks)
    passes = 1 << max(0, math.ceil(math.log2(max(1, total) / PASS_VARIANTS)))
    shift, mix = np.uint64(64 - 20), np.uint64(0x9E3779B97F4A7C15)
    step = np.uint64(64 - max(1, passes.bit_length() - 1))
    found_a, found_b = [np.zeros(0, reps.dtype)], [np.zeros(0, reps.dtype)]
    for turn in range(passes):
        keys, owners = [], []
        for n, (f, _, m) in enumerate(blocks):
            rows = max(1, PASS_VARIANTS // len(m))
            for at in range(0, len(f), rows):
                v = (f[at : at + rows, None] ^ m[None, :]).ravel()
                if passes > 1:
                    mine = np.flatnonzero((v * mix) >> step == turn)
                    keys.append(v[mine])
                    owners.append((n, at, mine))
                else:
                    keys.append(v)
                    owners.append((n, at, None))
        if not keys:
            continue
        ordered = np.sort(np.concatenate(keys))
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        del ordered
        if not len(twice):
            continue
        seen = np.zeros(1 << 20, bool)
        seen[(twice * mix) >> shift] = True
        hit_key, hit_rep, hit_fp = [], [], []
        for v, (n, at, mine) in zip(keys, owners, strict=True):
            at_v = np.flatnonzero(seen[(v * mix) >> shift])
            at_v = at_v[twice[np.minimum(np.searchsorted(twice, v[at_v]), len(twice) - 1)] == v[at_v]]
            f, r, m = blocks[n]
            own = at + (at_v if mine is None else mine[at_v]) // len(m)
            hit_key.append(v[at_v])
            hit_rep.append(r[own])
            hit_fp.append(f[own])
        key, rep, fp = (np.concatenate(x) for x in (hit_key, hit_rep, hit_fp))
        order = np.lexsort((rep, key))
        key, rep, fp = key[order], rep[order], fp[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        lead = np.repeat(first, np.diff(np.r_[first, len(key)]))
        true = (np.bitwise_count(fp ^ fp[lead]) <= RADIUS) & (rep != rep[lead])
        a, b = _forest(rep[true], rep[lead][true])
        found_a.append(a)
        found_b.append(b)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    return _forest(a, b) if passes > 1 else (a, b)


def near_links(classes: DataFrame, n: int) -> DataFrame:
    """classes: n rows (fp, rep) with distinct fp. Links (a, b) between reps that connect what lies within RADIUS bits.

    Each fingerprint stands for all its variants within half the radius. The variants are dealt to buckets by the
    parities of bit groups, so they reach few buckets; a bucket gets the fingerprint once and
    spells out there just those variants that are its own. The number of buckets follows the input,
    so a bucket's work stays the same size; what is shuffled is 16 bytes for each bucket reached instead of each variant.
    """
    variants = sum(math.comb(BITS, i) for i in range(RADIUS // 2 + 1))
    groups = min(MOST_GROUPS, max(1, math.ceil(math.log2(max(2, n * variants / BUCKET_VARIANTS)))))
    targets = np.array(sorted(flips(groups)), np.int64)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = bucket_of(batch["fp"].to_numpy().view(np.uint64), groups)
            yield pd.DataFrame({"bucket": (own[:, None] ^ targets[None, :]).ravel(), "far": np.tile(targets, len(batch)), "fp": np.repeat(batch["fp"].to_numpy(), len(targets)), "rep": np.repeat(batch["rep"].to_numpy(), len(targets))})

    def link(part: pd.DataFrame) -> pd.DataFrame:
        a, b = bucket_links(part["fp"].to_numpy().view(np.uint64), part["rep"].to_numpy(), part["far"].to_numpy(), flips_of(groups))
        released(cycles=False)
        return pd.DataFrame({"a": a, "b": b})

    dealt = classes.select("fp", "rep").mapInPandas(deal, "bucket long, far long, fp long, rep long")
    return dealt.groupBy("bucket").applyInPandas(link, "a long, b long")


_FLIPS: dict[int, dict[int, np.ndarray]] = {}


def flips_of(groups: int) -> dict[int, np.ndarray]:
    if groups not in _FLIPS:
        _FLIPS[groups] = flips(groups)
    return _FLIPS[groups]


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    Documents link where their fingerprints differ in at most 4 bits; component_id is the smallest id that links
    reach. Null, empty and blank texts have fingerprint zero and link like any others. Repeated rows each return.
    Rows without id link like others; their component_id is null only where no id is reached. Equal fingerprints are one
    class, so copies make no pairs. The result joins classes back on the fingerprint, in narrow rows; where one
    fingerprint is very common, adaptive execution splits its rows.
    """
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    return prints.join(linked(prints), "fp", "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first").alias("component_id"),
    )


def linked(prints: DataFrame) -> DataFrame:
    """(fp, component, first): for every fingerprint the smallest one that links reach, as a signed long, and the smallest id among those linked."""
    classes = written(prints.groupBy("fp").agg(F.min("id").alias("first")).withColumn("rep", F.col("fp")), "classes")
    joined = components(near_links(classes, classes.count()))
    found = classes.join(joined, classes["fp"] == joined["node"], "left").select("fp", F.coalesce("component", "fp").alias("component"), "first")
    return found.drop("first").join(found.groupBy("component").agg(F.min("first").alias("first")), "component")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component, with all its columns, whatever these are called.

    The row of the smallest id stays; where several rows of the component have that id, the one of the smallest
    text digest. Rows without id go where an id shares their component; a component of such rows alone keeps the row
    of the smallest text digest. An empty table gives an empty table.
    """
    text_key = F.sha2(text_of(text_col), 256)
    prints = written(fingerprints(docs, id_col, text_col, named(id_col).alias("k_id"), text_key.alias("k_text")), "fingerprints")
    first = F.min_by(F.struct("k_id", "k_text"), F.struct(F.col("id").isNull(), F.col("id"), F.col("k_text"))).alias("k")
    keep = prints.join(linked(prints).select("fp", "component"), "fp").groupBy("component").agg(first).select("k.*")
    return one_of_each(docs, id_col, text_key, text_col, keep)
