"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, named, packed

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
#: Tokens in a block: total / BLOCKS, within these bounds.
BLOCKS, LEAST_BLOCK, MOST_BLOCK = 1 << 16, 16, 2048
#: Slots, and rows of a table, that one ordering group is meant to hold.
RUN, BUCKET = 1 << 14, 1 << 10
#: Golden-ratio points: slot * GOLD modulo POINTS, over POINTS. GOLD is the odd number next to POINTS / 1.618...
POINTS, GOLD = 1 << 31, 1327217885


def n_words(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """sizes(source, source_size): adds weight and target.

    Sources in code-point order, null last, take the weights in turn and share the sum of all sizes by weight.
    A target stops at most_epochs times its source's size, and the excess goes to the others by weight until none
    is above. Sources fill up in the order of (limit / weight), so running sums over that order give the share at which
    the filling stops. The table has a row for each source.
    """
    limit = F.col("source_size") * F.lit(float(most_epochs))
    by_name = W.orderBy(F.col("source").isNull(), F.col("source"))
    by_fill = W.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").isNull(), F.col("source"))
    before = by_fill.rowsBetween(W.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, W.unboundedFollowing)
    whole = W.partitionBy()
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    share = F.col("_rest") / F.col("_weights")
    return (
        sizes.withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
        .withColumn("_limit", limit)
        .withColumn("_rest", F.sum("source_size").over(whole) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
        .withColumn("_weights", F.sum("_weight").over(onward))
        .withColumn("_open", share * F.col("_weight") < F.col("_limit"))
        .withColumn("_share", F.max(F.when(F.col("_open"), share)).over(whole))
        .withColumn("target", F.when(F.col("_open"), F.col("_share") * F.col("_weight")).otherwise(F.col("_limit")))
        .select("source", "source_size", F.col("_weight").alias("weight"), "target")
    )


def schedule(targets: DataFrame, slots: int, block: int) -> DataFrame:
    """(source, rank): slot number t takes the source in whose cumulative share the t-th golden-ratio point falls;
    rank counts the slots of a source from 0. Slots past the last epoch of a source are left out.

    Ranks come from counts by run of slots and places inside runs, so no task orders more than a run.
    """
    spark = targets.sparkSession
    in_order = W.orderBy(F.col("source").isNull(), F.col("source"))
    shares = (
        targets.where("target > 0")
        .withColumn("_to", F.sum("target").over(in_order.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("_all", F.sum("target").over(W.partitionBy()))
        .select("source", "source_size", "target", F.ceil(F.col("_to") / F.col("_all") * POINTS).cast("long").alias("_to"))
        .withColumn("_from", F.coalesce(F.lag("_to").over(in_order), F.lit(0)))
    )
    points = spark.range(slots).select(F.col("id").alias("slot"), F.pmod(F.pmod("id", F.lit(POINTS)) * F.lit(GOLD), F.lit(POINTS)).alias("_point"))
    # The join is on the cell of the unit interval; a source lies in the cells that its share touches.
    cells = 256
    cell = POINTS // cells
    wide = shares.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_from") / cell), F.floor((F.col("_to") - 1) / cell))))
    taken = points.withColumn("_cell", F.floor(F.col("_point") / cell)).join(wide, "_cell").where("_point >= _from and _point < _to")
    run = F.floor(F.col("slot") / RUN)
    counts = taken.groupBy("source", run.alias("_run")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = counts.withColumn("_before", F.sum("_n").over(W.partitionBy("source").orderBy("_run").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n"))
    place = F.row_number().over(W.partitionBy("source", "_run").orderBy("slot")) - 1
    placed = taken.select("source", "source_size", "slot", run.alias("_run")).withColumn("_place", place)
    a, b = placed.alias("a"), earlier.alias("b")
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a._run") == F.col("b._run"))
    return a.join(b, same).select("a.source", "slot", "source_size", (F.col("_place") + F.col("_before")).alias("rank"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row per input row: id, size, source, source_size, target, taken.

    size counts the text's words; null has none. Each source's texts are shuffled by a digest of their ids, of the text where
    the id is null, so that rows without id spread like others, laid end to end and cut into blocks of equal token counts, of which the last may be short. The schedule's slots take a source's
    blocks in turn, at most most_epochs times around. taken is what the slots take of a text, repeats counted: at most
    most_epochs times its size. Every source's sum is within a few blocks of its target. Repeated rows each return with words
    of their own. Null is a source of its own, the last. Empty tables give an empty table.

    Order and offsets inside a source come from two levels of sums, over buckets of the shuffle and inside them, so
    a source that holds a third of all rows is spread like any other. The driver sees two numbers: rows and words.
    """
    spark = docs.sparkSession
    sized = docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"), n_words(text_col).alias("size"), F.md5(F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit(""))).alias("_order"))
    rows, total = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = max(LEAST_BLOCK, min(MOST_BLOCK, total // BLOCKS))
    buckets = max(1, rows // BUCKET)
    drawn = sized.withColumn("_bucket", F.pmod(F.conv(F.substring("_order", 1, 8), 16, 10).cast("long"), F.lit(buckets)))
    sums = drawn.groupBy("source", "_bucket").agg(F.sum("size").alias("_n"))
    offsets = sums.withColumn("_before", F.sum("_n").over(W.partitionBy("source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n"))
    goals = source_targets(sums.groupBy("source").agg(F.sum("_n").alias("source_size")), weights, most_epochs)
    inside = W.partitionBy("source", "_bucket").orderBy("_order", "_id", "size").rowsBetween(W.unboundedPreceding, 0)
    laid = drawn.withColumn("_to", F.sum("size").over(inside)).withColumn("_row", F.row_number().over(W.partitionBy("source", "_bucket").orderBy("_order", "_id", "size")))
    d, o, g = laid.alias("d"), offsets.alias("o"), goals.alias("g")
    placed = (
        d.join(o, F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d._bucket") == F.col("o._bucket")))
        .join(g, F.col("d.source").eqNullSafe(F.col("g.source")))
        .select("d._id", "d.source", "d.size", "g.source_size", "g.target", "d._bucket", "d._row", (F.col("o._before") + F.col("d._to") - F.col("d.size")).alias("_from"))
    )
    slots = -(-int(total) // block)
    uses = schedule(goals, slots, block).withColumn("_blocks", F.ceil(F.col("source_size") / F.lit(block)))
    uses = uses.where(F.col("rank") < F.col("_blocks") * most_epochs).groupBy("source", F.pmod("rank", "_blocks").alias("_block")).agg(F.count(F.lit(1)).alias("_uses"))
    first, last = F.floor(F.col("_from") / block), F.floor((F.col("_from") + F.greatest("size", F.lit(1)) - 1) / block)
    pieces = placed.withColumn("_block", F.explode(F.sequence(first, last)))
    overlap = F.least(F.col("_from") + F.col("size"), (F.col("p._block") + 1) * block) - F.greatest(F.col("_from"), F.col("p._block") * block)
    p, u = pieces.alias("p"), uses.alias("u")
    joined = p.join(u, F.col("p.source").eqNullSafe(F.col("u.source")) & (F.col("p._block") == F.col("u._block")), "left")
    return (
        joined.groupBy("p.source", "_bucket", "_row", "_id", "size", "p.source_size", "target")
        .agg(F.sum(F.greatest(overlap, F.lit(0)) * F.coalesce("_uses", F.lit(0))).cast("long").alias("taken"))
        .select(F.col("_id").alias(id_col), "size", "source", "source_size", "target", "taken")
    )


def repeat_taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix in whole documents: each row of docs as often as the mix takes it, with all its columns, whatever these are called.

    A share of a document is rounded up as often as it is large, by a digest of the id, so that each source's words stay
    near its target; no row comes more than MOST_EPOCHS times. Texts without words, null ones included, are no part
    of a mix and go. Ids are expected to be unique, as after deduplication; where they repeat, an id's rows share its mean.
    An empty table gives an empty table.
    """
    up = F.conv(F.substring(F.md5(F.concat(F.lit("round"), F.col("k_id"))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    share = F.try_divide(F.sum("taken"), F.sum("size"))
    taken = mix(docs, id_col, text_col, source_col).groupBy(named(id_col).alias("k_id")).agg(share.alias("share")).select("k_id", F.floor(F.col("share") + up).cast("int").alias("times")).where("times > 0")
    rows = packed(docs, k_id=named(id_col)).join(taken, "k_id")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time")).select("row.*")


ORACLE = rf"""
WITH w AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, text, '')) AS ord FROM documents
), tot AS (
  SELECT sum(size)::BIGINT AS total, count(*) AS n, greatest({LEAST_BLOCK}, least({MOST_BLOCK}, sum(size)::BIGINT // {BLOCKS})) AS b,
    greatest(1, count(*) // {BUCKET}) AS buckets FROM w
), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM w GROUP BY source
), n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM s
), q AS (SELECT *, CASE k % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight, {MOST_EPOCHS}.0::DOUBLE * source_size AS lim FROM n
), f AS (SELECT *, (sum(source_size) OVER ())::DOUBLE - coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM q
), g AS (SELECT *, rest / weights * weight < lim AS is_open, max(CASE WHEN rest / weights * weight < lim THEN rest / weights END) OVER () AS share FROM f
), t AS (SELECT source, source_size, CASE WHEN is_open THEN share * weight ELSE lim END AS target FROM g
), c AS (SELECT *, ceil(sum(target) OVER (ORDER BY source NULLS LAST) / sum(target) OVER () * {POINTS})::BIGINT AS upto FROM t WHERE target > 0
), e AS (SELECT *, coalesce(lag(upto) OVER (ORDER BY source NULLS LAST), 0) AS since FROM c
), p AS (SELECT i AS slot, (((i % {POINTS}) * {GOLD}) % {POINTS}) AS point FROM tot, range(0, (total + b - 1) // b) r(i)
), r AS (SELECT e.source, ceil(e.source_size / b)::BIGINT AS blocks, row_number() OVER (PARTITION BY e.source ORDER BY slot) - 1 AS rank FROM p JOIN e ON point >= since AND point < upto, tot
), u AS (SELECT source, rank % blocks AS blk, count(*) AS uses FROM r WHERE rank < blocks * {MOST_EPOCHS} GROUP BY ALL
), l AS (SELECT o.*, sum(size) OVER (PARTITION BY source ORDER BY ('0x' || substr(ord, 1, 8))::BIGINT % buckets, ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS since FROM w AS o, tot
), x AS (SELECT l.doc_id, any_value(l.size) AS size, any_value(l.source) AS source, sum(greatest(0, least(l.since + size, (blk + 1) * b) - greatest(l.since, blk * b)) * uses) AS taken
  FROM l, tot, u WHERE l.source IS NOT DISTINCT FROM u.source AND blk BETWEEN l.since // b AND (l.since + greatest(size, 1) - 1) // b GROUP BY l.doc_id)
SELECT w.doc_id, w.size, w.source, t.source_size, t.target, coalesce(x.taken, 0)::BIGINT AS taken
FROM w JOIN t ON w.source IS NOT DISTINCT FROM t.source LEFT JOIN x ON w.doc_id = x.doc_id
"""
