"""Global row numbers and exact quantiles without a single-task window
(inventory W1, W2, A13, T6).

Row numbers:

``Window.orderBy(...)`` with no partition pulls every row into one task.
Instead the rows are range partitioned on the order key (Spark samples the
key to pick balanced bounds), sorted inside each partition, and numbered
locally with ``monotonically_increasing_id`` (partition index in the high
bits, position in the low bits) and written once to the checkpoint folder:
range bounds are sampled, so nothing read twice may be partitioned twice.
Per-partition counts - one row per partition - give each partition its
offset; that small table is broadcast.  No task ever holds more than its
partition.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = (1 << 33) - 1


def row_ids(df: DataFrame, order_cols: list[str | Column], out: str = "row_id",
            partitions: int | None = None) -> DataFrame:
    """W1 dense 0-based ids in the order of ``order_cols`` (make the order
    total - e.g. end with a unique key - for ids that are stable on retry)."""
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n_parts, *order_cols).sortWithinPartitions(*order_cols)
           .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    s = s.withColumn("_pid", F.shiftright(F.col("_mid"), 33)).withColumn("_local", F.col("_mid").bitwiseAND(_LOW_BITS))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: this window and the broadcast are bounded by the partition count
    offs = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (s.join(F.broadcast(offs), "_pid")
             .withColumn(out, F.col("_off") + F.col("_local"))
             .drop("_mid", "_pid", "_local", "_off"))


def batch_number(row_id: str, batch_size: int) -> Column:
    """W2 consecutive batches of ``batch_size`` rows."""
    return F.floor(F.col(row_id) / F.lit(batch_size)).cast("bigint")


#: sketch size (about 0.1 % rank error, some 100 KB), the rank width asked of it, and the values that one fold may hold
SKETCH_K, RANK_WIDTH, FOLD_VALUES = 4096, 0.002, 50_000


def exact_quantiles(df: DataFrame, col: str, probs: dict[str, float], accuracy: int | None = None,
                    fold_values: int = FOLD_VALUES, rank_width: float = RANK_WIDTH) -> DataFrame:
    """A13 exact quantiles by linear interpolation between order statistics
    (numpy's default), over the non-null values -> one row, one column per
    name in ``probs``.  Null when the column has no values.  With ``accuracy``
    one pass gives approximate ones (a value whose rank is off by at most
    rows / accuracy).

    The values are neither sorted nor written.  One pass builds a mergeable
    KLL sketch; it brackets the ranks that are wanted.  The next pass counts
    what lies below and at the ends of each bracket and folds what lies
    inside to (value, count).  Brackets with more than ``fold_values`` rows
    inside are narrowed by a sketch of their own first (each time by a factor
    of 1 / (2 * rank_width)), so any number of rows takes a few passes; the
    ends are counted apart, so a hot value never fills a bracket.  A sketch
    that missed its rank only moves the bracket: the counts decide.
    """
    spark = df.sparkSession
    v = df.select(F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if accuracy:
        return v.agg(*[F.percentile_approx("_v", float(p), accuracy).alias(n) for n, p in probs.items()])
    first = v.agg(F.count("_v").alias("n"), F.kll_sketch_agg_double("_v", SKETCH_K).alias("s")).first()
    if not first["n"]:
        return spark.range(1).select(*[F.lit(None).cast("double").alias(n) for n in probs])
    places = {name: (first["n"] - 1) * float(p) for name, p in probs.items()}
    wanted = sorted({r for h in places.values() for r in (math.floor(h), math.ceil(h))})
    value = _order_statistics(v, wanted, first["n"], first["s"], fold_values, rank_width)
    out = [value[math.floor(h)] + (value[math.ceil(h)] - value[math.floor(h)]) * (h - math.floor(h)) for h in places.values()]
    return spark.range(1).select(*[F.lit(x).cast("double").alias(n) for n, x in zip(places, out)])


def _inside(x: Column, lo: float | None, hi: float | None) -> Column:
    return (F.lit(True) if lo is None else x > lo) & (F.lit(True) if hi is None else x < hi)


def _order_statistics(v: DataFrame, ranks: list[int], n: int, sketch: bytes, fold_values: int, width: float) -> dict[int, float]:
    """The values of ``_v`` at 0-based ranks; each pass serves all ranks that are open."""
    spark, x = v.sparkSession, F.col("_v")
    found: dict[int, float] = {}
    # per open rank: an open interval that holds it (None: no end), the rows up to its lower end, the rows inside, a sketch of these
    open_ = {r: (None, None, 0, n, sketch) for r in ranks}
    while open_:
        asked = [(r, i, min(max((r - below + 0.5) / inside + d, 0.0), 1.0))
                 for r, (_, _, below, inside, _) in open_.items() for i, d in enumerate((-width, width))]
        row = spark.range(1).select(*[F.kll_sketch_get_quantile_double(F.lit(bytes(open_[r][4])), F.lit(q)).alias(f"{r}_{i}") for r, i, q in asked]).first()
        bracket = {r: (row[f"{r}_0"], row[f"{r}_1"]) for r in open_}
        aggs, small = [], {}
        for r, (lo, hi, _, inside, _) in open_.items():
            a, b = bracket[r]
            small[r] = inside * 2 * width <= fold_values / 2
            own, mid = _inside(x, lo, hi), _inside(x, a, b)
            aggs += [F.count_if(own & (x < a)).alias(f"{r}_below"), F.count_if(own & (x == a)).alias(f"{r}_a"), F.count_if(mid).alias(f"{r}_mid"),
                     F.count_if(own & (x == b) & F.lit(a != b)).alias(f"{r}_b")]
            if not small[r]:
                for name, part in (("mid", mid), ("left", own & (x < a)), ("right", own & (x > b))):
                    aggs.append(F.kll_sketch_agg_double(F.when(part, x), SKETCH_K).alias(f"{r}_{name}_s"))
        counts = v.agg(*aggs).first()
        fold, narrowed = {}, {}
        for r, (lo, hi, below, inside, _) in open_.items():
            (a, b), c = bracket[r], {k: counts[f"{r}_{k}"] for k in ("below", "a", "mid", "b")}
            at = r - below
            edges = [c["below"], c["below"] + c["a"], c["below"] + c["a"] + c["mid"], c["below"] + c["a"] + c["mid"] + c["b"]]
            if at < edges[0]:
                part = ("left", lo, a, below, c["below"])
            elif at < edges[1]:
                found[r] = a
                continue
            elif at < edges[2]:
                part = ("mid", a, b, below + edges[1], c["mid"])
            elif at < edges[3]:
                found[r] = b
                continue
            else:
                part = ("right", b, hi, below + edges[3], inside - edges[3])
            (fold if part[4] <= fold_values else narrowed)[r] = part
        found.update(_folded(v, fold))
        again = [r for r in narrowed if small[r]]  # the sketch of a small bracket was not made
        extra = v.agg(*[F.kll_sketch_agg_double(F.when(_inside(x, *narrowed[r][1:3]), x), SKETCH_K).alias(str(r)) for r in again]).first() if again else {}
        open_ = {r: (lo, hi, below, inside, extra[str(r)] if r in again else counts[f"{r}_{name}_s"]) for r, (name, lo, hi, below, inside) in narrowed.items()}
    return found


def _folded(v: DataFrame, parts: dict[int, tuple]) -> dict[int, float]:
    """The order statistics inside open intervals (name, lo, hi, rows up to lo, rows inside) of a bounded number of rows."""
    if not parts:
        return {}
    x, found = F.col("_v"), {}
    inside = functools.reduce(lambda a, b: a | b, [_inside(x, lo, hi) for _, lo, hi, _, _ in parts.values()])
    rows = sorted((r["_v"], r["n"]) for r in v.where(inside).groupBy("_v").agg(F.count(F.lit(1)).alias("n")).collect())  # bounded by the counts
    for r, (_, lo, hi, below, _) in parts.items():
        at = r - below
        for value, n in rows:
            if (lo is None or lo < value) and (hi is None or value < hi):
                if at < n:
                    found[r] = value
                    break
                at -= n
    return found
