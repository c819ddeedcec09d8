"""Building blocks that stay safe when one key holds a large share of the rows.

None of them drops, caps or samples rows: each splits the hot key into
buckets, does the heavy work per bucket and carries a small summary across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rn") -> DataFrame:
    """First n rows per key. The adjacent filter lets Spark cut each partition
    to n rows per key before the shuffle, so a hot key sends n rows per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def bounded_text_agg(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], text: Column, sep: str, max_chars: int, out: str
) -> DataFrame:
    """LEFT(LISTAGG(text, sep) ordered, max_chars) without collecting the group.

    Every element after the first adds at least len(sep) characters, so the
    first `max_chars // len(sep) + 1` elements already decide the result.
    """
    if not sep:
        raise ValueError("a separator is needed to bound the number of elements")
    keep = max_chars // len(sep) + 1
    head = top_n(df.withColumn("__t", text), keys, order, keep, "__rn")
    # an element can only contribute its first max_chars characters
    head = head.withColumn("__t", F.substring("__t", 1, max_chars))
    rows = F.array_sort(F.collect_list(F.struct("__rn", "__t")))
    joined = F.array_join(F.transform(rows, lambda r: r["__t"]), sep)
    return head.groupBy(*keys).agg(F.substring(joined, 1, max_chars).alias(out))


def prefix_sums(
    df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column], measures: dict[str, Column]
) -> DataFrame:
    """Running totals per key, row by row, without one task per key.

    `bucket` must not decrease along `order`. Totals per (key, bucket) are
    summed over the few buckets, then each bucket is scanned on its own.
    """
    names = list(measures)
    base = df.select("*", bucket.alias("__b"), *[c.alias(f"__m_{n}") for n, c in measures.items()])
    per_bucket = base.groupBy(*keys, "__b").agg(*[F.sum(f"__m_{n}").alias(f"__s_{n}") for n in names])
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *keys, "__b", *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in names]
    )
    within = Window.partitionBy(*keys, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = base.select("*", *[F.sum(f"__m_{n}").over(within).alias(f"__l_{n}") for n in names])
    joined = local.join(offsets, [*keys, "__b"])
    totals = [(F.col(f"__o_{n}") + F.col(f"__l_{n}")).alias(n) for n in names]
    return joined.select(*df.columns, *totals)


def last_k_before(
    df: DataFrame, key: str, order: str, payload: Column, k: int, span: int, out: str = "history"
) -> DataFrame:
    """Array of the payloads of the k rows that precede each row of a key.

    The key is cut into buckets of `span` order values. Each bucket is scanned
    alone; what it needs from earlier buckets (at most k rows) is found from
    the last k rows of every bucket, a table about k/span of the input.
    """
    cols = df.columns
    base = df.select(*cols, F.floor(F.col(order) / span).alias("__b"), payload.alias("__p"))
    slim = base.select(key, order, "__b", "__p")
    first = Window.partitionBy(key, "__b").orderBy(order)
    last = Window.partitionBy(key, "__b").orderBy(F.desc(order))
    tails = slim.withColumn("__r", F.row_number().over(last)).where(F.col("__r") <= k).drop("__r")
    heads = slim.withColumn("__r", F.row_number().over(first)).where(F.col("__r") == 1)
    heads = heads.select(key, order, "__b", "__p").withColumn("__is_head", F.lit(1))
    marks = (
        tails.withColumn("__is_head", F.lit(0))
        .unionByName(heads)
        .groupBy(key, order, "__b")
        .agg(F.max("__is_head").alias("__is_head"), F.first("__p").alias("__p"))
    )
    across = Window.partitionBy(key).orderBy(order).rowsBetween(-k, -1)
    carry = (
        marks.withColumn("__carry", F.collect_list("__p").over(across))
        .where(F.col("__is_head") == 1)
        .select(key, "__b", "__carry")
    )
    inside = Window.partitionBy(key, "__b").orderBy(order).rowsBetween(-k, -1)
    local = base.withColumn("__local", F.collect_list("__p").over(inside))
    both = local.join(carry, [key, "__b"])
    merged = F.concat("__carry", "__local")
    return both.select(*cols, F.slice(merged, F.greatest(F.size(merged) - k + 1, F.lit(1)), k).alias(out))


def salted(df: DataFrame, salts: int, *by: str) -> DataFrame:
    """Add a replay-stable salt column derived from the given columns."""
    return df.withColumn("__salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))


def replicated(df: DataFrame, salts: int) -> DataFrame:
    """One copy of each row per salt, the other side of a salted join."""
    return df.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], salts: int, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join whose hot keys on `big` are spread over `salts` tasks."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    joined = salted(big, salts, *by).join(replicated(small, salts), [*keys, "__salt"], how)
    return joined.drop("__salt")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per key without holding a key's values.

    A mergeable sketch brackets the target ranks, one aggregation counts the
    values below the bracket and only distinct values inside it are ranked.
    """
    accuracy = 10000
    eps = 4.0 / accuracy
    lows = [max(p - eps, 0.0) for p in probs.values()]
    highs = [min(p + eps, 1.0) for p in probs.values()]
    sketch = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(value).alias("__n"),
        F.min(value).alias("__min"),
        F.max(value).alias("__max"),
        F.percentile_approx(value, lows, accuracy).alias("__lo"),
        F.percentile_approx(value, highs, accuracy).alias("__hi"),
    )
    # the sketch is off by at most n / accuracy ranks and interpolation looks one
    # rank further; below 2 * accuracy rows the whole (small) group is ranked
    small = F.col("__n") < 2 * accuracy
    targets = sketch.select(
        *keys,
        "__n",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("__name"),
                        (F.lit(p) * (F.col("__n") - 1)).alias("__pos"),
                        F.when(small, F.col("__min")).otherwise(F.col("__min") if p - eps <= 0 else F.col("__lo")[i]).alias("__lo"),
                        F.when(small, F.col("__max")).otherwise(F.col("__max") if p + eps >= 1 else F.col("__hi")[i]).alias("__hi"),
                    )
                    for i, (name, p) in enumerate(probs.items())
                ]
            )
        ).alias("__q"),
    ).select(*keys, "__n", "__q.*")
    # one row per distinct value: copies of a value cost nothing further on
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__v")).agg(F.count("*").alias("__c"))
    joined = counts.join(targets, list(keys)) if keys else counts.crossJoin(F.broadcast(targets))
    below = joined.where(F.col("__v") < F.col("__lo")).groupBy(*keys, "__name").agg(F.sum("__c").alias("__below"))
    inside = joined.where(F.col("__v").between(F.col("__lo"), F.col("__hi")))
    inside = inside.join(below, [*keys, "__name"], "left")
    w = Window.partitionBy(*keys, "__name").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("__end", F.coalesce("__below", F.lit(0)) + F.sum("__c").over(w)).withColumn(
        "__start", F.col("__end") - F.col("__c")
    )

    def at(pos: Column) -> Column:
        return F.max(F.when((F.col("__start") <= pos) & (pos < F.col("__end")), F.col("__v")))

    lo, hi = F.floor("__pos"), F.ceil("__pos")
    picked = ranked.groupBy(*keys, "__name", "__pos").agg(at(lo).alias("__a"), at(hi).alias("__z"))
    quant = F.col("__a") + (F.col("__z") - F.col("__a")) * (F.col("__pos") - F.floor("__pos"))
    wide = picked.select(*keys, "__name", quant.alias("__val"))
    return wide.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__name") == name, F.col("__val"))).alias(name) for name in probs]
    )
