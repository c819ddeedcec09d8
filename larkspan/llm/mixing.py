"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Words are the tokens. Sources, ordered by code point with null last, take the
weights in turn and share `total` times all words; a target stops at `most`
times its source's words and the excess goes to the others by weight.

The mix is counted in blocks of `block` words. Sainte-Laguë gives the blocks to
the sources (parties: sources, votes: targets), and again each source's blocks
to its shards (votes: words): the seats go to the highest quotients
votes / (2 k + 1). The n-th seat lies between two known divisors, so all but
about three quotients per party are settled without ranking them.

A shard is a hash range of a source's documents, about `shard_words` long, put
in a seeded order. Its words form a stream that is cut into blocks: each block
is taken quota // n times, and one run of quota mod n blocks, from a seeded
place on, once more. The order is random already, so a run is a random choice of
documents, and only those at its two ends are cut; what is taken of a document
is one unbroken part of it. So a hot source is many shards, no block is a row,
and no document exceeds `most` times its size.

Defined results: null text has 0 words; rows without words take 0. Ties are
ordered by key; rows that repeat a key are ordered by size, and equal rows are
interchangeable. An empty table gives no rows. Extra columns are ignored by
`mix`, kept where named in `keep`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (3, 1, 2)
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 8
SHARD_WORDS = 1 << 20
SEED = "mix"


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _before(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def apportion(parties: DataFrame, by: Sequence[str], name: Sequence[str], votes: str, seats: str) -> DataFrame:
    """`parties` with `quota`: the Sainte-Laguë share of each group's `seats`; ties in the order of `name`.

    With n parties, the divisor that gives all seats lies between all votes / (seats + n/2)
    and all votes / (seats - n/2); quotients outside are settled."""
    w = Window.partitionBy(*by)
    x = parties.withColumn("__all", F.sum(votes).over(w)).withColumn("__n", F.count("*").over(w))
    share = F.when(F.col("__all") > 0, F.col(votes) / F.col("__all")).otherwise(0.0)
    sure = F.floor(share * F.greatest(F.col(seats) - F.col("__n") / 2, F.lit(0.0)) + 0.5 - 1e-9)
    most = F.ceil(share * (F.col(seats) + F.col("__n") / 2) + 0.5)
    x = x.withColumn("__sure", F.greatest(sure, F.lit(0))).withColumn("__open", F.col(seats) - F.sum("__sure").over(w)).withColumn("__most", most)
    tried = x.where((F.col("__most") > F.col("__sure")) & (F.col(votes) > 0)).select(*by, *name, votes, "__open", F.explode(F.sequence("__sure", F.col("__most") - 1)).alias("__k"))
    order = Window.partitionBy(*by).orderBy((F.col(votes) / (2 * F.col("__k") + 1)).desc(), *[F.col(c).asc_nulls_last() for c in name])
    won = tried.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= F.col("__open"))
    keys = [*by, *name]
    won = won.groupBy(*keys).agg(F.count("*").alias("__won")).select(*[F.col(c).alias(f"__w_{c}") for c in keys], "__won")
    same = [F.col(c).eqNullSafe(F.col(f"__w_{c}")) for c in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    out = x.join(won, on, "left")
    return out.select(*parties.columns, (F.col("__sure") + F.coalesce("__won", F.lit(0))).cast("bigint").alias("quota"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, halves: int = 3, most: int = 2) -> DataFrame:
    """(source, source_size, target): `sizes` is (source, source_size); all targets add up to `halves` / 2 of all sizes.

    With the sources in order of size over weight, those that reach their limit
    come first: a source does if its share of what the ones before it leave is
    above its limit. Integers are compared, so ties are exact."""
    everything = Window.partitionBy()
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(n - 1, F.lit(len(weights))) + 1).cast("int"))
    x = sizes.withColumn("w", weight.cast("bigint")).withColumn("limit", F.col("source_size") * most)
    order = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    x = x.withColumn("total2", F.sum("source_size").over(everything) * halves)
    x = x.withColumn("left2", F.col("total2") - 2 * _before(F.col("limit"), order)).withColumn("w_left", F.sum("w").over(everything) - _before(F.col("w"), order))
    x = x.withColumn("full", F.col("left2") * F.col("w") >= 2 * F.col("limit") * F.col("w_left"))
    open_left2 = F.col("total2") - 2 * F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(everything)
    open_w = F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(everything)
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise((open_left2 * F.col("w")).cast("double") / (2 * open_w))
    return x.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, halves: int = 3, most: int = 2, block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
        seed: str = SEED, key: str = "doc_id", text: str = "text", source: str = "source", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., size, source_size, target, taken, at, pick): words of each document that the mix takes.

    `pick` is the shard's choice (n blocks, quota, first block of the run) and `at` the
    document's place in the shard's stream; `times` tells from them how often a block is taken."""
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")
    mark = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))
    rows = docs.select(key, *keep, F.col(source).alias("__source"), size.alias("size"), mark.alias("__mark"))
    goal = targets(docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size")), weights, halves, most)
    goal = goal.withColumn("n_shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)))
    seats = F.round(F.sum("target").over(Window.partitionBy()) / block).cast("bigint")
    goal = apportion(goal.withColumn("seats", seats).withColumn("one", F.lit(1)), ["one"], ["source"], "target", "seats")
    goal = goal.select(F.col("source").alias("__s"), "source_size", "target", "n_shards", F.col("quota").alias("source_quota"))
    shard = F.pmod(F.conv(F.substring("__mark", 1, 8), 16, 10).cast("bigint"), F.col("n_shards"))

    def sharded(x: DataFrame) -> DataFrame:
        # one row per source: small, and joined as Spark sees fit
        return x.join(goal, F.col("__source").eqNullSafe(F.col("__s"))).withColumn("__shard", shard)

    slim = docs.select(F.col(source).alias("__source"), size.alias("size"), mark.alias("__mark"))
    words = sharded(slim).groupBy("__source", "__shard", "source_quota").agg(F.sum("size").alias("words"))
    n = F.greatest(F.ceil(F.col("words") / block), F.lit(1)).cast("bigint")
    words = apportion(words, ["__source"], ["__shard"], "words", "source_quota").withColumn("n", n)
    quota = F.least(F.col("quota"), F.col("n") * most)
    # a run that does not go round the end
    place = _hash(F.concat_ws("|", F.lit(seed), F.coalesce("__source", F.lit("\0")), F.col("__shard").cast("string")))
    first = F.pmod(place, F.col("n") - quota % F.col("n") + 1)
    choice = words.select(F.col("__source").alias("__cs"), F.col("__shard").alias("__ch"), F.struct("n", quota.alias("quota"), first.alias("first")).alias("pick"))
    stream = Window.partitionBy("__source", "__shard").orderBy("__mark", key, "size")
    placed = sharded(rows).withColumn("at", _before(F.col("size"), stream))
    out = placed.join(choice, F.col("__source").eqNullSafe(F.col("__cs")) & (F.col("__shard") == F.col("__ch")))

    def overlap(b: Column) -> Column:
        return F.least((b + 1) * block, F.col("at") + F.col("size")) - F.greatest(b * block, F.col("at"))

    blocks = F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))
    taken = F.aggregate(blocks, F.lit(0).cast("bigint"), lambda acc, b: acc + times(b) * overlap(b))
    return out.select(key, *keep, "size", "source_size", "target", F.when(F.col("size") > 0, taken).otherwise(0).cast("bigint").alias("taken"), "at", "pick")


def times(b: Column) -> Column:
    """How often the mix takes block `b` of the row's shard."""
    p = F.col("pick")
    return F.floor(p["quota"] / p["n"]) + F.when((b >= p["first"]) & (b < p["first"] + p["quota"] % p["n"]), 1).otherwise(0)


def mixed_documents(docs: DataFrame, block: int = BLOCK_WORDS, most: int = 2, **options) -> DataFrame:
    """The mix as documents: for each round that takes some of a document's words, a row
    with those words and the white space before them. A document taken whole once keeps its text."""
    fixed = ("doc_id", "text", "source", "n_chars")
    names = {c: f"__x{i}" for i, c in enumerate(docs.columns) if c not in fixed}  # out of the way of the mix's own columns
    x = docs.withColumnsRenamed(names).withColumn("__kept_source", F.col("source"))
    x = mix(x, block=block, most=most, keep=["text", "__kept_source", *names.values()], **options).where("taken > 0")
    words = F.regexp_extract_all(F.col("text"), F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    x = x.withColumn("__words", words).withColumn("__round", F.explode(F.sequence(F.lit(1), F.lit(most))))
    chosen = F.filter("__words", lambda _, i: times(F.floor((F.col("at") + i) / block)) >= F.col("__round"))
    x = x.withColumn("__words", chosen).where(F.size("__words") > 0).withColumn("text", F.array_join("__words", ""))
    back = {v: k for k, v in names.items()}
    x = x.select("doc_id", "text", F.col("__kept_source").alias("source"), F.length("text").cast("bigint").alias("n_chars"), *names.values())
    return x.withColumnsRenamed(back).select(*docs.columns)


def oracle(table: str = "documents") -> str:
    """The rows of `mix` with its defaults as DuckDB SQL: seats are ranked one by one."""
    return f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                  md5('{SEED}|' || CAST(doc_id AS VARCHAR)) AS mark FROM {table}),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s0),
s2 AS (SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER o, 0) AS left2, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS w_left,
              3 * sum(source_size) OVER () AS total2 FROM s1
       WINDOW o AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, left2 * w >= 4 * source_size * w_left AS is_full FROM s2),
s4 AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
              ELSE CAST((total2 - 4 * sum(CASE WHEN is_full THEN source_size ELSE 0 END) OVER ()) * w AS DOUBLE) / (2 * sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ()) END AS target FROM s3),
s5 AS (SELECT *, CAST(greatest(ceil(source_size / {SHARD_WORDS}), 1) AS BIGINT) AS n_shards, CAST(round(sum(target) OVER () / {BLOCK_WORDS}) AS BIGINT) AS seats FROM s4),
q0 AS (SELECT source, target, seats, unnest(range(CAST(target / {BLOCK_WORDS} AS BIGINT) + 20)) AS k FROM s5),
q1 AS (SELECT *, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST) AS r FROM q0 WHERE target > 0),
q2 AS (SELECT source, count(*) AS quota FROM q1 WHERE r <= seats GROUP BY source),
s6 AS (SELECT s5.*, coalesce(quota, 0) AS source_quota FROM s5 LEFT JOIN q2 ON s5.source IS NOT DISTINCT FROM q2.source),
e AS (SELECT d.*, source_size, target, source_quota, CAST('0x' || substr(mark, 1, 8) AS BIGINT) % n_shards AS shard FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source),
h0 AS (SELECT source, shard, source_quota, CAST(sum(size) AS BIGINT) AS words FROM e GROUP BY ALL),
h1 AS (SELECT *, unnest(range(source_quota + 1)) AS k FROM h0 WHERE words > 0),
h2 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY words / (2 * k + 1) DESC, shard) AS r FROM h1),
h3 AS (SELECT source, shard, count(*) AS quota FROM h2 WHERE r <= source_quota GROUP BY ALL),
h4 AS (SELECT h0.source, h0.shard, CAST(greatest(ceil(words / {BLOCK_WORDS}), 1) AS BIGINT) AS n, coalesce(quota, 0) AS quota
       FROM h0 LEFT JOIN h3 ON h0.source IS NOT DISTINCT FROM h3.source AND h0.shard = h3.shard),
h5 AS (SELECT source, shard, n, least(quota, 2 * n) AS quota,
              CAST('0x' || substr(md5('{SEED}|' || coalesce(source, chr(0)) || '|' || shard), 1, 8) AS BIGINT) % (n - least(quota, 2 * n) % n + 1) AS first_block FROM h4),
p AS (SELECT e.*, n, quota, first_block, CAST(coalesce(sum(size) OVER (PARTITION BY e.source, e.shard ORDER BY mark, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
      FROM e JOIN h5 ON e.source IS NOT DISTINCT FROM h5.source AND e.shard = h5.shard)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(CASE WHEN size = 0 THEN 0 ELSE list_sum(list_transform(range(pos // {BLOCK_WORDS}, (pos + size - 1) // {BLOCK_WORDS} + 1),
       lambda b: (quota // n + CASE WHEN b >= first_block AND b < first_block + quota % n THEN 1 ELSE 0 END) * (least((b + 1) * {BLOCK_WORDS}, pos + size) - greatest(b * {BLOCK_WORDS}, pos)))) END AS BIGINT) AS taken
FROM p"""
