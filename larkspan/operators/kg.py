"""Entity graph from text: catalogue, mentions, relations, claims, edges.

Everything is keyed by (document, sentence), so the work of one group is
bounded by the length of a sentence however large the corpus is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.functions.text import sentences, stem, tokens
from larkspan.operators.skew import last_k_before
from larkspan.storage import written
from larkspan.tables import values

# Catalogue thresholds.
MIN_DOCS = 5
WORD_CHARS = 8
PAIR_CHARS = 5
LONG_CHARS = 10
# Fixed values: (priority, source type, target type, trigger word, relation, reverse); '' = any type.
RULES = [
    (1, "", "", "by", "caused by", False),
    (2, "", "", "from", "delayed by", False),
    (3, "", "", "of", "part of", False),
    (4, "", "", "in", "contains", True),
    (5, "long", "", "with", "works with", False),
    (6, "", "", "and", "joins", False),
    (7, "", "", "the", "refers to", False),
]
CAUSES = ["caused by", "delayed by"]
TIME_PATTERN = r"(?i)\b(?:19|20)[0-9]{2}\b|\bfirst week\b|\b[0-9]+-(?:day|week)\b|\b[0-9]+\b"


def sentence_table(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sent, words)."""
    rows = df.select(key, F.posexplode(sentences(F.col(text))).alias("sent", "sentence"))
    return rows.select(key, "sent", tokens(F.col("sentence")).alias("words"), "sentence")


def _candidates(sents: DataFrame, key: str) -> DataFrame:
    """(key, sent, pos, alias, n): single words and two-word runs that may be names."""
    beside = F.arrays_zip(F.col("words").alias("tok"), F.slice("words", 2, F.size("words")).alias("follow"))  # no row carries its sentence
    words = sents.select(key, "sent", F.posexplode(beside).alias("pos", "w")).select(key, "sent", "pos", "w.tok", "w.follow")
    follow = F.col("follow")
    single = F.when(F.length("tok") >= WORD_CHARS, F.struct(F.col("tok").alias("alias"), F.lit(1).alias("n")))
    double = F.when(
        (F.length("tok") >= PAIR_CHARS) & (F.length(follow) >= PAIR_CHARS),
        F.struct(F.concat_ws(" ", "tok", follow).alias("alias"), F.lit(2).alias("n")),
    )
    return words.select(key, "sent", "pos", F.explode(F.array_compact(F.array(single, double))).alias("c")).select(key, "sent", "pos", "c.alias", "c.n")


def catalogue(sents: DataFrame, key: str = "doc_id") -> DataFrame:
    """(alias, entity, type): names that at least MIN_DOCS texts use. `sents` is a sentence table.

    A name's texts fall into 64 places by hash, marked in one number, so a task sends a row per name and not one per
    text and name. A name with MIN_DOCS places has that many texts; one with fewer, but as many uses, is counted by text."""
    cand = _candidates(sents, key).select(key, "alias")
    place = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(key), F.lit(64)).cast("int"))
    used = cand.groupBy("alias").agg(F.count("*").alias("uses"), F.bit_count(F.bit_or(place)).alias("places"))
    used = written(used.where(F.col("uses") >= MIN_DOCS), "used")
    close = written(used.where(F.col("places") < MIN_DOCS).select("alias"), "close")
    counted = cand.join(close, "alias", "left_semi").distinct().groupBy("alias").agg(F.count("*").alias("docs")).where(F.col("docs") >= MIN_DOCS)
    frequent = used.where(F.col("places") >= MIN_DOCS).select("alias").unionByName(counted.select("alias"))
    kind = F.when(F.contains("alias", F.lit(" ")), "pair").when(F.length("alias") >= LONG_CHARS, "long").otherwise("short")
    return written(frequent.select("alias", F.col("alias").alias("entity"), kind.alias("type")), "names")


def mentions(sents: DataFrame, names: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, sent, pos, n, alias, entity, type): longest name first, no overlaps.

    Read in order of position, so a sentence of any length costs one pass: of two-word names that hang together
    every second is kept, then the single words that none of them covers."""
    at = Window.partitionBy(key, "sent").orderBy("pos", F.desc("n"), "alias", "entity", "type")
    before, so_far = at.rowsBetween(Window.unboundedPreceding, -1), at.rowsBetween(Window.unboundedPreceding, 0)
    rows = _candidates(sents, key).join(names, "alias").withColumn("last", F.max(F.when(F.col("n") == 2, F.col("pos"))).over(before))
    rows = rows.withColumn("last_one", F.max(F.when(F.col("n") == 1, F.col("pos"))).over(before))
    starts = (F.col("n") == 2) & (F.col("last").isNull() | (F.col("last") < F.col("pos") - 1))
    rows = rows.withColumn("start", F.max(F.when(starts, F.col("pos"))).over(so_far))
    first = F.col("last").isNull() | (F.col("last") < F.col("pos"))
    rows = rows.withColumn("pair", (F.col("n") == 2) & first & ((F.col("pos") - F.col("start")) % 2 == 0))
    rows = rows.withColumn("covers", F.max(F.when(F.col("pair"), F.col("pos"))).over(so_far))
    single = (F.col("n") == 1) & (F.col("last_one").isNull() | (F.col("last_one") < F.col("pos"))) & (F.col("covers").isNull() | (F.col("covers") < F.col("pos") - 1))
    return rows.where(F.col("pair") | single).select(key, "sent", "pos", "n", "alias", "entity", "type")


def relations(sents: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, sent, source, relation, target, source_surface, target_surface).

    Consecutive mentions of a sentence, first rule whose trigger lies between. Only trigger words travel; others are null."""
    triggers = sorted({r[3] for r in RULES})
    marked = sents.where(F.arrays_overlap("words", F.array(*map(F.lit, triggers))))
    marked = marked.select(key, "sent", F.transform("words", lambda w: F.when(w.isin(*triggers), w)).alias("words"))
    per = found.groupBy(key, "sent").agg(F.array_sort(F.collect_list(F.struct("pos", "n", "entity", "type", "alias"))).alias("ms"))
    per = per.where(F.size("ms") > 1).join(marked, [key, "sent"])

    def pair(i: Column) -> Column:
        a, b = F.get("ms", i), F.get("ms", i + 1)
        end = a["pos"] + a["n"]
        return F.struct(a.alias("a"), b.alias("b"), F.slice("words", end + 1, F.greatest(b["pos"] - end, F.lit(0))).alias("between"))

    pairs = per.select(key, "sent", F.explode(F.transform(F.sequence(F.lit(0), F.size("ms") - 2), pair)).alias("p")).where("p.a.entity <> p.b.entity")
    rule = F.lit(None).cast("struct<relation:string,reverse:boolean>")
    for _, src, dst, trigger, name, reverse in sorted(RULES, reverse=True):
        hit = F.array_contains("p.between", trigger)
        if src:
            hit = hit & (F.col("p.a.type") == src)
        if dst:
            hit = hit & (F.col("p.b.type") == dst)
        rule = F.when(hit, F.struct(F.lit(name).alias("relation"), F.lit(reverse).alias("reverse"))).otherwise(rule)
    out = pairs.withColumn("r", rule).where("r IS NOT NULL")
    one = lambda x, y: F.when(F.col("r.reverse"), F.col(y)).otherwise(F.col(x))
    return out.select(
        key, "sent", one("p.a.entity", "p.b.entity").alias("source"), "r.relation", one("p.b.entity", "p.a.entity").alias("target"),
        one("p.a.alias", "p.b.alias").alias("source_surface"), one("p.b.alias", "p.a.alias").alias("target_surface"),
    )


def claims(sents: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, sent, clause_no, subject, claim, time): clauses with a time or number expression."""
    clauses = sents.select(key, "sent", F.posexplode(F.split("sentence", r";\s*|\s+and\s+")).alias("clause_no", "claim"))
    dated = clauses.withColumn("time", F.regexp_extract("claim", TIME_PATTERN, 0)).where("time <> ''")
    subject = found.groupBy(key, "sent").agg(F.min_by("entity", "pos").alias("subject"))
    return dated.join(subject, [key, "sent"]).select(key, "sent", "clause_no", "subject", F.btrim("claim", F.lit(" .")).alias("claim"), "time")


def edges(rels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(source, target, weight, relations, chunks, first_chunk, last_chunk)."""
    return rels.groupBy("source", "target").agg(
        F.count("*").alias("weight"),
        F.array_join(F.array_sort(F.collect_set("relation")), "|").alias("relations"),
        F.countDistinct(key).alias("chunks"),
        F.min(key).alias("first_chunk"),
        F.max(key).alias("last_chunk"),
    )


def canonical(name: Column) -> Column:
    """Alias rule of the sample corpus: inflected forms share a name."""
    return F.array_join(F.transform(F.split(name, " "), stem), " ")


def undirected(e: DataFrame) -> DataFrame:
    """(a, b, weight) in both directions, parallel edges added up."""
    both = e.select(F.col("source").alias("a"), F.col("target").alias("b"), "weight").unionByName(
        e.select(F.col("target").alias("a"), F.col("source").alias("b"), "weight")
    )
    return both.groupBy("a", "b").agg(F.sum("weight").alias("weight"))


def bridges(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(previous, key, shared, n): neighbouring texts of an entity and what they share.

    Each entity links consecutive texts only: a chain per entity, not all pairs."""
    uses = found.select("entity", key).distinct()
    chain = last_k_before(uses, "entity", key, F.col(key), 1, 1_000_000, "before")
    links = chain.where(F.size("before") > 0).select(F.get("before", F.lit(0)).alias("previous"), key, "entity")
    return links.groupBy("previous", key).agg(F.count("*").alias("n"), F.min("entity").alias("first_shared"), F.max("entity").alias("last_shared"))


def rule_table(spark) -> DataFrame:
    return values(spark, "priority INT, src STRING, dst STRING, trigger STRING, relation STRING, reverse BOOLEAN", RULES)
