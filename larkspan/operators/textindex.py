"""A stored text index: kept up by batches, read by searches that tokenise no document.

One folder holds, per batch, what the batch added and nothing else:

  postings  a row per (term, block of about BLOCK documents of like length): how many documents, the greatest
            term frequency, the shortest length, and the documents' places in the block; in folders by hash of the term
  docs      a row per document: its number in the batch, length, distinct terms and their frequencies, hashed words in
            order of their numbers, attributes to filter by and to show
  sizes     how many blocks there are of a length; with it a document's block and place follow from its row
  terms     signed document frequencies;  totals  signed numbers of documents and words
  gone      keys whose rows of earlier batches no longer count
  commits   written last: readers take batches up to the newest commit, so a half-written batch is never seen

A batch that sends a key again replaces the document: the old rows stay and are
skipped, their counts are taken back by negative rows. A batch that is replayed
overwrites its own folders.

Searches are block-max: the frequencies and lengths of the postings' heads
bound what a block can score for a question. The best blocks of each question
are scored first, their k-th score is the bar, and only blocks whose bound
reaches it are read in full. A batch of questions is answered in one job.

Defined results: null text is empty and such a document is never found; rows
that repeat a key within a batch, or have none, are documents by themselves; a
question without words finds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspan.functions.text import let, tokens
from larkspan.operators.search import B, DECIMALS, K1, hashed
from larkspan.operators.skew import top_n
from larkspan.storage import derived, scratch, written

BLOCK = 128  # documents of a block, on average
PARTS = 16  # folders of postings
QUESTIONS = 1024  # questions of a block that meet its postings at once, on average
SEEDS = 4  # blocks scored first, beyond those that k documents fill
SLACK = 2 * 10.0**-DECIMALS  # scores are rounded before they are ranked


@dataclass(frozen=True)
class TextIndex:
    """A folder of the shared store; `columns` declares the key of documents and the attributes kept with them."""

    spark: SparkSession
    path: str
    columns: str = "doc_id BIGINT, lang STRING, source STRING"

    @property
    def _types(self) -> dict[str, str]:
        return dict(c.strip().split(" ", 1) for c in self.columns.split(","))

    @property
    def key(self) -> str:
        return next(iter(self._types))

    @property
    def shown(self) -> tuple[str, ...]:
        return tuple(self._types)[1:]

    def _schema(self, name: str) -> str:
        key, typ = next(iter(self._types.items()))
        own = {
            "postings": f"term STRING, block BIGINT, n BIGINT, uses BIGINT, max_tf INT, min_len INT, places ARRAY<INT>, tfs ARRAY<INT>, part INT",
            "docs": ", ".join([f"{key} {typ}, row BIGINT, len INT, terms ARRAY<STRING>, tfs ARRAY<INT>, buckets ARRAY<INT>", *(f"{c} {self._types[c]}" for c in self.shown)]),
            "sizes": "class INT, blocks BIGINT",
            "terms": "term STRING, df BIGINT",
            "totals": "docs BIGINT, words BIGINT",
            "gone": f"{key} {typ}",
        }
        return f"{own[name]}, batch_id INT"

    def upto(self) -> int:
        """The newest batch; -1 for none."""
        try:
            commits = self.spark.read.schema("at BIGINT").parquet(f"{self.path}/commits/batch_id=*")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return -1
        return commits.agg(F.coalesce(F.max("at"), F.lit(-1))).first()[0]

    def table(self, name: str, upto: int) -> DataFrame:
        """Rows of all batches up to one, with their `batch_id`."""
        return self.spark.read.schema(self._schema(name)).parquet(f"{self.path}/{name}").where(F.col("batch_id") <= upto)

    def docs(self, upto: int | None = None) -> DataFrame:
        """(key, batch_id, len, terms, buckets, shown...) of the documents that count."""
        at = self.upto() if upto is None else upto
        gone = self.table("gone", at).select(F.col(self.key).alias("__key"), F.col("batch_id").alias("__since"))
        d = self.table("docs", at)
        return d.join(gone, (d[self.key] == F.col("__key")) & (d["batch_id"] < F.col("__since")), "left_anti")


def _counted(words: Column) -> Column:
    """array<struct<term, tf>> of an array of words, from its sorted form."""

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)))
        ends = let(starts, lambda b: F.transform(b, lambda i, j: F.struct(F.get(s, i - 1).alias("term"), (F.coalesce(F.get(b, j + 1), F.size(s) + 1) - i).alias("tf"))))
        return F.when(F.size(s) > 0, ends).otherwise(F.array().cast("array<struct<term:string,tf:int>>"))

    return let(F.array_sort(words), runs)


def _part(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(PARTS)).cast("int")


def _store(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def _in_blocks(docs: DataFrame, sizes: DataFrame, *batch: str) -> DataFrame:
    """Documents with their block, drawn among those of a like length, and their place in it, counted by row."""
    classed = docs.withColumn("class", _class(F.col("len")))
    blocks = classed.join(F.broadcast(sizes), ["class", *batch])  # one row per half power of two
    blocks = blocks.withColumn("block", F.col("class") * F.lit(1 << 32) + F.pmod(F.xxhash64("row"), F.col("blocks"))).drop("class", "blocks")
    return blocks.withColumn("place", F.row_number().over(Window.partitionBy(*batch, "block").orderBy("row")) - 1)


def _class(length: Column) -> Column:
    return F.floor(2 * F.log2(length + 1)).cast("int")


def add_batch(index: TextIndex, docs: DataFrame, batch_id: int, text: str = "text") -> None:
    """Index new and replaced documents as one batch; only folders of this batch are written."""
    at, key = f"batch_id={batch_id}", index.key
    words = tokens(F.coalesce(F.col(text), F.lit("")))
    body = docs.select(key, *index.shown, _counted(words).alias("counts"), F.array_sort(hashed(F.coalesce(F.col(text), F.lit("")))).alias("buckets"))
    of = lambda field: F.transform("counts", lambda c: c[field]).alias(f"{field}s")
    _store(body.select(key, F.monotonically_increasing_id().alias("row"), F.size("buckets").alias("len"), of("term"), of("tf"), "buckets", *index.shown), f"{index.path}/docs/{at}")
    body = index.spark.read.schema(index._schema("docs")).parquet(f"{index.path}/docs/{at}")
    _store(body.groupBy(_class(F.col("len")).alias("class")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), f"{index.path}/sizes/{at}")
    sizes = index.spark.read.schema("class INT, blocks BIGINT").parquet(f"{index.path}/sizes/{at}")
    # a document's words move once, packed, to its block's task, where its postings are made
    packed = _in_blocks(body.select("row", "len", F.array_join("terms", " ").alias("terms"), "tfs"), sizes)
    posted = packed.where("len > 0").select("len", "block", "place", F.explode(F.arrays_zip(F.split("terms", " ").alias("term"), F.col("tfs").alias("tf"))).alias("c")).select("len", "block", "place", "c.term", "c.tf")
    posted = posted.groupBy("term", "block").agg(
        F.count("*").alias("n"), F.sum("tf").alias("uses"), F.max("tf").alias("max_tf"), F.min("len").alias("min_len"), F.collect_list(F.struct("place", "tf")).alias("docs")
    )
    posted = posted.withColumn("places", F.transform("docs", lambda d: d["place"])).withColumn("tfs", F.transform("docs", lambda d: d["tf"])).drop("docs")
    posted = posted.withColumn("part", _part(F.col("term"))).sortWithinPartitions("part", "term", "block")
    posted.write.mode("overwrite").option("compression", "zstd").partitionBy("part").parquet(f"{index.path}/postings/{at}")
    _finish(index, batch_id, body.select(key).distinct(), _document_frequencies(index, at), body.agg(F.count("*").alias("docs"), F.coalesce(F.sum("len"), F.lit(0)).alias("words")))


def _document_frequencies(index: TextIndex, at: str) -> DataFrame:
    return index.spark.read.schema(index._schema("docs")).parquet(f"{index.path}/docs/{at}").select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def remove_batch(index: TextIndex, keys: DataFrame, batch_id: int) -> None:
    """Take documents out; as a batch, it only adds files."""
    none = index.spark.range(0)
    _finish(index, batch_id, keys.select(index.key).distinct(), none.select(F.lit("").alias("term"), F.col("id").alias("df")), none.select(F.col("id").alias("docs"), F.col("id").alias("words")))


def _finish(index: TextIndex, batch_id: int, keys: DataFrame, df: DataFrame, totals: DataFrame) -> None:
    at, key, before = f"batch_id={batch_id}", index.key, batch_id - 1
    if index.upto() >= 0 and before >= 0:
        old = index.docs(before).join(keys, key, "left_semi").select(key, "terms", "len")
        old = written(old, "replaced")
        df = df.unionByName(old.select(F.explode("terms").alias("term")).groupBy("term").agg((-F.count("*")).alias("df")))
        totals = totals.unionByName(old.agg((-F.count("*")).alias("docs"), (-F.coalesce(F.sum("len"), F.lit(0))).alias("words")))
        gone = old.select(key).distinct()
    else:
        gone = keys.limit(0)
    _store(df, f"{index.path}/terms/{at}")
    _store(totals, f"{index.path}/totals/{at}")
    _store(gone, f"{index.path}/gone/{at}")
    _store(index.spark.range(1).select(F.lit(batch_id).cast("bigint").alias("at")), f"{index.path}/commits/{at}")


def _gain(tf: Column, length: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.col("avg_len")))


def _members(index: TextIndex, at: int, where: Column | None = None) -> DataFrame:
    """(batch_id, block, members): the documents of each block by place, and whether they still count and `where` lets them through."""
    key = index.key
    gone = index.table("gone", at).groupBy(F.col(key).alias("__key")).agg(F.max("batch_id").alias("__since"))
    docs = index.table("docs", at).withColumn("__ok", F.lit(True) if where is None else F.coalesce(where, F.lit(False)))
    docs = docs.select(F.col(key).alias("doc"), "row", "len", "batch_id", "__ok")
    docs = docs.join(gone, docs["doc"] == F.col("__key"), "left")
    docs = docs.select("doc", "row", "len", "batch_id", (F.col("__ok") & (F.col("__since").isNull() | (F.col("batch_id") >= F.col("__since")))).alias("ok"))
    placed = _in_blocks(docs, index.table("sizes", at), "batch_id")
    members = F.array_sort(F.collect_list(F.struct("place", "doc", "row", "len", "ok")))
    return written(placed.groupBy("batch_id", "block").agg(members.alias("members")), "members")


def search(index: TextIndex, queries: DataFrame, qkey: str, k: int, where: Column | None = None, show: Sequence[str] = (), text: str = "text") -> DataFrame:
    """(qkey, key, score, rank, show...): the k best documents of each question by BM25, of those that `where`
    (over the attributes) lets through. Statistics are those of the whole index, whatever the filter."""
    at, key = index.upto(), index.key
    asked = queries.select(F.col(qkey).alias("q"), F.explode(F.array_distinct(tokens(F.col(text)))).alias("term")).withColumn("part", _part(F.col("term")))
    if at < 0:
        raise ValueError(f"no index at {index.path}")
    totals = index.table("totals", at).agg(F.sum("docs").alias("n_docs"), F.try_divide(F.sum("words"), F.sum("docs")).alias("avg_len"))  # one row
    df = index.table("terms", at).join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = written(asked.join(df, "term").join(F.broadcast(totals)).select("q", "term", "part", idf.alias("idf"), "avg_len"), "asked")
    postings = index.table("postings", at)
    terms = asked.select("part", "term").distinct()
    heads = postings.select("part", "term", "batch_id", "block", "max_tf", "min_len").join(terms, ["part", "term"], "left_semi")
    met = heads.repartition("batch_id", "block").join(asked, ["part", "term"])  # a task adds up whole blocks
    bounds = met.groupBy("q", "batch_id", "block").agg(F.sum(F.col("idf") * _gain(F.col("max_tf"), F.col("min_len"))).alias("bound"))
    bounds = written(bounds, "bounds")
    groups = -(-asked.select("q").distinct().count() // QUESTIONS)
    group = F.pmod(F.xxhash64("q"), F.lit(max(groups, 1)))
    members = _members(index, at, where)

    def scores(pairs: DataFrame) -> DataFrame:
        # postings move once, to their block's task, beside the numbers of the questions that want the block; all words
        # of a document lie there, so its score is added up in place and a task sends k documents a question
        wanted = pairs.groupBy("batch_id", "block", group.alias("group")).agg(F.collect_set("q").alias("qs")).join(members, ["batch_id", "block"])
        hits = postings.select("part", "term", "batch_id", "block", "places", "tfs").join(terms, ["part", "term"], "left_semi")
        hits = hits.repartition("batch_id", "block").join(wanted, ["batch_id", "block"])
        named = F.filter(F.zip_with("places", "tfs", lambda p, tf: F.struct(F.get("members", p).alias("m"), tf.alias("tf"))), lambda d: d["m"]["ok"])
        hits = hits.select("part", "term", "group", "qs", "batch_id", "block", named.alias("docs"))
        hits = hits.join(asked.withColumn("group", group), ["part", "term", "group"]).where(F.array_contains("qs", F.col("q")))
        one = hits.select("q", "batch_id", "block", "idf", "avg_len", F.explode("docs").alias("d"))
        one = one.select("q", "batch_id", "block", F.col("d.m.doc").alias(key), "d.m.row", (F.col("idf") * _gain(F.col("d.tf"), F.col("d.m.len"))).alias("s"))
        return one.groupBy("q", "batch_id", "block", "row", key).agg(F.round(F.sum("s"), DECIMALS).alias("score"))

    order = [F.desc("bound"), F.col("batch_id"), F.col("block")]
    first = top_n(bounds, ["q"], order, -(-k // BLOCK) + SEEDS, "at").drop("at")
    bar = top_n(scores(first), ["q"], [F.desc("score"), F.col(key)], k, "at").where(F.col("at") == k).select("q", F.col("score").alias("bar"))
    left = bounds.join(bar, "q", "left").where(F.col("bar").isNull() | (F.col("bound") >= F.col("bar") - SLACK))
    best = top_n(scores(left), ["q"], [F.desc("score"), F.col(key)], k, "rank").withColumn("rank", F.col("rank").cast("bigint"))
    if show:
        seen = index.table("docs", at).select("row", "batch_id", *show)
        best = best.join(seen, ["row", "batch_id"])
    return best.select(F.col("q").alias(qkey), key, "score", "rank", *show)


def index_of(t) -> TextIndex:
    """The index of a directory's documents, built once per state of its files in this application."""

    def build() -> TextIndex:
        index = TextIndex(t.spark, scratch(t.spark, "index"))
        add_batch(index, t.texts, 0)
        return index

    return derived(t, "index", build)


def holding(index: TextIndex, queries: DataFrame, qkey: str, text: str = "text") -> DataFrame:
    """(qkey, key): documents that hold the rarest inner word of a passage. Every document with the passage
    in it is among them, since only the first and the last word of a passage can be part of a longer one.
    Passages of fewer than three words have no inner word and find nothing."""
    at = index.upto()
    words = tokens(F.col(text))
    inner = queries.select(F.col(qkey).alias("q"), F.explode(F.array_distinct(F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0))))).alias("term"))
    df = index.table("terms", at).join(inner.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    rare = inner.join(df, "term", "left").groupBy("q").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")).alias("r")).select("q", "r.term")
    hits = rare.withColumn("part", _part(F.col("term"))).join(index.table("postings", at).select("part", "term", "batch_id", "block", "places"), ["part", "term"])
    hits = written(hits.select("q", "batch_id", "block", "places"), "hits").join(_members(index, at), ["batch_id", "block"])
    found = hits.select(F.col("q").alias(qkey), F.explode("places").alias("p"), "members").select(qkey, F.get("members", F.col("p"))["doc"].alias(index.key)).distinct()
    return found.join(index.docs(at).select(index.key).distinct(), index.key, "left_semi")


def stored_sets(t) -> tuple[DataFrame, str, DataFrame]:
    """The distinct words of every document (doc_id, words), their key, and (w, df) of all words; from the stored index."""
    index = index_of(t)
    df = index.table("terms", index.upto()).groupBy(F.col("term").alias("w")).agg(F.sum("df").alias("df"))
    return index.docs().select("doc_id", F.col("terms").alias("words")), "doc_id", df
