"""Streaming and incremental jobs over the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspan import lexicons as lx
from larkspan.functions import scoring
from larkspan.functions.text import tokens
from larkspan.operators.textindex import TextIndex, add_batch, search
from larkspan.plans import sqltext as q
from larkspan.plans.retrieval import _BM25
from larkspan.registry import query
from larkspan.storage import scratch
from larkspan.streaming.runs import WATERMARK, batch_folder, clock, event_time, file_stream, first_arrivals, run_batches, run_to_files
from larkspan.tables import SCHEMAS, values


@query("SELECT doc_id, lang, source, CAST(length(text) AS INTEGER) AS chars FROM documents")
def st_ingest_files(t):
    """New files only, run when there is data; a second run finds nothing to do."""
    out, ck = scratch(t.spark, "ingested"), scratch(t.spark, "ck")
    for _ in range(2):
        src = file_stream(t.spark, t.path("documents"), SCHEMAS["documents"])
        run_to_files(src.select("doc_id", "lang", "source", F.length("text").alias("chars")), out, ck)
    return t.spark.read.parquet(out)


ACTIONS = "seq BIGINT, action STRING, doc_id BIGINT, source STRING, chars INT"


def current_state(log):
    """Latest action per key decides; a deleted key is gone. Merge on read: changes
    are appended, nothing stored is rewritten until a compaction."""
    last = log.groupBy("doc_id").agg(F.max_by(F.struct("action", "source", "chars"), "seq").alias("r"))
    return last.where("r.action <> 'DELETE'").select("doc_id", "r.source", "r.chars")


@query(
    """
SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'curated' ELSE d.source END AS source, CAST(length(text) AS INTEGER) AS chars
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(l.toxic, 0) = 0"""
)
def st_cdc_insert_delete(t):
    """A change stream of inserts, updates (delete + insert) and deletes, applied per batch."""
    feed, out, ck = scratch(t.spark, "feed"), scratch(t.spark, "state"), scratch(t.spark, "ck")
    docs = t.documents.select("doc_id", "source", F.length("text").alias("chars"))
    row = lambda seq, action: (F.lit(seq).cast("bigint").alias("seq"), F.lit(action).alias("action"))
    inserts = docs.select(*row(1, "INSERT"), "doc_id", "source", "chars")
    good = docs.join(t.labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi")
    updates = good.select(*row(2, "DELETE"), "doc_id", "source", "chars").unionByName(good.select(*row(3, "INSERT"), "doc_id", F.lit("curated").alias("source"), "chars"))
    deletes = docs.join(t.labels.where("toxic = 1").select("doc_id"), "doc_id", "left_semi").select(*row(4, "DELETE"), "doc_id", "source", "chars")
    for part in (inserts, updates, deletes):
        part.write.mode("append").parquet(feed)
    for _ in range(2):
        run_batches(file_stream(t.spark, feed, ACTIONS, 2), batch_folder(out), ck)
    log = t.spark.read.schema(ACTIONS).option("basePath", out).parquet(f"{out}/batch_id=*")
    return current_state(log)


@query(
    f"""
SELECT term, count(DISTINCT doc_id) AS docs, CAST(count(*) AS BIGINT) AS uses FROM (SELECT doc_id, unnest({q.toks('text')}) AS term FROM documents) GROUP BY 1"""
)
def st_target_lag(t):
    """A stored index kept up by the batches of a stream: what it knows of each term."""
    index = _followed(t)
    heads = index.table("postings", index.upto())
    return heads.groupBy("term").agg(F.sum("n").alias("docs"), F.sum("uses").alias("uses"))


def _followed(t) -> TextIndex:
    """The index of a feed of two files, each a batch of the stream; the second one only adds files."""
    feed, ck = scratch(t.spark, "feed"), scratch(t.spark, "ck")
    for half in (0, 1):
        t.documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == half).coalesce(1).write.mode("append").parquet(feed)
    index = TextIndex(t.spark, scratch(t.spark, "index"))
    run_batches(file_stream(t.spark, feed, SCHEMAS["documents"], 1), keeps(index), ck)
    return index


def keeps(index: TextIndex):
    """A sink for `run_batches` or, within a target lag, `run_refreshing`."""
    return lambda batch, batch_id: add_batch(index, batch, batch_id)


@query(f"WITH {_BM25} SELECT item_id, doc_id, score, rank FROM lex WHERE rank <= 5")
def st_index_search(t):
    """Questions answered by the index that the stream keeps; no document is tokenised for them."""
    return search(_followed(t), t.benchmark, "item_id", 5)


@query()
def st_audit_log(t):
    """One row per processed batch: rows, first and last event time, or a skipped run."""
    feed, out, ck = scratch(t.spark, "feed"), scratch(t.spark, "audit"), scratch(t.spark, "ck")
    t.events.repartition(3, "user_id").write.parquet(feed)
    sink = batch_folder(out)

    def apply(batch, batch_id):
        sink(batch.agg(F.count("*").alias("rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")), batch_id)

    runs = []
    for run in (1, 2):
        done = run_batches(file_stream(t.spark, feed, SCHEMAS["events"], 1), apply, ck)
        runs.append((run, sum(p.numInputRows for p in done.recentProgress)))
    audit = t.spark.read.schema("rows BIGINT, first_ts TIMESTAMP_NTZ, last_ts TIMESTAMP_NTZ, batch_id INT").option("basePath", out).parquet(out)
    skipped = [(f"run {r}", "skipped: no new data") for r, n in runs if n == 0]
    log = audit.select(F.concat(F.lit("batch "), "batch_id").alias("step"), F.concat(F.lit("rows "), "rows").alias("status"))
    return log.unionByName(values(t.spark, "step STRING, status STRING", skipped)) if skipped else log


_P, _N = q.pos_neg(q.toks("text"), lx.SAMPLE_SENTIMENT)


@query(
    f"""
WITH s AS (SELECT conv_id, turn, {_P} AS p, {_N} AS n, {q.labels(q.toks('text'), lx.TOPIC_TERMS)}[1].label AS label FROM conversations)
SELECT conv_id, turn, {q.sentiment('p', 'n')} AS sentiment, coalesce(label, 'other') AS category, round((p + n) / sqrt((p + n) * (p + n) + {lx.ALPHA}), 6) AS score,
  (p + n) / sqrt((p + n) * (p + n) + {lx.ALPHA}) < -0.5 AS escalate FROM s"""
)
def st_feedback_enrich(t, escalate_below: float = -0.5):
    out, ck = scratch(t.spark, "feedback"), scratch(t.spark, "ck")
    src = file_stream(t.spark, t.path("conversations"), SCHEMAS["conversations"])
    run_to_files(enrich_messages(src, escalate_below), out, ck)
    return t.spark.read.parquet(out)


def enrich_messages(df, escalate_below: float = -0.5):
    """Sentiment, category and escalation per message; the same for a stream and a batch."""
    pos, neg = scoring.polarity(F.col("w"), lx.SAMPLE_SENTIMENT)
    s = df.select("conv_id", "turn", tokens(F.col("text")).alias("w")).select("conv_id", "turn", pos.alias("p"), neg.alias("n"), scoring.best_label(F.col("w"), lx.TOPIC_TERMS).alias("label"))
    score = scoring.squash(F.col("p") + F.col("n"))
    return s.select(
        "conv_id", "turn", scoring.sentiment_label(F.col("p"), F.col("n")).alias("sentiment"), F.coalesce("label", F.lit("other")).alias("category"),
        F.round(score, 6).alias("score"), (score < escalate_below).alias("escalate"),
    )


def daily(df):
    w = df.withWatermark("ts", WATERMARK).groupBy(F.window("ts", "1 day"), "event_type")
    return w.agg(F.count("*").alias("n"), F.sum("value").alias("v")).select(
        clock(F.col("window.start")).alias("window_start"), "event_type", "n", F.round("v", 2).alias("total")
    )


_CLOSED = "window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"
_DAILY = f"""
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, n, total FROM (
  SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2, 3) WHERE {_CLOSED}"""


@query(_DAILY)
def st_windowed_counts(t):
    """Daily counts in append mode: a window is emitted once the watermark has passed it."""
    out, ck = scratch(t.spark, "daily"), scratch(t.spark, "ck")
    run_to_files(daily(event_time(file_stream(t.spark, t.path("events"), SCHEMAS["events"]))), out, ck)
    return t.spark.read.parquet(out)


@query(
    """
WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM g),
x AS (SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 30 MINUTE AS window_end, count(*) AS n FROM s GROUP BY user_id, session)
SELECT user_id, strftime(started, '%Y-%m-%d %H:%M:%S') AS started, n FROM x WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""
)
def st_session_memory(t, gap: str = "30 minutes"):
    """Sessions per user, closed by inactivity."""
    out, ck = scratch(t.spark, "sessions"), scratch(t.spark, "ck")
    src = event_time(file_stream(t.spark, t.path("events"), SCHEMAS["events"])).withWatermark("ts", WATERMARK)
    g = src.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    run_to_files(g.select("user_id", clock(F.col("session_window.start")).alias("started"), "n"), out, ck)
    return t.spark.read.parquet(out)


@query("SELECT event_id, user_id, event_type, value FROM events")
def st_dedupe(t):
    """Uploads that arrive in three runs, the later half of the events first: every event is kept once,
    late first arrivals too, and no copy of another run."""
    feed, out, ck = scratch(t.spark, "feed"), scratch(t.spark, "unique"), scratch(t.spark, "ck")
    late = F.pmod(F.xxhash64("user_id"), F.lit(2)) == 0
    for upload in (t.events.where(~late), t.events, t.events.where(late)):
        upload.write.mode("append").parquet(feed)
        run_batches(file_stream(t.spark, feed, SCHEMAS["events"]), first_arrivals(out, "event_id"), ck)
    return t.spark.read.schema(SCHEMAS["events"]).parquet(f"{out}/rows/batch_id=*").select("event_id", "user_id", "event_type", "value")


@query(f"SELECT *, true AS late_rows_dropped FROM ({_DAILY})")
def st_late_data(t):
    """Rows behind the watermark change no closed window and are counted.

    The engine reports them per batch as dropped by the watermark."""
    first, out, ck = scratch(t.spark, "feed"), scratch(t.spark, "late"), scratch(t.spark, "ck")
    t.events.write.parquet(first)
    done = [run_to_files(daily(event_time(file_stream(t.spark, first, SCHEMAS["events"]))), out, ck)]
    late = t.events.where(F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz"))
    late.write.mode("append").parquet(first)
    done.append(run_to_files(daily(event_time(file_stream(t.spark, first, SCHEMAS["events"]))), out, ck))
    dropped = sum(s.numRowsDroppedByWatermark for d in done for p in d.recentProgress for s in p.stateOperators)
    return t.spark.read.parquet(out).withColumn("late_rows_dropped", F.lit(dropped > 0))
