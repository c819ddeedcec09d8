"""Text analytics: classify, score, extract, redact, summarise, count, check."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspan import lexicons as lx
from larkspan.functions import pii, scoring
from larkspan.functions.text import NUMBER_PATTERN, numbers, sentences, tokens, word_count
from larkspan.operators.bpe import learn_merges
from larkspan.operators.enrich import enrich_cached as enrich
from larkspan.operators.enrich import stub_provider
from larkspan.operators.extractive import distinctive_terms, summarize_groups, summarize_rows
from larkspan.operators.setjoin import most_shared
from larkspan.operators.similarity import near_duplicates
from larkspan.operators.skew import prefix_sums, top_n
from larkspan.operators.textindex import stored_sets
from larkspan.operators.vectors import best_per_query, label_centroids
from larkspan.plans import sqltext as q
from larkspan.plans.relational import CENTROIDS_SQL
from larkspan.registry import query
from larkspan.storage import scratch, written
from larkspan.tables import values

DESCRIBED = scoring.described_terms(lx.DESCRIBED_LABELS)


def with_words(df, *keep: str):
    return df.select(*keep, "text", tokens(F.col("text")).alias("words"))


@query(f"SELECT doc_id, {q.labels(q.toks('text'), lx.TOPIC_TERMS)}[1].label AS label FROM documents")
def ai_classify_single(t):
    return with_words(t.texts, "doc_id").select("doc_id", scoring.best_label(F.col("words"), lx.TOPIC_TERMS).alias("label"))


@query(
    f"""
WITH s AS (SELECT doc_id, {q.labels(q.toks('text'), DESCRIBED)} AS s FROM documents)
SELECT doc_id, s[1].label AS label, round(-s[1].neg, 4) AS score FROM s"""
)
def ai_classify_described(t):
    s = with_words(t.texts, "doc_id").select("doc_id", F.get(scoring.label_scores(F.col("words"), DESCRIBED), F.lit(0)).alias("s"))
    return s.select("doc_id", "s.label", F.round(-F.col("s.neg"), 4).alias("score"))


@query(
    f"""
SELECT doc_id, r.label AS label, round(-r.neg, 4) AS score FROM (
  SELECT doc_id, unnest(list_filter({q.labels(q.toks('text'), lx.TOPIC_TERMS)}, lambda r: -r.neg >= 3)) AS r FROM documents)"""
)
def ai_classify_multi(t):
    s = scoring.label_scores(F.col("words"), lx.TOPIC_TERMS)
    rows = with_words(t.texts, "doc_id").select("doc_id", F.explode(F.filter(s, lambda r: -r["neg"] >= 3)).alias("r"))
    return rows.select("doc_id", "r.label", F.round(-F.col("r.neg"), 4).alias("score"))


@query(
    f"""
WITH p AS (SELECT doc_id, CAST({q.has(q.toks('text'), list(lx.TOPIC_TERMS['abuse']))} AS INTEGER) AS predicted FROM documents)
SELECT toxic, predicted, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share,
       round(sum(sum(CASE WHEN toxic = predicted THEN 1 ELSE 0 END)) OVER () / sum(count(*)) OVER (), 6) AS agreement
FROM labels JOIN p USING (doc_id) GROUP BY 1, 2"""
)
def ai_classify_agreement(t):
    """Confusion counts and agreement of the abuse label with the human flag."""
    hit = scoring.has_cue(tokens(F.col("text")), list(lx.TOPIC_TERMS["abuse"]))
    rows = t.texts.select("doc_id", "text").join(t.labels.select("doc_id", "toxic"), "doc_id")
    g = rows.groupBy("toxic", hit.cast("int").alias("predicted")).agg(F.count("*").alias("n"))
    w = Window.partitionBy()  # four rows at most
    right = F.sum(F.when(F.col("toxic") == F.col("predicted"), F.col("n")).otherwise(0)).over(w)
    return g.select(
        "toxic", "predicted", "n", F.round(F.col("n") / F.sum("n").over(w), 6).alias("share"), F.round(right / F.sum("n").over(w), 6).alias("agreement")
    )


@query(
    f"""
SELECT doc_id, {q.has(q.toks('text'), list(lx.TOPIC_TERMS['abuse']))} AS is_abusive,
       regexp_matches(text, '{pii.PATTERNS["EMAIL"]}') AS has_email,
       {q.has(q.toks('text'), ['licensed', 'license'])} AND {q.has(q.toks('text'), ['under'])} AS is_license
FROM documents
WHERE {q.has(q.toks('text'), list(lx.TOPIC_TERMS['abuse']))} OR regexp_matches(text, '{pii.PATTERNS["EMAIL"]}')
   OR {q.has(q.toks('text'), ['licensed', 'license'])}"""
)
def ai_filter_predicate(t):
    """Several named predicates from one scan, used as flags and as the filter."""
    w = F.col("words")
    lic = scoring.has_cue(w, ["licensed", "license"])
    flags = with_words(t.texts, "doc_id").select(
        "doc_id", scoring.has_cue(w, list(lx.TOPIC_TERMS["abuse"])).alias("is_abusive"),
        F.col("text").rlike(pii.PATTERNS["EMAIL"]).alias("has_email"), lic.alias("mentions_license"), (lic & scoring.has_cue(w, ["under"])).alias("is_license"),
    )
    return flags.where("is_abusive OR has_email OR mentions_license").drop("mentions_license")


_PN = q.pos_neg(q.toks("text"), lx.SAMPLE_SENTIMENT)


@query(
    f"""
WITH s AS (SELECT doc_id, {_PN[0]} AS p, {_PN[1]} AS n FROM documents)
SELECT doc_id, round((p + n) / sqrt((p + n) * (p + n) + {lx.ALPHA}), 6) AS score, {q.sentiment('p', 'n')} AS sentiment FROM s"""
)
def ai_sentiment_overall(t):
    pos, neg = scoring.polarity(F.col("words"), lx.SAMPLE_SENTIMENT)
    s = with_words(t.texts, "doc_id").select("doc_id", pos.alias("p"), neg.alias("n"))
    return s.select("doc_id", F.round(scoring.squash(F.col("p") + F.col("n")), 6).alias("score"), scoring.sentiment_label(F.col("p"), F.col("n")).alias("sentiment"))


def _aspect_sql() -> str:
    parts = []
    for name, cues in sorted(lx.ASPECTS.items()):
        chosen = f"list_filter({q.sents('text')}, lambda s: len(list_filter({q.toks('s')}, lambda w: w IN {q.in_list(cues)})) > 0)"
        words = q.toks(f"array_to_string({chosen}, ' ')")
        p, n = q.pos_neg("w", lx.SAMPLE_SENTIMENT)
        parts.append(f"SELECT conv_id, turn, '{name}' AS aspect, {q.sentiment('p', 'n')} AS sentiment FROM (SELECT conv_id, turn, {p} AS p, {n} AS n FROM (SELECT conv_id, turn, {words} AS w FROM conversations))")
    p, n = q.pos_neg("w", lx.SAMPLE_SENTIMENT)
    parts.append(f"SELECT conv_id, turn, 'overall', {q.sentiment('p', 'n')} FROM (SELECT conv_id, turn, {p} AS p, {n} AS n FROM (SELECT conv_id, turn, {q.toks('text')} AS w FROM conversations))")
    return " UNION ALL ".join(parts)


def aspect_sentiment(df, keys: list[str], aspects: dict[str, list[str]], lexicon: dict[str, float]):
    """(keys, aspect, sentiment) with an `overall` row; one pass over the text."""
    scoring.check_aspects(aspects)
    cols = [scoring.aspect_words(F.col("text"), cues).alias(f"w_{a}") for a, cues in aspects.items()]
    rows = df.select(*keys, tokens(F.col("text")).alias("w_overall"), *cols)
    structs = []
    for a in ["overall", *aspects]:
        pos, neg = scoring.polarity(F.col(f"w_{a}"), lexicon)
        structs.append(F.struct(F.lit(a).alias("aspect"), scoring.sentiment_label(pos, neg).alias("sentiment")))
    return rows.select(*keys, F.explode(F.array(*structs)).alias("r")).select(*keys, "r.aspect", "r.sentiment")


@query(_aspect_sql())
def ai_sentiment_aspect(t):
    return aspect_sentiment(t.conversations, ["conv_id", "turn"], lx.ASPECTS, lx.SAMPLE_SENTIMENT)


@query(
    f"""
WITH s AS (SELECT doc_id, {q.count_in(q.toks('text'), [w for w, v in lx.SAMPLE_SENTIMENT.items() if v > 0])} AS a,
  {q.count_in(q.toks('text'), [w for w, v in lx.SAMPLE_SENTIMENT.items() if v < 0])} AS b, {_PN[0]} + {_PN[1]} AS x, n_chars % 5 + 1 AS r FROM documents)
SELECT doc_id, round((a - b) / greatest(a + b, 1), 6) AS probability_difference, round(x / sqrt(x * x + {lx.ALPHA}), 6) AS lexicon_score,
       round((r - 3) / 2, 6) AS rating_score, x / sqrt(x * x + {lx.ALPHA}) < {lx.ESCALATE_BELOW} AS escalate FROM s"""
)
def sentiment_formulas(t):
    w = F.col("words")
    plus = F.size(F.filter(w, lambda x: x.isin(*[k for k, v in lx.SAMPLE_SENTIMENT.items() if v > 0])))
    minus = F.size(F.filter(w, lambda x: x.isin(*[k for k, v in lx.SAMPLE_SENTIMENT.items() if v < 0])))
    pos, neg = scoring.polarity(w, lx.SAMPLE_SENTIMENT)
    s = with_words(t.texts, "doc_id", "n_chars").select("doc_id", plus.alias("a"), minus.alias("b"), (pos + neg).alias("x"), (F.col("n_chars") % 5 + 1).alias("r"))
    squashed = scoring.squash(F.col("x"))
    return s.select(
        "doc_id",
        F.round((F.col("a") - F.col("b")) / F.greatest(F.col("a") + F.col("b"), F.lit(1)), 6).alias("probability_difference"),
        F.round(squashed, 6).alias("lexicon_score"),
        F.round((F.col("r") - 3) / 2, 6).alias("rating_score"),
        (squashed < lx.ESCALATE_BELOW).alias("escalate"),
    )


# Field -> patterns tried in order; group 0 is the value.
FIELDS = {
    "email": [pii.PATTERNS["EMAIL"]],
    "ip": [pii.PATTERNS["IP_ADDRESS"]],
    "phone": [pii.PATTERNS["PHONE_NUMBER"]],
    "year": [r"\b(?:19|20)[0-9]{2}\b"],
    "secret": [r"token = \S+", r"key = \S+"],
    "number": [r"\b[0-9]+(?:\.[0-9]+)?\b"],
}


def _field_sql(p: list[str]) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract(text, '{x}'), '')" for x in p) + ", '')"


@query("SELECT doc_id, " + ", ".join(f"nullif({_field_sql(p)}, '') AS {n}" for n, p in FIELDS.items()) + " FROM documents")
def ai_extract_fields(t):
    cols = [F.coalesce(*[F.nullif(F.regexp_extract("text", p, 0), F.lit("")) for p in ps]).alias(n) for n, ps in FIELDS.items()]
    return t.texts.select("doc_id", *cols)


@query(
    f"""
WITH m AS (SELECT doc_id, len(list_distinct(regexp_extract_all(text, '{FIELDS["email"][0]}'))) AS e,
  len(list_distinct(regexp_extract_all(text, '{FIELDS["number"][0]}'))) AS n FROM documents)
SELECT doc_id, round(CASE WHEN e = 0 THEN 0 ELSE 1.0 / e END, 6) AS email_score, round(CASE WHEN n = 0 THEN 0 ELSE 1.0 / n END, 6) AS number_score,
       CASE WHEN (e > 0 AND 1.0 / e < 0.8) OR (n > 0 AND 1.0 / n < 0.8) THEN 'REVIEW' ELSE 'AUTO' END AS route FROM m"""
)
def ai_extract_scored(t):
    """Score = 1 / number of different candidates; low confidence goes to review."""
    found = lambda name: F.size(F.array_distinct(F.regexp_extract_all("text", F.lit(FIELDS[name][0]), F.lit(0))))
    m = t.texts.select("doc_id", found("email").alias("e"), found("number").alias("n"))
    score = lambda c: F.when(F.col(c) == 0, 0.0).otherwise(1.0 / F.col(c))
    low = lambda c: (F.col(c) > 0) & (score(c) < 0.8)
    return m.select(
        "doc_id", F.round(score("e"), 6).alias("email_score"), F.round(score("n"), 6).alias("number_score"),
        F.when(low("e") | low("n"), "REVIEW").otherwise("AUTO").alias("route"),
    )


@query(f"SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '{NUMBER_PATTERN}'))) AS number FROM documents")
def ai_extract_list(t):
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(NUMBER_PATTERN), F.lit(0)))
    return t.texts.select("doc_id", F.explode(found).alias("number"))


_LANGS = {k: {w: 1.0 for w in v} for k, v in lx.LANGUAGE_PROFILES.items()}


@query(
    f"""
WITH p AS (SELECT doc_id, lang, coalesce({q.labels(q.toks('text'), _LANGS)}[1].label, 'unknown') AS predicted, CAST(ceil(length(text) / 4.0) AS BIGINT) AS est FROM documents)
SELECT doc_id, lang, predicted, CASE WHEN predicted = 'en' THEN 'direct' WHEN predicted = 'unknown' THEN 'review' ELSE 'translate' END AS route,
       CASE WHEN predicted IN ('en', 'unknown') THEN 0 ELSE est END AS translate_tokens, predicted = lang AS agrees FROM p"""
)
def ai_translate_route(t):
    label = F.coalesce(scoring.best_label(F.col("words"), _LANGS), F.lit("unknown"))
    p = with_words(t.texts, "doc_id", "lang").select("doc_id", "lang", label.alias("predicted"), F.ceil(F.length("text") / 4).alias("est"))
    known = F.col("predicted")
    return p.select(
        "doc_id", "lang", "predicted", F.when(known == "en", "direct").when(known == "unknown", "review").otherwise("translate").alias("route"),
        F.when(known.isin("en", "unknown"), F.lit(0)).otherwise(F.col("est")).cast("bigint").alias("translate_tokens"), (known == F.col("lang")).alias("agrees"),
    )


@query(f"SELECT doc_id, {q.redact('text')} AS redacted FROM documents")
def ai_redact_mask(t):
    return t.texts.select("doc_id", pii.redact(F.col("text")).alias("redacted"))


_DETECT = " UNION ALL ".join(
    f"SELECT doc_id, '{c}' AS category, unnest(list_distinct(regexp_extract_all(text, '{p}'))) AS value, text FROM documents" for c, p in pii.PATTERNS.items()
)


@query(
    f"""
SELECT doc_id, category, value, CAST(strpos(text, value) - 1 AS INTEGER) AS first_start,
       CAST((length(text) - length(replace(text, value, ''))) / length(value) AS BIGINT) AS occurrences FROM ({_DETECT})"""
)
def ai_redact_detect(t):
    """Inventory of detected values with the offset of the first one."""
    spans = t.texts.select("doc_id", F.explode(pii.detect(F.col("text"))).alias("s"))
    return spans.groupBy("doc_id", F.col("s.category").alias("category"), F.col("s.text").alias("value")).agg(
        F.min("s.start").alias("first_start"), F.count("*").alias("occurrences")
    )


@query(f"SELECT doc_id, {q.redact('text')} AS redacted FROM documents")
def ai_redact_chunked(t):
    """Split at line feeds, redact each piece, join in order: all inside the row. No pattern
    spans a line feed, so no value is cut and the result is that of the whole text."""
    pieces = F.split("text", "\n", -1)
    return t.texts.select("doc_id", F.array_join(F.transform(pieces, lambda p: pii.redact(p)), "\n").alias("redacted"))


@query(
    f"""
WITH s AS (SELECT doc_id, text, {q.sents('text')} AS ss FROM documents WHERE length(text) > 110),
x AS (SELECT doc_id, i, ss[i] AS sentence FROM (SELECT doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM s)),
w AS (SELECT doc_id, i, sentence, unnest({q.toks('sentence')}) AS tok FROM x),
f AS (SELECT *, count(*) OVER (PARTITION BY doc_id, tok) AS f FROM w),
g AS (SELECT doc_id, i, any_value(sentence) AS sentence, round(avg(f), 9) AS score FROM f GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS rn FROM g)
SELECT doc_id, string_agg(sentence, ' ' ORDER BY i) AS summary FROM r WHERE rn <= 2 GROUP BY 1
UNION ALL SELECT doc_id, text FROM documents WHERE length(text) <= 110
UNION ALL SELECT doc_id, '' FROM documents WHERE length(text) > 110 AND len({q.toks('text')}) = 0"""
)
def ai_summarize_row(t):
    return summarize_rows(t.texts, "doc_id", "text")


@query(
    f"""
WITH x AS (SELECT source, doc_id, i, ss[i] AS sentence FROM (SELECT source, doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM (
  SELECT source, doc_id, {q.sents('text')} AS ss FROM documents))),
w AS (SELECT source, doc_id, i, sentence, unnest({q.toks('sentence')}) AS tok FROM x),
f AS (SELECT *, count(*) OVER (PARTITION BY source, tok) AS f FROM w),
g AS (SELECT source, doc_id, i, any_value(sentence) AS sentence, round(sum(f) / count(*), 9) AS score FROM f GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id, i) AS rn FROM g)
SELECT source, string_agg(sentence, ' ' ORDER BY rn) AS summary FROM r WHERE rn <= 3 GROUP BY 1"""
)
def ai_summarize_agg(t):
    return summarize_groups(t.texts, "source", "doc_id", "text")


_AGG_SQL = f"""
WITH w AS (SELECT source, doc_id, unnest(list_distinct({q.toks('text')})) AS term FROM documents),
g AS (SELECT source, term, count(*) AS docs FROM w GROUP BY 1, 2),
h AS (SELECT term, count(*) AS held_by FROM g GROUP BY 1),
n AS (SELECT count(DISTINCT source) AS groups FROM documents),
s AS (SELECT source, term, docs, round(docs * ln(groups / held_by), 9) AS score FROM g JOIN h USING (term), n WHERE docs >= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, term) AS rank FROM s WHERE score > 0)
SELECT source, term, docs, round(score, 6) AS score, rank FROM r WHERE rank <= 5"""


@query(_AGG_SQL)
def ai_agg_instruction(t):
    """What sets a group apart: its five most distinctive terms with their support."""
    words = F.array_distinct(tokens(F.col("text")))
    return distinctive_terms(t.texts, "source", words, 5)


_TRIAGE = q.toks("text")


@query(
    f"""
WITH s AS (SELECT doc_id, text, {q.labels(_TRIAGE, lx.TOPIC_TERMS)}[1].label AS category, {q.level(_TRIAGE, lx.SEVERITY)} AS severity FROM documents)
SELECT doc_id, coalesce(category, 'other') AS category, severity,
       CASE category {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in lx.ROUTING.items())} ELSE 'support' END AS team,
       severity >= 2 AS sla_risk, {q.sents('text')}[1] AS headline FROM s"""
)
def ai_triage_struct(t):
    return triage(with_words(t.texts, "doc_id")).select("doc_id", "triage.*")


def triage(df):
    """Add a struct: category, severity, owning team, SLA risk, one-line headline."""
    cat = F.coalesce(F.col("__c"), F.lit("other"))
    team = F.lit("support")
    for k, v in lx.ROUTING.items():
        team = F.when(F.col("__c") == k, v).otherwise(team)
    keep = [c for c in df.columns if c != "words"]
    scored = df.select(*keep, scoring.best_label(F.col("words"), lx.TOPIC_TERMS).alias("__c"), scoring.cue_level(F.col("words"), lx.SEVERITY).alias("__s"))
    return scored.select(
        *keep,
        F.struct(
            cat.alias("category"), F.col("__s").alias("severity"), team.alias("team"), (F.col("__s") >= 2).alias("sla_risk"),
            F.get(sentences(F.col("text")), F.lit(0)).alias("headline"),
        ).alias("triage"),
    )


@query(
    f"""
WITH s AS (SELECT doc_id, {q.level(_TRIAGE, lx.SEVERITY)} AS severity, {q.has(_TRIAGE, lx.CHURN_CUES)} AS churn_risk,
  {q.has(_TRIAGE, lx.SUPPORT_CUES)} AS mentions_support, {q.sents('text')}[1] AS headline FROM documents)
SELECT * FROM s WHERE severity >= 2 OR churn_risk"""
)
def ai_rubric_score(t):
    w = F.col("words")
    s = with_words(t.texts, "doc_id").select(
        "doc_id", scoring.cue_level(w, lx.SEVERITY).alias("severity"), scoring.has_cue(w, lx.CHURN_CUES).alias("churn_risk"),
        scoring.has_cue(w, lx.SUPPORT_CUES).alias("mentions_support"), F.get(sentences(F.col("text")), F.lit(0)).alias("headline"),
    )
    return s.where("severity >= 2 OR churn_risk")


@query(
    f"""
WITH s AS (SELECT item_id, {q.weighted(_TRIAGE, lx.CLAUSE_CUES)} AS score,
  list_filter({q.sents('text')}, lambda s: {q.count_in(q.toks('s'), lx.OBLIGATION_CUES)} > 0)[1] AS obligation FROM benchmark)
SELECT item_id, round(score, 4) AS score, CASE WHEN score >= 6 THEN 'high' WHEN score >= 2 THEN 'medium' ELSE 'low' END AS risk,
       coalesce(obligation, 'none found') AS obligation,
       row_number() OVER (ORDER BY score DESC, item_id) AS position FROM s"""
)
def ai_clause_risk(t):
    score = scoring.weighted_sum(F.col("words"), lx.CLAUSE_CUES)
    duty = F.get(F.filter(sentences(F.col("text")), lambda s: scoring.has_cue(tokens(s), lx.OBLIGATION_CUES)), F.lit(0))
    s = with_words(t.benchmark, "item_id").select("item_id", score.alias("score"), duty.alias("obligation"))
    banded = s.select(
        "item_id", "score", F.when(F.col("score") >= 6, "high").when(F.col("score") >= 2, "medium").otherwise("low").alias("risk"),
        F.coalesce("obligation", F.lit("none found")).alias("obligation"),
    )
    return ranked_overall(banded, "score", "item_id").withColumn("score", F.round("score", 4))


def ranked_overall(df, score: str, key: str):
    """Global descending position without a single-task sort: scores are counted
    per value, the counts are summed over the values, ties are ranked per value."""
    counts = df.groupBy(score).agg(F.count("*").alias("__n"))
    before = Window.orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, -1)  # one row per distinct score
    offsets = counts.select(score, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    inside = Window.partitionBy(score).orderBy(key)
    rows = df.join(offsets, score).withColumn("position", (F.col("__o") + F.row_number().over(inside)).cast("bigint"))
    return rows.drop("__o")


@query(
    f"""
WITH w AS (SELECT conv_id, role, turn, len({q.toks('text')}) AS words FROM conversations),
g AS (SELECT conv_id, role, count(*) AS turns, min(turn) AS first_turn, max(turn) AS last_turn, CAST(sum(words) AS BIGINT) AS words FROM w GROUP BY 1, 2)
SELECT conv_id, role AS speaker, turns, first_turn, last_turn, words, round(words / sum(words) OVER (PARTITION BY conv_id), 6) AS share FROM g"""
)
def conv_speaker_turns(t):
    w = t.conversations.select("conv_id", F.col("role").alias("speaker"), "turn", F.size(tokens(F.col("text"))).alias("words"))
    g = w.groupBy("conv_id", "speaker").agg(F.count("*").alias("turns"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.sum("words").alias("words"))
    return g.withColumn("share", F.round(F.col("words") / F.sum("words").over(Window.partitionBy("conv_id")), 6))


@query(
    f"""
WITH w AS (SELECT conv_id, turn, role, text, len({q.toks('text')}) AS n FROM conversations)
SELECT conv_id, turn, role AS speaker, CAST(sum(n) OVER (PARTITION BY conv_id ORDER BY turn) - n AS BIGINT) AS start_word, CAST(sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS end_word, text FROM w"""
)
def conv_turn_rows(t, span: int = 256):
    """Who said what and when: a row per turn with its place in the conversation, counted in words."""
    w = t.conversations.select("conv_id", "turn", F.col("role").alias("speaker"), "text", F.size(tokens(F.col("text"))).cast("bigint").alias("n"))
    rows = prefix_sums(w, ["conv_id"], F.floor(F.col("turn") / span), [F.col("turn")], {"end_word": F.col("n")})
    return rows.select("conv_id", "turn", "speaker", (F.col("end_word") - F.col("n")).alias("start_word"), "end_word", "text")


@query(
    f"""
WITH w AS (SELECT conv_id, turn, role, {q.toks('text')} AS ws FROM conversations),
o AS (SELECT *, coalesce(sum(len(ws)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM w)
SELECT conv_id, turn, role AS speaker, CAST(start + i - 1 AS BIGINT) AS position, ws[i] AS word FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM o)"""
)
def conv_word_rows(t):
    """Word-level rows of the transcript: speaker, place in the conversation, word."""
    rows = conv_turn_rows(t).select("conv_id", "turn", "speaker", "start_word", F.posexplode(tokens(F.col("text"))).alias("i", "word"))
    return rows.select("conv_id", "turn", "speaker", (F.col("start_word") + F.col("i")).alias("position"), "word")


_PIECES = f"len(regexp_extract_all(text, '{lx.PIECE_PATTERN}'))"


@query(
    f"""
SELECT lang, count(*) AS documents, CAST(sum(CAST(ceil(length(text) / 4.0) AS BIGINT)) AS BIGINT) AS by_chars, CAST(max(CAST(ceil(length(text) / 4.0) AS BIGINT)) AS BIGINT) AS max_by_chars,
       CAST(sum(CAST(ceil(len(regexp_extract_all(text, '[^\\s]+')) / 0.75) AS BIGINT)) AS BIGINT) AS by_words, CAST(sum({_PIECES}) AS BIGINT) AS by_pieces
FROM documents GROUP BY 1"""
)
def token_count(t):
    per = token_estimates(t.texts, "lang")
    return per.groupBy("lang").agg(
        F.count("*").alias("documents"), F.sum("by_chars").alias("by_chars"), F.max("by_chars").alias("max_by_chars"),
        F.sum("by_words").alias("by_words"), F.sum("by_pieces").alias("by_pieces"),
    )


def token_estimates(df, *keep: str):
    """Three estimates per row: characters, words, tokenizer-like pieces."""
    return df.select(
        *keep,
        F.ceil(F.length("text") / lx.CHARS_PER_TOKEN).alias("by_chars"),
        F.ceil(word_count(F.col("text")) / lx.WORDS_PER_TOKEN).alias("by_words"),
        F.size(F.regexp_extract_all("text", F.lit(lx.PIECE_PATTERN), F.lit(0))).cast("bigint").alias("by_pieces"),
    )


@query(
    f"""
WITH g AS (SELECT lang, sum({_PIECES}) / sum(len(regexp_extract_all(text, '[^\\s]+'))) AS pieces_per_word,
  sum(length(text)) / sum(len(regexp_extract_all(text, '[^\\s]+'))) AS chars_per_word, sum(strlen(text)) / sum(length(text)) AS bytes_per_char FROM documents GROUP BY 1)
SELECT lang, round(pieces_per_word, 6) AS pieces_per_word, round(chars_per_word, 6) AS chars_per_word, round(bytes_per_char, 6) AS bytes_per_char,
       round(pieces_per_word / (SELECT pieces_per_word FROM g WHERE lang = 'en'), 6) AS ratio_to_en FROM g"""
)
def token_lang_ratio(t):
    rows = t.texts.select(
        "lang", F.size(F.regexp_extract_all("text", F.lit(lx.PIECE_PATTERN), F.lit(0))).alias("p"), word_count(F.col("text")).alias("w"),
        F.length("text").alias("c"), F.octet_length("text").alias("b"),
    )
    g = rows.groupBy("lang").agg(*[F.sum(x).alias(x) for x in "pwcb"])
    g = g.select("lang", (F.col("p") / F.col("w")).alias("pw"), (F.col("c") / F.col("w")).alias("cw"), (F.col("b") / F.col("c")).alias("bc"))
    en = F.max(F.when(F.col("lang") == "en", F.col("pw"))).over(Window.partitionBy())  # one row per language
    return g.select(
        "lang", F.round("pw", 6).alias("pieces_per_word"), F.round("cw", 6).alias("chars_per_word"), F.round("bc", 6).alias("bytes_per_char"), F.round(F.col("pw") / en, 6).alias("ratio_to_en")
    )


@query(
    """
WITH g AS (SELECT source, count(*) AS calls, sum(CAST(ceil(length(text) / 4.0) AS BIGINT)) AS tin FROM documents GROUP BY 1)
SELECT source, calls, CAST(tin AS BIGINT) AS input_tokens, round((tin * 3.0 + calls * 150 * 15.0) / 1e6, 6) AS daily_cost,
       round(30 * (tin * 3.0 + calls * 150 * 15.0) / 1e6, 6) AS monthly_cost, round(calls * 3 * 40 * 3.0 / 1e6, 6) AS few_shot_overhead FROM g"""
)
def token_cost(t, out_tokens: int = 150, shots: int = 3, shot_tokens: int = 40):
    g = token_estimates(t.texts, "source").groupBy("source").agg(F.count("*").alias("calls"), F.sum("by_chars").alias("input_tokens"))
    day = (F.col("input_tokens") * lx.PRICE_IN + F.col("calls") * out_tokens * lx.PRICE_OUT) / 1e6
    return g.select(
        "source", "calls", "input_tokens", F.round(day, 6).alias("daily_cost"), F.round(30 * day, 6).alias("monthly_cost"),
        F.round(F.col("calls") * shots * shot_tokens * lx.PRICE_IN / 1e6, 6).alias("few_shot_overhead"),
    )


@query(
    """
WITH r AS (SELECT source, doc_id, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank,
  coalesce(sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM documents WHERE length(text) > 0)
SELECT source, doc_id, rank, CAST(least(length(text), 18000 - used) AS BIGINT) AS kept_chars, left(text, CAST(18000 - used AS BIGINT)) AS context_piece
FROM r WHERE used < 18000"""
)
def context_budget(t, budget: int = 18_000):
    """Texts in rank order until the budget is full, the last one cut.

    Each text holds a character at least, so the first `budget` rows decide."""
    rows = t.texts.where(F.length("text") > 0).select("source", "doc_id", "text", F.length("text").alias("n"))
    head = top_n(rows, ["source"], [F.col("doc_id")], budget, "rank")
    before = F.sum("n").over(Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1))
    left = F.lit(budget) - F.coalesce(before, F.lit(0))
    packed = head.withColumn("room", left.cast("int")).where("room > 0")
    return packed.select("source", "doc_id", F.col("rank").cast("bigint").alias("rank"), F.least("n", "room").cast("bigint").alias("kept_chars"), F.substring("text", F.lit(1), F.col("room")).alias("context_piece"))


def _bpe_sql(rounds: int) -> str:
    ctes = [
        f"w0 AS (SELECT regexp_replace(tok, '(.)', chr(1) || '\\1' || chr(2), 'g') AS s, count(*) AS n FROM (SELECT unnest({q.toks('text')}) AS tok FROM documents) GROUP BY 1)"
    ]
    for r in range(1, rounds + 1):
        ctes.append(f"p{r} AS (SELECT string_split(replace(trim(s, chr(1) || chr(2)), chr(2) || chr(1), chr(3)), chr(3)) AS p, n FROM w{r - 1})")
        ctes.append(f"q{r} AS (SELECT p[i] AS l, p[i + 1] AS r, n FROM (SELECT p, n, unnest(range(1, len(p))) AS i FROM p{r}))")
        ctes.append(f"m{r} AS (SELECT l, r, CAST(sum(n) AS BIGINT) AS c FROM q{r} GROUP BY 1, 2 ORDER BY c DESC, l, r LIMIT 1)")
        ctes.append(f"w{r} AS (SELECT replace(s, chr(1) || l || chr(2) || chr(1) || r || chr(2), chr(1) || l || r || chr(2)) AS s, n FROM w{r - 1}, m{r})")
    out = " UNION ALL ".join(f"SELECT CAST({r} AS INTEGER) AS round, l AS left_symbol, r AS right_symbol, c AS pair_count FROM m{r}" for r in range(1, rounds + 1))
    return f"WITH {', '.join(ctes)} {out}"


@query(_bpe_sql(4))
def bpe_merge_counts(t, rounds: int = 4):
    merges = learn_merges(t.texts, "text", rounds)
    return values(t.spark, "round INT, left_symbol STRING, right_symbol STRING, pair_count BIGINT", merges)


_GRAM = "list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + 2], ' ')))"


@query(
    f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_GRAM} AS g FROM (SELECT doc_id, {q.toks('text')} AS w FROM documents)),
h AS (SELECT doc_id, md5(array_to_string(g, chr(1))) AS h FROM d),
f AS (SELECT h, min(doc_id) AS anchor FROM h GROUP BY 1),
u AS MATERIALIZED (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM d WHERE doc_id IN (SELECT anchor FROM f)),
p AS (SELECT x.doc_id, y.doc_id AS anchor, x.n AS nx, y.n AS ny, count(*) AS i FROM u x JOIN u y ON x.gram = y.gram AND y.doc_id < x.doc_id GROUP BY 1, 2, 3, 4),
s AS (SELECT doc_id, anchor, round(i / (nx + ny - i), 6) AS jaccard FROM p WHERE i / (nx + ny - i) >= 0.7 - 1e-12),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY jaccard DESC, anchor) AS rn FROM s)
SELECT doc_id, anchor, 1.0::DOUBLE AS jaccard, 'copy' AS kind FROM h JOIN f USING (h) WHERE doc_id <> anchor
UNION ALL SELECT doc_id, anchor, jaccard, 'near' FROM r WHERE rn = 1"""
)
def near_duplicate_text(t):
    return near_duplicates(t.texts, "doc_id", "text")


_NEG = q.in_list(lx.NEGATIONS)


def _signed_sql() -> str:
    groups: dict[float, list[str]] = {}
    for w, s in lx.SAMPLE_SENTIMENT.items():
        groups.setdefault(s, []).append(w)
    sign = f"CASE WHEN len(list_filter(w[greatest(i - 2, 1):i - 1], lambda b: b IN {_NEG})) > 0 THEN -1 ELSE 1 END"
    parts = [f"{s}::DOUBLE * coalesce(list_sum(list_transform(list_filter(range(1, len(w) + 1), lambda i: w[i] IN {q.in_list(v)}), lambda i: {sign})), 0)" for s, v in sorted(groups.items())]
    return "(0.0::DOUBLE + " + " + ".join(parts) + ")"


@query(
    f"""
WITH d AS (SELECT doc_id, {q.toks('text')} AS w FROM documents),
s AS (SELECT doc_id, {q.weighted('w', lx.SAMPLE_SENTIMENT)} AS plain, {_signed_sql()} AS signed FROM d)
SELECT doc_id, round(plain, 4) AS plain, round(signed, 4) AS signed, round(plain, 4) <> round(signed, 4) AS negation_matters FROM s"""
)
def lexicon_pitfalls(t):
    w = F.col("words")
    s = with_words(t.texts, "doc_id").select(
        "doc_id", F.round(scoring.weighted_sum(w, lx.SAMPLE_SENTIMENT), 4).alias("plain"), F.round(scoring.signed_sum(w, lx.SAMPLE_SENTIMENT, lx.NEGATIONS), 4).alias("signed")
    )
    return s.withColumn("negation_matters", F.col("plain") != F.col("signed"))


EVIDENCE_CTE = f"""
qt AS (SELECT item_id, unnest(list_distinct({q.toks('text')})) AS tok FROM benchmark),
dt AS (SELECT doc_id, unnest(list_distinct({q.toks('text')})) AS tok FROM documents),
hit AS (SELECT item_id, doc_id, count(*) AS shared FROM qt JOIN dt USING (tok) GROUP BY 1, 2),
ev AS MATERIALIZED (SELECT item_id, doc_id, shared FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) AS rn FROM hit) WHERE rn = 1)"""


def best_evidence(t):
    """(item_id, doc_id, shared): the document sharing most words with each passage, by its rarest words."""
    items = t.benchmark.select("item_id", F.array_distinct(tokens(F.col("text"))).alias("words"))
    sets, key, _ = stored_sets(t)
    return most_shared(items, "item_id", sets, key, 1).drop("rank")


def check_claims(df, claim: str, evidence: str, min_overlap: float = 0.5):
    """Add supported, missing numbers and word overlap to rows of (claim, evidence)."""
    missing = F.array_sort(F.array_except(numbers(F.col(claim)), numbers(F.col(evidence))))
    share = scoring.covered_share(scoring.claim_words(F.col(claim)), F.array_distinct(scoring.claim_words(F.col(evidence))))
    rows = df.withColumn("missing", F.array_join(missing, ",")).withColumn("overlap", F.round(share, 6))
    return rows.withColumn("supported", (F.col("missing") == "") & (F.col("overlap") >= min_overlap))


@query(
    f"""
WITH {EVIDENCE_CTE}, x AS (SELECT ev.item_id, ev.doc_id, {q.claim_words('b.text')} AS cw, list_distinct({q.claim_words('d.text')}) AS ew,
  array_to_string(list_sort(list_filter({q.numbers('b.text')}, lambda n: NOT list_contains({q.numbers('d.text')}, n))), ',') AS missing
  FROM ev JOIN benchmark b USING (item_id) JOIN documents d USING (doc_id)),
y AS (SELECT item_id, doc_id, missing, round({q.covered('cw', 'ew')}, 6) AS overlap FROM x)
SELECT item_id, doc_id, missing, overlap, CASE WHEN missing = '' AND overlap >= 0.5 THEN 'SUPPORTED' ELSE 'UNSUPPORTED' END AS verdict FROM y"""
)
def claim_check(t):
    rows = written(best_evidence(t).join(t.benchmark.select("item_id", F.col("text").alias("claim")), "item_id"), "hits")
    rows = rows.join(t.documents.select("doc_id", F.col("text").alias("evidence")), "doc_id")  # few hits go to the documents, which stay in place
    out = check_claims(rows, "claim", "evidence")
    return out.select("item_id", "doc_id", "missing", "overlap", F.when(F.col("supported"), "SUPPORTED").otherwise("UNSUPPORTED").alias("verdict"))


@query(
    f"""
WITH {EVIDENCE_CTE}, c AS (SELECT item_id, unnest({q.sents('text')}) AS claim FROM benchmark),
x AS (SELECT d.lang, {q.claim_words('c.claim')} AS cw, list_distinct({q.claim_words('d.text')}) AS ew,
  len(list_filter({q.numbers('c.claim')}, lambda n: NOT list_contains({q.numbers('d.text')}, n))) AS missing
  FROM ev JOIN c USING (item_id) JOIN documents d USING (doc_id)),
y AS (SELECT lang, CASE WHEN missing = 0 AND round({q.covered('cw', 'ew')}, 6) >= 0.9 THEN 0 ELSE 1 END AS bad FROM x)
SELECT lang, count(*) AS claims, CAST(sum(bad) AS BIGINT) AS unsupported, round(avg(bad), 6) AS rate FROM y GROUP BY 1"""
)
def hallucination_rate(t):
    """Share of passage sentences that the best evidence does not support."""
    claims = t.benchmark.select("item_id", F.explode(sentences(F.col("text"))).alias("claim"))
    rows = written(best_evidence(t).join(claims, "item_id"), "hits").join(t.documents.select("doc_id", "lang", F.col("text").alias("evidence")), "doc_id")
    bad = F.when(F.col("supported"), 0).otherwise(1)
    return check_claims(rows, "claim", "evidence", 0.9).groupBy("lang").agg(
        F.count("*").alias("claims"), F.sum(bad).alias("unsupported"), F.round(F.avg(bad), 6).alias("rate")
    )


@query(
    f"""
WITH {CENTROIDS_SQL},
s AS (SELECT c_label, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c_vec), 6) AS similarity FROM embeddings, cent),
r AS (SELECT *, row_number() OVER (PARTITION BY c_label ORDER BY similarity DESC, vec_id) AS rn FROM s)
SELECT c_label AS statement, vec_id AS best_chunk, similarity, similarity >= 0.6 AS grounded FROM r WHERE rn = 1"""
)
def grounded_statement(t, threshold: float = 0.6):
    best = best_per_query(t.embeddings, "vec_id", label_centroids(t.embeddings), "label", 1)
    return best.select(F.col("label").cast("int").alias("statement"), F.col("vec_id").alias("best_chunk"), "similarity", (F.col("similarity") >= threshold).alias("grounded"))


@query()
def enrich_cached(t):
    """Two runs over one cache: the second asks the provider for nothing new."""
    cache = scratch(t.spark, "responses")
    models = ["small", "large"]
    first = enrich(t.texts.select("doc_id", "source", "text"), "text", stub_provider, models, cache)
    return first.select("doc_id", "source", "model", "value", "error")
