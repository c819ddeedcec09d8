"""Entity graph queries: extraction, paths, communities, graph search."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspan import lexicons as lx
from larkspan.functions import scoring
from larkspan.functions.text import tokens
from larkspan.operators import graphs, kg
from larkspan.operators.search import DIMS, hashed
from larkspan.operators.skew import top_n
from larkspan.operators.vectors import best_per_query
from larkspan.plans import sqltext as q
from larkspan.plans.scalars import sql_stem
from larkspan.registry import query
from larkspan.storage import cut, derived, written
from larkspan.tables import values

HOPS = 4

# ---- the same pipeline in SQL, as common table expressions

_CANDIDATES = f"""
sen AS MATERIALIZED (SELECT doc_id, CAST(i - 1 AS INTEGER) AS sent, {q.toks('ss[i]')} AS words, ss[i] AS sentence
  FROM (SELECT doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM (SELECT doc_id, {q.sents('text')} AS ss FROM documents))),
tk AS (SELECT doc_id, sent, CAST(i - 1 AS INTEGER) AS pos, words[i] AS tok, words[i + 1] AS nxt FROM (SELECT doc_id, sent, words, unnest(range(1, len(words) + 1)) AS i FROM sen)),
cd AS MATERIALIZED (SELECT doc_id, sent, pos, tok AS alias, 1 AS n FROM tk WHERE length(tok) >= {kg.WORD_CHARS}
  UNION ALL SELECT doc_id, sent, pos, tok || ' ' || nxt, 2 FROM tk WHERE length(tok) >= {kg.PAIR_CHARS} AND length(nxt) >= {kg.PAIR_CHARS}),
cat AS MATERIALIZED (SELECT alias, n, CASE WHEN n = 2 THEN 'pair' WHEN length(alias) >= {kg.LONG_CHARS} THEN 'long' ELSE 'short' END AS type
  FROM (SELECT DISTINCT doc_id, alias, n FROM cd) GROUP BY alias, n HAVING count(*) >= {kg.MIN_DOCS})"""

_MENTIONS = f"""{_CANDIDATES},
mc AS MATERIALIZED (SELECT doc_id, sent, list({{'neg': -n, 'pos': pos, 'alias': alias, 'type': type}} ORDER BY -n, pos, alias) AS c FROM cd JOIN cat USING (alias, n) GROUP BY 1, 2),
mk(doc_id, sent, c, i, kept) AS (SELECT doc_id, sent, c, 1, [c[1]] FROM mc
  UNION ALL SELECT doc_id, sent, c, i + 1, CASE WHEN len(list_filter(kept, lambda a: a.pos < c[i + 1].pos - c[i + 1].neg AND c[i + 1].pos < a.pos - a.neg)) > 0
    THEN kept ELSE list_append(kept, c[i + 1]) END FROM mk WHERE i < len(c)),
ment AS MATERIALIZED (SELECT doc_id, sent, m.pos AS pos, -m.neg AS n, m.alias AS alias, m.type AS type FROM (SELECT doc_id, sent, unnest(kept) AS m FROM mk WHERE i = len(c)))"""


def _rule_sql(column: int) -> str:
    cases = []
    for rule in sorted(kg.RULES):
        _, src, dst, trigger, name, reverse = rule
        cond = f"list_contains(btw, '{trigger}')" + (f" AND a.type = '{src}'" if src else "") + (f" AND b.type = '{dst}'" if dst else "")
        cases.append(f"WHEN {cond} THEN {repr(name) if column == 0 else str(reverse).lower()}")
    return f"CASE {' '.join(cases)} END"


_RELATIONS = f"""{_MENTIONS},
ml AS (SELECT doc_id, sent, list({{'pos': pos, 'n': n, 'alias': alias, 'type': type}} ORDER BY pos) AS ms FROM ment GROUP BY 1, 2),
pr AS (SELECT doc_id, sent, ms[i] AS a, ms[i + 1] AS b FROM (SELECT doc_id, sent, ms, unnest(range(1, len(ms))) AS i FROM ml)),
pb AS (SELECT pr.*, words[a.pos + a.n + 1:b.pos] AS btw FROM pr JOIN sen USING (doc_id, sent) WHERE a.alias <> b.alias),
rl AS MATERIALIZED (SELECT doc_id, sent, CASE WHEN rev THEN b.alias ELSE a.alias END AS source, relation, CASE WHEN rev THEN a.alias ELSE b.alias END AS target
  FROM (SELECT *, {_rule_sql(0)} AS relation, {_rule_sql(1)} AS rev FROM pb) WHERE relation IS NOT NULL)"""

_EDGES = f"""{_RELATIONS},
ed AS MATERIALIZED (SELECT source, target, count(*) AS weight, array_to_string(list_sort(list(DISTINCT relation)), '|') AS relations, count(DISTINCT doc_id) AS chunks,
  min(doc_id) AS first_chunk, max(doc_id) AS last_chunk FROM rl GROUP BY 1, 2),
ud AS MATERIALIZED (SELECT a, b, CAST(sum(weight) AS BIGINT) AS weight FROM (SELECT source AS a, target AS b, weight FROM ed UNION ALL SELECT target, source, weight FROM ed) GROUP BY 1, 2),
dg AS (SELECT a AS node, count(*) AS nb, sum(weight) AS k FROM ud GROUP BY 1),
seed AS MATERIALIZED (SELECT node FROM dg ORDER BY nb DESC, k DESC, node LIMIT 1)"""

WITH = "WITH RECURSIVE "


def _levels(n: int, path: bool = False) -> str:
    ctes = [f"h0 AS MATERIALIZED (SELECT node, node AS path FROM seed)"]
    for i in range(1, n + 1):
        seen = " UNION ALL ".join(f"SELECT node FROM h{j}" for j in range(i))
        ctes.append(f"h{i} AS MATERIALIZED (SELECT b AS node, min(path || '>' || b) AS path FROM h{i - 1} JOIN ud ON a = node WHERE b NOT IN ({seen}) GROUP BY 1)")
    return ", ".join(ctes)


# ---- the pipeline in Spark


# Sentences, mentions, relations, edges and communities are stored once per state of the documents;
# the texts are split and tokenised a single time, whatever number of queries follows.


def sentences_of(t):
    return derived(t, "sentences", lambda: written(kg.sentence_table(t.texts), "sentences"))


def names_of(t):
    return derived(t, "names", lambda: kg.catalogue(sentences_of(t)))


def found_mentions(t):
    return derived(t, "mentions", lambda: written(kg.mentions(sentences_of(t), names_of(t)), "mentions"))


def found_relations(t):
    return derived(t, "relations", lambda: written(kg.relations(sentences_of(t), found_mentions(t)), "relations"))


def weighted_graph(t):
    """(edges, undirected pairs), both stored for the loops that follow."""
    e = derived(t, "edges", lambda: written(kg.edges(found_relations(t)), "edges"))
    return e, derived(t, "pairs", lambda: cut(kg.undirected(e)))


def members_of(t):
    """(node, community): the detected communities."""
    return derived(t, "communities", lambda: cut(graphs.communities(weighted_graph(t)[1])))


def tree_of(t):
    return derived(t, "hierarchy", lambda: cut(graphs.hierarchy(weighted_graph(t)[1])))


def seed_node(pairs):
    """The node with the most neighbours (then weight): a one-row table."""
    degree = pairs.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n"), F.sum("weight").alias("k"))
    return degree.orderBy(F.desc("n"), F.desc("k"), "node").limit(1).select("node")


@query(f"{WITH}{_MENTIONS} SELECT doc_id, sent, pos, CAST(n AS INTEGER) AS n, alias AS entity, type FROM ment")
def ent_mentions(t):
    return found_mentions(t).select("doc_id", "sent", "pos", F.col("n").cast("int").alias("n"), "entity", "type")


@query(f"{WITH}{_RELATIONS} SELECT doc_id, sent, source, relation, target FROM rl")
def ent_relations(t):
    return found_relations(t).select("doc_id", "sent", "source", "relation", "target")


@query(
    f"""{WITH}{_MENTIONS},
su AS (SELECT doc_id, sent, arg_min(alias, pos) AS subject FROM ment GROUP BY 1, 2),
cl AS (SELECT doc_id, sent, regexp_split_to_array(sentence, ';\\s*|\\s+and\\s+') AS cs FROM sen),
cx AS (SELECT doc_id, sent, CAST(i - 1 AS INTEGER) AS clause_no, cs[i] AS claim FROM (SELECT doc_id, sent, cs, unnest(range(1, len(cs) + 1)) AS i FROM cl)),
ct AS (SELECT *, regexp_extract(claim, '{kg.TIME_PATTERN}') AS time FROM cx)
SELECT doc_id, sent, clause_no, subject, trim(claim, ' .') AS claim, time FROM ct JOIN su USING (doc_id, sent) WHERE time <> ''"""
)
def ent_claims(t):
    return kg.claims(sentences_of(t), found_mentions(t))


@query(f"{WITH}{_EDGES} SELECT source, target, weight, relations, chunks, first_chunk, last_chunk FROM ed")
def kg_merge_edges(t):
    return weighted_graph(t)[0]


@query(
    f"""{WITH}{_EDGES},
fx AS (SELECT source, target, source || ' ' || relation || ' ' || target AS fact FROM (SELECT DISTINCT source, relation, target FROM rl)),
inc AS (SELECT source AS node, fact FROM fx UNION SELECT target, fact FROM fx),
tu AS (SELECT alias AS node, any_value(type) AS type, count(DISTINCT doc_id) AS text_units FROM ment GROUP BY 1),
wf AS (SELECT source || ' ' || relation || ' ' || target AS fact, count(*) AS uses FROM rl GROUP BY 1),
rk AS (SELECT node, fact, row_number() OVER (PARTITION BY node ORDER BY uses DESC, fact) AS rn FROM inc JOIN wf USING (fact)),
ds AS (SELECT node, string_agg(fact, '. ' ORDER BY rn) AS description FROM rk WHERE rn <= 5 GROUP BY 1)
SELECT node, type, text_units, count(*) AS facts, any_value(description) AS description FROM inc JOIN tu USING (node) JOIN ds USING (node) GROUP BY 1, 2, 3"""
)
def kg_nodes(t):
    """Entities with their number of facts, described by the five that most sentences state."""
    facts = found_relations(t).groupBy("source", "relation", "target").agg(F.count("*").alias("uses")).withColumn("fact", F.concat_ws(" ", "source", "relation", "target"))
    inc = facts.select(F.explode(F.array_distinct(F.array("source", "target"))).alias("node"), "fact", "uses")
    counts = inc.groupBy("node").agg(F.count("*").alias("facts"))
    text = in_order(top_n(inc, ["node"], [F.desc("uses"), F.col("fact")], 5), "node", "fact", ". ", "description")
    units = found_mentions(t).select(F.col("entity").alias("node"), "type", "doc_id").distinct().groupBy("node", "type").agg(F.count("*").alias("text_units"))
    return units.join(counts, "node").join(text, "node").select("node", "type", "text_units", "facts", "description")


def in_order(ranked, key: str, text: str, sep: str, out: str):
    """The texts of a key's few ranked rows as one string."""
    rows = F.array_sort(F.collect_list(F.struct("rn", F.col(text).alias("t"))))
    return ranked.groupBy(key).agg(F.array_join(F.transform(rows, lambda r: r["t"]), sep).alias(out))


def _canon(c: str) -> str:
    return f"array_to_string(list_transform(string_split({c}, ' '), lambda w: {sql_stem('w')}), ' ')"


@query(
    f"""{WITH}{_EDGES}, cn AS (SELECT {_canon('source')} AS source, {_canon('target')} AS target, weight FROM ed)
SELECT source, target, CAST(sum(weight) AS BIGINT) AS weight, count(*) AS merged FROM cn WHERE source <> target GROUP BY 1, 2"""
)
def kg_alias_normalise(t):
    """Surfaces renamed to their canonical name at both ends, then merged again."""
    e, _ = weighted_graph(t)
    renamed = e.select(kg.canonical(F.col("source")).alias("source"), kg.canonical(F.col("target")).alias("target"), "weight")
    return renamed.where("source <> target").groupBy("source", "target").agg(F.sum("weight").alias("weight"), F.count("*").alias("merged"))


@query(
    f"""{WITH}{_EDGES},
o AS (SELECT source AS node, count(*) AS out_degree, sum(weight) AS out_weight FROM ed GROUP BY 1),
i AS (SELECT target AS node, count(*) AS in_degree, sum(weight) AS in_weight FROM ed GROUP BY 1)
SELECT node, coalesce(out_degree, 0) AS out_degree, coalesce(in_degree, 0) AS in_degree, CAST(coalesce(out_weight, 0) + coalesce(in_weight, 0) AS BIGINT) AS weighted,
  CASE WHEN in_degree IS NULL THEN 'source' WHEN out_degree IS NULL THEN 'sink' ELSE 'inner' END AS role FROM o FULL JOIN i USING (node)"""
)
def graph_degree_source_sink(t):
    """Both ends of an edge become rows of one aggregation, so no join is needed."""
    e, _ = weighted_graph(t)
    ends = e.select(F.explode(F.array(
        F.struct(F.col("source").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"), "weight"),
        F.struct(F.col("target").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"), "weight"),
    )).alias("x")).select("x.*")
    g = ends.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), F.sum("weight").alias("weighted"))
    return g.withColumn("role", F.when(F.col("in_degree") == 0, "source").when(F.col("out_degree") == 0, "sink").otherwise("inner"))


@query()
def graph_dag_check(t):
    e, _ = weighted_graph(t)
    free, stuck = graphs.peel(e.select(F.col("source").alias("a"), F.col("target").alias("b")))
    edges = e.count()
    return values(t.spark, "edges BIGINT, nodes_free BIGINT, nodes_stuck BIGINT, acyclic BOOLEAN", [(edges, free, stuck, stuck == 0)])


@query(f"{WITH}{_EDGES}, {_levels(HOPS)} " + " UNION ALL ".join(f"SELECT node, CAST({i} AS INTEGER) AS distance FROM h{i}" for i in range(HOPS + 1)))
def graph_khop(t):
    _, pairs = weighted_graph(t)
    return graphs.khop(pairs, seed_node(pairs), HOPS)


@query(f"{WITH}{_EDGES}, {_levels(HOPS)} " + " UNION ALL ".join(f"SELECT node, CAST({i} AS INTEGER) AS hops, path FROM h{i}" for i in range(HOPS + 1)))
def graph_shortest_path(t):
    _, pairs = weighted_graph(t)
    return graphs.shortest_paths(pairs, seed_node(pairs), HOPS)


@query(
    f"""{WITH}{_EDGES}, rc(node) AS (SELECT node FROM seed UNION SELECT target FROM rc JOIN ed ON source = node)
SELECT node, node NOT IN (SELECT source FROM ed) AS is_root_cause FROM rc"""
)
def graph_descendants_roots(t):
    e, pairs = weighted_graph(t)
    out = graphs.reachable(e.select(F.col("source").alias("a"), F.col("target").alias("b")), seed_node(pairs))
    sources = e.select(F.col("source").alias("node"), F.lit(False).alias("leaf")).distinct()
    return out.join(sources, "node", "left").select("node", F.coalesce("leaf", F.lit(True)).alias("is_root_cause"))


@query(
    f"""{WITH}{_EDGES}, cc(node, root) AS (SELECT node, node FROM dg UNION SELECT b, root FROM cc JOIN ud ON a = node)
SELECT node, min(root) AS component FROM cc GROUP BY 1"""
)
def graph_components(t):
    _, pairs = weighted_graph(t)
    return graphs.components(pairs.select("a", "b"))


@query(
    f"""{WITH}{_EDGES}, win AS (SELECT min(doc_id) + 50 AS lo, max(doc_id) - 50 AS hi FROM ment WHERE alias = (SELECT node FROM seed))
SELECT source, target, count(*) AS evidence, min(doc_id) AS first_seen FROM rl, win WHERE doc_id BETWEEN lo AND hi GROUP BY 1, 2"""
)
def graph_temporal_filter(t, margin: int = 50):
    """Edges whose evidence lies inside the seed's own window (text number = time)."""
    found = found_mentions(t)
    rels = found_relations(t)
    seed = seed_node(weighted_graph(t)[1])
    win = found.join(seed, F.col("entity") == F.col("node"), "left_semi").agg((F.min("doc_id") + margin).alias("lo"), (F.max("doc_id") - margin).alias("hi"))
    inside = rels.join(F.broadcast(win)).where("doc_id BETWEEN lo AND hi")  # win is one row
    return inside.groupBy("source", "target").agg(F.count("*").alias("evidence"), F.min("doc_id").alias("first_seen"))


def _members_sql(levels: int = 14, sweeps: int = 2) -> str:
    """Detection by levels of contraction as common table expressions; levels beyond the last that helps change nothing."""
    out = ["lv0 AS MATERIALIZED (SELECT a, b, CAST(weight AS HUGEINT) AS weight FROM ud)", "mb0 AS (SELECT DISTINCT a AS node, a AS community FROM ud)"]
    for v in range(levels):
        lv, last = f"lv{v}", f"lb{v}_{2 * sweeps}"
        out += [f"dk{v} AS MATERIALIZED (SELECT a AS node, CAST(sum(weight) AS HUGEINT) AS k FROM {lv} GROUP BY 1)", f"tm{v} AS MATERIALIZED (SELECT CAST(sum(k) AS HUGEINT) AS m FROM dk{v})", f"lb{v}_0 AS (SELECT node, k, node AS community FROM dk{v})"]
        for r in range(2 * sweeps):
            x, was = f"{v}_{r}", f"lb{v}_{r}"
            out += [
                f"tt{x} AS (SELECT community, sum(k) AS tot FROM {was} GROUP BY 1)",
                f"op{x} AS (SELECT node, community, sum(w) AS w FROM (SELECT e.a AS node, x.community, e.weight AS w FROM {lv} e JOIN {was} x ON x.node = e.b WHERE e.a <> e.b UNION ALL SELECT node, community, 0 FROM {was}) GROUP BY 1, 2)",
                f"gn{x} AS (SELECT o.node, o.community, y.community AS cur, y.k, o.w * m - y.k * (tot - CASE WHEN o.community = y.community THEN y.k ELSE 0 END) AS gain FROM op{x} o JOIN tt{x} USING (community) JOIN {was} y ON y.node = o.node, tm{v})",
                f"lb{v}_{r + 1} AS MATERIALIZED (SELECT node, any_value(k) AS k, CASE WHEN (substr(md5(node || '{v}:{r // 2}'), 1, 1) < '8') = {str(r % 2 == 0).lower()} AND max(gain) > max(gain) FILTER (community = cur) THEN arg_min(community, (-gain, community)) ELSE any_value(cur) END AS community FROM gn{x} GROUP BY node)",
            ]
        out += [
            f"in{v} AS MATERIALIZED (SELECT e.a, e.b FROM {lv} e JOIN {last} x ON x.node = e.a JOIN {last} y ON y.node = e.b WHERE x.community = y.community AND e.a <> e.b)",
            f"cc{v}(node, root) AS (SELECT node, node FROM dk{v} UNION SELECT i.b, c.root FROM cc{v} c JOIN in{v} i ON i.a = c.node)",
            f"lc{v} AS MATERIALIZED (SELECT node, min(root) AS community FROM cc{v} GROUP BY 1)",
            f"sq{v} AS (SELECT sum(t * t) AS after, (SELECT sum(k * k) FROM dk{v}) AS before FROM (SELECT sum(k) AS t FROM lc{v} JOIN dk{v} USING (node) GROUP BY community))",
            f"wi{v} AS (SELECT coalesce(sum(weight) FILTER (x.community = y.community), 0) AS after, coalesce(sum(weight) FILTER (a = b), 0) AS before FROM {lv} e JOIN lc{v} x ON x.node = e.a JOIN lc{v} y ON y.node = e.b)",
            f"ok{v} AS MATERIALIZED (SELECT w.after * m - s.after > w.before * m - s.before AS ok FROM sq{v} s, wi{v} w, tm{v})",
            f"fl{v} AS MATERIALIZED (SELECT node, CASE WHEN ok THEN community ELSE node END AS community FROM lc{v}, ok{v})",
            f"mb{v + 1} AS MATERIALIZED (SELECT m.node, f.community FROM mb{v} m JOIN fl{v} f ON f.node = m.community)",
            f"lv{v + 1} AS MATERIALIZED (SELECT x.community AS a, y.community AS b, CAST(sum(weight) AS HUGEINT) AS weight FROM {lv} e JOIN fl{v} x ON x.node = e.a JOIN fl{v} y ON y.node = e.b GROUP BY 1, 2)",
        ]
    return ",\n".join([*out, f"mb AS MATERIALIZED (SELECT node, community FROM mb{levels})"])


_MEMBERS = f"{_EDGES},\n{_members_sql()}"


@query(f"""{WITH}{_MEMBERS},
tk2 AS (SELECT community, sum(weight) AS k FROM ud JOIN mb ON node = a GROUP BY 1),
md AS (SELECT round((SELECT sum(weight) FROM ud JOIN mb x ON x.node = a JOIN mb y ON y.node = b WHERE x.community = y.community) / sum(k) - sum(k * k) / (sum(k) * sum(k)), 9) AS modularity FROM tk2)
SELECT node, community, modularity FROM mb, md""")
def community_detect(t):
    """(node, community, modularity): connected communities of the undirected graph, by levels of contraction."""
    members = members_of(t)
    quality = graphs.modularity(weighted_graph(t)[1], members).select(F.round("modularity", 9).alias("modularity"))
    return members.join(F.broadcast(quality))


@query()
def community_hierarchy(t):
    """Communities split until none splits; each level's rows name their parent."""
    return tree_of(t)


@query(
    f"""{WITH}{_MEMBERS},
sz AS (SELECT community, count(*) AS size FROM mb GROUP BY 1),
p AS (SELECT x.community AS ca, y.community AS cb, ud.a, ud.b FROM ud JOIN mb x ON x.node = a JOIN mb y ON y.node = b),
l AS (SELECT ca AS community, sum(CASE WHEN ca = cb THEN 0.5 ELSE 0 END) AS internal, sum(CASE WHEN ca <> cb THEN 1 ELSE 0 END) AS ext FROM p GROUP BY 1)
SELECT community, size, CAST(internal AS BIGINT) AS internal_links, CAST(ext AS BIGINT) AS external_links,
  round(CASE WHEN size > 1 THEN internal / (size * (size - 1) / 2.0) ELSE 0 END, 6) AS density FROM sz JOIN l USING (community)"""
)
def community_stats(t):
    return stats_of(weighted_graph(t)[1], members_of(t))


def stats_of(pairs, members):
    sizes = members.groupBy("community").agg(F.count("*").alias("size"))
    ma = members.select(F.col("node").alias("a"), F.col("community").alias("ca"))
    mb = members.select(F.col("node").alias("b"), F.col("community").alias("cb"))
    p = pairs.join(ma, "a").join(mb, "b")
    same = F.col("ca") == F.col("cb")
    links = p.groupBy(F.col("ca").alias("community")).agg((F.count_if(same) / 2).cast("bigint").alias("internal_links"), F.count_if(~same).alias("external_links"))
    possible = F.col("size") * (F.col("size") - 1) / 2
    density = F.round(F.when(F.col("size") > 1, F.col("internal_links") / possible).otherwise(0.0), 6)
    return sizes.join(links, "community").select("community", "size", "internal_links", "external_links", density.alias("density"))


@query(
    f"""{WITH}{_MEMBERS}, nn AS (SELECT source AS node FROM ed UNION SELECT target FROM ed), c AS (SELECT node, count(mb.community) AS n FROM nn LEFT JOIN mb USING (node) GROUP BY 1)
SELECT count(*) AS nodes, count(*) FILTER (n = 0) AS without_community, count(*) FILTER (n > 1) AS in_several, count(*) FILTER (n <> 1) = 0 AS is_partition FROM c"""
)
def community_partition_check(t):
    """Every node of the edges in exactly one detected community: nodes are counted from the edges, members as they were stored."""
    nodes = weighted_graph(t)[0].select(F.explode(F.array("source", "target")).alias("node")).distinct()
    c = nodes.join(members_of(t), "node", "left").groupBy("node").agg(F.count("community").alias("n"))
    return c.agg(
        F.count("*").alias("nodes"), F.count_if(F.col("n") == 0).alias("without_community"), F.count_if(F.col("n") > 1).alias("in_several"),
        (F.count_if(F.col("n") != 1) == 0).alias("is_partition"),
    )


_FACTS = f"""{_MEMBERS},
fc AS MATERIALIZED (SELECT source, target, source || ' ' || relation || ' ' || target AS fact, relation IN {q.in_list(kg.CAUSES)} AS is_cause, count(*) AS weight FROM rl GROUP BY 1, 2, 3, 4),
cf AS MATERIALIZED (SELECT DISTINCT community, fact, is_cause, weight FROM fc JOIN mb ON node = source UNION SELECT community, fact, is_cause, weight FROM fc JOIN mb ON node = target)"""


def community_facts(rels, members):
    """(community, fact, is_cause, weight): facts that touch a member."""
    facts = rels.groupBy("source", "target", "relation").agg(F.count("*").alias("weight"))
    facts = facts.select(
        F.array_distinct(F.array("source", "target")).alias("ends"), F.concat_ws(" ", "source", "relation", "target").alias("fact"),
        F.col("relation").isin(*kg.CAUSES).alias("is_cause"), "weight",
    )
    rows = facts.select(F.explode("ends").alias("node"), "fact", "is_cause", "weight").join(members, "node")
    return rows.select("community", "fact", "is_cause", "weight").distinct()


@query(
    f"""{WITH}{_FACTS},
h AS (SELECT community, fact, row_number() OVER (PARTITION BY community ORDER BY weight DESC, fact) AS rn FROM cf WHERE is_cause),
hl AS (SELECT community, string_agg(fact, '; ' ORDER BY rn) AS headline FROM h WHERE rn <= 2 GROUP BY 1),
hb AS (SELECT community, node, row_number() OVER (PARTITION BY community ORDER BY k DESC, node) AS rn FROM mb JOIN dg USING (node)),
hs AS (SELECT community, string_agg(node, ' / ' ORDER BY rn) AS hubs FROM hb WHERE rn <= 3 GROUP BY 1)
SELECT community, hubs, coalesce(headline, 'no delay-related findings') AS headline FROM hs LEFT JOIN hl USING (community)"""
)
def community_headline(t):
    members = members_of(t)
    return headlines(community_facts(found_relations(t), members), weighted_graph(t)[1], members)


def headlines(facts, pairs, members):
    """Top two cause facts and top three hubs per community."""
    join_ranked = lambda df, c, sep, out: df.groupBy("community").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", c))), lambda r: r[c]), sep).alias(out)
    )
    causes = top_n(facts.where("is_cause"), ["community"], [F.desc("weight"), F.col("fact")], 2)
    degree = pairs.groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("k"))
    hubs = top_n(members.join(degree, "node"), ["community"], [F.desc("k"), F.col("node")], 3)
    out = join_ranked(hubs, "node", " / ", "hubs").join(join_ranked(causes, "fact", "; ", "headline"), "community", "left")
    return out.select("community", "hubs", F.coalesce("headline", F.lit("no delay-related findings")).alias("headline"))


def within_words(rows, key: str, order, text: str, words: int, sep: str, out: str):
    """(key, out): a key's first whole texts, in order, that fit a budget of words; at least the first one.

    A text has a word at least, so no more than `words` of them can fit and a key never sends more."""
    from pyspark.sql import Window

    head = top_n(rows.withColumn("__n", F.size(F.split(text, " "))), [key], order, words)
    so_far = F.sum("__n").over(Window.partitionBy(key).orderBy("rn"))
    return in_order(head.withColumn("__sum", so_far).where((F.col("__sum") <= words) | (F.col("rn") == 1)), key, text, sep, out)


BUDGET_WORDS = 100  # fixed value: words of a report


def tree_facts(t):
    """(community, fact, is_cause, weight) of the communities of all levels."""
    return derived(t, "tree_facts", lambda: written(community_facts(found_relations(t), tree_of(t).select("node", "community")), "facts"))


def rolled_up(t):
    """(community, level, parent, is_leaf, hubs, headline, raw_words, facts) of all levels, and (community, line): the headlines of a parent's children."""

    def build():
        tree, facts = tree_of(t), tree_facts(t)
        words = facts.groupBy("community").agg(F.sum(F.size(F.split("fact", " "))).alias("raw_words"), F.count("*").alias("facts"))
        head = headlines(facts, weighted_graph(t)[1], tree.select("node", "community"))
        return written(tree.select("community", "level", "parent", "is_leaf").distinct().join(head, "community").join(words, "community", "left"), "reports")

    base = derived(t, "tree_heads", build)
    kids = base.where("parent <> 'root'").select(F.col("parent").alias("community"), F.concat_ws(": ", F.col("community"), "headline").alias("line"))
    return base, kids


def from_facts(raw_words, budget_words: int):
    """Whether a report is written from raw facts: those of a leaf, and of a parent whose facts fit the budget."""
    return F.col("is_leaf") | (F.coalesce(raw_words, F.lit(0)) <= budget_words)


@query()
def community_rollup(t, budget_words: int = BUDGET_WORDS):
    """Leaf reports from facts; a parent takes its raw facts if they fit, else its children's headlines.

    A report holds whole facts, heaviest first, up to the budget."""
    base, kids = rolled_up(t)
    text = within_words(tree_facts(t), "community", [F.desc("weight"), F.col("fact")], "fact", budget_words, ". ", "raw_text")
    kid_text = within_words(kids, "community", [F.col("line")], "line", budget_words, " || ", "child_text")
    rows = base.join(text, "community", "left").join(kid_text, "community", "left")
    fits = F.col("child_text").isNull() | from_facts(F.col("raw_words"), budget_words)
    method = F.when(F.col("is_leaf") | F.col("child_text").isNull(), "leaf").when(fits, "parent: facts fit").otherwise("parent: child reports")
    return rows.select(
        "community", "level", "parent", F.col("hubs").alias("title"), "headline", method.alias("method"), F.coalesce("raw_words", F.lit(0)).alias("raw_words"),
        F.when(fits, F.coalesce("raw_text", F.lit(""))).otherwise(F.col("child_text")).alias("report"),
    )


def report_store(t, budget_words: int = BUDGET_WORDS):
    """(community, body): the whole reports of all levels in parts, for search; a community is named by a number.

    The parts are a report's facts, or the lines of its children where a parent's facts don't fit the budget; none is left out."""
    base, kids = rolled_up(t)
    raw = base.where(from_facts(F.col("raw_words"), budget_words)).select("community")
    facts = tree_facts(t).join(raw, "community", "left_semi").select("community", F.col("fact").alias("body"))
    lines = kids.join(raw, "community", "left_anti").select("community", F.col("line").alias("body"))
    return facts.unionByName(lines).select(name_id(F.col("community")).alias("community"), "body")


def name_id(name):
    """A number for a name, which vector search needs as a key."""
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")


def whole_vectors(parts, key: str, text: str):
    """(key, embedding): hashed word counts of all texts of a key, added up by (key, dimension); no text is put together."""
    counted = parts.select(key, F.explode(hashed(F.col(text))).alias("dim")).groupBy(key, "dim").agg(F.count("*").cast("double").alias("tf"))
    dims = counted.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("dim", "tf"))).alias("m"))  # DIMS entries at most
    return dims.select(key, F.transform(F.sequence(F.lit(0), F.lit(DIMS - 1)), lambda d: F.coalesce(F.try_element_at("m", d), F.lit(0.0))).alias("embedding"))


def text_vectors(texts, key: str, text: str):
    """(key, embedding): hashed words of a key's whole texts, mostly one; a text moves as one short array."""
    buckets = texts.select(key, hashed(F.col(text)).alias("b")).groupBy(key).agg(F.flatten(F.collect_list("b")).alias("embedding"))
    return buckets.where(F.size("embedding") > 0)


def _probe(asked, parts, key: str, text: str, k: int = 3):
    """Best keys of every question, by the words of all texts that belong to a key."""
    return best_per_query(whole_vectors(parts, key, text), key, whole_vectors(asked, "item_id", "text"), "item_id", k)


@query()
def stores_three(t):
    """Chunk, entity and report stores, embedded alike and probed with every question."""
    rels = found_relations(t)
    nodes = rels.select(F.explode(F.array("source", "target")).alias("node"), F.concat_ws(" ", "source", "relation", "target").alias("body")).distinct().withColumn("id", name_id(F.col("node")))
    reports = community_facts(rels, members_of(t)).select(name_id(F.col("community")).alias("id"), F.col("fact").alias("body"))
    chunks = text_vectors(t.documents.select(F.col("doc_id").alias("id"), "text"), "id", "text")
    asked, out = whole_vectors(t.benchmark, "item_id", "text"), None
    for name, df in {"chunks": chunks, "entities": whole_vectors(nodes, "id", "body"), "reports": whole_vectors(reports, "id", "body")}.items():
        part = best_per_query(df, "id", asked, "item_id", 3).select(F.lit(name).alias("store"), "item_id", "id", "similarity", "rank")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    f"""{WITH}{_EDGES}, {_levels(2)}, sub AS (SELECT node FROM h0 UNION SELECT node FROM h1 UNION SELECT node FROM h2),
x AS (SELECT doc_id, count(DISTINCT alias) AS entities FROM ment WHERE alias IN (SELECT node FROM sub) GROUP BY 1)
SELECT doc_id, entities, row_number() OVER (ORDER BY entities DESC, doc_id) AS position FROM x ORDER BY position LIMIT 10"""
)
def local_search(t, k: int = 10):
    """Texts ranked by how many entities of the seed's two-hop neighbourhood they mention."""
    found, (_, pairs) = found_mentions(t), weighted_graph(t)
    return local_ranking(found, graphs.khop(pairs, seed_node(pairs), 2), k)


def local_ranking(found, nodes, k: int):
    from pyspark.sql import Window

    uses = found.join(nodes.select(F.col("node").alias("entity")), "entity", "left_semi").select("doc_id", "entity").distinct()
    best = uses.groupBy("doc_id").agg(F.count("*").alias("entities")).orderBy(F.desc("entities"), "doc_id").limit(k)
    return best.withColumn("position", F.row_number().over(Window.orderBy(F.desc("entities"), "doc_id")).cast("bigint"))  # k rows


def _vec_sql(name: str, source: str, key: str) -> str:
    return (
        f"{name}_c AS (SELECT {key}, ('0x' || substr(md5(tok), 1, 8))::BIGINT % {DIMS} AS dim, count(*) AS tf FROM (SELECT {key}, unnest({q.toks('text')}) AS tok FROM {source}) GROUP BY 1, 2), "
        f"{name}_v AS (SELECT {key}, dim, tf / sqrt(sum(tf * tf) OVER (PARTITION BY {key})) AS w FROM {name}_c)"
    )


@query(
    f"""{WITH}{_FACTS},
rp AS (SELECT community, fact AS text FROM cf),
{_vec_sql('r', 'rp', 'community')}, {_vec_sql('b', 'benchmark', 'item_id')},
s AS (SELECT item_id, community, round(sum(r_v.w * b_v.w), 6) AS sim FROM r_v JOIN b_v USING (dim) GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY sim DESC, ('0x' || substr(md5(community), 1, 15))::BIGINT) AS rn FROM s),
m AS (SELECT item_id, community, CAST(round(100 * sim) AS INTEGER) AS score FROM k WHERE rn <= 25 AND round(100 * sim) >= 33),
p AS (SELECT item_id, fact AS point, count(*) AS support, max(score) AS best_score FROM m JOIN cf USING (community) WHERE is_cause GROUP BY 1, 2),
z AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY support DESC, best_score DESC, point) AS rank FROM p)
SELECT item_id, point, support, best_score, rank FROM z WHERE rank <= 5"""
)
def global_map_reduce(t, reports: int = 25, threshold: int = 33, keep: int = 5):
    """Map: best reports per question give scored points. Filter weak ones. Reduce: pool, merge, rank."""
    facts = facts_of(t)
    return map_reduce(t.benchmark, facts.select("community", F.col("fact").alias("body")), facts, reports, threshold, keep)


def facts_of(t):
    """(id, fact, is_cause, weight): the facts of every detected community, which is named by a number."""
    return derived(t, "facts", lambda: written(community_facts(found_relations(t), members_of(t)).select(name_id(F.col("community")).alias("community"), "fact", "is_cause", "weight"), "facts"))


def map_reduce(asked, store, facts, reports: int, threshold: int, keep: int):
    """`asked` is (item_id, text); `store` has the parts (community, body) of what is searched, `facts` the points that a community can make."""
    mapped = _probe(asked, store, "community", "body", reports).select("item_id", "community", F.round(100 * F.col("similarity")).cast("int").alias("score"))
    kept = mapped.where(F.col("score") >= threshold)
    points = kept.join(facts.where("is_cause").select("community", F.col("fact").alias("point")), "community")
    pooled = points.groupBy("item_id", "point").agg(F.count("*").alias("support"), F.max("score").alias("best_score"))
    out = top_n(pooled, ["item_id"], [F.desc("support"), F.desc("best_score"), F.col("point")], keep, "rank")
    return out.withColumn("rank", F.col("rank").cast("bigint"))


def routes(t):
    """(item_id, text, route, seed): a question that names an entity goes to local search, with a theme cue to both, else to global search.

    The seed is the first of its entities, one of the graph before others."""
    sents = kg.sentence_table(t.benchmark, "item_id")
    nodes = weighted_graph(t)[1].select(F.col("a").alias("entity"), F.lit(True).alias("linked")).distinct()
    named = kg.mentions(sents, names_of(t), "item_id").select("item_id", "entity").distinct().join(nodes, "entity", "left")
    seeds = named.groupBy("item_id").agg(F.min(F.struct(F.col("linked").isNull().alias("apart"), "entity"))["entity"].alias("seed"))
    cue = scoring.has_cue(tokens(F.coalesce("text", F.lit(""))), lx.INTENTS[2][2])
    route = F.when(F.col("seed").isNull(), "global").when(cue, "hybrid").otherwise("local")
    return written(t.benchmark.join(seeds, "item_id", "left").select("item_id", "text", route.alias("route"), "seed"), "routes")


def local_rankings(found, pairs, seeds, k: int):
    """(seed, doc_id, entities, position): for every seed, the k texts that mention most entities within its two hops."""
    near = last = cut(seeds.select("seed", F.col("seed").alias("node")).distinct())
    for _ in range(2):
        last = cut(last.join(pairs.select(F.col("a").alias("node"), "b"), "node").select("seed", F.col("b").alias("node")).distinct().join(near, ["seed", "node"], "left_anti"))
        near = near.unionByName(last)
    # an entity's seeds travel as one array to its texts' tasks, where they are counted
    around = near.groupBy(F.col("node").alias("entity")).agg(F.collect_list("seed").alias("seeds"))
    uses = found.select("doc_id", "entity").distinct().join(around, "entity").select("doc_id", "seeds").repartition("doc_id")
    best = uses.select("doc_id", F.explode("seeds").alias("seed")).groupBy("doc_id", "seed").agg(F.count("*").alias("entities"))
    out = top_n(best, ["seed"], [F.desc("entities"), F.col("doc_id")], k, "position")
    return out.select("seed", "doc_id", "entities", F.col("position").cast("bigint").alias("position"))


@query()
def drift_hybrid(t):
    """Primer from the reports, refinement in two hops around the seed, follow-ups on the seed's own links."""
    found, (_, pairs) = found_mentions(t), weighted_graph(t)
    seed, facts = cut(seed_node(pairs)), facts_of(t)
    primer = map_reduce(t.benchmark, facts.select("community", F.col("fact").alias("body")), facts, 25, 33, 3).select(F.lit("primer").alias("stage"), F.col("point").alias("item"), F.col("support").alias("weight"))
    refine = local_ranking(found, graphs.khop(pairs, seed, 2), 5).select(F.lit("refine").alias("stage"), F.col("doc_id").cast("string").alias("item"), F.col("entities").alias("weight"))
    linked = pairs.join(seed, pairs["a"] == seed["node"]).orderBy(F.desc("weight"), "b").limit(5)
    follow = linked.select(F.lit("follow_up").alias("stage"), F.col("b").alias("item"), "weight")
    return primer.groupBy("stage", "item").agg(F.sum("weight").alias("weight")).unionByName(refine).unionByName(follow)


@query(
    f"""{WITH}{_MEMBERS}, nd AS (SELECT max(doc_id) AS d FROM rl),
tc AS (SELECT source, target, count(*) AS added FROM rl WHERE doc_id = (SELECT d FROM nd) GROUP BY 1, 2)
SELECT source, target, CAST(weight - added AS BIGINT) AS weight_before, weight AS weight_after, community, weight = added AS is_new FROM tc JOIN ed USING (source, target) JOIN mb ON node = source"""
)
def freshness_impact(t):
    """What the newest linked text changed: edge weights before and after, reports to rebuild."""
    rels = found_relations(t)
    e = weighted_graph(t)[0]
    newest = rels.agg(F.max("doc_id").alias("d"))
    touched = rels.join(F.broadcast(newest)).where("doc_id = d").groupBy("source", "target").agg(F.count("*").alias("added"))
    rows = e.join(touched, ["source", "target"]).join(members_of(t).withColumnRenamed("node", "source"), "source")
    return rows.select(
        "source", "target", (F.col("weight") - F.col("added")).alias("weight_before"), F.col("weight").alias("weight_after"), "community", (F.col("weight") == F.col("added")).alias("is_new")
    )


@query(
    f"""{WITH}{_MENTIONS}, u AS (SELECT DISTINCT alias, doc_id FROM ment),
c AS (SELECT alias, doc_id, lag(doc_id) OVER (PARTITION BY alias ORDER BY doc_id) AS previous FROM u)
SELECT previous, doc_id, count(*) AS n, min(alias) AS first_shared, max(alias) AS last_shared FROM c WHERE previous IS NOT NULL GROUP BY 1, 2"""
)
def entity_bridges(t):
    return kg.bridges(found_mentions(t))


@query(
    f"""{WITH}{_EDGES}, c AS (SELECT (SELECT count(*) FROM documents) AS texts, (SELECT count(*) FROM dg) AS entities, (SELECT count(*) FROM ed) AS edges),
w AS (SELECT texts, entities, edges, texts + entities + edges AS index_work FROM c)
SELECT CAST(n AS BIGINT) AS queries, index_work, round(index_work / n + 3, 6) AS cost_per_query, round(texts / 10.0 / n + 12, 6) AS cost_per_query_direct FROM w, (VALUES (1), (10), (100), (1000), (10000)) AS v(n)"""
)
def index_cost_model(t):
    """Index work spread over the number of queries, from real counts."""
    e = weighted_graph(t)[0]
    texts = t.texts.agg(F.count("*").alias("texts"))
    ents = e.select(F.explode(F.array("source", "target")).alias("n")).distinct().agg(F.count("*").alias("entities"))
    counts = texts.join(F.broadcast(ents)).join(F.broadcast(e.agg(F.count("*").alias("edges"))))  # one row each
    w = counts.withColumn("index_work", F.col("texts") + F.col("entities") + F.col("edges"))
    rows = w.select("*", F.explode(F.array(*[F.lit(x).cast("bigint") for x in (1, 10, 100, 1000, 10000)])).alias("queries"))
    return rows.select(
        "queries", "index_work", F.round(F.col("index_work") / F.col("queries") + 3, 6).alias("cost_per_query"), F.round(F.col("texts") / 10 / F.col("queries") + 12, 6).alias("cost_per_query_direct")
    )
