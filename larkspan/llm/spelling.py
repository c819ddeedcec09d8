"""Spelling variants: words one edit apart, found by a frontier over a trie.

`counted_words` counts the words of a corpus; `group_variants` takes any table
(word, n) and finds all pairs that differ by exactly one inserted, deleted or
replaced code point.

The trie is a table of edges per level, split by the length of the words below:
a node is (direction, length, prefix), named by a 64-bit hash. A state (word,
position, node, edits) is joined with the edges of its node. Of the two halves
of a word one is untouched by a single edit, so a word enters the trie of its
own length and the trie of words one longer at the node of its first half, and
the trie of reversed words at the node of its last half; each round moves all
states one level down (those that spent their edit two levels). Edges reach two
characters down: the second one must be the character that goes on after the
edit, and is part of the join key, so few states are born that die at once. An
edge with a single word below ends the walk: what is left is compared. States
that end at a word are the neighbours. The edit distance is verified at the
end, so hash collisions cannot add a pair, and none can be lost by them.

The number of rounds follows the longest prefix beyond the half that words of
one length share, not the longest word: states alone in their node are compared
and dropped every few rounds. Nothing is broadcast by hint or collected; loop
state is written to the shared folder.

Defined results: null text has no runs; a null key counts as empty in the key's
text; repeated rows count again. Words are compared by code point, and only A-Z
is lower-cased. Empty tables give no rows, other columns are ignored. Ties of
the most frequent neighbour go to the word first in code-point order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.storage import written

LETTERS = "A-Za-zÀ-ÿ"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST = 7  # code points of a word
TWICE = 2  # occurrences of a word
RATIO = 10  # a form is so many times as frequent
END = "$"  # closes a word in the trie; not a letter
CHECK_EVERY = 8  # rounds between looks for states that are alone in their node


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(key, run): maximal runs of letters of at least `least` code points, A-Z lower-cased."""
    found = F.regexp_extract_all(F.col(text), F.lit(f"([{LETTERS}]{{{least},}})"), 1)
    return docs.select(F.col(key).alias("key"), F.explode(found).alias("run")).select("key", F.translate("run", UPPER, UPPER.lower()).alias("run"))


def with_typos(found: DataFrame, every: int = 31) -> DataFrame:
    """The runs, those whose crc32 with their key is divisible by `every` without one of their letters."""
    h = F.crc32(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    x = found.select("key", "run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return x.select("key", F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("run"))


def counted_words(found: DataFrame, least: int = LEAST, twice: int = TWICE) -> DataFrame:
    """(word, n) of the runs long and frequent enough."""
    return found.where(F.length("run") >= least).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= twice)


def _oriented(word: Column, reverse: Column) -> Column:
    return F.concat(F.when(reverse, F.reverse(word)).otherwise(word), F.lit(END))


def _half(size: Column, reverse: Column) -> Column:
    return F.when(reverse, F.floor(size / 2)).otherwise(F.ceil(size / 2)).cast("int")


def _node(path: Column, size: Column, reverse: Column, depth: Column) -> Column:
    return F.xxhash64(reverse, size, F.substr(path, F.lit(1), depth))


def _char(path: Column, at: Column) -> Column:
    """The character at a position from 0; empty beyond the end."""
    return F.substr(path, at + 1, F.lit(1))


def neighbours(words: DataFrame) -> DataFrame:
    """(a, b): both orders of every pair of distinct words one edit apart. `words` is (word), without repeats."""
    rev = F.col("rev")
    ways = words.select("word", F.explode(F.array(F.lit(False), F.lit(True))).alias("rev"))
    ways = ways.select("word", "rev", _oriented(F.col("word"), rev).alias("path"), F.length("word").alias("own"))
    # a word walks among words of its own length (a replaced character) and one longer (an inserted one)
    alive = ways.select("*", F.explode(F.array(F.col("own"), F.col("own") + 1)).alias("size"))
    alive = alive.select("word", "rev", "own", "size", _half(F.col("size"), rev).alias("half"))
    trie = ways.select("rev", "path", F.col("own").alias("size"), _half(F.col("own"), rev).alias("half"))
    pairs, waiting, rounds = [], {}, 0
    while True:
        depth = F.col("half") + rounds
        if rounds % CHECK_EVERY == 0:
            here = alive.where(depth < F.col("size")).withColumn("path", _oriented(F.col("word"), rev))
            here = here.withColumn("node", _node(F.col("path"), F.col("size"), rev, depth))
            below = trie.where(depth < F.col("size")).groupBy(_node(F.col("path"), F.col("size"), rev, depth).alias("node")).agg(F.count("*").alias("n"), F.min("path").alias("only"))
            met = here.join(below, "node").where((F.col("n") > 1) | (F.col("only") != F.col("path")))
            met = written(met.select("word", "rev", "own", "size", "half", F.when(F.col("n") == 1, F.col("only")).alias("only")), "alive")
            only = F.expr("left(only, length(only) - 1)")
            single = met.where("only is not null").select("word", F.when(rev, F.reverse(only)).otherwise(only).alias("other"))
            pairs.append(written(single.where(F.levenshtein("word", "other", 1) == 1), "neighbours"))
            alive = met.where("only is null").drop("only")
        states = alive.where(depth < F.col("size")).select("word", "rev", "own", "size", "half", depth.alias("pos"), F.lit(0).alias("edits"))
        states = states.withColumn("node", _node(_oriented(F.col("word"), rev), F.col("size"), rev, F.col("pos")))
        spent = waiting.pop(rounds, None)
        if spent is not None:
            states = states.unionByName(spent)
        if (spent is None or spent.isEmpty()) and not waiting and alive.where(depth < F.col("size")).isEmpty():
            break
        edges = trie.where(depth < F.col("size")).select(
            _node(F.col("path"), F.col("size"), rev, depth).alias("node"), _char(F.col("path"), depth).alias("c1"), _char(F.col("path"), depth + 1).alias("c2"),
            _node(F.col("path"), F.col("size"), rev, depth + 2).alias("child"), "path",
        )
        edges = edges.groupBy("node", "c1", "c2").agg(F.min("child").alias("child"), F.count("*").alias("below"), F.min("path").alias("only"))
        pos, path = F.col("pos"), F.col("path")
        longer = F.col("size") > F.col("own")
        at = states.withColumn("path", _oriented(F.col("word"), rev))
        at = at.withColumn("next", _char(path, pos)).withColumn("c2", F.when((F.col("edits") == 0) & longer, F.col("next")).otherwise(_char(path, pos + 1)))
        same, other = F.col("c1") == F.col("next"), F.col("c1") != F.col("next")
        replaced = (F.col("edits") == 0) & ~longer & (F.col("c1") > F.col("next")) & (F.col("next") != END) & (F.col("c1") != END)
        inserted = (F.col("edits") == 0) & longer & other & (F.col("c1") != END)
        moved = at.join(edges, ["node", "c2"]).where(((F.col("edits") == 1) & same) | replaced | inserted)
        # where the walk goes on in the word, and in the trie
        moved = moved.withColumn("pos", F.when(inserted, pos + 1).otherwise(pos + 2)).withColumn("down", depth + 2)
        ended = moved.where("below = 1").where(F.substr("path", pos + 1) == F.substr("only", F.col("down") + 1))
        only = F.expr("left(only, length(only) - 1)")
        ended = ended.select("word", F.when(rev, F.reverse(only)).otherwise(only).alias("other"), F.lit(None).cast("struct<rev:boolean,own:int,size:int,half:int,pos:int,node:bigint>").alias("state"))
        ended = ended.where(F.levenshtein("word", "other", 1) == 1)
        on = moved.where("below > 1").select("word", F.lit(None).cast("string").alias("other"), F.struct("rev", "own", "size", "half", "pos", F.col("child").alias("node")).alias("state"))
        both = written(ended.unionByName(on), "frontier")
        pairs.append(both.where("other is not null").select("word", "other"))
        on = both.where("state is not null").select("word", "state.*").withColumn("edits", F.lit(1))
        if not on.isEmpty():
            waiting[rounds + 2] = on.select("word", "rev", "own", "size", "half", "pos", "edits", "node")
        rounds += 1
    found = pairs[0]
    for p in pairs[1:]:
        found = found.unionByName(p)
    both = found.select(F.explode(F.array(F.struct(F.col("word").alias("a"), F.col("other").alias("b")), F.struct(F.col("other").alias("a"), F.col("word").alias("b")))).alias("p"))
    return both.select("p.a", "p.b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form, following (word, form) to the last by doubling. Forms must not run in a circle."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = written(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.drop("moved")


def group_variants(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each row of `counts`, (word, n) without repeats."""
    words = written(counts.select("word", F.col("n").cast("bigint").alias("n")), "words")
    near = neighbours(words.select("word")).join(words.withColumnRenamed("word", "b"), "b")
    best = near.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), "b")).alias("best"))
    x = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.b").alias("b"), (-F.col("best.minus")).alias("m"))
    is_form = F.col("m") >= ratio * F.col("n")
    x = written(x.select("word", "n", "n_near", F.when(is_form, F.col("b")).alias("form"), F.when(is_form, F.col("m")).alias("form_n")), "forms")
    last = roots(x.where("form is not null"))
    return x.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
