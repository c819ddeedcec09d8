"""Line dedup by a deletion-neighbourhood join, edit bound one.

A line (a trimmed, non-blank run of a text between line feeds) goes if an equal
line, or one within one edit of it (a character put in, taken out or changed),
stands earlier in order of (doc_id, line number, text hash); the earliest stays.

* Equal lines meet by a 128-bit hash and are counted down to the first place.
* Two different lines within one edit agree in their first or last half, so only
  lines that share a half with another line go on. This loses no pair.
* Of these, hashes of all variants with one character taken out are counted, and
  those that two lines have go on.
* Each line emits the hashes of all its variants with one character taken
  out. Lines whose variants at the same position are equal differ in that
  character only; a line equal to another's variant lacks one character of it.
  Either way all lines under one key are within one edit of one line, so the
  earliest of a key is found by an aggregation: no pair of a group is listed.
* The edit distance of a line and the earliest found for it is then verified.

Variant hashes are sums over a line's characters, mixed and weighted by powers,
so all variants of a line cost one pass; keys have 2 x 64 bits.

Lines shorter than `min_chars` characters are compared for equality only: one
edit is most of a short line.

Defined results: null and empty texts have no lines and are kept as they are;
blank lines are never repeats. Equal rows that repeat a doc_id count as one
document: both keep what the first keeps. Different texts of one doc_id (or of
none) are documents of their own, in order of line number and the text's hash
between them. A null doc_id comes first. An empty table gives
no rows. All columns of the documents are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.llm.worker import pieces_of
from larkspan.storage import written

MIN_CHARS = 16
SPACES = " \t\r\f\v"
SMALL_ROWS = 1 << 20  # a table counted to be no longer is broadcast, a longer one joined plainly


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def _sized(table: DataFrame) -> DataFrame:
    """For a written table of narrow rows: with a broadcast hint if it is counted to be small."""
    return F.broadcast(table) if table.count() <= SMALL_ROWS else table


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, doc_hash, line_no, line, h1, h2): every non-blank line, trimmed; `doc_hash` is of the whole text."""
    every = docs.select(key, F.xxhash64(text).alias("doc_hash"), F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))
    every = every.withColumn("line", _trimmed(F.col("line"))).where("line <> ''")
    return every.select(key, "doc_hash", "line_no", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def half_keys(line: Column) -> Column:
    """Hashes of the first and last half of a line, as the shorter and as the longer of a pair."""
    n = F.length(line)

    def key(tag: str, of: Column) -> Column:
        m = F.floor(of / 2).cast("int")
        part = F.substring(line, F.lit(1), m) if tag == "first" else F.substring(line, n - m + 1, m)
        return F.xxhash64(F.lit(tag), of, part)

    return F.array(*[key(tag, of) for tag in ("first", "last") for of in (n, n - 1)])


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)  # odd, so powers can be taken back
SALTS = (0x1234567, 0x89ABCDEF)


def variants(line: str) -> list[tuple[np.ndarray, np.uint64]]:
    """Per hash: those of the line without its i-th character, for every i, and of the line itself."""
    chars = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for base, salt in zip(BASES, SALTS):
            power = np.full(len(chars), base, np.uint64)
            power[:1] = 1
            power = np.cumprod(power, dtype=np.uint64)
            terms = _mix(chars, salt) * power
            upto = np.cumsum(terms, dtype=np.uint64)
            total = upto[-1] if len(upto) else np.uint64(0)
            back = np.uint64(pow(base, -1, 1 << 64))
            out.append((upto - terms + (total - upto) * back, total))
    return out


def variant_hashes(lines: DataFrame) -> DataFrame:
    """(k, h1): the first hash of a line and of every variant of it, places left out."""

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, 1 << 18):
                every = [np.unique(np.append(v, whole)) for v, whole in (variants(line)[0] for line in part.column("line").to_pylist())]
                at = pa.array(np.repeat(np.arange(len(every)), [len(v) for v in every]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(every).view(np.int64)), part.column("h1").take(at)], names=["k", "h1"])

    return lines.select("h1", "line").mapInArrow(run, "k BIGINT, h1 BIGINT")


def variant_keys(lines: DataFrame) -> DataFrame:
    """(k1, k2, kind, row...): kind >= 0 is the place of the changed character, -1 a line that lacks a
    character of others, -2 such an other."""
    schema = f"k1 BIGINT, k2 BIGINT, kind INT, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in lines.schema if f.name != 'line')}"
    rest = [c for c in lines.columns if c != "line"]
    names = ["k1", "k2", "kind", *rest]

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, 1 << 18):
                keys, kinds, at = ([], []), [], []
                for i, line in enumerate(part.column("line").to_pylist()):
                    (a, whole_a), (b, whole_b) = variants(line)
                    n = len(a)
                    # characters of a run give the same variant: once is enough for a lacking character
                    first = np.concatenate([[True], a[1:] != a[:-1]])
                    for found, whole, v in ((keys[0], whole_a, a), (keys[1], whole_b, b)):
                        found += [v, [whole], v[first]]
                    kinds += [np.arange(n), [-1], np.full(first.sum(), -2)]
                    at.append(np.full(n + 1 + first.sum(), i))
                at = pa.array(np.concatenate(at))
                cols = [pa.array(np.concatenate([np.asarray(x, np.uint64) for x in k]).view(np.int64)) for k in keys]
                cols += [pa.array(np.concatenate(kinds).astype(np.int32))] + [part.column(c).take(at) for c in rest]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return lines.mapInArrow(run, schema)


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> tuple[DataFrame, DataFrame]:
    """(firsts, near): `firsts` is (h1, h2, place) for each distinct line, `near` is (h1, h2, earlier)
    for those with an earlier line within one edit; places are (key, line number, hash of the text)."""
    every = lines_of(docs, key, text)
    place = F.struct(F.col(key).alias("key"), "line_no", "doc_hash")
    long = F.length("line") >= min_chars
    halves = F.when(long, half_keys(F.col("line")))
    firsts = every.select("h1", "h2", place.alias("place"), halves.alias("halves")).groupBy("h1", "h2").agg(F.min("place").alias("place"), F.first("halves").alias("halves"))
    firsts = written(firsts, "lines")
    keyed = firsts.select(F.explode("halves").alias("half"), "h1", "h2")
    shared = written(keyed.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("half"), "halves")
    may = keyed.join(_sized(shared), "half", "left_semi").select("h1", "h2").distinct()
    # each line's text is read again at its first place
    wanted = written(firsts.join(may, ["h1", "h2"], "left_semi").select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), "place"), "wanted")
    at = (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2")) & F.col(key).eqNullSafe(F.col("place.key")) & (F.col("line_no") == F.col("place.line_no")) & (F.col("doc_hash") == F.col("place.doc_hash"))
    lined = every.where(long).join(_sized(wanted), at)
    lined = written(lined.select("h1", "h2", "place", "line").dropDuplicates(["h1", "h2"]), "candidates")
    # of all variants only those go on that two lines have, whatever their places
    met = variant_hashes(lined).groupBy("k").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("k")
    met = written(met, "variants")
    keys = variant_keys(lined.select("h1", "h2", "place", "line"))
    keys = written(keys.join(_sized(met), F.col("k1") == F.col("k"), "left_semi"), "keys")
    least = F.min(F.struct("place", "h1", "h2"))
    # a changed character: everything under (variant, place of the change)
    same = keys.where("kind >= 0").groupBy("k1", "k2", "kind").agg(least.alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    changed = keys.where("kind >= 0").join(same, ["k1", "k2", "kind"]).select("h1", "h2", "place", F.col("least").alias("earlier"))
    # a missing character: the shorter line is the key itself
    shorter = keys.where("kind = -1").select("k1", "k2", F.struct("place", "h1", "h2").alias("short"))
    longer = keys.where("kind = -2")
    lacking = longer.join(shorter, ["k1", "k2"]).select("h1", "h2", "place", F.col("short").alias("earlier"), "short")
    longest_first = longer.groupBy("k1", "k2").agg(least.alias("earlier")).join(shorter, ["k1", "k2"])
    grown = longest_first.select(F.col("short.h1").alias("h1"), F.col("short.h2").alias("h2"), F.col("short.place").alias("place"), "earlier")
    found = changed.unionByName(lacking.drop("short")).unionByName(grown).where(F.col("earlier.place") < F.col("place"))
    # one row per line and other line, then the earliest that the edit distance confirms
    pairs = found.select("h1", "h2", F.col("earlier.h1").alias("e1"), F.col("earlier.h2").alias("e2"), F.col("earlier.place").alias("earlier")).distinct()
    texts = lined.select("h1", "h2", "line")
    pairs = pairs.join(texts, ["h1", "h2"]).join(texts.withColumnsRenamed({"h1": "e1", "h2": "e2", "line": "other"}), ["e1", "e2"])
    near = pairs.where(F.levenshtein("line", "other", 1) >= 0).groupBy("h1", "h2").agg(F.min("earlier").alias("earlier"))
    return firsts.drop("halves"), near


def _decided(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(key, doc_hash, line_no, kind) for the lines that go: 1 copies, 2 near copies."""
    firsts, near = repeated_lines(docs, key, text, min_chars)
    every = lines_of(docs, key, text).select(key, "doc_hash", "line_no", "h1", "h2")
    near = near.select("h1", "h2", F.lit(True).alias("near"))
    state = firsts.join(near, ["h1", "h2"], "left")
    first = F.col(key).eqNullSafe(F.col("place.key")) & (F.col("line_no") == F.col("place.line_no")) & (F.col("doc_hash") == F.col("place.doc_hash"))
    kind = F.when(~first, 1).when(F.col("near"), 2)
    return every.join(state, ["h1", "h2"]).select(key, "doc_hash", "line_no", kind.alias("kind")).where("kind is not null")


def _by_document(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    gone = _decided(docs, key, text, min_chars)
    return gone.groupBy(F.col(key).alias("__key"), F.col("doc_hash").alias("__hash")).agg(
        F.collect_set(F.when(F.col("kind") == 1, F.col("line_no"))).alias("__copies"), F.collect_set(F.when(F.col("kind") == 2, F.col("line_no"))).alias("__near")
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, counts: str | None = None) -> DataFrame:
    """The documents without repeated lines; with `counts`, a prefix, also n_lines, n_copies and n_near.

    What is collected per document is the numbers of its own lines."""
    gone = _by_document(docs, key, text, min_chars)
    x = docs.join(gone, docs[key].eqNullSafe(gone["__key"]) & (F.xxhash64(docs[text]) == gone["__hash"]), "left")
    none = F.array().cast("array<int>")
    x = x.withColumn("__copies", F.coalesce("__copies", none)).withColumn("__near", F.coalesce("__near", none))
    lines = F.split(docs[text], "\n", -1)
    gone_at = F.concat("__copies", "__near")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone_at)
    kept = F.array_join(F.transform(left, lambda i: F.element_at(lines, i + 1)), "\n")
    new = F.when(F.size(gone_at) > 0, kept).otherwise(docs[text])
    cols = [new.alias(c) if c == text else docs[c] for c in docs.columns]
    if counts is not None:
        filled = F.filter(lines, lambda line: _trimmed(line) != "")
        cols += [F.coalesce(F.size(filled), F.lit(0)).cast("bigint").alias(f"{counts}n_lines"), F.size("__copies").cast("bigint").alias(f"{counts}n_copies"), F.size("__near").cast("bigint").alias(f"{counts}n_near")]
    return x.select(*cols)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without repeated lines; a document of which no word is left goes."""
    left = dedup_lines(docs, counts="__")
    return left.where("__n_lines = 0 or __n_lines > __n_copies + __n_near").select(*docs.columns)


def oracle(table: str = "documents", min_chars: int = MIN_CHARS) -> str:
    """The rows of op2_lines as DuckDB SQL: all pairs of lines that share a half are compared."""
    return f"""
WITH l0 AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM {table}),
l1 AS (SELECT doc_id, unnest(range(len(ls))) AS line_no, regexp_replace(unnest(ls), '^[ \t\r\f\v]+|[ \t\r\f\v]+$', '', 'g') AS line FROM l0),
l2 AS (SELECT * FROM l1 WHERE line <> ''),
f AS (SELECT line, min((doc_id, line_no)) AS place, length(line) AS n FROM l2 GROUP BY line),
g AS (SELECT line, place, n, unnest([n, n - 1]) AS m FROM f WHERE n >= {min_chars}),
h AS (SELECT line, place, n, unnest([('first', m, left(line, m // 2)), ('last', m, right(line, m // 2))]) AS half FROM g),
p AS (SELECT DISTINCT b.line, b.n, a.line AS other, a.n AS o FROM h a JOIN h b ON a.half = b.half AND a.place < b.place AND abs(a.n - b.n) <= 1),
near AS (SELECT DISTINCT line FROM p WHERE len(list_filter(range(greatest(n, o)), lambda i: left(line, i) = left(other, i)
         AND right(line, n - i - CASE WHEN n >= o THEN 1 ELSE 0 END) = right(other, o - i - CASE WHEN o >= n THEN 1 ELSE 0 END))) > 0),
d AS (SELECT l2.doc_id, l2.line_no, CASE WHEN f.place <> (l2.doc_id, l2.line_no) THEN 1 WHEN near.line IS NOT NULL THEN 2 ELSE 0 END AS kind
      FROM l2 JOIN f ON l2.line = f.line LEFT JOIN near ON l2.line = near.line),
x AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (kind = 1) AS n_copies, count(*) FILTER (kind = 2) AS n_near, list(line_no) FILTER (kind > 0) AS gone FROM d GROUP BY doc_id)
SELECT l0.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_copies, 0) AS n_copies, coalesce(n_near, 0) AS n_near,
       sha256(CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(len(ls)), lambda i: NOT list_contains(gone, i)), lambda i: ls[i + 1]), chr(10)) END) AS text_sha256
FROM l0 LEFT JOIN x ON l0.doc_id = x.doc_id"""
