"""Phrase collocations by dynamic itemset counting.

The corpus is cut into slices (about SLICE bytes of one language), stored once
as word codes, and dealt over SHARDS shards that are scanned in turn, again and
again. All lengths are counted in the same scans: words from the first shard
on, and a longer phrase from the shard after that in which the later of its two
subphrases (without its last word, without its first) reached the threshold, for
one full cycle of shards. Scanning ends when no phrase is still in its cycle.

What a scan needs to know of earlier ones is when a subphrase reached the
threshold. A table of `cells` bytes, its size fixed by a parameter, holds it: a
phrase's hash names two cells, each with the latest step of the phrases that
fall there. It is the only thing sent to all tasks, and it can only err towards
counting more: whatever M shards in a row give is a count over distinct shards
of the corpus, so early or late extra counts never change a sum, and a phrase
with a rare subphrase is rare itself. Counts are summed by hash over the
cluster; of a phrase that reaches the threshold some shard holds a SHARDS-th of
it, so only phrases with such a shard are summed up at all. At the end one scan
fetches the words of the frequent phrases and counts each by its text, which
leaves no trace of hash collisions.

Defined results: null text is empty; null language is `und`; repeated rows
count again; a text of any length is one run of words, and slices hold at least
one text. Ties of score and count are ordered by the phrase's bytes. Empty
tables give no rows, other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.llm.worker import pieces_of
from larkspan.storage import scratch, written

SHARDS = 4
LONGEST = 5  # words of a phrase
THRESHOLD = 100
CELLS = 1 << 23  # bytes of the table of frequent subphrases
SLICE = 1 << 21
CUTS = 64  # parts in which a language's phrases are ranked first
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"  # fixed values: what ends a piece
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
SLICES = "lang STRING, n BIGINT, words ARRAY<STRING>, hashes BINARY, counts BINARY, codes BINARY, shard INT"


def slices(docs: DataFrame, text: str = "text", lang: str = "lang", shards: int = SHARDS) -> DataFrame:
    """SLICES rows: distinct words with hash and count, and the texts as codes of words, -1 between pieces; stored by shard."""
    und = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    table = bytes.maketrans(UPPER + b"\t" + BREAKS, LOWER + b" " + b"." * len(BREAKS))

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext

        names = ["lang", "n", "words", "hashes", "counts", "codes", "shard"]
        kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
        turn = TaskContext.get().partitionId()
        for batch in batches:
            for part in pieces_of(batch, SLICE):
                by_lang = {}
                for name, said in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    # a full stop can't be in a word, so it stands for every break
                    by_lang.setdefault(name, []).append((said or "").encode().translate(table).replace(b".", b" . "))
                for name, texts in by_lang.items():
                    coded = pa.array(b" . ".join(texts).split(), pa.binary()).dictionary_encode()
                    words, codes = coded.dictionary.to_pylist(), np.asarray(coded.indices, np.int32)
                    counts = np.bincount(codes, minlength=len(words)).astype(np.int64)
                    seed = zlib.crc32(name.encode())
                    hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
                    if b"." in words:
                        stop = words.index(b".")
                        counts[stop], codes = 0, np.where(codes == stop, np.int32(-1), codes)
                    if not counts.any():
                        continue
                    row = [[name], [int(counts.sum())], [[w.decode() for w in words]], [hashes.tobytes()], [counts.tobytes()], [codes.tobytes()], [turn % shards]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names=names)
                turn += 1

    path = scratch(docs.sparkSession, "slices")
    docs.select(und.alias("lang"), F.col(text).alias("text")).mapInArrow(run, SLICES).write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(SLICES).parquet(path)


def _longer(h, w):
    """Hash of a phrase and the word after it."""
    import numpy as np

    x = h * np.uint64(0x9E3779B97F4A7C15) + (w ^ (w >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _seen(cells, h):
    """Step + 1 at which a phrase reached the threshold as far as the cells tell; 0: not yet."""
    import numpy as np

    most = np.uint64(len(cells) - 1)
    return np.minimum(cells[(h & most).astype(np.int64)], cells[((h >> np.uint64(32)) & most).astype(np.int64)])


def _levels(hashes, codes, cells, longest: int):
    """For each length from 2: (places, hashes, seen of the first subphrase, of the second) where both are frequent."""
    import numpy as np

    words = np.frombuffer(hashes, np.uint64)
    at = np.frombuffer(codes, np.int32)
    if not len(words):
        return
    inside = at >= 0
    one = words[np.where(inside, at, 0)]
    seen = np.where(inside, _seen(cells, words)[np.where(inside, at, 0)], 0).astype(np.uint8)
    h = one
    for k in range(2, longest + 1):
        n = len(at) - k + 1
        if n <= 0:
            return
        places = np.flatnonzero((seen[:n] > 0) & (seen[1 : n + 1] > 0))
        mine = _longer(h[places], one[places + k - 1])
        yield k, places, mine, seen[places], seen[places + 1]
        if k == longest:
            return
        nxt, h_all = np.zeros(n, np.uint8), np.zeros(n, np.uint64)
        nxt[places], h_all[places] = _seen(cells, mine), mine
        seen, h = nxt, h_all


def scan(shard: DataFrame, cells, step: int, shards: int, longest: int) -> DataFrame:
    """(h, c): counts in these slices of all phrases that are in their cycle at this step."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            hs, ns, cs = (batch.column(c) for c in ("hashes", "counts", "codes"))
            for i in range(batch.num_rows):
                hashes, codes = hs[i].as_py(), cs[i].as_py()
                found = []
                if step < shards:
                    counts = np.frombuffer(ns[i].as_py(), np.int64)
                    found.append((np.frombuffer(hashes, np.uint64)[counts > 0], counts[counts > 0]))
                for _, _, h, a, b in _levels(hashes, codes, cells.value, longest):
                    found.append(np.unique(h[np.maximum(a, b).astype(np.int16) > step - shards], return_counts=True))
                for h, c in found:
                    if len(h):
                        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])

    rows = shard.select("hashes", "counts", "codes").mapInArrow(run, "h BIGINT, c BIGINT")
    return rows.groupBy("h").agg(F.sum("c").alias("c"))


def frequent(stored: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS, n_cells: int = CELLS):
    """((h, total) of all phrases that reach the threshold, the cells that know them)."""
    import numpy as np

    if n_cells & (n_cells - 1):
        raise ValueError("the number of cells must be a power of two")
    sc = stored.sparkSession.sparkContext
    cells, counted, reached, last, step = np.zeros(n_cells, np.uint8), {}, [], -1, 0
    enough = -(-threshold // shards)
    while step < shards or last >= step - shards:
        sent = sc.broadcast(cells)
        counted[step] = written(scan(stored.where(F.col("shard") == step % shards), sent, step, shards, longest), "counts")
        sent.destroy()
        counted.pop(step - shards, None)
        window = list(counted.values())
        every, likely = window[0], window[0].where(F.col("c") >= enough).select("h")
        for x in window[1:]:
            every, likely = every.unionByName(x), likely.unionByName(x.where(F.col("c") >= enough).select("h"))
        total = every.join(likely.distinct(), "h", "left_semi").groupBy("h").agg(F.sum("c").alias("total")).where(F.col("total") >= threshold)
        now = written(total, "frequent")
        new = now.select("h")
        for before in reached:
            new = new.join(before.select("h"), "h", "left_anti")
        low = F.col("h").bitwiseAND(F.lit(n_cells - 1))
        high = F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(n_cells - 1))
        places = new.select(F.explode(F.array(low, high)).alias("at")).distinct().toArrow().column("at").to_numpy()  # at most n_cells
        if len(places):
            cells[places] = step + 1
            last = step
        # the earlier ones in one table, so that a plan never joins more than two
        reached = [written(reached[0].unionByName(now).groupBy("h").agg(F.max("total").alias("total")), "reached") if reached else now]
        step += 1
        if step > 250:
            raise RuntimeError("more steps than a cell can hold")
    return reached[0], cells


def phrase_counts(stored: DataFrame, known: DataFrame, cells, threshold: int = THRESHOLD, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, k, f) of all words and phrases in `known`, counted by their texts."""
    sent = stored.sparkSession.sparkContext.broadcast(cells)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                lang, words, hashes, codes = (batch.column(c)[i].as_py() for c in ("lang", "words", "hashes", "codes"))
                at, h = np.frombuffer(codes, np.int32), np.frombuffer(hashes, np.uint64)
                counts = np.frombuffer(batch.column("counts")[i].as_py(), np.int64)
                own = np.flatnonzero((_seen(sent.value, h) > 0) & (counts > 0))
                found = [(1, h[own], counts[own], [words[j] for j in own])]
                for k, places, mine, _, _ in _levels(hashes, codes, sent.value, longest):
                    ok = _seen(sent.value, mine) > 0
                    mine, places = mine[ok], places[ok]
                    # phrases of one slice by the codes of their words, so that none share a row by hash alone
                    rows = at[places[:, None] + np.arange(k)] if len(places) else np.zeros((0, k), np.int32)
                    if len(rows):
                        _, first, n = np.unique(rows, axis=0, return_index=True, return_counts=True)
                        found.append((k, mine[first], n, [" ".join([words[j] for j in rows[f]]) for f in first]))
                for k, hs, n, said in found:
                    if len(hs):
                        cols = [pa.array([lang] * len(hs)), pa.array(said, pa.string()), pa.array(np.full(len(hs), k, np.int32)), pa.array(hs.view(np.int64)), pa.array(n.astype(np.int64))]
                        yield pa.RecordBatch.from_arrays(cols, names=["lang", "phrase", "k", "h", "c"])

    rows = stored.select("lang", "words", "hashes", "counts", "codes").mapInArrow(run, "lang STRING, phrase STRING, k INT, h BIGINT, c BIGINT")
    counts = rows.groupBy("lang", "phrase", "k", "h").agg(F.sum("c").alias("f")).where(F.col("f") >= threshold)
    out = written(counts.join(known.select("h"), "h", "left_semi").drop("h"), "phrases")
    sent.destroy()
    return out


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of each phrase of two words or more at its lowest-scoring cut."""
    phrases = counts.where("k > 1").select("lang", "phrase", F.col("f").alias("a"), "k", F.split("phrase", " ", -1).alias("w"))
    cuts = phrases.select("lang", "phrase", "a", "k", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("at"))
    cuts = cuts.select("lang", "phrase", "a", "at", F.array_join(F.slice("w", F.lit(1), F.col("at")), " ").alias("first"), F.array_join(F.slice("w", F.col("at") + 1, F.col("k")), " ").alias("rest"))
    part = lambda name, as_: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(as_))
    x = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "anlr"}  # products pass 64 bits
    x = x.withColumn("over", wide["a"] * wide["n"] * F.lit(1000).cast("decimal(4,0)")).withColumn("under", wide["l"] * wide["r"])
    x = x.withColumn("score", F.expr("over div under"))
    best = x.groupBy("lang", "phrase").agg(F.min(F.struct("score", "at", "a", "l", "r", "n")).alias("b"))
    return best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")


def outermost(found: DataFrame) -> DataFrame:
    """Without phrases that lie in a longer one as frequent as they are."""
    w = F.split("phrase", " ", -1)
    longer = found.select("lang", "a", w.alias("w")).where(F.size("w") > 2)
    parts = longer.select("lang", "a", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("k"))
    parts = parts.select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).alias("at"))
    inner = parts.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("k")), " ").alias("phrase"), F.col("a").alias("whole"))
    most = inner.groupBy("lang", "phrase").agg(F.max("whole").alias("whole"))
    return found.join(most, ["lang", "phrase"], "left").where("whole is null or 100 * whole < 100 * a").drop("whole")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, longest: int = LONGEST, top: int = 2000, shards: int = SHARDS, n_cells: int = CELLS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases by score."""
    stored = slices(docs, text, lang, shards)
    totals = stored.groupBy("lang").agg(F.sum("n").alias("n"))
    known, cells = frequent(stored, threshold, longest, shards, n_cells)
    counts = phrase_counts(stored, known, cells, threshold, longest)
    found = outermost(written(scored(counts, totals), "scored"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = Window.partitionBy("lang", "cut").orderBy(*order)
    few = found.withColumn("cut", F.pmod(F.xxhash64("phrase"), F.lit(CUTS))).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return few.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
