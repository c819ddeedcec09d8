"""LM scoring by online logistic context mixing, beside a word unigram base.

A text is its words, A-Z lower-cased, and an end mark. The HOT most frequent
words of the training rows are symbols of their own; any other word is an escape
and its bytes up to a blank. Symbols are written in two Huffman codes (words,
bytes), and every binary decision is predicted from three contexts, each hashed
with the place in the code tree to a slot of a table of zeros and ones counted
over all training rows. For a word: the last word, the last two words, the last
byte; for a byte: the last two and four bytes and the word so far. The
predictions, as log odds, are added up with weights that a gate (tree and depth)
selects, and the sum goes through a map from predicted to seen frequency; both
weights and map learn from every decision they have coded. The total is the
text's probability, and its bits per byte follow.

Learning inside a text starts anew every SEGMENT symbols from weights that all
training rows gave (`learned_start`), the contexts do not; so segments are coded side by side, one
decision of each gate in each at a time.

What a task holds: tables of fixed size, the symbols of one slice of texts and
HELD_DECISIONS of its decisions, as rare words have many times those of frequent
ones. Counts of slots travel as blocks of SLOTS numbers and are added up block by block; the tables
(2.6 million small numbers) are broadcast. Words: the HOT most frequent ones are
broadcast once, as symbols, with their logarithms, so no frequent word is a hot key; the others are
joined by the word itself.

Defined results: null, empty and blank texts are the end mark alone. Rows are
told apart by a number of their own, so repeated rows give repeated results. If
no row may be learned from, all counts are zero. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.llm.sampling import crc_is
from larkspan.llm.worker import pieces_of
from larkspan.storage import written

HOT = 1 << 16
HOT_CHARS = 64
ESCAPE, END = 256, 257  # symbols below are bytes, those above the frequent words
FIRST_WORD = 258
PAD = 4  # end marks before each text, as its first contexts
BITS = (19, 20, 20)  # table sizes of the contexts
OFFSETS = tuple(sum(1 << b for b in BITS[:i]) for i in range(len(BITS) + 1))
SLOTS = 1 << 14  # numbers in a travelling block
SEGMENT = 256
SLICE = 1 << 20
HELD_DECISIONS = 3 << 20  # decisions held by a task at once, some 20 bytes each
NEAR = 1 << 17  # decisions worked on at once
TOGETHER = 32
GATES = 6
START = 0.35
RATE = 0.02
CELLS = 24  # cells of the map of probabilities, log odds -6 to 6
MAP_RATE = 0.02
PRIOR = 1.0  # added to the zeros and ones of a slot
HELD_WORDS = 1 << 19  # distinct words counted in a task before they are passed on
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


# --- codes ------------------------------------------------------------------------------------------------------


def huffman(counts: list[int]) -> list[list[tuple[int, int]]]:
    """Per symbol its decisions (node, bit) from the root on; equal counts in order of the symbols."""
    n = len(counts)
    heap = [(c + 1, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    above: list[tuple[int, int] | None] = [None] * (2 * n - 1)
    for node in range(n, 2 * n - 1):
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        above[x], above[y] = (node, 0), (node, 1)
        heapq.heappush(heap, (a + b, node))
    paths = []
    for i in range(n):
        path, at = [], above[i]
        while at is not None:
            path.append((2 * n - 2 - at[0], at[1]))
            at = above[at[0]]
        paths.append(path[::-1])
    return paths


class Code:
    """Words, escape and end mark in one Huffman code, bytes in another."""

    def __init__(self, byte_counts: np.ndarray, escapes: int, ends: int, words: list[tuple[bytes, int]]):
        self.symbol = {w: FIRST_WORD + i for i, (w, _) in enumerate(words)}
        self.last_byte = np.array([10] * FIRST_WORD + [w[-1] for w, _ in words], np.uint64)
        self.last_byte[:256] = np.arange(256)
        small = [[(node, bit) for node, bit in p] for p in huffman([int(c) for c in byte_counts])]
        large = [[(256 + node, bit) for node, bit in p] for p in huffman([escapes, ends, *(n for _, n in words)])]
        paths = small + large
        self.length = np.array([len(p) for p in paths])
        self.first = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        node = np.array([node for p in paths for node, _ in p], np.uint64)
        self.mixed_node = (node * MIX >> np.uint64(32)).astype(np.uint32)
        bit = np.array([bit for p in paths for _, bit in p], np.int8)
        depth = np.concatenate([np.arange(n) for n in self.length])
        self.mark = bit + 2 * (np.minimum(depth, 2) + 3 * (node >= 256)).astype(np.int8)  # of a decision: its bit, and twice its gate


# --- decisions and their slots ----------------------------------------------------------------------------------


def symbols_of(code: Code, words: list[bytes]) -> np.ndarray:
    """The symbol of each word, an escape for those that have none."""
    return np.fromiter(map(code.symbol.get, words, repeat(ESCAPE)), np.int64, len(words))


def symbols(code: Code, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols with PAD end marks before each text, where each text starts, how many symbols it has)."""
    flat = [w for words in texts for w in words]
    return spelled_out(texts, flat, symbols_of(code, flat))


def spelled_out(texts: list[list[bytes]], flat: list[bytes], found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rare = np.flatnonzero(found == ESCAPE)
    width = np.ones(len(flat) + 1, np.int64)  # symbols of a word: itself, or the escape, its bytes and a blank
    width[rare] = [len(flat[i]) + 2 for i in rare.tolist()]
    width[-1] = 0
    n_words = np.array([len(words) for words in texts], np.int64)
    ends = np.cumsum(n_words)
    before = np.concatenate([[0], np.cumsum(width[:-1])])
    sizes = before[ends] - before[ends - n_words] + 1
    starts = np.cumsum(sizes + PAD) - sizes
    data = np.full(len(texts) * PAD + int(sizes.sum()), END, np.int64)
    place = before[:-1] + np.repeat(starts - before[ends - n_words], n_words)
    data[place] = found
    spelled = np.frombuffer(b"".join(flat[i] + b" " for i in rare.tolist()), np.uint8)
    data[positions(place[rare] + 1, width[rare] - 1)] = spelled
    return data, starts, sizes


def contexts(code: Code, data: np.ndarray) -> list[np.ndarray]:
    """Three hashes for every symbol, of what stands before it."""
    x = data.astype(np.uint64) + np.uint64(1)
    n, at = len(x), np.arange(len(x))
    is_byte = data < 256
    with np.errstate(over="ignore"):
        opened = np.maximum.accumulate(np.where(is_byte, 0, at))  # the escape of a byte's word
        deep = at - opened

        def past(k: int) -> np.ndarray:
            out = np.zeros(n, np.uint64)
            np.multiply(x[:-k], deep[k:] >= k, out=out[k:])
            out *= np.uint64(509 ** (k - 1))
            return out

        two = past(1) + past(2)
        four = two + past(3)
        four += past(4)
        # hash of the word so far: a difference of running sums, shifted back to the word's start
        base = 0xD1342543DE82EF95
        power = np.full(n, base, np.uint64)
        power[:1] = 1
        np.cumprod(power, out=power)
        power *= x
        upto = np.cumsum(power)
        word = upto - power
        word -= upto.take(opened)
        power[:] = pow(base, -1, 1 << 64)
        power[:1] = 1
        np.cumprod(power, out=power)
        word *= power.take(opened)
        out = [two, four, word]
        # for word symbols: the words before; the last byte before them
        w = np.flatnonzero(~is_byte)
        mark = x[w] * MIX
        one = np.concatenate([np.zeros(1, np.uint64), mark[:-1]])
        before = np.concatenate([np.zeros(2, np.uint64), mark[:-2]])[: len(mark)]
        byte_at = np.maximum(w - 1, 0)
        byte_at = np.where(data[byte_at] == 32, np.maximum(byte_at - 1, 0), byte_at)
        last = code.last_byte[data[byte_at]]
        for hashes, own in zip(out, (one, one ^ (before * np.uint64(0xBF58476D1CE4E5B9)), last + np.uint64(1))):
            hashes[w] = own ^ np.uint64(0x5851F42D4C957F2D)
        return [((c + np.uint64(i + 1)) * MIX >> np.uint64(32)).astype(np.uint32) for i, c in enumerate(out)]


class Decisions:
    """All decisions of the given positions of `data`, in order."""

    def __init__(self, code: Code, data: np.ndarray, at: np.ndarray):
        found = data.take(at)
        each = code.length.take(found)
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        self.at, self.each, self.first, self.is_word = at, each, ends - each, found >= 256
        self.symbol = np.repeat(np.arange(len(at)), each)  # of a decision: which of the positions
        place = (code.first.take(found) - self.first).take(self.symbol)
        place += np.arange(total)
        self.mixed_node, self.mark = code.mixed_node.take(place), code.mark.take(place)

    @property
    def bit(self) -> np.ndarray:
        return self.mark & 1

    @property
    def gate(self) -> np.ndarray:
        return self.mark >> 1

    def by_gate(self) -> list[np.ndarray]:
        """The decisions of each gate, in order."""
        out = []
        for chosen in (~self.is_word, self.is_word):
            each, first = self.each[chosen], self.first[chosen]
            deeper = np.maximum(each - 2, 0)
            out += [first[each > 0], first[each > 1] + 1, positions(first + 2, deeper)]
        return out

    def slots(self, hashes: np.ndarray, bits: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = hashes.take(self.at).take(self.symbol)
            h ^= self.mixed_node
            h *= np.uint32(0x85EBCA6B)
        h >>= np.uint32(32 - bits)
        return h.astype(np.intp)


def positions(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    out = np.repeat(starts - ends + sizes, sizes)
    out += np.arange(len(out))
    return out


def groups(decisions: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of neighbours that have about `most` together: from, to."""
    cuts = np.flatnonzero(np.diff(np.cumsum(decisions) // most)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(decisions)]))


def decisions_at(code: Code, data: np.ndarray, at: np.ndarray, most: int):
    """The decisions of the given positions in order, about `most` at a time."""
    for lo, hi in groups(code.length[data[at]], most):
        yield Decisions(code, data, at[lo:hi])


def decisions_of(code: Code, texts: list[list[bytes]], most: int):
    """All decisions of the texts, about `most` at a time, and the hashes of their contexts."""
    data, starts, sizes = symbols(code, texts)
    hashes = contexts(code, data)
    for d in decisions_at(code, data, positions(starts, sizes), most):
        yield d, hashes


# --- mixing -----------------------------------------------------------------------------------------------------


def flat_start() -> np.ndarray:
    return np.full((GATES, len(BITS)), START, np.float32)


def side_by_side(first: np.ndarray, length: np.ndarray):
    """The first place of every run, the second of every run and so on, longest runs first, in blocks of about NEAR
    places: (places, how many runs each turn has)."""
    by = np.argsort(-length, kind="stable")
    turns, first = int(length[by[0]]), first[by]
    active = len(by) - np.cumsum(np.bincount(length))[:turns]
    for lo, hi in groups(active, NEAR):
        some = active[lo:hi].tolist()
        places, at = np.empty(sum(some), np.intp), 0
        for turn, a in enumerate(some, lo):
            np.add(first[:a], turn, out=places[at : (at := at + a)])
        yield places, some


def inputs_of(d: Decisions, odds: list[np.ndarray], hashes: list[np.ndarray]) -> np.ndarray:
    """Per decision the log odds of its contexts in sixteenths and its mark, in the four bytes of a number."""
    packed = np.empty((len(d.mark), 4), np.int8)
    for i, (table, h, bits) in enumerate(zip(odds, hashes, BITS)):
        packed[:, i] = table.take(d.slots(h, bits))
    packed[:, 3] = d.mark
    return packed.view(np.uint32).ravel()


def unpacked(packed: np.ndarray, kind=np.float32) -> tuple[np.ndarray, np.ndarray]:
    """(log odds by context, bits)."""
    x = np.empty((len(BITS), len(packed)), kind)
    x[:] = packed.view(np.int8).reshape(-1, 4)[:, : len(BITS)].T
    x *= kind(1 / 16)
    return x, bits_of(packed)


def bits_of(packed: np.ndarray) -> np.ndarray:
    return (packed >> np.uint32(24) & np.uint32(1)).astype(np.float32)


def chances(z: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-z))."""
    p = np.negative(z)
    np.exp(p, out=p)
    p += 1
    return np.reciprocal(p, out=p)


def lanes_log10(code: Code, odds: list[np.ndarray], start: np.ndarray, data: np.ndarray, hashes: list[np.ndarray], first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of each lane's probability, the sum of the lanes' last weights): a lane is `size` symbols from `first` on.

    A gate's weights learn from its own decisions only, and a cell of the map from those that fall into it.
    So the decisions of every lane and gate are coded side by side first, those of every lane in the map then."""
    k, lanes = len(BITS), len(first)
    at = positions(first, size)
    ends = np.cumsum(np.add.reduceat(code.length[data[at]], np.cumsum(size) - size))
    begin, n = np.concatenate([[0], ends[:-1]]), int(ends[-1])
    packed, done, by_gate = np.empty(n, np.uint32), 0, [[] for _ in range(GATES)]
    for d in decisions_at(code, data, at, NEAR):
        for found, own in zip(by_gate, d.by_gate()):
            found.append(own + done)
        packed[done : (done := done + len(d.mark))] = inputs_of(d, odds, hashes)
    # the weights: runs are the decisions of a gate in a lane
    by_gate = [np.concatenate(x) for x in by_gate]
    run_first = np.concatenate([np.searchsorted(x, begin) for x in by_gate])
    length = np.concatenate([np.searchsorted(x, ends) for x in by_gate]) - run_first
    run_first += np.repeat(np.cumsum([0, *map(len, by_gate[:-1])]), lanes)
    by_gate = np.concatenate(by_gate)
    by = np.argsort(-length, kind="stable")
    weights = np.repeat(start.T, lanes, axis=1)[:, by]  # (inputs, runs)
    chance, spare = np.empty(n, np.float32), np.empty((k, len(by)), np.float32)
    rate, one = np.float32(RATE), np.float32(1)
    for places, active in side_by_side(run_first, length):
        places = by_gate.take(places)
        x, bit = unpacked(packed.take(places))
        np.negative(x, out=x)  # so that a sum is what exp() takes
        coded, at = np.empty(len(places), np.float32), 0
        for a in active:
            s = slice(at, at := at + a)
            own, w, t = x[:, s], weights[:, :a], spare[:, :a]
            np.multiply(w, own, out=t)
            t, *rest = t
            for y in rest:
                t += y
            coded[s] = t
            np.exp(t, out=t)
            t += one
            np.reciprocal(t, out=t)
            np.subtract(bit[s], t, out=t)
            t *= rate
            own *= t
            w -= own
        chance[places] = coded
    used = np.empty_like(weights)
    used[:, by] = weights
    used = used.reshape(k, GATES, lanes).sum(axis=2, dtype=np.float64).T
    # the map: runs are lanes
    cell_odds = (np.arange(CELLS, dtype=np.float32) + 0.5) / 2 - CELLS / 4
    seen = np.repeat((1 / (1 + np.exp(-cell_odds)))[:, None], lanes, axis=1).astype(np.float32).ravel()
    spare, rate, lane = np.empty(lanes, np.float32), np.float32(MAP_RATE), np.arange(lanes)
    for places, active in side_by_side(begin, ends - begin):
        dot, bit = -chance.take(places), bits_of(packed.take(places))
        p = chances(dot)
        dot *= 2
        dot += CELLS / 2
        np.maximum(dot, 0, out=dot)
        np.minimum(dot, CELLS - 1, out=dot)
        cell = dot.astype(np.intp)
        cell *= lanes
        mapped, at = dot, 0
        for a in active:
            s = slice(at, at := at + a)
            c, t = cell[s], spare[:a]
            c += lane[:a]
            q = seen.take(c, out=mapped[s], mode="clip")
            np.subtract(bit[s], q, out=t)
            t *= rate
            t += q
            seen[c] = t
        p *= 2
        p += mapped
        p *= np.float32(1 / 3)
        p += bit
        p -= 1
        np.abs(p, out=p)
        chance[places] = np.maximum(p, np.float32(1e-7))
    # logarithms of products: TOGETHER chances of 1e-7 are still a number
    products = -(-(ends - begin) // TOGETHER)
    lane = np.repeat(np.arange(lanes), products)
    cuts = begin[lane] + TOGETHER * (np.arange(len(lane)) - (np.cumsum(products) - products)[lane])
    return np.bincount(lane, np.log10(np.multiply.reduceat(chance, cuts, dtype=np.float64)), minlength=lanes), used


def text_log10(code: Code, odds: list[np.ndarray], start: np.ndarray, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of the model's probability of each text, the mean of the weights after the segments)."""
    return symbols_log10(code, odds, start, *symbols(code, texts))


def symbols_log10(code: Code, odds: list[np.ndarray], start: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sizes):
        return np.zeros(0), start
    hashes = contexts(code, data)
    # lanes: segments of texts, longest first
    segments = -(-sizes // SEGMENT)
    text = np.repeat(np.arange(len(sizes)), segments)
    first = starts[text] + SEGMENT * (np.arange(len(text)) - (np.cumsum(segments) - segments)[text])
    size = np.minimum(SEGMENT, (starts + sizes)[text] - first)
    upto = np.concatenate([[0], np.cumsum(code.length[data])])
    by = np.argsort(upto[first] - upto[first + size], kind="stable")
    text, first, size = text[by], first[by], size[by]
    logs, used = np.empty(len(text)), 0.0
    for lo, hi in groups(upto[first + size] - upto[first], HELD_DECISIONS):
        logs[lo:hi], weights = lanes_log10(code, odds, start, data, hashes, first[lo:hi], size[lo:hi])
        used = used + weights
    return np.bincount(text, logs, minlength=len(sizes)), (used / len(text)).astype(np.float32)


# --- Spark jobs -------------------------------------------------------------------------------------------------


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """(word, n, docs): `docs` counts the texts under the empty word."""

    def run(batches):
        def out(c):
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

        counts: Counter = Counter()
        for batch in batches:
            for part in pieces_of(batch):
                for t in part.column(text).to_pylist():
                    counts.update(words_of(t))
                    counts[b""] += 1
                    if len(counts) >= HELD_WORDS:
                        yield out(counts)
                        counts = Counter()
        yield out(counts)

    return texts.select(text).mapInArrow(run, "word BINARY, n BIGINT").groupBy("word").agg(F.sum("n").alias("n"))


def byte_counts(counts: DataFrame, hot: DataFrame) -> np.ndarray:
    """How often each byte is spelled out: 256 numbers a task, from the words that are no symbols."""
    rare = counts.where(F.length("word") > 0).join(F.broadcast(hot.select("word")), "word", "left_anti")

    def run(batches):
        found = np.zeros(256, np.int64)
        for batch in batches:
            for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                for c in w:
                    found[c] += n
                found[32] += n
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(found)], names=["byte", "n"])

    out = np.zeros(256, np.int64)
    for r in rare.select("word", "n").mapInArrow(run, "byte INT, n BIGINT").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        out[r.byte] = r.n
    return out


def slot_counts(texts: DataFrame, text: str, code: Code) -> np.ndarray:
    """Zeros and ones by slot over all texts: two numbers for each slot of each table."""
    shared = texts.sparkSession.sparkContext.broadcast(code)
    size = 2 * OFFSETS[-1]

    def count(batches):
        counts = np.zeros(size, np.uint32)
        for batch in batches:
            for part in pieces_of(batch, SLICE):
                for d, hashes in decisions_of(shared.value, [words_of(t) for t in part.column(text).to_pylist()], NEAR):
                    for h, bits, offset in zip(hashes, BITS, OFFSETS):
                        slot = d.slots(h, bits)
                        slot += offset
                        slot *= 2
                        slot += d.bit
                        np.add.at(counts, slot, np.uint32(1))
        blocks = counts.reshape(-1, SLOTS)
        some = np.flatnonzero(blocks.any(axis=1))
        for i in range(0, len(some), 16):
            b = some[i : i + 16]
            yield pa.RecordBatch.from_arrays([pa.array(b.astype(np.int32)), pa.array([blocks[j].tobytes() for j in b], pa.binary())], names=["block", "counts"])

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                x = np.frombuffer(counts, np.uint32)
                held[block] = held[block] + x if block in held else x.astype(np.uint64)
        for block, x in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["block", "counts"])

    kind = "block INT, counts BINARY"
    total = np.zeros(size, np.uint64)
    # as many rows as a table has blocks, however many texts: at most size / SLOTS
    for r in texts.select(text).mapInArrow(count, kind).repartition("block").mapInArrow(add, kind).toLocalIterator():
        total[r.block * SLOTS : (r.block + 1) * SLOTS] = np.frombuffer(bytes(r.counts), np.uint64)
    shared.destroy()
    return total


def odds_of(total: np.ndarray) -> list[np.ndarray]:
    """Per context the log odds of its slots in sixteenths, 0 where nothing was seen."""
    zeros, ones = total[0::2].astype(np.float64), total[1::2].astype(np.float64)
    odds = np.clip(np.rint(16 * np.log((ones + PRIOR) / (zeros + PRIOR))), -127, 127).astype(np.int8)
    return [odds[a:b] for a, b in zip(OFFSETS, OFFSETS[1:])]


def learned_start(train: DataFrame, text: str, code: Code, odds: list[np.ndarray]) -> np.ndarray:
    """Start weights from every decision of all training rows: by gate, one Newton step of a logistic regression from START, kept within 0 and 1.

    A task sends GATES times k + k * k sums, so the weights are those of all rows however they are split."""
    shared = train.sparkSession.sparkContext.broadcast((code, odds))
    k = len(BITS)

    def run(batches):
        code, odds = shared.value
        sums = np.zeros((GATES, k + k * k))
        for batch in batches:
            for part in pieces_of(batch, SLICE):
                for d, hashes in decisions_of(code, [words_of(t) for t in part.column(text).to_pylist()], NEAR):
                    packed = inputs_of(d, odds, hashes)
                    for total, at in zip(sums, d.by_gate()):
                        x, bit = unpacked(packed.take(at))
                        p = chances(np.float32(START) * sum(x))
                        y = x.astype(np.float64)
                        total[:k] += y @ (bit - p).astype(np.float64)
                        total[k:] += (y * (p * (1 - p)).astype(np.float64) @ y.T).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size), pa.int32()), pa.array(sums.ravel())], names=["at", "v"])

    sums = np.zeros(GATES * (k + k * k))
    for r in train.select(text).mapInArrow(run, "at INT, v DOUBLE").groupBy("at").agg(F.sum("v").alias("v")).collect():  # GATES * (k + k * k) rows
        sums[r.at] = r.v
    shared.destroy()
    sums = sums.reshape(GATES, -1)
    steps = [np.linalg.solve(row[k:].reshape(k, k) + np.eye(k), row[:k]) for row in sums]
    return np.clip(flat_start() + np.array(steps), 0, 1).astype(np.float32)


def listed(counts: list[Counter]) -> pa.Array:
    """A list of (w, c) for each."""
    ends = np.cumsum([0, *map(len, counts)]).astype(np.int32)
    pairs = [pa.array([w for c in counts for w in c], pa.binary()), pa.array([n for c in counts for n in c.values()], pa.int64())]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(pairs, ["w", "c"]))


def score(docs: DataFrame, folds: int = 7, held: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)."""
    spark = docs.sparkSession
    is_held = crc_is(key, folds, held)
    train = docs.where(~is_held)
    counts = written(word_counts(train, text), "words")
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.max(F.when(F.length("word") == 0, F.col("n"))).alias("ends")).first()
    n_train, v_train, ends = sums.n or 0, sums.v, sums.ends or 0
    top = counts.where(F.length("word").between(1, HOT_CHARS)).orderBy(F.desc("n"), "word").limit(HOT)
    top = written(top, "frequent")
    words = sorted(((bytes(r.word), r.n) for r in top.toLocalIterator()), key=lambda x: (-x[1], x[0]))
    spelled = byte_counts(counts, top)
    code = Code(spelled, int(spelled[32]), ends, words)
    odds = odds_of(slot_counts(train, text, code))
    start = learned_start(train, text, code, odds)
    model = spark.sparkContext.broadcast((code, odds, start, np.array([0.0] * FIRST_WORD + [math.log10(n + 1) for _, n in words])))
    slim = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(key).alias("__key"), is_held.alias("held_out"), text)

    def run(batches):
        code, odds, start, hot_logs = model.value
        for batch in batches:
            for part in pieces_of(batch, SLICE):
                texts = [words_of(t) for t in part.column(text).to_pylist()]
                flat = [w for words in texts for w in words]
                own = symbols_of(code, flat)
                rare, ends = np.flatnonzero(own == ESCAPE), np.cumsum([0, *map(len, texts)])
                of = np.repeat(np.arange(len(texts)), np.diff(ends))
                logs = np.bincount(of, hot_logs[own], minlength=len(texts))
                cuts, other = np.searchsorted(rare, ends).tolist(), [flat[i] for i in rare.tolist()]
                found = np.diff(ends) - np.diff(cuts)
                rest = [Counter(other[a:b]) for a, b in zip(cuts, cuts[1:])]
                scores, _ = symbols_log10(code, odds, start, *spelled_out(texts, flat, own))
                sizes = [sum(map(len, w)) + len(w) + (not w) for w in texts]
                cols = [pa.array([len(w) + 1 for w in texts], pa.int64()), pa.array(found, pa.int64()), pa.array(logs, pa.float64()), pa.array(scores)]
                cols += [pa.array(-scores / math.log10(2) / np.array(sizes)), listed(rest)]
                names = ["__row", "__key", "held_out"]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + cols, names=names + ["n_tokens", "hot_known", "hot_log", "score", "bits_per_byte", "rest"])

    kind = slim.schema["__key"].dataType.simpleString()
    parts = slim.mapInArrow(run, f"__row BIGINT, __key {kind}, held_out BOOLEAN, n_tokens BIGINT, hot_known BIGINT, hot_log DOUBLE, score DOUBLE, bits_per_byte DOUBLE, rest ARRAY<STRUCT<w: BINARY, c: BIGINT>>")
    parts = written(parts, "scored")
    model.destroy()
    rare = parts.select("__row", F.explode("rest").alias("r")).select("__row", F.col("r.w").alias("word"), F.col("r.c").alias("c")).join(counts, "word")
    rare = rare.groupBy("__row").agg(F.sum("c").alias("rare_known"), F.sum(F.col("c") * F.log10(F.col("n") + 1)).alias("rare_log"))
    x = parts.drop("rest").join(rare, "__row", "left")
    zero = F.lit(0)
    base = F.col("hot_log") + F.coalesce("rare_log", F.lit(0.0)) + math.log10(ends + 1) - F.col("n_tokens") * math.log10(n_train + v_train + 1)
    known = F.col("hot_known") + F.coalesce("rare_known", zero) + (1 if ends else 0)
    return x.select(F.col("__key").alias(key), "held_out", "n_tokens", known.alias("n_known"), F.lit(n_train).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score", "bits_per_byte")
