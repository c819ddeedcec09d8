"""Toxicity by a bidirectional gated recurrent network with attention, in numpy.

A word enters as the images of two learned vectors: one of the word itself
(hashed), one added up over its hashed runs of 3 and 6 characters (bytes, the
word's ends marked). A word of over LONGEST bytes (text without spaces, a URL)
enters as several inputs: its pieces of PIECE bytes, which begin every HOP bytes
and hold all its runs. Words and runs that few training texts hold share place 0. Two gated recurrent
layers read a window of WINDOW inputs from either end; attention pools their
states, and a logistic unit rates the window. Windows begin every STRIDE inputs
and cover the whole text; a text is as toxic as its worst window.

Labels say that a text is toxic, not where. So training picks, in each round,
the windows the network rates worst in each text (random ones at first) and
learns the text's label on them. A last logistic step on the texts' worst
windows, weighted to the labels' own share, makes the rating a probability.

Fitted on a bounded sample: per label value the `per_label` labelled rows with
the smallest hash of doc_id, in one task; only the weights reach the driver.
Scoring covers every window of every text, row-local.

Defined results: a text without words (null, empty, blank) has score 0. With a
single label value to learn from every text with words has that value's share
(0 or 1), with none 0. Rows of labels that repeat a doc_id count by the larger
value. Repeated rows give repeated results. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import pickle
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.llm.sampling import crc_is, smallest
from larkspan.llm.worker import pieces_of, stash

WINDOW, STRIDE = 16, 8
WORDS, GRAMS, DIM, HIDDEN = 1 << 13, 1 << 14, 8, 8
RUNS = (3, 6)
PER_LABEL = 1000
ROUNDS = 8
BATCH = 256
RATE = 0.01
DECAY = 0.02
LEAST_TEXTS = 5  # training texts that must hold a word for a vector of its own
SEED = 8
THRESHOLD = 0.3
EDGE = b".,;:!?%$&*#|\"'()[]{}<>-_=+/\\@^~`"
LONGEST = 64  # bytes of a word that is one input
PIECE, HOP = 16, 8  # bytes of a piece of a longer word, and from one piece to the next
HELD = 1 << 17  # distinct words a worker remembers
CHUNK = 4096  # windows rated at a time
SLICE = 1 << 14  # words hashed at a time


def inputs_in(text: str | None) -> tuple[list[bytes], np.ndarray | None]:
    """(inputs, the word that each is of): the words, long ones as overlapping pieces that begin
    with a space, which no word has. None if every input is a word."""
    words = (text or "").encode().lower().split()
    if max(map(len, words), default=0) <= LONGEST:
        return words, None
    found, of = [], []
    for i, w in enumerate(words):
        if len(w) <= LONGEST:
            parts = [w]
        else:
            framed = b"<" + (w.strip(EDGE) or w) + b">"
            parts = [b" " + framed[k : k + PIECE] for k in range(0, max(1, len(framed) - PIECE + HOP), HOP)]
        found += parts
        of += [i] * len(parts)
    return found, np.array(of)


def hashed_inputs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each word, places of its character runs end to end, how many runs)."""
    framed = [w[1:] if w[0] == 32 else b"<" + (w.strip(EDGE) or w) + b">" for w in words]
    place = np.fromiter((1 + crc32(f) % (WORDS - 1) for f in framed), np.int64, len(framed))
    data = np.frombuffer(b"".join(framed), np.uint8).astype(np.uint64)
    lengths = np.array([len(f) for f in framed])
    of, end = np.repeat(np.arange(len(framed)), lengths), np.repeat(np.cumsum(lengths), lengths)
    owners, runs = [], []
    with np.errstate(over="ignore"):
        for n in RUNS:
            at = np.flatnonzero(np.arange(len(data)) + n <= end)
            h = np.full(len(at), n, np.uint64)
            for j in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + data[at + j]
            owners.append(of[at])
            runs.append(((h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % (GRAMS - 1) + 1)
    owners, runs = np.concatenate(owners), np.concatenate(runs)
    return place, runs[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(framed))


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, first input) of the windows of texts with so many inputs each."""
    n = np.where(sizes > 0, np.maximum(0, -(-(sizes - WINDOW) // STRIDE)) + 1, 0)
    text = np.repeat(np.arange(len(sizes)), n)
    return text, (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def new_weights(rng) -> dict[str, np.ndarray]:
    def normal(*shape, scale=None):
        return (rng.standard_normal(shape) * (scale or 1 / np.sqrt(shape[0]))).astype(np.float32)

    out = {"word": normal(WORDS, DIM, scale=0.3), "gram": normal(GRAMS, DIM, scale=0.3), "att": normal(2 * HIDDEN), "out": normal(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
    for d in "fb":
        out |= {f"x{d}": normal(2 * DIM, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32), f"g{d}": normal(HIDDEN, 2 * HIDDEN), f"n{d}": normal(HIDDEN, HIDDEN)}
    return out


def run_gates(p, d, gates, mask, keep=False):
    """States after each step of one direction; `gates` is (steps, windows, 3 HIDDEN) of inputs."""
    steps, n, _ = gates.shape
    h = np.zeros((n, HIDDEN), np.float32)
    states, kept = np.empty((steps, n, HIDDEN), np.float32), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        zr = sigmoid(gates[t, :, : 2 * HIDDEN] + h @ p["g" + d])
        z, r = zr[:, :HIDDEN] * mask[t][:, None], zr[:, HIDDEN:]
        c = np.tanh(gates[t, :, 2 * HIDDEN :] + (r * h) @ p["n" + d])
        if keep:
            kept.append((t, h, zr, c))
        h = h + z * (c - h)
        states[t] = h
    return states, kept


def rate(p, gates_f, gates_b, mask):
    """Ratings of windows, and what the gradients need."""
    sf, kf = run_gates(p, "f", gates_f, mask, True)
    sb, kb = run_gates(p, "b", gates_b, mask, True)
    s = np.concatenate([sf, sb], axis=2)
    e = np.where(mask > 0, s @ p["att"], -1e9)
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", a, s)
    return pooled @ p["out"] + p["bias"][0], (s, a, pooled, kf, kb)


def gradients(p, x, mask, want):
    """Loss gradients for inputs x (steps, windows, 2 DIM)."""
    g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "gram", "common")}
    gates = {d: x @ p["x" + d] + p["b" + d] for d in "fb"}
    logit, (s, a, pooled, kf, kb) = rate(p, gates["f"], gates["b"], mask)
    d_logit = (sigmoid(logit) - want) / len(want)
    g["out"], g["bias"][0] = pooled.T @ d_logit, d_logit.sum()
    d_pool = d_logit[:, None] * p["out"]
    along = np.einsum("tnh,nh->tn", s, d_pool)
    d_e = a * (along - (a * along).sum(axis=0))
    g["att"] = np.einsum("tn,tnh->h", d_e, s)
    d_s = a[:, :, None] * d_pool[None] + d_e[:, :, None] * p["att"]
    d_x = np.zeros_like(x)
    for d, kept, part in (("f", kf, d_s[:, :, :HIDDEN]), ("b", kb, d_s[:, :, HIDDEN:])):
        d_h = np.zeros_like(part[0])
        for t, h, zr, c in reversed(kept):
            d_h = d_h + part[t]
            z, r, m = zr[:, :HIDDEN], zr[:, HIDDEN:], mask[t][:, None]
            d_c = d_h * z * m * (1 - c * c)
            d_rh = d_c @ p["n" + d].T
            d_zr = np.concatenate([d_h * (c - h) * m * z * (1 - z), d_rh * h * r * (1 - r)], axis=1)
            g["n" + d] += (r * h).T @ d_c
            g["g" + d] += h.T @ d_zr
            d_gate = np.concatenate([d_zr, d_c], axis=1)
            g["x" + d] += x[t].T @ d_gate
            g["b" + d] += d_gate.sum(axis=0)
            d_x[t] += d_gate @ p["x" + d].T
            d_h = d_h * (1 - z * m) + d_rh * r + d_zr @ p["g" + d].T
    return g, d_x


def common_places(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Which places of words and of runs at least LEAST_TEXTS texts hold."""
    words, runs = np.zeros(WORDS, np.int64), np.zeros(GRAMS, np.int64)
    for t in texts:
        place, of, _ = hashed_inputs(list(set(t)))
        words[np.unique(place)] += 1
        runs[np.unique(of)] += 1
    return words >= LEAST_TEXTS, runs >= LEAST_TEXTS


def inputs_of(words: list[bytes], common) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`hashed_inputs` with rare words and runs at place 0."""
    place, runs, sizes = hashed_inputs(words)
    return np.where(common[0][place], place, 0), np.where(common[1][runs], runs, 0), sizes


class Lexicon:
    """Rows of the words seen: gate inputs of both directions, made when first met."""

    def __init__(self, p):
        self.p, self.row = p, {}
        self.image = {k: np.concatenate([p[k] @ p["xf"][at : at + DIM], p[k] @ p["xb"][at : at + DIM]], axis=1) for k, at in (("word", 0), ("gram", DIM))}
        self.bias = np.concatenate([p["bf"], p["bb"]])
        self.rows = np.empty((HELD, 6 * HIDDEN), np.float32)

    def of(self, words: list[bytes]) -> np.ndarray:
        """Row numbers; forgets everything before if the words wouldn't fit."""
        new = list(set(words) - self.row.keys())
        if len(self.row) + len(new) > HELD:
            self.row, new = {}, list(set(words))
            if len(new) > len(self.rows):
                self.rows = np.empty((len(new), 6 * HIDDEN), np.float32)
        if new:
            at = len(self.row)
            for i in range(0, len(new), SLICE):
                place, runs, sizes = inputs_of(new[i : i + SLICE], self.p["common"])
                sums = np.add.reduceat(self.image["gram"][runs], np.cumsum(sizes) - sizes, axis=0)
                self.rows[at + i : at + i + len(place)] = self.image["word"][place] + sums / np.sqrt(sizes)[:, None] + self.bias
            self.row.update(zip(new, range(at, at + len(new))))
        return np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))

    def rate(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first input, rating) of all windows."""
        sizes = np.array([len(t) for t in texts], np.int64)
        text, first = windows(sizes)
        if not len(text):
            return text, first, np.empty(0, np.float32)
        rows = self.of([w for t in texts for w in t])
        begin = (np.cumsum(sizes) - sizes)[text] + first
        left = np.minimum(sizes[text] - first, WINDOW)
        rating = np.empty(len(text), np.float32)
        steps = np.arange(WINDOW)[:, None]
        for i in range(0, len(text), CHUNK):
            n = left[None, i : i + CHUNK]
            gates = self.rows[rows[begin[None, i : i + CHUNK] + np.minimum(steps, n - 1)]]
            mask = (steps < n).astype(np.float32)
            sf, _ = run_gates(self.p, "f", gates[:, :, : 3 * HIDDEN], mask)
            sb, _ = run_gates(self.p, "b", gates[:, :, 3 * HIDDEN :], mask)
            e = np.where(mask > 0, sf @ self.p["att"][:HIDDEN] + sb @ self.p["att"][HIDDEN:], -1e9)
            a = np.exp(e - e.max(axis=0))
            v = sf @ self.p["out"][:HIDDEN] + sb @ self.p["out"][HIDDEN:]
            rating[i : i + CHUNK] = (a * v).sum(axis=0) / a.sum(axis=0) + self.p["bias"][0]
        return text, first, rating


def train(texts: list[list[bytes]], labels: np.ndarray, share: float, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Weights from labelled texts with words; `share` is the share of label 1 among all labelled rows."""
    rng = np.random.default_rng(SEED)
    p = new_weights(rng)
    if len(set(labels.tolist())) < 2:
        return p | {"always": np.array(share)}
    common = common_places(texts)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    p["common"] = common
    sizes = np.array([len(t) for t in texts])
    step = 0
    for r in range(rounds):
        text, first = windows(sizes)
        order = rng.permutation(len(text))
        if r >= 2:
            rating = Lexicon(p).rate(texts)[2]
            order = order[np.argsort(-rating[order], kind="stable")]
        order = order[np.argsort(text[order], kind="stable")]
        nth = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        picked = rng.permutation(order[nth < (6 if r < 2 else 2)])
        for i in range(0, len(picked), BATCH):
            chosen = picked[i : i + BATCH]
            words = [texts[text[j]][first[j] : first[j] + WINDOW] for j in chosen]
            n = np.array([len(w) for w in words])
            mask = (np.arange(WINDOW)[:, None] < n[None, :]).astype(np.float32)
            met = list({w for ws in words for w in ws})
            place = {w: k for k, w in enumerate(met)}
            ids = np.array([[place[ws[min(t, len(ws) - 1)]] for ws in words] for t in range(WINDOW)])
            wid, gids, gn = inputs_of(met, common)
            scale = np.sqrt(gn)[:, None]
            vec = np.concatenate([p["word"][wid], np.add.reduceat(p["gram"][gids], np.cumsum(gn) - gn, axis=0) / scale], axis=1).astype(np.float32)
            g, d_x = gradients(p, vec[ids], mask, labels[text[chosen]].astype(np.float32))
            d_vec = np.zeros_like(vec)
            np.add.at(d_vec, ids.ravel(), (d_x * mask[:, :, None]).reshape(-1, 2 * DIM))
            g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
            np.add.at(g["word"], wid, d_vec[:, :DIM])
            np.add.at(g["gram"], gids, np.repeat(d_vec[:, DIM:] / scale, gn, axis=0))
            step += 1
            for k, v in g.items():
                m, s = moments[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                p[k] -= (RATE * m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6) + RATE * DECAY * p[k]).astype(np.float32)
    text, _, rating = Lexicon(p).rate(texts)
    worst = np.full(len(texts), -np.inf)
    np.maximum.at(worst, text, rating)
    weight = np.where(labels == 1, share / max(labels.mean(), 1e-9), (1 - share) / max(1 - labels.mean(), 1e-9))
    # a logistic step on the worst window: slope and level by damped Newton steps
    ab = np.array([1.0, 0.0])
    x = np.stack([worst, np.ones(len(worst))], axis=1)
    for _ in range(50):
        q = sigmoid(x @ ab)
        grad = x.T @ (weight * (q - labels)) + 1e-2 * (ab - [1.0, 0.0])
        ab = ab - np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(2), grad)
    return p | {"level": ab}


def learn(docs: DataFrame, labels: DataFrame, folds: int, held: int, per_label: int = PER_LABEL):
    """The weights, or None if there is nothing to learn from."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~crc_is("doc_id", folds, held)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = known.join(docs.where(F.length("text") > 0).select("doc_id"), "doc_id", "left_semi")
    chosen = smallest(rows, "toxic", "doc_id", per_label).select(F.col("doc_id").alias("__id"), "toxic", "__r")
    share = known.agg(F.avg("toxic").alias("s")).first().s
    if share is None:
        return None
    # at most per_label rows for each of two values
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "toxic", "text")

    def run(batches):
        rows = []
        for batch in batches:
            for d, y, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "toxic", "text"))):
                if words := inputs_in(t)[0]:
                    rows.append((d, y, words))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        if rows:
            p = train([r[2] for r in rows], np.array([r[1] for r in rows]), share)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(p)], pa.binary())], names=["weights"])

    found = sample.repartition(1).mapInArrow(run, "weights BINARY").collect()
    return pickle.loads(bytes(found[0].weights)) if found else None


def score_texts(docs: DataFrame, weights, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, worst_at): `worst_at` is the first word of the worst window, null without words."""
    slim = docs.select(key, text)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = slim.schema[key].dataType.simpleString()

    def run(batches):
        held, p = stash("toxicity"), shared.value
        if p is not None and (held.get("of") is not p):
            held.update(of=p, lexicon=Lexicon(p))
        for batch in batches:
            for part in pieces_of(batch, 1 << 20):
                texts, words = zip(*map(inputs_in, part.column(text).to_pylist()))
                score, at = np.zeros(len(texts)), np.full(len(texts), -1)
                if p is not None and "always" in p:
                    score[[bool(t) for t in texts]] = p["always"]
                elif p is not None:
                    no, first, rating = held["lexicon"].rate(texts)
                    order = np.lexsort((-first, rating, no))
                    last = np.flatnonzero(np.append(no[order][1:] != no[order][:-1], True)) if len(no) else []
                    best = order[last]
                    a, b = p["level"]
                    score[no[best]] = sigmoid(a * rating[best].astype(np.float64) + b)
                    at[no[best]] = [f if words[i] is None else words[i][f] for i, f in zip(no[best], first[best])]
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(score), pa.array(at, pa.int64(), mask=at < 0)], names=[key, "score", "worst_at"])

    return slim.mapInArrow(run, f"`{key}` {kind}, score DOUBLE, worst_at BIGINT")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted, worst_at), learned from rows whose crc32(doc_id) mod `folds` isn't `held`."""
    scored = score_texts(docs, learn(docs, labels, folds, held))
    return scored.select("doc_id", crc_is("doc_id", folds, held).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "worst_at")
