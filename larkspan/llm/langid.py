"""Language ID by a blended-spectrum string kernel.

A text is the set of its character n-grams, n from 1 to SPECTRUM, lower-cased,
with whatever is no letter as one blank; grams are hashed to BUCKETS places. The
kernel of two texts is the share of common grams, |A and B| / sqrt(|A| |B|).
Landmark texts give a Nyström map, on which one ridge regression per language
(against the rest) is fitted. Both are linear in the grams a text has, so
landmarks x coefficients is multiplied out once, and texts are scored as
(texts x grams) @ (grams x languages), a batch at a time.

Fitted on a bounded sample: for each language the `per_language` rows with the
smallest hash of the key, `landmarks` of which are landmarks. Scoring covers
every whole text. What is broadcast is BUCKETS x languages numbers.

Defined results: a text that is null, or has no letter, is `und` with score 0;
so is every text if there is nothing to learn from. The score is the winner's
regression value taken from -1..1 to 0..1; equal values go to the language
first in code-point order. Repeated rows give repeated results. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.llm.sampling import crc_is, smallest
from larkspan.llm.worker import pieces_of, stash

SPECTRUM = 4
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
PER_LANGUAGE = 256
LANDMARKS = 32
RIDGE = 1e-3
SMALL_ROWS = 1 << 16  # sample keys are broadcast up to here, joined plainly beyond
UNKNOWN = "und"
FLOOR = 0.45  # least share of a text's grams that some landmark must have for a language to claim it


def letters() -> np.ndarray:
    held = stash("letters")
    if "table" not in held:
        held["table"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return held["table"]


class Grams:
    """Sets of hashed n-grams, with one table of marks used again and again."""

    def __init__(self):
        self.seen = np.zeros(BUCKETS, bool)

    def __call__(self, text: str | None) -> np.ndarray:
        """The places of a text's grams in order, or none without a letter."""
        chars = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letters()[chars]
        if not is_letter.any():
            return np.empty(0, np.int64)
        blank = np.concatenate([[True], ~is_letter, [True]])
        chars = np.concatenate([[32], chars, [32]])
        chars[blank] = 32
        chars = chars[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.uint64)
        with np.errstate(over="ignore"):
            h = np.zeros(len(chars) + 1, np.uint64)
            for n in range(1, SPECTRUM + 1):
                if len(chars) < n:
                    break
                h = (h[: len(chars) - n + 1] + chars[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                self.seen[h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BUCKET_BITS)] = True
        places = np.flatnonzero(self.seen)
        self.seen[places] = False
        return places


def kernel(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """All kernel values of two lists of gram sets, as products of presence matrices over the grams of `b`."""
    known = np.unique(np.concatenate(b))
    right = np.zeros((len(known), len(b)), np.float32)
    for j, g in enumerate(b):
        right[np.searchsorted(known, g), j] = 1 / np.sqrt(len(g))
    out = np.empty((len(a), len(b)))
    for i, g in enumerate(a):
        at = np.searchsorted(known, g)
        at = at[known[np.minimum(at, len(known) - 1)] == g]
        out[i] = right[at].sum(axis=0) / np.sqrt(len(g))
    return out


def fit(sets: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, weights BUCKETS x languages, constants) from gram sets in order of preference."""
    names = sorted(set(labels))
    chosen = [i for name in names for i in [j for j, x in enumerate(labels) if x == name][:landmarks]]
    marks = [sets[i] for i in chosen]
    near = kernel(sets, marks)
    values, vectors = np.linalg.eigh(near[chosen] + 1e-8 * np.eye(len(chosen)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    phi = near @ root
    want = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    mean_phi, mean_want = phi.mean(axis=0), want.mean(axis=0)
    gram = (phi - mean_phi).T @ (phi - mean_phi) + RIDGE * len(sets) * np.eye(len(chosen))
    coef = np.linalg.solve(gram, (phi - mean_phi).T @ (want - mean_want))
    constant = mean_want - mean_phi @ coef
    by_mark = root @ coef
    weights = np.zeros((BUCKETS, len(names)), np.float32)
    for g, row in zip(marks, by_mark):
        weights[g] += (row / np.sqrt(len(g))).astype(np.float32)
    return names, weights, constant


def learn(docs: DataFrame, may_learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS):
    """The model from rows where `may_learn` holds and `lang` is known, or None without any."""
    keys = docs.where(may_learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, key)
    keys = smallest(keys, lang, key, per_language).select(F.col(key).alias("__key"), F.col(lang).alias("__lang"), "__r").distinct()
    small = keys.count() <= SMALL_ROWS
    rows = docs.select(key, text, lang).join(F.broadcast(keys) if small else keys, F.col(key).eqNullSafe(F.col("__key")) & (F.col(lang) == F.col("__lang")))

    def run(batches):
        grams = Grams()
        for batch in batches:
            for part in pieces_of(batch):
                sets = [grams(t).astype(np.int32).tobytes() for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("__lang"), part.column("__r"), pa.array(sets, pa.binary())], names=["lang", "r", "grams"])

    sample = rows.select(text, "__lang", "__r").mapInArrow(run, "lang STRING, r INT, grams BINARY").where("length(grams) > 0").toLocalIterator()
    sample = sorted((r.lang, r.r, bytes(r.grams)) for r in sample)
    if not sample:
        return None
    sets = [np.frombuffer(g, np.int32).astype(np.int64) for _, _, g in sample]
    return fit(sets, [x[0] for x in sample], landmarks)


def predict(docs: DataFrame, model, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """(key, keep..., lang_pred, score, evidence) for every row. Row-local.

    `prefix` goes before the names of the new columns; `evidence` is the share of the text's grams that some landmark has."""
    slim = docs.select(key, *keep, *[text] * (text not in keep))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [prefix + c for c in ("lang_pred", "score", "evidence")]
    kept = [c for c in slim.columns if c != text or c in keep]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name in kept)

    def run(batches):
        names, weights, constant = shared.value or ([UNKNOWN], None, None)
        grams = Grams()
        known = None if weights is None else weights.any(axis=1)
        for batch in batches:
            for part in pieces_of(batch, 1 << 21):
                sets = [grams(t) for t in part.column(text).to_pylist()] if weights is not None else [np.empty(0, np.int64)] * part.num_rows
                sizes = np.array([len(s) for s in sets])
                pred, score, evidence = np.full(len(sets), UNKNOWN, object), np.zeros(len(sets)), np.zeros(len(sets))
                some = np.flatnonzero(sizes)
                if len(some):
                    starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
                    sums = np.add.reduceat(weights[np.concatenate([sets[i] for i in some])], starts, axis=0, dtype=np.float64)
                    values = sums / np.sqrt(sizes[some])[:, None] + constant
                    best = values.argmax(axis=1)
                    pred[some] = np.array(names, object)[best]
                    won = values[np.arange(len(best)), best]
                    score[some] = np.clip((won + 1) / 2, 0, 1)
                    evidence[some] = np.add.reduceat(known[np.concatenate([sets[i] for i in some])], starts, dtype=np.int64) / sizes[some]
                out = [part.column(c) for c in kept] + [pa.array(pred, pa.string()), pa.array(score), pa.array(evidence)]
                yield pa.RecordBatch.from_arrays(out, names=[*kept, *added])

    return slim.mapInArrow(run, f"{fields}, {added[0]} STRING, {added[1]} DOUBLE, {added[2]} DOUBLE")


def identify(docs: DataFrame, folds: int = 3, held: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keep..., held_out, lang_pred, score): learned from the rows whose crc32(doc_id) mod `folds` isn't `held`."""
    is_held = crc_is("doc_id", folds, held)
    model = learn(docs, ~is_held)
    return predict(docs, model, keep=keep).select("doc_id", *keep, is_held.alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame, floor: float = FLOOR) -> DataFrame:
    """The documents of which a learned language claims the text; `und` and unclaimed ones go.
    If no language can be learned, all with a letter stay."""
    others = tuple(c for c in docs.columns if c != "doc_id")
    model = learn(docs, ~crc_is("doc_id", 3, 1))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    scored = predict(docs.select("doc_id", *others), model, keep=others, prefix="__")
    return scored.where((F.col("__lang_pred") != UNKNOWN) & (F.col("__evidence") >= floor)).select(*docs.columns)
