"""Byte-level BPE by prefix dynamic programming.

A BPE encoding is right exactly when every two neighbouring tokens could stand
beside each other, so each prefix of a byte string has one valid last token.
`Encoder` stores that token per prefix: appending bytes only adds entries, and
an edit recomputes entries from the edit on (`Prefixes`).

Two tokens may stand beside each other unless a merge across their border comes
first. Every part x on the right edge of the left token lives until the merge
that uses it up, likewise every part y on the left edge of the right token; the
pair is wrong if the merge of some x and y has a lower rank than the merges that
end x and y (an equal rank goes to the leftmost place).

Defined results: null text counts as the empty text; empty text has no tokens,
and the digests of empty input. Repeated rows give repeated results. Other
columns are ignored by the query and kept by `encode_documents(keep=...)`.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from larkspan.llm.worker import pieces_of, stash

CACHE_PARTS = 1 << 18  # parts of texts a worker remembers; a store is emptied before it overflows
CACHE_PIECES = 1 << 14  # matches it remembers, for parts of several
CACHE_PAIRS = 1 << 17  # pairs of tokens it remembers
SLICE = 1 << 21  # bytes of texts held as Python objects at a time
STRETCH = 1 << 16  # characters of a text encoded at a time
CACHE_CHARS = 48  # longer pieces are not remembered


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank per line of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merged(ranks: dict[bytes, int], piece: bytes, below: int | None = None) -> list[bytes]:
    """Plain merging, lowest rank first and leftmost among equals: the definition
    the dynamic programme is tested against, and how the splits are found."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        best = min((f for f in found if f[0] is not None and (below is None or f[0] < below)), default=None)
        if best is None:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return parts


def splits_of(ranks: dict[bytes, int]) -> dict[int, tuple[int, int] | None]:
    """By token: the two tokens its last merge joins, or None if merging never makes it."""
    found: dict[int, tuple[int, int] | None] = {}
    for token, rank in ranks.items():
        if len(token) > 1:
            parts = merged(ranks, token, rank)
            found[rank] = (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None
    return found


class Encoder:
    def __init__(self, ranks: dict[bytes, int], splits: dict[int, tuple[int, int] | None] | None = None):
        self.ranks = ranks
        self.splits = splits_of(ranks) if splits is None else splits
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.usable = {t: r for t, r in ranks.items() if self.splits.get(r, ()) is not None}
        self.opening = {t[:n]: -1 for t in self.usable for n in range(1, len(t))} | self.usable
        self.fits: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})

    def edge(self, token: int, side: int) -> list[tuple[bytes, float]]:
        """Parts on the left (0) or right (1) edge of a token, each with the rank of the merge that uses it up."""
        known = self.edges[side].get(token)
        if known is None:
            known, t, until = [], token, float("inf")
            while True:
                known.append((self.bytes_of[t], until))
                parts = self.splits.get(t)
                if not parts:
                    break
                t, until = parts[side], t
            self.edges[side][token] = known
        return known

    def may_stand(self, a: int, b: int) -> bool:
        known = self.fits.get(a << 20 | b)
        if known is None:
            if len(self.fits) >= CACHE_PAIRS:
                self.fits.clear()
            known = self.fits[a << 20 | b] = self.fit(a, b)
        return known

    def fit(self, a: int, b: int) -> bool:
        """`may_stand` worked out."""
        get, right = self.ranks.get, self.edge(b, 0)
        for x, x_until in self.edge(a, 1):
            for y, y_until in right:
                r = get(x + y)
                if r is not None and r < x_until and r <= y_until:
                    return False
        return True

    def last_token(self, data: bytes, last: list[int], end: int) -> int:
        """The one token that can end the encoding of data[:end]; last[i] is that of data[:i]."""
        usable = self.usable
        for start in range(max(0, end - self.longest), end):
            token = usable.get(data[start:end])
            if token is not None and (not start or self.may_stand(last[start], token)):
                return token
        raise ValueError("the ranks lack a single byte")

    def extend(self, data: bytes, last: list[int]) -> None:
        """Fill in the last tokens of the prefixes of `data` that `last` doesn't reach yet.

        Goes from each start along the tokens that begin there; entries are right
        when their turn as a start comes, since all shorter starts are done."""
        begun, n, opening, fits = len(last), len(data), self.opening, self.fits
        last += [-1] * (n + 1 - begun)
        for start in range(max(0, begun - self.longest), n):
            before = last[start]
            for end in range(start + 1, n + 1):
                token = opening.get(data[start:end])
                if token is None:
                    break
                if token >= 0 and end >= begun and last[end] < 0:
                    ok = True if not start else fits.get(before << 20 | token)
                    if ok or ok is None and self.may_stand(before, token):
                        last[end] = token

    def prefixes(self, data: bytes) -> Prefixes:
        return Prefixes(self, data)

    def piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern; a match that is a token itself is that token."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.prefixes(data).ids()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Prefixes:
    """The last token of every prefix of a byte string under edits."""

    def __init__(self, encoder: Encoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact: no entry of an earlier prefix changes."""
        self.data += more
        self.encoder.extend(self.data, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put `new` in the place of data[start:stop]; gives the number of entries computed anew.

        An entry depends on the bytes and entries within one longest token before
        it, so once that many entries in a row are as before, the rest stay."""
        old, shift = self.last, len(new) - (stop - start)
        rest = self.data[stop:]
        self.data = self.data[:start] + new + rest
        self.last = old[: start + 1]
        same = done = 0
        for end in range(start + 1, len(self.data) + 1):
            token = self.encoder.last_token(self.data, self.last, end)
            self.last.append(token)
            done += 1
            past = end - (start + len(new))
            same = same + 1 if past > 0 and old[end - shift] == token else 0
            if same >= self.encoder.longest:
                self.last += old[end - shift + 1 :]
                break
        return done

    def ids(self) -> list[int]:
        found, end = [], len(self.data)
        while end:
            found.append(self.last[end])
            end -= len(self.encoder.bytes_of[found[-1]])
        return found[::-1]


_SHARED: dict = {}


def shared_encoder(spark: SparkSession, path: str):
    """The ranks and splits as a broadcast: as large as the vocabulary, whatever the input."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _SHARED:
        ranks = load_ranks(path)
        _SHARED[key] = spark.sparkContext.broadcast((path, ranks, splits_of(ranks)))
    return _SHARED[key]


class Known(dict):
    """Ids by string, worked out when first asked for; emptied when full."""

    def __init__(self, of, limit: int):
        self.of, self.limit = of, limit

    def __missing__(self, key: str) -> str:
        ids = self.of(key)
        self.keep(key, ids)
        return ids

    def keep(self, key: str, ids: str) -> None:
        if len(key) <= CACHE_CHARS:
            if len(self) >= self.limit:
                self.clear()
            self[key] = ids


class TextEncoder:
    """Texts to ids and back, in stretches of bounded length; made once per worker.

    A single space between two characters that aren't white space always begins
    a match, so a text may be cut there and each part be encoded by itself."""

    def __init__(self, ranks, splits, pattern: str):
        import regex

        from larkspan.llm.bpe_batch import LONGEST, Batch

        self.encoder, self.find, self.longest = Encoder(ranks, splits), regex.compile(pattern).findall, LONGEST
        self.batch = Batch(self.encoder)
        self.pieces = Known(lambda piece: ",".join(map(str, self.encoder.piece(piece.encode()))), CACHE_PIECES)
        self.opening = Known(lambda part: ",".join(map(self.pieces.__getitem__, self.find(part))), CACHE_PIECES)
        self.spaced = Known(lambda part: ",".join(map(self.pieces.__getitem__, self.find(" " + part))), CACHE_PARTS)
        self.runs, self.cut = re.compile(r"\s | \s|\A | \Z").search, re.compile(r"(?<=\S) (?=\S)")
        size = max(self.encoder.bytes_of, default=0) + 1
        self.blob = np.frombuffer(b"".join(self.encoder.bytes_of.get(i, b"") for i in range(size)), np.uint8)
        self.length = self.batch.size.astype(np.int64)
        self.offset = np.cumsum(self.length) - self.length

    def stretches(self, text: str) -> list[list[str]]:
        """The parts of a text, STRETCH characters or a little more at a time; only the first part has no space before it."""
        out, at = [], 0
        while True:
            border = self.cut.search(text, at + STRETCH) if len(text) > at + STRETCH else None
            piece = text[at : border.start()] if border else text[at:]
            out.append(self.cut.split(piece) if self.runs(piece) else piece.split(" "))
            if not border:
                return out
            at = border.end()

    def learn(self, parts: set[str]) -> None:
        """Work out the ids of parts that follow a space, all side by side."""
        if len(self.spaced) + len(parts) > CACHE_PARTS:
            self.spaced.clear()
        parts = [p for p in parts if len(p) <= CACHE_CHARS and p not in self.spaced]
        found = [self.find(" " + p) for p in parts]
        fresh = [m for m in {m for ms in found for m in ms} if m not in self.pieces and len(m.encode()) <= self.longest]
        ids = dict(zip(fresh, (",".join(map(str, i)) for i in self.batch.ids([m.encode() for m in fresh]))))
        for part, matches in zip(parts, found):
            self.spaced.keep(part, ",".join([ids.get(m) or self.pieces[m] for m in matches]))

    def __call__(self, parts: list[str], first: bool) -> str:
        """Ids of a stretch, comma-joined."""
        ids = [self.opening[parts[0]] if first else self.spaced[parts[0]], *map(self.spaced.__getitem__, parts[1:])]
        return ",".join(ids) if len(ids) > 1 else ids[0]

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.length[ids]
        ends = np.cumsum(n)
        if not len(ids):
            return b""
        return self.blob[np.repeat(self.offset[ids] - ends + n, n) + np.arange(ends[-1])].tobytes()


def text_encoder(shared, pattern: str) -> TextEncoder:
    path, ranks, splits = shared.value
    held = stash("bpe")
    if held.get("of") != (path, pattern):
        held.update(of=(path, pattern), made=TextEncoder(ranks, splits, pattern))
    return held["made"]


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), with_ids: bool = False, remember: bool = True) -> DataFrame:
    """(key, keep..., n_tokens, ids_sha256, decoded_sha256[, ids]) for each row's whole text.

    Row-local: one pass in Arrow batches, no shuffle. With `remember`, a worker keeps the encoder
    and its stores for its next task; without, it gives them up, for jobs whose other stages need the room."""
    shared = shared_encoder(docs.sparkSession, path)
    slim = docs.select(key, *keep, text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.drop(text).schema)
    schema = f"{fields}, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING" + (", ids ARRAY<INT>" if with_ids else "")
    names = [*slim.drop(text).columns, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches):
        encode = text_encoder(shared, pattern)
        for batch in batches:
            for part in pieces_of(batch, SLICE):
                texts = part.column(text).to_pylist()
                short = [encode.stretches(t) for t in texts if t and len(t) <= STRETCH]
                encode.learn({p for stretch in short for parts in stretch for p in parts[1:]})
                del short
                counts, shas, back, ids = [], [], [], []
                for t in texts:
                    n, sha, plain, held = 0, hashlib.sha256(), hashlib.sha256(), []
                    for k, parts in enumerate(encode.stretches(t) if t else []):
                        if len(t) > STRETCH:
                            encode.learn(set(parts[k == 0 :]))
                        found = encode(parts, k == 0)
                        numbers = np.fromstring(found, np.int32, sep=",")
                        n += len(numbers)
                        sha.update(("," * (k > 0) + found).encode())
                        plain.update(encode.decode(numbers))
                        if with_ids:
                            held.append(numbers)
                    counts.append(n)
                    shas.append(sha.hexdigest())
                    back.append(plain.hexdigest())
                    ids += held
                out = [pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names[: len(names) - len(out)]] + out, names=names)
        if not remember:
            stash("bpe").clear()

    return slim.mapInArrow(run, schema)
