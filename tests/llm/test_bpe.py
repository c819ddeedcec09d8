"""Byte-level BPE against the tiktoken library and against plain merging."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest

from larkspan.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load_ranks(PATH))


def words(rnd, alphabet, n):
    return "".join(rnd.choice(alphabet) for _ in range(n))


def test_pieces_equal_plain_merging(encoder):
    rnd = random.Random(1)
    for _ in range(2000):
        data = words(rnd, rnd.choice(["ab", "aeiou", "0123456789", "thenrei", "äöß漢字é"]), rnd.randint(1, 24)).encode()
        want = [encoder.ranks[data]] if data in encoder.ranks else [encoder.ranks[p] for p in bpe.merged(encoder.ranks, data)]
        assert encoder.piece(data) == want
        assert encoder.decode(want) == data


def test_append_and_edit_equal_a_fresh_run(encoder):
    rnd = random.Random(2)
    for _ in range(500):
        data = words(rnd, "abthe on12", rnd.randint(0, 90)).encode()
        a = rnd.randint(0, len(data))
        b = rnd.randint(a, len(data))
        p = encoder.prefixes(data)
        done = p.replace(a, b, b"hex")
        assert p.last == encoder.prefixes(data[:a] + b"hex" + data[b:]).last
        assert done <= len(p.data)
        p.append(b" the end")
        assert p.last == encoder.prefixes(p.data).last


def test_an_edit_stops_near_its_place(encoder):
    data = b"the engine reads many words and " * 400
    p = encoder.prefixes(data)
    assert p.replace(100, 101, b"X") < 200


def test_documents_equal_tiktoken(spark, tik):
    rnd = random.Random(3)
    texts = [None, "", " ", "  a  b ", "a \n\n b", "don't 'll can't", "x\x1c y", "a　 b", "ab" * 5000, "漢字 " * 50, "same", "same"]
    texts += [words(rnd, "ab'st \n\t　\x1c1.!é漢", rnd.randint(0, 60)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x", t) for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens string, ids string")
    got = {r.doc_id: r for r in bpe.encode_documents(docs, PATH, P.PATTERN, with_ids=True, remember=False).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = tik.encode_ordinary(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.encode_documents(docs, PATH, P.PATTERN).count() == 0


def test_many_matches_side_by_side_equal_the_programme_one_by_one(monkeypatch):
    from larkspan.llm import bpe_batch

    monkeypatch.setattr(bpe_batch, "PAIRS", 1 << 6)  # pairs take each other's places
    monkeypatch.setattr(bpe_batch, "ROWS", 100)
    rnd = random.Random(9)
    ranks = {bytes([b]): b for b in range(256)}
    while len(ranks) < 600:
        parts = bpe.merged(ranks, bytes(rnd.choice(b"abc") for _ in range(12)))  # ranks as merging makes them: neighbours that stand
        if len(parts) > 1:
            at = rnd.randrange(len(parts) - 1)
            ranks.setdefault(parts[at] + parts[at + 1], len(ranks))
    encoder = bpe.Encoder(ranks)
    data = [bytes(rnd.choice(b"abc\x00\xff") for _ in range(rnd.randint(1, 48))) for _ in range(900)] + list(ranks)
    assert bpe_batch.Batch(encoder).ids(data) == [encoder.piece(d) for d in data]
    assert bpe_batch.Batch(encoder).ids([]) == []


def test_long_texts_in_stretches(spark, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(bpe, "STRETCH", 50)
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(["ab", "The", "é", "don't", " ", " ", "  ", "\n", " \t", "12", "日本", "."]) for _ in range(rnd.randint(0, 300))) for _ in range(60)] + [None, "", "x" * 3000, " " * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    import tiktoken

    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    for r in bpe.encode_documents(docs, path, public_tokenizers.PATTERN, with_ids=True).collect():
        want = plain.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
