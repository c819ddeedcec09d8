"""The stages one after another against plain versions, each on what the stage before it kept."""

import hashlib

import corpus_pipeline as cp
import public_tokenizers
import pytest

from larkspan.llm import bpe, langid, mixing
from larkspan.storage import written
from larkspan.tables import Tables

from .test_linededup import brute
from .test_simhash import wide_groups

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Documents with hard cases, and what each stage makes of its predecessor's rows."""
    docs = Tables(spark, SF).documents
    hard = [(-1, None, None, None, None), (-2, "", "en", "src0", 0), (-3, "12 %% 34\n\n", "en", None, 9)]
    docs = written(docs.unionByName(spark.createDataFrame(hard, docs.schema)), "documents")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(written(stage(spark, out[-1], SF), name))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(steps):
    assert all(d.columns == COLUMNS for d in steps[:5])
    assert len(cp.STAGES) == 5


def test_language_keeps_all_with_letters(steps):
    before, after = rows(steps[0]), rows(steps[1])
    assert set(before) - set(after) == {-1, -2, -3}
    assert all(after[i] == before[i] for i in after)
    assert all(langid.Grams()(r.text).size for r in after.values())


def test_lines_equal_brute_force(steps):
    before, after = rows(steps[1]), rows(steps[2])
    want = dict(brute([(i, r.text) for i, r in before.items()], 16))
    want = {i: t for i, t in want.items() if any(line.strip(" \t\r\f\v") for line in t.split("\n"))}
    assert {i: r.text for i, r in after.items()} == want


def test_near_copies_keep_one_of_each_group(steps):
    before, after = rows(steps[2]), rows(steps[3])
    ids = sorted(before)
    assert set(after) == {ids[v] for v in wide_groups([before[i].text for i in ids])}
    assert all(after[i] == before[i] for i in after)


def test_mix_holds_the_taken_words(steps):
    taken = {r.doc_id: r.taken for r in mixing.mix(steps[3]).collect()}
    words = {}
    for r in steps[4].collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.encode().split())
    assert words == {i: n for i, n in taken.items() if n}
    assert 1.45 < sum(words.values()) / sum(len(r.text.encode().split()) for r in steps[3].collect()) < 1.55


def test_encoding_decodes_to_the_text(steps):
    encoder = bpe.Encoder(bpe.load_ranks(cp.RANKS))
    texts = sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in steps[4].collect())
    got = steps[5].collect()
    assert sorted((r.doc_id, hashlib.sha256(encoder.decode(r.ids)).hexdigest()) for r in got) == texts
    assert all(r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(encoder.decode(r.ids)).hexdigest() for r in got)


def test_run_and_empty_table(spark, steps, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    steps[0].limit(0).write.parquet(path)
    assert cp.run(spark, str(tmp_path)).count() == 0
    assert public_tokenizers.PATTERN


def test_entry_points():
    import __spark_entry__ as e

    names = set(e.queries())
    assert {"pipeline"} | {f"op{n}" for n in range(1, 11)} <= {n if n == "pipeline" else n.split("_")[0] for n in names}
    assert set(e.oracle_sql()) <= names
