import importlib

import pytest

import corpus_pipeline
from lectern.llm import bpe, decontaminate, jaccard, langid, queries, secrets
from lectern.scratch import Scratch
from tests.llm.test_jaccard import plain as plain_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage is given and what it keeps."""
    scratch, docs, out = Scratch(spark), queries.table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        kept = scratch.write(stage(spark, docs, SF), name)
        out.append((name, docs, kept))
        docs = kept
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_are_the_five_in_order(steps):
    assert [s[0] for s in steps] == ["language_id", "ngram_jaccard", "decontaminate", "secrets", "bpe"]
    for _, given, kept in steps[:-1]:
        assert kept.columns == given.columns


def test_each_stage_equals_its_plain_version(spark, steps):
    given, kept = rows(steps[0][1]), rows(steps[0][2])
    told = {r.doc_id: r for r in langid.identify(steps[0][1]).collect()}
    assert set(kept) == {d for d, r in told.items() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE}
    assert all(kept[d] == given[d] for d in kept)

    given, kept = rows(steps[1][1]), rows(steps[1][2])
    assert set(kept) == {c for _, _, c in plain_groups([(d, r.text) for d, r in given.items()])}

    given, kept = rows(steps[2][1]), rows(steps[2][2])
    leaks = {r.doc_id for r in decontaminate.contaminated(steps[2][1], queries.table(spark, SF, "benchmark")).collect()}
    assert set(kept) == set(given) - leaks

    given, kept = rows(steps[3][1]), rows(steps[3][2])
    network = secrets.learn(steps[3][1])
    assert {d: r.text for d, r in kept.items()} == {d: secrets.masked(r.text, secrets.find(r.text, network)[1]) for d, r in given.items()}
    assert all(r.n_chars == len(r.text) for r in kept.values())

    given, kept = rows(steps[4][1]), rows(steps[4][2])
    vocab = bpe.vocabulary(queries.vocabulary_path())
    assert set(kept) == set(given) and all(r.round_trip for r in kept.values())
    assert all(vocab.decode(kept[d].token_ids).decode() == given[d].text and kept[d].n_tokens == len(kept[d].token_ids) for d in given)


def test_run_is_the_last_stage(spark, steps):
    assert sorted(corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens").collect()) == sorted(steps[-1][2].select("doc_id", "n_tokens").collect())


def test_stages_bear_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            kept = stage(spark, docs, SF)
            assert kept.count() <= docs.count()
    kept = corpus_pipeline.keep_known_language(spark, odd, SF)
    assert kept.columns == odd.columns and not {3, 4, 5, 9} & {r.doc_id for r in kept.collect()}


def test_queries_are_registered():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names and set(queries.SQL) <= set(entry.oracle_sql())
    assert jaccard.PERCENT == 80 and jaccard.SHINGLE == 5
