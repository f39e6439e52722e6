"""The stages, each against a plain version of what it has to do with its own input."""

import brute
import corpus_pipeline
import pytest
from tests_data import SF_DIR

from pulseframe.llm import bpe, secret_scan, toxicity
from pulseframe.llm.common import table
from pulseframe.sources.staging import stage


@pytest.fixture(scope="module")
def outputs(spark):
    docs, found = table(spark, SF_DIR, "documents"), []
    for name, apply in corpus_pipeline.STAGES:
        found.append((docs, docs := stage(apply(spark, docs, SF_DIR), name)))
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_names_and_columns(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "dart_minhash", "spaced_seeds", "secret_scan", "byte_bpe"]
    for before, after in outputs[:-1]:
        assert after.columns == before.columns


def test_toxicity_stage(spark, outputs):
    before, after = outputs[0]
    scores = toxicity.score_documents(before, table(spark, SF_DIR, "labels")).collect()
    assert set(texts(after)) == {r["doc_id"] for r in scores if not r["predicted"]}


def test_copies_stage(outputs):
    before, after = outputs[1]
    classes = brute.classes(list(texts(before).items()))
    assert set(texts(after)) == set(classes.values())


def test_benchmark_stage(spark, outputs):
    before, after = outputs[2]
    items = [r["text"] for r in table(spark, SF_DIR, "benchmark").collect()]
    assert set(texts(after)) == {d for d, t in texts(before).items() if not any(brute.holds(t, x) for x in items)}


def test_secrets_stage(outputs):
    before, after = outputs[3]
    old, new = texts(before), texts(after)
    assert set(old) == set(new)
    for d, t in old.items():
        _, every = secret_scan.spans(t, bpe.encoding())
        assert new[d] == secret_scan.redact(t, every)
        assert not every or new[d] != t
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_tokens_stage(outputs):
    before, after = outputs[4]
    counts = {d: len(bpe.encoding().encode_ordinary(t)) for d, t in texts(before).items()}
    assert {r["doc_id"]: r["n_tokens"] for r in after.collect()} == counts


def test_run_gives_the_last_stage(spark, outputs):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(tuple, outputs[-1][1].collect()))


def test_edge_rows_pass_all_stages(spark, edge_docs, no_docs):
    for docs, least in ((edge_docs, 5), (no_docs, 0)):
        for _, apply in corpus_pipeline.STAGES:
            docs = stage(apply(spark, docs, SF_DIR), "edge")
        assert docs.count() >= least
