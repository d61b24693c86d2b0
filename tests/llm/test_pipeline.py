from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pytest
import test_simhash
from compare import connect, spark_rows, sql_rows
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.llm import decontaminate
from tidemark.llm.queries import REGISTERED

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTERED.items() if sql])
def test_query_matches_its_sql(spark, sf_dir, name):
    query, sql = REGISTERED[name]
    assert spark_rows(query(spark, sf_dir)) == sql_rows(connect(sf_dir), sql)


def test_registered():
    names = contract.queries()
    assert [len([n for n in names if n.startswith(f"op{i}_")]) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and "pipeline" not in contract.oracle_sql()


def test_stages_against_brute_force(spark, sf_dir):
    """Each stage on all that the one before kept; the last three wholly by other means."""
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # fewer labels teach too little
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == DOCUMENTS
        kept.append({r.doc_id: r.text for r in docs.collect()})
    clean, single, free, masked = kept

    insults = re.compile(r"\b(idiot|moron|scum|trash|loser|clown|stupid|pathetic|worthless|disgusting)\b", re.I)
    caught = [i for i, t in text.items() if len({w.lower() for w in insults.findall(t)}) >= 3]
    assert caught and not set(caught) & clean.keys()
    assert len(clean) > 0.8 * len(text)

    ids = sorted(clean)
    groups = test_simhash.brute_groups(ids, [test_simhash.brute_fingerprint(clean[i]) for i in ids])
    assert single == {i: clean[i] for i in set(groups)}

    benchmark = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {i for i, t in single.items() if any(b in t for b in benchmark)}
    assert not leaks & free.keys()
    assert len(single.keys() - free.keys() - leaks) <= 2  # copies that differ in case or marks

    strong = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}""")
    assert masked.keys() == free.keys()
    assert not any(strong.search(t or "") for t in masked.values())
    assert all(masked[i] == t for i, t in free.items() if "[SECRET]" not in masked[i])
    assert all((r.n_chars == len(r.text)) for r in docs.collect())

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id: list(r.ids) for r in out} == {i: library.encode(t, add_special_tokens=False).ids for i, t in masked.items()}
    assert all(r.n_tokens == len(r.ids) for r in out)


def test_run(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    rows = found.collect()
    assert found.columns == ["doc_id", "n_tokens", "ids"] and len({r.doc_id for r in rows}) == len(rows) > 0
    assert np.all([r.n_tokens == len(r.ids) for r in rows])


def test_decontamination_is_fitted_to_all_documents(spark, prose, tmp_path, monkeypatch):
    """The stage takes no sample: its counts are those of all documents, its space that of all their passages."""
    texts = prose(60, words=70, seed=31)
    spark.createDataFrame([(i, " ".join(t.split()[:20])) for i, t in enumerate(texts[:8])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(i % 700, f"w{i} {texts[i % 60]}") for i in range(900)], "doc_id long, text string")
    counts, passages = [], []
    frequency, products = decontaminate.document_frequency, decontaminate.products
    monkeypatch.setattr(decontaminate, "sampled_passages", lambda *_: pytest.fail("a sample"))
    monkeypatch.setattr(decontaminate, "document_frequency", lambda *a: counts.append(frequency(*a)) or counts[-1])
    monkeypatch.setattr(decontaminate, "products", lambda *a: passages.append(products(*a)) or passages[-1])
    kept = {r.doc_id for r in corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path)).collect()}
    assert kept and not any(i % 60 < 8 for i in kept if i >= 200)
    words = [t.casefold().split() for t in texts]
    folded = [[f"w{i}", *words[i % 60]] for i in range(900)]
    known = {w for t in words[:8] for w in t[:20]}
    assert [n for n, _ in counts] == [900]
    assert sorted(counts[0][1]) == sorted(sum(w in t for t in map(set, folded)) for w in known)
    assert [n for _, n in passages] == [sum(not known.isdisjoint(t[at : at + 32]) for t in folded for at in range(0, len(t), 32))]
