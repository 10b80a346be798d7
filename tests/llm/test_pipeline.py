"""The pipeline, stage by stage."""

from __future__ import annotations

import corpus_pipeline
from almoner.llm import toxicity
from almoner.llm.common import table
from almoner.session import written
from tests.llm import brute


def test_stages(spark, folder):
    docs = table(spark, folder, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), name)
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    model = toxicity.trained(table(spark, folder, "documents"), table(spark, folder, "labels"))
    clean = toxicity.scored(table(spark, folder, "documents"), model).filter("score < 0.7")
    assert seen["toxicity"].count() == clean.count() > 0.8 * table(spark, folder, "documents").count()
    texts = {r.doc_id: r.text for r in seen["toxicity"].collect()}
    last = {t: max(d for d in texts if texts[d] == t) for t in set(texts.values())}
    assert {r.doc_id for r in seen["exact_dedup"].collect()} == set(last.values())
    kept = [(d, texts[d]) for d in sorted(last.values())]
    first = {c if n else d for (d, _), (n, c) in zip(kept, brute.components(kept))}
    assert {r.doc_id for r in seen["ngram_jaccard"].collect()} == first
    mixed = seen["source_mix"].collect()
    assert {r.doc_id for r in mixed} <= first
    words = sum(len(brute.words(texts[d])) for d in first)
    assert abs(sum(len(brute.words(r.text)) for r in mixed) - 1.5 * words) <= 20
    assert seen["byte_bpe"].count() == len(mixed)
    assert all(r.n_tokens == len(r.ids) for r in seen["byte_bpe"].collect())


def test_registered(spark, folder):
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
