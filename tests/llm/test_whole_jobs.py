"""Cases in which operators once did less than their whole job."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from almoner.llm import exact_dedup, license_rules, license_scan, ngram_join, style_tree, toxicity
from tests.llm import brute

# --- 2: toxicity


def test_sample_goes_on_after_long_texts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 100)
    monkeypatch.setattr(toxicity, "LONG", 40, raising=False)
    # three in four texts don't fit, or would leave no room for others
    docs = spark.createDataFrame([(i, "long " * (150 if i % 2 else 90) if i % 4 else f"row {i}") for i in range(60)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 8 = 0 as int) AS toxic")
    short = docs.filter(~toxicity.held_out(docs["doc_id"]) & (docs["doc_id"] % 4 == 0))
    assert Counter(r[0] for r in toxicity.sample(docs, labels)) == Counter(r.text for r in short.collect())
    assert toxicity.fitting([(1, 90), (2, 101), (3, 5), (4, 5), (5, 95)], 100, 40) == [3, 4, 1]


def test_learns_from_every_labelled_row(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 6)
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 150, raising=False)
    texts = [f"plain words {i} and {i % 7} more, {'awful' if i % 3 == 0 else 'kind'} ones" for i in range(900)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(1, texts[1], "en"), (900, None, None)], "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) AS toxic")
    rows = Counter(r.doc_id for r in docs.filter(~toxicity.held_out(docs["doc_id"])).collect())
    wanted = Counter()
    for d, n in rows.items():
        wanted[len(texts[d].split()) if d < 900 else 0, int(d % 3 == 0)] += n * n
    packed = toxicity.shards(toxicity.training_rows(docs, labels), 4).toArrow().to_batches()
    opened = list(toxicity.opened(packed))
    assert Counter((len(t), int(v)) for _, ts, y, *_ in opened for t, v in zip(ts, y)) == wanted
    assert len({shard for shard, *_ in opened}) == len(opened) == 4
    found = toxicity.toxic_scores(docs, labels).filter("doc_id < 900").collect()
    assert all((r.score >= 0.5) == (r.doc_id % 3 == 0) for r in found)


def test_long_texts_are_learnt_in_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 50, n).astype(np.int32) for n in (1, 2, 3, 40, 7, 200, 1, 64)] * 12
    y, buckets = np.array([0, 1, 0, 1, 0, 0, 1, 1] * 12, np.float32), rng.integers(0, toxicity.BUCKETS, (50, toxicity.PARTS)).astype(np.int32)

    def rows(block):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        own = np.random.default_rng(2)
        model = toxicity.Model.fresh(own)
        model.learn(texts, y, buckets, own, 2)
        again = toxicity.Model.fresh(np.random.default_rng(3))
        again.set_rows(model.rows())
        assert np.array_equal(again.rows(), model.rows())
        return model.rows()

    assert np.array_equal(rows(1 << 20), rows(13))


# --- 5: n-gram join


@pytest.mark.parametrize("cell", [3, 2048])
def test_join_gives_every_link_once(spark, cell):
    words = [f"w{i}" for i in range(80)]
    near = [" ".join([*words[:i], f"x{i}", *words[i + 1 :]]) for i in (0, 1, 2, 78, 79)]
    texts = [" ".join(words), *near, near[0], near[0], " ".join(words[40:] + ["tail"] * 2), "few words", "FEW  words", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [brute.shingles(t) for t in texts]
    links = {(a, b) for a in range(len(texts)) for b in range(len(texts)) if a != b and sets[a] and brute.jaccard(sets[a], sets[b]) >= 0.75}
    got = ngram_join.link_counts(docs, cell=cell).collect()
    assert {r.doc_id: (r.n_shingles, r.n_links) for r in got} == {a: (len(s), sum(x == a for x, _ in links)) for a, s in enumerate(sets)}
    first = [next(b for b in range(len(texts)) if sets[b] == s) for s in sets]
    wanted = Counter(frozenset(p) for p in links if p[0] < p[1] and all(first[x] == x for x in p) and sets[p[0]] != sets[p[1]])
    pairs = ngram_join.linked_pairs(docs, cell=cell).collect()
    assert Counter(frozenset((r.doc_id_a, r.doc_id_b)) for r in pairs) == wanted and len(wanted) > 6
    for r in pairs:
        a, b = sets[r.doc_id_a], sets[r.doc_id_b]
        assert (r.n_a, r.n_b, r.n_shared) == (len(a), len(b), len(a & b))
        assert (r.copies_a, r.copies_b) == (first.count(r.doc_id_a), first.count(r.doc_id_b))


# --- 6: license scan

UNGATED = [
    "Released under MIT", "distributed under Apache 2.0", "This is available under CC0.", "published under EPL 2.0", "provided by the Vim",
    "covered by the terms of the WTFPL v2 and more", "released under a tree", "discovered by chance", "distributed under", "Released under MITRE",
]


def test_scan_of_sentences_without_gate_words(spark):
    rules = license_rules.rules()
    frame = spark.createDataFrame(list(enumerate(UNGATED)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.licenses(frame).collect()}
    for i, text in enumerate(UNGATED):
        facts, spans = brute.license_facts(text, license_scan.PHRASES, rules, license_rules.CONFIDENCE)
        assert tuple(got[i][1:-1]) == tuple(facts), text
        assert Counter(tuple(x[:3]) for x in got[i].detections) == Counter(tuple(x) for x in spans), text
    assert "mit" in got[0].labels.split(",") and "epl-2.0" in got[3].labels.split(",") and got[7].labels == ""


STATED = {
    "epl": "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE",
    "mpl-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1",
    "ofl-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "cddl": "The contents of this file are subject to the terms of the Common Development and Distribution License",
    "artistic-1.0": "The intent of this document is to state the conditions under which a Package may be copied",
    "artistic-2.0": "This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed.",
    "bsl-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    "busl-1.1": "the right to copy, modify, create derivative works, redistribute, and make non-production use of the Licensed Work.",
    "wtfpl": "0. You just DO WHAT THE FUCK YOU WANT TO.",
}


def test_scan_of_licenses_by_their_own_sentences(spark):
    rules = license_rules.rules()
    frame = spark.createDataFrame(list(enumerate(STATED.values())), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.licenses(frame).collect()}
    for i, (label, text) in enumerate(STATED.items()):
        facts, _ = brute.license_facts(text, license_scan.PHRASES, rules, license_rules.CONFIDENCE)
        assert tuple(got[i][1:-1]) == tuple(facts), label
        assert label in got[i].labels.split(",") and got[i].score == 0.95, label


# --- 4: style tree

ARTICLES = {
    '<article class="post has-sidebar"><p>a</p></article>': "a",
    '<article class="post related-posts-on"><p>a</p></article><aside>x</aside>': "a",
    '<article><p class="social-science">a</p><section id="search">b</section><div id="ad-hoc-section">c</div></article>': "a\nb\nc",
    "<article><p>a</p><dialog>b</dialog><p><button>c</button></p><form>d</form></article>": "a\nb\nc",
    '<div class="main-nav">n</div><div class="with-banner"><p>a</p></div><div class="cookie-notice">c</div>': "a",
    '<article><p>a</p><div class="comment-list"><article><p>r</p></article></div><div class="share">s</div></article>': "a",
    '<article><p>a</p></article><div id="comments"><article class="x"><p>r</p></article></div>': "a",
    '<article><header role="banner"><h1>t</h1></header><p>a</p></article>': "t\na",
}


def test_articles_are_not_lost_by_their_classes(spark):
    pages = [(i, None, f"<body>{html}</body>") for i, html in enumerate(ARTICLES)]
    got = {r.page_id: r.text for r in style_tree.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(len(pages))] == list(ARTICLES.values())


def test_the_tree_changes_most_pages_without_telling_names(spark):
    """Boilerplate inside the article whose classes say nothing: only the tree finds it."""
    page = "<body><article><div class=a><b>Acme weekly</b></div><h1>T{0} of {1}</h1><p>story {0} told {1} times</p><div class=b><p>Call us now</p></div></article></body>"
    pages = [(i, f"http://h{i % 3}.example/{i}", page.format(i, i * i)) for i in range(60)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in style_tree.extracted(frame).collect()}
    without = {i: style_tree.extract(html, {}) for i, _, html in pages}
    assert all(got[i] == f"T{i} of {i * i}\nstory {i} told {i * i} times" for i in got)
    assert sum(got[i] != without[i] for i in got) == 60


def test_importance_by_definition(spark):
    rng = np.random.default_rng(2)
    texts = ["one", "two", "three", "four"]
    pages = [(f"<body><div class=t>{texts[rng.integers(0, 4)]}</div><p>same</p><p>{i}</p>{'<ul><li>x</ul>' * int(rng.integers(0, 2))}</body>") for i in range(40)]
    frame = spark.createDataFrame([(f"http://h/{i}", p) for i, p in enumerate(pages)], "url string, html string")
    found = {n.path: (n.texts, n.children) for r in style_tree.importance(frame).collect() for n in r.nodes}
    seen = {}
    for p in pages:
        once = set()
        for path, children, text in style_tree.nodes(style_tree.main_content(style_tree.parse(p))):
            node = seen.setdefault(style_tree.signed(path), {"m": 0, "t": Counter(), "s": Counter()})
            node["m"] += path not in once
            once.add(path)
            node["t"][text] += bool(text)
            node["s"][children] += bool(children)
    for path, node in seen.items():
        if node["m"] >= style_tree.PAGES:
            for value, counts in zip(found[path], (node["t"], node["s"])):
                shares = np.array([n for n in counts.values() if n], float)
                if not len(shares):
                    assert value is None
                else:
                    shares /= shares.sum()
                    assert value == pytest.approx(min(1, -(shares * np.log(shares)).sum() / np.log(node["m"])), abs=1e-9)
        else:
            assert path not in found


# --- 9: exact dedup


def test_rounds_merge_runs_in_order(spark):
    docs = spark.createDataFrame([(i, f"text {i % 37}") for i in range(300)], "doc_id long, text string").repartition(9)
    rows = exact_dedup.digests(docs)
    own = rows.groupBy("run", *exact_dedup.KEY).agg(F.max(F.struct("doc_id", "row")).alias("winner"), F.count(F.lit(1)).alias("group_size"))
    both = exact_dedup.merged(own.where("run % 2 = 0").withColumn("run", F.lit(0)), own.where("run % 2 = 1").withColumn("run", F.lit(0)))
    plan = both._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "FullOuter" in plan and "Python" not in plan
    stored = exact_dedup.merge_round(own, 2)
    for part in stored.withColumn("p", F.input_file_name()).groupBy("p").agg(F.collect_list(F.struct("run", *exact_dedup.KEY)).alias("found")).collect():
        keys = [(r.run, bytes(r.digest), r.second, r.n_bytes) for r in part.found]
        assert keys == sorted(keys)
    assert stored.agg(F.sum("group_size")).first()[0] == 300
    merged = exact_dedup.classes(rows, 2).collect()
    assert len(merged) == 37 and sum(r.group_size for r in merged) == 300
    assert {r.winner.doc_id for r in merged} == set(range(263, 300))
