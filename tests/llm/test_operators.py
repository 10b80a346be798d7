"""The dealt operators against brute force, and on awkward tables."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from almoner.llm import bpe, exact_dedup, fingerprints, license_rules, license_scan, mixing, ngram_join, perspectives, queries, style_tree, token_files, toxicity
from almoner.llm.common import table
from tests.compare import connect, differences
from tests.llm import brute

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = "one two three four five six seven eight nine ten " * 3000
BASE = " ".join(f"w{i}" for i in range(60))
NEAR = BASE.replace("w30", "other")
TEXTS = [
    None, "", "   \n\t ", "Word", "word", "four words are few", "four words are few", BASE, BASE.upper(), NEAR, NEAR + " tail", LONG,
    "  lead  and double  blanks \n\nlines\x85 don't we'll été 日本語 \U0001F600 <|endoftext|> x.\r\n", "CC BY CC BY 4.0; all rights reserved", "General Public License v3.0 or later",
]
#: Column names that operators could want for themselves.
CLASH = ["row", "text_", "lang_", "score", "size", "shard", "position", "bucket", "vertex", "key", "ids", "n_tokens", "flagged"]


@pytest.fixture(scope="module")
def rows():
    found = [(i, t, "en" if i % 2 else None, ["b", "a", None][i % 3], len(t or "")) for i, t in enumerate(TEXTS)]
    found += [(None, "no id", "en", "a", 5), (None, None, None, None, None), (7, BASE, "en", "b", len(BASE)), (3, "Word", "en", "a", 4)]
    return found


@pytest.fixture(scope="module")
def docs(spark, rows):
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return made.withColumns({c: F.lit("x") for c in CLASH}).repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, i % 2) for i in range(3)] + [(99, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def documents(spark, folder):
    return table(spark, folder, "documents")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(name, spark, folder):
    assert differences(queries.QUERIES[name](spark, folder), connect(folder), queries.ORACLE[name]) == []


# --- 1: token files


def expected_ids(texts: list[str]) -> list[list[int]]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    return [e.ids + [2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def checksum(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_query(spark, folder, texts):
    got = {r.doc_id: r for r in queries.op1_token_files(spark, folder).collect()}
    start = 0
    for doc, ids in zip(sorted(texts), expected_ids([texts[d] for d in sorted(texts)])):
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), checksum(ids))
        start += len(ids)
    assert len(got) == len(texts)


def test_token_files_of_awkward_rows(docs, rows, empty):
    got = token_files.round_trip(docs, JSON, 2).collect()
    wanted = Counter((r[0], len(ids), checksum(ids)) for r, ids in zip(rows, expected_ids([r[1] or "" for r in rows])))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == wanted
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda o: (o[0], o[1] or 0))
    assert token_files.round_trip(empty, JSON, 2).collect() == []


def test_sequences_are_read_in_place(tmp_path):
    writer = token_files.ShardWriter(str(tmp_path), 0, "<u2", 8, 2)
    data = [np.arange(n, dtype="<u2") for n in (3, 0, 5000, 7)]
    writer.add([1, 2, 3, 4], [d.tobytes() for d in data])
    writer.close()
    shard = token_files.Shard(str(tmp_path), writer.name)
    flat = np.concatenate([np.append(d, 2) for d in data])
    for k in (0, 1, 255, 256, writer.n_sequences - 1):
        cut = flat[8 * k : 8 * k + 8]
        assert shard.sequence(k)[: len(cut)].tolist() == cut.tolist()
        assert shard.mask(k).to_pylist() == [i < len(cut) for i in range(8)]
    assert not shard.sequence(3).flags.owndata
    assert [np.concatenate(p).tolist() for _, _, p in shard.documents()] == [[*d, 2] for d in data]


# --- 2: toxicity


def test_toxicity_learns_from_training_rows_only(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r.doc_id: r for r in toxicity.toxic_scores(docs, labels).collect()}
    b = {r.doc_id: r for r in toxicity.toxic_scores(docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy")}), flipped).collect()}
    assert {d: r.score for d, r in a.items()} == {d: r.score for d, r in b.items()}
    for d, r in a.items():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1)


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    scores = toxicity.toxic_scores(table(spark, folder, "documents"), table(spark, folder, "labels")).filter("held_out")
    found = [(r.toxic, r.predicted) for r in scores.join(table(spark, folder, "labels"), "doc_id").collect()]
    right = sum(t and p for t, p in found)
    assert right / max(1, sum(p for _, p in found)) >= 0.95
    assert right / sum(t for t, _ in found) >= 0.75


def test_toxicity_of_awkward_rows(docs, labels, empty):
    got = toxicity.toxic_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(r.score is not None for r in got)
    assert toxicity.toxic_scores(docs, labels.filter("false")).select("score").distinct().collect()[0][0] == 0.5
    assert toxicity.toxic_scores(empty, labels).collect() == []
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == docs.count()


# --- 3: mixing


def test_mix_reaches_targets(spark, folder, documents, texts):
    got = queries.op3_source_mix(spark, folder).collect()
    assert sorted(got) == sorted(queries.op3_source_mix(spark, folder).collect())
    source = {r.doc_id: r.source for r in documents.select("doc_id", "source").collect()}
    sums = defaultdict(lambda: [0, 0])
    for r in got:
        assert r.size == len(brute.words(texts[r.doc_id])) and 0 <= r.taken <= 2 * r.size
        sums[source[r.doc_id]][0] += r.size
        sums[source[r.doc_id]][1] += r.taken
    names = sorted(sums, key=lambda s: s.encode())
    wanted = dict(zip(names, water_filled([sums[n][0] for n in names])))
    for r in got:
        assert r.source_size == sums[source[r.doc_id]][0]
        assert r.target == pytest.approx(wanted[source[r.doc_id]], rel=1e-9)
    assert all(abs(sums[n][1] - wanted[n]) <= 1 for n in names)


def water_filled(sizes: list[int]) -> list[float]:
    """Targets by bisection on the words per weight."""
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    low, high = 0.0, 2.0 * sum(sizes) + 1
    for _ in range(200):
        middle = (low + high) / 2
        total = sum(min(2 * n, w * middle) for n, w in zip(sizes, weights))
        low, high = (middle, high) if total < 1.5 * sum(sizes) else (low, middle)
    return [min(2.0 * n, w * high) for n, w in zip(sizes, weights)]


def test_mix_pieces_are_the_documents(spark, docs, rows, empty):
    got = mixing.taken_words(docs).collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r.size for r in got)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    found = mixed.collect()
    sources = {(r[0], r[1]) for r in rows}
    assert all(any(m.doc_id == d and t and m.text in t for d, t in sources) and m.n_chars == len(m.text) for m in found)
    assert sum(len(brute.words(m.text)) for m in found) == sum(r.taken for r in got)
    assert mixing.taken_words(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


def test_tree_deals_exact_quotas():
    quotas = np.array([7, 0, 1000, 31], np.int64)
    shares = [mixing.shard_shares(quotas, 13, s, 4) for s in range(13)]
    assert (sum(n for _, n in shares) == quotas).all()
    sizes = [int(n.sum()) for _, n in shares]
    assert max(sizes) - min(sizes) <= 1
    for (first, n), (after, _) in zip(shares, shares[1:]):
        assert (first + n == after).all()


def test_permutation_and_quota():
    for n in (1, 2, 3, 100, 1025):
        assert sorted(mixing.permuted(np.arange(n), n, (1, 2)).tolist()) == list(range(n))
    for size in (1, 9, 10, 11, 95, 100):
        for target in range(2 * size + 1):
            q = mixing.Quota(3, size, float(target), 10, 5)
            ranks, words = zip(*[q.take(np.arange(q.blocks), copy) for copy in range(2)])
            assert sum(int(w.sum()) for w in words) == target
            taken = np.concatenate(ranks)[np.concatenate(words) > 0]
            assert sorted(taken.tolist()) == list(range(q.taken))


# --- 4: extraction


def test_extraction_of_generated_pages(spark, folder):
    got = {r.page_id: r for r in queries.op4_style_tree(spark, folder).collect()}
    pages = table(spark, folder, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == brute.article_text(p.html)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_extraction_of_awkward_pages(spark):
    page = "<body><header>H</header><div class='cookie-notice'>C</div><div id=content><h1>T &amp; t</h1><p>one\n two<p>three<br>four<ul><li>a<li>b</ul><form>F</form></div><aside>S</aside><div id=comments>R</div></body>"
    nested = "<div>" * 3000 + "deep" + "</div>" * 3000
    made = [
        (1, "http://a.example/1", page),
        (None, None, None),
        (3, "x", ""),
        (3, "x", ""),
        (4, "http://a.example/2", "<p>no end <b>bold <script>x<p></script>&eacute;&#233 <!-- c"),
        (5, "//b", nested),
        (6, "http://a.example/3", "<article><header><h1>Head</h1></header><p>Text</p><section class=comments>no</section></article><main>other</main>"),
    ]
    pages = spark.createDataFrame(made, "page_id long, url string, html string").withColumns({"h": F.lit(1), "host": F.lit(1), "nodes": F.lit(1)})
    got = Counter((r.page_id, r.text, r.n_chars) for r in style_tree.extracted(pages).collect())
    texts = {1: "T & t\none two\nthree four\na\nb", None: "", 3: "", 4: "no end bold éé", 5: "deep", 6: "Head\nText"}
    assert got == Counter((i, texts[i], len(texts[i])) for i, _, _ in made)
    assert style_tree.extracted(pages.filter("false")).collect() == []


def test_template_parts_of_a_host_go(spark):
    body = "<body><div class=top>Shop of things</div><div class=x><p>{}</p></div><div class=low>Call us</div></body>"
    pages = [(i, f"http://s.example/{i}", body.format(f"story number {i} is told")) for i in range(12)]
    pages += [(99, "http://lone.example/", body.format("alone"))]
    got = {r.page_id: r.text for r in style_tree.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"story number {i} is told" for i in range(12))
    assert got[99] == "Shop of things\nalone\nCall us"


# --- 5: Jaccard join


def test_join_against_brute_force(spark, folder, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op5_ngram_join(spark, folder).collect()}
    assert got == dict(zip(texts, brute.components(list(texts.items()))))


def test_join_of_awkward_rows(docs, rows, empty):
    wanted = Counter((r[0], n, c if n else r[0]) for r, (n, c) in zip(rows, brute.components([r[:2] for r in rows])))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.joined(docs).collect()) == wanted
    assert ngram_join.joined(empty).collect() == []
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = Counter(tuple(sorted(brute.shingles(r.text))) for r in kept.collect() if brute.shingles(r.text))
    assert max(groups.values()) == 1


@pytest.mark.parametrize("cell", [4, 2048])
def test_join_of_a_chain_of_near_copies_in_split_cells(spark, cell):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(80)]
    made = []
    for i in range(40):
        copy = list(base)
        for at in rng.integers(0, 80, int(rng.integers(0, 4))):
            copy[at] = f"x{rng.integers(0, 50)}"
        made.append((i, " ".join(copy)))
    made += [(100 + i, " ".join(base[:30] + [f"y{i}z{j}" for j in range(60)])) for i in range(30)]
    got = ngram_join.joined(spark.createDataFrame(made, "doc_id long, text string"), cell=cell).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == dict(zip([d for d, _ in made], brute.components(made)))


# --- 6: license scan


def test_scan_against_brute_force(spark, documents, docs, rows, empty):
    rules = license_rules.rules()
    assert len(rules) > 300
    for frame in (documents, docs):
        known = {(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()}
        wanted = Counter()
        for d, t in known:
            facts, spans = brute.license_facts(t, license_scan.PHRASES, rules, license_rules.CONFIDENCE)
            wanted[d, *facts, tuple(spans)] += 1
        got = license_scan.licenses(frame.dropDuplicates(["doc_id", "text"])).collect()
        assert Counter((*r[:-1], tuple(sorted(tuple(x[:3]) for x in r.detections))) for r in got) == wanted
    assert license_scan.licenses(empty).collect() == []


# --- 7: fingerprints


def test_fingerprints_against_brute_force(spark, folder, texts):
    got = {r.doc_id: r for r in queries.op7_fingerprints(spark, folder).collect()}
    order, by_text, errors = sorted(texts, reverse=True), {}, []
    for k, d in enumerate(order):
        text, after = texts[d], texts[order[(k + 1) % len(order)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert got[d].n_chars == len(text) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, got[d].fingerprint) == got[d].fingerprint
        errors.append(got[d].near_edited - brute.jaccard(brute.shingles(text), brute.shingles(edited)))
        assert abs(got[d].near_next - brute.jaccard(brute.shingles(text), brute.shingles(after))) < 0.25
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_fingerprints_of_awkward_rows(spark, docs, rows, empty):
    got = fingerprints.edited(docs).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((r[0], len(r[1] or "")) for r in rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert all((r.fingerprint == "") == (r.doc_id in (0, 1, 2) or r.n_chars == 0) for r in got)
    one = fingerprints.edited(docs.filter("doc_id = 11")).collect()[0]
    assert one.near_next == 1.0
    assert fingerprints.edited(empty).collect() == []


# --- 8: byte-level BPE


def test_bpe_against_the_library(spark, folder, texts):
    import tiktoken

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in queries.op8_byte_bpe(spark, folder).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    encoder, decoder = bpe.coders(RANKS, public_tokenizers.PATTERN)
    rng, tokens = np.random.default_rng(1), list(ranks)
    alphabet = list("ab  \n\t 's1é日　\x85\U0001F600'll .\x1c")
    made = ["".join(rng.choice(alphabet, rng.integers(0, 30))) for _ in range(3000)]
    made += [b"".join(tokens[i] for i in rng.integers(0, len(tokens), 5)).decode("utf-8", "ignore") for _ in range(1000)]
    for text in made + [t or "" for t in TEXTS]:
        ids = encoder.encode(text)
        assert ids == library.encode_ordinary(text)
        assert decoder.decode(ids) == text
    assert decoder.decode([ranks[b"\xff"], ranks[b"a"], ranks[b"\xe6"]]) == "�a�"


def test_token_chunks_against_the_library():
    rng = np.random.default_rng(2)
    alphabet = [*"ab  \n\t 's1é日　\x85\U0001F600'll ..,,", "<|endoftext|>"]
    made = ["".join(rng.choice(alphabet, rng.integers(0, 30))) for _ in range(5000)] + [t or "" for t in TEXTS] + ["a <|endoftext|> b"]
    assert expected_ids(made)[-1] == [64, 220, 50256, 275, 2]
    got = token_files.Encoder(JSON, "<u2").encode(pa.array(made))
    assert [np.frombuffer(g, "<u2").tolist() + [2] for g in got] == expected_ids(made)


def test_tokens_come_after_bounded_lookahead():
    machine = bpe.coders(RANKS, public_tokenizers.PATTERN)[0].transducer
    longest = max(map(len, machine.ranks))
    piece, given = b"supercalifragilisticexpialidocious" * 20, 0
    read = []

    def reader():
        for byte in piece:
            read.append(byte)
            yield byte

    for token in machine.stream(reader()):
        given += len(machine.bytes_of[token])
        assert len(read) - given <= 2 * longest
    assert given == len(piece)


def test_bpe_of_awkward_rows(docs, rows, empty):
    got = bpe.transcoded(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, r.decoded) for r in got) == Counter((r[0], r[1] or "") for r in rows)
    coded = bpe.encoded(docs, RANKS, public_tokenizers.PATTERN)
    assert coded.count() == len(rows) and {"_ids", "_n_tokens"} < set(coded.columns)
    assert bpe.transcoded(empty, RANKS, public_tokenizers.PATTERN).collect() == []


# --- 9: exact dedup


@pytest.mark.parametrize("fan_in", [2, 8])
def test_exact_dedup_of_awkward_rows(docs, rows, empty, fan_in):
    got = exact_dedup.marked(exact_dedup.digests(docs), fan_in).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    wanted = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            wanted[i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == wanted
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.duplicates(empty).collect() == []
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


# --- 10: perspectives


def test_perspectives_of_awkward_turns(spark):
    made = [(1, 0, "system", "rules"), (1, 1, "ann", "hi"), (1, 2, "bob", "<|end|> yo"), (1, 3, None, None), (1, 3, "ann", "bye"), (1, 3, "ann", "bye"), (1, None, "bob", "early"), (2, 0, "system", "only"), (None, 5, "eve", "lone")]
    turns = spark.createDataFrame(made, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("speaker", "block", "n", "c", "start")})
    for size in (1, 64):
        got = defaultdict(list)
        for r in perspectives.perspectives(turns, size).collect():
            got[r.conv_id, r.speaker].append(r)
        assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "eve")}
        ann = sorted(got[1, "ann"], key=lambda r: r.position)
        whole = "".join(r.segment for r in ann)
        assert whole == (
            "<|user name=bob|>\nearly<|end|>\n<|system|>\nrules<|end|>\n<|assistant|>\nhi<|end|>\n<|user name=bob|>\n< |end|> yo<|end|>\n"
            "<|assistant|>\nbye<|end|>\n<|assistant|>\nbye<|end|>\n<|user name=unknown|>\n<|end|>\n"
        )
        assert [whole[r.train_start : r.train_end] for r in ann if r.train_start is not None] == ["hi<|end|>\n", "bye<|end|>\n", "bye<|end|>\n"]
        assert all(whole[r.start : r.start + r.n_chars] == r.segment for r in ann)
    assert perspectives.perspectives(turns.filter("false")).collect() == []
