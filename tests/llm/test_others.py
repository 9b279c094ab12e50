"""Operators on conversations, pages and embeddings, components, and the pipeline."""
import random
import zlib

import numpy as np
import pytest
from brute import least_labels, near_duplicate_labels, rule_counts

from barspark.llm import chat, embeddings, encoding, packing, rules, urls, weak
from barspark.llm.common import Scratch
from barspark.llm.components import components

SCHEMA = "conv_id long, turn long, role string, text string, pos int, run string"


def conversation(i, texts, first=0):
    return [(i, first + k, "user" if k % 2 == 0 else "assistant", t, 7, "x") for k, t in enumerate(texts)]


def rendered(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (str(r["conv_id"]), r["position"])):
        assert r["start"] == len(out.get(r["conv_id"], ""))
        out[r["conv_id"]] = out.get(r["conv_id"], "") + r["segment"]
    return out


def test_snapshots_collapse(spark):
    rows = (conversation(1, ["a", "b"]) + conversation(2, ["a", "b", "c"]) + conversation(3, ["a", "b", "c", "d"])
            + conversation(4, ["a", "x"]) + conversation(5, ["a", "b", "c", "d"]) + conversation(6, ["b"])
            + conversation(7, [None, "é🙂"]) + conversation(None, ["q"]) + conversation(9, ["a", "b"], first=5)
            + [(10, 0, None, "z", 1, "x"), (10, 0, None, "z", 1, "x"), (10, None, "user", "first", 1, "x")])
    got = rendered(chat.render(spark.createDataFrame(rows, SCHEMA)))
    assert set(got) == {3, 4, 6, 7, None, 10}
    assert got[3] == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in zip(["user", "assistant"] * 2, "abcd"))
    assert got[7].startswith("<|im_start|>user\n<|im_end|>\n")
    assert got[10].startswith("<|im_start|>user\nfirst") and got[10].count("unknown\nz") == 1
    assert chat.render(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_conversations_are_split_into_runs(spark):
    texts = [f"t{k}" for k in range(700)]
    rows = conversation(1, texts) + conversation(2, texts[:650]) + conversation(3, texts[:650] + ["other"])
    got = rendered(chat.render(spark.createDataFrame(rows, SCHEMA)))
    assert set(got) == {1, 3} and got[1].count("<|im_start|>") == 700


@pytest.mark.parametrize("number", [None, 7])
def test_many_turns_of_one_number_are_split_by_rank(spark, number):
    """Rows without conv_id and with equal or null turns are one conversation, cut into runs all the same."""
    rows = [(None, number, "user", f"text {k}", 1, "x") for k in range(3000)] + conversation(5, ["a", "b"])
    df = spark.createDataFrame(rows, SCHEMA)
    prefixes = chat.prefix_hashes(chat.turns_of(df), Scratch(spark, "equal-turns"), "p")
    runs = [r["count"] for r in prefixes.filter("conv_id IS NULL").groupBy("run").count().collect()]
    assert sum(runs) == 3000 and len(runs) > 6 and max(runs) <= 2 * chat.RUN
    out = chat.render(df).persist()
    assert rendered(out)[5].count("<|im_start|>") == 2
    found = sorted(out.filter("conv_id IS NULL").collect(), key=lambda r: r["position"])
    assert [r["position"] for r in found] == list(range(1, 3001)) and {r["n_turns"] for r in found} == {3000}
    assert sorted(r["segment"] for r in found) == sorted(f"<|im_start|>user\ntext {k}<|im_end|>\n" for k in range(3000))
    # a snapshot of its first thousand turns collapses into it; one that goes on otherwise stays
    head = [(8, number, "user", r["segment"][17:-11], 1, "x") for r in found[:1000]]
    other = [(9, *r[1:]) for r in head] + [(9, 8, "user", "another end", 1, "x")]
    again = chat.render(spark.createDataFrame(rows + head + other, SCHEMA))
    assert {r["conv_id"] for r in again.select("conv_id").distinct().collect()} == {None, 5, 9}
    out.unpersist()


def test_rendered_files_hold_whole_texts_in_order(spark, tmp_path):
    df = spark.createDataFrame(conversation(1, ["a", "b", "c"]) + conversation(2, ["x"]), SCHEMA)
    chat.write_rendered(chat.render(df), str(tmp_path / "out"))
    rows = [(r["conv_id"], r["position"]) for r in spark.read.parquet(str(tmp_path / "out")).coalesce(1).collect()]
    assert rows == [(1, 1), (1, 2), (1, 3), (2, 1)]


def test_urls_rules_and_parts(spark):
    cases = [("https://A.B.Example.NET/en/x?y#z", "a.b.example.net", "/en/x", "example.net/en/", "allow"),
             ("http://example.net/de/", "example.net", "/de/", "net/", "block"), ("http://badexample.net", "badexample.net", "", None, "allow"),
             ("x://net/", "net", "/", "net/", "block"), ("ftp://q.example.com/de/1", "q.example.com", "/de/1", "example.com/de/", "block"),
             ("//example.net/en/", "", "", None, "allow"), (None, "", "", None, "allow"), ("a://b://net/x", "b:", "//net/x", None, "allow"),
             ("http://h.org?x=/fr/", "h.org", "", None, "allow"), ("http://h.org/fr/", "h.org", "/fr/", "org/fr/", "allow"),
             ("http://É.org/", "É.org", "/", None, "allow"), ("http://k.org/a\nb", "k.org", "/a\nb", None, "allow"), ("", "", "", None, "allow")]
    pages = spark.createDataFrame([(k, c[0], None, "x", 1.0) for k, c in enumerate(cases)],
                                  "page_id long, url string, html string, host string, trust double")
    got = {r["page_id"]: r for r in urls.judge(pages).collect()}
    for k, (_, host, path, rule, verdict) in enumerate(cases):
        r = got[k]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict), cases[k]
    assert urls.judge(pages.limit(0)).count() == 0


def test_trust_and_distrust_against_power_iteration(spark):
    r = random.Random(4)
    names = [f"s{k}.example.net" for k in range(3)] + [f"b{k}.com" for k in range(8)] + ["bad.net", "worse.net"]
    pages, edges = [], []
    for k, host in enumerate(names):
        path = "/en/" if host.startswith("s") else "/p/"
        out = ["bad.net"] * 3 if host == "b0.com" else r.sample([n for n in names if n != "b0.com"], 3)
        html = "".join(f'<a HREF="http://{x.upper() if i else x}/q?a">x</a>' for i, x in enumerate(out)) + '<a href="/own">y</a>'
        pages.append((k, f"http://{host}{path}", html))
        edges += [(host, x) for x in out if x != host]
    t = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {x["host"]: x for x in urls.judge(t, threshold=0.2).collect()}
    at = {n: i for i, n in enumerate(names)}
    m = np.zeros((len(names), len(names)))
    for a, b in edges:
        m[at[a], at[b]] += 1
    seed = {"trust": np.array([n.startswith("s") for n in names], float),
            "distrust": np.array([n in ("bad.net", "worse.net") for n in names], float)}
    for kind, links in (("trust", m), ("distrust", m.T)):
        share = links / np.maximum(links.sum(axis=1, keepdims=True), 1)
        score = base = 0.15 * seed[kind]
        for _ in range(urls.ROUNDS):
            score = base + 0.85 * share.T @ score
        np.testing.assert_allclose([got[n][kind] for n in names], score, atol=1e-9)
    for n in names:
        if n.endswith(".com"):
            bad = got[n]["distrust"] > got[n]["trust"] and got[n]["distrust"] > 0.03
            assert got[n]["verdict"] == ("block" if bad else "allow")
    assert got["b0.com"]["verdict"] == "block"


def brute_links(vectors):
    ok = {i: (np.array(v, float), label) for i, v, label in vectors
          if i is not None and v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links, pairs = {i: 0 for i, _, _ in vectors}, []
    ids = sorted(ok)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            (x, p), (y, q) = ok[a], ok[b]
            if p == q and len(x) == len(y) and x @ y >= 0.98 * np.sqrt(x @ x) * np.sqrt(y @ y):
                links[a] += 1
                links[b] += 1
                pairs.append((a, b))
    return links, least_labels([i for i in links if i is not None], pairs)


@pytest.mark.parametrize("block", [16, 512])
def test_embeddings_against_brute_force(spark, block):
    r = np.random.default_rng(7)
    vectors, k = [], 0
    for c in range(14):
        centre = r.standard_normal(24)
        for _ in range(12 if c else 60):
            v = centre + 0.09 * r.standard_normal(24) * np.linalg.norm(centre) / np.sqrt(24) * r.random()
            vectors.append((k, [float(x) for x in np.float32(v)], c % 3))
            k += 1
    vectors += [(1000 + j, vectors[0][1], 0) for j in range(5)] + [(2000, vectors[0][1], None), (2001, None, 0), (2002, [0.0] * 24, 0),
                (2003, [float("nan")] * 24, 0), (2004, [1.0, None], 0), (2005, [], 0), (2006, [1.0, 2.0], 0), (2007, [2.0, 4.0], 0),
                (2008, [float("inf")] * 24, 0), (2009, [2 * x for x in vectors[0][1]], 0)]
    df = spark.createDataFrame([(*v, 1, "x") for v in vectors], "vec_id long, embedding array<double>, label int, node int, cell string")
    got = {x["vec_id"]: x for x in embeddings.near_duplicates(df, block=block).collect()}
    links, label = brute_links(vectors)
    assert {i: x["n_links"] for i, x in got.items()} == links
    assert {i: x["component_id"] for i, x in got.items()} == label
    assert all(x["kept"] == (i == x["component_id"]) for i, x in got.items())
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [2000, 65_536, 70_000])
def test_codes_retrieve_alike_at_every_size(n):
    """Links of a query set by brute force, all retrieved by the tables: pairs at 0.98 to 0.981."""
    r = np.random.default_rng(3)
    x = embeddings.unit(r.standard_normal((n // 2, 64)))
    turn = embeddings.unit((lambda y: y - (y * x).sum(axis=1, keepdims=True) * x)(r.standard_normal(x.shape)))
    cosine = r.uniform(0.9801, 0.981, (n // 2, 1))
    x = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * turn])
    queries = np.arange(0, n // 2, max(1, n // 2 // 4000))
    links = [(q, j) for at in np.array_split(queries, 8) for q, j in zip(*np.nonzero(x[at] @ x.T >= embeddings.COSINE)) for q in [at[q]] if q != j]
    assert len(links) >= len(queries)
    bounds = embeddings.chunk_bounds(64, n)
    codes = embeddings.code_count(bounds, embeddings.COSINE)
    code = embeddings.codes_of(x, *embeddings.rotations(x[:embeddings.SAMPLE], codes))
    i, j = np.array(links).T
    diff = code[i] ^ code[j]
    found = np.zeros(len(i), bool)
    for lo, hi in bounds:
        part = (diff >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
        found |= (np.bitwise_count(part) <= embeddings.RADIUS).any(axis=1)
    assert found.all(), f"{(~found).sum()} of {len(found)} missed"


def test_embeddings_without_id_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0], 0), (5, [1.0, 2.0], 0), (5, [1.0, 2.0], 0)], "vec_id long, embedding array<double>, label int")
    got = sorted(((x["vec_id"] is None, x["n_links"], x["component_id"], x["kept"]) for x in embeddings.near_duplicates(df).collect()), key=str)
    assert got == sorted([(True, 0, None, True), (False, 1, 5, True), (False, 1, 5, True)], key=str)


def test_components_against_union_find(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(r.randint(200, 300), r.randint(200, 300)) for _ in range(70)] + [(400, 400 + k) for k in range(1, 40)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {x["node"]: x["component"] for x in components(df, Scratch(spark, "cc")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == least_labels({n for e in real for n in e}, real)
    assert components(df.limit(0), Scratch(spark, "cc")).count() == 0


def test_pipeline_against_brute_force(spark, sf):
    import corpus_pipeline as p
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    # 1: the same scorer, document by document
    first = {r["row"]["doc_id"] for r in weak.score(docs, weak.train(docs), ["doc_id"]).collect() if r["score"] >= weak.THRESHOLD}
    # 2: base rules and shrunk host rates over what is left
    failed = {}
    for i in first:
        c = rule_counts(text[i])
        failed[i] = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
    hosts = {}
    for i in first:
        n, x = hosts.get(source[i], (0, 0))
        hosts[source[i]] = (n + 1, x + failed[i])
    m = sum(x for _, x in hosts.values()) / len(first)
    v = np.var([x / n for n, x in hosts.values()])
    s = max(1.0, m * (1 - m) / v - 1) if v > 0 else 1.0
    second = {i for i in first if not failed[i] and (hosts[source[i]][1] + m * s) / (hosts[source[i]][0] + s) <= rules.MAX_HOST_RATE}
    # 3: all pairs of full shingle sets
    labels, _ = near_duplicate_labels({i: text[i] for i in second})
    third = {i for i in second if labels[i] == i}
    # 4: the tokenizer itself
    tokenizer = Tokenizer.from_file(encoding.vocabulary_path())
    want = set()
    for i in third:
        ids, start = tokenizer.encode(text[i], add_special_tokens=False).ids + [1], 0
        for size in packing.cuts(len(ids), 2048):
            want.add((i, start, size, zlib.crc32(np.array(ids[start:start + size], "<u4").tobytes()), len(ids)))
            start += size
    got = p.run(spark, sf).collect()
    assert {(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got} == want
    assert len(got) == len(want) == len({r["sequence_id"] for r in got})
    assert 0 < len(third) < len(second) < len(text)


def test_pipeline_returns_the_packed_ids(spark, edge_docs):
    import corpus_pipeline as p
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(encoding.vocabulary_path())
    docs = edge_docs.filter("doc_id IN (2, 4, 9)")
    got = p.STAGES[-1][1](spark, docs, "").collect()
    assert all(len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    for d in docs.collect():
        own = sorted((r for r in got if r["doc_id"] == d["doc_id"]), key=lambda r: r["start"])
        assert [i for r in own for i in r["ids"]] == tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1]


def test_pipeline_edges(spark, edge_docs, no_docs):
    import corpus_pipeline as p
    for docs, some in ((edge_docs, True), (no_docs, False)):
        scratch = Scratch(spark, "edges")
        for k, (_, stage) in enumerate(p.STAGES):
            before = docs
            docs = scratch.save(stage(spark, docs, ""), f"s{k}")
            if k < len(p.STAGES) - 1:
                assert docs.columns == before.columns
                ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert sorted(map(str, ids)) == (["4", "5", "None"] if some else [])
        assert (docs.count() > 0) == some
