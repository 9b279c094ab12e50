"""Operators on documents: against brute force, and on edge cases."""
import zlib

import numpy as np
import pytest
from brute import near_duplicate_labels, rule_counts
from conftest import prose
from pyspark.sql import functions as F

from barspark.llm import encoding, lm, minhash, nbest, packing, rules, toxicity, weak
from barspark.llm.common import Scratch


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(encoding.vocabulary_path())


def test_rule_counts_against_brute_force(edge_docs):
    small = edge_docs.filter("doc_id IS NULL OR doc_id != 4")
    for r in rows(rules.rule_counts(small, ["doc_id", "text"])):
        assert {c: r[c] for c in rules.COUNTS} == rule_counts(r["row"]["text"]), r["row"]["doc_id"]


def test_rules_judge_every_row(edge_docs, no_docs):
    got = rows(rules.judge(edge_docs))
    assert len(got) == 14
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert kept == {4, 5, 6, 7, None}
    assert next(r for r in got if r["doc_id"] == 12)["base_failed"]      # every word is repeated
    assert rows(rules.judge(no_docs)) == []
    assert rules.passed(edge_docs).columns == edge_docs.columns
    assert rules.passed(edge_docs).count() == 6 and rules.passed(no_docs).count() == 0


def test_bad_host_is_rejected_and_shrunk(spark):
    bad = [(k, "one two" if k < 18 else prose(k, 60), "bad") for k in range(20)]
    good = [(100 + k, prose(k, 60), f"h{k % 4}") for k in range(80)]
    tiny = [(300, "one", "tiny")]
    got = {r["doc_id"]: r for r in rows(rules.judge(spark.createDataFrame(bad + good + tiny, "doc_id long, text string, source string")))}
    assert not got[19]["kept"] and got[19]["host_rate"] > 0.5 and not got[19]["base_failed"]
    assert 0.1 < got[300]["host_rate"] < 1.0
    assert all(got[100 + k]["kept"] for k in range(80))


def test_minhash_against_brute_force(spark):
    texts, k = {}, 0
    for family in range(12):
        words = prose(family, 150).split()
        for edits in (0, 0, 1, 2, 3, 4, 5, 8, 12):
            own = list(words)
            for e in range(edits):
                own[(7 + 13 * e * (family + 1)) % 150] = f"edit{family}x{e}y{k % 3}"
            texts[k] = " ".join(own)
            k += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels, sizes = near_duplicate_labels(texts)
    for block in (2, 512):
        got = rows(minhash.near_duplicates(docs, block=block))
        assert {r["doc_id"]: r["component_id"] for r in got} == labels
        assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(set(labels.values())) < len(texts)


def test_minhash_chain_links_through_members(spark):
    """Each text is close to the next only: one component, found beyond the stars."""
    words = [f"w{i}" for i in range(260)]
    texts = {i: " ".join(words[10 * i:10 * i + 150]) for i in range(9)}
    labels, _ = near_duplicate_labels(texts)
    got = rows(minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    assert {r["doc_id"]: r["component_id"] for r in got} == labels and set(labels.values()) == {0}


def test_minhash_pair_leaves_from_the_first_band_it_really_shares(spark):
    """1 and 2 are near; every band they share has 0, which is near neither, as its head. In band
    0 only the low 8 bits of their minima agree, so they meet in no cell of that band."""
    def edited(edits):
        words = [f"w{i}" for i in range(150)]
        for at, word in edits.items():
            words[at] = word
        return " ".join(words)
    texts = {0: edited({20: "z1", 30: "q1", 110: "r1", 130: "s1"}), 1: edited({}), 2: edited({6: "v21846", 8: "y21846"})}
    labels, _ = near_duplicate_labels(texts)
    assert labels == {0: 0, 1: 1, 2: 1}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sig = {r["doc_id"]: r for r in minhash.signatures(docs, rows=1, bands=6).collect()}
    assert sig[1]["sketch"][0] == sig[2]["sketch"][0] and sig[1]["bands"][0] != sig[2]["bands"][0]
    assert [sig[1]["bands"][k] == sig[2]["bands"][k] for k in range(6)] == [False, True, True, True, True, False]
    got = rows(minhash.near_duplicates(docs, rows=1, bands=6))
    assert {r["doc_id"]: r["component_id"] for r in got} == labels


def test_minhash_edges(edge_docs, no_docs):
    got = rows(minhash.near_duplicates(edge_docs))
    assert len(got) == 14
    of = {r["doc_id"]: r for r in got}
    assert [of[k]["component_id"] for k in (5, 6, 7)] == [5, 5, 5]
    assert [of[k]["n_shingles"] for k in (1, 2, 3, 8, 10)] == [0, 0, 1, 1, 0]
    assert of[None]["component_id"] is None and of[None]["kept"]
    assert all(of[k]["component_id"] == k for k in (1, 2, 3, 4, 8, 9, 10, 11, 12))
    kept = minhash.deduplicated(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, None, 8, 9, 10, 11, 12]))
    assert minhash.near_duplicates(no_docs).count() == 0


def test_minhash_rows_of_one_id_follow_their_own_text(spark):
    """doc_id 5 names a copy of 3's text, a text of its own, and a near copy of that; 6 and 7 are
    near copies of its texts."""
    a, b = prose(21, 120), prose(22, 120)
    other = b.replace(b.split()[60], "ocean", 1)
    texts = [(3, a), (5, a), (5, b), (5, other), (6, a + " end"), (7, b + " end"), (8, prose(23, 120)), (5, b)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = minhash.judged(docs).join(docs.select("doc_id", "text", minhash.text_key().alias("text_key")).distinct(), ["doc_id", "text_key"])
    component = {(r["doc_id"], r["text"]): r["component_id"] for r in got.collect()}
    assert component == {(3, a): 3, (5, a): 3, (6, a + " end"): 3, (5, b): 5, (5, other): 5, (7, b + " end"): 5, (8, texts[6][1]): 8}
    kept = sorted((r["doc_id"], r["text"]) for r in minhash.deduplicated(docs).collect())
    assert [k for k, _ in kept] == [3, 5, 8] and kept[0][1] == a and kept[1][1] in (b, other)


def test_packing_round_trip(edge_docs, no_docs, tokenizer):
    got = rows(packing.pack(edge_docs))
    assert len({r["sequence_id"] for r in got}) == len(got)
    assert all(r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 and r["offset"] == 0 for r in got)
    assert all(r["sequence_id"] % 64 == r["bucket"] == r["length"].bit_length() - 1 for r in got)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    texts = {r["doc_id"]: r["text"] for r in edge_docs.collect()}
    for doc, text in texts.items():
        own = sorted((r for r in got if r["doc_id"] == doc), key=lambda r: r["start"])
        if doc == 5:
            own = own[::2]        # the repeated row
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert [i for r in own for i in r["ids"]] == want and own[0]["doc_tokens"] == len(want)
        lengths = [r["length"] for r in own]
        assert lengths == packing.cuts(len(want), 2048) and len(set(lengths) - {2048}) == len([x for x in lengths if x < 2048])
    assert packing.pack(no_docs).count() == 0


def test_encoder_equals_the_tokenizer(tokenizer):
    import random

    import pyarrow as pa
    r = random.Random(5)
    parts = ["a", "B", "É", "é", "ß", "Σ", "ς", "İ", "'s", "'T", "1", "½", ".", ",", "!", "%", " ", "  ", "\n", "\x1c", "\x85",
             "\u00a0", "e\u0301", " \u0301", "<|endoftext|>", "漢", "ق", "🙂", "_", "ª", "ﬁ", "the", "of", "\u3000", "×", "÷", "ÿ"]
    encode = encoding.WordEncoder(encoding.vocabulary_path(), 40)
    for _ in range(40):
        texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(50)]
        for lo, ids, at in encode.texts(pa.array(texts)):
            for k in range(len(at) - 1):
                assert ids[at[k]:at[k + 1]].tolist() == tokenizer.encode(texts[lo + k], add_special_tokens=False).ids


def n_best_scores(lattice, text):
    """The N largest scores of all segmentations, position by position."""
    word, best = " " + text, [[0.0]]
    for j in range(1, len(word) + 1):
        pieces = [i for i in range(max(0, j - lattice.width), j) if word[i:j] in lattice.score]
        ways = [(i, lattice.score[word[i:j]]) for i in pieces]
        if word[j - 1] not in lattice.score:
            ways.append((j - 1, len(word[j - 1].encode()) * lattice.byte_score))
        best.append(sorted((g + s for i, s in ways for g in best[i]), reverse=True)[:lattice.n])
    return best[-1]


def test_n_best_against_every_segmentation():
    import random
    r = random.Random(3)
    lattice = nbest.PieceLattice(encoding.vocabulary_path(nbest.MODEL), 5)
    for _ in range(150):
        text = "".join(r.choice(["a", "b", "he", "in", "é", "漢", " ", "\n", "the", "🙂", "▁", "."]) for _ in range(r.randint(1, 6)))
        got = next(lattice.segment([text]))
        np.testing.assert_allclose([s for s, _ in got], n_best_scores(lattice, text))
        assert all(lattice.decode(ids) == text for _, ids in got)
        assert len({ids for _, ids in got}) == len(got)


def test_n_best_of_words_without_spaces():
    import random
    r = random.Random(7)
    lattice = nbest.PieceLattice(encoding.vocabulary_path(nbest.MODEL), 4)
    han = [chr(0x4e00 + i) for i in range(2000)] + ["数据", "获取", "🙂", "é"]
    code = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    texts = ["".join(r.choices(han, k=k)) for k in (62, 63, 64, 111, 112, 700)]
    texts += ["".join(r.choices(code, k=k)) for k in (64, 500)]
    texts += ["a" * 64, "the" * 900, "x" + " " * 300 + "y", "a" * 130 + "漢字" * 90 + "international" * 30]
    texts += [texts[0] + "\n" + texts[5] + " " + texts[5], "".join(r.choices(code[:26], k=20_000))]
    for text, got in zip(texts, lattice.segment(texts)):
        np.testing.assert_allclose([s for s, _ in got], n_best_scores(lattice, text), rtol=1e-12)
        assert all(lattice.decode(ids) == text for _, ids in got) and len({ids for _, ids in got}) == len(got)
    assert max(map(len, lattice.index)) <= nbest.LONGEST and not lattice.long_paths
    assert len(lattice.words) == len(lattice.first) == len(lattice.index)


def test_n_best_searches_only_words_that_lose_least(monkeypatch):
    import random
    r = random.Random(11)
    lattice = nbest.PieceLattice(encoding.vocabulary_path(nbest.MODEL), 4)
    words = ["".join(r.choices("abcdefghinorst", k=r.randint(3, 11))) for _ in range(1500)]
    texts = [" ".join(r.choices(words, k=200)) for _ in range(12)]
    searched, search = [], lattice.search
    monkeypatch.setattr(lattice, "search", lambda words: searched.extend(words) or search(words))
    got = list(lattice.segment(texts))
    known = lattice.words
    ties = sum(np.diff(scores)[0] > -1e-6 for scores in search(known)[0])
    assert len(searched) == len(set(searched)) <= 3 * len(texts) + ties < len(known) / 2
    for text, found in zip(texts, got):
        np.testing.assert_allclose([s for s, _ in found], n_best_scores(lattice, text), rtol=1e-12)
        assert all(lattice.decode(ids) == text for _, ids in found) and len({ids for _, ids in found}) == 4
    assert list(lattice.segment(texts)) == got and list(lattice.segment([])) == []


def test_n_best_passes_find_what_the_search_finds():
    import random
    r = random.Random(12)
    lattice = nbest.PieceLattice(encoding.vocabulary_path(nbest.MODEL), 4)
    parts = ["a", "e", "the", "ing", "é", "漢", "🙂", "-", "=", "s", "XY", "0", "\x00"]
    words = sorted({" " * r.randint(0, 2) + "".join(r.choices(parts, k=r.randint(1, 12))) for _ in range(600)}) + ["\n", "q" * 63]
    scores, masks, ids = lattice.search(words)
    best, mask, gap, best_ids = lattice.best_two(words)
    np.testing.assert_allclose(gap, scores[:, 0] - scores[:, 1], atol=1e-9)
    sure = gap > nbest.NEAR
    assert (best[sure] == scores[sure, 0]).all() and (mask[sure] == masks[sure, 0]).all() and 0 < sure.sum() < len(words)
    assert [a for a, s in zip(best_ids, sure) if s] == [b for b, s in zip(ids, sure) if s]
    for n in (1, 2):
        fewer = nbest.PieceLattice(encoding.vocabulary_path(nbest.MODEL), n)
        texts = ["".join(words[k::20])[1:] for k in range(20)]
        for text, got in zip(texts, fewer.segment(texts)):
            np.testing.assert_allclose([s for s, _ in got], n_best_scores(fewer, text), rtol=1e-12)


def test_n_best_cache_is_bounded_by_bytes():
    path = encoding.vocabulary_path(nbest.MODEL)
    small, large = nbest.PieceLattice(path, 4, cache_bytes=20_000), nbest.PieceLattice(path, 4)
    batches = [[f"word{i}x{k} 漢字{i}" * 3 for i in range(10)] for k in range(12)]
    sizes = []
    for batch in batches:
        assert list(small.segment(batch)) == list(large.segment(batch))
        sizes.append(small.size)
    assert max(sizes) < 20_000 + sizes[0] * 1.5 and large.size > max(sizes)
    assert small.size == sum(nbest.WORD_BYTES + 2 * len(w) + len(i) for w, i in zip(small.words, small.first))


def test_n_best_long_words_and_edges(edge_docs, no_docs):
    lattice = nbest.PieceLattice(encoding.vocabulary_path(nbest.MODEL), 4)
    word = "international" * 4
    long, (scores, _, best) = lattice.search_long(" " + word), lattice.search([" " + word])
    np.testing.assert_allclose([g for g, _ in long], scores[0])
    assert lattice.decode(best[0]) == word
    got = nbest.segmentations(edge_docs)
    out = rows(got)
    assert len(out) == 14 and all(r["round_trip"] for r in out)
    assert all(r["scores"] == sorted(r["scores"], reverse=True) for r in out)
    empty = next(r for r in out if r["doc_id"] == 2)
    assert empty["n_pieces"] == 0 and empty["scores"] == [0.0] and empty["ids"] == [[]]
    texts = {r["doc_id"]: r["text"] for r in edge_docs.collect()}
    for r in rows(nbest.decoded(got)):
        assert set(r["texts"]) == {texts[r["doc_id"]] or ""}
    assert nbest.segmentations(no_docs).count() == 0


def test_cross_entropy_against_brute_force(spark, edge_docs, no_docs, tokenizer):
    import math
    from collections import Counter
    target = spark.createDataFrame([(prose(9, 200),), (None,)], "text string")

    def model(texts):
        pair, token, history = Counter(), Counter(), Counter()
        for ids in texts:
            for h, t in zip([lm.START, *ids], ids):
                pair[h, t] += 1
                token[t] += 1
                history[h] += 1
        n = sum(token.values())
        return lambda h, t: -math.log((pair[h, t] + lm.MU * (token[t] + lm.ALPHA) / (n + lm.ALPHA * lm.SIZE)) / (history[h] + lm.MU))
    docs = edge_docs.filter("doc_id IS NULL OR doc_id != 4").collect()
    ids = [tokenizer.encode(r["text"] or "", add_special_tokens=False).ids for r in docs]
    aim, background = model([tokenizer.encode(prose(9, 200), add_special_tokens=False).ids]), model(ids)
    want = sorted((str(r["doc_id"]), len(x), *(round(sum(m(h, t) for h, t in zip([lm.START, *x], x)) / len(x), 9) if x else None
                                               for m in (aim, background))) for r, x in zip(docs, ids))
    for block in (40, lm.BLOCK_TOKENS):
        out = rows(lm.cross_entropy_difference(edge_docs.filter("doc_id IS NULL OR doc_id != 4"), target, block_tokens=block))
        got = sorted((str(r["doc_id"]), r["n_tokens"], *(None if r[c] is None else round(r[c], 9)
                                                        for c in ("target_loss", "background_loss"))) for r in out)
        assert got == want
    assert lm.cross_entropy_difference(no_docs, target).count() == 0
    assert lm.cross_entropy_difference(edge_docs, target.limit(0)).count() == 14


def test_em_finds_the_accuracies():
    r = np.random.default_rng(2)
    truth = np.where(r.random(20_000) < 0.5, 1, -1)
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.6]
    votes = np.stack([np.where(r.random(20_000) < 0.3, 0, np.where(r.random(20_000) < a, truth, -truth)) for a in accuracy], axis=1)
    codes, count = np.unique(weak.pattern(votes), return_counts=True)
    q, found = weak.expectation_maximisation(weak.patterns_to_votes(codes, 5), count.astype(float))
    assert np.abs(found - accuracy).max() < 0.08 and list(found) == sorted(found, reverse=True)
    assert (((q >= 0.5)[np.searchsorted(codes, weak.pattern(votes))]) == (truth == 1)).mean() > 0.92


def test_weak_labels_against_quality_labels(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    got = {r["doc_id"]: r["kept"] for r in weak.op2_weak_labels(spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [got[i] for i, q in labels.items() if q == 1]
    bad = [got[i] for i, q in labels.items() if q == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2


def test_weak_labels_edges(edge_docs, no_docs):
    model = weak.train(edge_docs)
    assert weak.score(edge_docs, model, edge_docs.columns).count() == 14
    kept = weak.classified(edge_docs)
    assert kept.columns == edge_docs.columns and {4, 5, 6, 7} <= {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert weak.classified(no_docs).count() == 0


def test_toxicity_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    got = {r["doc_id"]: r for r in toxicity.op6_multiple_instance(spark, sf).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(labels[i], r["predicted"]) for i, r in got.items() if r["held_out"] and i in labels]
    true = sum(y and p for y, p in held)
    assert true / sum(p for _, p in held) > 0.9 and true / sum(y for y, _ in held) > 0.8
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


def test_toxicity_locates_the_sentence_and_edges(spark, edge_docs, no_docs):
    clean = [(k, prose(k, 80), 0) for k in range(60)]
    toxic = [(100 + k, prose(k, 40) + f" You are a bloodyfool number{k}. " + prose(900 + k, 40), 1) for k in range(60)]
    both = spark.createDataFrame(clean + toxic, "doc_id long, text string, toxic int")
    model = toxicity.train(both, both.select("doc_id", "toxic"))
    got = {r["doc_id"]: r for r in toxicity.score(both, model).collect()}
    assert all(got[k]["score"] < 0.5 for k, _, _ in clean) and all(got[k]["score"] >= 0.5 for k, _, _ in toxic)
    for k, text, _ in toxic:
        at = got[k]["worst_start"]
        assert "bloodyfool" in text[at:at + got[k]["worst_chars"]]
    out = {r["doc_id"]: r for r in toxicity.score(edge_docs, model).collect()}
    assert toxicity.score(edge_docs, model).count() == 14
    assert out[2]["score"] == 0.0 and out[1]["worst_start"] is None and 0 <= out[4]["score"] <= 1
    assert toxicity.score(no_docs, model).count() == 0
    weights, bias = toxicity.train(edge_docs, both.select("doc_id", "toxic").limit(0))
    assert not weights.any() and bias == toxicity.BIAS


def test_long_texts_are_trained_on(spark):
    """Every text is longer than TRAIN_CHARS."""
    clean = [(k, prose(k, 3500), 0) for k in range(30)]
    toxic = [(100 + k, prose(500 + k, 1800) + " You are a bloodyfool here. " + prose(900 + k, 1800), 1) for k in range(30)]
    both = spark.createDataFrame(clean + toxic, "doc_id long, text string, toxic int")
    assert min(len(t) for _, t, _ in clean + toxic) > toxicity.TRAIN_CHARS
    model = toxicity.train(both, both.select("doc_id", "toxic"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(both, model).collect()}
    assert all(got[k] < 0.5 for k, _, _ in clean) and all(got[k] >= 0.5 for k, _, _ in toxic)
    assert weak.train(both).weights.any()


def test_scratch_tables_are_dropped(spark):
    import os
    s = Scratch(spark, "t")
    s.save(spark.range(3), "a")
    path = f"{s.base}/a".removeprefix("file:")
    assert os.path.isdir(path)
    s.drop("a")
    assert not os.path.exists(path)


def text_exchanges(df):
    """Shuffles in a plan whose rows hold texts."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    parts = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted").split("\n\n")
    assert "Broadcast" not in plan
    return [p for p in parts if ") Exchange" in p.split("\n")[0] and any(c in p for c in ("row#", "text#", "first#"))]


def test_dedup_shuffles_texts_once_at_every_size(spark, edge_docs, tmpdir_path):
    edge_docs.write.parquet(tmpdir_path + "/docs")
    docs = spark.read.parquet(tmpdir_path + "/docs")
    ids = docs.select(F.col("doc_id").alias("node"), "doc_id", minhash.text_key().alias("text_key"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans = []
    for limit in ("-1", old):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            plans.append([len(text_exchanges(df)) for df in (minhash.deduplicated(docs), minhash.texts_by_id(docs, ids))])
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plans == [[1, 1], [1, 1]]


def test_dedup_leaves_one_of_many_repeated_rows(spark):
    text = prose(3, 90)
    docs = spark.range(5000).selectExpr("CASE WHEN id < 4000 THEN 7 WHEN id < 4500 THEN id ELSE NULL END AS doc_id",
                                        f"'{text}' || CASE WHEN id < 4500 THEN '' ELSE 'x' || id END AS text", "id AS `row`")
    got = minhash.deduplicated(docs)
    assert got.columns == docs.columns
    left = rows(got)
    assert [r["doc_id"] for r in left if r["doc_id"] is not None] == [7] and len(left) == 501


def test_host_prior_shrinks_noise_and_leaves_a_bad_host(spark):
    """200 hosts of 5 documents that fail by chance: no host is rejected. One of 40 whose
    documents nearly all fail is."""
    import random
    r = random.Random(4)
    noise = [(h * 5 + k, f"h{h}", r.random() < 0.25) for h in range(200) for k in range(5)]
    got = rows(rules.host_rates(spark.createDataFrame(noise, "doc_id long, host string, base_failed boolean"), "host"))
    mean = sum(f for *_, f in noise) / 1000
    assert max(abs(x["host_rate"] - mean) for x in got) < 0.1 and all(x["host_ok"] for x in got)
    bad = noise + [(2000 + k, "bad", k < 38) for k in range(40)] + [(3000, "single", True)]
    by_host = {x["host"]: x for x in rows(rules.host_rates(spark.createDataFrame(bad, "doc_id long, host string, base_failed boolean"), "host"))}
    assert not by_host["bad"]["host_ok"] and by_host["bad"]["host_rate"] > 0.7 and by_host["single"]["host_ok"]
    assert all(x["host_ok"] for h, x in by_host.items() if h != "bad")


def test_training_gets_repeated_rows_once(spark, monkeypatch):
    """50,000 equal rows beside others: what the driver collects stays small, the fit is the same
    as on counted rows."""
    base = [(k, prose(k, 70) if k % 2 else "buy!!! ### " * 30) for k in range(200)]
    docs = spark.createDataFrame(base, "doc_id long, text string")
    many = docs.union(spark.range(50_000).selectExpr("1L AS doc_id", f"'{base[1][1]}' AS text"))
    sizes, fit = [], weak.fit
    monkeypatch.setattr(weak, "fit", lambda row, feature, value, target, weight, bits: sizes.append((len(target), weight.sum()))
                        or fit(row, feature, value, target, weight, bits))
    weak.train(many, per_class=10**9)
    assert sizes[0][0] <= 200 and sizes[0][1] == pytest.approx(50_200)
    bags, tox = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda f, s, bag, label, *rest: bags.append(len(label)) or tox(f, s, bag, label, *rest))
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS toxic")
    toxicity.train(many, labels)
    assert bags[0] <= 200
