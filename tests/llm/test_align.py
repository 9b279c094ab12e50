"""Cross-tokenizer alignment: against plain loops over both tokenizers' own output."""
import hashlib
from collections import Counter

import pytest
from test_bestfit import fuzz

from barspark.llm import align, units
from barspark.llm.encoding import vocabulary_path


@pytest.fixture(scope="module")
def own():
    """Token lists straight from the libraries: [(id, bytes), ...] of A and B, or none."""
    import sentencepiece
    a = units.load(vocabulary_path(align.VOCABULARY_A), special=False)
    entries = units.byte_level_bytes(vocabulary_path(align.VOCABULARY_A))
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(align.VOCABULARY_B))

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        ta = [(i, entries[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
        tb = [(i, piece(i)) for i in b.encode(text)]
        raw = (" " + text).encode()
        return (ta, tb) if b"".join(x for _, x in ta) == raw == b"".join(x for _, x in tb) else ([], [])
    return tokens


def ranges(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(texts, tokens):
    docs, counts = [], Counter()
    for text in texts:
        a, b = map(ranges, tokens(text))
        links = [(x, y) for x in range(len(a)) for y in range(len(b)) if a[x][1] < b[y][2] and b[y][1] < a[x][2]]
        both = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, lo = [], 0
        for hi in both:
            groups.append(",".join(str(i) for i, _, e in a if lo < e <= hi) + "|" + ",".join(str(i) for i, _, e in b if lo < e <= hi))
            lo = hi
        docs.append((len(a), len(b), len(groups), [(a[x][0], b[y][0]) for x, y in links], ";".join(groups), sorted(links)))
        counts.update(docs[-1][3])
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return [{"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": len(links), "n_best": sum(counts[p] == most[p[1]] for p in links),
             "count_sum": sum(counts[p] for p in links), "groups_sha256": groups and hashlib.sha256(groups.encode()).hexdigest(),
             "groups": groups, "places": places} for n_a, n_b, n_groups, links, groups, places in docs]


TEXTS = [*fuzz(11, 150), "", None, "a", " ", "  ", "\n", "x ", "a▁b", "<0x41> <s> </s> <unk>", "Straße naïve 漢字かな交じり文 🙂🙃",
         "supercalifragilistic " * 3, "the the the cat", "the cat"]


@pytest.mark.parametrize("block_links", [40, 4_000_000])
def test_align_against_plain_loops(spark, own, block_links):
    wanted = plain(TEXTS, own)
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(TEXTS)], "doc_id long, text string, n_a int").repartition(5)
    got = {r["doc_id"]: r.asDict() for r in align.align(docs, block_links=block_links).collect()}
    assert len(got) == len(TEXTS)
    for k, w in enumerate(wanted):
        assert {c: got[k][c] for c in got[k] if c != "doc_id"} == {c: v for c, v in w.items() if c not in ("groups", "places")}, TEXTS[k]
    assert any(w["n_best"] != w["n_links"] for w in wanted) and any(w["n_groups"] < min(w["n_a"], w["n_b"]) for w in wanted)


def test_alignments_give_groups_and_places(spark, own):
    wanted = plain(TEXTS, own)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in align.alignments(docs).collect():
        assert r["groups"] == wanted[r["doc_id"]]["groups"]
        assert sorted((x["a"], x["b"]) for x in r["links"]) == wanted[r["doc_id"]]["places"]


def test_edges(spark, own, edge_docs, no_docs):
    got = align.align(edge_docs).collect()
    assert len(got) == 14 and align.align(no_docs).collect() == []
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["n_a"] == by_id[2]["n_b"] == by_id[11]["n_links"] == 0 and by_id[2]["groups_sha256"] == ""
    long = next(r for r in edge_docs.collect() if r["doc_id"] == 4)["text"]
    a, b = own(long)
    ends = [{e for _, _, e in ranges(x)} for x in (a, b)]
    assert (by_id[4]["n_a"], by_id[4]["n_b"], by_id[4]["n_groups"]) == (len(a), len(b), len(ends[0] & ends[1]))
    fives = [r for r in got if r["doc_id"] == 5]
    assert len(fives) == 2 and fives[0] == fives[1] and fives[0]["count_sum"] > by_id[8]["n_links"]
    assert align.align(edge_docs.filter("doc_id IN (1, 2)")).agg({"n_links": "sum"}).first()[0] == 0


def test_pieces_that_join_words_forbid_the_cut():
    pieces = units.Pieces(vocabulary_path(align.VOCABULARY_B))
    assert b" " in pieces.cuts and b"\r" not in pieces.cuts
