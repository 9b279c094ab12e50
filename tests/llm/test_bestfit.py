"""Hierarchical best-fit packing: against the tokenizer, on edge cases, and its rounds."""
import random
import zlib

import numpy as np
import pytest

from barspark.llm import bestfit, units
from barspark.llm.encoding import vocabulary_path


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_path(bestfit.VOCABULARY))


def fuzz(seed, n):
    r = random.Random(seed)
    parts = ["a", "bc", "It's", "'ll", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", " ", "　", " ", "é", "漢字", "🙂", ".", ",",
             "!!", "12", "<|endoftext|>", "É.", "x,", "ß. ", "\u0085", "​", "word, word.", "▁", "<0x41>", "x" * 60]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)]


def check(got, texts, tokenizer, seq_len=1024, with_ids=True):
    """Every id once, cut as agreed, sequences full from 0 without gaps. Returns the sequences."""
    wanted = sorted(((d is None, d or 0), t or "") for d, t in texts)
    encoded = {}
    for (_, d), t in wanted:
        encoded.setdefault(d, []).append(np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4"))
    pieces = sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    expected = []
    for d, many in encoded.items():
        for ids in many:
            at = 0
            for k, n in enumerate(bestfit.cuts(len(ids), seq_len)):
                expected.append((d, k, at, n, zlib.crc32(ids[at:at + n].tobytes())))
                at += n
    assert pieces == sorted(expected)
    by_seq = {}
    for r in got:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        if with_ids:
            assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    for places in by_seq.values():
        places.sort()
        assert [p[0] for p in places] == [0, *np.cumsum([p[1] for p in places])[:-1].tolist()]
        assert sum(p[1] for p in places) <= seq_len
    return by_seq


def test_units_give_the_tokenizers_ids(tokenizer):
    import pyarrow as pa
    texts = [*fuzz(1, 4000), "", None]
    path = vocabulary_path(bestfit.VOCABULARY)
    for lo, ids, at in bestfit.encoded(pa.array(texts), path):
        for k in range(len(at) - 1):
            assert ids[at[k]:at[k + 1]].tolist() == tokenizer.encode(texts[lo + k] or "", add_special_tokens=False).ids


def test_small_cache_gives_the_same_ids(tokenizer):
    encoder = units.UnitEncoder(units.byte_level_encoder(vocabulary_path(bestfit.VOCABULARY)), cache_units=8)
    for text in fuzz(2, 300):
        data = np.frombuffer(text.encode(), np.uint8)
        starts, _ = units.unit_starts(data, np.array([0, len(data)]), units.cut_table(units.BLANKS))
        flat, begin, size = encoder.ids(data, starts, np.append(starts[1:], len(data)))
        assert units.gather(flat, begin, size).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pack_edges(edge_docs, no_docs, tokenizer):
    texts = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    for with_ids in (True, False):
        got = rows(bestfit.pack(edge_docs, with_ids=with_ids))
        check(got, texts, tokenizer, with_ids=with_ids)
        assert ("ids" in got[0]) == with_ids
    assert rows(bestfit.pack(no_docs)) == []


@pytest.mark.parametrize("group_items", [50, 100_000])
def test_rounds_use_few_sequences(spark, tokenizer, group_items):
    r = random.Random(7)
    texts = [(k, " ".join(["a"] * r.choice([1, 3, 20, 70, 120, 300, 501, 555, 700, 1023, 2500]))) for k in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    got = rows(bestfit.pack(docs, group_items=group_items, with_ids=False))
    by_seq = check(got, texts, tokenizer, with_ids=False)
    lengths = [x["length"] for x in got]
    least = -(-sum(lengths) // 1024)
    large = sum(n > 512 for n in lengths)       # no two of these share a sequence
    assert len(by_seq) <= max(least, large) * (1.02 if group_items > 1000 else 1.06) + 2


def test_bins_that_never_fit_end_the_rounds(spark, tokenizer):
    texts = [(k, " ".join(["a"] * 600)) for k in range(300)]
    got = rows(bestfit.pack(spark.createDataFrame(texts, "doc_id long, text string"), group_items=20, with_ids=False))
    assert len(check(got, texts, tokenizer, with_ids=False)) == 300


def test_best_fit_against_plain_search():
    r = np.random.default_rng(3)
    for _ in range(30):
        sizes = r.integers(1, 65, r.integers(1, 80))
        rooms, placed = [], {}
        for i in np.argsort(-sizes, kind="stable"):
            fit = [(room, b) for b, room in enumerate(rooms) if room >= sizes[i]]
            room, b = min(fit)[0] if fit else 64, None
            if not fit:
                rooms.append(64)
                b = len(rooms) - 1
            else:
                b = next(x for x in range(len(rooms)) if rooms[x] == room)
            rooms[b] -= sizes[i]
            placed[i] = b
        got = bestfit.best_fit(sizes, 64)
        assert got.max() + 1 == len(rooms)
        assert sorted(np.bincount(got, weights=sizes)) == sorted(64 - x for x in rooms)
