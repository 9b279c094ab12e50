"""Filter interaction audit: against a plain run of every order, and on edge cases."""
import itertools
from collections import Counter

import pytest
from brute import WORD

from barspark.llm import audit


def rows(df):
    return [r.asDict() for r in df.collect()]


def failed(docs):
    """The letters each row fails, by the contract's words."""
    out = []
    for doc_id, text, _ in docs:
        text = text or ""
        w = WORD.findall(text)
        f = "A" if len(w) < 50 else ""
        f += "B" if 100 * len(set(w)) < 65 * len(w) else ""
        f += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else ""
        f += "D" if set(text) & set("#$%&*|") else ""
        if doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in docs):
            f += "E"
        out.append(f)
    return out


def played(docs, labels):
    """Every order played on the rows one filter at a time."""
    fails = failed(docs)
    flag = {c: {d for d, q, t in labels if d is not None and (q if c == "good" else t) == 1} for c in ("good", "toxic")}
    out = {}
    for part in {p or "" for _, _, p in docs}:
        own = [(d, f) for (d, _, p), f in zip(docs, fails) if (p or "") == part]
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left, gone = own, []
            for step, x in enumerate(order, 1):
                hit = [(d, f) for d, f in left if x in f]
                redundant = sum(x in f for _, f in gone)
                left, gone = [r for r in left if x not in r[1]], gone + hit
                shapley[x] += len(hit)
                out[part, order, step] = {
                    "kept": len(left), "removed": len(hit), "redundant": redundant, "unique_fails": sum(f == x for _, f in own),
                    "good_lost": sum(d in flag["good"] for d, _ in hit), "toxic_lost": sum(d in flag["toxic"] for d, _ in hit)}
        for (p, order, step), r in out.items():
            if p == part:
                r["shapley"] = shapley[order[step - 1]]
    return out


LABELS = [(4, 1, 0), (5, 1, 1), (5, 1, None), (6, 0, 1), (7, None, None), (8, 1, 1), (None, 1, 1), (99, 1, 1)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_audit_against_played_orders(spark, edge_docs, labels):
    base = [(r["doc_id"], r["text"], r["source"]) for r in edge_docs.collect()]
    prose = base[4][1]
    docs = base + [(20 + k, prose + " # " * (k % 2) + " SHOUT" * (k % 3) * 20, "c") for k in range(12)] + [
        (40, None, ""), (41, "", None), (42, "only " * 60, None), (43, prose, None), (None, prose, "c"), (None, prose, "c")]
    got = rows(audit.filter_audit(spark.createDataFrame(docs, "doc_id long, text string, source string"), labels))
    wanted = played(docs, LABELS)
    assert len(got) == len(wanted) == 600 * len({p or "" for _, _, p in docs})
    for r in got:
        key = r.pop("part"), r.pop("filter_order"), r.pop("step")
        assert r == wanted[key], key
    assert any(r["redundant"] and r["good_lost"] for r in wanted.values())


def test_many_copies_under_one_source(spark, labels):
    docs = spark.range(3000).selectExpr("id % 1500 AS doc_id", "'one text' AS text", "'hot' AS source")
    got = rows(audit.filter_audit(docs, labels).filter("filter_order = 'EABCD'"))
    by_step = {r["step"]: r for r in got}
    assert by_step[1]["removed"] == 2998 and by_step[1]["kept"] == 2     # both rows of doc 0 stay
    assert by_step[2]["removed"] == 2 and by_step[2]["redundant"] == 2998


def test_extra_columns_and_empty_tables(spark, edge_docs, no_docs, labels):
    assert audit.filter_audit(edge_docs, labels).count() == 600 * 4
    assert rows(audit.filter_audit(no_docs, labels)) == []
    none = rows(audit.filter_audit(edge_docs, labels.limit(0)))
    assert sum(r["removed"] for r in none) > 0 and not any(r["good_lost"] or r["toxic_lost"] for r in none)


def test_paths_go_through_every_edge_as_often_as_counted():
    for n in range(1, 6):
        edges = audit.lattice(n)
        through = Counter(p["edge"] for p in audit.paths("ABCDE"[:n], edges))
        assert [through[i] for i in range(len(edges))] == [e["orders"] for e in edges]


def test_audit_of_other_filters(spark):
    masks = spark.createDataFrame([("p", 0, 5, 0, 0), ("p", 1, 2, 1, 0), ("p", 3, 4, 0, 1)],
                                  "part string, mask int, n long, good long, toxic long")
    got = {(r["filter_order"], r["step"]): r for r in rows(audit.audit(masks, "xy"))}
    assert [got["xy", s]["removed"] for s in (1, 2)] == [6, 0] and [got["yx", s]["removed"] for s in (1, 2)] == [4, 2]
    assert got["xy", 1]["shapley"] == 8 and got["xy", 2]["shapley"] == 4 and got["yx", 2]["kept"] == 5
    with pytest.raises(ValueError):
        audit.audit(masks, "xx")
