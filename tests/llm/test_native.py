"""Fingerprints and mixing against plain Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from conftest_llm import ODD
from mdq.llm import fingerprints as fp
from mdq.llm import mixing


def shingles(t):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edits_and_next_documents(ready, make_docs):
    text = "the quick brown fox jumps over the lazy dog and runs far away from all of the other dogs "
    rows = [(i * 7919 % 1000, f"{text * (1 + i % 3)} number {i}" if i % 9 else None) for i in range(200)] + [(None, "first of all " * 9)]
    got = {r.doc_id: r for r in fp.fingerprint_edits(make_docs(rows, extra=["fingerprint", "edited"])).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(rows)
    for (d, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        m = len(t) // 2
        edited = t[:len(t) - m] + u[:m]
        r = got[d]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        # under 128 shingles the estimate is exact
        assert r.near_edited == pytest.approx(jaccard(shingles(t), shingles(edited)))
        assert r.near_next == pytest.approx(jaccard(shingles(t), shingles(u)))


def test_odd_documents(make_docs):
    rows = fp.fingerprint_edits(make_docs(ODD, extra=["h", "nx_text"])).collect()
    assert len(rows) == len(ODD)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert by[1] == by[2] == by[3] == {""} and by[4] == by[5] and len(by[4].pop()) == 16
    assert fp.fingerprint_edits(make_docs([])).count() == 0
    one = fp.fingerprint_edits(make_docs([(3, "a b c d e f")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_sketches_merge_and_estimate(ready):
    words = [f"w{i * i % 7001}" for i in range(6000)]
    a, b = " ".join(words[:4000]), " ".join(words[2000:])
    df = ready.createDataFrame([(a, b, " ".join(words))], "a string, b string, c string")
    for c in "abc":
        df = fp.sketch(df, f"s{c}", c)
    r = df.select((fp.merge(F.col("sa"), F.col("sb")) == F.col("sc")).alias("same"),
                  fp.resemblance(F.col("sa"), F.col("sb")).alias("j"), fp.containment(F.col("sa"), F.col("sc")).alias("inside"),
                  fp.n_distinct(F.col("sc")).alias("n")).first()
    sa, sb, sc = shingles(a), shingles(b), shingles(" ".join(words))
    assert r.same or sc != sa | sb
    assert abs(r.j - jaccard(sa, sb)) < 0.15 and r.inside > 0.85 and abs(r.n / len(sc) - 1) < 0.3


def test_sketch_keeps_every_column(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "w " * 50_000)], extra=["fp__h", "h"])
    got = fp.sketch(docs).orderBy("doc_id").collect()
    assert [len(r.sketch) for r in got] == [0, 0, 1, 1, 1] and {(r["fp__h"], r["h"]) for r in got} == {("x", "x")}
    assert fp.sketch(make_docs([])).count() == 0


def test_no_python_in_native_plans(make_docs):
    for df in (fp.fingerprint_edits(make_docs(ODD)), mixing.mix(make_docs(ODD))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# -- mixing ------------------------------------------------------------------
def test_mix_meets_the_weights(make_docs):
    rows = [(i, "x" * (50 + i % 100), "en", "big" if i % 4 else "small") for i in range(4000)]
    docs = make_docs(rows, extra=["copy", "mx_note"])
    got = mixing.mix(docs, {"big": 1.0, "small": 3.0})
    size = {r.source: r.n for r in got.groupBy("source").agg(F.sum(F.octet_length("text") + 1).alias("n")).collect()}
    total = sum(len(t) + 1 for _, t, _, _ in rows)
    assert abs(size["big"] / total - 0.25) < 0.03 and abs(size["small"] / total - 0.75) < 0.05
    keys = [r.shuffle_key for r in got.select("shuffle_key").collect()]
    assert len(set(keys)) == len(keys) and got.columns[-2:] == ["copy", "shuffle_key"]
    again = sorted(r.shuffle_key for r in mixing.mix(docs, {"big": 1.0, "small": 3.0}).collect())
    assert again == sorted(keys)


def test_mix_counts_are_poisson(make_docs):
    docs = make_docs([(i, "abc", "en", None) for i in range(20000)])
    got = mixing.mix(docs, total=20000 * 4 * 2.0).groupBy("doc_id").agg(F.max("copy").alias("n"), F.count("*").alias("k"))
    n = [r.n for r in got.collect()]
    assert all(r.n == r.k for r in got.collect())
    mean = sum(n) / 20000
    var = sum(x * x for x in n) / 20000 - mean ** 2
    assert abs(mean - 2) < 0.05 and abs(var - 2) < 0.1
    assert abs(1 - len(n) / 20000 - 0.1353) < 0.01


def test_mix_odd_tables(make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    assert set(mixing.mix(make_docs(ODD, extra=["shuffle_key"])).columns) == {"doc_id", "text", "lang", "source", "n_chars", "copy", "shuffle_key"}
    huge = mixing.mix(make_docs([(1, "a", "en", "s")]), total=2 * 3000.0).count()          # a rate beyond exp underflow
    assert abs(huge - 3000) < 300
    with pytest.raises(ValueError):
        mixing.mix(make_docs(ODD), {"nowhere": 1.0})
