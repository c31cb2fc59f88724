"""Embedding join, filter audit and centroid clustering against brute force."""
import hashlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from mdq.llm import blocks, centroids, embedding_join, filter_audit

VECTORS = "vec_id bigint, embedding array<float>, label int"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute_links(rows, t=0.93):
    """vec_id, n_links, component_id, kept of (vec_id, vector, label) rows, one by one."""
    def ok(r):
        return (r[2] is not None and r[1] and all(x is not None and np.isfinite(np.float32(x)) for x in r[1]) and any(r[1]))
    units = [None if not ok(r) else (lambda v: v / np.linalg.norm(v))(np.array(r[1], np.float32).astype(float)) for r in rows]
    near = [[j for j, b in enumerate(rows) if i != j and units[i] is not None and units[j] is not None and a[2] == b[2]
             and len(a[1]) == len(b[1]) and units[i] @ units[j] >= t] for i, a in enumerate(rows)]
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        for j in group:
            c = min(ids, default=None)
            out[j] = (rows[j][0], len(near[j]), c, rows[j][0] == c)
    return out


def cloud(seed, n, dim=16):
    """Random vectors, groups of near copies (chained too), exact copies and odd rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(n):
        v = rng.normal(size=dim)
        rows.append(v)
        for _ in range(int(rng.integers(0, 4))):
            v = v + rng.normal(size=dim) * 0.09
            rows.append(v)
    rows = [(i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3))) for i, v in enumerate(rows)]
    k = len(rows)
    rows += [(k + i, rows[3][1], rows[3][2]) for i in range(30)]                      # exact copies
    rows += [(k + 30, [2 * x for x in rows[3][1]], rows[3][2]), (k + 31, rows[3][1], None), (k + 32, None, 1), (k + 33, [0.0] * dim, 1),
             (k + 34, [float("nan")] * dim, 1), (k + 35, [None] + [1.0] * (dim - 1), 1), (k + 36, [], 1), (None, rows[3][1], rows[3][2]),
             (k + 37, [1.0, 2.0], 1), (k + 38, [1.0, 2.01], 1), (5, rows[5][1], rows[5][2]), (k + 39, [1e-30] * dim, 2), (k + 40, [1e30] * dim, 2)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_embedding_join_equals_brute_force(ready, monkeypatch, small):
    if small:                                                    # many segments, blocks and levels
        monkeypatch.setattr(embedding_join, "SEGMENT_ROWS", 7)
        monkeypatch.setattr(embedding_join, "LEAF", 3)
        monkeypatch.setattr(embedding_join, "FANOUT", 1)
    rows = cloud(1, 60)
    df = ready.createDataFrame([r + ("x", "y", "z") for r in rows], VECTORS + ", node string, `a.b` string, links string").repartition(3)
    got = embedding_join.near_duplicates(df).collect()
    want = brute_links(rows)
    assert any(r[1] for r in want) and any(not r[3] for r in want)
    assert Counter(map(tuple, got)) == Counter(want)


def test_embedding_join_of_doubles_empty_and_unusable_rows(ready):
    wide = ready.createDataFrame([(1, [1e300, 1e300], "a"), (2, [1.0, 1.0], "a"), (3, [-1.0, 1.0], "a"), (4, [1.0, 1.0], "b")],
                                 "vec_id bigint, embedding array<double>, label string")
    assert sorted(map(tuple, embedding_join.near_duplicates(wide).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)]
    none = ready.createDataFrame([], VECTORS)
    assert embedding_join.near_duplicates(none).collect() == []
    odd = ready.createDataFrame([(1, None, 1), (2, [1.0], None), (None, [0.0], 1)], VECTORS)
    assert sorted(map(str, (tuple(r) for r in embedding_join.near_duplicates(odd).collect()))) == sorted(
        map(str, [(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)]))


def test_a_chain_across_segments_is_one_component(ready, monkeypatch):
    monkeypatch.setattr(embedding_join, "SEGMENT_ROWS", 4)
    step = np.arccos(0.94)
    rows = [(100 - i, [float(np.cos(i * step)), float(np.sin(i * step)), 0.0], 1) for i in range(40)]   # each linked with the next alone
    got = embedding_join.near_duplicates(ready.createDataFrame(rows, VECTORS)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_links(rows))


def test_blocks_that_are_provably_distant_are_skipped(monkeypatch):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(512, 8)) * 0.01 + np.eye(8)[k] for k in range(4)])
    ids = np.arange(len(x), dtype="<i8")
    raw = ids.tobytes() + np.ones(len(x), "<i8").tobytes() + ids.tobytes() + x.astype("<f8").tobytes()
    seg = embedding_join.Segment(raw, len(x), 8, "<f8", np.eye(8))
    compared = []
    triu = np.triu
    monkeypatch.setattr(embedding_join.np, "triu", lambda m, k: compared.append(1) or triu(m, k))
    at, links, root = embedding_join.join_segments(seg, seg, 0.93)
    assert len(at) == 2048 and set(links) == {511} and set(root) == {0, 512, 1024, 1536}
    assert len(compared) == 4                                    # the four blocks with themselves, no two with each other


# -- filter audit ------------------------------------------------------------
def brute_audit(docs, labels):
    """Every order applied to every document, one by one."""
    first = {}
    for d, t, s in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    rows = []
    for d, t, s in docs:
        t = t or ""
        w = t.encode().split()
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
             "D": any(c in "#$%&*|" for c in t), "E": d is not None and d > first[t]}
        rows.append((s or "", {k for k, v in f.items() if v}, d in good and d is not None, d in toxic and d is not None))
    out = {}
    for order in map("".join, permutations("ABCDE")):
        for s, fails, g, x in rows:
            gone = False
            for k, f in enumerate(order):
                e = out.setdefault((s, order, k + 1), Counter())
                if f in fails:
                    e["unique_fails"] += fails == {f}
                    e["redundant" if gone else "removed"] += 1
                    if not gone:
                        e["good_lost"] += g
                        e["toxic_lost"] += x
                    gone = True
                e["kept"] += not gone
    shapley = Counter()
    for (s, order, k), e in out.items():
        shapley[s, order[k - 1]] += e["removed"]
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return {(*k, *(e[n] for n in names), shapley[k[0], k[1][k[2] - 1]]) for k, e in out.items()}


def odd_documents():
    rng = np.random.default_rng(3)
    words = ["word", "other", "Wort", "İz", "a b", "50%", "#tag", "x|y", "BIG", "é"]
    docs = []
    for i in range(160):
        n = int(rng.choice([0, 1, 30, 220, 400]))
        some = words if i % 3 else words[:3]
        pool = [f"w{j}" for j in range(300)] + some * int(rng.integers(0, 30))
        docs.append((i, rng.choice(["", " ", "\n", "\x0b "]) + " ".join(rng.choice(pool, n)), [None, "", "s1", "s2"][int(rng.integers(0, 4))]))
    docs += [(200 + i, docs[i % 5][1], "s2") for i in range(40)] + [(300, None, "s1"), (301, "", "s3"), (None, docs[3][1], "s3"),
                                                                     (7, docs[7][1], "s1"), (7, "again #7", "s1"), (302, "long " * 20000, "s4")]
    labels = [(i, int(rng.integers(0, 2)), int(rng.integers(0, 2))) for i in range(0, 250, 2)]
    return docs, labels + [(4, 1, None), (4, 0, 1), (9, None, None), (None, 1, 1)]


@pytest.mark.parametrize("block", [5, 1 << 16])
def test_filter_audit_equals_brute_force(ready, block, monkeypatch):
    docs, labels = odd_documents()
    monkeypatch.setattr(filter_audit.posting_lists, "__defaults__", (block,))
    monkeypatch.setattr(filter_audit, "WINDOW", 4)
    df = ready.createDataFrame([(d, t, "en", s, 0, "x", "y") for d, t, s in docs], DOCS + ", part string, `a.b` string")
    lab = ready.createDataFrame([(*r, "x") for r in labels], "doc_id bigint, quality int, toxic int, good_lost string")
    got = filter_audit.audit_documents(df, lab)
    cols = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = [tuple(r[c] for c in cols) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute_audit(docs, labels)


def test_filter_audit_of_an_empty_table(ready):
    empty = ready.createDataFrame([], DOCS)
    assert filter_audit.audit_documents(empty, ready.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect() == []


def test_merges_of_posting_lists(monkeypatch):
    monkeypatch.setattr(filter_audit, "WINDOW", 3)
    rng = np.random.default_rng(4)
    for _ in range(200):
        lists = [np.unique(rng.integers(0, 60, int(rng.integers(0, 40)))).astype(np.int32) for _ in range(5)]
        assert filter_audit.union(lists).tolist() == sorted(set().union(*(x.tolist() for x in lists)))
        assert lists[0][filter_audit.common(lists[0], lists[1])].tolist() == sorted(set(lists[0].tolist()) & set(lists[1].tolist()))
        at = int(rng.integers(0, len(lists[2]) + 1))
        v = int(rng.integers(0, 60))
        assert filter_audit.gallop(lists[2], at, v) == at + int((lists[2][at:] < v).sum())


# -- centroid clustering -----------------------------------------------------
def brute_clusters(rows, k=8, rounds=10, dim=64):
    kept = []
    for i, v, _ in rows:
        if v is not None and len(v) == dim and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            kept.append((i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    c = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), n) for n, m in enumerate(c))
    for _ in range(rounds):
        to = [near(v)[1] for _, v in kept]
        for n in range(len(c)):
            own = [v for (_, v), t in zip(kept, to) if t == n]
            if own:
                c[n] = [sum(x) // len(own) for x in zip(*own)]
    placed = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, n, d in placed:
        inertia[n] += d
    return Counter((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest()) for i, n, d in placed)


def test_clusters_equal_brute_force(ready, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(5, 64)) * 0.2
    rows = [(i, [float(np.float32(x)) for x in base[i % 5] + rng.normal(size=64) * 0.1], 1) for i in range(150)]
    rows += [(200 + i, rows[0][1], 1) for i in range(20)] + [(3, rows[3][1], 1), (3, rows[4][1], 1), (None, rows[5][1], 1)]
    odd = [(300, None, 1), (301, [1.0] * 63, 1), (302, [1.0] * 65, 1), (303, [None] + [1.0] * 63, 1), (304, [float("inf")] * 64, 1), (305, [], 1)]
    df = ready.createDataFrame([r + ("a", "b", "c") for r in rows + odd], VECTORS + ", cluster string, x string, `k.e` string").repartition(3)
    got = centroids.cluster(df)
    assert Counter(map(tuple, got.collect())) == brute_clusters(rows + odd)


def test_few_vectors_ties_and_empty_table(ready):
    assert centroids.cluster(ready.createDataFrame([], VECTORS)).collect() == []
    rows = [(i, [0.5] * 64, 1) for i in range(3)]
    got = centroids.cluster(ready.createDataFrame(rows, VECTORS)).collect()
    assert Counter(map(tuple, got)) == brute_clusters(rows) and {r["cluster"] for r in got} == {0}
    huge = [(1, [1e6] * 64, 1), (2, [1.0] * 64, 1)]
    assert [r["vec_id"] for r in centroids.cluster(ready.createDataFrame(huge, VECTORS)).collect()] == [2]


def test_hilbert_curve_visits_neighbours_in_turn():
    for axes, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        key = centroids.hilbert_keys(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        way = grid[np.argsort(key)]
        assert (np.abs(np.diff(way, axis=0)).sum(1) == 1).all()


def test_box_bounds_keep_every_nearest_centroid_and_drop_some():
    rng = np.random.default_rng(6)
    fewer = 0
    for _ in range(100):
        c = rng.integers(-100, 100, (8, 4))
        x = rng.integers(-100, 60, 4) + rng.integers(0, 40, (50, 4))
        among = centroids.candidates(x.min(0), x.max(0), c)
        full, d = centroids.nearest(x, c, np.arange(8))
        part, e = centroids.nearest(x, c, among)
        assert (full == part).all() and (d == e).all()
        big, f = centroids.nearest(x + (1 << 26), c + (1 << 26), np.arange(8))       # the path in longs
        assert (big == full).all() and (f == d).all()
        fewer += len(among) < 8
    assert fewer > 50


def test_principal_axes_are_orthonormal_and_lead(ready):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 6)) * [0.1, 0.1, 5.0, 0.1, 0.1, 1.0]
    df = ready.createDataFrame([([float(v) for v in r],) for r in x] + [([1.0, 2.0],), (None,)], "x array<double>")
    dim, axes = blocks.principal_axes(df, "x", unit=False, limit=3)
    assert dim == 6 and np.allclose(axes.T @ axes, np.eye(3)) and abs(axes[2, 0]) > 0.99 and abs(axes[5, 1]) > 0.9
