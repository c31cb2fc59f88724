"""Quality classifier, language ID and quality rules: held-out accuracy, brute force, odd rows."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import ODD
from mdq.llm import language_id, quality_classifier, quality_rules
from mdq.llm.common import crc_mod, read_table

SF = "/root/testdata/sf0.01"


def test_quality_scores_held_out(ready):
    got = {r.doc_id: r for r in quality_classifier.op1_quality_classifier(ready, SF).collect()}
    labels = {r.doc_id: r.quality for r in read_table(ready, SF, "labels").collect()}
    good = [got[d].score for d, q in labels.items() if q == 1 and got[d].held_out]
    bad = [got[d].score for d, q in labels.items() if q == 0 and got[d].held_out]
    auc = np.mean([[g > b for b in bad] for g in good])
    assert auc > 0.95 and len(got) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_network_reads_the_whole_text():
    net = quality_classifier.Network.start(0)
    r = np.random.default_rng(0)
    long = bytes(r.integers(97, 123, 3_000_000, dtype=np.uint8))
    texts = [b"", b"ab", long[:511], long[:513], long[:100_000], long]
    together = net.scores(texts)
    assert np.allclose(together, [net.scores([t])[0] for t in texts], atol=1e-5)
    at = quality_classifier.chunk_starts(100_000)
    assert at[-1] + quality_classifier.CHUNK >= 100_000 and np.diff(at).max() < quality_classifier.CHUNK
    changed = bytearray(long[:100_000])
    changed[-1] = 200
    assert net.scores([bytes(changed)])[0] != net.scores([long[:100_000]])[0]


def test_gradients_learn_a_simple_pattern():
    r = np.random.default_rng(0)
    texts, labels = [], []
    for i in range(200):
        t = bytearray(bytes(r.integers(97, 123, int(r.integers(100, 1500)), dtype=np.uint8)))
        if i % 2:
            t[::9] = b"#" * len(t[::9])
        texts.append(quality_classifier.cut(bytes(t), quality_classifier.chunk_starts(len(t))))
        labels.append(1 - i % 2)
    net = quality_classifier.train(texts, np.array(labels), epochs=30)
    clean = [bytes(r.integers(97, 123, 700, dtype=np.uint8)) for _ in range(20)]
    marked = [b"#".join(t[i:i + 8] for i in range(0, 700, 8)) for t in clean]
    assert (net.scores(clean) > 0.5).mean() > 0.9 and (net.scores(marked) < 0.5).mean() > 0.9


def test_quality_odd_rows(make_docs, ready):
    labels = ready.createDataFrame([(1, 1), (4, 0), (None, 1), (5, None)], "doc_id bigint, quality int")
    docs = make_docs(ODD, extra=["score", "quality"])
    net = quality_classifier.fit(docs, labels)
    rows = quality_classifier.score(docs, net).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    empty = [r.score for r in rows if r.text in (None, "")]
    assert max(empty) - min(empty) < 1e-6
    untrained = quality_classifier.fit(make_docs([]), labels.limit(0))
    assert quality_classifier.score(make_docs([]), untrained).count() == 0


# -- language ----------------------------------------------------------------
def test_language_held_out_accuracy(ready):
    got = {r.doc_id: r for r in language_id.op6_language_id(ready, SF).collect()}
    docs = read_table(ready, SF, "documents").select("doc_id", "lang", (crc_mod("doc_id", 5) == 0).alias("h")).collect()
    held = [d for d in docs if d.h]
    assert np.mean([got[d.doc_id].lang_pred == d.lang for d in held]) > 0.97
    assert all(got[d.doc_id].held_out == d.h and 0 <= got[d.doc_id].score <= 1 for d in docs)


def test_language_odd_rows(make_docs):
    rows = ([(100 + i, "the cat and the dog went to the house " * 3, "en") for i in range(20)]
            + [(200 + i, "der hund und die katze gehen in das haus " * 3, "de") for i in range(20)]
            + [(300 + i, "el perro y la casa de los gatos del rey " * 3, "es") for i in range(20)]
            + [(400 + i, "quel bois mystique xq zw kv", "zz") for i in range(20)])
    odd = [(d, t, None) for d, t in ODD]
    docs = make_docs(rows + odd, extra=["lang_pred", "families"])
    model = language_id.fit(docs)
    assert model.families == ["germanic", "romance", "zz"]
    got = language_id.identify(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        if r.lang:
            assert r.lang_pred == r.lang
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    kept = language_id.keep_known(docs, model)
    assert kept.columns == docs.columns and kept.filter("text is null or text in ('', '😀')").count() == 0
    none = language_id.fit(make_docs([]))
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}
    assert language_id.identify(make_docs([]), model).count() == 0


FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。人人有资格享有本宣言所载的一切权利和自由。",
    " ".join(f"{i * 2654435761 % 2 ** 32:08x}" for i in range(1, 80)),
]


@pytest.mark.parametrize("langs", [["de", "en", "es", "fr"], ["en"]])
def test_unlearned_languages_are_left_out(ready, make_docs, langs):
    docs = read_table(ready, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").filter(F.col("lang").isin(langs))
    model = language_id.fit(docs)
    n = docs.count()
    assert language_id.keep_known(docs, model).count() > 0.97 * n
    foreign = [(i, t, None) for i, t in enumerate(FOREIGN)]
    short = [(100, "the cat", None), (101, "the", None), (102, "12 34", None)]
    assert sorted(r.doc_id for r in language_id.keep_known(make_docs(foreign + short), model).collect()) == [100, 101]


def test_features_of_long_texts_in_blocks(monkeypatch):
    t = "the quick brown fox über den Zaun " * 300
    whole = language_id.features(t)
    monkeypatch.setattr(language_id, "BLOCK", 101)
    assert np.allclose(whole, language_id.features(t))


# -- rules -------------------------------------------------------------------
def brute(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(wins)
    inside = {j for i, x in enumerate(wins) if n[x] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(inside)


def test_base_counts_match_brute_force(ready, make_docs):
    rows = [(r.doc_id, r.text, r.lang) for r in read_table(ready, SF, "documents").limit(300).collect()] + [(d, t, None) for d, t in ODD]
    got, _ = quality_rules.judge(make_docs(rows, extra=["kept", "classes"]))
    have = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got.collect())
    want = sorted((d or -1, *b, b[0] < 20 or 100 * b[4] > 30 * b[0]) for d, t, _ in rows for b in [brute(t)])
    assert have == want


def test_divergence_rejects_junk_and_keeps_prose(ready):
    docs = read_table(ready, SF, "documents")
    got = {r.doc_id: r for r in quality_rules.judge(docs)[0].collect()}
    labels = {r.doc_id: r.quality for r in read_table(ready, SF, "labels").collect()}
    passed = [d for d in labels if not got[d].base_failed]
    assert np.mean([got[d].kept for d in passed if labels[d] == 1]) > 0.995
    assert np.mean([got[d].kept for d in passed if labels[d] == 0]) < 0.15
    assert not any(r.kept and r.base_failed for r in got.values())
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, r in got.items() if r.kept)


@pytest.mark.parametrize("junk", [False, True])
def test_copies_do_not_become_the_reference(ready, make_docs, junk):
    docs = [(r.doc_id, r.text, r.lang) for r in read_table(ready, SF, "documents").collect()]
    labels = {r.doc_id: r.quality for r in read_table(ready, SF, "labels").collect()}
    of = [(d, t, x) for d, t, x in docs if x == "es" and labels.get(d) == int(not junk) and len(t.split()) >= 60]
    copied = min(of)
    rows = docs + [(10**6 + i, *copied[1:]) for i in range(len(docs) // 2)]        # a third of all rows
    got = {r.doc_id: r for r in quality_rules.judge(make_docs(rows))[0].collect()}
    assert len(got) == len(rows)
    clean = [d for d, _, x in docs if x == "es" and labels.get(d) == 1 and not got[d].base_failed]
    assert len(clean) > 10 and np.mean([got[d].kept for d in clean]) > 0.99


def test_references_count_a_text_once_and_leave_out_failed_ones(make_docs):
    r = np.random.default_rng(1)
    texts = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "eps"], 60)) for _ in range(20)]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    _, plain = quality_rules.judge(make_docs(rows))
    _, more = quality_rules.judge(make_docs(rows + [(100 + i, texts[0], "en") for i in range(50)] + [(200 + i, "zz # " * 50, "en") for i in range(50)]))
    assert more.common == plain.common
    for a, b in zip(plain.refs["en"], more.refs["en"]):
        assert np.allclose(a, b)


def test_distance():
    p, q = np.array([[1.0, 0], [0.5, 0.5]]), np.array([[0, 1.0], [0.5, 0.5]])
    assert quality_rules.js_distance(p, q).tolist() == pytest.approx([1, 0])


def test_colliding_windows_are_told_apart(monkeypatch):
    monkeypatch.setattr(quality_rules, "_FACTORS", np.zeros(8, np.uint64))       # every window hashes alike
    words = [str(i).encode() for i in range(30)]
    assert quality_rules.repeated_words(words) == 0
    assert quality_rules.repeated_words(words + words[:8]) == 16


def test_rules_empty_table(make_docs):
    assert quality_rules.judge(make_docs([]))[0].count() == 0
    assert quality_rules.keep_good(make_docs([])).count() == 0


def test_verdicts_equal_plain_distances(make_docs):
    """References, distances, limits and verdicts computed one text at a time."""
    q, r = quality_rules, np.random.default_rng(4)
    pool = [f"w{i}" for i in range(90)]
    p = 1 / np.arange(1, 91)
    texts = [" ".join(r.choice(pool, int(r.integers(5, 120)), p=p / p.sum())) + r.choice([".", " 12 |", "!"]) for _ in range(120)]
    texts += ["| # | % " * 20, "ZZ QQ XX " * 12, "w1 w2 " * 40, "", "w0"] + texts[:6] * 5 + [" ".join(f"u{i} | {i}" for i in range(60))]
    rows = [(i, t, ["en", None][i % 2]) for i, t in enumerate(texts)]
    lim = q.Limits(min_texts=5)
    got = {x.doc_id: x for x in q.judge(make_docs(rows, extra=["n_plain", "h1", "a.b"]), lim)[0].collect()}
    plain = lambda t: t.encode().translate(q._PLAIN).split()
    failed = {i: (lambda b: b[0] < 20 or 100 * b[4] > 30 * b[0])(brute(t)) for i, t, _ in rows}
    for lang in ("en", None):
        own = {t: i for i, t, x in rows if x == lang and not failed[i]}
        df = Counter(w for t in own for w in set(plain(t)) if len(w) <= q.MAX_WORD)
        common = [w for w, _ in sorted(df.items(), key=lambda e: (-e[1], e[0]))][:q.N_COMMON]

        def hist(t):
            c = Counter(q._class_of(x) for x in t)
            w, n = Counter(plain(t)), max(1, len(plain(t)))
            known = [w[x] / n for x in common] + [0.0] * (q.N_COMMON - len(common))
            return np.array([c[k] / max(1, len(t)) for k in range(8)]), np.array(known + [(len(plain(t)) - sum(w[x] for x in common)) / n])

        def js(a, b):
            m = (a + b) / 2
            kl = lambda x: sum(v * np.log2(v / y) for v, y in zip(x, m) if v > 0)
            return max(0.0, (kl(a) + kl(b)) / 2) ** 0.5
        long = [hist(t) for t in own if len(t.split()) >= lim.min_words]
        ref = [np.mean([h[k] for h in long], 0) for k in (0, 1)]
        over = lambda t: js(hist(t)[1], ref[1]) - lim.slack / len(t.split()) ** 0.5
        e = sorted(over(t) for t in own if len(t.split()) >= lim.min_words)
        lo, hi = (e[int(np.ceil(x * len(e))) - 1] for x in (0.25, 0.75))
        top = min(lim.max_word, hi + lim.spread * (hi - lo))
        for i, t, x in rows:
            if x != lang:
                continue
            use_c, use_w = len(t) >= lim.min_chars, len(t.split()) >= lim.min_words
            assert (got[i].class_distance is not None, got[i].word_distance is not None) == (use_c, use_w)
            if use_c:
                assert abs(got[i].class_distance - js(hist(t)[0], ref[0])) < 1e-6
            if use_w:
                assert abs(got[i].word_distance - js(hist(t)[1], ref[1])) < 1e-6
            near = use_w and abs(over(t) - top) < 1e-9
            want = not failed[i] and not (use_c and js(hist(t)[0], ref[0]) > lim.max_class) and not (use_w and over(t) > top)
            assert near or got[i].kept == want
    assert {x.kept for x in got.values() if not x.base_failed} == {True, False}


def test_no_text_is_shuffled_whatever_repeats(make_docs, monkeypatch):
    """All texts occur twice: what is dealt by their hashes has no text in it."""
    seen = []
    write = quality_rules.write_shared
    monkeypatch.setattr(quality_rules, "write_shared", lambda df, name: seen.append((name, df._jdf.queryExecution().optimizedPlan().toString(), df.columns)) or write(df, name))
    docs = make_docs([(i % 50, f"some words of text number {i % 50} " * 6, "en") for i in range(100)])
    got, _ = quality_rules.judge(docs)
    assert got.count() == 100
    for name, plan, columns in seen:
        if "Aggregate" in plan:
            assert name == "rules-texts" and "text" not in columns and columns == ["lang", "n_words", "n_plain", "classes", "words"]
    assert {n for n, _, _ in seen} == {"rules-measures", "rules-texts"}
