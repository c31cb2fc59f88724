"""Bounds under repeated rows, high rates and clashing names; certificates; plain versions of the models."""
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mdq.llm import fingerprints, language_id, mixing, packing, quality_classifier, simhash, warc
from mdq.llm.common import free_prefix, quoted
from mdq.llm.tokens import BYTE_BPE, WORD_BPE, PieceEncoder, vocabulary


@pytest.mark.parametrize("name,spaces", [(BYTE_BPE, True), (WORD_BPE, False)])
def test_every_letter_before_every_mark(name, spaces):
    letters = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x180))]
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = [f"{a}{m}" for a in letters for m in marks] + [f"x{a}{m} y{a}{m}{a}" for a in letters for m in marks]
    texts += ["İ.", "AKİ, su", "İİ!İ", "i̇. İstanbul, İ", "xİ\n.İ-"]
    tok, enc = Tokenizer.from_file(vocabulary(name)), PieceEncoder(vocabulary(name), spaces, memo_size=5000)
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode(pa.array(texts))]
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []


# -- packing certificate -----------------------------------------------------
def test_the_certificate_bounds_the_packing(ready):
    r = np.random.default_rng(5)
    for high, per in ((4096, 200), (1500, 300), (4096, 50_000)):
        lengths = r.integers(1, high + 1, 3000)
        df = ready.createDataFrame([(int(n),) for n in lengths], "length bigint")
        got = packing.pack_certified(df, per_partition=per)
        used = got.rows.select("sequence_id").distinct().count()
        cert = got.certificate.collect()
        assert used == got.sequences >= got.bound == packing.lower_bound(lengths)
        first = [c for c in cert if c["round"] == 0]
        assert sum(c.pieces for c in first) == 3000 and sum(c.bins for c in first) >= used
        assert all(c.bins >= c.bound >= 1 and c.gap == c.bins - c.bound and 0 <= c.given <= c.bins for c in cert)
        assert used <= got.bound * 1.03 + 2
    empty = packing.pack_certified(ready.createDataFrame([], "length bigint"))
    assert (empty.sequences, empty.bound, empty.rows.count(), empty.certificate.count()) == (0, 0, 0, 0)


def test_own_names_in_the_input_are_kept(ready, make_docs):
    assert free_prefix(["a", "PK__x", "_pk__"], "pk") == "__pk__" and free_prefix(["PK__x"], "pk") == "_pk__"
    odd = ["pk__uid", "pk_part", "a.b", "c`d", "sequence_id"]
    df = ready.createDataFrame([(5, *["mine"] * 5)] * 3, "length bigint, " + ", ".join(f"{quoted(c)} string" for c in odd))
    rows = packing.pack(df).collect()
    assert len(rows) == 3 and all(r["pk_part"] == r["a.b"] == r["c`d"] == r["pk__uid"] == "mine" for r in rows)
    text = "one two three four five six seven"
    docs = make_docs([(1, text), (2, text + " eight nine"), (3, None)], extra=["sd__id", "sd__hash", "li__", "mx_u", "mx__u", "mx_n", "root", "x.y"])
    for got in (simhash.keep_one(docs), language_id.identify(docs, language_id.fit(docs)), mixing.mix(docs, total=1000.0),
                language_id.keep_known(docs, language_id.fit(docs))):
        assert set(docs.columns) <= set(got.columns)
        assert all(r["sd__id"] == r["li__"] == r["mx_u"] == r["mx__u"] == r["x.y"] == "x" for r in got.collect())


# -- mixing ------------------------------------------------------------------
def test_high_rates_need_no_long_array(ready, make_docs):
    docs = make_docs([(i, "x" * 999, "en", "big") for i in range(400)] + [(900, None, "en", None), (901, "", "en", None), (901, "", "en", None)])
    r = {x.mx_group: x for x in mixing.rates(docs).collect()}
    assert r[None].mx_rate > 60_000 and r[None].mx_parts == -(-int(np.ceil(r[None].mx_rate)) // 64)
    assert max(len(x.mx_cdf) for x in r.values()) <= 201
    got = mixing.mix(docs)
    n = {(x.doc_id, x.source): (x.n, x.top, x.d) for x in got.groupBy("doc_id", "source").agg(
        F.count("*").alias("n"), F.max("copy").alias("top"), F.countDistinct("copy").alias("d")).collect()}
    rate = r[None].mx_rate
    assert abs(n[900, None][0] - rate) < 6 * rate ** 0.5 and n[900, None][0] == n[900, None][1] == n[900, None][2]
    assert n[901, None][0] == 2 * n[901, None][1]                       # equal rows of one id get the same count
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_high_rates_in_sql(tables, make_docs):
    import duckdb
    from check_oracle import norm_rows
    docs = make_docs([(i, "é" * 30, "en", f"s{i % 2}") for i in range(300)] + [(7, None, "en", None), (8, "a", "en", "tiny")])
    root = tables(documents=docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{root}/documents.parquet/*.parquet')")
    df = mixing.op9_mixing(docs.sparkSession, root)
    rel = con.sql(mixing.OP9_SQL)
    assert norm_rows(df.columns, [tuple(r) for r in df.collect()]) == norm_rows(rel.columns, rel.fetchall())


# -- samples of the models ---------------------------------------------------
def test_training_samples_are_bounded_whatever_repeats(ready, make_docs, monkeypatch):
    rows = [(7, "the same words again", "en")] * 3000 + [(i, f"words of number {i} go here", ["en", "de"][i % 2]) for i in range(100, 400)]
    docs = make_docs(rows)
    held = []
    fit = language_id.train_svm
    monkeypatch.setattr(language_id, "train_svm", lambda x, y, **k: held.append(len(x)) or fit(x, y, **k))
    model = language_id.fit(docs, per_language=20)
    assert 10 < max(held) <= 80 and sorted(sum(model.members, [])) == ["de", "en"]
    assert len(sum(language_id.fit(docs, per_language=20, max_languages=1).members, [])) == 1
    labels = ready.createDataFrame([(7, 1)] * 500 + [(i, i % 2) for i in range(100, 400)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality_classifier, "train", lambda x, y, seed: seen.append((len(x), sorted(set(y.tolist())))) or quality_classifier.Network.start(seed))
    quality_classifier.fit(docs, labels, max_rows=60)
    assert 20 < seen[0][0] <= 120 and seen[0][1] == [0, 1]
    quality_classifier.fit(make_docs([(5, "x" * 20_000)] + [(6, "y" * 3000)]), ready.createDataFrame([(5, 1), (6, 0)], "doc_id bigint, quality int"), max_bytes=9000)
    assert seen[1][0] <= 1


def test_all_chunks_of_a_chosen_text_are_learned_from(ready, make_docs, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    seen = []
    monkeypatch.setattr(quality_classifier, "train", lambda x, y, seed: seen.extend(len(c) for c in x) or quality_classifier.Network.start(seed))
    text = "a b " * 5000
    quality_classifier.fit(make_docs([(ids[0], text), (ids[1], "short")]), ready.createDataFrame([(ids[0], 1), (ids[1], 0)], "doc_id bigint, quality int"))
    assert sorted(seen) == [1, len(quality_classifier.chunk_starts(len(text)))]


# -- plain versions ----------------------------------------------------------
def test_network_scores_equal_a_plain_forward_pass():
    q = quality_classifier
    net = q.Network.start(3)
    r = np.random.default_rng(1)
    for k in ("bias", "hidden_bias", "out_bias"):
        getattr(net, k)[:] = r.standard_normal(getattr(net, k).shape) * 0.1
    texts = [b"", b"a", b"some words, here." * 3, bytes(r.integers(0, 256, 700, dtype=np.uint8)), b"long text " * 400]
    for text, got in zip(texts, net.scores(texts)):
        pooled = []
        for s in q.chunk_starts(len(text)):
            chunk = [b for b in text[s:s + q.CHUNK]] + [q.PAD] * max(0, q.CHUNK - len(text[s:s + q.CHUNK]))
            best = np.full(q.FILTERS, -np.inf)
            for w in range(q.N_WINDOWS):
                x = np.concatenate([net.embed[b] for b in chunk[w * q.STRIDE:w * q.STRIDE + q.WIDTH]]).astype(float)
                best = np.maximum(best, x @ net.filters.astype(float))
            pooled.append(np.maximum(best + net.bias, 0))
        x = np.concatenate([np.mean(pooled, 0), np.max(pooled, 0), [min(len(text), q.CHUNK) / q.CHUNK]])
        h = np.maximum(x @ net.hidden + net.hidden_bias, 0)
        assert abs(1 / (1 + np.exp(-(h @ net.out + net.out_bias[0]))) - got) < 1e-4


def test_language_answers_equal_plain_machines_and_votes(ready, make_docs):
    words = {"en": "the of and to in that is was for", "de": "der die und das ist von nicht mit ein", "es": "el la de que y en los se del",
             "fr": "le la les des est une dans pour qui", "nl": "de het een van en dat niet met voor"}
    r = np.random.default_rng(2)
    docs = make_docs([(i, " ".join(r.choice(words[x].split(), 40)), x) for i, x in enumerate(list(words) * 30)])
    m = language_id.fit(docs)
    texts = [" ".join(r.choice(" ".join(words.values()).split(), 25)) for _ in range(200)] + ["", None, "123 45", "der the el"]
    got_lang, got_score = m.predict(texts)
    sig = lambda z: 1 / (1 + np.exp(-4 * z))
    for t, lang, score in zip(texts, got_lang, got_score):
        if not t or not any(c.isalpha() for c in t):
            assert (lang, score) == ("und", 0.0)
            continue
        z = [float(language_id.features(t).astype(float) @ m.weights[:, k].astype(float) + m.bias[k]) for k in range(m.weights.shape[1])]
        answers = [sig(x) for x in z[:len(m.families)]]
        f = int(np.argmax(answers))
        names = m.members[f]
        votes, trust = [0] * len(names), [0.0] * len(names)
        for (g, i, j), x in zip(m.pairs, z[len(m.families):]):
            if g == f:
                q = sig(x)
                votes[i if q >= 0.5 else j] += 1
                trust[i] += q
                trust[j] += 1 - q
        k = max(range(len(names)), key=lambda n: votes[n] + trust[n] / (len(names) + 1))
        inside = trust[k] / (len(names) - 1) if len(names) > 1 else 1.0
        assert lang == names[k] and abs(score - answers[f] / sum(answers) * inside) < 1e-3


def test_fingerprint_strings_equal_plain_bottom_k(ready, make_docs):
    """The fingerprint holds the 128 smallest of the distinct shingle hashes, in order."""
    docs = make_docs([(1, " ".join(f"w{i}" for i in range(400))), (2, "a b c"), (3, ""), (4, "x y z " * 50)])
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", fingerprints.word_hashes(F.col("text")).alias("h")).collect()}
    got = {r.doc_id: r.f for r in docs.select("doc_id", fingerprints.to_text(
        fingerprints.sketch_column(fingerprints.word_hashes(F.col("text")), 128)).alias("f")).collect()}
    direct = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint_edits(docs).collect()}
    assert got == direct
    for d, text in got.items():
        parts = [int(text[i:i + 16], 16) for i in range(0, len(text), 16)]
        assert parts == sorted(set(parts)) and len(parts) <= 128
        assert (d == 3) == (not parts)
    assert len(got[1]) == 128 * 16 and hashes[1] is not None and len({*got.values()}) == 4


# -- archives ----------------------------------------------------------------
def test_frames_are_read_by_many_tasks(ready, tmp_path, monkeypatch):
    rows = [(i, f"http://h/{i}", hashlib.sha256(str(i).encode()).hexdigest() * 200) for i in range(60)]
    pages = ready.createDataFrame(rows, "page_id bigint, url string, html string").repartition(1)
    index = warc.write_bundles(pages, str(tmp_path / "b"), frame_bytes=20_000)
    assert index.select("file", "frame").distinct().count() >= 30
    monkeypatch.setattr(warc, "TASK_BYTES", 40_000)
    got = warc.read_bundles(index)
    tasks = got.select(F.spark_partition_id().alias("p"), "page_id").groupBy("p").count().collect()
    assert len(tasks) >= 8 and sum(r["count"] for r in tasks) == 60
    found = warc.fetch(index, ready.createDataFrame([(3,), (3,), (59,), (None,), (1000,)], "page_id bigint"))
    assert sorted(r.page_id for r in found.collect()) == [3, 59]
    assert warc.fetch(index.limit(0), ready.createDataFrame([(3,)], "page_id bigint")).count() == 0
