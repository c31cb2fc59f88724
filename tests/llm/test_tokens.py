"""Piece encoder, prefix counts, packing and token files against the library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from conftest_llm import ODD
from mdq.llm import packing, token_counts, token_files
from mdq.llm.tokens import BYTE_BPE, WORD_BPE, PieceEncoder, text_groups, vocabulary


def samples(n, seed=3):
    r = random.Random(seed)
    letters = "aábßé <|endoft>'ls\n\t  1#日 😀\xa0\x1cÉ.,"
    fixed = ["", " ", "  a", "a  ", "a ", "\na", "a \n b", "a\n\n\nb", "it's it'll 'd", "a<|endoftext|> b <|endoftext|>",
             "x" * 300, "\xa0  the", "foo　 bar", "<|startoftext|>a <|endoftext|", "\r\n\r\n a", "12 3456 78,9"]
    return fixed + ["".join(r.choice(letters) for _ in range(r.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("name,spaces", [(BYTE_BPE, True), (WORD_BPE, False)])
def test_pieces_encode_as_the_library_does(name, spaces):
    texts = samples(3000)
    tok, enc = Tokenizer.from_file(vocabulary(name)), PieceEncoder(vocabulary(name), spaces, memo_size=500)
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    for lo, hi in text_groups(pa.array(texts), 2000):
        got = enc.encode(pa.array(texts[lo:hi]))
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want[lo:hi]
    assert enc.encode(pa.array([None, ""], pa.string())) == [b"", b""]
    assert enc.encode(pa.array([], pa.string())) == []


def test_prefix_counts_are_exact_at_every_prefix():
    tok, c = Tokenizer.from_file(vocabulary(BYTE_BPE)), token_counts.PrefixCounter(vocabulary(BYTE_BPE))
    n = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    for t in samples(250):
        want = [n(t[:i]) for i in range(len(t) + 1)]
        assert c.prefixes(t).tolist() == want
        for budget in (0, 3, 9):
            assert c.fit(c.cumulative(t), t, budget) == max(i for i, x in enumerate(want) if x <= budget)


def test_prefix_counts_of_long_pieces():
    tok, c = Tokenizer.from_file(vocabulary(BYTE_BPE)), token_counts.PrefixCounter(vocabulary(BYTE_BPE))
    n = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    r = random.Random(4)
    parts = ["a" * 90, "日本語" * 40, "." * 70, " " * 80, "\xa0" * 70, "1" * 70, "<|endoftext|>", "<|endo", "'ll", "é", " b", "\x1c", "\u3000", "、"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(2, 7))) for _ in range(60)]
    for t in texts + ["\x1c" + "".join(samples(6, seed)[-6:]) for seed in range(40)]:
        want = [n(t[:i]) for i in range(len(t) + 1)]
        assert c.piece_prefixes(t).tolist() == want and c.prefixes(t).tolist() == want
        for budget in (0, 2, 7, 20):
            best = max(i for i, x in enumerate(want) if x <= budget)
            assert c.last_within(t, budget) == best and c.fit(c.cumulative(t), t, budget) == best


def test_very_long_texts_come_to_an_end(make_docs):
    import time
    tok, c = Tokenizer.from_file(vocabulary(BYTE_BPE)), token_counts.PrefixCounter(vocabulary(BYTE_BPE))
    r = random.Random(5)
    words = " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9))) for _ in range(180_000))
    chinese = "".join(chr(r.randint(0x4E00, 0x9FA5)) if r.random() > 0.05 else r.choice("，。") for _ in range(350_000))
    for t in (words[:500_000] + "\xa0" + words[500_000:], "\x1c" + words, chinese, "天" * 350_000, "ab1" * 300_000):
        began = time.monotonic()
        cumulated = c.cumulative(t)
        got = c.fit(cumulated, t, 512)
        assert time.monotonic() - began < 60
        assert int(cumulated[1][-1]) == len(tok.encode(t, add_special_tokens=False).ids)
        # every prefix up to the point where even the longest tokens cannot fit is counted near the border
        counts = [len(e.ids) for e in tok.encode_batch([t[:i] for i in range(max(0, got - 20), got + 150)], add_special_tokens=False)]
        assert max(i for i, x in enumerate(counts) if x <= 512) + max(0, got - 20) == got


def test_token_counts_rows(make_docs):
    tok = Tokenizer.from_file(vocabulary(BYTE_BPE))
    docs = make_docs(ODD, extra=["n_tokens", "over_limit"])
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs).collect())
    want = sorted((d or -1, len((t or "").encode()), n, n > 512) for d, t in ODD
                  for n in [len(tok.encode(t or "", add_special_tokens=False).ids)])
    assert got == want
    assert token_counts.token_counts(make_docs([])).count() == 0


def test_token_files_round_trip(make_docs, tmp_path):
    tok = Tokenizer.from_file(vocabulary(BYTE_BPE))
    docs = make_docs(ODD, extra=["ids", "start"])
    manifest = token_files.write_token_files(docs, str(tmp_path / "f"), tokens_per_file=50)
    got = sorted(token_files.read_token_files(manifest).collect(), key=lambda r: r.start)
    assert manifest.count() > 1
    assert [r.doc_id for r in got] == sorted((d for d, _ in ODD), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    want = sorted((d or -1, [*tok.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in ODD)
    assert sorted((r.doc_id or -1, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    empty = token_files.write_token_files(make_docs([]), str(tmp_path / "e"))
    assert empty.count() == 0 and token_files.read_token_files(empty).count() == 0


def test_token_files_first_positions(ready):
    r = np.random.default_rng(4)
    rows = [((int(t) << 24) + i, f"f{t}-{i}", 1, int(r.integers(0, 1 << 40)), 10) for t in (0, 2, 3, 9) for i in range(int(r.integers(1, 30)))]
    shuffled = [rows[i] for i in r.permutation(len(rows))]
    manifest = ready.createDataFrame(shuffled, token_files.MANIFEST).repartition(5)
    got = {x.file: x.base for x in token_files.first_positions(manifest).collect()}
    ends = np.cumsum([x[3] for x in rows])
    assert got == {x[1]: int(e) - x[3] for x, e in zip(rows, ends)}
    cores = 2 * ready.sparkContext.defaultParallelism
    assert token_files._tasks(manifest) == min(len(rows), cores)
    many = ready.range(50_000).selectExpr("id AS part", "'f' AS file", "1L AS n_docs", "1L AS n_tokens", "4000000L AS n_bytes")
    assert token_files._tasks(many) == -(-50_000 * 4_000_000 // token_files.READ_BYTES)       # grows with the bytes
    assert token_files._tasks(many.limit(0)) == 1


def test_byte_coding_of_all_widths():
    r = np.random.default_rng(0)
    for ids in (np.zeros(0), r.integers(0, 200, 7), r.integers(0, 70_000, 200_000), np.arange(70_003), np.array([5] * 9 + [1 << 20])):
        ids = ids.astype(np.uint32)
        table, control, data = token_files.pack(ids)
        assert (token_files.unpack(table, control, data, len(ids)) == ids).all()
        counts = np.bincount(ids) if len(ids) else np.zeros(1)
        assert (np.diff(counts[table]) <= 0).all()
    assert token_files.unpack(np.arange(1 << 25, dtype=np.uint32), np.array([3 | 2 << 2 | 1 << 4], np.uint8),
                              np.array([1, 0, 0, 1, 7, 0, 1, 9, 1, 4], np.uint8), 4).tolist() == [(1 << 24) + 1, 65543, 265, 4]


# -- packing -----------------------------------------------------------------
def test_pieces_and_packing(make_docs):
    tok = Tokenizer.from_file(vocabulary(WORD_BPE))
    docs = make_docs(ODD, extra=["sequence_id", "length"])
    rows = packing.packed_documents(docs).collect()
    want = sorted((d or -1, k // 4096, k, len(x[k:k + 4096]), zlib.crc32(np.array(x[k:k + 4096], "<u4").tobytes()))
                  for d, t in ODD for x in [[*tok.encode(t or "", add_special_tokens=False).ids, 1]] for k in range(0, len(x), 4096))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    check_sequences(rows)
    assert packing.packed_documents(make_docs([])).count() == 0


def check_sequences(rows, capacity=4096):
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values(), default=0) <= capacity
    return len(at)


@pytest.mark.parametrize("high", [4096, 1500, 90])
def test_exchange_of_many_partitions_stays_near_the_bound(ready, high):
    r = np.random.default_rng(high)
    lengths = r.integers(1, high + 1, 3000)
    df = ready.createDataFrame([(int(i), int(n)) for i, n in enumerate(lengths)], "doc_id bigint, length bigint")
    rows = packing.pack(df, per_partition=200).collect()
    assert sorted(x.doc_id for x in rows) == list(range(3000))
    n, bound = check_sequences(rows), packing.lower_bound(lengths)
    assert bound <= n <= bound * 1.03 + 2


def test_lower_bound_never_exceeds_an_optimum():
    r = np.random.default_rng(1)
    for _ in range(300):
        cap = int(r.integers(5, 60))
        n = int(r.integers(1, 12))
        pieces = []
        for _ in range(n):                      # cut n full bins: the optimum is n
            cuts = np.unique(r.integers(1, cap, int(r.integers(0, 4))))
            pieces += np.diff(np.concatenate([[0], cuts, [cap]])).tolist()
        lengths = np.array(pieces)
        assert packing.lower_bound(lengths, cap) == n
        some = lengths[r.random(len(lengths)) < 0.7]
        bins, offsets, left = packing.best_fit_decreasing(some, cap)
        assert packing.lower_bound(some, cap) <= min(n, len(left))
        assert (left == cap - np.bincount(bins, some, minlength=len(left))).all() and (left >= 0).all()
    assert packing.lower_bound(np.array([], int)) == 0
    assert packing.lower_bound(np.array([2049] * 10)) == 10
    assert packing.lower_bound(np.array([1366] * 9)) == 5          # two to a sequence, which the sum alone does not see
