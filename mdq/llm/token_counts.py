"""Exact token counts at every prefix by dynamic programming.

For a byte-pair vocabulary, the encoding of w[:i] ends in exactly one token t,
and what precedes t is the encoding of w[:i-len(t)]. So, over the prefixes of
a pre-token w, the last token and the count follow from those of a shorter
prefix:

    count[i] = count[i - len(t)] + 1

where t is the one vocabulary entry ending at i that the merges really leave
next to last[i - len(t)]. Whether two tokens stay next to each other is read
from the merge ranks: walk back from the pair to the pieces that once touched,
undoing the later merge first, and look for a merge across the border that
would have come before it.

``PrefixCounter`` keeps these tables, so that truncation and budget questions
are answered without encoding again. Byte-level vocabularies only (ids of
merges in rank order), as the given file is.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdq.llm.common import read_table
from mdq.llm.tokens import _LETTERS, _OTHER_SPACE, _SIMPLE, _SPACED, BYTE_BPE, Memo, byte_letters, text_groups, vocabulary

LIMIT = 512
LONG = 64                # characters; the prefixes of longer pieces are read from pre-tokens that are cut once

#: White space that the vocabulary's split knows beside ASCII's. Its runs are
#: kept whole, so texts with it may be cut in front of them as well.
_S = " \t\n\r\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WIDE_SPACED = re.compile(rf"[{_S}]*{_LETTERS}|[{_S}]*[^{_S}]+|[{_S}]+")
_CONTROL_SPACE = re.compile("[\x1c-\x1f]")

class PrefixCounter:
    """Token counts of a text and of all its prefixes."""

    def __init__(self, path: str, memo_size: int = 600_000):
        import ahocorasick
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("normalizer") or model.get("byte_fallback"):
            raise ValueError("a byte-level BPE file without normalizer is needed")
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.letters = byte_letters()
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special_re = re.compile("|".join(map(re.escape, special))) if special else None
        #: No token stands for more bytes than this.
        self.max_bytes = max(max(map(len, model["vocab"])), *(len(t.encode()) for t in special), 1)
        ids = {t: i for t, i in model["vocab"].items() if t not in special}
        self.merge_of: dict[int, int] = {}                     # a << 32 | b -> rank
        self.born: dict[int, tuple[int, int, int]] = {}        # token -> rank of its merge, left, right
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merge_of[ids[a] << 32 | ids[b]] = r
            self.born.setdefault(ids[a + b], (r, ids[a], ids[b]))
        self.ends = ahocorasick.Automaton()                    # all tokens that end at a place
        for t, i in ids.items():
            self.ends.add_word(t, (len(t), i))
        self.ends.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.max_pairs = 2_000_000
        self.memo = Memo(self.piece, memo_size)

    # -- the recurrence ----------------------------------------------------
    def adjacent(self, a: int, b: int) -> bool:
        """Do the merges leave tokens a and b side by side?"""
        x, y, limit = a, b, float("inf")
        while True:
            r = self.merge_of.get(x << 32 | y)
            if r is not None and r < limit:
                return False
            bx, by = self.born.get(x), self.born.get(y)
            if bx is None and by is None:
                return True
            if by is None or (bx is not None and bx[0] > by[0]):
                limit, x = bx[0], bx[2]            # the left token was made last: before that, its right part touched y
            else:
                limit, y = by[0] + 1, by[1]        # equal ranks: the merge further left comes first, so the border's wins

    def table(self, w: str) -> list[int]:
        """count[i] for every prefix of the pre-token w (byte-level letters)."""
        count, last, pairs = [0] * (len(w) + 1), [0] * (len(w) + 1), self.pairs
        if len(pairs) > self.max_pairs:
            pairs.clear()
        for end, (n, t) in self.ends.iter(w):      # longest first at each end
            i = end + 1
            if count[i]:
                continue
            j = i - n
            if j:
                if not count[j]:
                    raise ValueError("the vocabulary lacks a byte")
                key = last[j] << 32 | t
                ok = pairs.get(key)
                if ok is None:
                    ok = pairs[key] = self.adjacent(last[j], t)
                if not ok:
                    continue
            last[i], count[i] = t, count[j] + 1
        if w and not count[-1]:
            raise ValueError("the vocabulary lacks a byte")
        return count

    # -- pieces and texts --------------------------------------------------
    def piece(self, p: str) -> int:
        """Tokens of a piece of text that white space cuts off."""
        if _SIMPLE(p):                             # one pre-token
            return self.table(p.encode().decode("latin-1").translate(self.letters))[-1]
        if self.special_re is None or not self.special_re.search(p):
            return sum(self.table(w)[-1] for w, _ in self.split(p))
        return (sum(self.piece(x) for x in self.special_re.split(p) if x)
                + len(self.special_re.findall(p)))

    def cumulative(self, text: str) -> tuple[list[str], np.ndarray]:
        """The text's pieces, and the token count at the end of each."""
        if text.isascii() or not _OTHER_SPACE.search(text):
            pieces = _SPACED.findall(text)
        else:
            pieces = [text] if _CONTROL_SPACE.search(text) else _WIDE_SPACED.findall(text)
        return pieces, np.cumsum(np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces)))

    def prefixes(self, text: str) -> np.ndarray:
        """Exact token count of text[:i] for i = 0 .. len(text)."""
        out = np.zeros(len(text) + 1, np.int64)
        at, pieces, cum = 0, *self.cumulative(text)
        for k, p in enumerate(pieces):
            out[at + 1:at + len(p) + 1] = (cum[k - 1] if k else 0) + self.piece_prefixes(p)[1:]
            at += len(p)
        return out

    def piece_prefixes(self, p: str) -> np.ndarray:
        """Counts of p[:i] for i = 0 .. len(p)."""
        if len(p) <= LONG:
            return self.split_prefixes(p)
        units = self.units(p)
        return np.concatenate([[0]] + [self.unit_prefixes(p, units, j) for j in range(len(units[0]) - 1)]).astype(np.int64)

    def units(self, p: str) -> tuple[list[int], list[int]]:
        """Borders of the pre-tokens and special tokens of p, and the token
        count at each border."""
        at, cum, lo = [0], [0], 0
        specials = [m.span() for m in self.special_re.finditer(p)] if self.special_re is not None else []
        for start, end in [*specials, (len(p), len(p))]:
            for w, (_, e) in self.split(p[lo:start]) if start > lo else ():
                at.append(lo + e)
                cum.append(cum[-1] + self.table(w)[-1])
            if end > start:
                at.append(end)
                cum.append(cum[-1] + 1)
            lo = end
        return at, cum

    def unit_prefixes(self, p: str, units: tuple[list[int], list[int]], j: int) -> np.ndarray:
        """Counts of p[:i] for the ends i inside unit j, its border included.

        A cut inside a unit changes at most the split of the unit in front of it
        (white space hands its last character on, and in front of a special
        token it does not), so the splits start two units further ahead. Of a
        long unit, a run of one kind of characters, all but the shortest
        prefixes are a single pre-token, and one table has their counts."""
        at, cum = units
        lo, hi, base = at[j], at[j + 1], max(0, j - 2)
        near = hi if hi - lo <= LONG else lo + 4
        known: dict[str, int] = {}

        def count(q: str) -> int:
            if self.special_re is not None and self.special_re.search(q):
                return self.piece(q)
            total = 0
            for w, _ in self.split(q):
                if w not in known:
                    known[w] = self.table(w)[-1]
                total += known[w]
            return total

        out = [cum[base] + count(p[at[base]:i]) for i in range(lo + 1, near + 1)]
        if near < hi:
            raw = p[lo:hi].encode()
            table = np.array(self.table(raw.decode("latin-1").translate(self.letters)))
            ends = np.flatnonzero(np.append((np.frombuffer(raw, np.uint8)[1:] & 0xC0) != 0x80, True)) + 1
            out += (cum[j] + table[ends[near - lo:]]).tolist()
        return np.array(out, np.int64)

    def last_within(self, p: str, budget: int) -> int:
        """The largest i with at most ``budget`` tokens in p[:i]."""
        if len(p) <= LONG:
            return int(np.flatnonzero(self.split_prefixes(p) <= budget)[-1])
        p = p[:budget * self.max_bytes + 1]        # a longer prefix has more tokens than that
        units = self.units(p)
        at, cum = units
        # a prefix that ends in unit j holds all before unit j - 2, and more
        for j in range(min(int(np.searchsorted(cum, budget)) + 2, len(at) - 2), -1, -1):
            inside = np.flatnonzero(self.unit_prefixes(p, units, j) <= budget)
            if len(inside):
                return at[j] + int(inside[-1]) + 1
        return 0

    def split_prefixes(self, p: str) -> np.ndarray:
        """Counts of p[:i], each prefix split as it stands alone; the table of
        a pre-token that two prefixes share is filled once."""
        tables: dict[str, int] = {}
        out = np.zeros(len(p) + 1, np.int64)
        for i in range(1, len(p) + 1):
            q = p[:i]
            if self.special_re is not None and self.special_re.search(q):
                out[i] = self.piece(q)
                continue
            for w, _ in self.split(q):
                if w not in tables:
                    for m, c in enumerate(self.table(w)):
                        tables.setdefault(w[:m], c)
                out[i] += tables[w]
        return out

    def fit(self, cumulated, text: str, budget: int) -> int:
        """Length of the longest prefix with at most ``budget`` tokens. Pieces
        end at exact counts, so only the first piece beyond the budget is
        looked at by its own prefixes."""
        pieces, cum = cumulated
        if not len(cum) or cum[-1] <= budget:
            return len(text)
        k = int(np.searchsorted(cum, budget, side="right"))
        left = budget - (int(cum[k - 1]) if k else 0)
        # in front of the piece: what a longer prefix can add is inside it alone
        return sum(map(len, pieces[:k])) + self.last_within(pieces[k], left)


_COUNTERS: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) and fit_chars:
    the code points of the longest prefix of at most ``limit`` tokens.

    One row for each input row, repeated ids too; null text counts as empty
    (0 tokens); other columns are left out; an empty table gives no rows.
    """
    path = path or vocabulary(BYTE_BPE)

    def count(batches):
        c = _counter(path)
        for b in batches:
            for lo, hi in text_groups(b.column(1)):
                part = [t or "" for t in b.column(1).slice(lo, hi - lo).to_pylist()]
                n, fit = [], []
                for t in part:
                    cumulated = c.cumulative(t)
                    n.append(int(cumulated[1][-1]) if len(cumulated[1]) else 0)
                    fit.append(c.fit(cumulated, t, limit))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(n, pa.int64()),
                                       pa.array([x > limit for x in n], pa.bool_()), pa.array(fit, pa.int64())],
                                      ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    return rows.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))
