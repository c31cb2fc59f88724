"""Quality rules: divergence of a document's histograms from its language's.

A document's characters are counted in classes (small and capital letters,
digits, spaces, sentence marks, symbols, others) and its words in one bin for
each common word of its language and one for all other words. Both histograms
are compared with references, the means over the language's distinct texts that
pass the base rules, by the Jensen-Shannon distance (0 to 1), so that neither
copies nor base-failed junk move a reference. A document is kept if
neither distance passes its limit. Short documents have ragged histograms, so a
comparison is made only from a minimum length on.

Beside these stand the base counts: words, symbols, repeated lines, and words
in repeated eight-word windows.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from mdq.llm.common import quoted, read_table, write_shared

SYMBOLS = "#*$%&|<>"
SENTENCE = ".,;:!?'\"()-"
N_COMMON = 60
N_CANDIDATES = 400       # of each language, the words among which the common ones are
WINDOW = 8
SLICE = 1000             # rows whose texts a task holds as Python strings
MAX_WORD = 40            # bytes; a longer word is never a common one
TEXT = ["lang", "h1", "h2"]
CLASSES = ["small", "capital", "other letter", "digit", "space", "sentence", "symbol", "other"]


@dataclass(frozen=True)
class Limits:
    """Documents with a histogram of at least ``min_chars`` characters (or
    ``min_words`` words) are compared. ``max_class`` is the largest class
    distance kept. Of a word distance ``slack`` / sqrt(words) is put down to
    chance: the distance of a sample from its own distribution falls with the
    square root of its size; the rest may be as large as ``word_limits`` finds
    for the language (``spread``, ``min_texts``, at most ``max_word``). Base
    rules: fewer than ``base_words`` words, or more than ``base_repeat`` percent
    of words in repeated windows, fail."""
    min_chars: int = 250
    min_words: int = 30
    max_class: float = 0.30
    max_word: float = 0.30
    slack: float = 1.2
    spread: float = 1.5
    min_texts: int = 30
    base_words: int = 20
    base_repeat: int = 30


def _class_of(c: str) -> int:
    if c in " \t\n\x0b\x0c\r":
        return 4
    if c in SENTENCE:
        return 5
    if c in SYMBOLS:
        return 6
    kind = unicodedata.category(c)
    return {"Ll": 0, "Lu": 1, "Lt": 1, "Nd": 3}.get(kind, 2 if kind[0] == "L" else 7)


_TABLE = np.array([_class_of(chr(i)) for i in range(0x3000)], np.uint8)
_SYMBOL_BYTES = np.array([ord(c) for c in SYMBOLS])
#: ASCII letters made small, ASCII marks and control bytes to spaces.
_PLAIN = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))
_FACTORS = np.random.default_rng(8).integers(1, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def class_counts(text: str) -> np.ndarray:
    if text.isascii():
        by = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=128)
        return np.bincount(_TABLE[:128], by[:128], minlength=len(CLASSES)).astype(np.int64)
    p = np.frombuffer(text.encode("utf-32-le"), "<u4")
    out = np.bincount(_TABLE[p[p < 0x3000]], minlength=len(CLASSES)).astype(np.int64)
    far, n = np.unique(p[p >= 0x3000], return_counts=True)
    for c, k in zip(far.tolist(), n.tolist()):
        out[_class_of(chr(c))] += k
    return out


def repeated_words(words: list[bytes]) -> int:
    """Words inside eight-word windows that occur at least twice."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.uint64, len(words))
    h = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        h += ids[j:j + n] * _FACTORS[j]
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(h, twice))
    view = np.lib.stride_tricks.sliding_window_view(ids, WINDOW)
    order = at[np.argsort(h[at], kind="stable")]
    same = h[order[1:]] == h[order[:-1]]
    if not (view[order[1:][same]] == view[order[:-1][same]]).all():      # unequal windows of one hash
        _, which, n_of = np.unique(view[at], axis=0, return_inverse=True, return_counts=True)
        at = at[n_of[which.reshape(-1)] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str, known: dict[bytes, int]) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class
    counts, numbers and counts of the words in ``known``, plain words) of a text."""
    raw = text.encode()
    words = raw.split()
    by_class = class_counts(text)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    plain = raw.translate(_PLAIN).split()
    found = Counter(map(known.get, plain)) if known else Counter()
    found.pop(None, None)
    return (len(words), int(by_class.sum() - by_class[4]), int(by_class[6]), len(lines) - len(set(lines)),
            repeated_words(words), by_class, np.array([*found.items()], "<u4").reshape(-1, 2), len(plain))


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Square root of the Jensen-Shannon divergence (base 2) of rows of p and q."""
    m = (p + q) / 2

    def kl(a):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0).sum(-1)
    return np.sqrt(np.clip((kl(p) + kl(q)) / 2, 0, 1))


# -- what the corpus has in common ------------------------------------------
def candidate_words(rows: DataFrame, n: int = N_CANDIDATES) -> dict[str, dict[bytes, int]]:
    """For each language the ``n`` words that occur in most texts (ties by the
    word), numbered: among them are the common words. A text that a task meets
    again is passed over, so a group of copies adds at most one for each task.
    Tasks add up their words before the shuffle and hand counts on when they
    hold 150,000 words."""
    def add_up(batches):
        held, seen = {}, set()

        def emit():
            out = [(lang, w, k) for lang, c in held.items() for w, k in c.items()]
            held.clear()
            for lo in range(0, len(out), 50_000):
                lang, w, k = zip(*out[lo:lo + 50_000])
                yield pa.record_batch([pa.array(lang, pa.string()), pa.array(w, pa.binary()), pa.array(k, pa.int64())], ["lang", "word", "n"])
        for lang, h, text in (row for whole in batches for lo in range(0, whole.num_rows, SLICE)
                              for row in zip(*(whole.slice(lo, SLICE).column(c).to_pylist() for c in ("lang", "h1", "text")))):
            if (lang, h) in seen:
                continue
            if len(seen) > 100_000:
                seen.clear()
            seen.add((lang, h))
            held.setdefault(lang, Counter()).update(set(text.encode().translate(_PLAIN).split()))
            if sum(map(len, held.values())) > 150_000:
                yield from emit()
        yield from emit()

    by = W.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (rows.select("lang", "h1", "text").mapInArrow(add_up, "lang string, word binary, n bigint").filter(F.length("word") <= MAX_WORD)
           .groupBy("lang", "word").agg(F.sum("n").alias("n")).withColumn("k", F.row_number().over(by)).filter(F.col("k") <= n))
    out: dict[str, dict[bytes, int]] = {}
    for r in top.collect():                                   # n rows of each language
        out.setdefault(r["lang"], {})[bytes(r["word"])] = r["k"] - 1
    return out


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = ", ".join(f"{c} bigint" for c in COUNTS) + ", n_plain bigint, classes binary, words binary"


def measure_batch(lang: list[str], text: list[str], words: dict[str, dict[bytes, int]]) -> pa.RecordBatch:
    """The columns of MEASURES: classes and words hold 32-bit numbers, a count
    for each class, and number and count of each word that occurs."""
    got = [measure(t, words.get(x, {})) for x, t in zip(lang, text)]
    cols = list(zip(*got)) or [()] * 8
    raw = lambda c, kind: pa.array([x.astype(kind).tobytes() for x in c], pa.binary())
    return pa.record_batch([*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[7], pa.int64()), raw(cols[5], "<u4"), raw(cols[6], "<u4")],
                           [x.split(" ")[0] for x in MEASURES.split(", ")])


def measures(rows: DataFrame, words: dict[str, dict[bytes, int]], names: list[str], text: str = "text") -> DataFrame:
    """The measures of each row, beside its columns ``names``, written once: no
    text is split a second time. ``text``: the column that holds it."""
    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                b = whole.slice(lo, SLICE)
                m = measure_batch(b.column("lang").to_pylist(), [t or "" for t in b.column(text).to_pylist()], words)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *m.columns], names=names + m.schema.names)
            pa.default_memory_pool().release_unused()
    rows = rows.select(*dict.fromkeys([*names, text]))
    schema = T.StructType([rows.schema[n] for n in names] + T.StructType.fromDDL(MEASURES).fields)
    return write_shared(rows.mapInArrow(run, schema), "rules-measures")


def distinct_texts(m: DataFrame, limits: Limits) -> DataFrame:
    """The measures of each distinct text that passes the base rules, once. Texts
    are told apart by two hashes; measures move, never texts."""
    passed = m.filter((F.col("n_words") >= limits.base_words) & (100 * F.col("n_repeat_words") <= limits.base_repeat * F.col("n_words")))
    return write_shared(passed.select(*TEXT, "n_words", "n_plain", "classes", "words").dropDuplicates(TEXT).drop("h1", "h2"), "rules-texts")


def common_words(texts: DataFrame, words: dict[str, dict[bytes, int]], n: int = N_COMMON) -> dict[str, np.ndarray]:
    """For each language the bin of each candidate: the ``n`` words that occur
    in most of the distinct texts (ties by the word) have bins 0, 1, ...; any
    other has bin n. The driver gets a count for each candidate."""
    def add_up(batches):
        held: dict = {}
        for b in batches:
            for lang, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                np.add.at(held.setdefault(lang, np.zeros(N_CANDIDATES, np.int64)), np.frombuffer(raw, "<u4")[::2], 1)
        for lang, c in held.items():
            yield pa.record_batch([pa.array([lang] * len(c)), pa.array(np.arange(len(c), dtype=np.int32)), pa.array(c)], ["lang", "k", "n"])

    found = texts.select("lang", "words").mapInArrow(add_up, "lang string, k int, n bigint").groupBy("lang", "k").agg(F.sum("n").alias("n"))
    counts = {(r["lang"], r["k"]): r["n"] for r in found.filter("n > 0").collect()}
    bins = {}
    for lang, own in words.items():
        best = sorted((-counts[lang, k], w, k) for w, k in own.items() if (lang, k) in counts)[:n]
        bins[lang] = np.full(N_CANDIDATES, n)
        bins[lang][[k for _, _, k in best]] = np.arange(len(best))
    return bins


def histograms(classes: list[bytes], words: list[bytes], n_plain: np.ndarray, lang: list[str], bins: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Class counts and counts of the common words (last bin: all others) of a batch."""
    n = len(lang)
    cls = np.frombuffer(b"".join(classes), "<u4").reshape(n, len(CLASSES)).astype(np.float64)
    wrd = np.zeros((n, N_COMMON + 1))
    for i, raw in enumerate(words):
        x = np.frombuffer(raw, "<u4")
        if len(x):
            np.add.at(wrd[i], bins[lang[i]][x[::2]], x[1::2])
    wrd[:, N_COMMON] = n_plain - wrd[:, :N_COMMON].sum(1)
    return cls, wrd


def _columns(b: pa.RecordBatch) -> tuple:
    return (b.column("classes").to_pylist(), b.column("words").to_pylist(), b.column("n_plain").to_numpy(), b.column("lang").to_pylist())


def references(texts: DataFrame, bins: dict[str, np.ndarray], limits: Limits) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each language the mean class histogram and the mean histogram of its
    common words over its distinct texts that are long enough. Tasks add up;
    the driver gets a number for each language and bin."""
    def add_up(batches):
        held: dict = {}
        for b in batches:
            cls, wrd = histograms(*_columns(b), bins)
            both = np.concatenate([cls / np.maximum(cls.sum(1), 1)[:, None], wrd / b.column("n_plain").to_numpy()[:, None], np.ones((len(cls), 1))], 1)
            for lang in set(lang_of := b.column("lang").to_pylist()):
                held[lang] = held.get(lang, 0) + both[np.array([x == lang for x in lang_of])].sum(0)
        for lang, v in held.items():
            yield pa.record_batch([pa.array([lang] * len(v)), pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], ["lang", "k", "v"])

    long = texts.filter((F.col("n_words") >= limits.min_words) & (F.col("n_plain") > 0))
    sums: dict = {}
    for r in long.mapInArrow(add_up, "lang string, k int, v double").groupBy("lang", "k").agg(F.sum("v").alias("v")).collect():
        sums.setdefault(r["lang"], np.zeros(len(CLASSES) + N_COMMON + 2))[r["k"]] = r["v"]
    return {lang: (v[:len(CLASSES)] / v[-1], v[len(CLASSES):-1] / v[-1]) for lang, v in sums.items()}


# -- distances and limits ----------------------------------------------------
def distances(b: pa.RecordBatch, bins: dict, refs: dict, limits: Limits) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distance of classes and of words, and whether each may be compared."""
    cls, wrd = histograms(*_columns(b), bins)
    lang, n_plain = b.column("lang").to_pylist(), b.column("n_plain").to_numpy()
    has = np.array([x in refs for x in lang], bool)
    nothing = (np.zeros(len(CLASSES)), np.zeros(N_COMMON + 1))
    both = [refs.get(x, nothing) for x in lang]
    qc = np.array([x[0] for x in both]).reshape(len(lang), len(CLASSES))
    qw = np.array([x[1] for x in both]).reshape(len(lang), N_COMMON + 1)
    chars = cls.sum(1)
    dc = js_distance(cls / np.maximum(chars, 1)[:, None], qc)
    dw = js_distance(wrd / np.maximum(n_plain, 1)[:, None], qw)
    return dc, dw, has & (chars >= limits.min_chars), has & (b.column("n_words").to_numpy() >= limits.min_words)


def excess(dw: np.ndarray, n_words: np.ndarray, limits: Limits) -> np.ndarray:
    """A word distance less what chance makes of a text of that length."""
    return dw - limits.slack / np.sqrt(np.maximum(n_words, 1))


def word_limits(texts: DataFrame, bins: dict, refs: dict, limits: Limits) -> dict[str, float]:
    """For each language the largest excess kept: the upper quartile of all its
    distinct texts that pass the base rules, and ``spread`` times the quartiles'
    distance above it, but no more than ``max_word``. (A fence of this kind cuts
    off what lies apart, and not a fixed share of any corpus.) Languages of
    fewer than ``min_texts`` such texts have ``max_word``."""
    def each(batches):
        for b in batches:
            _, dw, _, use = distances(b, bins, refs, limits)
            e = excess(dw, b.column("n_words").to_numpy(), limits)
            yield pa.record_batch([b.column("lang").filter(pa.array(use)), pa.array(e[use])], ["lang", "e"])
    q = texts.mapInArrow(each, "lang string, e double").groupBy("lang").agg(
        F.percentile_approx("e", F.array(F.lit(0.25), F.lit(0.75)), F.lit(10_000)).alias("q"), F.count("*").alias("n"))
    return {r["lang"]: min(limits.max_word, r["q"][1] + limits.spread * (r["q"][1] - r["q"][0])) if r["n"] >= limits.min_texts else limits.max_word
            for r in q.collect()}


@dataclass
class Rules:
    """Bins of the candidate words, references and word limits of a corpus."""
    words: dict[str, dict[bytes, int]]
    bins: dict[str, np.ndarray]
    refs: dict[str, tuple[np.ndarray, np.ndarray]]
    max_word: dict[str, float]
    limits: Limits

    @property
    def common(self) -> dict[str, list[bytes]]:
        """The common words of each language, in the order of their bins."""
        return {lang: [w for _, w in sorted((self.bins[lang][k], w) for w, k in own.items() if self.bins[lang][k] < N_COMMON)]
                for lang, own in self.words.items()}

    def verdict(self, b: pa.RecordBatch) -> tuple:
        """(base failed, kept, class distance, word distance) of a batch of
        measures with lang; distances that a guard leaves out are null."""
        lim = self.limits
        n_words, n_repeat = (b.column(x).to_numpy() for x in ("n_words", "n_repeat_words"))
        dc, dw, use_c, use_w = distances(b, self.bins, self.refs, lim)
        top = np.array([self.max_word.get(x, lim.max_word) for x in b.column("lang").to_pylist()])
        failed = (n_words < lim.base_words) | (100 * n_repeat > lim.base_repeat * n_words)
        kept = ~failed & ~(use_c & (dc > lim.max_class)) & ~(use_w & (excess(dw, n_words, lim) > top))
        return pa.array(failed), pa.array(kept), pa.array(dc, mask=~use_c), pa.array(dw, mask=~use_w)


def fit(rows: DataFrame, names: list[str], limits: Limits, text: str = "text") -> tuple[DataFrame, Rules]:
    """Measures of all rows (with lang and the columns ``names``), and the rules."""
    words = candidate_words(rows)
    m = measures(rows, words, [*names, *TEXT], text)
    texts = distinct_texts(m, limits)
    bins = common_words(texts, words)
    refs = references(texts, bins, limits)
    return m, Rules(words, bins, refs, word_limits(texts, bins, refs, limits), limits)


VERDICTS = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean, class_distance double, word_distance double"


def _plain(docs: DataFrame, *more) -> DataFrame:
    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(*more, lang.alias("lang"), text.alias("text")).select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(17), "text").alias("h2"))


def judge(docs: DataFrame, limits: Limits = Limits()) -> tuple[DataFrame, Rules]:
    """The verdict on each document (one row for each input row), and the rules.

    Null text has no word and fails the base rules, as does any text under 20
    words; null lang is a language of its own (und); a language without a
    document of the minimum length that passes the base rules has no reference,
    and its documents are held to the base rules alone. Repeated rows each get
    a verdict, but their text counts once in references and limits. An empty
    table has no verdicts; other columns are left out. Distances that a guard
    leaves out are null. The measures are written once, so the references see
    all documents before the first verdict.
    """
    m, rules = fit(_plain(docs, F.col("doc_id").cast("bigint").alias("doc_id")), ["doc_id"], limits)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(b.column(c) for c in COUNTS), *rules.verdict(b)],
                                             names=[x.split(" ")[0] for x in VERDICTS.split(", ")])
    return m.mapInArrow(run, VERDICTS), rules


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that the rules keep, with all their columns, whatever their
    names; null, empty and repeated rows as in ``judge``, an empty table stays
    empty. The measures are written beside the documents, so that the verdicts
    need neither another pass over the texts nor a join."""
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}     # Arrow functions do not take every name
    text = next((n for c, n in own.items() if c == "text" and isinstance(docs.schema[c].dataType, T.StringType)), "text")   # not sent twice
    m, rules = fit(_plain(docs, *[F.col(quoted(c)).alias(n) for c, n in own.items()]), list(own.values()), limits, text)
    used = ["lang", "n_words", "n_repeat_words", "n_plain", "classes", "words"]

    @F.arrow_udf("boolean")
    def good(*cols: pa.Array) -> pa.Array:
        return rules.verdict(pa.RecordBatch.from_arrays(list(cols), names=used))[1]

    return m.filter(good(*[F.col(c) for c in used])).select(*[F.col(n).alias(c) for c, n in own.items()])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents"))[0]
