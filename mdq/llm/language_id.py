"""Language identification in two steps.

First the language family: one-versus-rest linear support vector machines.
Then, within the family, one-versus-one linear support vector machines between
every two of its languages, by vote. Features are the square roots of hashed
counts of three-byte sequences of the lower-cased letters, scaled to length 1.
Trained in numpy on a bounded sample.

The score compares the learned families and languages with one another. Whether
a text is in any of them is told by the answer of its family's machine alone: a
text that shares no sequences with the learned ones gets about 0.5, or less where
a single family is learned and the zero vector stands for all other texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from mdq.llm.common import free_prefix, quoted, crc_mod, hash_unit, read_table

BITS = 13
BLOCK = 1 << 20

#: Families of languages by ISO 639-1 code. A language that is
#: not listed is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "celtic": ["br", "cy", "ga", "gd"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "tt", "ug", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "or", "pa", "sd", "si", "ur"],
    "iranian": ["fa", "ku", "ps", "tg"],
    "semitic": ["am", "ar", "he", "mt"],
    "dravidian": ["kn", "ml", "ta", "te"],
    "austronesian": ["id", "jv", "mg", "ms", "su", "tl"],
}
_FAMILY_OF = {lang: f for f, langs in FAMILIES.items() for lang in langs}

_LETTER = re.compile(r"[^\W\d_]")
_KEEP = np.full(256, 32, np.uint8)
_KEEP[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KEEP[128:] = np.arange(128, 256)


def family(lang: str) -> str:
    return _FAMILY_OF.get(lang.split("-")[0].lower(), lang)


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def n_letters(text: str) -> int:
    """Bytes of the text that count as letters in its features."""
    return int((_KEEP[np.frombuffer(text.lower().encode(), np.uint8)] != 32).sum())


def features(text: str) -> np.ndarray:
    """The text's feature vector (float32). Very long texts are counted in blocks."""
    raw = _KEEP[np.frombuffer(text.lower().encode(), np.uint8)]
    b = np.full(len(raw) + 2, 32, np.uint8)
    b[1:-1] = raw
    count = np.zeros(1 << BITS, np.int64)
    for lo in range(0, len(raw), BLOCK):
        x = b[lo:lo + BLOCK + 2]
        x = x[:min(len(x), len(raw) - lo + 2)].astype(np.uint32)
        code = x[:-2] << 16 | x[1:-1] << 8 | x[2:]
        code = code[x[1:-1] != 32]
        count += np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    v = np.sqrt(count).astype(np.float32)
    n = float(np.sqrt(v @ v))
    return v / n if n else v


def train_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Linear machines with squared hinge loss, one per column of ``y`` (+1 or
    -1, each side weighted alike), by accelerated gradient steps."""
    n_pos = np.maximum((y > 0).sum(0), 1)
    n_neg = np.maximum((y < 0).sum(0), 1)
    weight = np.where(y > 0, 0.5 / n_pos, 0.5 / n_neg).astype(np.float32)
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    b = np.zeros(y.shape[1], np.float32)
    vw, vb, step = w.copy(), b.copy(), 0.25
    for k in range(rounds):
        short = np.maximum(0, 1 - y * (x @ vw + vb)) * y * weight
        w1 = vw + step * (2 * (x.T @ short) - penalty * vw)
        b1 = vb + step * 2 * short.sum(0)
        m = k / (k + 3)
        vw, vb, w, b = w1 + m * (w1 - w), b1 + m * (b1 - b), w1, b1
    return w, b


def _sigmoid(x):
    return 1 / (1 + np.exp(-4 * np.clip(x, -50, 50)))


@dataclass
class LanguageModel:
    """families: names; members: languages of each; weights: of the families'
    machines, then of the pairs' (family, first, second)."""
    families: list[str]
    members: list[list[str]]
    pairs: list[tuple[int, int, int]]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Languages and scores; ``und`` with score 0 for texts without a letter."""
        return self.answers(texts)[:2]

    def answers(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Languages, scores and the answers of the winning families' machines
        (0 to 1, not set against the other families)."""
        known = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.families else []
        lang, score, answer = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        for at in range(0, len(known), 256):
            rows = known[at:at + 256]
            z = np.stack([features(texts[i]) for i in rows]) @ self.weights + self.bias
            nf = len(self.families)
            e = _sigmoid(z[:, :nf])
            fam = e.argmax(1)
            p_fam = e[np.arange(len(rows)), fam] / np.maximum(e.sum(1), 1e-12)
            for r, a in zip(rows, e.max(1).tolist()):
                answer[r] = a
            p = _sigmoid(z[:, nf:])
            for f, names in enumerate(self.members):
                own = np.flatnonzero(fam == f)
                if not len(own):
                    continue
                votes, trust = np.zeros((len(own), len(names))), np.zeros((len(own), len(names)))
                for c, (g, i, j) in enumerate(self.pairs):
                    if g == f:
                        q = p[own, c]
                        votes[:, i] += q >= 0.5
                        votes[:, j] += q < 0.5
                        trust[:, i] += q
                        trust[:, j] += 1 - q
                best = (votes + trust / (len(names) + 1)).argmax(1)
                inside = trust[np.arange(len(own)), best] / (len(names) - 1) if len(names) > 1 else np.ones(len(own))
                for r, k, s in zip(own.tolist(), best.tolist(), (p_fam[own] * inside).tolist()):
                    lang[rows[r]], score[rows[r]] = names[k], min(1.0, float(s))
        return lang, score, answer


def fit(docs: DataFrame, per_language: int = 250, max_rows: int = 4000, max_languages: int = 200, seed: int = 6) -> LanguageModel:
    """Train on the rows whose crc32(doc_id as text) mod 5 is not 0 and whose
    lang is known: about ``per_language`` of each of the ``max_languages`` most
    frequent languages, chosen by a hash of id and text, and about ``max_rows``
    in all; of a row that repeats, one, and never more than twice the number
    wanted. Only their feature vectors (counts of ``1 << BITS`` buckets) come to
    the driver. No usable row: a model that answers ``und``."""
    rows = docs.filter((crc_mod("doc_id", 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
                       hash_unit("doc_id", "text", seed=seed).alias("u"))
    counts = {r["lang"]: r["n"] for r in rows.select("lang", "u").distinct().groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()}
    if not counts:
        return LanguageModel([], [], [], np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32))
    per = max(1, min(per_language, max_rows // len(counts)))
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, per / n))])
    chosen = rows.filter(F.col("u") < share[F.col("lang")])
    rank = F.row_number().over(W.partitionBy("lang").orderBy("u", "doc_id"))
    chosen = chosen.dropDuplicates(["lang", "doc_id", "u"]).withColumn("k", rank).filter(F.col("k") <= 2 * per).select("doc_id", "lang", "text")

    def vectors(batches):
        for b in batches:
            keep = [(d, lang, features(t)) for d, lang, t in zip(*(c.to_pylist() for c in b.columns)) if has_letter(t)]
            for lo in range(0, len(keep), 200):
                d, lang, v = zip(*keep[lo:lo + 200])
                yield pa.record_batch([pa.array(d, pa.int64()), pa.array(lang), pa.array([x.astype(np.float16).tobytes() for x in v])],
                                      ["doc_id", "lang", "v"])

    got = chosen.mapInArrow(vectors, "doc_id bigint, lang string, v binary").collect()
    got = sorted(got, key=lambda r: (r["lang"], -1 if r["doc_id"] is None else r["doc_id"]))
    if not got:
        return LanguageModel([], [], [], np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32))
    x = np.stack([np.frombuffer(r["v"], np.float16).astype(np.float32) for r in got])
    langs = np.array([r["lang"] for r in got])
    names = sorted(set(langs.tolist()))
    fams = sorted({family(n) for n in names})
    members = [[n for n in names if family(n) == f] for f in fams]
    fam = np.array([fams.index(family(n)) for n in langs.tolist()])
    y = np.where(fam[:, None] == np.arange(len(fams)), 1.0, -1.0).astype(np.float32)
    if len(fams) == 1:                                        # no other family: the zero vector is the other side
        w, b = train_svm(np.concatenate([x, np.zeros_like(x[:1])]), np.concatenate([y, -y[:1]]))
    else:
        w, b = train_svm(x, y)
    weights, bias, pairs = [w], [b], []
    for f, own in enumerate(members):
        for i, j in combinations(range(len(own)), 2):
            rows_ = np.flatnonzero((langs == own[i]) | (langs == own[j]))
            y = np.where(langs[rows_] == own[i], 1.0, -1.0).astype(np.float32)[:, None]
            w, b = train_svm(x[rows_], y)
            pairs.append((f, i, j))
            weights.append(w)
            bias.append(b)
    return LanguageModel(fams, members, pairs, np.concatenate(weights, 1), np.concatenate(bias))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` plus lang_pred and score (columns of these names are replaced).

    Whole texts are read. Null text, or text without a letter: ``und``, score 0.
    Equal texts get equal answers; an empty table stays empty."""
    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(text: pa.Array) -> pa.Array:
        lang, score = model.predict(text.to_pylist())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    own = free_prefix(docs.columns, "li")
    out = docs.select(*[quoted(c) for c in names]).withColumn(own, predict(F.col("text")))
    return out.select(*[quoted(c) for c in names], f"{own}.lang_pred", f"{own}.score")


def keep_known(docs: DataFrame, model: LanguageModel, min_answer: float = 0.7, min_letters: int = 100) -> DataFrame:
    """The documents that have a language: not ``und``, and the answer of the
    winning family's machine is at least ``min_answer``, whatever the number of
    families and languages. Texts of fewer than ``min_letters`` letter bytes
    are too short for that and are held to the first condition alone."""
    @F.arrow_udf("boolean")
    def known(text: pa.Array) -> pa.Array:
        texts = text.to_pylist()
        lang, _, answer = model.answers(texts)
        return pa.array([x != "und" and (a >= min_answer or n_letters(t) < min_letters)
                         for t, x, a in zip(texts, lang, answer)], pa.bool_())

    return docs.select(*[quoted(c) for c in docs.columns]).filter(known(F.col("text")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    got = identify(docs.select("doc_id", "text"), fit(docs))
    return got.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
