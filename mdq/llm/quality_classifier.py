"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks that cover all of it. In each chunk,
learned filters slide over byte embeddings, and each filter keeps its largest
answer (max pooling). The mean and the maximum over the document's chunks go
through a small hidden layer to one probability. Training is Adam on a bounded
sample of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from mdq.llm.common import crc_mod, hash_unit, quoted, read_table

CHUNK, OVERLAP = 512, 64
WIDTH, STRIDE = 8, 4           # of a filter; windows overlap by half
EMBED, FILTERS, HIDDEN = 6, 32, 16
INPUTS = 2 * FILTERS + 1       # mean and maximum of each filter, share of one chunk that the text fills
PAD = 256                      # the value behind the end of a short chunk
STEP = CHUNK - OVERLAP
N_WINDOWS = (CHUNK - WIDTH) // STRIDE + 1
BLOCK = 512                    # chunks handled at a time


def chunk_starts(n: int) -> np.ndarray:
    """Starts of the chunks of n bytes; the last one ends at or behind the end."""
    return np.arange(0, max(1, n - OVERLAP), STEP)


def cut(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """Chunks as rows of CHUNK byte values (int16), padded behind the end."""
    b = np.full(int(starts[-1]) + CHUNK, PAD, np.int16)
    b[:len(raw)] = np.frombuffer(raw, np.uint8)[:len(b)]
    return b[starts[:, None] + np.arange(CHUNK)]


@dataclass
class Network:
    embed: np.ndarray      # (257, EMBED), the pad row zero
    filters: np.ndarray    # (WIDTH * EMBED, FILTERS)
    bias: np.ndarray
    hidden: np.ndarray     # (INPUTS, HIDDEN)
    hidden_bias: np.ndarray
    out: np.ndarray        # (HIDDEN,)
    out_bias: np.ndarray   # (1,)

    @classmethod
    def start(cls, seed: int) -> "Network":
        r = np.random.default_rng(seed)
        f = lambda *shape, s: (r.standard_normal(shape) * s).astype(np.float32)
        e = f(257, EMBED, s=0.5)
        e[PAD] = 0
        return cls(e, f(WIDTH * EMBED, FILTERS, s=(2 / (WIDTH * EMBED)) ** 0.5), np.zeros(FILTERS, np.float32),
                   f(INPUTS, HIDDEN, s=(1 / FILTERS) ** 0.5), np.zeros(HIDDEN, np.float32),
                   f(HIDDEN, s=(1 / HIDDEN) ** 0.5), np.zeros(1, np.float32))

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, windows, WIDTH * EMBED), a view on the embedded bytes."""
        x = self.embed[chunks].reshape(len(chunks), CHUNK * EMBED)
        return np.lib.stride_tricks.sliding_window_view(x, WIDTH * EMBED, axis=1)[:, ::STRIDE * EMBED]

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Each filter's largest answer in each chunk, at least 0."""
        out = np.empty((len(chunks), FILTERS), np.float32)
        for lo in range(0, len(chunks), BLOCK):
            w = self.windows(chunks[lo:lo + BLOCK])
            z = w.reshape(-1, WIDTH * EMBED) @ self.filters
            out[lo:lo + BLOCK] = z.reshape(-1, N_WINDOWS, FILTERS).max(1) + self.bias
        return np.maximum(out, 0)

    def probability(self, docs: np.ndarray) -> np.ndarray:
        """From the (mean, maximum, fill) of each document."""
        h = np.maximum(docs @ self.hidden + self.hidden_bias, 0)
        return 1 / (1 + np.exp(-np.clip(h @ self.out + self.out_bias, -30, 30)))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of every whole text, in blocks of bounded memory."""
        out = np.empty((len(texts), INPUTS), np.float32)
        out[:, -1] = [min(len(raw), CHUNK) / CHUNK for raw in texts]
        held, own = [], []

        def flush():
            p = self.pooled(np.concatenate(held))
            at = 0
            for i, n in own:
                q = p[at:at + n]
                out[i, :FILTERS], out[i, FILTERS:-1] = q.mean(0), q.max(0)
                at += n
            held.clear()
            own.clear()

        many = 8 * BLOCK
        for i, raw in enumerate(texts):
            starts = chunk_starts(len(raw))
            if len(starts) > many:                      # a very long text by itself
                total, top = np.zeros(FILTERS), np.zeros(FILTERS, np.float32)
                for lo in range(0, len(starts), many):
                    s = starts[lo:lo + many]
                    q = self.pooled(cut(raw[int(s[0]):int(s[-1]) + CHUNK], s - s[0]))
                    total, top = total + q.sum(0), np.maximum(top, q.max(0))
                out[i, :FILTERS], out[i, FILTERS:-1] = total / len(starts), top
                continue
            held.append(cut(raw, starts))
            own.append((i, len(starts)))
            if sum(n for _, n in own) >= many:
                flush()
        if own:
            flush()
        return self.probability(out)


def excerpt(chunks: np.ndarray, r: np.random.Generator) -> np.ndarray:
    """12 to 400 bytes from the middle chunk of a document, as one chunk."""
    x = chunks[len(chunks) // 2]
    x = x[x != PAD]
    n = min(len(x), int(np.exp(r.uniform(np.log(12), np.log(400)))))
    at = int(r.integers(0, len(x) - n + 1))
    out = np.full((1, CHUNK), PAD, np.int16)
    out[0, :n] = x[at:at + n]
    return out


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 1, epochs: int = 6, batch: int = 32,
          rate: float = 4e-3) -> Network:
    """Fit on documents given as arrays of chunks; both labels weigh alike."""
    net, r = Network.start(seed), np.random.default_rng(seed)
    texts, labels = texts + [excerpt(x, r) for x in texts], np.concatenate([labels, labels])
    names = list(net.__dataclass_fields__)
    m1 = {k: np.zeros_like(getattr(net, k)) for k in names}
    m2 = {k: np.zeros_like(getattr(net, k)) for k in names}
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    t, steps = 0, epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = r.permutation(len(texts))
        for lo in range(0, len(order), batch):
            rows = order[lo:lo + batch]
            n = np.array([len(texts[i]) for i in rows])
            chunks = np.concatenate([texts[i] for i in rows])
            doc = np.repeat(np.arange(len(rows)), n)
            first = np.cumsum(n) - n
            w = net.windows(chunks).reshape(-1, WIDTH * EMBED)
            z = (w @ net.filters).reshape(len(chunks), N_WINDOWS, FILTERS)
            best = z.argmax(1)                                                    # (chunks, FILTERS)
            p = np.maximum(np.take_along_axis(z, best[:, None], 1)[:, 0] + net.bias, 0)
            mean = np.add.reduceat(p, first) / n[:, None]
            top = np.maximum.reduceat(p, first)
            x = np.concatenate([mean, top, (chunks[first] != PAD).mean(1, dtype=np.float32)[:, None]], 1)
            h = np.maximum(x @ net.hidden + net.hidden_bias, 0)
            y = 1 / (1 + np.exp(-np.clip(h @ net.out + net.out_bias, -30, 30)))
            g = ((y - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
            grad = {"out": h.T @ g, "out_bias": np.array([g.sum()], np.float32)}
            gh = np.outer(g, net.out) * (h > 0)
            grad["hidden"], grad["hidden_bias"] = x.T @ gh, gh.sum(0)
            gx = gh @ net.hidden.T
            is_top = p == top[doc]
            gp = (gx[doc, :FILTERS] / n[doc][:, None] + gx[doc, FILTERS:-1] * is_top) * (p > 0)
            grad["bias"] = gp.sum(0)
            c, f = np.nonzero(gp)
            at = c * N_WINDOWS + best[c, f]
            used, inverse = np.unique(at, return_inverse=True)                    # windows that won
            gz = np.zeros((len(used), FILTERS), np.float32)
            gz[inverse, f] = gp[c, f]
            grad["filters"] = w[used].T @ gz
            ge = (gz @ net.filters.T).reshape(-1, EMBED)
            byte = chunks[(used // N_WINDOWS)[:, None], (used % N_WINDOWS * STRIDE)[:, None] + np.arange(WIDTH)].reshape(-1)
            grad["embed"] = np.stack([np.bincount(byte, ge[:, k], minlength=257) for k in range(EMBED)], 1).astype(np.float32)
            grad["embed"][PAD] = 0
            t += 1
            lr = rate * (1 - 0.9 * t / steps)
            for k in names:
                gk = grad[k] + 1e-5 * getattr(net, k)
                m1[k] += 0.1 * (gk - m1[k])
                m2[k] += 0.01 * (gk * gk - m2[k])
                v = getattr(net, k)
                v -= lr * (m1[k] / (1 - 0.9 ** t) / (np.sqrt(m2[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 3000, max_bytes: int = 1 << 20, seed: int = 1) -> Network:
    """Train on about ``max_rows`` labelled rows (half of each label, chosen by
    a hash of the id; never more than ``max_rows`` of a label, whatever repeats)
    whose crc32(doc_id as text) mod 3 is not 1, with all chunks of their texts;
    rows with a text over ``max_bytes`` are not chosen. Null labels are left out; an id with both labels counts with both. Without
    any usable row the network stays untrained."""
    own = labels.select("doc_id", "quality").filter((crc_mod("doc_id", 3) != 1) & F.col("quality").isin(0, 1)).distinct()
    counts = {r["quality"]: r["n"] for r in own.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return train([], np.array([], np.int64), seed)
    share = F.create_map(*[F.lit(v) for q, n in counts.items() for v in (q, min(1.0, max_rows / 2 / n))])
    chosen = own.filter(hash_unit("doc_id", seed=seed) < share[F.col("quality")])
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")   # about max_rows ids
    u = hash_unit("doc_id", "text", seed=seed)
    rows = (rows.filter(F.octet_length("text") <= max_bytes).withColumn("u", u).dropDuplicates(["doc_id", "quality", "u"])
            .withColumn("k", F.row_number().over(W.partitionBy("quality").orderBy("u", "doc_id"))).filter(F.col("k") <= max_rows))

    def chunks(batches):
        for b in batches:
            d, text, q = (c.to_pylist() for c in b.columns)
            x = []
            for t in text:
                raw = t.encode()
                x.append(cut(raw, chunk_starts(len(raw))).tobytes())
            yield pa.record_batch([pa.array(d, pa.int64()), pa.array(q, pa.int32()), pa.array(x, pa.binary())],
                                  ["doc_id", "quality", "chunks"])

    got = rows.select("doc_id", "text", F.col("quality").cast("int").alias("quality")).mapInArrow(
        chunks, "doc_id bigint, quality int, chunks binary").collect()
    got = sorted(got, key=lambda r: (-1 if r["doc_id"] is None else r["doc_id"], r["quality"], bytes(r["chunks"])))
    return train([np.frombuffer(r["chunks"], np.int16).reshape(-1, CHUNK) for r in got],
                 np.array([r["quality"] for r in got]), seed)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` plus score and predicted (columns of these names are replaced).

    The whole text counts, however long, a chunk at a time; null and empty texts are one empty chunk and get the
    score the network gives to nothing. Equal texts get equal scores up to the
    last digits of single precision. An empty table stays empty."""
    @F.arrow_udf("double")
    def quality(text: pa.Array) -> pa.Array:
        return pa.array(net.scores([(t or "").encode() for t in text.to_pylist()]).astype(np.float64), pa.float64())

    names = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    out = docs.select(*[quoted(c) for c in names]).withColumn("score", quality(F.col("text")))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    net = fit(docs, read_table(spark, sf_dir, "labels"))
    got = score(docs.select("doc_id", "text"), net)
    return got.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")
