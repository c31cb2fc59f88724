"""Document fingerprints: bottom-k sketches of shingle hashes (native).

A document's fingerprint is the k smallest distinct hashes of its five-word
shingles. Fingerprints of parts merge (smallest k of the union); they estimate
resemblance, containment and the number of distinct shingles. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from mdq.llm.common import WORD_BREAK, free_prefix, quoted, read_table

K = 128
SHINGLE = 5
SPAN = float(1 << 63)


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text (null: none), in order."""
    return F.transform(F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), ""), lambda w: F.xxhash64(w))


def _bottom(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch_column(h: Column, k: int = K, n: int = SHINGLE) -> Column:
    """Bottom-k of the n-word shingles, from a column of word hashes. With
    fewer than n words the whole sequence is the one shingle; no word gives
    an empty sketch. Hashes are in 0 .. 2^63 - 1."""
    m = F.size(h) - (n - 1)
    gram = F.arrays_zip(*[F.slice(h, i + 1, m).alias(f"w{i}") for i in range(n)])
    top = F.lit((1 << 63) - 1)
    many = F.transform(gram, lambda x: F.xxhash64(x).bitwiseAND(top))
    return (F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
            .when(m < 1, F.array(F.xxhash64(h).bitwiseAND(top)))
            .otherwise(_bottom(many, k)))


def sketch(docs: DataFrame, out: str = "sketch", text: str = "text", k: int = K) -> DataFrame:
    """``docs`` with the bottom-k sketch of ``text`` as column ``out`` (replaced
    if there). The word hashes are a step of their own, so that no shingle
    hashes the text again. A null or wordless text has an empty sketch, a long
    one is hashed whole, rows that repeat stay, an empty table gives an empty
    one, and all other columns come through, whatever their names."""
    h = free_prefix([*docs.columns, out], "fp") + "h"
    return (docs.withColumn(h, word_hashes(F.col(quoted(text))))
            .withColumn(out, sketch_column(F.col(h), k)).drop(h))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two shingle sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A and B| / |A or B|; exact while the union has at most k
    shingles. Two empty sketches: 1; one empty: 0."""
    u = merge(a, b, k)
    return (F.when(F.size(u) == 0, 1.0)
            .otherwise(F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)))


def n_distinct(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(
        F.lit(k - 1.0) * F.lit(SPAN) / F.element_at(a, -1).cast("double"))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of A's shingles that B has too. An empty A: 1."""
    j = resemblance(a, b, k)
    shared = j * n_distinct(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / n_distinct(a, k)))


def to_text(a: Column) -> Column:
    """A sketch as text: 16 hex digits for each hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next(docs: DataFrame, id_col: str, value: str) -> tuple[DataFrame, W]:
    """Rows dealt into id ranges, each range followed by a guest copy of the
    next range's first rows (the last range by the first's), and the window in
    which lead(value) is the next document's value.

    The bounds are quantiles of the ids, four ranges to a shuffle partition, so
    a range holds a small share of the rows whatever the ids are; they and the
    first ids (one of each range) are the only things sent to all tasks. Null
    ids come first, rows of equal id are in the order of their value's hash.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ord_ = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63)))
    ids = docs.select(ord_.alias("nx_ord"))
    cuts = ids.agg(F.percentile_approx("nx_ord", F.lit([i / parts for i in range(1, parts)]), F.lit(10 * parts))).first()[0]
    cuts = sorted(set(cuts or [])) or [0]
    step = max(1, int(len(cuts) ** 0.5))     # two short searches in place of one long
    coarse = F.lit(cuts[::step])
    fine = F.array(F.lit([0]).cast("array<bigint>"), *[F.lit(cuts[i:i + step]) for i in range(0, len(cuts), step)])
    below = lambda bounds: F.size(F.filter(bounds, lambda c: c <= F.col("nx_ord")))
    dealt = lambda df: (df.withColumn("nx_c", below(coarse))
                        .withColumn("nx_range", F.when(F.col("nx_c") == 0, 0).otherwise(
                            (F.col("nx_c") - 1) * step + below(F.element_at(fine, F.col("nx_c") + 1)))).drop("nx_c"))
    first = dealt(ids).groupBy("nx_range").agg(F.min("nx_ord").alias("nx_first"))
    over = W.orderBy("nx_range")
    every = W.orderBy("nx_range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    first = first.select("nx_first", F.coalesce(F.lag("nx_range").over(over), F.last("nx_range").over(every)).alias("nx_to"))
    rows = dealt(docs.withColumn("nx_ord", ord_)).join(F.broadcast(first), F.col("nx_ord") == F.col("nx_first"), "left")
    place = F.array_compact(F.array(
        F.struct(F.col("nx_range").alias("r"), F.lit(0).alias("g")),
        F.when(F.col("nx_to").isNotNull(), F.struct(F.col("nx_to").alias("r"), F.lit(1).alias("g")))))
    rows = (rows.withColumn("nx_place", F.explode(place))
            .withColumn("nx_guest", F.col("nx_place.g")).withColumn("nx_range", F.col("nx_place.r"))
            .drop("nx_place", "nx_first", "nx_to"))
    w = W.partitionBy("nx_range").orderBy("nx_guest", "nx_ord", F.xxhash64(F.col(value)))
    return rows, w


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text.

    Repeated rows: each row counts; the next of equal ids is the next in the
    order of the text's hash. One document alone is its own next. Null text: empty.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return fingerprint_edits(docs)


def fingerprint_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next of every row of ``docs`` (doc_id, text).

    Null text counts as empty; an empty text has the empty fingerprint, which is
    like another empty one (1) and unlike all others (0). Very long texts are
    hashed whole. Rows may repeat, and each gives a row; null ids come first;
    an empty table gives an empty table. Other columns are left out."""
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows, w = with_next(docs, "doc_id", "text")
    rows = rows.withColumn("nx_text", F.lead("text").over(w)).withColumn("n_chars", F.length("text").cast("bigint"))
    m = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - m),
        F.substring(F.coalesce("nx_text", F.lit("")), F.lit(1), m))).drop("nx_text")
    rows = (rows.withColumn("h", word_hashes(F.col("text"))).withColumn("eh", word_hashes(F.col("edited")))
            .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
            .withColumn("h_text", F.xxhash64("text")).drop("edited"))
    rows = (rows.withColumn("a", sketch_column(F.col("h"), k)).withColumn("e", sketch_column(F.col("eh"), k))
            .drop("h", "eh"))
    rows = rows.withColumn("b", F.lead("a").over(w)).filter("nx_guest = 0")
    return rows.select("doc_id", "n_chars", "edited_sha256", to_text(F.col("a")).alias("fingerprint"),
                       to_text(F.col("e")).alias("edited_fingerprint"),
                       resemblance(F.col("a"), F.col("e"), k).alias("near_edited"),
                       resemblance(F.col("a"), F.col("b"), k).alias("near_next"))
