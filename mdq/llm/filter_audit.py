"""Filter interaction audit with sorted posting lists.

Every row is dealt to a block: a part (say, a source) and a range of ids. In a
block the rows are numbered in id order, and each filter keeps the sorted list
of the rows that fail it, as do the labels that a loss is counted for. What any
order of the filters removes, finds already removed or loses follows from unions
and differences of these lists, computed by galloping k-way merges and kept for
each set of filters that can come first. Sizes are added up over the blocks of a
part, so a part may be of any size and no task sees more than a block's lists.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdq.llm.common import read_table, write_shared

FILTERS = "ABCDE"
MIN_WORDS = 200
BLOCK_ROWS = 1 << 16
WINDOW = 1 << 12                # entries of the shortest list that one step of a merge takes
ROWS_PER_TASK = 1 << 20
BLOCKS_PER_TASK = 16

#: Fixed values of filters C and D.
UPPER, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"


# -- filters -----------------------------------------------------------------
def fails(text: str) -> tuple[bool, bool, bool, bool]:
    """Whether a text fails A (under 200 words), B (100 * distinct words < 50 *
    words), C (100 * upper-case ASCII letters > 2 * code points), D (a mark)."""
    raw = text.encode()
    words = raw.split()
    upper = len(raw) - len(raw.translate(None, UPPER))
    return (len(words) < MIN_WORDS, 100 * len(set(words)) < 50 * len(words), 100 * upper > 2 * len(text),
            len(raw.translate(None, MARKS)) < len(raw))


def failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part and a boolean for each of the filters A to E of every row.

    Null text counts as empty, a null part as the empty string. E: the same
    text has a smaller doc_id somewhere in the table; a row of a null id fails
    it never, and rows that repeat an id do not fail it because of each other."""
    import hashlib

    def each(batches):
        for b in batches:
            texts = [t or "" for t in b.column(2).to_pylist()]
            flags = [fails(t) for t in texts]
            digest = [hashlib.blake2b(t.encode(), digest_size=16).digest() for t in texts]
            yield pa.record_batch([b.column(0), b.column(1), *[pa.array(c, pa.bool_()) for c in (zip(*flags) if flags else [()] * 4)],
                                   pa.array(digest, pa.binary())], ["doc_id", "part", *"ABCD", "digest"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                       F.col("text").cast("string").alias("text"))
    rows = write_shared(rows.mapInArrow(each, "doc_id bigint, part string, A boolean, B boolean, C boolean, D boolean, digest binary"), "audit-rows")
    # Only texts that repeat take part in the join; their first id is found by a partial aggregation.
    first = (rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .filter("last > first").select("digest", "first"))
    return (rows.join(first, "digest", "left")
            .select("doc_id", "part", *"ABCD", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E")))


# -- posting lists -----------------------------------------------------------
def posting_lists(flags: DataFrame, part: str, id_col: str, names: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row per block: part, low and high id, rows, and for each of the boolean
    columns ``names`` the sorted list of the rows where it is true (numbers in
    the block's id order, null ids first). Rows that repeat an id are rows of
    their own. Blocks hold at most ``block_rows`` rows of one part."""
    n = flags.count()
    parts = max(1, -(-n // ROWS_PER_TASK), min(flags.sparkSession.sparkContext.defaultParallelism, -(-n // 1024)))
    schema = "part string, low bigint, high bigint, rows int, " + ", ".join(f"`{c}` array<int>" for c in names)

    def block(held: list[tuple]) -> pa.RecordBatch:
        ids = [r[1] for r in held if r[1] is not None]
        hits = np.array([r[2:] for r in held], bool)
        lists = [pa.array([np.flatnonzero(hits[:, k]).astype(np.int32)], pa.list_(pa.int32())) for k in range(len(names))]
        return pa.record_batch([pa.array([held[0][0]]), pa.array([min(ids, default=None)], pa.int64()), pa.array([max(ids, default=None)], pa.int64()),
                                pa.array([len(held)], pa.int32()), *lists], ["part", "low", "high", "rows", *names])

    def build(batches):
        held: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and (row[0] != held[0][0] or len(held) >= block_rows):
                    yield block(held)
                    held = []
                held.append(row)
        if held:
            yield block(held)

    rows = flags.select(F.col(part).alias("part"), F.col(id_col).cast("bigint").alias("id"),
                        *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in names]).withColumn("tie", F.monotonically_increasing_id())
    order = ["part", "id", "tie"]
    return write_shared(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie").mapInArrow(build, schema), "audit-postings")


def gallop(a: np.ndarray, start: int, value: int) -> int:
    """The first place at or after ``start`` of the sorted list ``a`` whose
    entry is not below ``value``: steps that double, then a search between the
    last two."""
    step, n = 1, len(a)
    while start + step < n and a[start + step] < value:
        step *= 2
    low = start + step // 2 if step > 1 else start
    return low + int(np.searchsorted(a[low:min(n, start + step + 1)], value))


def union(lists: list[np.ndarray]) -> np.ndarray:
    """The union of sorted lists, by a k-way merge over ranges of ids: each
    step takes a window of the list that lies furthest back, and every other
    list gallops to the window's end."""
    lists = [x for x in lists if len(x)]
    if len(lists) < 2:
        return lists[0] if lists else np.zeros(0, np.int32)
    at, out = [0] * len(lists), []
    while True:
        left = [k for k in range(len(lists)) if at[k] < len(lists[k])]
        if not left:
            return np.concatenate(out)
        k = min(left, key=lambda k: lists[k][at[k]])
        if len(left) == 1:
            out.append(lists[k][at[k]:])
            return np.concatenate(out)
        end = int(lists[k][min(at[k] + WINDOW, len(lists[k])) - 1]) + 1
        took = []
        for k in left:
            to = gallop(lists[k], at[k], end)
            took.append(lists[k][at[k]:to])
            at[k] = to
        out.append(np.unique(np.concatenate(took)))


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which entries of the sorted list ``a`` are in the sorted list ``b``; ``b``
    is galloped through, a window of ``a`` at a time."""
    found, at = np.zeros(len(a), bool), 0
    for lo in range(0, len(a), WINDOW):
        part = a[lo:lo + WINDOW]
        at = gallop(b, at, int(part[0])) if at < len(b) else at
        end = gallop(b, at, int(part[-1]) + 1) if at < len(b) else at
        inside = b[at:end]
        if len(inside):
            place = np.searchsorted(inside, part)
            found[lo:lo + WINDOW] = (place < len(inside)) & (inside[np.minimum(place, len(inside) - 1)] == part)
        at = end
    return found


def differences(lists: list[np.ndarray], losses: list[np.ndarray]) -> list[tuple]:
    """(set, filter, size of the union of the set's lists, rows of the filter's
    list outside of it, and how many of these are in each list of ``losses``)
    for every filter and every set of others; a set is a sum of powers of two."""
    n, unions, out = len(lists), {0: np.zeros(0, np.int32)}, []
    for size in range(n):
        for chosen in combinations(range(n), size):
            s = sum(1 << f for f in chosen)
            if size:                                     # one more list than a union that is there already
                unions[s] = union([unions[s & ~(1 << chosen[-1])], lists[chosen[-1]]])
            for f in range(n):
                if f not in chosen:
                    new = lists[f][~common(lists[f], unions[s])]
                    out.append((s, f, len(unions[s]), len(new), *[int(common(new, x).sum()) for x in losses]))
    return out


def interactions(postings: DataFrame, filters: list[str], losses: list[str]) -> DataFrame:
    """A row for each part, filter (its number in ``filters``) and set of other
    filters (a sum of powers of two): rows of the part, fails (rows failing the
    filter), before (rows failing any of the set), removed (rows failing the
    filter and none of the set) and, of these, those in each list of ``losses``."""
    def sizes(batches):
        names = ["part", "rows", "fails", "set", "filter", "before", "removed", *losses]
        for b in batches:
            for k in range(b.num_rows):
                lists = [np.asarray(b.column(b.schema.get_field_index(c))[k].values) for c in [*filters, *losses]]
                own = lists[:len(filters)]
                got = differences(own, lists[len(filters):])
                part, rows = b.column(0)[k].as_py(), b.column(3)[k].as_py()
                cols = [[part] * len(got), [rows] * len(got), [len(own[x[1]]) for x in got], *zip(*got)]
                yield pa.record_batch([pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(cols)], names)
    n = postings.count()
    tasks = max(1, min(n, max(-(-n // BLOCKS_PER_TASK), postings.sparkSession.sparkContext.defaultParallelism)))
    dealt = postings.repartition(tasks, "part", "low", "high")
    schema = "part string, rows bigint, fails bigint, `set` bigint, filter bigint, before bigint, removed bigint" + "".join(
        f", `{c}` bigint" for c in losses)
    return (dealt.mapInArrow(sizes, schema).groupBy("part", "set", "filter")
            .agg(*[F.sum(c).alias(c) for c in ("rows", "fails", "before", "removed", *losses)]))


def audit(postings: DataFrame, filters: list[str], losses: list[str]) -> DataFrame:
    """A row per part, filter_order (each permutation of ``filters``) and step:
    kept, removed, redundant, unique_fails, shapley and a column for each of
    ``losses``. Parts without a row have none here; an empty table gives an
    empty table. Only the sums of a part's blocks are expanded to the orders."""
    n = len(filters)
    sets = write_shared(interactions(postings, filters, losses), "audit-sets")
    weight = F.create_map(*[F.lit(x) for s in range(n) for x in (s, factorial(s) * factorial(n - 1 - s))])
    alone = F.bit_count("set") == n - 1                         # every other filter comes first
    per_filter = sets.groupBy("part", "filter").agg(F.sum(F.col("removed") * weight[F.bit_count("set")]).alias("shapley"),
                                                    F.sum(F.when(alone, F.col("removed")).otherwise(0)).alias("unique_fails"))
    steps = [("".join(filters[f] for f in p), k + 1, sum(1 << f for f in p[:k]), p[k])
             for p in permutations(range(n)) for k in range(n)]
    steps = F.broadcast(sets.sparkSession.createDataFrame(steps, "filter_order string, step int, `set` bigint, filter bigint"))
    return (sets.join(per_filter, ["part", "filter"]).join(steps, ["set", "filter"])
            .select("part", "filter_order", "step", (F.col("rows") - F.col("before") - F.col("removed")).alias("kept"), "removed",
                    (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", *losses, "shapley"))


def audit_documents(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The audit of filters A to E over ``docs`` with the losses good_lost
    (labels of quality 1) and toxic_lost (toxic 1). Several label rows of an id
    count as one that has what any of them has; documents without labels, and
    null ids, lose nothing. Other columns are left out, whatever their names."""
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marks = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality", "toxic").groupBy("doc_id")
             .agg(flag("quality").alias("good_lost"), flag("toxic").alias("toxic_lost")).filter("good_lost or toxic_lost"))
    flags = write_shared(failures(docs, part).join(marks, "doc_id", "left"), "audit-flags")
    losses = ["good_lost", "toxic_lost"]
    return audit(posting_lists(flags, "part", "doc_id", [*FILTERS, *losses]), list(FILTERS), losses)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH f AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
     orders AS (SELECT a.col0 || b.col0 || c.col0 || d.col0 || e.col0 AS filter_order
                FROM f a, f b, f c, f d, f e
                WHERE len(list_distinct([a.col0, b.col0, c.col0, d.col0, e.col0])) = 5),
     w AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text,
                  regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
     l AS (SELECT doc_id, bool_or(COALESCE(quality = 1, false)) AS good, bool_or(COALESCE(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
     d AS (SELECT part, COALESCE(good, false) AS good, COALESCE(toxic, false) AS toxic,
                  CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
                  || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
                  || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
                  || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
                  || CASE WHEN COALESCE(w.doc_id > MIN(w.doc_id) OVER (PARTITION BY text), false) THEN 'E' ELSE '' END AS failed
           FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
     g AS (SELECT part, failed, COUNT(*) AS n, COUNT(*) FILTER (WHERE good) AS good, COUNT(*) FILTER (WHERE toxic) AS toxic
           FROM d GROUP BY part, failed),
     s AS (SELECT part, filter_order, step::INTEGER AS step, substr(filter_order, step, 1) AS now, n, good, toxic, failed,
                  contains(failed, substr(filter_order, step, 1)) AS fails,
                  regexp_matches(failed, '[-' || substr(filter_order, 1, step - 1) || ']') AS gone
           FROM g, orders, range(1, 6) r(step)),
     a AS (SELECT part, filter_order, step, now,
                  COALESCE(SUM(n) FILTER (WHERE NOT gone AND NOT fails), 0)::BIGINT AS kept,
                  COALESCE(SUM(n) FILTER (WHERE fails AND NOT gone), 0)::BIGINT AS removed,
                  COALESCE(SUM(n) FILTER (WHERE fails AND gone), 0)::BIGINT AS redundant,
                  COALESCE(SUM(n) FILTER (WHERE failed = now), 0)::BIGINT AS unique_fails,
                  COALESCE(SUM(good) FILTER (WHERE fails AND NOT gone), 0)::BIGINT AS good_lost,
                  COALESCE(SUM(toxic) FILTER (WHERE fails AND NOT gone), 0)::BIGINT AS toxic_lost
           FROM s GROUP BY part, filter_order, step, now)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (SUM(removed) OVER (PARTITION BY part, now))::BIGINT AS shapley
FROM a
"""
