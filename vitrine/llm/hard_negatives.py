"""Hard negatives for anchors of labelled vectors, by threshold joins on integer inner products.

Rows are packed into blocks. In a block dimensions stand by weight, rows by how many of them they index: a dimension's
postings are then the first rows of the block, stored as a slice. A row indexes dimensions only as long as what
follows could still reach the lowest threshold asked, by the norm of its suffix; the rest is kept for verification. A pair of
an anchor block and a row block is joined dimension group by dimension group: partial scores grow, rows
whose partial score and remaining norms stay below every threshold leave, and pairs that remain are completed exactly.

Thresholds start high and are lowered for anchors whose windows are not full, so a round costs what its thresholds let
through. First round by round the positives (same label), then per distinct positive score the window of the
negatives. Rows of a window beyond its size are dropped in the task and again before the shuffle, so no anchor or label,
however frequent, gathers more than that many rows a block.

Anchors are a stated query set: each block of them meets each block of rows once a round, as (block, block) records.

Rows with a null label, a null vector or a component that is null or not finite take no part. Missing trailing components
count as 0. Every row stands for itself: repeated rows can fill several ranks, repeated anchors give repeated results;
a row with the anchor's own vec_id is no other row. A null vec_id is no anchor, is not relabelled and comes last among ties.
Sums are exact: vectors whose norm passes 26 bits are multiplied as Python integers, where a score beyond 64 bits saturates;
the bounds of a window above 53 bits are rounded to doubles.
An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.llm.core import batches_of, discard, stored

BLOCK_BYTES, BLOCK_ROWS = 2 << 20, 4096
ANCHOR_ROWS = 256
GROUPS = 64  # shares of the row blocks that an anchor block is sent to
STEP = 8  # dimensions accumulated between two prunings
FIRST, LOWER, LAST = 0.5, 0.6, 0.15  # of an anchor's own squared norm: first threshold, factor, below it all rows count
WINDOW_STEPS = (0.97, 0.9)  # of a positive's score, before the window's own bound
EXACT = float(1 << 26)  # sums of products of vectors with norms below this are exact in doubles
TOP = (1 << 63) - 1
_LAST_ID = TOP  # stands for a null vec_id


def integer_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, q): rows that take part, components floored after scaling, every seventh row relabelled."""
    x = F.col("embedding")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.where(F.col("label").isNotNull() & x.isNotNull() & whole).select(
        "vec_id", label.alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double")).alias("q"))


def _matrix(column: pa.Array) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def blocks(vectors: DataFrame, most: int = BLOCK_ROWS) -> DataFrame:
    """(block, width, ids, labels, vectors): rows packed by task, ids and labels as 64-bit numbers, vectors as doubles."""

    def pack(batches):
        def block(ids, labels, q):
            return pa.record_batch({
                "width": pa.array([q.shape[1]], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()),
                "labels": pa.array([labels.tobytes()], pa.binary()),
                "vectors": pa.array([np.ascontiguousarray(q, np.float64).tobytes()], pa.binary())})

        held, size = [], 0

        def flush():
            width = max(q.shape[1] for _, _, q in held)
            q = np.concatenate([np.pad(q, ((0, 0), (0, width - q.shape[1]))) for _, _, q in held])
            ids, labels = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            rows = max(1, min(most, BLOCK_BYTES // (8 * max(width, 1))))
            for i in range(0, len(ids), rows):
                yield block(ids[i:i + rows], labels[i:i + rows], q[i:i + rows])

        for batch in batches:
            if not len(batch):
                continue
            ids = batch.column(0).fill_null(_LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)
            labels = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            held.append((ids, labels, _matrix(batch.column(2))))
            size += held[-1][2].nbytes + 16 * len(ids)
            if sum(len(h[0]) for h in held) >= most or size >= BLOCK_BYTES:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    packed = vectors.select("vec_id", "label", "q").mapInArrow(pack, "width int, ids binary, labels binary, vectors binary")
    return packed.withColumn("block", F.monotonically_increasing_id())


class Index:
    """Rows of a block by inverted dimensions, for thresholds of at least ``least`` times the norm of any query."""

    def __init__(self, rows: np.ndarray, least: float):
        energy = (rows * rows).sum(axis=0)
        self.dims = np.argsort(-energy, kind="stable")
        rows = rows[:, self.dims]
        squares = np.cumsum((rows * rows)[:, ::-1], axis=1)[:, ::-1]
        suffix = np.sqrt(np.concatenate([squares, np.zeros((len(rows), 1))], axis=1))
        # A row indexes dimension j while its norm from j on could reach the threshold alone.
        indexed = (suffix[:, :-1] * (1 + 1e-9) >= least).sum(axis=1) if least > 0 else np.full(len(rows), rows.shape[1])
        self.order = np.argsort(-indexed, kind="stable")
        self.indexed, self.rows, self.suffix = indexed[self.order], rows[self.order], suffix[self.order]

    def postings(self, j: int) -> int:
        """Dimension ``j`` is indexed by this many first rows."""
        return int(np.searchsorted(-self.indexed, -j, "left"))

    def candidates(self, queries: np.ndarray, thresholds: np.ndarray):
        """(query, row) of all pairs that may reach the query's threshold."""
        queries = queries[:, self.dims]
        squares = np.cumsum((queries * queries)[:, ::-1], axis=1)[:, ::-1]
        rest = np.sqrt(np.concatenate([squares, np.zeros((len(queries), 1))], axis=1)) * (1 + 1e-9)
        asked = (thresholds - 0.5)[:, None]
        width = self.rows.shape[1]
        # A row that ends inside a step has the step whole: more than is needed, never less.
        done = np.minimum(-(-self.indexed // STEP) * STEP, width)
        alive = np.arange(len(self.rows) if not width else self.postings(0))
        partial = np.zeros((len(queries), len(alive)))
        for j in range(0, width, STEP):
            to = min(j + STEP, width)
            n = int(np.searchsorted(alive, self.postings(j)))
            partial[:, :n] += queries[:, j:to] @ self.rows[alive[:n], j:to].T
            keep = self._reaches(partial, rest, alive, np.minimum(done[alive], to), asked).any(axis=0)
            alive, partial = alive[keep], partial[:, keep]
        q, r = np.nonzero(self._reaches(partial, rest, alive, done[alive], asked))
        return q, self.order[alive[r]]

    def _reaches(self, partial, rest, alive, at, asked):
        """Which pairs can still reach what is asked: partial score and the norms that remain from ``at`` on."""
        return partial + rest[:, at] * self.suffix[alive, at] >= asked


def joined(rows: np.ndarray, queries: np.ndarray, thresholds: np.ndarray):
    """(query, row, score) of all pairs whose exact integer score reaches the query's threshold."""
    width = max(rows.shape[1], queries.shape[1])
    rows, queries = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (rows, queries))
    norms, lengths = (np.sqrt((x * x).sum(axis=1)) for x in (queries, rows))
    large_q, large_r = np.flatnonzero(norms >= EXACT), np.flatnonzero(lengths >= EXACT)
    plain_q, plain_r = np.flatnonzero(norms < EXACT), np.flatnonzero(lengths < EXACT)
    found = [(np.zeros(0, np.int64),) * 3]
    for qs, rs in ((large_q, np.arange(len(rows))), (plain_q, large_r)):
        for i in qs.tolist():
            q = [int(x) for x in queries[i]]
            score = np.array([sum(int(x) * y for x, y in zip(rows[j], q)) for j in rs.tolist()], object)
            keep = np.flatnonzero(score >= thresholds[i]) if len(rs) else np.zeros(0, np.int64)
            own = [max(-TOP, min(TOP, x)) for x in score[keep]]
            found.append((np.full(len(keep), i), rs[keep], np.array(own, np.int64)))
    if len(plain_q) and len(plain_r):
        own, asked = queries[plain_q], thresholds[plain_q]
        # A query of norm 0 scores 0 with every row, so no threshold above 0 needs an index for it.
        some = norms[plain_q] > 0
        least = float((asked[some] / norms[plain_q][some]).min(initial=np.inf)) if (some | (asked > 0)).all() else -np.inf
        q, r = Index(rows[plain_r], least).candidates(own, asked)
        q, r = plain_q[q], plain_r[r]
        score = np.empty(len(q))
        for i in range(0, len(q), 1 << 16):
            score[i:i + (1 << 16)] = np.einsum("ij,ij->i", queries[q[i:i + (1 << 16)]], rows[r[i:i + (1 << 16)]])
        keep = score >= thresholds[q]
        found.append((q[keep], r[keep], score[keep].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _first(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, best: int) -> np.ndarray:
    """Places of the first ``best`` of each anchor by score, then id."""
    order = np.lexsort((ids, -score, anchor))
    own = anchor[order]
    rank = np.arange(len(own)) - np.searchsorted(own, own, "left")
    return order[rank < best]


def matches(parts: DataFrame, asked: DataFrame, best: int, positive: bool) -> DataFrame:
    """(query, score, vec_id): per query its first ``best`` rows with low <= score <= high, of its own or another label.

    ``asked`` has query, anchor_id, label, q, low, high. Anchor blocks are sent to every group of row blocks.
    """

    def pack(batches):
        for batch in batches:
            for i in range(0, len(batch), ANCHOR_ROWS):
                own = batch.slice(i, ANCHOR_ROWS)
                q = _matrix(own.column(3))
                numbers = {n: own.column(k).to_numpy(zero_copy_only=False).astype(t).tobytes()
                           for k, (n, t) in enumerate((("queries", np.int64), ("anchors", np.int64), ("own", np.int64)))}
                numbers |= {n: own.column(k).to_numpy(zero_copy_only=False).astype(np.float64).tobytes() for k, n in ((4, "low"), (5, "high"))}
                yield pa.record_batch({
                    "breadth": pa.array([q.shape[1]], pa.int32()), "asking": pa.array([q.astype(np.float64).tobytes()], pa.binary()),
                    **{n: pa.array([x], pa.binary()) for n, x in numbers.items()}})

    def join(batches):
        for batch in batches:
            for x in batch.to_pylist():
                ids, labels = (np.frombuffer(x[n], np.int64) for n in ("ids", "labels"))
                query, anchor, own = (np.frombuffer(x[n], np.int64) for n in ("queries", "anchors", "own"))
                low, high = (np.frombuffer(x[n]) for n in ("low", "high"))
                rows = np.frombuffer(x["vectors"]).reshape(len(ids), x["width"])
                q, r, score = joined(rows, np.frombuffer(x["asking"]).reshape(len(query), x["breadth"]), low)
                keep = (score <= high[q]) & ((labels[r] == own[q]) == positive)
                if positive:
                    keep &= ids[r] != anchor[q]
                q, r, score = q[keep], r[keep], score[keep]
                at = _first(q, score, ids[r], best)
                yield pa.record_batch({
                    "query": pa.array(query[q[at]], pa.int64()), "score": pa.array(score[at], pa.int64()),
                    "vec_id": pa.array(ids[r[at]], pa.int64())})

    packed = asked.select("query", "anchor_id", "label", "q", "low", "high").mapInArrow(
        pack, "breadth int, asking binary, queries binary, anchors binary, own binary, low binary, high binary")
    sent = packed.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))))
    pairs = parts.withColumn("g", (F.xxhash64("block") % GROUPS + GROUPS) % GROUPS).withColumn("g", F.col("g").cast("int"))
    # Spark would take the copies of an anchor block for one of them and broadcast all.
    found = pairs.join(sent.hint("merge"), "g").drop("g", "block").mapInArrow(join, "query long, score long, vec_id long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _rounds(parts: DataFrame, asked: DataFrame, best: int, positive: bool, lows: list[Column], name: str) -> DataFrame:
    """``matches`` of every query, its lower bound taken from ``lows`` until the window is full or the last is reached."""
    done, open_ = [], asked
    for i, low in enumerate(lows):
        last = i == len(lows) - 1
        with batches_of(asked.sparkSession, ANCHOR_ROWS):
            found = stored(matches(parts, open_.withColumn("low", F.greatest(low, F.col("floor"))), best, positive), name)
        filled = found.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") >= best).select("query")
        full = open_.join(filled, "query", "left_semi") if not last else open_
        if not last:
            # A window that reaches down to its own bound is final as well.
            full = full.unionByName(open_.join(filled, "query", "left_anti").where(low <= F.col("floor")))
        done.append(found.join(full.select("query"), "query", "left_semi"))
        if last:
            break
        open_ = stored(open_.join(full.select("query"), "query", "left_anti"), f"{name}-open")
        if open_.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are rows whose vec_id is divisible by ``every``; positives the first rows of the same label by score, then id;
    negatives the first rows of another label with ``low`` <= 100 * score / positive score <= ``high``.
    """
    vectors = integer_vectors(rows)
    parts = stored(blocks(vectors), "vector-blocks")
    anchors = vectors.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("anchor_id"), "label", "q")
    norm = F.aggregate("q", F.lit(0.0), lambda s, v: s + v * v)
    anchors = anchors.withColumn("norm", norm).withColumn("query", F.monotonically_increasing_id())
    anchors = stored(anchors.withColumn("high", F.lit(float("inf"))).withColumn("floor", F.lit(float("-inf"))), "anchors")
    steps, share = [], FIRST
    while share >= LAST:
        steps.append(F.col("norm") * share)
        share *= LOWER
    near = stored(_rounds(parts, anchors, positives, True, [*steps, F.lit(float("-inf"))], "positives"), "anchor-positives")
    near = near.select(F.col("query").alias("anchor"), "vec_id", "score", F.col("rank").alias("place"))
    # Positives of one score share their window; below 0 there is none.
    windows = near.where("score >= 0").select("anchor", F.col("score").alias("positive")).distinct()
    windows = windows.join(anchors.select(F.col("query").alias("anchor"), "anchor_id", "label", "q"), "anchor")
    windows = windows.withColumn("query", F.monotonically_increasing_id())
    windows = windows.withColumn("high", F.floor(F.col("positive").cast("decimal(20,0)") * high / 100).cast("double")).withColumn(
        "floor", F.ceil(F.col("positive").cast("decimal(20,0)") * low / 100).cast("double"))
    windows = stored(windows, "windows")
    bounds = [F.col("positive") * s for s in WINDOW_STEPS] + [F.col("floor")]
    far = _rounds(parts, windows, negatives, False, bounds, "negatives")
    far = far.join(windows.select("query", "anchor", "anchor_id", "positive"), "query")
    out = near.join(
        far.select("anchor", "anchor_id", F.col("positive").alias("score"), F.col("vec_id").alias("negative"),
                   F.col("score").alias("negative_score"), "rank"),
        ["anchor", "score"])
    known = lambda c: F.when(F.col(c) != _LAST_ID, F.col(c))
    return out.select(
        "anchor_id", known("vec_id").alias("positive_id"), "rank", known("negative").alias("negative_id"),
        F.col("score").alias("positive_score"), "negative_score")


SQL = r"""
WITH v AS (
  SELECT row_number() OVER () AS row_no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.row_no, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id NULLS LAST) AS place
  FROM scores WHERE same AND vec_id IS DISTINCT FROM anchor_id QUALIFY place <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.row_no, place ORDER BY n.score DESC, n.vec_id NULLS LAST)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.row_no = p.row_no AND NOT n.same
WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""
