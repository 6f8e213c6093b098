"""Phrase collocations per language: runs of two to five words that occur together far more often than their parts.

Texts are cut into pieces at punctuation and line ends, pieces into words. Frequent phrases are found in two passes:

1. Texts are packed into chunks of one language. Every run of one to five words becomes a short hash; a chunk's hashes
   with their counts, cut into hash partitions, are its exact local summaries. Per hash partition the summaries are
   merged into one Misra-Gries summary. Its capacity exceeds the partition's mass over the threshold, so that all that
   is ever subtracted stays below the threshold and every frequent run survives. The number of partitions
   follows the mass, so a summary is bounded at any size of the corpus.
2. Each chunk gets back those of its own hashes that survived, and counts the runs behind them exactly, by their words.
   Runs that only share a hash with a frequent one are dropped here.

Nothing is broadcast by force, no set of frequent phrases passes through the driver. A short hash has six bits more than
the mass over the threshold asks for; inside one chunk runs are told apart by 64 bits.

Null texts are empty, a null lang is ``und``, repeated rows count each time, other columns are not read, empty
tables give no rows. A long text is cut at breaks into several chunks; a piece is never cut.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from vitrine.llm.core import batches_of, discard, stored
from vitrine.llm.hashing import U, _tables, mix

# What ends a piece, and what parts words within one.
BREAKS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"

LONGEST = 5
CHUNK = 4 << 20  # bytes of text
SEGMENT = 1 << 20  # bytes hashed at once
PART_MASS = 1 << 23  # runs of words per hash partition
LEAST_PARTS = 64
SLACK = 4  # counters per summary over mass / threshold
FILTER_BITS = 24

_PLAIN = bytes.maketrans(BREAKS + GAPS, b"\n" * len(BREAKS) + b" " * len(GAPS))


def _cuts(body: bytes, size: int, at: bytes):
    """``body`` in runs of about ``size`` bytes that end with the byte ``at``."""
    start = 0
    while len(body) - start > size:
        end = body.rfind(at, start, start + size) + 1
        if not end:
            end = body.find(at, start + size) + 1 or len(body)
        yield body[start:end]
        start = end
    if start < len(body):
        yield body[start:]


def word_bounds(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, piece) of each word of a normalised body."""
    data = np.frombuffer(body, np.uint8)
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = (data != 32) & (data != 10)
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.r_[0, edge]
    if inside[-1]:
        edge = np.r_[edge, len(data)]
    start, end = edge[::2], edge[1::2]
    return start, end, np.searchsorted(np.flatnonzero(data == 10), start)


def word_hashes(body: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = np.empty(len(start), np.uint64)
    data = np.frombuffer(body, np.uint8)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SEGMENT, "right")))
        low, high = start[i], end[j - 1]
        t = _tables(int(high - low))
        sums = np.cumsum(t["code"][data[low:high]] * t["up"][:high - low])
        s, e = start[i:j] - low, end[i:j] - low
        before = np.where(s > 0, sums[s - 1], U(0))
        out[i:j] = mix((sums[e - 1] - before) * t["down"][s] + (e - s).astype(np.uint64) * U(0x9E3779B97F4A7C15))
        i = j
    return out


def runs_of_words(lang: str, words: np.ndarray, piece: np.ndarray, longest: int):
    """(order, places, 64-bit hashes) of all runs of 1 to ``longest`` words within pieces."""
    seed = U(int.from_bytes(lang.encode()[:64], "little") * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    running = np.zeros(len(words), np.uint64)
    for order in range(1, longest + 1):
        n = len(words) - order + 1
        if n <= 0:
            return
        running = running[:n] * U(0xA24BAED4963EE407) + words[order - 1:]
        at = np.flatnonzero(piece[:n] == piece[order - 1:])
        yield order, at, mix(running[at] + seed + U(order))


def mass_of(piece: np.ndarray, longest: int) -> int:
    lengths = np.unique(piece, return_counts=True)[1] if len(piece) else np.zeros(0, np.int64)
    return int(sum(np.maximum(lengths - order + 1, 0).sum() for order in range(1, longest + 1)))


def _carry(x: np.ndarray) -> np.ndarray:
    """Numbers as bytes below 255, each after as many bytes 255 as it holds 255."""
    many, rest = np.divmod(x, 255)
    ends = np.cumsum(many + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = rest
    return out


def _uncarry(b: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(b != 255)
    return (np.diff(ends, prepend=-1) - 1) * 255 + b[ends]


def packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct numbers with their counts: low bytes, then high parts and counts as carried bytes."""
    steps = np.diff(values, prepend=values.dtype.type(0)).astype(np.uint64)
    wide = int(steps[1:].mean()).bit_length() // 8 if len(steps) > 1 else 0
    low = steps.view(np.uint8).reshape(-1, 8)[:, :wide]
    high = _carry((steps >> U(8 * wide)).astype(np.int64))
    head = np.array([len(values), wide, len(high)], np.int64)
    return b"".join((head.tobytes(), low.tobytes(), high.tobytes(), _carry(counts.astype(np.int64) - 1).tobytes()))


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, wide, size = np.frombuffer(blob, np.int64, 3).tolist()
    at = 24 + n * wide
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :wide] = np.frombuffer(blob, np.uint8, n * wide, 24).reshape(n, wide)
    steps = steps.view(np.uint64).reshape(n)
    steps = steps + (_uncarry(np.frombuffer(blob, np.uint8, size, at)).astype(np.uint64) << U(8 * wide))
    return np.cumsum(steps, dtype=np.uint64), _uncarry(np.frombuffer(blob, np.uint8, -1, at + size)) + 1


class MisraGries:
    """Counters of the heaviest keys; a true count is at most the counter plus ``lost``, which stays below mass / capacity."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._new: list = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._new.append((keys, counts))
        self._size += len(keys)
        if self._size >= max(1 << 19, self.capacity):
            self.settle()

    def settle(self) -> None:
        """Merges what was added and, over capacity, subtracts the largest counter that has no place from all."""
        parts = [(self.keys, self.counts), *self._new]
        self._new, self._size = [], 0
        keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > self.capacity:
            at = len(keys) - self.capacity - 1
            cut = int(np.partition(counts, at)[at])
            self.lost += cut
            keys, counts = keys[counts > cut], counts[counts > cut] - cut
        self.keys, self.counts = keys, counts

    def at_least(self, threshold: int) -> np.ndarray:
        """Sorted keys, among them all whose true count reaches ``threshold``."""
        self.settle()
        return self.keys[self.counts + self.lost >= threshold]


def chunks(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(chunk, lang, body, n, mass): normalised texts of one language, words and runs of words in them."""

    def pack(batches):
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def rows(lang):
            body = b"\n".join(held.pop(lang))
            del size[lang]
            for part in _cuts(body, CHUNK, b"\n"):
                start, _, piece = word_bounds(part)
                if len(start):
                    yield pa.record_batch({
                        "lang": [lang], "body": pa.array([part], pa.binary()), "n": [len(start)], "mass": [mass_of(piece, longest)]})

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, body = lang.as_py(), text.as_buffer()
                body = body.to_pybytes().lower().translate(_PLAIN) if body is not None else b""
                held.setdefault(lang, []).append(body)
                size[lang] = size.get(lang, 0) + len(body) + 1
                if size[lang] >= CHUNK:
                    yield from rows(lang)
                elif len(held) > 8 and sum(size.values()) >= 2 * CHUNK:
                    yield from rows(max(size, key=size.get))
        for lang in list(held):
            yield from rows(lang)

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    packed_texts = texts.mapInArrow(pack, "lang string, body binary, n long, mass long")
    return packed_texts.withColumn("chunk", F.monotonically_increasing_id())


def surviving(parts: DataFrame, threshold: int, mass: int, longest: int = LONGEST) -> tuple[DataFrame, int]:
    """(chunk, p, hits) and the bits of a short hash: per chunk its hashes that may reach ``threshold`` in all chunks."""
    bits = min(60, max(20, math.ceil(math.log2(max(mass // threshold, 1) + 1)) + 6))
    levels = max(LEAST_PARTS, 1 << math.ceil(math.log2(mass / PART_MASS + 1)))
    levels = min(levels, 1 << 20)
    shift = U(bits - int(math.log2(levels)))

    def summaries(batches):
        for batch in batches:
            for chunk, lang, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                start, end, piece = word_bounds(body)
                words = word_hashes(body, start, end)
                short = [h >> U(64 - bits) for _, _, h in runs_of_words(lang, words, piece, longest)]
                short = np.concatenate(short)
                if bits <= 32:
                    short = short.astype(np.uint32)
                short.sort()
                first = np.flatnonzero(np.r_[True, short[1:] != short[:-1]])
                counts = np.diff(np.r_[first, len(short)])
                short = short[first].astype(np.uint64)
                edges = np.searchsorted(short, np.arange(levels + 1, dtype=np.uint64) << shift)
                sums = np.add.reduceat(np.r_[counts, 0], np.minimum(edges[:-1], len(counts)))
                full = np.flatnonzero(edges[1:] > edges[:-1])
                yield pa.record_batch({
                    "p": pa.array(full, pa.int64()), "chunk": pa.array([chunk] * len(full), pa.int64()),
                    "own": pa.array(sums[full], pa.int64()),
                    "summary": pa.array([packed(short[edges[p]:edges[p + 1]] - (U(p) << shift), counts[edges[p]:edges[p + 1]])
                                         for p in full], pa.binary())})

    def merged(table: pa.Table) -> pa.Table:
        summary = MisraGries(SLACK * (sum(table["own"].to_pylist()) // threshold + 1))
        for x in table["summary"]:
            summary.add(*unpacked(x.as_buffer()))
        frequent = summary.at_least(threshold)
        own, hits = [], []
        for chunk, p, x in zip(table["chunk"].to_pylist(), table["p"].to_pylist(), table["summary"]):
            keys = unpacked(x.as_buffer())[0]
            at = np.minimum(np.searchsorted(keys, frequent), len(keys) - 1)
            both = frequent[keys[at] == frequent]
            if len(both):
                own.append((chunk, p))
                hits.append(packed(both, np.ones(len(both), np.int64)))
        return pa.table({"chunk": pa.array([c for c, _ in own], pa.int64()), "p": pa.array([p for _, p in own], pa.int64()),
                         "hits": pa.array(hits, pa.binary())})

    local = parts.select("chunk", "lang", "body").mapInArrow(summaries, "p long, chunk long, own long, summary binary")
    found = local.groupBy("p").applyInArrow(merged, "chunk long, p long, hits binary")
    return found.withColumn("hits", F.struct("p", "hits")), (bits, int(shift))


def exact_counts(parts: DataFrame, hits: DataFrame, hashing: tuple[int, int], threshold: int, longest: int = LONGEST) -> DataFrame:
    """(lang, size, phrase, f) of the runs of words with f >= ``threshold``, counted by their words.

    A chunk's counts travel like its summaries: one packed row for each hash partition.
    """
    bits, shift = hashing

    def count(batches):
        for batch in batches:
            for lang, body, hits in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keep = np.concatenate([
                    unpacked(x["hits"])[0] + (U(x["p"]) << U(shift)) for x in sorted(hits, key=lambda x: x["p"])])
                table = np.zeros(1 << min(FILTER_BITS, bits), bool)
                low = U(len(table) - 1)
                table[keep & low] = True
                start, end, piece = word_bounds(body)
                letters = np.r_[0, np.cumsum(end - start)]
                found = [(np.zeros(0, np.int64),) * 4]
                for order, at, keys in runs_of_words(lang, word_hashes(body, start, end), piece, longest):
                    short = keys >> U(64 - bits)
                    some = np.flatnonzero(table[short & low])
                    own = short[some]
                    some = some[keep[np.minimum(np.searchsorted(keep, own), len(keep) - 1)] == own]
                    _, first, f = np.unique(keys[some], return_index=True, return_counts=True)
                    first = some[first]
                    found.append(((short[first] >> U(shift)).astype(np.int64), at[first], f, np.full(len(f), order)))
                p, first, f, order = (np.concatenate(x) for x in zip(*found))
                by = np.argsort(p, kind="stable")
                p, first, f, order = p[by], first[by], f[by], order[by]
                a, b = start[first], end[first + order - 1]
                plain = b - a == letters[first + order] - letters[first] + order - 1
                text = pa.array([body[i:j] if one else b" ".join(body[i:j].split())
                                 for i, j, one in zip(a.tolist(), b.tolist(), plain.tolist())], pa.binary()).cast(pa.string())
                full, edges = np.unique(p, return_index=True)
                edges = pa.array(np.r_[edges, len(p)], pa.int32())
                lists = {n: pa.ListArray.from_arrays(edges, x) for n, x in (
                    ("sizes", pa.array(order, pa.int32())), ("phrases", text), ("counts", pa.array(f, pa.int64())))}
                yield pa.record_batch({"p": pa.array(full, pa.int64()), "lang": pa.array([lang] * len(full), pa.string()), **lists})

    def total(table: pa.Table) -> pa.Table:
        each = pa.table({
            "lang": table["lang"].combine_chunks().take(pc.list_parent_indices(table["phrases"].combine_chunks())),
            **{one: pc.list_flatten(table[many].combine_chunks())
               for one, many in (("size", "sizes"), ("phrase", "phrases"), ("f", "counts"))}})
        sums = each.group_by(["lang", "size", "phrase"]).aggregate([("f", "sum")])
        sums = sums.select(["lang", "size", "phrase", "f_sum"]).rename_columns(["lang", "size", "phrase", "f"])
        return sums.filter(pc.greater_equal(sums["f"], threshold))

    grouped = hits.groupBy("chunk").agg(F.collect_list("hits").alias("hits"))
    local = parts.join(grouped, "chunk").select("lang", "body", "hits").mapInArrow(
        count, "p long, lang string, sizes array<int>, phrases array<string>, counts array<long>")
    return local.groupBy("p").applyInArrow(total, "lang string, size int, phrase string, f long")


def frequent_phrases(docs: DataFrame, threshold: int, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all runs of 1 to ``longest`` words with f >= ``threshold``, and (lang, n)."""
    parts = stored(chunks(docs, longest), "phrase-chunks", {"parquet.block.size": str(4 * CHUNK)})
    mass = parts.agg(F.sum("mass")).first()[0] or 0
    hits, hashing = surviving(parts, threshold, mass, longest)
    with batches_of(docs.sparkSession, 1):
        hits = stored(hits, "phrase-hits")
        counts = stored(exact_counts(parts, hits, hashing, threshold, longest), "phrase-counts")
    totals = stored(parts.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    discard(parts, hits)
    return counts, totals


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score) of phrases of two words or more, by their weakest cut."""
    big = lambda c: F.col(c).cast("decimal(18,0)")
    words = F.split("phrase", " ")
    pieces = counts.where("size > 1").select(
        "lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    pieces = pieces.select(
        "*", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cut = pieces.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    cut = cut.withColumn("up", F.lit(1000).cast("decimal(4,0)") * (big("a") * big("n"))).withColumn("down", big("l") * big("r"))
    cut = cut.withColumn("score", F.expr("up div down"))
    worst = F.min(F.struct("score", "k", "l", "r"))
    by = cut.groupBy("lang", "phrase", "size", "a", "n").agg(worst.alias("cut"))
    return by.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score")


def not_contained(candidates: DataFrame) -> DataFrame:
    """Candidates without those that occur only inside a longer one.

    What holds a phrase k words longer occurs no more often than the phrases between, so one word more or less decides.
    """
    words = F.split("phrase", " ")
    inner = candidates.where("size > 2").select(
        "lang", F.col("a").alias("outer"),
        F.explode(F.array(F.slice(words, F.lit(1), F.col("size") - 1), F.slice(words, F.lit(2), F.col("size") - 1))).alias("inner"))
    inner = inner.groupBy("lang", F.array_join("inner", " ").alias("phrase")).agg(F.max("outer").alias("outer"))
    return candidates.join(inner, ["lang", "phrase"], "left").where("outer is null or outer < a").drop("outer")


def collocations(docs: DataFrame, threshold: int = 100, best: int = 2000, longest: int = LONGEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per lang the ``best`` phrases by score, count and phrase.

    Counts and scores are exact at any size: products are decimals of 38 digits. A language of any share of the corpus is
    cut into many chunks, and its ranks are taken from the best of each task.
    """
    counts, totals = frequent_phrases(docs, threshold, longest)
    left = not_contained(scored(counts, totals))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) piece FROM (
    SELECT coalesce(lang, 'und') lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT n FROM words GROUP BY lang
), runs AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) phrase
  FROM words, (VALUES (1), (2), (3), (4), (5)) s(size) WHERE len(w) >= size
), counts AS (
  SELECT lang, size, phrase, count(*) f FROM runs GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, size, phrase, f a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') first_words,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') rest
  FROM counts, (VALUES (1), (2), (3), (4)) c(k) WHERE k < size
), scores AS (
  SELECT c.lang, c.size, c.phrase, c.a, k, x.f l, y.f r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = first_words
  JOIN counts y ON y.lang = c.lang AND y.phrase = rest JOIN totals t ON t.lang = c.lang
), worst AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM worst s WHERE NOT EXISTS (
    SELECT 1 FROM counts o WHERE o.lang = s.lang AND o.size > s.size AND 100 * o.f >= 100 * s.a
    AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' '))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT score FROM ranked WHERE rank <= 2000
"""
