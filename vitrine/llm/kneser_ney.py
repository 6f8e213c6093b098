"""Interpolated modified Kneser-Ney language model: counted in Spark, memory-mapped by the workers that score.

Bigrams with their raw counts over unigrams with continuation counts over a uniform share for the unknown word:

    P(w | u) = (c(u w) - D[c]) / c(u .) + gamma(u) P(w),    P(w) = (k(w) - D'[k]) / k(.) + gamma' / (V + 1)

with k(w) the number of different words before w, and discounts D1, D2, D3+ from the counts of counts (Chen and Goodman).
Words are 64-bit hashes. Every text begins in one context and ends with one token.

1. Word counts: distinct words of some millions of tokens at a time are packed per shard of the hash range; each shard is
   added up.
2. Bigram counts, likewise, sharded by their first word. First words with more than a quarter of a shard's mean share of
   all tokens (fewer than four for each shard, so the list is bounded) are sharded by the bigram instead. Each shard becomes a sorted hash array
   with counts, and sends on what it knows of contexts and continuations.
3. Word shards join counts, continuations and contexts to sorted arrays.

Arrays lie in the shared folder, are written under a name of the task's own and renamed, so a task can run again. Pages
of the map that aren't needed are dropped by the system, so a worker's memory doesn't grow with the model.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.core import shared_dir, small_batches, stored, worker_cache
from vitrine.llm.hashing import U, mix, parts, words

BEGIN, END = 0x243F6A8885A308D3, 0x13198A2E03707344  # hashes of the first context and the last token
FLUSH = 2_500_000  # tokens that are counted together before they are sent
FREQUENT = 4  # a word is frequent above 1 / (FREQUENT * shards) of all tokens
FOLDS, HELD_OUT = 5, 1


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo FOLDS; a null counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def _stream(column):
    """(token, context, row) of all texts of a column, end tokens included, in pieces of some megabytes."""
    import numpy as np

    for first, offsets, data in parts(column):
        hashes, row = words(offsets, data)
        n = len(offsets) - 1
        ends = np.searchsorted(row, np.arange(n), "right") + np.arange(n)
        token = np.empty(len(hashes) + n, np.uint64)
        token[np.arange(len(hashes)) + row] = hashes
        token[ends] = END
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[0] = BEGIN
        context[ends[:-1] + 1] = BEGIN
        rows = np.repeat(np.arange(n), np.diff(ends, prepend=-1))
        yield first, n, token, context, rows


def _shard(hashes, shards: int):
    """The part of the hash range that each hash lies in."""
    return ((hashes >> U(32)) * U(shards)) >> U(32)


def _pair(context, token):
    return mix(context * U(0x9E3779B97F4A7C15) + (token ^ (token >> U(29))))


def _pair_shard(context, pair, hot, shards: int):
    import numpy as np

    by = mix(context)
    if len(hot):
        often = hot[np.minimum(np.searchsorted(hot, context), len(hot) - 1)] == context
        by = np.where(often, mix(pair), by)
    return _shard(by, shards)


def _tally(keys, values):
    """Distinct keys, sorted, and the sums of their values (one array or several)."""
    import numpy as np

    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], [np.add.reduceat(v[order], first) if len(first) else v for v in values], order[first]


def _pieces(shard, arrays):
    """(shard, bytes of each array) for each shard in use."""
    import numpy as np

    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
    for a, b in zip(cuts, np.append(cuts[1:], len(shard)) if len(shard) else []):
        yield int(shard[a]), [x[order[a:b]].tobytes() for x in arrays]


def _write(folder: str, name: str, **arrays) -> None:
    """Arrays as files folder/name.array.npy, each put in place at once."""
    import numpy as np

    for key, x in arrays.items():
        own = f"{folder}/.{name}.{key}.{uuid.uuid4().hex}.npy"
        np.save(own, x)
        os.replace(own, f"{folder}/{name}.{key}.npy")


def _open(folder: str, name: str, key: str):
    """A mapped array; an empty one if the shard has none."""
    import numpy as np

    path = f"{folder}/{name}.{key}.npy"
    if not os.path.exists(path):
        return None
    x = np.load(path, mmap_mode="r")
    return x if len(x) else None


def _flushed(batches, most: int):
    """Tokens and contexts of about ``most`` tokens at a time."""
    import numpy as np

    held, n = [], 0
    for batch in batches:
        for _, _, token, context, _ in _stream(batch.column("text")):
            held.append((token, context))
            n += len(token)
            if n >= most:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, n = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _word_counts(texts: DataFrame, folder: str, shards: int) -> DataFrame:
    """Writes sorted (word, c) arrays per shard; (n, tokens) per shard."""
    def counted(batches):
        import numpy as np
        import pyarrow as pa

        for token, _ in _flushed(batches, FLUSH):
            keys, (c,), _ = _tally(token, [np.ones(len(token), np.int64)])
            rows = [(s, *x) for s, x in _pieces(_shard(keys, shards), [keys, c.astype(np.uint32)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["shard", "k", "c"])

    def added(batches):
        import numpy as np
        import pyarrow as pa

        keys, counts, shard = [], [], None
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                keys.append(np.frombuffer(row["k"], np.uint64))
                counts.append(np.frombuffer(row["c"], np.uint32).astype(np.int64))
        if keys:
            keys, (c,), _ = _tally(np.concatenate(keys), [np.concatenate(counts)])
            _write(folder, f"count-{shard}", k=keys, c=c)
            yield pa.RecordBatch.from_arrays([pa.array([len(keys)]), pa.array([int(c.sum())])], ["n", "tokens"])

    return texts.mapInArrow(counted, "shard int, k binary, c binary").repartitionById(shards, F.col("shard")).mapInArrow(
        added, "n bigint, tokens bigint")


def _frequent_words(spark, folder: str, shards: int, tokens: int) -> list[int]:
    """Words above 1 / (FREQUENT * shards) of all tokens; so there are fewer than FREQUENT * shards."""
    def picked(batches):
        import pyarrow as pa

        for batch in batches:
            for shard in batch.column("id").to_pylist():
                k, c = _open(folder, f"count-{shard}", "k"), _open(folder, f"count-{shard}", "c")
                if k is not None:
                    often = k[c * (FREQUENT * shards) > tokens]
                    yield pa.RecordBatch.from_arrays([pa.array(often.view("int64"))], ["word"])

    rows = spark.range(0, shards, 1, min(shards, 64)).mapInArrow(picked, "word bigint").collect()
    return [row.word & 0xFFFFFFFFFFFFFFFF for row in rows]


def _bigram_counts(texts: DataFrame, folder: str, shards: int, hot_words: list[int]) -> DataFrame:
    """Writes sorted (bigram, c) arrays per shard; rows for word shards: kind 0 contexts, 1 continuations; counts of counts."""
    def counted(batches):
        import numpy as np
        import pyarrow as pa

        hot = np.array(sorted(hot_words), np.uint64)
        for token, context in _flushed(batches, FLUSH):
            pair = _pair(context, token)
            keys, (c,), first = _tally(pair, [np.ones(len(pair), np.int32)])
            u, w, shard = context[first], token[first], _pair_shard(context[first], keys, hot, shards)
            del pair, token, context
            order = np.lexsort((u, shard))
            u, w, c, shard = u[order], w[order], c[order].astype(np.uint32), shard[order]
            rows = []
            cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            for a, b in zip(cuts, np.append(cuts[1:], len(shard))):
                starts = np.flatnonzero(np.append(True, u[a + 1:b] != u[a:b - 1]))
                rows.append((int(shard[a]), u[a:b][starts].tobytes(), np.diff(starts, append=b - a).astype(np.uint32).tobytes(),
                             w[a:b].tobytes(), c[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 4)], ["shard", "u", "r", "w", "c"])

    def added(batches):
        import numpy as np
        import pyarrow as pa

        us, ws, cs, shard = [], [], [], None
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                us.append(np.repeat(np.frombuffer(row["u"], np.uint64), np.frombuffer(row["r"], np.uint32)))
                ws.append(np.frombuffer(row["w"], np.uint64))
                cs.append(np.frombuffer(row["c"], np.uint32))
        if not us:
            return
        u, w, c = np.concatenate(us), np.concatenate(ws), np.concatenate(cs).astype(np.int64)
        del us, ws, cs
        keys, (c,), first = _tally(_pair(u, w), [c])
        u, w = u[first], w[first]
        large = c >= 255
        _write(folder, f"pair-{shard}", k=keys, c=np.minimum(c, 255).astype(np.uint8), bk=keys[large], bc=c[large])
        of = [int((c == i).sum()) for i in (1, 2, 3, 4)]
        del keys
        rows = []
        ctx, sums, _ = _tally(u, [c, (c == 1).astype(np.int64), (c == 2).astype(np.int64), (c > 2).astype(np.int64)])
        for s, x in _pieces(_shard(ctx, shards), [ctx, sums[0], *[v.astype(np.uint32) for v in sums[1:]]]):
            rows.append((s, 0, *x))
        after, (k,), _ = _tally(w, [np.ones(len(w), np.int64)])
        for s, x in _pieces(_shard(after, shards), [after, k.astype(np.uint32)]):
            rows.append((s, 1, *x, b"", b"", b""))
        n = [[v if i == 0 else 0 for i in range(len(rows))] for v in of]
        kinds = [pa.int32()] * 2 + [pa.binary()] * 5
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(x, t) for x, t in zip(zip(*rows), kinds)], *[pa.array(x, pa.int64()) for x in n]],
            ["shard", "kind", "k", "a", "b", "d", "e", "n1", "n2", "n3", "n4"])

    return texts.mapInArrow(counted, "shard int, u binary, r binary, w binary, c binary").repartitionById(
        shards, F.col("shard")).mapInArrow(
        added, "shard int, kind int, k binary, a binary, b binary, d binary, e binary, n1 bigint, n2 bigint, n3 bigint, n4 bigint")


def _word_arrays(known: DataFrame, folder: str, shards: int) -> DataFrame:
    """Writes the words' sorted arrays (word, c, continuations, context totals); counts of counts per shard."""
    def joined(batches):
        import numpy as np
        import pyarrow as pa

        ctx, after, shard = [], [], None
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                k = np.frombuffer(row["k"], np.uint64)
                if row["kind"]:
                    after.append((k, np.frombuffer(row["a"], np.uint32).astype(np.int64)))
                else:
                    ctx.append((k, np.frombuffer(row["a"], np.int64),
                                *[np.frombuffer(row[x], np.uint32).astype(np.int64) for x in "bde"]))
        if shard is None:
            return
        counts, c = _open(folder, f"count-{shard}", "k"), _open(folder, f"count-{shard}", "c")
        none = np.zeros(0, np.uint64)
        ctx_k, sums, _ = _tally(np.concatenate([x[0] for x in ctx] or [none]), [
            np.concatenate([x[i] for x in ctx] or [np.zeros(0, np.int64)]) for i in range(1, 5)])
        after_k, (cont,), _ = _tally(np.concatenate([x[0] for x in after] or [none]), [
            np.concatenate([x[1] for x in after] or [np.zeros(0, np.int64)])])
        keys = np.union1d(np.union1d(ctx_k, after_k), none if counts is None else counts)

        def spread(k, v):
            out = np.zeros(len(keys), np.int64)
            out[np.searchsorted(keys, k)] = v
            return out

        own = spread(counts, c) if counts is not None else np.zeros(len(keys), np.int64)
        cont = spread(after_k, cont)
        sums = [spread(ctx_k, v) for v in sums]
        _write(folder, f"word-{shard}", k=keys, c=own, cont=cont.astype(np.uint32), total=sums[0],
               f1=sums[1].astype(np.uint32), f2=sums[2].astype(np.uint32), f3=sums[3].astype(np.uint32))
        stats = [int((cont == i).sum()) for i in (1, 2, 3, 4)] + [int((cont > 2).sum()), int(cont.sum())]
        names = ["m1", "m2", "m3", "m4", "m3up", "total"]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in stats], names)

    return known.repartitionById(shards, F.col("shard")).mapInArrow(
        joined, "m1 bigint, m2 bigint, m3 bigint, m4 bigint, m3up bigint, total bigint")


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """D1, D2, D3+; where a count of counts is missing, one half of the way to the next count, as a fixed choice."""
    if min(n1, n2, n3, n4) == 0:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.0), float(i)) for i, d in enumerate(found, 1))


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    folder: str
    shards: int
    hot: list[int]
    tokens: int  # N
    words: int  # V
    d2: tuple[float, float, float]
    d1: tuple[float, float, float]
    continuations: int
    spare: float  # gamma' of the unigrams


def train(texts: DataFrame, name: str = "kneser-ney") -> Model:
    """The model of all rows of ``texts`` (text). An empty table gives a model of the unknown word alone."""
    spark = texts.sparkSession
    small_batches(spark)
    at = urlparse(shared_dir(spark))
    if at.scheme not in ("", "file"):
        raise ValueError(f"arrays can be mapped from a mounted folder only, not from {at.scheme}:")
    folder, shards = f"{at.path}/vitrine-{name}-{uuid.uuid4().hex}", max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    os.makedirs(folder)
    counted = stored(_word_counts(texts.select("text"), folder, shards), f"{name}-words")
    n, v = counted.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot = _frequent_words(spark, folder, shards, n) + [BEGIN]
    known = stored(_bigram_counts(texts.select("text"), folder, shards, hot), f"{name}-bigrams")
    of = known.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in (1, 2, 3, 4)]).first()
    names = ["m1", "m2", "m3", "m4", "m3up", "total"]
    stats = stored(_word_arrays(known.drop("n1", "n2", "n3", "n4"), folder, shards), f"{name}-stats")
    m1, m2, m3, m4, m3up, total = stats.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in names]).first()
    d1 = discounts(m1, m2, m3, m4)
    spare = (d1[0] * m1 + d1[1] * m2 + d1[2] * m3up) / total if total else 1.0
    return Model(folder, shards, hot, n, v, discounts(*of), d1, total, spare)


class Reader:
    """Looks up sorted, distinct hashes in the mapped arrays."""

    def __init__(self, model: Model):
        import numpy as np

        self.model, self.open = model, {}
        self.hot = np.array(sorted(model.hot), np.uint64)

    def _array(self, name: str, key: str):
        if (name, key) not in self.open:
            self.open[name, key] = _open(self.model.folder, name, key)
        return self.open[name, key]

    def find(self, kind: str, shard, keys, columns: dict):
        """The columns' values of each key, 0 where it isn't there; ``shard`` and ``keys`` sorted by (shard, key)."""
        import numpy as np

        out = {c: np.zeros(len(keys), t) for c, t in columns.items()}
        cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(keys) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(keys)) if len(keys) else []):
            name = f"{kind}-{int(shard[a])}"
            k = self._array(name, "k")
            if k is None:
                continue
            i = np.minimum(np.searchsorted(k, keys[a:b]), len(k) - 1)
            have = k[i] == keys[a:b]
            for c, x in out.items():
                x[a:b][have] = self._array(name, c)[i[have]]
            if kind == "pair" and (out["c"][a:b] == 255).any():
                some = np.flatnonzero(out["c"][a:b] == 255)
                j = np.searchsorted(self._array(name, "bk"), keys[a:b][some])
                out["c"][a:b][some] = self._array(name, "bc")[j]
        return out

    def score(self, token, context):
        """(c(w), log10 P(w | u)) of each token."""
        import numpy as np

        m = self.model
        # Words and contexts: every distinct hash once.
        names, back = np.unique(np.concatenate([token, context]), return_inverse=True)
        got = self.find("word", _shard(names, m.shards), names, {
            "c": np.int64, "cont": np.int64, "total": np.int64, "f1": np.int64, "f2": np.int64, "f3": np.int64})
        off = lambda c, d: np.where(c > 2, d[2], np.where(c == 2, d[1], np.where(c == 1, d[0], 0.0)))
        low = m.spare / (m.words + 1) + (got["cont"] - off(got["cont"], m.d1)) / max(m.continuations, 1)
        total = got["total"]
        gamma = np.where(total > 0, (m.d2[0] * got["f1"] + m.d2[1] * got["f2"] + m.d2[2] * got["f3"]) / np.maximum(total, 1), 1.0)
        w, u = back[:len(token)], back[len(token):]
        pair, at, again = np.unique(_pair(context, token), return_index=True, return_inverse=True)
        shard = _pair_shard(context[at], pair, self.hot, m.shards)
        order = np.lexsort((pair, shard))
        c = np.empty(len(pair), np.int64)
        c[order] = self.find("pair", shard[order], pair[order], {"c": np.int64})["c"]
        c = c[again]
        high = (c - off(c, m.d2)) / np.maximum(total[u], 1)
        return got["c"][w], np.log10(high + gamma[u] * low[w])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row; null and empty texts are one end token.

    ``base_score``: add-one-half unigrams over N, V and one unknown word. Sums run in the order of the text.
    """
    small_batches(docs.sparkSession)

    def scored(batches):
        import math

        import numpy as np
        import pyarrow as pa

        cache = worker_cache()
        if cache.get("model") != model:
            cache["model"], cache["reader"] = model, Reader(model)
        reader = cache["reader"]
        below = math.log10(model.tokens + 0.5 * (model.words + 1))
        for batch in batches:
            for first, n, token, context, row in _stream(batch.column("text")):
                c, p = reader.score(token, context)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, n), pa.array(np.bincount(row, minlength=n)),
                    pa.array(np.bincount(row, c > 0, n).astype(np.int64)),
                    pa.array(np.bincount(row, np.log10(c + 0.5) - below, n)), pa.array(np.bincount(row, p, n))],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scored, f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double")


def held_out_scores(docs: DataFrame) -> DataFrame:
    """Every document scored by the model of those outside fold HELD_OUT, itself in training or not."""
    texts = docs.where(fold(F.col("doc_id")) != HELD_OUT)
    model = train(texts)
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
