"""Repeated byte strings, found through enhanced suffix arrays of anchored suffixes, and texts without them.

Every window of ``length`` bytes is represented by the smallest hash of its 64-byte grams, its anchor: equal windows have
equal anchors at equal places, wherever they stand. Suffixes are sorted per anchor instead of all together:

1. A text becomes runs of windows with a common anchor; a run carries hashes of the anchor and of its whole excerpt.
   Excerpts that repeat within a task are marked there and sent once.
2. Anchors seen once end here. If all excerpts of an anchor are equal, all of its windows are repeats.
3. Otherwise its distinct excerpts are fetched. The suffixes from the anchor on are sorted, with longest common
   prefixes; a stack scan gives the intervals of the prefix tree. Within an interval the texts before the anchor are sorted and
   scanned likewise: where they differ (left-extension diversity) a group of occurrences is a maximal repeat, and if it is at
   least ``length`` long all its occurrences are covered.
4. An anchor with more than ``WIDE`` distinct excerpts is cut into parts first. Texts that share the window x bytes before
   the anchor agree in x bytes before it and ``length`` - x from it on; for any x in [low, high] that is at least low
   and ``length`` - high. So a wide part is halved by x, and each half is cut by the text that is shared in it, until all
   parts are narrow enough to sort. In a half only the text of its windows counts: excerpts equal in that repeat wholly
   there, and one of them goes on for all.

Covers are united per document, and what is left is hashed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.llm.core import discard, small_batches, stored
from vitrine.llm.hashing import U, _tables, mix, parts

LENGTH, GRAM = 400, 64
WIDE = 500  # excerpts sorted together; more are cut into parts, which changes no result
SLICE = 1 << 21  # bytes looked at together
POSITIONS = 22  # bits of a position within a slice


def _anchors(data, offsets, length: int):
    """(row, pos, lo, hi, anchor, excerpt) of the runs in texts laid end to end; windows at pos - hi .. pos - lo."""
    import numpy as np

    n = len(data)
    windows = n - length + 1
    if windows <= 0:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    t = _tables(n)
    h = mix(data.astype(np.uint64) + U(77))
    codes, width = h, 1
    while width < GRAM:
        h = h[:len(h) - width] * U(0xA24BAED4963EE407 + 2 * width) + h[width:]
        width *= 2
    h = mix(h)
    span = length - GRAM + 1
    least = (h >> U(POSITIONS) << U(POSITIONS)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width * 2 <= span:
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    at = (least & U((1 << POSITIONS) - 1)).astype(np.int64)
    # A window must lie in one text: the cut before each text takes the windows that reach over it.
    whole = np.ones(windows, bool)
    edge = np.zeros(windows + 1, np.int32)
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first, last = np.maximum(cuts - length + 1, 0), np.minimum(cuts, windows)
    some = first < last
    np.add.at(edge, first[some], 1)
    np.add.at(edge, last[some], -1)
    whole = np.cumsum(edge[:-1]) == 0
    starts = whole.copy()
    starts[1:] &= (at[1:] != at[:-1]) | ~whole[:-1]
    stops = whole.copy()
    stops[:-1] &= (at[1:] != at[:-1]) | ~whole[1:]
    smin, smax = np.flatnonzero(starts), np.flatnonzero(stops)
    pos = at[smin]
    sums = np.cumsum(codes * t["up"][:n])
    before = np.where(smin > 0, sums[smin - 1], U(0))
    shape = (pos - smin).astype(np.uint64) * U(65536) + (pos - smax).astype(np.uint64)
    excerpt = mix((sums[smax + length - 1] - before) * t["down"][smin] + shape * U(0x9E3779B97F4A7C15))
    row = np.searchsorted(offsets, smin, "right") - 1
    return row, pos, pos - smax, pos - smin, h[pos], excerpt


def _joined(lo, hi):
    """The maximal runs of the union of ranges."""
    import numpy as np

    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    first = np.ones(len(lo), bool)
    first[1:] = lo[1:] > hi[:-1]
    last = np.append(first[1:], True)
    return lo[first], hi[last]


OCCURRENCE = "doc_id bigint, row bigint, pos int, lo int, hi int, h bigint, e bigint, n int, start int, stop int"


def occurrences(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Rows of two kinds: runs (pos, lo, hi, h, e, n), and ranges known to repeat (start, stop); the rest is null.

    ``n``: how often a run's excerpt occurs in the slice of texts that was looked at; it is sent once.
    """
    small_batches(docs.sparkSession, 1024)

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        names = ["doc_id", "row", "pos", "lo", "hi", "h", "e", "n", "start", "stop"]
        whole = [pa.int32()] * 3 + [pa.int64()] * 2 + [pa.int32()] * 3
        for batch in batches:
            ids, rows = (batch.column(c) for c in ("doc_id", "row"))
            for first, offsets, data in parts(batch.column("text"), SLICE):
                for base in range(0, max(len(data), 1), SLICE):
                    end = min(len(data), base + SLICE + length - 1)
                    inner = np.clip(offsets - base, 0, end - base)
                    row, pos, lo, hi, h, e = _anchors(data[base:end], inner, length)
                    if not len(row):
                        continue
                    off = base - offsets[row]  # from places in the slice to places in the text
                    _, one, back, n = np.unique(e, return_index=True, return_inverse=True, return_counts=True)
                    take = pa.array(first + row[one])
                    yield pa.RecordBatch.from_arrays([
                        ids.take(take), rows.take(take),
                        *[pa.array(x[one].astype(np.int32)) for x in (pos + off, lo, hi)],
                        *[pa.array(x[one].view(np.int64)) for x in (h, e)], pa.array(n.astype(np.int32)),
                        *[pa.nulls(len(one), pa.int32())] * 2], names)
                    twice = np.flatnonzero(n[back] > 1)
                    if len(twice):
                        # Ranges of different texts are kept apart by the distance between texts.
                        gap = row[twice] * (len(data) + 1)
                        a, b = _joined(gap + (pos - hi)[twice], gap + (pos - lo)[twice] + length)
                        who = a // (len(data) + 1)
                        shift = base - offsets[who] - who * (len(data) + 1)
                        take = pa.array(first + who)
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(take), rows.take(take), *[pa.nulls(len(a), k) for k in whole[:6]],
                             pa.array((a + shift).astype(np.int32)), pa.array((b + shift).astype(np.int32))], names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("row"), "text").mapInArrow(
        cut, OCCURRENCE)


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def intervals(lcp: list[int]):
    """(value, first, last) of each interval of the prefix tree over a sorted list, by a scan with a stack.

    ``lcp[i]``: common prefix of entries i and i + 1. All entries of an interval share ``value`` and no more.
    """
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp, -1]):
        left = i
        while stack and stack[-1][0] > value:
            top, left = stack.pop()
            yield top, left, i
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, left))


def maximal_repeats(before: list[bytes], after: list[bytes], length: int):
    """(left, right, members): all maximal repeats of at least ``length`` bytes around one anchor.

    ``before``: the text up to the anchor, reversed; ``after``: the text from it on. Members share ``left`` bytes before
    the anchor and ``right`` from it on, and no more on either side.
    """
    order = sorted(range(len(after)), key=after.__getitem__)
    lcp = [_common(after[a], after[b]) for a, b in zip(order, order[1:])]
    by_left = sorted(range(len(before)), key=before.__getitem__)
    lcs = [_common(before[a], before[b]) for a, b in zip(by_left, by_left[1:])]
    place = {m: i for i, m in enumerate(by_left)}
    for right, first, last in intervals(lcp):
        if not right:
            continue
        if last - first + 1 == len(order):
            members, shared = by_left, lcs
        else:
            members = sorted(order[first:last + 1], key=place.__getitem__)
            shared = []
            for a, b in zip(members, members[1:]):
                i, j = place[a], place[b]
                shared.append(lcs[i] if j == i + 1 else min(lcs[i:j]) if j - i < 16 else _common(before[a], before[b]))
        need = length - right
        if max(shared) < need:
            continue
        child = {m: i for i, m in enumerate(order[first:last + 1], first)}
        for left, a, b in intervals(shared):
            if left < need:
                continue
            group = members[a:b + 1]
            # Right-maximal in this interval only if the group isn't inside one of its children.
            if len(group) < last - first + 1:
                places = [child[m] for m in group]
                if min(lcp[min(places):max(places)]) > right:
                    continue
            yield left, right, group


def _covers(excerpts: DataFrame, length: int) -> DataFrame:
    """(id, left, right): how far excerpts (part, id, lo, hi, text) repeat before and after the anchor in their part.

    All repeats of an excerpt hold its anchor, so their union is one range.
    """
    def scanned(batches):
        import pyarrow as pa

        def group(rows):
            before = [text[:hi][::-1] for _, hi, text in rows]
            after = [text[hi:] for _, hi, text in rows]
            far = [(0, 0)] * len(rows)
            for left, right, members in maximal_repeats(before, after, length):
                for m in members:
                    far[m] = max(far[m][0], left), max(far[m][1], right)
            return [(rows[m][0], *far[m]) for m in range(len(rows)) if far[m][1]]

        now, rows, out = None, [], []
        schema = pa.schema([("id", pa.string()), ("left", pa.int32()), ("right", pa.int32())])
        for batch in batches:
            for part, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "id", "hi", "text"))):
                if part != now:
                    if len(rows) > 1:
                        out += group(rows)
                    now, rows = part, []
                rows.append(row)
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), schema)], schema=schema)
                out = []
        if len(rows) > 1:
            out += group(rows)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), schema)], schema=schema)

    return excerpts.repartition("part").sortWithinPartitions("part").mapInArrow(scanned, "id string, left int, right int")


def _halved(wide: DataFrame, length: int) -> DataFrame:
    """(src, id, part, lo, hi, low, high, text): rows of wide parts in each half of the range that has windows of theirs.

    ``text`` and its ``lo`` and ``hi`` are cut to the windows of the half; rows equal in all of these have one ``id``.
    """
    names = ["src", "id", "part", "lo", "hi", "low", "high", "text"]

    def halves(batches):
        import hashlib

        import pyarrow as pa

        kinds = [pa.string()] * 3 + [pa.int32()] * 4 + [pa.binary()]
        digest = lambda *of: hashlib.blake2b(b"\0".join(of), digest_size=16).hexdigest()
        for batch in batches:
            out = []
            for src, part, lo, hi, low, high, text in zip(*(
                    batch.column(c).to_pylist() for c in ("id", "part", "lo", "hi", "low", "high", "text"))):
                mid = (low + high) // 2
                for a, b in ((low, mid), (mid + 1, high)):
                    first, last = max(a, lo), min(b, hi)
                    if first > last:
                        continue
                    shared = digest(f"{part} {a} {b}".encode(), text[hi - a:hi + length - b])
                    own = text[hi - last:hi + length - first]
                    out.append((src, digest(f"{shared} {first} {last}".encode(), own), shared, first, last, a, b, own))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return wide.mapInArrow(
        halves, "src string, id string, part string, lo int, hi int, low int, high int, text binary")


def _all_covers(texts: DataFrame, length: int) -> DataFrame:
    """(h, e, left, right), stored, of all excerpts (h, e, lo, hi, text) that repeat; wide parts are halved first.

    A range of ``length`` + 1 windows can be halved some ten times; then a part is one window and all in it is equal.
    """
    level = texts.select(
        F.col("h").cast("string").alias("part"), F.concat_ws(" ", "h", "e").alias("id"), "lo", "hi", "text",
        F.lit(0).alias("low"), F.lit(length).alias("high"))
    equal, found, steps, used = None, [], [], []
    while True:
        wide = stored(level.groupBy("part").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > WIDE).select("part"),
                      "wide-parts")
        used.append(wide)
        covers = _covers(level.join(wide, "part", "left_anti"), length)
        found.append(stored(covers.union(equal) if equal else covers, "part-covers"))
        if wide.isEmpty():
            break
        rows = stored(_halved(level.join(wide, "part", "left_semi"), length), "halves")
        level = stored(rows.groupBy("id").agg(
            F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("part", "lo", "hi", "low", "high", "text")]), "parts")
        equal = level.where("n > 1").select("id", F.col("hi").alias("left"), (length - F.col("lo")).alias("right"))
        steps.append(rows.select("src", "id"))
        used += [rows, level]
    covers = found[-1]
    for step, own in zip(reversed(steps), reversed(found[:-1])):
        covers = own.union(step.join(covers, "id").groupBy(F.col("src").alias("id")).agg(
            F.max("left").alias("left"), F.max("right").alias("right")))
    h, e = (F.split("id", " ")[i].cast("bigint") for i in (0, 1))
    covers = stored(covers.select(h.alias("h"), e.alias("e"), "left", "right"), "excerpt-covers")
    discard(*used, *found)
    return covers


def _packed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, row, z): texts compressed, as they move through shuffles whole."""
    small_batches(docs.sparkSession)

    def pack(batches):
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"),
                 pa.array([press.compress((x or "").encode()) for x in batch.column("text").to_pylist()], pa.binary())],
                ["doc_id", "row", "z"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("row"), "text").mapInArrow(
        pack, "doc_id bigint, row bigint, z binary")


def repeated_ranges(docs: DataFrame, packed: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, row, start, stop): byte ranges covered by strings of ``length`` bytes that start anywhere else too.

    Ranges may overlap. ``packed``: see ``_packed_texts``.
    """
    met = stored(occurrences(docs, length), "runs")
    runs = met.where("h IS NOT NULL").select("doc_id", "row", "pos", "lo", "hi", "h", "e", "n")
    sure = met.where("h IS NULL").select("doc_id", "row", "start", "stop")
    anchors = runs.groupBy("h").agg(F.sum("n").alias("n"), F.min("e").alias("a"), F.max("e").alias("b")).where("n > 1")
    anchors = stored(anchors.select("h", (F.col("a") != F.col("b")).alias("mixed")), "anchors")
    again = stored(runs.join(anchors, "h"), "repeated-runs")
    whole = [(F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + length).alias("stop")]
    pure = again.where("NOT mixed").select("doc_id", "row", *whole)

    mixed = again.where("mixed").drop("mixed")
    excerpts = mixed.groupBy("h", "e").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "row", "pos", "lo", "hi")).alias("at"))
    excerpts = stored(excerpts.select("h", "e", (F.col("n") > 1).alias("twice"), "at.*"), "excerpts")
    wanted = excerpts.groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(
        F.collect_list(F.struct("h", "e", "pos", "lo", "hi")).alias("runs"))
    texts = stored(packed.join(
        wanted.hint("shuffle_hash"), (F.col("row") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d"))
    ).select("doc_id", "row", "z", "runs").dropDuplicates(["doc_id", "row"]).select("z", "runs").mapInArrow(
        _fetch(length), "h bigint, e bigint, lo int, hi int, text binary"), "excerpt-texts")
    covers = _all_covers(texts, length)
    covers = covers.union(excerpts.where("twice").select("h", "e", F.col("hi").alias("left"), (length - F.col("lo")).alias("right")))
    covers = stored(covers.groupBy("h", "e").agg(F.max("left").alias("left"), F.max("right").alias("right")), "covers")
    found = mixed.join(covers, ["h", "e"]).select(
        "doc_id", "row", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("stop"))
    return sure.union(pure).union(found)


def _fetch(length: int):
    def fetch(batches):
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdDecompressor()
        names = ["h", "e", "lo", "hi", "text"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            for z, runs in zip(batch.column("z").to_pylist(), batch.column("runs").to_pylist()):
                text = press.decompress(z)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for k, c in zip(kinds, zip(*[
                    (r["h"], r["e"], r["lo"], r["hi"], text[r["pos"] - r["hi"]:r["pos"] - r["lo"] + length]) for r in runs]))], names)

    return fetch


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row; ``kept``: the bytes that stay.

    A byte goes if a string of ``length`` bytes over it also starts elsewhere, in any row; strings are judged on the
    input. Null counts as empty; texts shorter than ``length`` stay whole; rows that are wholly equal are copies of
    each other, and each is answered.
    """
    packed = _packed_texts(docs)
    ranges = repeated_ranges(docs, packed, length).groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(
        F.collect_set(F.struct("start", "stop")).alias("ranges"))

    def kept(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out, ranges = [], batch.column("ranges")
            ends, valid = ranges.offsets.to_numpy(), ranges.is_valid().to_pylist()
            start, stop = (ranges.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for i, z in enumerate(batch.column("z")):
                text = press.decompress(z.as_buffer())
                n = len(text)
                if valid[i] and ends[i] < ends[i + 1]:
                    own = slice(ends[i], ends[i + 1])
                    lo, hi = _joined(start[own], stop[own])
                    keep = np.ones(n, bool)
                    for a, b in zip(lo, hi):
                        keep[a:b] = False
                    text = np.frombuffer(text, np.uint8)[keep].tobytes()
                else:
                    lo = ()
                out.append((n, n - len(text), len(lo), hashlib.sha256(text).hexdigest(), text))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return packed.join(
        ranges.hint("shuffle_hash"), (F.col("row") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d")), "left",
    ).select("doc_id", "z", "ranges").mapInArrow(
        kept, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def suffix_dedup_digest(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes, removed runs and the SHA-256 of what is kept."""
    return without_repeats(docs).drop("kept")
