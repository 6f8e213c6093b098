"""Near copies by the exact Jaccard similarity of their word shingles.

Equal shingle sets are one class; classes are joined by partitioning the universe of shingles:

* Sizes fall into bands, each at least 5/4 of the one before, so a set finds all smaller partners in its own band or the one
  below. Two sets of sizes r and s with 5 |both| >= 4 |either| differ in at most (r + s) // 9 shingles.
* A band cuts the hash range into segments. The signature of a set's segment is a sum over its shingles; if two sets differ
  in at most h shingles, then for any thresholds t of -1, 0 or 1 per segment with a sum of (t + 1) above h, they differ in
  at most t shingles in some segment. Threshold 0 is an equal signature, 1 also one that is equal after deleting one
  shingle on either side (kept for bands of small sets, whose segments are few and large), -1 costs nothing.
* All segments are indexed; what each signature costs is known once they are counted. A set then probes with the cheapest
  thresholds that suffice: signatures of its own cost nothing, so most sets need no probe, and a passage
  that many documents share is left aside. Sets with too few filled segments to reach the sum are compared
  with all of their bands by sketch, which hashing makes very rare.
* Pairs are pruned by a sketch of 512 parities (it never exceeds the true difference) and verified on the whole sets.

Groups of near copies aren't turned into all pairs: in ``ROUNDS`` rounds each probe is compared with one member of its
signatures' groups that is close by sketch and in another component, the first time with one member for each set, then with
one for each signature; after that all pairs between different components that are left are looked at, each where the
two sets first meet, so no link that joins two components is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vitrine.llm.components import components
from vitrine.llm.core import discard, small_batches, stored
from vitrine.llm.hashing import U, mix, shingles

WIDTH = 5  # words in a shingle
LARGEST_DELETED = 48  # bands up to this size index one-deletion neighbourhoods
ROUNDS = 3
FIRSTS = 16  # signatures that a set carries to tell where a pair meets; changes cost, not results
SKETCH = [f"k{i}" for i in range(8)]
MEMBER = "id bigint, n int, own boolean, band int, seg int, deleted boolean, g bigint, cost bigint, room int"


def band_edges(largest: int = 1 << 31) -> list[int]:
    """Largest size of each band."""
    edges = [4]
    while edges[-1] < largest:
        edges.append(-(-edges[-1] * 5 // 4))
    return edges


def segments_of(edge: int) -> int:
    """Segments of the band whose largest size is ``edge``: enough for its probes, and some to leave aside."""
    most = 2 * edge // 9 + 1  # the largest sum of (t + 1) that a probe needs
    if edge <= LARGEST_DELETED:
        return 1 if most <= 2 else -(-most // 2) + 1
    return -(-most * 6 // 5) + 4


def _signatures(sets, edges):
    """Per set (index, band, own, seg, deleted, signature): arrays, for the set's own band and the next one."""
    import numpy as np

    out = []
    for at, x in enumerate(sets):
        if not len(x):
            continue
        band = int(np.searchsorted(edges, len(x)))
        values = mix(x + U(0x51ED270B))
        for b, own in ((band, True), (band + 1, False)):
            if own and 2 * len(x) < 9:
                continue  # differs in less than one shingle from any partner: such sets are one class
            m = segments_of(edges[b])
            seg = (((x >> U(32)) * U(m)) >> U(32)).astype(np.int64)
            starts = np.flatnonzero(np.diff(seg, prepend=-1))
            sums = np.add.reduceat(values, starts)
            tag = U((b * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF)
            segs = seg[starts]
            out.append((at, b, own, segs, np.zeros(len(segs), bool), mix(sums + mix(segs.astype(np.uint64) + tag))))
            if edges[b] <= LARGEST_DELETED:
                count = np.diff(np.append(starts, len(x)))
                which = np.repeat(np.arange(len(starts)), count)
                some = np.repeat(count, count) > 1
                which, less = which[some], (sums[which] - values)[some]
                out.append((at, b, own, segs[which], np.ones(len(which), bool),
                            mix(less + mix(segs[which].astype(np.uint64) + tag))))
    return out


def set_table(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n, s1, s2, scarce, k0..k7): size, a 128-bit name and a sketch of each row's shingle set.

    ``scarce``: its filled segments can't reach the sum of (t + 1) it needs.
    """
    small_batches(docs.sparkSession)

    def named(batches):
        import numpy as np
        import pyarrow as pa

        edges = np.array(band_edges())
        for batch in batches:
            n, s1, s2, k, scarce = [], [], [], [], []
            for x in shingles(batch.column("text"), width):
                n.append(len(x))
                s1.append(int(np.add.reduce(mix(x + U(11)))) if len(x) else 0)
                s2.append(int(np.add.reduce(mix(x ^ U(0x5555555555555555)))) if len(x) else 0)
                bits = np.bincount((x & U(511)).astype(np.int64), minlength=512) & 1
                k.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
                edge = int(edges[np.searchsorted(edges, len(x))])
                held = np.bincount((((x >> U(32)) * U(segments_of(edge))) >> U(32)).astype(np.int64))
                room = np.count_nonzero(held) + (np.count_nonzero(held > 1) if edge <= LARGEST_DELETED else 0)
                scarce.append(2 * len(x) >= 9 and room < 2 * len(x) // 9 + 1)
            k = np.array(k, np.int64).reshape(-1, 8)
            wrapped = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int32()), wrapped(s1), wrapped(s2),
                 pa.array(scarce, pa.bool_()), *[pa.array(k[:, i]) for i in range(8)]], ["doc_id", "n", "s1", "s2", "scarce", *SKETCH])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        named, "doc_id bigint, n int, s1 bigint, s2 bigint, scarce boolean, " + ", ".join(f"{k} bigint" for k in SKETCH))


def packed_signatures(docs: DataFrame, buckets: int, width: int = WIDTH) -> DataFrame:
    """(bucket, ids, sizes, rooms, info, owner, sig): the signatures of a batch of texts that fall into one bucket.

    Sets are named by s1 here. Equal sets of one task are packed once.
    """
    small_batches(docs.sparkSession, 2048)

    def packed(batches):
        import numpy as np
        import pyarrow as pa

        edges = np.array(band_edges())
        met: set[int] = set()
        for batch in batches:
            sets, ids, sizes = [], [], []
            for x in shingles(batch.column("text"), width):
                name = int(np.add.reduce(mix(x + U(11)))) if len(x) else 0
                if not len(x) or name in met:
                    continue
                if len(met) > 200_000:
                    met.clear()
                met.add(name)
                sets.append(x)
                ids.append(name)
                sizes.append(len(x))
            found = _signatures(sets, edges)
            if not found:
                continue
            lens = [len(f[5]) for f in found]
            owner = np.repeat(np.array([f[0] for f in found], np.uint16), lens)
            info = np.concatenate([
                (f[2] * 128 + f[4] * 64 + np.minimum(f[3], 63) * (edges[f[1]] <= LARGEST_DELETED)).astype(np.uint8) for f in found])
            sig = np.concatenate([f[5] for f in found])
            room = np.zeros(len(sets), np.int32)  # how high the sum of (t + 1) can get in the own band
            for at, b, own, segs, deleted, _ in found:
                if own:
                    room[at] += len(np.unique(segs))
            where = (sig % U(buckets)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            where = where[order]
            cuts = np.flatnonzero(np.diff(where, prepend=-1))
            ends = np.append(cuts[1:], len(where))
            ids_np, sizes_np = np.array(ids, np.uint64), np.array(sizes, np.int32)
            rows = []
            for a, b in zip(cuts, ends):
                o = order[a:b]
                mine, back = np.unique(owner[o], return_inverse=True)
                rows.append((int(where[a]), ids_np[mine].tobytes(), sizes_np[mine].tobytes(), room[mine].tobytes(),
                             info[o].tobytes(), back.astype(np.uint16).tobytes(), (sig[o] // U(buckets)).tobytes()))
            names = ["bucket", "ids", "sizes", "rooms", "info", "owner", "sig"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))], names)

    return docs.select("text").mapInArrow(
        packed, "bucket int, ids binary, sizes binary, rooms binary, info binary, owner binary, sig binary")


def shared_signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, n, own, band, seg, deleted, g, cost, room): signatures that some other set can match.

    ``g`` names the signature; ``cost``: how many other sets have it. ``room``: see ``packed_signatures``.
    """
    buckets = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def matched(batches):
        import numpy as np
        import pyarrow as pa

        edges = np.array(band_edges())
        bucket, ids, sizes, rooms, info, owner, sig, base = [], [], [], [], [], [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["ids"], np.uint64)
                ids.append(own)
                sizes.append(np.frombuffer(row["sizes"], np.int32))
                rooms.append(np.frombuffer(row["rooms"], np.int32))
                info.append(np.frombuffer(row["info"], np.uint8))
                owner.append(np.frombuffer(row["owner"], np.uint16).astype(np.int32) + base)
                sig.append(np.frombuffer(row["sig"], np.uint64) * U(buckets) + U(row["bucket"]))
                base += len(own)
        if not sig:
            return
        ids, sizes, rooms, info, owner, sig = map(np.concatenate, (ids, sizes, rooms, info, owner, sig))
        # Only signatures that occur twice are worth sorting by set.
        order = np.argsort(sig, kind="stable")
        s = sig[order]
        same = np.zeros(len(s), bool)
        same[1:] = s[1:] == s[:-1]
        same[:-1] |= same[1:]
        order = order[same]
        order = order[np.lexsort((info[order], ids[owner[order]], sig[order]))]
        s, who, what = sig[order], ids[owner[order]], info[order]
        first = np.ones(len(s), bool)  # a set that several tasks packed counts once
        first[1:] = (s[1:] != s[:-1]) | (who[1:] != who[:-1]) | (what[1:] != what[:-1])
        order, s, who, what = order[first], s[first], who[first], what[first]
        if not len(s):
            return
        group = np.cumsum(np.append(0, s[1:] != s[:-1]))
        deleted = (what & 64) > 0
        exact = np.bincount(group, ~deleted).astype(np.int64)[group]
        gone = np.bincount(group, deleted).astype(np.int64)[group]
        useful = np.where(deleted, exact > 0, exact + gone > 1)
        o = order[useful]
        n, own = sizes[owner[o]], (what[useful] & 128) > 0
        band = np.searchsorted(edges, n) + ~own
        # Equal signatures are threshold 0; what only a deletion finds is threshold 1, cost of the deleted side.
        cost = np.where(deleted, exact, (exact - 1) + (gone << 32))[useful]
        for a in range(0, len(o), 50_000):
            z = slice(a, a + 50_000)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[owner[o[z]]].view(np.int64)), pa.array(n[z]), pa.array(own[z]), pa.array(band[z].astype(np.int32)),
                pa.array((what[useful][z] & 63).astype(np.int32)), pa.array(deleted[useful][z]), pa.array(s[useful][z].view(np.int64)),
                pa.array(cost[z]), pa.array(rooms[owner[o[z]]])],
                ["id", "n", "own", "band", "seg", "deleted", "g", "cost", "room"])

    return packed_signatures(docs, buckets, width).repartitionById(buckets, F.col("bucket")).mapInArrow(matched, MEMBER)


def chosen_probes(shared: DataFrame) -> DataFrame:
    """(id, n, g, deleted, deep): the signatures each set probes with; ``deep``: it also asks for deletions of others.

    Of the sum of (t + 1) that a set of n needs, 2 n // 9 + 1, segments without any other holder give their part for
    nothing; the rest is taken from the cheapest thresholds.
    """
    own = shared.where("own").select("id", "n", "seg", "deleted", "g", "cost", "room")
    large = own.where(F.col("n") > F.lit(_last_deleted()))
    # Large sets: thresholds -1 and 0; one row per segment that others share.
    w = Window.partitionBy("id")
    need = F.floor(F.col("n") * 2 / 9) + 1 - (F.col("room") - F.count(F.lit(1)).over(w))
    large = large.withColumn("need", need).withColumn(
        "rank", F.row_number().over(w.orderBy("cost", "g"))).where("rank <= need")
    large = large.select("id", "n", "g", F.lit(False).alias("deleted"), F.lit(False).alias("deep"))

    # Small sets: -1, 0 and 1; the segments' costs are gathered per set, at most LARGEST_DELETED rows each.
    small = own.where(F.col("n") <= F.lit(_last_deleted()))
    equal = F.sum(F.when(~F.col("deleted"), F.expr("cost & 4294967295L")))
    other = F.sum(F.when(F.col("deleted"), F.col("cost")).otherwise(F.shiftright("cost", 32)))
    segs = small.groupBy("id", "n", "room", "seg").agg(F.coalesce(equal, F.lit(0)).alias("c0"), F.coalesce(other, F.lit(0)).alias("c1"))
    # Two units per shared segment: reaching 0 costs c0, going on to 1 costs c1 and never comes before.
    units = segs.select("id", "n", "room", "seg", F.explode(F.array(
        F.struct(F.lit(0).alias("t"), F.col("c0").alias("c")),
        F.struct(F.lit(1).alias("t"), F.greatest("c0", "c1").alias("c")))).alias("u")).select("id", "n", "room", "seg", "u.t", "u.c")
    units = units.withColumn("rank", F.row_number().over(w.orderBy("c", "seg", "t")))
    # ``room`` counts both units of segments with two shingles or more, one of others; unshared units are free.
    units = units.withColumn("need", F.floor(F.col("n") * 2 / 9) + 1 - (F.col("room") - F.count(F.lit(1)).over(w)))
    picked = units.where("rank <= need").groupBy("id", "seg").agg(F.max("t").alias("t"))
    small = small.join(picked, ["id", "seg"]).where((F.col("t") == 1) | ~F.col("deleted"))
    small = small.select("id", "n", "g", "deleted", (F.col("t") == 1).alias("deep"))
    return large.union(small)


def _last_deleted() -> int:
    return max(e for e in band_edges(10_000) if e <= LARGEST_DELETED)


def _sizes_fit(a: str, b: str):
    """The sizes allow the similarity."""
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def shingle_sets(docs: DataFrame, ids: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, x): the packed sorted shingle hashes of the wanted sets (id, doc_id), one row per set."""
    small_batches(docs.sparkSession)

    def hashed(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            names, rows = [], []
            for x in shingles(batch.column("text"), width):
                names.append(int(np.add.reduce(mix(x + U(11)))) if len(x) else 0)
                rows.append(x.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(names, np.uint64).view(np.int64)), batch.column("id"), pa.array(rows, pa.binary())],
                ["name", "id", "x"])

    wanted = ids.select(F.col("id"), F.col("doc_id").alias("d"))
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        wanted.hint("shuffle_hash"), F.col("doc_id") == F.col("d")).select("id", "text")
    # Rows of one doc_id may differ: only the text that made the set counts.
    return text.mapInArrow(hashed, "name bigint, id bigint, x binary").where("name = id").groupBy("id").agg(F.first("x").alias("x"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` with 5 |both| >= 4 |either|, counted on the whole sets."""
    def counted(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                both = int(np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x))
                keep.append(5 * both >= 4 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep)], ["a", "b", "linked"])

    both = pairs.join(sets.select(F.col("id").alias("a"), "x"), "a").join(sets.select(F.col("id").alias("b"), F.col("x").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(counted, "a bigint, b bigint, linked boolean").where("linked").select("a", "b")


def _close(n: str, m: str):
    """The sketches of two rows, k0.. and q0.., are no further apart than the sizes allow."""
    apart = F.lit(0)
    for i, k in enumerate(SKETCH):
        apart = apart + F.bit_count(F.col(k).bitwiseXOR(F.col(f"q{i}")))
    return 9 * apart <= F.col(n) + F.col(m)


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _first_names(rows: DataFrame, of: str, name: str) -> DataFrame:
    """(of, name): the ``FIRSTS`` smallest signatures of each set in ``rows``."""
    w = Window.partitionBy(of).orderBy("g")
    first = rows.select(of, "g").distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= FIRSTS)
    return first.groupBy(of).agg(F.collect_list("g").alias(name))


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the component of their id under the links so far, stored."""
    label = components(links)
    named = rows.join(label.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = stored(named, "named-signatures")
    discard(label)
    return named


def class_links(docs: DataFrame, sets: DataFrame, classes: DataFrame, width: int = WIDTH) -> DataFrame:
    """(a, b): doc_ids of linked classes, enough links to connect whatever is connected.

    ``sets``: see ``set_table``; ``classes``: (s1, s2, doc_id) with the smallest doc_id of each set.
    """
    members = stored(shared_signatures(docs, width), "shared-signatures")
    probes = stored(chosen_probes(members), "probes")
    asked = stored(probes.select("g").distinct(), "asked")
    sketches = sets.select(F.col("s1").alias("id"), *SKETCH).dropDuplicates(["id"])
    around = stored(members.join(asked, "g").select("g", "id", "n", "deleted").join(sketches, "id"), "asked-signatures")
    short = sets.where("scarce").dropDuplicates(["s1"])

    # The sets that lack filled segments meet all sets of their band and the one below.
    edges = band_edges()
    band = F.array_position(F.array(*[F.lit(e) for e in edges]), F.array_min(
        F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e >= F.col("n"))))
    banded = sets.where("n > 0").dropDuplicates(["s1"]).select(F.col("s1").alias("id"), "n", *SKETCH).withColumn("band", band)
    rare = short.select(F.col("s1").alias("r"), F.col("n").alias("m"), *[F.col(k).alias(f"q{i}") for i, k in enumerate(SKETCH)])
    rare = rare.withColumn("band", F.array_position(F.array(*[F.lit(e) for e in edges]), F.array_min(
        F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e >= F.col("m")))))
    rare = rare.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    rare = rare.join(banded, "band").where((F.col("id") != F.col("r")) & _sizes_fit("n", "m") & _close("n", "m"))
    rare = rare.select(*_ordered("id", "r")).distinct()
    rare = stored(rare, "rare-pairs")

    involved = around.select("id").union(rare.select("a")).union(rare.select("b")).distinct().join(
        classes.select(F.col("s1").alias("id"), "doc_id"), "id")
    whole = stored(shingle_sets(docs, involved, width), "shingle-sets")

    links = stored(verified(rare, whole), "rare-links")
    # Joins on a signature read stored tables on both sides, so that Spark can split one that very many sets share.
    asked_by = stored(probes.select("g", "id").distinct(), "asked-by")
    for turn in range(ROUNDS):
        named = _labelled(around, links)
        # First one member for all who share a signature, the same for signatures that go together. Then one of each signature's
        # own, so that a set meets about as many different members as it has probes.
        drawn = F.xxhash64("id", F.lit(turn)) if turn == 0 else F.xxhash64("id", "g", F.lit(turn))
        centre = named.where("NOT deleted").groupBy("g").agg(F.min(F.struct(
            drawn.alias("h"), F.col("id").alias("r"), F.col("n").alias("m"), F.col("component").alias("other"),
            *[F.col(k).alias(f"q{i}") for i, k in enumerate(SKETCH)])).alias("c")).select("g", "c.*")
        centre = stored(centre, "centres")
        asking = named.join(asked_by, ["g", "id"])
        near = asking.join(centre, "g").where((F.col("component") != F.col("other")) & _sizes_fit("n", "m") & _close("n", "m"))
        if turn == 0:
            near = near.groupBy("id").agg(F.min(F.struct("h", "r"))["r"].alias("r"))
        near = near.select(*_ordered("id", "r")).distinct()
        links = links.union(stored(verified(near, whole), "round-links"))
        discard(named, centre)

    # Then whatever joins two components.
    named = _labelled(around, links)
    counts = named.groupBy("g", "component").agg(F.count(F.lit(1)).alias("c"))
    mixed = counts.groupBy("g").agg(
        F.count(F.lit(1)).alias("components"), F.max_by("component", F.struct("c", "component")).alias("major")).where("components > 1")
    mixed = stored(mixed.select("g", "major"), "mixed-signatures")
    there = stored(named.join(mixed, "g"), "mixed-members")
    probing = there.join(probes.select("g", "id", "deep"), ["g", "id"]).select(
        "g", "major", F.col("id").alias("r"), F.col("n").alias("m"), F.col("deleted").alias("gone"), "deep",
        F.col("component").alias("own"), *[F.col(k).alias(f"q{i}") for i, k in enumerate(SKETCH)])
    probing = stored(probing, "mixed-probes")
    mixed_members = there
    # Two sets that share many signatures meet at the first that stands among the first few of both; a row that is no
    # deletion meets every probe, so the pair is surely looked at there. Without such a one they meet at each they share.
    there = stored(there.join(_first_names(there.where("NOT deleted"), "id", "firsts"), "id", "left"), "mixed-members")
    probing = stored(probing.join(_first_names(probing, "r", "asks"), "r"), "mixed-probes")

    def crossing(left: DataFrame, right: DataFrame) -> DataFrame:
        smaller = (F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("id") < F.col("r")))
        met = F.when(F.col("gone"), ~F.col("deleted")).otherwise(F.col("deep") | ~F.col("deleted"))
        here = F.coalesce(F.array_min(F.array_intersect("asks", "firsts")), F.col("g")) == F.col("g")
        return left.join(right, "g").where(
            (F.col("component") != F.col("own")) & smaller & met & _sizes_fit("n", "m") & _close("n", "m") & here
        ).select(*_ordered("id", "r"))

    across = crossing(probing.where("own <> major"), there.drop("major")).union(
        crossing(probing.where("own = major"), there.where("component <> major").drop("major"))).distinct()
    links = links.union(stored(verified(across, whole), "later-links"))
    discard(members, probes, asked, asked_by, around, rare, whole, named, mixed, mixed_members, there, probing)
    to_doc = classes.select(F.col("s1").alias("s"), "doc_id")
    return links.join(to_doc, F.col("a") == F.col("s")).select(F.col("doc_id").alias("a"), "b").join(
        to_doc, F.col("b") == F.col("s")).select("a", F.col("doc_id").alias("b"))


def near_copies(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Rows whose sets are linked, or linked through others, share a component, named by the smallest doc_id in it.
    Null, empty and blank texts have no shingles and are linked with nothing; texts of fewer than ``width`` words are one
    shingle. Repeated rows are linked like any others. A null doc_id names no component: its rows are compared with
    nothing, and their component_id is null. An empty table gives an empty one.
    """
    sets = stored(set_table(docs, width), "shingle-names")
    classes = stored(sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id")), "classes")
    known = sets.where("doc_id IS NOT NULL")
    label = components(class_links(docs.where("doc_id IS NOT NULL"), known, classes, width))
    named = stored(classes.join(label, F.col("doc_id") == F.col("node"), "left").select(
        "s1", "s2", F.coalesce("component", "doc_id").alias("component_id")), "class-components")
    discard(label, classes)
    own = sets.select("doc_id", "n", "s1", "s2").where("n > 0 AND doc_id IS NOT NULL").join(named, ["s1", "s2"])
    rest = sets.where("n = 0 OR doc_id IS NULL")
    return own.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id").union(
        rest.select("doc_id", F.col("n").cast("bigint"), "doc_id"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s AS a JOIN s AS b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM p JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(c, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) AS r ON r.a = w.doc_id
"""
