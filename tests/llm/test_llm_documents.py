"""Operators over documents against plain Python, on awkward rows with clashing columns, and on empty tables."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from vitrine.llm import decontam, jaccard_join, kneser_ney, line_dedup, quality, suffix_dedup  # noqa: E402
from vitrine.llm.queries import model_file  # noqa: E402

ROWS = brute.documents()


def framed(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(partitions)
    return df.select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(None).cast("bigint").alias("n_chars"),
                     *[F.lit(7).alias(c) for c in brute.CLASHES])


@pytest.fixture(scope="module")
def docs(spark):
    return framed(spark, ROWS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(d, int(d % 3 > 0), int(d % 7 == 0)) for d, _ in ROWS if d % 2] + [(None, 1, 0), (3, None, None)],
        "doc_id bigint, quality int, toxic int")


def sorted_rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_line_dedup(docs):
    got = sorted_rows(line_dedup.line_dedup_digest(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    want = sorted(x[:4] for x in brute.line_dedup(ROWS))
    assert got == want and sum(x[2] for x in got) > 10
    kept = line_dedup.with_kept_lines(docs)
    assert sorted_rows(kept, "doc_id", "kept_text") == sorted((x[0], x[4]) for x in brute.line_dedup(ROWS))
    assert set(docs.columns) < set(kept.columns)


def test_line_bitmaps_hold_only_words_with_dropped_lines(spark):
    rows = [(i, "\n".join(["short"] * 70 + ["y" * 50])) for i in range(6)]
    maps = line_dedup.keep_bitmaps(framed(spark, rows)).collect()
    assert sorted(r.doc_id for r in maps) == [0, 1, 2, 3, 4]
    assert {tuple(map(tuple, r.words)) for r in maps} == {((1, 1 << 6),)}


def test_null_document_ids(spark):
    rows = [(None, "z" * 60), (None, "z" * 60), (1, "z" * 60), (2, "z" * 60), (3, "z" * 60)]
    got = {(r.doc_id, r.n_dropped) for r in line_dedup.line_dedup_digest(framed(spark, rows)).collect()}
    assert got == {(None, 1), (1, 1), (2, 1), (3, 0)}
    near = jaccard_join.near_copies(framed(spark, [(None, "a b c d e f"), (4, "a b c d e f"), (9, "a b c d e f")])).collect()
    assert {tuple(r) for r in near} == {(None, 2, None), (4, 2, 4), (9, 2, 4)}


def test_hits_beside_columns_of_any_name(spark):
    clashes = ["n_hit", "items", "own", "own_d", "own_r", "hit_d", "hit_r", "hit_n", "hit_i", "row", "a.b", "w"]
    item = "one two three four five six seven eight nine ten"
    rows = [(1, f"x {item} y"), (None, item), (None, "clean"), (2, None), (1, f"x {item} y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", *[F.lit(7).alias(c) for c in clashes])
    bench = spark.createDataFrame([(4, item)], "item_id bigint, text string")
    got = decontam.with_hits(docs, bench, [F.col(f"`{c}`") for c in docs.columns])
    assert got.columns == ["doc_id", "text", *clashes[2:], "n_hit", "items"]
    assert sorted((r.n_hit, r.hit_n, r["a.b"], r.items) for r in got.collect() if r.n_hit) == [(10, 7, 7, ["4"])] * 3
    assert got.count() == 5
    none = decontam.with_hits(docs, bench.where("false"), ["doc_id", "text"])
    assert [r.n_hit for r in none.collect()] == [0] * 5


@pytest.mark.parametrize("width", [5])
def test_near_copies(docs, width):
    got = sorted_rows(jaccard_join.near_copies(docs, width), "doc_id", "n_shingles", "component_id")
    want = sorted(brute.near_copies(ROWS))
    assert got == want and sum(a != c for a, _, c in got) > 10


@pytest.mark.parametrize("rounds, firsts", [(0, 1), (0, 16), (1, 2)])
def test_near_copies_left_to_the_last_join(spark, monkeypatch, rounds, firsts):
    """Variants of one text, some linked and some just not, that share many signatures."""
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "FIRSTS", firsts)
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rnd.sample(range(150), rnd.randint(1, 7)):
            words[k] = f"v{i}x{k}"
        rows.append((i, " ".join(words)))
    got = sorted_rows(jaccard_join.near_copies(framed(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.near_copies(rows))
    assert 1 < len({c for _, _, c in got}) < 60


def test_near_copies_around_the_threshold(spark):
    """Chains of edits of sets of all small sizes, so every band, deletion and threshold is met."""
    rnd, rows = random.Random(11), []
    for n in [*range(5, 40), 50, 61, 80, 120, 200, 333]:
        base = [f"w{n}x{i}" for i in range(n)]
        for _ in range(6):
            cut = list(base)
            for _ in range(rnd.randint(0, max(1, n // 30 + 1))):
                at = rnd.randrange(len(cut))
                cut[at:at + rnd.randint(0, 2)] = [f"v{rnd.random()}"] * rnd.randint(0, 2)
            rows.append((len(rows), " ".join(cut)))
    rnd.shuffle(rows)
    got = sorted_rows(jaccard_join.near_copies(framed(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.near_copies(rows))


def test_sets_with_few_filled_segments_meet_their_whole_band(docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "set_table", lambda d, w=5, f=jaccard_join.set_table: f(d, w).withColumn("scarce", F.col("n") > 4))
    monkeypatch.setattr(jaccard_join, "chosen_probes", lambda s, f=jaccard_join.chosen_probes: f(s).where("false"))
    got = sorted_rows(jaccard_join.near_copies(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.near_copies(ROWS))


@pytest.fixture(scope="module")
def items(spark):
    rnd = random.Random(4)
    long = [t for _, t in ROWS if t and len(t.split()) > 30]
    rows = [(i, " ".join(rnd.choice(long).split()[4:4 + rnd.choice([9, 10, 12, 25])])) for i in range(12)]
    rows += [(20, "One"), (21, ""), (22, None), (23, "?!"), (24, "one two"), (3, "never met in any of these documents at all ever"),
             (25, rows[0][1].upper() + "!"), (25, "a b c d e"), (26, "no two three")]
    return rows


def test_decontamination(spark, docs, items):
    table = spark.createDataFrame(items, "item_id bigint, text string").withColumn("w", F.lit(1))
    got = sorted_rows(decontam.decontam_digest(docs, table),
                      "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = sorted(brute.decontamination(ROWS, items))
    assert got == want and {x[3] for x in got} >= {0, 1, 2}
    none = decontam.decontam_digest(docs, table.where("false"))
    assert none.where("contaminated OR n_hit > 0 OR n_items > 0").count() == 0 and none.count() == len(ROWS)


@pytest.mark.parametrize("wide", [1, 4, 500])
def test_suffix_dedup(spark, docs, wide, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "WIDE", wide)
    rnd = random.Random(6)
    base = ["".join(rnd.choice("ab \né") for _ in range(1800)) for _ in range(3)]
    rows = list(ROWS) + [(500 + i, "".join(
        rnd.choice(base)[a:a + rnd.randint(0, 800)] + rnd.choice(["", "x", "=" * 700, "abc" * 200])
        for a in [rnd.randint(0, 1300) for _ in range(rnd.randint(1, 4))])) for i in range(30)]
    rows += [(900, "y" * 399), (901, "z" * 400), (902, "w" * 401), (None, base[0])]
    got = suffix_dedup.suffix_dedup_digest(framed(spark, rows)).collect()
    key = lambda x: (x[0] is None, *[v or 0 for v in x[:1]], *x[1:])
    assert sorted(map(tuple, got), key=key) == sorted(brute.repeats(rows), key=key)


def test_suffix_dedup_in_slices(spark, monkeypatch):
    """A text longer than a slice repeats itself over the cut."""
    rnd = random.Random(8)
    part = "".join(rnd.choice("abcdefgh ") for _ in range(6000))
    monkeypatch.setattr(suffix_dedup, "SLICE", 5000)
    rows = [(1, part + "-" + part[:3000]), (2, part[2500:5500])]
    got = sorted(map(tuple, suffix_dedup.suffix_dedup_digest(framed(spark, rows)).collect()))
    assert got == sorted(brute.repeats(rows))


def test_maximal_repeats():
    """Groups with all their members: the whole of three, and more of two of them."""
    left, mid = "pqrstuvw", "0123456789"
    texts = [("A" + left, mid + "xyz!"), ("B" + left, mid + "xyz?"), ("CC" + left[1:], mid + "x1")]
    groups = {(a, b, tuple(sorted(m))) for a, b, m in suffix_dedup.maximal_repeats(
        [x[::-1].encode() for x, _ in texts], [y.encode() for _, y in texts], 12)}
    assert groups == {(8, 13, (0, 1)), (7, 11, (0, 1, 2))}
    assert list(suffix_dedup.intervals([2, 3, 1])) == [(3, 1, 2), (2, 0, 2), (1, 0, 3)]


def test_quality(docs, labels):
    got = quality.judged(docs, labels).collect()
    base = {d: brute.quality_base(t) for d, t in ROWS}
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base[r.doc_id]
        assert not (r.base_failed and r.kept)
    assert sum(r.kept for r in got) > 20


def test_quality_tells_junk_from_text(spark):
    rnd = random.Random(2)
    good, bad = [f"g{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(rnd.choice(bad if i % 4 == 0 else good) for _ in range(60))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 200)], "doc_id bigint, quality int, toxic int")
    got = quality.judged(framed(spark, rows), labels)
    assert {(r.doc_id, r.kept) for r in got.collect()} == {(i, i % 4 > 0) for i in range(400)}
    assert sorted(r.doc_id for r in quality.kept_rows(framed(spark, rows), labels).collect()) == [i for i in range(400) if i % 4]
    # Without labels only the base rule rejects.
    assert quality.judged(framed(spark, rows), labels.where("false")).where("NOT kept").count() == 0


def test_quality_scores_trusted_documents_as_if_outside_the_fit(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(f"w{rnd.randrange(40)}" for _ in range(30))) for i in range(24)]
    labels = [(i, 1, 0) for i in range(12)]
    docs, schema = quality.described(framed(spark, rows), ["doc_id"]), "doc_id bigint, quality int, toxic int"

    def fit(some):
        labelled = quality.labelled_grams(docs, spark.createDataFrame(some, schema))
        return labelled, *quality._arrays(quality.bucket_weights(docs, labelled))

    got = [r.s for r in quality.outside_scores(*fit(labels)).where("good").collect()]
    want = []
    for i in (0, 7):
        _, weights, _, _ = fit(labels[:i] + labels[i + 1:])
        want += [r.score for r in quality.verdicts(docs.where(F.col("own.doc_id") == i), weights, 0.0).collect()]
    assert len(got) == 12
    for x in want:
        assert min(abs(x - y) for y in got) < 1e-7


def test_quality_fit_takes_every_labelled_row(spark):
    """Negative and far ids, two labels for one document, repeated and null ids, and more labels than 10,000."""
    ids = [-(1 << 63), -65, -64, -1, 0, 63, 64, 1 << 40, (1 << 63) - 1, 5, 5, None] + list(range(1000, 12000))
    docs = spark.createDataFrame([(i, "a b a") for i in ids], "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), 0) for i in ids if i is not None and i != 64] + [(0, 1, 0), (None, 1, 0), (64, 1, 1), (77, 1, 0)],
        "doc_id bigint, quality int, toxic int")
    got = quality.labelled_grams(quality.described(docs, ["doc_id"]), labels).groupBy("good", "bad").count().collect()
    named = [i for i in ids if i is not None and i != 64]
    want = {(True, False): sum(i % 3 > 0 for i in named), (False, True): sum(i % 3 == 0 and i != 0 for i in named), (True, True): 1}
    assert {(r.good, r.bad): r["count"] for r in got} == want


def test_quality_keeps_documents_of_a_rare_language_outside_the_fit(spark):
    """Rare documents have words of their own, and one in two has a label, as all common ones have; junk is spread over all scores beneath."""
    rnd = random.Random(5)

    def text(share, rare, common):
        return " ".join(rare() if rnd.random() < share else common() for _ in range(40))

    rows = [(i, text(0, None, lambda: f"c{rnd.randrange(50)}")) for i in range(300)]
    rows += [(i, text(0.8, lambda: f"r{rnd.randrange(4000)}", lambda: f"r{rnd.randrange(20)}")) for i in range(300, 400)]
    rows += [(i, text(i % 100 / 100, lambda: f"j{rnd.randrange(50)}", lambda: f"c{rnd.randrange(50)}")) for i in range(400, 600)]
    labels = spark.createDataFrame(
        [(i, int(i < 400), 0) for i in range(600) if i < 300 or i % 2 == 0], "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id for r in quality.judged(framed(spark, rows), labels).where("kept").collect()}
    assert sum(i not in kept for i in range(301, 400, 2)) <= 3
    assert sum(i not in kept for i in range(400, 600)) > 50


def test_quality_threshold_is_an_exact_percentile(spark):
    rnd = random.Random(6)
    values = [rnd.randrange(-3 * 10**9, 3 * 10**9) for _ in range(3000)] + [-3 * 10**9] * 3
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint")
    for share in (0.0, 0.0005, 0.01, 0.5, 1.0):
        assert quality.value_at(df, share) == sorted(values)[int(share * (len(values) - 1))]
    assert quality.value_at(df.where("false"), 0.5) is None


def test_kneser_ney(docs):
    got = sorted(map(tuple, kneser_ney.held_out_scores(docs).collect()))
    want = sorted(brute.kneser_ney(ROWS, kneser_ney.discounts))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_kneser_ney_with_frequent_pairs(spark):
    """Counts over 255 and contexts that are split over shards."""
    rows = [(i, "the cat " * 90 + ("dog" if i % 3 else "cow")) for i in range(12)]
    got = sorted(map(tuple, kneser_ney.held_out_scores(framed(spark, rows)).collect()))
    for g, w in zip(got, sorted(brute.kneser_ney(rows, kneser_ney.discounts))):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_empty_tables(spark, docs, labels, items):
    none = docs.where("false")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for out in (line_dedup.line_dedup_digest(none), jaccard_join.near_copies(none), decontam.decontam_digest(none, bench),
                suffix_dedup.suffix_dedup_digest(none), quality.judged(none, labels), kneser_ney.held_out_scores(none)):
        assert out.count() == 0


def test_pipeline(spark, docs, labels, items, tmp_path):
    """Stage by stage against plain Python; verdicts and identifiers come from the operators' own tests."""
    import sentencepiece

    clashes = ["n_hit", "own_d", "own_r", "hit_d", "hit_n", "hit_i", "hit_r", "kept_text", "n_dropped", "carried", "a.b"]
    docs = docs.select("*", *[F.lit(7).alias(c) for c in clashes])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {r.doc_id for r in quality.judged(docs, labels).where("kept").collect()}
    rows = [r for r in ROWS if r[0] in kept]
    rows = [(x[0], x[4]) for x in brute.line_dedup(rows)]
    low = {(d, t): c for (d, t), (_, _, c) in zip(rows, brute.near_copies(rows))}
    rows = sorted({(d, t) for d, t in rows if low[d, t] == d})
    hit = {x[0] for x in brute.decontamination(rows, items) if x[5]}
    rows = [r for r in rows if r[0] not in hit]
    got = sorted(corpus_pipeline.run(spark, str(tmp_path)).collect())
    sp = sentencepiece.SentencePieceProcessor(model_proto=model_file())
    assert [(r.doc_id, r.ids) for r in got] == [(d, sp.encode(t)) for d, t in rows] and len(got) > 10
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)


def test_pipeline_stages_keep_columns_and_empty_tables(spark, docs, labels, items, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, str(tmp_path))
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
            assert {r.own for r in out.select("own").collect()} <= {r.own for r in rows.select("own").collect()}
    docs.where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_components_of_chains_stars_and_random_links(spark):
    from vitrine.llm.components import components

    rnd = random.Random(9)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(5, 5), (7, 3), (3, 7)]
    links += [(rnd.randint(300, 500), rnd.randint(300, 500)) for _ in range(110)]
    rnd.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint").repartition(3)).collect()}
    low = {n: n for pair in links for n in pair if pair[0] != pair[1]}
    for _ in range(len(low)):
        for a, b in links:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    assert got == low
    assert components(spark.createDataFrame([(1, 1)], "a bigint, b bigint")).count() == 0
