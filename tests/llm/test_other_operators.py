"""Classifiers, near duplicates, nearest neighbours, revisits and the pipeline on small tables."""

import gc
import random
import weakref
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from matchflow.llm import ann_forest, common, components, pu_quality, revisits, simhash_bk, toxicity

WORDS = "the of and stone river lamp quiet garden window paper winter road seven cloud music table".split()


def prose(rnd, n=60):
    return " ".join(rnd.choice(WORDS) for _ in range(n)).capitalize() + "."


def docs(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, 0, False, "c") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, score int, held_out boolean, component_id string")


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


# --- classifiers ------------------------------------------------------------------------------


def test_risk_is_never_negative():
    x = np.eye(3)
    as_bad = pu_quality.non_negative_gradient(x, x[:1], 0.9)(np.array([-5.0, 5.0, 5.0]), 0.0)[0]
    assert as_bad[1] > 0  # the risk of the bad is below zero here, so the step undoes it


def test_quality_finds_junk_held_out(spark):
    rnd = random.Random(1)
    junk = lambda: " ".join(w.upper() + rnd.choice(["!!", "###", "$$$"]) for w in prose(rnd).split())
    bad = [i % 5 == 0 for i in range(300)]
    table = docs(spark, [junk() if b else prose(rnd) for b in bad])
    labels = labelled(spark, [(i, int(not b), 0) for i, b in enumerate(bad)] + [(None, 1, 0), (3, None, 0)])
    model = pu_quality.fit(table, labels)
    got = pu_quality.score(table, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == int(not bad[r.doc_id]) for r in got if r.held_out]) > 0.95
    odd = docs(spark, [None, "", "x" * 50_000, "a"], [1, 1, None, 2])
    assert sorted((r.doc_id is None, 0 <= r.score <= 1) for r in pu_quality.score(odd, model).collect()) == [(False, True)] * 3 + [(True, True)]
    kept = pu_quality.keep_good(table, model)
    assert kept.columns == table.columns and kept.where("doc_id % 5 = 0").count() < 6 and kept.count() > 230


@pytest.mark.parametrize("module", [pu_quality, toxicity])
def test_classifiers_without_labels_or_documents(spark, module):
    table, none = docs(spark, ["a b", None]), labelled(spark, [])
    assert {r.score for r in module.score(table, module.fit(table, none)).collect()} == {0.5}
    one = labelled(spark, [(0, 1, 1), (1, 1, 1)])
    assert module.score(docs(spark, []), module.fit(docs(spark, []), one)).count() == 0
    assert all(r.score > 0.5 for r in module.score(table, module.fit(docs(spark, ["a b", "c"], [0, 1]), one)).collect())


def test_toxicity_held_out(spark):
    rnd = random.Random(2)
    bad = [i % 4 == 0 for i in range(400)]
    texts = [prose(rnd) + (" You " + rnd.choice(["worthless", "stupid"]) + " moron " if b else " ") + prose(rnd) for b in bad]
    table = docs(spark, texts)
    model = toxicity.fit(table, labelled(spark, [(i, 1, int(b)) for i, b in enumerate(bad)] + [(None, 1, 1), (5, 1, None)]))
    got = toxicity.score(table, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.predicted == int(bad[r.doc_id]) for r in got if r.held_out]) > 0.95


def test_one_id_in_a_third_of_all_rows(spark):
    rnd = random.Random(4)
    bad = [i % 4 == 0 for i in range(120)]
    texts = [prose(rnd) + (" You worthless moron " if b else " ") + prose(rnd) for b in bad]
    table = docs(spark, texts + [f"{texts[8]} {i}" for i in range(60)], [*range(120), *[8] * 60])
    known = labelled(spark, [(i, 1 - int(b), int(b)) for i, b in enumerate(bad)])
    assert len(pu_quality._vectors(table)) == 120
    for module, column in ((pu_quality, "quality"), (toxicity, "toxic")):
        got = module.score(table, module.fit(table, known)).collect()
        assert len(got) == 180
        assert np.mean([r.predicted == int(bad[r.doc_id] == (column == "toxic")) for r in got]) > 0.7


def test_grams_of_pieces_are_those_of_the_whole(monkeypatch):
    text = prose(random.Random(3), 500)
    whole = sorted(toxicity.grams(text).tolist())
    monkeypatch.setattr(toxicity, "PIECE", 100)
    assert sorted(toxicity.grams(text).tolist()) == whole == sorted(set(whole))


# --- near duplicates -----------------------------------------------------------------------------


def test_fingerprint_by_definition():
    text = "The quick\tBROWN fox\u00a0x  jumps"
    words = text.replace("The", "the").replace("BROWN", "brown").split(" ")
    words = [w for part in words for w in part.split("\t") if w]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(len(words) - 2)]
    bits = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert simhash_bk.fingerprint(text) == bits
    assert simhash_bk.fingerprint(" \n") == 0 and simhash_bk.fingerprint("A b") == xxhash.xxh64_intdigest(b"a b", 42)


@pytest.mark.parametrize("radius, blocks, shard", [(3, 4, 4096), (3, 4, 5), (3, 8, 50), (6, 8, 4096)])
def test_links_connect_what_is_near(spark, radius, blocks, shard):
    rnd = random.Random(4)
    values = {rnd.getrandbits(64) for _ in range(60)}
    for v in list(values):  # chains and a dense cluster around each value
        for _ in range(4):
            v ^= sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, radius + 1)))
            values.add(v)
    values = sorted(values)
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "bits bigint")
    found = {r.node: r.root for r in components.components(simhash_bk.links(df, radius, blocks, shard)).collect()}
    mine = {}
    for i, v in enumerate(signed):
        mine.setdefault(root(i), []).append(v)
    assert {v: found.get(v, v) for v in signed} == {v: min(g) for g in mine.values() for v in g}


def test_near_duplicates_and_odd_rows(spark):
    text = prose(random.Random(5), 400)
    texts = [text, text, None, "", "  ", "other words altogether here", text]
    got = simhash_bk.near_duplicates(docs(spark, texts, [5, 3, 9, 8, None, 1, 3])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(1, 1), (3, 3), (3, 3), (5, 3), (8, 8), (9, 8)]
    assert [r.component_id for r in got if r.doc_id is None] == [8] and {len(r.fingerprint) for r in got} == {16}
    assert simhash_bk.near_duplicates(docs(spark, [])).count() == 0


def test_near_copies_go_and_unlike_texts_stay(spark):
    rnd = random.Random(6)
    base = " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(400))
    near = base + " end"
    assert 0 < (simhash_bk.fingerprint(base) ^ simhash_bk.fingerprint(near)).bit_count() <= 3
    texts = [near, base, base, " ".join(base.split()[:200]), "a b", "a c", None, "", near]
    left = simhash_bk.drop_near_copies(docs(spark, texts, [1, 2, 3, 4, 5, 6, None, 7, None]))
    assert left.columns == docs(spark, []).columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 4, 5, 6, 7]
    assert simhash_bk.drop_near_copies(docs(spark, [])).count() == 0


def test_one_row_of_each_group_stays_whatever_its_ids(spark):
    rnd = random.Random(9)
    a, z = (" ".join(f"{c}{rnd.randint(0, 10**6)}" for _ in range(300)) for c in "az")
    left = simhash_bk.drop_near_copies(docs(spark, [a, a, z], [1, 3, 3]))  # (3, z) is a copy of nothing
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, a), (3, z)]
    unnamed = simhash_bk.drop_near_copies(docs(spark, [a, a, z, None, ""], [None] * 5)).collect()
    assert sorted(r.text or "" for r in unnamed) == ["", *sorted([a, z])]
    repeated = docs(spark, [a] * 500 + [z], [4] * 500 + [5]).withColumn("n", F.monotonically_increasing_id())
    assert sorted((r.doc_id, r.score) for r in simhash_bk.drop_near_copies(repeated).collect()) == [(4, 0), (5, 0)]


@pytest.mark.parametrize("shard_rows", [4096, 2])
def test_near_copies_against_brute_force(spark, shard_rows):
    rnd = random.Random(10)
    texts = []
    for _ in range(25):  # families of a text, and it with one to eight of its words changed, one after the other
        words = [f"w{rnd.randint(0, 10**6)}" for _ in range(rnd.choice([3, 80, 600]))]
        for _ in range(rnd.randint(1, 6)):
            texts.append(" ".join(words))
            for _ in range(rnd.choice([0, 1, 8])):
                words[rnd.randrange(len(words))] = f"x{rnd.randint(0, 10**6)}"
    rnd.shuffle(texts)
    prints = [simhash_bk.fingerprint(t) for t in texts]
    first = list(range(len(texts)))
    for _ in texts:
        first = [min([first[j] for j in range(len(texts)) if (prints[i] ^ prints[j]).bit_count() <= 3]) for i in range(len(texts))]
    left = simhash_bk.drop_near_copies(docs(spark, texts), shard_rows=shard_rows)
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(first)) and len(set(first)) < len(texts)


def test_components_of_chains_loops_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (60, 61), (61, 60), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {60: 60, 61: 60}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- nearest neighbours ----------------------------------------------------------------------------


@pytest.mark.parametrize("scale", [1, 1e-7, 1e7])
def test_nearest_against_brute_force(spark, scale):
    rng = np.random.default_rng(0)
    x = (rng.standard_normal((600, 16)) * scale).astype(np.float32)
    x[100:200] = x[7]  # many equal vectors
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(3, x[3].tolist(), 0), (900, None, 0), (901, [0.0] * 16, 0), (902, [1.0, None] + [0.0] * 14, 0), (903, [float("nan")] * 16, 0), (904, [1.0], 0), (None, x[5].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")
    got = {}
    for r in ann_forest.nearest(df, F.col("vec_id") % 20 == 0, leaf=32, block=64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 600, 20))
    hit = 0
    wide = x.astype(np.float64)
    for q, found in got.items():
        found.sort()
        assert [n for n, _, _ in found] == list(range(1, 21)) and q not in [i for _, i, _ in found]
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        scores = (wide * wide[q]).sum(axis=1)
        assert np.allclose([s for _, _, s in found], scores[[i for _, i, _ in found]], rtol=1e-12, atol=0)
        scores[q] = -np.inf
        hit += len({i for _, i, _ in found} & set(np.lexsort((np.arange(600), -scores))[:20].tolist()))
    assert hit / 20 / len(got) >= 0.9


def test_best_of_settles_what_rounding_blurs():
    rng = np.random.default_rng(1)
    there = np.repeat(rng.standard_normal((50, 8)) * 1e-9, 3, axis=0)
    query = rng.standard_normal(8)
    exact = (there * query).sum(axis=1)
    blurred = exact * (1 + 1e-16 * rng.standard_normal(150))
    places, scores = ann_forest.best_of(there, query, blurred, 7)
    assert places.tolist() == np.lexsort((np.arange(150), -exact))[:7].tolist() and (scores == exact[places]).all()


def test_nearest_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = ann_forest.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, 0.0)]
    assert ann_forest.nearest(df.where("vec_id > 5"), F.lit(True)).count() == 0


# --- revisits ---------------------------------------------------------------------------------------

CAPTURE = "record_id bigint, url string, at bigint, kind string, etag string, last_modified string, digest string, headers map<string,string>, found string"


@pytest.mark.parametrize("slices", [1, 4])
def test_revisits(spark, slices):
    page, same = "http://www.A.example:80/x/?b=2&utm_source=q&a=1#top", "https://a.example/x?a=1&b=2"
    old = {"date": "1", "content-length": "9", "server": "s"}
    rows = [
        (1, page, 10, "response", '"v1"', "mon", "d1", old, ""),
        (2, same, 20, "revisit", 'W/"v1"', None, None, {"date": "2", "content-length": "0"}, ""),
        (3, same, 30, "response", '"v2"', "tue", "d2", None, ""),
        (4, same, 30, "revisit", None, "tue", None, None, ""),
        (5, same, 40, "revisit", '"v1"', None, None, None, ""),
        (6, same, 5, "revisit", '"v1"', None, None, None, ""),
        (7, same, 50, "revisit", None, None, None, None, ""),
        (8, None, 50, "revisit", '"v1"', None, None, None, ""),
        (9, same, None, "revisit", '"v1"', None, None, None, ""),
        (10, same, 60, "revisit", None, None, "d2", None, ""),
        (10, same, 60, "revisit", None, None, "d2", None, ""),
    ]
    got = revisits.resolve_revisits(spark.createDataFrame(rows, CAPTURE), slices).collect()
    assert sorted((r.record_id, r.outcome, r.resolved_id) for r in got) == [
        (2, "etag", 1), (4, "last_modified", 3), (5, "changed", None), (6, "missing", None), (7, "unchecked", None),
        (8, "missing", None), (9, "missing", None), (10, "digest", 3), (10, "digest", 3),
    ]
    merged = next(r.headers for r in got if r.record_id == 2)
    assert merged == {"date": "2", "content-length": "9", "server": "s"}
    assert revisits.resolve_revisits(spark.createDataFrame([], CAPTURE), slices).count() == 0


# --- pipeline -----------------------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    rnd = random.Random(8)
    unique = lambda n: " ".join(f"{rnd.choice(WORDS)}{rnd.choice('abcdefgh')}{rnd.choice('klmnop')}{rnd.randint(0, 9)}" for _ in range(n))
    passage = unique(70)
    texts = [unique(120) for _ in range(40)] + [unique(50) + " " + passage + " " + unique(50) for _ in range(2)]
    texts += [texts[0], texts[0] + " end", " ".join(w.upper() + "!!" for w in unique(80).split()), None, ""]
    junk = len(texts) - 3
    table = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    labelled(spark, [(i, int(i != junk), 0) for i in range(junk + 1)]).write.parquet(str(tmp_path / "labels.parquet"))
    now = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, str(tmp_path))
        assert after.columns == table.columns
        after.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
    left = {r.doc_id: r.text for r in now.collect()}
    assert 0 in left and not {42, 43} & set(left)  # the copy and the near copy are gone
    assert all(passage not in (t or "") for t in left.values()) and left[0] == texts[0] and {40, 41} <= set(left)
    packed = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(left)


def test_workers_free_what_a_stage_kept():
    class Kept:
        def __init__(self):
            self.me = self

    kept = weakref.ref(common.once_per_worker("a stage", Kept))
    gc.disable()
    try:
        common.let_go("a stage")
        assert kept() is not None
        common.let_go()
        assert kept() is None
    finally:
        gc.enable()


def test_stages_hand_small_batches_to_python(spark, tmp_path):
    before = spark.conf.get(corpus_pipeline.BATCH_CONF)
    rnd = random.Random(5)
    texts = [" ".join(str(rnd.random()) for _ in range(25_000)) for _ in range(24)]
    table = docs(spark, [*texts, *texts[:4], None]).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield batch.select([0]).from_pydict({"n": [batch.nbytes]})

    try:
        for name, stage in corpus_pipeline.STAGES[1:4]:
            spark.conf.set(corpus_pipeline.BATCH_CONF, before)
            out = stage(spark, table, str(tmp_path))
            assert table.mapInArrow(sizes, "n bigint").toPandas()["n"].max() < 3 * corpus_pipeline.BATCH_BYTES, name
            if name == "near_dedup":
                assert sorted(r.doc_id for r in out.select("doc_id").collect()) == [*range(24), 28]
    finally:
        spark.conf.set(corpus_pipeline.BATCH_CONF, before)
