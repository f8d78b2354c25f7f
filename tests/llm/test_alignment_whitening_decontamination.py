"""Cross-tokenizer alignment, embedding whitening and benchmark decontamination against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from matchflow.llm import decontamination, token_alignment, whitening
from matchflow.llm.fm_index import FmIndex

DOCS = "doc_id bigint, text string, start int, items string, row string"


@pytest.fixture(scope="module")
def encoders():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return token_alignment.Encoders(a.read(), b.read(), public_tokenizers.PATTERN)


def docs_of(spark, texts, parts=3):
    rows = [(i, t, 0, "x", "y") for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(parts) if rows else spark.createDataFrame([], DOCS)


# --- alignment ----------------------------------------------------------------------------------


def test_fast_ids_are_the_tokenizers_own(encoders):
    rng = random.Random(1)
    letters = "".join(map(chr, range(0x250))) + "'''    \n\n\t  sdtlvre‘’“”…–—"
    for i in range(3000):
        text = "".join(rng.choice(letters) if rng.random() < 0.5 else rng.choice("ab 'st l re1 2\n") for _ in range(rng.randrange(1, 60)))
        text += "<|endoftext|>" if i % 5 == 0 else ""
        assert not token_alignment.RARE.search(text)
        assert encoders.a.fast.encode_ordinary(" " + text) == encoders.a.tokenizer.encode(" " + text, add_special_tokens=False).ids


def test_pair_hash_is_minimal_and_verifies_keys():
    for n in (0, 1, 2, 5000):
        keys = np.unique(np.random.default_rng(n).integers(0, 1 << 40, n))
        index = token_alignment.PairHash(keys)
        assert sorted(index.lookup(keys).tolist()) == list(range(len(keys)))
        assert (index.lookup(keys + (1 << 41)) == -1).all()


def aligned_by_hand(texts, encoders):
    held, count = [], Counter()
    for i, text in texts:
        a, b = ([*np.frombuffer(ids, "<u4").tolist()] for ids in encoders.encode(text))
        at_a, at_b = ([sum(len(side.bytes[t]) for t in ids[: k + 1]) for k in range(len(ids))] for side, ids in ((encoders.a, a), (encoders.b, b)))
        links = [(x, y) for x, e, s in zip(a, at_a, [0, *at_a]) for y, f, t in zip(b, at_b, [0, *at_b]) if s < f and t < e]
        cuts = sorted({*at_a} & {*at_b})
        groups = [",".join(str(x) for x, e in zip(a, at_a) if low < e <= cut) + "|" + ",".join(str(y) for y, f in zip(b, at_b) if low < f <= cut) for low, cut in zip([0, *cuts], cuts)]
        held.append((i, a, b, cuts, links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
        count.update(set(links))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return sorted([(i, len(a), len(b), len(cuts), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), digest) for i, a, b, cuts, links, digest in held], key=str)


ODD = [None, "", "a", " ", "  two  spaces ", "Ünïcode ßtraße 東京 🎈", "<|endoftext|> plain <s>", "x" * 400, "tab\tnew\n\nline", "▁ mark", "é composed", "\x00nul", "１２ wide"]


@pytest.mark.parametrize("slice_pairs", [10**6, 40])
def test_alignment_equals_brute_force(spark, encoders, slice_pairs):
    rng = random.Random(2)
    words = ["the", "tokenizer", "übers", "and", "segment", "naïve", "it's", "1999", "don't", "...", "straightforwardly"]
    texts = [*enumerate(ODD), (None, "no id"), (None, "no id"), (7, "the same"), (7, "the same")]
    texts += [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for i in range(30)]
    got = token_alignment.align(docs_of(spark, texts), slice_pairs=slice_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == aligned_by_hand(texts, encoders)


def test_alignment_of_nothing_and_of_long_texts(spark, encoders):
    assert token_alignment.align(docs_of(spark, [])).collect() == []
    only = token_alignment.align(docs_of(spark, [(1, None)])).first()
    assert tuple(only) == (1, 0, 0, 0, 0, 0, 0, "")
    long = " ".join(f"word{i % 97} {'z' * (i % 7)}" for i in range(60_000)) + " " * 5000
    row = token_alignment.align(docs_of(spark, [(1, long), (2, "word5")])).where("doc_id = 1").first()
    a, b = encoders.encode(long)
    assert (row.n_a, row.n_b) == (len(a) // 4, len(b) // 4) and row.n_a > 100_000
    assert row.n_best <= row.n_links <= row.count_sum


# --- whitening ----------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, number bigint, component string"


def whitened_by_hand(vectors, most):
    x = np.floor(np.array(vectors) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = (n * fit - s) / n
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1][:most], directions[:, ::-1][:, :most]
    return n, ((n * x - s) ** 2).sum(axis=1), ((n * x - s) / n) @ directions / np.sqrt(values), values / np.trace(covariance)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((300, 6)) @ rng.standard_normal((6, 6))
    vectors = np.concatenate([vectors, np.tile(vectors[:1], (150, 1))])  # a third is one vector
    rows = [(i, v.tolist(), 0, "c") for i, v in enumerate(vectors)]
    odd = [(900, None, 0, ""), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0, ""), (902, [float("nan")] * 6, 0, ""), (903, [float("inf")] * 6, 0, ""), (904, [], 0, ""), (905, [1.0] * 5, 0, "")]
    got = whitening.whiten(spark.createDataFrame(rows + odd, VECTORS).repartition(4), components=4, block_bytes=6 * 8 * 50).toPandas()
    n, deviation, values, explained = whitened_by_hand(vectors, 4)
    got = got.sort_values(["vec_id", "component"])
    assert got["vec_id"].tolist() == np.repeat(np.arange(450), 4).tolist() and got["component"].tolist() == [1, 2, 3, 4] * 450
    assert set(got["n"]) == {n} and (got["deviation"].to_numpy().reshape(-1, 4)[:, 0] == deviation).all()
    mine = got["whitened"].to_numpy().reshape(-1, 4)
    assert np.abs(mine * np.sign((mine * values).sum(axis=0)) - values).max() < 1e-9
    assert np.allclose(got["explained"].to_numpy()[:4], explained, rtol=1e-9) and got["identity_error"].max() < 1e-9


def test_whitening_without_variance_and_of_nothing(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 0, "")], VECTORS)).collect() == []
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 2.0], 0, ""), (None, [0.5, 2.0], 0, "")], VECTORS)).collect()
    assert len(same) == 4 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, 0.0, 0.0, 0.0) for r in same)
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 3.0], 0, "") for i in range(5)], VECTORS)).collect()
    assert all(r.whitened == 0.0 for r in line if r.component == 2) and all(abs(r.explained - 1) < 1e-12 for r in line if r.component == 1)


def test_whitening_of_huge_numbers_is_exact_or_null(spark):
    vectors = [[float(1 << 40), 1.0], [0.0, 2.0], [-float(1 << 40), 3.0]]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0, "") for i, v in enumerate(vectors)], VECTORS)).toPandas()
    assert got["deviation"].isna().any() and np.isfinite(got["whitened"]).all()
    far = whitening.whiten(spark.createDataFrame([(0, [1e300, 1.0], 0, ""), (1, [-1e300, 2.0], 0, ""), (2, [0.0, 0.0], 0, "")], VECTORS))
    assert far.count() == 6


# --- decontamination ----------------------------------------------------------------------------


def test_fm_index_equals_brute_force():
    rng = np.random.default_rng(0)
    for turn in range(60):
        symbols, n = int(rng.integers(1, 6)), int(rng.integers(1, 80))
        text = rng.integers(0, symbols + 1, n)
        text = np.append(np.tile(text[: max(1, n // 5)], 6) if turn % 3 == 0 else text, 0)
        index = FmIndex(text, symbols + 1, int(rng.integers(1, 9)))
        for length in (1, 2, 5):
            patterns = rng.integers(1, symbols + 1, (20, length))
            for p, low, high in zip(patterns, *index.search(patterns)):
                want = [i for i in range(len(text) - length + 1) if (text[i : i + length] == p).all()]
                assert sorted(index.locate(np.arange(low, high)).tolist()) == want


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def hits_by_hand(docs, items, length):
    found = []
    windows = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        if item is not None and words:
            for i in range(max(1, len(words) - length + 1)):
                windows[tuple(words[i : i + length])].add(str(item))
    for i, text in docs:
        words, hit, named = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for at in range(len(words) - n + 1):
                if tuple(words[at : at + n]) in windows:
                    hit.update(range(at, at + n))
                    named |= windows[tuple(words[at : at + n])]
        found.append((i, len(words), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=str)


@pytest.mark.parametrize("options", [{}, {"shard_words": 40}, {"batch_words": 60}, {"batch_words": 60, "shard_words": 30}])
def test_decontamination_equals_brute_force(spark, options):
    rng = random.Random(5)
    vocabulary = ["a", "B", "c", "D", "e", "É", "f9", "東京"]
    prose = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, prose(rng.randrange(1, 40))) for i in range(12)] + [(3, prose(9)), (50, None), (51, "..."), (None, "a a a a a"), (52, "zz zz a"), (52, "zz zz a")]
    docs = [(None, None), (None, "a"), (1, ""), (2, "..."), (3, "zz ZZ a, zz zz A"), (4, items[0][1]), (4, items[0][1]), (5, items[1][1] + " q " + items[2][1])]
    docs += [(10 + i, prose(rng.randrange(1, 300))) for i in range(30)] + [(100 + i, "same " + items[3][1] + " tail") for i in range(20)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.contamination_digests(docs_of(spark, docs), bench, length=5, **options)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == hits_by_hand(docs, items, 5)


@pytest.mark.parametrize("batch_words", [10**6, 4])
def test_spans_are_cut_out(spark, batch_words):
    bench = spark.createDataFrame([("q", "one two Three"), ("r", "three four five")], "item_id string, text string")
    docs = docs_of(spark, [(1, "(zero) One, two three; four FIVE! six"), (2, "clean"), (3, None)])
    got = {r.doc_id: r for r in decontamination.contaminated(docs, bench, length=3, batch_words=batch_words, with_text=True).collect()}
    assert got[1].kept_text == "(zero) ! six" and [tuple(s) for s in got[1].spans] == [(1, 6)] and got[1]["items"] == ["q", "r"]
    assert got[2].kept_text == "clean" and got[3].kept_text is None and got[3].n_words == 0


def test_decontamination_without_benchmark_or_documents(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = decontamination.contamination_digests(docs_of(spark, [(1, "a b"), (2, None)]), none).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got] == [(2, 0, 0, False), (0, 0, 0, False)]
    bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontamination.contamination_digests(docs_of(spark, []), bench).collect() == []


def test_a_very_long_document_is_cut_without_loss(spark):
    passage = [f"w{i}" for i in range(40)]
    bench = spark.createDataFrame([(1, " ".join(passage))], "item_id bigint, text string")
    rng = random.Random(6)
    words = [rng.choice(passage) for _ in range(30_000)]
    for at in range(0, 29_000, 997):
        words[at : at + 15] = passage[5:20]
    docs = [(1, " ".join(words))]
    got = decontamination.contamination_digests(docs_of(spark, docs), bench, shard_words=1000)
    assert [tuple(r) for r in got.collect()] == hits_by_hand(docs, [(1, " ".join(passage))], 10)
