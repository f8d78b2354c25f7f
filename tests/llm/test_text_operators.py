"""Packing, byte-level BPE, suffix dedup, line templates and multiset fingerprints on small tables."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from matchflow.llm import byte_bpe, line_templates, multiset_hash, packing, suffix_dedup, suffix_runs

ODD = [" ", "\n", "\t", "a", "b", "'s", "'", "1", "é", "語", "!", " ", "\x1c", "\r\n", "　", "zz", "The", ".", ",", "ß", "<|endoftext|>"]


def docs(spark, texts, ids=None, more=""):
    """A table with columns whose names clash with those of the operators."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, 1, "x", 2, 3) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, piece int, fingerprint string, k1 int, spans int")


def odd_texts(n, seed=0):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


# --- byte-level BPE -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.make_encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_finds_every_token(encoder):
    assert sorted(encoder.slots) == list(range(len(encoder.tokens)))
    assert all(encoder.lookup(t) == i for i, t in enumerate(encoder.tokens))
    assert encoder.lookup(b"\x00\x01zz") == -1


def test_bpe_equals_the_library(encoder, reference):
    for text in [*odd_texts(5000), "", "x" * 5000, "ab" * 5000 + " " * 300, "".join(map(chr, range(0x20, 0x3000)))]:
        ids = encoder.encode(text)
        assert ids == ",".join(map(str, reference.encode_ordinary(text)))
        assert encoder.decode(ids) == text.encode()


def test_bpe_merges_a_word_once(monkeypatch, reference):
    monkeypatch.setattr(byte_bpe, "CACHE_WORDS", 100)
    encoder = byte_bpe.make_encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    merged, merge = [], encoder.merge
    monkeypatch.setattr(encoder, "merge", lambda piece: merged.append(piece) or merge(piece))
    # before marks, at line ends, and while it is in use among more other words than are kept
    texts = [f"a qvzthandou qvzthandou, qvzthandou.\nqvthan qvzthandou?! über{i}zvé." for i in range(300)]
    for text in [*texts, "a qvzthandou,. qvzthandou,\n qvzthandou\n\nb, a,1. ñ, ª. x\ny, \u0250b."]:
        assert encoder.encode(text) == ",".join(map(str, reference.encode_ordinary(text)))
    assert merged.count(b" qvzthandou") == merged.count(b"qvthan") == 1
    assert len(encoder) + len(encoder.older) <= 100


def test_bpe_digests(spark, reference):
    texts = [None, "", "hello  world\n", "hello  world\n", "é" * 3000]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = byte_bpe.encode_digests(docs(spark, texts, [1, 2, 3, 3, None]), path).collect()
    want = []
    for i, t in zip([1, 2, 3, 3, None], texts):
        ids = reference.encode_ordinary(t or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert byte_bpe.encode_digests(docs(spark, []), path).count() == 0


# --- packing --------------------------------------------------------------------------------


def test_words_are_encoded_as_whole_texts_are():
    words = packing.WordIds(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    for text in odd_texts(5000, 1):
        assert words.encode(text) == (words.plain(text) if text else b"")


def test_first_words_and_letters_before_marks_need_no_splitter():
    words = packing.WordIds(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    texts = [f"{w} tion{w}$$$ the{w},### {w}. {w}... naïve{w}!" for w in ("Stone", "river", "Über")]
    want = [words.plain(text) for text in texts]
    asked, whole = [], words.tokenizer

    class Recorder:
        def encode(self, text, **options):
            asked.append(text)
            return whole.encode(text, **options)

    words.tokenizer = Recorder()
    assert [words.encode(text) for text in texts] == want
    assert asked and not any(c.isalpha() for text in asked for c in text)


@pytest.mark.parametrize("n", [0, 1, 7, 3000])
def test_best_two_fit_fills_bins(n):
    lengths = np.random.default_rng(n).integers(1, 2049, n) // (3 if n == 3000 else 2) + 1
    bins, offsets = packing.best_two_fit(lengths)
    for b in range(bins.max() + 1 if n else 0):
        own = np.flatnonzero(bins == b)
        own = own[np.argsort(offsets[own])]
        assert (np.cumsum(lengths[own]) - lengths[own] == offsets[own]).all() and lengths[own].sum() <= 2048
    if n == 3000:
        assert bins.max() + 1 <= 1.01 * lengths.sum() / 2048 + 1


def test_smallest_is_replaced_by_two_that_fit_better():
    bins, _ = packing.best_two_fit(np.array([70, 25, 17, 13]), 100)
    assert bins[0] == bins[2] == bins[3] != bins[1]  # 70 + 25 becomes 70 + 17 + 13


def test_packed_documents(spark):
    texts = [None, "", "one two", "one two", "word " * 5000, "x"]
    got = packing.pack_documents(docs(spark, texts, [1, 2, 3, 3, 5, None])).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in ((5, texts[4]), (None, "x"), (1, "")):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        pieces = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        assert [p.start for p in pieces] == list(np.cumsum([0, *(p.length for p in pieces)])[:-1])
        assert sum(p.length for p in pieces) == len(ids) and all(p.length == 2048 for p in pieces[1:])
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    for s in {r.sequence_id for r in got}:
        own = sorted((r.offset, r.length) for r in got if r.sequence_id == s)
        assert [o for o, _ in own] == list(np.cumsum([0, *(n for _, n in own)])[:-1]) and sum(n for _, n in own) <= 2048
    assert len([r for r in got if r.doc_id == 3]) == 2
    assert packing.pack_documents(docs(spark, [])).count() == 0


# --- suffix dedup -----------------------------------------------------------------------------


def test_loser_tree_merges_and_tells_common_prefixes():
    rnd = random.Random(0)
    for _ in range(100):
        runs, owners = [], {}
        for r in range(rnd.randint(0, 9)):
            entries = {bytes(rnd.choice(b"ab\xff") for _ in range(rnd.randint(0, 8))): (r, i, i) for i in range(rnd.randint(0, 20))}
            for key, owner in entries.items():
                owners.setdefault(key, []).append(owner)
            runs.append(suffix_runs.pack_run(sorted(entries), [entries[k] for k in sorted(entries)]))
        last = b""
        got = list(suffix_runs.merge(runs))
        assert [(k, sorted(o)) for k, _, o in got] == [(k, sorted(owners[k])) for k in sorted(owners)]
        for key, shared, _ in got:
            n = 0
            while n < min(len(key), len(last)) and key[n] == last[n]:
                n += 1
            assert shared == n
            last = key


def removed_by_brute_force(texts, length):
    data = [(t or "").encode() for t in texts]
    counts: dict[bytes, int] = {}
    for d in data:
        for i in range(len(d) - length + 1):
            counts[d[i : i + length]] = counts.get(d[i : i + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~gone])).hexdigest()))
    return out


def repeating_texts():
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    base = [word(120) for _ in range(8)]
    part = lambda: rnd.choice(base)[rnd.randint(0, 40) : rnd.randint(50, 120)] + word(rnd.randint(0, 9))
    texts = ["".join(part() for _ in range(rnd.randint(1, 9))) for _ in range(70)]
    return [*texts, None, "", "é" * 60, "é" * 60, "aaaa" * 50, texts[0], "short"]


@pytest.mark.parametrize("settings", [{}, {"group_rows": 3}, {"ranges": 40}])
def test_suffix_dedup_equals_brute_force(spark, settings):
    texts = repeating_texts()
    got = suffix_dedup.removal_digests(docs(spark, texts), 25, **settings).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == removed_by_brute_force(texts, 25)


def test_suffix_dedup_of_repeated_rows_and_null_ids(spark):
    long = "abcdefghij" * 3 + "klmnopqrstuvwxyz0123456789" * 2
    got = suffix_dedup.removal_digests(docs(spark, [long, long, long[:30] + "?"], [1, 1, None]), 40).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, len(long)), (False, len(long)), (True, 0)]
    kept = suffix_dedup.without_repeats(docs(spark, [long, "x" + long, None], [1, 2, 3]), 40)
    assert kept.columns == docs(spark, []).columns
    assert {r.doc_id: r.text for r in kept.collect()} == {1: "", 2: "x", 3: None}
    assert suffix_dedup.removal_digests(docs(spark, []), 40).count() == 0


# --- line templates ---------------------------------------------------------------------------


def test_recurring_templates_go_from_all_but_the_first(spark):
    texts = [f"{chr(97 + i) * 5} are own words here\nposted by user{i} on day {i * 7} here\nshort line\n" for i in range(12)]
    texts += [None, "", "posted by nobody"]
    got = {r.doc_id: r for r in line_templates.drop_recurring(docs(spark, texts), min_documents=5).collect()}
    assert got[0].text == texts[0] and got[0].n_dropped == 0
    for i in range(1, 12):
        assert "posted" not in got[i].text and "short line" in got[i].text and (got[i].n_lines, got[i].n_dropped) == (4, 1)
    assert got[12].text is None and got[13].text == "" and got[14].text == texts[14]
    assert line_templates.drop_recurring(docs(spark, [])).count() == 0


def test_short_lines_go_as_they_stand(spark):
    texts = [f"{chr(97 + i)} own{chr(97 + i)}\n\nAll rights\t reserved.\n{i}\nPage 7" for i in range(12)]
    table = docs(spark, texts).withColumns({"lang": F.lit("en"), "n_chars": F.lit(0)})
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, table, "").collect()}
    assert got[0] == texts[0] and all(got[i] == f"{chr(97 + i)} own{chr(97 + i)}\n\n{i}" for i in range(1, 12))


def test_lines_are_joined_where_they_are_too_many_to_send(spark):
    texts = [f"posted by user{i} on day {i * 7} here\n\tposted  by me on day 7 here\n{i} own\nAll rights reserved." for i in range(15)] * 2 + [None, ""]
    table = docs(spark, texts, [*range(15), *range(12), None, 20, 21, 7, 22])
    rows = [sorted(map(repr, line_templates.drop_recurring(table, short_lines=True, broadcast_lines=n).collect())) for n in (0, 1000)]
    assert rows[0] == rows[1] and sum("n_dropped=3" in r for r in rows[0]) > 20


def test_fields_are_generalised_in_the_leaf(spark):
    names = ["ann", "bob", "cid", "dan", "eve", "fay"]
    texts = [f"all rights reserved by {n} and the other authors\n{n} has own text here" for n in names]
    found = line_templates.recurring_lines(suffix_dedup.keyed(docs(spark, texts)), 5, 4, 3, 0.8).select("template").distinct().collect()
    assert [r.template for r in found] == ["all rights reserved by <*> and the other authors"]


# --- multiset fingerprints ----------------------------------------------------------------------


def vectors(spark, *lists):
    df = spark.createDataFrame([tuple(lists)], ", ".join(f"c{i} array<string>" for i in range(len(lists))))
    return df.select(*[multiset_hash.vector(F.col(f"c{i}")).alias(f"c{i}") for i in range(len(lists))])


def test_vectors_add_and_forget_order(spark):
    parts = [f"p{i}" for i in range(300)]
    v = vectors(spark, parts, ["q", "p1"], [*parts, "p1", "q"], parts[::-1], [])
    plus = multiset_hash.combine(F.col("c0"), F.col("c1"))
    minus = multiset_hash.combine(F.col("c2"), F.col("c1"), -1)
    row = v.select((plus == F.col("c2")).alias("a"), (minus == F.col("c0")).alias("b"), (F.col("c0") == F.col("c3")).alias("c"), F.size("c4").alias("n")).first()
    assert tuple(row) == (True, True, True, 0)


def test_edited_texts(spark):
    texts = [None, "", "one two three four five six seven eight nine ten", "ä" * 41, "a b c d", "same", "same"]
    ids = [7, 1, 2, 3, 4, 5, 5]
    for buckets in (1, 4):
        got = multiset_hash.edited_fingerprints(docs(spark, texts, ids), buckets).collect()
        rows = sorted(((i, t or "") for i, t in zip(ids, texts)))
        want = []
        for n, (i, t) in enumerate(rows):
            k = len(t) // 4
            edited = t[: len(t) - k] + rows[(n + 1) % len(rows)][1][:k]
            want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
        assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
        same = [r for r in got if r.doc_id == 5]
        assert same[0].fingerprint == same[1].fingerprint and 1.0 in {r.near_next for r in same}
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert multiset_hash.edited_fingerprints(docs(spark, [])).count() == 0
    alone = multiset_hash.edited_fingerprints(docs(spark, ["abcdefgh"], [None])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def cut_by_hand(text, hash_of):
    """The runs of a text as multiset_hash.runs describes them; ``hash_of`` gives the words' hashes."""
    found = Counter()
    for line in text.split("\n"):
        words = line.split()
        head = " ".join(words[: multiset_hash.HEAD]) + (" " if len(words) > multiset_hash.HEAD else "")
        found.update(f"{i // 3}:{head[i : i + 3]}" for i in range(0, len(head), 3))
        run = []
        for w in words[multiset_hash.HEAD :]:
            run.append(w)
            if len(run) > 1 and hash_of[w] % multiset_hash.CUTS == 0:
                found[" ".join(run)] += 1
                run = []
        if run:
            found[" ".join(run)] += 1
    return found


def test_likeness_of_any_length_is_that_of_the_runs(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefghijklm", k=rnd.randint(2, 8))) for _ in range(5000)]
    write = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    pairs = []
    for n in (1, 4, 10, 40, 100, 400, 4_000, 20_000):
        for _ in range(4):
            a, b = write(n), write(n)
            line = write(max(2, n // 5))
            often = "\n".join([line] * 5)
            pairs += [(a, a[: len(a) - len(a) // 4] + b[: len(a) // 4]), (a, b), (a, "new " + a), (often, often[: len(often) * 3 // 4])]
    hashes = spark.createDataFrame([(w,) for w in sorted({w for p in pairs for t in p for w in t.split()})], "w string").select("w", F.xxhash64("w").alias("h"))
    hash_of = {r.w: r.h for r in hashes.collect()}
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    v = df.select("i", *[multiset_hash.vector(multiset_hash.paragraphs(F.col(c))).alias(c) for c in "ab"])
    got = {r.i: r.near for r in v.select("i", multiset_hash.likeness(F.col("a"), F.col("b")).alias("near")).collect()}
    for i, (a, b) in enumerate(pairs):
        x, y = cut_by_hand(a, hash_of), cut_by_hand(b, hash_of)
        want = 2 * sum(x[r] * y[r] for r in x) / sum(c * c for z in (x, y) for c in z.values())
        assert abs(got[i] - want) < 0.12, (i, got[i], want)
        if i % 4 == 2 and len(a.split()) >= 400:  # a word in front changes the pieces of the head and the runs next to it
            assert got[i] > 0.8
        if i % 4 == 3 or (i % 4 == 0 and len(a) > 3):
            assert got[i] > 0.3
    long = [got[i] for i in range(0, len(pairs), 4) if len(pairs[i][0].split()) == 20_000]
    assert max(long) - min(long) < 0.05


def test_fingerprints_run_no_python(spark, capsys):
    multiset_hash.edited_fingerprints(docs(spark, ["a"])).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
