"""Benchmark decontamination: an FM-index per training shard, in which all benchmark windows are looked up.

A window is ``length`` consecutive words of an item; a shorter item is one window. A task gathers its documents into shards
of about SHARD_WORDS words and indexes each. Words that stand in no window can be part of no occurrence, so they end a run,
and runs shorter than the shortest window are not indexed; equal runs are indexed once and their occurrences carried over to
all places where the run stands. Longer runs than a shard are cut with an overlap, so that no occurrence is lost.

The windows are broadcast in batches of at most about BATCH_WORDS words; if the benchmark has more, documents are numbered and
the spans of all batches are merged.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchflow.llm.common import map_columns, once_per_worker
from matchflow.llm.fm_index import FmIndex
from matchflow.session import materialise

LENGTH = 10
SHARD_WORDS = 500_000
BATCH_WORDS = 400_000
PIECE_WORDS = 10_000
LOCATED = 1 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SPANS = "array<struct<start:int,end:int>>"
SCHEMA = f"row bigint, doc_id bigint, n_words bigint, spans {SPANS}, items array<string>, kept_text string"


def words_column(text: Column) -> Column:
    """Words of a text; only A to Z are lower-cased."""
    return F.filter(F.split(F.translate(text, UPPER, UPPER.lower()), BREAKS), lambda w: w != "")


class Windows:
    """All distinct windows of a batch of items, as rows of word numbers grouped by length, and the items of each."""

    def __init__(self, pieces: list[tuple[str, str]], length: int):
        numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = defaultdict(set)
        self.items = sorted({item for item, _ in pieces})
        place = {item: i for i, item in enumerate(self.items)}
        for item, text in pieces:
            words = [numbers.setdefault(w, len(numbers) + 1) for w in text.encode().split(b" ")]
            for i in range(max(1, len(words) - length + 1)):
                found[tuple(words[i : i + length])].add(place[item])
        self.numbers = numbers
        self.by_length: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        for n in sorted({len(w) for w in found}):
            mine = [w for w in found if len(w) == n]
            self.by_length[n] = (np.array(mine, np.int64), [sorted(found[w]) for w in mine])
        self.shortest, self.longest = min(self.by_length, default=1 << 31), max(self.by_length, default=1)


class Shard:
    """Runs of documents, each different run once, and where they stand."""

    def __init__(self, windows: Windows, shard_words: int):
        self.windows, self.shard_words = windows, shard_words
        self.runs: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.size = 0

    def add(self, documents: list[tuple[int, np.ndarray]]) -> None:
        """Documents as (number, word numbers with 0 for words in no window)."""
        if not documents:
            return
        starts = np.cumsum([0] + [len(ids) + 1 for _, ids in documents])
        joined = np.zeros(starts[-1] + 1, np.int32)  # a 0 before, between and behind documents
        for (_, ids), start in zip(documents, starts):
            joined[start + 1 : start + 1 + len(ids)] = ids
        edges = np.flatnonzero((joined[1:] != 0) != (joined[:-1] != 0)) + 1
        begins, ends = edges[::2], edges[1::2]
        long = ends - begins >= self.windows.shortest
        begins, ends = begins[long], ends[long]
        whose = np.searchsorted(starts, begins, side="right") - 1
        for at, begin, end in zip(whose.tolist(), begins.tolist(), ends.tolist()):
            step = max(1, self.shard_words - self.windows.longest + 1)
            for first in range(begin, max(begin + 1, end - self.windows.longest + 1), step):
                run = joined[first : min(end, first + self.shard_words)].tobytes()
                if run not in self.runs:
                    self.size += len(run) // 4 + 1
                self.runs[run].append((documents[at][0], first - int(starts[at]) - 1))

    def hits(self) -> Iterator[tuple[list[tuple[int, int]], list[tuple[int, int]], list[int]]]:
        """For each run with an occurrence: where it stands, merged spans within it, and items."""
        part: list[bytes] = []
        size = 0
        for run in self.runs:
            part.append(run)
            size += len(run) // 4 + 1
            if size >= self.shard_words:
                yield from self._indexed(part)
                part, size = [], 0
        if part:
            yield from self._indexed(part)

    def _indexed(self, runs: list[bytes]) -> Iterator[tuple[list[tuple[int, int]], list[tuple[int, int]], list[int]]]:
        lengths = np.array([len(r) // 4 for r in runs])
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        text = np.zeros(starts[-1], np.int64)
        for run, start in zip(runs, starts):
            text[start : start + len(run) // 4] = np.frombuffer(run, np.int32)
        index = FmIndex(text, len(self.windows.numbers) + 1)
        cover = np.zeros(len(text) + 1, np.int64)
        items: dict[int, set[int]] = defaultdict(set)
        for length, (patterns, owners) in self.windows.by_length.items():
            low, high = index.search(patterns)
            which = np.flatnonzero(high > low)
            turn = np.cumsum(high[which] - low[which]) // LOCATED  # occurrences are located LOCATED or so at once
            cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(which)] if len(which) else []
            for a, b in zip(cuts, cuts[1:]):
                w = which[a:b]
                counts = high[w] - low[w]
                within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                places = index.locate(np.repeat(low[w], counts) + within)
                cover += np.bincount(places, minlength=len(cover))
                cover -= np.bincount(places + length, minlength=len(cover))
                for run, window in set(zip((np.searchsorted(starts, places, side="right") - 1).tolist(), np.repeat(w, counts).tolist())):
                    items[run].update(owners[window])
        hit = np.concatenate([[0], np.cumsum(cover[:-1]) > 0, [0]]).astype(np.int8)
        begins, ends = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
        whose = np.searchsorted(starts, begins, side="right") - 1
        spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for run, begin, end in zip(whose.tolist(), begins.tolist(), ends.tolist()):
            spans[run].append((begin - int(starts[run]), end - int(starts[run])))
        for run, mine in spans.items():
            yield self.runs[runs[run]], mine, sorted(items[run])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text less its spans of words, from the first character of the first word to the last of the last."""
    words = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : words[start][0]])
        at = words[end - 1][1]
    return "".join([*kept, text[at:]])


def find(docs: DataFrame, pieces: list[tuple[str, str]], length: int, shard_words: int, with_text: bool) -> DataFrame:
    """SCHEMA's columns for documents (row, doc_id, text) against one batch of windows."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    call = uuid.uuid4().hex

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        windows = once_per_worker(call, lambda: Windows(shared.value, length))
        get = windows.numbers.get
        shard, waiting, size = Shard(windows, shard_words), [], 0
        rows: list[tuple] = []

        def flush() -> dict:
            nonlocal shard, rows
            spans: dict[int, list] = defaultdict(list)
            items: dict[int, set] = defaultdict(set)
            for places, mine, which in shard.hits():
                for number, start in places:
                    spans[number] += [(start + a, start + b) for a, b in mine]
                    items[number].update(which)
            out: dict[str, list] = {"row": [], "doc_id": [], "n_words": [], "spans": [], "items": [], "kept_text": []}
            for number, (row, doc_id, n, text) in enumerate(rows):
                mine = merged(spans[number]) if number in spans else []
                out["row"].append(row)
                out["doc_id"].append(doc_id)
                out["n_words"].append(n)
                out["spans"].append([{"start": a, "end": b} for a, b in mine])
                out["items"].append([windows.items[i] for i in sorted(items[number])] if mine else [])
                out["kept_text"].append(without_words(text, mine) if with_text and mine else text)
            shard, rows = Shard(windows, shard_words), []
            return out

        for row_ids, doc_ids, texts in batches:
            for row, doc_id, text in zip(row_ids, doc_ids, texts):
                words = (text or "").encode().translate(WORD_BYTES).split()
                waiting.append((len(rows), np.fromiter(map(get, words, repeat(0)), np.int32, len(words))))
                rows.append((row, doc_id, len(words), text if with_text else None))
                size += len(words) + 1
                if size >= shard_words:
                    shard.add(waiting)
                    waiting, size = [], 0
                    if shard.size >= shard_words or with_text:
                        yield flush()
        shard.add(waiting)
        yield flush()

    return map_columns(docs, ["row", "doc_id", "text"], work, SCHEMA)


def pieces_of(benchmark: DataFrame, length: int, batch_words: int) -> tuple[DataFrame, int]:
    """Distinct items in pieces (batch, item_id, words joined by spaces), and how many batches of ``batch_words`` words there are.

    Long items are cut into pieces that overlap by a window less one word; each piece goes to one batch by its hash.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_column(F.col("text")).alias("words"))
    items = items.where("item_id IS NOT NULL AND size(words) > 0").distinct()
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    batches = -(-total // batch_words)
    last = F.greatest(F.size("words") - length, F.lit(0))
    pieces = items.select("item_id", "words", F.explode(F.sequence(F.lit(0), last, F.lit(PIECE_WORDS))).alias("start"))
    piece = F.array_join(F.slice("words", F.col("start") + 1, PIECE_WORDS + length - 1), " ").alias("piece")
    return pieces.select(F.pmod(F.xxhash64("item_id", "start"), F.lit(max(batches, 1))).alias("batch"), "item_id", piece), batches


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    length: int = LENGTH,
    shard_words: int = SHARD_WORDS,
    batch_words: int = BATCH_WORDS,
    with_text: bool = False,
) -> DataFrame:
    """What every document shares with the benchmark: doc_id, n_words, spans, items and, if asked for, kept_text.

    ``spans`` are merged runs of words (from 0, end exclusive) that lie in an occurrence of a window, ``items`` the ids
    (as text, in order) of the items whose windows occur, ``kept_text`` the text without the spans.

    Null and empty texts have no words and no spans. Repeated rows and null ids are answered row by row. An item of null id or
    without words takes no part; of an item id with several texts the windows of all count. An empty benchmark leaves all
    documents as they are; no documents give no rows. Columns other than those named are ignored.
    """
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces, batches = pieces_of(benchmark, length, batch_words)
    text = ["kept_text"] if with_text else []
    if not batches:
        words = F.coalesce(F.size(words_column(F.col("text"))), F.lit(0)).cast("bigint")
        empty = [F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items")]
        return chosen.select("doc_id", F.greatest(words, F.lit(0)).alias("n_words"), *empty, *[F.col("text").alias(c) for c in text])
    batch = lambda number: [tuple(r) for r in pieces.where(F.col("batch") == number).drop("batch").collect()]  # noqa: E731  bounded
    if batches == 1:
        rows = chosen.withColumn("row", F.lit(0).cast("bigint"))
        return find(rows, batch(0), length, shard_words, with_text).drop("row", *(() if text else ("kept_text",)))
    rows = materialise(chosen.withColumn("row", F.monotonically_increasing_id()), "documents")
    every = materialise(find(rows, batch(0), length, shard_words, False), "spans")
    for number in range(1, batches):
        every = every.unionByName(materialise(find(rows, batch(number), length, shard_words, False).where("size(spans) > 0"), "spans"))
    every = every.groupBy("row").agg(
        F.min("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    every = every.withColumn("spans", merged_column("spans"))
    if with_text:
        cut = F.udf(lambda t, spans: t and without_words(t, [(s["start"], s["end"]) for s in spans]), "string")
        every = every.join(rows.select("row", "text"), "row").withColumn("kept_text", cut("text", "spans")).drop("text")
    return every.select("doc_id", "n_words", "spans", "items", *text)


def merged_column(spans: str) -> Column:
    """Sorted spans with those that touch or overlap made one."""
    def step(out: Column, s: Column) -> Column:
        last = F.element_at(out, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        meets = (F.size(out) > 0) & (s["start"] <= F.try_element_at(out, F.lit(-1))["end"])
        return F.when(meets, F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(out, F.array(s)))

    return F.aggregate(spans, F.array().cast(SPANS), step)


def contamination_digests(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Counts and digest of ``contaminated``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = contaminated(docs, benchmark, **options)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), digest.alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


#: The same over words joined by spaces; windows of every length that an item has are looked up among the documents' own.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM bw), dw AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n)
), hits AS (SELECT DISTINCT r, n, i, win FROM dw SEMI JOIN bw USING (n, win)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r
), named AS (
  SELECT r, list_sort(list(DISTINCT item)) AS items FROM hits JOIN bw USING (n, win) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
