"""Homomorphic multiset hash of a text's paragraphs, for equality and likeness without regard to order.

A fingerprint is a vector of SUMS + LANES lanes modulo 2^32, the sum of the vectors of all paragraphs. The sum does not depend
on the order of the paragraphs; a paragraph is inserted or deleted by adding or subtracting its vector; a repeated paragraph
counts as often as it stands there.

Equality: a line of the text, as it stands, adds SUMS pseudo-random numbers of 32 bits, one to each of the first SUMS lanes.
Two texts that are not made of the same lines have equal sums with a chance of 2^-(32 SUMS).

Likeness: lines are cut further into runs of words, and each run adds one to one of LANES lanes. The products of two such
vectors, less what lanes share by chance, estimate how many runs the texts have in common; the relative error depends on LANES
only, not on the length of the texts. Runs are cut where the hash of a word says so, so that a word put in or taken out
changes the runs next to it and no others. The first HEAD words of a line are cut finer, into pieces of PIECE characters, so
that texts of a few words are compared by more than one or two runs.

A vector is kept as the array of its used lanes in order, each ``lane * 2^32 + sum``. All of this is built-in functions; no
Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUMS = 8
LANES = 512
HEAD = 4
PIECE = 3
CUTS = 3
MASK = (1 << 32) - 1
MAX_BUCKETS = 10_000


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is made once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def paragraphs(text: Column) -> Column:
    """The lines of a text, as they stand; an empty text has none."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))


def runs(line: Column) -> Column:
    """What a line is cut into for likeness; blanks between words count as one space.

    The first HEAD words are cut into pieces of PIECE characters, each with its place. The words after them end a run of two
    words or more where a word's hash is divisible by CUTS.
    """

    def cut(plain: Column) -> Column:
        head = F.regexp_extract(plain, rf"^(?:[^ ]+ ?){{1,{HEAD}}}", 0)
        pieces = F.transform(F.regexp_extract_all(head, F.lit(rf".{{1,{PIECE}}}"), F.lit(0)), lambda p, i: F.concat(i.cast("string"), F.lit(":"), p))
        rest = F.filter(F.split(F.substring(plain, F.length(head) + 1, F.length(plain)), " "), lambda w: w != "")
        marked = F.transform(rest, lambda w: F.concat(w, F.when(F.pmod(F.xxhash64(w), F.lit(CUTS)) == 0, F.lit("\n")).otherwise(F.lit(" "))))
        return F.concat(pieces, F.regexp_extract_all(F.array_join(marked, ""), F.lit(r"[^ \n]+[ \n]?[^\n]*"), F.lit(0)))

    return bind(F.trim(F.regexp_replace(line, r"[\s\u0085\u2028\u2029]+", " ")), cut)


def vector(parts: Column) -> Column:
    """Sum of the vectors of the given paragraphs; the empty array without paragraphs."""
    lanes = F.sort_array(F.flatten(F.transform(parts, lambda p: F.transform(runs(p), lambda r: F.xxhash64(r).bitwiseAND(LANES - 1)))))
    return F.concat(bind(parts, _sums), bind(lanes, _counts))


def _sums(parts: Column) -> Column:
    """The used ones of the first SUMS lanes: two of each 64-bit hash of a paragraph."""

    def total(seed: int, shift: int) -> Column:
        return F.aggregate(parts, F.lit(0).cast("bigint"), lambda s, p: (s + F.shiftrightunsigned(F.xxhash64(p, F.lit(seed)), shift).bitwiseAND(MASK)).bitwiseAND(MASK))

    both = F.array(*(F.lit(i << 32).cast("bigint") + total(i // 2, 32 * (i % 2)) for i in range(SUMS)))
    return F.filter(both, lambda v: v.bitwiseAND(MASK) != 0)


def _counts(lanes: Column) -> Column:
    """How often each lane stands in the sorted array ``lanes``."""
    places = F.when(F.size(lanes) > 0, F.sequence(F.lit(0), F.size(lanes) - 1)).otherwise(F.array().cast("array<int>"))
    ends = F.filter(places, lambda i: ~F.get(lanes, i).eqNullSafe(F.get(lanes, i + 1)))
    before = lambda found, j: F.coalesce(F.get(found, j - 1), F.lit(-1))
    return bind(ends, lambda found: F.transform(found, lambda i, j: F.shiftleft(F.get(lanes, i) + SUMS, 32) + (i - before(found, j))))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Vector of the union of two multisets (``sign`` 1), or of the first without the second (-1)."""
    both = F.array_sort(F.array_distinct(F.transform(F.concat(a, b), lambda v: F.shiftright(v, 32))))

    def at(v: Column, lane: Column) -> Column:
        return F.aggregate(F.filter(v, lambda x: F.shiftright(x, 32) == lane), F.lit(0).cast("bigint"), lambda s, x: s + x.bitwiseAND(MASK))

    summed = F.transform(both, lambda lane: F.shiftleft(lane, 32) + (at(a, lane) + sign * at(b, lane)).bitwiseAND(MASK))
    return F.filter(summed, lambda v: v.bitwiseAND(MASK) != 0)


def likeness(a: Column, b: Column) -> Column:
    """Twice the product of two vectors of runs over the sum of their squares, from 0 to 1; 1 for equal vectors.

    Of texts without repeated runs this is the share of runs that they have in common. What different runs add by falling
    into one lane is taken off: n * m / LANES of every product of vectors of n and m runs.
    """
    counts = lambda v: F.filter(v, lambda x: F.shiftright(x, 32) >= SUMS)
    number = lambda x: x.bitwiseAND(MASK).cast("double")
    total = lambda v, f: F.aggregate(v, F.lit(0.0), lambda s, x: s + f(number(x)))

    def product(merged: Column) -> Column:
        """Lanes that both have are neighbours in the sorted array of both."""
        at = lambda i: F.get(merged, i)
        places = F.when(F.size(merged) > 1, F.sequence(F.lit(0), F.size(merged) - 2)).otherwise(F.array().cast("array<int>"))
        same = F.filter(places, lambda i: F.shiftright(at(i), 32) == F.shiftright(at(i + 1), 32))
        return F.aggregate(same, F.lit(0.0), lambda s, i: s + number(at(i)) * number(at(i + 1)))

    def of(found: Column) -> Column:
        x, y = found["x"], found["y"]
        n, m = total(x, lambda c: c), total(y, lambda c: c)
        common = bind(F.sort_array(F.concat(x, y)), product) - n * m / LANES
        squares = total(x, lambda c: c * c) + total(y, lambda c: c * c) - (n * n + m * m) / LANES
        return F.coalesce(F.try_divide(2 * common, squares), F.lit(0.0))

    found = bind(F.struct(counts(a).alias("x"), counts(b).alias("y")), of)
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), found)))


def text_of(v: Column) -> Column:
    """A vector as text: the used lanes in hexadecimal, 11 digits each (three for the lane, eight for the sum)."""
    return F.lower(F.array_join(F.transform(v, lambda x: F.lpad(F.hex(x), 11, "0")), ""))


def with_next(docs: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """Add next_<column> of the row that follows by doc_id, the first after the last.

    Rows of one id follow each other by their text; a null id comes first. Ids are cut into ranges at their approximate
    quantiles, which are ids themselves, so the row after the last of a range is known beforehand: it is sent to both ranges.
    No task gets more than about a range of rows.
    """
    fractions = [i / buckets for i in range(1, buckets)]
    ends = docs.agg(
        F.percentile_approx("doc_id", fractions or [0.5], 10_000).alias("cuts"), F.min("doc_id").alias("least"), F.bool_or(F.col("doc_id").isNull()).alias("nulls")
    ).first()
    cuts = sorted(set(ends["cuts"] or [])) if fractions else []
    least = F.lit(None if ends["nulls"] else ends["least"]).cast("bigint")
    cut = F.array(*(F.lit(c).cast("bigint") for c in cuts)) if cuts else F.array().cast("array<bigint>")
    own = F.coalesce(F.size(F.filter(cut, lambda c: c <= F.col("doc_id"))), F.lit(0))
    place = lambda b, wraps, guest: F.struct(b.alias("range"), F.lit(wraps).alias("wraps"), F.lit(guest).alias("guest"))
    places = F.array(
        place(own, False, False),
        F.when(F.array_contains(cut, F.col("doc_id")), place(own - 1, False, True)),
        F.when(F.col("doc_id").eqNullSafe(least), place(F.lit(len(cuts)), True, True)),
    )
    spread = docs.withColumn("place", F.explode(F.filter(places, lambda p: p.isNotNull()))).select(*docs.columns, "place.*")
    order = Window.partitionBy("range").orderBy("wraps", F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    return spread.select("guest", *docs.columns, *(F.lead(c).over(order).alias(f"next_{c}") for c in columns)).where("NOT guest").drop("guest")


def edited_fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are.

    The edited text has the last quarter of its code points replaced by the first as many of the next document by doc_id.
    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null texts count as
    empty and have the empty fingerprint; two empty texts are alike by 1. For null and repeated ids see with_next; a table
    of one row is its own next. Columns other than doc_id and text are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = buckets or min(MAX_BUCKETS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("v", vector(paragraphs(F.col("text"))))
    rows = with_next(base, ["text", "v"], buckets).withColumn("n_chars", F.length("text").cast("bigint"))
    replaced = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n_chars - floor(n_chars / 4))"), F.substring(F.col("next_text"), F.lit(1), replaced))
    rows = rows.select("doc_id", "n_chars", "v", "next_v", edited.alias("edited"))
    rows = rows.withColumn("edited_v", vector(paragraphs(F.col("edited"))))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        text_of(F.col("v")).alias("fingerprint"),
        text_of(F.col("edited_v")).alias("edited_fingerprint"),
        likeness(F.col("v"), F.col("edited_v")).alias("near_edited"),
        likeness(F.col("v"), F.col("next_v")).alias("near_next"),
    )
