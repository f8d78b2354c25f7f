"""Line dedup by a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and its DEPTH leading tokens; tokens with a digit are a field from the
start. In the leaf that it reaches, a token stays if it stands at its place in the lines of MIN_DOCUMENTS documents, else the
place becomes a field too. A line has a template, its tokens with fields as ``<*>``, if at least the share CONSTANT of its
tokens without digits stays. A template that MIN_DOCUMENTS documents have is recurring; its lines are dropped from all documents but
the first by id, which keeps them. Lines of fewer than MIN_TOKENS tokens say too little to become templates with fields: they are left
alone, or with ``short_lines`` are templates of their own, all their tokens as they stand.

Unlike an online tree the result does not depend on the order of the lines. Only lines in leaves that enough documents reach
are looked at further; counts are summed before each shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchflow.llm.suffix_dedup import keyed, row_columns, whole_rows
from matchflow.session import materialise

DEPTH = 3
MIN_DOCUMENTS = 10
MIN_TOKENS = 4
CONSTANT = 0.8
FIELD = "<*>"
BROADCAST_LINES = 1_000_000


def shaped_lines(text: Column, min_tokens: int) -> Column:
    """The lines of a text with one blank between tokens, and those with a digit as fields; lines of fewer than ``min_tokens``
    tokens keep their digits. Each step is a transform of its own, so that no line is worked on twice; single blanks match nothing.
    """
    plain = F.transform(F.split(text, "\n"), lambda line: F.trim(F.regexp_replace(line, r"[ \t\r]{2,}|[\t\r]", " ")))
    long = rf"^(?:[^ ]* ){{{min_tokens - 1}}}"
    fields = lambda line: F.regexp_replace(line, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)
    return F.transform(plain, lambda line: F.when(line.rlike("[0-9]") & line.rlike(long), fields(line)).otherwise(line))


def recurring_lines(rows: DataFrame, min_documents: int, min_tokens: int, depth: int, constant: float, short_lines: bool = False) -> DataFrame:
    """Columns k1, k2, line, h (its hash, by which lines of a leaf are told apart), template, documents, least (k1 and k2 of the document that keeps it) and first (whether it is this one).

    ``rows`` as from keyed; with a column shaped, as from shaped_lines, the texts are not shaped again.
    """
    distinct = F.array_distinct(F.col("shaped") if "shaped" in rows.columns else shaped_lines(F.col("text"), min_tokens))
    lines = rows.where("text IS NOT NULL").select("k1", "k2", F.explode(distinct).alias("line"))
    lines = lines.withColumn("n", F.size(F.split("line", " "))).where("line <> ''" if short_lines else F.col("n") >= min_tokens)
    lines = lines.withColumn("leaf", F.xxhash64("n", F.substring_index("line", " ", depth)))
    leaves = materialise(lines.groupBy("leaf").count().where(F.col("count") >= min_documents).select("leaf"), "leaves")
    reached = materialise(lines.join(leaves, "leaf").select("k1", "k2", "leaf", "line", F.xxhash64("line").alias("h"), "n"), "lines")
    short, reached = (reached.where(kind).drop("n") for kind in (F.col("n") < min_tokens, F.col("n") >= min_tokens))
    texts = reached.groupBy("leaf", "h").agg(F.count("*").alias("docs"), F.min("line").alias("line"))
    tokens = texts.select("leaf", "h", "docs", F.posexplode(F.split("line", " ")).alias("place", "token"))
    often = tokens.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("often")).where(F.col("often") >= min_documents).drop("often")
    kept = tokens.drop("docs").join(often.withColumn("stays", F.lit(True)), ["leaf", "place", "token"], "left")
    stays = F.coalesce("stays", F.lit(False)) & (F.col("token") != FIELD)
    placed = F.struct("place", F.when(stays, F.col("token")).otherwise(FIELD).alias("token"), (F.col("token") == FIELD).alias("digits"))
    shaped = kept.groupBy("leaf", "h").agg(F.array_sort(F.collect_list(placed)).alias("places"))
    stay, digits = F.size(F.filter("places", lambda p: p["token"] != FIELD)), F.size(F.filter("places", lambda p: p["digits"]))
    templates = shaped.where((stay > 0) & (stay >= constant * (F.size("places") - digits))).select("leaf", "h", F.array_join(F.transform("places", lambda p: p["token"]), " ").alias("template"))
    having = reached.join(templates, ["leaf", "h"])
    if short_lines:
        having = having.unionByName(short.withColumn("template", F.col("line")))
    per_document = having.groupBy("leaf", "template", "k1", "k2").agg(F.lit(1).alias("one"))
    recurring = per_document.groupBy("leaf", "template").agg(F.count("*").alias("documents"), F.min(F.struct("k1", "k2")).alias("least"))
    recurring = recurring.where(F.col("documents") >= min_documents)
    is_first = (F.col("least.k1") == F.col("k1")) & (F.col("least.k2") == F.col("k2"))
    return having.join(recurring, ["leaf", "template"]).select("k1", "k2", "line", "h", "template", "documents", "least", is_first.alias("first"))


def marked(marks: DataFrame):
    """Function of k1, k2 and hashes of lines: which of them recur and are kept by another document. ``marks``: h, k1, k2 of the keeper."""
    frame = marks.toPandas().sort_values("h")
    shared = marks.sparkSession.sparkContext.broadcast([frame[c].to_numpy(np.int64) for c in ("h", "k1", "k2")])

    @F.pandas_udf("array<boolean>")
    def goes(k1: pd.Series, k2: pd.Series, hashes: pd.Series) -> pd.Series:
        known, least1, least2 = shared.value
        lists = [np.zeros(0, np.int64) if h is None else h for h in hashes]
        sizes = np.array([len(h) for h in lists])
        every = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64)
        drop = np.zeros(len(every), bool)
        if len(known) and len(every):
            at = np.minimum(np.searchsorted(known, every), len(known) - 1)
            keeper = (least1[at] == np.repeat(k1.to_numpy(), sizes)) & (least2[at] == np.repeat(k2.to_numpy(), sizes))
            drop = (known[at] == every) & ~keeper
        return pd.Series(np.split(drop, np.cumsum(sizes)[:-1]) if len(sizes) else [])

    return goes


def drop_recurring(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_tokens: int = MIN_TOKENS,
    depth: int = DEPTH,
    constant: float = CONSTANT,
    short_lines: bool = False,
    broadcast_lines: int = BROADCAST_LINES,
) -> DataFrame:
    """The rows of ``docs`` with the lines of recurring templates dropped from their texts, and n_lines and n_dropped.

    Documents are told apart by id and text: repeated rows count as one and lose the same lines. Null texts stay null and
    have no lines; an empty text has one, which is never dropped. A null id counts as 0 for which document is first; of two
    documents of one id the text's hash decides. Columns n_lines and n_dropped of the input are replaced, others stay.

    The shaped lines are written out once beside the rows, as three passes read them.

    Up to ``broadcast_lines`` different recurring lines (24 bytes each) are sent to all tasks, so that the documents are not
    shuffled. More lines are joined to the documents, with the same result.
    """
    docs = docs.drop("n_lines", "n_dropped")
    rows = keyed(whole_rows(docs)).withColumn("row", F.col("row").dropFields("text"))
    rows = materialise(rows.withColumn("shaped", shaped_lines(F.col("text"), min_tokens)), "shaped")
    found = recurring_lines(rows.select("k1", "k2", "text", "shaped"), min_documents, min_tokens, depth, constant, short_lines)
    lines = F.split("text", "\n")
    marks = materialise(found.select("h", "least.k1", "least.k2").distinct(), "marks")
    if marks.count() <= broadcast_lines:
        hashes = F.transform("shaped", lambda line: F.xxhash64(line))
        out = rows.withColumn("goes", marked(marks)("k1", "k2", hashes))
        left = F.filter(lines, lambda line, i: ~F.col("goes")[i])
    else:
        drops = found.where("NOT first").groupBy("k1", "k2").agg(F.collect_set("line").alias("dropped"))
        out = rows.join(drops, ["k1", "k2"], "left")
        left = F.when(F.col("dropped").isNull(), lines).otherwise(F.filter(lines, lambda line, i: ~F.array_contains(F.col("dropped"), F.col("shaped")[i])))
    out = out.withColumn("left", left)
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    out = out.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(count(lines)).cast("bigint"))
    out = out.withColumn("n_dropped", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines") - count(F.col("left"))).cast("bigint"))
    return out.withColumn("text", F.array_join("left", "\n")).select(*row_columns(docs), "n_lines", "n_dropped")


#: DuckDB SQL for the rows of the query, with the parameters above and short lines. Of one id there is one text in the given tables.
ORACLE_SQL = rf"""
WITH lines AS (
    SELECT doc_id, ord, line, CASE WHEN plain SIMILAR TO '.*[0-9].*' AND len(string_split(plain, ' ')) >= {MIN_TOKENS}
        THEN array_to_string(list_transform(string_split(plain, ' '), lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{FIELD}' ELSE t END), ' ')
        ELSE plain END AS m
    FROM (SELECT doc_id, ord, line, trim(regexp_replace(line, '[ \t\r]+', ' ', 'g'), ' ') AS plain
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS ord FROM documents))
), per_doc AS (
    SELECT DISTINCT doc_id, m, len(string_split(m, ' ')) AS n, array_to_string(string_split(m, ' ')[1:{DEPTH}], ' ') AS lead
    FROM lines WHERE m <> ''
), texts AS (
    SELECT n, lead, m, count(*) AS docs FROM per_doc WHERE n >= {MIN_TOKENS} GROUP BY ALL
), tokens AS (
    SELECT n, lead, m, docs, unnest(string_split(m, ' ')) AS token, unnest(range(n)) AS place FROM texts
), often AS (
    SELECT n, lead, place, token FROM tokens GROUP BY ALL HAVING sum(docs) >= {MIN_DOCUMENTS}
), shaped AS (
    SELECT n, lead, m,
           string_agg(CASE WHEN o.token IS NULL OR t.token = '{FIELD}' THEN '{FIELD}' ELSE t.token END, ' ' ORDER BY t.place) AS template,
           count(*) FILTER (WHERE o.token IS NOT NULL AND t.token <> '{FIELD}') AS stay,
           count(*) FILTER (WHERE t.token <> '{FIELD}') AS plain
    FROM tokens t LEFT JOIN often o USING (n, lead, place, token) GROUP BY n, lead, m
), having_it AS (
    SELECT doc_id, n, lead, m, template FROM per_doc JOIN shaped USING (n, lead, m) WHERE stay > 0 AND stay >= {CONSTANT} * plain
    UNION ALL SELECT doc_id, n, lead, m, m AS template FROM per_doc WHERE n < {MIN_TOKENS}
), recurring AS (
    SELECT n, lead, template, min(doc_id) AS first_id FROM having_it GROUP BY ALL HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}
), dropped AS (
    SELECT DISTINCT doc_id, m FROM having_it JOIN recurring USING (n, lead, template) WHERE doc_id <> first_id
), kept AS (
    SELECT l.doc_id, count(*) FILTER (WHERE d.m IS NOT NULL) AS n_dropped, count(*) AS n_lines,
           coalesce(string_agg(l.line, chr(10) ORDER BY l.ord) FILTER (WHERE d.m IS NULL), '') AS text
    FROM lines l LEFT JOIN dropped d USING (doc_id, m) GROUP BY l.doc_id
)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE k.text END AS text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
