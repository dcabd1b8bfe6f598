"""Line dedup by overlapping three-line windows.

Every run of three consecutive lines is hashed (128 bits). A window that occurred before, in a document
with a smaller id or earlier in the same one, is a repeat; the lines that repeats cover
are removed, overlapping repeats being merged into one covered stretch. The first
occurrence of a window never counts as a repeat, so every line stays somewhere.

Defined results: lines end at ``\\n``; windows of three blank lines are no windows; documents with
fewer than three lines, and null or empty texts, come back unchanged; rows that repeat both id and
text are one document and are cut alike; rows that share an id only are ordered by a hash
of their texts; a null id comes before all others; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.tables import fresh, split_by_ids
from harborline.session import written_once

LINES = 3


def _windows(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, text_key, at, h1, h2)`` for each window, ``at`` being its first line from 0."""
    hashes = F.transform(F.split("text", "\n"), lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(size), x).alias("h2"), x.rlike("\\S").alias("filled")))
    lines = docs.select("doc_id", "text_key", hashes.alias("lines")).where(F.size("lines") >= size)
    lines = lines.select("doc_id", "text_key", *[F.col("lines")[c].alias(c) for c in ("h1", "h2", "filled")])
    own = lambda c, i: F.slice(F.col(c), i + 1, size)
    window = lambda i: F.struct(i.alias("at"), F.xxhash64(own("h1", i)).alias("h1"), F.xxhash64(own("h2", i)).alias("h2"), F.array_contains(own("filled", i), True).alias("filled"))
    return lines.select("doc_id", "text_key", F.inline(F.transform(F.sequence(F.lit(0), F.size("h1") - size), window))).where("filled").drop("filled")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = LINES) -> DataFrame:
    """``(doc_id, text_key, covered)``: sorted places, from 0, of the lines to remove, for documents that have any."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    windows = _windows(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), size)
    place = F.struct("doc_id", "text_key", "at")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("h1", "h2", "first")
    later = windows.join(first, ["h1", "h2"]).where(place != F.col("first"))
    starts = later.groupBy("doc_id", "text_key").agg(F.collect_set("at").alias("starts"))
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("starts", lambda i: F.sequence(i, i + size - 1)))))
    return starts.select("doc_id", "text_key", covered.alias("covered"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = LINES, counts: tuple[str, str] = ("_lines", "_removed")) -> DataFrame:
    """All rows and columns of ``docs``, the text without repeated lines; ``counts`` names two more columns, its lines and how many went."""
    if any(fresh(docs, c) != c for c in counts):
        raise ValueError(f"the table has a column of the name {counts[0]} or {counts[1]}; name the counts otherwise")
    covered = written_once(repeated_lines(docs, id_col, text_col, size), "covered-lines")
    lines = F.split(F.col(f"`{text_col}`"), "\n")
    key = F.xxhash64(F.col(f"`{text_col}`"))
    gone_id, gone_key, gone, split = (fresh(docs, c) for c in ("_covered_id", "_covered_key", "_covered", "_split"))
    covered = covered.select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key), F.col("covered").alias(gone))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(gone_id)) & (key == F.col(gone_key))
    # most documents have nothing to remove: only the others are shuffled to meet their lines
    some, clean = split_by_ids(docs, key, covered, gone_key)
    joined = some.join(covered.hint("merge"), same, "left").withColumn(split, lines)
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone))
    kept = F.transform(left, lambda i: F.get(F.col(split), i))
    text = F.when(F.col(gone).isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(kept, "\n"))
    out = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    cut = joined.select(*out, F.size(split).alias(counts[0]), F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).alias(counts[1]))
    return cut.union(clean.select("*", F.size(lines).alias(counts[0]), F.lit(0).alias(counts[1])))


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
windows AS (
  SELECT doc_id, i AS pos, array_to_string(ls[i:i + 2], chr(10)) AS w
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM lines WHERE len(ls) >= 3)),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS n
  FROM windows WHERE regexp_replace(w, '\\s', '', 'g') <> ''),
covered AS (
  SELECT doc_id, list_distinct(flatten(list([pos, pos + 1, pos + 2]))) AS gone FROM ranked WHERE n > 1 GROUP BY doc_id)
SELECT l.doc_id, len(ls) AS n_lines, coalesce(len(gone), 0) AS n_removed,
  CASE WHEN gone IS NULL THEN l.text
    ELSE coalesce(array_to_string(list_filter(ls, lambda x, i: NOT list_contains(gone, i)), chr(10)), '') END AS text
FROM lines l LEFT JOIN covered c USING (doc_id)
"""
