"""Line dedup: lines found in many documents are dropped, except in one.

Lines are exploded, normalised and hashed; each hash's distinct documents are counted; lines over the threshold go and
the rest is reassembled by position. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .columns import free_prefix
from .staging import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased and nothing else; lower() is faster and does the same where all characters are ASCII."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_hash, pos, a, b): the 96-bit hash of the key of each line that is long enough, and where it stands."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    lines = lines.where(F.length("line") >= min_chars).select("doc_id", "text_hash", "pos", F.btrim("line", F.lit(" \t\n\x0b\x0c\r")).alias("line"))
    lines = lines.where(F.length("line") >= min_chars).select("doc_id", "text_hash", "pos", lower_ascii(F.col("line")).alias("key"))
    return lines.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("a"), F.hash("key").alias("b"))


def _between(lines: Column, drops: Column) -> Column:
    """The lines at positions other than `drops`, which are sorted: the slices between them."""

    def slices(lines: Column, edges: Column) -> Column:
        each = F.sequence(F.lit(0), F.size(edges) - 2)
        return F.flatten(F.transform(each, lambda i: F.slice(lines, F.get(edges, i) + 2, F.get(edges, i + 1) - F.get(edges, i) - 1)))

    return let(lines, lambda x: let(F.concat(F.array(F.lit(-1)), drops, F.array(F.size(x))), lambda edges: slices(x, edges)))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """`docs` with repeated lines cut from `text`, and `n_lines` (before) and `n_dropped` added.

    A line's key is the line without white space at both ends, A-Z lower-cased. Keys of at least `min_chars` code points
    found in at least `min_docs` distinct doc_ids lose all their lines except in the largest doc_id that holds them.

    Null and empty texts are one empty line, and come back empty. Rows with a null doc_id count towards no key, and lose
    all lines of keys that are dropped. Rows that share a doc_id count as one document. Columns n_lines and n_dropped of
    the input are replaced; other columns pass through, whatever their names. No rows give no rows.
    """
    p = free_prefix(docs)
    keys = staged(_line_keys(docs, min_chars), "line_keys")
    frequent = keys.groupBy("a", "b").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs)
    drops = (
        keys.join(frequent.select("a", "b", "keeper"), ["a", "b"])
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias(p + "doc_id"), F.col("text_hash").alias(p + "of"))
        .agg(F.sort_array(F.collect_set("pos")).alias(p + "drops"))
    )
    order = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    mine = docs.select(*order, F.xxhash64("text").alias(p + "hash"))
    joined = mine.join(drops, mine["doc_id"].eqNullSafe(drops[p + "doc_id"]) & (mine[p + "hash"] == drops[p + "of"]), "left")
    dropped, text = F.col(p + "drops"), F.coalesce("text", F.lit(""))
    stay = F.when(dropped.isNull(), text).otherwise(F.array_join(_between(_lines(text), dropped), "\n"))
    return joined.select(
        *[stay.alias(c) if c.lower() == "text" else F.col(c) for c in order],
        (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"),
    )
