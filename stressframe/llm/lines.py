"""Line deduplication across documents (operator 8), DataFrame functions only.

Lines are exploded, normalised (white space stripped at both ends, A-Z lower-
cased) and hashed to 128 bits; distinct documents are counted per hash with
partial aggregation; the few lines that hold a large share of all rows are
broadcast (their number is bounded by that share), the others joined by hash.
Only hashes and positions are shuffled for the decision; the text moves once, to
meet its dropped positions.

Results in special cases: null or empty text is one empty line and is kept; keys
under ``min_chars`` code points are never dropped; repeated rows (same id and
text) are treated alike and count as one document; a null id counts as the
largest; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stressframe.session import cut_lineage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"
LAST_ID = (1 << 63) - 1
HOT_KEYS = 1000


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    core = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(core) == F.char_length(core)
    return F.when(ascii_only, F.lower(core)).otherwise(F.translate(core, UPPER, UPPER.lower()))


def dropped_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, max_docs: int) -> DataFrame:
    """(_d, _t, _pos array): positions of the lines to drop in each document.

    ``_d`` is the id (null as the largest), ``_t`` a hash of the text that tells
    rows with one id apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = (
        docs.select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_d"),
            F.xxhash64(text).alias("_t"),
            F.split(text, "\n", -1).alias("_l"),
        )
        .select("_d", "_t", F.posexplode("_l").alias("_p", "_line"))
        .select("_d", "_t", "_p", line_key(F.col("_line")).alias("_k"))
        .where(F.char_length("_k") >= min_chars)
        .select("_d", "_t", "_p", F.xxhash64("_k").alias("_a"), F.xxhash64(F.lit(min_chars), "_k").alias("_b"))
    )
    lines = cut_lineage(lines)
    frequent = cut_lineage(
        lines.select("_a", "_b", "_d")
        .distinct()
        .groupBy("_a", "_b")
        .agg(F.count("*").alias("_n"), F.min("_d").alias("_first"))
        .where(F.col("_n") > max_docs)
    )
    # fewer than HOT_KEYS keys can hold more than this share of the rows each: they are
    # broadcast, so that no key gathers more than that share in one task of the other join
    share = lines.count() / HOT_KEYS
    hot = F.broadcast(frequent.where(F.col("_n") > share).select("_a", "_b", "_first"))
    cold = frequent.where(F.col("_n") <= share).select("_a", "_b", "_first")
    found = lines.join(hot, ["_a", "_b"]).unionAll(lines.join(hot.drop("_first"), ["_a", "_b"], "left_anti").join(cold, ["_a", "_b"]))
    return found.where(F.col("_d") > F.col("_first")).groupBy("_d", "_t").agg(F.collect_set("_p").alias("_pos"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, max_docs: int = 1, counts: bool = True
) -> DataFrame:
    """``docs`` with the text left after dropping, and with ``counts`` also n_lines and
    n_dropped (in place of columns of these names).

    A key of at least ``min_chars`` code points in more than ``max_docs``
    documents loses its lines everywhere but in the smallest id that holds it."""
    drop = dropped_lines(docs, id_col, text_col, min_chars, max_docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    left = docs.select(
        F.struct("*").alias("_row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_d"),
        F.xxhash64(text).alias("_t"),
    )
    both = left.join(drop, ["_d", "_t"], "left").select(
        "_row", F.coalesce("_pos", F.array().cast("array<int>")).alias("_pos")
    )
    whole = F.coalesce(F.col(f"_row.`{text_col}`"), F.lit(""))
    split = both.select("_row", "_pos", F.split(whole, "\n", -1).alias("_l"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_l") - 1), F.col("_pos"))
    new = {text_col: F.array_join(F.transform(kept, lambda i: F.element_at("_l", i + 1)), "\n")}
    if counts:
        new |= {"n_lines": F.size("_l").cast("long"), "n_dropped": F.size("_pos").cast("long")}
    names = [*docs.columns, *(c for c in new if c not in docs.columns)]
    return split.select(*(new[c].alias(c) if c in new else F.col(f"_row.`{c}`").alias(c) for c in names))
