"""Quality classifier: Bradley-Terry ranking from preference pairs (operator 1).

Every document becomes a short vector of text measures.  From labelled rows,
preference pairs (a document of label 1 over one of label 0) are drawn and the
weights learned by logistic loss on the *difference* of the two vectors, without
an intercept (Spark ML).  The score threshold is a quantile: the cut below which
the share of labelled rows equals the share of label 0.  Scores are moved so
that the cut maps to ``cut_score``.

Fitting uses every labelled row that may teach, with ``pairs_per_loser`` pairs per
row of label 0; ranks, pairs, moments and the cut are distributed, and only counts, the
weights and the cut reach the driver.  Special cases: null or empty text has
the measures of an empty text and a score like any other; if no pair can be
formed, every score is ``cut_score``; labels without a document, null labels
and repeated rows do no harm; equal hashes are ordered by id; texts of any
length are read whole; an empty table gives an empty result; other columns, whatever
their names, are not read (``keep_good`` returns them unchanged).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stressframe.llm.textvec import Roller, class_table, text_slices, word_spans
from stressframe.operators.prefix import running_totals
from stressframe.operators.quantile import quantile_map
from stressframe.session import cut_lineage

MEASURES = (
    "upper", "digit", "symbol", "bang", "space", "mean_word", "mark_words", "mark_ends", "again", "distinct", "top_word", "words", "line_words",
)
ROWS_PER_RANGE = 50_000  # about, of a range of hashes in which rows are ranked
SPACE = class_table([(0x20, 0x20), (0x09, 0x0D)])


def _letters(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


CLASSES = {
    "upper": class_table([(65, 90)]),
    "digit": class_table([(48, 57)]),
    "symbol": _letters("#$%&*+/<=>@\\^_`|~{}[]"),
    "bang": _letters("!?"),
    "space": SPACE,
}
MARKS = class_table([(0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)])


def measures(data: np.ndarray, offsets: np.ndarray, roller: Roller) -> np.ndarray:
    """Rows x MEASURES for the texts of one slice; all in bounded ranges, 0 for empty texts."""
    n = len(offsets) - 1
    out = np.zeros((n, len(MEASURES)))
    size = np.maximum(np.diff(offsets), 1)
    if not len(data):
        return out
    for j, table in enumerate(CLASSES.values()):
        c = np.concatenate([[0], np.cumsum(table[data], dtype=np.int32)])
        out[:, j] = (c[offsets[1:]] - c[offsets[:-1]]) / size
    c = np.concatenate([[0], np.cumsum(data == 10, dtype=np.int32)])
    lines = c[offsets[1:]] - c[offsets[:-1]] + 1
    start, end, row = word_spans(data, offsets, ~SPACE)
    if not len(start):
        return out
    words = np.bincount(row, minlength=n)
    some = np.maximum(words, 1)
    roller.load(data)
    h = roller.ranges(start, end)
    k = len(CLASSES)
    out[:, k] = np.minimum(np.bincount(row, end - start, n) / some, 20) / 10
    single = (end - start == 1) & MARKS[data[start]]
    out[:, k + 1] = np.bincount(row, single, n) / some
    tail = (end - start > 2) & MARKS[data[end - 1]] & MARKS[data[end - 2]]
    out[:, k + 2] = np.bincount(row, tail, n) / some
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    out[:, k + 3] = np.bincount(row, same, n) / some
    order = np.lexsort((h, row))
    hs, rs = h[order], row[order]
    head = np.ones(len(hs), bool)
    head[1:] = (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])
    at = np.flatnonzero(head)
    kinds = np.bincount(rs[at], minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, rs[at], np.diff(np.append(at, len(hs))))
    out[:, k + 4] = np.log1p(kinds) / np.log1p(some)
    out[:, k + 5] = most / some
    out[:, k + 6] = np.log1p(words) / 10
    out[:, k + 7] = np.minimum(lines / some, 1)
    return out


def add_measures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, _x array<double>), one row per document."""

    def run(batches):
        roller = Roller()
        for batch in batches:
            parts = [measures(data, offs, roller) for _, data, offs in text_slices(batch.column(1))]
            x = np.concatenate(parts) if parts else np.zeros((0, len(MEASURES)))
            flat = pa.array(x.ravel(), pa.float64())
            offs = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(MEASURES), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offs, flat)], names=[id_col, "_x"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, _x array<double>")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that never teach: crc32 of the id's text leaves 2 modulo 4 (a null id: not held out)."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def _dot(x: Column, weights: list[float]) -> Column:
    return sum((F.element_at(x, j + 1) * w for j, w in enumerate(weights)), F.lit(0.0))


def _ranked(known: DataFrame, n: int) -> DataFrame:
    """(_x, _y, _r): 0-based rank within the label in the order of the ids' hashes, by
    ranges of hashes, so that no task holds a whole label."""
    bits = max(1, math.ceil(math.log2(max(1.0, n / ROWS_PER_RANGE))))
    keyed = known.select("_x", "_y", "_id", F.xxhash64("_id").alias("_h"), F.lit(1).alias("_one"))
    keyed = keyed.withColumn("_range", F.shiftright("_h", 64 - bits))
    return running_totals(keyed, ["_h", "_id"], ["_one"], by=("_y",), bucket_col="_range").select("_x", "_y", (F.col("cum__one") - 1).alias("_r"))


def learn(known: DataFrame, pairs_per_loser: int, reg: float):
    """(weights, cut) from all rows of a stored table (_id, _x, _y); None if a label is missing."""
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    if not n0 or not n1:
        return None
    stats = known.select(*[F.stddev_pop(F.element_at("_x", j + 1)).alias(f"s{j}") for j in range(len(MEASURES))]).first()
    scale = [1.0 / s if s and s > 1e-9 else 0.0 for s in stats]
    ranked = _ranked(known, n0 + n1)
    losers = ranked.where("_y = 0").select(
        F.col("_x").alias("_low"),
        F.explode(F.sequence(F.lit(0), F.lit(pairs_per_loser - 1))).alias("_k"),
        "_r",
    ).select("_low", "_k", ((F.col("_r") * pairs_per_loser + F.col("_k")) % n1).alias("_w"))
    winners = ranked.where("_y = 1").select(F.col("_x").alias("_high"), F.col("_r").alias("_w"))
    sign = F.when(F.col("_k") % 2 == 0, 1.0).otherwise(-1.0)
    pairs = losers.join(winners, "_w").select(
        array_to_vector(
            F.array(*[(F.element_at("_high", j + 1) - F.element_at("_low", j + 1)) * sign * s for j, s in enumerate(scale)])
        ).alias("features"),
        ((sign + 1) / 2).alias("label"),
    )
    model = LogisticRegression(fitIntercept=False, standardization=False, regParam=reg, maxIter=50).fit(pairs)
    weights = [float(w) * s for w, s in zip(model.coefficients.toArray(), scale)]
    share = (n0 - 0.5) / (n0 + n1 - 1)
    return weights, quantile_map(known.select(_dot(F.col("_x"), weights).alias("_m")), ["_m"], share)["_m"]


def fit(vectors: DataFrame, labels: DataFrame, id_col: str, label_col: str, pairs_per_loser: int, reg: float):
    """``learn`` on all labelled rows that may teach."""
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    marked = marked.where(F.col("_y").isin(0, 1) & ~held_out("_id"))
    known = vectors.join(marked, vectors[id_col] == marked["_id"]).select("_id", "_x", "_y")
    return learn(cut_lineage(known), pairs_per_loser, reg)


def rate(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    pairs_per_loser: int = 8,
    reg: float = 1e-3,
    cut_score: float = 0.7,
) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``."""
    vectors = cut_lineage(add_measures(docs, id_col, text_col))
    model = fit(vectors, labels, id_col, label_col, pairs_per_loser, reg)
    shift = math.log(cut_score / (1 - cut_score))
    if model is None:
        score = F.lit(cut_score)
    else:
        margin = _dot(F.col("_x"), model[0]) - model[1] + shift
        score = 1.0 / (1.0 + F.exp(-F.greatest(F.least(margin, F.lit(500.0)), F.lit(-500.0))))
    return vectors.select(id_col, held_out(id_col).alias("held_out"), score.cast("double").alias("score")).withColumn(
        "predicted", (F.col("score") >= cut_score).cast("int")
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    pairs_per_loser: int = 8,
    reg: float = 1e-3,
) -> DataFrame:
    """The rows of ``docs`` whose score reaches the cut, with all their columns, unshuffled."""
    model = fit(add_measures(docs, id_col, text_col), labels, id_col, label_col, pairs_per_loser, reg)
    if model is None:
        return docs
    weights, cut = np.array(model[0]), model[1]
    at = docs.columns.index(text_col)

    def run(batches):
        roller = Roller()
        for batch in batches:
            good = [measures(data, offs, roller) @ weights >= cut for _, data, offs in text_slices(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate(good) if good else np.zeros(0, bool)))

    return docs.mapInArrow(run, docs.schema)
