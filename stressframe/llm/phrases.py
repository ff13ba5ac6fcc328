"""Document fingerprints by locally consistent parsing (operator 6).

Level by level, a text's symbols are cut into short phrases at positions that
depend only on a few neighbours: runs of equal symbols collapse (to one of their
length's power of two), deterministic
coin tossing turns the names into small labels that differ from their left
neighbour's, and local maxima of those labels start new phrases.  A phrase is
named by a hash of its symbols' names, so equal substrings get the same interior
names wherever they stand.  A fingerprint is the ``size`` smallest hashes of the
names of level 3 (about 27 bytes each; short texts add levels 2 and 1);
likeness is the share of names that two fingerprints have in common among the
smallest of both (an estimate of the Jaccard index, exact for small sets).

The next document is found without a global sort in one task: ids are cut into
buckets at quantiles, each bucket is read in id order as a stream, and the first
document of a bucket is also sent to the bucket before it (the very first to the
last).  Special cases: null or empty text has an empty fingerprint (alike 1.0 to
another empty one, 0.0 to others); a null id comes first; rows with one id are
ordered by a hash of their text; a single document is its own next document; an
empty table gives an empty result; texts of any length are read whole; other columns,
whatever their names, are not read; ids must be numbers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stressframe.llm.textvec import byte_codes, mix, powers

LEVEL, FEW = 3, 16
CHUNK_CHARS = 1_000_000
ROWS_PER_BUCKET = 4096
MAX_BUCKETS = 65_536  # more rows make longer buckets; nothing is left out


def _low_bit(z: np.ndarray) -> np.ndarray:
    """Position of the lowest set bit (z is not 0 where it matters)."""
    one = z.dtype.type(1)
    return np.bitwise_count((z & (~z + one)) - one)


def toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing: 2 * (lowest bit that differs from the left) + that bit."""
    left = np.empty_like(names)
    left[0] = 0
    left[1:] = names[:-1]
    p = _low_bit(names ^ left)
    p[first] = 0
    return (2 * p + ((names >> p.astype(names.dtype)) & names.dtype.type(1)).astype(np.uint8)).astype(np.uint8)


def next_level(names: np.ndarray, labels: np.ndarray, starts: np.ndarray, weights: np.ndarray):
    """Cut one level into phrases.  ``names``: 64-bit, ``labels``: what coin tossing
    starts from (equal names have equal labels), ``starts``: first symbol of each text."""
    n = len(names)
    border = np.zeros(n + 1, bool)
    border[starts] = True
    border[n] = True
    # runs of one name become one symbol that knows how many bits its length has
    head = np.ones(n, bool)
    head[1:] = (labels[1:] != labels[:-1]) | border[1:n]
    at = np.flatnonzero(head)
    if len(at) < n:
        bits = np.frexp(np.diff(np.append(at, n)).astype(np.float64))[1].astype(np.uint64)
        names = np.where(bits > 1, mix(names[at] + bits * weights[1]), names[at])
        labels = labels[at]
        first = border[:n][at]
    else:
        first = border[:n]
    k = len(names)
    for _ in range(4):
        labels = toss(labels, first)
    peak = np.zeros(k, bool)
    if k > 2:
        last = np.append(first[1:], True)
        peak[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
        peak &= ~last
        peak[1:] &= ~first[:-1]  # a phrase has two symbols or more
    cut = np.flatnonzero(peak | first)
    where = np.arange(k) - np.repeat(cut, np.diff(np.append(cut, k)))
    if k and where.max() >= len(weights):
        weights = powers(int(where.max()) + 1)[0]
    new = mix(np.add.reduceat(names * weights[where], cut))
    return new, np.searchsorted(cut, np.flatnonzero(first))


def sketches(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The ``size`` smallest 32-bit phrase hashes of each text, ascending."""
    full = [i for i, t in enumerate(texts) if t]
    out = [np.zeros(0, np.uint32)] * len(texts)
    if not full:
        return out
    data = np.frombuffer(b"".join(texts[i] for i in full), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(texts[i]) for i in full])])[:-1]
    weights = powers(64)[0]
    names, labels = byte_codes()[data], data
    levels = []
    for depth in range(LEVEL):
        names, starts = next_level(names, labels, starts, weights)
        labels = names
        levels.append((names, np.append(starts, len(names))))
    for j, i in enumerate(full):
        got: list[np.ndarray] = []
        total = 0
        for names, s in reversed(levels):
            got.append(names[s[j] : s[j + 1]])
            total += len(got[-1])
            if total >= FEW:
                break
        found = np.concatenate(got) if len(got) > 1 else got[0]
        found = np.unique((found >> np.uint64(32)).astype(np.uint32))
        out[i] = found[:size]
    return out


def likeness(a: np.ndarray, b: np.ndarray, size: int) -> float:
    if not len(a) and not len(b):
        return 1.0
    one, two = a.tolist(), set(b.tolist())
    both = [x for x in one if x in two]
    union = sorted(two.union(one))[:size]
    return sum(x <= union[-1] for x in both) / len(union)


def fingerprint_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 64) -> DataFrame:
    """One row per document: its fingerprint, that of its text with the last quarter
    taken from the next document, and its likeness to that text and to the next."""
    spark = docs.sparkSession
    first_id = -(1 << 63)
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(first_id)).alias("_k"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            *[T.StructField(c, T.LongType()) for c in ("n_chars",)],
            *[T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
            *[T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")],
        ]
    )
    keys = rows.select("_k")
    n = keys.count()
    if n == 0:
        return spark.createDataFrame([], schema)
    buckets = min(MAX_BUCKETS, -(-n // ROWS_PER_BUCKET))
    cuts = keys.approxQuantile("_k", [i / buckets for i in range(1, buckets)], 0.1 / buckets) if buckets > 1 else []
    cuts = np.unique(np.array(cuts, dtype=np.float64))

    @F.pandas_udf("int")
    def bucket(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy().astype(np.float64), side="right").astype(np.int32))

    firsts = sorted(keys.groupBy(bucket("_k").alias("_b")).agg(F.min("_k").alias("_f")).collect())
    before = {firsts[i]["_f"]: firsts[i - 1]["_b"] for i in range(len(firsts))}  # the first's is the last bucket

    @F.pandas_udf("int")
    def bucket_before(k: pd.Series) -> pd.Series:
        return k.map(before).astype("int32")

    own = rows.select(bucket("_k").alias("_b"), F.lit(0).alias("_more"), "*")
    heads = rows.where(F.col("_k").isin([r["_f"] for r in firsts]))
    heads = heads.select(bucket_before("_k").alias("_b"), F.lit(1).alias("_more"), "*")
    stream = (
        own.unionAll(heads)
        .withColumn("_h", F.xxhash64("_text"))
        .repartition("_b")
        .sortWithinPartitions("_b", "_more", "_k", "_h")
        .select("_b", "_more", "_id", "_text")
    )
    id_type = stream.schema["_id"].dataType

    def run(batches):
        names = [f.name for f in schema.fields]

        def result(part: list, following: str | None):
            """part: (id, text) in order; following: the text after the last one."""
            texts = [t for _, t in part]
            after = texts[1:] + [following if following is not None else ""]
            edited = []
            for t, nxt in zip(texts, after):
                q = len(t) // 4
                edited.append((t[: len(t) - q] + nxt[:q]).encode("utf-8"))
            marks = sketches([t.encode("utf-8") for t in [*texts, after[-1]]], size)
            changed = sketches(edited, size)
            cols = [
                [i for i, _ in part],
                [len(t) for t in texts],
                [hashlib.sha256(e).hexdigest() for e in edited],
                [m.astype(">u4").tobytes().hex() for m in marks[:-1]],
                [m.astype(">u4").tobytes().hex() for m in changed],
                [likeness(a, b, size) for a, b in zip(marks, changed)],
                [likeness(a, b, size) for a, b in zip(marks, marks[1:])],
            ]
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        kinds = None
        now, part, chars = None, [], 0  # bucket, rows that wait for the text after them
        for batch in batches:
            if kinds is None:
                kinds = [batch.schema.field(2).type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            for b, more, i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                t = t.as_py()
                if b != now:
                    if part:  # cannot happen: a bucket ends with the head of the next
                        yield result(part, None)
                    now, part, chars = b, [], 0
                if more:
                    if part:
                        yield result(part, t)
                    part, chars = [], 0
                    continue
                if part and chars >= CHUNK_CHARS:
                    yield result(part, t)
                    part, chars = [], 0
                part.append((i, t))
                chars += len(t)
        if part:
            yield result(part, None)

    assert id_type == schema[id_col].dataType
    return stream.mapInArrow(run, schema)
