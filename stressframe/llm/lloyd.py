"""Vector code compression by active-entry Lloyd rounds (operator 11).

Vectors become integers, are cut into equal parts and every part is coded by the
nearest entry of its position's codebook.  A round assigns all parts and replaces
every entry by the floored mean of its parts.  From the second assignment on a
part whose entry did not move compares only the *moved* entries against its stored
exact distance (the unmoved ones lost to its entry before and lie where they were);
a part whose entry moved is compared with all entries.  Ties go to the lower index
in both cases, so the result equals that of complete rescans.

Spark holds the rows: an assignment is one pass over the table written by the one
before (integers, codes, distances), the means are grouped sums of per-task partial
sums.  Only codebooks (parts x entries x width numbers) reach the driver.

Results in special cases: rows whose vector is null, empty, holds null or non-finite
components, or has another length than that of the smallest kept id are dropped; a
length that is no multiple of ``parts`` is an error; with fewer rows than ``entries``
the codebooks have as many entries as rows; repeated rows are coded alike and each
counts in the means; null ids sort last, equal ids by their vectors; components so
large that a squared distance does not fit 62 bits are an error; an empty table gives
an empty result.  Only the named columns are read, so others may clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stressframe.llm.vectors import matrix, raw_column, raw_matrix, stored, usable


def to_integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), checked so that all squared distances fit 62 bits."""
    v = np.floor(x * scale)
    if v.size and 4.0 * float(np.abs(v).max()) ** 2 * v.shape[1] >= 2.0**62:
        raise ArithmeticError("components too large: squared distances would not fit a long")
    return v.astype(np.int64)


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all entries."""
    most = max(float(np.abs(x).max(initial=0)), float(np.abs(entries).max(initial=0)))
    if 4 * most * most * x.shape[1] < 2.0**52:  # every value below stays an exact double
        x, entries = x.astype(np.float64), entries.astype(np.float64)
    d = (x * x).sum(1)[:, None] + (entries * entries).sum(1) - 2 * (x @ entries.T)
    return d.astype(np.int64)


def assign(x: np.ndarray, books: np.ndarray, before=None):
    """(codes, distances) of all parts of the rows ``x`` (rows, parts, width).

    ``before``: (codes, distances, moved (parts, entries) bool) of the last
    assignment, when only some entries have moved since."""
    n, parts, _ = x.shape
    codes, dist = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64)
    for p in range(parts):
        book = books[p]
        if before is None:
            again = np.ones(n, bool)
        else:
            codes[:, p], dist[:, p] = before[0][:, p], before[1][:, p]
            moved = before[2][p]
            again = moved[codes[:, p]]
            active, rest = np.flatnonzero(moved), np.flatnonzero(~again)
            if len(active) and len(rest):
                d = _distances(x[rest, p], book[active])
                best = d.argmin(1)
                near, entry = d[np.arange(len(rest)), best], active[best]
                own, at = dist[rest, p], codes[rest, p]
                wins = (near < own) | ((near == own) & (entry < at))
                codes[rest[wins], p], dist[rest[wins], p] = entry[wins], near[wins]
        rows = np.flatnonzero(again)
        if len(rows):
            d = _distances(x[rows, p], book)
            codes[rows, p] = d.argmin(1)
            dist[rows, p] = d.min(1)
    return codes, dist


def _state_columns(batch, x, codes, dist) -> list:
    return [*batch, raw_column(x.reshape(len(x), -1).astype(np.int32)), raw_column(codes.astype(np.uint8)), raw_column(dist)]


def _first_pass(books: np.ndarray, scale: int, names):
    parts = len(books)

    def run(batches):
        for batch in batches:
            x = to_integers(matrix(batch.column(2)), scale).reshape(len(batch), parts, -1)
            codes, dist = assign(x, books)
            yield pa.RecordBatch.from_arrays(_state_columns(batch.columns[:2], x, codes, dist), names)

    return run


def _read_state(batch, parts: int):
    x = raw_matrix(batch.column("x"), np.int32).astype(np.int64).reshape(len(batch), parts, -1)
    return x, raw_matrix(batch.column("codes"), np.uint8).astype(np.int64), raw_matrix(batch.column("dist"), np.int64)


def _next_pass(books: np.ndarray, moved: np.ndarray, names, last: bool):
    parts = len(books)

    def run(batches):
        for batch in batches:
            x, codes, dist = _read_state(batch, parts)
            codes, dist = assign(x, books, (codes, dist, moved))
            if last:
                hexes = pa.array([bytes(c).hex() for c in codes.astype(np.uint8)], pa.string())
                columns = [batch.column(0), batch.column(1), hexes, pa.array(dist.sum(1), pa.int64())]
            else:
                columns = _state_columns(batch.columns[:2], x, codes, dist)
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _sums(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Exact component sums and, last, part counts of every entry: (parts, entries, width + 1)."""
    parts, entries, width = books.shape

    def run(batches):
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            x, codes, _ = _read_state(batch, parts)
            for p in range(parts):
                np.add.at(total[p, :, :width], codes[:, p], x[:, p])
                total[p, :, width] += np.bincount(codes[:, p], minlength=entries)
        at = np.flatnonzero(total.any(2).ravel())
        yield pa.RecordBatch.from_pydict(
            {
                "slot": pa.array(at, pa.int64()),
                "sums": pa.array(list(total.reshape(-1, width + 1)[at]), pa.list_(pa.int64())),
            }
        )

    cells = state.mapInArrow(run, "slot long, sums array<long>").select("slot", F.posexplode("sums").alias("k", "v"))
    out = np.zeros((parts * entries, width + 1), object)
    for slot, k, v in cells.groupBy("slot", "k").agg(F.sum(F.col("v").cast("decimal(38,0)"))).collect():
        out[slot, k] = int(v)
    return out.reshape(parts, entries, width + 1)


def moved_books(books: np.ndarray, sums: np.ndarray):
    """The next codebooks (floored means; unused entries stay) and which entries changed."""
    new = books.copy()
    for p, e in zip(*np.nonzero(sums[:, :, -1])):
        n = sums[p, e, -1]
        new[p, e] = [s // n for s in sums[p, e, :-1]]
    return new, (new != books).any(2)


def first_books(vectors: DataFrame, id_col: str, vec_col: str, parts: int, entries: int, scale: int):
    """Codebooks from the ``entries`` smallest kept ids (and the kept length), or None."""
    fine = vectors.where(usable(F.col(vec_col))).select(F.col(id_col).alias("i"), F.col(vec_col).cast("array<double>").alias("v"))
    in_order = (F.col("i").asc_nulls_last(), "v")
    first = fine.orderBy(*in_order).limit(1).collect()
    if not first:
        return None
    size = len(first[0].v)
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    fine = fine.where(F.size("v") == size)
    ids = fine.select("i").orderBy(F.col("i").asc_nulls_last()).limit(entries).collect()  # each task offers ids alone
    low = fine.where(F.col("i") <= F.lit(ids[-1].i)) if ids[-1].i is not None else fine
    rows = low.orderBy(*in_order).limit(entries).collect()
    x = to_integers(np.array([r.v for r in rows]), scale)
    return x.reshape(len(rows), parts, size // parts).transpose(1, 0, 2).copy(), size


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
) -> tuple[DataFrame, np.ndarray | None]:
    """(id, label, code, error) of every kept row, and the final codebooks (parts, entries, width).

    ``entries`` up to 256, so that a code is one byte a part."""
    if not 1 <= entries <= 256 or rounds < 0:
        raise ValueError("entries must be 1 to 256, rounds 0 or more")
    kinds = ", ".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in (id_col, label_col))
    start = first_books(vectors, id_col, vec_col, parts, entries, scale)
    final = [id_col, label_col, "code", "error"]
    if start is None:
        empty = vectors.select(id_col, label_col, F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.where("false"), None
    books, size = start
    names = [id_col, label_col, "x", "codes", "dist"]
    fine = vectors.where(usable(F.col(vec_col)) & (F.size(vec_col) == size)).select(id_col, label_col, vec_col)
    state = stored(fine.mapInArrow(_first_pass(books, scale, names), f"{kinds}, x binary, codes binary, dist binary"), "lloyd")
    moved = np.zeros(books.shape[:2], bool)
    for k in range(rounds):
        books, moved = moved_books(books, _sums(state, books))
        if k + 1 < rounds:
            state = stored(state.mapInArrow(_next_pass(books, moved, names, False), state.schema), "lloyd")
    return state.mapInArrow(_next_pass(books, moved, final, True), f"{kinds}, code string, error long"), books


def codes_with_errors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", **kw) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every kept row.

    ``label_error``: error summed over the rows of the same label, nulls together."""
    coded, books = compress(vectors, id_col, vec_col, label_col, **kw)
    if books is not None:
        coded = stored(coded, "lloyd")
    total = coded.groupBy(F.col(label_col).alias("_l")).agg(F.sum("error").alias("label_error"))
    both = coded.join(total, F.col(label_col).eqNullSafe(F.col("_l")))
    sha = F.lit("" if books is None else digest(books)).alias("codebooks_sha256")
    return both.select(id_col, "code", "error", "label_error", sha)
