"""Gradient-boosted trees on every labelled row (MOD-1..3, MOD-5, MOD-10).

Cross-validation and searches make many fits of many rounds on the same table.  Spark
ML's GBT pays one job chain per tree, so here a fit whose rows come to at most
``TASK_CELLS`` bin codes is one Spark task: it reads its rows batch by batch, keeps one
byte per row and feature, and fits run side by side on the executors.  A larger fit keeps
its rows in blocks on the executors: a pass over them sums the histograms of all nodes
that may be split next, Spark brings the sums of a node together and the splits alone
come back (``fit_blocks``).  Both grow the same trees, and the rows' order and blocks
follow from their hashes, whatever the partitioning.  The fitted model is a Spark ML
transformer that scores every row of any table with its columns.

Trees are grown leaf by leaf on histograms of first and second derivatives of
the logistic loss, with the usual controls: rounds, rate, depth, leaves, rows
and weight per child, L1 / L2, least gain, row and column sampling, weight of
positives, and a patience in rounds on a validation set (the best round is kept).
"""

from __future__ import annotations

import heapq
import json
import math
import threading
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COUNTED_ROWS = 50_000  # up to so many rows bins come from all values, beyond from quantiles of all rows
TASK_CELLS = 24_000_000  # rows x features of a fit in one task
BLOCK_ROWS = 500_000  # of a block of a larger fit; their number and places follow from the rows alone
SUMMED_ROWS, STEPS = 250_000, 2_048  # of a summary of values; its steps of rank
FEW_ROWS = 4096  # of a leaf whose columns are summed together
CHUNK_ROWS = 1 << 16  # summed at a time: they stay in a core's cache
KEEP_ROUNDS = 50  # rounds after which margins are stored: no lineage is longer
WIDE = threading.Semaphore(2)  # larger fits at a time: each one's tasks fill the cores
SEED = 42


@dataclass(frozen=True)
class Boost:
    rounds: int = 100
    rate: float = 0.1
    depth: int = 0  # 0: no limit
    leaves: int = 0  # 0: 2 ** depth
    min_rows: int = 1
    min_weight: float = 1e-3
    l1: float = 0.0
    l2: float = 0.0
    gain: float = 0.0
    row_rate: float = 1.0
    col_rate: float = 1.0
    pos_weight: float = 1.0
    patience: int = 0  # 0: all rounds
    metric: str = "auc"  # of the patience: auc or loss
    bins: int = 255


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Upper edges of at most ``bins`` bins per column (all distinct values where few)."""
    out = []
    for j in range(x.shape[1]):
        v = np.unique(x[:, j])
        if len(v) > bins:
            v = np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:], method="lower"))
        out.append(v)
    return out


def auc(y: np.ndarray, score: np.ndarray) -> float:
    """Area under the ROC curve with mean ranks for ties."""
    _, group, count = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[group]
    pos = int(y.sum())
    neg = len(y) - pos
    return float((rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)) if pos and neg else 0.5


def _strength(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0) if l1 else g


def leaf_value(g, h, p: Boost) -> float:
    return float(-p.rate * _strength(g, p.l1) / (h + p.l2 + 1e-12))


def best_split(hist: np.ndarray, use: np.ndarray, p: Boost):
    """(gain, column, bin) of the best split of a leaf's (sums, columns, bins), or None."""
    cols = np.flatnonzero(use)
    left = np.cumsum(hist if len(cols) == len(use) else hist[:, cols], axis=2)
    total = np.cumsum(hist[:, :1], axis=2)[:, :, -1:]
    right = total - left
    score = lambda s: _strength(s[0], p.l1) ** 2 / (s[1] + p.l2 + 1e-12)
    gain = (score(left) + score(right) - score(total)) / 2
    bad = np.minimum(left[1], right[1]) < p.min_weight
    if p.min_rows > 1:
        bad |= np.minimum(left[2], right[2]) < p.min_rows
    gain[bad] = -np.inf
    k, bins = int(gain.argmax()), hist.shape[2]
    best = float(gain.flat[k])
    return (best, int(cols[k // bins]), k % bins) if best > max(p.gain, 1e-9) else None


def column_sums(codes: np.ndarray, rows, at, weights: list, size: int, counts: bool) -> np.ndarray:
    """(sums, columns, ``size``): of each weight, and rows where ``counts``, by code plus ``at``
    (of every row, or None), for ``rows`` (None: all) of the codes (columns, rows)."""
    n = codes.shape[1] if rows is None else len(rows)
    if n <= FEW_ROWS:  # one call for all columns
        key = (codes if rows is None else codes[:, rows]) + (np.arange(len(codes)) * size)[:, None]
        key = (key if at is None else key + at).ravel()
        sums = [np.bincount(key, np.tile(w, len(codes)), len(codes) * size) for w in weights]
        if counts:
            sums.append(np.bincount(key, minlength=len(codes) * size))
        return np.stack(sums).reshape(len(sums), len(codes), size).astype(np.float64, copy=False)
    out = np.zeros((len(weights) + counts, len(codes), size))
    for s in range(0, n, CHUNK_ROWS):
        part = slice(s, min(s + CHUNK_ROWS, n))
        own = part if rows is None else rows[part]
        of = [w[part] for w in weights]
        for j, column in enumerate(codes):
            key = column[own].astype(np.intp)
            if at is not None:
                key += at[part]
            for k, w in enumerate(of):
                out[k, j] += np.bincount(key, w, size)
            if counts:
                out[-1, j] += np.bincount(key, minlength=size)
    return out


class _Grower:
    """One tree on binned rows (columns, rows): histograms per open leaf, best split first."""

    def __init__(self, codes: np.ndarray, p: Boost):
        self.p, (self.cols, self.n) = p, codes.shape
        self.bins = int(codes.max()) + 1 if codes.size else 1
        self.codes = codes

    def _hist(self, rows, g, h, last=False):
        """Sums of g, h and (where rows per child are limited) rows, by column and bin;
        ``last``: of the first column alone, for leaves that are not split any more."""
        every = len(rows) == self.n
        codes = self.codes[:1] if last else self.codes
        weights = [g, h] if every else [g[rows], h[rows]]
        return column_sums(codes, None if every else rows, None, weights, self.bins, self.p.min_rows > 1)

    def _best(self, hist, use):
        return best_split(hist, use, self.p)

    def grow(self, rows, g, h, use):
        """(nodes, leaf rows): node = [column, bin, left, right, value, gain]."""
        p, nodes, heap, leaves = self.p, [], [], {}
        limit = p.leaves or (1 << p.depth if p.depth else 1 << 30)

        def leaf(rows_, hist, depth):
            k = len(nodes)
            s = hist[:, 0, :].sum(axis=1)
            nodes.append([-1, 0, 0, 0, leaf_value(s[0], s[1], p), 0.0])
            leaves[k] = rows_
            split = self._best(hist, use) if not p.depth or depth < p.depth else None
            if split:
                heapq.heappush(heap, (-split[0], k, split, hist, depth))

        leaf(rows, self._hist(rows, g, h), 0)
        while heap and len(leaves) < limit:
            _, k, (gain, col, b), hist, depth = heapq.heappop(heap)
            own = leaves.pop(k)
            goes = self.codes[col][own] <= b
            left_small = 2 * np.count_nonzero(goes) <= len(own)
            last = bool(p.depth) and depth + 1 >= p.depth
            part = self._hist(own[goes] if left_small else own[~goes], g, h, last)
            hist = hist[:, :1] if last else hist
            first, second = (part, hist - part) if left_small else (hist - part, part)
            nodes[k][:4], nodes[k][5] = [col, b, len(nodes), len(nodes) + 1], gain
            leaf(own[goes], first, depth + 1)
            leaf(own[~goes], second, depth + 1)
        return nodes, leaves


def walk(nodes: dict[str, np.ndarray], x: np.ndarray, key: str) -> np.ndarray:
    """Leaf values of one tree; ``key`` is 'bin' for codes, 'cut' for raw values."""
    at = np.zeros(len(x), np.int32)
    rows = np.arange(len(x))
    while True:
        col = nodes["col"][at[rows]]
        rows, col = rows[col >= 0], col[col >= 0]
        if not len(rows):
            return nodes["value"][at]
        k = at[rows]
        at[rows] = np.where(x[rows, col] <= nodes[key][k], nodes["left"][k], nodes["right"][k])


def walk_codes(nodes, codes: np.ndarray, rows=None) -> np.ndarray:
    """The last node of every row (or of ``rows``) of the codes (columns, rows)."""
    at = np.zeros(codes.shape[1] if rows is None else len(rows), np.int32)
    todo = np.arange(len(at))
    while len(todo):
        col = nodes["col"][at[todo]]
        todo, col = todo[col >= 0], col[col >= 0]
        k = at[todo]
        at[todo] = np.where(codes[col, todo if rows is None else rows[todo]] <= nodes["bin"][k], nodes["left"][k], nodes["right"][k])
    return at


def coded(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin codes (columns, rows) of rows."""
    return np.stack([np.minimum(np.searchsorted(e, x[:, j]), len(e) - 1) for j, e in enumerate(edges)]).astype(np.uint8)


def base_score(positive: float, whole: float) -> float:
    """Log odds of the share of positive weight."""
    share = min(max(positive / whole, 1e-6), 1 - 1e-6)
    return float(np.log(share / (1 - share)))


def drawn_columns(rng, width: int, p: Boost) -> np.ndarray:
    use = np.ones(width, bool)
    if p.col_rate < 1:
        use[:] = False
        use[rng.permutation(width)[: max(1, round(p.col_rate * width))]] = True
    return use


def as_tree(nodes: list, edges: list[np.ndarray]) -> dict:
    n = np.array(nodes, dtype=np.float64)
    tree = {"col": n[:, 0].astype(np.int32), "bin": n[:, 1], "left": n[:, 2].astype(np.int32), "right": n[:, 3].astype(np.int32), "value": n[:, 4], "gain": n[:, 5]}
    tree["cut"] = np.array([edges[int(c)][int(b)] if c >= 0 else 0.0 for c, b in n[:, :2]])
    return tree


def as_model(base: float, trees: list[dict], width: int) -> dict:
    gains = np.zeros(width)
    for t in trees:
        inner = t["col"] >= 0
        np.add.at(gains, t["col"][inner], t["gain"][inner])
    keep = ("col", "cut", "left", "right", "value")
    return {"base": base, "trees": [{k: t[k].tolist() for k in keep} for t in trees], "gains": gains.tolist(), "rounds": len(trees)}


class _Patience:
    """The best round so far, and whether it lies too far back."""

    def __init__(self, p: Boost):
        self.p, self.best, self.round = p, -np.inf, 0

    def over(self, r: int, now: float) -> bool:
        if now > self.best + (0.0 if self.p.metric == "auc" else 1e-4):
            self.best, self.round = now, r
            return False
        return r - self.round >= self.p.patience


def fit_arrays(x, y, p: Boost, x_valid=None, y_valid=None, seed: int = SEED) -> dict:
    """Boosted trees as plain lists: base score, trees, summed gain per column, rounds kept."""
    edges = bin_edges(x, p.bins)
    valid = (None, None) if x_valid is None else (coded(x_valid, edges), y_valid)
    return fit_codes(coded(x, edges), y, edges, p, *valid, seed)


def fit_codes(codes, y, edges, p: Boost, codes_v=None, y_valid=None, seed: int = SEED) -> dict:
    """The same from bin codes (columns, rows)."""
    y = y.astype(np.float64)
    w = np.where(y == 1, p.pos_weight, 1.0)
    base = base_score(float((w * y).sum()), float(w.sum()))
    raw = np.full(len(y), base)
    watch = p.patience and codes_v is not None and len(y_valid)
    if watch:
        raw_v = np.full(len(y_valid), base)
    rng, grower = np.random.default_rng(seed), _Grower(codes, p)
    trees, waiting = [], _Patience(p)
    for r in range(p.rounds):
        q = 1.0 / (1.0 + np.exp(-raw))
        g, h = w * (q - y), w * q * (1 - q)
        rows = np.arange(len(y)) if p.row_rate >= 1 else np.sort(rng.permutation(len(y))[: max(1, round(p.row_rate * len(y)))])
        nodes, leaves = grower.grow(rows, g, h, drawn_columns(rng, len(codes), p))
        tree = as_tree(nodes, edges)
        trees.append(tree)
        for k, own in leaves.items():
            raw[own] += tree["value"][k]
        if len(rows) < len(y):
            others = np.ones(len(y), bool)
            others[rows] = False
            others = np.flatnonzero(others)
            raw[others] += tree["value"][walk_codes(tree, codes, others)]
        if watch:
            raw_v += tree["value"][walk_codes(tree, codes_v)]
            now = auc(y_valid, raw_v) if p.metric == "auc" else -float(np.mean(np.logaddexp(0, raw_v) - y_valid * raw_v))
            if waiting.over(r, now):
                break
    if watch:
        trees = trees[: waiting.round + 1]
    return as_model(base, trees, len(codes))


class Scorer:
    """Margins of a fitted model for many rows at once.

    Every cut that a row exceeds rules out the leaves left of it; what all cuts leave is
    a set of leaves per tree whose leftmost is the row's.  The sets are bits of one word,
    stored per feature and interval between its cuts, so a row costs one table row per
    feature instead of a walk per tree.  Trees of more than 64 leaves are walked."""

    WORDS = ((8, np.uint8), (16, np.uint16), (32, np.uint32), (64, np.uint64))
    TREES, ROWS = 128, 512  # of a block: tables and sets stay in a core's cache

    def __init__(self, model: dict):
        kinds = {"col": np.int32, "left": np.int32, "right": np.int32, "cut": np.float64, "value": np.float64}
        trees = [{k: np.array(t[k], d) for k, d in kinds.items()} for t in model["trees"]]
        sizes = [int((t["col"] < 0).sum()) for t in trees]
        self.base, self.walked, self.blocks = model["base"], [t for t, n in zip(trees, sizes) if n > 64], []
        low = 0
        for high, word in self.WORDS:
            own = [t for t, n in zip(trees, sizes) if low < n <= high]
            self.blocks += [self._block(own[i : i + self.TREES], high, word) for i in range(0, len(own), self.TREES)]
            low = high

    @staticmethod
    def _block(trees, leaves, word):
        """(cuts per column, leaf sets per column and interval, leaf values)."""
        values, found = np.zeros((len(trees), leaves)), {}
        for t, tree in enumerate(trees):
            ends, order, stack = {}, 0, [(0, False)]
            while stack:  # leaves numbered from left to right; ends: first leaf right of a node
                k, done = stack.pop()
                if tree["col"][k] < 0:
                    values[t, order] = tree["value"][k]
                    ends[k] = (order, order + 1)
                    order += 1
                elif done:
                    first, middle = ends[tree["left"][k]]
                    ends[k] = (first, ends[tree["right"][k]][1])
                    gone = ((1 << (middle - first)) - 1) << first
                    found.setdefault(int(tree["col"][k]), []).append((tree["cut"][k], t, ~gone & ((1 << leaves) - 1)))
                else:
                    stack += [(k, True), (tree["right"][k], False), (tree["left"][k], False)]
        tables = []
        for col, nodes in sorted(found.items()):
            cuts = np.unique([c for c, _, _ in nodes])
            left = np.full((len(cuts) + 1, len(trees)), np.iinfo(word).max, word)
            at = np.searchsorted(cuts, [c for c, _, _ in nodes]) + 1
            np.bitwise_and.at(left, (at, [t for _, t, _ in nodes]), np.array([m for _, _, m in nodes], word))
            tables.append((col, cuts, np.bitwise_and.accumulate(left, axis=0)))
        return tables, values.ravel(), np.arange(len(trees)) * leaves, np.full(len(trees), np.iinfo(word).max, word)

    def margins(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.base)
        for tables, values, first, every in self.blocks:
            codes = [np.searchsorted(cuts, x[:, col]) for col, cuts, _ in tables]
            one = every.dtype.type(1)
            left, sets_of = (np.empty((self.ROWS, len(every)), every.dtype) for _ in range(2))
            for s in range(0, len(x), self.ROWS):
                n = min(self.ROWS, len(x) - s)
                own, other = left[:n], sets_of[:n]
                own[:] = every
                for code, (_, _, sets) in zip(codes, tables):
                    np.bitwise_and(own, np.take(sets, code[s : s + n], axis=0, out=other, mode="clip"), out=own)
                np.subtract(own, one, out=other)
                np.bitwise_and(other, np.invert(own, out=own), out=other)  # ones below the lowest bit
                raw[s : s + n] += values[np.bitwise_count(other) + first].sum(1)
        for t in self.walked:
            raw += walk(t, x, "cut")
        return raw

    def swapped(self, x: np.ndarray, other: np.ndarray) -> np.ndarray:
        """(columns, rows): the margins of ``x`` with each column in turn taken from ``other``.
        A row's sets are looked up once for all columns: what the others leave is an AND from the
        left and one from the right, and only trees that cut the column get another leaf."""
        raw = np.full((x.shape[1], len(x)), self.base)
        for tables, values, first, every in self.blocks:
            one = every.dtype.type(1)
            users = [np.flatnonzero((sets != every).any(axis=0)) for _, _, sets in tables]
            of_users = [np.ascontiguousarray(sets[:, u].T) for (_, _, sets), u in zip(tables, users)]  # a row per tree
            codes, codes_other = ([np.searchsorted(cuts, v[:, col]) for col, cuts, _ in tables] for v in (x, other))
            unused = np.setdiff1d(np.arange(len(raw)), [col for col, _, _ in tables])

            def leaf_values(left, start):
                low = (left - one) & ~left  # ones below the lowest bit
                return np.take(values, np.bitwise_count(low) + start[:, None])

            for s in range(0, len(x), self.ROWS):
                at = slice(s, min(s + self.ROWS, len(x)))
                own = [np.take(sets, code[at], axis=1) for sets, code in zip(of_users, codes)]
                left, after = np.repeat(every[:, None], at.stop - s, axis=1), []
                for sets, u in zip(own[::-1], users[::-1]):
                    after.append(left[u])
                    left[u] = after[-1] & sets
                found = leaf_values(left, first)
                raw[unused, at] += found.sum(0)
                left[:] = every[:, None]
                for (col, _, _), u, sets, new, code, rest in zip(tables, users, own, of_users, codes_other, after[::-1]):
                    before, kept = left[u], found[u]
                    found[u] = leaf_values(before & rest & np.take(new, code[at], axis=1), first[u])
                    raw[col, at] += found.sum(0)
                    found[u] = kept
                    left[u] = before & sets
        for t in self.walked:
            plain = walk(t, x, "cut")
            for col in range(len(raw)):
                if (t["col"] == col).any():
                    mixed = x.copy()
                    mixed[:, col] = other[:, col]
                    raw[col] += walk(t, mixed, "cut")
                else:
                    raw[col] += plain
        return raw


class BoostModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``pv_<name>`` (class probabilities as a vector) and ``pd_<name>`` to a frame with ``features``."""

    name = Param(Params._dummy(), "name", "suffix of the output columns", TypeConverters.toString)
    payload = Param(Params._dummy(), "payload", "trees as JSON", TypeConverters.toString)

    def __init__(self, name: str = "boost", payload: str = "{}"):
        super().__init__()
        self._set(name=name, payload=payload)

    @property
    def rounds(self) -> int:
        return json.loads(self.getOrDefault(self.payload))["rounds"]

    @property
    def featureImportances(self):
        """Total gain per feature."""
        return Vectors.dense(json.loads(self.getOrDefault(self.payload))["gains"])

    def _transform(self, df: DataFrame) -> DataFrame:
        name, payload = self.getOrDefault(self.name), self.getOrDefault(self.payload)
        sent = df.sparkSession.sparkContext.broadcast(payload)
        ready: dict = {}

        @F.arrow_udf("double")
        def positive(x: pa.Array) -> pa.Array:
            if not ready:
                ready["scorer"] = Scorer(json.loads(sent.value))
            if not len(x):
                return pa.array([], pa.float64())
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            return pa.array(1.0 / (1.0 + np.exp(-ready["scorer"].margins(rows))))

        p = positive(vector_to_array(F.col("features")))
        out = df.withColumn(f"_p_{name}", p)
        return out.select(
            *df.columns,
            array_to_vector(F.array(1.0 - F.col(f"_p_{name}"), F.col(f"_p_{name}"))).alias(f"pv_{name}"),
            (F.col(f"_p_{name}") > 0.5).cast("double").alias(f"pd_{name}"),
        )

    def swapped(self, df: DataFrame, own: str, other: str, output: str) -> DataFrame:
        """``df`` with an array: the probability of class 1 of the vector ``own`` with each entry
        in turn taken from the vector ``other``."""
        sent = df.sparkSession.sparkContext.broadcast(self.getOrDefault(self.payload))
        ready: dict = {}

        @F.arrow_udf("array<double>")
        def positive(x: pa.Array, y: pa.Array) -> pa.Array:
            if not ready:
                ready["scorer"] = Scorer(json.loads(sent.value))
            if not len(x):
                return pa.array([], pa.list_(pa.float64()))
            a, b = (v.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) for v in (x, y))
            p = (1.0 / (1.0 + np.exp(-ready["scorer"].swapped(a, b)))).T
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))

        return df.withColumn(output, positive(vector_to_array(F.col(own)), vector_to_array(F.col(other))))


def labelled_rows(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, _h, _x, _y): every labelled row with its hash, what fits read."""
    rows = df.where(F.col(label).isNotNull()).select(*by, vector_to_array(F.col("features")).alias("_x"), F.col(label).cast("double").alias("_y"))
    return rows.select(*by, F.xxhash64("_x", "_y").alias("_h"), "_x", "_y")


def sample_rows(df: DataFrame, label: str, by: tuple[str, ...], limit: int) -> DataFrame:
    """``labelled_rows`` of each group with the smallest hash, at most ``limit``, stored; for
    looks at a table, no fit reads it.  Approximate quantiles of the hashes (with their error
    added) tell which rows come into question, so no task sorts the table; equal rows travel
    as one row with their number."""
    from stressframe.session import cut_lineage

    rows = labelled_rows(df, label, by)
    sizes = df.where(F.col(label).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n")).collect()
    if sizes and max(r.n for r in sizes) > limit:
        share = min(1.0, 1.1 * limit / min(r.n for r in sizes if r.n > limit) + 2e-4)  # 1e-4: the quantile's error
        cuts = rows.groupBy(*by).agg(F.percentile_approx("_h", share, 10_000).alias("cut"), F.count(F.lit(1)).alias("n")).collect()
        near = F.lit(False)
        for r in cuts:
            own = F.lit(True)
            for c in by:
                own = own & F.col(c).eqNullSafe(F.lit(r[c]))
            near = near | (own & ((F.col("_h") <= r.cut) if r.n > limit else F.lit(True)))
        rows = rows.where(near)
    few = rows.groupBy(*by, "_h", "_y", "_x").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_h", "_y").rowsBetween(Window.unboundedPreceding, -1)
    few = few.withColumn("_left", F.lit(limit) - F.coalesce(F.sum("_n").over(before), F.lit(0))).where("_left > 0")
    each = F.explode(F.sequence(F.lit(1), F.least("_n", "_left"))).alias("_k")
    return cut_lineage(few.select(*by, "_h", "_x", "_y", each).drop("_k"))


@dataclass
class FitBins:
    """Of a fit's rows: their number, their features and the bins' upper edges (None: the
    fit takes them from all values itself)."""

    rows: int
    width: int
    edges: list[np.ndarray] | None


def summary(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, rows): all distinct values where they are few, else values at equal steps of rank."""
    v = np.sort(v)
    first = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    if len(first) <= STEPS:
        return v[first], np.diff(np.append(first, len(v))).astype(np.float64)
    at = np.ceil(np.arange(1, STEPS + 1) * len(v) / STEPS).astype(np.int64) - 1
    return v[at], np.diff(np.append(-1, at)).astype(np.float64)


def edges_of(values: np.ndarray, rows: np.ndarray, bins: int) -> np.ndarray:
    """Upper edges of at most ``bins`` bins from merged summaries."""
    found, group = np.unique(values, return_inverse=True)
    if len(found) <= bins:
        return found
    below = np.cumsum(np.bincount(group, rows))
    points = np.linspace(0, 1, bins + 1)[1:] * below[-1]
    return found[np.unique(np.minimum(np.searchsorted(below, points - 1e-6), len(found) - 1))]


def fit_bins(rows: DataFrame, bins: int = 255) -> FitBins:
    """Bins of ``labelled_rows``: all values of a feature where they are few, else quantiles of
    all rows, by summaries of ``SUMMED_ROWS`` rows each (rank error 1 / ``STEPS`` at most)."""

    def told(batches):
        held, size = [], 0

        def parts():
            x = np.concatenate(held)
            both = [summary(x[:, j]) for j in range(x.shape[1])]
            columns = [pa.array([v[k].tobytes() for v in both], pa.binary()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(range(len(both)), pa.int32()), *columns], ["k", "v", "n"])

        for b in batches:
            if len(b):
                held.append(b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1))
                size += len(b)
            if size >= SUMMED_ROWS:
                yield parts()
                held, size = [], 0
        if size:
            yield parts()

    def merged(table):
        v, n = (np.concatenate([np.frombuffer(x, np.float64) for x in table[c].to_pylist()]) for c in ("v", "n"))
        return pa.table({"k": pa.array([table["k"][0].as_py()], pa.int32()), "rows": pa.array([round(n.sum())], pa.int64()), "edges": pa.array([edges_of(v, n, bins).tolist()], pa.list_(pa.float64()))})

    sent = rows.select("_x").mapInArrow(told, "k int, v binary, n binary")
    found = sorted(sent.groupBy("k").applyInArrow(merged, "k int, rows long, edges array<double>").collect(), key=lambda r: r.k)
    n = found[0]["rows"] if found else 0
    return FitBins(n, len(found), [np.array(r.edges) for r in found] if n > COUNTED_ROWS else None)


def fit_boost(
    train: DataFrame, label: str, name: str, params: Boost, valid: DataFrame | None = None, seed: int = SEED, valid_share: float = 0.0,
    bins: FitBins | None = None,
) -> BoostModel:
    """Fit on every labelled row of ``train`` (vector ``features``, or ``labelled_rows``);
    ``valid`` (or the last ``valid_share`` of the rows in hash order) decides when patience
    ends.  ``bins``: ``fit_bins`` of ``train``, for several fits on the same rows."""
    rows, held = (df if df is None or {"_h", "_x", "_y"} <= set(df.columns) else labelled_rows(df, label) for df in (train, valid))
    bins = fit_bins(rows, params.bins) if bins is None else bins
    if not bins.rows:
        raise ValueError("no labelled rows to fit on")
    n, watched = bins.rows, bool(params.patience and held is not None)
    both = rows.select(F.lit(False).alias("_valid"), "_h", "_x", "_y")
    if watched:
        n += held.count()
        both = both.unionAll(held.select(F.lit(True).alias("_valid"), "_h", "_x", "_y"))
        if n == bins.rows:
            raise ValueError("no labelled rows to fit on")
    share = valid_share if params.patience and not watched else 0.0
    if bins.edges is not None and n * bins.width > TASK_CELLS:
        with WIDE:
            return BoostModel(name, json.dumps(fit_blocks(both, params, bins.edges, n, watched, share, seed)))
    settings, edges = asdict(params), bins.edges

    def run(batches):
        parts = []
        for b in batches:
            if len(b):
                of_valid, h, y = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3))
                x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)
                parts.append((of_valid, h, y, x.T if edges is None else coded(x, edges)))
        if not parts:
            return
        of_valid, h, y, x = (np.concatenate(c, axis=-1) for c in zip(*parts))
        parts.clear()
        order = np.lexsort((y, h, of_valid))
        cut = int((~of_valid).sum())
        x, y, p = x[:, order], y[order], Boost(**settings)
        if share:
            cut -= max(1, round(share * cut))
        valid = (x[:, cut:], y[cut:]) if cut < len(y) else (None, None)
        if edges is None:
            found = fit_arrays(x[:, :cut].T, y[:cut], p, valid[0] if valid[0] is None else valid[0].T, valid[1], seed)
        else:
            found = fit_codes(x[:, :cut], y[:cut], edges, p, *valid, seed)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(found)])], names=["payload"])

    (found,) = both.coalesce(1).mapInArrow(run, "payload string").collect()
    return BoostModel(name, found["payload"])


def grow_known(count, p: Boost) -> list:
    """The nodes of one tree, best split first as ``_Grower.grow`` does, from ``count(tree, wanted)``:
    the sums and the best split of each wanted node of a tree.  Leaves that may still be split are
    split ahead, so a pass over the rows serves many of them; what was split in vain is left out."""
    limit = p.leaves or (1 << p.depth if p.depth else 1 << 30)
    col, bin_, left, right, depth, split, value = [-1], [0], [0], [0], [0], [None], [0.0]

    def look(wanted):
        tree = {"col": np.array(col), "bin": np.array(bin_), "left": np.array(left), "right": np.array(right)}
        for k, (sums, found) in zip(wanted, count(tree, wanted)):
            split[k] = found
            if k == 0:
                value[0] = leaf_value(sums[0], sums[1], p)

    look([0])
    while True:
        nodes, leaves = [[-1, 0, 0, 0, value[0], 0.0]], 1
        heap = [(-split[0][0], 0, 0)] if split[0] else []
        while heap and leaves < limit:
            if col[heap[0][2]] < 0:
                break
            gain, at, k = heapq.heappop(heap)
            nodes[at][:4], nodes[at][5] = [col[k], bin_[k], len(nodes), len(nodes) + 1], -gain
            leaves += 1
            for child in (left[k], right[k]):
                if split[child]:
                    heapq.heappush(heap, (-split[child][0], len(nodes), child))
                nodes.append([-1, 0, 0, 0, value[child], 0.0])
        else:
            return nodes
        wanted = []
        for _, _, k in heapq.nsmallest(min(limit - leaves, len(heap)), heap):
            if col[k] >= 0:
                continue
            _, col[k], bin_[k], low, high = split[k]
            left[k], right[k] = len(col), len(col) + 1
            for sums in (low, high):
                if not p.depth or depth[k] + 1 < p.depth:
                    wanted.append(len(col))
                for own, v in ((col, -1), (bin_, 0), (left, 0), (right, 0), (depth, depth[k] + 1), (split, None), (value, leaf_value(sums[0], sums[1], p))):
                    own.append(v)
        if wanted:
            look(wanted)


def _area(parts) -> tuple[float, list[float]]:
    """The area from (range, positives, negatives, pairs won, scores in between) and cuts for the next ranges."""
    won = below = positives = 0.0
    for _, pos, neg, own, _ in sorted(parts, key=lambda v: v[0]):
        won, below, positives = won + own + pos * below, below + neg, positives + pos
    return (won / (positives * below) if positives and below else 0.5), sorted(s for v in parts for s in v[4])


def fit_blocks(both: DataFrame, p: Boost, edges: list[np.ndarray], n: int, watched: bool, valid_share: float, seed: int) -> dict:
    """``fit_codes`` over rows that stay on the executors: (_valid, _h, _x, _y).  Row sampling
    draws each row by itself (by round and block), all else is the same up to rounding."""
    from stressframe.session import checkpoint_path, cut_lineage, drop_stored

    width, bins = len(edges), max(len(e) for e in edges)
    count_rows, parts = p.min_rows > 1, max(1, math.ceil(n / BLOCK_ROWS))
    if valid_share:
        last = both.agg(F.percentile_approx("_h", 1 - valid_share, 10_000).alias("cut")).first().cut
        both = both.withColumn("_valid", F.col("_h") > last)
    watch = watched or bool(valid_share)

    @F.arrow_udf("binary")
    def codes_of(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.binary())
        out = np.ascontiguousarray(coded(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), edges).T)
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(out), [None, pa.py_buffer(out)]).cast(pa.binary())

    def pack(batches):
        held, size = [], 0

        def block():
            t = pa.Table.from_batches(held)
            codes = np.frombuffer(b"".join(t["_c"].to_pylist()), np.uint8).reshape(-1, width).T
            rows = [[np.ascontiguousarray(codes).tobytes()], [t["_y"].to_numpy().astype(np.uint8).tobytes()]]
            train = len(t) - int(np.count_nonzero(t["_valid"].to_numpy()))
            return pa.RecordBatch.from_arrays([*(pa.array(r, pa.binary()) for r in rows), pa.array([train], pa.int64())], ["codes", "y", "train"])

        for b in batches:
            held.append(b)
            size += len(b)
            if size >= 2 * BLOCK_ROWS:  # many equal rows: more blocks, none larger
                yield block()
                held, size = [], 0
        if size:
            yield block()

    coded_rows = both.select("_valid", "_h", "_y", codes_of("_x").alias("_c"))
    dealt = coded_rows.repartition(parts, "_h").sortWithinPartitions("_valid", "_h", "_y")
    blocks = cut_lineage(dealt.mapInArrow(pack, "codes binary, y binary, train long"))
    packed = blocks.rdd.map(
        lambda r: (np.frombuffer(r["codes"], np.uint8).reshape(width, -1), np.frombuffer(r["y"], np.uint8), r["train"])
    )
    told = packed.map(lambda b: (b[2], len(b[1]) - b[2], int(b[1][: b[2]].sum()))).collect()
    train, valid, positives = (sum(c) for c in zip(*told))
    base = base_score(p.pos_weight * positives, p.pos_weight * positives + train - positives)

    def moved(tree):
        return lambda b: (*b[:3], b[3] + tree["value"][walk_codes(tree, b[0])])

    def sums(tree, wanted, r):
        place = np.full(len(tree["col"]), -1)
        place[wanted] = np.arange(len(wanted))

        def run(part, blocks):
            total = None
            for k, (codes, y, train, raw) in enumerate(blocks):
                slot = place[walk_codes(tree, codes[:, :train])]
                own = slot >= 0
                if p.row_rate < 1:
                    own &= np.random.default_rng([seed, r, part, k]).random(train) < p.row_rate
                rows = np.flatnonzero(own)
                some = y[rows].astype(np.float64)
                w, q = np.where(some == 1, p.pos_weight, 1.0), 1.0 / (1.0 + np.exp(-raw[rows]))
                at = slot[rows] * bins if len(wanted) > 1 else None
                rows = None if len(rows) == train else rows
                hist = column_sums(codes[:, :train], rows, at, [w * (q - some), w * q * (1 - q)], len(wanted) * bins, count_rows)
                total = hist if total is None else total + hist
            if total is not None:
                by_node = total.reshape(len(total), width, len(wanted), bins)
                for i in range(len(wanted)):
                    yield i, (part, np.ascontiguousarray(by_node[:, :, i]))

        return run

    def best(use):
        def run(found):
            nodes: dict = {}
            for i, v in found:
                nodes.setdefault(i, []).append(v)
            for i, own in nodes.items():
                hist = sum(h for _, h in sorted(own, key=lambda v: v[0]))  # in one order: the same sums
                whole, split = hist[:, 0].sum(axis=1), best_split(hist, use, p)
                if split:
                    low = hist[:, split[1], : split[2] + 1].sum(axis=1)
                    split = (*split, low, whole - low)
                yield i, (whole, split)

        return run

    def losses(b):
        raw, y = b[3][b[2] :], b[1][b[2] :].astype(np.float64)
        return float(np.sum(np.logaddexp(0, raw) - y * raw))

    def counted(cuts):
        def run(blocks):
            for _, y, train, raw in blocks:
                score, group = np.unique(raw[train:], return_inverse=True)
                pos, every = np.bincount(group, y[train:], len(score)), np.bincount(group, minlength=len(score))
                stops = np.searchsorted(score, cuts, side="right")
                for k, (a, b) in enumerate(zip([0, *stops], [*stops, len(score)])):
                    if b > a:
                        yield k, (score[a:b], pos[a:b], every[a:b])

        return run

    def areas(found):
        by_range: dict = {}
        for k, v in found:
            by_range.setdefault(k, []).append(v)
        for k, own in by_range.items():
            score, group = np.unique(np.concatenate([v[0] for v in own]), return_inverse=True)
            pos, every = (np.bincount(group, np.concatenate([v[c] for v in own]), len(score)) for c in (1, 2))
            neg = every - pos
            inside = np.searchsorted(every.cumsum(), every.sum() * np.arange(1, 16) / 16)
            yield k, float(pos.sum()), float(neg.sum()), float((pos * (neg.cumsum() - neg / 2)).sum()), score[inside].tolist()

    ranges, cuts = max(1, math.ceil(valid / BLOCK_ROWS)), []

    def metric(state):
        nonlocal cuts
        if p.metric != "auc":
            return -sum(state.map(losses).collect()) / valid
        sent = state.mapPartitions(counted(cuts))
        area, points = _area((sent.partitionBy(len(cuts) + 1, int) if len(cuts) else sent.coalesce(1)).mapPartitions(areas).collect())
        cuts = sorted({points[len(points) * k // ranges] for k in range(1, ranges)}) if points else []
        return area

    state = packed.map(lambda b: (*b, np.full(len(b[1]), base))).persist(StorageLevel.MEMORY_AND_DISK)
    rng, trees, waiting, margins = np.random.default_rng(seed), [], _Patience(p), None
    for r in range(p.rounds):
        use = drawn_columns(rng, width, p)

        def count(tree, wanted):
            sent = state.mapPartitionsWithIndex(sums(tree, wanted, r))
            sent = sent.partitionBy(min(len(wanted), parts), int) if parts > 1 else sent
            found = dict(sent.mapPartitions(best(use)).collect())
            return [found[i] for i in range(len(wanted))]

        tree = as_tree(grow_known(count, p), edges)
        trees.append(tree)
        before, state = state, state.map(moved(tree))
        if (r + 1) % KEEP_ROUNDS == 0:  # what the next rounds go back to
            old, margins = margins, state.map(lambda b: b[3])
            margins.checkpoint()
            margins.count()
            state = packed.zip(margins).map(lambda b: (*b[0], b[1]))
            if old is not None:
                drop_stored(both.sparkSession, old.getCheckpointFile())
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        if watch:
            over = waiting.over(r, metric(state))
            before.unpersist()
            if over:
                break
        else:
            state.count()
            before.unpersist()
    state.unpersist()
    if margins is not None:
        drop_stored(both.sparkSession, margins.getCheckpointFile())
    drop_stored(both.sparkSession, checkpoint_path(blocks))
    return as_model(base, trees[: waiting.round + 1] if watch else trees, width)
