"""Random forests whose rows and nodes stay on the executors (MOD-4, MOD-6).

A forest without a depth limit has about as many nodes as rows, times its trees: too
many for one process.  Here the driver holds only the upper part of each tree:

* Rows become bin codes (at most ``max_bins`` per feature); equal rows are one with
  their number.  A tree's bootstrap is a Poisson draw per row, hashed from the row and
  the tree, so it is the same in every pass, partitioning and retry.
* While a node holds more than ``LOCAL_ROWS`` rows, tasks count classes per bin and
  drawn feature, Spark brings the counts of a tree together and its best splits come
  back (one pass over the rows per level, for all trees).
* Below that, a node's rows travel to one group, which grows the rest of the branch and
  stores it as one row of the node table.  Growing a branch sooner or later gives the
  same trees, since draws come from hashes of (seed, tree, node).
* Rows are scored where they are while all branches take at most ``SENT_NODES`` bytes.  Else
  they travel to the branches that they reach, each branch is read once, and the leaf values
  of a block of rows come back to one group.

As in Spark ML's forests the square root of the features is tried at each node, Gini
impurity with class weights picks the split, a node without a gain is a leaf, and the
score is the mean over the trees of the weighted share of class 1.
"""

from __future__ import annotations

import json
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stressframe.session import cut_lineage, ensure_checkpoint_dir

LOCAL_ROWS = 100_000  # of a branch that one group grows
TASK_ROWS = 200_000  # of all trees together, that a task grows or scores
SENT_NODES = 32 << 20  # bytes of all branches that each task may have, to score rows where they are
CELLS = 1 << 16  # of the histograms worked on at a time: they stay in a core's cache
ONE = 1 << 48  # of leaf values as integers: their sums are the same in any order
NODE = np.dtype([("feature", "<i2"), ("bin", "u1"), ("left", "<i4"), ("value", "<i8")])  # right child: left + 1


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit hashes of 64-bit keys (splitmix64)."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn_features(spec: dict, tree: int, heap: np.ndarray) -> np.ndarray:
    """(nodes, tried): the features tried at each node of a tree."""
    node = mix(heap.astype(np.uint64) ^ mix(np.array([spec["seed"] * 1_000_003 + tree], np.uint64)))
    keys = mix(node[:, None] + np.arange(1, spec["width"] + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
    return np.argsort(keys, axis=1, kind="stable")[:, : spec["tried"]]


def poisson(u: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Poisson numbers of the given means from uniform ones."""
    out = np.zeros(len(u), np.int64)
    for m in np.unique(mean):
        first = max(0, int(m - 12 * math.sqrt(m)) - 12)
        k = np.arange(first, int(m + 12 * math.sqrt(m)) + 40)
        log = np.concatenate([[0.0], np.cumsum(np.log(float(m)) - np.log(k[1:]))])
        share = np.cumsum(np.exp(log - log.max()))
        own = mean == m
        out[own] = first + np.minimum(np.searchsorted(share / share[-1], u[own], side="right"), len(k) - 1)
    return out


def copies(spec: dict, tree: int, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How often each row stands in a tree's bootstrap."""
    if not spec["bootstrap"]:
        return n
    u = mix(h.astype(np.uint64) ^ mix(np.array([(spec["seed"] + 7) * 1_000_033 + tree], np.uint64)))
    return poisson((u >> np.uint64(11)).astype(np.float64) / (1 << 53), n)


def best_splits(n0: np.ndarray, n1: np.ndarray, spec: dict):
    """(gain, number of the feature, bin) per node of class histograms (nodes, tried, bins);
    a gain of 0: no split."""
    a, b = n0.cumsum(axis=2), n1.cumsum(axis=2)
    rows = a + b
    whole = rows[:, :1, -1:]
    few = np.minimum(rows, whole - rows) < spec["min_rows"]
    a, b = a * spec["weights"][0], b * spec["weights"][1]
    a_all, b_all = a[:, :1, -1:], b[:, :1, -1:]

    def purity(a, b):
        return (a * a + b * b) / np.maximum(a + b, 1e-300)

    gain = purity(a, b)
    gain += purity(a_all - a, b_all - b)
    gain -= purity(a_all, b_all)
    gain[few | (gain <= 1e-12 * (a_all + b_all))] = 0.0
    flat = gain.reshape(len(gain), -1)
    k = flat.argmax(axis=1)
    return flat[np.arange(len(flat)), k], k // n0.shape[2], k % n0.shape[2]


def grow(codes: np.ndarray, y: np.ndarray, c: np.ndarray, tree: int, heap: int, spec: dict):
    """(nodes, gain per feature) of the branch below node ``heap``, level by level."""
    tried, bins, width = spec["tried"], spec["bins"], codes.shape[1]
    flat, gains, levels, made = codes.ravel(), np.zeros(width), [], 1
    heaps, row, slot = np.array([heap], np.int64), np.arange(len(y)), np.zeros(len(y), np.int64)
    while len(heaps):
        n = np.bincount(slot * 2 + y[row], c[row], 2 * len(heaps)).reshape(-1, 2)
        level = np.zeros(len(heaps), NODE)
        level["feature"], level["value"] = -1, leaf_value(n, spec)
        levels.append(level)
        go = (n.min(1) > 0) & (n.sum(1) >= 2 * spec["min_rows"]) & (heaps < 1 << spec["depth"])
        inside = go[slot]
        row, slot = row[inside], (np.cumsum(go) - 1)[slot[inside]]
        own = np.flatnonzero(go)
        order = np.argsort(slot, kind="stable")
        row, slot = row[order], slot[order]
        chosen = drawn_features(spec, tree, heaps[own])
        found = [np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        step = max(1, CELLS // (tried * bins * 2))
        for at in range(0, len(own), step):
            stop = min(at + step, len(own))
            a, b = np.searchsorted(slot, [at, stop])
            s, r = slot[a:b], row[a:b]
            size = (stop - at) * tried * bins
            key = ((s - at)[:, None] * tried + np.arange(tried)) * bins + flat[r[:, None] * width + chosen[s]]
            hist = np.bincount((key + y[r][:, None] * size).ravel(), np.repeat(c[r], tried), 2 * size)
            part = best_splits(*hist.reshape(2, stop - at, tried, bins), spec)
            found = [np.concatenate(x) for x in zip(found, part)]
        gain, k, cut = found
        split = gain > 0
        feature = chosen[np.arange(len(own)), k][split] if len(own) else np.zeros(0, np.int64)
        np.add.at(gains, feature, gain[split])
        at = own[split]
        level["feature"][at], level["bin"][at] = feature, cut[split]
        level["left"][at] = made + 2 * np.arange(len(at))
        made += 2 * len(at)
        inside = split[slot] if len(slot) else np.zeros(0, bool)
        row, slot = row[inside], (np.cumsum(split) - 1)[slot[inside]]
        slot = 2 * slot + (flat[row * width + feature[slot]] > cut[split][slot])
        heaps = (2 * heaps[at][:, None] + np.arange(2)).ravel()
    return np.concatenate(levels), gains


def leaf_value(n: np.ndarray, spec: dict) -> np.ndarray:
    a, b = n[:, 0] * spec["weights"][0], n[:, 1] * spec["weights"][1]
    return np.rint(np.divide(b, a + b, out=np.zeros(len(n)), where=a + b > 0) * ONE).astype(np.int64)


def walk(nodes, codes: np.ndarray) -> np.ndarray:
    """Number of the last node of every row; ``nodes`` has feature, bin and left."""
    at, row = np.zeros(len(codes), np.int64), np.arange(len(codes))
    while len(row):
        f = nodes["feature"][at[row]]
        row, f = row[f >= 0], f[f >= 0].astype(np.int64)
        k = at[row]
        at[row] = nodes["left"][k] + (codes[row, f] > nodes["bin"][k])
    return at


class _Tops:
    """The upper parts of all trees: nodes as arrays per tree, with their heap numbers."""

    KINDS = {"feature": np.int64, "bin": np.int64, "left": np.int64, "heap": np.int64, "value": np.int64, "open": bool}

    def __init__(self, trees: list[dict]):
        self.trees = [{k: np.array(t[k], d) for k, d in self.KINDS.items()} for t in trees]

    @staticmethod
    def roots(trees: int) -> "_Tops":
        return _Tops([{"feature": [-1], "bin": [0], "left": [0], "heap": [1], "value": [0], "open": [True]} for _ in range(trees)])

    def plain(self) -> list[dict]:
        return [{k: v.tolist() for k, v in t.items()} for t in self.trees]


def _codes_udf(edges: list[np.ndarray]):
    @F.arrow_udf("binary")
    def codes(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.binary())
        rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        out = np.stack([np.searchsorted(e, rows[:, j], side="left") for j, e in enumerate(edges)], 1).astype(np.uint8)
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(out.shape[1]), len(out), [None, pa.py_buffer(np.ascontiguousarray(out))]).cast(pa.binary())

    return codes(vector_to_array(F.col("features")))


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def bin_edges(df: DataFrame, width: int, max_bins: int) -> list[np.ndarray]:
    """Cuts per feature: between all its values where they are few, else quantiles of all rows."""
    x = [F.nullif(F.col("_x")[j], F.lit(float("nan"))) for j in range(width)]
    rows = df.select(vector_to_array("features").alias("_x"))
    points = [i / max_bins for i in range(1, max_bins)]
    first = rows.agg(*[F.approx_count_distinct(c, 0.02).alias(f"n{j}") for j, c in enumerate(x)],
                     *[F.percentile_approx(c, points, 10_000).alias(f"q{j}") for j, c in enumerate(x)]).first()
    few = [j for j in range(width) if 0 < first[f"n{j}"] <= 1.2 * max_bins]
    sets = rows.agg(F.lit(0), *[F.collect_set(x[j]).alias(f"v{j}") for j in few]).first()
    edges = []
    for j in range(width):
        values = np.unique(np.array(sets[f"v{j}"] if j in few else [], np.float64))
        if 0 < len(values) <= max_bins:
            middle = values[:-1] + (values[1:] - values[:-1]) / 2
            edges.append(np.where(np.isfinite(middle), middle, values[:-1]))
        else:
            edges.append(np.unique(np.array(first[f"q{j}"] or [], np.float64)))
    return edges


def _batches(batches, spec):
    """(codes, y, copies, hash) of Arrow batches of the fit's rows."""
    for b in batches:
        if len(b):
            n, h = b.column(2).to_numpy(), b.column(3).to_numpy()
            yield _matrix(b.column(0), spec["width"]), b.column(1).to_numpy().astype(np.int64), n, h.view(np.uint64)


def _grow_tops(rows: DataFrame, tops: _Tops, spec: dict) -> np.ndarray:
    """Split nodes of more than ``local`` rows, level by level; returns gains (trees, features)."""
    gains = np.zeros((len(tops.trees), spec["width"]))
    tried, bins = spec["tried"], spec["bins"]
    while any(t["open"].any() for t in tops.trees):
        trees = tops.trees
        own = [np.flatnonzero(t["open"]) for t in trees]
        chosen = [drawn_features(spec, i, trees[i]["heap"][k]) for i, k in enumerate(own)]

        def count(batches):
            # (nodes, tried, bins, class, [copies, rows])
            hist = [np.zeros((len(k) * tried * bins * 2, 2), np.int64) for k in own]
            for codes, y, n, h in _batches(batches, spec):
                flat, width = codes.ravel(), codes.shape[1]
                for i, k in enumerate(own):
                    if not len(k):
                        continue
                    c = copies(spec, i, h, n)
                    place = np.full(len(trees[i]["open"]), -1)
                    place[k] = np.arange(len(k))
                    s = place[walk(trees[i], codes)]
                    r = np.flatnonzero((s >= 0) & (c > 0))
                    s = s[r]
                    key = (s[:, None] * tried + np.arange(tried)) * bins + flat[r[:, None] * width + chosen[i][s]]
                    key = (key * 2 + y[r][:, None]).ravel()
                    hist[i][:, 0] += np.bincount(key, np.repeat(c[r], tried), len(hist[i])).astype(np.int64)
                    hist[i][:, 1] += np.bincount(key, minlength=len(hist[i]))
            for i, k in enumerate(own):
                if len(k):
                    yield pa.RecordBatch.from_pydict({"tree": pa.array([i], pa.int32()), "hist": pa.array([hist[i].tobytes()], pa.binary())})

        def pick(table):
            i = table.column("tree")[0].as_py()
            hist = sum(np.frombuffer(x, np.int64) for x in table.column("hist").to_pylist()).reshape(len(own[i]), tried, bins, 2, 2)
            gain, k, cut = best_splits(*np.moveaxis(hist[..., 0], 3, 0).astype(np.float64), spec)
            at = np.arange(len(k))
            left, whole = hist.cumsum(axis=2)[at, k, cut], hist[:, 0].sum(axis=1)
            names = {"l": left, "n": whole}
            out = {"tree": pa.array([i] * len(k), pa.int32()), "node": pa.array(own[i]), "gain": gain, "feature": chosen[i][at, k], "bin": cut}
            out |= {f"{c}{y}{w}": x[:, y, w] for c, x in names.items() for y in (0, 1) for w in (0, 1)}
            return pa.table(out)

        shape = "tree int, node long, gain double, feature long, bin long, " + ", ".join(f"{c}{y}{w} long" for c in "ln" for y in (0, 1) for w in (0, 1))
        found = rows.mapInArrow(count, "tree int, hist binary").groupBy("tree").applyInArrow(pick, shape).toPandas()
        for i, part in found.sort_values(["tree", "node"]).groupby("tree"):
            tops.trees[i] = _split_top(trees[i], part, spec, gains[i])
    return gains


def _split_top(t: dict, found, spec: dict, gains: np.ndarray) -> dict:
    """One tree's upper part after a level's splits; open: children that still are too large."""
    t = {k: v.copy() for k, v in t.items()}
    t["open"][:] = False
    more = {k: [] for k in t}
    for r in found.itertuples():
        n = np.array([[r.n00, r.n10]], np.float64)
        t["value"][r.node] = leaf_value(n, spec)[0]
        if r.gain <= 0:
            continue
        gains[r.feature] += r.gain
        t["feature"][r.node], t["bin"][r.node], t["left"][r.node] = r.feature, r.bin, len(t["heap"]) + len(more["heap"])
        for side, (n0, n1, m) in enumerate(((r.l00, r.l10, r.l01 + r.l11), (r.n00 - r.l00, r.n10 - r.l10, r.n01 + r.n11 - r.l01 - r.l11))):
            heap = 2 * int(t["heap"][r.node]) + side
            able = n0 > 0 and n1 > 0 and n0 + n1 >= 2 * spec["min_rows"] and heap < 1 << spec["depth"]
            # value -1: the rest of the branch is grown by a group
            value = leaf_value(np.array([[n0, n1]], np.float64), spec)[0] if not able or m > spec["local"] else -1
            for k, v in {"feature": -1, "bin": 0, "left": 0, "heap": heap, "value": value, "open": able and m > spec["local"]}.items():
                more[k].append(v)
    return {k: np.concatenate([v, np.array(more[k], v.dtype)]) for k, v in t.items()}


def _parts(df: DataFrame, n: int, trees: int) -> int:
    """Partitions of ``n`` rows sent to every tree."""
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(n * trees / TASK_ROWS))


def _branches(rows: DataFrame, n: int, tops: _Tops, spec: dict) -> DataFrame:
    """(tree, node, nodes, gains): the branches below the upper parts, grown by groups."""
    trees = tops.trees

    def send(batches):
        for codes, y, n, h in _batches(batches, spec):
            for i, t in enumerate(trees):
                c = copies(spec, i, h, n)
                at = walk(t, codes)
                r = np.flatnonzero((c > 0) & (t["value"][at] < 0) & (t["feature"][at] < 0))
                if not len(r):
                    continue
                r = r[np.argsort(at[r], kind="stable")]
                nodes, first = np.unique(at[r], return_index=True)
                out = [(codes[p].tobytes(), y[p].astype(np.uint8).tobytes(), c[p].astype(np.int64).tobytes()) for p in np.split(r, first[1:])]
                columns = [pa.array(x, pa.binary()) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(nodes), pa.int32()), pa.array(nodes), *columns], ["tree", "node", "codes", "y", "c"])

    def build(table):
        i, k = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        y, c = (np.frombuffer(b"".join(table.column(x).to_pylist()), d) for x, d in (("y", np.uint8), ("c", np.int64)))
        codes = _matrix(table.column("codes"), spec["width"])
        nodes, gains = grow(codes, y.astype(np.int64), c, i, int(trees[i]["heap"][k]), spec)
        return pa.table({"tree": pa.array([i], pa.int32()), "node": pa.array([k]), "nodes": pa.array([nodes.tobytes()], pa.binary()), "gains": pa.array([gains.tolist()])})

    sent = rows.mapInArrow(send, "tree int, node long, codes binary, y binary, c binary")
    return sent.repartition(_parts(rows, n, len(trees)), "tree", "node").groupBy("tree", "node").applyInArrow(build, "tree int, node long, nodes binary, gains array<double>")


def fit_forest(
    df: DataFrame, label: str, name: str, trees: int, depth: int = 30, min_rows: int = 1, bootstrap: bool = True, max_bins: int = 32,
    weights: tuple[float, float] = (1.0, 1.0), seed: int = 42, local_rows: int | None = None,
) -> "ForestModel":
    """A forest over the rows of ``df`` (vector ``features``) with a label of 0 or 1."""
    spark = df.sparkSession
    df = df.where(F.col(label).isin(0, 1))
    head = df.select(F.size(vector_to_array("features")).alias("n")).first()
    if head is None:
        raise ValueError("no labelled rows to fit on")
    edges = bin_edges(df, head.n, max_bins)
    local = LOCAL_ROWS if local_rows is None else local_rows
    spec = dict(width=head.n, tried=max(1, math.ceil(math.sqrt(head.n))), bins=max_bins, min_rows=min_rows, depth=depth, seed=seed, bootstrap=bootstrap,
                weights=[float(w) for w in weights], local=local)
    rows = df.select(_codes_udf(edges).alias("codes"), F.col(label).cast("int").alias("y")).groupBy("codes", "y").agg(F.count(F.lit(1)).alias("n"))
    rows = cut_lineage(rows.withColumn("h", F.xxhash64("codes", "y")).repartition(spark.sparkContext.defaultParallelism, "h"))
    tops = _Tops.roots(trees)
    gains = np.zeros((trees, head.n))
    n = rows.count()
    if n > local:
        gains = _grow_tops(rows, tops, spec)
    else:
        for t in tops.trees:
            t["value"][:], t["open"][:] = -1, False
    path = f"{ensure_checkpoint_dir(spark)}/forest-{uuid.uuid4().hex}"
    _branches(rows, n, tops, spec).write.parquet(path)
    nodes = spark.read.parquet(path)
    for r in nodes.groupBy("tree").agg(F.array(*[F.sum(F.col("gains")[j]) for j in range(head.n)]).alias("g")).collect():
        gains[r.tree] += r.g
    share = gains / np.maximum(gains.sum(1, keepdims=True), 1e-300)
    importances = share.sum(0) / (share.sum() or 1.0)
    known = {"edges": [e.tolist() for e in edges], "tops": tops.plain(), "importances": importances.tolist()}
    return ForestModel(name, json.dumps(known), nodes)


class ForestModel(Model, MLReadable, MLWritable):
    """Adds ``pv_<name>`` (class probabilities as a vector) and ``pd_<name>`` to a frame with
    ``features``.  ``nodes``: the stored branches."""

    name = Param(Params._dummy(), "name", "suffix of the output columns", TypeConverters.toString)
    payload = Param(Params._dummy(), "payload", "cuts, upper parts and importances as JSON", TypeConverters.toString)

    def __init__(self, name: str = "forest", payload: str = "{}", nodes: DataFrame | None = None):
        super().__init__()
        self._set(name=name, payload=payload)
        self.nodes = nodes

    @property
    def featureImportances(self):
        """Share of each feature in a tree's gains, mean over the trees."""
        return Vectors.dense(json.loads(self.getOrDefault(self.payload))["importances"])

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()

    def _transform(self, df: DataFrame) -> DataFrame:
        name, known = self.getOrDefault(self.name), json.loads(self.getOrDefault(self.payload))
        edges, trees = [np.array(e) for e in known["edges"]], _Tops(known["tops"]).trees
        held = cut_lineage(df.withColumn("_codes", _codes_udf(edges)))
        scores = self._scores(cut_lineage(held.select("_codes").distinct()), trees, len(edges))
        out = held.join(scores, "_codes")
        return out.select(
            *df.columns,
            array_to_vector(F.array(1.0 - F.col("_p"), F.col("_p"))).alias(f"pv_{name}"),
            (F.col("_p") > 0.5).cast("double").alias(f"pd_{name}"),
        )

    def _scores(self, codes: DataFrame, trees: list[dict], width: int) -> DataFrame:
        """(_codes, _p): the mean leaf value of distinct rows."""
        size = self.nodes.agg(F.sum(F.length("nodes")).alias("n")).first().n or 0
        return self._scores_here(codes, trees, width) if size <= SENT_NODES else self._scores_there(codes, trees, width)

    def _scores_here(self, codes: DataFrame, trees: list[dict], width: int) -> DataFrame:
        """The branches go to the rows: each task has all of them."""
        found: dict = {}
        for r in self.nodes.select("tree", "node", "nodes").collect():
            found.setdefault(r.tree, {})[r.node] = bytes(r.nodes)
        sent = codes.sparkSession.sparkContext.broadcast(found)

        def score(batches):
            for b in batches:
                x = _matrix(b.column(0), width)
                if not len(x):
                    continue
                total = np.zeros(len(x), np.int64)
                for i, t in enumerate(trees):
                    at = walk(t, x)
                    own = t["value"][at]
                    inside = np.flatnonzero(own < 0)
                    inside = inside[np.argsort(at[inside], kind="stable")]
                    nodes, first = np.unique(at[inside], return_index=True)
                    for k, p in zip(nodes.tolist(), np.split(inside, first[1:])):
                        branch = np.frombuffer(sent.value[i][k], NODE)
                        own[p] = branch["value"][walk(branch, x[p])]
                    total += own
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total.astype(np.float64) / (ONE * len(trees)))], ["_codes", "_p"])

        return codes.mapInArrow(score, "_codes binary, _p double")

    def _scores_there(self, codes: DataFrame, trees: list[dict], width: int) -> DataFrame:
        """The rows travel to the branches that they reach."""

        def send(batches):
            """A block's rows to the branches that they reach; the block itself with what it has by then."""
            part = TaskContext.get().partitionId()
            for k, b in enumerate(batches):
                x, block = _matrix(b.column(0), width), (part << 32) + k
                if not len(x):
                    continue
                known = np.zeros(len(x), np.int64)
                for i, t in enumerate(trees):
                    at = walk(t, x)
                    inside = t["value"][at] < 0
                    known += np.where(inside, 0, t["value"][at])
                    r = np.flatnonzero(inside)
                    if not len(r):
                        continue
                    r = r[np.argsort(at[r], kind="stable")]
                    nodes, first = np.unique(at[r], return_index=True)
                    each = np.split(r, first[1:])
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array([i] * len(nodes), pa.int32()), "node": pa.array(nodes), "block": pa.array([block] * len(nodes)),
                        "rows": pa.array([p.astype(np.int32).tobytes() for p in each], pa.binary()), "what": pa.array([x[p].tobytes() for p in each], pa.binary()),
                    })
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array([-1], pa.int32()), "node": pa.array([0]), "block": pa.array([block]),
                    "rows": pa.array([known.tobytes()], pa.binary()), "what": pa.array([x.tobytes()], pa.binary()),
                })

        def score(batches):
            """Sorted by branch, its nodes first: leaf values of the rows that follow."""
            nodes = None
            for b in batches:
                tree, block, rows, what = (b.column(k).to_pylist() for k in (0, 2, 3, 4))
                out = []
                for k, i in enumerate(tree):
                    if block[k] < 0:
                        nodes = np.frombuffer(what[k], NODE)
                    else:
                        x = np.frombuffer(what[k], np.uint8).reshape(-1, width)
                        out.append((i, block[k], rows[k], nodes["value"][walk(nodes, x)].tobytes()))
                if out:
                    i, blocks, rows, values = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(i, pa.int32()), pa.array(blocks, pa.int64()), pa.array(rows, pa.binary()), pa.array(values, pa.binary())],
                        ["tree", "block", "rows", "what"],
                    )

        def add(table):
            whole = table.column("tree").to_numpy() < 0
            k = int(np.flatnonzero(whole)[0])
            rows, what = table.column("rows"), table.column("what")
            total, x = np.frombuffer(rows[k].as_py(), np.int64).copy(), what[k].as_py()
            for j in np.flatnonzero(~whole).tolist():
                total[np.frombuffer(rows[j].as_py(), np.int32)] += np.frombuffer(what[j].as_py(), np.int64)
            p = total.astype(np.float64) / (ONE * len(trees))
            return pa.table({"_codes": pa.array([x[s : s + width] for s in range(0, len(x), width)], pa.binary()), "_p": pa.array(p)})

        sent = cut_lineage(codes.mapInArrow(send, "tree int, node long, block long, rows binary, what binary"))
        inner = self.nodes.select("tree", "node", F.lit(-1).cast("long").alias("block"), F.lit(None).cast("binary").alias("rows"), F.col("nodes").alias("what"))
        parts = _parts(codes, codes.count(), len(trees))
        both = inner.unionByName(sent.where("tree >= 0")).repartition(parts, "tree", "node").sortWithinPartitions("tree", "node", "block")
        back = both.mapInArrow(score, "tree int, block long, rows binary, what binary")
        back = back.unionByName(sent.where("tree < 0").select("tree", "block", "rows", "what"))
        return back.groupBy("block").applyInArrow(add, "_codes binary, _p double")


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.nodes.write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        spark = SparkSession.active()
        out = ForestModel(nodes=spark.read.parquet(f"{path}/nodes"))
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        return out
