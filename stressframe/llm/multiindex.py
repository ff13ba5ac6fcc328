"""Near-duplicate vectors by an inverted multi-index (operator 12).

Two codebooks, one for each half of the unit vectors, form a product grid of cells.
Every vector lives in the cell of its two nearest entries and visits further cells
in the order of the multi-sequence traversal, that is by ascending sum of its two
half distances, as long as that sum exceeds the one of its own cell by no more than
a margin.  Of the two vectors of a pair the one with the higher cell number visits,
so a pair is met at most once.  Vectors that meet in a cell are verified by their
cosine in double precision; links below the limit do not exist, links found are
counted for both ends and joined to components by star steps.

The margin is measured: up to ``queries`` vectors are compared exactly with all
vectors, and the smallest margin is taken at which the links so found (each query
weighing the same) would be met with the target recall, times ``slack``, since a
bounded sample holds few of the rare wide links.  With links for under 32 queries it follows from simulated partners of the sample at exactly the limit.

Dense families.  When a vector of that sample has ``block`` or more others within half
the angle of the limit, these form a ball: by the triangle inequality all its members
are linked, so they are counted at once and never compared with each other; members of
two balls are too far apart to be linked at all.  Families that are not caught this way
are compared pair by pair in blocks.  Cells with more than ``block`` vectors are
dealt in blocks over several tasks.

What reaches the driver is bounded by parameters: the sample, histograms of its links,
at most 64 balls, and the cells with more than ``block`` vectors (at most ``entries``
squared).  Rows are never sampled, dropped or capped.

Results in special cases: vectors that are null, empty, zero or hold null or non-finite
components, or whose length is not the commonest one (ties: the shortest), link with
nothing; every row is a vector of its own, rows with equal ids too; a null id counts as
the largest and its component is null when no other id is reached (such a row is kept);
an empty table gives an empty result; ids may be of any ordered type.  Only the named columns are read, so others may clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stressframe.llm.components import components
from stressframe.llm.textvec import mix
from stressframe.llm.vectors import matrix, raw_column, raw_matrix, stored, usable

BINS = 400  # steps of the margin histogram
STEP = 0.005
BALLS = 64
SURE = 1e-9  # far above the rounding of a dot product of unit vectors


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by their largest component, so that no square overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def lloyd_entries(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Codebook of one half from the bounded sample."""
    book = x[:: max(1, len(x) // k)][:k].copy()
    for _ in range(rounds):
        near = ((book * book).sum(1) - 2 * x @ book.T).argmin(1)
        n = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, x)
        book[n > 0] = sums[n > 0] / n[n > 0, None]
    return book


class Grid:
    """The product grid: margins of vectors to entries, own cells, visited cells."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books = first, second
        self.width = len(second)

    def margins(self, x: np.ndarray):
        """Squared half distances to all entries, above the nearest one's: two matrices."""
        h = x.shape[1] // 2
        out = []
        for half, book in zip((x[:, :h], x[:, h:]), self.books):
            d = (book * book).sum(1) - 2 * half @ book.T
            out.append(d - d.min(1, keepdims=True))
        return out

    def home(self, m1: np.ndarray, m2: np.ndarray) -> np.ndarray:
        return m1.argmin(1) * self.width + m2.argmin(1)

    def visits(self, m1: np.ndarray, m2: np.ndarray, margin: float):
        """(row, cell) of the lower-numbered cells that each row visits besides its own.

        Multi-sequence traversal over the sorted halves: for the entries of the first
        half in ascending order, those of the second as long as the sum stays within
        the margin."""
        home = self.home(m1, m2)
        order = np.argsort(m2, axis=1, kind="stable")
        sorted2 = np.take_along_axis(m2, order, 1)
        rows, cells = [], []
        r1, e1 = np.nonzero(m1 <= margin)
        left = margin - m1[r1, e1]
        reach = 0
        while len(r1):
            rows.append(r1)
            cells.append(e1 * self.width + order[r1, reach])
            reach += 1
            if reach == self.width:
                break
            go = sorted2[r1, reach] <= left
            r1, e1, left = r1[go], e1[go], left[go]
        row, cell = np.concatenate(rows), np.concatenate(cells)
        lower = cell < home[row]
        return home, row[lower], cell[lower]


def _simulated_margin(grid: Grid, x: np.ndarray, least: float, target: float) -> float:
    """Margin that meets partners at exactly the limit, in random directions, with the target recall."""
    rng = np.random.default_rng(0)
    noise = rng.standard_normal(x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.maximum(np.sqrt((noise * noise).sum(1, keepdims=True)), 1e-300)
    y = least * x + math.sqrt(max(0.0, 1 - least * least)) * noise
    home = grid.home(*grid.margins(y))
    m1, m2 = grid.margins(x)
    at = np.arange(len(x))
    return float(np.quantile(m1[at, home // grid.width] + m2[at, home % grid.width], target)) + STEP


def _measure(rows: DataFrame, read, grid: Grid, sample: np.ndarray, own: np.ndarray, least: float, half: float):
    """Links of the sample with all rows: histogram of margins per query, and rows within half the angle."""
    s1, s2 = grid.margins(sample)
    s_home = grid.home(s1, s2)

    def run(batches):
        seen = np.zeros((len(sample), BINS + 1), np.int64)
        near = np.zeros(len(sample), np.int64)
        for batch in batches:
            row, u = batch.column("row").to_numpy(), read(batch)
            cos = sample @ u.T
            near += (cos >= half).sum(1)
            q, j = np.nonzero(cos >= least)
            other = own[q] != row[j]
            q, j = q[other], j[other]
            m1, m2 = grid.margins(u)
            home = grid.home(m1, m2)
            m = np.where(
                s_home[q] > home[j],  # the query visits
                s1[q, home[j] // grid.width] + s2[q, home[j] % grid.width],
                m1[j, s_home[q] // grid.width] + m2[j, s_home[q] % grid.width],
            )
            m[s_home[q] == home[j]] = 0
            np.add.at(seen, (q, np.minimum(np.ceil(m / STEP).astype(np.int64), BINS)), 1)
        q, b = np.nonzero(seen)
        some = np.flatnonzero(near)
        yield pa.RecordBatch.from_pydict(
            {
                "q": pa.array(np.r_[q, some], pa.int64()),
                "b": pa.array(np.r_[b, np.full(len(some), -1)], pa.int64()),
                "n": pa.array(np.r_[seen[q, b], near[some]], pa.int64()),
            }
        )

    found = rows.mapInArrow(_small(run), "q long, b long, n long").groupBy("q", "b").agg(F.sum("n").alias("n")).collect()
    seen, near = np.zeros((len(sample), BINS + 1)), np.zeros(len(sample), np.int64)
    for q, b, n in found:
        if b < 0:
            near[q] = n
        else:
            seen[q, b] = n
    return seen, near


def _small(run, rows: int = 2048):
    """``run`` over batches of at most ``rows`` rows."""
    return lambda batches: run(b.slice(at, rows) for b in batches for at in range(0, len(b), rows))


def _balls(sample: np.ndarray, near: np.ndarray, least: float, block: int) -> np.ndarray:
    """Centres with ``block`` or more rows within half the angle, farther apart than twice the angle."""
    apart = math.cos(min(math.pi, 2 * math.acos(least))) - SURE
    out: list[int] = []
    for q in np.argsort(-near, kind="stable"):
        if near[q] < block or len(out) == BALLS:
            break
        if all(sample[q] @ sample[o] < apart for o in out):
            out.append(int(q))
    return sample[out]


def _ball_of(u: np.ndarray, balls: np.ndarray, half: float) -> np.ndarray:
    """Number of the ball of each row, -1 for none."""
    if not len(balls):
        return np.full(len(u), -1)
    cos = u @ balls.T
    best = cos.argmax(1)
    return np.where(cos[np.arange(len(u)), best] >= half, best, -1)


def _compare(x: np.ndarray, pairs, least: float):
    """(counts, first row of the linked set) of every row, over the given (rows, rows) pairs.

    Rows are compared 512 at a time; only the counts and the sets are kept."""
    count, label = np.zeros(len(x), np.int64), np.arange(len(x))
    for a, b in pairs:
        for at in range(0, len(a) if len(b) else 0, 512):
            i = a[at : at + 512]
            hit = x[i] @ x[b].T >= least
            if a is b:  # each pair once
                hit &= np.arange(len(b)) > (at + np.arange(len(i)))[:, None]
            count[i] += hit.sum(1)
            count[b] += hit.sum(0)
            for k in np.flatnonzero(hit.any(1)):
                joined = np.unique(np.r_[label[i[k]], label[b[hit[k]]]])
                if len(joined) > 1:
                    label[np.isin(label, joined)] = joined[0]
    return count, label


def _copies(cell, member, row, hot: dict):
    """(index, i, j, side) of the groups that each (row, cell) entry goes to.

    A cell's plain rows are dealt into blocks 0 .. p-1, its ball members into blocks
    p .. p+m-1; group (i, j) meets block i with block j.  A cell that is not hot is
    one group (0, 0) with the members on side 1."""
    n = len(cell)
    is_hot = np.isin(cell, np.fromiter(hot, np.int64, len(hot))) if hot else np.zeros(n, bool)
    at = np.flatnonzero(~is_hot)
    zero = np.zeros(len(at), np.int64)
    out = [(at, zero, zero, member[at].astype(np.int64))]
    for c in np.unique(cell[is_hot]):
        p, m = hot[int(c)]
        if not p:  # members only: nothing to compare
            continue
        plain = np.flatnonzero((cell == c) & ~member)
        t = (mix(row[plain].astype(np.uint64)) % np.uint64(p)).astype(np.int64)
        for j in range(p + m):
            out.append((plain, np.minimum(t, j), np.maximum(t, j), (t > j).astype(np.int64)))
        if m:
            inside = np.flatnonzero((cell == c) & member)
            t = (mix(row[inside].astype(np.uint64)) % np.uint64(m)).astype(np.int64)
            for i in range(p):
                out.append((inside, np.full(len(t), i), p + t, np.ones(len(t), np.int64)))
    return [np.concatenate(x) for x in zip(*out)]


def link_near(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    least: float = 0.9,
    target: float = 0.999,
    slack: float = 2.0,
    per_cell: int = 128,
    entries: int = 1024,
    sample: int = 8192,
    queries: int = 1024,
    block: int = 4096,
    stats: dict | None = None,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    ``per_cell``: rows a cell holds on average, which sets the codebook sizes (4 to
    ``entries``); ``stats``, if given, takes the margin, the grid, the recall measured
    on the sample and the number of balls."""
    if not 0.0 < least <= 1.0:
        raise ValueError("least must be above 0 and at most 1")
    kind = vectors.schema[id_col].dataType.simpleString()
    dtype = np.float32 if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else np.float64
    half = math.cos(math.acos(least) / 2) + SURE
    stats = {} if stats is None else stats

    def pack(batches):
        for batch in batches:
            fine = batch.column(2).is_valid()
            raw = iter(raw_column(matrix(batch.column(2).filter(fine)).astype(dtype)).to_pylist())
            vec = [next(raw) if ok else None for ok in fine.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(vec, pa.binary())], ["row", "id", "vec"])

    def read(batch):
        return unit(raw_matrix(batch.column("vec"), dtype).astype(np.float64))

    v = F.col(vec_col)
    some = usable(v) & F.exists(v, lambda c: c != 0)
    sizes = vectors.where(some).groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    size = sizes[0].d if sizes else 0
    numbered = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.when(some & (F.size(v) == size), v.cast("array<double>")).alias("v"),
    )
    everything = stored(numbered.mapInArrow(pack, f"row long, id {kind}, vec binary"), "multiindex-rows")
    rows = everything.where("vec IS NOT NULL")
    n = rows.count()
    if n < 2:
        return everything.select(
            F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
        )

    # what is fitted on the bounded sample: codebooks, margin, balls
    key = F.xxhash64("vec", "id")
    few = rows.where(F.pmod(key, F.lit(n)) < 2 * sample)  # few of the rows that each task would offer otherwise
    top = (few if n > 4 * sample else rows).orderBy(key, "row").limit(sample).collect()
    drawn = unit(np.frombuffer(b"".join(r.vec for r in top), dtype).reshape(len(top), -1).astype(np.float64))
    k = int(min(entries, max(4, math.isqrt(n // per_cell))))
    h = size // 2
    grid = Grid(lloyd_entries(drawn[:, :h], k), lloyd_entries(drawn[:, h:], k))
    asked, own = drawn[:queries], np.array([r.row for r in top[:queries]])
    seen, near = _measure(rows, read, grid, asked, own, least, half)
    linked = seen.sum(1) > 0
    share = np.cumsum((seen[linked] / seen[linked].sum(1, keepdims=True)).mean(0)) if linked.any() else np.ones(BINS + 1)
    if linked.sum() >= 32 and share[BINS - 1] >= target:
        margin = float(np.argmax(share >= target - 1e-12)) * STEP * slack
    else:
        margin = _simulated_margin(grid, asked, least, target)
    balls = _balls(asked, near, least, block)
    stats.update(margin=margin, entries=k, recall=float(share[min(BINS, int(margin / STEP + 1e-9))]), balls=len(balls))

    def place(batch):
        """Unit vectors of a batch, their balls, and (row index, cell, resident) of every cell they go to."""
        u = read(batch)
        m1, m2 = grid.margins(u)
        home, at, cell = grid.visits(m1, m2, margin)
        index = np.r_[np.arange(len(u)), at]
        return u, _ball_of(u, balls, half), index, np.r_[home, cell], np.arange(len(index)) < len(u)

    def sizes_of_cells(batches):
        total: dict = {}
        for batch in batches:
            _, ball, index, cell, _ = place(batch)
            for c, m in zip(cell.tolist(), (ball[index] >= 0).tolist()):
                total[c, m] = total.get((c, m), 0) + 1
        cells = list(total)
        yield pa.RecordBatch.from_pydict(
            {
                "cell": pa.array([c for c, _ in cells], pa.int64()),
                "p": pa.array([0 if m else total[c, m] for c, m in cells], pa.int64()),
                "m": pa.array([total[c, m] if m else 0 for c, m in cells], pa.int64()),
            }
        )

    cells = rows.mapInArrow(_small(sizes_of_cells), "cell long, p long, m long").groupBy("cell").agg(F.sum("p").alias("p"), F.sum("m").alias("m"))
    hot = {r.cell: (-(-r.p // block), -(-r.m // block)) for r in cells.where(F.col("p") + F.col("m") > block).collect()}

    def deal(batches):
        for batch in batches:
            _, ball, index, cell, resident = place(batch)
            row = batch.column("row").to_numpy()
            at, i, j, side = _copies(cell, ball[index] >= 0, row[index], hot)
            for s in range(0, len(at), 4096):
                e = at[s : s + 4096]
                take = pa.array(index[e])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell[e]),
                        pa.array(i[s : s + 4096], pa.int32()),
                        pa.array(j[s : s + 4096], pa.int32()),
                        pa.array(side[s : s + 4096].astype(bool)),
                        pa.array(resident[e]),
                        pa.array(ball[index[e]], pa.int32()),
                        *(c.take(take) for c in batch.columns),
                    ],
                    ["cell", "i", "j", "side", "resident", "ball", "row", "id", "vec"],
                )

    def verify(key, group):
        if len(group) < 2:
            return _links_table(group, np.zeros(0, np.int64), None, None)
        x = unit(raw_matrix(group.column("vec"), dtype).astype(np.float64))
        side, here = group.column("side").to_numpy(), group.column("resident").to_numpy()
        own, away = np.flatnonzero(~side & here), np.flatnonzero(~side & ~here)
        own1, away1 = np.flatnonzero(side & here), np.flatnonzero(side & ~here)
        pairs = [(own, own1), (own, away1), (away, own1)]
        if key[1].as_py() == key[2].as_py():
            pairs = [(own, own), (own, away), *pairs]
        count, label = _compare(x, pairs, least)
        return _links_table(group, np.flatnonzero(count), count, label)

    shape = f"row long, id {kind}, ball int, n long, root_row long, root_id {kind}, root_ball int"
    dealt = rows.mapInArrow(_small(deal), f"cell long, i int, j int, side boolean, resident boolean, ball int, row long, id {kind}, vec binary")
    links = stored(dealt.groupBy("cell", "i", "j").applyInArrow(verify, shape), "multiindex-links")

    # every ball is one node; members count each other
    def members(batches):
        for batch in batches:
            ball = _ball_of(read(batch), balls, half)
            keep = pa.array(ball >= 0)
            columns = [batch.column("row"), batch.column("id"), pa.array(ball, pa.int32())]
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in columns], ["row", "id", "ball"])

    node = F.struct(F.col("id").isNull().alias("z"), F.col("id"), F.col("row"))
    inside = rows.mapInArrow(_small(members), f"row long, id {kind}, ball int")
    ball_nodes = inside.groupBy("ball").agg(F.count("*").alias("size"), F.min(node).alias("node")) if len(balls) else None
    if ball_nodes is not None:
        ball_nodes = stored(ball_nodes, "multiindex-balls")

    def node_of(prefix: str, df: DataFrame) -> DataFrame:
        own_node = F.struct(F.col(prefix + "id").isNull().alias("z"), F.col(prefix + "id").alias("id"), F.col(prefix + "row").alias("row"))
        if ball_nodes is None:
            return df.withColumn(prefix + "node", own_node)
        known = F.broadcast(ball_nodes.select(F.col("ball").alias(prefix + "ball"), F.col("node").alias("_n")))
        return df.join(known, prefix + "ball", "left").withColumn(prefix + "node", F.coalesce("_n", own_node)).drop("_n")

    edges = node_of("root_", node_of("", links.where("row <> root_row"))).select(F.col("node").alias("a"), F.col("root_node").alias("b"))
    found = stored(components(edges.where("a <> b").distinct()), "multiindex-components")
    counts = links.select("row", "id", "ball", "n")
    if ball_nodes is not None:
        sized = inside.join(F.broadcast(ball_nodes.select("ball", "size")), "ball")
        counts = counts.unionByName(sized.select("row", "id", "ball", (F.col("size") - 1).alias("n")))
    counts = node_of("", counts.groupBy("row").agg(F.first("id").alias("id"), F.first("ball").alias("ball"), F.sum("n").alias("n_links")))
    plain = counts.where("ball < 0").join(found, "node", "left").select("row", "n_links", F.coalesce("component", "node").alias("component"))
    if ball_nodes is not None:  # at most BALLS rows
        of_ball = ball_nodes.join(found, "node", "left").select("ball", F.coalesce("component", "node").alias("component"))
        plain = plain.unionByName(counts.join(F.broadcast(of_ball), "ball").select("row", "n_links", "component"))
    out = everything.select("row", "id").join(plain, "row", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component.id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _links_table(group: pa.Table, some: np.ndarray, count, label) -> pa.Table:
    """Rows of a group that have links, with the first row of their linked set."""
    own, root = group.take(pa.array(some)), group.take(pa.array(label[some] if len(some) else some))
    return pa.table(
        {
            "row": own.column("row"),
            "id": own.column("id"),
            "ball": own.column("ball"),
            "n": pa.array(count[some] if len(some) else some, pa.int64()),
            "root_row": root.column("row"),
            "root_id": root.column("id"),
            "root_ball": root.column("ball"),
        }
    )
