"""Operators on vectors against brute force: codes, near duplicates."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from stressframe.llm import lloyd, multiindex

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)
    return df.selectExpr("*", "7 AS row", "8 AS id", "9 AS ball", "'x' AS codes", "5 AS error", "6 AS _l")


def full_rescans(rows, parts, entries, rounds):
    """{id: (code, error, label error)} and the digest of the codebooks, by complete rescans."""
    rows = sorted((r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])), key=lambda r: r[0])
    x = np.floor(256 * np.array([r[1] for r in rows], np.float64)).astype(np.int64).reshape(len(rows), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    for k in range(rounds + 1):
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        codes, dist = d.argmin(2), d.min(2)
        if k < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    own = codes[:, p] == e
                    if own.any():
                        books[p, e] = x[own, p].sum(0) // own.sum()
    errors = dist.sum(1)
    by_label: dict = {}
    for r, e in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + int(e)
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return {r[0]: (bytes(c.tolist()).hex(), int(e), by_label[r[2]]) for r, c, e in zip(rows, codes, errors)}, sha


def coded(df, **kw):
    got = lloyd.codes_with_errors(df, **kw).collect()
    return {r.vec_id: (r.code, r.error, r.label_error) for r in got}, {r.codebooks_sha256 for r in got}, len(got)


@pytest.mark.parametrize("kw", [dict(parts=4, entries=8, rounds=3), dict(parts=16, entries=64, rounds=2), dict(parts=2, entries=3, rounds=0)])
def test_codes_equal_full_rescans(spark, kw):
    rng = np.random.default_rng(3)
    rows = [(int(7 * k - 300), [float(np.float32(c)) for c in rng.normal(0, 0.3, 32)], None if k % 5 == 0 else int(k % 3)) for k in range(150)]
    rows[20:40] = [(r[0], [round(c, 1) for c in r[1]], r[2]) for r in rows[20:40]]  # ties
    rows[50:60] = [(r[0], rows[3][1], r[2]) for r in rows[50:60]]  # repeated vectors
    odd = [(9001, None, 1), (9002, [], 1), (9003, [0.1] * 31 + [None], 1), (9004, [NAN] + [0.0] * 31, 1), (9005, [-INF] * 32, 1)]
    got, shas, n = coded(vectors(spark, rows + odd), **kw)
    want, sha = full_rescans(rows, **kw)
    assert got == want and shas == {sha} and n == len(rows)


def test_active_entries_keep_lower_index_ties():
    """An unmoved entry against a moved one at the same distance, on both sides of its index."""
    x = np.array([[[0, 0]], [[2, 0]]])
    books = np.array([[[9, 9], [1, 0], [50, 50]]])
    codes, dist = lloyd.assign(x, books)
    moved_to = books.copy()
    moved_to[0, 0], moved_to[0, 2] = (0, 1), (2, 1)
    moved = (moved_to != books).any(2)
    again = lloyd.assign(x, moved_to, (codes, dist, moved))
    full = lloyd.assign(x, moved_to)
    assert (again[0] == full[0]).all() and (again[1] == full[1]).all() and again[0].ravel().tolist() == [0, 1]


def test_codes_special(spark):
    assert coded(vectors(spark, []), parts=4)[2] == 0
    few = [(3, [1.0, -1.0], 1), (1, [0.0, 0.0], 1), (1, [0.0, 0.0], None)]
    got = lloyd.codes_with_errors(vectors(spark, few), parts=2).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == [(1, "0000", 0), (1, "0000", 0), (3, "0202", 0)]
    null_id = lloyd.codes_with_errors(vectors(spark, [(None, [1.0, 1.0], 1), (5, [0.0, 0.0], 1)]), parts=2, entries=1).collect()
    assert {r.vec_id: r.code for r in null_id} == {None: "0000", 5: "0000"}
    with pytest.raises(Exception, match="equal parts"):
        coded(vectors(spark, [(1, [1.0] * 5, 1)]), parts=2)
    with pytest.raises(Exception, match="too large"):
        coded(vectors(spark, [(1, [1e30] * 4, 1)], "double"), parts=2)


def test_large_components_stay_exact():
    big = np.array([[[2**27, 2**27 - 1]], [[-(2**27), 5]]])
    codes, dist = lloyd.assign(big, np.array([[[2**27, 2**27], [0, 0]]]))
    assert codes.ravel().tolist() == [0, 1] and dist.ravel().tolist() == [1, 2**54 + 25]


def links_of(rows, least=0.9):
    """[(n_links, smallest id reached)] by comparing all pairs."""
    unit = []
    for _, v, _ in rows:
        ok = v and all(c is not None and math.isfinite(c) for c in v) and any(v)
        unit.append(np.array(v, np.float64) / np.linalg.norm(v) if ok else None)
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    low: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return [(r[0], n[i], low.get(find(i))) for i, r in enumerate(rows)]


def families(seed=4, plain=150, family=60):
    rng = np.random.default_rng(seed)
    rows = [(int(k * 11 + 5), rng.normal(size=24).tolist(), 0) for k in range(plain)]
    for f in range(3):
        centre = rng.normal(size=24)
        size = family if f == 0 else 12
        spread = (0.02, 0.1, 0.3)[f]
        rows += [(int(3000 - 13 * k - f), (s * (centre + spread * rng.normal(size=24))).tolist(), 0) for k, s in enumerate(rng.uniform(0.1, 9, size))]
    for k in range(12):  # single copies
        v = np.array(rows[k][1])
        rows.append((int(5000 + k), (v + 0.12 * rng.normal(size=24)).tolist(), 0))
    return rows


@pytest.mark.parametrize(
    "kw",
    [dict(), dict(block=20), dict(block=20, queries=4), dict(per_cell=2, target=1.0), dict(block=7, per_cell=1000, queries=2)],
)
def test_near_vectors(spark, kw):
    rows = families()
    stats: dict = {}
    got = multiindex.link_near(vectors(spark, rows, "double"), stats=stats, **kw).collect()
    want = links_of(rows)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    if kw == dict(block=20):
        assert stats["balls"] >= 1  # the dense family is counted, not compared


def test_recall_on_given_vectors(spark):
    """Planted copies at all cosines from 0.9 on, against all pairs of a given table."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    rng = np.random.default_rng(6)
    rows = [(r.vec_id, list(r.embedding), 0) for r in table]
    for k in range(400):
        v = np.array(rows[k][1])
        d = rng.normal(size=len(v))
        d -= d @ v / (v @ v) * v
        c = rng.uniform(0.901, 0.999)
        rows.append((100_000 + k, (v / np.linalg.norm(v) * c + d / np.linalg.norm(d) * math.sqrt(1 - c * c)).tolist(), 0))
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.9).sum(1) - 1
    got = {r.vec_id: r.n_links for r in multiindex.link_near(vectors(spark, rows, "double")).collect()}
    found = [got[r[0]] for r in rows]
    assert (np.array(found) <= want).all() and sum(found) >= 0.97 * want.sum() and want.sum() >= 800


def test_near_vectors_special(spark):
    v = [1.0, 2.0, 3.0, -1.0]
    rows = [(None, v, 0), (4, v, 0), (4, v, 0), (9, [2 * c for c in v], 0), (1, None, 0), (2, [0.0] * 4, 0), (3, [NAN] * 4, 0)]
    rows += [(5, [1.0], 0), (6, [], 0), (7, [None, 1.0, 1.0, 1.0], 0), (8, [1e30 * c for c in v], 0), (10, [INF] * 4, 0), (None, [-1.0, 1.0, 0.5, 2.0], 0)]
    got = multiindex.link_near(vectors(spark, rows)).collect()
    want = [(i, n, 4 if n else i, n == 0 or i == 4) for i, n, _ in links_of(rows)]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert multiindex.link_near(vectors(spark, [])).collect() == []
    alone = multiindex.link_near(vectors(spark, [(3, v, 0), (2, None, 0)])).collect()
    assert sorted(map(tuple, alone)) == [(2, 0, 2, True), (3, 0, 3, True)]
