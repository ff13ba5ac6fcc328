"""Exact quantiles with linear interpolation, without a sort of the data.

The two order statistics around ``q * (n - 1)`` are bracketed by approximate
quantiles; one aggregation counts the values below and inside every bracket (so
a bracket that misses its rank is seen and widened, never trusted); brackets that
still hold many values are narrowed inside themselves; and only the few values
left in a bracket are gathered.  All columns, probabilities and groups share each
pass, and every pass is a partial aggregation over one stored narrow table: no
exchange carries the values and no key holds a column.

Interpolation: ``lo + (hi - lo) * (pos - floor(pos))`` with ``pos = q*(n-1)``
(0-based ranks), the rule of pandas ``quantile`` / numpy 'linear'.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stressframe.session import cut_lineage

ACCURACY = 10_000
GATHER = 10_000  # distinct values of one bracket that may reach the driver


@dataclass
class QTarget:
    """One (group, column, probability): the bracket [low, high] holds both ranks."""

    group: tuple
    column: int
    prob: float
    n: int
    low: float
    high: float
    below: int = 0  # values under low
    inside: int = 0

    @property
    def pos(self) -> float:
        return self.prob * (self.n - 1)


def _value(by: tuple[str, ...], group: tuple, column: int) -> Column:
    """The column's value in rows of the group, else NULL."""
    same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, group)]
    v = F.col(f"_v{column}")
    return F.when(functools.reduce(Column.__and__, same), v) if same else v


def _narrow(data: DataFrame, by, todo: list[QTarget]) -> None:
    """Tighten the brackets of ``todo`` by approximate quantiles inside them, then count."""
    asked = []
    for i, t in enumerate(todo):
        v = _value(by, t.group, t.column)
        inner = F.when((v >= t.low) & (v <= t.high), v)
        at = [(math.floor(t.pos) - t.below) / max(1, t.inside), (math.ceil(t.pos) - t.below + 1) / max(1, t.inside)]
        span = 2.0 / ACCURACY
        asked.append(F.percentile_approx(inner, [max(0.0, at[0] - span), min(1.0, at[1] + span)], ACCURACY).alias(f"q{i}"))
    row = data.agg(*asked).first()
    tight = [tuple(row[f"q{i}"]) for i in range(len(todo))]
    counts = []
    for i, (t, (low, high)) in enumerate(zip(todo, tight)):
        v = _value(by, t.group, t.column)
        counts += [F.count_if(v < low).alias(f"b{i}"), F.count_if((v >= low) & (v <= high)).alias(f"i{i}")]
    row = data.agg(*counts).first()
    for i, (t, (low, high)) in enumerate(zip(todo, tight)):
        b, n = row[f"b{i}"], row[f"i{i}"]
        if b <= math.floor(t.pos) and math.ceil(t.pos) < b + n:
            t.low, t.high, t.below, t.inside = low, high, b, n
        elif b > math.floor(t.pos):  # the rank lies under the new bracket: keep the part up to it
            t.high, t.inside = high, b + n - t.below
        else:
            t.inside, t.low, t.below = t.below + t.inside - b, low, b


def _targets(data: DataFrame, cols: list[str], probs: list[float], by: tuple[str, ...]) -> list[QTarget]:
    aggs = [F.struct(F.count(f"_v{i}").alias("n"), F.min(f"_v{i}").alias("lo"), F.max(f"_v{i}").alias("hi")).alias(f"s{i}") for i in range(len(cols))]
    out = []
    for row in data.groupBy(*by).agg(*aggs).collect():  # the caller's groups
        for i in range(len(cols)):
            s = row[f"s{i}"]
            if s["n"]:
                out += [QTarget(tuple(row[c] for c in by), i, float(p), s["n"], s["lo"], s["hi"], 0, s["n"]) for p in probs]
    return out


def value_columns(df: DataFrame, cols: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """The columns as doubles ``_v0``, ``_v1``, ... without NaN, after ``by``."""
    x = [F.col(c).cast("double") for c in cols]
    return df.select(*by, *[F.when(~F.isnan(v), v).alias(f"_v{i}") for i, v in enumerate(x)])


def _count(data: DataFrame, by, targets: list[QTarget]) -> None:
    """Values below and inside given brackets; a bracket that misses its ranks is opened."""
    todo = list(targets)
    while todo:
        counts = []
        for i, t in enumerate(todo):
            v = _value(by, t.group, t.column)
            counts += [F.count_if(v < t.low).alias(f"b{i}"), F.count_if((v >= t.low) & (v <= t.high)).alias(f"i{i}"),
                       F.count(v).alias(f"n{i}"), F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}")]
        row, again = data.agg(*counts).first(), []
        for i, t in enumerate(todo):
            t.n, t.below, t.inside = row[f"n{i}"], row[f"b{i}"], row[f"i{i}"]
            if t.n and not (t.below <= math.floor(t.pos) and math.ceil(t.pos) < t.below + t.inside):
                t.low, t.high = row[f"l{i}"], row[f"h{i}"]
                again.append(t)
            elif t.n:  # no wider than the values
                t.low, t.high = max(t.low, row[f"l{i}"]), min(t.high, row[f"h{i}"])
        todo = again


def quantile_rows(
    df: DataFrame, cols: list[str], probs: list[float], by: tuple[str, ...] = (), gather: int = GATHER
) -> list[dict]:
    """{*by, column, prob, value} for each group, column and probability; NULL and NaN
    are left out, a column without values has no row."""
    by, cols = tuple(by), list(cols)
    data = cut_lineage(value_columns(df, cols, by))
    return resolve(data, by, cols, _targets(data, cols, probs, by), gather)


def resolve(data: DataFrame, by: tuple[str, ...], cols: list[str], targets: list[QTarget], gather: int = GATHER, counted: bool = True) -> list[dict]:
    """Exact values of bracketed quantiles over ``value_columns`` data.

    ``counted``: whether the brackets' counts are known already."""
    if not counted:
        data = cut_lineage(data)
        _count(data, by, targets)
        targets = [t for t in targets if t.n]
    while todo := [t for t in targets if t.low < t.high and t.inside > gather]:
        before = [t.inside for t in todo]
        _narrow(data, by, todo)
        if [t.inside for t in todo] == before:
            break  # a few values with many copies each: their counts fit
    open_ = [t for t in targets if t.low < t.high]
    found: dict[int, list[tuple[float, int]]] = {}
    if open_:
        items = []
        for i, t in enumerate(open_):
            v = _value(by, t.group, t.column)
            items.append(F.when((v >= t.low) & (v <= t.high), F.struct(F.lit(i).alias("i"), v.alias("v"))))
        inside = data.select(F.inline(F.array_compact(F.array(*items))))
        for r in inside.groupBy("i", "v").count().collect():
            found.setdefault(r["i"], []).append((r["v"], r["count"]))
    out = []
    for t in targets:
        a, b = math.floor(t.pos), math.ceil(t.pos)
        picks = {}
        if t.low == t.high:
            picks = {a: t.low, b: t.low}
        else:
            at = t.below
            for v, n in sorted(found[open_.index(t)]):
                for rank in (a, b):
                    if at <= rank < at + n:
                        picks[rank] = v
                at += n
        value = picks[a] + (picks[b] - picks[a]) * (t.pos - a) if a != b else picks[a]
        out.append({**dict(zip(by, t.group)), "column": cols[t.column], "prob": t.prob, "value": value})
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], by: tuple[str, ...] = (), gather: int = GATHER) -> DataFrame:
    """Rows (*by, column, prob, value): ``quantile_rows`` as a small frame."""
    rows = quantile_rows(df, cols, probs, by, gather)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in by), "column string", "prob double", "value double"])
    names = [*by, "column", "prob", "value"]
    return df.sparkSession.createDataFrame([tuple(r[c] for c in names) for r in rows], schema)


def quantile_map(df: DataFrame, cols: list[str], prob: float) -> dict[str, float]:
    """Driver-side {column: quantile} (one value per column: bounded)."""
    return {r["column"]: r["value"] for r in quantile_rows(df, cols, [prob])}
