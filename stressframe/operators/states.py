"""Mergeable statistics kept per part of a growing table (AGG-7, AGG-8, AGG-10, AGG-12, FEA-27).

A table that grows by parts (weeks) is profiled part by part: each part's state is
written once, states are merged without reading earlier rows again, and a part that is
added again replaces its own state.

``MomentStore`` keeps exact moments: counts, sums, sums of squares, smallest and
largest value per (part, label, column), sums as whole numbers of millionths in
decimals.  Merged moments are therefore the same in whatever order parts came, and
means, deviations and correlations follow in exact arithmetic.

``QuantileStore`` keeps a quantile sketch per (part, column).  The merged sketches give
brackets around a quantile; the rows inside are then narrowed and counted exactly, so
the sketch decides the work, never the value.

Results in special cases: missing and NaN values have no part in any state; infinite
values are an error of the moments (no decimal holds them); values are rounded to
millionths in the moments (the smallest and largest are not); a label that is missing
is a label of its own and has no part in correlations; no parts give no rows.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stressframe.operators.quantile import GATHER, QTarget, resolve, value_columns

UNIT = 1_000_000


class _Parts:
    """States by part in one folder; adding a part overwrites that part alone."""

    def __init__(self, spark: SparkSession, path: str, part: str):
        self.spark, self.path, self.part = spark, path, part

    def _write(self, states: DataFrame) -> None:
        states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.part).parquet(self.path)

    def _read(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None


class MomentStore(_Parts):
    """Exact moments of ``columns`` by ``label`` (0/1 for correlations), per ``part``."""

    def __init__(self, spark: SparkSession, path: str, columns: list[str], label: str, part: str = "week_number"):
        super().__init__(spark, path, part)
        self.columns, self.label = list(columns), label

    def add(self, rows: DataFrame) -> None:
        """States of the parts that ``rows`` hold (whole parts)."""
        aggs = []
        for i, c in enumerate(self.columns):
            x = F.col(c).cast("double")
            x = F.when(~F.isnan(x), x)
            units = F.round(x * UNIT).cast("decimal(19,0)")
            square = (units * units).cast("decimal(38,0)")
            aggs.append(
                F.struct(
                    F.lit(c).alias("column"),
                    F.count(x).alias("n"),
                    F.sum(units.cast("decimal(38,0)")).alias("total"),
                    F.sum(square).alias("squares"),
                    F.min(x).alias("low"),
                    F.max(x).alias("high"),
                ).alias(f"s{i}")
            )
        states = rows.groupBy(self.part, F.col(self.label).alias("label")).agg(*aggs)
        self._write(states.select(self.part, "label", F.inline(F.array(*[F.col(f"s{i}") for i in range(len(self.columns))]))))

    def merged(self) -> DataFrame | None:
        """(label, column, n, total, squares, low, high) over all parts."""
        states = self._read()
        if states is None:
            return None
        sums = [F.sum(c).cast("decimal(38,0)").alias(c) for c in ("total", "squares")]
        return states.groupBy("label", "column").agg(F.sum("n").alias("n"), *sums, F.min("low").alias("low"), F.max("high").alias("high"))

    def _cells(self) -> list:
        """Merged states: labels x columns."""
        merged = self.merged()
        return [] if merged is None else [r for r in merged.collect() if r.column in self.columns]

    def stats(self) -> DataFrame:
        """(label, feature, n, mean, std, min, max), sample deviation."""
        rows = []
        for r in self._cells():
            n, s, q = r.n, int(r.total or 0), int(r.squares or 0)
            mean = float(Fraction(s, n * UNIT)) if n else None
            std = math.sqrt(Fraction(n * q - s * s, n * (n - 1) * UNIT * UNIT)) if n > 1 else None
            rows.append((r.label, r.column, n, mean, std, r.low, r.high))
        return self.spark.createDataFrame(rows, "label int, feature string, n long, mean double, std double, min double, max double")

    def correlations(self) -> DataFrame:
        """(column, correlation) with a 0/1 label, NULL where one side is constant."""
        cells = [r for r in self._cells() if r.label is not None]
        rows = []
        for c in self.columns:
            own = [r for r in cells if r.column == c]
            n, sx, sq = (sum(int(r[k] or 0) for r in own) for k in ("n", "total", "squares"))
            sy = sum(r.label * r.n for r in own)
            syy = sum(r.label * r.label * r.n for r in own)
            sxy = sum(r.label * int(r.total or 0) for r in own)
            spread = (n * sq - sx * sx) * (n * syy - sy * sy)
            top = n * sxy - sx * sy
            r2 = math.sqrt(Fraction(top * top, spread)) if spread > 0 else None
            rows.append((c, None if r2 is None else math.copysign(r2, top)))
        return self.spark.createDataFrame(rows, "column string, correlation double")


class QuantileStore(_Parts):
    """Quantile sketches of ``columns`` per ``part``, and exact quantiles from their brackets."""

    def __init__(self, spark: SparkSession, path: str, columns: list[str], part: str = "week_number", k: int = 400):
        super().__init__(spark, path, part)
        self.columns, self.k = list(columns), k

    def add(self, rows: DataFrame) -> None:
        """Sketches of the parts that ``rows`` hold (whole parts)."""
        values = value_columns(rows, self.columns, (self.part,))
        aggs = [
            F.struct(F.lit(c).alias("column"), F.count(f"_v{i}").alias("n"), F.kll_sketch_agg_double(f"_v{i}", self.k).alias("sketch")).alias(f"s{i}")
            for i, c in enumerate(self.columns)
        ]
        states = values.groupBy(self.part).agg(*aggs)
        self._write(states.select(self.part, F.inline(F.array(*[F.col(f"s{i}") for i in range(len(self.columns))]))))

    def merged(self) -> DataFrame | None:
        """(column, n, sketch) over all parts."""
        states = self._read()
        if states is None:
            return None
        return states.where("n > 0").groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))

    def brackets(self, probs: list[float], error: float = 0.01) -> list[QTarget]:
        """Sketch values around each quantile, ``error`` of rank to both sides."""
        merged = self.merged()
        if merged is None:
            return []
        ranks = [x for p in probs for x in (max(0.0, p - error), min(1.0, p + error))]
        told = merged.select("column", "n", F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, ranks))).alias("q")).collect()
        out = []
        for r in (r for r in told if r.column in self.columns):
            for k, p in enumerate(probs):
                low = r.q[2 * k] if ranks[2 * k] > 0 else -math.inf
                high = r.q[2 * k + 1] if ranks[2 * k + 1] < 1 else math.inf
                out.append(QTarget((), self.columns.index(r.column), p, r.n, low, high))
        return out

    def quantiles(self, rows: DataFrame, probs: list[float], error: float = 0.01, gather: int = GATHER) -> DataFrame:
        """(column, prob, value): exact over ``rows``, the table whose parts were added.

        Rows are read to count below and inside the brackets; a bracket that misses
        its rank is widened."""
        found: list[dict] = []
        targets = self.brackets(probs, error)
        if targets:
            found = resolve(value_columns(rows, self.columns), (), self.columns, targets, gather, counted=False)
        return self.spark.createDataFrame([(r["column"], r["prob"], r["value"]) for r in found], "column string, prob double, value double")
