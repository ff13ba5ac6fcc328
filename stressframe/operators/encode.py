"""Encoding and preparation (ENC-1..5, AGG-17).

Fitted state is tiny (category levels, per-column median / mean / std) and is
applied as literal Column expressions: scoring never re-derives levels from the
batch being scored.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stressframe.functions.columns import non_finite_to_null
from stressframe.operators.quantile import quantile_rows

MAX_LEVELS = 10_000  # default of ``maxLevels``: one-hot is for low-cardinality columns


class OneHot(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """pandas ``get_dummies(drop_first=True)``: one 0/1 column per sorted level
    except the first; a missing value is all zeros. Output column name
    ``<col>_<level>``; the source column is dropped."""

    dropFirst = Param(Params._dummy(), "dropFirst", "drop the first sorted level", TypeConverters.toBoolean)
    maxLevels = Param(Params._dummy(), "maxLevels", "levels that may reach the driver; more is an error", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, dropFirst=True, maxLevels=MAX_LEVELS):
        super().__init__()
        self._setDefault(dropFirst=True, maxLevels=MAX_LEVELS)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "OneHotModel":
        cols = self.getInputCols()
        most = self.getOrDefault(self.maxLevels)
        levels = []
        for c in cols:
            # distinct levels (shuffle with map-side dedup); at most maxLevels + 1 reach the driver
            vals = sorted(
                r[0]
                for r in df.select(F.col(c).cast("string")).where(F.col(c).isNotNull()).distinct()
                .limit(most + 1).collect()
            )
            if len(vals) > most:
                raise ValueError(f"{c} has {len(vals)} levels; drop identifier columns or raise maxLevels ({most})")
            if self.getOrDefault(self.dropFirst):
                vals = vals[1:]
            levels.append("\u0001".join(vals))
        return OneHotModel(inputCols=cols, levels=levels)


class OneHotModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    levels = Param(Params._dummy(), "levels", "kept levels per column, \\x01-joined", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, levels=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        encoded = {}
        for c, joined in zip(self.getInputCols(), self.getOrDefault(self.levels)):
            lv = [v for v in joined.split("\u0001") if v != ""] if joined else []
            encoded[c] = [
                F.when(F.col(c).cast("string") == v, F.lit(1)).otherwise(F.lit(0)).alias(f"{c}_{v}") for v in lv
            ]
        out = []
        for name in df.columns:
            out.extend(encoded.get(name, [F.col(name)]))
        return df.select(*out)


def fill_non_finite(df: DataFrame, value: float = 0.0, cols: list[str] | None = None) -> DataFrame:
    """+-inf -> missing -> ``value`` in floating columns, NULL -> ``value`` in
    integral ones (ENC-4: ``replace([inf, -inf], nan).fillna(0)``)."""
    cols = cols or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        t = types[c]
        if c in cols and isinstance(t, (T.DoubleType, T.FloatType)):
            out.append(F.coalesce(non_finite_to_null(c), F.lit(float(value))).alias(c))
        elif c in cols and isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            out.append(F.coalesce(F.col(c), F.lit(int(value)).cast(t)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


class ImputeScale(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Median imputation then standard scaling with the population std, fitted
    on the imputed values (AGG-17 / ENC-5: scikit-learn's SimpleImputer +
    StandardScaler; Spark's StandardScaler would divide by n-1). A zero std
    scales by 1."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ImputeScaleModel":
        cols = self.getInputCols()
        med = {r["column"]: r["value"] for r in quantile_rows(df, cols, [0.5])}
        filled = [F.coalesce(F.col(c).cast("double"), F.lit(med.get(c))) for c in cols]
        row = df.agg(
            *[F.avg(x).alias(f"m{i}") for i, x in enumerate(filled)],
            *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)],
        ).first()
        means = [float(row[f"m{i}"]) if row[f"m{i}"] is not None else 0.0 for i in range(len(cols))]
        stds = [float(row[f"s{i}"]) if row[f"s{i}"] else 1.0 for i in range(len(cols))]
        medians = [float(med[c]) if med.get(c) is not None else 0.0 for c in cols]
        return ImputeScaleModel(inputCols=cols, medians=medians, means=means, stds=stds)


class ImputeScaleModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "fill values", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "centres", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "scales", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, medians=None, means=None, stds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        spec = dict(
            zip(
                self.getInputCols(),
                zip(self.getOrDefault(self.medians), self.getOrDefault(self.means), self.getOrDefault(self.stds)),
            )
        )
        out = []
        for c in df.columns:
            if c in spec:
                med, mu, sd = spec[c]
                out.append(((F.coalesce(F.col(c).cast("double"), F.lit(med)) - F.lit(mu)) / F.lit(sd)).alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)
