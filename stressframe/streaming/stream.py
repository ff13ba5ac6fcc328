"""The stateless path on Structured Streaming (FLT, FEA with frozen caps, POL).

Cleaning, features and the risk policy are row expressions, so the same
functions apply to a ``readStream`` frame. Quantile caps cannot be refitted on
a stream: a ``ClipLimitsModel`` fitted on a batch table is applied as literals.
No state, watermark or window is needed (the reference has none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stressframe.functions.columns import nan_to_null_all
from stressframe.operators.clean import clean
from stressframe.operators.features import ClipLimitsModel, add_features
from stressframe.operators.policy import assess
from stressframe.schemas import V2, detect_target


def statement_stream(spark: SparkSession, path: str, schema: T.StructType = V2, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of statement files with the batch reader's rules: CSV columns bind by
    header name (the header of the files that are there at the start; a later file
    with another header is an error, not a silent swap), NaN becomes NULL."""
    if fmt == "csv":
        names = spark.read.option("header", True).csv(path).columns
        kinds = {f.name: f.dataType for f in schema.fields}
        text = T.StructType([T.StructField(c, T.StringType()) for c in names])
        reader = spark.readStream.schema(text).format("csv").option("header", True).option("enforceSchema", False)
    else:
        reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(path)
    if fmt == "csv":
        df = df.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in names])
    return nan_to_null_all(df)


def score_statements(df: DataFrame, caps: ClipLimitsModel | None = None, base: str = "unified_stress_index",
                     feature_set: str = "v2") -> DataFrame:
    """clean -> features -> frozen caps -> policy; batch or streaming input."""
    target = detect_target(df)
    out = add_features(clean(df, target), feature_set)
    if caps is not None:
        out = caps.transform(out)
    return assess(out, base)


def start_to_parquet(df: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    """Append scored rows to Parquet; the checkpoint makes restarts exactly-once."""
    writer = df.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def stream_scored_statements(spark: SparkSession, statements: DataFrame, caps: ClipLimitsModel,
                             workdir: str, files_per_trigger: int | None = None) -> DataFrame:
    """Land ``statements`` as files (as many as the table has partitions), score them
    with a Structured Streaming query (exactly-once parquet sink) and return what
    the stream wrote. ``workdir`` must be shared storage on a cluster."""
    import uuid

    run = uuid.uuid4().hex
    src, out, ckpt = (f"{workdir}/stream-{run}/{p}" for p in ("in", "out", "ckpt"))
    statements.write.parquet(src)
    stream = score_statements(statement_stream(spark, src, schema=statements.schema, max_files_per_trigger=files_per_trigger), caps)
    query = start_to_parquet(stream.drop("factors", "actions"), out, ckpt)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.parquet(out)
