"""L3: stream scoring - the app's record-at-a-time loop re-aimed as a stateless Structured Streaming job.

Records arrive as files in a folder (explicit schema, no inference); each micro-batch goes through the same
fitted feature model (stream-static joins with its state tables) and classifier as batch scoring (L2) and is
appended to a Parquet sink with a checkpoint folder, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskflow.operators.encode import ManualFeaturesModel
from riskflow.operators.score import assemble_manual, with_prediction

RECORD_SCHEMA = T.StructType([
    T.StructField("TransactionID", T.LongType()),
    T.StructField("TransactionAmt", T.DoubleType()),
    T.StructField("card1", T.LongType()),
    T.StructField("addr1", T.DoubleType()),
    T.StructField("DeviceType", T.StringType()),
    T.StructField("DeviceInfo", T.StringType()),
    T.StructField("P_emaildomain", T.StringType()),
])


def scoring_stream(spark: SparkSession, source_dir: str, features: ManualFeaturesModel, clf,
                   schema: T.StructType = RECORD_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """The streaming DataFrame of scored records (TransactionID, p, label, risk_level)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    records = reader.parquet(source_dir)
    x = assemble_manual(features.transform(records, keep=["TransactionID"]))
    return with_prediction(clf.transform(x)).select("TransactionID", "p", "label", "risk_level")


def score_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                 features: ManualFeaturesModel, clf, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """Run the stream into ``sink_dir`` (append, checkpointed): process what is there and stop. Returns the sink read
    back as a table. (A continuous run starts ``scoring_stream`` with its own trigger.)"""
    q = (scoring_stream(spark, source_dir, features, clf, schema)
         .writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True))
    q.start(sink_dir).awaitTermination()
    return spark.read.schema("TransactionID long, p double, label int, risk_level string").parquet(sink_dir)
