"""ST1: streaming scoring of feature requests (JSON in, scores out).

``start_model_stream`` scores with the model that the registry names when a micro-batch starts: a
promotion takes effect with the next batch, without a restart.  Every batch is written to a
folder of its own number, which a repeated batch replaces.

``start_scoring_stream`` takes a fixed scorer:

``readStream.text`` over a folder of request files -> the same projection as
the batch per-request scorer -> parquet sink (append; stateless, so every
micro-batch is independent and exactly-once through the checkpoint).
``availableNow`` processes what is there and stops, which makes the job
schedulable like a batch job and restartable after executor or driver loss.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting as B
from ..operators import registry as RG
from ..operators.model import score_requests


def start_scoring_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                         scorer=None, max_files_per_trigger: int = 100, available_now: bool = True):
    """Start the scoring stream; returns the StreamingQuery."""
    requests = (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
                .text(source_dir).withColumnRenamed("value", "payload"))
    scored = score_requests(requests, scorer)
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_dir).option("path", sink_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def run_scoring_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                       scorer=None) -> DataFrame:
    """Run to completion (availableNow) and return the sink as a DataFrame."""
    q = start_scoring_stream(spark, source_dir, sink_dir, checkpoint_dir, scorer)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(sink_dir)


class RegistryModel:
    """The model in use: the registry's production version, else its newest staging one.
    A loaded version is kept, since versions never change."""

    def __init__(self, registry: Callable[[], DataFrame], models_dir: str):
        self.registry, self.models_dir, self.held = registry, models_dir, (None, None)

    def resolve(self, spark: SparkSession) -> tuple[str, B.Booster]:
        best = RG.resolve(self.registry()).first()
        if best is None:
            raise LookupError("no production or staging model in the registry")
        if self.held[0] != best.version:
            self.held = (best.version, B.load(spark, f"{self.models_dir}/{best.version}"))
        return self.held


def score_with_registry(requests: DataFrame, model: RegistryModel) -> DataFrame:
    """Scores of a (batch) DataFrame of requests, with the version that made them."""
    version, booster = model.resolve(requests.sparkSession)
    scored = score_requests(requests, lambda df: df.withColumn("churn_score", booster.score_column()))
    return scored.withColumn("model_version", F.lit(version))


def start_model_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, model: RegistryModel,
                       max_files_per_trigger: int = 100, available_now: bool = True):
    """Start scoring with the registry's model; returns the StreamingQuery."""
    requests = (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
                .text(source_dir).withColumnRenamed("value", "payload"))

    def sink(batch: DataFrame, number: int):
        score_with_registry(batch, model).write.mode("overwrite").parquet(f"{sink_dir}/batch={number}")

    writer = requests.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


SCORED = "customer_id long, churn_score double, high_risk boolean, model_version string"


def run_model_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, model: RegistryModel,
                     max_files_per_trigger: int = 100) -> DataFrame:
    """Score what is there, stop, and return everything scored so far."""
    q = start_model_stream(spark, source_dir, sink_dir, checkpoint_dir, model, max_files_per_trigger)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(SCORED + ", batch int").parquet(sink_dir)
