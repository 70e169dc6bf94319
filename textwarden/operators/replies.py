"""A lasting store of a user function's answers, so that no text is paid for twice."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_folder


class ReplyStore:
    """Answers by the digest of what was asked, in a folder all executors share.

    ``path`` outlives the job: a later run over the same texts calls nothing.  What is asked
    is the text together with ``model`` (name and version of whatever answers) and the
    caller's own settings, such as a system prompt.  Unseen texts are found by an anti-join,
    cut into ``slices`` by their digests, and each slice's answers are written before the next
    one is asked; a run that fails starts again with what is still unseen.  At most ``callers``
    tasks call at a time.  Failures are written as well, for the run at hand, and asked again
    by the next one.  Every slice is a folder of its own, so a slice written twice, or two runs
    at a time, do no harm: one answer of each digest counts, the same one for every reader.
    """

    def __init__(self, path: str, model: str = "", slices: int = 1, callers: int | None = None):
        if slices < 1:
            raise ValueError("slices must be positive")
        self.path, self.model, self.slices, self.callers = path.rstrip("/"), model, slices, callers

    def key(self, text: Column, settings: str = "") -> Column:
        """What is asked, as a digest; lengths keep the parts apart."""
        asked = [F.lit(f"{len(self.model)}:{self.model}{len(settings)}:{settings}"), text]
        return F.sha2(F.concat(*asked), 256)

    def _schema(self, answer: T.DataType) -> T.StructType:
        return T.StructType([T.StructField("key", T.StringType()), T.StructField("answer", answer)])

    def _rows(self, spark: SparkSession, answer: T.DataType) -> DataFrame:
        schema = self._schema(answer)
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.path}/run=start")
        return spark.read.schema(schema).parquet(self.path).select("key", "answer")

    def answers(self, spark: SparkSession, answer: T.DataType) -> DataFrame:
        """(key, answer) of everything asked so far, an answer rather than a failure."""
        best = F.struct(F.col("answer.error").isNull().alias("good"), "answer")
        return self._rows(spark, answer).groupBy("key").agg(F.max(best).alias("best")).select(
            "key", "best.answer")

    def ask(self, texts: DataFrame, call, answer: T.StructType) -> DataFrame:
        """Ask what is unseen of ``texts`` (key, text); (key, answer) of all that is stored.

        ``call`` is a column function from texts to ``answer`` (value and error).
        """
        spark = texts.sparkSession
        seen = self._rows(spark, answer).where("answer.error is null").select("key")
        folder = scratch_folder(spark)
        texts.join(seen, "key", "left_anti").dropDuplicates(["key"]).write.parquet(folder)
        unseen = spark.read.schema(texts.schema).parquet(folder)
        run = uuid.uuid4().hex
        for number in range(self.slices if not unseen.isEmpty() else 0):
            part = unseen.where(F.pmod(F.xxhash64("key"), F.lit(self.slices)) == number)
            if self.callers:
                part = part.repartition(self.callers)
            part.select("key", call(F.col("text")).alias("answer")).write.parquet(
                f"{self.path}/run={run}-{number}")
        return self.answers(spark, answer)
