"""Feature stores, reports and logs on disk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

FEATURES = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("features", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("path", T.StringType())])
LOG = "struct<metadata:struct<run_id:string>,epochs:map<string,struct<timestamp:string,epoch:int,fp_threshold:double,total_val_samples:int,false_positive_count:int,false_predictions:array<struct<index:int,score:double,file_path:string>>>>>"


class FeatureStore:
    """Rows of (row_id, features, label, path) in Parquet, partitioned by split. Appends are atomic, so no repair is needed."""

    def __init__(self, spark: SparkSession, root: str, width: int = 40) -> None:
        self.spark, self.root, self.width = spark, root, width

    def add(self, rows: DataFrame, split: str) -> None:
        """Appends; a feature array whose length isn't a multiple of the width raises when it is written."""
        checked = rows.select("row_id", F.when(F.size("features") % self.width == 0, F.col("features")).otherwise(F.raise_error(F.lit(f"features must be a multiple of {self.width}"))).alias("features"), "label", "path")
        checked.write.mode("append").parquet(f"{self.root}/split={split}")

    def reset(self, split: str) -> None:
        self.spark.createDataFrame([], FEATURES).write.mode("overwrite").parquet(f"{self.root}/split={split}")

    def read(self, split: str | None = None) -> DataFrame:
        if split:
            return self.spark.read.schema(FEATURES).parquet(f"{self.root}/split={split}")
        return self.spark.read.schema(T.StructType([*FEATURES.fields, T.StructField("split", T.StringType())])).option("basePath", self.root).parquet(f"{self.root}/split=*")

    def get(self, ids: Sequence[int], split: str) -> DataFrame:
        """The rows of `ids` with their position, so that the asked order can be restored; repeated ids give repeated rows."""
        wanted = self.spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "row_id bigint, pos int")
        return self.read(split).join(F.broadcast(wanted), "row_id")


def csv_report(df: DataFrame, decimals: dict[str, int]) -> DataFrame:
    """Strings as a CSV report has them: fixed decimals, true and false as 1 and 0, nothing for null."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind == "boolean":
            c = F.when(c, "1").otherwise("0")
        elif name in decimals:
            c = F.format_string(f"%.{decimals[name]}f", c.cast("double"))
        out.append(F.coalesce(F.when(F.col(name).isNotNull(), c.cast("string")), F.lit("0" if kind == "boolean" else "")).alias(name))
    return df.select(*out)


def exploded_log(texts: DataFrame, column: str) -> DataFrame:
    """(run_id, epoch key, threshold, index, score, file_path) of prediction-log documents; what is no log gives no rows."""
    log = texts.select(F.from_json(F.col(column), LOG).alias("l"))
    epochs = log.select(F.col("l.metadata.run_id").alias("run_id"), F.explode("l.epochs").alias("epoch", "e"))
    return epochs.select("run_id", "epoch", F.col("e.fp_threshold").alias("fp_threshold"), F.explode("e.false_predictions").alias("p")).select("run_id", "epoch", "fp_threshold", F.col("p.index").alias("index"), F.col("p.score").alias("score"), F.col("p.file_path").alias("file_path"))


def log_documents(predictions: DataFrame) -> DataFrame:
    """(run_id, document): a JSON document for each run and each hundred of its epochs, from rows of (run_id, epoch, logged_at, fp_threshold, total_val_samples, false_positive_count, false_predictions); of an epoch's repeated rows the last by time counts."""
    last = predictions.where("epoch IS NOT NULL").groupBy("run_id", "epoch").agg(F.max_by(F.struct("logged_at", "fp_threshold", "total_val_samples", "false_positive_count", "false_predictions"), F.struct("logged_at", "log_id")).alias("e"))
    value = F.struct(F.date_format("e.logged_at", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col("epoch").try_cast("int").alias("epoch"), F.col("e.fp_threshold").alias("fp_threshold"), F.col("e.total_val_samples").alias("total_val_samples"), F.col("e.false_positive_count").alias("false_positive_count"), F.transform("e.false_predictions", lambda p: F.struct(p["idx"].alias("index"), p["score"].alias("score"), p["file_path"].alias("file_path"))).alias("false_predictions"))
    grouped = last.groupBy("run_id", F.floor(F.coalesce(F.col("epoch").try_cast("int"), F.pmod(F.xxhash64("epoch"), F.lit(1_000_000))) / 100).alias("part")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("epoch"), value.alias("v"))))).alias("epochs"))
    return grouped.select("run_id", F.to_json(F.struct(F.struct("run_id").alias("metadata"), "epochs")).alias("document"))
