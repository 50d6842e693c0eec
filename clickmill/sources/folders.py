"""Folders of any file system that Spark reaches."""

import json

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, hadoop_path = _hadoop(spark, path)
    return filesystem.exists(hadoop_path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    if not exists(spark, path):
        return []
    filesystem, hadoop_path = _hadoop(spark, path)
    return sorted(status.getPath().getName() for status in filesystem.listStatus(hadoop_path))


def delete(spark: SparkSession, path: str) -> None:
    filesystem, hadoop_path = _hadoop(spark, path)
    filesystem.delete(hadoop_path, True)


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text that write_note left; readers of the folder around it do not see it."""
    return spark.read.text(path, wholetext=True).first().value.strip() if exists(spark, path) else None


def write_note(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that Spark gave the query of a checkpoint, None before its first start."""
    text = read_note(spark, f"{checkpoint}/metadata")
    return None if text is None else json.loads(text)["id"]


OWNER = "_owner"


def check_owner(spark: SparkSession, path: str, checkpoint: str, filled: bool) -> None:
    """Refuse a checkpoint that does not belong to what `path` holds.

    Progress and running counts live in the checkpoint. A new one on a filled path would skip
    or overwrite rows, and one that has committed micro-batches would go on from there on an
    empty path.
    """
    query, owner = checkpoint_id(spark, checkpoint), read_note(spark, f"{path}/{OWNER}")
    if filled and query is None:
        raise ValueError(f"{path} holds data, but the checkpoint {checkpoint} is new")
    if not filled and children(spark, f"{checkpoint}/commits"):
        raise ValueError(f"the checkpoint {checkpoint} has micro-batches that {path} does not hold")
    if query is not None and owner is not None and query != owner:
        raise ValueError(f"{path} was filled by another checkpoint than {checkpoint}")


def set_owner(spark: SparkSession, path: str, query_id: str) -> None:
    if read_note(spark, f"{path}/{OWNER}") is None:
        write_note(spark, f"{path}/{OWNER}", query_id)
