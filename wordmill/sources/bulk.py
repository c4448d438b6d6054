"""Bulk input: NDJSON files in which an action line precedes every document line.

    {"index": {"_id": 1}}
    {"title": "…", "authors": ["…"]}
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.operators.scoring import measure, small

ACTION = "struct<index:struct<_id:string,_type:string>>"


def read_bulk(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, key: str = "_id"
) -> DataFrame:
    """The documents of bulk files: the key as a string, their fields, and `_order`.

    `_order` is the place of the document in the input, for `index_all(order_by=…)`.
    Lines are numbered inside each split of a file, so a large file is read by many
    tasks. An action and its document may lie in different splits: the first line of a
    split takes its action from the last line of the split before.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    lines = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
    )
    split = ["file", "block"]
    counts = lines.groupBy(*split).agg(F.count("*").alias("lines"), F.max_by("value", "n").alias("last"))
    # one row per split: as many as the file has blocks
    in_file = Window.partitionBy("file").orderBy("block")
    before = F.sum("lines").over(in_file) - F.col("lines")
    counts = counts.select(
        *split,
        before.alias("before"),
        F.sum("lines").over(Window.partitionBy("file")).alias("in_file"),
        # only an action is carried over, not a document
        F.lag(F.when((before + F.col("lines")) % 2 == 1, F.col("last"))).over(in_file).alias("carried"),
    )
    in_split = Window.partitionBy(*split).orderBy("n")
    numbered = lines.select(
        "*",
        F.row_number().over(in_split).alias("line"),
        F.lag("value").over(in_split).alias("previous"),
    ).join(small(counts, measure(counts)), split, "left")
    # a split that was not counted means that the two reads disagree: fail, lose nothing
    number = (
        F.when(F.col("before").isNull(), _refuse(F.lit("the input files changed while they were read")))
        .when(F.col("in_file") % 2 == 1, _refuse(F.concat(F.lit("an action or a document is missing in "), "file")))
        .otherwise(F.col("before") + F.col("line"))
    )
    pairs = numbered.withColumn("number", number).where("number % 2 = 0")
    action = F.from_json(F.coalesce("previous", "carried"), ACTION)
    pairs = pairs.select("file", "number", "value", action.alias("action"))
    only_index = F.when(F.col("action.index").isNotNull(), F.col("action.index._id")).otherwise(
        F.raise_error(F.concat(F.lit("not an index action before line "), F.col("number").cast("string")))
    )
    doc_id = F.coalesce(only_index, F.concat_ws(":", "file", "number"))
    order = F.struct("file", "number")
    # a document that is no JSON object of this schema raises
    doc = F.from_json("value", schema or inferred_schema(pairs), {"mode": "FAILFAST"})
    return pairs.select(doc_id.alias(key), doc.alias("doc"), order.alias("_order")).select(key, "doc.*", "_order")


def _refuse(message: Column) -> Column:
    return F.raise_error(message).cast("bigint")


def inferred_schema(pairs: DataFrame) -> str:
    """The fields of the documents, from one pass over the document lines alone."""
    found = pairs.agg(F.schema_of_variant_agg(F.parse_json("value"))).first()[0]
    if not found or not found.startswith("OBJECT<"):
        raise ValueError("a document is not a JSON object")
    # JSON has numbers and no decimals; a field without any value is read as text
    kinds = re.sub(r"DECIMAL\(\d+,\s*0\)", "BIGINT", found)
    kinds = re.sub(r"DECIMAL\(\d+,\s*\d+\)|FLOAT", "DOUBLE", kinds)
    return re.sub(r"\b(VOID|VARIANT)\b", "STRING", kinds).replace("OBJECT<", "STRUCT<")


def bulk_lines(docs: DataFrame, key: str) -> DataFrame:
    """One text per document, of two lines, to be written with `write.text`."""
    action = F.to_json(F.struct(F.struct(F.col(key).alias("_id")).alias("index")))
    fields: list[Column] = [F.col(c) for c in docs.columns if c != key]
    return docs.select(F.concat_ws("\n", action, F.to_json(F.struct(*fields))).alias("value"))
