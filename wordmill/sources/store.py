"""The index: five Spark tables per version, and one view that names the version.

    docs      the documents, one row per key, bucketed by the key
    postings  field, term, key, tf, dl, positions: partitioned by field, bucketed by
              the key, sorted by term inside each file
    terms     field, term, df, cf, top (the highest tf_norm): bucketed by term
    lengths   field, key, dl: bucketed by the key
    stats     field, n_docs, avgdl, n_postings: one row per field

Buckets follow the document, not the term, so a term that is in a third of all
documents is spread over every bucket, and scores are added up without a shuffle.
A file is sorted by term, so a lookup reads only the pages that hold the term.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.functions.bm25 import tf_norm
from wordmill.functions.text import catch_all
from wordmill.plans.mapping import FieldSpec, Mapping, entry_mapping

TABLES = ("docs", "postings", "terms", "lengths", "stats")
# Tokens take some fifty times their text while a shard is sorted (600 MB for 12 MB of text), so a
# shard is small enough to be sorted in the memory of one task.
BYTES_PER_SHARD = 8 * 1024 * 1024
# Spark refuses more than 100,000 buckets; a lookup by key opens one.
MAX_SHARDS = 20_000


def workspace(spark: SparkSession) -> str:
    """The database that holds the indices of this application.

    It lies in the shared folder named by `spark.checkpoint.dir`. Only a local session
    without that setting gets a temporary folder.
    """
    name = "wordmill_" + "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId)
    if not spark.catalog.databaseExists(name):
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="wordmill-")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{shared.rstrip('/')}/{name}'")
    return name


def beside(index: Index, kind: str, rows: Callable[[], DataFrame], bucket_by: str, ordered: bool = True) -> DataFrame:
    """A table derived from a version of an index, written when it is first asked for."""
    if not index.spark.catalog.tableExists(index.table_name(kind)):
        _save(index, kind, rows(), bucket_by=bucket_by, ordered=ordered)
    return index.table(kind)


def kept_table(index: Index, rows: DataFrame) -> DataFrame:
    """Rows that several steps of a job read, written to a table of the workspace."""
    name = f"{index.database}.kept_{uuid.uuid4().hex}"
    rows.write.format("parquet").saveAsTable(name)
    return index.spark.table(name)


def clear_workspace(spark: SparkSession) -> None:
    """Drop every index of this application."""
    spark.sql(f"DROP DATABASE IF EXISTS {workspace(spark)} CASCADE")


def numbered_index(number: int, prefix: str = "zot") -> str:
    """The customary index name for a numbered collection."""
    return f"{prefix}{number:d}"


@dataclass(frozen=True)
class Index:
    """One version of an index, ready to be searched."""

    spark: SparkSession
    database: str
    name: str
    version: int
    shards: int
    mapping: Mapping

    @property
    def key(self) -> str:
        return self.mapping.key

    def table_name(self, kind: str) -> str:
        return f"{self.database}.{self.name}_v{self.version}_{kind}"

    def table(self, kind: str) -> DataFrame:
        return self.spark.table(self.table_name(kind))

    @property
    def docs(self) -> DataFrame:
        return self.table("docs")

    @property
    def postings(self) -> DataFrame:
        return self.table("postings")

    @property
    def terms(self) -> DataFrame:
        return self.table("terms")

    @property
    def lengths(self) -> DataFrame:
        return self.table("lengths")

    @property
    def stats(self) -> DataFrame:
        return self.table("stats")


# ---- life cycle -----------------------------------------------------------------


def index_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(f"{workspace(spark)}.{name}")


def open_index(spark: SparkSession, name: str) -> Index:
    """The current version of an index."""
    database = workspace(spark)
    if not index_exists(spark, name):
        raise LookupError(f"no index {name!r}")
    found = dict(spark.sql(f"SHOW TBLPROPERTIES {database}.{name}").collect())
    return Index(
        spark,
        database,
        name,
        int(found["wordmill.version"]),
        int(found["wordmill.shards"]),
        Mapping.from_json(found["wordmill.mapping"]),
    )


def create_index(
    spark: SparkSession,
    name: str,
    mapping: Mapping | None = None,
    schema: T.StructType | None = None,
    shards: int = 1,
) -> bool:
    """Create an empty index. False, and nothing changed, if it exists."""
    if index_exists(spark, name):
        return False
    mapping = mapping or entry_mapping()
    schema = schema or mapping.schema()
    index = Index(spark, workspace(spark), name, 0, shards, mapping)
    docs = spark.createDataFrame([], schema)
    _write(index, docs, postings_of(docs, mapping))
    return True


def delete_index(spark: SparkSession, name: str) -> bool:
    """Drop an index. False if there is none."""
    if not index_exists(spark, name):
        return False
    index = open_index(spark, name)
    spark.sql(f"DROP VIEW {index.database}.{name}")
    for version in range(index.version + 1):
        _drop(index, version)
    return True


def build_index(
    spark: SparkSession,
    name: str,
    docs: DataFrame,
    mapping: Mapping,
    shards: int | None = None,
    order_by: Column | None = None,
) -> Index:
    """Index a DataFrame under a new name. Keys are checked as in `index_all`."""
    if index_exists(spark, name):
        raise ValueError(f"index {name!r} exists; add documents with index_all")
    shards = shards or shard_count(docs, mapping)
    index = Index(spark, workspace(spark), name, 0, shards, mapping)
    # written first, so that the analysis reads documents already in their buckets
    _save_latest(index, "docs", docs, order_by, docs.columns)
    _write(index, None, postings_of(index.docs, mapping))
    return index


def index_all(
    spark: SparkSession,
    name: str,
    docs: DataFrame,
    mapping: Mapping | None = None,
    shards: int | None = None,
    order_by: Column | None = None,
) -> bool:
    """Add documents to an index, creating it if needed; the last row of a key by `order_by` wins.

    Null keys raise, and without `order_by` so does a key that occurs twice in `docs`.

    Only the new documents are analyzed. They replace the rows of the same key in a new
    version of the tables; the view moves to it when it is complete. The version
    before the last is dropped. An index that outgrows its shards gets more. False if there is
    nothing to index.
    """
    if docs.isEmpty():
        return False
    if not index_exists(spark, name):
        build_index(spark, name, docs, mapping or entry_mapping(), shards, order_by)
        return True
    old = open_index(spark, name)
    if mapping is not None and mapping != old.mapping:
        raise ValueError("the mapping differs from that of the index; build a new one")
    key = old.key
    shards = _grown(old, docs)
    new = Index(spark, old.database, name, old.version + 1, shards, old.mapping)
    _save_latest(new, "batch", docs, order_by, old.docs.columns)
    batch = new.table("batch")
    ids = batch.select(key).hint("shuffle_hash")
    old_docs, old_postings = old.docs, old.postings
    if shards != old.shards:
        # dealt into the new buckets, once
        old_docs, old_postings = old_docs.repartition(shards, key), old_postings.repartition(shards, key)
    # both sides lie in the same buckets: matched bucket by bucket, with no further shuffle
    kept_docs = old_docs.join(ids, key, "left_anti")
    kept_postings = old_postings.join(ids, key, "left_anti").select(*old.postings.columns)
    _write(new, kept_docs.unionByName(batch), kept_postings.unionByName(postings_of(batch, new.mapping)))
    spark.sql(f"DROP TABLE {new.table_name('batch')}")
    if old.version > 0:
        _drop(old, old.version - 1)
    return True


def describe_index(index: Index) -> DataFrame:
    """One row per column and field: type, analyzer, boost, and how much text it holds."""
    rows = []
    for path, kind in _flat(index.docs.schema):
        rows.append((path, kind, None, None))
    for spec in index.mapping.fields:
        kind = "text" if spec.is_text else "keyword"
        rows = [r for r in rows if r[0] != spec.name]
        rows.append((spec.name, kind, spec.analyzer_name, float(spec.boost)))
    declared = index.spark.createDataFrame(rows, "field string, type string, analyzer string, boost double")
    # one row per field on either side: bounded by the mapping
    return declared.join(
        F.broadcast(index.stats.select("field", "n_docs", "n_postings")), "field", "left"
    )


def _flat(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    found = []
    for one in schema:
        if isinstance(one.dataType, T.StructType):
            found += _flat(one.dataType, f"{prefix}{one.name}.")
        else:
            found.append((prefix + one.name, one.dataType.simpleString()))
    return found


# ---- building -------------------------------------------------------------------


def shard_count(docs: DataFrame, mapping: Mapping) -> int:
    """One shard per 8 MB of indexed text, at least one per core, and at most MAX_SHARDS.

    The size comes from one pass over the indexed columns; no list of files is made. Beyond
    the maximum shards grow, and each is written as several files by `maxRecordsPerFile`.
    """
    least = max(1, docs.sparkSession.sparkContext.defaultParallelism)
    return min(max(least, -(-_text_bytes(docs, mapping) // BYTES_PER_SHARD)), MAX_SHARDS)


def _grown(old: Index, docs: DataFrame) -> int:
    """The shards of an index when documents are added: as many as before, unless these would hold
    over twice the text that one shard should."""
    size = _text_bytes(old.docs, old.mapping) + _text_bytes(docs, old.mapping)
    if size <= 2 * BYTES_PER_SHARD * old.shards:
        return old.shards
    return max(old.shards, min(-(-size // BYTES_PER_SHARD), MAX_SHARDS))


def _text_bytes(docs: DataFrame, mapping: Mapping) -> int:
    """Bytes of all indexed text fields."""
    texts = [F.coalesce(F.octet_length(F.expr(f"CAST({f.expression} AS string)")), F.lit(0)) for f in mapping.text_fields]
    return docs.agg(F.sum(reduce(Column.__add__, texts, F.lit(0).cast("bigint")))).first()[0] or 0


def spread(docs: DataFrame) -> DataFrame:
    """Deal an input of fewer splits than cores over all cores; any other one stays as it is."""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def checked(docs: DataFrame, key: str, order_by: Column | None) -> DataFrame:
    """The documents, after a pass over their keys: none may be null, and without an order
    none may occur twice, since nothing then says which row is the last."""
    keys = docs.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    bad = keys.where("k IS NULL" if order_by is not None else "k IS NULL OR n > 1").orderBy("k").limit(3).collect()
    if any(row["k"] is None for row in bad):
        raise ValueError(f"{key!r} is null in some documents")
    if bad:
        raise ValueError(f"{key!r} {bad[0]['k']!r} occurs {bad[0]['n']} times; give order_by to say which row is the last")
    return docs


def latest(docs: DataFrame, key: str, order_by: Column, columns: list[str] | None = None) -> DataFrame:
    """One row per key: the last by `order_by`; a null order comes before all others.

    Rows of one key that are equal in order are told apart by a hash of the row, so the
    result does not depend on the layout. An aggregate, not a window: copies of a key are
    reduced in every task before the shuffle, however many there are.
    """
    columns = columns or docs.columns
    rest = [c for c in columns if c != key]
    whole = F.struct(*rest)
    order = F.struct(order_by.isNotNull().alias("given"), order_by.alias("order"), F.xxhash64(F.to_json(whole)).alias("hash"))
    rows = docs.select(key, whole.alias("_row"), order.alias("_order"))
    last = rows.groupBy(key).agg(F.max_by("_row", "_order").alias("_row"))
    return last.select(key, "_row.*").select(*columns)


def postings_of(docs: DataFrame, mapping: Mapping) -> DataFrame:
    """Postings of every text field. On documents bucketed by key this needs no shuffle:
    all tokens of a document are in its own task."""
    key = mapping.key
    document = Window.partitionBy(key)
    shared = _shared(docs, mapping)
    parts = [_postings_of_both(docs, key, *shared)] if shared else []
    for spec in mapping.text_fields:
        if shared and spec in shared:
            continue
        tokens = spec.chain.tokens(docs, F.expr(spec.expression), [key])
        grouped = tokens.groupBy(key, F.col("token").alias("term")).agg(
            F.count("*").cast("int").alias("tf"),
            F.sort_array(F.collect_list("position")).alias("positions"),
        )
        parts.append(
            grouped.select(
                "term",
                key,
                "tf",
                F.sum("tf").over(document).cast("int").alias("dl"),
                "positions",
                F.lit(spec.name).alias("field"),
            )
        )
    if not parts:
        kind = docs.schema[key].dataType.simpleString()
        schema = f"term string, `{key}` {kind}, tf int, dl int, positions array<int>, field string"
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def _shared(docs: DataFrame, mapping: Mapping) -> tuple[FieldSpec, FieldSpec] | None:
    """A field of the text of one column, and the catch-all field if it has the same chain."""
    schema = docs.schema
    whole = next((f for f in mapping.text_fields if f.source == catch_all(schema, skip=(mapping.key,))), None)
    columns = {f"`{f.name}`" for f in schema if f.name != mapping.key and isinstance(f.dataType, T.StringType)}
    if whole is None:
        return None
    same = (f for f in mapping.text_fields if f.expression in columns and f.chain == whole.chain)
    return next(((f, whole) for f in same), None)


def _postings_of_both(docs: DataFrame, key: str, spec: FieldSpec, whole: FieldSpec) -> DataFrame:
    """Postings of a field and of the catch-all field, whose tokens are those of the field between
    those of other columns: cut, sorted and grouped once."""
    schema, document = docs.schema, Window.partitionBy(key)
    names = [f.name for f in schema]
    at = next(n for n, name in enumerate(names) if f"`{name}`" == spec.expression)
    before, after = (
        F.expr(catch_all(schema, skip=(key, *left))) if set(names) - {key, *left} else F.lit("")
        for left in (names[at:], names[: at + 1])
    )
    keep = [key, "_low", "_high"]
    rows = whole.chain.split_parts(docs, before, F.expr(spec.expression), after, [key])
    tokens = whole.chain.kept_tokens(rows, keep)
    inside = (F.col("position") >= F.col("_low")) & (F.col("position") < F.col("_high"))
    grouped = tokens.groupBy(key, F.col("token").alias("term")).agg(
        F.count("*").cast("int").alias("tf"),
        F.count_if(inside).cast("int").alias("_tf"),
        F.max("_low").alias("_low"),
        F.max("_high").alias("_high"),
        F.sort_array(F.collect_list("position")).alias("positions"),
    )
    low, high = F.col("_low"), F.col("_high")
    own = F.transform(F.filter("positions", lambda p: (p >= low) & (p < high)), lambda p: p - low)
    # a word of the field stands in other columns in few documents
    own = F.when((F.col("_tf") == F.col("tf")) & (low == 0), F.col("positions")).otherwise(own)
    sums = [F.sum(c).over(document).cast("int").alias(name) for c, name in (("tf", "dl"), ("_tf", "_dl"))]
    grouped = grouped.select("term", key, "tf", "_tf", *sums, "positions", own.alias("_positions"))
    fields = [
        F.struct(F.col(tf).alias("tf"), F.col(dl).alias("dl"), F.col(places).alias("positions"), F.lit(one.name).alias("field"))
        for one, tf, dl, places in ((spec, "_tf", "_dl", "_positions"), (whole, "tf", "dl", "positions"))
    ]
    return grouped.select("term", key, F.inline(F.array(*fields))).where("tf > 0")


def _write(index: Index, docs: DataFrame | None, postings: DataFrame) -> None:
    """Write all tables of a version, then let the view point to it."""
    key = index.key
    if docs is not None:
        _save(index, "docs", docs, bucket_by=key, in_place=True)
    # tokens are sorted once: with lists, the hash aggregate sorts them in both of its halves
    with _set(index.spark, "spark.sql.execution.useObjectHashAggregateExec", "false"):
        _save(index, "postings", postings, key, ("term",), partition_by="field", in_place=True)
    read = index.postings
    lengths = read.groupBy(key, "field").agg(F.max("dl").alias("dl"), F.count("*").alias("n"))
    _save(index, "lengths", lengths, key, ("field", key), in_place=True)
    stats = index.lengths.groupBy("field").agg(
        F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"), F.sum("n").alias("n_postings")
    )
    _save(index, "stats", stats)
    # one row per field: bounded by the mapping
    average = F.broadcast(index.stats.select("field", "avgdl"))
    terms = read.join(average, "field").groupBy("field", "term").agg(
        F.count("*").alias("df"),
        F.sum("tf").cast("bigint").alias("cf"),
        F.max(tf_norm(F.col("tf"), F.col("dl"), F.col("avgdl"))).alias("top"),
    )
    _save(index, "terms", terms, bucket_by="term", sort_by=("field", "term"))
    _publish(index)


def _save(
    index: Index,
    kind: str,
    df: DataFrame,
    bucket_by: str | None = None,
    sort_by: tuple[str, ...] = (),
    partition_by: str | None = None,
    in_place: bool = False,
    ordered: bool = True,
) -> None:
    """Write one table. `in_place`: the rows lie in their buckets already, so they are
    written where they are, without a shuffle. `ordered`: the rows of a bucket are sorted."""
    if bucket_by is None:
        df = df.coalesce(1)
    elif not in_place:
        df = df.repartition(index.shards, bucket_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        writer = writer.bucketBy(index.shards, bucket_by)
        writer = writer.sortBy(*(sort_by or (bucket_by,))) if ordered else writer
    writer.saveAsTable(index.table_name(kind))


def _save_latest(
    index: Index, kind: str, docs: DataFrame, order_by: Column | None, columns: list[str]
) -> None:
    """Write the last row of every key into its bucket, in a single shuffle.

    The shuffle of the aggregate is given as many partitions as there are buckets. Both
    use the same hash of the key, so the repartitioning before the write is left out.
    """
    with _set(index.spark, "spark.sql.shuffle.partitions", str(index.shards)):
        docs = checked(docs, index.key, order_by)
        rows = docs.select(*columns) if order_by is None else latest(docs, index.key, order_by, columns)
        _save(index, kind, rows, bucket_by=index.key)


@contextmanager
def _set(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    """A setting of the session, for a while."""
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _publish(index: Index) -> None:
    quoted = index.mapping.to_json().replace("\\", "\\\\").replace("'", "\\'")
    index.spark.sql(
        f"CREATE OR REPLACE VIEW {index.database}.{index.name} TBLPROPERTIES ("
        f"'wordmill.version'='{index.version}', 'wordmill.shards'='{index.shards}', "
        f"'wordmill.mapping'='{quoted}') AS SELECT * FROM {index.table_name('docs')}"
    )


def _drop(index: Index, version: int) -> None:
    stem = f"{index.name}_v{version}"
    derived = index.spark.sql(f"SHOW TABLES IN {index.database} LIKE '{stem}_near_*|{stem}_grams_*'").collect()
    for name in [*(f"{stem}_{kind}" for kind in TABLES), *(row["tableName"] for row in derived)]:
        index.spark.sql(f"DROP TABLE IF EXISTS {index.database}.{name}")
