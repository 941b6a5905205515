"""What several operators share: words, the shared folder, cutting lineage, batches of texts."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyed.sources.files import work_root

#: Rows of one Arrow batch. Texts are long; the default of 10,000 rows would not bound a batch's bytes.
BATCH_ROWS = 128


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine import the package, and keeps Arrow batches of texts small.

    A cluster gets the package by ``--py-files``, as any job's code.
    """
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if top not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (top, env.get("PYTHONPATH", "")) if x)
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):  # a task has one core; more threads only wait for each other
        env.setdefault(name, "1")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{work_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: later jobs and lost executors start from the files."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def repeatable(df: DataFrame) -> bool:
    """Whether the plan is a scan with filters and projections, whose tasks see the same rows in the same order each time."""
    plan = df._jdf.queryExecution().analyzed()
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().split(" ")[0] not in ("Project", "Filter", "SubqueryAlias", "View", "LogicalRelation", "Relation", "LocalRelation"):
            return False
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return plan.deterministic()


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of finished steps now rather than when the driver next runs short of heap."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_join(rows: DataFrame, once: DataFrame, keys: list[str], counts: DataFrame, total: int, by: list[str]) -> DataFrame:
    """Inner join of ``rows`` to ``once`` (one row per key) in which a key with a large part of the rows is no single task's.

    ``counts`` has the number of rows ``m`` of every key, ``total`` is their sum. A share is a quarter of what a task gets on
    average. A key beyond it is dealt by the hash of ``by`` to as many places as it has shares, and its row of ``once`` is
    copied to each. Fewer than four such keys a task are possible, so their list can be broadcast whatever the input; the copies are
    fewer than eight a task. ``m`` is not returned.
    """
    share = max(1, total // (4 * shuffle_partitions(rows.sparkSession)))
    # one key that needs a single place is listed too: with an empty list Spark leaves the look-up out, and small inputs run another plan
    listed = counts.filter(F.col("m") > share).unionByName(counts.filter(F.col("m") <= share).limit(1))
    often = listed.select(*keys, F.ceil(F.col("m") / share).cast("int").alias("__places"))
    dealt = rows.join(F.broadcast(often), keys, "left")
    dealt = dealt.withColumn("__place", F.coalesce(F.pmod(F.xxhash64(*by), F.col("__places")).cast("int"), F.lit(0))).drop("__places")
    places = F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("m") / share).cast("int")) - 1)
    copied = once.withColumn("__place", F.explode(places)).drop("m")
    return dealt.join(copied.hint("merge"), [*keys, "__place"]).drop("__place")


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, as UTF-8."""
    return utf8(text).split()


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def per_text(fn: Callable[[list[str | None]], pa.Array], returns: str, text: str | Column) -> Column:
    """A column from an Arrow function that sees only the texts, a batch at a time. Other columns stay in the JVM."""

    @F.arrow_udf(returns)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield fn(batch.to_pylist())

    return run(text)


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Adds columns; one of the same name, in any case, gives way."""
    taken = {k.lower() for k in new}
    kept = [df[f"`{c}`"] for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *(v.alias(k) for k, v in new.items()))


def _named_labels(labels: DataFrame, label: str, where: Column) -> DataFrame:
    return labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).filter(F.col("doc_id").isNotNull() & where)


def label_share(labels: DataFrame, label: str, where: Column) -> float | None:
    """Share of label 1 among all rows that ``sampled_labels`` draws from, before its caps; None without any."""
    return _named_labels(labels, label, where).filter(F.col("y").isin(0, 1)).distinct().agg(F.avg("y")).first()[0]


def sampled_labels(labels: DataFrame, label: str, where: Column, most: dict[int, int]) -> DataFrame:
    """At most ``most[value]`` labelled rows per class, those with the lowest hash of their id: a bounded, repeatable sample.

    Columns: doc_id, y. Rows without an id or a label of 0 or 1 are not used.
    """
    named = _named_labels(labels, label, where)
    parts = [
        named.filter(F.col("y") == y).dropDuplicates(["doc_id"]).orderBy(F.xxhash64(F.col("doc_id"), F.lit(7)), "doc_id").limit(n)
        for y, n in most.items()
    ]
    return parts[0].unionByName(parts[1])


def crc_mod(col: str | Column, n: int) -> Column:
    return F.pmod(F.crc32(F.col(col).cast("string") if isinstance(col, str) else col.cast("string")), F.lit(n))
