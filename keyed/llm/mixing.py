"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyed.llm.common import ready, replace_columns, shuffle_partitions

#: Sources up to which their rates are sent to every task; beyond it they are joined.
MOST_SENT = 100_000
#: Hexadecimal digits of the hash that make the uniform number.
DIGITS = 13
#: Mean from which the distribution is summed from below its middle: exp(-mean) leaves the normal doubles at 708.
LOG_FROM = 700.0


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the MD5 of the parts, joined by '|'."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def poisson(u: Column, rate: Column) -> Column:
    """The least k with P(X <= k) > u, X of Poisson distribution with this mean: the inverse distribution function.

    The sum over k starts at 0 and stops where it passes u. Above a mean of LOG_FROM, where the first terms are too small for
    a double, it starts 12 standard deviations below the mean, from a term worked out in log space by Stirling's series, and
    also stops where it no longer grows: what is left out on either side is far below the 2^-52 from one u to the next.
    """
    spread = 12 * F.sqrt(rate) + 30
    low = F.when(rate > LOG_FROM, F.floor(rate - spread).cast("double")).otherwise(0.0)
    n = F.greatest(low, F.lit(1.0))
    series = 1 / (12 * n) - 1 / (360 * n * n * n) + 1 / (1260 * n * n * n * n * n)
    stirling = F.exp(n * F.log(rate / n) + (n - rate) - F.log(n * (2 * math.pi)) / 2 - series)
    first = F.when(low > 0, stirling).otherwise(F.exp(-rate))

    def step(s: Column) -> Column:
        p = s.p * rate / (s.k + 1)
        return F.when((s.c > u) | ((low > 0) & (s.k > rate) & (s.c + p == s.c)), s).otherwise(F.struct((s.k + 1).alias("k"), p.alias("p"), (s.c + p).alias("c")))

    tries = F.sequence(F.lit(1), F.ceil(rate - low + spread).cast("int"))
    return F.aggregate(tries, F.struct(low.alias("k"), first.alias("p"), first.alias("c")), lambda s, _: step(s)).k.cast("long")


def rates(docs: DataFrame, weights: dict[str | None, float] | None, power: float, budget: float, source: str, text: str) -> DataFrame:
    """Mean repetitions of each source: (its share of the weights) x budget x (all bytes) / (its bytes). Columns: s, rate."""
    sizes = docs.groupBy(F.col(source).cast("string").alias("s")).agg(F.sum(F.octet_length(text)).cast("double").alias("b"))
    sizes = sizes.filter("b > 0")
    if weights is None:
        weighed = sizes.withColumn("w", F.pow("b", F.lit(power)))
    else:
        named = {k: v for k, v in weights.items() if k is not None}
        given = F.create_map(*(F.lit(x) for kv in named.items() for x in kv)) if named else F.lit(None).cast("map<string,double>")
        known = F.coalesce(F.element_at(given, F.col("s")).cast("double"), F.lit(0.0))
        weighed = sizes.withColumn("w", F.when(F.col("s").isNull(), F.lit(float(weights.get(None, 0.0)))).otherwise(known))
    all_bytes, all_weight = weighed.agg(F.sum("b"), F.sum("w")).first()  # two numbers
    rate = F.col("w") * budget * all_bytes / F.col("b") / all_weight if all_weight else F.lit(0.0)
    return weighed.select("s", rate.alias("rate"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.5, budget: float = 1.0, seed: str = "mix", doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Repeats each document by a Poisson count whose mean brings its source to the target weight; shuffles globally.

    ``weights`` are target shares of bytes by source (others get none); without them a source weighs its bytes to the
    ``power``. ``budget`` is the size of the result, in bytes of the input. The count of a row inverts the distribution at a
    number hashed from seed and id, so it does not depend on partitions or reruns. Adds ``replica`` (from 0) and ``mix_key``
    (hash of seed, id and replica: the global order, by which rows are dealt over partitions and sorted in each).

    Rows whose source is null are a source of their own, which weights name as None. A row with a null or empty text counts
    no bytes; it is repeated like the others of its source. Rows whose source has no bytes at all or is left out of the
    weights get rate 0 and so no copies. Rows without an id share one number; rows with the same id get the same count. Extra columns are kept,
    columns named like a result give way to it. An empty table gives no rows.

    The only shuffle of texts is the global one. Rates are one row per source, summed before the shuffle; up to MOST_SENT
    sources they are sent to the tasks, else joined.
    """
    spark = ready(docs.sparkSession)
    rate = rates(docs, weights, power, budget, source, text).select(F.col("s").alias("__s"), F.col("rate").alias("__rate")).cache()
    few = rate.limit(MOST_SENT + 1).count() <= MOST_SENT
    rated = docs.join(F.broadcast(rate) if few else rate, docs[source].cast("string").eqNullSafe(F.col("__s")))
    u = uniform(F.lit(f"{seed}-count"), F.coalesce(docs[doc_id].cast("string"), F.lit("null")))
    counted = rated.withColumn("__n", poisson(u, F.col("__rate"))).drop("__s", "__rate").filter("__n > 0")
    replicas = counted.withColumn("__r", F.explode(F.sequence(F.lit(0), (F.col("__n") - 1).cast("int")))).drop("__n")
    key = F.md5(F.concat_ws("|", F.lit(f"{seed}-order"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null")), F.col("__r")))
    dealt = replicas.withColumn("__key", key)
    n = shuffle_partitions(spark)
    # the first 8 digits of the key, scaled to the partitions: ranges of keys, without a sampling pass
    part = F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("double") * n / float(16**8)).cast("int")
    shuffled = dealt.repartitionById(n, part).sortWithinPartitions("__key")
    return replace_columns(shuffled, {"replica": F.col("__r"), "mix_key": F.col("__key")}).drop("__r", "__key")
