"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits link at two differing bits or fewer. Cut into two segments of 32 bits, one segment of a linked pair
differs in one bit at most; so both fingerprints share one of the 32 variants of that segment that leave one bit out. The
variants are joined by equality and the pairs verified by the whole fingerprint. Shingle length and distance are parameters;
beyond three bits there are more segments, always so many that one differs in one bit at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyed.llm.common import cut, per_text, ready, replace_columns, words_of
from keyed.llm.components import components

#: Of the hash; words of a shingle and differing bits of a link where the caller names none.
SEED, SHINGLE, DISTANCE = 42, 3, 2
#: Shingles whose bits are counted at once.
BLOCK = 1 << 15
#: Members of a variant beyond which it is split by parts of the other segment. Every link is found either way.
CROWD = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in more than half of the hashes of the shingles, repeats included."""
    words = words_of((text or "").translate(_LOWER) if text else None)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    count = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, BLOCK):
        h = np.array([digest(joined[i:j], SEED) for i, j in zip(starts[a : a + BLOCK], stops[a : a + BLOCK], strict=True)], "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * count > n))


_LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> Column:
    """The fingerprint of each row's whole text as a (signed) long."""

    def of(texts: list[str | None]) -> pa.Array:
        return pa.array(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return per_text(of, "long", text)


def _segments(distance: int) -> list[tuple[int, int]]:
    """First bit and end of each segment, 32 bits at most: two that differ in ``distance`` bits have one with one at most."""
    if not 0 <= distance < 32:
        raise ValueError(f"distance {distance} is not between 0 and 31")
    n = max(2, distance // 2 + 1)
    return [(64 * s // n, 64 * (s + 1) // n) for s in range(n)]


def _bits(begin: int, end: int) -> Column:
    return F.shiftrightunsigned("f", begin).bitwiseAND(F.lit((1 << (end - begin)) - 1).cast("long"))


def _variants(prints: DataFrame, distance: int) -> DataFrame:
    """64 rows per fingerprint: the segment and the bit left out (0 to 63), and what is left of the segment."""
    keys = [
        F.struct(F.lit(a + i).cast("byte").alias("w"), (_bits(a, b).bitwiseAND(F.lit(((1 << (b - a)) - 1) ^ (1 << i)).cast("long")) - (1 << 31)).cast("int").alias("k"))
        for a, b in _segments(distance)
        for i in range(b - a)
    ]
    return prints.select("f", F.explode(F.array(*keys)).alias("x")).select("f", "x.w", "x.k")


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (f, g), f < g, of different fingerprints with at most ``distance`` differing bits, each once.

    ``prints`` has one row per fingerprint, column f. A variant with more than CROWD members is split: 32 bits beside
    its segment are cut into one part more than bits may differ (three parts at least), of which two linked members
    have at least one in common, so they meet by variant and part.
    """
    index = _variants(prints, distance)
    # written, as the least neighbours of components are: a variant that many fingerprints share is then split
    size = cut(index.groupBy("w", "k").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    # a merge join at every size: at small ones Spark would send the sizes to all tasks instead
    several = cut(index.join(size.hint("merge"), ["w", "k"]), "variants")
    other = F.lit(None).cast("long")
    for a, b in _segments(distance):  # the 32 bits after the segment, or before it, or around it
        rest = F.when(F.lit(b <= 32), _bits(b, min(b + 32, 64))).when(F.lit(a >= 32), _bits(a - 32, a)).otherwise(_bits(0, a).bitwiseOR(F.shiftleft(_bits(b, 64), a)).bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))
        other = F.when((F.col("w") >= a) & (F.col("w") < b), rest).otherwise(other)
    n = max(3, distance + 1)
    cuts = [32 * p // n for p in range(n + 1)]
    parts = [F.struct(F.lit(p).alias("p"), F.shiftright(other, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).cast("int").alias("q")) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    whole = several.filter(F.col("n") <= CROWD).withColumn("x", F.array(F.struct(F.lit(-1).alias("p"), F.lit(0).alias("q"))))
    split = several.filter(F.col("n") > CROWD).withColumn("x", F.array(*parts))
    keyed = whole.unionByName(split).select("f", "w", "k", F.explode("x").alias("x")).select("f", "w", "k", "x.p", "x.q")
    right = keyed.withColumnRenamed("f", "g")
    pairs = keyed.join(right, ["w", "k", "p", "q"]).filter("f < g").filter(F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= distance)
    return pairs.select("f", "g").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Adds ``fingerprint`` (16 hexadecimal digits) and ``component_id`` to every row.

    ``component_id`` is the least id among the rows that can be reached over links, the row's own included. A null or empty
    text has fingerprint zero and links like any other; copies share a fingerprint. A row without an id counts for links
    but gives no least id (if no row of the component has an id, it is null). Rows and extra columns are kept; columns
    named like a result give way to it; an empty table gives none.

    Texts are read once and not shuffled: the table of rows with their fingerprints is written to the shared folder. Copies
    are aggregated to one row per fingerprint before anything is joined.
    """
    return labelled(_printed(docs, doc_id, text, shingle), doc_id, distance)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each group of near-duplicates, that with the least id (null ids last), with the columns of the input.

    Of rows with the same id and text any one stays. The texts are shuffled once, to meet the ids that stay.
    """
    ready(docs.sparkSession)
    key = {"__none": F.col(doc_id).isNull(), "__key": F.coalesce(F.col(doc_id).cast("long"), F.lit(0)), "__hash": F.xxhash64(text)}
    keyed = docs.withColumns(key)
    slim = cut(keyed.select(fingerprints(docs, text, shingle).alias("__print"), F.struct("__none", "__key", "__hash").alias("__id")), "fingerprints")
    kept = classes(slim, distance).select("c.*").distinct()
    found = keyed.join(kept, list(key), "left_semi")
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))  # copies of a row are equal in id and text
    return found.withColumn("__nth", nth).filter("__nth = 1").select(*(f"`{c}`" for c in docs.columns))


def _printed(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """The rows with their fingerprint and an order of them, written: a row's number must not change when a task runs again."""
    ready(docs.sparkSession)
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.monotonically_increasing_id().alias("row"))
    return cut(docs.withColumns({"__print": fingerprints(docs, text, shingle), "__id": order}), "fingerprints")


def classes(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """One row per fingerprint: f and the least row reached, c."""
    prints = cut(rows.groupBy(F.col("__print").alias("f")).agg(F.min("__id").alias("least")), "prints")
    stars = components(links(prints.select("f"), distance).select(F.col("f").alias("u"), F.col("g").alias("v")))
    known = cut(prints.join(stars.withColumnRenamed("node", "f"), "f", "left").select("f", "least", F.coalesce("component", "f").alias("r")), "known")
    least = cut(known.groupBy("r").agg(F.min("least").alias("c")), "classes")
    return known.join(least, "r").select("f", "c")


def _with_class(rows: DataFrame, distance: int) -> DataFrame:
    found = classes(rows, distance).select(F.col("f").alias("__f"), F.col("c").alias("__least"))
    return rows.join(found, F.col("__print") == F.col("__f")).drop("__f")


def labelled(rows: DataFrame, doc_id: str, distance: int = DISTANCE) -> DataFrame:
    new = {"fingerprint": F.lower(F.lpad(F.hex("__print"), 16, "0")), "component_id": F.col("__least.id")}
    return replace_columns(_with_class(rows, distance), new).drop("__print", "__id", "__least")


def prints_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only ids with their results, for callers that don't need the texts again."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ready(docs.sparkSession)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("row"))
    rows = cut(slim.select("doc_id", fingerprints(slim).alias("__print"), order.alias("__id")), "fingerprints")
    return labelled(rows, "doc_id").select("doc_id", "fingerprint", "component_id")
