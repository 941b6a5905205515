"""Files by key range: what a read opens, what the record says, how batches are cut."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import keyed as K
from keyed.operators import batches


def opened(df):
    return len(df.inputFiles())


@pytest.fixture(scope="module")
def large(spark):
    rows = spark.range(20_000).selectExpr("id * 3 AS id", "repeat('x', CAST(id % 50 AS INT)) AS s")
    return K.create_keyed(spark, "large", rows, "id", prefix=f"{K.work_root(spark)}/files", splits=[100, 57_000], rows_per_file=500).table


def test_files_of_a_shard_hold_narrow_ranges(spark, large):
    zones = large.base.stored(spark, [1])[1]
    assert 30 <= len(zones) <= 45 and sum(z.rows for z in zones) == 19_000 - 34
    ends = [(z.first, z.last) for z in sorted(zones, key=lambda z: z.first)]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    assert max(z.rows for z in zones) <= 1000


def test_reads_open_the_files_they_need(spark, large):
    for key in (102, 30_000, 56_997):
        found = large.read([("id", "=", key)])
        assert opened(found) == 1 and [r.id for r in found.collect()] == [key]
    some = large.read([("id", "in", [300, 30_000, 56_400])])
    assert opened(some) == 3 and sorted(r.id for r in some.collect()) == [300, 30_000, 56_400]
    either = large.read([("or", [("id", "<", 60), ("and", [("id", ">=", 40_000), ("id", "<", 41_000)])])])
    assert opened(either) <= 4 and either.count() == 20 + 333
    assert opened(large.read([("not", ("id", ">", 600))])) <= 3
    assert opened(large.read([("id", "=", 101), ("id", "=", 102)])) == 0
    assert large.read([("id", "=", 101)]).count() == 0
    again = K.KeyedTable.open(spark, large.path)
    assert opened(again.read([("id", "=", 30_000)])) == 1


def test_a_point_read_opens_one_file_of_each_generation(spark, place):
    table = K.create_keyed(spark, "g", spark.range(0, 4000, 2).toDF("id"), "id", prefix=place, shards=1, rows_per_file=200).table
    table = K.insert(table, spark.range(1, 4000, 2).toDF("id")).table
    for key in (0, 777, 3999):
        found = table.read([("id", "=", key)])
        assert opened(found) <= 2 and found.count() == 1
    assert [r.id for r in table.ordered().collect()] == list(range(4000))
    plan = table.ordered()._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_tables_without_a_record_of_files(spark, place):
    """Tables written before files were recorded are read, ordered and merged as before."""
    import glob
    import json
    import os

    from keyed.sources import table as tables

    table = K.create_keyed(spark, "old", spark.range(300).selectExpr("id", "'a' AS s"), "id", prefix=place, splits=[100], rows_per_file=50).table
    for f in glob.glob(f"{table.path}/data/*/_zones.json"):
        os.remove(f)
    tables._known.clear()
    record, = glob.glob(f"{table.path}/_commits/*.json")
    with open(record) as f:
        held = json.load(f)
    for name in ("cell_rows", "homes"):
        del held["base"][name]
    for f in (record, f"{os.path.dirname(record)}/.{os.path.basename(record)}.crc"):
        os.remove(f)
    with open(record, "w") as f:
        json.dump(held, f)
    old = K.KeyedTable.open(spark, table.path)
    assert [r.id for r in old.ordered().collect()] == list(range(300))
    assert {r.shard: r.rows for r in K.shard_layout(old).collect()} == {0: 100, 1: 200} and old.size_bytes() > 0
    assert old.read([("id", "in", [5, 250])]).count() == 2
    done = K.upsert(old, spark.range(200, 400).selectExpr("id", "'b' AS s")).table
    assert done.read().count() == 400 and done.read([("s", "=", "b")]).count() == 200


def test_layout_comes_from_the_record(spark, large):
    plan = K.shard_layout(large)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan.lower()
    got = {r.shard: (r.rows, r.min_id, r.max_id) for r in K.shard_layout(large).collect()}
    assert got == {0: (34, 0, 99), 1: (18_966, 102, 56_997), 2: (1000, 57_000, 59_997)}
    assert large.size_bytes() > 0


def test_writes_read_their_batch_twice(spark, place, monkeypatch):
    """One pass to survey, one to write: no count, sample or range sample beside them."""
    seen = []
    reads = spark.range(5000).select("id", F.lit("x").alias("s"))
    reads.write.parquet(f"{place}/source")
    source = spark.read.parquet(f"{place}/source")
    collect = type(source).collect
    monkeypatch.setattr(type(source), "collect", lambda self: (seen.append(self.inputFiles()), collect(self))[1])
    K.create_keyed(spark, "t", source, "id", prefix=place, shards=4)
    assert len([s for s in seen if any("/source/" in f for f in s)]) == 1  # the survey; the write is the other


@pytest.mark.parametrize("store", ["range", "hash"])
def test_merges_keep_files_narrow(spark, place, store):
    table = K.create_keyed(spark, store, spark.range(6000).selectExpr("id", "'a' AS s"), "id", prefix=place, store=store, shards=2, rows_per_file=300).table
    table = K.upsert(table, spark.range(3000, 9000).selectExpr("id", "'b' AS s")).table
    rows = {r.id: r.s for r in table.read().collect()}
    assert len(rows) == 9000 and all(rows[i] == ("b" if i >= 3000 else "a") for i in rows)
    for zones in table.base.stored(spark, table.base.live).values():
        assert len(zones) >= 8
        ordered = sorted(zones, key=lambda z: z.first)
        assert all(a.last < b.first for a, b in zip(ordered, ordered[1:]))
    assert opened(table.read([("id", "=", 4321)])) == 1
    assert opened(table.read([("id", "in", [1, 4321])])) <= 2


def test_index_lookup_opens_files_by_key(spark, place):
    rows = spark.range(5000).selectExpr("id", "id DIV 100 AS g", "if(id % 7 = 0, NULL, id) AS v")
    table = K.create_keyed(spark, "i", rows, "id", prefix=place, shards=1, rows_per_file=250, indexes={"by_g": ["g"], "by_v": ["v"]}).table
    found = K.index_lookup(table, "by_g", [("g", "in", [3, 4])])
    assert found.count() == 200 and opened(found) < 8
    assert K.index_lookup(table, "by_v", [("v", "<=>", None), ("id", "<", 70)]).count() == 10
    assert K.index_lookup(table, "by_v", [("or", [("v", "<=>", None), ("v", "=", 5)]), ("id", "<", 70)]).count() == 11
    assert K.index_lookup(table, "by_v", [("not", ("v", "<=>", None)), ("id", "<", 7)]).count() == 6


def greedy(sizes, rows, most):
    out, n, b, batch = [], 0, 0, 0
    for s in sizes:
        if n >= rows or b >= most:
            n, b, batch = 0, 0, batch + 1
        n, b = n + 1, b + s
        out.append(batch)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_batches_are_greedy(spark, monkeypatch, seed):
    r = random.Random(seed)
    monkeypatch.setattr(batches, "BATCHES_PER_BIN", 2)
    monkeypatch.setattr(batches, "MAPS_PER_GROUP", 3)
    given = [(s, i, "é" * r.choice([0, 1, 3, 40, 500]), None if i % 5 else [i] * (i % 9)) for s, n in ((None, 40), (1, 700), (2, 1), (3, 13)) for i in range(n)]
    df = spark.createDataFrame(given, "part int, id long, s string, a array<long>")
    for rows, most in ((7, 300), (1, 50), (10, 1), (5, 10**9), (40, 2000)):
        got = {(x.part, x.id): x.batch for x in K.batch_pack(df, ["id"], "part", rows, most).collect()}
        for part in (None, 1, 2, 3):
            own = sorted(x for x in given if x[0] == part and True)
            own.sort(key=lambda x: x[1])
            sizes = [(4 if part is not None else 0) + 8 + len(s.encode()) + (8 * len(a) if a is not None else 0) for _, _, s, a in own]
            assert [got[part, x[1]] for x in own] == greedy(sizes, rows, most), (part, rows, most)
    assert K.batch_pack(df.limit(0), ["id"], "part", 5, 10).count() == 0
    with pytest.raises(ValueError):
        K.batch_pack(df, ["id"], "part", 0)


def test_batches_as_files(spark, place):
    df = spark.range(1000).selectExpr("CAST(id % 3 AS INT) AS part", "id", "repeat('x', CAST(id % 20 AS INT)) AS s")
    written = K.write_batches(df, f"{place}/out", ["id"], "part", rows=50, max_bytes=900)
    assert K.bag_diff(written.select("part", "id", "s"), df).isEmpty()
    files = written.withColumn("f", F.input_file_name()).groupBy("part", "batch").agg(F.count_distinct("f").alias("files"), F.count("*").alias("n")).collect()
    assert all(f.files == 1 and f.n <= 50 for f in files)


def test_touched_shards_by_differences(spark, place):
    n = 9000
    table = K.create_keyed(spark, "many", spark.range(10).toDF("id"), "id", prefix=place, splits=list(range(0, n * 10, 10))).table
    r = random.Random(1)
    ranges = [(min(a, b), max(a, b), r.random() < 0.5, r.random() < 0.5) for a, b in ((r.randint(-5, n * 10), r.randint(-5, n * 10)) for _ in range(200))] + [(None, 5, True, True), (n * 10, None, True, False)]
    df = spark.createDataFrame(ranges, "l long, h long, lo_incl boolean, hi_incl boolean")
    df = df.select(F.struct(F.col("l").alias("k0")).alias("lo"), F.struct(F.col("h").alias("k0")).alias("hi"), "lo_incl", "hi_incl")
    got = {x.shard: x.ranges for x in K.touched_shards(table, df).collect()}
    one = K.operators.ranges.range_shards(table.layout, table.base.key_types(), df).groupBy("shard").count().collect()
    assert got == {x.shard: x["count"] for x in one} and len(got) > 5000


def test_sizes_of_nested_values(spark):
    from keyed.functions.sizes import row_bytes

    row = (1, "é", [("ab", None), ("c", 2)], {"k": [1.5, None]}, dt.date(2020, 1, 1), None)
    df = spark.createDataFrame([row], "i int, s string, a array<struct<x:string,y:int>>, m map<string,array<double>>, d date, n string")
    assert df.select(row_bytes(df.schema)).first()[0] == 4 + 2 + (2 + 1 + 4) + (1 + 8) + 4


def test_split_and_merge_by_size(spark, place):
    rows = spark.range(30_000).selectExpr("id", "id % 100 AS g", "md5(CAST(id AS STRING)) AS s")
    table = K.create_keyed(spark, "r", rows, "id", prefix=place, splits=[100, 200, 20_000, 25_000], rows_per_file=1000, indexes={"by_g": ["g"]}).table
    before = {r.shard: r.rows for r in K.shard_layout(table).collect()}
    files = set(table.read([("id", ">=", 20_000)]).inputFiles())
    done = K.resize(table, max_mb=0.3, min_mb=0.02).table
    done = K.KeyedTable.open(spark, done.path)
    after = {r.shard: (r.rows, r.bounds) for r in K.shard_layout(done).collect()}
    assert before[2] == 19_800 and after[0] == (200, "(-Inf - 200)") and max(n for n, _ in after.values()) < 12_000
    assert files == set(done.read([("id", ">=", 20_000)]).inputFiles())  # shards 3 and 4 keep their files
    assert K.bag_diff(done.read(), rows).isEmpty()
    assert K.pushdown_parity(done, [("id", ">=", 24_900), ("id", "<", 25_100)]).isEmpty()
    assert len(done.read([("id", "=", 24_999)]).inputFiles()) == 1
    # writes after it: shards that kept their files are found under their new number
    again = K.upsert(done, spark.createDataFrame([(24_999, 5, "x"), (50, 5, "y"), (40_000, 5, "z")], "id long, g long, s string")).table
    assert again.read().count() == 30_001 and again.read([("id", "=", 24_999)]).first().s == "x"
    assert K.index_lookup(again, "by_g", [("g", "=", 5), ("id", "in", [50, 24_999, 40_000])]).count() == 3
    assert [r.id for r in again.ordered().collect()] == [*range(30_000), 40_000]
    assert K.resize(again, max_mb=1000, min_mb=0).table is again
    whole = K.resize(again, max_mb=1000, min_mb=900).table
    assert len(whole.base.live) == 1 and K.bag_diff(whole.read(), again.read()).isEmpty()


def test_indexes_follow_without_a_second_read_of_the_table(spark, place, monkeypatch):
    from keyed.sources.table import Shards

    rows = spark.range(1000).selectExpr("id", "if(id % 3 = 0, NULL, CAST('NaN' AS DOUBLE)) AS v", "if(id < 0, NULL, id) AS w", "id % 7 AS g0").selectExpr("id", "if(id < 0, NULL, g0) AS g", "v", "w")
    table = K.create_keyed(spark, "c", rows, "id", prefix=place, splits=[500], indexes={"by_g": ["g"], "by_v": ["v", "w"], "by_id": ["id"]}).table
    read, reads = Shards.read, []
    monkeypatch.setattr(Shards, "read", lambda self, *a, **k: (reads.append(self.folder), read(self, *a, **k))[1])
    batch = spark.createDataFrame([(3, 6, None), (4, 4, 1.5), (9000, 1, None)], "id long, g long, v double")
    done = K.upsert(table, batch).table
    assert reads.count(table.base.folder) == 1  # once for the merge, whatever the number of indexes
    for name, columns in {"by_g": ["g", "id"], "by_v": ["v", "w", "id"], "by_id": ["id"]}.items():
        assert K.bag_diff(done.index(name).select(*columns), done.read(columns=columns)).isEmpty(), name
    assert done.read().columns == ["id", "g", "v", "w"] and "_change" not in done.read().columns
    done = K.replace_rows(done, batch.filter("id < 5")).table
    assert K.bag_diff(done.index("by_v").select("v", "w", "id"), done.read(columns=["v", "w", "id"])).isEmpty()


def test_generated_keys_are_repeatable_and_copy_nothing(spark, place, monkeypatch):
    from keyed.operators import write as W

    spark.range(5000).selectExpr("id % 3 AS a").write.parquet(f"{place}/in")
    source = spark.read.parquet(f"{place}/in")
    monkeypatch.setattr(W, "_staged", None)  # rows are not copied
    with W._generated_keys(spark, place, source, "k") as keyed:
        first, second = (sorted(r.k for r in keyed.collect()) for _ in range(2))
    assert first == second and len(set(first)) == 5000
    table = K.create_keyed(spark, "t", source, prefix=place, shards=4).table
    table = K.insert(table, source).table
    assert table.read().select("_spark_key").distinct().count() == 10_000
    sizes = [r.rows for r in K.shard_layout(table).collect()]
    assert len(sizes) == 4 and min(sizes) > 1500


def test_ranges_prune_partitions_while_the_query_runs(spark, place):
    table = K.create_keyed(spark, "d", spark.range(1000).toDF("id"), "id", prefix=place, splits=list(range(100, 1000, 100))).table
    ranges = spark.range(5).selectExpr("named_struct('k0', id * 10) AS lo", "named_struct('k0', id * 10 + 3) AS hi", "true AS lo_incl", "false AS hi_incl")
    found = K.read_ranges(table, ranges)
    assert sorted(r.id for r in found.collect()) == [10 * i + j for i in range(5) for j in range(3)]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()


@pytest.fixture
def few(monkeypatch):
    """Bounds that small tables reach: 40 files of few rows a write, 8 tasks."""
    from keyed.sources import table as tables

    monkeypatch.setattr(tables, "NARROW_FILES", 40, raising=False)
    monkeypatch.setattr(tables, "NARROW_TASKS", 8, raising=False)


def writers(files):
    """Tasks that wrote these files."""
    return {f.rsplit("part-", 1)[1][:5] for f in files}


def test_ordered_read_of_many_small_files_has_few_tasks(spark, place, few):
    """Almost all rows in one shard of a given layout, in two generations."""
    table = K.create_keyed(spark, "o", spark.range(12_000).filter("id % 3 > 0"), "id", prefix=place, splits=[50], rows_per_file=10).table
    table = K.insert(table, spark.range(12_000).filter("id % 3 = 0")).table
    rows = table.ordered()
    assert [r.id for r in rows.collect()] == list(range(12_000))
    assert 5 <= rows.rdd.getNumPartitions() <= 12
    for zones in table.base.stored(spark, [1]).values():
        assert 50 <= len(zones) <= 150 and sum(z.rows for z in zones) == 11_950


def test_resize_of_many_small_files_writes_few(spark, place, few):
    rows = spark.range(8000).selectExpr("id", "md5(CAST(id AS STRING)) AS s")
    table = K.create_keyed(spark, "z", rows, "id", prefix=place, splits=[10, 20, 300, 400], rows_per_file=10).table
    sizes = table.base.stored(spark, table.base.live)
    kept = set(table.read([("id", ">=", 300), ("id", "<", 400)]).inputFiles())
    most = sum(z.size for z in sizes[4])
    done = K.resize(table, max_mb=most / 1.5 / (1 << 20), min_mb=sum(z.size for s in (0, 1) for z in sizes[s]) / (1 << 20)).table
    after = done.base.stored(spark, done.base.live)
    assert [len(zones) for zones in sizes.values()][:2] == [1, 1] and 30 <= len(sizes[4]) <= 100
    assert len(after) == 5 and max(sum(z.size for z in zones) for zones in after.values()) < most
    fresh = [f for f in done.read().inputFiles() if f not in set(table.read().inputFiles())]
    assert 30 <= len(fresh) <= 100 and len(writers(fresh)) <= 12
    assert kept == set(done.read([("id", ">=", 300), ("id", "<", 400)]).inputFiles())
    assert K.bag_diff(done.read(), rows).isEmpty()


@pytest.mark.parametrize("store", ["range", "hash"])
def test_typed_keys_in_many_small_files(spark, place, few, store):
    """Keys of two columns, NaN among them: few tasks write few files, which hold rising ranges."""
    rows = spark.range(8000).selectExpr("id", "if(id % 50 = 0, CAST('NaN' AS DOUBLE), id * 0.5D) AS v")
    table = K.create_keyed(spark, store, rows, "v, id", prefix=place, store=store, shards=4, rows_per_file=10).table
    zones = table.base.stored(spark, table.base.live)
    assert 30 <= sum(len(z) for z in zones.values()) <= 120 and len(writers(table.read().inputFiles())) <= 16
    for own in zones.values():
        ordered = sorted(own, key=lambda z: (z.first[0] != z.first[0], z.first))
        assert all(a.last[0] < b.first[0] or b.first[0] != b.first[0] or a.last < b.first for a, b in zip(ordered, ordered[1:]))
    assert table.read([("v", "=", float("nan"))]).count() == 160
    assert [r.id for r in table.read([("v", ">", 3996.0), ("v", "<", 3998.0)]).orderBy("id").collect()] == [7993, 7994, 7995]


def test_a_point_read_of_many_small_files(spark, place, few):
    table = K.create_keyed(spark, "p", spark.range(12_000).toDF("id"), "id", prefix=place, shards=1, rows_per_file=10).table
    files = table.read().inputFiles()
    assert 30 <= len(files) <= 60 and len(writers(files)) <= 10
    for key in (0, 5555, 11_999):
        found = table.read([("id", "=", key)])
        assert opened(found) == 1 and [r.id for r in found.collect()] == [key]


def test_some_keys_of_many_small_files(spark, place, few):
    """The files stay narrow after a merge, which is dealt by the record of the files."""
    table = K.create_keyed(spark, "s", spark.range(6000).selectExpr("id", "'a' AS s"), "id", prefix=place, shards=1, rows_per_file=10).table
    table = K.upsert(table, spark.range(3000, 9000).selectExpr("id", "'b' AS s")).table
    files = table.read().inputFiles()
    assert 30 <= len(files) <= 70 and len(writers(files)) <= 10
    found = table.read([("id", "in", [42, 4242, 8888])])
    assert opened(found) <= 3 and sorted((r.id, r.s) for r in found.collect()) == [(42, "a"), (4242, "b"), (8888, "b")]
    assert K.bag_diff(table.read(), spark.range(9000).selectExpr("id", "if(id < 3000, 'a', 'b') AS s")).isEmpty()


def test_resize_counts_by_the_record(spark, place, monkeypatch):
    """Shards that are split are read once, to be written: their work is known from the record of their files."""
    rows = spark.range(12_000).selectExpr("id", "md5(CAST(id AS STRING)) AS s")
    table = K.create_keyed(spark, "w", rows.filter("id % 3 > 0"), "id", prefix=place, splits=[10, 20, 600], rows_per_file=50).table
    table = K.insert(table, rows.filter("id % 3 = 0")).table
    old, seen = set(table.read().inputFiles()), []
    sizes = {s: sum(z.size for z in zones) for s, zones in table.base.stored(spark, table.base.live).items()}
    collect = type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda self: (seen.append(set(self.inputFiles())), collect(self))[1])
    done = K.resize(table, max_mb=sizes[3] / 1.5 / (1 << 20), min_mb=(sizes[0] + sizes[1]) / (1 << 20)).table
    assert seen and not any(s & old for s in seen)
    monkeypatch.undo()
    after = done.base.stored(spark, done.base.live)
    assert sum(z.rows for zones in after.values() for z in zones) == 12_000 and len(done.base.live) == 4
    assert max(sum(z.size for z in zones) for zones in after.values()) < sizes[3]
    assert K.bag_diff(done.read(), rows).isEmpty()
    assert [r.id for r in done.ordered().collect()] == list(range(12_000))


@pytest.mark.parametrize("store", ["range", "hash"])
def test_a_write_makes_few_files_of_few_rows(spark, place, store):
    """Files of 50 rows would be 400."""
    rows = spark.range(20_000).selectExpr("id", "if(id % 50 = 0, CAST('NaN' AS DOUBLE), id * 0.5D) AS v")
    table = K.create_keyed(spark, store, rows, "v, id", prefix=place, store=store, shards=4, rows_per_file=50).table
    files = table.read().inputFiles()
    assert 60 <= len(files) <= 130 and len(writers(files)) <= 52
    assert table.read([("v", "=", float("nan"))]).count() == 400
    assert K.bag_diff(table.read(), rows).isEmpty()


def test_tables_that_are_written_together(spark, place):
    from suite import tables

    def create(n):
        return lambda name, prefix: K.create_keyed(spark, name, spark.range(n * 100).toDF("id"), "id", prefix=prefix, shards=2)

    made = tables.stored_together(spark, place, {f"t{n}": create(n) for n in range(1, 7)}, at_once=3)
    assert list(made) == [f"t{n}" for n in range(1, 7)]
    assert [t.read().count() for t in made.values()] == [100 * n for n in range(1, 7)]
    with pytest.raises(ValueError, match="no such table"):
        tables.stored_together(spark, place, {"t1": create(1), "bad": lambda n, p: (_ for _ in ()).throw(ValueError("no such table"))})


def test_a_point_read_among_few_files(spark, place):
    """Files of 20 rows would be 1,500, of which a write made 1,024."""
    table = K.create_keyed(spark, "f", spark.range(30_000).toDF("id"), "id", prefix=place, shards=1, rows_per_file=20).table
    assert 60 <= len(table.read().inputFiles()) <= 120
    for key in (0, 7777, 29_999):
        found = table.read([("id", "=", key)])
        assert opened(found) == 1 and [r.id for r in found.collect()] == [key]


def test_some_keys_among_few_files_with_a_frequent_key(spark, place):
    """A given layout, whose cuts come from hash buckets; a third of the batch is one key."""
    table = K.create_keyed(spark, "f", spark.range(20_000).selectExpr("id", "'a' AS s"), "id", prefix=place, splits=[5], rows_per_file=20).table
    batch = spark.range(12_000).selectExpr("if(id < 4000, 42, id + 10000) AS id", "CAST(id AS STRING) AS s")
    table = K.upsert(table, batch, order_by=[F.col("s").cast("int")]).table
    assert 50 <= len(table.read().inputFiles()) <= 130
    found = table.read([("id", "in", [42, 9999, 21_999])])
    assert opened(found) <= 3 and sorted((r.id, r.s) for r in found.collect()) == [(42, "3999"), (9999, "a"), (21_999, "11999")]
    assert table.read().count() == 22_000
