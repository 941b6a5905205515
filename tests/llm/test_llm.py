"""Every operator of the text package against brute force, and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keyed.llm import components, convnet, mixing, packing, queries, records, rules, simhash, substring, token_counts, topk, toxicity
from keyed.llm.common import scratch, spread_join

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
ODD = [
    (5, None, "a", "x"),
    (1, "", "a", "x"),
    (2, " \t\n ", None, "x"),
    (3, f"one two {PASSAGE} three", "b", None),
    (4, f"four {PASSAGE} five\nsix", "b", "x"),
    (4, f"four {PASSAGE} five\nsix", "b", "x"),
    (None, f"seven {PASSAGE}", "b", "x"),
    (9, LONG, "c", "x"),
    (7, LONG, "c", "x"),
    (8, "Don't  stop<|endoftext|>it's é́ 日本語\r\n\x85 ", "c", "x"),
]
SCHEMA = "doc_id long, text string, source string, f string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture
def given(sf):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ids(path, text, end=None):
    found = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids if text else []
    return found + ([] if end is None else [end])


def bag(rows):
    return sorted(map(repr, rows))


def test_token_counts(spark, sf, odd, given):
    got = {r.doc_id: r for r in queries.op2_token_counts(spark, sf).collect()}
    library = Tokenizer.from_file(BYTES)
    for d, e in zip(given, library.encode_batch([t for _, t in given], add_special_tokens=False), strict=True):
        assert (got[d[0]].n_bytes, got[d[0]].n_tokens, got[d[0]].over_limit) == (len(d[1].encode()), len(e.ids), len(e.ids) > 512)
    rows = token_counts.count_tokens(odd, BYTES).collect()
    assert rows[0].asDict().keys() == {"doc_id", "text", "source", "f", "n_bytes", "n_tokens", "over_limit"}
    assert Counter(r.n_tokens for r in rows) == Counter(len(ids(BYTES, t)) for _, t, _, _ in ODD)
    assert token_counts.count_tokens(odd.limit(0), BYTES).count() == 0


def test_packing(spark, sf, odd):
    def check(rows, texts):
        whole, places = defaultdict(list), defaultdict(list)
        for r in rows:
            whole[r.doc_id].append(r)
            places[r.sequence_id].append((r.offset, r.length))
        for own in places.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= 2048
        for d, text in texts:
            tokens = np.array(ids(BYTES, text, 0), "<u4")
            for r in whole[d]:
                assert zlib.crc32(tokens[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        return len(places), sum(r.length for r in rows)

    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    n, total = check(queries.op8_best_fit_packing(spark, sf).collect(), docs)
    assert n <= 1.05 * total / 2048 + 1
    rows = packing.pack(odd, BYTES).collect()
    check(rows, [(d, t) for d, t, _, _ in ODD if d != 4])
    assert sum(r.length for r in rows) == sum(len(ids(BYTES, t, 0)) for _, t, _, _ in ODD)
    assert all(r.length == 2048 for r in rows if r.piece)
    assert packing.pack(odd.limit(0), BYTES).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_every_length(seed):
    r = np.random.default_rng(seed)
    top = int(r.choice([5, 60, 2048]))
    counts = Counter(r.integers(1, top + 1, int(r.choice([1, 40, 3000]))).tolist())
    packed = packing.plan(dict(counts), top)
    used = Counter()
    for sizes, n in packed:
        assert n > 0 and 0 < sum(sizes) <= top
        for s in sizes:
            used[s] += n
    assert used == counts


def test_records(spark, sf, odd, given):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op10_binary_records(spark, sf).collect()}
    at = 0
    for (d, _), e in zip(given, Tokenizer.from_file(WORDS).encode_batch([t for _, t in given], add_special_tokens=False), strict=True):
        own = np.array([*e.ids, 1], "<u4")
        assert got[d] == (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)
    folder = scratch(spark, "odd")
    index = records.write_records(odd, folder, WORDS, 1)
    back = records.read_records(spark, folder).collect()
    assert bag((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in back) == bag((d, ids(WORDS, t, 1)) for d, t, _, _ in ODD)
    assert [r.doc_id for r in sorted(back, key=lambda r: r.start)] == [None, 1, 2, 3, 4, 4, 5, 7, 8, 9]
    some = records.read_at(index.filter("doc_id in (8, 9)"), folder).collect()
    assert bag((r.doc_id, len(r.ids) // 4) for r in some) == bag((d, len(ids(WORDS, t, 1))) for d, t, _, _ in ODD if d in (8, 9))
    empty = scratch(spark, "none")
    assert records.write_records(odd.limit(0), empty, WORDS, 1).count() == 0 and records.read_records(spark, empty).count() == 0


def test_damaged_record():
    data = bytearray(records.frame(b"payload"))
    data[14] ^= 1
    import io

    with pytest.raises(ValueError, match="damaged"):
        records.read_record(io.BytesIO(bytes(data)))


def fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_classes(rows):
    prints = [fingerprint(t) for _, t in rows]
    near = [{j for j, q in enumerate(prints) if (p ^ q).bit_count() <= 2} for p in prints]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        least = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], format(prints[i], "016x"), min(least, default=None)))
    return out


@pytest.mark.parametrize("crowd", [64, 1])
def test_simhash(spark, sf, odd, given, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    got = queries.op5_simhash_near_dedup(spark, sf).collect()
    assert bag((r.doc_id, r.fingerprint, r.component_id) for r in got) == bag(near_classes(given))
    rows = simhash.near_duplicates(odd).collect()
    assert bag((r.doc_id, r.fingerprint, r.component_id) for r in rows) == bag(near_classes([x[:2] for x in ODD]))
    kept = simhash.one_of_each(odd).collect()
    expected = {c if c is not None else "none" for _, _, c in near_classes([x[:2] for x in ODD])}
    assert len(kept) == len(expected) and {r.doc_id for r in kept} <= {x[0] for x in ODD} and "f" in kept[0].asDict()
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("crowd", [64, 0])
def test_simhash_links_at_any_distance(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    r = np.random.default_rng(4)
    prints = set()
    for base in r.integers(0, 1 << 63, 12):
        prints |= {int(base) ^ sum(1 << int(i) for i in r.choice(64, r.integers(0, 6), replace=False)) for _ in range(12)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for distance in (1, 3, 5):
        got = simhash.links(spark.createDataFrame([(p,) for p in signed], "f long"), distance).collect()
        assert bag(map(tuple, got)) == bag((p, q) for p in signed for q in signed if p < q and ((p ^ q) & ((1 << 64) - 1)).bit_count() <= distance)
    assert simhash.fingerprint("a b c d e", 5) == xxhash.xxh64_intdigest(b"a b c d e", 42)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40) if i != 20] + [(100, 50), (100, 60), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert all(got.get(i, 0) == 0 for i in range(21)) and all(got.get(i, 21) == 21 for i in range(21, 41))
    assert got[100] == got[60] == 50


def kept_words(rows, window=50):
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if d is not None:
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w, gone = words(t), set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("shard", [512, 3, 1])
def test_substring(spark, sf, odd, given, monkeypatch, shard):
    monkeypatch.setattr(substring, "SHARD", shard)
    got = queries.op4_substring_dedup(spark, sf).collect()
    assert bag(map(tuple, got)) == bag(kept_words(given))
    rows = substring.remove_repeats(odd).collect()
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == bag(kept_words([x[:2] for x in ODD]))
    assert {r.text for r in rows if r.doc_id == 4} == {"four five\nsix"} and [r.text for r in rows if r.doc_id == 3] == [ODD[3][1]]
    assert substring.remove_repeats(odd.limit(0)).count() == 0


def test_automaton_finds_what_a_search_finds():
    r = np.random.default_rng(2)
    for _ in range(200):
        known = [r.integers(0, 3, r.integers(0, 12)).tolist() for _ in range(3)]
        asked = r.integers(0, 3, 12).tolist()
        a = substring.Automaton()
        for k in known:
            a.add(k)
        spans, _ = a.matched(asked, 3)
        expected = {i + j for i in range(10) for j in range(3) if any(asked[i : i + 3] == k[x : x + 3] for k in known for x in range(len(k)))}
        assert {i for b, e in spans for i in range(b, e)} == expected


def test_mixing(spark, sf, odd):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = queries.op1_poisson_mixing(spark, sf)
    found = con.execute(queries.SQL["op1_poisson_mixing"])
    names = [d[0] for d in found.description]
    assert bag(tuple(r[c] for c in names) for r in got.collect()) == bag(found.fetchall())
    rows = mixing.mix(odd, weights={"b": 1.0}, budget=50.0).collect()
    assert rows and {r.source for r in rows} == {"b"} and rows[0].asDict().keys() >= {"f", "replica", "mix_key"}
    per = Counter((r.doc_id, r.text) for r in rows)
    assert per[(4, ODD[4][1])] % 2 == 0
    assert mixing.mix(odd.limit(0)).count() == 0 and mixing.mix(odd, weights={}).count() == 0


@pytest.mark.parametrize("sent", [100_000, 0])
def test_mixing_keeps_rows_without_a_source(spark, monkeypatch, sent):
    monkeypatch.setattr(mixing, "MOST_SENT", sent)
    docs = spark.createDataFrame([(i, "x" * 100, ["a", "b", None][i % 3]) for i in range(3000)], "doc_id long, text string, source string")
    got = Counter(r.source for r in mixing.mix(docs).select("source").collect())
    assert got.keys() == {"a", "b", None} and all(abs(n - 1000) < 150 for n in got.values())
    named = Counter(r.source for r in mixing.mix(docs, weights={None: 3.0, "a": 1.0}).select("source").collect())
    assert named.keys() == {"a", None} and abs(named[None] - 2250) < 250 and abs(named["a"] - 750) < 150
    assert {r.source for r in mixing.mix(docs, weights={"a": 1.0}).select("source").collect()} == {"a"}
    assert {r.source for r in mixing.mix(docs, weights={None: 1.0}).select("source").collect()} == {None}


def test_poisson_inverts_the_distribution(spark):
    rows = spark.range(20_000).select(mixing.poisson(mixing.uniform("id"), mixing.F.lit(2.5)).alias("k")).toPandas().k
    assert abs(rows.mean() - 2.5) < 0.05 and abs(rows.var() - 2.5) < 0.15
    big = spark.range(500).select(mixing.poisson(mixing.uniform("id"), mixing.F.lit(1200.0)).alias("k")).toPandas().k
    assert abs(big.mean() - 1200) < 20


@pytest.mark.parametrize("mean", [499.5, 650.0, 701.0, 3750.0, 40_000.0])
def test_poisson_is_one_distribution_at_any_mean(spark, mean):
    us = [0.001, 0.02, 0.1587, 0.3, 0.5, 0.75, 0.8413, 0.98, 0.999, 1 - 2.0**-52]
    got = [r.k for r in spark.createDataFrame([(u, mean) for u in us], "u double, m double").select(mixing.poisson(mixing.F.col("u"), mixing.F.col("m")).alias("k")).collect()]
    k = np.arange(int(mean + 20 * mean**0.5))
    below = np.cumsum(np.exp(k * np.log(mean) - mean - np.array([math.lgamma(i + 1) for i in k])))
    assert got[:-1] == np.searchsorted(below, us[:-1], side="right").tolist() and got[-2] < got[-1] < mean + 12 * mean**0.5 + 31


def labelled(sf, column):
    return duckdb.sql(f"SELECT doc_id, text, {column} FROM '{sf}/documents.parquet' JOIN '{sf}/labels.parquet' USING (doc_id) ORDER BY 1").fetchall()


@pytest.mark.parametrize("name,column,mod,out,least", [("op3_toxicity", "toxic", 3, 1, 0.85), ("op7_quality_network", "quality", 4, 2, 0.9)])
def test_held_out_accuracy(spark, name, column, mod, out, least):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, sf).collect()}
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(d).encode()) % mod == out) and 0 <= r.score <= 1 for d, r in got.items())
    assert all(r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [(got[d].predicted, y) for d, _, y in labelled(sf, column) if got[d].held_out]
    assert np.mean([p == y for p, y in held]) >= least


def test_classifiers_on_odd_rows(odd):
    y = np.array([0, 1, 0, 1], float)
    model = toxicity.fit(["good day to you", "vile nasty scum here", "lovely nice day", "nasty scum again"], y)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    net = convnet.fit(["aaaa bbbb cccc", "%%%% $$$$", None, "dddd eeee"], np.array([1, 0, 0, 1], float))
    rows = convnet.score(odd, net).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert convnet.score(odd.limit(0), net).count() == 0 and toxicity.score(odd.limit(0), model).count() == 0
    assert abs(net.probability(LONG) - net.probabilities([LONG, None])[0]) < 1e-6
    assert toxicity.fit([], np.zeros(0)).scorer()("x") == 0.5 and convnet.fit([], np.zeros(0)).probability(None) == 0.5


def test_network_is_calibrated_to_all_labels(spark, monkeypatch):
    n = 600  # 90 of 100 are good, 80 of the 100 in letters
    rows = [(i, "aaaa bbbb cccc " * 3 if i % 2 else "%%%% $$$$ " * 3, int(i % 10 != 1)) for i in range(n)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 0)] * n + [(0, None)], "doc_id long, quality int")
    whole = convnet.train(docs, labels, convnet.F.lit(True))
    monkeypatch.setattr(convnet, "SAMPLE", {0: 60, 1: 60})
    capped = convnet.train(docs, labels, convnet.F.lit(True))
    for text, share in ((rows[1][1], 0.8), (rows[0][1], 1.0)):
        assert abs(whole.probability(text) - share) < 0.1 and abs(capped.probability(text) - share) < 0.1
    monkeypatch.setattr(convnet, "SAMPLE", {0: 0, 1: 60})
    assert abs(convnet.train(docs, labels, convnet.F.lit(True)).probability("x") - 0.9) < 1e-6


def rule_counts(text):
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n, covered, seen, dup = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if n[g] > 1:
            covered |= {i, i + 1, i + 2}
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_rules(spark, sf, odd, given):
    texts = dict(given)
    rows = queries.op6_quality_rules(spark, sf).collect()
    for r in rows:
        c = rule_counts(texts[r.doc_id])
        assert tuple(r)[1:6] == c and r.base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0]) and not (r.base_failed and r.kept)
    good = {d for d, _, y in labelled(sf, "quality") if y}
    assert np.mean([r.kept for r in rows if r.doc_id in good and not r.base_failed]) > 0.9
    judged = rules.judge(odd, rules.fit(np.zeros((0, 10)), np.zeros(0))).collect()
    assert bag((r.doc_id, *(r[c] for c in rules.COUNTS[:5])) for r in judged) == bag((d, *rule_counts(t)) for d, t, _, _ in ODD)


def test_trees_are_calibrated_to_all_labels(spark, monkeypatch):
    n = 600  # 90 of 100 are good, 80 of the 100 with odd ids
    rows = [(i, "aaaa bbbb cccc " * 3 if i % 2 else "%%%% $$$$ " * 3, int(i % 10 != 1)) for i in range(n)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 0)] * n + [(0, None)], "doc_id long, quality int")
    x = rules.features(np.array([rules.counts(rows[1][1]), rules.counts(rows[0][1])]))
    whole = rules.train(docs, labels)
    monkeypatch.setattr(rules, "SAMPLE", {0: 60, 1: 60})
    capped = rules.train(docs, labels)
    for t in (whole, capped):
        assert np.abs(t.probability(x) - [0.8, 1.0]).max() < 0.1
    monkeypatch.setattr(rules, "SAMPLE", {0: 0, 1: 60})
    assert np.abs(rules.train(docs, labels).probability(x) - 0.9).max() < 1e-6


def test_trees_keep_their_constraints():
    r = np.random.default_rng(0)
    x = r.random((2000, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * r.normal(size=2000) > 0.6).astype(float)
    t = rules.fit(x, y, [1, -1, 0])
    grid = np.tile(r.random((50, 3)), (20, 1, 1))
    for j, sign in ((0, 1), (1, -1)):
        g = grid.copy()
        g[:, :, j] = np.linspace(0, 1, 20)[:, None]
        p = t.probability(g.reshape(-1, 3)).reshape(20, 50)
        assert (sign * np.diff(p, axis=0) >= -1e-12).all()
    assert ((t.probability(x) > 0.5) == y).mean() > 0.8


def test_top_k(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = queries.op9_exact_top_k(spark, sf).select("query_id", "rank", "vec_id", "score").collect()
    assert bag(map(tuple, got)) == bag(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({queries.SQL['op9_exact_top_k']})").fetchall())
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [3.0]), (None, [1.0, 1.0]), (6, [-1.0, 0.0]), (6, [1.0, 2.0]), (7, [])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(v, v.filter("vec_id = 0"), k=2).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1, 5 << 20), (2, 6, 5 << 20)]
    assert topk.top_k(v.limit(0), v, k=2).count() == 0


def test_shard_search_is_exact():
    r = np.random.default_rng(1)
    for _ in range(200):
        n, d, most = r.integers(1, 200), r.integers(1, 12), int(r.choice([2, 50, 2000]))
        v, names = r.integers(-most, most + 1, (n, d)), r.permutation(2 * n)[:n]
        q = r.integers(-most, most + 1, d)
        found, scores = topk.Shard(names, v).search(int(names[0]), q, 10)
        expected = sorted((-int(x @ q), int(i)) for x, i in zip(v, names, strict=True) if i != names[0])[:10]
        assert [(-int(s), int(i)) for i, s in zip(found, scores, strict=True)] == expected


def test_pipeline(spark, sf):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in p.STAGES[:-1]:
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        after = docs.collect()
        if name == "near duplicates":
            classes = near_classes([(r.doc_id, r.text) for r in before])
            assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in classes})
        if name == "substring dedup":
            expected = {d: n for d, _, n, _ in kept_words([(r.doc_id, r.text) for r in before])}
            assert all(len(words(r.text)) == len(words(texts[r.doc_id])) - expected[r.doc_id] for r in after)
            assert all(r.n_chars == len(r.text) for r in after if expected[r.doc_id])
    rows = p.STAGES[-1][1](spark, docs, sf).collect()
    assert sum(r.length for r in rows) == sum(len(ids(BYTES, r.text, 0)) for r in docs.collect())


def test_substring_of_a_crowded_line(spark, monkeypatch):
    """A line and a long passage that all documents have, with single words changed: every path has rows."""
    monkeypatch.setattr(substring, "SHARD", 4)
    r = np.random.default_rng(5)
    line = [f"common{n}" for n in range(20)]
    base = [f"w{n}" for n in range(160)]
    rows = []
    for d in range(60):
        own = base.copy()
        for at in r.integers(0, len(base), 2):
            own[at] = f"changed{d}"
        rows.append((d, " ".join([f"x{d}y{n}" for n in range(60)] + line + own + line + [f"z{d % 7}y{n}" for n in range(60)])))
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), only_digest=True).collect()
    assert bag(map(tuple, got)) == bag(kept_words(rows))


def test_spread_join(spark):
    """A key with most rows is dealt to many places; the rows are those of a plain join."""
    rows = spark.range(4000).selectExpr("CASE WHEN id % 10 < 8 THEN 7 WHEN id % 10 = 8 THEN 100 + id % 50 ELSE 9 END AS k", "id AS v")
    counts = rows.groupBy("k").agg(F.count("*").alias("m"))
    once = counts.filter("k <> 9").withColumn("w", F.col("k") * 2)
    got = spread_join(rows, once, ["k"], counts, 4000, ["v"])
    assert got.columns == ["k", "v", "w"]
    assert bag(map(tuple, got.collect())) == bag((r.k, r.v, 2 * r.k) for r in rows.collect() if r.k != 9)
    assert spread_join(rows.limit(0), once, ["k"], counts.limit(0), 0, ["v"]).count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 1200  # 3,200 rows have one key
