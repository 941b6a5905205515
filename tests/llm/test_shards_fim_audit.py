"""Resharding by flow, the piece table and the divergence audit, against brute force and on odd rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from keyed.llm import divergence, mixing, packing, piece_table, queries, resharding, topk
from keyed.llm.common import scratch
from tests.llm.test_llm import BYTES, LONG, ODD

ROWS = [(d, t, s, f, f, "en" if i % 3 else None, i, i) for i, (d, t, s, f) in enumerate(ODD)] + [
    (20, "a <P>b", "x", "x", "x", "en", 0, 0),
    (21, "Ω𝔘é<S", "x", "x", "x", "en", 0, 0),
    (22, "Word WORD word Ωmega", "y", "x", "x", "en", 0, 0),
]
SCHEMA = "doc_id long, text string, source string, form string, fim_text string, lang string, n int, pos int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def by_rule(doc_id, text):
    t = text or ""
    h = [int(sha(f"1:{'null' if doc_id is None else doc_id}")[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(t)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return n, "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


def test_fill_in_middle(spark, sf, odd):
    out = piece_table.fill_in_middle(odd)
    out = out.withColumn("back", piece_table.restored_text("fim_text", "form"))
    rows = out.collect()
    assert len(rows) == len(ROWS) and {"source", "lang", "pos"} <= set(out.columns)
    expected = Counter((r[0], *by_rule(r[0], r[1]), r[1] or "") for r in ROWS)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.fim_text, r.back) for r in rows) == expected
    assert all(r.output_sha256 == sha(r.fim_text) and r.restored_sha256 == sha(r.back) for r in rows)
    assert {"plain", "psm", "spm"} == {r.form for r in queries.op12_piece_table(spark, sf).collect()}
    assert piece_table.fill_in_middle(odd.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(10))
def test_piece_table(seed):
    r = np.random.default_rng(seed)
    text = "".join(r.choice(list("aé𝔘<>PSM日"), int(r.integers(0, 60)))).encode()
    at = sorted(r.integers(0, len(text) + 1, 3).tolist())
    table = piece_table.PieceTable([text]).cut(*at)
    parts = [text[a:b] for a, b in zip([0, *at], [*at, len(text)], strict=True)]
    assert [bytes(x) for x in table.stream()] == parts
    order = r.permutation(4).tolist()
    moved = table.permuted(order)
    assert moved.joined() == b"".join(parts[i] for i in order) and moved.sha256() == hashlib.sha256(moved.joined()).hexdigest()
    assert moved.restored(order).joined() == text and moved.buffers[0] is text


@pytest.mark.parametrize("seed", range(30))
def test_outputs_have_one_reading(seed):
    r = np.random.default_rng(seed)
    marks = [b"<P>", b"<S>", b"<M>"]
    text = "".join(r.choice(list("<>PSMé"), 12))
    if any(m.decode() in text for m in marks):
        text = text.replace(">", "")
    a, b = sorted(r.integers(0, len(text) + 1, 2).tolist())
    for form in ("psm", "spm"):
        output = piece_table.arrange(text.encode(), form, a, b, marks).joined()
        assert piece_table.restore(output, form, marks).joined() == text.encode()


@pytest.mark.parametrize("marks", [("ab", "ba", "x"), ("aa", "b", "c"), ("a", "xay", "c"), ("", "b", "c")])
def test_overlapping_sentinels_are_refused(odd, marks):
    with pytest.raises(ValueError):
        piece_table.fill_in_middle(odd, sentinels=marks)


def audited(rows, least=3, top=200):
    """lang, source, text rows by plain loops."""
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups.add((lang, source))
        counts[lang, source].update(found)
        seen[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        own = sorted(s for g, s in groups if g == lang)
        whole = Counter()
        for s in own:
            whole.update({t: counts[lang, s][t] for t in kept})

        def share(c, t, kept=kept):
            return 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept))

        p = {s: {t: share(counts[lang, s], t) for t in kept} for s in own}
        q = {t: share(whole, t) for t in kept}
        for s in own:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in own if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("cells", [1 << 22, 1])
def test_audit(spark, odd, monkeypatch, cells):
    monkeypatch.setattr(divergence, "CELLS", cells)  # one chunk, and chunks of 64 terms
    monkeypatch.setattr(divergence, "COUNTED", 50)
    rows = odd.select("lang", "source", "text", F.col("n").alias("term"), F.col("pos").alias("rank"), F.col("n").alias("value"))
    given = [(r[5], r[2], r[1]) for r in ROWS]
    for least, top in ((3, 200), (2, 3), (1, 200), (99, 5)):
        got = sorted(tuple(r) for r in divergence.audit(rows, least_docs=least, top=top).select("lang", "source", "part", "item", "value", "rank").collect())
        assert got == audited(given, least, top)
    assert divergence.audit(rows.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_forest_prices_every_pair_of_leaves_once(seed):
    r = np.random.default_rng(seed)
    counts = r.integers(0, 3, (5, int(r.integers(1, 40))))
    forest, asked = divergence.Forest(counts), []

    def price(who, a, b):
        asked.append((who, a, b))
        return np.where(a < 0, 0, a * 10 + b + who), np.where(a < 0, 0, b * 10 + a)

    others = np.array([3, 1, 4])
    there, turned, _ = forest.walk(0, others, price)
    assert there.tolist() == [sum(int(counts[0, t]) * 10 + int(counts[o, t]) + k for t in range(counts.shape[1])) for k, o in enumerate(others)]
    assert turned.tolist() == [sum(int(counts[o, t]) * 10 + int(counts[0, t]) for t in range(counts.shape[1])) for o in others]
    (who, a, b), = asked
    assert len(set(zip(who.tolist(), a.tolist(), b.tolist(), strict=True))) == len(who) <= 3 * 10


def test_shares_are_exact():
    big = 10**17 + 3
    assert divergence._shares(np.array([big]), np.array([3 * big]), 7).tolist() == [1 + 10**9 * (big + 1) // (3 * big + 7)]


def test_audit_repeats_equal_rows(spark):
    rows = [("x", "a", "one two")] * 3 + [("x", "b", None), ("y", "a", None), ("y", "c", "")]
    got = sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, "lang string, source string, text string")).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == audited(rows)


@pytest.mark.parametrize("seed", range(12))
def test_transfers_are_cheapest(seed):
    r = np.random.default_rng(seed)
    m, n = 2, 3
    old = r.integers(0, 5, m).tolist()
    new = r.integers(0, 5, n)
    new[0] += max(0, sum(old) - new.sum())
    cost = r.integers(0, 6, (m, n)) if seed % 2 else None
    sent = resharding.transfers(old, new.tolist(), cost)
    price = cost if cost is not None else (np.arange(m)[:, None] != np.arange(n)[None, :]).astype(int)
    assert sent.sum(axis=1).tolist() == old and (sent.sum(axis=0) <= new).all() and (sent >= 0).all()
    every = itertools.product(*[[x for x in itertools.product(range(o + 1), repeat=n) if sum(x) == o] for o in old])
    best = min(int((np.array(x) * price).sum()) for x in every if (np.array(x).sum(axis=0) <= new).all())
    assert int((sent * price).sum()) == best


def test_transfers_move_no_more_than_the_surplus():
    r = np.random.default_rng(5)
    old = r.integers(0, 10**12, 32).tolist()
    new = resharding.level_rooms(sum(old), np.zeros(40), np.ones(40))
    sent = resharding.transfers(old, new)
    assert sum(new) == sum(old) and max(new) - min(new) <= 1
    assert sum(old) - sum(int(sent[i, i]) for i in range(32)) == sum(max(0, a - b) for a, b in zip(old, new, strict=False))
    with pytest.raises(ValueError):
        resharding.transfers([5], [4])


def placed(store):
    return store.read().select("row.doc_id", "row.text", "size", "shard", "slot").collect()


def check_slots(rows, shards):
    own = defaultdict(list)
    for r in rows:
        assert r["size"] == len((r.text or "").encode()) + 16
        own[r.shard].append(r.slot)
    assert set(own) <= set(range(shards)) and all(sorted(x) == list(range(len(x))) for x in own.values())


def test_reshard_odd_rows(spark, odd):
    old = resharding.write_store(odd, scratch(spark, "store"), F.pmod(F.xxhash64("doc_id"), F.lit(3)), 3)
    wanted = Counter((r[0], r[1]) for r in ROWS)
    for after in (resharding.reshard(old, 5), resharding.reshard(resharding.reshard(old, 5), 2), resharding.reshard(old, 4, [4, 1, 1, 1])):
        rows = placed(after)
        assert Counter((r.doc_id, r.text) for r in rows) == wanted
        check_slots(rows, after.shards)
    names = after.read().select("row.*").columns
    assert names == odd.columns
    none = resharding.write_store(odd.limit(0), scratch(spark, "store"), F.lit(0), 3)
    assert resharding.reshard(none, 4).read().count() == 0


def test_reshard_moves_little_and_keeps_other_files(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 90 + 1).cast("int")).alias("text"))
    old = resharding.write_store(rows, scratch(spark, "store"), F.pmod(F.xxhash64("doc_id"), F.lit(8)), 8, file_bytes=50_000)
    before = {r.shard: r.bytes for r in old.totals().collect()}
    assert max(before.values()) > 3 * min(before.values())  # the id of a third of the rows
    new = resharding.reshard(old, 10)
    check_slots(placed(new), 10)
    after = {r.shard: r.bytes for r in new.totals().collect()}
    total = sum(after.values())
    assert total == sum(before.values()) and max(after.values()) - min(after.values()) <= 2 * 106
    surplus = sum(max(0, b - total // 10) for b in before.values())
    assert surplus <= new.moved <= surplus + 10 * 106
    assert new.rewritten < total / 3
    files = lambda s: {(r.gen, r.file) for r in s.manifest.collect()}
    assert len(files(old) & files(new)) > len(files(old)) / 2
    shares = {r.shard: r.bytes for r in resharding.reshard(new, 3, [1, 2, 1]).totals().collect()}
    assert abs(shares[1] - total / 2) <= 300


def test_large_documents_are_placed_first(spark):
    texts = [(i, "y" * n) for i, n in enumerate([90_000, 50_000, 40_000, 30_000, 30_000, *range(300, 700)])]
    old = resharding.write_store(spark.createDataFrame(texts, "doc_id long, text string"), scratch(spark, "store"), F.lit(0), 2)
    after = {r.shard: r.bytes for r in resharding.reshard(old, 5).totals().collect()}
    assert max(after.values()) - min(after.values()) <= 1500


def test_resharding_query(spark, sf):
    rows = queries.op11_flow_resharding(spark, sf).collect()
    own, bytes_of = defaultdict(list), Counter()
    given = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    for r in rows:
        text = (given[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text), "bytes", None)
        own[r.shard].append(r.slot)
        bytes_of[r.shard] += r["size"]
    assert sorted(r.doc_id for r in rows) == sorted(given)
    assert all(sorted(x) == list(range(len(x))) for x in own.values()) and set(own) <= set(range(40))
    largest = max(r["size"] for r in rows)
    assert max(bytes_of.values()) - min(bytes_of.values()) <= largest


def test_long_texts(spark):
    rows = spark.createDataFrame([(1, "en", "a", LONG * 5)], "doc_id long, lang string, source string, text string")
    assert divergence.audit(rows, least_docs=1).count() == 0  # one group: no other source, and no share above the language's
    r = piece_table.fill_in_middle(rows).first()
    assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.fim_text) == by_rule(1, LONG * 5)


def test_blocks_stop_early_and_stay_exact():
    r = np.random.default_rng(3)
    v = r.normal(size=(4000, 64))
    v = np.floor(1024 * v / np.linalg.norm(v, axis=1)[:, None]).astype(np.int64)
    names = np.arange(4000)
    names[1000:2000] = 7  # one id for a quarter of the rows
    shard = topk.Shard(names, v)
    own = np.array([7, 0, 3999, 55])
    q = np.concatenate((v[[1500, 0, 3999]], v[[55]] * 0))
    for (ids, scores), i, x in zip(shard.search_block(own, q, 10), own, q, strict=True):
        every = sorted((-int(a @ x), int(n)) for a, n in zip(v, names, strict=True) if n != i)[:10]
        assert [(-int(s), int(n)) for n, s in zip(ids, scores, strict=True)] == every
    shard.read = shard.rescored = shard.asked = 0
    shard.search_block(names[:100], v[:100], 10)
    assert shard.read < 0.8 * 100 * v.size and shard.rescored < 0.1 * 100 * len(v)


def test_one_id_for_a_third_of_the_vectors(spark):
    rows = [(5 if i % 3 == 0 else i, [float(i % 7), float(i % 11) / 4]) for i in range(600)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(v, v.filter("vec_id in (5, 10)"), k=4, shard_rows=50)
    whole = [(i, np.floor(1024 * np.array(x)).astype(int)) for i, x in rows]
    for own in (5, 10):
        q = [x for i, x in whole if i == own]
        every = sorted((-int(a @ b), n) for b in q for n, a in whole if n != own)
        assert sorted((r.score for r in got.filter(f"query_id = {own}").collect()), reverse=True) == [-s for s, _ in every[:4]]


def best_fit(counts, capacity):
    """Best fit of falling lengths, one by one."""
    rooms, n = Counter(), 0
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            room = min((r for r, k in rooms.items() if k and r >= size), default=None)
            if room is None:
                n, room = n + 1, capacity
            else:
                rooms[room] -= 1
            rooms[room - size] += 1
    return n


@pytest.mark.parametrize("low, high", [(600, 1100), (300, 2048), (400, 800), (1, 2048), (1, 300)])
def test_packing_needs_no_more_sequences_than_best_fit(low, high):
    counts = Counter(np.random.default_rng(low).integers(low, high + 1, 1500).tolist())
    packed = packing.fewest(counts, 2048)
    used = Counter()
    for sizes, n in packed:
        assert sum(sizes) <= 2048
        for s in sizes:
            used[s] += n
    assert used == counts and sum(n for _, n in packed) <= best_fit(counts, 2048)


def test_packing_of_the_given_table(spark, sf):
    lengths = packing.pieces(spark.read.parquet(f"{sf}/documents.parquet"), BYTES, 0, 2048).groupBy("length").count().collect()
    counts = {r.length: r["count"] for r in lengths}
    assert sum(n for _, n in packing.fewest(counts, 2048)) <= best_fit(counts, 2048)
    assert packing.fewest({}, 2048) == []


def test_mixing_and_its_sql_keep_rows_without_a_source(spark):
    rows = [(i, "x" * (i % 50 + 1), "en", None if i % 3 == 0 else f"s{i % 2}", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix(docs).select("doc_id", "replica", "mix_key").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    found = con.execute(f"SELECT doc_id, replica, mix_key FROM ({queries.SQL['op1_poisson_mixing']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(found) and any(r[0] % 3 == 0 for r in found)


def test_stages_on_odd_rows(spark, sf):
    import corpus_pipeline as p

    passage = " ".join(f"p{i}" for i in range(70))
    rows = [
        (1, None, "en", "a", None, "x"), (2, "", None, "a", 0, "x"), (3, f"one {passage} two", "en", None, 300, None), (4, f"three {passage} four", "en", "b", 300, "x"),
        (4, f"three {passage} four", "en", "b", 300, "x"), (None, "five six seven eight", "en", "b", 20, "x"), (5, LONG, "en", "b", len(LONG), "x"), (6, " \n", "en", "c", 2, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fingerprint string")
    found = {}
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), sf).count() == 0
        found[name] = [tuple(r) for r in out.collect()]
    given = set(rows)
    assert set(found["quality classifier"]) <= given
    kept = found["near duplicates"]
    assert set(kept) <= given and len(kept) == len({r[0] for r in kept}) and {1, 3, 4, 5, None} <= {r[0] for r in kept} and not {2, 6} & {r[0] for r in kept}
    cut = {(r[0], r[1]) for r in found["substring dedup"]}
    assert len(found["substring dedup"]) == 8 and (4, "three four") in cut and (3, rows[2][1]) in cut and (None, rows[5][1]) in cut
    assert {r[1] for r in found["mixing"]} <= {r[1] for r in rows}
    packed = p.STAGES[-1][1](spark, docs, sf)
    assert packed.filter("doc_id in (1, 2) and length = 1").count() == 2 and p.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0
