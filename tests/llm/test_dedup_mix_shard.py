import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from samples import SCHEMA, rows, sorted_rows, words

from tallyport.llm import mixing, sharding, similar, simhash


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    parts = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    parent = {f: f for f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in prints}


def test_simhash_equals_brute_force(docs):
    data = rows()
    prints = {r[1]: plain_print(r[1]) for r in data}
    roots = plain_components(set(prints.values()))
    least = defaultdict(lambda: 1 << 60)
    for i, text, *_ in data:
        if i is not None:
            least[roots[prints[text]]] = min(least[roots[prints[text]]], i)
    want = sorted([(i, f"{prints[t]:016x}", least[roots[prints[t]]] if least[roots[prints[t]]] < 1 << 60 else None) for i, t, *_ in data], key=repr)
    assert sorted_rows(simhash.near_duplicates(docs)) == want


def test_links_are_all_pairs_within_three_bits(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(6):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            prints.add(base)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in simhash.components(simhash.links(simhash.candidates(df))).collect()}
    want = plain_components(prints)
    groups = defaultdict(set)
    for p in prints:
        groups[want[p]].add(roots.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_simhash_empty_and_clashes(empty, clashing, docs):
    assert simhash.near_duplicates(empty).count() == 0
    assert sorted_rows(simhash.near_duplicates(clashing)) == sorted_rows(simhash.near_duplicates(docs))


def plans_written(monkeypatch, *modules):
    """The plans of the tables that these modules write from now on, as (name, text)."""
    seen = []

    def noted(df, name, cut=simhash.cut):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return cut(df, name)

    for module in modules:
        monkeypatch.setattr(module, "cut", noted)
    return seen


def test_simhash_broadcasts_no_table_that_spark_sizes_too_low(docs, monkeypatch):
    seen = plans_written(monkeypatch, simhash)
    found = simhash.near_duplicates(docs)
    seen.append(("result", found._jdf.queryExecution().executedPlan().toString()))
    # Links and roots are random longs, which no file packs: their steps may go by the file's size.
    own = [(name, plan) for name, plan in seen if not name.startswith("cc")]
    assert any("SortMergeJoin" in plan for _, plan in own)
    assert [name for name, plan in own if "Broadcast" in plan] == []


def test_similar_stage_equals_brute_force(spark, docs):
    kept = {(r.doc_id, r.text) for r in similar.stage(spark, docs, "").collect()}
    sets = [(i, t, similar.shingles(similar.text_words(t.encode() if t else None))) for i, t, *_ in rows()]
    order = sorted(sets, key=lambda x: (x[0] is None, x[0] or 0))
    group: list[list] = []
    for item in order:
        near = [g for g in group if any(similar.similarity(item[2], o[2]) >= 0.8 for o in g)]
        for g in near[1:]:
            near[0].extend(g)
            group.remove(g)
        near[0].append(item) if near else group.append([item])
    want = {min(((x[0] is None, x[0] or 0), x[0], x[1]) for x in g)[1:] for g in group if None not in [x[1] for x in g]}
    want |= {(i, t) for g in group for i, t, _ in g[:1] if t is None}
    assert {k for k in kept if k[1]} == {w for w in want if w[1]}
    assert similar.stage(spark, docs, "").columns == docs.columns
    assert sum(1 for k in kept if not (k[1] or "").strip()) == 1


def test_similar_stage_broadcasts_no_table_that_spark_sizes_too_low(spark, docs, monkeypatch):
    seen = plans_written(monkeypatch, simhash, similar)
    similar.stage(spark, docs, "")
    # These join with counted rows (bearers) or with texts and pairs, of which Spark knows the size.
    known = {"similar-whole", "similar-pairs"}
    assert {"similar-near", "similar-balls", "similar-live", "similar-links"} <= {name for name, _ in seen}
    assert [name for name, plan in seen if "Broadcast" in plan and not name.startswith("cc") and name not in known] == []


def test_similar_stage_takes_repeats_hubs_and_clashes(spark, empty, clashing):
    assert similar.stage(spark, empty, "").count() == 0
    assert set(similar.stage(spark, clashing, "").columns) == set(clashing.columns)
    base = words(200, 1)
    copies = [(i, " ".join([*base[:100], f"copy{i}", *base[101:]]), "en", "s", 0) for i in range(150)]
    hub = spark.createDataFrame([*copies, (7, "another text of the same id", "en", "s", 0)], SCHEMA)
    assert sorted(r.doc_id for r in similar.stage(spark, hub, "").collect()) == [0, 7]


def test_mix_equals_sql(docs, tmp_path):
    docs.write.parquet(str(tmp_path / "d"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = sorted((tuple(r) for r in db.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.SQL})").fetchall()), key=repr)
    got = mixing.mix(docs.sparkSession.read.parquet(str(tmp_path / "d"))).drop("repeats")
    assert sorted_rows(got) == want


def test_mix_tells_rows_without_ids_apart(spark):
    data = [(None, " ".join(words(10, i)), "en", "a" if i % 2 else "b", 0) for i in range(100)]
    mixed = mixing.mix(spark.createDataFrame(data, SCHEMA)).groupBy("target").agg(F.sum("taken").alias("t")).collect()
    assert len(mixed) == 2
    assert all(abs(r.t - r.target) <= 10 for r in mixed)


def test_mix_takes_repeated_rows_one_by_one(spark, tmp_path):
    """A hundred times the same row in either source, and rows alike but for the source."""
    data = [(None, "one two three four five six seven eight nine ten", "en", "a" if i % 5 < 3 else "b", i % 7) for i in range(200)]
    data += [(1, "x y", "en", s, 0) for s in ("a", "b", None)]
    docs = spark.createDataFrame(data, SCHEMA)
    mixed = mixing.mix(docs)
    for r in mixed.groupBy("target").agg(F.sum("taken").alias("t")).collect():
        assert abs(r.t - r.target) <= 10
    docs.write.parquet(str(tmp_path / "d"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = sorted((tuple(r) for r in db.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.SQL})").fetchall()), key=repr)
    assert sorted_rows(mixed.drop("repeats")) == want
    assert mixing.stage(spark, docs, "").count() == mixed.agg(F.sum("repeats")).first()[0]


def test_targets_water_fill(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 90), ("z", 0)], "source string, source_size long")
    got = {r.source: r for r in mixing.targets(sizes).collect()}
    left = 1600 - 30
    assert got["a"].target == 30
    free = {"b": 2, "c": 1, None: 2}
    capped_null = min(270, left * 2 / 5)
    assert got[None].target == capped_null or got[None].target == 270
    assert abs(sum(r.target for r in got.values()) - 1600) < 1e-6
    assert all(r.target <= 3 * r.source_size + 1e-9 for r in got.values())
    assert got["b"].target / got["c"].target == free["b"] / free["c"]


def test_mix_comes_near_targets_and_repeats_rows(spark, docs, empty):
    mixed = mixing.mix(docs)
    by = {r.source_size: r for r in mixed.groupBy("source_size").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("m")).collect()}
    assert all(abs(r.t - r.g) <= r.m for r in by.values())
    assert mixed.where("taken > 3 * size").count() == 0
    assert sorted_rows(mixing.mix(docs)) == sorted_rows(mixed)
    assert mixing.mix(empty).count() == mixing.stage(spark, empty, "").count() == 0
    staged = mixing.stage(spark, docs, "")
    assert staged.columns == docs.columns
    counts = Counter({r.doc_id: 0 for r in docs.collect()}) + Counter(r.doc_id for r in staged.collect())
    want = Counter()
    for r in mixed.collect():
        want[r.doc_id] += r.repeats
    assert counts == want


def test_mix_keeps_clashing_columns(spark, clashing):
    staged = mixing.stage(spark, clashing, "")
    assert {(r.place, r.bucket) for r in staged.select("place", "bucket").collect()} == {("x", "y")}


def check_shards(found, data):
    assert len(found) == len(data)
    by = defaultdict(list)
    load = Counter()
    for r in found:
        by[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    biggest = max(r["size"] for r in found)
    assert max(load.values()) - min(load[s] for s in range(16)) <= biggest
    assert {r.law for r in found} == {"bytes"}


def test_shard_places_and_sizes(docs, tmp_path):
    many = docs.crossJoin(docs.sparkSession.range(20).withColumnRenamed("id", "n")).withColumn("doc_id", F.col("doc_id") * 20 + F.col("n")).drop("n")
    found = sharding.shard(many.where("length(text) < 5000"), str(tmp_path / "map"), keep=["doc_id"]).collect()
    check_shards(found, many.where("length(text) < 5000").collect())
    sizes = {r.doc_id: len((r.text or "").encode()) + 1 for r in many.collect() if r.doc_id is not None}
    assert all(r["size"] == sizes[r.doc_id] for r in found if r.doc_id is not None)


def test_slot_map_versions(spark, tmp_path):
    first = sharding.SlotMap.initial(64, 4)
    sizes = [i * i for i in range(64)]
    second = first.rebalanced(sizes)
    assert max(second.loads()) - min(second.loads()) <= 64
    grown = second.grown()
    assert all(b in (a, 4) for a, b in zip(second.shard_of, grown.shard_of, strict=True))
    assert 4 in grown.shard_of
    for m in (first, second, grown, second):
        m.save(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError):
        sharding.SlotMap.initial(64, 4).rebalanced(sizes[::-1]).save(spark, str(tmp_path / "m"))
    assert sharding.SlotMap.load(spark, str(tmp_path / "m")) == grown
    assert sharding.SlotMap.load(spark, str(tmp_path / "m"), 2) == second


def test_second_run_edits_the_stored_map(spark, docs, tmp_path):
    path = str(tmp_path / "map")
    first = sharding.shard(docs, path)
    again = sharding.shard(docs, path)
    assert sorted_rows(first) == sorted_rows(again)
    assert {r.map_version for r in again.collect()} == {2}
    assert spark.read.parquet(path).count() == 2 * sharding.SLOTS
    more = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000))
    third = sharding.shard(more, path, keep=["doc_id", "text"])
    check_shards(third.collect(), more.collect())
    old, new = sharding.SlotMap.load(spark, path, 2), sharding.SlotMap.load(spark, path)
    assert (new.version, len(new.shard_of)) == (3, sharding.SLOTS)
    # Slots without rows never move, and what the map says is where the rows are.
    bytes_of = Counter()
    for r in third.collect():
        assert new.shard_of[r.virtual_slot] == r.shard
        assert r.text_crc32 == (zlib.crc32(r.text.encode()) if r.text is not None else 0)
        bytes_of[r.virtual_slot] += r["size"]
    assert new.bytes_of == [bytes_of[s] for s in range(sharding.SLOTS)]
    assert all(a == b for s, (a, b) in enumerate(zip(old.shard_of, new.shard_of, strict=True)) if not new.bytes_of[s] and not old.bytes_of[s])
    grown = sharding.shard(docs, path, shards=17)
    assert {r.map_version for r in grown.collect()} == {4}
    with pytest.raises(ValueError):
        sharding.shard(docs, path, shards=16)
    with pytest.raises(ValueError):
        sharding.shard(docs, path, slots=64)


def test_shard_places_follow_one_order_by_brute_force(spark, docs, tmp_path):
    """Within a slot's part, places are in order of id, crc and size; slots follow each other in a shard."""
    slot_of = "pmod(xxhash64(doc_id, crc32(text)), 4096) AS v", "pmod(shiftright(xxhash64(doc_id, crc32(text)), 32), 16) AS p"
    order = lambda r: (r.v, r.p, r.doc_id is None, r.doc_id or 0, zlib.crc32((r.text or "").encode()), r.text is not None)
    plain = sorted(docs.selectExpr("doc_id", "text", *slot_of).collect(), key=order)
    found = sharding.shard(docs, str(tmp_path / "map"), keep=["doc_id", "text"]).collect()
    shard_of = sharding.SlotMap.load(spark, str(tmp_path / "map")).shard_of
    at, want = Counter(), []
    for r in plain:
        want.append((r.doc_id, r.text, shard_of[r.v], at[shard_of[r.v]]))
        at[shard_of[r.v]] += 1
    assert sorted(((r.doc_id, r.text, r.shard, r.slot) for r in found), key=repr) == sorted(want, key=repr)


def test_shard_stage_keeps_columns(spark, docs, empty, clashing, tmp_path):
    assert sharding.stage(spark, empty, "").count() == 0
    out = sharding.stage(spark, clashing, "")
    assert {*clashing.columns, "input_size", "input_shard"} - {"size", "shard"} <= set(out.columns)
    assert {(r.place, r.input_size, r.input_shard) for r in out.select("place", "input_size", "input_shard").collect()} == {("x", 1, 0)}
    assert out.count() == docs.count()


def test_balls_bring_slightly_edited_texts_together(spark):
    texts = [words(300, 3)]
    for at in (20, 150, 280):
        texts.append([*texts[0][:at], "other", *texts[0][at + 1 :]])
    prints = [similar.fingerprint(similar.shingle_hashes([w.encode() for w in t])) for t in [*texts, words(300, 4)]]
    plain = [sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hs) > len(hs)) for hs in (similar.shingle_hashes([w.encode() for w in t]).tolist() for t in texts)]
    assert [p % (1 << 64) for p in prints[:4]] == plain
    df = spark.createDataFrame([(i, 296, p) for i, p in enumerate(prints)], "h long, size int, fp long")
    got = {frozenset((r.a, r.b)) for r in similar.ball_pairs(df).collect()}
    near = {frozenset((i, j)) for i in range(5) for j in range(i) if ((prints[i] ^ prints[j]) % (1 << 64)).bit_count() <= 3}
    assert plain_groups(got) == plain_groups(near)


def plain_groups(pairs):
    groups = []
    for pair in pairs:
        joined = [g for g in groups if g & pair]
        groups = [g for g in groups if not g & pair] + [frozenset(pair).union(*joined)]
    return set(groups)


def test_every_colliding_copy_is_found_in_families_that_share_words(spark):
    shared = words(150, 1)
    order = random.Random(3)
    rows, extra = [], []
    for i in range(300):
        text = [*shared, *(f"own{i}x{k}" for k in range(30))]
        copy = list(text)
        at = 150 + i % 20
        copy[at] = "edit"
        rows += [(2 * i, " ".join(text), "en", "s", 0), (2 * i + 1, " ".join(copy), "en", "s", 0)]
    # Equal sets of words: fingerprints and MinHash bits are equal in every block, shingles are not.
    base = words(120, 2)
    for i in range(40):
        moved = order.sample(base, len(base))
        again = [*moved[:60], "more", *moved[60:]]
        extra += [(10_000 + 2 * i, " ".join(moved), "en", "s", 0), (10_001 + 2 * i, " ".join(again), "en", "s", 0)]
    found = similar.stage(spark, spark.createDataFrame(rows + extra, SCHEMA), "")
    assert sorted(r.doc_id for r in found.collect()) == [r[0] for r in rows + extra if r[0] % 2 == 0]


def test_stage_finds_all_similar_pairs_after_contiguous_edits(spark):
    """Insertions, appends and cuts of runs of words down to a similarity of 0.8, beside pairs just below it."""
    rows, want, below = [], [], 0
    for i in range(120):
        base = words(200, i)
        n = 20 + i % 30
        at = random.Random(i).randrange(150)
        edits = [base[:at] + words(n, 7000 + i) + base[at:], base + words(n, 8000 + i), base[n:], base[:at] + base[at + n :]]
        edit = edits[i % 4]
        rows += [(2 * i, " ".join(base), "en", "s", 0), (2 * i + 1, " ".join(edit), "en", "s", 0)]
        alike = similar.similarity(*(similar.shingles([w.encode() for w in t]) for t in (base, edit))) >= 0.8
        below += not alike
        want += [2 * i] if alike else [2 * i, 2 * i + 1]
    assert 10 < below < 110
    found = similar.stage(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert sorted(r.doc_id for r in found.collect()) == want


def test_prefixes_of_similar_texts_meet_after_contiguous_edits():
    none, met = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), 0
    for seed in range(150):
        a = words(200, seed)
        b = a[: 10 + seed] + words(30 + seed % 12, 5000 + seed) + a[10 + seed :]
        x, y = (similar.shingle_hashes([w.encode() for w in t]) for t in (a, b))
        if similar.similarity(frozenset(x.tolist()), frozenset(y.tolist())) >= 0.8:
            met += 1
            assert set(similar.prefix(x, none).tolist()) & set(similar.prefix(y, none).tolist())
    assert met >= 20
