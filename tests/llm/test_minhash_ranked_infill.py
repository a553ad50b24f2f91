"""Operators 11 to 13 against brute force: nulls, empty and long texts, repeated rows, ties, clashing columns, no rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import SCHEMA, rows, words

from tallyport.llm import infill, minhash, ranked


# Operator 11


def shingle_set(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[i : i + 4]) for i in range(max(1, len(found) - 3))} if found else set()


def exact_components(data):
    """(doc_id, n_shingles, component_id, kept) of each row, by all pairs of distinct texts."""
    sets = {t: shingle_set(t) for _, t, *_ in data}
    root = {t: t for t in sets}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    texts = [t for t in sets if sets[t]]
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for doc_id, t, *_ in data:
        if doc_id is not None and sets[t]:
            least[find(t)] = min(doc_id, least.get(find(t), doc_id))
    out = []
    for doc_id, t, *_ in data:
        component = least.get(find(t)) if sets[t] else doc_id
        out.append((doc_id, len(sets[t]), component, doc_id == component))
    return sorted(out, key=repr)


def found_components(df):
    return sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=repr)


def family_rows():
    """Families of copies with own edits, texts that share half their words, and pairs just above and below 0.8."""
    rng = random.Random(5)
    data, number = [], 1000
    for f in range(3):
        origin = words(150, 500 + f)
        for _ in range(25):
            copy = list(origin)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
            data.append((number, " ".join(copy), "en", "s", 0))
            number += 1
    passage = words(60, 900)
    for i in range(40):
        data.append((number, " ".join(words(60, 2000 + i) + passage), "en", "s", 0))
        number += 1
    for cut in range(8, 24):
        base = words(100, 3000 + cut)
        data += [(number, " ".join(base), "en", "s", 0), (number + 1, " ".join(base[: 100 - cut]).upper(), "en", "s", 0)]
        number += 2
    data += [(number, "one two three", "en", "s", 0), (number + 1, "One  Two\tthree", "en", "s", 0), (number + 2, "one two", "en", "s", 0)]
    return data


def test_minhash_equals_all_pairs(spark, docs):
    assert found_components(docs) == exact_components(rows())
    data = family_rows()
    assert found_components(spark.createDataFrame(data, SCHEMA).repartition(4)) == exact_components(data)


def test_minhash_takes_no_rows_and_clashing_columns(empty, clashing, docs):
    assert found_components(empty) == []
    assert found_components(clashing) == found_components(docs)


def test_minhash_takes_an_id_with_two_texts(spark):
    a, b = words(50, 1), words(50, 2)
    data = [(1, " ".join(a), "en", "s", 0), (1, " ".join(b), "en", "s", 0), (2, " ".join([*a[:49], "x"]), "en", "s", 0), (3, " ".join([*b[:49], "y"]), "en", "s", 0), (4, "", "en", "s", 0), (5, None, "en", "s", 0)]
    got = found_components(spark.createDataFrame(data, SCHEMA))
    assert [(i, c, k) for i, _, c, k in got] == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 5, True)]


def test_minhash_only_unlike_texts(spark):
    data = [(i, " ".join(words(30, 4000 + i)), "en", "s", 0) for i in range(5)]
    assert found_components(spark.createDataFrame(data, SCHEMA)) == exact_components(data)


def test_minima_agree_as_often_as_sets_are_alike():
    drawn = minhash.Hashes()
    rng = np.random.default_rng(3)
    agree, apart = [], []
    for _ in range(60):
        common, own = rng.integers(0, 1 << 63, 400, np.uint64), rng.integers(0, 1 << 63, 100, np.uint64)
        a, b = drawn.minima(np.concatenate([common, own[:50]])), drawn.minima(np.concatenate([common, own[50:]]))
        agree.append(float(np.mean(a == b)))
        apart.append(sum((int(x) ^ int(y)).bit_count() if (x >= 0) == (y >= 0) else bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(minhash.signature(a), minhash.signature(b), strict=True)))
    assert abs(np.mean(agree) - 0.8) < 0.02
    assert abs(np.mean(apart) - 25.6) < 2.5
    assert max(apart) <= minhash.MOST_APART


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for n in (3, 40, 300, 3000):
        for _ in range(50):
            union = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1))
            apart = int(0.2 * len(union))
            left = rng.integers(0, apart + 1)
            a, b = union[left:], np.concatenate([union[:left], union[apart:]])
            differ = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(minhash.bitmap(a), minhash.bitmap(b), strict=True))
            assert differ * 9 <= len(a) + len(b)


def test_all_pairs_meets_every_pair_that_sizes_allow(spark):
    """Members of one bucket with sizes around class borders, all with one signature: every pair that sizes allow is met."""
    sizes = [1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 13, 15, 16, 19, 20, 25, 31, 39, 40, 50, 100, 124, 125, 126, 156, 157]
    # In bands 2 and 4 all meet; in band 0 the first two only.
    members = spark.createDataFrame([(7 + band, band, i, i) for band in (2, 4) for i in range(len(sizes))] + [(7, 0, i, i) for i in range(2)], "key long, band int, h long, root long")
    texts = spark.createDataFrame([(i, n, [0, 0, 0, 0], [0] * 16, [i // 2, 100 + i, 5, 200 + i, 5]) for i, n in enumerate(sizes)], "h long, size long, sig array<long>, bits array<long>, lanes array<int>")
    found = [(r.a, r.b) for r in minhash.all_pairs(members, texts).collect()]
    # No pair comes twice; neighbours whose lanes say that they meet in band 0 do so there, or not at all.
    assert len(found) == len(set(found))
    got = set(found) | {(i, i + 1) for i in range(2, len(sizes) - 1, 2) if sizes[i] * 5 >= sizes[i + 1] * 4}
    assert got == {(i, j) for j in range(len(sizes)) for i in range(j) if sizes[i] * 5 >= sizes[j] * 4}


# Operator 12


def term_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def exact_ranking(data, items, k=50):
    found = [(doc_id, Counter(term_list(text))) for doc_id, text, *_ in data]
    found = [(i, c) for i, c in found if c]
    documents, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, counts in found:
            n = sum(counts.values())
            m = 50 + 50 * n * documents // total
            score = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (1000000000 * counts[t] // (1000 * counts[t] + 20 * m)) for t in set(term_list(text)) if t in counts)
            if score > 0:
                scored.append((score, doc_id))
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1]))
        out += [(item_id, rank, doc_id, score) for rank, (score, doc_id) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "Which CHANGED word, and the Naïve café?"), (2, "the of and to in"), (3, ""), (4, None), (5, "hi!"), (5, "Hi"), (None, "no id"), (6, "absent-term xyzzyq"), (7, "the the the id 12 kg ☃")]


def ranking(docs, items, k=50):
    return sorted((tuple(r) for r in ranked.search(docs, items, k).collect()), key=repr)


def test_search_equals_brute_force(spark, docs, clashing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranking(docs, items) == exact_ranking(rows(), ITEMS)
    assert ranking(clashing, items.selectExpr("*", "1 AS rank", "2 AS score"), 3) == exact_ranking(rows(), ITEMS, 3)


def test_search_without_documents_or_items(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranking(empty, items) == []
    assert ranking(docs, items.where("false")) == []
    assert ranking(docs, items.where("item_id = 3")) == []


def test_search_of_many_ties_takes_the_smallest_ids(spark):
    data = [(i, "same words here", "en", "s", 0) for i in range(300)] + [(1000 + i, "other words", "en", "s", 0) for i in range(100)]
    random.Random(1).shuffle(data)
    items = [(1, "same"), (2, "words"), (3, "same other")]
    assert ranking(spark.createDataFrame(data, SCHEMA).repartition(5), spark.createDataFrame(items, "item_id long, text string")) == exact_ranking(data, items)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 7), min_size=1, max_size=12), min_size=1, max_size=40), st.lists(st.integers(0, 7), min_size=1, max_size=5, unique=True), st.integers(1, 6), st.integers(1, 3))
def test_threshold_algorithm_in_segments(texts, query, k, pieces):
    weights = np.array([900, 700, 500, 300, 200, 100, 50, 0], np.int64)
    total = sum(map(len, texts))
    counted = [Counter(t) for t in texts]
    scores = [sum(int(weights[t]) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * (50 + 50 * len(x) * len(texts) // total))) for t in query if t in c) for x, c in zip(texts, counted, strict=True)]
    want = sorted(((-s, i) for i, s in enumerate(scores) if s > 0))[:k]
    top = []
    step = -(-len(texts) // pieces)
    for at in range(0, len(texts), step):
        part = range(at, min(at + step, len(texts)))
        entries = [(t, n) for i in part for t, n in counted[i].items()]
        segment = ranked.Segment(
            list(part), np.array([len(texts[i]) for i in part]), np.array([len(counted[i]) for i in part]), np.array([t for t, _ in entries]), np.array([n for _, n in entries]), weights, len(texts), total
        )
        segment.search(np.array(query), top, k)
    assert sorted((-s, i) for s, _, i in top) == want


def test_threshold_search_stops_early():
    """A list with one rare term: only the first documents are looked up."""
    n = 10_000
    rng = np.random.default_rng(1)
    lengths = rng.integers(10, 2000, n)
    segment = ranked.Segment(list(range(n)), lengths, np.ones(n, int), np.zeros(n, int), np.ones(n, int), np.array([500]), n, int(lengths.sum()))
    asked = []
    whole = segment.scores
    segment.scores = lambda docs: (asked.append(len(docs)), whole(docs))[1]
    top = []
    segment.search(np.array([0]), top, 10)
    assert len(top) == 10
    assert sum(asked) < n / 50


# Operator 13

LINES = re.compile(r"[^\n]*\n|[^\n]+")


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(["a", "é", "☃", "\U0001f600", "\n", "\r", " "]), max_size=80), st.integers(1, 5), st.sampled_from([infill.LINE, infill.CHARACTER]), st.sampled_from([3, 7, 1 << 20]))
def test_checkpoints_find_every_cut(text, every, unit, block):
    before, infill.BLOCK = infill.BLOCK, block
    try:
        points = infill.Checkpoints(text.encode(), unit, every)
        units = LINES.findall(text) if unit == infill.LINE else list(text)
        assert points.n == len(units)
        assert len(points.units) == len(units) // every + 1 or (unit == infill.LINE and not text.endswith("\n"))
        for cut in range(len(units) + 1):
            head = "".join(units[:cut])
            assert points.cut(cut) == (len(head.encode()), len(head))
    finally:
        infill.BLOCK = before


def exact_infill(doc_id, text):
    text = text or ""
    units = LINES.findall(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        form, output, sizes = "plain", text, (None, None)
    else:
        form = "spm" if h[3] % 100 < 50 else "psm"
        output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
        sizes = len(prefix), len(middle)
    return (doc_id, len(units), form, *sizes, output, text)


def infill_rows():
    out = [(i, t) for i, t, *_ in rows()]
    out += [(100 + i, "\n".join(" ".join(words(4, 60 + j)) + "é☃"[j % 2] for j in range(i)) + "\n" * (i % 3)) for i in range(40)]
    out += [(200, "a <P> b\nc"), (201, "ends <\n<S"), (202, "x<"), (203, "\n\n\n"), (204, "\r\n\r\n"), (205, "line\n" * 5000), (-7, "neg\native")]
    return [(i, t, "en", "s", 0) for i, t in out]


def test_infill_equals_brute_force(spark):
    data = infill_rows()
    made = infill.rearranged(spark.createDataFrame(data, SCHEMA).repartition(3).selectExpr("*", "1 AS n", "'x' AS form", "2 AS `row`", "3 AS `d`"))
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars", "n", "form", "row", "d", "fim"]
    back = infill.restored(F.col("fim.output"), F.col("fim.form"))
    got = made.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", "fim.output", back.alias("back")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((exact_infill(i, t) for i, t, *_ in data), key=repr)


def test_infill_rates_and_other_markers(spark, empty):
    data = spark.createDataFrame(infill_rows(), SCHEMA)
    marks = infill.Markers("<|p.|>", "<|s|>", "<|m|>")
    made = infill.rearranged(data, infill.Options(rate=60, spm=0, unit=infill.CHARACTER, every=5, markers=marks), out="text_fim")
    got = made.select("text", "text_fim.*", infill.restored(F.col("text_fim.output"), F.col("text_fim.form"), marks).alias("back")).collect()
    assert {r.form for r in got} == {"plain", "psm"}
    assert 0.3 < sum(r.form == "psm" for r in got) / len(got) < 0.75
    assert all(r.back == (r.text or "") and r.n == len(r.text or "") for r in got)
    assert infill.rearranged(empty).count() == 0


@pytest.mark.parametrize("name", ["op11_minhash_near_dedup", "op12_ranked_search", "op13_fill_in_middle"])
def test_queries_read_the_tables(spark, tmp_path, docs, name):
    from tallyport.llm import queries

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = queries.queries()[name](spark, str(tmp_path))
    want = {"op11_minhash_near_dedup": exact_components(rows()), "op12_ranked_search": exact_ranking(rows(), ITEMS)}.get(name)
    if want is not None:
        assert sorted(map(tuple, got.collect()), key=repr) == want
    else:
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        whole = [exact_infill(i, t) for i, t, *_ in rows()]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(((*r[:5], sha(r[5]), sha(r[6])) for r in whole), key=repr)
