import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from samples import SCHEMA, rows, sorted_rows, words

from tallyport.llm import decontaminate, fingerprints, katz, licenses, pii, tokens, toxicity

# 1 fingerprints


def shingle_set(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_fingerprints_equal_brute_force(docs):
    got = defaultdict(list)
    for r in fingerprints.neighbours(docs).collect():
        got[r.doc_id].append(r)
    known = sorted({(i, t or "") for i, t, *_ in rows() if i is not None}, reverse=True)
    order = [*known, (None, "no id at all here")]
    for at, (i, text) in enumerate(order):
        after = order[(at + 1) % len(order)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        for r in got[i]:
            assert r.n_chars == len(text)
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            a, b = shingle_set(text), shingle_set(edited)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(r.near_edited - true) < (0.2 if len(a | b) > 128 else 1e-12)
            c = shingle_set(after)
            assert abs(r.near_next - (len(a & c) / len(a | c) if a | c else 1.0)) < (0.2 if len(a | c) > 128 else 1e-12)
            assert r.n_shingles == pytest.approx(len(a), rel=0.3 if len(a) >= 128 else 1e-12)
            assert r.kept_share == (pytest.approx(len(a & b) / len(a), abs=0.3 if len(a | b) >= 128 else 1e-9) if a else None)
    assert sum(map(len, got.values())) == len(rows())
    by_text = defaultdict(set)
    for i, t, *_ in rows():
        by_text[t or ""].update(r.fingerprint for r in got[i] if r.n_chars == len(t or ""))
    assert all(len(v) == 1 for k, v in by_text.items() if len(k) > 60)


def test_fingerprints_take_the_smallest_long_and_repeats(spark):
    least = -(1 << 63)
    data = [(least, "a b c d e f", "en", "s", 11), (0, "g h", "en", "s", 3), (least, "a b c d e f", "en", "s", 11), ((1 << 63) - 1, "i", "en", "s", 1)]
    got = sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprints.neighbours(spark.createDataFrame(data, SCHEMA)).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted([(least, 11, sha("a b c d i"))] * 2 + [(0, 3, sha("g a")), ((1 << 63) - 1, 1, sha("i"))])


def test_sketches_merge(spark):
    w = words(900, 3)
    whole, left, right = " ".join(w), " ".join(w[:500]), " ".join(w[496:])
    df = spark.createDataFrame([(whole, left, right)], "w string, l string, r string")
    row = df.select(fingerprints.sketch(F.col("w")).alias("w"), fingerprints.merged(fingerprints.sketch(F.col("l")), fingerprints.sketch(F.col("r"))).alias("m")).first()
    assert row.w == row.m
    parts = spark.createDataFrame([("k", left), ("k", right)], "k string, t string").select("k", fingerprints.sketch(F.col("t")).alias("s"))
    assert fingerprints.merge_all(parts, ["k"], "s").first().s == row.w


def test_fingerprints_of_no_rows_and_clashes(empty, clashing, docs):
    assert fingerprints.neighbours(empty).count() == 0
    assert sorted_rows(fingerprints.neighbours(clashing).select("doc_id", "edited_sha256")) == sorted_rows(fingerprints.neighbours(docs).select("doc_id", "edited_sha256"))


# 2 decontamination

ITEM = "If Alice has 3 apples and Bob gives Alice 4 more kg of fruit then how many apples does Alice hold after 3 days"


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, "one two three four five"), (3, None), (4, "too short"), (1, ITEM)], "item_id long, text string")


def test_decontamination_cases(spark, benchmark):
    cases = [
        (0, "Start. " + ITEM + " and more.", [(1, "verbatim")]),
        (1, "x " + ITEM.replace("Alice", "Carol").replace("Bob", "Dan").replace("3", "7").replace("4", "9"), [(1, "reparameterised")]),
        (2, ITEM.replace("Alice has", "Carol has").replace("gives Alice", "gives Erin").replace("does Alice", "does Frank").replace("after 3", "after 8"), []),
        (3, ITEM.upper(), [(1, "verbatim")]),
        (4, "zero one two three four five six", [(2, "verbatim")]),
        (5, " ".join(words(500, 1)), []),
        (6, "1 2 3 4 5 6 7 8 9 10 11 12", []),
        (7, None, []),
        (8, "", []),
    ]
    docs = spark.createDataFrame([(i, t) for i, t, _ in cases], "doc_id long, text string")
    got = defaultdict(list)
    for r in decontaminate.find(docs, benchmark).collect():
        got[r.doc_id].append((r.item_id, r.kind))
    assert dict(got) == {i: w for i, _, w in cases if w}
    for of in decontaminate.finders(benchmark):
        docs = docs.where(F.size(of(F.col("text"))) == 0)
    assert sorted(r.doc_id for r in docs.collect()) == [i for i, _, w in cases if not w]


def test_decontamination_blocks_and_empty(docs, empty, benchmark, monkeypatch):
    assert decontaminate.find(empty, benchmark).count() == 0
    assert decontaminate.find(docs, benchmark.limit(0)).count() == 0
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 1)
    assert len(decontaminate.finders(benchmark)) == 3


def plain_readings(text):
    """Of each reading (plain, names inside sentences, names everywhere): (token, slot kind or lower-cased word) pairs."""
    out = ([], [], [])
    before = "stop"
    raw = re.findall(r"[.!?\n]+|[^\W\d_]+|\d+(?:[.,:/]\d+)*|[%$€£°]", text or "")
    runs = [False, False, False]
    for t in raw:
        if t[0] in ".!?\n":
            before, runs = "stop", [False, False, False]
            continue
        number, unit = t[0].isdigit(), t.lower() in decontaminate.UNITS
        capital = not number and not unit and t[0].isupper() and not t[1:].isupper()
        for way in range(3):
            name = capital and way and (way == 2 or before != "stop")
            if name and runs[way]:
                out[way][-1] = (out[way][-1][0] + " " + t, "<name>")
                continue
            runs[way] = bool(name)
            slot = "<name>" if name else "<number>" if way and number else "<unit>" if way and unit and before == "number" else None
            out[way].append((t, slot or t.lower()))
        before = "number" if number else "other"
    return out


def plain_hits(text, items):
    """(item, kind) of the items that a text holds, by windows compared one by one."""
    docs, best = plain_readings(text), {}
    for item, body in items:
        own = plain_readings(body)
        if len(own[0]) < 5:
            continue
        for way in range(3):
            mine, theirs = own[way], docs[way]
            size = min(8, len(mine))
            slot = lambda x: x[1].startswith("<")
            used = [p for p in range(len(mine) - size + 1) if not way or sum(not slot(x) for x in mine[p : p + size]) >= size / 2]
            shifts = defaultdict(list)
            for p in used:
                for at in range(len(theirs) - size + 1):
                    if [x[1] for x in mine[p : p + size]] == [x[1] for x in theirs[at : at + size]]:
                        shifts[at - p].append(p)
            covered, changed = set(), 0
            for shift, places in shifts.items():
                values = defaultdict(set)
                for p in sorted({p + k for p in places for k in range(size) if way and slot(mine[p + k])}):
                    a, b = mine[p][0].split(" "), theirs[p + shift][0].split(" ")
                    while len(a) > 1 and len(b) > 1 and a[0] == b[0]:
                        a, b = a[1:], b[1:]
                    values[" ".join(a)].add(" ".join(b))
                if any(len(v) > 1 for v in values.values()):
                    places = [p for p in places if all(mine[p + k][0] == theirs[p + k + shift][0] for k in range(size) if slot(mine[p + k]))]
                else:
                    changed += sum(k not in v for k, v in values.items()) if places else 0
                covered |= set(places)
            share = len(covered) / max(1, len(used))
            if covered and share >= 0.4 and share > best.get(item, (0, ""))[0]:
                best[item] = (share, "reparameterised" if changed else "template" if way else "verbatim")
    return sorted((item, kind) for item, (_, kind) in best.items())


def test_decontamination_equals_brute_force(spark):
    """Items in documents whole, in part, in capitals, with changed names, numbers and units, alike or not."""
    rng = random.Random(6)
    items = [
        (1, ITEM), (2, "one two three four five"), (3, "Ben sold 20 pens on Monday. Carl sold 15 more than Ben did. Dana sold 7 less than Carl. How many did Dana sell?"),
        (4, "A tank holds 300 liters and loses 5 liters a day while Rosa adds 12 kg of salt each week so when is it empty"), (5, "which of these is not a prime number and why is that so"),
    ]
    data = []
    for i in range(150):
        _, body = items[i % 5]
        w = body.split(" ")
        for _ in range(rng.choice([0, 0, 1, 3])):
            at = rng.randrange(len(w))
            w[at] = str(rng.randint(1, 99)) if w[at].isdigit() else rng.choice(["Zoe", "Yann", "Bob"]) if w[at][:1].isupper() else rng.choice([w[at], "other", "km"])
        if i % 4 == 1:
            w = [{"Alice": "Mia", "Ben": "Ann Lee", "Carl": "Otto", "Rosa": "Kim", "3": "8", "20": "31"}.get(x, x) for x in w]
        if i % 7 == 2:
            w = w[: rng.randint(4, len(w))]
        if i % 11 == 3:
            w = [x.upper() for x in w]
        data.append((i, " ".join([*words(rng.randint(0, 30), i), *w, *words(rng.randint(0, 30), i + 500)])))
    data += [(1000, None), (1001, ""), (7, data[7][1]), (1002, " ".join(words(20_000, 3)) + " " + ITEM)]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("h", F.lit(1)).withColumn("hit", F.lit("x"))
    got = sorted((r.doc_id, r.item_id, r.kind) for r in decontaminate.find(docs, spark.createDataFrame(items, "item_id long, text string")).collect())
    want = sorted((i, item, kind) for i, t in data for item, kind in plain_hits(t, items))
    assert len(want) > 90
    assert got == want


# 3 toxicity


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(1)
    data, labels = [], []
    for i in range(400):
        w, bad = words(80, 1000 + i), i % 4 == 0
        if bad:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(["grumblefex", "grumbleton", "zorkhead"]) + rng.choice(["", "s", "ly"])
        data.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([*data, (1000, None), (1001, ""), (None, "x")], "doc_id long, text string")
    found = toxicity.score(docs, spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")).collect()
    held = [r for r in found if r.held_out and r.doc_id < 400]
    assert {r.doc_id for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
    assert len(found) == 403


def test_toxicity_without_labels(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(empty, none).count() == 0


def test_toxicity_takes_repeats_long_texts_and_clashes(spark, clashing):
    data = [(i, f"{' '.join(words(30, i))} {'zorkhead grumblefex' if i % 2 else 'gentle kindness'}") for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    long_text = " ".join(words(60_000, 7))
    docs = spark.createDataFrame([*data, data[3], (500, long_text), (501, long_text + " zorkhead grumblefex")], "doc_id long, text string")
    found = toxicity.score(docs, labels).collect()
    assert len(found) == 83
    assert len({r.score for r in found if r.doc_id == 3}) == 1
    of = {r.doc_id: r.score for r in found}
    assert of[501] > of[500]
    assert toxicity.score(clashing, labels).count() == len(rows())
    model = toxicity.train(docs, labels)
    for w in ("zorkhead", "gentle", "the"):
        # A word's ratio is the sum of the logs of its letters' probabilities under both models.
        levels_ratio = toxicity.word_ratio(w, model.seen, model.unseen)
        assert toxicity.evidence([w], {w: levels_ratio}) == pytest.approx((levels_ratio / (len(w) + 1),) * 4)


def test_class_models_equal_plain_kneser_ney():
    by_class = (Counter({"gentle": 3, "general": 1}), Counter({"genius": 2, "gentle": 1}))
    levels = toxicity.Levels(by_class)
    seen, unseen = toxicity.fit(by_class)

    def p(c, h, x):
        own = levels.own[c]
        total = sum(n for g, n in own.items() if g[:-1] == h)
        kinds = sum(g[:-1] == h for g in own)
        below = levels.lower(h[1:], x)
        return (max(own.get(h + x, 0) - toxicity.DISCOUNT, 0) + toxicity.DISCOUNT * kinds * below) / total if total else below

    for word in ("gentle", "genus", "xylem"):
        w = toxicity.START + word + toxicity.END
        want = sum(math.log(p(1, w[max(0, i - toxicity.ORDER + 1) : i], w[i]) / p(0, w[max(0, i - toxicity.ORDER + 1) : i], w[i])) for i in range(1, len(w)))
        assert toxicity.word_ratio(word, seen, unseen) == pytest.approx(want)


def test_kneser_ney_probabilities_sum_to_one():
    levels = toxicity.Levels((Counter({"abc": 3, "abd": 1}), Counter({"abd": 2, "xyz": 1})))
    symbols = {g[-1] for own in levels.own for g in own}
    for h in ("", "a", "ab", "\x02"):
        assert abs(sum(levels.lower(h, x) for x in symbols) + levels.lower(h, "?") - 1) < 1e-9


# 5 licenses


def contained(text):
    """(license, share) of the templates that a text holds, by plain sets of token tuples."""
    def parts(x, n):
        w = [t.lower() for t in re.findall(r"[^\W\d_]+|\d+(?:[.,:/]\d+)*|[%$€£°]", x)]
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    out = set()
    for name, template in licenses.TEMPLATES:
        n = next(n for n in (5, 4, 3, 2, 1) if parts(template, n))
        own = parts(template, n)
        if len(own & parts(text or "", n)) >= 0.8 * len(own):
            out.add(name)
    return out


def test_licenses_equal_containment(spark, clashing, docs):
    rng = random.Random(2)
    data = []
    for i in range(150):
        w = words(rng.randint(0, 300), i)
        name, text = licenses.TEMPLATES[i % len(licenses.TEMPLATES)]
        body = text.split()
        if i % 3 == 1:
            body[len(body) // 2] = "altered"
        data.append((i, " ".join([*w[: len(w) // 2], *(body if i % 4 else []), *w[len(w) // 2 :]])))
    data += [(100_000, None), (100_001, ""), (100_002, " ".join(words(40_000, 1)) + " " + licenses.TEMPLATES[3][1]), (3, data[3][1])]
    docs_ = spark.createDataFrame(data, "doc_id long, text string")
    want = sorted((i, n) for i, t in data for n in contained(t))
    assert sorted((r.doc_id, r.license) for r in licenses.scan(docs_).collect()) == want
    assert licenses.scan(docs_.limit(0)).count() == 0
    assert licenses.scan(docs_, []).count() == 0
    assert licenses.scan(clashing).count() == licenses.scan(docs).count()
    with pytest.raises(ValueError):
        licenses.Library([("x", " .")])


def test_licenses_are_found_when_words_are_inserted():
    """Runs of up to 200 words within a notice, beside replaced words: all that still hold enough are found."""
    library, coder, rng = licenses.Library(licenses.TEMPLATES), licenses.Coder(), random.Random(8)
    wanted = missed = 0
    for k in (0, 1, 2, 5, 10, 20, 40, 200):
        for trial in range(60):
            _, text = licenses.TEMPLATES[trial % 22]
            body = text.split()
            for _ in range(rng.randint(0, max(0, len(body) // 40))):
                body[rng.randrange(len(body))] = "altered"
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(body) + 1)
                body[at:at] = words(k, rng.randrange(10**6))
            full = " ".join([*words(50, trial), *body, *words(50, trial + 99)])
            want = contained(full)
            got = {h["license"] for h in library.hits(coder, full)}
            assert got <= want
            wanted, missed = wanted + len(want), missed + len(want - got)
    assert wanted > 250
    assert missed <= 0.01 * wanted
    for size in range(1, licenses.TILE + 1):
        assert (1 - licenses.least_resemblance(size)) ** licenses.bands_for(size) <= licenses.MISS
    assert licenses.SHINGLE - 1 > (1 - licenses.CONTAINMENT) * licenses.TILE


# 6 personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


PII_TEXTS = [
    None, "", "plain", "é☃ a.b@c.de_x@y.zz, q@w", "a@b.c@d.e f@g..h", "1.2.3.4.5 300.1.1.1 0255.0.0.1 12.34.56.78", "4539 1488 0343 6467 4539-1488-0343-6467 1234567890123", "+1 (663) 555-6869 +12 +1.2.3.4.5.6.7.8.9 ++44 20 7946 0958.",
    "x@" + "a." * 5000 + "b", "a" * 30000, "1" * 30000, "1 " * 3000 + "+" * 2000, "4465758382889437 4465758382889437", "tab\t+1-2-3-4-5-6-7-8-9\n+9",
]


def test_base_spans_equal_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs, pii.Detector()).collect()}
    for i, text in enumerate(PII_TEXTS):
        spans = {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if passes(k, m[0])] for k, p in PATTERNS.items()}
        joined = ",".join(f"{k}:{a}:{b}" for k in PATTERNS for a, b in spans[k])
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(spans[k]) for k in PATTERNS), i
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.spans == joined


def pii_texts(n, hidden):
    """Texts with plain personal data, in every fourth also in a form that no base pattern takes, beside numbers of other sorts."""
    rng = random.Random(4)
    digits = lambda k: "".join(rng.choice("123456789") for _ in range(k))
    out = []
    for i in range(n):
        mail, phone, ip = f"{words(1, i)[0]}{i}@mail.example.com", f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", ".".join(str(rng.randint(1, 254)) for _ in range(4))
        text = f"{' '.join(words(8, i))} {mail} or call {phone} today, host {ip} is up. Pages {rng.randint(1, 9)}-{rng.randint(10, 99)}, years 19{digits(2)}-20{digits(2)}, version {rng.randint(1, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)}, total {digits(3)}.{digits(2)}"
        if hidden and i % 4 == 0:
            text += f" write {words(1, i + 5)[0]} [at] host [dot] org or call ({digits(3)}) {digits(3)}-{digits(4)} now"
        out.append((i, text))
    return out


def test_pii_learns_forms_that_base_patterns_do_not_take(spark, empty):
    docs = spark.createDataFrame(pii_texts(600, False), "doc_id long, text string")
    detector = pii.train(docs)
    assert {"email", "phone"} <= set(detector.thresholds)
    for kind in ("email", "phone"):
        precision, recall, positives = detector.measured[kind]
        assert positives > 20
        assert precision >= 0.9
        assert recall >= 0.8
    # Frequent hidden spans are added, whatever their share of the corpus, and base spans stay as they are.
    hidden = pii_texts(600, True)
    found = spark.createDataFrame(hidden, "doc_id long, text string")
    again = pii.train(found)
    rows = {r.doc_id: r for r in pii.find(found, again).collect()}
    assert sum(rows[i].n_added >= 1 for i in range(0, 600, 4)) >= 0.8 * 150
    assert sum(rows[i].n_added for i in range(600) if i % 4) <= 0.03 * 450
    for i, text in hidden:
        for kind, pattern in PATTERNS.items():
            assert rows[i][f"n_{kind}"] == sum(passes(kind, m[0]) for m in re.finditer(pattern, text))
    assert pii.find(empty).count() == 0
    assert pii.redact(found, pii.Detector()).where("doc_id = 1").first().text.count("[phone]") == 1


def test_pii_rewrites_keep_places(spark):
    texts = [(i, t) for i, t in enumerate(["a.b@c.de and +1 (663) 555-6869, 1.2.3.4", "", "none", "4539 1488 0343 6467 x@y.zz"])]
    df = spark.createDataFrame(texts, "doc_id long, text string").select("doc_id", "text", pii.rewritten(F.col("text")).alias("r"))
    for r in df.collect():
        assert len(r.r.spans) == sum(passes(k, m[0]) for k, p in PATTERNS.items() for m in re.finditer(p, r.text))
        for s in r.r.spans:
            assert not any(passes(k, m[0]) and m[0] == r.r.text[s.start : s.end] for k, p in PATTERNS.items() for m in re.finditer(p, r.r.text))


def test_pii_ties_at_the_threshold_go_together():
    assert pii._threshold(np.array([0.9] * 12 + [0.5] * 10), np.array([1.0] * 12 + [1.0] * 5 + [0.0] * 5)) == pytest.approx(0.7)
    assert pii._threshold(np.array([0.9] * 20), np.array([1.0] * 19 + [0.0])) is None


#: Forms and contexts that training does not have.
HIDDEN = (
    ("email", "write to bob [at] example [dot] org today", "bob [at] example [dot] org"), ("email", "anna(at)mail.com", "anna(at)mail.com"), ("email", "jane (at) firm (dot) com wrote", "jane (at) firm (dot) com"), ("email", "so bob @ example.com", "bob @ example.com"),
    ("ip", "the box 10[.]0[.]0[.]12 is down", "10[.]0[.]0[.]12"), ("ip", "192(.)168(.)1(.)5", "192(.)168(.)1(.)5"), ("card", "paid by 4111.1111.1111.1111 then", "4111.1111.1111.1111"), ("card", "4111/1111/1111/1111", "4111/1111/1111/1111"), ("phone", "please call 1 (743) 555-3824 now", "1 (743) 555-3824"),
)
CLEAN = (
    "we meet [at] noon. Then we go", "lunch @ 12.30 for all", "version 3.2.1 of 2024-01-15", "order 12-345-678", "total 1,234,567,890 kr", "see 4111111111111112 there", "see 4111.1111.1111.1112 there", "pages 10-20", "section 4.10.22", "1990-1995", "on 15.01.2024", "scores 10,20,30,40",
    "build 11.301.17.2", "the sum 12 345 678", "",
)


@pytest.mark.parametrize("source", ["few", "own"])
def test_pii_adds_unseen_forms_and_leaves_clean_text(spark, docs, source):
    """Trained on documents with no personal data of their own, and on ones with some."""
    detector = pii.train(docs if source == "few" else spark.createDataFrame(pii_texts(300, False), "doc_id long, text string"))
    assert set(detector.thresholds) == set(pii.KINDS)
    texts = [t for _, t, _ in HIDDEN] + list(CLEAN)
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), detector).collect()}
    found = [f"{kind}:{text.index(span)}:{text.index(span) + len(span)}" in got[i].spans.split(",") for i, (kind, text, span) in enumerate(HIDDEN)]
    # With few documents a form or two may be missed; clean text is left alone all the same.
    assert sum(found) >= len(found) - (2 if source == "few" else 1)
    assert sum(got[len(HIDDEN) + i].n_added > 0 for i in range(len(CLEAN))) <= 1


def test_pii_takes_clashing_columns_and_repeats(spark, docs, clashing):
    detector = pii.Detector()
    assert sorted_rows(pii.find(clashing, detector)) == sorted_rows(pii.find(docs, detector))
    assert pii.find(docs, detector).count() == len(rows())


# 7 language model


class PlainKatz:
    """The same model by dictionaries over words."""

    def __init__(self, texts):
        self.count, self.pairs, self.triples = Counter(), Counter(), Counter()
        for w in texts:
            self.count.update(w)
            self.pairs.update(zip([b"<s>", *w], w, strict=False))
            self.triples.update(zip([b"<s>", b"<s>", *w], [b"<s>", *w], w, strict=False))
        self.n, self.v = sum(self.count.values()), len(self.count)
        per = lambda c: np.array([sum(x == r for x in c.values()) for r in range(1, katz.KATZ_K + 2)])
        self.d1, self.d2, self.d3 = (katz.discounts(per(c)) for c in (self.count, self.pairs, self.triples))
        self.freed = 1 - sum(self.d(self.d1, c) * c for c in self.count.values()) / self.n
        self.unknown = max(self.freed, 0.5 / (self.n + 0.5 * (self.v + 1)))
        self.after2, self.after3 = defaultdict(list), defaultdict(list)
        for (h, w), c in self.pairs.items():
            self.after2[h].append((w, c))
        for (g, h, w), c in self.triples.items():
            self.after3[g, h].append((w, c))

    @staticmethod
    def d(table, c):
        return table[min(c, katz.KATZ_K + 1)]

    def p1(self, w):
        c = self.count[w]
        return self.d(self.d1, c) * c / self.n * (1 - self.unknown) / (1 - self.freed) if c else self.unknown

    def level(self, after, table, w, lower):
        total = sum(c for _, c in after)
        if not total:
            return lower(w)
        mass = sum(self.d(table, c) * c for _, c in after) / total
        scale = total / (total + 1) if 1 - mass < 1e-9 else 1
        c = dict(after).get(w, 0)
        if c:
            return self.d(table, c) * c / total * scale
        return (1 - mass * scale) / (1 - sum(lower(x) for x, _ in after)) * lower(w)

    def p2(self, h, w):
        return self.level(self.after2[h], self.d2, w, self.p1)

    def p3(self, g, h, w):
        return self.level(self.after3[g, h], self.d3, w, lambda x: self.p2(h, x))


def plain_katz(data):
    """Expected rows of (id, words with the end, held out)."""
    model = PlainKatz([w for _, w, h in data if not h])
    out = []
    for i, w, h in data:
        base = sum(math.log10((model.count[x] + 0.5) / (model.n + 0.5 * (model.v + 1))) for x in w)
        total = sum(math.log10(model.p3(*x)) for x in zip([b"<s>", b"<s>", *w], [b"<s>", *w], w, strict=False))
        out.append((i, h, len(w), sum(model.count[x] > 0 for x in w), model.n, base, total))
    return model, out


def katz_words(text):
    return [*"".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split(), b"</s>"]


@pytest.mark.parametrize("spread", ["none", "all", "some"])
def test_katz_equals_brute_force_and_scores_from_its_tables(spark, tmp_path, monkeypatch, spread):
    """Whatever is spread over buckets or sent as a code, the scores are those of dictionaries; and so are those that the
    stored tables give by themselves."""
    monkeypatch.setattr(katz, "SPREAD", {"none": 1e9, "all": 0.0, "some": 1 / 16}[spread])
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(katz, "COMMON", {"none": 0, "all": 10**6, "some": 20}[spread])
    text = [w for w in words(2500, 5)]
    data = [(i, t) for i, t, *_ in rows() if i != 65] + [(100 + i, " ".join(text[20 * i : 20 * i + 60])) for i in range(110)] + [(300 + i, "the of the and to the of in the") for i in range(30)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    model, want = plain_katz([(i, katz_words(t), i is not None and zlib.crc32(str(i).encode()) % 5 == 1) for i, t in data])
    assert model.d3[1] < 1
    path = str(tmp_path / "m")
    got = sorted_rows(katz.score(docs, path=path))
    for a, b in zip(got, sorted(want, key=repr), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:])
    stored = {k: Counter(r["count"] for r in t.collect()) for k, t in katz.tables(spark, path).items() if "of_" not in k}
    assert stored == {"words": Counter(model.count.values()), "bigrams": Counter(model.pairs.values()), "trigrams": Counter(model.triples.values())}
    fresh = spark.createDataFrame([*((i, t) for i, t in data if i is not None and i < 60 and i % 10 != 7), (900, "never seen words of the kind the of")], "doc_id long, text string")
    by_id = {r.doc_id: r.score for r in katz.evaluate(spark, path, fresh).collect()}
    for i, _, _, _, _, _, total in want:
        if i in by_id:
            assert by_id[i] == pytest.approx(total, rel=1e-5)
    w = katz_words("never seen words of the kind the of")
    assert by_id[900] == pytest.approx(sum(math.log10(model.p3(*x)) for x in zip([b"<s>", b"<s>", *w], [b"<s>", *w], w, strict=False)), rel=1e-5)


def test_katz_is_normalised():
    model = PlainKatz([katz_words(" ".join(words(300, i))) for i in range(5)])
    for g, h in ((b"<s>", b"<s>"), (b"of", b"the"), (b"the", b"of"), (b"nothing", b"like it")):
        assert sum(model.p3(g, h, w) for w in model.count) + model.p3(g, h, b"?") == pytest.approx(1)


def test_katz_without_rows_or_training(docs, empty):
    assert katz.score(empty).count() == 0
    found = katz.score(docs, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.score) for r in found} == {(0, 0, 0.0)}


def test_frozen_arrays_come_back():
    a, b = np.array([0, 1, (1 << 48) - 1], np.uint64), np.array([1.5, -2.25])
    for x, y in zip(katz.thaw(katz.freeze(a, b, np.zeros(0, np.uint64))), (a, b, np.zeros(0)), strict=True):
        assert x.tolist() == y.tolist()


# 9 token segments


def test_elias_fano_selects():
    rng = random.Random(4)
    for spread in (0, 1, 7, 1000, 1 << 40):
        values = np.cumsum(np.array([rng.randint(0, spread) for _ in range(1500)], np.int64)) - 50
        read, at = tokens.EliasFano.read(memoryview(tokens.EliasFano.of(values).to_bytes()), 0)
        assert read.all().tolist() == values.tolist()
        assert [read.select(i) for i in (0, 1, 255, 256, 257, 1499)] == values[[0, 1, 255, 256, 257, 1499]].tolist()
    assert len(tokens.EliasFano.of(np.arange(0, 64_000, 64)).to_bytes()) < 1000 * 9 / 8 + 100
    assert tokens.EliasFano.of(np.zeros(0, np.int64)).all().tolist() == []


def test_segments_round_trip(spark, docs, empty, tmp_path, monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    tokens.write(docs, str(tmp_path / "t"), path)
    plain = Tokenizer.from_file(path)
    order = sorted(((i is None, i or 0, t or "") for i, t, *_ in rows()))
    want, start = [], 0
    for none, i, t in order:
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want.append((None if none else i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted_rows(tokens.read(spark, str(tmp_path / "t"))) == sorted(want, key=repr)
    tokens.write(empty, str(tmp_path / "e"), path)
    assert tokens.read(spark, str(tmp_path / "e")).count() == 0


def test_segments_give_documents_by_select(spark, tmp_path):
    """Rows without an id spread over ranges; documents read one by one from a segment; a vocabulary that does not split at
    blanks is used on whole texts."""
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    data = [(None, " ".join(words(5 + i % 7, i))) for i in range(200)] + [(7, "x"), (7, "a"), (-3, None)]
    path = public.path("byte_bpe_50k.json")
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("payload", F.lit("x"))
    tokens.write(docs, str(tmp_path / "t"), path)
    plain = Tokenizer.from_file(path)
    encode = lambda t: [*plain.encode(t or "", add_special_tokens=False).ids, 0]
    found = []
    for r in spark.read.parquet(str(tmp_path / "t")).orderBy("part", "seq").collect():
        segment = tokens.Segment(r.payload)
        found += [(segment.doc_ids[i], segment.document(i).tolist()) for i in range(segment.docs)]
    order = sorted(data, key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))
    assert found == [(i, encode(t)) for i, t in order]
    assert [(r.doc_id, r.n_tokens) for r in tokens.read(spark, str(tmp_path / "t")).orderBy("start").collect()] == [(i, len(encode(t))) for i, t in order]
    other = tokens.Encoder(public.path("word_bpe_49k.json"))
    whole = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    assert not other.by_piece or other.tokenizer.to_str() == whole.to_str()
    texts = ["Hello there  you", "a\nb c", "déjà vu 12"]
    assert [x.tolist() for x in other.encode(texts)] == [[*whole.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_encoder_equals_whole_texts():
    public = pytest.importorskip("public_tokenizers")
    coder = tokens.Encoder(public.path("byte_bpe_50k.json"))
    odd = ["", "a", "  a b", "a  b ", "x\n y", "x\n\ny", "<|endoftext|> x", "don't we'll 12 34.5", "日本 語", "a b c", "\x00 a", "tab\tx y", "end ", " ", "\n\n", "é è", "12ab 3", "a — b", "x.\nY z"]
    for text, ids in zip(odd, coder.encode(odd), strict=True):
        assert ids.tolist() == [*coder.tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_encoder_asks_once_for_a_word_with_or_without_marks_and_keeps_what_it_meets(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(tokens, "CACHE_PIECES", 400)
    coder, asked = tokens.Encoder(public.path("byte_bpe_50k.json")), []
    whole = coder.tokenizer

    class Counting:
        def encode_batch_fast(self, texts, **kw):
            asked.extend(x.strip() for t in texts for x in t.split("\n"))
            return whole.encode_batch_fast(texts, **kw)

    coder.tokenizer = Counting()
    for i in range(40):
        new = " ".join(f"{w}{m}" for w, m in zip(words(60, i), [",", ".", "!?", "'s", "'", '."', "\u00bb.", "_x-", "3)", "\u00b2;"] * 6, strict=True))
        texts = [f"say frequent, frequent. (frequent) frequent {new}", f"'frequent' $frequent% ,, . {new[::-1]}"]
        for text, ids in zip(texts, coder.encode(texts), strict=True):
            assert ids.tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0]
        assert len(coder.known) + len(coder.older) < 2 * tokens.CACHE_PIECES
    assert asked.count("frequent") == 1 and asked.count("frequent,") == 0


def test_decontamination_takes_names_at_the_start_of_a_sentence_and_of_any_length():
    index = decontaminate.Index([(1, "Ben sold 20 pens on Monday. Carl sold 15 more than Ben did. Dana sold 7 less than Carl. How many did Dana sell?")])
    hits = lambda text: [(x["item_id"], x["kind"]) for x in index.hits(decontaminate.Coder(), text)]
    assert hits("Well. Erin sold 31 pens on Friday. Frank sold 12 more than Erin did. Gina sold 9 less than Frank. How many did Gina sell?") == [(1, "reparameterised")]
    assert hits("Mary Ann Lee sold 31 pens on Friday. Frank Moe sold 12 more than Mary Ann Lee did. Gina Roe sold 9 less than Frank Moe. How many did Gina Roe sell?") == [(1, "reparameterised")]
    assert hits("") == hits("It rained. Nobody sold anything.") == []


def test_katz_counts_many_payloads_without_sorting_all_words_for_each(monkeypatch):
    """What a bucket sorts or unites grows with its trigrams, not with payloads times words; results are those of one payload."""
    plan = katz.Plan(1, np.arange(5, 50, dtype=np.uint64), np.array([katz.START, katz.END]), np.zeros(0, np.uint64))
    rng = np.random.default_rng(5)
    grams = np.unique(rng.integers(1, 2000, (40_000, 3)).astype(np.uint64) << np.uint64(38), axis=0)
    grams = grams[np.lexsort((grams[:, 2], grams[:, 1], grams[:, 0], grams[:, 0] >> np.uint64(40) & np.uint64(3)))]
    rng.shuffle(block := np.arange(len(grams)) % 400)

    def rows(*parts):
        one = np.ones(1, np.uint64)
        frozen = [plan.freeze_ngrams(*p.T, np.ones(len(p), np.uint64), np.zeros(len(p), np.uint64), one) for p in parts]
        return pd.DataFrame({"bucket": 0, "kind": "d", "block": range(len(parts)), "payload": frozen})

    class Shared:
        def plan(self):
            return plan

    sent = lambda r: [(k, s, p) for _, k, s, p in katz.counter(Shared())(r).sort_values(["kind", "source"]).itertuples(index=False)]
    want, handled = sent(rows(grams)), 0

    def counted(f):
        def run(*arrays, **kw):
            nonlocal handled
            handled += sum(np.size(a) for a in arrays if isinstance(a, np.ndarray))
            return f(*arrays, **kw)

        return run

    for name in ("union1d", "sort", "unique"):
        monkeypatch.setattr(np, name, counted(getattr(np, name)))
    got = sent(rows(*(grams[block == i] for i in range(400))))
    assert got == want and handled < 4 * len(grams)


def test_katz_parts_come_out_of_a_payload_and_words_have_one_order():
    plan = katz.Plan(1, np.array([7, 3, 1 << 41], np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    v, u, w = (np.array(x, np.uint64) for x in ([3, 3, 9, 1 << 40, 1 << 41, 3 << 40], [7, 8, 7, 3, 7, 11], [5, 5, 3, 3, 7, 7]))
    times, docs, size = np.array([1, 2, 1, 1, 3, 1], np.uint64), np.arange(9, dtype=np.uint64), np.array([5], np.uint64)
    payload, whole = plan.freeze_ngrams(v, u, w, times, docs, size), []
    for part in range(katz.PARTS):
        got = plan.thaw_part(payload, part)
        assert (katz.part_of(got[0]) == part).all() and got[-1].tolist() == [5]
        assert [x.tolist() for x in plan.thaw_part(payload, part, words=False)[3:]] == [x.tolist() for x in got[3:]]
        whole.append(got[:5])
    for x, y in zip((v, u, w, times, docs), zip(*whole, strict=True), strict=True):
        assert np.concatenate(y).tolist() == x.tolist()
    assert katz.distinct([w, np.zeros(0, np.uint64), v]).tolist() == sorted({*w.tolist(), *v.tolist()}) and not len(katz.distinct([]))
    for key in (np.array([3, 1, 3, 1, 0], np.uint64), np.array([1 << 63, 1, 1 << 63, 0], np.uint64), np.zeros(0, np.uint64)):
        assert katz._order(key).tolist() == np.argsort(key, kind="stable").tolist()
