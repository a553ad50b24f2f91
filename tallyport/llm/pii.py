"""Personal data by candidate spans and boosted trees, in JVM-side expressions only.

Spans have a kind (email, ip, card, phone), a start and an exclusive end in code points. Base spans follow fixed
patterns and checks and are always redacted. High-recall generators propose further, overlapping candidates of the same
kinds (other separators, no leading plus, written-out "at" and "dot"); boosted trees over format and context features
score them, and those above a threshold calibrated for PRECISION on rows that the trees have not seen are added.

What the trees learn is not what the base patterns say. A bounded sample (the TRAIN_DOCS documents with the least hash of
doc_id) gives three sorts of rows. Its own base spans are rewritten, VARIANTS times, in forms that no base pattern takes:
without the plus, the at sign or the separators (FORMS). In windows around the middle of each text a made-up span of each
kind is planted in such a form, with or without a word that leads to it (`made`); so each kind has positives in every
corpus, however few spans of its own it has. And in the same windows decoys are planted, which look alike and are none:
sentences that break after an at sign, lists of numbers, sixteen digits that fail the check, dates, sections, order numbers
(`decoy`). Of the candidates in such a text that no base span covers, those on a rewritten or planted span are positive,
those on a decoy negative, and others of the document itself too, unless they are in a rewritten form by themselves
(`unclear`). The sample is split by document: one part fits the trees, one sets a threshold for each kind, half-way between
the least score that is let through and the next one below, and one measures precision and recall. The measured part has
forms, decoys and leading words that the other two never have. A kind with too few rows to calibrate it takes the threshold
of all kinds together. Everything else covers all rows and whole texts.

Patterns are written so that the engine never walks back through a long run: a match may start at a run's first
character or where the last match ended, and inner groups are possessive, which changes no match.

Defined results: null and empty texts have no spans and the hash of the empty string; rows that repeat get the same
result each; an empty table gives no rows; without a document that has text there is nothing to learn from and nothing is
added.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.llm.boosting import Boosted
from tallyport.llm.common import cut, discard, table

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 600
TRAIN_ROWS = 1500
PRECISION = 0.99
#: Least rows of a kind above its threshold on the calibration rows; with fewer the threshold of all kinds counts.
LEAST_SUPPORT = 10
#: Times that a document's own spans are rewritten, each time in another form.
VARIANTS = 3
#: Characters of a text on either side of a planted span or decoy.
WINDOW = 120
#: Parts of the documents that fit, calibrate and measure.
PARTS = (3, 1, 1)
CONTEXT = 24

#: Base patterns by kind, as (where a match may start, pattern).
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
BASE = {
    "email": (f"(?:\\G|(?<!{_LOCAL}))", f"{_LOCAL}++@{_LABEL}++(?:\\.{_LABEL}++)++"),
    "ip": ("(?:\\G|(?<![0-9]))", "[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"),
    "card": ("(?:\\G|(?<![0-9]))", "[0-9](?:[\\x20-]?[0-9])++"),
    "phone": ("", "\\+[0-9][\\x20().0-9-]+[0-9]"),
}
#: What a text must contain before its spans of a kind are looked for.
_HINT = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]"}
#: High-recall generators by kind; a match starts where no letter, digit or joiner precedes.
GENERATORS = {
    "email": (f"(?<!{_LOCAL})", f"{_LOCAL}++ ?(?:@|\\[at\\]|\\(at\\)) ?{_LABEL}++(?: ?(?:\\.|\\[dot\\]|\\(dot\\)) ?{_LABEL}++)++"),
    "ip": ("(?<![0-9A-Za-z])", "[0-9]{1,3}(?:(?:\\.|\\[\\.\\]|\\(\\.\\)|,)[0-9]{1,3}){3}(?![0-9A-Za-z])"),
    "card": ("(?<![0-9A-Za-z])", "[0-9]{4}(?:[ ./_-]?[0-9]{4}){2}[ ./_-]?[0-9]{1,7}(?![0-9A-Za-z])"),
    "phone": ("(?<![0-9A-Za-z])", "\\(?[0-9]{1,4}\\)?(?:[ ./-]{1,2}\\(?[0-9]{2,4}\\)?){1,4}(?![0-9A-Za-z])"),
}
_GENERATOR_HINT = {"email": "@|\\[at\\]|\\(at\\)", "ip": "[0-9](?:[.,]|\\[\\.|\\(\\.)", "card": "[0-9]{4}", "phone": "[0-9]{2}[)]?[ ./-]"}
SPANS = "array<struct<start:long,end:long,found:string>>"


def _none() -> Column:
    return F.array().cast(SPANS)


def matches(text: Column, at: str, pattern: str, hint: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, end, found>>, in one pass over the text."""
    step = F.lit(f"\\G(?s)(.*?){at}({pattern})")
    pairs = F.arrays_zip(F.regexp_extract_all(text, step, F.lit(1)).alias("gap"), F.regexp_extract_all(text, step, F.lit(2)).alias("found"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["found"])
        return F.struct(end.cast("long").alias("at"), F.concat(acc["spans"], F.array(F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), x["found"].alias("found")))).alias("spans"))

    first = F.struct(F.lit(0).cast("long").alias("at"), _none().alias("spans"))
    return F.when(F.coalesce(F.regexp_like(text, F.lit(hint)), F.lit(False)), F.aggregate(pairs, first, add, lambda acc: acc["spans"])).otherwise(_none())


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of 1 to 40 digits passes the Luhn check."""
    at = F.sequence(F.lit(1), F.length(number))
    digit = lambda i: F.ascii(F.substr(number, i, F.lit(1))) - 48

    def value(i: Column) -> Column:
        twice = (F.length(number) - i) % 2 * digit(i) + digit(i)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return (F.length(number) > 0) & (F.length(number) <= 40) & (F.aggregate(at, F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0)


def valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.regexp_like(found, F.lit(f"^{_BYTE}(?:\\.{_BYTE}){{3}}$"))
    if kind == "card":
        return F.length(digits(found)).between(13, 19) & luhn(digits(found))
    if kind == "phone":
        return F.length(digits(found)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(matches(text, *BASE[kind], _HINT[kind]), lambda s: valid(kind, s["found"]))


def candidates(text: Column, kind: str) -> Column:
    return matches(text, *GENERATORS[kind], _GENERATOR_HINT[kind])


FEATURES = (
    "kind", "chars", "digits", "letters", "blanks", "dots", "dashes", "brackets", "slashes", "groups", "longest group", "same digit", "luhn",
    "bytes", "year", "text before", "text after", "digit near", "sign before", "mail word", "call word", "card word", "address word", "amount word",
    "blank after dot", "lower tail", "written dots", "capital in it", "commas",
)


def features(kind: str, text: Column, span: Column) -> list[Column]:
    """Doubles in the order of FEATURES. The leading plus and the at sign are never looked at."""
    found = span["found"]
    start, end = span["start"].cast("int"), span["end"].cast("int")
    begin = F.greatest(F.lit(0), start - CONTEXT)
    before = F.lower(F.substr(text, begin + 1, start - begin))
    after = F.lower(F.substr(text, end + 1, F.lit(CONTEXT)))
    count = lambda pattern: F.length(found) - F.length(F.regexp_replace(found, pattern, ""))
    groups = F.regexp_extract_all(found, F.lit("[0-9]+"), F.lit(0))
    flag = lambda value: F.coalesce(value, F.lit(False)).cast("double")
    has = lambda where, pattern: flag(F.regexp_like(where, F.lit(pattern)))
    number = digits(found)
    out = [
        F.lit(KINDS.index(kind)), F.length(found), F.length(number), count("[A-Za-z]"), count(" "), count("\\."), count("-"), count("[()\\[\\]]"), count("/"),
        F.size(groups), F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), has(number, "^([0-9])\\1*$"),
        flag(F.length(number).between(13, 19) & luhn(F.substr(number, F.lit(1), F.lit(20)))), has(found, f"^{_BYTE}(?:[^0-9]+{_BYTE}){{3}}$"), has(found, "(?<![0-9])(?:19|20)[0-9][0-9](?![0-9])"),
        has(before, "\\p{L} ?$"), has(after, "^ ?\\p{L}"), flag(F.regexp_like(before, F.lit("[0-9]$")) | F.regexp_like(after, F.lit("^[0-9]"))), has(before, "[$€£#=\"']\\s?$"),
        has(before, "mail|contact|write"), has(before, "tel|phone|call|fax|mobile|\\+[0-9]"), has(before, "card|visa|credit|payment"), has(before, "\\bip\\b|host|server|address"), has(before, "total|price|version|page|order|no\\.|section|date|ref"),
        count("(?<=[.])[ ]"), has(found, "[a-z]{2,6}$"), count("\\[dot\\]|\\(dot\\)") / 5, has(found, "\\p{Lu}"), count(","),
    ]
    return [x.cast("double") for x in out]


def _overlaps(spans: Column, s: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


#: What a base span may be rewritten to, by kind; which one is chosen by a hash. Those of HELD are for measuring only.
FORMS = {
    "email": (
        lambda f: F.regexp_replace(F.regexp_replace(f, "@", " [at] "), "\\.", " [dot] "),
        lambda f: F.regexp_replace(f, "@", "(at)"),
        lambda f: F.regexp_replace(f, "@", " @ "),
        lambda f: F.regexp_replace(F.regexp_replace(f, "[0-9]", ""), "@", " [at] "),
        lambda f: F.regexp_replace(F.regexp_replace(F.regexp_replace(f, "[0-9]", ""), "@", "[at]"), "\\.(?=[a-z]*$)", "[dot]"),
    ),
    "ip": (lambda f: F.regexp_replace(f, "\\.", "[.]"), lambda f: F.regexp_replace(f, "^([0-9]+)\\.([0-9]+)\\.", "$1[.]$2[.]")),
    "card": (lambda f: F.regexp_replace(digits(f), "([0-9]{4})(?=[0-9])", "$1."), lambda f: F.regexp_replace(digits(f), "([0-9]{4})(?=[0-9])", "$1/")),
    "phone": (lambda f: F.substr(f, F.lit(2)), lambda f: F.regexp_replace(f, "^\\+[0-9]{1,3}[ .-]*", ""), lambda f: F.regexp_replace(F.substr(f, F.lit(2)), "[ ()-]+", ".")),
}
HELD = {
    "email": (lambda f: F.regexp_replace(F.regexp_replace(f, "@", " (at) "), "\\.", " (dot) "), lambda f: F.regexp_replace(F.regexp_replace(f, "[0-9]", ""), "@", " (at) ")),
    "ip": (lambda f: F.regexp_replace(f, "\\.", "(.)"),),
    "card": (lambda f: F.regexp_replace(digits(f), "([0-9]{4})(?=[0-9])", "$1_"),),
    "phone": (lambda f: F.regexp_replace(F.substr(f, F.lit(2)), "[ ()-]+", "-"),),
}
#: Words before a planted span, and before a decoy; the last two of each are for measuring only.
_LEADS = {
    "email": ("", "mail", "", "write to", "contact", ""), "ip": ("", "host", "server", "", "address", ""), "card": ("", "card", "", "visa", "payment", ""), "phone": ("call", "tel", "", "phone", "mobile", "fax"),
}
_DECOY_LEADS = {
    "email": ("", "meet", "page", "", "version", ""), "ip": ("", "total", "price", "", "page", ""), "card": ("", "order", "no.", "", "ref", ""), "phone": ("", "on", "section", "the", "version", "", "order", "in", "page", "ref"),
}


def _picked(options: list[Column], by: Column) -> Column:
    return F.get(F.array(*options), F.pmod(by, F.lit(len(options))).cast("int"))


def _number(seed: Column, n: int, salt: int) -> Column:
    """n digits by a hash."""
    return F.lpad(F.pmod(F.xxhash64(seed, F.lit(salt)), F.lit(10**n)).cast("string"), n, "0")


def made(kind: str, words: Column, seed: Column) -> Column:
    """A made-up span that the base pattern of its kind takes: words of the text, digits by a hash."""
    word = lambda i: F.lower(F.get(words, F.lit(i)))
    if kind == "email":
        end = _picked([F.lit(x) for x in ("org", "com", "net", "de")], F.xxhash64(seed, F.lit(5)))
        plain, dotted = F.concat(word(0), F.lit("@"), word(1), F.lit("."), end), F.concat(word(0), F.lit("."), word(2), F.lit("@"), word(1), F.lit("."), end)
        numbered = F.concat(word(0), _number(seed, 2, 1), F.lit("@"), word(1), _number(seed, 1, 2), F.lit(".example."), end)
        return _picked([plain, dotted, numbered], F.xxhash64(seed, F.lit(6)))
    if kind == "ip":
        part = lambda i: F.pmod(F.xxhash64(seed, F.lit(i)), F.when(F.pmod(F.xxhash64(seed, F.lit(i + 9)), F.lit(3)) == 0, F.lit(20)).otherwise(F.lit(256))).cast("string")
        return F.concat_ws(".", *(part(i) for i in range(4)))
    if kind == "card":
        body = F.concat(F.lit("4"), _number(seed, 14, 1))
        return F.concat(body, F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: d.cast("string")), lambda d: luhn(F.concat(body, d)))[0])
    country = _picked([F.lit(x) for x in ("1", "44", "49", "358")], F.xxhash64(seed, F.lit(5)))
    spaced = F.concat_ws(" ", F.concat(F.lit("+"), country), _number(seed, 2, 1), _number(seed, 4, 2), _number(seed, 4, 3))
    return _picked([F.concat(F.lit("+"), country, F.lit(" ("), _number(seed, 3, 1), F.lit(") "), _number(seed, 3, 2), F.lit("-"), _number(seed, 4, 3)), spaced], F.xxhash64(seed, F.lit(6)))


def decoy(kind: str, words: Column, seed: Column, held: Column) -> Column:
    """What looks like a span of a kind and is none; `held` asks for one of those that are for measuring only."""
    word = lambda i: F.lower(F.get(words, F.lit(i)))
    capital = F.initcap(F.get(words, F.lit(2)))
    small = lambda i: F.pmod(F.xxhash64(seed, F.lit(i)), F.lit(90)).cast("string")
    pick = F.xxhash64(seed, F.lit(77))
    if kind == "email":
        usual = [F.concat(word(0), F.lit(f" {m} "), word(1), F.lit(". "), capital) for m in ("[at]", "@")] + [F.concat(word(0), F.lit(" @ "), small(1), F.lit("."), small(2)), F.concat(word(0), F.lit("(at) "), word(1), F.lit(". "), word(2))]
        rare = [F.concat(word(0), F.lit(" (at) "), word(1), F.lit(". "), capital)]
    elif kind == "ip":
        big = lambda i: F.lpad((F.pmod(F.xxhash64(seed, F.lit(i)), F.lit(700)) + 256).cast("string"), 3, "0")
        usual = [F.concat_ws(",", small(1), _number(seed, 3, 2), _number(seed, 3, 3), _number(seed, 3, 4)), F.concat_ws(",", *(small(i) for i in range(4))), F.concat_ws(".", small(1), big(2), small(3), small(4))]
        rare = [F.concat_ws(",", *(_number(seed, 2, i) for i in range(4)))]
    elif kind == "card":
        body = F.concat(_number(seed, 15, 1), _number(seed, 1, 2))
        wrong = F.when(luhn(body), F.concat(F.left(body, F.lit(15)), F.pmod(F.right(body, F.lit(1)).cast("int") + 1, F.lit(10)).cast("string"))).otherwise(body)
        usual = [F.regexp_replace(wrong, "([0-9]{4})(?=[0-9])", f"$1{m}") for m in ("", ".", "/", " ", "-")]
        rare = [F.regexp_replace(wrong, "([0-9]{4})(?=[0-9])", "$1_")]
    else:
        year = F.concat(F.lit("20"), _number(seed, 2, 1))
        day = lambda i: F.lpad((F.pmod(F.xxhash64(seed, F.lit(i)), F.lit(12)) + 1).cast("string"), 2, "0")
        usual = [F.concat_ws("-", year, day(2), day(3)), F.concat_ws(".", day(2), day(3), year), F.concat_ws(".", small(1), _number(seed, 2, 2), _number(seed, 2, 3)), F.concat_ws("-", _number(seed, 2, 1), _number(seed, 3, 2), _number(seed, 3, 3)), F.concat_ws("-", year, F.concat(F.lit("20"), _number(seed, 2, 4)))]
        usual += [F.concat_ws(" ", small(1), _number(seed, 3, 2), _number(seed, 3, 3)), F.concat_ws(".", small(1), small(2)), F.concat_ws(".", small(1), _number(seed, 3, 2), small(3), small(4))]
        rare = [F.concat_ws("/", day(2), day(3), year), F.concat_ws(" ", _number(seed, 3, 1), _number(seed, 3, 2))]
    return F.when(held, _picked(rare, pick)).otherwise(_picked(usual, pick))


def _forms(kind: str, found: Column, by: Column, held: Column) -> Column:
    return F.when(held, _picked([f(found) for f in HELD[kind]], by)).otherwise(_picked([f(found) for f in FORMS[kind]], by))


def rewritten(text: Column, variant: Column | None = None, held: Column | None = None) -> Column:
    """struct<text, spans>: the text with its base spans in other forms, and where these are; of spans that overlap, the
    first is rewritten and the others stay."""
    turn, apart = (F.lit(0) if variant is None else variant), (F.lit(False) if held is None else held)

    def formed(kind: str):  # noqa: ANN202
        def of(s: Column) -> Column:
            form = _forms(kind, s["found"], F.xxhash64(s["found"], s["start"]) + turn, apart)
            return F.struct(s["start"].alias("start"), s["end"].alias("end"), form.alias("form"), F.lit(kind).alias("kind"))

        return of

    base = F.sort_array(F.concat(*(F.transform(base_spans(text, kind), formed(kind)) for kind in KINDS)))

    def put(acc: Column, s: Column) -> Column:
        kept = F.concat(acc["text"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")))
        span = F.struct(F.length(kept).cast("long").alias("start"), (F.length(kept) + F.length(s["form"])).cast("long").alias("end"), s["kind"].alias("kind"))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(kept, s["form"]).alias("text"), F.concat(acc["spans"], F.array(span)).alias("spans"))).otherwise(acc)

    none = F.array().cast("array<struct<start:long,end:long,kind:string>>")
    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text"), none.alias("spans"))
    done = lambda acc: F.struct(F.concat(acc["text"], F.substr(text, (acc["at"] + 1).cast("int"), F.length(text))).alias("text"), acc["spans"].alias("spans"))
    return F.aggregate(base, first, put, done)


@dataclass
class Detector:
    """Trees with a threshold for each kind that selects redactions (a kind without one adds nothing), and what they
    reached on documents that neither fitted nor calibrated them: (precision, recall, positives) by kind."""

    trees: Boosted | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    measured: dict[str, tuple[float, float, int]] = field(default_factory=dict)


def unclear(kind: str, text: Column, span: Column) -> Column:
    """Whether a candidate that nobody rewrote may well be personal data: brackets in an address, digits that pass a
    card's check, as many digits as a phone number has after a word of calling."""
    found = span["found"]
    if kind in ("email", "ip"):
        return F.regexp_like(found, F.lit("[\\[(]"))
    if kind == "card":
        return F.length(digits(found)).between(13, 19) & luhn(F.substr(digits(found), F.lit(1), F.lit(20)))
    start = span["start"].cast("int")
    begin = F.greatest(F.lit(0), start - CONTEXT)
    before = F.lower(F.substr(text, begin + 1, start - begin))
    return F.length(digits(found)).between(9, 15) & F.regexp_like(before, F.lit("tel|phone|call|fax|mobile"))


def _planted(sample: DataFrame) -> DataFrame:
    """(part, text, planted, own, only): for each sampled document and kind VARIANTS windows with a made-up span in another
    form, and as many with a decoy, which `planted` has with an empty kind. Only candidates on what was planted count here
    (`own` is false): those of its kind on a span, those of any kind on a decoy."""
    half = F.floor(F.length("text") / 2).cast("int")
    near = F.substr("text", F.greatest(half - 300, F.lit(0)) + 1, F.lit(600))
    at = half + F.instr(F.substr("text", half + 1, F.lit(300)), " ")
    words = F.concat(F.filter(F.regexp_extract_all(near, F.lit("[A-Za-z]{3,10}"), F.lit(0)), lambda w: F.length(w) > 2), F.array(F.lit("anna"), F.lit("noon"), F.lit("then")))
    start = F.greatest(at - WINDOW, F.lit(0))
    base = sample.select("part", F.substr("text", start + 1, at - start).alias("before"), F.substr("text", at + 1, F.lit(WINDOW)).alias("after"), words.alias("words"), F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("turn"), "doc_id")
    base = base.withColumn("seed", F.xxhash64(F.lit("plant"), "doc_id", "turn"))
    out = None
    for kind in KINDS:
        held, by = F.col("part") >= sum(PARTS[:2]), F.xxhash64("seed", F.lit(f"lead {kind}"))
        lead = lambda leads: F.when(held, _picked([F.lit(x) for x in leads[-2:]], by)).otherwise(_picked([F.lit(x) for x in leads[:-2]], by))  # noqa: B023, E731
        for mark, found, leads in ((kind, _forms(kind, made(kind, F.col("words"), F.col("seed")), F.xxhash64("seed", F.lit(kind)), held), _LEADS[kind]), ("", decoy(kind, F.col("words"), F.xxhash64("seed", F.lit(f"decoy {kind}")), held), _DECOY_LEADS[kind])):
            head = F.concat("before", lead(leads), F.when(lead(leads) == "", "").otherwise(" "))
            rows = base.select("part", head.alias("head"), found.alias("found"), "after")
            span = F.struct(F.length("head").cast("long").alias("start"), (F.length("head") + F.length("found")).cast("long").alias("end"), F.lit(mark).alias("kind"))
            one = rows.select("part", F.concat("head", "found", F.lit(" "), "after").alias("text"), F.array(span).alias("planted"), F.lit(False).alias("own"), F.lit(mark or None).cast("string").alias("only"))
            out = one if out is None else out.unionAll(one)
    return out


def labelled(docs: DataFrame) -> DataFrame:
    """(kind, x, y, part, place) of the candidates of the sample's rewritten texts and planted windows."""
    place = F.xxhash64(F.lit("pii"), "doc_id")
    ids = docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).select("doc_id").distinct().orderBy(place, "doc_id").limit(TRAIN_DOCS)
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(sum(PARTS))).cast("int")
    sample = cut(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id").select("doc_id", "text", part.alias("part")), "pii-documents")
    held = F.col("part") >= sum(PARTS[:2])
    turned = sample.select("part", "text", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("variant"))
    own = turned.select("part", rewritten(F.col("text"), F.col("variant"), held).alias("r")).select("part", F.col("r.text").alias("text"), F.col("r.spans").alias("planted"), F.lit(True).alias("own"), F.lit(None).cast("string").alias("only"))
    rows = cut(own.unionAll(_planted(sample)), "pii-sample")
    seen = rows
    for kind in KINDS:
        seen = seen.withColumn(f"base_{kind}", base_spans(F.col("text"), kind))
    out = None
    for kind in KINDS:
        of = seen.where(F.coalesce(F.col("only"), F.lit(kind)) == kind).select("part", "text", "planted", "own", F.explode(_fresh(kind)).alias("s"))
        mine = F.filter("planted", lambda p: p["kind"] == kind)  # noqa: B023
        one = of.select(
            F.lit(kind).alias("kind"), F.array(*features(kind, F.col("text"), F.col("s"))).alias("x"), _overlaps(mine, F.col("s")).cast("double").alias("y"), "part", F.xxhash64("text", "s").alias("place"),
            unclear(kind, F.col("text"), F.col("s")).alias("unclear"), "own", _overlaps(F.col("planted"), F.col("s")).alias("on"),
        )
        one = one.where("CASE WHEN own THEN y = 1 OR NOT unclear ELSE on END").select("kind", "x", "y", "part", "place").distinct().orderBy("place", "x").limit(TRAIN_ROWS)
        out = one if out is None else out.unionAll(one)
    found = cut(out, "pii-rows")
    discard(rows, sample)
    return found


def train(docs: DataFrame) -> Detector:
    """Fit, calibrate and measure on a bounded sample."""
    table_ = labelled(docs)
    found = sorted(table_.collect(), key=lambda r: (r.kind, r.place, r.x))
    discard(table_)
    fit, calibrate, last = ([r for r in found if low <= r.part < high] for low, high in ((0, PARTS[0]), (PARTS[0], sum(PARTS[:2])), (sum(PARTS[:2]), sum(PARTS))))
    if len({r.y for r in fit}) < 2:
        return Detector()
    out = Detector(Boosted(np.array([r.x for r in fit]), np.array([r.y for r in fit])))
    scored = lambda rows: (out.trees.predict(np.array([r.x for r in rows])), np.array([r.y for r in rows])) if rows else (np.zeros(0), np.zeros(0))
    # Where even all kinds together are too few to calibrate, the trees' own odds decide.
    together = _threshold(*scored(calibrate), least=1)
    for kind in KINDS:
        of = _threshold(*scored([r for r in calibrate if r.kind == kind]))
        out.thresholds[kind] = next((t for t in (of, together) if t is not None), 0.5)
        p, truth = scored([r for r in last if r.kind == kind])
        if len(truth):
            chosen = p >= out.thresholds[kind]
            right = float(truth[chosen].sum())
            out.measured[kind] = (right / max(1, int(chosen.sum())), right / max(1.0, float(truth.sum())), int(truth.sum()))
    return out


def _threshold(p: np.ndarray, truth: np.ndarray, least: int = LEAST_SUPPORT) -> float | None:
    """Half-way between the least score from which on at least PRECISION of the rows are right and the next one below (or
    nothing); rows of one score go together."""
    order = np.argsort(-p, kind="stable")
    n = np.arange(1, len(order) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True) if len(order) else np.zeros(0, bool)
    good = np.flatnonzero((np.cumsum(truth[order]) / n >= PRECISION) & (n >= least) & last)
    if not len(good):
        return None
    lowest = p[order[good[-1]]]
    below = p[p < lowest]
    return float((lowest + (below.max() if len(below) else 0.0)) / 2)


def _fresh(kind: str) -> Column:
    """Candidates beside base spans of any kind only: what a base span covers is redacted already."""
    return F.filter(candidates(F.col("text"), kind), lambda s: ~(_overlaps(F.col("base_email"), s) | _overlaps(F.col("base_ip"), s) | _overlaps(F.col("base_card"), s) | _overlaps(F.col("base_phone"), s)))


def _selected(kind: str, detector: Detector):  # noqa: ANN202
    """Whether the trees' score of a candidate reaches the threshold. Its features are bound once, as an array."""

    def of(s: Column) -> Column:
        score = lambda x: detector.trees.column([x[i] for i in range(len(FEATURES))])
        return F.element_at(F.transform(F.array(F.array(*features(kind, F.col("text"), s))), score), 1) >= detector.thresholds[kind]

    return of


def spans(docs: DataFrame, detector: Detector) -> DataFrame:
    """Each row's columns with `text` never null, and for each kind base_<kind> and added_<kind>."""
    out = docs
    for kind in KINDS:
        out = out.withColumn(f"base_{kind}", base_spans(F.col("text"), kind))
    for kind in KINDS:
        added = F.filter(_fresh(kind), _selected(kind, detector)) if kind in detector.thresholds else _none()
        out = out.withColumn(f"added_{kind}", added)
    return out


def listed(kind: str, found: Column) -> Column:
    return F.transform(found, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def find(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """(doc_id, n_<kind> of base spans, base_sha256, spans, n_added) of each row."""
    detector = train(docs) if detector is None else detector
    found = spans(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), detector)
    base = F.concat(*(listed(k, F.col(f"base_{k}")) for k in KINDS))
    together = lambda k: F.sort_array(F.concat(f"base_{k}", f"added_{k}"))
    every = F.concat(*(listed(k, together(k)) for k in KINDS))
    return found.select(
        "doc_id",
        *(F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(every, ",").alias("spans"),
        sum((F.size(f"added_{k}") for k in KINDS), F.lit(0)).cast("long").alias("n_added"),
    )


def _marker(mark: str):  # noqa: ANN202
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(mark).alias("mark"))


def redact(docs: DataFrame, detector: Detector | None = None, mark: str = "[{}]") -> DataFrame:
    """The documents with every span of `text` replaced by its kind; of spans that overlap, the first."""
    detector = train(docs) if detector is None else detector
    found = spans(docs, detector)
    marked = F.sort_array(F.concat(*(F.transform(F.concat(f"base_{k}", f"added_{k}"), _marker(mark.format(k))) for k in KINDS)))

    def put(acc: Column, s: Column) -> Column:
        kept = F.concat(acc["out"], F.substr("text", (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), s["mark"])
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), kept.alias("out"))).otherwise(acc)

    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substr("text", (acc["at"] + 1).cast("int"), F.length("text")))
    text = F.when(F.col("text").isNotNull(), F.aggregate(marked, first, put, rest))
    return found.withColumn("text", text).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
