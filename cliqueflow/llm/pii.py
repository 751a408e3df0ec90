"""Personal data in texts: patterns propose spans, checksums confirm, context scores (DataFrame functions only).

Base kinds (email, ip, card, phone) are the leftmost non-overlapping matches
of one pattern each; a match that fails its check is dropped without a retry.
The method adds kinds that a pattern alone cannot settle: ``iban`` (mod-97;
every country code with two digits is tried, also inside another's run, with
each whole word up to 34 characters as its end; of the ends that the checksum
confirms, that of the country's own length stands, else the longest) and
``ssn`` (three digit groups that stand only with a telling word nearby).
Every span has a score: a checksum or structure gives its base, a context word
within ``CONTEXT`` code points before or after it adds ``CONTEXT_GAIN``, and so
does a confirmed neighbour of its kind at most ``CONTEXT`` code points away that
has the gain itself (a list has the context of its heading); spans below
``MIN_SCORE`` of the added kinds are dropped, base spans always stay.

Spans are code point offsets, end exclusive. Defined cases: a null text has no
span; repeated rows are each scanned; other columns pass through unchanged.
The possessive and look-behind forms below match what the plain patterns do,
but take linear time and constant stack on very long runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})"
#: A match of IBAN with what may belong to it, and one character more where the last word goes on.
IBAN_RUN = r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+[A-Za-z0-9]?"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
CONTEXT = 40
#: Code points after a match that are kept with it: the longest rest of an IBAN with its blanks, one more, and the context.
AHEAD = 61 + CONTEXT
CONTEXT_GAIN = 0.35
MIN_SCORE = 0.5
#: Words near a span that make its kind likelier; fixed values.
CONTEXT_WORDS = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|address|host|server|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta|payment",
    "phone": "phone|call|tel|mobile|fax|telefon",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social|security|taxpayer",
}
START_SCORE = {"email": 0.7, "ip": 0.6, "card": 0.6, "phone": 0.5, "iban": 0.6, "ssn": 0.3}
#: Length of the IBANs of each country of the registry.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


CHUNK = 256
FOUND = "array<struct<s:int,e:int,t:string,b:string,a:string>>"


def running(items: Column, state: Column, kind: str, step) -> Column:
    """What ``step(state, item) -> (next state, result)`` gives for every item, as ``kind``; chunks keep the appends short."""

    def one(acc: Column, x: Column) -> Column:
        following, result = step(acc["state"], x)
        return F.struct(following.alias("state"), F.concat(acc["out"], F.array(result)).alias("out"))

    def chunk(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(acc["state"].alias("state"), F.array().cast(kind).alias("out")), one)
        return let(done, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

    parts = F.transform(F.sequence(F.lit(1), F.size(items), F.lit(CHUNK)), lambda i: F.slice(items, i, CHUNK))
    start = F.struct(state.alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.flatten(F.aggregate(parts, start, chunk, lambda a: a["out"]))


def matches(text: Column, pattern: str) -> Column:
    """All matches as array<struct<s, e, t, b, a>>: start and end code point, matched text, what stands just before it and after it.

    Offsets are running sums over the gaps between matches, so that the work
    stays in proportion to the number of matches.
    """
    pattern += rf"(?=((?s:.{{0,{AHEAD}}})))"

    def step(state: Column, pair: Column) -> tuple[Column, Column]:
        before = F.right(F.concat(state["tail"], pair["g"]), F.lit(CONTEXT))
        start = state["at"] + F.char_length(pair["g"])
        end = start + F.char_length(pair["t"])
        one = F.struct(start.alias("s"), end.alias("e"), pair["t"].alias("t"), before.alias("b"), pair["a"].alias("a"))
        return F.struct(end.alias("at"), F.right(F.concat(before, pair["t"]), F.lit(CONTEXT)).alias("tail")), one

    def place(pairs: Column) -> Column:
        return running(pairs, F.struct(F.lit(0).alias("at"), F.lit("").alias("tail")), FOUND, step)

    def pairs(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        after = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        return F.transform(F.arrays_zip(gaps.alias("g"), found.alias("t"), after.alias("a")), lambda x: F.struct(x["g"].alias("g"), x["t"].alias("t"), x["a"].alias("a")))

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) > 0, let(pairs(found), place)).otherwise(F.array().cast(FOUND)),
    )


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Checksum of a digit string, counted from its right end."""
    ordered = F.reverse(F.split(digits, ""))

    def value(d: Column, i: Column) -> Column:
        n = d.cast("int")
        doubled = n * 2
        return F.when(i % 2 == 0, n).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    return F.aggregate(F.transform(ordered, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """IBAN check: first four characters moved to the end, letters as two digits, remainder 1."""
    turned = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))

    def step(acc: Column, ch: Column) -> Column:
        letter = F.ascii(ch) - 55
        return F.when(ch.rlike("[A-Z]"), (acc * 100 + letter) % 97).otherwise((acc * 10 + ch.cast("int")) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def confirmed(kind: str, found: Column) -> Column:
    """Whether a match's text passes the check of its kind."""
    t = found["t"]
    if kind == "ip":
        parts = F.transform(F.split(t, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return let(digits_of(t), lambda d: F.length(d).between(12, 19) & luhn(d))
    if kind == "phone":
        return F.length(digits_of(t)).between(9, 15)
    return F.lit(True)


def whole_ibans(found: Column) -> Column:
    """Matches of IBAN with the end that their checksum confirms; those without one are dropped."""
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])

    def ends(words: Column, own: Column) -> Column:
        def end(i: Column) -> Column:
            return F.struct(F.array_join(F.slice(words, 1, i), "").alias("code"), (i - 1).alias("blanks"), (i == F.size(words)).alias("last"))

        def stands(x: Column) -> Column:
            fits = own.isNull() | (F.length(x["code"]) == own) | x["last"]
            return F.when(fits & x["code"].rlike("^[A-Z0-9]{15,34}$"), mod97(x["code"])).otherwise(False)

        def ranked(x: Column) -> Column:
            n = F.length(x["code"])
            return F.struct(F.coalesce(n == own, F.lit(False)).alias("own"), (n + x["blanks"]).alias("n"))

        tried = F.transform(F.sequence(F.lit(1), F.size(words)), end)
        return F.array_max(F.transform(F.filter(tried, stands), ranked))["n"]

    def whole(m: Column) -> Column:
        words = F.split(F.regexp_extract(F.concat(m["t"], m["a"]), IBAN_RUN, 0), " ")
        own = F.try_element_at(lengths, F.substr(m["t"], F.lit(1), F.lit(2)))
        length = let(F.struct(words.alias("words"), own.alias("own")), lambda x: ends(x["words"], x["own"]))
        return let(
            length,
            lambda n: F.struct(
                m["s"].alias("s"),
                (m["s"] + n).alias("e"),
                m["t"].alias("t"),
                m["b"].alias("b"),
                F.substr(m["a"], n - F.char_length(m["t"]) + 1).alias("a"),
            ),
        )

    return F.filter(F.transform(found, whole), lambda m: m["e"].isNotNull())


NEAR = "array<struct<s:int,e:int,near:boolean>>"


def with_neighbours(found: Column) -> Column:
    """array<struct<s, e, near>> where a span is near context, too, if a chain of spans, each within CONTEXT of the next, leads to one that is."""

    def after(state: Column, x: Column) -> tuple[Column, Column]:
        near = x["near"] | (state["near"] & (x["s"] - state["at"] <= CONTEXT))
        return F.struct(x["e"].alias("at"), near.alias("near")), F.struct(x["s"].alias("s"), x["e"].alias("e"), near.alias("near"))

    def before(state: Column, x: Column) -> tuple[Column, Column]:
        near = x["near"] | (state["near"] & (state["at"] - x["e"] <= CONTEXT))
        return F.struct(x["s"].alias("at"), near.alias("near")), F.struct(x["s"].alias("s"), x["e"].alias("e"), near.alias("near"))

    none = F.struct(F.lit(0).alias("at"), F.lit(False).alias("near"))

    def chained(spans: Column) -> Column:
        forth = let(spans, lambda x: running(x, none, NEAR, after))
        back = let(F.reverse(forth), lambda x: running(x, none, NEAR, before))
        some = F.exists(spans, lambda x: x["near"]) & F.exists(spans, lambda x: ~x["near"])
        return F.when(some, F.reverse(back)).otherwise(spans)

    return let(found, chained)


def spans_of(text: Column, kind: str) -> Column:
    """array<struct<s, e, k, score>> of one kind (``k``: its rank in KINDS)."""
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN, "ssn": SSN}[kind]
    rank = KINDS.index(kind)

    def nearby(m: Column) -> Column:
        words = rf"(?:^|[^a-z])(?:{CONTEXT_WORDS[kind]})"
        near = F.lower(m["b"]).rlike(words) | F.lower(F.left(m["a"], F.lit(CONTEXT))).rlike(words)
        return F.struct(m["s"].alias("s"), m["e"].alias("e"), near.alias("near"))

    def scored(m: Column) -> Column:
        score = F.lit(START_SCORE[kind]) + F.when(m["near"], CONTEXT_GAIN).otherwise(0.0)
        return F.struct(m["s"].alias("s"), m["e"].alias("e"), F.lit(rank).alias("k"), score.alias("score"))

    found = matches(text, pattern)
    if kind == "iban":
        found = whole_ibans(found)
    found = F.transform(F.filter(found, lambda m: confirmed(kind, m)), nearby)
    found = F.transform(with_neighbours(found), scored)
    return found if kind in BASE_KINDS else F.filter(found, lambda s: s["score"] >= MIN_SCORE)


#: A kind is looked for only in texts that hold what each of its matches holds.
NEEDS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][0-9\x20-]{10}"),
    "phone": lambda t: t.rlike(r"\+[0-9]"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
    "ssn": lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"),
}


#: What ``find_pii`` adds; a column of that name is replaced.
ADDED = ("_spans",)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``_spans``: array<struct<s, e, k, score>> by start, then kind."""
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<struct<s:int,e:int,k:int,score:double>>")
    has_digit = body.rlike("[0-9]")

    def scan(t: Column) -> Column:
        return F.concat(*[F.when(NEEDS[k](t), spans_of(t, k)).otherwise(none) for k in KINDS])

    def in_order(spans: Column) -> Column:
        keyed = F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["score"].alias("score")))
        return F.transform(
            F.sort_array(keyed),
            lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"), x["score"].alias("score")),
        )

    found = F.when(has_digit | body.contains("@"), let(body, lambda t: let(scan(t), in_order))).otherwise(none)
    return docs.withColumn("_spans", found)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by ``<KIND>``; a span that begins inside an earlier one joins it."""
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def step(acc: Column, x: Column) -> Column:
        gap = F.substr(text, acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0)))
        return F.when(
            x["s"] < acc["at"], F.struct(F.greatest(acc["at"], x["e"]).alias("at"), acc["out"].alias("out"))
        ).otherwise(F.struct(x["e"].alias("at"), F.concat(acc["out"], F.array(gap, F.get(tags, x["k"]))).alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    parts = F.aggregate(
        spans, start, step, lambda a: F.array_join(F.concat(a["out"], F.array(F.substr(text, a["at"] + 1))), "")
    )
    return F.when(F.size(spans) > 0, parts).otherwise(text)


def op2_pii(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, max_score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    spans = F.col("_spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda x: x["k"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda x: x["k"] < len(BASE_KINDS))
    return find_pii(docs).select(
        "doc_id",
        *[count(k) for k in BASE_KINDS],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
        F.array_max(F.transform(spans, lambda x: x["score"])).alias("max_score"),
    )
