r"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

Only DataFrame functions touch the rows.  Spark gives the matches of a
pattern (``regexp_extract_all``) and the text between them (``split``); the
running lengths of both are the positions of the matches, in code points.

Every pattern starts where its run of characters starts (or where the last
match ended) and never gives characters back, which finds the same leftmost
matches as the plain patterns in linear time.

Base kinds (email, ip, card, phone) are kept whatever their score.  The
kinds that the method adds are kept from ``ADDED_SCORE`` up: ``iban``
(mod-97 confirms it) and ``account`` (13 to 15 digits that pass Luhn beside
a word of payment).  An added span that overlaps a base span is left out.

Edge cases: a null or empty text has no spans (counts 0, ``spans`` empty,
``base_sha256`` of the empty string).  Repeated rows are each reported.  Long
texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points before a span in which a context word counts.
NEAR = 48
ADDED_SCORE = 0.6
#: Positions are summed in runs of so many matches, so that a text with very many stays linear.
RUN = 256

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A cheap test that any text with a match passes.
    gate: str
    score: float
    context: str
    bonus: float = 0.25


#: The four base patterns (made possessive) come from the contract of the query.
BASE = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "@", 0.7, "e-?mail|contact|mailto|write"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.4, r"\bip\b|address|host|server|login"),
    Kind("card", r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", 0.6, "card|visa|credit|payment|account"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.5, "phone|tel|call|mobile|fax"),
)
ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", 0.75,
         "iban|bank|account|konto|transfer"),
    Kind("account", r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", 0.25, "card|amex|credit|payment|visa", 0.5),
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check: from the right, every second digit doubled, its digits summed."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _mod97(value: Column) -> Column:
    """Whether an IBAN's number (four first signs moved to the end, letters as 10 to 35) leaves 1 modulo 97."""
    plain = F.regexp_replace(value, r"\x20", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        sign = F.substring(turned, i, F.lit(1))
        code = F.ascii(sign)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _holds(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "account":
        return F.when(F.length(digits).between(13, 15), _luhn(digits)).otherwise(False)
    if kind == "iban":
        return _mod97(value)
    return F.lit(True)


def _span(kind: Kind, text: Column, start: Column, value: Column) -> Column:
    before = F.lower(F.substring(text, F.greatest(start - NEAR, F.lit(0)) + 1, F.least(start, F.lit(NEAR))))
    score = F.lit(kind.score) + F.when(before.rlike(kind.context), kind.bonus).otherwise(0.0)
    return F.struct(F.lit(kind.name).alias("kind"), start.cast("long").alias("start"),
                    (start + F.length(value)).cast("long").alias("end"), score.alias("score"))


def _add_matches(df: DataFrame, kind: Kind, text: str) -> DataFrame:
    """A column named after the kind: the spans of its matches that hold, by start (null: none)."""
    body, hits, gaps, steps, runs = F.col(text), "_hits", "_gaps", "_steps", "_runs"
    gate = body.contains(kind.gate) if len(kind.gate) == 1 else body.rlike(kind.gate)
    df = df.withColumn(hits, F.when(gate, F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(0))))
    df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.transform(F.split(body, kind.pattern, -1), lambda g: F.length(g))))
    df = df.withColumn(steps, F.when(F.col(gaps).isNotNull(), F.transform(
        hits, lambda h, i: F.element_at(F.col(gaps), i + 1) + F.length(h))))
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    df = df.withColumn(runs, F.when(F.col(steps).isNotNull(), F.aggregate(
        F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / RUN).cast("int")), F.array(F.lit(0)),
        lambda a, r: F.concat(a, F.array(F.element_at(a, -1) + total(F.slice(F.col(steps), r * RUN + 1, F.lit(RUN))))))))

    def placed(h: Column, i: Column) -> Column:
        run = F.floor(i / RUN).cast("int")
        start = (F.element_at(F.col(runs), run + 1) + total(F.slice(F.col(steps), run * RUN + 1, i % RUN))
                 + F.element_at(F.col(gaps), i + 1))
        return F.struct(start.alias("start"), h.alias("value"))

    found = F.filter(F.transform(F.col(hits), placed), lambda s: _holds(kind.name, s["value"]))
    spans = F.transform(found, lambda s: _span(kind, body, s["start"], s["value"]))
    return df.withColumn(kind.name, F.when(F.col(runs).isNotNull(), spans)).drop(hits, gaps, steps, runs)


def find_personal_data(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``base_spans`` and ``added_spans``: arrays of (kind, start, end, score), by kind, then start.

    A column of ``df`` named like one of these two is replaced, all others stay, whatever they are called.
    """
    kept = [(i, c) for i, c in enumerate(df.columns) if c not in ("base_spans", "added_spans")]
    df = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in kept], F.col(f"`{text}`").alias("_body"))
    text = "_body"
    for kind in BASE + ADDED:
        df = _add_matches(df, kind, text)
    # as the element type stays the same, an empty array takes the place of null
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    joined = lambda kinds: F.concat(*[F.coalesce(F.col(k.name), none) for k in kinds])
    df = df.withColumn("base_spans", joined(BASE))
    free = F.filter(joined(ADDED), lambda s: (s["score"] >= ADDED_SCORE) & ~F.exists(
        "base_spans", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return df.withColumn("added_spans", free).select(*[F.col(f"c{i}").alias(c) for i, c in kept], "base_spans", "added_spans")


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask_personal_data(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every found span of the text replaced by its kind in brackets; the columns stay as they are.

    Of overlapping spans the one that starts first (then the longest) names the replacement, which
    covers them all.  A null text stays null.
    """
    names = df.columns
    held = "_masked"
    found = find_personal_data(df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                                         F.col(f"`{text}`").alias(held)), held)
    spans = F.array_sort(F.transform(
        F.concat("base_spans", "added_spans"),
        lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus"), s["kind"].alias("kind"))))

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        start, end = s["start"], -s["minus"]
        both = F.struct(last["start"].alias("start"), F.greatest(last["end"], end).alias("end"), last["kind"].alias("kind"))
        own = F.struct(start.alias("start"), end.alias("end"), s["kind"].alias("kind"))
        overlaps = F.when(F.size(done) > 0, last["end"] > start).otherwise(False)
        return F.when(overlaps, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(both))).otherwise(
            F.concat(done, F.array(own)))

    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
    found = found.withColumn("_spans", F.when(F.size(spans) > 0, F.aggregate(spans, none, merge)))
    body, merged = F.col(held), F.col("_spans")
    parts = F.transform(merged, lambda s, i: F.concat(
        F.substring(body, F.when(i > 0, F.element_at(merged, F.greatest(i, F.lit(1)))["end"]).otherwise(0).cast("int") + 1,
                    (s["start"] - F.when(i > 0, F.element_at(merged, F.greatest(i, F.lit(1)))["end"]).otherwise(0)).cast("int")),
        F.lit("["), F.upper(s["kind"]), F.lit("]")))
    tail = F.substring(body, F.element_at(merged, -1)["end"].cast("int") + 1, F.length(body))
    clean = F.when(merged.isNull(), body).otherwise(F.concat(F.array_join(parts, ""), tail))
    return found.select(*[(clean if c == text else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)])
