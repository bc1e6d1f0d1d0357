"""Personal data in texts, with SQL functions only.

Regular expressions propose spans, checksums (Luhn, mod 97) confirm them and
words nearby adjust a score; see :func:`personal_data`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns are possessive where nothing that follows could use what they give
# back, and start only where a run starts (or the last match ended), so a very
# long run of letters or digits is read once.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Characters of an IBAN by country. A blank and a capital may follow one, so the length ends it.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_LISTED = "(?:" + "|".join(c for n in _IBAN_LENGTHS.values() for c in n.split()) + ")[0-9]{2}"
_IBAN = (
    r"(?=[A-Z]{2}[0-9]{2})(?<![A-Za-z0-9])(?:(?:" + "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in _IBAN_LENGTHS.items())
    + rf")(?![A-Za-z0-9])|(?!{_LISTED})[A-Z]{{2}}[0-9]{{2}}(?:(?!\x20{_LISTED})\x20?[A-Z0-9]){{11,30}})"
)
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

#: Code points on either side of a span that are searched for context words.
WINDOW = 40


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``hint``: a character every match contains; texts without it are skipped.
    ``valid``: name of the checksum or range test. ``alone``: characters that
    may not touch a span. ``score`` is raised by
    ``boost`` where a context word is near and lowered by ``doubt`` where a word
    of ``against`` is; a span stays at ``keep`` or more (base kinds always).
    Context ends at neighbouring matches of the kind, unless ``past`` them.
    """

    name: str
    pattern: str
    hint: str
    valid: str | None = None
    score: float = 0.5
    boost: float = 0.3
    doubt: float = 0.2
    keep: float = 0.0
    words: tuple[str, ...] = field(default=())
    against: tuple[str, ...] = field(default=())
    alone: str | None = None
    past: bool = False


BASE = ("email", "ip", "card", "phone")
KINDS = (
    Kind("email", _EMAIL, "@", None, 0.9, 0.1, 0.0, 0.0, ("mail", "contact", "write to")),
    Kind("ip", _IP, ".", "ip", 0.6, 0.3, 0.2, 0.0, ("ip", "address", "host", "server", "login"), ("version", "release", "section")),
    Kind("card", _CARD, "", "luhn", 0.7, 0.3, 0.2, 0.0, ("card", "visa", "credit", "karte", "carte", "tarjeta", "payment"), ("isbn", "order", "serial")),
    Kind("phone", _PHONE, "+", "phone", 0.7, 0.3, 0.1, 0.0, ("phone", "call", "tel", "fax", "mobile", "whatsapp"), ("version",)),
    # Beyond the base kinds: an IBAN is proven by mod 97; a social security number needs a word nearby.
    Kind("iban", _IBAN, "", "mod97", 0.8, 0.2, 0.2, 0.5, ("iban", "bank", "account", "konto", "compte", "cuenta"), ("serial",), "[A-Za-z0-9]"),
    Kind("ssn", _SSN, "-", "ssn", 0.3, 0.4, 0.2, 0.5, ("ssn", "social security", "sozialversicherung"), ("order", "serial", "part"), "[0-9-]", True),
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Digits doubled at every second place from the right, their digit sums added: a multiple of ten."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int"))),
        F.lit(0),
        lambda acc, d: acc + d,
    )
    return total % 10 == 0


def _mod97(value: Column) -> Column:
    """Country and check digits to the end, letters as 10 to 35: remainder 1 by 97."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0))) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def _valid(kind: str | None, value: Column) -> Column:
    if kind == "ip":
        parts = F.split(value, r"\.")
        short = F.transform(parts, lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(short, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "luhn":
        digits = _digits(value)
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "mod97":
        return _mod97(value)
    if kind == "ssn":
        return ~value.rlike("^(000|666|9[0-9]{2})|-00-|-0000$")
    return F.lit(True)


def _alone(kind: Kind, before: Column, after: Column) -> Column:
    if kind.alone is None:
        return F.lit(True)
    return ~(F.right(before, F.lit(1)).rlike(kind.alone) | F.left(after, F.lit(1)).rlike(kind.alone))


def _score(kind: Kind, before: Column, after: Column) -> Column:
    """The kind's score, adjusted by the words around a span."""
    near = F.lower(F.concat(before, F.lit(" \n "), after))
    score = F.lit(kind.score)
    if kind.words:
        score = score + F.when(near.rlike(r"(?<![\p{L}])(" + "|".join(kind.words) + ")"), kind.boost).otherwise(0.0)
    if kind.against:
        score = score - F.when(near.rlike(r"(?<![\p{L}])(" + "|".join(kind.against) + ")"), kind.doubt).otherwise(0.0)
    return F.round(score, 2)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(text: Column, kind: Kind) -> Column:
    """``array<struct<kind, start, end, score>>`` of the kept spans of one kind, in order.

    A text split at the pattern gives the gaps, extracting the pattern the
    matches between them, so offsets are running sums of their lengths: two
    passes over the text, whatever the number of matches, and none where the
    kind's hint is missing or nothing matches.
    """

    def context(gaps: Column, m: Column, e: Column, i: Column) -> tuple[Column, Column]:
        if not kind.past:
            return F.right(F.get(gaps, i), F.lit(WINDOW)), F.left(F.get(gaps, i + 1), F.lit(WINDOW))
        start = F.get(e, i) - F.length(m)
        low = F.greatest(start - WINDOW, F.lit(0))
        return F.substring(text, low + 1, start - low), F.substring(text, F.get(e, i) + 1, F.lit(WINDOW))

    def placed(matches: Column) -> Column:
        return _let(F.split(text, kind.pattern, -1), lambda gaps: _let(ends(gaps, matches), lambda e: F.filter(
            F.transform(matches, lambda m, i: F.struct(
                F.lit(kind.name).alias("kind"),
                (F.get(e, i) - F.length(m)).alias("start"),
                F.get(e, i).alias("end"),
                F.when(
                    _valid(kind.valid, m) & _alone(kind, F.get(gaps, i), F.get(gaps, i + 1)),
                    _score(kind, *context(gaps, m, e, i)),
                ).otherwise(-1.0).alias("score"),
            )),
            lambda r: r["score"] >= kind.keep,
        )))

    def ends(gaps: Column, matches: Column) -> Column:
        lengths = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m))
        return F.aggregate(
            lengths,
            F.array().cast("array<int>"),
            lambda acc, n: F.concat(acc, F.array(n + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)))),
        )

    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    if kind.hint:
        matches = F.when(text.contains(kind.hint), matches)
    nothing = F.array().cast(SPANS)
    return _let(matches, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(nothing))


def spans_of(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """All kinds' spans of a text; none for a null."""
    return F.concat(*[_spans(F.coalesce(text, F.lit("")), k) for k in kinds])


def personal_data(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``(doc_id, text, spans)``: the personal data in every whole text of ``docs(doc_id, text)``.

    ``spans`` is an array of ``(kind, start, end, score)`` in code points, end
    exclusive, by kind as listed and then by start. A regular expression
    proposes leftmost, non-overlapping matches of each kind; checksums or ranges
    (Luhn, mod 97, parts of an address) confirm them; words within 40 code
    points raise or lower the score. Base kinds (email, ip, card, phone) stay
    once confirmed; further ones at their kind's least score. Spans of different
    kinds may overlap.

    No shuffle, no Python: one projection over the texts. A null or empty text
    has no span; repeated rows and null ids are carried through; other columns
    are ignored; an empty table gives no rows.
    """
    return docs.select("doc_id", "text", spans_of(F.col("text"), kinds).alias("spans"))


def n_spans(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the spans (of some kinds), comma-joined."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans become one mask."""

    def rebuilt(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        done = F.aggregate(
            ordered,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
            lambda acc, s: F.when(
                s["start"] >= acc["at"],
                F.struct(s["end"].alias("at"), F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("parts")),
            ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts"))),
        )
        return _let(done, lambda d: F.concat(F.array_join(d["parts"], ""), F.substring(text, d["at"] + 1, F.length(text))))

    return _let(spans, lambda found: F.when(F.size(found) > 0, rebuilt(found)).otherwise(text))
