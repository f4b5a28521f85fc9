"""Personal data: patterns propose spans, checksums confirm them, context words score them.

All of it is column expressions. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.tables import set_aside, without

# Kinds in the order that breaks ties, their patterns, context words.
# A match may start only where the kind's own run starts or the last match ended, which
# any leftmost match does; so a long run is scanned once. Possessive repeats never give
# a character back that a later part of the pattern could use.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:\.|$)){4}$"
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|address|host|server|login|adresse",
    "card": "card|visa|mastercard|credit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|whatsapp|telefon",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security|tax",
}
AGAINST = "version|release|build|order|invoice|isbn|serial"


@dataclass(frozen=True)
class Kind:
    """``prior`` is the score of a confirmed match without context; ``base`` kinds are
    returned whatever their score."""

    name: str
    pattern: str
    confirm: object
    prior: float
    base: bool
    needs: str | None = None


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    """The remainder of an account number: first four characters moved to the end,
    letters read as 10 to 35."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    step = lambda acc, c: F.when(
        c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97
    ).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c)))


KINDS = (
    Kind("email", EMAIL, lambda m: F.lit(True), 0.9, True, "@"),
    Kind("ip", IP, lambda m: m.rlike(IP_PARTS), 0.7, True),
    Kind(
        "card",
        CARD,
        lambda m: F.length(_digits(m)).between(14, 19) & F.call_function("luhn_check", _digits(m)),
        0.8,
        True,
    ),
    Kind("phone", PHONE, lambda m: F.length(_digits(m)).between(10, 15), 0.7, True, "+"),
    Kind(
        "iban",
        IBAN,
        lambda m: F.length(F.regexp_replace(m, " ", "")).between(15, 34) & (_mod97(m) == 1),
        0.8,
        False,
    ),
    Kind("ssn", SSN, lambda m: ~m.rlike("^(000|666|9)|-00-|-0000$"), 0.3, False, "-"),
)
#: Matches whose positions are summed in one go; longer lists are summed run by run.
RUN = 512


def _places(gaps: Column, matches: Column) -> Column:
    """``array<struct<start, end>>`` of matches that lie between the gaps."""

    def run(first: Column, at: Column) -> Column:
        """Places of up to RUN matches from number ``first`` on, with ``at`` before them."""
        return F.aggregate(
            F.sequence(first, F.least(first + RUN - 1, F.size(matches))),
            F.struct(at.alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")),
            lambda acc, i: _step(acc, i),
            lambda acc: acc["out"],
        )

    def _step(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(F.element_at(gaps, i))
        end = start + F.length(F.element_at(matches, i))
        place = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(place)).alias("out"))

    firsts = F.sequence(F.lit(1), F.size(matches), F.lit(RUN))
    lengths = F.transform(
        firsts,
        lambda f: F.aggregate(
            F.sequence(f, F.least(f + RUN - 1, F.size(matches))),
            F.lit(0),
            lambda acc, i: acc
            + F.length(F.element_at(gaps, i))
            + F.length(F.element_at(matches, i)),
        ),
    )
    before = F.aggregate(
        lengths,
        F.array(F.lit(0)),
        lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)),
    )
    runs = F.zip_with(
        firsts, F.slice(before, 1, F.size(firsts)), lambda f, at: F.struct(f.alias("f"), at.alias("at"))
    )
    return F.flatten(F.transform(runs, lambda r: run(r["f"], r["at"])))


def _candidates(text: Column, kind: Kind) -> Column:
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    if kind.needs:
        found = F.when(F.contains(text, F.lit(kind.needs)), found).otherwise(
            F.array().cast("array<string>")
        )
    return found


def _spans(
    text: Column, matches: Column, gaps: Column, kind: Kind, rank: int, window: int
) -> Column:
    """Confirmed matches of a kind as structs that sort by start, then by kind."""
    places = _places(gaps, matches)

    def span(m: Column, p: Column) -> Column:
        first = F.greatest(p["start"] - window, F.lit(0))
        before = F.lower(text.substr(first + 1, p["start"] - first))
        near = F.concat_ws(" ", before, F.lower(text.substr(p["end"] + 1, F.lit(window))))
        score = (
            F.lit(kind.prior)
            + F.when(near.rlike(rf"\b(?:{CONTEXT[kind.name]})"), 0.3).otherwise(0.0)
            - F.when(before.rlike(rf"\b(?:{AGAINST})"), 0.2).otherwise(0.0)
        )
        return F.struct(
            p["start"].alias("start"),
            F.lit(rank).alias("rank"),
            p["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            F.round(F.least(score, F.lit(1.0)), 2).alias("score"),
            kind.confirm(m).alias("confirmed"),
        )

    spans = F.zip_with(matches, places, span)
    return F.filter(spans, lambda s: s["confirmed"])


def personal_data(docs: DataFrame, least_score: float = 0.5, window: int = 40) -> DataFrame:
    """``docs`` with ``personal_data``, an array of spans in order of place, then kind.

    A span has ``start, rank, end, kind, score, confirmed``. Emails, addresses of hosts,
    card numbers that pass the Luhn sum and phone numbers are always returned; account
    numbers that pass mod 97 and social security numbers only from ``least_score`` on,
    which context words within ``window`` characters raise and some before it lower. Matches of one kind
    do not overlap; those of different kinds may. Null and empty texts have no spans;
    repeated rows are treated alike; all other columns stay as they are.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast(
        "array<struct<start:int,rank:int,end:int,kind:string,score:double,confirmed:boolean>>"
    )
    own, back = set_aside(without(docs, "personal_data"), "text")
    work = own.select("*", text.alias("__text"))
    work = work.select(
        "*", *[_candidates(F.col("__text"), k).alias(f"__{k.name}") for k in KINDS]
    )
    # What lies between the matches; a column of its own, so that it is made once.
    work = work.select(
        "*",
        *[
            F.when(F.size(f"__{k.name}") > 0, F.split("__text", k.pattern, -1)).alias(f"__{k.name}_gaps")
            for k in KINDS
        ],
    )
    parts = []
    for rank, kind in enumerate(KINDS):
        matches, gaps = F.col(f"__{kind.name}"), F.col(f"__{kind.name}_gaps")
        spans = _spans(F.col("__text"), matches, gaps, kind, rank, window)
        if not kind.base:
            spans = F.filter(spans, lambda s: s["score"] >= least_score)
        parts.append(F.when(F.size(matches) > 0, spans).otherwise(none))
    found = F.sort_array(F.concat(*parts))
    return work.select(*back.values(), found.alias("personal_data"))


def masked(docs: DataFrame) -> DataFrame:
    """``text`` with each span of :func:`personal_data` replaced by its kind in brackets.

    Spans that overlap an earlier one are covered by the earlier one's mark.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.concat(
            acc["out"],
            text.substr(acc["at"] + 1, s["start"] - acc["at"]),
            F.concat(F.lit("["), s["kind"], F.lit("]")),
        )
        apart = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(apart, kept).otherwise(acc["out"]).alias("out"),
        )

    done = F.aggregate(F.col("personal_data"), state, step)
    whole = F.concat(done["out"], text.substr(done["at"] + 1, F.length(text)))
    return docs.withColumn("text", whole)


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and text forms of the spans of :func:`personal_data`."""
    spans = F.col("personal_data")
    base = F.filter(spans, lambda s: s["rank"] < 4)

    def count(kind: Kind) -> Column:
        own = F.filter(spans, lambda s: s["kind"] == kind.name)
        return F.size(own).cast("long").alias(f"n_{kind.name}")

    counts = [count(kind) for kind in KINDS if kind.base]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(spans).alias("spans"),
    )
