"""Personal data: patterns propose spans, checksums confirm them, context adjusts scores.

Only DataFrame functions: a pattern cuts a text into its matches and the gaps between
them, and the running lengths of both give every span in code points.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import texts

SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double,match:string>>"

#: Code points before and after a span that are searched for context words.
NEAR = 40
#: So many gaps and matches behind a match cover ``NEAR``: no match has under 4 code points.
NEXT = 10
#: Values that are added up one by one; runs of them are then added up likewise.
RUN = 128
#: Code points of a slice of a text that parts are cut from.
SLICE = 1024
#: An added span is reported from this score on; base spans always are.
REPORTED = 0.5
#: What a context word nearby adds to a score.
CONTEXT = 0.3


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """The digits' weighted sum, every second one from the right doubled, ends in 0."""
    number = F.reverse(_digits(match))
    weighed = F.transform(
        F.sequence(F.lit(1), F.length(number)),
        lambda i: F.when(i % 2 == 1, _at(number, i)).otherwise(
            2 * _at(number, i) - F.when(_at(number, i) > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(weighed, F.lit(0), lambda total, x: total + x) % 10 == 0


def _at(number: Column, i: Column) -> Column:
    return F.substring(number, i, F.lit(1)).cast("int")


def mod97(match: Column) -> Column:
    """The first four characters moved behind the rest, letters as 10 to 35: 1 modulo 97."""
    moved = F.concat(F.substring(match, F.lit(5), F.length(match)), F.substring(match, 1, 4))
    values = F.transform(
        F.sequence(F.lit(1), F.length(moved)),
        lambda i: F.instr(
            F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substring(moved, i, F.lit(1))
        )
        - 1,
    )
    left = F.aggregate(
        values, F.lit(0), lambda rest, x: (rest * F.when(x > 9, 100).otherwise(10) + x) % 97
    )
    return left == 1


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes (leftmost, non-overlapping); ``holds`` confirms a match;
    ``hint`` is a piece of text without which there is no match."""

    name: str
    pattern: str
    holds: Callable[[Column], Column]
    score: float
    context: str
    hint: str | None = None
    #: What of a match is the span, NULL if nothing; the whole match by default.
    cut: Callable[[Column], Column] | None = None
    #: Kind of its spans, by default ``name``.
    label: str | None = None


def _between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda match: F.length(_digits(match)).between(low, high)


def _iban(match: Column) -> Column:
    bare = F.translate(match, " ", "")
    return F.length(bare).between(15, 34) & mod97(bare)


def _groups(match: Column) -> Column:
    """The longest beginning of whole groups that is an IBAN."""
    groups = F.split(match, " ")
    beginnings = F.transform(
        F.sequence(F.size(groups), F.lit(3), F.lit(-1)),
        lambda n: F.array_join(F.slice(groups, F.lit(1), n), " "),
    )
    return F.get(F.filter(beginnings, _iban), 0)


# Possessive repeats and the look-behinds change no match: they only stop Java's matcher
# from trying every start and every length of a long run, and from recursing into it.
BASE = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda match: F.lit(True),
        0.9,
        "mail|contact|write",
        "@",
    ),
    Kind(
        "ip",
        r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
        lambda match: match.rlike(
            r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})(?:\.|$)){4}$"
        ),
        0.5,
        "ip|host|server|address|login",
        ".",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?+[0-9]){15,}+",
        lambda match: F.length(_digits(match)).between(16, 19) & luhn(match),
        0.6,
        "card|credit|visa|pay",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        _between(8, 15),
        0.6,
        "phone|tel|call|fax|mobile",
        "+",
    ),
)
ADDED = (
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}[A-Z0-9]++",
        _iban,
        0.8,
        "iban|account|bank",
    ),
    Kind(
        "ssn",
        r"(?:(?<![0-9])|\G)[0-9]++-[0-9]++-[0-9]++",
        lambda match: match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        0.3,
        "ssn|social|security",
        "-",
    ),
)
#: IBANs as they are printed, in groups of four; their spans are of the kind iban.
PRINTED = Kind(
    "iban_printed",
    r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20[A-Z0-9]{4}(?![A-Z0-9])){2,7}(?:\x20[A-Z0-9]{1,3}(?![A-Z0-9]))?",
    _iban,
    0.8,
    "iban|account|bank",
    cut=_groups,
    label="iban",
)


def _proposed(kind: Kind) -> Column:
    """Struct of the matches and of the gaps around them (one more), NULL without a match."""
    found = F.struct(
        F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0)).alias("matches"),
        F.split("text", kind.pattern, -1).alias("gaps"),
    )
    there = F.col("text").rlike(kind.pattern)
    if kind.hint:
        there = F.col("text").contains(kind.hint) & there
    return F.when(there, found)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What ``step`` makes, from 0 on, of all values before each one.  Appending copies an
    array, so it is done within runs and for the runs' results."""

    def through(array: Column) -> Column:
        return F.aggregate(
            array,
            F.array(F.lit(0).cast("long")),
            lambda done, x: F.array_append(done, step(F.element_at(done, -1), x)),
        )

    last = F.floor((F.size(values) - 1) / RUN).cast("int")
    runs = F.transform(
        F.sequence(F.lit(0), last), lambda r: through(F.slice(values, r * RUN + 1, F.lit(RUN)))
    )
    return _let(
        runs,
        lambda runs: _let(
            through(F.transform(runs, lambda run: F.element_at(run, -1))),
            lambda firsts: F.flatten(
                F.transform(
                    runs,
                    lambda run, r: F.transform(
                        F.slice(run, F.lit(1), F.size(run) - 1),
                        lambda x: step(F.get(firsts, r), x),
                    ),
                )
            ),
        ),
    )


def _confirmed(kind: Kind, always: bool) -> Column:
    """Spans of the matches that hold, with their scores."""
    matches, gaps = F.col(f"{kind.name}.matches"), F.col(f"{kind.name}.gaps")

    def piece(array: Column, j: Column, side: Callable) -> Column:
        return side(F.coalesce(F.get(array, j), F.lit("")), F.lit(NEAR))

    def around(first: Column, last: Column, side: Callable) -> Column:
        return F.array_join(
            F.transform(
                F.sequence(first, last),
                lambda j: F.concat(piece(gaps, j, side), piece(matches, j, side)),
            ),
            "",
        )

    def span(i: Column, at: Column, match: Column) -> Column:
        whole = F.get(matches, i)
        start = F.get(at, i) + F.length(F.get(gaps, i))
        left = F.substring(whole, F.length(match) + 1, F.length(whole))
        before = F.concat(around(i - NEXT, i - 1, F.right), piece(gaps, i, F.right))
        after = F.concat(left, around(i + 1, i + NEXT, F.left))
        near = F.lower(F.right(before, F.lit(NEAR))).rlike(kind.context)
        near = near | F.lower(F.left(after, F.lit(NEAR))).rlike(kind.context)
        return F.struct(
            F.lit(kind.label or kind.name).alias("kind"),
            start.alias("start"),
            (start + F.length(match)).alias("end"),
            F.when(near, kind.score + CONTEXT).otherwise(kind.score).alias("score"),
            match.alias("match"),
        )

    def cut(i: Column) -> Column:
        whole = F.get(matches, i)
        match = kind.cut(whole) if kind.cut else whole
        return F.when(F.coalesce(kind.holds(match), F.lit(False)), match)

    def spans(at: Column) -> Column:
        cuts = F.transform(
            F.sequence(F.lit(0), F.size(matches) - 1),
            lambda i: F.struct(i.alias("i"), cut(i).alias("match")),
        )
        held = F.filter(cuts, lambda c: c["match"].isNotNull())
        return F.transform(held, lambda c: span(c["i"], at, c["match"]))

    lengths = F.transform(
        matches, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("long")
    )
    found = _let(
        lengths, lambda lengths: _let(_before(lengths, lambda total, x: total + x), spans)
    )
    if not always:
        found = F.filter(found, lambda s: s["score"] >= REPORTED)
    nothing = F.from_json(F.lit("[]"), SPAN)
    return F.when(F.col(kind.name).isNotNull(), found.cast(SPAN)).otherwise(nothing)


def _with_spans(read: DataFrame) -> DataFrame:
    """``read`` (text and columns named row and raw) with the spans of every kind."""
    kinds = [*BASE, *ADDED, PRINTED]
    proposed = read.select("*", *(_proposed(k).alias(k.name) for k in kinds))
    confirmed = proposed.select(
        *read.columns, *(_confirmed(k, k in BASE).alias(k.name) for k in kinds)
    )
    both = F.array_sort(F.concat("iban", PRINTED.name))
    return confirmed.withColumn("iban", both).drop(PRINTED.name)


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, text and one column of spans per kind (email, ip, card, phone, iban, ssn).

    Base kinds keep every match their check confirms; an IBAN (one run, or groups of four)
    needs its checksum, and a social security number a context word within ``NEAR`` code
    points before or after it, whatever numbers lie between.  Spans
    count code points, ends exclusive, and are ordered by start.  A null or empty text
    has empty arrays; repeated rows are searched each for itself; other columns are left;
    no rows give no rows.
    """
    return _with_spans(texts(docs))


def redact_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by its kind in brackets, and n_chars (if it is
    a column) as the new text has it.  A null text stays null."""
    others = [c for c in docs.columns if c != "text"]
    read = docs.select(
        F.struct(*others).alias("row"),
        F.col("text").alias("raw"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    clean = _with_spans(read).select(
        "row", F.when(F.col("raw").isNotNull(), redacted()).alias("text")
    )
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return clean.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def _joined(kinds: tuple[Kind, ...]) -> Column:
    spans = F.concat(*(F.col(k.name) for k in kinds))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def digest_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    found = find_pii(docs)
    return found.select(
        "doc_id",
        *(F.size(k.name).cast("long").alias(f"n_{k.name}") for k in BASE),
        F.sha2(_joined(BASE), 256).alias("base_sha256"),
        _joined(BASE + ADDED).alias("spans"),
    )


def redacted() -> Column:
    """The text with every span of ``find_pii`` replaced by its kind in brackets.

    Spans of different kinds may overlap; what any span covers goes, once, under the
    kind of the span that starts first, the longest of these.
    """
    kinds = (*BASE, *ADDED)
    spans = F.array_sort(
        F.concat(
            *(
                F.transform(
                    k.name,
                    lambda s, rank=rank: F.struct(
                        s["start"].alias("start"), (-s["end"]).alias("back"),
                        F.lit(rank).alias("rank"), s["kind"].alias("kind"),
                    ),
                )
                for rank, k in enumerate(kinds)
            )
        )
    )
    return F.when(F.size(spans) == 0, F.col("text")).otherwise(_let(spans, _replaced))


def _replaced(spans: Column) -> Column:
    text = F.col("text")
    slices = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SLICE}}}"), F.lit(0))
    ends = F.transform(spans, lambda s: -s["back"])

    def part(slices: Column, start: Column, end: Column) -> Column:
        """Code points from start to end, of the slices that hold them."""
        first = F.floor(start / SLICE).cast("int")
        count = F.floor((end - 1) / SLICE).cast("int") - first + 1
        held = F.array_join(F.slice(slices, first + 1, count), "")
        inside = F.substring(held, (start % SLICE + 1).cast("int"), (end - start).cast("int"))
        return F.when(end > start, inside).otherwise("")

    def joined(slices: Column, at: Column) -> Column:
        parts = F.transform(
            spans,
            lambda s, i: F.when(
                s["start"] >= F.get(at, i),
                F.concat(part(slices, F.get(at, i), s["start"]), F.lit("["), s["kind"], F.lit("]")),
            ).otherwise(""),
        )
        rest = part(slices, F.array_max(ends), F.length(text).cast("long"))
        return F.concat(F.array_join(parts, ""), rest)

    return _let(
        slices,
        lambda slices: _let(
            ends, lambda ends: _let(_before(ends, F.greatest), lambda at: joined(slices, at))
        ),
    )
