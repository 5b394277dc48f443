"""Column functions on text: dates and amounts in prose, markup, labels, addresses on the web.

All but :func:`unescape` and :func:`json_after` are built-in expressions and stay in generated code. Functions that use
an array more than once take a column of its own for it (see :func:`with_dates`), since an expression inside a lambda is
evaluated anew for each element.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# English month names as the sources write them, besides the whole names; and the ends of ordinals.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_REST = ("uary", "ruary", "ch", "il", "", "e", "y", "ust", "tember", "ober", "ember", "ember")
_WRITTEN = [*(m + r for m, r in zip(MONTHS, _REST)), *MONTHS, "sept"]
_ORDINALS = ("st", "nd", "rd", "th")

#: What looks like a date: three numbers of which one end has four digits, or a word that begins as a month does between
#: or before a day and a year. Whether it is one is for :func:`date_of` to say.
_DAY = rf"\d{{1,2}}(?:{'|'.join(_ORDINALS)})?"
_WORD = rf"(?:{'|'.join(MONTHS)})[a-z]{{0,6}}\.?"
ANY_DATE = "(?i)(" + "|".join((r"\b\d{4}(?:[-/]\d{1,2}){2}\b", r"\b(?:\d{1,2}/){2}\d{4}\b", rf"\b{_WORD}\s+{_DAY},?\s+\d{{4}}\b", rf"\b{_DAY}\s+{_WORD},?\s+\d{{4}}\b")) + ")"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def date_of(written: Column) -> Column:
    """The date that one written date stands for; NULL for a day its month doesn't have, another century or no month's word.

    Year first and then month and day, or month, day and year; with a word, the day is before or after it and the year last.
    """
    known = F.array(*(F.lit(w) for w in _WRITTEN))
    months = F.array(*(F.lit(i % 12 + 1 if i < 24 else 9) for i in range(len(_WRITTEN))))

    def day(text: Column, form: str) -> Column:
        return F.to_date(F.try_to_timestamp(text, F.lit(form)))

    def worded(parts: Column) -> Column:
        first, second, year = (F.get(parts, F.lit(i)) for i in range(3))
        ahead = first.rlike(r"^\d")
        place = F.array_position(known, F.when(ahead, second).otherwise(first)).cast("int")
        return F.when((place > 0) & year.startswith("20"), day(F.concat_ws("-", year, F.get(months, place - 1).cast("string"), F.when(ahead, first).otherwise(second)), "yyyy-M-d"))

    def read(low: Column) -> Column:
        words = F.split(F.regexp_replace(low, rf"(?<=\d)(?:{'|'.join(_ORDINALS)})|[.,]", ""), r"\s+")
        return (
            F.when(low.rlike("[a-z]"), bound(words, worded))
            .when(low.rlike(r"^20\d\d[-/]"), day(F.translate(low, "/", "-"), "yyyy-M-d"))
            .when(low.rlike("/20\\d\\d$"), day(low, "M/d/yyyy"))
        )

    return bound(F.lower(written), read)


def find_dates(text: Column) -> Column:
    """``array<date>``: every valid date written in ``text``, in reading order; [] if there are none, NULL for NULL."""
    found = F.transform(F.regexp_extract_all(text, F.lit(ANY_DATE), 1), lambda w: date_of(w))
    return F.filter(found, lambda d: d.isNotNull())


def with_dates(df: DataFrame, text: str, out: str = "dates") -> DataFrame:
    return df.withColumn(out, find_dates(F.col(f"`{text}`")))


def first_date(text: Column) -> Column:
    """The first valid date in ``text``, or NULL."""
    return F.get(find_dates(text), F.lit(0))


#: Runs of digits, dots and commas, with the character before and the one after.
_NUMBER_LIKE = r"(?s)(?:^|[^\d.,])[.,]*[\d.,]*\d[\d.,]*.?"


def amount_in(text: Column) -> Column:
    """The first amount in ``text`` as a double. NULL if the text holds a date, or no number of at most three digits or with groups or decimals.

    What a dash or slash joins to its neighbours is no amount, nor is a run of digits, dots and commas that isn't one
    number as a whole, but for dots and commas that end it.
    """

    def number(piece: Column) -> Column:
        digits = F.regexp_replace(F.regexp_extract(piece, r"([\d.,]*\d)", 1), r"^,+", "")
        joined = piece.rlike(r"^[-/]|[-/]$")
        whole = digits.rlike(r"^(\d{1,3}(,\d{3})*(\.\d+)?|\d*\.\d+)$")
        return F.when(~joined & whole, F.replace(digits, F.lit(","), F.lit("")).try_cast("double"))

    found = F.filter(F.transform(F.regexp_extract_all(text, F.lit(f"({_NUMBER_LIKE})"), 1), number), lambda n: n.isNotNull())
    return F.when(first_date(text).isNull(), F.get(found, F.lit(0)))


def plain_amount(text: Column) -> Column:
    """A cell with dollar signs and thousands commas as a double; 0 for anything else."""
    return F.coalesce(F.trim(F.regexp_replace(text, r"[$,]", "")).try_cast("double"), F.lit(0.0))


def without_tags(markup: Column) -> Column:
    """Text without tags, white space of any kind collapsed to single blanks. Entities stay as they are."""
    return F.trim(F.regexp_replace(F.regexp_replace(markup, r"<[^>]+>", " "), r"(?U)\s+", " "))


def spaced_key(key: Column) -> Column:
    """A field name as words: ``exDividendDate`` and ``ex_dividend-date`` become ``ex dividend date``."""
    return F.trim(F.lower(F.translate(F.regexp_replace(key, r"(?<=[a-z])(?=[A-Z])", " "), "_-", "  ")))


def truncated(text: Column, size: int) -> Column:
    return F.substring(text, 1, size)


def host(url: Column) -> Column:
    """Host of a URL in lower case without ``www.``; NULL if it has none."""
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", "")


def host_suffixes(name: Column) -> Column:
    """``array<string>``: the host and each domain above it, so that "ends with a domain" is an equi-join."""
    labels = F.split(name, r"\.")
    return F.when(F.length(name) > 0, F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def padded_id(number: Column, size: int = 10) -> Column:
    return F.lpad(number, size, "0")


def bare_id(number: Column) -> Column:
    """Without leading zeros; '0' if nothing else is left."""
    return F.coalesce(F.nullif(F.regexp_replace(number, r"^0+", ""), F.lit("")), F.when(number.isNotNull(), F.lit("0")))


def sentences(text: Column) -> Column:
    """``array<string>``: text cut after full stops, question and exclamation marks."""
    return F.split(text, r"(?<=[.!?])\s+")


def labelled(text: Column, label: str, reach: int = 40) -> Column:
    """The first date within ``reach`` characters after ``label`` (a pattern), if it stands right after it."""
    return first_date(F.regexp_extract(text, rf"(?is){label}\s*[:\-]?\s*(.{{0,{reach}}})", 1))


# The labels under which schedules and notices give their dates; a tilde is a blank, a dash or nothing.
DATE_LABELS = {
    "declaration": ["declaration date", "declared on", "date declared", "declared :"],
    "ex": ["ex~date", "ex~dividend date", "ex~distribution date"],
    "record": ["record date", *(f"{who} of record{when}" for who in ("holders", "unitholders", "shareholders") for when in (" on", " at the close of business on", " as of", ""))],
    "payable": ["payable date", "payable on", "payment date", "pay date", "paid on", "payable"],
}
# Verbs by which prose tells of a declaration, words of other dates that may follow them; cities of datelines.
DECLARING = ("announce", "announces", "announced", "declare", "declares", "declared")
OF_OTHER_DATES = ("payable", "paid", "record", "ex-")
CITIES = ("Toronto", "Montreal", "Vancouver", "Calgary", "New York", "Boston", "Chicago", "Malvern", "Valley Forge", "San Francisco", "Newport Beach")


def phrases(wanted: list[str] | tuple[str, ...]) -> str:
    """A pattern of any of these phrases, longer ones first, whatever the white space between their words."""

    def one(phrase: str) -> str:
        marks = {" ": r"\s+", "~": r"[-\s]?"}
        return "".join(marks.get(ch, re.escape(ch)) for ch in phrase).replace(r"\s+:", r"\s*:")

    return "(?:" + "|".join(one(p) for p in sorted(wanted, key=lambda p: -len(p))) + ")"


def labelled_dates(text: Column) -> dict[str, Column]:
    """A date column per kind of :data:`DATE_LABELS`; a date only ever counts for the label it follows.

    Without a labelled one, the declaration date is that after "on", in the sentence of the first verb of DECLARING that
    has one within 80 characters with no word of OF_OTHER_DATES before it. Only "ex-" is taken for the ex-date's word, so
    "announces distributions ... went ex on" gives the ex-date.
    """
    out = {kind: labelled(text, phrases(label)) for kind, label in DATE_LABELS.items()}
    pieces = F.split(text, rf"(?i)\b{phrases(DECLARING)}\b")
    told = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: F.struct(F.regexp_extract(p, r"(?is)^(.{0,80}?)\bon\s", 1).alias("head"), F.regexp_extract(p, r"(?is)^.{0,80}?\bon\s+([^\n]{1,30})", 1).alias("then")))
    own = F.filter(told, lambda t: (t["then"] != "") & ~t["head"].rlike(rf"(?i){phrases(OF_OTHER_DATES)}|\.(?!\d)"))
    return out | {"declaration": F.coalesce(out["declaration"], first_date(F.get(own, F.lit(0))["then"]))}


def dateline(text: Column) -> Column:
    """The date of a text's first dateline: a city in capitals, at most 42 characters without a digit, a comma, the date. NULL if there is none."""
    after = F.regexp_extract(text, rf"{phrases([c.upper() for c in CITIES])}([^\n]{{0,72}})", 1)
    # up to the last comma before a digit or, in "June 18, 2026", before its month
    rest = F.regexp_extract(after, r"^\D{0,42},\s*(\S.*)$", 1)
    return F.when(rest.rlike("^" + ANY_DATE), first_date(rest))


def labelled_amount(text: Column, label: str) -> Column:
    """The first number with decimals after ``label`` (a pattern), if it is the first number there and within 40 characters, as a double."""
    after = F.regexp_extract_all(text, F.lit(rf"(?is)(?:{label})(.{{0,80}})"), 1)
    number = F.transform(after, lambda a: F.regexp_extract(a, r"(?s)^\D{0,42}?(\d[\d.]*)", 1))
    return F.regexp_extract(F.get(F.filter(number, lambda n: n.rlike(r"^\d+\.\d")), F.lit(0)), r"^(\d+\.\d+)", 1).try_cast("double")


# Words of sentences on payouts, and of those on fees and sales.
PAYOUT_WORDS = r"(?i)dividend|distribution|capital\s*gain"
FEE_WORDS = r"(?i)12b-1|service\s+fee|distribution\s+plan|sales\s+and\s+distribution"


def payout_sentence(text: Column, since: Column | None = None, until: Column | None = None) -> Column:
    """struct(event_date, amount, snippet) of the first sentence on a payout that has a date, its first; NULL if there is none.

    ``since``, ``until``: the days between which that date must be. The amount is the first one with a dollar sign and
    decimals, or NULL; the snippet has 300 characters at most.
    """
    on_payouts = F.filter(sentences(text), lambda s: s.rlike(PAYOUT_WORDS) & ~s.rlike(FEE_WORDS))
    read = F.transform(on_payouts, lambda s: F.struct(first_date(s).alias("event_date"), F.regexp_extract(s, r"\$\s*([0-9]+\.[0-9]+)", 1).try_cast("double").alias("amount"), F.substring(F.trim(s), 1, 300).alias("snippet")))

    def wanted(s: Column) -> Column:
        out = s["event_date"].isNotNull()
        out = out if since is None else out & (s["event_date"] >= since)
        return out if until is None else out & (s["event_date"] <= until)

    return F.get(F.filter(read, wanted), F.lit(0))


def _has(text: Column, *parts: str) -> Column:
    low = F.lower(text)
    out = F.contains(low, F.lit(parts[0]))
    for p in parts[1:]:
        out = out | F.contains(low, F.lit(p))
    return out


# Words of each kind of date in headers, in the order in which kinds are looked for; and the patterns of
# those in a line of headers.
KIND_WORDS = {"declaration": ("decl", "announced"), "ex": ("ex-div", "ex div", "ex-date", "ex date", "exdate"), "record": ("record",), "payable": ("payable", "pay date", "payment", "paid")}
LINE_WORDS = {"declaration": r"decl|announced", "ex": r"ex[- ]?(?:div|date)", "record": r"record", "payable": r"payable|pay date|payment|paid"}
# Categories and their words in the order in which they are looked for; a category needs one of each tuple.
CATEGORY_WORDS = [
    ("RETURN_OF_CAPITAL", [("return of capital",)]),
    ("RETURN_OF_CAPITAL", [("\\broc\\b",)]),
    ("LONG_TERM_CAPITAL_GAIN", [("capital gain", "cap gain"), ("long",)]),
    ("SHORT_TERM_CAPITAL_GAIN", [("capital gain", "cap gain"), ("short",)]),
    ("COMBINED", [("capital gain", "cap gain"), ("income", "dividend")]),
    ("CAPITAL_GAIN", [("capital gain", "cap gain")]),
    ("SPECIAL", [("special", "extra")]),
    ("INCOME", [("interest", "income", "dividend", "distribution")]),
]


def first_of_words(text: Column, table: list[tuple[str, list[tuple[str, ...]]]], otherwise: Column) -> Column:
    """The name of the first entry of which ``text`` has a word of each tuple, whatever the case. Words are patterns."""
    low, out = F.lower(text), otherwise
    for name, needed in reversed(table):
        test = F.lit(True)
        for words in needed:
            test = test & low.rlike("|".join(words))
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def date_kind(header: Column) -> Column:
    """Which date a column header announces: declaration, ex, record or payable, in this order; else NULL."""
    return first_of_words(header, [(kind, [words]) for kind, words in KIND_WORDS.items()], F.lit(None).cast("string"))


def header_kinds(line: Column) -> Column:
    """``array<string>``: the kinds of dates a header line names, in the order it names them."""
    low = F.lower(line)
    hits = F.array(*(F.struct(F.regexp_instr(low, F.lit(p)).alias("at"), F.lit(k).alias("kind")) for k, p in LINE_WORDS.items()))
    return F.transform(F.array_sort(F.filter(hits, lambda h: h["at"] > 0)), lambda h: h["kind"])


def payout_category(kind: Column) -> Column:
    """A stable category for free-text types, by the first rule that holds; NULL and '' are INCOME."""
    return F.when(F.length(kind) > 0, first_of_words(kind, CATEGORY_WORDS, F.lit("OTHER"))).otherwise(F.lit("INCOME"))


@F.pandas_udf(T.StringType())
def unescape(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Character entities decoded. Spark has no function for it."""
    import html

    for texts in batches:
        yield texts.map(html.unescape, na_action="ignore")


def json_after(marker: str):
    """A pandas UDF: the JSON object that begins after ``marker`` in a page, its braces balanced outside strings; NULL if there is none."""

    @F.pandas_udf(T.StringType())
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import json

        decoder = json.JSONDecoder()

        def one(page: str) -> str | None:
            at = page.find(marker)
            at = page.find("{", at + len(marker)) if at >= 0 else -1
            if at < 0:
                return None
            try:
                return page[at : decoder.raw_decode(page, at)[1]]
            except ValueError:
                return None

        for pages in batches:
            yield pages.map(one, na_action="ignore")

    return extract
