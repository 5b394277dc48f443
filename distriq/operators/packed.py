"""Several values packed in one field: one value per row, with its position.

Quoted spans are swapped for indexed placeholders, what remains is split at the delimiters, the spans are put back
through an array lookup, and the pieces are exploded with their positions. Everything is a built-in expression, so
the work stays inside the generated code of one scan stage and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks the two ends of a placeholder's index. Where a text holds the mark or the escape itself, they are escaped first, so no text collides.
MARK, ESCAPE = "\ue000", "\ue001"

#: Spans that protect the delimiters inside them. A doubled quote inside a quoted span stands for one quote.
QUOTED = r'"(?:[^"]|"")*"|“[^”]*”|«[^»]*»'
BRACKETED = r"\([^()]*\)"

#: Separators of written lists: marks, line ends, a dash between blanks, the words "and" and "et".
LIST_DELIMITERS = r"[,;/|+&、，；•·\t\r\n]|(?<=\s)[-–—](?=\s)|(?<=[\s,])(?i:and|et)(?=\s)"


def _escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "b")), F.lit(MARK), F.lit(ESCAPE + "a"))


def _unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE + "a"), F.lit(MARK)), F.lit(ESCAPE + "b"), F.lit(ESCAPE))


def _unquote(span: Column) -> Column:
    inner = F.substring(span, F.lit(2), F.length(span) - 2)
    return F.when(F.startswith(span, F.lit('"')), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(inner)


def unpack(df: DataFrame, column: str, out: str, delimiters: str = LIST_DELIMITERS, is_item: Callable[[Column], Column] | None = None) -> DataFrame:
    """``df`` with ``out``: ``array<string>`` of the values packed in ``column``, in written order, empty pieces left out.

    * A span in quotes is one value even if it holds delimiters; its quotes go, and a doubled quote becomes one.
    * A span in round brackets stays with the piece it stands in, so delimiters in a remark split nothing.
    * With ``is_item``, a quoted or bracketed span all of whose pieces are items is itself a list and is split.
    * Square brackets around the whole list are dropped, as is a bullet before a value.
    * NULL gives NULL; an empty text gives an empty array. An unclosed quote protects nothing.

    The spans are a column of their own, as an expression inside a lambda would be evaluated once per piece.
    """
    protected = f"{QUOTED}|{BRACKETED}"
    safe, spans, outside = F.col("__safe"), F.col("__spans"), F.col("__outside")

    def kept(span: Column, index: Column) -> Column:
        placeholder = F.concat(F.lit(MARK), index.cast("string"), F.lit(MARK))
        if is_item is None:
            return placeholder
        inner = F.filter(F.transform(F.split(_unquote(span), delimiters, -1), lambda p: F.trim(p)), lambda p: F.length(p) > 0)
        a_list = (F.size(inner) > 0) & F.forall(inner, is_item)
        # a list's own text takes the span's place, between delimiters, so that it is split with the rest
        return F.when(a_list, F.concat(F.lit("\n"), _unquote(span), F.lit("\n"))).otherwise(placeholder)

    swapped = F.concat(
        F.array_join(F.transform(spans, lambda s, i: F.concat(F.get(outside, i), kept(s, i))), ""),
        F.get(outside, F.size(outside) - 1),
    )

    def lookup(index: Column) -> Column:
        span = F.get(spans, index.try_cast("int"))
        return F.when(F.startswith(span, F.lit("(")), span).otherwise(_unquote(span))

    def restored(piece: Column) -> Column:
        # of a piece cut at the marks, the odd parts are the indexes of its spans
        return _unescape(F.array_join(F.transform(F.split(piece, MARK, -1), lambda part, i: F.when(i % 2 == 1, lookup(part)).otherwise(part)), ""))

    values = F.transform(F.split(F.col("__swapped"), delimiters, -1), lambda p: F.regexp_replace(restored(p), r"^[\s•·*-]+|\s+$", ""))
    return (
        df.withColumn("__safe", _escape(F.regexp_replace(F.col(f"`{column}`"), r"^\s*\[|\]\s*$", "")))
        .withColumns({"__spans": F.regexp_extract_all(safe, F.lit(f"({protected})"), 1), "__outside": F.split(safe, protected, -1)})
        .withColumn("__swapped", swapped)
        .withColumn(out, F.filter(values, lambda v: F.length(v) > 0))
        .drop("__safe", "__spans", "__outside", "__swapped")
    )


def split_packed(df: DataFrame, column: str, value: str = "value", pos: str = "pos", delimiters: str = LIST_DELIMITERS, is_item: Callable[[Column], Column] | None = None, keep_empty: bool = False) -> DataFrame:
    """One row per value packed in ``column``: the other columns, ``pos`` from 1 in written order, and ``value``.

    Rows whose field is NULL, blank or only delimiters give no row, or with ``keep_empty`` one row of NULLs. Repeated
    values and repeated rows are kept. A column of the input called like ``pos`` or ``value`` is replaced.
    """
    wide = unpack(df, column, "__packed", delimiters, is_item)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (pos, value)]
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return wide.select(*rest, explode("__packed").alias("__p", value)).withColumn(pos, F.col("__p") + 1).drop("__p")


# Month names and their usual short forms, English and French, accents folded.
MONTH_WORDS = {
    1: ("january", "jan", "janvier", "janv"),
    2: ("february", "feb", "fevrier", "fevr", "fev"),
    3: ("march", "mar", "mars"),
    4: ("april", "apr", "avril", "avr"),
    5: ("may", "mai"),
    6: ("june", "jun", "juin"),
    7: ("july", "jul", "juillet", "juil"),
    8: ("august", "aug", "aout"),
    9: ("september", "sept", "sep", "septembre"),
    10: ("october", "oct", "octobre"),
    11: ("november", "nov", "novembre"),
    12: ("december", "dec", "decembre"),
}


def fold(text: Column) -> Column:
    """Lower case without the accents of French."""
    plain = F.translate(F.lower(text), "àâäéèêëîïôöûùüç", "aaaeeeeiioouuuc")
    return F.regexp_replace(plain, r"\p{Mn}", "")


def month_number(value: Column) -> Column:
    """1 to 12 if ``value`` names one month, else NULL.

    A month may follow an ordinal label ("No.1:", "payout 2:", "P3:") or a day, and be followed by a year and by a
    remark after a comma, a quote or in brackets. A bare number is a month too. Other words name no month.
    """
    words = sorted((w for forms in MONTH_WORDS.values() for w in forms), key=len, reverse=True)
    pattern = (
        r"^(?:\p{L}*[\s.]*\d{1,2}\s*[:.)]\s*)?(?:\d{1,2}(?:st|nd|rd|th|er)?\s+)?(" + "|".join(words) + r")\b\.?"
        r"(?:\s+\d{4})?\s*(?:$|[,\"“«(:].*)$"
    )
    word = F.regexp_extract(fold(value), pattern, 1)
    table = F.create_map(*(F.lit(x) for number, forms in MONTH_WORDS.items() for w in forms for x in (w, number)))
    bare = F.regexp_extract(value, r"^0?([1-9]|1[0-2])$", 1)
    return F.coalesce(F.try_element_at(table, word), F.nullif(bare, F.lit("")).try_cast("int"))


def payout_months(df: DataFrame, column: str, id_column: str) -> DataFrame:
    """(id, pos, month_no) of the months listed in ``column``, pos from 1 among the months, each distinct row once.

    Pieces that name no month (cadence words, remarks, placeholders such as "TBD") give no row and no position.
    """
    listed = unpack(df.select(id_column, column), column, "__values", LIST_DELIMITERS, lambda v: month_number(v).isNotNull())
    months = F.filter(F.transform(F.col("__values"), lambda v: month_number(v)), lambda m: m.isNotNull())
    return (
        listed.select(F.col(id_column), F.posexplode(months).alias("p", "month_no"))
        .select(id_column, (F.col("p") + 1).alias("pos"), "month_no")
        .distinct()
    )
