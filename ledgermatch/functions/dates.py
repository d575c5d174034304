"""Date parsing and formatting for payment and register dates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Payment dates arrive in mixed formats.  The text before the first 'T' is
# read month-first with a day-first fallback (so '01/02/2020' is 2 Jan and
# '13/02/2020' is 13 Feb); register dates are day-first.  A time at the end is
# left out, and two-digit years run from 1970 to 2069.  Numbers become dates by
# range checks, as a failed parse costs an exception in the JVM; only dates with
# a month's name are parsed by format, once their text has the shape.
TIME_OF_DAY = r"[ T]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?[AaPp][Mm])?( ?(Z|UTC|[+-]\d{2}:?\d{2}))?$"
YEAR_LAST = r"^\d{1,2}[-./]\d{1,2}[-./](\d{2}|\d{4})\z"
YEAR_FIRST = r"^\d{4}[-./]\d{1,2}[-./]\d{1,2}\z"
YEAR_SLASHED = r"^\d{4}/\d{1,2}/\d{1,2}\z"
DIGITS = r"^(\d{8}|\d{4})\z"
NAMED_FORMATS = [(r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"), (r"^\d{1,2} [A-Z][a-z]{3,8} \d{4}$", "d MMMM yyyy"),
                 (r"^[A-Z][a-z]{2} \d{1,2} \d{4}$", "MMM d yyyy"), (r"^[A-Z][a-z]{3,8} \d{1,2} \d{4}$", "MMMM d yyyy")]


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _date(year: Column, month: Column, day: Column) -> Column:
    """The date, or null where the calendar has none."""
    in_month = day <= F.day(F.last_day(F.make_date(year, month, F.lit(1))))
    return F.when((year >= 1) & month.between(1, 12) & day.between(1, 31),
                  F.when(in_month, F.make_date(year, month, day)))


def _year_last(parts: Column, month_first: bool) -> Column:
    """``parts``: two numbers of a day and a month, and a year of two or four digits."""
    a, b, c = (parts[i].cast("int") for i in range(3))
    year = F.when(F.length(parts[2]) == 4, c).when(c < 70, c + 2000).otherwise(c + 1900)
    return F.coalesce(_date(year, a, b), _date(year, b, a)) if month_first else _date(year, b, a)


def _digits(text: Column) -> Column:
    year, month, day = (F.substring(text, at, n).cast("int") for at, n in ((1, 4), (5, 2), (7, 2)))
    return F.when(F.length(text) == 4, _date(year, F.lit(1), F.lit(1))).otherwise(_date(year, month, day))


def _four_digit_year(text: Column) -> Column:
    text = F.regexp_replace(text, r"^(.*[^0-9])([0-6]\d)$", "$120$2")
    return F.regexp_replace(text, r"^(.*[^0-9])([7-9]\d)$", "$119$2")


def _named(text: Column) -> Column:
    tries = [F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(f))) for shape, f in NAMED_FORMATS]
    return F.coalesce(*tries).cast("date")


def _parse(col: Column, month_first: bool) -> Column:
    def of_shape(plain: Column) -> Column:
        parts = F.split(plain, "[-./]")
        named = F.initcap(F.lower(_four_digit_year(F.regexp_replace(plain, "[-./, ]+", " "))))
        return (F.when(plain.rlike(YEAR_LAST), _bound(parts, lambda p: _year_last(p, month_first)))
                .when(plain.rlike(YEAR_FIRST), _bound(parts, lambda p: _date(*(p[i].cast("int") for i in range(3)))))
                .when(plain.rlike(DIGITS), _digits(plain))
                .when(plain.rlike("[A-Za-z]"), _bound(named, _named)))

    return _bound(F.regexp_replace(F.trim(col), TIME_OF_DAY, ""), of_shape)


def cut_at_t(col: Column) -> Column:
    """Text before the first upper-case 'T' (the reference splits on 'T')."""
    return F.substring_index(col.cast("string"), "T", 1)


def parse_mixed_date(col: Column) -> Column:
    """payment date text -> date (null when unparseable)."""
    return _parse(cut_at_t(col), month_first=True)


def parse_dayfirst_date(col: Column) -> Column:
    """Register date text, day-first -> date."""
    return _parse(col.cast("string"), month_first=False)


def parse_ymd(col: Column) -> Column:
    """Year of four digits, month and day of one or two, between slashes -> date, all else -> null."""
    return F.when(col.rlike(YEAR_SLASHED), _bound(F.split(col, "/"), lambda p: _date(*(p[i].cast("int") for i in range(3)))))


MONTHS = {name.upper(): str(at) for at, full in enumerate("January February March April May June July August September October "
                                                         "November December".split(), 1) for name in (full[:3], full)}
# Between dashes; the long s, which becomes an S in upper case, may begin a name.
NAMED = r"^(\d{1,2}-[A-Za-z\x{17f}][A-Za-z]{2,8}|[A-Za-z\x{17f}][A-Za-z]{2,8}-\d{1,2})-(\d{4}|\d{2})\z"


def with_mixed_date(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Adds ``dst``, the ``parse_mixed_date`` of ``src``, for whole feeds.

    The same results by projections of plain text: each shape is written with
    the year first between dashes, which a cast reads.  No lambda, which would run
    interpreted, no title case, which seeks the words of each text, and no arithmetic
    per calendar; a month's name is looked up instead of parsed by format.
    """
    own = {c: f"__{dst}_{c}" for c in ("plain", "dashed", "shape", "parts", "year", "iso", "swapped")}
    plain, dashed, shape, parts, year, iso, swapped = (F.col(c) for c in own.values())

    def between(*texts: Column) -> Column:
        return F.concat(texts[0], F.lit("-"), texts[1], F.lit("-"), texts[2])

    cut = F.trim(cut_at_t(F.col(src)))
    df = df.withColumn(own["plain"], F.when(cut.contains(":"), F.regexp_replace(cut, TIME_OF_DAY, "")).otherwise(cut))
    # A pattern is only tried on texts of its length or with its mark.
    df = df.withColumns({
        own["dashed"]: F.replace(F.replace(plain, F.lit("."), F.lit("-")), F.lit("/"), F.lit("-")),
        own["shape"]: F.when(F.substring(plain, 5, 1).isin("-", ".", "/") & plain.rlike(YEAR_FIRST), 2)
        .when(F.length(plain).isin(4, 8) & plain.rlike(DIGITS), 3).when(plain.rlike(YEAR_LAST), 1).when(plain.rlike("[A-Za-z]"), 4)})
    words = F.when(shape == 4, F.replace(F.replace(dashed, F.lit(","), F.lit("-")), F.lit(" "), F.lit("-")))
    df = df.withColumn(own["parts"], F.when(shape == 1, dashed).otherwise(
        F.when(words.contains("--"), F.regexp_replace(words, "-+", "-")).otherwise(words)))
    # A split by one plain character needs no pattern, which Java would compile for each row.
    df = df.withColumn(own["parts"], F.when((shape == 1) | parts.rlike(NAMED), F.split(parts, "-")))
    df = df.withColumn(own["year"], F.when(F.length(parts[2]) == 4, parts[2]).when(parts[2] < "70", F.concat(F.lit("20"), parts[2]))
                       .otherwise(F.concat(F.lit("19"), parts[2])))
    number_first = parts[0] < "A"
    known = F.create_map(*[F.lit(x) for item in MONTHS.items() for x in item])
    month = F.try_element_at(known, F.upper(F.when(number_first, parts[1]).otherwise(parts[0])))
    # Such a cast throws and catches an exception where the calendar has no such month, so that is asked first.
    a_month, b_month = (parts[i].try_cast("int").between(1, 12) for i in (0, 1))
    df = df.withColumns({
        own["iso"]: F.when(shape == 1, F.when(a_month, between(year, parts[0], parts[1]))).when(shape == 2, dashed)
        .when(shape == 3, F.when(F.length(plain) == 4, F.concat(plain, F.lit("-01-01")))
              .otherwise(between(F.substring(plain, 1, 4), F.substring(plain, 5, 2), F.substring(plain, 7, 2))))
        .when(shape == 4, between(year, month, F.when(number_first, parts[0]).otherwise(parts[1]))),
        own["swapped"]: F.when((shape == 1) & b_month, between(year, parts[1], parts[0]))})
    found = F.coalesce(iso.try_cast("date"), swapped.try_cast("date"))
    return df.withColumn(dst, F.when((shape == 4) | ~F.coalesce(iso, swapped).startswith("0000"), found)).drop(*own.values())


def fmt_dmy(col: Column) -> Column:
    return F.date_format(col, "dd-MM-yyyy")


def date_range_text(min_date: Column, max_date: Column) -> Column:
    """F3 on a distinct date list given its min and max.

    '' when the list is empty, 'dd-MM-yyyy' for one date, else
    'min-max' with both ends formatted.
    """
    return (F.when(min_date.isNull(), F.lit(""))
            .when(min_date == max_date, fmt_dmy(min_date))
            .otherwise(F.concat(fmt_dmy(min_date), F.lit("-"), fmt_dmy(max_date))))
