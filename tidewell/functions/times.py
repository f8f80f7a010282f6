"""One UTC instant out of times written in many ways.

The parser is an ordered cascade of anchored patterns. The first pattern that matches a value decides; it rewrites the
value to `year|month|day|hour|minute|second|zone|half` and the parts are then checked strictly (a 31st of June is null).
Everything is a Catalyst expression: no row passes through Python.

Policies
* A value without zone takes the default zone given for its row; a zone abbreviation means that zone as well, except
  for GMT, UTC and Z.
* A local time that a clock shows twice is the first of the two, unless an abbreviation of standard time (EST, CET)
  says that it is the second. One that a clock skips is moved forward by the skipped span (the offset before the change
  holds).
* A date without time is midnight in the row's zone. 8 digits are a date, 10 epoch seconds, 13 epoch milliseconds.
* Fractions of a second are cut off, not rounded. Anything else is null.
"""

from __future__ import annotations

from functools import reduce
from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# Month names by language, as feeds write them.
MONTH_NAMES = {
    1: ("jan", "january", "januar", "jän", "janvier", "janv", "enero", "ene"),
    2: ("feb", "february", "februar", "février", "févr", "fév", "febrero"),
    3: ("mar", "march", "märz", "mär", "mrz", "mars", "marzo"),
    4: ("apr", "april", "avril", "avr", "abril", "abr"),
    5: ("may", "mai", "mayo"),
    6: ("jun", "june", "juni", "juin", "junio"),
    7: ("jul", "july", "juli", "juillet", "juil", "julio"),
    8: ("aug", "august", "août", "aoû", "agosto", "ago"),
    9: ("sep", "sept", "september", "septembre", "septiembre", "setiembre"),
    10: ("oct", "october", "oktober", "okt", "octobre", "octubre"),
    11: ("nov", "november", "novembre", "noviembre"),
    12: ("dec", "december", "dezember", "dez", "décembre", "déc", "diciembre", "dic"),
}

# Abbreviations of standard time in zones that know a summer time.
STANDARD = ("EST", "CST", "MST", "PST", "AKST", "HST", "AST", "NST", "CET", "MEZ", "EET", "OEZ", "WET", "AEST", "ACST", "NZST", "IST", "MSK")

_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?"
_ZONE = r"(Z|[+-]\d{2}(?::?\d{2})?|(?:UTC|GMT)[+-]\d{1,2}(?::?\d{2})?|[A-Z]{2,5})"
_NAME = r"(\p{L}{3,12})\.?"
_WEEKDAY = r"(?:\p{L}{2,12}\.?,? +)?"

#: (name, anchored pattern, parts as year|month|day|hour|minute|second|zone|half). `<` and `>` mark the two leading
#: numbers of a form whose order the source decides.
CASCADE: list[tuple[str, str, str]] = [
    ("iso", rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})[Tt ]{_TIME} ?{_ZONE}?$", "$1|$2|$3|$4|$5|$6|$7|"),
    ("iso_date", r"^(\d{4})-(\d{1,2})-(\d{1,2})$", "$1|$2|$3|||||"),
    ("compact", rf"^(\d{{4}})(\d{{2}})(\d{{2}})T(\d{{2}})(\d{{2}})(\d{{2}})?{_ZONE}?$", "$1|$2|$3|$4|$5|$6|$7|"),
    ("digits_date", r"^(\d{4})(\d{2})(\d{2})$", "$1|$2|$3|||||"),
    ("rfc", rf"^{_WEEKDAY}(\d{{1,2}}) {_NAME} (\d{{4}}),? (?:at |à |a las |um )?{_TIME}(?: Uhr)? ?{_ZONE}?$", "$3|$2|$1|$4|$5|$6|$7|"),
    ("ctime", rf"^\p{{L}}{{3}} {_NAME} +(\d{{1,2}}) {_TIME} (?:{_ZONE} )?(\d{{4}})$", "$7|$1|$2|$3|$4|$5|$6|"),
    ("us_name", rf"^{_WEEKDAY}{_NAME} (\d{{1,2}}),? (\d{{4}}),?(?: at)? {_TIME} ?([AaPp])\.?[Mm]\.? ?{_ZONE}?$", "$3|$1|$2|$4|$5|$6|$8|$7"),
    ("us_name_24", rf"^{_WEEKDAY}{_NAME} (\d{{1,2}}),? (\d{{4}}),?(?: at)? {_TIME} ?{_ZONE}?$", "$3|$1|$2|$4|$5|$6|$7|"),
    ("us_name_date", rf"^{_WEEKDAY}{_NAME} (\d{{1,2}}),? (\d{{4}})$", "$3|$1|$2|||||"),
    ("dotted_name", rf"^{_WEEKDAY}(\d{{1,2}})\. {_NAME} (\d{{4}})(?:,? (?:um )?{_TIME}(?: Uhr)? ?{_ZONE}?)?$", "$3|$2|$1|$4|$5|$6|$7|"),
    ("de_name", rf"^{_WEEKDAY}(\d{{1,2}}) de {_NAME} (?:de|del) (\d{{4}})(?:,? (?:a las )?{_TIME}(?: h)? ?{_ZONE}?)?$", "$3|$2|$1|$4|$5|$6|$7|"),
    ("h_clock", rf"^{_WEEKDAY}(\d{{1,2}})(?:er)? {_NAME} (\d{{4}}),? (?:à )?(\d{{1,2}}) ?[hH] ?(\d{{2}})$", "$3|$2|$1|$4|$5||||"),
    ("name_date", rf"^{_WEEKDAY}(\d{{1,2}})(?:er)? {_NAME} (\d{{4}})$", "$3|$2|$1|||||"),
    ("han", r"^(\d{4})年(\d{1,2})月(\d{1,2})日(?: ?(上午|下午|凌晨|早上|中午|晚上)? ?(\d{1,2})[::时](\d{2})(?:[::分](\d{2}))?[分秒]?)?$", "$1|$2|$3|$5|$6|$7||$4"),
    ("ymd_slash", rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}})(?:[ T]{_TIME} ?{_ZONE}?)?$", "$1|$2|$3|$4|$5|$6|$7|"),
    ("two_numbers_12", rf"^(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{4}}),? {_TIME} ?([AaPp])\.?[Mm]\.?$", "$3|<$1|>$2|$4|$5|$6||$7"),
    ("two_numbers", rf"^(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{4}})(?:,? {_TIME} ?{_ZONE}?)?$", "$3|<$1|>$2|$4|$5|$6|$7|"),
]


def known_zone(zone: Column, otherwise: str = "UTC") -> Column:
    """The zone where it is one Java knows by an IANA name, else `otherwise`."""
    return F.when(zone.isin(sorted(available_timezones())), zone).otherwise(F.lit(otherwise))


def _month_map() -> Column:
    return F.create_map(*[F.lit(x) for m, names in MONTH_NAMES.items() for n in names for x in (n, m)])


def _num(part: Column) -> Column:
    return part.try_cast("int")


def _canon(v: Column) -> Column:
    return reduce(lambda rest, p: F.when(v.rlike(p[1]), F.regexp_replace(v, p[1], p[2])).otherwise(rest), reversed(CASCADE), F.lit(None).cast("string"))


def _fields(parts: Column, day_first: Column) -> Column:
    """Wall clock (as if UTC), offset text and zone text of the canonical parts."""
    part = lambda i: F.try_element_at(parts, F.lit(i))
    first, second, ordered = F.ltrim(F.translate(part(2), "<", " ")), F.ltrim(F.translate(part(3), ">", " ")), part(2).startswith("<")
    day_leads = F.coalesce(day_first, F.lit(True))
    month = F.when(ordered, F.when(day_leads, second).otherwise(first)).otherwise(F.lower(part(2)))
    day = F.when(ordered, F.when(day_leads, first).otherwise(second)).otherwise(part(3))
    half, hour = F.lower(part(8)), F.coalesce(_num(part(4)), F.lit(0))
    hour24 = (
        F.when(half.isin("a", "p") & ((hour < 1) | (hour > 12)), F.lit(None).cast("int"))
        .when(half.isin("p", "下午", "晚上") & (hour < 12), hour + 12)
        .when(half.isin("a", "上午", "凌晨", "早上") & (hour == 12), F.lit(0))
        .when((half == "中午") & (hour < 11), hour + 12)
        .otherwise(hour)
    )
    second_of = F.coalesce(_num(part(6)), F.lit(0))
    wall = F.try_make_timestamp(
        _num(part(1)), F.coalesce(_num(month), F.try_element_at(_month_map(), month)), _num(day), hour24, F.coalesce(_num(part(5)), F.lit(0)),
        F.when(second_of < 60, second_of).cast("decimal(16,6)"), F.lit("UTC"),
    )
    return F.struct(wall.alias("wall"), F.regexp_extract(part(7), r"^(?:UTC|GMT)?([+-]\d{1,2}(?::?\d{2})?)$", 1).alias("offset"), part(7).alias("zone"))


def _resolve(f: Column, zone: Column) -> Column:
    digits = F.regexp_replace(f["offset"], "[^0-9]", "")
    minutes = F.when(F.length(digits) > 2, _num(F.right(digits, F.lit(2)))).otherwise(F.lit(0))
    hours = F.when(F.length(digits) > 2, _num(F.left(digits, F.length(digits) - 2))).otherwise(_num(digits))
    ahead = F.when(f["offset"].startswith("-"), -1).otherwise(1) * (hours * 60 + minutes)
    return (
        F.when(f["offset"] != "", F.when((hours <= 18) & (minutes < 60), F.timestamp_seconds(F.unix_seconds(f["wall"]) - ahead * 60)))
        .when(f["zone"].isin("Z", "UTC", "GMT", "UT"), f["wall"])
        .otherwise(let(F.to_utc_timestamp(f["wall"], zone), lambda first: _of_two(first, f, zone)))
    )


def _of_two(first: Column, f: Column, zone: Column) -> Column:
    """The second instant at which the clock shows the same where the value names standard time, else the first."""
    out = first
    for minutes in (30, 60):  # what clocks are put back by
        later = F.timestamp_seconds(F.unix_seconds(first) + minutes * 60)
        out = F.when(f["zone"].isin(*STANDARD) & (F.from_utc_timestamp(later, zone) == f["wall"]), later).otherwise(out)
    return out


def to_utc(value: Column, zone: Column, day_first: Column) -> Column:
    """The instant that `value` names as a UTC timestamp, or null.

    zone: the row's default zone, a valid IANA name and never null. day_first: whether the day comes before the month
    where a form has two bare numbers (null: day first). Null, blank and unreadable values give null.
    """

    def body(v: Column) -> Column:
        written = let(F.split(_canon(v), r"\|"), lambda parts: let(_fields(parts, day_first), lambda f: _resolve(f, zone)))
        return (
            F.when(v.rlike(r"^\d{10}$"), F.timestamp_seconds(v.try_cast("bigint")))
            .when(v.rlike(r"^\d{13}$"), F.timestamp_seconds(F.floor(v.try_cast("bigint") / 1000)))
            .otherwise(written)
        )

    return let(F.regexp_replace(F.regexp_replace(value, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " "), body)


def utc_text(ts: Column) -> Column:
    """`yyyy-MM-ddTHH:mm:ssZ`; the session's time zone must be UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
