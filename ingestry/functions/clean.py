"""Scalar cleaning and parsing expressions.

Each parser is written once as a Spark SQL expression template (`*_sql`, text in,
text out) and exposed as a Column through `F.expr`. Built-in expressions only, so
everything stays inside whole-stage codegen; building the plan costs one JVM call
per expression instead of one per operator node.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ingestry import schema as S

# Python's str.strip() removes exactly the characters for which str.isspace() is
# true; derive that set by rule (it includes U+001C..U+001F, which Java's \s lacks)
# and trim with btrim(), which needs no regex.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Python's \s in the e-mail pattern is Unicode-aware; make Java's the same.
_WS_CLASS = r"\s\x{1c}-\x{1f}"
EMAIL_REGEX = "(?U)" + S.EMAIL_PATTERN.replace(r"\s", _WS_CLASS)

INT_TEXT = r"^[+-]?[0-9]+$"
DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# ISO 8601 with a mandatory zone: extended or basic date, HH[:MM[:SS[.f]]], Z or
# +HH[:MM[:SS]], with colons or without.
TS_ZONE = r"(Z|[+-][0-9]{2}(:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?|[0-9]{2}([0-9]{2}(\.[0-9]{1,6})?)?)?)$"
TS_GUARD = (
    r"^[0-9]{4}(-[0-9]{2}-[0-9]{2}T[0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?)?"
    r"|[0-9]{4}T[0-9]{2}([0-9]{2}([0-9]{2}([.,][0-9]+)?)?)?)" + TS_ZONE
)
# What a cast reads as it stands: all parts, extended, a zone within its reach; years from 2 on.
TS_PLAIN = (
    r"^(?!000[01])[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.,][0-9]+)?"
    r"(Z|[+-](0[0-9]|1[0-7])(:?[0-5][0-9])?)$"
)
TS_OFFSET = r"^(Z|[+-]([01][0-9]|2[0-3])([0-5][0-9]([0-5][0-9](\.[0-9]+)?)?)?)$"


def sql_str(value: str) -> str:
    """A Spark SQL string literal for any text (backslash escapes, \\uXXXX for the rest)."""
    out = []
    for ch in value:
        if ch == "\\":
            out.append("\\\\")
        elif ch == "'":
            out.append("\\'")
        elif ch.isprintable() and not ch.isspace() or ch == " ":
            out.append(ch)
        else:
            out.append(f"\\u{ord(ch):04x}")
    return "'" + "".join(out) + "'"


def _map_sql(mapping: dict) -> str:
    parts = []
    for key, value in mapping.items():
        parts.append(sql_str(key))
        parts.append(sql_str(value) if isinstance(value, str) else str(value))
    return "map(" + ", ".join(parts) + ")"


# ---------------------------------------------------------------- SQL templates
def clean_text_sql(x: str) -> str:
    """Stringify, strip like Python's str.strip(), blank -> null."""
    return f"nullif(btrim(CAST({x} AS STRING), {sql_str(PY_WHITESPACE)}), '')"


def alias_key_sql(t: str) -> str:
    return f"translate(lower({t}), '- ', '__')"


def email_sql(t: str) -> str:
    """`t` is cleaned text."""
    return f"CASE WHEN lower({t}) RLIKE {sql_str(EMAIL_REGEX)} THEN lower({t}) END"


def status_sql(t: str) -> str:
    return f"try_element_at({_map_sql(S.STATUS_ALIASES)}, {alias_key_sql(t)})"


def grade_sql(t: str) -> str:
    """Alias, else an integer, else an integral decimal; then the -1..12 range.
    Each regex appears once (the range test sits inside its branch)."""
    alias = f"try_element_at({_map_sql(S.GRADE_ALIASES)}, {alias_key_sql(t)})"
    dec = f"try_cast({t} AS DOUBLE)"
    ranged = f"CASE WHEN {dec} BETWEEN {S.MIN_GRADE_LEVEL} AND {S.MAX_GRADE_LEVEL} THEN {dec} END"
    return (
        f"CAST(CASE WHEN {alias} IS NOT NULL THEN {alias} "
        f"WHEN NOT contains({t}, '.') AND {t} RLIKE {sql_str(INT_TEXT)} THEN {ranged} "
        f"WHEN contains({t}, '.') AND {t} RLIKE {sql_str(DECIMAL_TEXT)} AND {dec} = floor({dec}) "
        f"THEN {ranged} END AS SMALLINT)"
    )


def timestamp_sql(t: str) -> str:
    """Guarded ISO 8601 parse. Values as TS_PLAIN takes them are cast; the others (basic form,
    missing minutes or seconds, far zones) are put into that form as UTC and moved by their
    offset. No lambda: those would end whole-stage code generation for the whole cascade.

    Year-0001 values with a positive offset fall before 0001-01-01 UTC; Python cannot represent
    them, we reject them."""
    local = f"translate(regexp_replace({t}, '(Z|[+-][0-9:.]+)$', ''), ',-:T', '.')"
    shaped = (
        f"regexp_replace(concat(rpad(substr({local}, 1, 14), 14, '0'), substr({local}, 15), 'Z'), "
        "'^(....)(..)(..)(..)(..)(..)', '$1-$2-$3T$4:$5:$6')"
    )
    zone = f"replace(regexp_extract({t}, {sql_str(TS_ZONE)}, 1), ':', '')"

    def part(at: int, width: int, kind: str) -> str:
        return f"coalesce(try_cast(nullif(substr({zone}, {at}, {width}), '') AS {kind}), 0)"

    micros = f"CAST(({part(2, 2, 'BIGINT')} * 3600 + {part(4, 2, 'BIGINT')} * 60 + {part(6, 9, 'DECIMAL(12,6)')}) * 1000000 AS BIGINT)"
    moved = f"timestampadd(MICROSECOND, if(left({zone}, 1) = '-', 1, -1) * {micros}, try_cast({shaped} AS TIMESTAMP))"
    return (
        f"CASE WHEN {t} RLIKE {sql_str(TS_PLAIN)} THEN try_cast(translate({t}, ',', '.') AS TIMESTAMP) "
        f"WHEN {t} RLIKE {sql_str(TS_GUARD)} AND {zone} RLIKE {sql_str(TS_OFFSET)} AND {moved} >= TIMESTAMP'0001-01-01 00:00:00' "
        f"THEN {moved} END"
    )


def iso_utc_sql(ts: str) -> str:
    """Python `datetime.isoformat()` of a UTC value: seconds, optional 6-digit fraction, +00:00."""
    micros = f"(unix_micros({ts}) % 1000000)"
    return (
        f"concat(date_format({ts}, 'yyyy-MM-dd\\'T\\'HH:mm:ss'), "
        f"CASE WHEN {micros} != 0 THEN concat('.', lpad(CAST({micros} AS STRING), 6, '0')) "
        f"ELSE '' END, '+00:00')"
    )


# ---------------------------------------------------------------- Column API
def _name(c: Column | str) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name; use the *_sql templates for expressions")


def clean_text(c: str) -> Column:
    """P1 as a Column."""
    return F.expr(clean_text_sql(_name(c)))


def parse_email(c: str) -> Column:
    """Lower-cased address when it matches the address pattern, else null."""
    return F.expr(email_sql(clean_text_sql(_name(c))))


def parse_grade_level(c: str) -> Column:
    """SMALLINT in -1..12 (PK/K aliases, integers, integral decimals), else null.

    Mirrors Python's int()/float() for ASCII spellings; underscores and non-ASCII
    digits are rejected (documented divergence).
    """
    return F.expr(grade_sql(clean_text_sql(_name(c))))


def parse_enrollment_status(c: str) -> Column:
    """One of the five canonical statuses via the alias table, else null."""
    return F.expr(status_sql(clean_text_sql(_name(c))))


def parse_timestamp(c: str) -> Column:
    """P5: ISO 8601 text with a 'T' and an explicit zone -> UTC TIMESTAMP, else null.

    Accepts `Z` / `+HH:MM` / `+HHMM` / `+HH` / `+HH:MM:SS` zones, `HH`, `HH:MM`,
    `HH:MM:SS[.f]` times, `,` as decimal mark, the basic form `YYYYMMDDTHHMMSS`,
    and fractions longer than 6 digits (cut, like Python). Date-only, naive,
    slash dates, epoch numbers and named zones are rejected.
    """
    return F.expr(timestamp_sql(clean_text_sql(_name(c))))


def iso_utc(c: str) -> Column:
    return F.expr(iso_utc_sql(_name(c)))
