"""Scalar parsers (P1-P5): every alias and boundary in generated spellings."""

import datetime as dt

from ingestry import schema as S
from ingestry.functions import clean as C


def _run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", fn("v").alias("o")).orderBy("i").collect()]


def _check(spark, cases, fn):
    got = _run(spark, list(cases), fn)
    assert dict(zip(cases, got)) == cases


def spellings(alias):
    yield from (alias, alias.upper(), alias.title(), f"\t{alias} ", alias.replace("_", "-"), alias.replace("_", " "))


def test_statuses(spark):
    cases = {form: status for alias, status in S.STATUS_ALIASES.items() for form in spellings(alias)}
    cases |= {f"{alias}x": None for alias in S.STATUS_ALIASES if f"{alias}x" not in S.STATUS_ALIASES}
    _check(spark, cases | {"": None, " ": None, None: None, "activé": None}, C.parse_enrollment_status)


def test_grades(spark):
    cases = {form: grade for alias, grade in S.GRADE_ALIASES.items() for form in spellings(alias)}
    for n in range(-4, 16):
        want = n if S.MIN_GRADE_LEVEL <= n <= S.MAX_GRADE_LEVEL else None
        cases |= {str(n): want, f" {n}": want, f"{n}.0": want, f"{n}.00e0": want, f"{n}.25": None, f"grade {n}": None}
        if n >= 0:
            cases |= {f"+{n}": want, f"{n:03d}": want}
    _check(spark, cases | {"": None, None: None, "kk": None, ".": None, "1e1": None, "1.0e1": 10}, C.parse_grade_level)


def test_emails(spark):
    cases = {}
    for local in ("x", "x.y", "x+y", "X_Y"):
        for domain in ("h.example", "a.b.h.example"):
            cases[f" {local}@{domain}\n"] = f"{local}@{domain}".lower()
        for bad in ("", "h.example", "@h", "@.h", "@h.", "@h..example", "@h.example@k", "@h.exa mple", "@h,k.example"):
            cases[local + bad] = None
    _check(spark, cases | {"@h.example": None, "": None, None: None}, C.parse_email)


def moments():
    """Date, time and zone in every form of the rule, and the moment that they name."""
    day = dt.date(2031, 2, 9)
    fractions = {"": 0, ".5": 500_000, ",25": 250_000, ".000001": 1, ".9999999": 999_999}
    offsets = [(h, m, s) for h, m, s in ((0, 0, 0), (5, 45, 0), (14, 0, 0), (19, 0, 0), (23, 59, 0), (1, 0, 7))]
    for sep in ("-", ""):
        colon = ":" if sep else ""
        date = f"{day:%Y{sep}%m{sep}%d}"
        times = {"21": (21, 0, 0), f"21{colon}43": (21, 43, 0), f"21{colon}43{colon}07": (21, 43, 7)}
        for clock, (h, m, s) in times.items():
            for mark, micros in fractions.items() if clock.endswith("07") else [("", 0)]:
                at = dt.datetime(day.year, day.month, day.day, h, m, s, micros)
                yield f"{date}T{clock}{mark}Z", at
                for oh, om, os in offsets:
                    for sign in (1, -1):
                        moved = at - sign * dt.timedelta(hours=oh, minutes=om, seconds=os)
                        zone = f"{'+' if sign > 0 else '-'}{oh:02}{colon}{om:02}" + (f"{colon}{os:02}" if os else "")
                        yield f"{date}T{clock}{mark}{zone}", moved
                        if not om and not os:
                            yield f"{date}T{clock}{mark}{zone[:3]}", moved


def spoilt():
    """A sound value with one part left out, out of range, in another order or other signs."""
    day, clock, zone = ("2031", "02", "09"), ("21", "43", "07"), "+05:45"
    date, time = "-".join(day), ":".join(clock)
    yield from (None, "", date, time, zone, f"{date}T{time}", f"{date}T{zone}", f"T{time}{zone}", f"{date}{time}{zone}")
    yield from (f"{date}{between}{time}{zone}" for between in (" ", "t", "_", "T ", "TT"))
    yield from (f"{mark.join(day)}T{time}{zone}" for mark in "/. ")
    yield from (f"{mark.join(parts)}" for mark in "/.-" for parts in (day[::-1], (day[1], day[2], day[0])))
    yield from (f"{date}T{mark.join(clock)}{zone}" for mark in ".-")
    for k, (low, high) in enumerate((("00", "13"), ("00", "32"))):  # month, day
        yield from ("-".join([*day[: k + 1], odd, *day[k + 2 :]]) + f"T{time}{zone}" for odd in (low, high, "9", "x1"))
    yield f"2031-02-29T{time}{zone}"
    for k, high in enumerate(("24", "60", "61")):
        yield from (f"{date}T" + ":".join([*clock[:k], odd, *clock[k + 1 :]]) + zone for odd in (high, "1", "-1"))
    yield from (f"{date}T{time}{odd}" for odd in ("+24:00", "+05:60", "+5", "5:45", "z", "UTC", " Asia/Kathmandu", "+05:45Z", "+05:4500", "+0545:00"))
    yield from ("31" + date[4:] + f"T{time}{zone}", "0001-01-01T00:00:00+00:01", "1928266987", "1928266987.5", "next week")


def test_timestamps(spark):
    _check(spark, dict(moments()) | dict.fromkeys(spoilt()), C.parse_timestamp)


def test_clean_text_strips_python_whitespace(spark):
    every = [ch for ch in map(chr, range(1, 0x3010)) if ch.isspace()]
    got = _run(spark, [f"{ch}a b{ch}{ch}" for ch in every] + every, C.clean_text)
    assert got == ["a b"] * len(every) + [None] * len(every)


def test_iso_format(spark):
    df = spark.sql("SELECT TIMESTAMP'2026-07-30 09:00:00' AS a, TIMESTAMP'2026-07-30 09:00:00.5' AS b")
    r = df.select(C.iso_utc("a").alias("a"), C.iso_utc("b").alias("b")).first()
    assert r["a"] == "2026-07-30T09:00:00+00:00"
    assert r["b"] == "2026-07-30T09:00:00.500000+00:00"
