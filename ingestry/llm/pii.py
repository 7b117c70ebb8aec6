"""Operator 8, PII (native): format-preserving Feistel pseudonyms.

Candidates are found by one pattern, then validated (Luhn, calendar, mod-97, number
ranges). A valid value is permuted by a keyed Feistel network within its own format, so
equal values get equal pseudonyms in every document, different values different ones,
and a pseudonym is as valid as the original:

* card numbers: the digits between the first and the check digit; a new check digit
* dates (1800-2199): the day number, within the 400-year cycle of 146,097 = 189 x 773 days;
  month-first dates, known by a day over 12, among their own kind (29 February stays)
* IPv4 addresses: the 32-bit number
* US social security numbers: the 898 x 99 x 9999 valid ones
* IBANs: letters and digits of the account part; new check digits
* phone numbers: the digits after the country code, layout kept
* e-mail addresses, access keys and the values of secrets: letters and digits, each within its
  own class

A secret is what stands after password, passwd, secret or token in any case (also at the end
of a longer name, as in API_TOKEN) and = or :, with or without blanks and quotes: at least 8
characters. Name, sign and quotes stay.

A card may stand beside other numbers (security code, expiry, counter, phone number). Digit
groups with single blanks or hyphens between them are one run. Valid stretches of its groups
are cards: first unbroken or equal groups anywhere, from the left; then, where they leave room,
the longest of equal groups with a shorter last one, or of any layout from where the run, or the
last 19 digits tried, end. The rest is searched for dates, social security and phone numbers.
Where a pseudonym would make another stretch of its run the valid one, it is permuted again
until it does not, so that ``reverse`` finds it. That is rare (a card in groups beside more groups
of their size, or one in unequal groups), and only there do equal cards get different pseudonyms.

Equal numbers link across layouts (4111-1111... and 4111 1111...), dates across year-first
and day-first notations,
e-mail addresses across case. ``reverse=True`` restores the originals. One projection per
document: no shuffle, no Python.

Edge cases: a null text stays null, with no values; an empty text stays empty; repeated
rows get the same pseudonyms; other columns of the input are ignored; what doesn't
validate is left as it is; a document without values keeps its text byte for byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry.llm.common import settled

ROUNDS = 8
DAYS = (189, 773)  # their product is the days of 400 years
FIRST_DAY, LAST_DAY = "1800-01-01", "2199-12-31"

_B, _E = "(?<![0-9A-Za-z])", "(?![0-9A-Za-z])"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# What stands before a secret; quotes and tabs are written so that SQL text can hold them.
_QUOTE, _BLANK = r"[\u0022\u0027\u0060]", r"[ \u0009]{0,8}"
NAMED = f"(?i:password|passwd|secret|token){_QUOTE}?{_BLANK}[=:]{_BLANK}{_QUOTE}?"
# Kind and pattern; the first that matches at a place wins.
KINDS = (
    ("email", r"(?<![0-9A-Za-z._%+-])[0-9A-Za-z._%+-]+@[0-9A-Za-z-]+(?:[.][0-9A-Za-z-]+)*[.][A-Za-z]{2,24}" + _E),
    ("ip", rf"(?<![0-9A-Za-z.]){_OCTET}(?:[.]{_OCTET}){{3}}(?![0-9A-Za-z]|[.][0-9])"),
    ("iso_date", _B + "[0-9]{4}-[0-9]{2}-[0-9]{2}" + _E),
    ("date", _B + "[0-9]{2}(?:/[0-9]{2}/|[.][0-9]{2}[.]|-[0-9]{2}-)[0-9]{4}" + _E),
    ("ssn", _B + "[0-9]{3}-[0-9]{2}-[0-9]{4}" + _E),
    ("iban", _B + "[A-Z]{2}[0-9]{2}(?:[ ]?[0-9A-Z]{4}){2,7}(?:[ ]?[0-9A-Z]{1,3})?" + _E),
    ("card", _B + "(?=(?:[0-9][ -]?){12}[0-9])[0-9]++(?![A-Za-z])(?:[ -][0-9]++(?![A-Za-z]))*+"),
    ("phone", r"(?<![0-9A-Za-z+])(?:[+][0-9]{1,3}[ .-]?)?(?:[(][0-9]{2,4}[)][ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}(?:[ .-][0-9]{2,4}){1,3}" + _E),
    ("key", _B + "AKIA[0-9A-Z]{16}" + _E),
    ("secret", _B + NAMED + "[0-9A-Za-z][0-9A-Za-z_+/.~-]{6,}[0-9A-Za-z]" + _E),
)
ANY = "|".join(f"(?:{p})" for _, p in KINDS)
# What is looked for beside the cards of a run.
BESIDE = "|".join(f"(?:{p})" for kind, p in KINDS if kind in ("iso_date", "date", "ssn", "phone"))
# Layouts of a card beside other numbers: unbroken or in equal groups or as 4-6-4 and 4-6-5; or,
# where there is none, in equal groups but for a shorter last one.
EQUAL = "^(?:[0-9]+|" + "|".join(
    [f"[0-9]{{{n}}}(?:{c}[0-9]{{{n}}})+" for n in range(4, 10) for c in " -"]
    + [f"[0-9]{{4}}{c}[0-9]{{6}}{c}[0-9]{{4,5}}" for c in " -"]
) + ")$"
EVEN = "^(?:" + "|".join(f"[0-9]{{{n}}}(?:{c}[0-9]{{{n}}})*{c}[0-9]{{1,{n}}}" for n in range(4, 10) for c in " -") + ")$"
WALKS = 64


def _let(value: str, name: str, body: str) -> str:
    """SQL: body with name bound to value, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _number(key: str, tag: str, rnd: str, half: str) -> str:
    """SQL: a keyed number of 48 bits from a round and the half that stays."""
    return f"cast(conv(left(sha2(concat_ws(':', '{key}', '{tag}', {rnd}, {half}), 256), 12), 16, 10) as bigint)"


def _steps(reverse: bool) -> str:
    return f"sequence({ROUNDS - 1}, 0)" if reverse else f"sequence(0, {ROUNDS - 1})"


def _permute_pair(left: str, right: str, a: str, b: str, key: str, tag: str, reverse: bool) -> str:
    """SQL: struct(l, r), the permuted pair of left in [0, a) and right in [0, b)."""
    sign = "-" if reverse else "+"
    return (
        f"aggregate({_steps(reverse)}, named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint)), (v, k) -> if(k % 2 = 0, "
        f"named_struct('l', pmod(v.l {sign} {_number(key, tag, 'k', 'v.r')} % {a}, {a}), 'r', v.r), "
        f"named_struct('l', v.l, 'r', pmod(v.r {sign} {_number(key, tag, 'k', 'v.l')} % {b}, {b}))))"
    )


def _permute_chars(value: str, key: str, tag: str, reverse: bool) -> str:
    """SQL: value with letters and digits permuted, each staying a digit, a capital or a
    small letter. Characters at even and odd positions are the two halves."""
    sign = "-" if reverse else "+"
    shift = "chr({z} + pmod(ascii(c) - {z} " + sign + " cast(conv(substr(ks, 2 * (cast(i / 2 as int) % 32) + 1, 2), 16, 10) as int), {n}))"
    step = (
        f"case when i % 2 != k % 2 then c when c between '0' and '9' then {shift.format(z=48, n=10)} "
        f"when c between 'a' and 'z' then {shift.format(z=97, n=26)} "
        f"when c between 'A' and 'Z' then {shift.format(z=65, n=26)} else c end"
    )
    stays = "lower(array_join(filter(v, (c, i) -> i % 2 != k % 2), ''))"
    stream = f"sha2(concat_ws(':', '{key}', '{tag}', k, size(v), {stays}), 256)"
    return (
        f"aggregate({_steps(reverse)}, split({value}, ''), (v, k) -> "
        f"{_let(stream, 'ks', f'transform(v, (c, i) -> {step})')}, v -> array_join(v, ''))"
    )


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]+', '')"


def _laid_out(layout: str, new: str, old_class: str = "0-9") -> str:
    """SQL: layout with its characters of the class replaced, in order, by those of new."""
    return (
        f"array_join(transform(split({layout}, ''), (c, i) -> if(c rlike '[{old_class}]', "
        f"substr({new}, i + 1 - length(regexp_replace(left({layout}, i), '[{old_class}]+', '')), 1), c)), '')"
    )


def _luhn(digits: str) -> str:
    """SQL: the Luhn sum of a digit string that ends in its check digit."""
    return (
        f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> (ascii(c) - 48) * (1 + i % 2)), 0, "
        "(s, x) -> s + if(x > 9, x - 9, x))"
    )


def _mod97(account: str) -> str:
    """SQL: the remainder of an IBAN whose first four characters were moved to the end."""
    return (
        f"aggregate(split({account}, ''), 0, (s, c) -> if(c between '0' and '9', "
        "s * 10 + ascii(c) - 48, s * 100 + ascii(c) - 55) % 97)"
    )


def _pseudonym(kind: str, key: str, reverse: bool) -> str:
    """SQL: the pseudonym of the candidate m, null if it isn't valid."""
    if kind == "email":
        at = "locate('@', m)"
        host = f"substr(m, {at} + 1)"
        tld = f"regexp_extract({host}, '[.][A-Za-z]+$', 0)"
        return (
            f"concat({_permute_chars(f'left(m, {at} - 1)', key, 'local', reverse)}, '@', "
            f"{_permute_chars(f'left({host}, length({host}) - length({tld}))', key, 'host', reverse)}, {tld})"
        )
    if kind == "ip":
        o = [f"cast(split(m, '[.]')[{k}] as int)" for k in range(4)]
        pair = _permute_pair(f"{o[0]} * 256 + {o[1]}", f"{o[2]} * 256 + {o[3]}", "65536", "65536", key, kind, reverse)
        return _let(pair, "p", "concat_ws('.', p.l div 256, p.l % 256, p.r div 256, p.r % 256)")
    if kind in ("iso_date", "date"):
        a, b = DAYS
        day = f"datediff(d, date'{FIRST_DAY}')"
        pair = _permute_pair(f"{day} div {b}", f"{day} % {b}", str(a), str(b), key, "date", reverse)
        new = f"date_add(date'{FIRST_DAY}', cast(p.l * {b} + p.r as int))"
        if kind == "iso_date":
            read = "try_cast(m as date)"
            shown = f"date_format({new}, 'yyyy-MM-dd')"
        else:
            dmy = "try_cast(concat_ws('-', substr(m, 7, 4), substr(m, 4, 2), left(m, 2)) as date)"
            mdy = "try_cast(concat_ws('-', substr(m, 7, 4), left(m, 2), substr(m, 4, 2)) as date)"
            sep = "substr(m, 3, 1)"
            read = dmy
            shown = f"concat_ws({sep}, date_format({new}, 'dd'), date_format({new}, 'MM'), date_format({new}, 'yyyy'))"
            # Month first, where day first is no date: the day is over 12 and must stay so.
            year, month, dom = "(year(u) - 1800)", "month(u)", "day(u)"
            low = _permute_pair(f"{year} * 12 + {month} - 1", f"{dom} - 13", "4800", "16", key, "mdy", reverse)
            high = _permute_pair(f"{year} div 20", f"{year} % 20", "20", "20", key, "mdy29", reverse)
            pad = "lpad(cast({0} as string), {1}, '0')"
            low = _let(low, "p", f"concat_ws({sep}, {pad.format('p.l % 12 + 1', 2)}, {pad.format('p.r + 13', 2)}, cast(p.l div 12 + 1800 as string))")
            high = _let(high, "p", f"concat(left(m, 6), cast(p.l * 20 + p.r + 1800 as string))")
            other = _let(
                mdy,
                "u",
                f"case when u is null or not u between date'{FIRST_DAY}' and date'{LAST_DAY}' then null "
                f"when {dom} <= 28 then {low} when {month} != 2 then {high} end",
            )
        valid = f"d between date'{FIRST_DAY}' and date'{LAST_DAY}'"
        if kind == "date":
            return _let(read, "d", f"case when {valid} then {_let(pair, 'p', shown)} when d is null then {other} end")
        return _let(read, "d", f"if({valid}, {_let(pair, 'p', shown)}, null)")
    if kind == "ssn":
        area, group, serial = "cast(left(m, 3) as int)", "cast(substr(m, 5, 2) as int)", "cast(right(m, 4) as int)"
        index = f"({area} - if({area} > 666, 2, 1))"
        pair = _permute_pair(f"{index} * 99 + {group} - 1", f"{serial} - 1", "88902", "9999", key, kind, reverse)
        back = "p.l div 99 + if(p.l div 99 >= 665, 2, 1)"
        shown = f"concat_ws('-', lpad(cast({back} as string), 3, '0'), lpad(cast(p.l % 99 + 1 as string), 2, '0'), lpad(cast(p.r + 1 as string), 4, '0'))"
        return f"if({area} between 1 and 899 and {area} != 666 and {group} > 0 and {serial} > 0, {_let(pair, 'p', shown)}, null)"
    if kind == "iban":
        flat = "replace(m, ' ', '')"
        check = _mod97("concat(substr(x, 5), left(x, 4))")
        body = _permute_chars("substr(x, 5)", key, "iban", reverse)
        control = f"98 - {_mod97('''concat(n, left(x, 2), '00')''')}"
        whole = f"concat(left(x, 2), lpad(cast({control} as string), 2, '0'), n)"
        shown = _let(body, "n", _let(whole, "y", _laid_out("m", "y", "0-9A-Z")))
        return _let(flat, "x", f"if(length(x) between 15 and 34 and {check} = 1, {shown}, null)")
    if kind == "card":
        inner = _permute_chars("substr(x, 2, length(x) - 2)", key, "card", reverse)
        zero = _luhn("concat(n, '0')")
        whole = f"concat(n, cast((10 - {zero} % 10) % 10 as string))"
        shown = _let(f"concat(left(x, 1), {inner})", "n", _let(whole, "y", _laid_out("m", "y")))
        return _let(_digits("m"), "x", f"if({_luhn('x')} % 10 = 0 and x rlike '[1-9]', {shown}, null)")
    if kind == "phone":
        code = "regexp_extract(m, '^[+][0-9]{1,3}', 0)"
        rest = f"substr(m, length({code}) + 1)"
        new = _permute_chars("x", key, "phone", reverse)
        shown = _let(new, "y", f"concat({code}, {_laid_out('z', 'y')})")
        return _let(rest, "z", _let(_digits("z"), "x", f"if(length(x) between 7 and 15, {shown}, null)"))
    if kind == "key":
        return f"concat(left(m, 4), {_permute_chars('substr(m, 5)', key, kind, reverse)})"
    name = f"regexp_extract(m, '^{NAMED}', 0)"
    return f"concat({name}, {_permute_chars(f'substr(m, length({name}) + 1)', key, kind, reverse)})"


def _cards(run: str) -> str:
    """SQL: array<struct<b, n>>, offset and length of each card in a run of digit groups."""
    some = "trim(trailing ' -' from array_join(slice(g, gi + 1, kk), ''))"
    made = f"named_struct('kk', kk, 'raw', {some}, 'dg', translate({some}, ' -', ''))"
    sizes = "least(19, size(g) - gi)"
    valid = f"cand.dg rlike '[1-9]' and {_luhn('cand.dg')} % 10 = 0"
    fits = f"if(length(cand.dg) between 13 and 19, if({{0}}, {valid}, false), false)"
    picked = f"get(filter(transform(sequence({{0}}, 1, -1), kk -> {made}), cand -> {{1}}), 0)"
    equal = picked.format("least(4, size(g) - gi)", fits.format(f"cand.raw rlike '{EQUAL}'"))
    equal = f"transform(sequence(0, size(g) - 1), gi -> {equal})"
    # Where a run is read 19 digits at a time, those are a card in any layout.
    full = "gi >= st.chop and length(cand.dg) + length(translate(coalesce(get(g, gi + cand.kk), '9999999999'), ' -', '')) > 19"
    free = "not exists(slice(eq, gi + 1, cand.kk), e -> e is not null)"
    loose = picked.format(sizes, fits.format(f"(({full}) or cand.raw rlike '{EVEN}') and {free}"))
    pick = f"coalesce(get(eq, gi), {loose})"
    tried = f"array_max(filter(sequence(1, {sizes}), kk -> length(translate({some}, ' -', '')) between 13 and 19))"
    step = (
        "named_struct('off', st.off + length(get(g, gi)), "
        "'free', coalesce(gi + pk.kk, st.free), "
        f"'chop', case when pk.kk is not null then gi + pk.kk when gi < st.chop then st.chop else gi + coalesce({tried}, 1) end, "
        "'at', if(pk.kk is null, st.at, array_append(st.at, named_struct('b', st.off, 'n', length(pk.raw)))))"
    )
    skip = "named_struct('off', st.off + length(get(g, gi)), 'free', st.free, 'chop', st.chop, 'at', st.at)"
    start = "named_struct('off', 0, 'free', 0, 'chop', 0, 'at', cast(array() as array<struct<b:int,n:int>>))"
    fold = f"aggregate(sequence(0, size(g) - 1), {start}, (st, gi) -> if(gi < st.free, {skip}, {_let(pick, 'pk', step)}), st -> st.at)"
    return _let(f"split({run}, '(?<=[ -])')", "g", _let(equal, "eq", fold))


def _tokens(key: str, reverse: bool) -> str:
    """SQL: the candidate ``run`` as array<struct<s, x>> in order: text (s = 0), candidates of
    other kinds (1) and cards that are pseudonyms already (2)."""
    none = "cast(array() as array<struct<s:int,x:string>>)"
    ends = "array_append(sel, named_struct('b', length(run), 'n', 0))"
    past = "coalesce(get(sel, zj - 1).b + get(sel, zj - 1).n, 0)"
    between = f"substr({{0}}, {past} + 1, zz.b - {past})"
    card = _let("substr(now, zz.b + 1, zz.n)", "m", _pseudonym("card", key, reverse))
    permuted = f"array_join(transform({ends}, (zz, zj) -> concat({between.format('now')}, if(zz.n = 0, '', {card}))), '')"
    walk = _let("wk.now", "now", _let(permuted, "nx", f"named_struct('now', nx, 'ok', {_cards('nx')} <=> sel)"))
    new = f"aggregate(sequence(1, {WALKS}), named_struct('now', run, 'ok', size(sel) = 0), (wk, zk) -> if(wk.ok, wk, {walk}), wk -> wk.now)"
    rest = _let(
        f"regexp_extract_all(gap, '{BESIDE}', 0)",
        "others",
        f"flatten(transform(split(gap, '{BESIDE}', -1), (zp, zq) -> concat(array(named_struct('s', 0, 'x', zp)), "
        f"if(zq < size(others), array(named_struct('s', 1, 'x', get(others, zq))), {none}))))",
    )
    parts = (
        f"flatten(transform({ends}, (zz, zj) -> concat({_let(between.format('run'), 'gap', rest)}, "
        f"if(zz.n = 0, {none}, array(named_struct('s', 2, 'x', substr(new, zz.b + 1, zz.n)))))))"
    )
    is_run = "translate(run, '0123456789 -', '') = '' and length(translate(run, ' -', '')) >= 13"
    return f"if({is_run}, {_let(_cards('run'), 'sel', _let(new, 'new', parts))}, array(named_struct('s', 1, 'x', run)))"


def pseudonymise(
    docs: DataFrame, key: str = "ingestry", id_col: str = "doc_id", text_col: str = "text", reverse: bool = False
) -> DataFrame:
    """id, the text with pseudonyms, n_values and kinds (sorted, comma-joined)."""
    if not key.replace("-", "").replace("_", "").isalnum():
        raise ValueError("the key may hold letters, digits, - and _")
    branches = " ".join(
        f"when m rlike '^(?:{pattern})$' and {_pseudonym(kind, key, reverse)} is not null "
        f"then named_struct('k', '{kind}', 'v', {_pseudonym(kind, key, reverse)})"
        for kind, pattern in _anchored()
        if kind != "card"
    )
    df = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("t"))
    candidate = F.when(F.col("t").rlike("(?i)[0-9@]|password|passwd|secret|token"), F.regexp_extract_all("t", F.lit(ANY), F.lit(0)))
    df = df.select("_id", "t", F.coalesce(candidate, F.expr("cast(array() as array<string>)")).alias("ms"))
    df = df.select("_id", "t", "ms", F.when(F.size("ms") > 0, F.split("t", ANY, -1)).alias("pieces"))
    tokens = (
        "flatten(transform(pieces, (piece, i) -> concat(array(named_struct('s', 0, 'x', piece)), if(i < size(ms), "
        f"{_let('get(ms, i)', 'run', _tokens(key, reverse))}, cast(array() as array<struct<s:int,x:string>>)))))"
    )
    df = df.select("_id", "t", F.expr(tokens).alias("tokens"))
    plain = "named_struct('k', cast(null as string), 'v', {0})"
    value = _let("z.x", "m", f"case {branches} else {plain.format('m')} end")
    df = df.select(
        "_id",
        "t",
        F.expr(
            f"transform(tokens, z -> case z.s when 0 then {plain.format('z.x')} "
            f"when 2 then named_struct('k', 'card', 'v', z.x) else {value} end)"
        ).alias("vs"),
    )
    found = F.expr("filter(transform(coalesce(vs, array()), v -> v.k), k -> k is not null)")
    df = df.select(
        F.col("_id").alias(id_col),
        F.when(F.col("vs").isNotNull(), F.expr("array_join(transform(vs, v -> v.v), '')")).otherwise(F.col("t")).alias("text"),
        F.size(found).cast("long").alias("n_values"),
        F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("kinds"),
    )
    return settled(df)


def _anchored() -> list[tuple[str, str]]:
    """Kind and pattern without the look at the neighbours, which a candidate lacks."""
    out = []
    for kind, pattern in KINDS:
        while pattern.startswith("(?<"):
            pattern = pattern[_close(pattern) + 1 :]
        if "(?!" in pattern:
            pattern = pattern[: pattern.index("(?!")]
        out.append((kind, pattern))
    return out


def _close(pattern: str) -> int:
    depth, k, inside = 0, 0, False
    for k, c in enumerate(pattern):
        if c == "[":
            inside = True
        elif c == "]":
            inside = False
        elif not inside:
            depth += (c == "(") - (c == ")")
            if depth == 0:
                break
    return k
