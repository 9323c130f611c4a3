"""Format-preserving pseudonyms for personal data, in Spark SQL functions only.

Numbers and dates are found by pattern and validated (Luhn sum of card numbers,
mod-97 sum of IBANs, octets of IPv4 addresses, ranges of social security numbers, calendar of
dates, 8 to 15 digits of phone numbers); what fails stays.  A valid value is permuted within its format by a
keyed Feistel network, so it keeps length, separators and validity:

- card numbers: the digits before the check digit, which is computed anew;
- IBANs: the digits after the check digits, which are computed anew; letters stay;
- phone numbers: all digits after the country code, which is told by its first digits (one written without a country code
  has ten digits and counts as one of code 1, so all spellings of a number have the same new digits);
- social security numbers: within the valid ones;
- IPv4 addresses: the 32 bits;
- dates of 1900-2099, in numbers or with an English month: the 73,049 days of that span, as 17 x 4,297.

The permutation depends on the key, the kind and the number of digits only:
equal values have equal pseudonyms in all documents, different ones different.
What is no number is replaced by a keyed digest of the value: e-mail addresses and
IPv6 addresses of eight groups (case ignored), quoted hexadecimal secrets and those after a name like
``api_key=`` (length and case kept), and access tokens with a known beginning (which stays, as does the length).

The key is the caller's: who knows it can undo the permutations.  It stands in the
plan, so plans and event logs of a job are to be kept as it is.

Every text that holds a digit or another sign of a value is searched once: matches are set between marks, at which it is then cut (a text that
holds the mark is cut at the matches by two searches).  A null text stays null, an empty one empty; texts are searched whole; matches
do not overlap (the leftmost, then the first kind listed in ``PATTERN`` wins).
Repeated rows get equal results, input columns named like an output column are
replaced; the text column is found as Spark finds it, case aside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import fresh, replace_columns

ROUNDS = 8
MARK = "\uf8a1"    # of a private use area
TOKEN_START = "gh[oprsu]_|AKIA"

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
SECRET = (r'(?=[0-9A-Fa-f]{32})(?:(?<=[=:] ?")[0-9A-Fa-f]{32,}+(?=")'
          r"|(?<=(?i:key|token|secret|passwd|password)[=:] ?)[0-9A-Fa-f]{32,}+(?![0-9A-Za-z]))")
TOKEN = rf"(?<![0-9A-Za-z_])(?:gh[oprsu]_[0-9A-Za-z]{{36,}}+|AKIA[0-9A-Z]{{16}})(?![0-9A-Za-z_])"
IPV6 = r"(?<![0-9A-Za-z_:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z_:])"
IPV4 = r"(?<![0-9A-Za-z_.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z_]|\.[0-9])"
PHONE = (r"(?<![0-9A-Za-z_])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z_])"
         r"|(?<![0-9A-Za-z_])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{2,6})(?:[ .-]?[0-9]{2,6}){1,4}(?![0-9A-Za-z_])"
         r"|(?<![0-9A-Za-z_])\+[0-9]{8,15}(?![0-9A-Za-z_])"
         r"|(?<![0-9A-Za-z_])\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z_])"
         r"|(?<![0-9A-Za-z_.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z_]|[.-][0-9])")
SSN = r"(?<![0-9A-Za-z_-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z_-])"
MONTH = ("(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?"
         "|Nov(?:ember)?|Dec(?:ember)?)")
DATE = (r"(?<![0-9A-Za-z_./-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z_-])"
        r"|(?<![0-9A-Za-z_./-])[0-9]{1,2}([./-])[0-9]{1,2}\1[0-9]{4}(?![0-9A-Za-z_/-])"
        rf"|(?<![0-9A-Za-z_])[0-9]{{1,2}} {MONTH} [0-9]{{4}}(?![0-9A-Za-z_])"
        rf"|(?=[JFMASOND])(?<![0-9A-Za-z_]){MONTH} [0-9]{{1,2}}, [0-9]{{4}}(?![0-9A-Za-z_])")
IBAN = r"(?<![0-9A-Za-z_])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z_])"
CARD = (r"(?<![0-9A-Za-z_])[0-9]{13,19}(?![0-9A-Za-z_])"
        r"|(?<![0-9A-Za-z_])[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{1,3})?(?![0-9A-Za-z_])"
        r"|(?<![0-9A-Za-z_])[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9A-Za-z_])")
#: What every match holds: texts without any are not searched.
SIGN = "[0-9@]|[A-Fa-f]{32}|gh[oprsu]_|AKIA"
PATTERN = "|".join((EMAIL, SECRET, TOKEN, IPV6, IPV4, PHONE, SSN, DATE, IBAN, CARD))
# The first digits of international calling codes tell their length.
CALLING_CODE = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``name`` bound to ``value``, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _round(key: str, tag: str, i: str, x: str) -> str:
    """A keyed pseudo-random number below 2^60."""
    return f"CAST(conv(substr(sha2(concat_ws(':', {key}, {tag}, {i}, {x}), 256), 1, 15), 16, 10) AS BIGINT)"


def _feistel(a: str, b: str, size_a: str, size_b: str, key: str, tag: str) -> str:
    """SQL of a struct (a, b): the pair permuted within size_a x size_b by alternating keyed additions."""
    return f"""aggregate(sequence(1, {ROUNDS}), named_struct('a', {a}, 'b', {b}), (s, i) -> CASE WHEN i % 2 = 1
        THEN named_struct('a', pmod(s.a + {_round(key, tag, 'i', 's.b')}, {size_a}), 'b', s.b)
        ELSE named_struct('a', s.a, 'b', pmod(s.b + {_round(key, tag, 'i', 's.a')}, {size_b})) END)"""


def _digits_permuted(d: str, key: str, kind: str) -> str:
    """SQL of a digit string of at least two digits, permuted among those of its length."""
    u, v = f"CAST(length({d}) DIV 2 AS INT)", f"CAST(length({d}) - length({d}) DIV 2 AS INT)"
    ten = "CAST(power(10, {}) AS BIGINT)"
    pair = _feistel(f"CAST(left({d}, {u}) AS BIGINT)", f"CAST(right({d}, {v}) AS BIGINT)", ten.format(u), ten.format(v),
                    key, f"concat('{kind}', length({d}))")
    return _let(pair, "p", f"concat(lpad(CAST(p.a AS STRING), {u}, '0'), lpad(CAST(p.b AS STRING), {v}, '0'))")


def _luhn(d: str, doubled: int) -> str:
    """SQL of the Luhn sum; ``doubled``: 1 if d ends with a check digit, else 0."""
    digit = f"CAST(substr({d}, k, 1) AS INT)"
    return f"""aggregate(sequence(1, length({d})), 0, (s, k) -> s + CASE WHEN (length({d}) - k) % 2 = {doubled}
        THEN 2 * {digit} - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END ELSE {digit} END)"""


def _into_format(match: str, digits: str) -> str:
    """SQL of ``match`` with its digits, in order, replaced by those of ``digits``."""
    return f"""aggregate(sequence(1, length({match})), named_struct('out', '', 'k', 1), (s, j) ->
        CASE WHEN substr({match}, j, 1) BETWEEN '0' AND '9'
        THEN named_struct('out', concat(s.out, substr({digits}, s.k, 1)), 'k', s.k + 1)
        ELSE named_struct('out', concat(s.out, substr({match}, j, 1)), 'k', s.k) END, s -> s.out)"""


def _card(m: str, key: str) -> str:
    payload = _digits_permuted("left(d, length(d) - 1)", key, "card")
    new = _let(payload, "q", f"concat(q, CAST(pmod(10 - {_luhn('q', 0)} % 10, 10) AS STRING))")
    made = _let(new, "n", _into_format(m, "n"))
    return _let(f"regexp_replace({m}, '[^0-9]', '')", "d",
                f"CASE WHEN length(d) BETWEEN 13 AND 19 AND {_luhn('d', 1)} % 10 = 0 THEN {made} ELSE {m} END")


def _phone(m: str, key: str) -> str:
    """The digits after the country code, permuted; without a country code, all ten.

    Of a match of more than 15 digits (figures that follow a number) the groups up to the fifteenth digit.
    """
    code = f"CASE WHEN left({m}, 1) = '+' THEN regexp_extract(d, '{CALLING_CODE}', 0) ELSE '' END"
    new = _digits_permuted("substr(d, length(c) + 1)", key, "phone")
    made = _let(code, "c", f"CASE WHEN length(d) - length(c) >= 4 THEN {_let(f'concat(c, {new})', 'n', _into_format('t', 'n'))} ELSE t END")
    whole = _let("regexp_replace(t, '[^0-9]', '')", "d", f"CASE WHEN length(d) BETWEEN 8 AND 15 THEN {made} ELSE t END")
    most = f"regexp_extract({m}, '^[+](?:[ .()-]{{0,2}}[0-9]){{8,15}}(?![0-9])', 0)"
    part = f"CASE WHEN length(regexp_replace({m}, '[^0-9]', '')) > 15 THEN {most} ELSE {m} END"
    return _let(part, "t", f"concat({whole}, substr({m}, length(t) + 1))")


def _mod97(text: str) -> str:
    """SQL of a number with letters A = 10 ... Z = 35, modulo 97."""
    char = f"substr({text}, k, 1)"
    return f"""aggregate(sequence(1, length({text})), 0, (s, k) -> CASE WHEN {char} >= 'A'
        THEN (s * 100 + ascii({char}) - 55) % 97 ELSE (s * 10 + CAST({char} AS INT)) % 97 END)"""


def _iban(m: str, key: str) -> str:
    """Country and letters stay, the digits behind the check digits are permuted, the check digits follow."""
    new = _into_format("substr(v, 5)", _digits_permuted("regexp_replace(substr(v, 5), '[^0-9]', '')", key, "iban"))
    check = _let(f"concat(b, left(v, 2), '00')", "w", f"lpad(CAST(98 - {_mod97('w')} AS STRING), 2, '0')")
    made = _let(new, "b", _let(f"concat(left(v, 2), {check}, b)", "n", f"""aggregate(sequence(1, length({m})),
        named_struct('out', '', 'k', 1), (s, j) -> CASE WHEN substr({m}, j, 1) = ' ' THEN named_struct('out', concat(s.out, ' '), 'k', s.k)
        ELSE named_struct('out', concat(s.out, substr(n, s.k, 1)), 'k', s.k + 1) END, s -> s.out)"""))
    valid = f"length(regexp_replace(substr(v, 5), '[^0-9]', '')) BETWEEN 4 AND 30 AND {_let('concat(substr(v, 5), left(v, 4))', 'u', _mod97('u'))} = 1"
    return _let(f"replace({m}, ' ', '')", "v", f"CASE WHEN {valid} THEN {made} ELSE {m} END")


def _ssn(m: str, key: str) -> str:
    """Within the valid numbers: areas 1-899 but 666, groups 1-99, serials 1-9999."""
    area = f"CAST(substr({m}, 1, 3) AS BIGINT)"
    index = f"({area} - CASE WHEN {area} > 666 THEN 2 ELSE 1 END)"
    rest = f"((CAST(substr({m}, 5, 2) AS BIGINT) - 1) * 9999 + CAST(substr({m}, 8, 4) AS BIGINT) - 1)"
    valid = (f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND substr({m}, 5, 2) <> '00' "
             f"AND substr({m}, 8, 4) <> '0000'")
    made = _let(_feistel(index, rest, "898L", "989901L", key, "'ssn'"), "p",
                "concat(lpad(CAST(p.a + CASE WHEN p.a >= 665 THEN 2 ELSE 1 END AS STRING), 3, '0'), '-', "
                "lpad(CAST(p.b DIV 9999 + 1 AS STRING), 2, '0'), '-', lpad(CAST(p.b % 9999 + 1 AS STRING), 4, '0'))")
    return f"CASE WHEN {valid} THEN {made} ELSE {m} END"


def _ipv4(m: str, key: str) -> str:
    octet = "CAST(o[{}] AS BIGINT)"
    pair = _feistel(f"{octet.format(0)} * 256 + {octet.format(1)}", f"{octet.format(2)} * 256 + {octet.format(3)}",
                    "65536L", "65536L", key, "'ipv4'")
    made = _let(pair, "p", "concat_ws('.', p.a DIV 256, p.a % 256, p.b DIV 256, p.b % 256)")
    return _let(f"split({m}, '[.]')", "o", f"CASE WHEN forall(o, x -> CAST(x AS INT) <= 255) THEN {made} ELSE {m} END")


def _date(m: str, key: str) -> str:
    """yyyy-MM-dd, day and month in either order before the year (day first where both are valid), or an English month."""
    def made(date: str, shown: str) -> str:
        days = f"CAST(datediff({date}, DATE'1900-01-01') AS BIGINT)"
        pair = _feistel(f"{days} DIV 4297", f"{days} % 4297", "17L", "4297L", key, "'date'")
        return _let(pair, "p", _let("date_add(DATE'1900-01-01', CAST(p.a * 4297 + p.b AS INT))", "t", shown))

    inside = "{0} BETWEEN DATE'1900-01-01' AND DATE'2099-12-31'"
    iso = f"try_to_date({m}, 'yyyy-MM-dd')"
    year_first = f"CASE WHEN {inside.format(iso)} THEN {made(iso, 'CAST(t AS STRING)')} ELSE {m} END"

    def part(k: int) -> str:
        return f"lpad(element_at(split({m}, '[./-]'), {k}), 2, '0')"

    def turned(day: int, month: int) -> str:
        return f"try_to_date(concat_ws('-', element_at(split({m}, '[./-]'), 3), {part(month)}, {part(day)}), 'yyyy-MM-dd')"

    def shown(first: str, second: str) -> str:
        # Ten characters: two digits each for day and month; shorter ones go without leading zeros.
        long = f"concat_ws(regexp_extract({m}, '[./-]', 0), {first}, {second}, 'yyyy')"
        short = f"concat_ws(regexp_extract({m}, '[./-]', 0), {first[:2]}', {second[:2]}', 'yyyy')"
        return f"date_format(t, CASE WHEN length({m}) = 10 THEN {long} ELSE {short} END)"

    day_first, month_first = turned(1, 2), turned(2, 1)
    def named(form: str) -> str:
        """SQL of a date with the month's name; NULL if it is not of the form."""
        date = f"try_to_date({m}, '{form}')"
        return f"CASE WHEN {inside.format(date)} THEN {made(date, f"date_format(t, '{form}')")} END"

    names = ", ".join(named(form) for form in ("d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy"))
    return f"""CASE WHEN {m} LIKE '____-%' THEN {year_first}
        WHEN {m} RLIKE '[A-Z]' THEN coalesce({names}, {m})
        WHEN {inside.format(day_first)} THEN {made(day_first, shown("'dd'", "'MM'"))}
        WHEN {inside.format(month_first)} THEN {made(month_first, shown("'MM'", "'dd'"))}
        ELSE {m} END"""


def _pseudonym(m: str, key: str) -> str:
    """SQL of what stands for the match ``m`` (itself if it is not valid)."""
    digest = f"sha2(concat_ws(':', {key}, 'mail', lower({m})), 256)"
    hexed = f"left(repeat(sha2(concat_ws(':', {key}, 'secret', lower({m})), 512), CAST(length({m}) DIV 128 + 1 AS INT)), length({m}))"
    start = f"regexp_extract({m}, '^(?:{TOKEN_START})', 0)"
    token = f"left(concat({start}, repeat(sha2(concat_ws(':', {key}, 'token', {m}), 512), CAST(length({m}) DIV 128 + 1 AS INT))), length({m}))"
    ipv6 = f"""regexp_replace(left(sha2(concat_ws(':', {key}, 'ipv6', array_join(transform(split(lower({m}), ':'),
        x -> lpad(x, 4, '0')), ':')), 256), 32), '(....)(?=.)', '$1:')"""
    return f"""CASE
        WHEN contains({m}, '@') THEN concat('user-', left({digest}, 12), '@', substr({digest}, 13, 8), '.invalid')
        WHEN {m} RLIKE '^[0-9A-Fa-f]{{32,}}$' THEN CASE WHEN {m} = upper({m}) THEN upper({hexed}) ELSE {hexed} END
        WHEN {m} RLIKE '^(?:{TOKEN_START})' THEN CASE WHEN {m} LIKE 'AKIA%' THEN upper({token}) ELSE {token} END
        WHEN {m} RLIKE '^(?:[0-9A-Fa-f]{{1,4}}:){{7}}' THEN {ipv6}
        WHEN {m} RLIKE '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$' THEN {_ipv4(m, key)}
        WHEN {m} RLIKE '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}[./-][0-9]{{1,2}}[./-][0-9]{{4}}|[0-9]{{1,2}} [A-Z].*|[A-Z][a-z].*)$' THEN {_date(m, key)}
        WHEN {m} RLIKE '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN {_ssn(m, key)}
        WHEN {m} RLIKE '^([+(]|[0-9]{{3}}[.-][0-9]{{3}}[.-][0-9]{{4}}$)' THEN {_phone(m, key)}
        WHEN {m} RLIKE '^[A-Z]{{2}}' THEN {_iban(m, key)}
        ELSE {_card(m, key)} END"""


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the text replaced and ``n_pseudonyms``, the number of values replaced in it; ``key`` as in the module."""
    if not key:
        raise ValueError("pseudonyms need a key")
    base = replace_columns(docs, "n_pseudonyms")
    rx, secret, mark = _sql(PATTERN), _sql(key), _sql(MARK)
    at = docs.select(F.col(text_col)).columns[0]
    name = next(c for c in base.columns if c == at or c.lower() == at.lower())
    parts, new = fresh(base, "_parts"), fresh(base, "_new")
    text = f"`{name}`"
    # Every second part is a match; without one there is one part.
    cut = f"""CASE WHEN NOT {text} RLIKE '{SIGN}' THEN array({text}) WHEN contains({text}, {mark})
        THEN flatten(zip_with(split({text}, {rx}, -1), regexp_extract_all({text}, {rx}, 0), (x, y) -> array(x, coalesce(y, ''))))
        ELSE split(regexp_replace({text}, {rx}, {_sql(MARK + "$0" + MARK)}), {mark}, -1) END"""
    swapped = f"""CASE WHEN size({parts}) > 1 THEN transform({parts}, (m, i) -> CASE WHEN i % 2 = 1 AND m <> ''
        THEN {_pseudonym('m', secret)} ELSE m END) END"""
    out = base.withColumn(parts, F.expr(cut)).withColumn(new, F.expr(swapped))
    changed = f"coalesce(CAST(size(filter(zip_with({parts}, {new}, (x, y) -> x <> y), z -> z)) AS BIGINT), 0L)"
    keep = [F.expr(f"coalesce(array_join({new}, ''), {text})").alias(c) if c == name else F.col(f"`{c}`") for c in base.columns]
    return out.select(*keep, F.expr(f"CASE WHEN {new} IS NULL THEN 0L ELSE {changed} END").alias("n_pseudonyms"))
