"""Format-preserving pseudonyms for personal data (DataFrame and SQL functions only).

Candidates are found by one pattern, validated (check digits, octets, calendar),
and replaced by a keyed Feistel permutation of their own format: a card number
stays a valid card number of the same length and grouping, a date a date of the
same century in the same notation. The permutation depends on key and kind
alone, so equal values stay linked across documents and different values of a
format never collide.

Two Feistel networks are used, both over sha-256 of key, kind, round and the
other half: over characters (each half's digits and letters are shifted within
their own class) and over numbers of a domain a * b (the halves are residues).

Kinds: email (all but the last domain label), phone (international, country
code kept), card (13-19 digits, Luhn; first digit kept, check digit renewed),
iban (mod 97; country kept, check digits renewed), ssn (valid areas), ipv4,
date (yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy or dd/mm/yyyy).

Defined cases: a null text stays null with no finds; an empty text stays
empty; candidates that fail validation stay as they are; repeated rows get
equal results; other columns pass through unchanged (an existing ``pii``
column is replaced by ``pseudonymise``'s finds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "phone", "card", "iban", "ssn", "ipv4", "date")

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}+"
_PHONE = r"\+\d{1,3}[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
_CARD = (r"(?<![\d.])(?:\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)")
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_IPV4 = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)"
_DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-]|\.\d)"
CANDIDATE = "|".join((_EMAIL, _PHONE, _IBAN, _SSN, _IPV4, _DATE, _CARD))


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _hash(key: str, kind: str, rnd: str, half: str) -> str:
    return f"sha2(concat({_sql(key)}, '|{kind}|', {rnd}, '|', {half}), 256)"


def _shift(s: str, hexes: str) -> str:
    """Every digit and letter of ``s`` moved within its class by the hex pairs of ``hexes`` (32 of them, in turn)."""
    k = f"cast(conv(substr({hexes}, (i - 1) % 32 * 2 + 1, 2), 16, 10) AS int)"
    c = f"ascii(substr({s}, i, 1))"
    return (f"CASE WHEN length({s}) = 0 THEN '' ELSE array_join(transform(sequence(1, length({s})), i -> CASE"
            f" WHEN {c} BETWEEN 48 AND 57 THEN char(48 + ({c} - 48 + {k}) % 10)"
            f" WHEN {c} BETWEEN 97 AND 122 THEN char(97 + ({c} - 97 + {k}) % 26)"
            f" WHEN {c} BETWEEN 65 AND 90 THEN char(65 + ({c} - 65 + {k}) % 26)"
            f" ELSE substr({s}, i, 1) END), '') END")


def permute_chars(x: str, key: str, kind: str) -> str:
    """SQL: the character Feistel network over the string expression ``x``."""
    cut = f"greatest(1, length({x}) DIV 2)"
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('l', left({x}, {cut}), 'r', substr({x}, {cut} + 1)),"
            f" (s, n) -> CASE WHEN n % 2 = 1"
            f" THEN transform(array({_hash(key, kind, 'n', 's.r')}), h -> named_struct('l', {_shift('s.l', 'h')}, 'r', s.r))[0]"
            f" ELSE transform(array({_hash(key, kind, 'n', 's.l')}), h -> named_struct('l', s.l, 'r', {_shift('s.r', 'h')}))[0]"
            f" END, s -> concat(s.l, s.r))")


def permute_number(x: str, a: str, b: str, key: str, kind: str) -> str:
    """SQL: the Feistel network over the whole numbers 0 <= x < a * b, halves modulo a and b."""
    def f(half):
        return f"cast(conv(substr({_hash(key, kind, 'n', half)}, 1, 14), 16, 10) AS bigint)"
    return (f"aggregate(sequence(1, {ROUNDS}),"
            f" named_struct('l', cast({x} AS bigint) DIV {b}, 'r', cast({x} AS bigint) % {b}),"
            f" (s, n) -> CASE WHEN n % 2 = 1"
            f" THEN named_struct('l', (s.l + {f('s.r')}) % {a}, 'r', s.r)"
            f" ELSE named_struct('l', s.l, 'r', (s.r + {f('s.l')}) % {b}) END, s -> s.l * {b} + s.r)")


def _refill(pattern_of: str, chars: str) -> str:
    """SQL: the alphanumerics of ``pattern_of`` replaced one by one by those of ``chars``; separators stay."""
    return (f"aggregate(sequence(1, length({pattern_of})), named_struct('o', '', 'k', 1),"
            f" (s, i) -> CASE WHEN substr({pattern_of}, i, 1) RLIKE '[A-Za-z0-9]'"
            f" THEN named_struct('o', concat(s.o, substr({chars}, s.k, 1)), 'k', s.k + 1)"
            f" ELSE named_struct('o', concat(s.o, substr({pattern_of}, i, 1)), 'k', s.k) END, s -> s.o)")


def _luhn_sum(d: str, from_end: int) -> str:
    """SQL: the Luhn sum of the digit string; ``from_end`` 1 when its last digit is the check digit, else 2."""
    x = f"(ascii(substr({d}, length({d}) + 1 - j, 1)) - 48)"
    doubled = f"{x} * 2 - CASE WHEN {x} > 4 THEN 9 ELSE 0 END"
    odd = 0 if from_end == 1 else 1
    return (f"aggregate(sequence(1, length({d})), 0, (t, j) -> t + CASE WHEN j % 2 = {odd} THEN {doubled} ELSE {x} END)")


def _let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _mod97(s: str) -> str:
    """SQL: the number that ``s`` spells (letters as 10..35) modulo 97."""
    c = f"ascii(substr({s}, j, 1))"
    return (f"aggregate(sequence(1, length({s})), 0, (t, j) -> CASE WHEN {c} > 57"
            f" THEN (t * 100 + {c} - 55) % 97 ELSE (t * 10 + {c} - 48) % 97 END)")


def _valid_octets(m: str) -> str:
    return f"forall(split({m}, '[.]'), o -> cast(o AS int) <= 255)"


def _day(y: str, mo: str, d: str) -> str:
    return f"try_to_timestamp(concat_ws('-', {y}, {mo}, {d}), 'yyyy-MM-dd')"


def _century_start(y: str) -> str:
    return f"to_date(concat(left({y}, 2), '00-01-01'))"


def _new_day(y: str, mo: str, d: str, key: str) -> str:
    """SQL: the permuted day of the same century; a century has 75 * 487 or 92 * 397 days."""
    offset = f"datediff(to_date({_day(y, mo, d)}), {_century_start(y)})"
    long_, short = permute_number(offset, "75", "487", key, "date"), permute_number(offset, "92", "397", key, "date")
    return (f"date_add({_century_start(y)}, cast(CASE WHEN cast(left({y}, 2) AS int) % 4 = 0 THEN {long_}"
            f" ELSE {short} END AS int))")


def kind_sql(m: str) -> str:
    """SQL: the kind of a candidate, or null when it does not validate."""
    compact = f"regexp_replace({m}, ' ', '')"
    y, a, b = (f"substr({m}, {k})" for k in ("7, 4", "1, 2", "4, 2"))
    iso = _day(f"left({m}, 4)", f"substr({m}, 6, 2)", f"substr({m}, 9, 2)")
    ssn = _digits(m)
    return (f"CASE WHEN contains({m}, '@') THEN 'email' WHEN left({m}, 1) = '+' THEN 'phone'"
            f" WHEN {m} RLIKE '^[A-Z]' THEN CASE WHEN length({compact}) BETWEEN 15 AND 34 AND "
            f"{_let(f'concat(substr({compact}, 5), left({compact}, 4))', 'q', _mod97('q'))} = 1 THEN 'iban' END"
            f" WHEN {m} RLIKE '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN CASE WHEN left({ssn}, 3) NOT IN ('000', '666') AND"
            f" left({ssn}, 1) <> '9' AND substr({ssn}, 4, 2) <> '00' AND right({ssn}, 4) <> '0000' THEN 'ssn' END"
            f" WHEN {m} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' THEN CASE WHEN {iso} IS NOT NULL AND left({m}, 2) >= '01' THEN 'date' END"
            f" WHEN {m} RLIKE '^[0-9]{{2}}[.][0-9]{{2}}[.][0-9]{{4}}$' THEN CASE WHEN {_day(y, b, a)} IS NOT NULL AND {y} >= '0100' THEN 'date' END"
            f" WHEN contains({m}, '/') THEN CASE WHEN {y} >= '0100' AND ({_day(y, a, b)} IS NOT NULL OR {_day(y, b, a)} IS NOT NULL) THEN 'date' END"
            f" WHEN contains({m}, '.') THEN CASE WHEN {_valid_octets(m)} THEN 'ipv4' END"
            f" WHEN {_let(_digits(m), 'd', f'length(d) BETWEEN 13 AND 19 AND {_luhn_sum('d', 1)} % 10 = 0')} THEN 'card' END")


def pseudonym_sql(m: str, kind: str, key: str) -> str:
    """SQL: the pseudonym of the validated candidate ``m`` of the given kind."""
    top = f"(length({m}) - instr(reverse({m}), '.') + 1)"      # place of the last dot
    email = f"concat({permute_chars(f'left({m}, {top} - 1)', key, 'email')}, substr({m}, {top}))"
    code = f"regexp_extract({m}, '^[+][0-9]{{1,3}}?(?=[ .-]?[(]?[0-9]{{3}}[)]?[ .-]?[0-9]{{3}}[ .-]?[0-9]{{4}}$)', 0)"
    rest = f"substr({m}, length({code}) + 1)"
    phone = f"concat({code}, {_let(rest, 'p', _refill('p', _let(_digits('p'), 'd', permute_chars('d', key, 'phone'))))})"
    body = _let(permute_chars("substr(d, 2, length(d) - 2)", key, "card"), "b",
                _let("concat(left(d, 1), b)", "e", f"concat(e, char(48 + (10 - {_luhn_sum('e', 2)} % 10) % 10))"))
    card = _let(_digits(m), "d", _let(body, "n", _refill(m, "n")))
    bban = permute_chars("substr(c, 5)", key, "iban")
    check = _let("concat(b, left(c, 2), '00')", "q", f"lpad(cast(98 - {_mod97('q')} AS string), 2, '0')")
    iban = _let(f"regexp_replace({m}, ' ', '')", "c",
                _let(bban, "b", _let(f"concat(left(c, 2), {check}, b)", "n", _refill(m, "n"))))
    # areas 001-665 and 667-899, groups 01-99, serials 0001-9999 numbered without gaps
    area = f"cast(left({m}, 3) AS int)"
    number = (f"(({area} - CASE WHEN {area} > 666 THEN 2 ELSE 1 END) * 99L + cast(substr({m}, 5, 2) AS int) - 1) * 9999L"
              f" + cast(right({m}, 4) AS int) - 1")
    ssn = _let(permute_number(number, "88902", "9999", key, "ssn"), "v",
               "concat_ws('-', lpad(cast(v DIV 989901 + CASE WHEN v DIV 989901 >= 665 THEN 2 ELSE 1 END AS string), 3, '0'),"
               " lpad(cast(v DIV 9999 % 99 + 1 AS string), 2, '0'), lpad(cast(v % 9999 + 1 AS string), 4, '0'))")
    ip = _let(permute_number(f"aggregate(split({m}, '[.]'), 0L, (t, o) -> t * 256 + cast(o AS int))", "65536", "65536", key, "ipv4"),
              "v", "concat_ws('.', cast(v DIV 16777216 AS string), cast(v DIV 65536 % 256 AS string),"
              " cast(v DIV 256 % 256 AS string), cast(v % 256 AS string))")
    y, a, b = (f"substr({m}, {k})" for k in ("7, 4", "1, 2", "4, 2"))
    date = (f"CASE WHEN substr({m}, 5, 1) = '-' THEN date_format({_new_day(f'left({m}, 4)', f'substr({m}, 6, 2)', f'substr({m}, 9, 2)', key)}, 'yyyy-MM-dd')"
            f" WHEN contains({m}, '.') THEN date_format({_new_day(y, b, a, key)}, 'dd.MM.yyyy')"
            f" WHEN {_day(y, a, b)} IS NOT NULL THEN date_format({_new_day(y, a, b, key)}, 'MM/dd/yyyy')"
            f" ELSE date_format({_new_day(y, b, a, key)}, 'dd/MM/yyyy') END")
    return (f"CASE {kind} WHEN 'email' THEN {email} WHEN 'phone' THEN {phone} WHEN 'card' THEN {card}"
            f" WHEN 'iban' THEN {iban} WHEN 'ssn' THEN {ssn} WHEN 'ipv4' THEN {ip} WHEN 'date' THEN {date} ELSE {m} END")


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the text column pseudonymised and a column ``pii`` of the finds (kind, value, pseudonym).

    Only texts with a digit or an @ are searched: every kind holds one.
    """
    cols = [c for c in docs.columns if c != "pii"]
    t = f"`{text_col}`"
    cand = (f"CASE WHEN {t} RLIKE '[0-9@]' THEN transform(transform(regexp_extract_all({t}, {_sql(CANDIDATE)}, 0),"
            f" m -> named_struct('value', m, 'kind', {kind_sql('m')})),"
            f" f -> named_struct('kind', f.kind, 'value', f.value, 'pseudonym', {pseudonym_sql('f.value', 'f.kind', key)}))"
            f" ELSE array() END")
    found = docs.select(*[F.col(f"`{c}`") for c in cols], F.expr(cand).alias("__pii"))
    text = (f"CASE WHEN exists(__pii, f -> f.kind IS NOT NULL) THEN array_join(zip_with(split({t}, {_sql(CANDIDATE)}, -1),"
            f" __pii, (gap, f) -> concat(gap, coalesce(f.pseudonym, ''))), '') ELSE {t} END")
    return found.select(*[F.expr(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in cols],
                        F.filter("__pii", lambda f: f["kind"].isNotNull()).alias("pii"))
