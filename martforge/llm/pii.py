"""Personal data: format-preserving Feistel pseudonyms.

Numbers, dates and mail names are found by one pattern, validated by kind
(check digits, ranges, calendar), and replaced by a keyed permutation of the
same format: a valid card number becomes another valid card number, a date
another date. The permutation depends on the key and the value only, so equal
values stay linked across documents, and whoever holds the key can invert it.

Two Feistel networks, both of an even number of rounds keyed by SHA-256:
over characters (halves of a string, each character shifted within digits,
small or capital letters) and over numbers (x = a * q + b with a below p and b
below q, for domains of exactly p * q values, so that no value leaves it).

Only DataFrame expressions are used. The network runs as an ``aggregate`` over
its rounds inside a ``transform`` over the few matches of a text; texts without
a digit are passed through.

Defined results: a null text stays null with no finds; a candidate that fails
its validation is left as it is; rows with a null doc_id and repeated rows
each get their row; texts of any length are read whole; equal values get equal
pseudonyms; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "phone", "iban", "ssn", "date", "ip", "card")
KEY = "pseudonym-key-1"
ROUNDS = 8
DAYS = (189, 773)            # 146,097 days: the 400 years from FIRST_DAY on
FIRST_DAY = "1800-01-01"
SSN = (898, 99 * 9999)       # areas without 000, 666 and 9xx; groups and serials without zero
ADDRESS = (1 << 16, 1 << 16)

# Account lengths by country (IBAN registry), for accounts printed in groups of four.
ACCOUNT_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MN MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
GROUPED = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:[ -][A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f"[ -][A-Z0-9]{{{n % 4}}}" if n % 4 else "")
                   for n, c in ACCOUNT_LENGTHS.items())
# Phone numbers without a country code: with an area in brackets, 3-3-4, or with a trunk zero.
NATIONAL = (r"\([0-9]{2,5}\)[ .-]?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}"
            r"|(?:1[ .-])?(?:\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4}"
            r"|[2-9][0-9]{2} [2-9][0-9]{2} [0-9]{4})"
            r"|0[1-9][0-9]{1,3}[ /-][0-9]{3,4}[ -]?[0-9]{3,5}")
# ITU country codes: one or two digits, or else three.
COUNTRY = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"

# One pattern for all candidates; the alternatives exclude one another by
# their first characters or are tried in this order.
CANDIDATE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}(?![A-Za-z0-9])"
    r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![0-9A-Za-z])"
    rf"|(?<![0-9A-Za-z])(?:{GROUPED})(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
    r"|(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9A-Za-z-])"
    r"|(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
    r"|(?<![0-9A-Za-z.])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z.])[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}(?![0-9A-Za-z])"
    rf"|(?<![0-9A-Za-z.(+/-])(?:{NATIONAL})(?![0-9A-Za-z]|[ .-][0-9])"
)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hash(key: str, kind: str, turn: str, value: str) -> str:
    return f"sha2(concat({_literal(key + '|' + kind + '|')}, {turn}, '|', {value}), 256)"


def permute_text(value: str, key: str, kind: str) -> str:
    """SQL: a keyed permutation of the strings of the same shape as ``value``."""
    shift = f"cast(conv(substr({_hash(key, kind, 't', 'h.b')}, 4 * (i % 16) + 1, 4), 16, 10) AS int)"
    turned = (f"CASE WHEN c BETWEEN '0' AND '9' THEN chr(48 + (ascii(c) - 48 + {shift}) % 10) "
              f"WHEN c BETWEEN 'a' AND 'z' THEN chr(97 + (ascii(c) - 97 + {shift}) % 26) "
              f"WHEN c BETWEEN 'A' AND 'Z' THEN chr(65 + (ascii(c) - 65 + {shift}) % 26) ELSE c END")
    return (f"aggregate(sequence(1, {ROUNDS}), "
            f"named_struct('a', left({value}, length({value}) div 2), 'b', substr({value}, length({value}) div 2 + 1)), "
            f"(h, t) -> named_struct('a', h.b, 'b', array_join(transform(split(h.a, ''), (c, i) -> {turned}), '')), "
            "h -> concat(h.a, h.b))")


def permute_number(value: str, domain: tuple[int, int], key: str, kind: str) -> str:
    """SQL: a keyed permutation of 0 .. p*q-1."""
    p, q = domain

    def noise(turn: str, part: str) -> str:
        return f"cast(conv(substr({_hash(key, kind, turn, part)}, 1, 12), 16, 10) AS bigint)"
    first = f"((h.a + {noise('t', 'h.b')}) % {p})"
    return (f"aggregate(sequence(1, {ROUNDS // 2}), "
            f"named_struct('a', cast({value} AS bigint) div {q}L, 'b', cast({value} AS bigint) % {q}L), "
            f"(h, t) -> named_struct('a', {first}, 'b', (h.b + {noise('-t', first)}) % {q}), h -> h.a * {q}L + h.b)")


def luhn_sum(digits: str) -> str:
    digit = f"cast(substr({digits}, length({digits}) + 1 - k, 1) AS int)"
    return (f"aggregate(sequence(1, length({digits})), 0, (s, k) -> s + "
            f"CASE WHEN k % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)")


def mod97(text: str) -> str:
    """SQL: an account text (letters count 10 to 35) modulo 97."""
    return (f"aggregate(split({text}, ''), 0, (s, c) -> "
            "CASE WHEN c BETWEEN 'A' AND 'Z' THEN (s * 100 + ascii(c) - 55) % 97 ELSE (s * 10 + cast(c AS int)) % 97 END)")


def in_layout(layout: str, digits: str, places: str = "[0-9]") -> str:
    """SQL: ``layout`` with its digits (characters of the class ``places``)
    replaced by ``digits`` in order."""
    return (f"array_join(zip_with(split({layout}, '{places}', -1), concat(split({digits}, ''), array('')), "
            "(x, y) -> concat(x, y)), '')")


def _bind(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


# Shape and layout; with slashes the day comes first where that is a date.
_DAY_FORMATS = [("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"), ("^[0-9]{4}-", "yyyy-M-d"),
                ("^[0-9]{2}/[0-9]{2}/", "dd/MM/yyyy"), ("/", "d/M/yyyy"),
                ("^[0-9]{2}[.][0-9]{2}[.][0-9]{4}$", "dd.MM.yyyy"), ("[.]", "d.M.yyyy")]


def _date_case(m: str, key: str) -> str:
    cases = []
    for pattern, layout in _DAY_FORMATS:
        day = f"cast(try_to_timestamp({m}, '{layout}') AS date)"
        moved = permute_number("n", DAYS, key, "date")
        new = f"date_add(DATE'{FIRST_DAY}', cast({moved} AS int))"
        out = f"date_format({new}, '{layout}')"
        if "/" in layout:
            swapped = "/".join([*layout.split("/")[1::-1], "yyyy"])
            other = f"cast(try_to_timestamp({m}, '{swapped}') AS date)"
            # A month-first date stays month first unless it would then be read as another day.
            out = _bind("w", new, f"date_format(w, CASE WHEN {day} IS NULL AND day(w) > 12 THEN '{swapped}' ELSE '{layout}' END)")
            day = f"coalesce({day}, {other})"
        number = f"datediff({day}, DATE'{FIRST_DAY}')"
        cases.append(f"WHEN {m} RLIKE '{pattern}' THEN " + _bind(
            "n", number, f"CASE WHEN n BETWEEN 0 AND {DAYS[0] * DAYS[1] - 1} THEN {out} END"))
    return f"CASE {' '.join(cases)} END"


def _octet(m: str, i: int) -> str:
    return f"cast(split({m}, '[.]')[{i}] AS bigint)"


def replacement(m: str, key: str = KEY) -> str:
    """SQL: struct(kind, new) of a candidate; ``new`` is null if it fails its
    validation."""
    name = f"substring_index({m}, '@', 1)"
    email = f"concat({permute_text(name, key, 'email')}, '@', substring_index({m}, '@', -1))"
    # The country code of a phone number stays, however the number is laid
    # out; so does the 1 or trunk zero of a national number, whose other digits
    # are permuted like those behind a country code.
    def phone_number(prefix: str) -> str:
        return _bind("d", f"regexp_replace({m}, '[^0-9]', '')", "CASE WHEN length(d) BETWEEN 7 AND 18 THEN " + _bind(
            "k", prefix, in_layout(m, f"concat(k, {permute_text('substr(d, length(k) + 1)', key, 'phone')})")) + " END")
    phone = phone_number(f"regexp_extract(d, '^({COUNTRY})', 0)")
    national = phone_number(f"CASE WHEN {m} RLIKE '^1[ .-]' OR {m} RLIKE '^0[1-9][0-9]{{1,3}}[ /-]' "
                            f"AND NOT {m} RLIKE '^[0-9]{{3}}-[0-9]{{3}}-[0-9]{{4}}$' THEN left(d, 1) ELSE '' END")
    iban = _bind("t", f"regexp_replace({m}, '[ -]', '')", "CASE WHEN {check} = 1 THEN {new} END".format(
        check=mod97("concat(substr(t, 5), left(t, 4))"),
        new=_bind("w", permute_text("substr(t, 5)", key, "iban"), in_layout(m, (
            f"concat(left(t, 2), lpad(cast(98 - {mod97("concat(w, left(t, 2), '00')")} AS string), 2, '0'), w)"), "[0-9A-Z]"))))
    area, group, serial = (f"cast({x} AS int)" for x in (f"left({m}, 3)", f"substr({m}, 5, 2)", f"right({m}, 4)"))
    place = f"(({area} - 1 - CASE WHEN {area} > 666 THEN 1 ELSE 0 END) * {SSN[1]}L + ({group} - 1) * 9999L + {serial} - 1)"
    new_area = f"(x div {SSN[1]}L + 1 + CASE WHEN x div {SSN[1]}L + 1 >= 666 THEN 1 ELSE 0 END)"
    ssn = (f"CASE WHEN {area} NOT IN (0, 666) AND {area} < 900 AND {group} > 0 AND {serial} > 0 THEN " + _bind(
        "x", permute_number(place, SSN, key, "ssn"),
        f"concat(lpad(cast({new_area} AS string), 3, '0'), '-', "
        f"lpad(cast((x % {SSN[1]}L) div 9999 + 1 AS string), 2, '0'), '-', "
        f"lpad(cast((x % {SSN[1]}L) % 9999 + 1 AS string), 4, '0'))") + " END")
    number = " + ".join(f"{_octet(m, i)} * {256 ** (3 - i)}L" for i in range(4))
    valid = " AND ".join(f"{_octet(m, i)} < 256" for i in range(4))
    ip = (f"CASE WHEN {valid} THEN " + _bind(
        "x", permute_number(f"({number})", ADDRESS, key, "ip"),
        "concat_ws('.', " + ", ".join(f"cast((x div {256 ** (3 - i)}L) % 256 AS string)" for i in range(4)) + ")") + " END")
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    payload = "left(d, length(d) - 1)"
    card = _bind("d", digits, f"CASE WHEN length(d) BETWEEN 13 AND 19 AND {luhn_sum('d')} % 10 = 0 THEN " + _bind(
        "w", permute_text(payload, key, "card"),
        in_layout(m, f"concat(w, cast((10 - {luhn_sum('''concat(w, '0')''')} % 10) % 10 AS string))")) + " END")
    date = _date_case(m, key)
    cases = [(f"{m} LIKE '%@%'", "email", email), (f"{m} LIKE '+%'", "phone", phone),
             (f"{m} RLIKE '^[A-Z]'", "iban", iban), (f"{m} RLIKE '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$'", "ssn", ssn),
             (f"{m} RLIKE '^([0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}|[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}|"
              "[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4})$'", "date", date),
             (f"{m} RLIKE {_literal(f'^(?:{NATIONAL})$')}", "phone", national),
             (f"{m} LIKE '%.%'", "ip", ip)]
    whens = " ".join(f"WHEN {test} THEN named_struct('kind', '{kind}', 'new', {new})" for test, kind, new in cases)
    return f"CASE {whens} ELSE named_struct('kind', 'card', 'new', {card}) END"


def candidates() -> Column:
    """All candidates of ``_text``, in order."""
    return F.expr(f"CASE WHEN _text RLIKE '[0-9]' OR _text LIKE '%@%' "
                  f"THEN regexp_extract_all(_text, {_literal(CANDIDATE)}, 0) ELSE array() END")


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per document: doc_id, n_found, the number of replaced values of
    each kind, and the text with every validated value replaced."""
    found = docs.select("doc_id", F.col("text").alias("_text")) \
        .select("doc_id", "_text", candidates().alias("_found"))
    rest = F.expr(f"CASE WHEN size(_found) > 0 THEN split(_text, {_literal(CANDIDATE)}, -1) END")
    changed = F.expr(f"transform(_found, m -> {replacement('m', key)})")
    parts = found.select("doc_id", "_text", "_found", rest.alias("_rest"), changed.alias("_new"))
    text = F.expr("""CASE WHEN _rest IS NULL THEN _text ELSE array_join(zip_with(_rest,
        concat(zip_with(_found, _new, (m, n) -> coalesce(n.new, m)), array('')), (x, y) -> concat(x, y)), '') END""")
    counts = [F.expr(f"cast(size(filter(coalesce(_new, array()), n -> n.kind = '{k}' AND n.new IS NOT NULL)) AS bigint)")
              .alias(f"n_{k}") for k in KINDS]
    total = F.expr("cast(size(filter(coalesce(_new, array()), n -> n.new IS NOT NULL)) AS bigint)")
    return parts.select("doc_id", total.alias("n_found"), *counts, text.alias("text"))
