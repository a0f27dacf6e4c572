"""Format-preserving Feistel pseudonyms for validated numbers and dates.

Everything is column expressions. A value of a format is a pair of halves
(left < a, right < b); keyed rounds change one half by a hash of the other, and
the result is printed in the same format. So each key is a permutation of every
format, and equal values stay equal across documents, tasks and runs.

Formats: payment card numbers (13 to 19 digits with a right Luhn digit; the first
digit stays, the check digit is computed anew), IBAN (right mod-97 check, with or
without blanks after every fourth character; country and leading part stay, digits
become digits and letters letters), telephone numbers (+country code, or the ten digits
of North America with hyphens, dots or blanks), US social security numbers, IPv4
addresses, and dates of the years 1800 to 2199 as yyyy-mm-dd, dd-mm-yyyy or, where that
is no date, mm-dd-yyyy, with any of the separators - / and dot; days and months may have
one digit, and keep one.
Numbers that fail their check, and all other text, stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"

#: Countries by the length of their IBAN, to tell where one with blanks ends.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _grouped_iban(length: int, countries: str) -> str:
    whole, rest = divmod(length - 4, 4)
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{whole}}}" + (f" [A-Z0-9]{{{rest}}}" if rest else "")


_GROUPED_IBAN = "|".join(_grouped_iban(*x) for x in _IBAN_LENGTHS.items())

#: Candidates, tried in this order at each place of a text.
CANDIDATES = "|".join(
    [
        rf"(?<![0-9A-Za-z])(?:[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}|{_GROUPED_IBAN})(?![0-9A-Za-z])",
        r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{4}\.[0-9]{1,2}\.[0-9]{1,2})(?![0-9]|[./-][0-9])",
        r"(?<![0-9./-])(?:[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9]|[./-][0-9])",
        rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
        r"(?<![0-9])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])",
        r"(?<![0-9])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])",
        r"(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9]|-[0-9])",
        r"(?<![0-9.])[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?![0-9]|\.[0-9])",
        r"(?<![0-9])(?<![0-9] )[0-9]{3} [0-9]{3} [0-9]{4}(?![0-9]| [0-9])",
        r"(?<![0-9])(?:[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7})(?![0-9])",
        r"(?<![0-9])(?:[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5}|[0-9]{13,19})(?![0-9])",
    ]
)

#: The days of any 400 years of the Gregorian calendar are 189 * 773.
_DAYS_A, _DAYS_B, _FIRST_DAY = 189, 773, "1800-01-01"

#: The rarest form of a date has more than a fifth of all days, so no walk is this long.
_WALK = 400


def feistel(left: Column, right: Column, a: Column, b: Column, tag: str, inverse: bool) -> Column:
    """struct(l, r): the keyed permutation of the pairs below (a, b), or its inverse."""
    sign = -1 if inverse else 1
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    rounds = list(range(1, ROUNDS + 1))
    steps = F.array(*map(F.lit, reversed(rounds) if inverse else rounds))

    def noise(i: Column, half: Column) -> Column:
        text = F.concat(F.lit(f"{tag}|"), i.cast("string"), F.lit("|"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")

    def step(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        left_half = F.when(odd, F.pmod(s["l"] + noise(i, s["r"]) * sign, a)).otherwise(s["l"])
        right_half = F.when(odd, s["r"]).otherwise(F.pmod(s["r"] + noise(i, s["l"]) * sign, b))
        return F.struct(left_half.alias("l"), right_half.alias("r"))

    return F.aggregate(steps, start, step)


def _sub(s: Column, start, length=None) -> Column:
    at = start if isinstance(start, Column) else F.lit(start)
    n = F.length(s) if length is None else length if isinstance(length, Column) else F.lit(length)
    return F.substr(s, at.cast("int"), n.cast("int"))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _chars(s: Column) -> Column:
    """The characters of a non-empty string."""
    return F.transform(F.sequence(F.lit(1), F.length(s)), lambda p: F.substr(s, p, F.lit(1)))


def _pad(value: Column, width: Column) -> Column:
    return F.lpad(value.cast("string"), width.cast("int"), "0")


def _permuted_digits(digits: Column, tag: str, inverse: bool) -> Column:
    """A string of 2 to 18 digits permuted among the strings of its length."""
    n_right = F.ceil(F.length(digits) / 2)
    n_left = F.length(digits) - n_right
    power = lambda n: F.pow(F.lit(10), n).cast("long")
    pair = feistel(_sub(digits, 1, n_left), _sub(digits, n_left + 1), power(n_left), power(n_right), tag, inverse)
    return F.aggregate(
        F.array(pair), F.lit(""), lambda _, p: F.concat(_pad(p["l"], n_left), _pad(p["r"], n_right))
    )


def _permuted_letters(letters: Column, tag: str, inverse: bool) -> Column:
    """A string of 1 to 12 letters A-Z permuted among the strings of its length."""
    n = F.length(letters)
    n_left = F.floor(n / 2).cast("int")
    number = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda v, c: v * 26 + F.ascii(c) - 65)
    power = lambda k: F.pow(F.lit(26), k).cast("long")
    left, right = F.slice(_chars(letters), F.lit(1), n_left), F.slice(_chars(letters), n_left + 1, n - n_left)
    pair = feistel(number(left), number(right), power(n_left), power(n - n_left), tag, inverse)

    def printed(_, p: Column) -> Column:
        def letter(k: Column) -> Column:
            half, place = F.when(k <= n_left, p["l"]).otherwise(p["r"]), F.when(k <= n_left, n_left - k).otherwise(n - k)
            return F.char(F.floor(half / power(place)) % 26 + 65)

        return F.array_join(F.transform(F.sequence(F.lit(1), n), letter), "")

    return F.aggregate(F.array(pair), F.lit(""), printed)


def _refilled(form: Column, fresh: Column, kind: str = "[0-9]") -> Column:
    """`form` with its characters of a kind (digits) replaced, in order, by those of `fresh`."""
    state = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def step(s: Column, c: Column) -> Column:
        mine = c.rlike(kind)
        return F.struct(
            F.concat(s["out"], F.when(mine, F.substr(fresh, s["next"], F.lit(1))).otherwise(c)).alias("out"),
            (s["next"] + mine.cast("int")).alias("next"),
        )

    return F.aggregate(_chars(form), state, step, lambda s: s["out"])


def _luhn_sum(payload: Column) -> Column:
    """Luhn sum of the digits before the check digit."""
    values = F.transform(F.reverse(_chars(payload)), lambda c, i: c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(values, F.lit(0), lambda s, v: s + v - F.when(v > 9, 9).otherwise(0))


def _check_digit(payload: Column) -> Column:
    return ((10 - _luhn_sum(payload) % 10) % 10).cast("string")


def _mod97(s: Column) -> Column:
    def step(m: Column, c: Column) -> Column:
        letter = c.rlike("[A-Z]")
        return F.when(letter, (m * 100 + F.ascii(c) - 55) % 97).otherwise((m * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97)

    return F.aggregate(_chars(s), F.lit(0), step)


def _card(m: Column, key: str, inverse: bool) -> Column:
    d = _digits(m)
    n = F.length(d)
    payload = F.concat(_sub(d, 1, 1), _permuted_digits(_sub(d, 2, n - 2), f"{key}|card", inverse))
    valid = n.between(13, 19) & (_check_digit(_sub(d, 1, n - 1)) == _sub(d, n, 1))
    fresh = F.aggregate(F.array(payload), F.lit(""), lambda _, p: F.concat(p, _check_digit(p)))
    return F.when(valid, _refilled(m, fresh))


def _iban(m: Column, key: str, inverse: bool) -> Column:
    """The last 18 digits are permuted, and the last 12 letters beyond the bank's four characters."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    bban = _sub(plain, 5)
    tail = lambda s, n: F.when(F.length(s) > n, F.right(s, F.lit(n))).otherwise(s)
    digits = _digits(bban)
    last = tail(digits, 18)
    changed = F.when(F.length(last) > 1, _permuted_digits(last, f"{key}|iban", inverse)).otherwise(last)
    refilled = _refilled(bban, F.concat(_sub(digits, 1, F.length(digits) - F.length(last)), changed))
    letters = F.regexp_replace(_sub(bban, 5), "[^A-Z]", "")
    end = tail(letters, 12)
    other = F.concat(_sub(letters, 1, F.length(letters) - F.length(end)), _permuted_letters(end, f"{key}|iban-letters", inverse))
    with_letters = lambda r: F.concat(_sub(r, 1, 4), _refilled(_sub(r, 5), other, "[A-Z]"))
    fresh = F.aggregate(F.array(refilled), F.lit(""), lambda _, r: F.when(F.length(letters) > 0, with_letters(r)).otherwise(r))
    check = lambda b: _pad(98 - _mod97(F.concat(b, _sub(plain, 1, 2), F.lit("00"))), F.lit(2))
    valid = _mod97(F.concat(bban, _sub(plain, 1, 4))) == 1
    whole = F.aggregate(F.array(fresh), F.lit(""), lambda _, b: F.concat(_sub(plain, 1, 2), check(b), b))
    return F.when(valid, F.when(F.contains(m, F.lit(" ")), _refilled(m, whole, "[^ ]")).otherwise(whole))


def _ssn(m: Column, key: str, inverse: bool) -> Column:
    area, group, serial = (_sub(m, p, n).cast("long") for p, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area < 666, area - 1).otherwise(area - 2) * 99 + group - 1
    pair = feistel(index, serial - 1, F.lit(898 * 99), F.lit(9999), f"{key}|ssn", inverse)

    def printed(_, p: Column) -> Column:
        place = F.floor(p["l"] / 99)
        return F.concat_ws(
            "-",
            _pad(place + F.when(place < 665, 1).otherwise(2), F.lit(3)),
            _pad(p["l"] % 99 + 1, F.lit(2)),
            _pad(p["r"] + 1, F.lit(4)),
        )

    return F.when(valid, F.aggregate(F.array(pair), F.lit(""), printed))


def _ipv4(m: Column, key: str, inverse: bool) -> Column:
    part = lambda i: F.element_at(F.split(m, r"\."), i).cast("long")
    pair = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), F.lit(65536), F.lit(65536), f"{key}|ipv4", inverse)
    halves = lambda p: F.concat_ws(
        ".", *[f(p[h]).cast("string") for h in ("l", "r") for f in (lambda x: F.floor(x / 256), lambda x: x % 256)]
    )
    return F.aggregate(F.array(pair), F.lit(""), lambda _, p: halves(p))


def _phone(m: Column, key: str, inverse: bool) -> Column:
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[^0-9])|^\+[0-9]|^", 0)
    rest = _sub(m, F.length(code) + 1)
    n = F.length(_digits(rest))
    return F.when(n.between(7, 14), F.concat(code, _refilled(rest, _permuted_digits(_digits(rest), f"{key}|phone", inverse))))


def _date(m: Column, key: str, inverse: bool) -> Column:
    """Permuted among the dates of its order and of as many digits; other dates on the way are walked over."""
    part = lambda i: F.element_at(F.split(m, "[-/.]"), i)
    made = lambda y, mo, d: F.try_to_date(F.concat_ws("-", part(y), _pad(part(mo), F.lit(2)), _pad(part(d), F.lit(2))), "yyyy-MM-dd")
    year_first = F.length(part(1)) == 4
    month_first = ~year_first & made(3, 2, 1).isNull()
    date = F.when(year_first, made(1, 2, 3)).otherwise(F.coalesce(made(3, 2, 1), made(3, 1, 2)))
    month_digits = F.length(F.when(month_first, part(1)).otherwise(part(2)))
    day_digits = F.length(F.when(year_first, part(3)).when(month_first, part(2)).otherwise(part(1)))
    first = F.lit(_FIRST_DAY).cast("date")
    number = F.datediff(date, first).cast("long")
    valid = date.isNotNull() & number.between(0, _DAYS_A * _DAYS_B - 1)
    at = lambda n: F.date_add(first, n.cast("int"))

    def of_form(n: Column) -> Column:
        day, month = F.dayofmonth(at(n)), F.month(at(n))
        return ((month_digits == 2) | (month < 10)) & ((day_digits == 2) | (day < 10)) & (~month_first | (day > 12))

    def step(s: Column, _: Column) -> Column:
        pair = feistel(F.floor(s["n"] / _DAYS_B), s["n"] % _DAYS_B, F.lit(_DAYS_A), F.lit(_DAYS_B), f"{key}|date", inverse)
        moved = lambda _, p: F.struct((p["l"] * _DAYS_B + p["r"]).alias("n"), of_form(p["l"] * _DAYS_B + p["r"]).alias("done"))
        return F.when(s["done"], s).otherwise(F.aggregate(F.array(pair), s, moved))

    start = F.struct(number.alias("n"), F.lit(False).alias("done"))
    sep = F.regexp_extract(m, "[-/.]", 0)

    def printed(s: Column) -> Column:
        digits = lambda n, width: F.when(width == 2, _pad(n, F.lit(2))).otherwise(n.cast("string"))
        year, month, day = F.date_format(at(s["n"]), "yyyy"), digits(F.month(at(s["n"])), month_digits), digits(F.dayofmonth(at(s["n"])), day_digits)
        text = F.when(year_first, F.concat(year, sep, month, sep, day)).when(month_first, F.concat(month, sep, day, sep, year))
        return F.when(s["done"], text.otherwise(F.concat(day, sep, month, sep, year)))

    return F.when(valid, F.aggregate(F.sequence(F.lit(1), F.lit(_WALK)), start, step, printed))


def pseudonym(m: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of one candidate; the candidate itself where its check fails."""
    rule = (
        F.when(m.rlike("^[A-Z]{2}"), _iban(m, key, inverse))
        .when(m.rlike("^(?:[0-9]{4}([-/.])[0-9]{1,2}\\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\\2[0-9]{4})$"), _date(m, key, inverse))
        .when(m.rlike("^[0-9]{1,3}([.][0-9]{1,3}){3}$"), _ipv4(m, key, inverse))
        .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), _ssn(m, key, inverse))
        .when(m.rlike("^[0-9][0-9 -]{11,}[0-9]$"), _card(m, key, inverse))
        .otherwise(_phone(m, key, inverse))
    )
    return F.coalesce(rule, m)


def pseudonymise(
    docs: DataFrame, key: str, text: str = "text", count: str = "n_pseudonyms", inverse: bool = False
) -> DataFrame:
    """docs with every validated value in `text` replaced; `count` (long) says how many changed.

    Every row is kept, also repeated ones; null text stays null and empty text
    empty, both with count 0; a column named as `count` is replaced. With the same
    key, `inverse` restores the original texts (a pseudonym has the format of its
    value, so it is found again at its place).
    """
    if "|" in key:
        raise ValueError("the key must not hold |")
    whole = F.col(f"`{text}`").cast("string")
    kept = [c for c in docs.columns if c not in (text, count)]
    found = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        whole.alias(text),
        F.when(whole.rlike("[0-9]"), F.regexp_extract_all(whole, F.lit(CANDIDATES), F.lit(0))).alias(count),
    )
    old = F.col(f"`{count}`")
    pairs = F.when(F.size(old) > 0, F.transform(old, lambda m: F.struct(m.alias("old"), pseudonym(m, key, inverse).alias("new"))))
    found = found.withColumn(count, pairs)
    between = F.split(F.col(f"`{text}`"), CANDIDATES, -1)
    joined = F.concat(
        F.array_join(F.zip_with(F.slice(between, 1, F.size(old)), old, lambda t, p: F.concat(t, p["new"])), ""),
        F.element_at(between, -1),
    )
    changed = F.size(F.filter(old, lambda p: p["old"] != p["new"]))
    return found.select(
        *[F.col(f"`{c}`") for c in docs.columns if c in kept],
        F.when(old.isNotNull(), joined).otherwise(F.col(f"`{text}`")).alias(text),
        F.coalesce(F.when(old.isNotNull(), changed), F.lit(0)).cast("long").alias(count),
    )
