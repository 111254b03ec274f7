"""Format-preserving pseudonyms for personal data (operator 2), in DataFrame functions only.

E-mail addresses, phone, card, account (IBAN) and social security numbers, IPv4 addresses and dates are
found by one pattern, validated (check sums, ranges, the calendar), and each valid one is replaced by
another value of its own format: a keyed permutation of the values that share the format, so equal
values stay equal and different ones different in all documents, and whoever has the key can go back.
What is no valid value stays as it is.

The permutation is a Feistel network: a value has two halves, and in each round one is shifted by a keyed
hash of the other, digit by digit and letter by letter, or modulo its range for numbers. Check digits are
computed anew. What stays: an address's domain, a phone number but its last seven digits, a card's first
digit, an account's country and letters, a date's century (of a hundred years from 1825, 1925 or 2025).

A repeated group in a pattern is possessive or bounded, so that no text makes a match recurse deeply. An address
has at most 64 characters before its @ and 253 after it.

Defined results: a null text stays null and has no findings; rows are independent, so repeated rows are
alike; other columns come back unchanged; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
LONGEST_DOMAIN = 253
FOUND = "__found"

#: The countries of each length of account numbers, spaces not counted.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL FK SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(size: int, countries: str) -> str:
    fours, rest = divmod(size - 4, 4)
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else "")


#: As long as its country has it, so that a word after it is no part of it; then by the general form.
_IBAN = "|".join([*(_iban_of(n, c) for n, c in _IBAN_LENGTHS.items()), "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"])
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: The kinds in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9A-Za-z/-])",
    "ssn": r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})(?![A-Za-z0-9])",
    "phone": (
        r"(?<![0-9A-Za-z+])(?:(?:\+1[ .-]?)?\([2-9][0-9]{2}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+1[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
        r"|[2-9][0-9]{2}[ .-][0-9]{3}[ .-][0-9]{4}|\+[2-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5})(?![0-9A-Za-z]|[./-][0-9])"
    ),
    # In fours, or 4-6-5 and 4-6-4; of the latter, no digits that begin a date or a card in fours.
    "card": (
        r"(?<![0-9A-Za-z])(?:[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9A-Za-z])"
        r"|[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{4,5}(?![0-9A-Za-z]|[./-][0-9]|(?:[ -][0-9]{4}){2}))"
    ),
}
KINDS = tuple(PATTERNS)
ANY = "|".join(PATTERNS.values())
#: What every value has: an address its @, an IPv4 address a dot between digits (each octet may be one digit), the others two digits in a row.
GATE = r"[0-9]{2}|[0-9]\.[0-9]|@"
#: First days of the centuries within which dates are permuted, and two factors of their days.
CENTURIES = (("1825-01-01", 92, 397), ("1925-01-01", 75, 487), ("2025-01-01", 92, 397))


def _chars(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substring(s, i, F.lit(1)))).otherwise(
        F.array().cast("array<string>")
    )


def _hash(secret: str, tweak: Column, salt: Column) -> Column:
    """A keyed hash as a number below 2**60."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(secret), tweak, salt), 256), 1, 15), 16, 10).cast("long")


def permuted_text(s: Column, secret: str, kind: str, back: bool = False) -> Column:
    """``s`` with its ASCII digits and letters permuted; every other character stays in its place."""
    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substring(s, F.lit(1), half).alias("a"), F.substring(s, half + 1, F.length(s)).alias("b"))

    def moved(mine: Column, other: Column, i: Column) -> Column:
        def shift(c: Column, place: Column) -> Column:
            by = _hash(secret, F.lit(kind), F.concat_ws("|", i, place, other)) * (-1 if back else 1)
            code = F.ascii(c)
            turn = lambda base, n: F.char(F.lit(base) + F.pmod(code - base + by, F.lit(n)))
            return F.when(c.rlike("^[0-9]$"), turn(48, 10)).when(c.rlike("^[a-z]$"), turn(97, 26)).when(c.rlike("^[A-Z]$"), turn(65, 26)).otherwise(c)

        return F.array_join(F.transform(_chars(mine), shift), "")

    def step(acc: Column, i: Column) -> Column:
        even = F.pmod(i, F.lit(2)) == 0
        return F.struct(
            F.when(even, moved(acc["a"], acc["b"], i)).otherwise(acc["a"]).alias("a"),
            F.when(even, acc["b"]).otherwise(moved(acc["b"], acc["a"], i)).alias("b"),
        )

    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, start, step, lambda acc: F.concat(acc["a"], acc["b"]))


def permuted_pair(a: Column, b: Column, n_a: Column, n_b: Column, secret: str, kind: Column, back: bool = False) -> Column:
    """The pair (a, b) of numbers below ``n_a`` and ``n_b``, permuted among all of them: struct a, b."""
    sign = -1 if back else 1

    def step(acc: Column, i: Column) -> Column:
        even = F.pmod(i, F.lit(2)) == 0
        return F.struct(
            F.when(even, F.pmod(acc["a"] + sign * F.pmod(_hash(secret, kind, F.concat_ws("|", i, acc["b"])), n_a), n_a)).otherwise(acc["a"]).alias("a"),
            F.when(even, acc["b"]).otherwise(F.pmod(acc["b"] + sign * F.pmod(_hash(secret, kind, F.concat_ws("|", i, acc["a"])), n_b), n_b)).alias("b"),
        )

    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def laid_out(form: Column, chars: Column) -> Column:
    """``form`` with its letters and digits replaced by those of ``chars``, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def put(acc: Column, c: Column) -> Column:
        slot = c.rlike("^[A-Za-z0-9]$")
        return F.struct(
            F.concat(acc["out"], F.when(slot, F.substring(chars, acc["next"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["next"] + slot.cast("int")).alias("next"),
        )

    return F.aggregate(_chars(form), start, put, lambda acc: acc["out"])


def luhn(digits: Column) -> Column:
    """The check sum of a card number, 0 modulo 10 for valid ones."""

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(F.pmod(i, F.lit(2)) == 1, twice).otherwise(d)

    return F.pmod(F.aggregate(F.transform(_chars(F.reverse(digits)), value), F.lit(0), lambda a, x: a + x), F.lit(10))


def mod97(s: Column) -> Column:
    """An account number, its first four characters moved to the end and letters as numbers, modulo 97."""
    moved = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        number = F.when(c.rlike("^[A-Z]$"), F.ascii(c) - 55).otherwise(c.cast("int"))
        return F.pmod(acc * F.when(number > 9, F.lit(100)).otherwise(F.lit(10)) + number, F.lit(97))

    return F.aggregate(_chars(moved), F.lit(0), add)


def _card(m: Column, secret: str) -> Column:
    digits = _digits(m)
    n = F.length(digits)
    body = F.concat(F.substring(digits, 1, 1), permuted_text(F.substring(digits, F.lit(2), n - 2), secret, "card"))
    check = F.pmod(10 - luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(n.between(13, 19) & (luhn(digits) == 0), laid_out(m, F.concat(body, check)))


def _phone(m: Column, secret: str) -> Column:
    digits = _digits(m)
    n = F.length(digits)
    return F.when(n.between(8, 15), laid_out(m, F.concat(F.substring(digits, F.lit(1), n - 7), permuted_text(F.substring(digits, n - 6, F.lit(7)), secret, "phone"))))


def _iban(m: Column, secret: str) -> Column:
    s = F.regexp_replace(m, " ", "")
    # Letters stay; the digits are permuted and the check digits follow.
    body = F.substring(s, F.lit(5), F.length(s))
    other = laid_out_digits(body, permuted_text(_digits(body), secret, "iban"))
    check = F.lpad((98 - mod97(F.concat(F.substring(s, 1, 2), F.lit("00"), other))).cast("string"), 2, "0")
    return F.when(F.length(s).between(15, 34) & (mod97(s) == 1), laid_out(m, F.concat(F.substring(s, 1, 2), check, other)))


def laid_out_digits(form: Column, digits: Column) -> Column:
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def put(acc: Column, c: Column) -> Column:
        slot = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(acc["out"], F.when(slot, F.substring(digits, acc["next"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["next"] + slot.cast("int")).alias("next"),
        )

    return F.aggregate(_chars(form), start, put, lambda acc: acc["out"])


def _ssn(m: Column, secret: str) -> Column:
    area, group, serial = (F.substring(m, *at).cast("long") for at in ((1, 3), (5, 2), (8, 4)))
    left = (area - 1 - (area > 666).cast("int")) * 99 + group - 1  # 898 areas, 99 groups
    pair = permuted_pair(left, serial - 1, F.lit(898 * 99), F.lit(9999), secret, F.lit("ssn"))

    def written(p: Column) -> Column:
        first = F.floor(p["a"] / 99) + 1
        parts = (first + (first > 665).cast("int"), F.pmod(p["a"], F.lit(99)) + 1, p["b"] + 1)
        return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in zip(parts, (3, 2, 4), strict=True)])

    return F.transform(F.array(pair), written)[0]


def _ip(m: Column, secret: str) -> Column:
    part = F.split(m, r"\.")
    value = lambda i: F.get(part, F.lit(i)).cast("long") * 256 + F.get(part, F.lit(i + 1)).cast("long")
    pair = permuted_pair(value(0), value(2), F.lit(1 << 16), F.lit(1 << 16), secret, F.lit("ip"))
    octets = lambda p: F.concat_ws(".", *[x for h in (p["a"], p["b"]) for x in (F.floor(h / 256), F.pmod(h, F.lit(256)))])
    return F.transform(F.array(pair), octets)[0]


def _day(begin: Column, n: int):
    return lambda p: F.date_add(begin, (p["a"] * n + p["b"]).cast("int"))


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


def _date(m: Column, secret: str) -> Column:
    iso, dotted = m.contains("-"), m.contains(".")
    form = F.when(iso, F.lit("yyyy-MM-dd")).when(dotted, F.lit("dd.MM.yyyy")).otherwise(F.lit("MM/dd/yyyy"))
    ymd = F.when(iso, m).when(dotted, F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2))).otherwise(
        F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2))
    )
    day = ymd.try_cast("date")
    out = None
    for first, n_a, n_b in CENTURIES:
        begin = F.to_date(F.lit(first))
        at = F.datediff(day, begin)
        pair = permuted_pair(F.floor(at / n_b), F.pmod(at, F.lit(n_b)), F.lit(n_a), F.lit(n_b), secret, F.lit(f"date{first}"))
        new = F.transform(F.array(pair), _day(begin, n_b))[0]
        inside = day.isNotNull() & (at >= 0) & (at < n_a * n_b)
        out = F.when(inside, new) if out is None else out.when(inside, new)
    return F.when(iso, F.date_format(out, "yyyy-MM-dd")).when(dotted, F.date_format(out, "dd.MM.yyyy")).otherwise(F.date_format(out, "MM/dd/yyyy"))


def _email(m: Column, secret: str) -> Column:
    domain = F.substring_index(m, "@", -1)
    return F.when(F.length(domain) <= LONGEST_DOMAIN, F.concat(permuted_text(F.substring_index(m, "@", 1), secret, "email"), F.lit("@"), domain))


REPLACED = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "iban": _iban, "phone": _phone, "card": _card}


def pseudonymized(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced, and struct ``FOUND``: the number of values of each kind replaced."""
    plain = F.col(f"`{text}`")
    has = plain.rlike(GATE)  # most texts need no more than this
    found = F.when(has, F.regexp_extract_all(plain, F.lit(f"({ANY})"), F.lit(1))).otherwise(F.array().cast("array<string>"))
    rest = docs.drop(FOUND, "__matches", "__new")
    matched = rest.withColumn("__matches", found)

    def judged(m: Column) -> Column:
        # A value's kind is the first whose pattern it has as a whole and whose rules it obeys.
        tried = [F.when(m.rlike(f"^(?:{PATTERNS[k]})$"), F.struct(F.lit(k).alias("kind"), REPLACED[k](m, secret).alias("new"))) for k in KINDS]
        valid = F.filter(F.array(*tried), lambda x: x["new"].isNotNull())
        return F.coalesce(F.get(valid, F.lit(0)), F.struct(F.lit(None).cast("string").alias("kind"), m.alias("new")))

    some = F.size("__matches") > 0
    replaced = matched.withColumn("__new", F.when(some, F.transform("__matches", judged)))
    between = F.split(plain, ANY, -1)
    woven = F.transform(between, lambda p, i: F.concat(p, F.coalesce(F.get(F.col("__new"), i)["new"], F.lit(""))))
    counts = F.struct(*[F.coalesce(F.size(F.filter("__new", _of_kind(k))), F.lit(0)).cast("long").alias(k) for k in KINDS])
    new_text = F.when(some, F.array_join(woven, "")).otherwise(plain)
    return replaced.select(*[new_text.alias(c) if c == text else F.col(f"`{c}`") for c in rest.columns], counts.alias(FOUND))


def total(found: Column) -> Column:
    return reduce(lambda a, b: a + b, [found[k] for k in KINDS])
