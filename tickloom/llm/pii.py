"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses.

DataFrame functions only. One pattern finds the candidates, each is validated by its
kind's rule, and the valid ones are permuted by a keyed Feistel network within the
values of their format: a card number stays a card number that passes its check
digit, a date stays a date in the same notation. The permutation depends on the key,
the kind and the value alone, so equal values get equal pseudonyms in every document
and different values of one format different ones; with the key it can be undone.

Two networks are used. ``_mix_text`` works on the two halves of a string: each round
shifts the letters and digits of one half, within their class, by amounts that a keyed
hash draws from the other half, hashed once a round. ``_mix_numbers`` does the same for a pair of numbers
below two moduli, for values whose digits are not free (dates, addresses). Halves are
never swapped, so every place keeps its character class.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm.common import fresh, quoted

ROUNDS = 8
KEY_SETTING = "spark.tickloom.pseudonym.key"

# kind -> pattern; the order decides between patterns that fit at one place
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9A-Za-z/-]|\.[0-9])",
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[ .-][0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "secret": r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])(?i:password|passwd|secret|token|api_key|apikey)(?: ?[=:] ?)\"?[0-9A-Za-z+/_-]{8,}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
SOME = "[0-9@=:]|AKIA"  # in every text that has a match of any pattern

FIRST_DAY, DAYS = "1800-01-01", (189, 773)  # 400 years, 189 * 773 days
SSN = (898, 99 * 9999)  # areas 001-899 but 666; groups 01-99 with serials 0001-9999


def session_key(spark: SparkSession) -> str:
    """The key that the session names in ``KEY_SETTING``; where it names none, one drawn for this session.

    Set your own and keep it to link pseudonyms between sessions or to undo them.
    """
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(16)
        spark.conf.set(KEY_SETTING, key)
    return key


def _draw(key: str, *parts: Column) -> Column:
    """A keyed number below 2**60."""
    return F.conv(F.left(F.sha2(F.concat_ws("\u0001", F.lit(key), *[p.cast("string") for p in parts]), 256), F.lit(15)), 16, 10).cast("long")


def _rounds(undo: bool) -> Column:
    return F.array(*[F.lit(i) for i in (range(ROUNDS, 0, -1) if undo else range(1, ROUNDS + 1))])


def _shift(char: Column, by: Column, undo: bool) -> Column:
    by = -by if undo else by
    turn = lambda first, n: F.char(F.pmod(F.ascii(char) - F.lit(ord(first)) + by, F.lit(n)) + F.lit(ord(first)))
    return (
        F.when(char.between("0", "9"), turn("0", 10))
        .when(char.between("a", "z"), turn("a", 26))
        .when(char.between("A", "Z"), turn("A", 26))
        .otherwise(char)
    )


def _shifts(key: str, kind: str, i: Column, other: Column, n: Column) -> Column:
    """``n`` keyed numbers below 2**16, an array: the other half is hashed once, and the hash with a block number gives 16 of them."""
    seed = F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit(kind), i.cast("string"), n.cast("string"), other), 256)
    blocks = F.sequence(F.lit(0), F.greatest(F.floor((n - 1) / 16), F.lit(0)).cast("int"))
    places = F.filter(F.sequence(F.lit(0), n), lambda j: j < n)
    number = lambda digests, j: F.conv(F.substring(F.element_at(digests, F.shiftright(j, 4) + 1), (j % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
    # seed and hashes as the only element of an array: named directly in a lambda they would be made again for every element
    digests = F.transform(F.array(seed), lambda own: F.transform(blocks, lambda b: F.sha2(F.concat_ws("\u0001", own, b.cast("string")), 256)))
    return F.element_at(F.transform(digests, lambda held: F.transform(places, lambda j: number(held, j))), 1)


def _mix_text(text: Column, key: str, kind: str, undo: bool) -> Column:
    """Work in proportion to the length of ``text``: characters and shifts are arrays walked side by side."""
    half = F.floor(F.length(text) / 2).cast("int")

    def moved(part: Column, other: Column, i: Column) -> Column:
        return F.zip_with(part, _shifts(key, kind, i, F.array_join(other, ""), F.size(part)), lambda char, by: _shift(char, by, undo))

    def step(state: Column, i: Column) -> Column:
        left, right = state["l"], state["r"]
        return F.when(
            i % 2 == 1, F.struct(moved(left, right, i).alias("l"), right.alias("r"))
        ).otherwise(F.struct(left.alias("l"), moved(right, left, i).alias("r")))

    chars = lambda part: F.filter(F.split(part, ""), lambda c: c != "")
    start = F.struct(chars(F.left(text, half)).alias("l"), chars(F.substring(text, half + 1, F.length(text))).alias("r"))
    return F.aggregate(_rounds(undo), start, step, lambda s: F.concat(F.array_join(s["l"], ""), F.array_join(s["r"], "")))


def _mix_numbers(x: Column, a: int, y: Column, b: int, key: str, kind: str, undo: bool, finish: Callable) -> Column:
    sign = -1 if undo else 1

    def step(state: Column, i: Column) -> Column:
        left, right = state["x"], state["y"]
        return F.when(
            i % 2 == 1,
            F.struct(F.pmod(left + sign * (_draw(key, F.lit(kind), i, right) % a), F.lit(a)).alias("x"), right.alias("y")),
        ).otherwise(
            F.struct(left.alias("x"), F.pmod(right + sign * (_draw(key, F.lit(kind), i, left) % b), F.lit(b)).alias("y"))
        )

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(_rounds(undo), start, step, lambda s: finish(s["x"], s["y"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(template: Column, filling: Column, slots: str) -> Column:
    """``template`` with its characters of class ``slots`` replaced, in order, by those of ``filling``."""
    char = lambda i: F.substring(template, i, F.lit(1))
    nth = lambda i: F.length(F.regexp_replace(F.left(template, i), f"[^{slots}]", ""))
    put = lambda i: F.when(char(i).rlike(f"^[{slots}]$"), F.substring(filling, nth(i), F.lit(1))).otherwise(char(i))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(template)), put), "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right but one doubled, modulo 10 (of a number whose last digit is the check)."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10


def _mod97(text: Column) -> Column:
    """``text`` of digits and letters (A = 10 ... Z = 35) as a number modulo 97."""

    def add(rest: Column, i: Column) -> Column:
        char = F.substring(text, i, F.lit(1))
        letter = F.ascii(char) - 55
        return F.when(char.between("0", "9"), (rest * 10 + char.cast("int")) % 97).otherwise((rest * 100 + letter) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def _email(value: Column, key: str, undo: bool) -> Column:
    local = F.substring_index(value, "@", 1)
    return F.concat(_mix_text(local, key, "email", undo), F.substring(value, F.length(local) + 1, F.length(value)))


def _ip(value: Column, key: str, undo: bool) -> Column:
    octet = lambda i: F.split_part(value, F.lit("."), F.lit(i)).cast("int")
    valid = (octet(1) < 256) & (octet(2) < 256) & (octet(3) < 256) & (octet(4) < 256)
    show = lambda x, y: F.concat_ws(".", F.floor(x / 256), x % 256, F.floor(y / 256), y % 256)
    return F.when(
        valid,
        _mix_numbers(octet(1) * 256 + octet(2), 65536, octet(3) * 256 + octet(4), 65536, key, "ip", undo, show),
    )


def _phone(value: Column, key: str, undo: bool) -> Column:
    known = F.regexp_extract(value, r"^\+(?:[0-9]{1,3}(?=[ .(-])|[0-9])", 0)  # the country stays
    rest = F.substring(value, F.length(known) + 1, F.length(value))
    n = F.length(_digits(value))
    return F.when(n.between(8, 15), F.concat(known, _refill(rest, _mix_text(_digits(rest), key, "phone", undo), "0-9")))


def _card(value: Column, key: str, undo: bool) -> Column:
    digits = _digits(value)
    inner = F.substring(digits, F.lit(2), F.length(digits) - 2)  # the network's digit stays, the check follows
    body = F.concat(F.left(digits, F.lit(1)), _mix_text(inner, key, "card", undo))
    check = F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(_luhn(digits) == 0, _refill(value, F.concat(body, check), "0-9"))


def _iban(value: Column, key: str, undo: bool) -> Column:
    plain = F.replace(value, F.lit(" "))
    country, account = F.left(plain, F.lit(2)), F.substring(plain, F.lit(5), F.length(plain))
    valid = _mod97(F.concat(account, F.left(plain, F.lit(4)))) == 1
    mixed = _mix_text(account, key, "iban", undo)
    check = F.lpad((98 - _mod97(F.concat(mixed, country, F.lit("00")))).cast("string"), 2, "0")
    return F.when(valid, _refill(value, F.concat(country, check, mixed), "0-9A-Z"))


def _ssn(value: Column, key: str, undo: bool) -> Column:
    part = lambda i: F.split_part(value, F.lit("-"), F.lit(i)).cast("int")
    area, group, serial = part(1), part(2), part(3)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    nth = F.when(area > 666, area - 2).otherwise(area - 1)
    pad = lambda n, width: F.lpad(n.cast("string"), width, "0")

    def show(x: Column, y: Column) -> Column:
        named = F.when(x + 1 >= 666, x + 2).otherwise(x + 1)
        return F.concat_ws("-", pad(named, 3), pad(F.floor(y / 9999) + 1, 2), pad(y % 9999 + 1, 4))

    return F.when(valid, _mix_numbers(nth, SSN[0], (group - 1) * 9999 + serial - 1, SSN[1], key, "ssn", undo, show))


def _date(value: Column, key: str, undo: bool) -> Column:
    """ISO dates, day.month.year, and with slashes day/month/year, or month/day/year where only that is a date."""
    mark = F.when(value.contains("-"), "-").when(value.contains("/"), "/").otherwise(".")
    part = lambda i: F.element_at(F.split(value, r"[-/.]"), i)
    iso = F.length(part(1)) == 4
    year = F.when(iso, part(1)).otherwise(part(3))
    parsed = lambda month, day: F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")
    by_day = F.when(iso, parsed(part(2), part(3))).otherwise(parsed(part(2), part(1)))
    by_month = F.when(mark == "/", parsed(part(1), part(2)))
    day = F.datediff(F.coalesce(by_day, by_month), F.lit(FIRST_DAY).cast("date"))
    bare = ~iso & (part(1).startswith("0") | part(2).startswith("0") | (F.length(value) == 10))

    def show(x: Column, y: Column) -> Column:
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), (x * DAYS[1] + y).cast("int"))
        in_full = lambda order: F.date_format(new, order)
        return (
            F.when(iso, in_full("yyyy-MM-dd"))
            .when(by_day.isNull(), F.when(bare, in_full("MM/dd/yyyy")).otherwise(in_full("M/d/yyyy")))
            .when(mark == "/", F.when(bare, in_full("dd/MM/yyyy")).otherwise(in_full("d/M/yyyy")))
            .otherwise(F.when(bare, in_full("dd.MM.yyyy")).otherwise(in_full("d.M.yyyy")))
        )

    within = day.between(0, DAYS[0] * DAYS[1] - 1)
    return F.when(within, _mix_numbers(F.floor(day / DAYS[1]), DAYS[0], day % DAYS[1], DAYS[1], key, "date", undo, show))


def _secret(value: Column, key: str, undo: bool) -> Column:
    name = F.regexp_extract(value, r"^(?:AKIA|[A-Za-z_]+ ?[=:] ?\"?)", 0)
    return F.concat(name, _mix_text(F.substring(value, F.length(name) + 1, F.length(value)), key, "secret", undo))


KINDS = {
    "email": _email,
    "date": _date,
    "ip": _ip,
    "ssn": _ssn,
    "phone": _phone,
    "card": _card,
    "iban": _iban,
    "secret": _secret,
}


def pseudonym(value: Column, key: str, undo: bool = False) -> Column:
    """The pseudonym of one candidate, NULL where it is not valid for the kind whose pattern it fits."""
    out = F.lit(None).cast("string")
    for kind in reversed(PATTERNS):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), KINDS[kind](value, key, undo)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, *, text: str = "text", count: str = "n_private", undo: bool = False) -> DataFrame:
    """``docs`` with the personal values in ``text`` replaced, and how many were.

    E-mail local parts, IPv4 addresses, telephone numbers (8 to 15 digits), payment
    cards (check digit), IBANs (modulo 97), social security numbers (valid ranges),
    full dates (1800 to 2199) and credentials (access keys, ``password=`` in any case) are replaced;
    candidates that their rule rejects, and everything else, stay as they are. Domain
    names, country codes, the first digit of a card and the names of credentials stay.
    ``undo`` turns pseudonyms back under the same key.

    One map over the rows: no shuffle, nothing to skew; texts of any length are handled
    whole, in time in proportion to their length and to that of each value. NULL text stays NULL with count 0. A column called ``count`` is replaced.
    """
    body = quoted(text)
    found = F.regexp_extract_all(body, F.lit(ANY), F.lit(0))
    renamed = F.transform(found, lambda v: F.struct(v.alias("old"), pseudonym(v, key, undo).alias("new")))
    has = F.coalesce(body.rlike(SOME) & body.rlike(ANY), F.lit(False))
    (values,) = fresh(docs, "_found")
    rows = docs.withColumn(values, F.when(has, renamed))
    pieces = F.split(body, ANY, -1)
    fill = F.transform(F.col(values), lambda v: F.coalesce(v["new"], v["old"]))
    joined = F.array_join(F.zip_with(pieces, fill, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = F.size(F.filter(F.col(values), lambda v: v["new"].isNotNull()))
    some = F.col(values).isNotNull()
    kept = [c for c in docs.columns if c.lower() != count.lower()]
    return rows.select(
        *[F.when(some, joined).otherwise(body).alias(c) if c.lower() == text.lower() else quoted(c) for c in kept],
        F.when(some, changed).otherwise(0).alias(count),
    )
