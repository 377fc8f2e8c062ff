"""PII: validated numbers, dates and mail names replaced by keyed pseudonyms of the same format."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import computed

ROUNDS = 6
CYCLE = 146_097  # days of 400 Gregorian years = 189 * 773
FIRST_DAY = "1600-01-01"

# What may be personal data. No part starts inside a run of its own characters,
# so a long run is read once.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    # In one piece, or in groups of four, those after the bank's each with a digit.
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}"
    r"| [A-Z0-9]{4}(?: (?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}){1,6}(?: (?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    # With a country code in groups or in one piece, or ten digits in groups.
    "phone": r"(?<![0-9A-Za-z])\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z+])\+(?:[0-9]{1,3}(?:[ .-](?:\([0-9]{1,4}\)|[0-9]{2,4})){2,4}|[0-9]{8,15})(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z.-])(?:\([0-9]{3}\) ?[0-9]{3}-|[0-9]{3}-[0-9]{3}-|[0-9]{3}\.[0-9]{3}\.)[0-9]{4}(?![0-9A-Za-z]|[.-][0-9])",
    "ipv6": r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]{0,38}[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z]|-[0-9])",
    "slashed": r"(?<![0-9A-Za-z/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9A-Za-z]|/[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    # As printed on cards, in one piece, or grouped otherwise if no such number follows in the same run of groups.
    "card": r"(?<![0-9A-Za-z-])(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19}"
    r"|(?!(?:[0-9]{1,12}[ -]){1,18}?(?:[0-9]{13}|[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])))[0-9](?:[ -]?[0-9]){12,18})(?![0-9A-Za-z]|-[0-9])",
}
CANDIDATE = "|".join(KINDS.values())


def _mix(key: str, kind: str, turn: int, value: Column, radix: Column | int) -> Column:
    """A keyed function of a value, below `radix`."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), F.lit(str(turn)), value.cast("string"))
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long"), radix if isinstance(radix, Column) else F.lit(radix))


def _let(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def feistel(key: str, kind: str, left: Column, right: Column, a: Column | int, b: Column | int, back: bool = False) -> Column:
    """(l, r): a keyed permutation of the pairs left < a, right < b; both may be columns."""
    a, b = (x if isinstance(x, Column) else F.lit(x) for x in (a, b))
    state = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    sign = -1 if back else 1

    def step(turn: int):
        if turn % 2:
            return lambda x: F.struct(x["l"].alias("l"), F.pmod(x["r"] + sign * _mix(key, kind, turn, x["l"], b), b).alias("r"))
        return lambda x: F.struct(F.pmod(x["l"] + sign * _mix(key, kind, turn, x["r"], a), a).alias("l"), x["r"].alias("r"))

    for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
        state = _let(state, step(turn))
    return state


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _put(shape: Column, digits: Column) -> Column:
    """`shape` with its digits replaced in turn by those of `digits`."""
    marks = F.split(F.regexp_replace(shape, "([0-9])", "\u0001$1"), "\u0001", -1)
    parts = F.transform(marks, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.substring(digits, i, F.lit(1)), F.substring(x, 2, 1_000_000))))
    return F.array_join(parts, "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second from the right (the last one not) doubled."""
    turned = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.aggregate(turned, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0)))


def _numbers(key: str, kind: str, digits: Column, back: bool) -> Column:
    """A string of digits permuted among those of its length (at most 18 digits)."""
    n = F.length(digits)
    first = F.floor(n / 2).cast("int")
    left = F.when(first > 0, F.substring(digits, F.lit(1), first)).otherwise("0").cast("long")
    right = F.substring(digits, first + 1, n).cast("long")
    a, b = F.pow(F.lit(10.0), first).cast("long"), F.pow(F.lit(10.0), n - first).cast("long")
    return _let(feistel(key, kind, left, right, a, b, back), lambda x: F.concat(F.when(first > 0, F.lpad(x["l"].cast("string"), first, "0")).otherwise(""), F.lpad(x["r"].cast("string"), n - first, "0")))


def _card(key: str, x: Column, back: bool) -> Column:
    digits = _digits(x)
    payload = F.substring(digits, F.lit(1), F.length(digits) - 1)

    def checked(p: Column) -> Column:
        return F.concat(p, F.pmod(-luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)).cast("string"))

    return F.when(luhn_sum(digits) % 10 == 0, _put(x, _let(_numbers(key, "card", payload, back), checked)))


def _ip(key: str, x: Column, back: bool) -> Column:
    """Each part keeps its number of digits: of one digit there are 10, of two 90, of three 156."""
    parts = F.split(x, r"\.")
    plain = F.forall(parts, lambda p: (p.cast("int") <= 255) & (p.cast("int").cast("string") == p))

    def moved(p: Column) -> Column:
        least, n = (
            [F.when(F.length(p[i]) == 1, small).when(F.length(p[i]) == 2, middle).otherwise(large) for i in range(4)]
            for small, middle, large in ((0, 10, 100), (10, 90, 156))
        )
        left, right = ((p[i].cast("int") - least[i]) * n[i + 1] + p[i + 1].cast("int") - least[i + 1] for i in (0, 2))
        pair = lambda s, h, i: (F.floor(s[h] / n[i + 1]) + least[i], s[h] % n[i + 1] + least[i + 1])
        permuted = feistel(key, "ip", left, right, n[0] * n[1], n[2] * n[3], back)
        return _let(permuted, lambda s: F.concat_ws(".", *[o.cast("string") for h, i in (("l", 0), ("r", 2)) for o in pair(s, h, i)]))

    return F.when(plain, _let(parts, moved))


def _date(key: str, x: Column, back: bool) -> Column:
    day = F.try_to_timestamp(x, F.lit("yyyy-MM-dd")).cast("date")
    since = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    cycle, rest = F.floor(since / CYCLE), F.pmod(since, F.lit(CYCLE))
    moved = _let(
        feistel(key, "date", F.floor(rest / 773), rest % 773, 189, 773, back),
        lambda s: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (cycle * CYCLE + s["l"] * 773 + s["r"]).cast("int")), "yyyy-MM-dd"),
    )
    return F.when(day.isNotNull() & (F.date_format(day, "yyyy-MM-dd") == x), moved)


def _ssn(key: str, x: Column, back: bool) -> Column:
    area, group, serial = (F.substring(x, p, n).cast("int") for p, n in ((1, 3), (5, 2), (8, 4)))
    real = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    left = area - 1 - (area > 666).cast("int")
    moved = _let(
        feistel(key, "ssn", left, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, back),
        lambda s: F.concat_ws("-", F.lpad((s["l"] + 1 + (s["l"] >= 665).cast("int")).cast("string"), 3, "0"), F.lpad((F.floor(s["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((s["r"] % 9999 + 1).cast("string"), 4, "0")),
    )
    return F.when(real, moved)


# Days of a year of 365, by which of the two first numbers of a date with slashes is the month.
_DAYS = [(date(1999, 1, 1) + timedelta(n)).strftime("%m %d").split() for n in range(365)]
MONTH_FIRST = [f"{m}/{d}" for m, d in _DAYS]
DAY_FIRST = [f"{d}/{m}" for m, d in _DAYS if d > "12"]


def _slashed(key: str, x: Column, back: bool) -> Column:
    """A first number above 12 is a day, else it is read as the month; the pseudonym reads alike."""
    year, day = F.substring(x, 7, 4).cast("int"), F.substring(x, 1, 5)

    def moved(kind: str, days: list[str]) -> Column:
        known = F.array(*map(F.lit, days))
        at = F.array_position(known, day)
        pair = feistel(key, kind, F.pmod(year, F.lit(400)), at - 1, 400, len(days), back)
        made = _let(pair, lambda s: F.concat(F.element_at(known, (s["r"] + 1).cast("int")), F.lit("/"), F.lpad((year - F.pmod(year, F.lit(400)) + s["l"]).cast("string"), 4, "0")))
        return F.when(at > 0, made)

    return F.when(F.substring(x, 1, 2) > "12", moved("day-first", DAY_FIRST)).otherwise(moved("month-first", MONTH_FIRST))


def _phone(key: str, x: Column, back: bool) -> Column:
    """The country code stays; in a number of one piece the first two digits, or a first 1 or 7."""
    code = F.when(x.rlike(r"^\+[0-9]+$"), F.regexp_extract(x, r"^\+(?:[17]|[0-9]{2})", 0)).otherwise(F.regexp_extract(x, r"^(?:\+[0-9]{1,3})?", 0))
    rest = F.substring(x, F.length(code) + 1, F.length(x))
    return F.when(F.length(_digits(x)) <= 18, F.concat(code, _put(rest, _numbers(key, "phone", _digits(rest), back))))


def _iban_rest(x: Column) -> Column:
    """The number mod 97, country and check digits moved to the end."""
    turned = F.concat(F.substring(x, F.lit(5), F.length(x)), F.substring(x, 1, 4))
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda n, c: F.when(c == "", n).otherwise((n * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97).cast("int"))


def _shifted(key: str, kind: str, turn: int, part: Column, other: Column, sign: int, letters: int) -> Column:
    """Letters and digits of a part moved within their kind by a keyed function of the other part."""
    stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lit(str(turn)), other), 256)

    def moved(c: Column, i: Column) -> Column:
        by = sign * F.conv(F.substring(stream, 2 * F.pmod(i, F.lit(32)) + 1, F.lit(2)), 16, 10).cast("int") + sign * F.floor(i / 32).cast("int")
        spin = lambda base, n: F.char(F.pmod(F.ascii(c) - base + by, F.lit(n)) + base)
        return F.when(c.rlike("^[a-z]$"), spin(97, letters)).when(c.rlike("^[A-Z]$"), spin(65, letters)).when(c.rlike("^[0-9]$"), spin(48, 10)).otherwise(c)

    return F.array_join(F.transform(F.split(part, ""), moved), "")


def _letters(key: str, kind: str, x: Column, back: bool, letters: int = 26) -> Column:
    """Any string of digits and of the first so many letters permuted among those of its format."""
    first = F.floor(F.length(x) / 2).cast("int")
    state = F.struct(F.substring(x, F.lit(1), first).alias("l"), F.substring(x, first + 1, F.length(x)).alias("r"))
    sign = -1 if back else 1

    def step(turn: int):
        if turn % 2:
            return lambda s: F.struct(s["l"].alias("l"), _shifted(key, kind, turn, s["r"], s["l"], sign, letters).alias("r"))
        return lambda s: F.struct(_shifted(key, kind, turn, s["l"], s["r"], sign, letters).alias("l"), s["r"].alias("r"))

    for turn in reversed(range(4)) if back else range(4):
        state = _let(state, step(turn))
    return _let(state, lambda s: F.concat(s["l"], s["r"]))


def _iban(key: str, x: Column, back: bool) -> Column:
    def made(plain: Column) -> Column:
        country, body = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))

        def checked(b: Column) -> Column:
            return F.concat(country, F.lpad((98 - _iban_rest(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0"), b)

        return F.when(_iban_rest(plain) == 1, _let(_letters(key, "iban", body, back), checked))

    found = _let(F.replace(x, F.lit(" "), F.lit("")), made)
    return F.when(F.contains(x, F.lit(" ")), F.regexp_replace(found, "(.{4})(?=.)", "$1 ")).otherwise(found)


def _ipv6(key: str, x: Column, back: bool) -> Column:
    return _letters(key, "ipv6", x, back, 6)


def _email(key: str, x: Column, back: bool) -> Column:
    name = F.substring_index(x, "@", 1)
    return F.concat(_letters(key, "email", name, back), F.substring(x, F.length(name) + 1, F.length(x)))


MAKERS = {"email": _email, "iban": _iban, "phone": _phone, "ipv6": _ipv6, "ip": _ip, "date": _date, "slashed": _slashed, "ssn": _ssn, "card": _card}


def pseudonym(x: Column, key: str, back: bool = False) -> Column:
    """(kind, value): what a candidate is and its pseudonym; kind null and the value unchanged if it isn't valid."""
    kind, value = F.lit(None).cast("string"), x
    for name, pattern in reversed(KINDS.items()):
        whole = x.rlike(f"^(?:{pattern})$")
        made = F.when(whole, MAKERS[name](key, x, back))
        value = F.when(made.isNotNull(), made).otherwise(value)
        kind = F.when(made.isNotNull(), F.lit(name)).otherwise(kind)
    return F.struct(kind.alias("kind"), value.alias("value"))


def pseudonymised(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """(doc_id, text, n_found, kinds): whole texts with pseudonyms, how many there are and of which kinds, in order.

    Card numbers (in fours, 4-6-5, in one piece or in other groups) must pass the
    Luhn check, account numbers (in one piece or in fours) their mod-97 check,
    IPv4 addresses, dates (2024-02-29, 12/05/1990) and social security numbers
    their ranges; what fails stays as it is. Phone numbers have a country code,
    or ten digits with dashes, dots or a bracketed area; IPv6 addresses eight
    groups or a gap, and a digit. A date with slashes isn't linked to other
    notations, and 29 February stays in it. Of groups that might be two
    cards the first four are tried. Pseudonyms pass the same checks and keep length, separators,
    country and mail domain. Under one key a value has one pseudonym in all
    documents, different values have different ones, and `back` restores the
    texts. Null text stays null (no finds); ids may be null, rows may repeat,
    other columns aren't read.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base = computed(base, _found=F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
    made = F.when(F.size("_found") > 0, F.transform("_found", lambda x: pseudonym(x, key, back)))
    base = computed(base, _made=made)
    between = F.split("text", CANDIDATE, -1)
    joined = F.array_join(F.zip_with(between, F.col("_made"), lambda a, b: F.concat(a, F.coalesce(b["value"], F.lit("")))), "")
    kinds = F.filter(F.transform("_made", lambda x: x["kind"]), lambda k: k.isNotNull())
    return base.select(
        "doc_id",
        F.when(F.col("_made").isNotNull(), joined).otherwise(F.col("text")).alias("text"),
        F.greatest(F.coalesce(F.size(kinds), F.lit(0)), F.lit(0)).alias("n_found"),
        F.coalesce(F.array_join(kinds, " "), F.lit("")).alias("kinds"),
    )
