"""Format-preserving pseudonyms: personal numbers, dates and mail addresses are permuted with a key.

Values that pass their format's check are replaced by other values that pass it too: card numbers
keep their length and a right Luhn digit, IBANs their country and a right check number, dates stay
dates from 1900 to 2099, IPv4 and IPv6 addresses stay addresses, phone and social security numbers
keep their punctuation, letters of a mail address stay letters of their script. Each replacement is
a Feistel network over the value's own domain, keyed by ``key``; it is a permutation, so equal values
get equal pseudonyms in all documents and different values of one format get different ones, without
any table of values. Numbers that fail the check (a 16-digit number with a wrong Luhn digit,
31 February, 300.1.1.1, the phone number 123-456-7890) are not personal and stay.

One value may be written in several ways, and its pseudonym is then the same value in each: IBANs and
cards with or without separators, dates with or without leading zeros and in any order, IPv6
addresses shortened or not (the pseudonym is written in full), ten-digit phone numbers with or
without +1.

All of it is column expressions inside one map over the documents: no shuffle, no Python."""

from __future__ import annotations

import sys
import unicodedata
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "iban", "date", "ip", "ssn", "phone", "card")

# fixed values: lengths of IBANs by country
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|XK", 21: "CH|CR|HR|LI|LV",
    22: "BG|BH|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST",
    26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA",
    30: "JO|KW|MU", 31: "MT|SC", 32: "LC", 33: "RU",
}


def _grouped(length: int, countries: str) -> str:
    """An IBAN in groups of four, set apart by what the group ``ib`` holds."""
    groups, rest = divmod(length - 4, 4)
    last = rf"\k<ib>[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries})[0-9]{{2}}(?:\k<ib>[A-Z0-9]{{4}}){{{groups}}}{last}"


_EMAIL = (
    r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@(?:(?:[A-Za-z0-9-]{1,63}\.){1,9}[A-Za-z]{2,63}"
    r"|(?:[\p{L}\p{M}\p{N}-]{1,63}\.){1,9}[\p{L}\p{M}]{2,63})"
)
_IBAN = (
    r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|(?=[A-Z]{2}[0-9]{2}(?<ib>[ -]))(?:"
    + "|".join(_grouped(*entry) for entry in _IBAN_LENGTHS.items())
    + r"))(?![A-Za-z0-9])"
)
_DATE = (
    r"(?<![0-9])(?:[0-9]{4}(?<y>[-/.])[0-9]{1,2}\k<y>[0-9]{1,2}|[0-9]{1,2}(?<d>[-/.])[0-9]{1,2}\k<d>[0-9]{4})(?![0-9])"
)
_IP = (
    r"(?:(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
    r"|(?<![\p{L}\p{N}:.])(?=(?:[0-9A-Fa-f]{0,4}:){1,7}:|(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f])"
    r"(?:[0-9A-Fa-f]{0,4}:){2,8}[0-9A-Fa-f]{0,4}(?![\p{L}\p{N}:]|\.[0-9]))"
)
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_PHONE = (
    r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}"
    r"|\+[0-9]{1,3}[ .-]\(?[0-9]\)?(?:(?:[ .-]?[0-9]{2}){4}|(?:[ .-]?[0-9]{3,4}){2})"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}(?<p>[ .-])[0-9]{3}\k<p>[0-9]{4})(?![0-9])"
)
_CARD = (
    r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?<sep>[ -])(?:[0-9]{4}\k<sep>[0-9]{4}\k<sep>[0-9]{1,7}"
    r"|[0-9]{6}\k<sep>[0-9]{4,5}))(?![0-9])"
)
_PATTERNS = dict(zip(KINDS, (_EMAIL, _IBAN, _DATE, _IP, _SSN, _PHONE, _CARD), strict=True))
_ANY = "|".join(_PATTERNS.values())

_ROUNDS = 10
_FIRST_DAY, _DAYS = "1900-01-01", (17, 4297)  # 17 * 4297 days: up to 2099-12-31
# (first code, letters) of the runs a character stays in: digits, A-Z, a-z, Latin-1 letters
_RUNS = ((48, 10), (65, 26), (97, 26), (192, 23), (216, 7), (224, 23), (248, 8))
_BLOCK = 128


def other_runs() -> list[list[list[int]]]:
    """(first code, letters, distance of letters) of the runs of all other letters and digits, by block of
    128 codes: neighbours of one category, or every second code where capital and small letters alternate."""
    codes = defaultdict(list)
    for code in range(256, sys.maxunicode + 1):
        category = unicodedata.category(chr(code))
        if category[0] in "LN":
            codes[category].append(code)
    blocks = defaultdict(list)
    for found in codes.values():
        at = 0
        while at < len(found) - 1:
            step, end = found[at + 1] - found[at], at + 1
            while step <= 2 and end < len(found) and found[end] - found[end - 1] == step:
                end += 1
            if end - at > 1:
                for block in range(found[at] // _BLOCK, found[end - 1] // _BLOCK + 1):
                    blocks[block].append([found[at], end - at, step])
            at = end
    return [blocks[block] for block in range(max(blocks) + 1)]


# blocks apart by ; and runs by , as one text: it is split once, when a query is planned
_OTHER_RUNS = ";".join(",".join(" ".join(map(str, run)) for run in block) for block in other_runs())


def _prf(key: str, *parts: Column) -> Column:
    """A number below 2**60 that depends on the key and the parts."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _feistel(key: str, tag: Column, left: Column, right: Column, n_left: Column, n_right: Column) -> Column:
    """The pair (left, right) permuted within [0, n_left) x [0, n_right): in turn one half is
    shifted by a keyed function of the other, modulo its size."""

    def step(pair: Column, i: Column) -> Column:
        a, b = pair["a"], pair["b"]
        new_a = F.when(i % 2 == 0, F.pmod(a + F.pmod(_prf(key, tag, i, b), n_left), n_left)).otherwise(a)
        new_b = F.when(i % 2 == 1, F.pmod(b + F.pmod(_prf(key, tag, i, a), n_right), n_right)).otherwise(b)
        return F.struct(new_a.alias("a"), new_b.alias("b"))

    start = F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(_ROUNDS - 1)), start, step)


def _power(digits: Column) -> Column:
    return F.rpad(F.lit("1"), (digits + 1).cast("int"), "0").cast("long")


def _permute_digits(key: str, tag: str, digits: Column) -> Column:
    """A string of 2 to 36 digits as another one of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    left, right = digits.substr(F.lit(1), half), digits.substr(half + 1, n - half)
    sizes = _power(half), _power(n - half)
    pair = _feistel(key, F.concat(F.lit(f"{tag}|"), n.cast("string")), left, right, *sizes)
    text = lambda number, width: F.lpad(number.cast("string"), width, "0")
    joined = F.transform(F.array(pair), lambda p: F.concat(text(p["a"], half), text(p["b"], n - half)))
    return F.when(n < 2, digits).otherwise(joined[0])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _into_format(value: Column, digits: Column, kept: str = "^[0-9]$") -> Column:
    """``value`` with its digits (characters like ``kept``) replaced in turn by those of ``digits``."""

    def filled(new_digits: Column) -> Column:
        def step(state: Column, char: Column) -> Column:
            is_digit = char.rlike(kept)
            new = F.when(is_digit, F.substring(new_digits, state["at"], 1)).otherwise(char)
            return F.struct(
                (state["at"] + is_digit.cast("int")).alias("at"), F.concat(state["out"], new).alias("out")
            )

        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
        return F.aggregate(F.split(value, ""), start, step, lambda state: state["out"])

    # bound to a variable, or each character would compute the digits again
    return F.transform(F.array(digits), filled)[0]


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum; ``doubled``: 1 if digits are doubled from the last but one on, 0 from the last."""

    def part(char: Column, i: Column) -> Column:
        d = char.cast("int") * F.when(i % 2 == doubled, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(F.transform(chars, part), F.lit(0), lambda a, b: a + b)


def _card(key: str, value: Column) -> Column:
    digits = _digits(value)
    body = _permute_digits(key, "card", digits.substr(F.lit(1), F.length(digits) - 1))
    whole = F.transform(
        F.array(body), lambda b: F.concat(b, F.pmod(-_luhn_sum(b, 0), F.lit(10)).cast("string"))
    )[0]
    return F.when(_luhn_sum(digits, 1) % 10 == 0, _into_format(value, whole)).otherwise(value)


def _mod97(text: Column) -> Column:
    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        number = F.when(code >= 65, code - 55).otherwise(code - 48)
        return F.pmod(rest * F.when(code >= 65, 100).otherwise(10) + number, F.lit(97))

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0), step)


def _iban(key: str, value: Column) -> Column:
    written = F.regexp_replace(value, "[ -]", "")
    country, body = F.substring(written, 1, 2), F.substring(written, 5, 30)
    valid = _mod97(F.concat(body, F.substring(written, 1, 4))) == 1
    new = _permute_chars(key, F.lit("iban"), body)
    check = lambda b: F.lpad((98 - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0")
    whole = F.transform(F.array(new), lambda b: F.concat(country, check(b), b))[0]
    return F.when(valid, _into_format(value, whole, "^[A-Z0-9]$")).otherwise(value)


def _date(key: str, value: Column) -> Column:
    """Year, month and day in one of three orders; day first where both that and month first fit.
    Leading zeros are left out where a date has a part of one digit."""
    parts = F.split(value, "[-/.]")
    year_first = F.length(parts[0]) == 4
    short = F.exists(parts, lambda p: F.length(p) == 1)
    orders = {
        "yyyy-MM-dd": (year_first, (0, 1, 2)),
        "dd-MM-yyyy": (~year_first, (2, 1, 0)),
        "MM-dd-yyyy": (~year_first, (2, 0, 1)),
    }
    a, b = _DAYS
    first = F.lit(_FIRST_DAY).cast("date")
    out = value
    for written, (fits, places) in reversed(orders.items()):
        iso = F.when(fits, F.concat_ws("-", *[F.lpad(parts[at], 4 if at == places[0] else 2, "0") for at in places]))
        day = F.datediff(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date"), first)
        pair = _feistel(key, F.lit("date"), F.floor(day / b), F.pmod(day, F.lit(b)), F.lit(a), F.lit(b))
        new = F.transform(F.array(pair), lambda p: F.date_add(first, (p["a"] * b + p["b"]).cast("int")))[0]
        mark = F.regexp_extract(value, "[-/.]", 0)
        unpadded = written.replace("MM", "M").replace("dd", "d")
        form = F.when(short, F.date_format(new, unpadded)).otherwise(F.date_format(new, written))
        text = F.replace(form, F.lit("-"), mark)
        out = F.when(day.between(0, a * b - 1), text).otherwise(out)
    return out


def _ip(key: str, value: Column) -> Column:
    return F.when(F.contains(value, F.lit(":")), _ipv6(key, value)).otherwise(_ipv4(key, value))


def _ipv6(key: str, value: Column) -> Column:
    """The address as two halves of 64 bits, in turn XORed with a keyed function of the other. At least
    two groups and a digit must be written: ``std::`` and ``ab::cd`` are no addresses."""
    sides = F.split(value, "::")
    groups = lambda text: F.filter(F.split(text, ":"), lambda g: g != "")
    head, tail = groups(sides[0]), groups(F.coalesce(F.get(sides, F.lit(1)), F.lit("")))
    n, shortened = F.size(head) + F.size(tail), F.size(sides) == 2
    valid = (
        F.when(shortened, n.between(2, 7)).otherwise((n == 8) & (F.size(sides) == 1))
        & value.rlike("[0-9]")
        & ~value.rlike("^:(?!:)|(?<!:):$|:::")
    )
    full = F.concat(head, F.array_repeat(F.lit("0"), F.greatest(8 - n, F.lit(0))), tail)
    hex_ = F.array_join(F.transform(full, lambda g: F.lpad(g, 4, "0")), "")

    def step(pair: Column, i: Column) -> Column:
        def mask(other: Column) -> Column:
            digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("ipv6"), i.cast("string"), other.cast("string")), 256)
            return F.conv(F.substring(digest, 1, 16), 16, -10).cast("long")

        return F.struct(
            F.when(i % 2 == 0, pair["a"].bitwiseXOR(mask(pair["b"]))).otherwise(pair["a"]).alias("a"),
            F.when(i % 2 == 1, pair["b"].bitwiseXOR(mask(pair["a"]))).otherwise(pair["b"]).alias("b"),
        )

    half = lambda at: F.conv(F.substring(hex_, at, 16), 16, -10).cast("long")
    start = F.struct(half(1).alias("a"), half(17).alias("b"))

    def written(pair: Column) -> Column:
        out = F.concat(*[F.lpad(F.lower(F.hex(pair[name])), 16, "0") for name in ("a", "b")])
        parts = [F.regexp_replace(F.substring(out, at, 4), "^0{1,3}", "") for at in range(1, 33, 4)]
        return F.concat_ws(":", *parts)

    new = F.aggregate(F.sequence(F.lit(0), F.lit(_ROUNDS - 1)), start, step, written)
    return F.when(valid, F.when(value.rlike("[A-F]"), F.upper(new)).otherwise(new)).otherwise(value)


def _ipv4(key: str, value: Column) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("int"))
    valid = F.forall(octets, lambda o: o <= 255)
    low = F.lit(1 << 16)
    pair = _feistel(key, F.lit("ip"), octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], low, low)
    new = F.transform(
        F.array(pair),
        lambda p: F.concat_ws(
            ".", *[x.cast("string") for n in ("a", "b") for x in (F.floor(p[n] / 256), F.pmod(p[n], F.lit(256)))]
        ),
    )[0]
    return F.when(valid, new).otherwise(value)


def _ssn(key: str, value: Column) -> Column:
    valid = ~value.rlike("^(000|666|9)") & ~value.rlike("-00-") & ~value.rlike("0000$")
    # areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999
    area, group, serial = (F.substring(value, at, n).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    left = area - 1 - (area > 666).cast("int")
    pair = _feistel(key, F.lit("ssn"), left, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999))

    def written(p: Column) -> Column:
        new = p["a"] + 1
        new = new + (new >= 666).cast("int")
        parts = ((new, 3), (F.floor(p["b"] / 9999) + 1, 2), (F.pmod(p["b"], F.lit(9999)) + 1, 4))
        return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in parts])

    return F.when(valid, F.transform(F.array(pair), written)[0]).otherwise(value)


def _phone(key: str, value: Column) -> Column:
    """All digits but those of a country code that is set apart. Numbers without a country code must
    have an area and an exchange from 200 on, as ten-digit numbers of the North American plan do."""
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])|^\+1(?=[0-9]{10}$)", 0)
    rest = value.substr(F.length(code) + 1, F.length(value))
    digits = _digits(rest)
    ten = (F.length(digits) == 10) & code.isin("", "+1")
    new = F.when(ten, _ten_digits(key, digits)).otherwise(_permute_digits(key, "phone", digits))
    valid = value.startswith("+") | digits.rlike("^[2-9][0-9]{2}[2-9]")
    return F.when(valid, F.concat(code, _into_format(rest, new))).otherwise(value)


def _ten_digits(key: str, digits: Column) -> Column:
    """Area, exchange and line: an area or an exchange from 200 on gets one from 200 on, others others."""
    area, exchange, line = (F.substring(digits, at, n).cast("long") for at, n in ((1, 3), (4, 3), (7, 4)))
    from_200 = [x >= 200 for x in (area, exchange)]
    first = [F.when(is_, 200).otherwise(0) for is_ in from_200]
    sizes = [F.when(is_, 800).otherwise(200) for is_ in from_200]
    tag = F.concat_ws("|", F.lit("ten"), *[f.cast("string") for f in first])
    left = (area - first[0]) * sizes[1] + exchange - first[1]
    pair = _feistel(key, tag, left, line, sizes[0] * sizes[1], F.lit(10_000))

    def written(p: Column) -> Column:
        parts = ((F.floor(p["a"] / sizes[1]) + first[0], 3), (p["a"] % sizes[1] + first[1], 3), (p["b"], 4))
        return F.concat(*[F.lpad(x.cast("string"), n, "0") for x, n in parts])

    return F.transform(F.array(pair), written)[0]


def _shift(key: str, tag: Column, text: Column) -> Column:
    """Each letter and digit moved within its run of characters, by a keyed function of its place
    and the tag. Other characters stay, as do the few letters without a neighbour of their category."""
    blocks = F.split(F.lit(_OTHER_RUNS), ";")

    def other(c: Column, code: Column, move: Column) -> Column:
        def numbers(run: Column) -> Column:
            return F.transform(F.split(run, " "), lambda n: n.cast("int"))

        def holds(run: Column) -> Column:
            place = code - run[0]
            return (place >= 0) & (place < run[1] * run[2]) & (place % run[2] == 0)

        def moved(run: Column) -> Column:
            to = run[0] + run[2] * F.pmod(F.floor((code - run[0]) / run[2]) + F.pmod(move, run[1]), run[1])
            return F.decode(F.unhex(F.lpad(F.hex(to.cast("long")), 8, "0")), "UTF-32")

        block = F.split(F.get(blocks, F.floor(code / _BLOCK).cast("int")), ",")
        runs = F.filter(F.transform(F.filter(block, lambda run: run != ""), numbers), holds)
        return F.coalesce(F.get(F.transform(runs, moved), F.lit(0)), c)

    def char(c: Column, i: Column) -> Column:
        code = F.ascii(c)
        move = _prf(key, tag, i)
        new = c
        for first, n in _RUNS:
            inside = (code >= first) & (code < first + n)
            new = F.when(inside, F.char(first + F.pmod(code - first + F.pmod(move, F.lit(n)), F.lit(n)))).otherwise(new)
        return F.when(code >= 256, other(c, code, move)).otherwise(new)

    return F.array_join(F.transform(F.split(text, ""), char), "")


def _permute_chars(key: str, tag: Column, text: Column) -> Column:
    """A Feistel network over characters: the halves of the text are shifted in turn, each by a
    keyed function of the other. Letters stay letters of their case, digits digits."""
    half = F.floor(F.length(text) / 2).cast("int")

    def step(pair: Column, i: Column) -> Column:
        a, b = pair["a"], pair["b"]
        label = lambda other: F.concat_ws("|", tag, i.cast("string"), other)
        return F.struct(
            F.when(i % 2 == 1, _shift(key, label(b), a)).otherwise(a).alias("a"),
            F.when(i % 2 == 0, _shift(key, label(a), b)).otherwise(b).alias("b"),
        )

    start = F.struct(text.substr(F.lit(1), half).alias("a"), text.substr(half + 1, F.length(text)).alias("b"))
    rounds = F.sequence(F.lit(0), F.lit(_ROUNDS - 1))
    return F.aggregate(rounds, start, step, lambda p: F.concat(p["a"], p["b"]))


def _email(key: str, value: Column) -> Column:
    local, domain = F.regexp_extract(value, "^([^@]*)(@.*)$", 1), F.regexp_extract(value, "^([^@]*)(@.*)$", 2)
    return F.concat(_permute_chars(key, F.lit("email"), local), domain)


_REPLACE = dict(zip(KINDS, (_email, _iban, _date, _ip, _ssn, _phone, _card), strict=True))


def _kind(value: Column) -> Column:
    """The kind of a match of any pattern: the first whose pattern fits all of it."""
    out = F.lit(KINDS[-1])
    for kind in reversed(KINDS[:-1]):
        out = F.when(value.rlike(f"^(?:{_PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with personal values in the text replaced, and ``n_<kind>``, the number of values
    replaced of each kind. Null texts stay null and empty ones empty, with counts of 0. Rows are
    independent of each other, so repeated rows stay equal. Columns of ``docs`` named like a count
    are replaced, all others kept. Every text is searched whole."""
    if not key:
        raise ValueError("the key is empty")
    found, text = "_pii", F.col(text_col).cast("string")
    while found in docs.columns:
        found = f"_{found}"
    pieces, matches = f"{found}_pieces", f"{found}_matches"

    def replaced(value: Column) -> Column:
        named = F.struct(_kind(value).alias("kind"), value.alias("old"))

        def new(entry: Column) -> Column:
            out = entry["old"]
            for name in KINDS:
                out = F.when(entry["kind"] == name, _REPLACE[name](key, entry["old"])).otherwise(out)
            return F.struct(entry["kind"].alias("kind"), entry["old"].alias("old"), out.alias("new"))

        return F.transform(F.array(named), new)[0]

    some = F.coalesce(text.rlike("[0-9@]"), F.lit(False))
    marked = docs.withColumn(matches, F.when(some, F.regexp_extract_all(text, F.lit(_ANY), 0)))
    some = F.size(matches) > 0
    marked = marked.withColumns(
        {
            found: F.when(some, F.transform(matches, replaced)),
            pieces: F.when(some, F.split(text, _ANY, -1)),
        }
    )
    tail = F.array(F.struct(F.lit("").alias("kind"), F.lit("").alias("old"), F.lit("").alias("new")))
    joined = F.array_join(
        F.zip_with(pieces, F.concat(found, tail), lambda piece, match: F.concat(piece, match["new"])), ""
    )

    def changed(kind: str) -> Column:
        hits = F.filter(found, lambda m: (m["kind"] == kind) & (m["old"] != m["new"]))
        return F.when(F.col(found).isNull(), 0).otherwise(F.size(hits))

    counts = {f"n_{kind}": changed(kind) for kind in KINDS}
    return marked.withColumns({text_col: F.when(F.col(found).isNotNull(), joined).otherwise(text), **counts}).drop(
        found, pieces, matches
    )
