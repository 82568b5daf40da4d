"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation.

Found and validated values are read as a vector of digits with a radix each,
permuted by a Feistel network over that mixed radix and written back in the same
format. The permutation depends on the key and the kind alone, so equal values
get equal pseudonyms in all documents, different values get different ones, and
whoever has the key can invert it.

kind   what counts                                       what is permuted
card   13 to 19 digits with a right Luhn digit           all but the first and the Luhn digit (made anew)
iban   IBAN of its country's length, right check digits  digits and letters after the check digits (made anew)
phone  North American number (any area code if written     the digits after the country code or the 0; where a
       with +1 or in parentheses, else 2-9 first), +       North American area or exchange starts with 2-9 it
       and 8 to 15 digits, 0 with an area and 5 to 8       does so again
       digits, 0 with five pairs
ip     IPv4 address                                      the four octets
ipv6   IPv6 address of three groups or more              digits among digits, letters among a to f
ssn    US social security number                         area, group and serial within their valid values
date   1900 to 2099: Y-M-D or Y/M/D, D-M-Y with - or .,  the day; where a part is unpadded or D/M/Y is told by
       M/D/Y, else D/M/Y; a time may follow a T            its day alone: year, and month and day in their class
email  e-mail address, local part of 64 at most          letters and digits of the local part, by mail domain

Only digits and letters enter the vector, so a number written with other separators gets the
same digits. A value of one letter or digit is split into two digits (2 x 13 or 2 x 5), so that it has two
halves. Ten digits without any mark are no phone number here: nothing tells them from other numbers.
The plan holds a key per round, made from the key, never the key itself.

DataFrame functions only; documents without a value keep their text as it is.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsarc.functions.common import let

ROUNDS = 8
FIRST_DAY, DAY_RADIX = "1900-01-01", (17, 4297)   # 17 x 4297 days = 1900 to 2099

# The lengths of IBANs and the countries that use them.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC"}
# Country codes of one and two digits; all others have three.
CALLING_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
# Days after the 28th other than 29 February, for months of one and of two digits.
LATE_DAYS = [[f"{m:02d}-{d}" for m in months for d in range(29, 32 if m in (1, 3, 5, 7, 8, 10, 12) else 31) if m != 2]
             for months in (range(1, 10), range(10, 13))]

# A mail domain has at most 127 labels; an unbounded repeat of groups would overflow the matcher's stack.
_NO, _END = r"(?<![\w.+/-])", r"(?![\w-])"  # no value starts or ends inside a longer token
_NO_MAIL, _NO_COLON = r"(?<![\w.+%-])", r"(?<![\w.+/:-])"
_GROUP = "[0-9A-Fa-f]{1,4}"


def _iban(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else "")


_LISTED = " ".join(IBAN_COUNTRIES.values()).replace(" ", "|")
PATTERNS = {
    "email": rf"{_NO_MAIL}[A-Za-z0-9_%+-][A-Za-z0-9._%+-]{{0,63}}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){{0,125}}\.[A-Za-z]{{2,}}",
    "iban": rf"{_NO}(?:" + "|".join(_iban(n, c) for n, c in IBAN_COUNTRIES.items())
            + rf"|(?!{_LISTED})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?){_END}",
    "phone": "|".join(rf"{_NO}{d}{_END}" for d in (
        r"\+?1[ .-]?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}", r"\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}",
        r"\+1[ .-][0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}", r"\+1[0-9]{10}",
        r"(?:1[ .-])?[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4}", r"\+(?!1)[1-9](?:[ .()-]{0,2}[0-9]){7,14}",
        r"0[0-9](?:[ .-][0-9]{2}){4}", r"0[0-9]{2,4}[ /-][0-9]{5,8}")),
    "card": rf"{_NO}(?:[0-9]{{13,19}}|[0-9]{{4}}[ -][0-9]{{4}}[ -][0-9]{{4}}[ -][0-9]{{1,7}}|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{5}}){_END}",
    "ssn": rf"{_NO}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_END}",
    "date": "|".join(rf"{_NO}{d}(?:(?=T[0-9]{{2}}:[0-9]{{2}})|(?![\w/-]))" for d in (
        r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", r"[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", r"[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}",
        r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}", r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}")),
    "ipv6": rf"{_NO_COLON}(?:(?:{_GROUP}:){{7}}{_GROUP}|(?:{_GROUP}:){{1,6}}(?::{_GROUP}){{1,6}})(?![\w:-])(?!\.[0-9])",
    "ip": rf"{_NO}[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}{_END}(?!\.[0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# the values alone, to tell what was found
_FORM = {k: "^(?:" + p.replace(_NO, "").replace(_NO_MAIL, "").replace(_NO_COLON, "") + ")$" for k, p in PATTERNS.items()}


def _chars(s: Column) -> Column:
    return F.split(s, "")


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x.cast("int"))


def _luhn(payload: Column) -> Column:
    """The digit that completes a string of digits."""
    doubled = F.transform(F.reverse(_chars(payload)), lambda c, i: F.when(
        i % 2 == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.pmod(F.lit(10) - F.pmod(_sum(doubled), F.lit(10)), F.lit(10))


def _value(c: Column) -> Column:
    """Digit or letter value of one character: 0-9, a-z from 0, A-Z from 0; 0 for any other."""
    return (F.when(c.between("0", "9"), F.ascii(c) - 48).when(c.between("a", "z"), F.ascii(c) - 97)
            .when(c.between("A", "Z"), F.ascii(c) - 65).otherwise(0)).cast("long")


def _radix(c: Column) -> Column:
    return (F.when(c.between("0", "9"), 10).when(c.between("a", "z") | c.between("A", "Z"), 26).otherwise(1)).cast("long")


def _iban_check(country: Column, rest: Column) -> Column:
    """The two check digits of an IBAN without blanks."""
    number = F.aggregate(_chars(F.concat(rest, country, F.lit("00"))), F.lit(0), lambda s, c: F.pmod(
        F.when(c.between("0", "9"), s * 10 + F.ascii(c) - 48).otherwise(s * 100 + F.ascii(c) - 55), F.lit(97)))
    return F.lpad((F.lit(98) - number).cast("string"), 2, "0")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _at(s: Column, form: str) -> Column:
    return F.try_to_timestamp(s, F.lit(form)).cast("date")


def _year_first(s: Column) -> Column:
    return s.rlike("^[0-9]{4}")


def _day_slash(s: Column) -> Column:
    """Is a value with slashes D/M/Y? Only if it is no M/D/Y."""
    return s.contains("/") & ~_year_first(s) & _at(s, "M/d/yyyy").isNull()


def _date(s: Column) -> Column:
    """The date of a value by its separators, or null."""
    found = (F.when(s.rlike("^[0-9]{4}-"), _at(s, "yyyy-M-d")).when(_year_first(s), _at(s, "yyyy/M/d"))
             .when(s.contains("/"), F.coalesce(_at(s, "M/d/yyyy"), _at(s, "d/M/yyyy")))
             .when(s.contains("."), _at(s, "d.M.yyyy")).otherwise(_at(s, "d-M-yyyy")))
    return F.when(F.year(found).between(1900, 2099), found)


def _classed(s: Column) -> Column:
    """Must a date keep the class of its month and day to be read again as it was written?"""
    return _day_slash(s) | s.rlike("(?:^|[-./])[0-9](?:[-./]|$)")


def _read_classed(date: Column) -> Column:
    """Vector of a date within its class: month below 10 or not, day below 10, 13, 29 or above, 29 February."""
    year, month, day, name = F.year(date), F.month(date), F.day(date), F.date_format(date, "MM-dd")
    pair = lambda v, m: F.struct(v.cast("long").alias("v"), F.lit(m).cast("long").alias("m"))
    leap = F.floor((year - 1904) / 4)
    place = lambda days: F.array_position(F.array(*[F.lit(d) for d in days]), name) - 1
    late = F.when(month < 10, pair(place(LATE_DAYS[0]), len(LATE_DAYS[0]))).otherwise(pair(place(LATE_DAYS[1]), len(LATE_DAYS[1])))
    return (F.when(name == "02-29", F.array(pair(F.floor(leap / 7), 7), pair(F.pmod(leap, F.lit(7)), 7)))
            .when(day > 28, F.array(pair(year - 1900, 200), late))
            .otherwise(F.array(pair(year - 1900, 200),
                               F.when(month < 10, pair(month - 1, 9)).otherwise(pair(month - 10, 3)),
                               F.when(day < 10, pair(day - 1, 9)).when(day < 13, pair(day - 10, 3)).otherwise(pair(day - 13, 16)))))


def _write_classed(s: Column, date: Column, v: Column) -> Column:
    month, day, leap = F.month(date), F.day(date), F.date_format(date, "MM-dd") == "02-29"
    at = lambda i: F.get(v, F.lit(i))
    late = F.when(month < 10, F.get(F.array(*[F.lit(d) for d in LATE_DAYS[0]]), at(1).cast("int"))) \
        .otherwise(F.get(F.array(*[F.lit(d) for d in LATE_DAYS[1]]), at(1).cast("int")))
    y = F.when(leap, 1904 + 4 * (at(0) * 7 + at(1))).otherwise(1900 + at(0)).cast("string")
    m = (F.when(leap, F.lit(2)).when(day > 28, F.substring(late, 1, 2).cast("int"))
         .when(month < 10, at(1) + 1).otherwise(at(1) + 10)).cast("string")
    d = (F.when(leap, F.lit(29)).when(day > 28, F.substring(late, 4, 2).cast("int"))
         .when(day < 10, at(2) + 1).when(day < 13, at(2) + 10).otherwise(at(2) + 13)).cast("string")
    part = F.split(s, "[-./]")
    wide = lambda x, i: F.lpad(x, F.length(part[i]), F.lit("0"))
    sep = F.regexp_extract(s, "[-./]", 0)
    month_first = s.contains("/") & ~_day_slash(s)
    return (F.when(_year_first(s), F.concat(y, sep, wide(m, 1), sep, wide(d, 2)))
            .when(month_first, F.concat(wide(m, 0), sep, wide(d, 1), sep, y)).otherwise(F.concat(wide(d, 0), sep, wide(m, 1), sep, y)))


def kind_of(s: Column) -> Column:
    """The kind of a found value, or null if it is not valid."""
    part = lambda i: F.get(F.split(s, "[-.]"), F.lit(i)).cast("int")
    flat = F.replace(s, F.lit(" "), F.lit(""))
    card = _digits(s)
    octets = F.split(s, r"\.")
    groups = F.filter(F.split(s, ":"), lambda g: g != "")
    return (F.when(s.contains("@"), F.when(s.rlike("^[^@]*[A-Za-z0-9][^@]*@"), "email"))
            .when(s.rlike(_FORM["iban"]) & (F.length(flat) >= 15)
                  & (F.substring(flat, 3, 2) == _iban_check(F.substring(flat, 1, 2), F.substring(flat, 5, 40))), "iban")
            .when(s.rlike(_FORM["phone"]), "phone")
            .when(s.rlike(_FORM["card"]) & (F.length(card) >= 13)
                  & (F.right(card, F.lit(1)).cast("int") == _luhn(F.substring(card, F.lit(1), F.length(card) - 1))), "card")
            .when(s.rlike(_FORM["ssn"]), F.when(part(0).between(1, 899) & (part(0) != 666) & (part(1) > 0) & (part(2) > 0), "ssn"))
            .when(s.rlike(_FORM["date"]), F.when(_date(s).isNotNull(), "date"))
            .when(s.rlike(_FORM["ipv6"]), F.when(F.size(groups).between(3, 8) & s.rlike("[0-9]")
                                                 & ((F.size(groups) < 8) | ~s.contains("::")), "ipv6"))
            .when(s.rlike(_FORM["ip"]), F.when(F.forall(octets, lambda o: o.cast("int") <= 255), "ip")))


# what stays of a phone number: country code, the 1 before an area code, the 0 of a national one
_PREFIX = (r"^(?:\+1[ .-]?|1[ .-]?(?=[(])|1[ .-](?=[0-9]{3}[ .-][0-9]{3}[ .-])"
           rf"|\+(?:{CALLING_CODES}|[0-9]{{3}})|\+[0-9]|0)?")


def _fixed(kind: Column, s: Column) -> Column:
    """Length of the prefix that stays: country codes, check digits, the card's first digit."""
    return (F.when(kind == "phone", F.length(F.regexp_extract(s, 
                _PREFIX, 0)))
            .when(kind == "iban", 4).when(kind == "card", 1).otherwise(0))


def _body(kind: Column, s: Column) -> Column:
    """The characters of a text-like kind that are permuted."""
    return (F.when(kind == "email", F.substring_index(s, "@", 1))
            .when(kind == "card", F.substring(s, F.lit(2), F.length(s) - 2))
            .otherwise(F.substring(s, _fixed(kind, s) + 1, F.length(s))))


def _national(kind: Column, s: Column) -> Column:
    """Is the value a North American phone number?"""
    return (kind == "phone") & ~s.rlike(r"^(?:\+[2-9]|0)")


def _opens(body: Column, i: Column) -> Column:
    """Does place i of a North American number hold the first digit of area or exchange?"""
    before = F.length(_digits(F.substring(body, F.lit(1), i)))
    return (before == 0) | (before == 3)


def _marks(s: Column) -> Column:
    """The characters that enter a vector."""
    return F.regexp_replace(s, "[^0-9A-Za-z]", "")


def _tweak(kind: Column, s: Column) -> Column:
    return F.when(kind == "email", F.lower(F.substring_index(s, "@", -1))).otherwise(F.lit(""))


def _read_text(kind: Column, s: Column) -> Column:
    """The letters and digits of a text-like value; a single one is split into two digits."""
    def radix(b: Column):
        return lambda c, i: F.struct(c.alias("c"), (
            F.when(b["national"] & c.between("0", "9") & _opens(b["body"], i), F.when(c > "1", 8).otherwise(2))
            .when((kind == "ipv6") & (_radix(c) == 26), 6).otherwise(_radix(c))).cast("long").alias("m"))

    def halves(text: Column) -> Column:
        only = text[0]
        small = F.floor(only["m"] / 2)
        return F.when(F.size(text) == 1, F.array(
            F.struct(F.floor(only["v"] / small).alias("v"), F.lit(2).cast("long").alias("m")),
            F.struct(F.pmod(only["v"], small).alias("v"), small.alias("m")))).otherwise(text)
    marks = let(F.struct(_body(kind, s).alias("body"), _national(kind, s).alias("national")),
                lambda b: F.filter(F.transform(_chars(b["body"]), radix(b)), lambda x: x["m"] > 1))
    return let(F.transform(marks, lambda x: F.struct(
        (_value(x["c"]) - F.when(x["m"] == 8, 2).otherwise(0)).alias("v"), x["m"].alias("m"))), halves)


def read(kind: Column, s: Column) -> Column:
    """array of struct(v, m): the value's vector and its radices."""
    part = lambda i: F.get(F.split(s, "-"), F.lit(i)).cast("long")
    area = part(0) - 1 - F.when(part(0) > 666, 1).otherwise(0)
    pairs = lambda *p: F.array(*[F.struct(v.cast("long").alias("v"), F.lit(m).cast("long").alias("m")) for v, m in p])

    def dated(date: Column) -> Column:
        day = F.datediff(date, F.lit(FIRST_DAY).cast("date"))
        return F.when(_classed(s), _read_classed(date)).otherwise(pairs(
            (F.floor(day / DAY_RADIX[1]), DAY_RADIX[0]), (F.pmod(day, F.lit(DAY_RADIX[1])), DAY_RADIX[1])))
    return (F.when(kind.isNull(), F.array().cast("array<struct<v:bigint,m:bigint>>"))
            .when(kind == "ip", F.transform(F.split(s, r"\."), lambda o: F.struct(
                o.cast("long").alias("v"), F.lit(256).cast("long").alias("m"))))
            .when(kind == "ssn", pairs((area, 898), (part(1) - 1, 99), (part(2) - 1, 9999)))
            .when(kind == "date", let(_date(s), dated)).otherwise(_read_text(kind, s)))


def _write_text(kind: Column, s: Column, v: Column) -> Column:
    def put(b: Column):
        def char(c: Column, i: Column) -> Column:
            digit = c.between("0", "9")
            first = (F.when(digit, 48 + F.when((c > "1") & b["national"] & _opens(b["body"], i), 2).otherwise(0))
                     .when(c.between("a", "z"), 97).otherwise(65))
            new = F.when(b["one"], v[0] * F.when(digit, 5).otherwise(13) + v[1]).otherwise(
                F.get(v, F.length(_marks(F.substring(b["body"], F.lit(1), i)))))
            return F.when(_radix(c) > 1, F.char(first + new)).otherwise(c)
        return F.array_join(F.transform(_chars(b["body"]), char), "")

    def frame(chars: Column) -> Column:
        first, country = F.substring(s, F.lit(1), _fixed(kind, s)), F.substring(s, 1, 2)
        return (F.when(kind == "email", F.concat(chars, F.lit("@"), F.substring_index(s, "@", -1)))
                .when(kind == "card", let(F.concat(first, chars), lambda x: F.concat(x, _luhn(_digits(x)).cast("string"))))
                .when(kind == "iban", F.concat(country, _iban_check(country, F.replace(chars, F.lit(" "), F.lit(""))), chars))
                .otherwise(F.concat(first, chars)))
    body = _body(kind, s)
    return let(let(F.struct(body.alias("body"), _national(kind, s).alias("national"),
                            (F.length(_marks(body)) == 1).alias("one")), put), frame)


def write(kind: Column, s: Column, v: Column) -> Column:
    """The vector ``v`` in the format of ``s``."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.get(v, F.lit(0)) * DAY_RADIX[1] + F.get(v, F.lit(1))).cast("int"))
    form = (F.when(s.rlike("^[0-9]{4}-"), "yyyy-MM-dd").when(_year_first(s), "yyyy/MM/dd").when(s.contains("/"), "MM/dd/yyyy")
            .when(s.contains("."), "dd.MM.yyyy").otherwise("dd-MM-yyyy"))
    date = F.when(_classed(s), let(_date(s), lambda d: _write_classed(s, d, v))).otherwise(F.call_function("date_format", day, form))
    area = F.get(v, F.lit(0)) + 1
    ssn = F.concat_ws("-", F.lpad((area + F.when(area >= 666, 1).otherwise(0)).cast("string"), 3, "0"),
                      F.lpad((F.get(v, F.lit(1)) + 1).cast("string"), 2, "0"), F.lpad((F.get(v, F.lit(2)) + 1).cast("string"), 4, "0"))
    return (F.when(kind.isNull(), s).when(kind == "ip", F.array_join(F.transform(v, lambda x: x.cast("string")), "."))
            .when(kind == "ssn", ssn).when(kind == "date", date).otherwise(_write_text(kind, s, v)))


def round_key(key: str, k: int) -> str:
    return hashlib.sha256(f"{key}|{k}".encode()).hexdigest()


def _turns(found: Column, key: str, back: bool) -> Column:
    """The Feistel rounds over an array of struct(kind, s, t, l, r, ml, mr), one transform per round."""
    def turn(k: int):
        secret = round_key(key, k)
        own, other, radix = ("l", "r", "ml") if k % 2 == 0 else ("r", "l", "mr")

        def step(x: Column) -> Column:
            def noise(i: Column) -> Column:
                digest = F.sha2(F.concat_ws("|", F.lit(secret), x["kind"], x["t"], F.floor(i / 8).cast("string"),
                                            F.concat_ws(",", x[other].cast("array<string>"))), 256)
                return F.conv(F.substring(digest, F.pmod(i, F.lit(8)) * 8 + 1, F.lit(8)), 16, 10).cast("long")
            sign = F.lit(-1 if back else 1)
            changed = F.transform(x[own], lambda v, i: F.pmod(v + sign * noise(i), F.get(x[radix], i)))
            return F.struct(*[changed.alias(f) if f == own else x[f].alias(f) for f in ("kind", "s", "t", "l", "r", "ml", "mr")])
        return step

    for k in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
        found = F.transform(found, turn(k))
    return found


def pseudonyms(values: Column, key: str, back: bool = False) -> Column:
    """array<struct(kind, s, new)> for an array of found strings; kind is null and new = s for what is not valid."""
    out = F.transform(values, lambda s: F.struct(s.alias("s"), kind_of(s).alias("kind")))
    out = F.transform(out, lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), read(x["kind"], x["s"]).alias("p")))
    half = lambda x: F.ceil(F.size(x["p"]) / 2).cast("int")
    left = lambda x, f: F.slice(x["p"][f], F.lit(1), half(x))
    right = lambda x, f: F.slice(x["p"][f], half(x) + 1, F.size(x["p"]))
    out = F.transform(out, lambda x: F.struct(
        x["kind"].alias("kind"), x["s"].alias("s"), _tweak(x["kind"], x["s"]).alias("t"), left(x, "v").alias("l"), right(x, "v").alias("r"),
        left(x, "m").alias("ml"), right(x, "m").alias("mr")))
    out = _turns(out, key, back)
    out = F.transform(out, lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), F.concat(x["l"], x["r"]).alias("v")))
    return F.transform(out, lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"),
                                               write(x["kind"], x["s"], x["v"]).alias("new")))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with the values in ``text`` replaced, plus pii_kinds (kind of each replaced value in order).

    A null text stays null with no kinds; an empty one stays empty. ``back`` undoes
    the replacement with the same key. Rows are treated one by one, so repeated
    rows and equal values in different documents get equal results. A column
    named pii_kinds in ``docs`` is replaced.
    """
    own = [c for c in docs.columns if c != "pii_kinds"]
    t = F.col(text)
    may = F.coalesce(t.rlike("[0-9@]"), F.lit(False))
    out = docs.select(*[F.col(f"`{c}`") for c in own],
                      F.when(may, F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).alias("_found"))
    hit = F.size(F.coalesce("_found", F.array().cast("array<string>"))) > 0
    out = out.withColumn("_new", F.when(hit, pseudonyms(F.col("_found"), key, back)))
    pieces = F.transform(F.split(t, ANY, -1), lambda p, i: F.concat(p, F.coalesce(F.get("_new.new", i), F.lit(""))))
    changed = F.when(F.col("_new").isNotNull(), F.array_join(pieces, "")).otherwise(t)
    kinds = F.filter(F.col("_new.kind"), lambda k: k.isNotNull())
    return out.select(*[changed.alias(c) if c == text else F.col(f"`{c}`") for c in own],
                      F.coalesce(kinds, F.array().cast("array<string>")).alias("pii_kinds"))
