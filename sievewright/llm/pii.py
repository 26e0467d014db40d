"""Format-preserving Feistel pseudonyms, in DataFrame functions alone.

A text is cut at its candidates by one pattern; each candidate that validates is permuted
within its own format by a keyed Feistel network, so equal values stay equal in every
document and different values of a format stay different:

card     13 to 19 digits, plain or in groups, with a Luhn check digit; the first digit
         stays, the check digit is made anew
account  IBAN of ISO 13616, remainder 1 modulo 97; country stays, check digits are made anew
number   ddd-dd-dddd with area, group and serial in their valid ranges, within them
address  IPv4 of four octets, over all 2^32
phone    a country code, or a bracketed or dashed ten-digit number; the code stays, and the
         rest moves alike with and without it
date     y-m-d, m/d/y (d/m/y where only that is a date) and d.m.y, years 1900 to 2099,
         within its century, by day number: the same day in two notations stays the same
mail     letters and digits of the local part, each within its kind; the domain stays

Numbers are split into two parts of a mixed radix whose product is the format's size, so
nothing is walked or rejected; strings into halves of characters, each moved within its kind.
A value goes through the network, is moved by one step, and comes back through the network:
no value is its own pseudonym, as no value is its own successor.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm.common import table

ROUNDS = 8
#: Country codes of ITU-T E.164 by their first digits; all others have three.
COUNTRY = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: Stretches of Unicode that hold letters of one kind alone: first, how many. Digits and ASCII first.
STRETCHES = [
    (0x30, 10), (0x61, 26), (0x41, 26), (0xDF, 24), (0xF8, 8), (0xC0, 23), (0xD8, 7), (0x430, 32), (0x410, 32), (0x3B1, 25), (0x391, 17), (0x3A3, 7), (0x5D0, 27), (0x621, 26), (0x641, 10),
    (0x905, 53), (0xE01, 46), (0x3041, 86), (0x30A1, 90), (0xAC00, 11172), (0x4E00, 20902)]
#: Characters beyond ASCII outside them move within so many neighbours.
NEIGHBOURS = 16


def _kinds() -> list[tuple[int, int, int]]:
    """First, how many, and within how many they move: the stretches, and all that lies between them but surrogates and the byte order mark."""
    out, at = [(first, n, n) for first, n in STRETCHES], 0x80
    for first, n in sorted([*((f, n) for f, n in STRETCHES if f >= 0x80), (0xD800, 0x800), (0xFEFF, 1), (0x110000, 0)]):
        # None is left alone at the end of its stretch.
        width = next(w for w in itertools.count(NEIGHBOURS) if (first - at) % w != 1 or first - at == 1)
        out += [(at, first - at, width)] * (first > at)
        at = first + n
    return out


#: Days of the two centuries, as products for the network: 36524 and 36525.
CENTURIES = {19: (92, 397), 20: (75, 487)}

_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
KINDS = {
    "mail": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?<=\.[A-Za-z]{2,24})",
    "account": _BEFORE + r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + _AFTER,
    "date": r"(?<![\p{L}\p{N}./-])(?:(?:19|20)[0-9]{2}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/(?:19|20)[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.(?:19|20)[0-9]{2})(?![\p{L}\p{N}]|[./-][0-9])",
    "address": r"(?<![\p{L}\p{N}])(?<![0-9]\.)(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\p{L}\p{N}]|\.[0-9])",
    "number": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}]|-[0-9])",
    "card": r"(?<![\p{L}\p{N}+])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})" + _AFTER,
    "phone": r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([.-])[0-9]{3}\3[0-9]{4})" + _AFTER,
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())

#: What every candidate holds: a sign of mail, six characters of a number, or the head of an account.
HINT = "@|[0-9][0-9 ()./+-]{5}|[A-Z]{2}[0-9]{2}[A-Z0-9 ]{11}"


def _is(x: Column, kind: str) -> Column:
    # A value stands alone here: what surrounds it was seen when it was found.
    return x.rlike(f"^(?:{KINDS[kind]})$".replace(r"\3", r"\1") if kind == "phone" else f"^(?:{KINDS[kind]})$")


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def _draw(key: Column) -> Column:
    """60 bits of a hash."""
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("long")


def _numbers(secret: str, kind: str, left: Column, right: Column, a: int, b: int) -> Column:
    """Permute a pair of Z_a x Z_b: each round adds to one part what the other draws. Returns a struct (l, r)."""

    def turn(s: Column, i: Column) -> Column:
        # Rounds 0 to ROUNDS - 1 lead there, one step follows, and the same rounds lead back.
        step = F.when(i <= ROUNDS, i).otherwise(2 * ROUNDS - i)
        drawn = _draw(_hash(F.lit(secret), F.lit(kind), step.cast("string"), F.when(step % 2 == 0, s["r"]).otherwise(s["l"]).cast("string")))
        by = F.when(i == ROUNDS, F.lit(1).cast("long")).when(i < ROUNDS, drawn).otherwise(-drawn)
        return F.struct(
            F.when((step % 2 == 0) | (i == ROUNDS), F.pmod(s["l"] + by, F.lit(a))).otherwise(s["l"]).alias("l"), F.when((step % 2 == 1) & (i != ROUNDS), F.pmod(s["r"] + by, F.lit(b))).otherwise(s["r"]).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(2 * ROUNDS)), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), turn)


def _let(value: Column, then) -> Column:
    """``then`` of a value that is worked out once, however often it is named."""
    return F.transform(F.array(value), then)[0]


def _moved(c: Column, by: Column) -> Column:
    """A letter or digit moved within its kind; other characters of ASCII stay."""
    known = F.array(*(F.struct(F.lit(first).alias("first"), F.lit(n).alias("n"), F.lit(width).alias("width")) for first, n, width in _kinds()))

    def within(at: Column, k: Column) -> Column:
        start = k["first"] + F.floor((at - k["first"]) / k["width"]) * k["width"]
        return start + F.pmod(at - start + by, F.least(k["width"], k["first"] + k["n"] - start))

    def new(at: Column) -> Column:
        own = F.try_element_at(F.filter(known, lambda k: (at >= k["first"]) & (at < k["first"] + k["n"])), F.lit(1))
        return _let(own, lambda k: F.coalesce(within(at, k), at))

    return F.when(c == "\ufeff", c).otherwise(F.decode(F.unhex(F.lpad(F.hex(_let(F.ascii(c), new)), 8, "0")), "UTF-32"))


def _text(secret: str, kind: str, text: Column) -> Column:
    """Permute a string: digits among digits, letters among letters of their kind; other characters stay. One hash of a half draws for all characters of the other."""

    def each(part: Column, by) -> Column:
        return F.when(F.length(part) == 0, F.lit("")).otherwise(F.array_join(F.transform(F.split(part, ""), lambda c, i: _moved(c, by(i + 1))), ""))

    def turn(s: Column, i: Column) -> Column:
        # Rounds 0 to ROUNDS - 1 lead there, one step follows, and the same rounds lead back.
        step = F.when(i <= ROUNDS, i).otherwise(2 * ROUNDS - i)
        key = F.when(i != ROUNDS, _hash(F.lit(secret), F.lit(kind), step.cast("string"), F.when(step % 2 == 0, s["r"]).otherwise(s["l"])))
        sign = F.when(i < ROUNDS, 1).otherwise(-1)

        def moved(part: Column, side: int) -> Column:
            return _let(key, lambda k: F.when(k.isNull(), each(part, lambda j: F.lit(1))).when(step % 2 == side, each(part, lambda j: sign * _draw(_hash(k, j.cast("string"))))).otherwise(part))

        return F.struct(moved(s["l"], 0).alias("l"), moved(s["r"], 1).alias("r"))

    def whole(t: Column) -> Column:
        half = F.floor(F.length(t) / 2).cast("int")
        start = F.struct(F.substr(t, F.lit(1), half).alias("l"), F.substr(t, half + 1).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(2 * ROUNDS)), start, turn, lambda s: F.concat(s["l"], s["r"]))

    return _let(text, whole)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _laid(x: Column, digits: Column) -> Column:
    """``x`` with its digits replaced by ``digits``, in order."""
    return _let(digits, lambda d: F.array_join(F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.when(
        F.substr(x, i, F.lit(1)).rlike("^[0-9]$"), F.substr(d, F.length(_digits(F.substr(x, F.lit(1), i))), F.lit(1))).otherwise(F.substr(x, i, F.lit(1)))), ""))


def _luhn(payload: Column) -> Column:
    """The check digit behind ``payload``."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(payload, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.pmod(-F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add), F.lit(10)).cast("string")


def _mod97(x: Column) -> Column:
    def add(rest: Column, i: Column) -> Column:
        c = F.substr(x, i, F.lit(1))
        return F.when(c.rlike("^[0-9]$"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(x)), F.lit(0), add)


def _card(secret: str, x: Column) -> Column:
    def of(d: Column) -> Column:
        payload = F.substr(d, F.lit(1), F.length(d) - 1)
        new = F.concat(F.substr(d, F.lit(1), F.lit(1)), _text(secret, "card", F.substr(payload, F.lit(2))))
        return F.when(_luhn(payload) == F.substr(d, F.length(d)), _let(new, lambda n: _laid(x, F.concat(n, _luhn(n))))).otherwise(x)

    return _let(_digits(x), of)


def _account(secret: str, x: Column) -> Column:
    def of(flat: Column) -> Column:
        country, rest = F.substr(flat, F.lit(1), F.lit(2)), F.substr(flat, F.lit(5))
        whole = _let(_text(secret, "account", rest), lambda new: F.concat(country, F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0"), new))
        spaced = _let(whole, lambda w: F.array_join(F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.when(F.substr(x, i, F.lit(1)) == " ", F.lit(" ")).otherwise(
            F.substr(w, F.length(F.regexp_replace(F.substr(x, F.lit(1), i), " ", "")), F.lit(1)))), ""))
        return F.when(_mod97(F.concat(rest, country, F.substr(flat, F.lit(3), F.lit(2)))) == 1, spaced).otherwise(x)

    return _let(F.regexp_replace(x, " ", ""), of)


def _number(secret: str, x: Column) -> Column:
    area, group, serial = (F.element_at(F.split(x, "-"), i).cast("int") for i in (1, 2, 3))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    skipped = area - F.when(area > 666, 2).otherwise(1)
    out = _numbers(secret, "number", skipped * 99 + group - 1, serial - 1, 898 * 99, 9999)
    at = F.floor(out["l"] / 99)
    text = F.format_string("%03d-%02d-%04d", at + F.when(at >= 665, 2).otherwise(1), out["l"] % 99 + 1, out["r"] + 1)
    return F.when(valid, text).otherwise(x)


def _address(secret: str, x: Column) -> Column:
    o = [F.element_at(F.split(x, r"\."), i).cast("int") for i in (1, 2, 3, 4)]
    out = _numbers(secret, "address", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
    text = F.concat_ws(".", *[f(out[p]).cast("string") for p in ("l", "r") for f in (lambda v: F.floor(v / 256), lambda v: v % 256)])
    return F.when((o[0] < 256) & (o[1] < 256) & (o[2] < 256) & (o[3] < 256), text).otherwise(x)


def _phone(secret: str, x: Column) -> Column:
    code = F.regexp_extract(x, COUNTRY, 0)
    rest = F.substr(x, F.length(code) + 1)
    n = F.length(_digits(x))
    return F.when((n >= 8) & (n <= 15), F.concat(code, _laid(rest, _text(secret, "phone", _digits(rest))))).otherwise(x)


def _date(secret: str, x: Column) -> Column:
    a, b, c = (F.element_at(F.split(x, "[-/.]"), i) for i in (1, 2, 3))
    iso, slashed = x.contains("-"), x.contains("/")
    year = F.when(iso, a).otherwise(c).cast("int")
    month_first = slashed & (a.cast("int") <= 12)
    month = F.when(month_first, a).otherwise(b).cast("int")
    day = F.when(iso, c).when(month_first, b).otherwise(a).cast("int")
    sound = F.when((month >= 1) & (month <= 12), (day >= 1) & (day <= F.day(F.last_day(F.make_date(year, month, F.lit(1)))))).otherwise(False)
    new = F.lit(None).cast("date")
    for century, (p, q) in CENTURIES.items():
        start = F.lit(f"{century}00-01-01").cast("date")
        at = F.datediff(F.make_date(year, month, day), start)
        out = _numbers(secret, "date", F.floor(at / q), at % q, p, q)
        new = F.when(F.floor(year / 100) == century, F.date_add(start, (out["l"] * q + out["r"]).cast("int"))).otherwise(new)
    separator = F.when(slashed, F.lit("/")).otherwise(F.lit("."))
    # A one-digit part stays without a zero where the new one allows.
    wide = lambda old, v: F.when(F.length(old) == 1, v.cast("string")).otherwise(F.lpad(v.cast("string"), 2, "0"))
    text = F.transform(F.array(new), lambda d: F.when(iso, F.concat_ws("-", F.year(d).cast("string"), wide(b, F.month(d)), wide(c, F.day(d)))).when(
        month_first, F.concat_ws("/", wide(a, F.month(d)), wide(b, F.day(d)), F.year(d).cast("string"))).otherwise(
        F.concat(wide(a, F.day(d)), separator, wide(b, F.month(d)), separator, F.year(d).cast("string"))))[0]
    return F.when(sound, text).otherwise(x)


def _mail(secret: str, x: Column) -> Column:
    at = F.instr(x, "@")
    return F.concat(_text(secret, "mail", F.substr(x, F.lit(1), at - 1)), F.substr(x, at))


def _value(secret: str, x: Column) -> Column:
    makers = {"mail": _mail, "account": _account, "date": _date, "address": _address, "number": _number, "card": _card, "phone": _phone}
    out = F.when(x.contains("@"), _mail(secret, x))
    for kind in list(KINDS)[1:]:
        out = out.when(_is(x, kind), makers[kind](secret, x))
    return out.otherwise(x)


def pseudonymise(docs: DataFrame, secret: str, column: str = "text") -> DataFrame:
    """``docs`` with the private values of ``column`` replaced, and ``n_private``, the number replaced.

    No shuffle and no Python: each row on its own. A null text stays null with 0 values; an
    empty one stays empty; repeated rows and values give the same result everywhere, so no
    tie arises; an empty table gives an empty one; a very long text is searched whole, in
    time that grows with its length. What looks like a format but doesn't validate stays.
    Other columns stay; one called ``n_private`` is replaced. ``secret`` is the key.
    """
    text = F.col(column)
    # A plain look first, then one search; values are few, so the rest touches few texts.
    searched = docs.withColumn("__found", F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    old = F.when(F.size("__found") > 0, F.col("__found"))
    parts = F.struct(F.split(text, ANY, -1).alias("between"), old.alias("old"), F.transform(old, lambda x: _value(secret, x)).alias("new"))
    marked = searched.withColumn("__private", F.when(old.isNotNull(), parts))
    joined = F.array_join(F.zip_with("__private.between", "__private.new", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    count = F.size(F.filter(F.zip_with("__private.old", "__private.new", lambda a, b: a != b), lambda x: x))
    return marked.withColumns({
        column: F.when(F.col("__private").isNull(), text).otherwise(joined),
        "n_private": F.when(F.col("__private").isNull(), F.lit(0)).otherwise(count),
    }).drop("__private", "__found")


#: The queries' key. A deployment passes its own.
SECRET = "sievewright"


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with pseudonyms; ``n_chars``, where there is one, follows if an address changes its length. Null and empty texts, repeated rows and an empty table as in ``pseudonymise``; all other columns stay as they are, also one called ``n_private``."""
    out = pseudonymise(docs.withColumnRenamed("n_private", "__n_private"), SECRET)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_private") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop("n_private").withColumnRenamed("__n_private", "n_private").select(docs.columns)


def query(spark, sf_dir):
    """doc_id, text with pseudonyms, n_private."""
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), SECRET)
