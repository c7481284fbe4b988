"""Format-preserving pseudonyms for personal data, from DataFrame functions only.

One pattern finds candidates; what passes its kind's validation is replaced, the rest of
the text stays as it is, byte for byte.  Numbers and dates go through a keyed Feistel
network over exactly the set of valid values of their format: round functions are SHA-256 of
key, kind, round and the other half, the halves count modulo two radices whose product is
the size of the set, so the map is a permutation and equal values stay linked across
documents, however they are punctuated.

kind    set that is permuted
card    digit strings of one length that pass the Luhn test (last digit recomputed)
iban    digits of the account part of one length and country, check digits recomputed
phone   the last ten digits (all of a shorter number)
ssn     area x (group, serial) without the areas, groups and serials never issued
ip      all IPv4 addresses
date    the 146,097 days from 1800-01-01 to 2199-12-31 as 189 x 773

E-mail names, access keys and passwords have no small set of valid values; they become
keyed digests of the same length and alphabet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .names import free

ROUNDS = 10

# Formats.
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@"
         r"[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}")
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
SECRET = (r"(?i:(?<![A-Za-z])(?:password|passwd|pwd|token|secret|api[_-]?key)\s{0,4}[=:]\s{0,4}"
          r"[\"']?)[A-Za-z0-9+/_=-]{8,512}")
IBAN = (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
        r"(?![A-Za-z0-9])")
DATE = (r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})"
        r"(?![\d/-]|\.\d)")
IPV4 = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = (r"(?<![\d.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5})"
        r"(?!\d)")
PHONE = (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
         r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)")
CANDIDATE = "|".join([EMAIL, ACCESS_KEY, SECRET, IBAN, DATE, IPV4, SSN, PHONE, CARD])
DAYS, FIRST_DAY = (189, 773), "1800-01-01"
KINDS = ("email", "phone", "card", "iban", "ssn", "ip", "date", "secret")


def _mac(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)


def _number(digest: Column) -> Column:
    """The first 60 bits."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, radix_a: Column, radix_b: Column, key: str,
            kind: Column) -> Column:
    """Permute the pairs (a, b) with 0 <= a < radix_a, 0 <= b < radix_b; struct(a, b)."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s: Column, i: Column) -> Column:
        left = F.pmod(s["a"] + _number(_mac(key, kind, i, s["b"])), radix_a.cast("long"))
        right = F.pmod(s["b"] + _number(_mac(key, kind, i, s["a"])), radix_b.cast("long"))
        return F.when(i % 2 == 0, F.struct(left.alias("a"), s["b"].alias("b"))) \
            .otherwise(F.struct(s["a"].alias("a"), right.alias("b")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _substr(s: Column, start, length) -> Column:
    return F.substring(s, F.lit(start) if isinstance(start, int) else start,
                       F.lit(length) if isinstance(length, int) else length)


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A permutation of the digit strings of each length (2 to 36)."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    power = lambda m: F.rpad(F.lit("1"), m + 1, "0").cast("long")
    moved = feistel(_substr(digits, 1, left), _substr(digits, left + 1, n - left), power(left),
                    power(n - left), key, F.concat(F.lit(kind), n.cast("string")))
    return _let(moved, lambda s: F.concat(F.lpad(s["a"].cast("string"), left, "0"),
                                          F.lpad(s["b"].cast("string"), n - left, "0")))


def only_digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def put_digits(shape: Column, digits: Column) -> Column:
    """The shape with its digits replaced, in order."""
    chars = F.transform(F.sequence(F.lit(1), F.length(shape)), lambda i: F.when(
        _substr(shape, i, 1).rlike("[0-9]"),
        _substr(digits, F.length(only_digits(_substr(shape, 1, i))), 1))
        .otherwise(_substr(shape, i, 1)))
    return F.array_join(chars, "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum; the last digit counts once."""
    n = F.length(digits)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + _let(
        _substr(digits, i, 1).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1),
        lambda d: F.when(d > 9, d - 9).otherwise(d)))


def mod97(text: Column) -> Column:
    """Remainder of an account number with letters as 10-35."""
    return F.aggregate(F.split(text, ""), F.lit(0), lambda acc, c: F.when(
        c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97).when(
        c.rlike("[A-Z]"), (acc * 100 + F.ascii(c) - 55) % 97).otherwise(acc))


def _card(m: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        body = permute_digits(_substr(d, 1, F.length(d) - 1), key, "card")
        return _let(body, lambda b: F.concat(b, F.pmod(
            10 - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10)).cast("string")))

    return _let(only_digits(m), lambda d: F.when(luhn_sum(d) % 10 == 0, put_digits(m, new(d))))


def _phone(m: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        tail = F.least(F.length(d), F.lit(10))
        return F.concat(_substr(d, 1, F.length(d) - tail),
                        permute_digits(_substr(d, F.length(d) - tail + 1, tail), key, "phone"))

    return _let(only_digits(m), lambda d: F.when(F.length(d).between(7, 15),
                                                 put_digits(m, new(d))))


def _iban(m: Column, key: str) -> Column:
    def new(s: Column) -> Column:  # without spaces
        country, account = _substr(s, 1, 2), _substr(s, 5, F.length(s))
        digits = only_digits(account)
        moved = F.when(F.length(digits) > 1, put_digits(
            account, permute_digits(digits, key, "iban"))).otherwise(account)
        return _let(F.concat(country, moved), lambda t: _let(
            98 - mod97(F.concat(_substr(t, 3, F.length(t)), _substr(t, 1, 2), F.lit("00"))),
            lambda c: F.concat(_substr(t, 1, 2), F.lpad(c.cast("string"), 2, "0"),
                               _substr(t, 3, F.length(t)))))

    return _let(F.regexp_replace(m, " ", ""), lambda s: F.when(
        mod97(F.concat(_substr(s, 5, F.length(s)), _substr(s, 1, 4))) == 1,
        put_digits(m, only_digits(new(s)))))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (_substr(m, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    moved = feistel(place, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key,
                    F.lit("ssn"))
    return F.when(valid, _let(moved, lambda s: F.format_string(
        "%03d-%02d-%04d", s["a"] + 1 + F.when(s["a"] >= 665, 1).otherwise(0),
        F.floor(s["b"] / 9999) + 1, s["b"] % 9999 + 1)))


def _ip(m: Column, key: str) -> Column:
    part = lambda i: F.split_part(m, F.lit("."), F.lit(i)).cast("long")
    moved = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), F.lit(65536),
                    F.lit(65536), key, F.lit("ip"))
    return _let(moved, lambda s: F.format_string(
        "%d.%d.%d.%d", F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256))


def _date(m: Column, key: str) -> Column:
    """Year first; else month/day/year if that is a date, or day/month/year; dots mean
    day.month.year.  The written order is kept."""
    a, b, c = _substr(m, 1, 2), _substr(m, 4, 2), _substr(m, 7, 4)
    forms = [(m.rlike(r"^\d{4}"), F.concat_ws("-", _substr(m, 1, 4), _substr(m, 6, 2),
                                              _substr(m, 9, 2)), ("yyyy", "MM", "dd")),
             (m.contains("/"), F.concat_ws("-", c, a, b), ("MM", "dd", "yyyy")),
             (F.lit(True), F.concat_ws("-", c, b, a), ("dd", "MM", "yyyy"))]
    radix_a, radix_b = DAYS
    first = F.lit(FIRST_DAY).cast("date")

    def permuted(n: Column) -> Column:
        moved = feistel(F.floor(n / radix_b), n % radix_b, F.lit(radix_a), F.lit(radix_b), key,
                        F.lit("date"))
        return _let(moved, lambda s: F.date_add(first, (s["a"] * radix_b + s["b"]).cast("int")))

    def written(iso: Column, order: str) -> Column:
        day = F.datediff(F.try_to_date(iso, "yyyy-MM-dd"), first)
        return _let(day, lambda n: F.when(
            n.between(0, radix_a * radix_b - 1),
            put_digits(m, F.date_format(permuted(n), order))))

    out = F.lit(None).cast("string")
    for applies, iso, order in reversed(forms):
        out = F.coalesce(F.when(applies, written(iso, "".join(order))), out)
    return out


def _letters(digest: Column, alphabet: str) -> Column:
    return F.translate(digest, "0123456789abcdef", alphabet)


def _email(m: Column, key: str) -> Column:
    name = F.substring_index(m, "@", 1)
    new = _letters(_mac(key, F.lit("email"), F.lower(m)), "abcdefghijkmnprs")
    return F.when(m.rlike(r"\.[A-Za-z]{2,24}$"), F.concat(
        _substr(new, 1, F.length(name)), _substr(m, F.length(name) + 1, F.length(m))))


def _secret(m: Column, key: str) -> Column:
    """The value after the separator, or what follows AKIA."""
    head = F.when(m.startswith("AKIA"), "AKIA").otherwise(
        F.regexp_extract(m, "^([^=:]*[=:]\\s*[\"']?)", 1))
    value = _substr(m, F.length(head) + 1, F.length(m))
    digest = _mac(key, F.lit("secret"), value)
    new = F.when(m.startswith("AKIA"), _letters(digest, "ABCDEFGHJKLMNPQR")).otherwise(digest)
    return F.concat(head, _substr(F.repeat(new, 8), 1, F.length(value)))


def _kind(m: Column) -> Column:
    return (F.when(m.contains("@"), "email").when(m.startswith("AKIA"), "secret")
            .when(m.rlike("^[A-Za-z _-]+[=:]"), "secret").when(m.rlike(r"^[A-Z]{2}\d{2}"), "iban")
            .when(m.rlike(r"^(\d{4}[-/]\d{2}[-/]\d{2}|\d{2}[/.]\d{2}[/.]\d{4})$"), "date")
            .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(m.rlike(f"^(?:{PHONE})$"), "phone").otherwise("card"))


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The replacement of one candidate; null if it does not pass its kind's validation."""
    made = {"email": _email, "phone": _phone, "card": _card, "iban": _iban, "ssn": _ssn,
            "ip": _ip, "date": _date, "secret": _secret}
    out = F.lit(None).cast("string")
    for name, make in made.items():
        out = F.when(kind == name, make(m, key)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text",
                 counts: str = "pii_counts") -> DataFrame:
    """The documents with pseudonyms in the text and a column `counts`: a struct with the
    number of replaced values of each kind.

    Defined cases: a null text stays null with counts of 0, an empty text stays empty;
    repeated rows stay repeated and equal; all other columns pass unchanged, but an input
    column named like `counts` is replaced.
    """
    text = F.col(f"`{text_col}`")
    found = F.transform(
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)),
        lambda m: _let(_kind(m), lambda k: F.struct(
            m.alias("m"), k.alias("k"), pseudonym(m, k, key).alias("p"))))
    (hits,) = free(docs, "_found")
    rows = docs.withColumn(hits, F.when(text.rlike(CANDIDATE), found))
    parts = F.split(text, CANDIDATE)
    new = F.array_join(F.transform(parts, lambda s, i: F.concat(s, F.coalesce(
        F.get(F.col(hits), i)["p"], F.get(F.col(hits), i)["m"], F.lit("")))), "")
    kinds = F.transform(F.filter(F.col(hits), lambda x: x["p"].isNotNull()), lambda x: x["k"])
    many = [F.coalesce(F.size(F.array_remove(kinds, n)), F.lit(0)) for n in KINDS]
    many = [(F.coalesce(F.size(kinds), F.lit(0)) - rest).cast("long").alias(n)
            for n, rest in zip(KINDS, many)]
    names = {c: F.col(f"`{c}`") for c in docs.columns}
    names[text_col] = F.when(F.col(hits).isNull(), text).otherwise(new).alias(text_col)
    names[counts] = F.when(F.col(hits).isNull(), F.struct(
        *[F.lit(0).cast("long").alias(n) for n in KINDS])).otherwise(F.struct(*many)).alias(counts)
    return rows.select(*names.values())
