"""Personal data replaced by format-preserving pseudonyms.

Numbers and dates are found by pattern, validated (Luhn check digit, octets,
calendar) and put through a keyed Feistel permutation of their own format: a card number
becomes another valid card number of the same length, a date another
date, separators stay. The permutation depends on the key and the value only, so
equal values stay linked across documents, and the holder of the key can undo it.
The local part of an e-mail address becomes a keyed digest. Built from DataFrame
expressions only; nothing is shuffled.

Defined results: null text stays null, empty text stays empty; numbers that fail
validation stay as they are; overlapping candidates are settled from left to right.
Rows are changed one by one, so repeated rows and ties need no rule; further
columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import free_name

#: Key of the registered query. A production run passes its own.
KEY = "pseudonym key of the registered query"
#: Passes of the permutation; an even number returns the halves to their sides.
ROUNDS = 8
#: Dates permuted: 1900-01-01 to 2099-12-31, 17 x 4297 days.
FIRST_DAY, DAY_HALVES = "1900-01-01", (17, 4297)

# kind -> pattern; tried in this order at each place of a text
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])",
    "iso_date": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])",
    "date": r"(?<![0-9./])[0-9]{2}([./])[0-9]{2}\1[0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{4})(?![0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (a lambda's variable)."""
    return F.get(F.transform(F.array(value), body), 0)


def _round(key: str, tag: Column, number: Column, half: Column) -> Column:
    """Keyed round function: the first 60 bits of SHA-256."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tag, number, half), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permute(n: Column, a: Column, b: Column, key: str, tag: Column, inverse: bool = False) -> Column:
    """Permutation of 0 .. a*b - 1 (LONG). One pass maps the halves (l, r) with sizes
    (a, b) to (r, l + f(r) mod a) with sizes (b, a)."""
    start = F.struct(F.call_function("div", n, b).cast("long").alias("l"),
                     F.pmod(n, b).cast("long").alias("r"), a.cast("long").alias("a"), b.cast("long").alias("b"))

    def forth(s: Column, i: Column) -> Column:
        moved = F.pmod(s["l"] + F.pmod(_round(key, tag, i, s["r"]), s["a"]), s["a"])
        return F.struct(s["r"].alias("l"), moved.alias("r"), s["b"].alias("a"), s["a"].alias("b"))

    def back(s: Column, i: Column) -> Column:
        moved = F.pmod(s["r"] - F.pmod(_round(key, tag, i, s["l"]), s["b"]), s["b"])
        return F.struct(moved.alias("l"), s["l"].alias("r"), s["b"].alias("a"), s["a"].alias("b"))

    order = range(ROUNDS)[::-1] if inverse else range(ROUNDS)
    passes = F.array(*[F.lit(i) for i in order])
    return F.aggregate(passes, start, back if inverse else forth, lambda s: s["l"] * s["b"] + s["r"])


def permute_digits(digits: Column, key: str, kind: str, inverse: bool = False) -> Column:
    """Digits of up to 18 characters to as many digits."""
    k = F.length(digits)
    half = F.floor(k / 2).cast("int")
    size = lambda c: F.rpad(F.lit("1"), c + 1, F.lit("0")).cast("long")
    n = permute(digits.cast("long"), size(half), size(k - half), key, F.concat(F.lit(kind), k), inverse)
    return F.lpad(n.cast("string"), k, F.lit("0"))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def fill(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order by ``digits``."""
    nth = lambda i: F.length(digits_of(F.substring(value, F.lit(1), i + 1)))
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(
        c.rlike("^[0-9]$"), F.substring(digits, nth(i), F.lit(1))).otherwise(c)), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits whose last one is not doubled."""
    n = F.length(digits)

    def part(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(F.pmod(n - i, F.lit(2)) == 0, twice).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), part), F.lit(0), lambda s, x: s + x)


def check_digit(body: Column) -> Column:
    return F.pmod(F.lit(10) - F.pmod(luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")


def card(value: Column, key: str, inverse: bool = False) -> Column:
    def changed(d: Column) -> Column:
        body = permute_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card", inverse)
        return let(body, lambda b: F.concat(b, check_digit(b)))

    ok = lambda d: F.pmod(luhn_sum(d), F.lit(10)) == 0
    return let(digits_of(value), lambda d: F.when(ok(d), let(changed(d), lambda c: fill(value, c))).otherwise(value))


def phone(value: Column, key: str, inverse: bool = False) -> Column:
    """The last ten digits; a country code stays."""
    d = digits_of(value)
    new = F.concat(F.substring(d, F.lit(1), F.length(d) - 10), permute_digits(F.right(d, F.lit(10)), key, "phone", inverse))
    return let(new, lambda c: fill(value, c))


def ssn(value: Column, key: str, inverse: bool = False) -> Column:
    return let(permute_digits(digits_of(value), key, "ssn", inverse), lambda c: fill(value, c))


def ip(value: Column, key: str, inverse: bool = False) -> Column:
    octets = F.transform(F.split(value, "\\."), lambda x: x.cast("long"))
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda s, x: s * 256 + x)
    new = permute(number, F.lit(65536), F.lit(65536), key, F.lit("ip"), inverse)
    dotted = lambda n: F.concat_ws(".", *[F.shiftright(n, s).bitwiseAND(F.lit(255)) for s in (24, 16, 8, 0)])
    return F.when(F.forall(octets, lambda x: x < 256), let(new, dotted)).otherwise(value)


def date(value: Column, key: str, form: str, inverse: bool = False) -> Column:
    """Valid dates of 1900 to 2099 to dates of that range, in the same form."""
    sep = F.substring(value, 3, 1)
    plain = value if form == "iso" else F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 4, 2),
                                                    F.substring(value, 1, 2))
    day = F.date_diff(F.try_to_date(plain, "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date"))
    a, b = DAY_HALVES

    def text(n: Column) -> Column:
        d = F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int")).cast("string")
        return d if form == "iso" else F.concat(F.substring(d, 9, 2), sep, F.substring(d, 6, 2), sep, F.substring(d, 1, 4))

    return let(day, lambda n: F.when((n >= 0) & (n < a * b), let(
        permute(n.cast("long"), F.lit(a), F.lit(b), key, F.lit("date"), inverse), text)).otherwise(value))


def email(value: Column, key: str) -> Column:
    """A digest of the whole address before its domain."""
    digest = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value)), 256), 1, 12)
    return F.concat(F.lit("p"), digest, F.lit("@"), F.substring_index(value, "@", -1))


def pseudonym(value: Column, key: str, inverse: bool = False) -> Column:
    """Pseudonym of one match of ``ANY``; with ``inverse`` the value (e-mail addresses stay)."""
    whole = lambda kind: value.rlike(f"^(?:{PATTERNS[kind]})$")
    return (F.when(value.contains("@"), value if inverse else email(value, key))
            .when(whole("ip"), ip(value, key, inverse))
            .when(whole("iso_date"), date(value, key, "iso", inverse))
            .when(whole("date"), date(value, key, "dmy", inverse))
            .when(whole("phone"), phone(value, key, inverse))
            .when(whole("ssn"), ssn(value, key, inverse))
            .otherwise(card(value, key, inverse)))


def _replaced(docs: DataFrame, key: str, inverse: bool, new_text: str, count: str) -> DataFrame:
    """``docs`` with the replaced text and the number of replaced values added."""
    text, found, new = F.col("text"), free_name(docs, "found"), free_name(docs, "new")
    # the match list is a column of its own, so that each pattern pass runs once
    some = docs.withColumn(found, F.when(text.rlike(ANY), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    some = some.withColumn(new, F.transform(found, lambda m: pseudonym(m, key, inverse)))
    hit = F.col(found).isNotNull()
    between = F.when(hit, F.split(text, ANY, -1))
    pairs = F.zip_with(between, F.concat(new, F.array(F.lit(""))), lambda x, y: F.array(x, y))
    changed = F.size(F.filter(F.zip_with(found, new, lambda x, y: x != y), lambda c: c))
    return some.select(*[F.col(c) for c in docs.columns],
                       F.when(hit, F.array_join(F.flatten(pairs), "")).otherwise(text).alias(new_text),
                       F.when(hit, changed).otherwise(0).cast("long").alias(count))


def pseudonymise(docs: DataFrame, key: str = KEY, inverse: bool = False) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced, and ``n_pseudonyms``,
    the number of values replaced (null text: 0), in place of a column of that name."""
    docs = docs.drop("n_pseudonyms")
    new = free_name(docs, "new_text")
    out = _replaced(docs, key, inverse, new, "n_pseudonyms")
    return out.select(*[F.col(new).alias("text") if c == "text" else F.col(c) for c in docs.columns], "n_pseudonyms")


def replace_in_documents(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with the same columns, the text replaced and ``n_chars`` (if there is
    one) set to its new length."""
    new = free_name(docs, "new_text")
    out = _replaced(docs, key, False, new, free_name(docs, "n_replaced"))
    own = {"text": F.col(new).alias("text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.length(new).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*[own.get(c, F.col(c)) for c in docs.columns])
