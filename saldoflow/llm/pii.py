"""Format-preserving pseudonyms for private values, in DataFrame expressions only.

Values are found by pattern and validated (check digits, octets, calendar days). A
validated value is permuted within its format by a keyed Feistel network: half of its
symbols are shifted by a keyed hash of the other half, in turn, each symbol within its own
kind (digit, small or capital letter, octet, day). The network depends on the key and the
kind only, so equal values get equal pseudonyms in all documents, different values
different ones, and the pseudonym is a valid value of the same format: card numbers and
account numbers keep right check digits, dates are days of the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from saldoflow.functions.scalars import once
from saldoflow.llm.common import fresh

#: Rounds of the network.
ROUNDS = 10
_EDGE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
#: Patterns by kind, the earlier first. The word before a secret stays as it is.
PATTERNS = {
    "email": r"(?<![0-9A-Za-z._%+-])[0-9A-Za-z][0-9A-Za-z._%+-]*+@[0-9A-Za-z-]++(?:\.[0-9A-Za-z-]++){1,20}",
    "password": _EDGE + r"(?i:password|passwd|secret)=[0-9A-Za-z]++",
    "token": _EDGE + r'(?i:token) = "[0-9a-fA-F]++"',
    "access_key": _EDGE + r"AKIA[0-9A-Z]{16}" + _END,
    "iban": _EDGE + r"[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?" + _END,
    "date": _EDGE + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})" + _END,
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}"
             r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})" + _END,
    "card": _EDGE + r"[0-9](?:[ -]?[0-9]){12,18}" + _END,
}
#: Days from this one on for so many are permuted among themselves: the years 1900 to 2099.
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)
_SMALL, _CAPITAL = ord("a"), ord("A")


def let(value: Column, f) -> Column:
    """``f`` of a value that is worked out once."""
    return F.transform(F.array(value), f)[0]


def feistel(values: Column, radices: Column, tweak: Column, key: str) -> Column:
    """Keyed permutation of an array of numbers, each below its radix.

    A round shifts one half of the places by a hash of the other half's values, so it can
    be undone; which half alternates.
    """
    half = F.floor(F.size(values) / 2)
    shifted = lambda i, r: (i < half) == (r % 2 == 0)

    def one(v: Column, r: Column) -> Column:
        other = F.array_join(F.transform(v, lambda x, i: F.when(shifted(i, r), F.lit("")).otherwise(x.cast("string"))), ",")
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, r.cast("string"), other), 256)
        return let(digest, lambda d: F.transform(v, lambda x, i: F.when(shifted(i, r), F.pmod(
            x + F.conv(F.substring(F.sha2(F.concat_ws(":", d, i.cast("string")), 256), 1, 12), 16, 10).cast("long"),
            F.get(radices, i))).otherwise(x)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, one)


def _number(digits: Column) -> Column:
    """Array of the digits of a text."""
    return F.transform(F.split(digits, ""), lambda c: c.cast("long"))


def _letters(span: Column, first: Column, last: Column, tweak: Column, key: str) -> Column:
    """Permute the digits and letters from place ``first`` to before ``last`` of a text."""
    chars = F.split(span, "")
    symbols = F.regexp_replace(F.substring(span, first + 1, last - first), "[^0-9A-Za-z]", "")
    code = lambda c: F.ascii(c).cast("long")
    start = lambda c: F.when(c.between("0", "9"), ord("0")).when(c.between("a", "z"), _SMALL).otherwise(_CAPITAL)
    radix = lambda c: F.when(c.between("0", "9"), 10).otherwise(26).cast("long")
    # Places of the symbols, from which each character finds its pseudonym.
    active = lambda c, i: (i >= first) & (i < last) & c.rlike("[0-9A-Za-z]")
    return let(F.split(symbols, ""), lambda s: let(
        feistel(F.transform(s, lambda c: code(c) - start(c)), F.transform(s, radix), tweak, key),
        lambda new: let(
            F.transform(s, lambda c, k: F.chr(F.get(new, k) + start(c))),
            lambda out: F.aggregate(
                F.transform(chars, lambda c, i: F.struct(c.alias("c"), active(c, i).alias("a"))),
                F.struct(F.lit("").alias("t"), F.lit(0).alias("k")),
                lambda acc, x: F.struct(
                    F.concat(acc["t"], F.when(x["a"], F.get(out, acc["k"])).otherwise(x["c"])).alias("t"),
                    (acc["k"] + F.when(x["a"], 1).otherwise(0)).alias("k")),
                lambda acc: acc["t"]))))


def _luhn_sum(digits: Column) -> Column:
    """Sum of a digit text by the Luhn rule, as if one check digit 0 followed."""
    n = F.char_length(digits)
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.transform(_number(digits), lambda d, i: F.when((n - i) % 2 == 1, doubled(d)).otherwise(d)),
                       F.lit(0).cast("long"), lambda a, d: a + d)


def _luhn_valid(digits: Column) -> Column:
    n = F.char_length(digits)
    return F.pmod(_luhn_sum(F.substring(digits, F.lit(1), n - 1)) + F.substring(digits, n, F.lit(1)).cast("long"), F.lit(10)) == 0


def _mod97(text: Column) -> Column:
    """The remainder modulo 97 of an account number's letters and digits, letters from 10 on."""
    value = lambda c: F.when(c.between("0", "9"), c.cast("long")).otherwise(F.ascii(c) - (_CAPITAL - 10))
    return F.aggregate(F.split(text, ""), F.lit(0).cast("long"), lambda a, c: F.when(
        c.between("0", "9"), (a * 10 + value(c)) % 97).otherwise((a * 100 + value(c)) % 97))


def _into_shape(span: Column, digits: Column) -> Column:
    """Put digits, in order, in the place of a text's digits and letters."""
    return F.aggregate(F.split(span, ""), F.struct(F.lit("").alias("t"), F.lit(1).alias("k")),
                       lambda a, c: F.when(c.rlike("[0-9A-Za-z]"), F.struct(
                           F.concat(a["t"], F.substring(digits, a["k"], F.lit(1))).alias("t"), (a["k"] + 1).alias("k")))
                       .otherwise(F.struct(F.concat(a["t"], c).alias("t"), a["k"].alias("k"))), lambda a: a["t"])


def _card(span: Column, key: str) -> Column:
    digits = F.regexp_replace(span, "[^0-9]", "")
    body = F.substring(digits, F.lit(1), F.char_length(digits) - 1)
    new = F.array_join(feistel(_number(body), F.transform(_number(body), lambda _: F.lit(10).cast("long")),
                               F.lit("card"), key), "")
    out = let(new, lambda b: F.concat(b, F.pmod(-_luhn_sum(b), F.lit(10)).cast("string")))
    return F.when(_luhn_valid(digits), _into_shape(span, out)).otherwise(span)


def _iban(span: Column, key: str) -> Column:
    plain = F.regexp_replace(span, " ", "")
    n = F.char_length(plain)
    head, body = F.substring(plain, 1, 4), F.substring(plain, F.lit(5), n)
    country = F.substring(plain, 1, 2)
    valid = _mod97(F.concat(body, head)) == 1
    new = _letters(body, F.lit(0), F.char_length(body), F.concat(F.lit("iban"), country), key)
    out = let(new, lambda b: F.concat(country, F.lpad((98 - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b))
    return F.when(valid, _into_shape(span, out)).otherwise(span)


def _ip(span: Column, key: str) -> Column:
    octets = F.transform(F.split(span, "[.]"), lambda o: o.cast("long"))
    new = F.array_join(feistel(octets, F.transform(octets, lambda _: F.lit(256).cast("long")), F.lit("ip"), key), ".")
    return F.when(F.forall(octets, lambda o: o < 256), new).otherwise(span)


def _days(n: Column, radix: tuple[int, int], tweak: Column, key: str) -> Column:
    """Permute a day's number, which is below the product of the radices."""
    a, b = radix
    return let(feistel(F.array(n % a, F.floor(n / a)), F.array(F.lit(a).cast("long"), F.lit(b).cast("long")),
                       tweak, key), lambda v: v[1] * a + v[0])


def _walk(day: Column, base: Column, radix: tuple[int, int], tweak: Column, key: str, allowed) -> Column:
    """Permute a day counted from ``base``, and again while the result is not allowed; so
    allowed days are permuted among themselves."""
    at = lambda n: F.date_add(base, n.cast("int"))
    step = lambda n: _days(n, radix, tweak, key)
    return at(F.aggregate(F.sequence(F.lit(1), F.lit(200)), step(F.datediff(day, base).cast("long")),
                          lambda n, _: F.when(allowed(at(n)), n).otherwise(step(n))))


def _date(span: Column, key: str) -> Column:
    """Days of 1900 to 2099 are permuted among themselves, others within their 400 years of
    the calendar (27 x 5411 days) without those. A date with slashes has its day first, or
    its month if only that reads as a date; the second kind is permuted apart."""
    first = F.to_date(F.lit(FIRST_DAY))
    recent = lambda d: F.year(d).between(1900, 2099)

    def moved(form: str, allowed=lambda d: F.lit(True)) -> Column:
        day = F.try_to_date(span, form)
        era = F.floor((F.year(day) - 1) / 400)
        start = F.make_date((era * 400 + 1).cast("int"), F.lit(1), F.lit(1))
        tweak = F.concat(F.lit("date"), F.lit("!" if form.startswith("MM") else ""))
        new = F.when(recent(day), _walk(day, first, DAYS, tweak, key, allowed)).otherwise(_walk(
            day, start, (27, 5411), F.concat(tweak, era.cast("string")), key, lambda d: ~recent(d) & allowed(d)))
        return F.when(day.isNotNull() & (F.year(day) > 0), F.date_format(new, form))

    return F.coalesce(
        F.when(span.rlike("^[0-9]{4}-"), moved("yyyy-MM-dd")).when(span.rlike("^[0-9]{2}[.]"), moved("dd.MM.yyyy"))
        .otherwise(F.coalesce(moved("dd/MM/yyyy"), moved("MM/dd/yyyy", lambda d: F.dayofmonth(d) > 12))), span)


def pseudonym(span: Column, key: str) -> Column:
    """A found value's pseudonym; the value itself when its check fails."""
    is_ = lambda kind: span.rlike("^" + PATTERNS[kind].replace(_EDGE, "").replace(_END, "") + "$")
    n = F.char_length(span)
    domain_end = n - F.instr(F.reverse(span), ".")
    code_end = F.char_length(F.regexp_extract(span, r"^(\+[0-9]{1,3}(?=[ .(-]))?", 1))
    letters = lambda first, last, kind: _letters(span, first, last, F.lit(kind), key)
    return (F.when(span.rlike('^((?i:password|passwd|secret)=|(?i:token) = ")'), letters(F.instr(span, "="), n, "secret"))
            .when(F.instr(span, "@") > 0, letters(F.lit(0), domain_end, "email"))
            .when(span.rlike("^AKIA[0-9A-Z]{16}$"), letters(F.lit(4), n, "access_key"))
            .when(is_("iban"), _iban(span, key))
            .when(is_("date"), _date(span, key))
            .when(span.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), letters(F.lit(0), n, "ssn"))
            .when(span.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), _ip(span, key))
            .when(span.rlike(r"^[+(]|^[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$"), letters(code_end, n, "phone"))
            .otherwise(_card(span, key)))


def pseudonymise(docs: DataFrame, key: str = "saldoflow", text: str = "text") -> DataFrame:
    """``docs`` with the private values of ``text`` replaced and ``n_replaced`` of them counted.

    A null text stays null with a count of 0. Values that fail their check stay. A
    column named n_replaced is replaced, all others stay, whatever their names (helper
    columns take names the table does not have; the text column may hold a dot). Rows are independent, so ties,
    repeated rows and empty tables need nothing special.
    """
    whole = "|".join(f"(?:{p})" for p in PATTERNS.values())
    given = F.col(f"`{text}`")
    found_, new_ = fresh("_found", docs.columns), fresh("_new", docs.columns)
    found = F.regexp_extract_all(F.coalesce(given, F.lit("")), F.lit(whole), 0)
    new = F.transform(found_, lambda s: pseudonym(s, key))
    rows = once(docs.drop("n_replaced"), **{found_: found})
    rows = once(rows, **{new_: F.when(F.size(found_) > 0, new)})
    between = F.transform(F.split(given, whole, -1), lambda p, i: F.concat(
        p, F.coalesce(F.get(new_, i), F.lit(""))))
    changed = F.size(F.filter(F.arrays_zip(F.col(found_).alias("f"), F.col(new_).alias("n")),
                              lambda z: z["f"] != z["n"]))
    out = {text: F.when(F.col(new_).isNotNull(), F.array_join(between, "")).otherwise(given),
           "n_replaced": F.when(F.col(new_).isNotNull(), changed).otherwise(0).cast("long")}
    return rows.withColumns(out).select(*[F.col(f"`{c}`") for c in docs.columns if c != "n_replaced"], "n_replaced")
