"""Scalar rules as SQL text, for use inside array expressions.

Journal rows are built by lambdas over a document's arrays. Spark parses one
text much faster than Python assembles the same tree node by node.
"""

from __future__ import annotations

from saldoflow import constants as K

MONEY = "DECIMAL(30,9)"     # a money figure of a document
RATE = "DECIMAL(20,8)"      # an exchange rate of a document
TOTAL = "DECIMAL(38,9)"


def lit(value) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def decimal_lenient(text: str, to: str = MONEY) -> str:
    """Exact decimal of a text; null, empty or not a number gives 0."""
    return f"coalesce(try_cast({text} AS {to}), CAST(0 AS {to}))"


#: Money of this size and more does not fit.
LARGEST = "1e21D"


def too_large(text: str) -> str:
    """True for the text of a number that does not fit a money figure.

    Such a text has more than 20 characters (21 nines round up) or an exponent; others are not read as numbers.
    """
    marks = " OR ".join(f"contains({text}, '{mark}')" for mark in "eEpP")
    return (f"({text} IS NOT NULL AND (octet_length({text}) > 20 OR {marks}) "
            f"AND coalesce(abs(try_cast({text} AS DOUBLE)) >= {LARGEST} "
            f"AND abs(try_cast({text} AS DOUBLE)) < double('infinity'), false))")


def first_nonblank(*texts: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({t}, '')" for t in texts) + ")"


def first_nonzero(*values: str) -> str:
    """The first value that is neither null nor zero, else 0."""
    return "coalesce(" + ", ".join(f"nullif({v}, 0)" for v in values) + f", CAST(0 AS {MONEY}))"


def variant_text(variant: str, path: str = "$") -> str:
    return f"try_variant_get({variant}, '{path}', 'string')"


def object_given(variant: str) -> str:
    """True when a variant holds something other than an empty value."""
    return f"coalesce({variant_text(variant)} NOT IN ('', '{{}}', '[]', '0', 'false'), false)"


def nested_get_default(variant: str, path: str, default: str) -> str:
    """Text at a path; null at any step gives the default."""
    return f"coalesce({variant_text(variant, path)}, {default})"


def rate_or(variant: str, default: str) -> str:
    """Exchange rate: an absent key takes the default, an explicit null is 0."""
    return (f"IF({variant} IS NULL, CAST({default} AS {RATE}), "
            f"{decimal_lenient(variant_text(variant), RATE)})")


def signed_amount(code: str, debit: str, credit: str) -> str:
    """Debit less credit, turned round for accounts of the credit groups."""
    return (f"CAST(IF(coalesce(substring({code}, 1, 1) IN {in_list(K.CREDIT_GROUPS)}, false), "
            f"{credit} - {debit}, {debit} - {credit}) AS {MONEY})")


def _by_key(key: str, pairs: dict) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in pairs.items())
    return f"CASE {key} {whens} END"


def tax_account(code: str, name: str, side: str) -> tuple[str, str]:
    """Account code and name a tax posts to, by tax code and else by tax name."""
    at = 0 if side == "purchase" else 2
    codes = {k: v[at] for k, v in K.TAX_ACCOUNTS.items()}
    names = {k: v[at + 1] for k, v in K.TAX_ACCOUNTS.items()}
    account = f"coalesce({_by_key(code, codes)}, {_by_key(name, codes)})"
    label = (f"coalesce({_by_key(code, names)}, {_by_key(name, names)}, "
             f"nullif({name}, ''), nullif({code}, ''))")
    return account, label


def discount_account(side: str) -> tuple[str, str]:
    code, name = K.DISCOUNT_ACCOUNTS[side]
    return lit(code), lit(name)


def fx_settlement(currency: str, rate: str) -> str:
    """True when cash settles in a foreign currency or at a rate other than 1."""
    return (f"(upper(coalesce({currency}, '')) NOT IN ('', {lit(K.BASE_CURRENCY)}) "
            f"OR {decimal_lenient(rate, RATE)} NOT IN (0, 1))")


def forex_account(is_debit: str) -> tuple[str, str]:
    """A debit is a realised loss, a credit a realised gain."""
    loss, gain = K.FOREX_LOSS, K.FOREX_GAIN
    return (f"IF({is_debit}, {lit(loss[0])}, {lit(gain[0])})",
            f"IF({is_debit}, {lit(loss[1])}, {lit(gain[1])})")


def withheld_amount(net: str, payable: str, payment: str) -> str:
    """Tax withheld from one payment line: a payment that is not the payable."""
    return (f"IF({net} <> 0 AND {payment} <> 0 AND {payment} <> {payable}, {payment}, "
            f"CAST(0 AS {MONEY}))")


def settled_amount(net: str, discount: str, payable: str, payment: str) -> str:
    """Claim settled by one payment line.

    Without a net amount the line settles its gross. With one it settles net,
    discount and withheld tax.
    """
    whole = first_nonzero(payable, payment)
    parts = f"{net} + {discount} + {withheld_amount(net, payable, payment)}"
    return f"CAST(IF({net} = 0, {whole}, {parts}) AS {MONEY})"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"
