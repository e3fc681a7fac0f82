"""Feeds and books derived from the given tables, by Spark, over whole tables.

An order becomes a document of each kind. Its lines are consolidated by line
number first (combined before the shuffle), so a document holds at most one
entry per line number however many rows an order has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from saldoflow.functions import scalars as S


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def order_lines(spark, sf) -> DataFrame:
    """(k, n) -> gross, net, tax, and the smallest supplier and part."""
    li = table(spark, sf, "lineitem")
    ext = money("l_extendedprice")
    net = F.round(ext * (1 - F.col("l_discount").cast("decimal(4,2)")), 2)
    tax = F.round(ext * F.col("l_tax").cast("decimal(4,2)"), 2)
    return (li.groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"))
            .agg(F.sum(ext).cast("decimal(20,2)").alias("gross"),
                 F.sum(net).cast("decimal(20,2)").alias("net"),
                 F.sum(tax).cast("decimal(20,2)").alias("tax"),
                 F.min("l_suppkey").alias("supp"), F.min("l_partkey").alias("part")))


def order_heads(spark, sf) -> DataFrame:
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("st"),
                    F.to_date("o_orderdate").alias("d"), F.col("c_name").alias("cname"),
                    F.col("n_nationkey").alias("nk"), F.col("n_name").alias("nname"),
                    F.col("o_orderpriority").alias("prio")))


#: Orders that are worked on in one piece of a large feed.
ORDERS_A_PIECE = 50_000


def pieces(spark, sf) -> int:
    """Pieces of a feed made of the orders: one per core at least, more the larger it is."""
    return max(spark.sparkContext.defaultParallelism, table(spark, sf, "orders").count() // ORDERS_A_PIECE)


def orders_with_lines(spark, sf) -> DataFrame:
    """One row per order: head fields, its lines in order, totals.

    Heads and lines are joined by a shuffle whatever their size: with the lines broadcast, the
    bodies would be built and parsed in as few tasks as the orders have files. The shuffles
    have a number of pieces of their own, as the rows are small but the work on them is not.
    """
    n = pieces(spark, sf)
    signed = F.when(F.col("n") == 6, -F.col("tax")).otherwise(F.col("tax"))
    lines = (order_lines(spark, sf).withColumn("stax", signed).repartition(n, "k").groupBy("k")
             .agg(F.array_sort(F.collect_list(F.struct("n", "gross", "net", "tax", "stax"))).alias("ls"),
                  F.sum("net").cast("decimal(22,2)").alias("nsum"),
                  F.sum("stax").cast("decimal(22,2)").alias("tsum"),
                  F.sum(F.when(F.col("n") == 7, F.col("gross")).otherwise(F.col("net")))
                  .cast("decimal(22,2)").alias("paid"),
                  F.sum(F.when(F.col("n") == 6, 0).otherwise(F.col("net")))
                  .cast("decimal(22,2)").alias("funded"),
                  F.min("supp").alias("supp")))
    return order_heads(spark, sf).repartition(n, "k").join(lines.hint("merge"), "k")


PREFIX = {"manual_journal": "MJ", "sales_invoice": "SI", "receivable_payment": "RP",
          "sales_return": "SR", "purchase_invoice": "PI", "payable_payment": "PP",
          "purchase_return": "PR", "cash_in": "CI", "cash_out": "CO"}
END_POINT = {"manual_journal": "manual_journals", "sales_invoice": "sales_invoices",
             "receivable_payment": "receivable_payments", "sales_return": "sales_returns",
             "purchase_invoice": "purchases_invoices", "payable_payment": "payable_payments",
             "purchase_return": "purchases_returns", "cash_in": "cash_ins", "cash_out": "cash_outs"}


def _obj(**fields) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()])


def _line_no(x) -> Column:
    return x.n.cast("string")


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _line_department(x) -> Column:
    none = F.lit(None).cast("string")
    full = _obj(code=_text("D", _line_no(x)), name=_text("Dept ", _line_no(x)))
    return (F.when(x.n % 2 == 0, full).when(x.n == 3, _obj(code=none, name=none))
            .when(x.n == 5, _obj(code=none, name=F.lit("Named only"))))


def _taxes(x) -> Column:
    none = F.lit(None).cast("string")

    def tax(i, code, name):
        return F.array(_obj(id=i, code=code, name=name, amount=x.stax))
    return (F.when(x.n <= 4, tax("T1", F.lit("PPN 11%"), F.lit("Pajak 11")))
            .when(x.n == 5, tax("T2", none, F.lit("PPN 2 1,1%")))
            .when(x.n == 6, tax("T3", F.lit("PPh 23-2"), F.lit("PPh")))
            .otherwise(tax("T4", F.lit("ZZ"), none)))


def _trade_lines(group: str, label: str) -> Column:
    return F.transform("ls", lambda x: _obj(
        id=_text("L", _line_no(x)),
        description=F.when(x.n % 3 == 0, "").otherwise(_text("Line ", _line_no(x))),
        subtotal_before_discount=x.gross, subtotal_after_discount=x.net,
        account=_obj(code=_text(group, _line_no(x), "00"), name=_text(label, _line_no(x))),
        department=_line_department(x), taxes=_taxes(x)))


def _claim_lines(module: str) -> Column:
    none = F.lit(None).cast("string")

    def one(x):
        key = _text(F.col("k").cast("string"), "-", _line_no(x))
        ref = _obj(id=_text("SI-", key), number=_text("SI/", key), date=F.col("d").cast("string"),
                   account=_obj(code="112111", name="Accounts Receivable") if module == "receivable_payment"
                   else _obj(code="211311", name="Accounts Payable"))
        base = dict(id=_text("L", _line_no(x)), amount=F.when(x.n != 7, x.net),
                    payment=F.when(x.n == 2, _obj(amount=F.lit(3).cast("decimal(20,2)")))
                    .when(x.n == 4, _obj(amount=x.gross)),
                    discount=F.when(x.n == 3, _obj(amount=F.lit(1.5).cast("decimal(4,2)"))),
                    department=_line_department(x))
        if module == "receivable_payment":
            return _obj(**base, invoice=ref, payable=_obj(amount=x.gross))
        payable = _obj(amount=x.gross, account=F.when(
            x.n % 2 == 0, _obj(code="211211", name="Trade Payables")))
        kinds = {n: F.when(x.n % 4 == i, ref) for i, n in
                 enumerate(("invoice", "purchase_invoice", "purchase", "bill"))}
        return _obj(**base, payable=payable, **kinds)
    return F.transform("ls", one)


def _rate() -> Column:
    """Document rate by order: absent and 1 are 1, null is 0, text is a number."""
    k4 = F.col("k") % 4
    return F.when(k4 == 1, F.lit(0)).when(k4 == 3, F.lit(1.5)).otherwise(F.lit(1)).cast("decimal(4,2)")


def _rate_fragment() -> Column:
    k4 = F.col("k") % 4
    return (F.when(k4 == 0, "").when(k4 == 1, '"exchange_rate":null,')
            .when(k4 == 2, '"exchange_rate":1,').otherwise('"exchange_rate":"1.5",'))


def _payment(amount: Column, code: str, name: str) -> Column:
    return F.array(_obj(id="P1", amount=amount, account=_obj(code=code, name=name)))


def _settlement_extra() -> dict:
    k = F.col("k")
    other = (F.when(k % 8 == 0, F.array(_obj(id="O1", amount=F.lit(-2).cast("decimal(6,2)"),
                                             account=_obj(code="6924", name="Bank Administrative"))))
             .when(k % 8 == 4, F.array(_obj(id="O1", amount=F.lit(4).cast("decimal(6,2)"),
                                            account=_obj(code="6101", name="Freight")))))
    moved = F.when(k % 8 == 0, -2).when(k % 8 == 4, 4).otherwise(0)
    gap = F.when(k % 31 == 0, 60000).otherwise(k % 6)
    return {"other": other, "moved": moved, "gap": gap}


def _cash(amount: Column) -> Column:
    k = F.col("k")
    return _obj(amount=amount, currency=F.when(F.col("nk") % 5 == 0, _obj(code="USD")),
                account=F.when(k % 7 != 0, _obj(id="C1", code="111211", name="Bank")))


def document_data(module: str) -> dict:
    """Fields of a document's ``data`` beyond the common ones."""
    k, r = F.col("k"), _rate()
    total = F.col("nsum") + F.col("tsum")
    memo = _obj(id=_text("SI-", k.cast("string")), number=_text("SI/", k.cast("string")),
                date=F.col("d").cast("string"))
    named = k % 29 != 0
    customer = F.when(named, _obj(name=F.col("cname")))
    supplier = _text("Supplier ", F.col("supp").cast("string"))
    vendor = {"vendor": _obj(name=F.when(k % 2 == 0, supplier).otherwise("")),
              "supplier": F.when(k % 2 == 1, _obj(name=supplier))}
    vendor = {n: F.when(named, v) for n, v in vendor.items()}
    ar, ap = ("112111", "Accounts Receivable"), ("211211", "Accounts Payable")
    if module == "sales_invoice":
        off = F.when(k % 17 == 0, 5).otherwise(0)
        return {"customer": customer, "line_items": _trade_lines("41", "Revenue "),
                "payments": _payment(total + off, *ar)}
    if module == "sales_return":
        return {"customer": customer, "line_items": _trade_lines("41", "Revenue "),
                "payments": _payment(total * r, *ar), "parent_memo": memo}
    if module == "purchase_invoice":
        freight = F.lit(12.5).cast("decimal(6,2)")
        return {**vendor, "line_items": _trade_lines("51", "Purchase "),
                "payments": _payment(total * r + freight, *ap),
                "others": F.array(_obj(id="O1", amount=freight,
                                       account=_obj(code="6101", name="Freight")))}
    if module == "purchase_return":
        return {**vendor, "line_items": _trade_lines("51", "Purchase "),
                "payments": _payment(total, *ap), "parent_memo": memo}
    if module in ("receivable_payment", "payable_payment"):
        e = _settlement_extra()
        cash = F.col("paid") + e["moved"] - e["gap"]
        who = {"customer": customer} if module == "receivable_payment" else vendor
        return {**who, "line_items": _claim_lines(module), "others": e["other"], "cash": _cash(cash)}
    if module in ("cash_in", "cash_out"):
        lines = F.transform("ls", lambda x: _obj(
            id=_text("L", _line_no(x)), amount=F.when(x.n != 6, x.net),
            note=F.when(x.n % 3 != 0, _text("Note ", _line_no(x))),
            account=_obj(code=_text("61", _line_no(x), "00"), name=_text("Fund ", _line_no(x))),
            department=_line_department(x)))
        return {"contact": customer, "line_items": lines, "cash": _cash(F.col("funded"))}
    off = F.when(k % 37 == 0, F.lit(2.0)).when(k % 23 == 0, F.lit(0.5)).otherwise(F.lit(0.0))
    none = F.lit(None).cast("string")
    lines = F.transform("ls", lambda x: _obj(
        id=_text("L", _line_no(x)), debit=x.net, credit=F.lit(0).cast("decimal(22,2)"),
        account=_obj(code=_text("71", _line_no(x), "00"),
                     name=F.when(x.n != 5, _text("Expense ", _line_no(x)))),
        department=_line_department(x)))
    close = F.array(_obj(id="LB", debit=F.lit(0).cast("decimal(20,2)"),
                         credit=(F.col("nsum") + off.cast("decimal(4,2)")).cast("decimal(22,2)"),
                         account=_obj(code="211000", name="Accruals"),
                         department=_obj(code=none, name=none)))
    return {"line_items": F.concat(lines.cast(_MANUAL), close.cast(_MANUAL))}


_MANUAL = ("array<struct<id:string,debit:decimal(22,2),credit:decimal(22,2),"
           "account:struct<code:string,name:string>,department:struct<code:string,name:string>>>")


def bodies(orders: DataFrame, module: str) -> DataFrame:
    """Orders with ``body``, the callback of each as a document of one kind."""
    k = F.col("k")
    prefix = PREFIX[module]
    common = {
        "id": _text(f"{prefix}-", k.cast("string")), "number": _text(f"{prefix}/", k.cast("string")),
        "date": F.col("d").cast("string"), "description": _text("Order ", k.cast("string")),
        "status": F.when(F.col("st") == "P", "draft").otherwise("approved"),
        "department": _obj(code=_text("N", F.col("nk").cast("string")), name=F.col("nname")),
        "project": _obj(name=F.col("prio")),
        "currency": F.when(F.col("nk") % 5 == 0, _obj(code="USD")),
        "created": _obj(time=_text(F.col("d").cast("string"), "T05:06:07+00:00"),
                        user=_obj(name=_text("clerk-", (k % 10).cast("string")),
                                  email=_text("clerk", (k % 10).cast("string"), "@example.org"))),
    }
    orders = S.once(orders, data_json=F.to_json(_obj(**common, **document_data(module))))
    body = F.concat(F.lit('{"end_point":"' + END_POINT[module] + '","method":"POST","data":{'), _rate_fragment(), F.expr("substring(data_json, 2)"), F.lit("}"))
    orders = S.once(orders, plain_body=body)
    body = F.col("plain_body")
    encoded = F.concat(F.lit('"'), F.replace(F.replace(body, F.lit("\\"), F.lit("\\\\")),
                                             F.lit('"'), F.lit('\\"')), F.lit('"'))
    return S.once(orders, body=F.when(k % 3 == 0, encoded).otherwise(body))


def callbacks(spark, sf, module: str) -> DataFrame:
    """One callback per order for one kind."""
    orders = bodies(orders_with_lines(spark, sf), module)
    return orders.select(F.col("k").alias("callback_id"), F.lit("POST").alias("method"), "body",
                         F.col("d").cast("timestamp_ntz").alias("created_at"),
                         F.lit(None).cast("timestamp_ntz").alias("deleted_at"))
