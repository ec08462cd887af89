"""Row status, row flags and the conditional aggregates built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline.functions.money import or_zero


def _holds(condition: Column) -> Column:
    """A comparison with a null counts as not holding."""
    return F.coalesce(condition, F.lit(False))


def well_formed_invoice(invoice: Column) -> Column:
    return _holds(invoice.rlike(C.INVOICE_PATTERN))


def product_code(stock_code: Column) -> Column:
    return _holds(stock_code.rlike(C.PRODUCT_CODE_PATTERN))


def is_cancelled(invoice: Column) -> Column:
    return _holds(invoice.startswith("C"))


def transaction_status(invoice: Column, quantity: Column, price: Column, at: Column) -> Column:
    """One status per row; the first rule that holds decides."""
    irregular = (
        _holds(price <= 0) | _holds(quantity == 0) | at.isNull() | ~well_formed_invoice(invoice)
    )
    return (
        F.when(is_cancelled(invoice), C.CANCELLATION)
        .when(_holds(quantity < 0), C.POTENTIAL_RETURN)
        .when(irregular, C.NON_STANDARD)
        .otherwise(C.VALID_SALE)
    )


def row_flags() -> dict[str, Column]:
    """Flags that depend on the row alone (the duplicate flag needs its whole group)."""
    return {
        "flag_missing_customer_id": F.col("customer_id").isNull(),
        "flag_missing_description": F.col("description").isNull(),
        "flag_non_positive_price": _holds(F.col("unit_price") <= 0),
        "flag_zero_quantity": _holds(F.col("quantity") == 0),
        "flag_non_standard_invoice_format": ~well_formed_invoice(F.col("invoice_no")),
        "flag_non_standard_stock_code": ~product_code(F.col("stock_code")),
    }


def has_status(status: str) -> Column:
    return F.col("transaction_status") == status


def sold() -> Column:
    return has_status(C.VALID_SALE)


def cancelled() -> Column:
    return has_status(C.CANCELLATION)


def status_order() -> Column:
    """Position of the status in its declared order, for sorting."""
    return F.array_position(F.array(*[F.lit(s) for s in C.STATUSES]), F.col("transaction_status"))


def revenue_of(status: str) -> Column:
    """Revenue of one status; null when no row has it."""
    return F.sum(F.when(has_status(status), F.col("line_revenue")))


def gross_revenue() -> Column:
    return revenue_of(C.VALID_SALE)


def cancellation_value() -> Column:
    return revenue_of(C.CANCELLATION)


def net_revenue() -> Column:
    return or_zero(gross_revenue()) + or_zero(cancellation_value())


def orders() -> Column:
    """Distinct invoices with a sale. Written without FILTER so that it stays a single
    distinct group, which Spark aggregates in two skew-safe steps without expanding rows."""
    return F.count_distinct(F.when(sold(), F.col("invoice_no")))


def units() -> Column:
    return F.sum(F.when(sold(), F.col("quantity")))


def rows_with(status: str) -> Column:
    return F.count_if(has_status(status))
