"""Columns the sales plan needs from the orders. Declaring them saves the extra pass over the JSON
that inference needs. Quantities and prices keep the type that each value has in the file, as some
files hold numbers and some text; the reader makes text of them that the cleaners judge alike."""

ITEMS = "array<struct<qty: variant, sku: string, unit_price: variant>>"
ORDERS = (
    f"channel string, created_at string, customer_id string, items {ITEMS}, "
    "order_id string, payment_status string"
)
# the same columns as they leave the reader
ORDERS_TEXT = ORDERS.replace("variant", "string")
