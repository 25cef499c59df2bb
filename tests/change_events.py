"""Events and row images as the change feed has them, for tests."""


def image(order, customer, product, quantity, price):
    return {
        "order_id": order,
        "customer_id": customer,
        "product_id": product,
        "quantity": quantity,
        "price": price,
    }


def event(op, before, after, ts, **source):
    return {"before": before, "after": after, "source": source or None, "op": op, "ts_ms": ts, "transaction": None}
