"""Purchase-order fixture documents: one of two lines (one just over the weight limit), one of one line."""


def _order(number, who, items, subtotal, taxes, total, due):
    name, email, phone = who
    fields = ("sku", "description", "weight_quantity", "price")
    return {
        "contact_info": {"name": name, "email": email, "phone": phone},
        "po_number": number,
        "items": [dict(zip(fields, item, strict=True)) for item in items],
        "subtotal": subtotal,
        "taxes": taxes,
        "total": total,
        "payment_due_date": due,
    }


MIRA = ("Mira Okafor", "mira@okafor.test", "020-7001")
TOMAS = ("Tomas Lind", "tomas@lind.test", "020-7002")

PO_DOCS = [
    _order("A-71", MIRA, [("bolt-m8", "hex bolt", 7500, 12.25), ("nut-m8", "hex nut", 5001, 3.4)], 15.65, 1.57, 17.22, "2027-03-08"),
    _order("A-72", TOMAS, [("gear-40", "spur gear", 9100, 212.4)], 212.4, 21.24, 233.64, "2027-02-19"),
]
