"""Names, lists and numbers that results must share with existing data."""

# Text fields of the source models: unset is the empty string.
STRING_FIELDS = ("state", "origin", "name", "usage", "default_code", "type")

# Quantity and money fields: unset is 0.0.
QUANTITY_FIELDS = (
    "quantity", "qty_done", "product_uom_qty", "quantity_done", "value", "standard_price", "list_price")

# Date fields beside those ending in "_date".
DATE_FIELDS = (
    "date", "date_done", "date_deadline", "write_date", "create_date", "date_expected", "date_order",
    "date_planned")

# Field lists, required fields and base domains of the source models.
MODEL_FIELDS = {
    "stock.move.line": (
        "id", "company_id", "product_id", "quantity", "location_id", "location_dest_id", "state", "date",
        "write_date", "create_date"),
    "stock.quant": (
        "id", "company_id", "product_id", "location_id", "quantity", "reserved_quantity", "write_date",
        "create_date"),
    "stock.move": (
        "id", "company_id", "product_id", "product_uom_qty", "quantity", "location_id", "location_dest_id",
        "state", "date_deadline", "date", "origin", "write_date", "create_date"),
    "purchase.order": (
        "id", "company_id", "partner_id", "name", "date_order", "date_planned", "state", "write_date",
        "create_date"),
    "product.product": ("id", "company_id", "product_tmpl_id", "default_code", "active", "write_date", "create_date"),
    "product.template": (
        "id", "company_id", "name", "standard_price", "list_price", "type", "write_date", "create_date"),
    "stock.valuation.layer": (
        "id", "company_id", "product_id", "quantity", "value", "stock_move_id", "write_date", "create_date"),
    "stock.location": ("id", "company_id", "name", "usage", "write_date", "create_date"),
    "res.company": ("id", "name", "write_date", "create_date"),
    "res.partner": ("id", "company_id", "name", "supplier_rank", "write_date", "create_date"),
}
MODEL_REQUIRED = {
    "stock.move.line": ("id", "product_id", "date_done", "write_date"),
    "stock.quant": ("id", "product_id", "write_date"),
    "stock.move": ("id", "product_id", "date_done", "write_date"),
    "purchase.order": ("id", "partner_id", "date_order", "write_date"),
    "product.product": ("id", "product_tmpl_id", "write_date"),
    "product.template": ("id", "name", "write_date"),
    "stock.valuation.layer": ("id", "product_id", "create_date", "write_date"),
    "stock.location": ("id", "name", "write_date"),
    "res.company": ("id", "name", "write_date"),
    "res.partner": ("id", "name", "write_date"),
}
MODEL_DOMAINS = {
    "stock.move.line": (("state", "=", "done"),),
    "stock.move": (("state", "=", "done"),),
    "res.partner": (("supplier_rank", ">", 0),),
}
# Models whose records belong to no company.
SHARED_MODELS = ("res.company",)

# Source field → raw table column.
FIELD_ALIASES = {
    "stock.move.line": {"quantity": "qty_done", "date": "date_done"},
    "stock.move": {"quantity": "quantity_done", "date": "date_done", "date_deadline": "date_expected"},
}

EPOCH = "1970-01-01 00:00:00"

# A template without a cost is taken at this share of its list price.
COST_SHARE_OF_LIST = 0.7

# Price ladders: sale = list, else cost × 1.35, else 10; purchase = cost, else list × 0.8, else 10.
SALE_MARKUP = 1.35
PURCHASE_SHARE = 0.8
DEFAULT_PRICE = 10.0

# Forecast interval around the forecast quantity.
LOWER_CI = 0.85
UPPER_CI = 1.15

# Days added to vendor lead times while a supplier delay is active.
SUPPLIER_DELAY_DAYS = 15

LOCATION_KINDS = ("GOOD", "TRANSIT", "DAMAGED")

DOCUMENT_PREFIX = "SEED17"

# Season starts (month, day) per country.
COUNTRY_SEASONS = {
    "rw": ((2, 10), (9, 10)),
    "ke": ((3, 15), (10, 10)),
    "ug": ((3, 15), (9, 10)),
}

# Category → lag days, amplitude, ramp days, peak days, decay days.
CATEGORY_CURVES = {
    "Seeds": (0, 2.2, 14, 28, 14),
    "Fertilizer": (18, 1.6, 14, 28, 14),
    "Pesticides": (35, 1.2, 10, 28, 10),
    "Tools": (7, 0.35, 10, 35, 10),
    "Spare Parts": (7, 0.30, 10, 35, 10),
    "Packaging": (75, 0.9, 14, 28, 14),
}
PULSE_LIMIT = 1.25

# Movement kind → factor from Monday to Sunday.
WEEKDAY_FACTORS = {
    "outbound": (1.0, 1.0, 1.0, 1.0, 1.0, 0.65, 0.15),
    "inbound": (1.0, 1.0, 1.0, 1.0, 1.0, 0.25, 0.25),
    "internal": (0.9, 1.2, 1.2, 1.2, 0.9, 0.9, 0.4),
    "damage": (1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
}

BASE_UNIT_LABELS = {"rw": "Sector", "ke": "Sub-county", "ug": "County"}

# Name of the property that holds a cost price.
PRICE_PROPERTY = "standard_price"
