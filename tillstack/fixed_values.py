"""Fixed values.

Everything in this module is a value the pipeline's results depend on:
extraction vocabularies, dimension members, labels written into output
columns, sentinel keys and accepted-value lists.  They are stated here once,
plainly and in their natural order, so the rest of the package only refers
to them by name.
"""

# --- FIXED VALUES: extraction vocabularies (matched case-insensitively) ----
SIZE_WORDS = ["Solo", "Duo", "Medio", "Familia"]
VARIATION_WORDS = ["Hot", "Cold"]
FLAVOR_LINE_WORDS = ["Fries", "Lemonade"]
FLAVOR_WORDS = ["Cheese", "BBQ", "Sour Cream", "Plain", "Mango"]
SUGAR_WORDS = ["Sugar 20%", "Sugar 50%", "Sugar 75%", "Sugar 100%"]
SPICE_WORDS = ["Mild (1/4)", "Regular (2/4)", "Spicy (3/4)"]
PASTRY_GROUPS = ["Croissant", "Croffle", "Cookies", "Cookie"]
PASTRY_FLAVORS = [
    "Chip and Chunk Walnut", "Nutella Pecan Cookie", "Red Velvet Cookie",
    "Smores Cookie", "Almond Nutella", "Biscoff Cookie", "Strawberry Cream",
    "Spam and Egg", "Chip and Chunk", "Biscoff", "Caramel", "Chocolate",
    "Matcha", "Oreo", "Plain", "Smores", "Red Velvet", "Dubai",
]
PASTRY_GROUP_RENAMES = {"Cookie": "Cookies"}
PASTRY_FLAVOR_SUFFIX = "Cookie"
QUANTITY_MARK = "x"  # before a quantity: "x3", "x 3"; case-sensitive

# --- FIXED VALUES: labels ----------------------------------------------------
UNCATEGORIZED = "Uncategorized"
PAYMENT_FREE = "Free/Voucher/Discounted"
PAYMENT_CASH = "Cash"
PAYMENT_GCASH = "Gcash"
PAYMENT_CARD = "Credit / Debit"
CASH_FREE_TEXTS = ["0.00", "0"]
NOT_PAID_TEXT = "-"
MISSING_TEXT = "nan"
MISSING_CASH_TEXT = "0"
REASON_NULL_ITEM = "Null item name"
REASON_NULL_AMOUNT = "Null order amount"
REASON_NULL_ORDER = "Null order ID"
REASON_BAD_QUANTITY = "Invalid quantity"
REASON_UNCAT_SUB = "Uncategorized sub_category"
REASON_UNCAT_CATEGORY = "Uncategorized category"
QUARANTINE_TIMEZONE = "Asia/Manila"
BLANK_MATCH = "MATCH_BLANK"
NO_FLAVOR = "No Flavor"
NO_SUGAR = "No Sugar Level"
NO_SPICE = "No Spice Level"

# --- FIXED VALUES: sentinel keys ----------------------------------------------
UNKNOWN_PRODUCT_KEY = -1
UNKNOWN_MEMBER_KEY = 0

# --- FIXED VALUES: literal dimension members (key, name[, number]) ---------
DIM_FLAVOR_ROWS = [
    (0, "No Flavor"), (1, "Cheese"), (2, "BBQ"), (3, "Sour Cream"),
    (4, "Plain"), (5, "Mango"),
]
DIM_SUGAR_ROWS = [
    (0, "No Sugar Level", None), (1, "No Sugar", 0), (2, "Sugar 20%", 20),
    (3, "Sugar 50%", 50), (4, "Sugar 75%", 75), (5, "Sugar 100%", 100),
]
DIM_SPICE_ROWS = [
    (0, "No Spice Level", None), (1, "Mild (1/4)", 1), (2, "Regular (2/4)", 2),
    (3, "Spicy (3/4)", 3), (4, "Extra Spicy (4/4)", 4),
]
DIM_PAYMENT_ROWS = [
    (0, "No Payment Type"), (1, "Free/Voucher/Discounted"),
    (2, "Credit / Debit"), (3, "Cash"), (4, "Gcash"),
]
DIM_ORDER_ROWS = [(0, "No Order Type"), (1, "Dine-in"), (2, "Takeaway")]

# --- FIXED VALUES: accepted-value lists used by the checks ------------------
ACCEPTED_CATEGORIES = ["Beverages", "Food", "Desserts", "Add-Ons", "Others"]
ACCEPTED_WEEKDAYS = [
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
]
ACCEPTED_FLAVORS = ["Mango", "No Flavor", "BBQ", "Plain", "Bbq", "Cheese", "Sour Cream"]
ACCEPTED_SPICE = [
    "No Spice Level", "Mild (1/4)", "Regular (2/4)", "Spicy (3/4)", "Extra Spicy (4/4)",
]

# --- FIXED VALUES: keys ------------------------------------------------------
DEDUP_KEYS = ["order_id", "items", "payment_time"]
MERGE_KEYS = ["order_id", "items", "flavor", "size", "variation", "payment_time"]
FACT_GRAIN = ["order_id", "product_key", "flavor_key", "sugar_key", "spice_key"]

# --- FIXED VALUES: columns -----------------------------------------------------
RAW_REPORT_COLUMNS = [
    "order_id", "products", "product_amount", "received_amount",
    "payment_time", "cash", "gcash", "type/channel",
]
KEEP_COLUMNS = [
    "order_id", "clean_item", "sub_category", "category", "flavor", "variation",
    "size", "quantity", "spice_level", "sugar_level", "product_amount",
    "received_amount", "payment_time", "order_type", "payment_type", "type/channel",
]
STAGING_COLUMNS = [
    ("order_id", "string"), ("items", "string"), ("sub_category", "string"), ("category", "string"),
    ("flavor", "string"), ("variation", "string"), ("size", "string"), ("quantity", "double"),
    ("spice_level", "string"), ("sugar_level", "string"), ("total_order_amount", "double"),
    ("received_amount", "double"), ("payment_time", "string"), ("payment_type", "string"),
    ("order_type", "string"), ("source_file", "string"),
]
FLAG_COLUMNS = [("is_reprocessed", "boolean")]
QUARANTINE_COLUMNS = [("quarantine_reason", "string"), ("quarantine_timestamp", "date")]
PRODUCTS_SEED_COLUMNS = [
    ("items", "string"), ("sub_category", "string"), ("category", "string"), ("variation", "string"), ("size", "string"),
]
HOLIDAYS_SEED_COLUMNS = [("holiday_date", "date"), ("holiday_name", "string"), ("holiday_type", "string")]
FACT_COLUMNS = [
    ("payment_time", "timestamp_ntz"), ("date_key", "int"), ("product_key", "int"), ("flavor_key", "int"),
    ("sugar_key", "int"), ("spice_key", "int"), ("payment_type_key", "int"), ("order_type_key", "int"),
    ("order_id", "string"), ("category", "string"), ("sub_category", "string"), ("quantity", "double"),
    ("total_order_amount", "double"), ("received_amount", "double"),
]
UNMAPPED_COLUMNS = [
    ("order_id", "string"), ("payment_time", "string"), ("total_order_amount", "double"), ("received_amount", "double"),
    ("payment_type", "string"), ("items", "string"), ("order_type", "string"),
]
DIM_COLUMNS = {
    "product": [("product_key", "int"), ("items", "string"), ("sub_category", "string"), ("category", "string"),
                ("variation", "string"), ("size", "string")],
    "flavor": [("flavor_key", "int"), ("flavor_name", "string")],
    "sugar": [("sugar_key", "int"), ("sugar_level", "string"), ("percentage", "int")],
    "spice": [("spice_key", "int"), ("spice_level", "string"), ("intensity", "int")],
    "payment": [("payment_type_key", "int"), ("payment_type", "string")],
    "order": [("order_type_key", "int"), ("order_type", "string")],
}
