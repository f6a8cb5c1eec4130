"""Our own menu: the product catalog, the item → sub-category → category
maps, name corrections and a holiday rule.

These are user data, not engine logic: every operator takes them as
arguments (see ``Vocabulary`` in ``tillstack.sources.seeds``), so a shop
swaps in its own menu without touching code.
"""

from __future__ import annotations

import datetime as _dt

# Catalog rows: (items, sub_category, category, variation, size); the natural
# key (items, variation, size) is unique.  Blank variation/size is None.  The menu
# is grouped by the occasion at which something is ordered.
CATALOG = [
    ("Americano", "Wake-Up", "Beverages", "Hot", None),
    ("Americano", "Wake-Up", "Beverages", "Cold", None),
    ("Americano", "Wake-Up", "Beverages", None, None),
    ("Farmer'S Omelette", "Hearty Start", "Food", None, None),
    ("Croissant - Almond Nutella", "Hearty Start", "Food", None, None),
    ("Mocha", "Long Talk", "Beverages", "Hot", None),
    ("Mocha", "Long Talk", "Beverages", "Cold", None),
    ("Cinnamon Latte", "Long Talk", "Beverages", "Hot", None),
    ("Cinnamon Latte", "Long Talk", "Beverages", "Cold", None),
    ("Mint Infusion", "Long Talk", "Beverages", "Hot", None),
    ("Hojicha Float", "Hot Afternoon", "Beverages", "Hot", None),
    ("Hojicha Float", "Hot Afternoon", "Beverages", "Cold", None),
    ("Oolong Milk", "Hot Afternoon", "Beverages", "Cold", None),
    ("Ginger Lemonade", "Hot Afternoon", "Beverages", None, None),
    ("Sparkling Water", "Hot Afternoon", "Beverages", None, None),
    ("Mushroom Rice Bowl", "Hungry", "Food", None, None),
    ("Chili Udon", "Hungry", "Food", None, None),
    ("Harvest Sandwich", "Hungry", "Food", None, "Solo"),
    ("Harvest Sandwich", "Hungry", "Food", None, "Duo"),
    ("Sweet Potato Fries", "Round Table", "Food", None, None),
    ("Pandan Tart", "Birthday", "Desserts", None, "Solo"),
    ("Pandan Tart", "Birthday", "Desserts", None, "Duo"),
    ("Pandan Tart", "Birthday", "Desserts", None, "Medio"),
    ("Pandan Tart", "Birthday", "Desserts", None, "Familia"),
    ("Croffle - Oreo", "To Take Home", "Desserts", None, None),
    ("Cookies - Smores", "To Take Home", "Desserts", None, None),
    ("Cookies - Red Velvet", "To Take Home", "Desserts", None, None),
    ("Cookies - Matcha", "To Take Home", "Desserts", None, None),
    ("Espresso Shot", "On The Side", "Add-Ons", None, None),
    ("Bowl Of Rice", "On The Side", "Add-Ons", None, None),
]

# Cleaned item name (exact case, before title-casing) → group and category.
# "Scented Candle" is mapped but deliberately absent from the catalog, so it
# passes quarantine and lands on the unknown product key.
MENU = {
    ("Wake-Up", "Beverages"): ["Americano"],
    ("Hearty Start", "Food"): ["Farmer's Omelette", "Croissant - Almond Nutella"],
    ("Long Talk", "Beverages"): ["Mocha", "Cinnamon Latte", "Mint Infusion"],
    ("Hot Afternoon", "Beverages"): ["Hojicha Float", "Oolong Milk", "Ginger Lemonade", "Sparkling Water"],
    ("Hungry", "Food"): ["Mushroom Rice Bowl", "Chili Udon", "Harvest Sandwich"],
    ("Round Table", "Food"): ["Sweet Potato Fries"],
    ("Birthday", "Desserts"): ["Pandan Tart"],
    ("To Take Home", "Desserts"): ["Croffle - Oreo", "Cookies - Smores", "Cookies - Red Velvet", "Cookies - Matcha"],
    ("On The Side", "Add-Ons"): ["Espresso Shot", "Bowl of Rice"],
    ("Keepsakes", "Others"): ["Scented Candle"],
}
PRODUCT_TO_SUB = {item: group for (group, _), items in MENU.items() for item in items}
SUB_TO_CATEGORY = dict(MENU.keys())

# Exact-value spelling fixes applied to the cleaned item name.
CORRECTIONS = {"Mocca": "Mocha"}

# Holiday rule: (month, day, name, type) repeated every year.
HOLIDAY_RULES = [
    (1, 1, "New Year's Day", "Regular"),
    (5, 1, "Labor Day", "Regular"),
    (11, 1, "All Saints' Day", "Special"),
    (12, 24, "Christmas Eve", "Special"),
    (12, 25, "Christmas Day", "Regular"),
    (12, 31, "New Year's Eve", "Special"),
]


def holiday_rows(first_year: int, last_year: int):
    """Expand ``HOLIDAY_RULES`` to (date, name, type) rows for a year range."""
    return [
        (_dt.date(y, m, d), name, kind)
        for y in range(first_year, last_year + 1)
        for (m, d, name, kind) in HOLIDAY_RULES
    ]
