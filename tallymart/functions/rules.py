"""Ordered rule tables for names: taxonomy, role, type and brand, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.functions.text import normalize_name

# Fixed values: (pattern, broad category, sub category), the first that matches counts.
TAXONOMY = [
    ("iphone|apple.*phone", "Electronics", "Smartphones"),
    ("galaxy\\s*s\\d|galaxy\\s*a\\d|galaxy\\s*z|samsung.*phone", "Electronics", "Smartphones"),
    ("xiaomi|oneplus|huawei.*phone|google.*pixel|oppo|realme", "Electronics", "Smartphones"),
    ("smartphone|mobile phone", "Electronics", "Smartphones"),
    ("macbook|laptop|notebook|thinkpad|inspiron|pavilion|surface laptop|gaming laptop", "Electronics", "Laptops"),
    ("ipad|galaxy tab|tablet", "Electronics", "Tablets"),
    ("airpods|headphones|earbuds|speaker|soundbar|earphones", "Electronics", "Audio & Headphones"),
    ("\\b(oled|qled|neo qled|bravia|smart tv|television|tcl tv)\\b", "Electronics", "Televisions"),
    ("monitor|curved monitor", "Electronics", "Monitors"),
    ("apple watch|galaxy watch|fitbit|garmin.*watch|smartwatch", "Electronics", "Wearables"),
    ("ps5|playstation|xbox|gaming controller|gaming headset", "Electronics", "Gaming"),
    ("mirrorless camera|dslr|gopro|action camera", "Electronics", "Cameras"),
    ("security camera|doorbell|smart plug|alexa|echo|smart speaker", "Electronics", "Smart Home"),
    ("coffee machine|air fryer|pressure cooker|stand mixer|blender|microwave|kettle|toaster", "Home & Kitchen", "Kitchen Appliances"),
    ("washing machine|washer|refrigerator|fridge|dishwasher|clothes dryer", "Home & Kitchen", "Large Appliances"),
    ("vacuum cleaner|robot vacuum", "Home & Kitchen", "Cleaning Appliances"),
    ("air conditioner|air purifier|humidifier", "Home & Kitchen", "Air Treatment"),
    ("hair dryer|hair straightener|shaver|epilator|toothbrush", "Personal Care", "Grooming"),
    ("treadmill|exercise bike|yoga mat|protein|whey", "Fitness & Sports", "Cardio Equipment"),
    ("sofa|office chair|mattress|bedding|curtains|led strip", "Home & Kitchen", "Furniture & Bedding"),
    ("printer|ssd|usb.*hub|webcam", "Office", "Peripherals"),
    ("baby stroller|pram|baby monitor|diaper|baby food|baby formula", "Baby & Kids", "Baby Essentials"),
    ("baby carrier|baby seat|crib|bassinet|baby bath", "Baby & Kids", "Baby Gear"),
    ("toy|lego|board game|puzzle", "Baby & Kids", "Toys & Games"),
    ("dress|abaya|hijab|women.*fashion|men.*fashion|shirt|jeans|sneaker", "Fashion", "Clothing"),
    ("perfume|fragrance|deodorant", "Personal Care", "Fragrance"),
    ("skincare|moisturizer|serum|sunscreen|face wash", "Personal Care", "Skincare"),
    ("makeup|lipstick|foundation|mascara|eyeshadow", "Personal Care", "Makeup"),
]
OTHERWISE = ("Electronics", "General")
# Fixed values: (type, pattern), the first that matches counts.
TYPES = [
    ("tablet", "\\b(ipad|galaxy tab|tablet)\\b"),
    ("laptop", "\\b(macbook|laptop|notebook|chromebook|thinkpad|vivobook|zenbook|ideapad)\\b"),
    ("watch", "\\b(smart ?watch|apple watch|galaxy watch|watch)\\b"),
    ("earbuds", "\\b(airpods|earbuds|earphones|in-ear|tws)\\b"),
    ("headphones", "\\b(headphones?|headset|over-ear)\\b"),
    ("tv", "\\b(tv|television)\\b"),
    ("speaker", "\\b(speaker|soundbar)\\b"),
    ("phone", "\\b(iphone|smartphone|mobile phone|galaxy [asz]\\d+|pixel \\d+|phone)\\b"),
]
# Brands looked for in the first four words of a name.
BRANDS = (
    "apple samsung xiaomi redmi oneplus huawei honor google oppo realme vivo nokia motorola sony lg tcl hisense dell hp lenovo asus acer msi "
    "microsoft jbl bose anker beats philips dyson bosch nespresso spigen otterbox belkin ugreen baseus esr casetify"
).split()
#: What follows these words comes with the product and says nothing about its type.
INCLUDED = "(?i)\\b(?:with|including|includes|bundle|plus)\\b|[+&]"


def first_rule(c: Column, rules: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """Value of the first (value, pattern) whose pattern is found, letter case aside."""
    out = F.lit(otherwise)
    for value, pattern in reversed(rules):
        out = F.when(c.rlike(f"(?i){pattern}"), value).otherwise(out)
    return out


def taxonomy(c: Column) -> Column:
    """Broad and sub category as a struct."""
    broad = first_rule(c, [(b, p) for p, b, _ in TAXONOMY], OTHERWISE[0])
    sub = first_rule(c, [(s, p) for p, _, s in TAXONOMY], OTHERWISE[1])
    return F.struct(broad.alias("broad"), sub.alias("sub"))


def product_type(c: Column) -> Column:
    """T7."""
    return first_rule(F.split(c, INCLUDED)[0], TYPES)


def brand(c: Column) -> Column:
    """T8."""
    return F.get(F.filter(F.slice(F.split(normalize_name(c), " "), 1, 4), lambda t: t.isin(*BRANDS)), 0)


def identity_conflict(type_a: Column, type_b: Column, brand_a: Column, brand_b: Column, price_a: Column, price_b: Column) -> Column:
    """The first reason that two names cannot be one product, null if there is none."""
    return (
        F.when(type_a != type_b, "type_mismatch")
        .when(brand_a != brand_b, "brand_mismatch")
        .when(F.greatest(price_a, price_b) > 2 * F.least(price_a, price_b), "price_ratio")
    )
