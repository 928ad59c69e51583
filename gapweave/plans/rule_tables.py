"""Default rule tables. All are plain parameters of the rule operators.

Fixed values: the limits, ratios and bounds below are domain constants that results depend on."""

from __future__ import annotations

# Role -> column of the product export.
PRODUCT_COLUMNS = {
    "energy": "energy_100g",
    "fat": "fat_100g",
    "saturated_fat": "saturated-fat_100g",
    "trans_fat": "trans-fat_100g",
    "cholesterol": "cholesterol_100g",
    "carbohydrates": "carbohydrates_100g",
    "sugars": "sugars_100g",
    "fiber": "fiber_100g",
    "proteins": "proteins_100g",
    "salt": "salt_100g",
    "sodium": "sodium_100g",
    "vitamin_a": "vitamin-a_100g",
    "vitamin_c": "vitamin-c_100g",
    "calcium": "calcium_100g",
    "iron": "iron_100g",
    "fr_score": "nutrition-score-fr_100g",
    "uk_score": "nutrition-score-uk_100g",
    "grade": "nutrition_grade_fr",
    "group": "pnns_groups_1",
    "subgroup": "pnns_groups_2",
}

NUTRIENTS = (
    "energy", "fat", "saturated_fat", "trans_fat", "cholesterol", "carbohydrates", "sugars", "fiber",
    "proteins", "salt", "sodium", "vitamin_a", "vitamin_c", "calcium", "iron",
)

# Upper limits per 100 g. Energy is in kJ for the integrity check and in kcal for the constraints.
_LIMITS_WITHOUT_ENERGY = {
    "fat": 95.0, "saturated_fat": 55.0, "carbohydrates": 95.0, "sugars": 95.0, "proteins": 90.0,
    "sodium": 3.0, "salt": 6.0, "fiber": 50.0, "trans_fat": 5.0, "cholesterol": 500.0,
    "vitamin_a": 30.0, "vitamin_c": 50.0, "calcium": 30.0, "iron": 40.0,
}
LIMITS_KJ = {"energy": 4300.0, **_LIMITS_WITHOUT_ENERGY}
LIMITS_KCAL = {"energy": 950.0, **_LIMITS_WITHOUT_ENERGY}

# (part, whole): the part must not exceed the whole.
PART_OF = (("saturated_fat", "fat"), ("sodium", "salt"))

# Grade -> inclusive range of the first and of the second score.
GRADE_RANGES = {
    "a": ((-15.0, -1.0), (-15.0, -1.0)),
    "b": ((0.0, 2.0), (0.0, 2.0)),
    "c": ((3.0, 10.0), (-3.0, 10.0)),
    "d": ((11.0, 18.0), (11.0, 19.0)),
    "e": ((19.0, 40.0), (19.0, 40.0)),
}

# Grade -> (slope, intercept) of second score = slope * first score + intercept.
GRADE_LINES = {
    "a": (1.0000, 0.0000),
    "b": (0.9998, -0.0048),
    "c": (1.0946, -0.7569),
    "d": (1.1226, -1.6237),
    "e": (1.3735, -8.6686),
}

SALT_PER_SODIUM = 2.5
SALT_RATIO_RANGE = (2.4, 2.6)
KCAL_PER_GRAM = {"proteins": 4.0, "carbohydrates": 4.0, "fat": 9.0}
MACRO_CAPS = {"proteins": 90.0, "carbohydrates": 95.0, "fat": 95.0}
MAX_ENERGY = 950.0

# Protein of zero by food group, then the minimum of any exact zero.
GROUP_PROTEIN = {"meat": 10.0, "dairy": 3.0, "fruits and vegetables": 0.5, "cereals": 0.5, "fish": 0.5}
ZERO_MINIMUMS = {"energy": 1.0, "proteins": 0.1, "fat": 0.01, "carbohydrates": 0.1}
DRINK_GROUP = "beverages"
DRINK_EXEMPT = ("fat", "proteins")

# Share of the whole given to a zero part, by food group; "" is the share without a group column.
SATURATED_SHARE = {"dairy": 0.6, "meat": 0.3, "fish": 0.3, None: 0.2, "": 0.3}
SUGAR_SHARE = {"fruits and vegetables": 0.7, "beverages": 0.8, "cereals": 0.1, None: 0.2, "": 0.3}
SATURATED_CAP_SHARE = 0.8
SUGAR_CAP_SHARE = 0.9
PART_THRESHOLD = 0.5

MACRO_SUM_LIMIT = 105.0
MACRO_SUM_TARGET = 100.0
ENERGY_TOLERANCE = 0.2

# Suffix of a column name -> (logical type, sub-type), applied in this order.
SUFFIX_TYPES = (
    ("_t", "unix_timestamp", None),
    ("_datetime", "iso8601_datetime", None),
    ("_tags", "string", "tags"),
    ("_100g", "float", None),
    ("_serving", "float", None),
    ("_fr", "string", "tags"),
)

# Confidence levels of the full imputation run, the label passes and the last fill.
LEVELS = (("high", 0.8), ("medium", 0.5), ("low", 0.2))
LABEL_CONFIDENCE = (0.9, 0.75)
LABEL_PERCENTILES = (50.0, 65.0)
LABEL_LAST_CONFIDENCE = 0.3
FINAL_CONFIDENCE = 0.1
