"""Evidence that a menu item is a canonical item: name, texts, portions, modifiers and image, weighed to a confidence.

Texts come as English and Arabic columns; one that folds to nothing counts as missing. Nulls are missing evidence, never a conflict.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.item_text import core_name, item_key, keyword_tokens, portion, signals
from tallymart.functions.marketplace import image_key
from tallymart.functions.text import dice

# Weights, thresholds and penalties of the matcher.
WEIGHTS = {"name": 0.5, "description": 0.2, "category": 0.1, "modifiers": 0.15, "image": 0.05}
NAME_CANDIDATE, NAME_MATCH, REVIEW, MATCH, MARGIN = 0.5, 0.9, 0.35, 0.7, 0.1
DESCRIPTION_SUPPORT, CATEGORY_SUPPORT, MODIFIER_SUPPORT = 0.5, 1.0, 0.6
CATEGORY_CONFLICT, MODIFIER_CONFLICT = 0.3, 0.3
PARTIAL_NAME, CORE_NAME = 0.8, 0.9
PENALTIES = {
    "CATEGORY_DIFFERENT": 0.05,
    "MODIFIER_OPTIONS_DIFFER": 0.05,
    "MODIFIER_REQUIRED_DIFFERS": 0.02,
    "MODIFIER_LIMITS_DIFFER": 0.02,
    "VARIANT_ONLY_ONE_SIDE": 0.1,
    "QUANTITY_MISMATCH": 0.3,
    "SIZE_MISMATCH": 0.3,
}
FOR_REVIEW = ("VARIANT_ONLY_ONE_SIDE", "QUANTITY_MISMATCH", "SIZE_MISMATCH", "PLATFORM_ALREADY_MAPPED")
EXCLUDED = ("UNIT_MISMATCH",)
LOCALES = ("en", "ar")


def _rounded(x: Column) -> Column:
    return F.floor(x * 1000 + 0.5) / 1000


def prepared(df: DataFrame, prefix: str) -> DataFrame:
    """Columns {prefix}name_en, _ar, alias, description_en, _ar, category_en, _ar become keys, tokens and the portion (all with the prefix), computed once
    for each row rather than for each pair."""
    p = lambda n: F.col(f"{prefix}{n}")
    names = [p("name_en"), p("name_ar"), p("alias")]
    texts = [f"{t}_{x}" for t in ("description", "category") for x in LOCALES]
    keyed = df.withColumns({f"{prefix}k{i}": item_key(n) for i, n in enumerate(names)} | {f"{prefix}c{i}": core_name(n) for i, n in enumerate(names)} | {f"{prefix}{t}": item_key(p(t)) for t in texts})
    k, core = [p(f"k{i}") for i in range(3)], [p(f"c{i}") for i in range(3)]
    made = {
        f"{prefix}full": signals(*k),
        f"{prefix}core": signals(*core),
        f"{prefix}tokens": F.transform(signals(*k), lambda x: F.array_distinct(keyword_tokens(x))),
        f"{prefix}portion": F.coalesce(portion(names[0]), portion(names[1])),
    }
    return keyed.withColumns(made).drop(*[f"{prefix}{x}{i}" for x in "kc" for i in range(3)])


def score_name(full1: Column, core1: Column, tokens1: Column, full2: Column, core2: Column, tokens2: Column) -> Column:
    """1 for an equal name, CORE_NAME for equal ones without portions, else the best Dice of tokens, scaled."""
    best = F.array_max(F.transform(tokens1, lambda x: F.array_max(F.transform(tokens2, lambda y: dice(x, y)))))
    return F.when(F.arrays_overlap(full1, full2), 1.0).when(F.arrays_overlap(core1, core2), CORE_NAME).otherwise(_rounded(F.coalesce(best, F.lit(0.0)) * PARTIAL_NAME))


def score_text(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """E13, of keys by locale: 1 for equal texts of a locale, else the best Dice within a locale; null if a side has no text."""
    there = lambda t: reduce(lambda x, y: x | y, [t[x].isNotNull() for x in LOCALES])
    tokens = lambda c: F.array_distinct(keyword_tokens(c))
    per = [F.when(a[x] == b[x], 1.0).when(a[x].isNotNull() & b[x].isNotNull(), dice(tokens(a[x]), tokens(b[x]))).otherwise(0.0) for x in LOCALES]
    return F.when(there(a) & there(b), _rounded(F.greatest(*per)))


def compare_portions(a: Column, b: Column) -> tuple[Column, Column]:
    """Score (null without any) and conflict (at most one, null if there is none)."""
    unit, quantity, size = (a[f] != b[f] for f in ("unit", "quantity", "size"))
    conflict = F.when(a.isNull() & b.isNull(), None).when(a.isNull() | b.isNull(), "VARIANT_ONLY_ONE_SIDE").when(unit, "UNIT_MISMATCH").when(quantity, "QUANTITY_MISMATCH").when(size, "SIZE_MISMATCH")
    score = F.when(a.isNotNull() | b.isNotNull(), F.when(conflict.isNull(), 1.0).when(conflict == "VARIANT_ONLY_ONE_SIDE", 0.5).otherwise(0.0))
    return score, conflict


def compare_modifiers(a: Column, b: Column) -> tuple[Column, Column]:
    """E15, of arrays of groups (en, ar: keys; required; least, most; options_en, options_ar: arrays of keys): score (null unless both
    have groups) and conflicts. Structure is compared between groups that share a name."""
    there = (F.size(a) > 0) & (F.size(b) > 0)
    names = lambda g, x: F.array_distinct(F.array_compact(F.transform(g, lambda e: e[x])))
    options = lambda g, x: F.array_distinct(F.array_compact(F.flatten(F.transform(g, lambda e: F.coalesce(e[f"options_{x}"], F.array().cast("array<string>"))))))
    option = F.greatest(*[dice(options(a, x), options(b, x)) for x in LOCALES])
    group = F.greatest(*[dice(names(a, x), names(b, x)) for x in LOCALES])
    twins = F.transform(a, lambda g: F.struct(g.alias("g"), F.get(F.filter(b, lambda r: F.coalesce(g["en"] == r["en"], F.lit(False)) | F.coalesce(g["ar"] == r["ar"], F.lit(False))), 0).alias("r")))
    facts = lambda fields: F.flatten(F.transform(twins, lambda t: F.array(*[t["g"][f].cast("int") == t["r"][f].cast("int") for f in fields])))
    known = F.array_compact(facts(("required", "least", "most")))
    structure = F.when(F.size(known) > 0, F.size(F.filter(known, lambda x: x)) / F.size(known)).otherwise(0.0)
    differs = lambda fields: F.exists(F.array_compact(facts(fields)), lambda x: ~x)
    conflicts = F.array(
        F.when(option < MODIFIER_CONFLICT, "MODIFIER_OPTIONS_DIFFER"),
        F.when(differs(("required",)), "MODIFIER_REQUIRED_DIFFERS"),
        F.when(differs(("least", "most")), "MODIFIER_LIMITS_DIFFER"),
    )
    score = _rounded(0.5 * option + 0.3 * group + 0.2 * structure)
    return F.when(there, score), F.when(there, F.array_compact(conflicts)).otherwise(F.array().cast("array<string>"))


def scored(pairs: DataFrame) -> DataFrame:
    """Pairs of prepared sides (prefixes s_ and c_; item, canonical, s_/c_modifiers, s_/c_image, s_platform, c_platforms) to
    item, canonical, confidence, method, plausible, matchable, conflicts. Of several references of a canonical item the caller takes the best."""
    c = F.col
    side = lambda p, t: {x: c(f"{p}{t}_{x}") for x in LOCALES}
    name = score_name(*[c(f"{p}{x}") for p in ("s_", "c_") for x in ("full", "core", "tokens")])
    variant, variant_conflict = compare_portions(c("s_portion"), c("c_portion"))
    modifiers, modifier_conflicts = compare_modifiers(c("s_modifiers"), c("c_modifiers"))
    signs = pairs.withColumns(
        {
            "n": name,
            "d": score_text(side("s_", "description"), side("c_", "description")),
            "g": score_text(side("s_", "category"), side("c_", "category")),
            "v": variant,
            "m": modifiers,
            "i": F.when(image_key(c("s_image")).isNotNull() & image_key(c("c_image")).isNotNull(), (image_key(c("s_image")) == image_key(c("c_image"))).cast("double")),
            "core": F.arrays_overlap("s_core", "c_core") & ~F.arrays_overlap("s_full", "c_full"),
            "modifier_conflicts": modifier_conflicts,
        }
    )
    mapped = F.when(F.coalesce(F.array_contains("c_platforms", c("s_platform")), F.lit(False)), "PLATFORM_ALREADY_MAPPED")
    conflicts = F.array_compact(F.concat(F.array(F.when(c("g") < CATEGORY_CONFLICT, "CATEGORY_DIFFERENT"), variant_conflict), c("modifier_conflicts"), F.array(mapped)))
    zero = lambda x: F.coalesce(c(x), F.lit(0.0))
    weighed = sum((w * zero(x) for x, w in zip("dgmi", list(WEIGHTS.values())[1:])), WEIGHTS["name"] * c("n"))
    fines = reduce(lambda x, y: x + y, [F.when(F.array_contains("conflicts", k), v).otherwise(0.0) for k, v in PENALTIES.items()])
    any_of = lambda kinds: F.arrays_overlap("conflicts", F.array(*map(F.lit, kinds)))
    corroborated = (zero("d") >= DESCRIPTION_SUPPORT) | (zero("g") >= CATEGORY_SUPPORT) | (zero("m") >= MODIFIER_SUPPORT)
    whole = (c("n") == 1) & (c("d").isNotNull() | c("g").isNotNull()) & F.coalesce(c("d") == 1, F.lit(True)) & F.coalesce(c("g") == 1, F.lit(True))
    d, m, g = WEIGHTS["description"] * zero("d"), WEIGHTS["modifiers"] * zero("m"), WEIGHTS["category"] * zero("g")
    method = (
        F.when(whole, "EXACT_NORMALIZED")
        .when(c("core") & (c("v") == 1), "VARIANT")
        .when((d > 0) & (d >= m) & (d >= g), "NAME_DESCRIPTION")
        .when((m > 0) & (m >= g), "MODIFIER")
        .when(g > 0, "NAME_CATEGORY")
        .otherwise("EXACT_NORMALIZED")
    )
    j = signs.withColumn("conflicts", conflicts).withColumn("confidence", _rounded(F.least(F.lit(1.0), F.greatest(F.lit(0.0), weighed - fines))))
    j = j.withColumn("plausible", ~any_of(EXCLUDED) & (c("n") >= NAME_CANDIDATE) & (c("confidence") >= REVIEW))
    matchable = c("plausible") & ~any_of(FOR_REVIEW) & corroborated & (c("n") >= NAME_MATCH) & (c("confidence") >= MATCH)
    return j.select("item", "canonical", "confidence", method.alias("method"), "plausible", matchable.alias("matchable"), "conflicts")


def decided(items: DataFrame, scores: DataFrame) -> DataFrame:
    """For each item the best plausible canonical item (ties to the smaller id): MATCHED if it may be and no other is within MARGIN, else
    REVIEW; UNMATCHED without one. Candidates are all those scored; none is cut before."""
    order = Window.partitionBy("item").orderBy(F.desc("confidence"), "canonical")
    top = scores.where("plausible").withColumn("at", F.row_number().over(order)).where("at <= 2")
    best = top.groupBy("item").agg(*[F.max(F.when(F.col("at") == 1, F.col(x))).alias(x) for x in ("canonical", "confidence", "method", "matchable")], F.max(F.when(F.col("at") == 2, F.col("confidence"))).alias("next"))
    j = items.select(F.col("id").alias("item")).join(best, "item", "left")
    clear = F.col("next").isNull() | (F.col("confidence") - F.col("next") >= MARGIN - 1e-9)
    status = F.when(F.col("canonical").isNull(), "UNMATCHED").when(F.col("matchable") & clear, "MATCHED").otherwise("REVIEW")
    return j.select("item", "canonical", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "method", status.alias("status"))
