"""Upkeep of stored data: merges of clusters, texts of one locale, modifier groups, branches near by, jobs, search requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOCALES = ("en", "ar")


def cluster_merge(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (id, match_key, created_at, images, tags, rating, review_count) of one match key fold into the oldest (a missing
    date last), then the smallest id. Gives the survivors (with the first images, rating and number of reviews that are there, and all
    tags in order), the folded rows as they were (to be saved before they go), and a row a cluster (folded, survivor).

    Documents without a key and those alone with theirs are in none of the three. The survivors are found by aggregates, so a
    frequent key is combined before it is shuffled."""
    order = F.struct(F.col("created_at").isNull(), F.col("created_at"), F.col("id"))
    keyed = docs.where("match_key IS NOT NULL AND match_key <> ''").withColumn("_order", order)
    at = lambda value, there: F.min_by(value, F.when(there, F.col("_order")))
    clusters = keyed.groupBy("match_key").agg(
        F.min_by("id", "_order").alias("survivor"), F.count("*").alias("n"), at("images", F.size("images") > 0).alias("images"),
        at("rating", F.col("rating").isNotNull()).alias("rating"), at("review_count", F.col("review_count").isNotNull()).alias("review_count"),
    ).where("n > 1")
    tag = keyed.select("match_key", "_order", F.posexplode("tags").alias("pos", "tag")).groupBy("match_key", "tag").agg(F.min(F.struct("_order", "pos")).alias("first"))
    tags = tag.groupBy("match_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "tag"))), lambda t: t["tag"]).alias("tags"))  # a cluster's distinct tags
    none = F.array().cast("array<string>")
    survivors = clusters.join(tags, "match_key", "left").select(F.col("survivor").alias("id"), "match_key", F.coalesce("images", none).alias("images"), F.coalesce("tags", none).alias("tags"), "rating", "review_count")
    folded = keyed.join(clusters.select("match_key", "survivor"), "match_key").where("id <> survivor").select(*docs.columns)
    return survivors, folded, clusters.select("match_key", "survivor", (F.col("n") - 1).alias("folded"))


def _texts(pick) -> Column:
    """A text of each locale, null if there is none in any."""
    made = F.struct(*[pick(x).alias(x) for x in LOCALES])
    return F.when(F.coalesce(*[made[x] for x in LOCALES]).isNotNull(), made)


def set_locale(stored: Column, new: Column, locale: str, clear: Column | None = None) -> Column:
    """M8: a localised text after a write in one locale. Another locale's text stays; the written one takes the new text, or goes where
    `clear` says so; a text that is left in no locale is null."""
    gone = F.lit(False) if clear is None else F.coalesce(clear, F.lit(False))
    return _texts(lambda x: F.when(~gone, F.coalesce(new[x], stored[x])) if x == locale else stored[x])


def _same_place(held: Column, id: Column, at: Column) -> Column:
    """The entry with the id, or, for one without an id, the one at its place if that has none either."""
    there = F.get(held, at)
    return F.when(id.isNotNull(), F.get(F.filter(held, lambda v: v["id"] == id), F.lit(0))).when(there["id"].isNull(), there)


def merged_modifiers(stored: Column, incoming: Column, locale: str) -> Column:
    """Groups and options as they come in; names and descriptions keep the other locale's text where the group or option still exists.
    Both are array<struct<id, name, description, options: array<struct<id, name, description, ...>>, ...>>; texts are structs of locales."""

    def text(old: Column, new: Column) -> Column:
        return _texts(lambda x: new[x] if x == locale else old[x])

    def option(o: Column, old: Column) -> Column:
        return o.withField("name", F.coalesce(text(old["name"], o["name"]), o["name"])).withField("description", text(old["description"], o["description"]))

    def group(g: Column, i: Column) -> Column:
        old = _same_place(stored, g["id"], i)
        options = F.transform(g["options"], lambda o, j: option(o, _same_place(old["options"], o["id"], j)))
        return option(g, old).withField("options", options)

    return F.transform(incoming, group)


def nearby_branches(sources: DataFrame, cards: DataFrame, most: int | None = None, cell: int = 7) -> DataFrame:
    """For each source (source, geohash, brand) the cards (card, geohash, brand, place) of its brand in its cell of `cell` digits;
    `most` keeps the first ones of each source by place. Sources without any are left out. A listing is read once for a cell, not once for a source.
    With `most`, a cell and brand's first cards are found before sources meet them, as they are the same for all its sources."""
    at = F.substring("geohash", 1, cell).alias("cell")
    shown = cards.select("card", "brand", "place", at)
    if most is not None:
        first = Window.partitionBy("cell", "brand").orderBy("place", "card")
        shown = shown.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= most).drop("_n")
    found = sources.where("brand <> ''").select("source", "brand", at).join(shown, ["cell", "brand"])
    if most is not None:
        w = Window.partitionBy("source").orderBy("place", "card")
        found = found.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    return found.select("source", "card", "place")


def next_run(now: Column, outcome: Column, attempts: Column, interval: Column, retry_seconds: int = 60, max_attempts: int = 3) -> Column:
    """When a job runs again. Complete or partial: after its interval (seconds). Out of budget: a minute after the next UTC midnight. Interrupted: now.
    Failed: after a wait that doubles with every attempt, at most the interval, which it is once the attempts are used up. Null for another outcome."""
    after = lambda s: F.timestamp_seconds(F.unix_micros(now) / 1_000_000 + s)
    wait = F.least(F.lit(float(retry_seconds)) * F.pow(F.lit(2.0), F.greatest(attempts - 1, F.lit(0))), interval.cast("double"))
    midnight = F.timestamp_seconds((F.floor(F.unix_micros(now) / 86_400_000_000) + 1) * 86400 + 60)
    return (
        F.when(outcome.isin("complete", "partial"), after(interval)).when(outcome == "budget_exhausted", midnight).when(outcome == "interrupted", now)
        .when(outcome == "failed", F.when(attempts >= max_attempts, after(interval)).otherwise(after(wait)))
    )


def recovered_jobs(jobs: DataFrame, wanted: DataFrame, now: Column) -> DataFrame:
    """The job table (id, status, next_run, attempts) of a worker that starts: jobs left running are interrupted and due, newly configured ones (id) idle and due."""
    running = F.col("status") == "running"
    old = jobs.select("id", F.when(running, "interrupted").otherwise(F.col("status")).alias("status"), F.when(running, now).otherwise(F.col("next_run")).alias("next_run"), "attempts")
    new = wanted.select("id").distinct().join(jobs, "id", "left_anti")
    return old.unionByName(new.select("id", F.lit("idle").alias("status"), now.alias("next_run"), F.lit(0).cast(jobs.schema["attempts"].dataType).alias("attempts")))


def request_issues(query: Column, locale: Column, group: Column, platforms: Column, limit: Column, known: tuple[str, ...] = ("talabat", "deliveroo"), longest: int = 100, most: int = 50) -> Column:
    """What is wrong with a search request, a reason a field; a null locale, group, platforms or limit takes its default."""
    bare = F.regexp_replace(query, "[^\\p{L}\\p{N}]", "")
    unknown = F.size(F.filter(platforms, lambda p: p.isNull() | ~p.isin(*known))) > 0
    wrong = {
        "query is required": F.coalesce(F.trim(query) == "", F.lit(True)),
        "query is too long": F.length(query) > longest,
        "query needs letters or digits": (F.trim(query) != "") & (F.length(query) <= longest) & (bare == ""),
        "locale is not supported": ~locale.isin(*LOCALES),
        "group is no id": ~group.rlike("^[0-9a-fA-F]{24}$"),
        "platforms are empty": F.size(platforms) == 0,
        "platform is not supported": unknown,
        "limit is out of range": ~limit.between(1, most),
    }
    return F.array_compact(F.array(*[F.when(bad, name) for name, bad in wrong.items()]))


#: Names that a canonical item is also known by, at most.
MAX_ALIASES = 20


def canonical_items(items: DataFrame, stored: DataFrame, key) -> DataFrame:
    """Canonical items (item, name, description, category, aliases, alias_keys, status) after a look at their seed items (item, name,
    description, category; texts are structs of locales). `alias_keys` are the aliases under `key`. An item without one makes a new one (created). A stored one takes texts of locales that it lacks;
    another name of its seed in a locale is kept as an alias, unless `key` of it is known already (enriched, else unchanged). Stored ones whose
    seed is not among the items stay (kept). Blank texts count as missing."""
    clean = lambda t: _texts(lambda x: F.when(F.trim(t[x]) != "", F.trim(t[x])))
    fields = ("name", "description", "category")
    j = stored.alias("s").join(items.select("item", *[clean(F.col(f)).alias(f) for f in fields], F.lit(True).alias("seen")).alias("i"), "item", "full")
    s, i = (lambda f: F.col(f"s.{f}")), (lambda f: F.col(f"i.{f}"))
    new = s("aliases").isNull()
    gone = i("seen").isNull()
    none = F.array().cast("array<string>")
    texts = {f: _texts(lambda x, f=f: F.coalesce(s(f)[x], i(f)[x])) for f in fields}
    keys = F.coalesce(s("alias_keys"), none)
    known = F.concat(keys, F.array_compact(F.array(*[key(s("name")[x]) for x in LOCALES])))
    other = [~new & s("name")[x].isNotNull() & (key(s("name")[x]) != key(i("name")[x])) & ~F.array_contains(known, key(i("name")[x])) for x in LOCALES]

    def with_others(held: Column, value) -> Column:
        return F.slice(F.array_distinct(F.concat(F.coalesce(held, none), F.array_compact(F.array(*[F.when(o, value(i("name")[x])) for o, x in zip(other, LOCALES)])))), 1, MAX_ALIASES)

    aliases, alias_keys = with_others(s("aliases"), lambda n: n), with_others(keys, key)
    merged = j.select("item", *[t.alias(f) for f, t in texts.items()], aliases.alias("aliases"), alias_keys.alias("alias_keys"), *[s(f).alias(f"_{f}") for f in (*fields, "aliases")], new.alias("_new"), gone.alias("_gone"))
    same = F.lit(True)
    for f in (*fields, "aliases"):
        same = same & F.col(f).eqNullSafe(F.col(f"_{f}"))
    status = F.when(F.col("_new"), "created").when(F.col("_gone"), "kept").when(same, "unchanged").otherwise("enriched")
    return merged.select("item", *fields, "aliases", "alias_keys", status.alias("status"))


def discovered(listings: DataFrame, likely: Column) -> tuple[DataFrame, DataFrame]:
    """Candidates for import, and what is left out with its reason; `likely` tells a restaurant, a null one does not."""
    good = F.coalesce(likely, F.lit(False))
    marked = listings.withColumn("_good", good)
    return marked.where("_good").drop("_good"), marked.where("NOT _good").drop("_good").withColumn("reason", F.lit("NOT_A_RESTAURANT"))
