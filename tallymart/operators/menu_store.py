"""Menus written to four tables (restaurants, categories, items, runs) that change together or not at all.

A batch holds the menus of any number of restaurants. What a page shows is merged into what is stored field by field; records that
break a rule or repeat a key are refused one by one, and the rest is written. What a complete and credible page does not show any
more becomes inactive. Tables are divided into buckets of restaurants; a batch writes new files for the buckets that it touches and
then one manifest that names the files of all tables. The manifest has the next number and is put in place only if nobody else
took that number, so readers see all of a batch or none of it, and a writer that lost starts again from the newer state.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.operators.files import Folder
from tallymart.operators.menu_search import inactive_marking

#: Buckets of restaurants. A batch rewrites those that it touches.
BUCKETS = 64
MOST_PRICE = 1_000_000
_TEXTS = "map<string,string>"
RESTAURANT = f"restaurant string, platform string, platform_id string, name {_TEXTS}, url {_TEXTS}, currency string, lat double, lng double, active boolean, first_seen timestamp, last_seen timestamp"
CATEGORY = f"restaurant string, source_key string, kind string, platform_id string, name {_TEXTS}, sort_order int, active boolean, first_seen timestamp, last_seen timestamp"
ITEM = f"restaurant string, source_key string, kind string, platform_id string, category_key string, name {_TEXTS}, description {_TEXTS}, price double, original_price double, currency string, image_url string, available boolean, active boolean, first_seen timestamp, last_seen timestamp"
COUNTS = tuple(f"{what}_{status}" for what in ("restaurants", "categories", "items") for status in ("created", "updated", "unchanged")) + ("categories_rejected", "categories_inactive", "items_seen", "items_rejected", "items_inactive")
RUN = "restaurant string, run_id string, locale string, at timestamp, " + ", ".join(f"{c} long" for c in COUNTS) + ", inactive_applied boolean, inactive_reasons array<string>"
SCHEMAS = {"restaurants": RESTAURANT, "categories": CATEGORY, "items": ITEM, "runs": RUN}
LOCALIZED = {"restaurants": ("name", "url"), "categories": ("name",), "items": ("name", "description")}
OBSERVED = ("active", "first_seen", "last_seen")


def _columns(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _none(spark: SparkSession, table: str) -> DataFrame:
    """No rows, without a Python worker to make them."""
    return spark.range(0).where("false").select(*(F.lit(None).cast(x.split(maxsplit=1)[1]).alias(x.split()[0]) for x in SCHEMAS[table].split(", ")))


def rules(table: str) -> dict[str, Column]:
    """What a merged record must fulfil."""
    c = F.col
    named = F.trim(F.concat_ws("", F.map_values("name"))) != ""
    if table == "restaurants":
        return {"restaurant": c("restaurant") != "", "name": named, "currency": c("currency").isNull() | c("currency").rlike("^[A-Z]{3}$"), "lat": c("lat").isNull() | (F.abs("lat") <= 90), "lng": c("lng").isNull() | (F.abs("lng") <= 180)}
    keyed = {"source_key": c("source_key") != "", "kind": c("kind").isin("id", "anchor", "position"), "platform_id": (c("kind") == "id") == c("platform_id").isNotNull(), "name": named}
    if table == "categories":
        return keyed | {"sort_order": c("sort_order").isNull() | (c("sort_order") >= 0)}
    price = (c("price") >= 0) & (c("price") <= MOST_PRICE)
    return keyed | {"category_key": (c("kind") != "position") | c("category_key").isNotNull(), "price": price, "original_price": c("original_price").isNull() | ((c("original_price") >= c("price")) & (c("original_price") <= MOST_PRICE)), "currency": c("currency").isNull() | c("currency").rlike("^[A-Z]{3}$")}


def merged(table: str, stored: DataFrame | None, incoming: DataFrame, locale: str, now: Column, good: DataFrame | None = None) -> DataFrame:
    """Stored and incoming records as they are to be, with status (created, updated, unchanged, kept), code (why refused; then the stored values
    stay), seen (whether the page shows the record) and was_active.

    incoming has the table's columns but `active` and the times; localized ones are texts of `locale`. It may have `at`, the order of
    records, and `clear`, names of fields that the page shows to be gone. A null leaves what is stored. A record is found by its
    platform_id if it has one, else by its source_key. Of records with one key the first counts, the others are refused, as is one
    that would take another record's key. With good, records of restaurants that it lacks are refused, and keys of another kind where
    active records have ids (M13).

    stored is None where nothing is stored yet, so nothing is looked up.
    Stored records, incoming ones and good restaurants are dealt by restaurant once, in one table; all that is looked up is a window of it."""
    key = "restaurant" if table == "restaurants" else "source_key"
    columns, texts = _columns(SCHEMAS[table]), LOCALIZED[table]
    own = [c for c in columns if c not in OBSERVED]
    i = incoming
    i = i if "at" in i.columns else i.withColumn("at", F.lit(0))
    i = i if "clear" in i.columns else i.withColumn("clear", F.array().cast("array<string>"))
    keys = ("restaurant",) if table == "restaurants" else ("restaurant", "source_key", "platform_id")
    empty, stored = stored is None, _none(incoming.sparkSession, table) if stored is None else stored
    every = stored.select(*keys, F.lit(0).alias("tag"), F.struct(*columns).alias("s"))
    every = every.unionByName(i.select(*keys, F.lit(1).alias("tag"), F.struct(*own, "at", "clear").alias("g")), allowMissingColumns=True)
    if good is not None:
        every = every.unionByName(good.select("restaurant", F.lit(-1).alias("tag")), allowMissingColumns=True)
    every = every.repartition("restaurant")
    is_stored, came = F.col("tag") == 0, F.col("tag") == 1
    by = lambda *c: Window.partitionBy("restaurant", *c)
    no = F.lit(False)
    if table == "restaurants":
        every = every.withColumns({"refused": F.lit(None).cast("string"), "owned": no, "target": F.col("restaurant"), "shown": F.lit(True)})
    else:
        found = F.min(F.when(is_stored, F.col("source_key"))).over(by("platform_id"))
        known, ids = F.max(F.col("tag") == -1).over(by()), F.max(is_stored & F.col("s.active") & (F.col("s.kind") == "id")).over(by())
        every = every.withColumns({"found": F.lit(None).cast("string") if empty else F.when(F.col("platform_id").isNotNull(), found), "known": known if good is not None else F.lit(True), "ids": no if empty or good is None else ids}).where("tag >= 0")
        every = every.withColumns({"there": no, "shown": no} if empty else {"there": F.max(is_stored).over(by("source_key")), "shown": F.max(came).over(by("source_key"))})
        owned = F.col("there") & ~F.coalesce(F.col("found") == F.col("source_key"), no) & F.col("platform_id").isNotNull()
        weak = F.coalesce("ids", no) & ~F.coalesce(F.col("g.kind") == "id", no)
        refused = F.when(came & ~F.col("known"), "UNKNOWN_RESTAURANT").when(came & weak, "IDENTITY_DOWNGRADE")
        every = every.withColumns({"refused": refused, "owned": came & owned})
        every = every.withColumn("target", F.when(is_stored, F.col("source_key")).when(F.col("refused").isNull(), F.coalesce("found", "source_key")))
    # of several records for one target the first counts; a key of another record is refused unless nothing tells that record apart
    every = every.where("target IS NOT NULL OR refused IS NOT NULL").withColumns({"order": F.xxhash64(*(F.col(f"g.{c}") for c in own)), "w": F.when(is_stored, F.struct("s", "shown"))})
    line = by("target").orderBy("tag", "g.at", "order")
    every = every.withColumns({"place": F.row_number().over(line), "next": F.lead("tag").over(line), "w": F.first("w", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, 0))})
    j = every.where("tag = 1 OR next IS NULL").withColumns({"old": F.col("w").isNotNull(), "new": came})
    j = j.withColumn("again", F.col("refused").isNull() & came & (F.col("place") > F.when(F.col("old"), 2).otherwise(1)))
    j = j.select("old", "new", "again", "owned", "refused", F.col("w.shown").alias("s_shown"), "g.clear", *(F.col(f"w.s.{c}").alias(f"s_{c}") for c in columns), *(F.col(f"g.{c}").alias(c) for c in own))
    new = F.col("new")
    cleared = lambda c: F.coalesce(F.array_contains("clear", c), no)

    def value(c: str) -> Column:
        was, got = F.col(f"s_{c}"), F.col(c) if c not in OBSERVED else None
        if c in texts:
            was = F.coalesce(was, F.create_map().cast(_TEXTS))
            others = F.when(F.map_contains_key(was, locale), F.map_filter(was, lambda k, _: k != locale)).otherwise(was)
            put = F.when(F.trim(got) != "", F.map_concat(others, F.create_map(F.lit(locale), got)))
            return F.when(new & cleared(c), others).when(new, F.coalesce(put, was)).otherwise(was).alias(c)
        if c == "active":
            return F.when(new, True).otherwise(was).alias(c)
        if c == "first_seen":
            return F.coalesce(was, now).alias(c)
        if c == "last_seen":
            return F.when(new, now).otherwise(was).alias(c)
        if c in ("restaurant", key):
            return F.when(new, F.coalesce(got, was)).otherwise(was).alias(c)
        return F.when(new & cleared(c), None).when(new, F.coalesce(got, was)).otherwise(was).alias(c)

    rows = j.select(*(value(c) for c in columns), "old", "new", "again", "owned", "refused", "s_shown", F.col(key).isNotNull().alias("named"), *(f"s_{c}" for c in columns))
    told = F.when(new, F.concat_ws(",", *(F.when(~F.coalesce(ok, no), name) for name, ok in rules(table).items())))
    code = F.when(F.col("refused").isNotNull(), F.col("refused")).when(new & (F.col("again") | F.col("owned")), "DUPLICATE_KEY").when(told != "", F.concat(F.lit("VALIDATION_FAILED: "), told))
    same = F.lit(True)
    for c in columns:
        if c not in ("first_seen", "last_seen"):
            # other locales' texts stay as they are
            same = same & (F.col(c)[locale].eqNullSafe(F.col(f"s_{c}")[locale]) if c in texts else F.col(c).eqNullSafe(F.col(f"s_{c}")))
    status = F.when(~new, "kept").when(~F.col("old"), "created").when(same, "unchanged").otherwise("updated")
    rows = rows.withColumn("code", code).withColumn("status", F.when(F.col("code").isNull(), status))
    back = [F.when(F.col("code").isNotNull(), F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    shown = [F.col(key).alias("shown_key"), F.col("restaurant").alias("shown_restaurant")]
    seen = (F.col("code").isNull() & new & F.col("named")) | F.coalesce("s_shown", no)
    # a refused repetition must not bring its stored record a second time
    once = F.col("old") & ~F.col("again")
    return rows.select(*back, *shown, "status", "code", once.alias("old"), seen.alias("seen"), (once & F.coalesce("s_active", no)).alias("was_active"))


def kept(rows: DataFrame, table: str, *more: str) -> DataFrame:
    """The records to be stored."""
    return rows.where("code IS NULL OR old").select(*_columns(SCHEMAS[table]), *more)


class Conflict(Exception):
    """Another batch was written meanwhile."""


class MenuStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.manifests = Folder(spark, f"{self.path}/manifests")

    def _state(self) -> tuple[int, dict]:
        names = self.manifests.names()
        return (int(names[-1]), json.loads(self.manifests.read(names[-1]))) if names else (-1, {t: {} for t in SCHEMAS})

    def _bucket(self, c: str = "restaurant") -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int")

    def _rows(self, state: dict, table: str, buckets: set[int] | None = None) -> DataFrame:
        paths = sorted({p for b, found in state[table].items() if buckets is None or int(b) in buckets for p in found})
        return self.spark.read.schema(SCHEMAS[table]).parquet(*(f"{self.path}/{p}" for p in paths)) if paths else _none(self.spark, table)

    def read(self, table: str) -> DataFrame:
        return self._rows(self._state()[1], table)

    def _publish(self, number: int, state: dict) -> None:
        if not self.manifests.put_new(f"{number:012d}", json.dumps(state)):
            raise Conflict(f"version {number} is taken")

    def write(self, restaurants: DataFrame, categories: DataFrame, items: DataFrame, pages: DataFrame, locale: str, run_id: str, now: str, deactivate: bool = True, attempts: int = 2) -> DataFrame:
        """M14. Returns the rejects (restaurant, entity, source_key, code); the counts are in `runs`. A batch that met another one is worked out again.

        pages: restaurant, complete, items_seen, items_rejected: what each page's parser says of it. Categories and items of restaurants
        that are refused, or that the batch does not have, are refused too (UNKNOWN_RESTAURANT)."""
        for left in range(attempts - 1, -1, -1):
            try:
                return self._written(restaurants, categories, items, pages, locale, run_id, now, deactivate)
            except Conflict:
                if not left:
                    raise

    def _written(self, restaurants, categories, items, pages, locale, run_id, now, deactivate) -> DataFrame:
        number, state = self._state()
        folder = f"data/{uuid.uuid4().hex}"
        at = F.lit(now).cast("timestamp")

        def put(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{self.path}/{folder}/{name}")
            return self.spark.read.parquet(f"{self.path}/{folder}/{name}")

        touched = {r.b for r in restaurants.select(self._bucket().alias("b")).where("b IS NOT NULL").distinct().collect()}  # BUCKETS at most
        stored = {t: self._rows(state, t, touched) if any(state[t].get(str(b)) for b in touched) else None for t in ("restaurants", "categories", "items")}
        rows = {"restaurants": put(merged("restaurants", stored["restaurants"], restaurants, locale, at), "work-restaurants")}
        good = rows["restaurants"].where("code IS NULL AND status <> 'kept'").select("restaurant").distinct()
        for t, came in (("categories", categories), ("items", items)):
            rows[t] = put(merged(t, stored[t], came, locale, at, good), f"work-{t}")
        rejects = None
        for t, df in rows.items():
            refused = df.where("code IS NOT NULL").select(F.col("shown_restaurant").alias("restaurant"), F.lit(t).alias("entity"), F.col("shown_key").alias("source_key"), "code")
            rejects = refused if rejects is None else rejects.union(refused)
        rejects = put(rejects, "rejects")
        judged = self._counts(rows, good, pages).withColumn("allowed", F.lit(deactivate))
        judged = inactive_marking(judged.withColumnsRenamed({"items_seen": "seen", "items_rejected": "rejected"})).withColumnsRenamed({"seen": "items_seen", "rejected": "items_rejected", "applied": "inactive_applied", "reasons": "inactive_reasons"})
        for t in ("categories", "items"):
            judged = judged.withColumn(f"{t}_inactive", F.when(F.col("inactive_applied"), F.col(f"{t}_unseen")).otherwise(0))
        run = judged.withColumns({"run_id": F.lit(run_id), "locale": F.lit(locale), "at": at})
        decided = put(run.select(*(F.col(c.split()[0]).cast(c.split(maxsplit=1)[1]) for c in RUN.split(", "))), "work-decided")
        gone = decided.where("inactive_applied").select("restaurant", F.lit(True).alias("gone"))
        written = {"restaurants": kept(rows["restaurants"], "restaurants"), "runs": decided}
        for t in ("categories", "items"):
            marked = kept(rows[t], t, "seen").join(gone, "restaurant", "left")
            written[t] = marked.withColumn("active", F.col("active") & (F.col("seen") | F.col("gone").isNull())).select(*_columns(SCHEMAS[t]))
        after = {t: dict(state[t]) for t in SCHEMAS}
        for t, df in written.items():
            # a large bucket is written by several tasks
            df.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}/{t}")
            has = {int(n.removeprefix("bucket=")) for n in Folder(self.spark, f"{self.path}/{folder}/{t}").names() if n.startswith("bucket=")}
            for b in touched:
                own = [f"{folder}/{t}/bucket={b}"] if b in has else []
                after[t][str(b)] = after[t].get(str(b), []) + own if t == "runs" else own
        try:
            self._publish(number + 1, after)
        except Conflict:
            Folder(self.spark, f"{self.path}/data").delete(folder.removeprefix("data/"))
            raise
        out = rejects.select("restaurant", "entity", "source_key", "code")
        work = Folder(self.spark, f"{self.path}/{folder}")
        for name in work.names():
            if name.startswith("work-"):
                work.delete(name)
        return out

    @staticmethod
    def _counts(rows: dict, good: DataFrame, pages: DataFrame) -> DataFrame:
        """The counts of each good restaurant, with previous, categories_unseen and items_unseen (active records that its page lacks), downgrade and complete."""
        n = lambda test: F.sum(F.when(test, 1).otherwise(0))
        fine, out = F.col("code").isNull(), good
        for t, df in rows.items():
            told = {f"{t}_{s}": n(fine & (F.col("status") == s)) for s in ("created", "updated", "unchanged")}
            if t != "restaurants":
                # everything on the page counts as seen, refused records too
                told |= {f"{t}_bad": n(~fine), f"{t}_weak": n(F.col("code") == "IDENTITY_DOWNGRADE"), f"{t}_previous": n(F.col("was_active")), f"{t}_unseen": n((fine | F.col("old")) & F.col("active") & ~F.col("seen"))}
            told = df.groupBy(F.col("shown_restaurant").alias("restaurant")).agg(*(x.alias(name) for name, x in told.items()))
            out = out.join(told, "restaurant", "left")
        out = out.join(pages.select("restaurant", "complete", "items_seen", F.col("items_rejected").alias("unread")), "restaurant", "left").fillna(0).fillna(False, ["complete"])
        return out.withColumns({"categories_rejected": F.col("categories_bad"), "items_rejected": F.col("items_bad") + F.col("unread"), "previous": F.col("items_previous"), "downgrade": F.col("categories_weak") + F.col("items_weak") > 0})
