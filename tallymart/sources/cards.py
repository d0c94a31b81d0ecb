"""Cards anywhere in the state that a listing page embeds, one row for each place, with its badges.

A card is any object with the card's key, at any depth, cards within cards included, in the order of the page. VARIANT sorts the keys of
objects, and badges count in the order of the page, so a page's state is walked in Python (one page at a time, its cards handed
on before the next, without recursion, only pages that name the key at all); what cards of one id have in common is put together by Spark.

A page that is null, without a state or with one that is no JSON, or nested deeper than the JSON reader goes, has no cards.
Other columns play no part; pages that come twice under one key are one page with all their cards.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from tallymart.functions.item_text import promotion
from tallymart.sources.menu_pages import STATE

#: What marks a card, where it leads and what its badges are.
CARD_KEY, TAP_END, PARAMETERS = "partner-name.content", "on-tap", ("action", "parameters")
ID_KEY, PATH_KEY = "restaurant_id", "restaurant_href"
BADGE = "^promotional-.*label\\.content$"
CARD = pa.struct([*((f, pa.string()) for f in ("id", "name", "href")), ("badges", pa.list_(pa.string()))])
#: Cards that are handed over at once.
MOST_CARDS = 2000


def _nodes(root) -> Iterator[dict]:
    """Objects of a tree, each before what is in it."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        if isinstance(node, dict):
            yield node
            waiting.extend(reversed(node.values()))
        elif isinstance(node, list):
            waiting.extend(reversed(node))


def _card(node: dict) -> dict | None:
    tap = next((v for k, v in node.items() if k.endswith(TAP_END)), None)
    for step in PARAMETERS:
        tap = tap.get(step) if isinstance(tap, dict) else None
    found = tap if isinstance(tap, dict) else {}
    own, href = found.get(ID_KEY), found.get(PATH_KEY)
    if isinstance(own, bool) or not isinstance(own, (str, int, float)):
        return None
    own = int(own) if isinstance(own, float) and own.is_integer() else own
    badges = [v for k, v in node.items() if re.search(BADGE, k) and isinstance(v, str)]
    return {"id": str(own), "name": node[CARD_KEY], "href": href if isinstance(href, str) else None, "badges": badges}


def _of(state: str) -> list[dict]:
    try:
        tree = json.loads(state)
    except (TypeError, ValueError, RecursionError):
        return []
    return [c for c in map(_card, (n for n in _nodes(tree) if isinstance(n.get(CARD_KEY), str))) if c]


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, at and card of each card of (key, state); a task holds one page's tree and MOST_CARDS cards beside its batch."""
    for batch in batches:
        keys, held = batch.column(0), []
        names = [batch.schema.names[0], "at", "card"]
        kind = pa.schema([(names[0], keys.type), ("at", pa.int32()), ("card", CARD)])
        for i, state in enumerate(batch.column(1)):
            key = keys[i].as_py()
            for at, card in enumerate(_of(state.as_py())):
                held.append({names[0]: key, "at": at, "card": card})
                if len(held) >= MOST_CARDS:
                    yield pa.RecordBatch.from_pylist(held, kind)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, kind)


def clean_label(label: Column) -> Column:
    """Without marks of direction, white space folded."""
    bare = F.regexp_replace(label, "[\\u200E\\u200F\\u202A-\\u202E]", "")
    return F.trim(F.regexp_replace(bare, "[\\s\\u00A0]+", " "))


def listed_places(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, at (its first card's place), id, name and path (of the first card), labels (distinct ones of all its cards, in their order)."""
    states = pages.where(F.contains(F.col(html), F.lit(CARD_KEY))).select(key, F.regexp_extract(html, STATE, 1).alias("state"))
    told = T.StructType([states.schema[key], T.StructField("at", T.IntegerType()), T.StructField("card", from_arrow_type(CARD))])
    cards = states.mapInArrow(_placed, told)
    labels = F.filter(F.transform("card.badges", clean_label), lambda x: x != "")
    rows = cards.select(key, F.col("card.id").alias("id"), "at", clean_label(F.col("card.name")).alias("name"), F.substring_index("card.href", "?", 1).alias("path"), labels.alias("labels"))
    every = F.transform(F.array_sort(F.collect_list(F.struct("at", "labels"))), lambda x: x["labels"])  # of the cards of one place on one page
    found = rows.groupBy(key, "id").agg(F.min("at").alias("at"), F.min_by("name", "at").alias("name"), F.min_by("path", "at").alias("path"), F.array_distinct(F.flatten(every)).alias("labels"))
    return found.select(key, "at", "id", "name", "path", "labels")


def listed_offers(places: DataFrame, key: str = "page_id") -> DataFrame:
    """T43 for each label of listed places: key, id, place (among the labels), type, percentage, minimum, maximum, title."""
    rows = places.select(key, "id", F.posexplode("labels").alias("place", "label"))
    return rows.select(key, "id", "place", promotion(F.col("label")).alias("o")).select(key, "id", "place", "o.type", "o.percentage", "o.minimum", "o.maximum", "o.title")
