"""Validators of nine kinds of documents: a good one of each kind, and what changes to it are told as, worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from tallymart.operators import validators

DAY, LATER, ID, OTHER = "2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z", "0" * 24, "a" * 24
KEY = "talabat:restaurant:id:9"
SEEN = {"lastRunIdByLocale": {"en": "run-1"}, "firstSeenAt": DAY, "createdAt": DAY, "updatedAt": LATER}
OF = {"platform": "talabat", "restaurantId": ID, "restaurantSourceKey": KEY}
GONE = object()

GOOD = {
    "restaurant": {"platform": "talabat", "platformRestaurantId": "9", "sourceKeyKind": "id", "sourceKey": KEY, "name": {"en": "A"}, "url": {"ar": "https://t.com/a"}, "cuisines": ["x"], "tags": [], "offers": [], "currency": "AED", "isActive": True,
                   "location": {"lat": 1.5}, "lastScrapedAtByLocale": {"ar": DAY}, **SEEN},
    "category": {**OF, "sourceKeyKind": "position", "sortOrder": 3, "sourceKey": KEY + ":category:pos:3", "name": {"en": "A"}, "isActive": False, "lastScrapedAtByLocale": {}, **SEEN},
    "item": {**OF, "sourceKeyKind": "anchor", "sourceKey": KEY + ":item:anchor:a%2Fb", "name": {"en": "A"}, "sourceUrl": {"en": "https://t.com/a"}, "price": 5, "originalPrice": 5.5, "currency": "AED", "isAvailable": False, "isActive": True, "dietaryTags": [],
             "modifiers": [{"name": {"en": "g"}, "options": [{"name": {"ar": "o"}, "priceDelta": -1}]}], "lastSeenAtByLocale": {}, "lastSeenAt": DAY, **SEEN},
    "modifiers": {"name": {"en": "g"}, "required": True, "minSelections": 1, "maxSelections": 2, "options": [{"name": {"en": "o"}, "currency": "AED", "isAvailable": True}]},
    "run": {"runId": "run-00001", "platform": "careem", "locale": "ar", "targetType": "listing", "trigger": "queue", "status": "failed", "targetUrl": "http://t.com", "dryRun": False, "startedAt": DAY, "finishedAt": LATER, "durationMs": 10,
            "counts": dict.fromkeys(validators.COUNTS, 0), "errors": [{"stage": "s", "code": "c", "message": "m"}], "fetch": {"statusCode": 200, "attempts": 1}, "createdAt": DAY, "updatedAt": DAY},
    "group": {"canonicalName": {"en": "A"}, "city": "Dubai", "location": {"lat": 90, "lng": -180}, "status": "active", "identityStatus": "auto", "seedRestaurantId": ID, "signals": {"names": ["a"], "brands": []}, "createdAt": DAY, "updatedAt": DAY},
    "mapping": {"restaurantId": ID, "platform": "talabat", "restaurantSourceKey": KEY, "matchStatus": "MATCHED", "matchMethod": "SEED", "decidedBy": "manual", "canonicalRestaurantGroupId": ID, "isActive": True, "confidence": 1,
                "evidence": {"signals": ["NAME_EXACT"], "conflicts": ["LOCATION_FAR"], "reason": "r"}, "createdAt": DAY, "updatedAt": DAY},
    "canonical": {"restaurantGroupId": ID, "seedMenuItemId": OTHER, "seedRestaurantId": ID, "identityKey": f"seed:{ID}:{OTHER}", "seedPlatform": "talabat", "canonicalName": {"en": "A"}, "aliases": ["a"], "searchKeywords": ["k"] * 150,
                  "variant": {"quantity": 0.5, "unit": "l", "label": {"en": "x"}}, "status": "inactive", "identityStatus": "review", "signals": {"normalizedNames": ["a"], "normalizedDescriptions": [], "normalizedCategories": []}, "createdAt": DAY, "updatedAt": DAY},
    "item_mapping": {"restaurantGroupId": ID, "menuItemId": ID, "restaurantId": ID, "platform": "talabat", "matchStatus": "MATCHED", "canonicalItemId": OTHER, "matchMethod": "IMPORT", "decidedBy": "import", "isActive": True, "confidence": 1.0,
                     "evidence": {"nameScore": 1, "reasons": ["A1"], "conflicts": [], "candidateCanonicalItemIds": [ID]}, "note": "n", "decidedAt": DAY, "createdAt": DAY, "updatedAt": DAY},
}

#: kind, fields that change, issues
CASES = [
    ("restaurant", {"platform": "x", "name": GONE, "currency": "aed"}, ["platform must be a supported dining platform", "name is required", "currency must be an ISO 4217 code (e.g. AED)"]),
    ("restaurant", {"sourceKeyKind": "anchor"}, ['sourceKeyKind must be "id" when platformRestaurantId is present', 'slug is required when sourceKeyKind is "anchor"']),
    ("restaurant", {"platformRestaurantId": "a b"}, ["platformRestaurantId must not contain whitespace (display names are not identities)", "sourceKey restaurant id must not contain whitespace (display names are not identities)"]),
    ("restaurant", {"platformRestaurantId": "a:b"}, ["sourceKey does not match the identity fields (expected talabat:restaurant:id:a%3Ab)"]),
    ("restaurant", {"name": {"en": " ", "fr": "x", "de": "y"}}, ["name.de is not a supported locale (en, ar)", "name.fr is not a supported locale (en, ar)", "name.en must not be empty", "name.en must not have leading/trailing whitespace"]),
    ("restaurant", {"name": {}, "brandName": "x", "description": {"ar": "y" * 5001}}, ["name must contain at least one locale", "brandName must be a LocalizedText object { en?, ar? }", "description.ar must be at most 5000 characters"]),
    ("restaurant", {"url": {"en": "https://u:p@t.com/?token=1", "ar": "nowhere"}}, ["url.en must not contain credentials", "url.en must not contain secret query parameters", "url.ar must be an absolute URL"]),
    ("restaurant", {"url": {"en": "https://api.scrape.do/x"}, "imageUrl": 5}, ["url.en must be the platform URL, not a Scrape.do request URL", "imageUrl must be a URL string"]),
    ("restaurant", {"cuisines": ["a", 1, ""], "tags": None, "rating": "5", "ratingCount": 1.5}, ["cuisines[1] must be a string", "cuisines[2] must not be empty", "tags must be an array of strings", "rating must be a finite number", "ratingCount must be an integer"]),
    ("restaurant", {"deliveryTimeMin": 5, "deliveryTimeMax": 4, "location": {"lat": -91, "city": "c "}, "isActive": None}, ["deliveryTimeMin must not exceed deliveryTimeMax", "isActive must be a boolean", "location.city must not have leading/trailing whitespace", "location.lat must be >= -90"]),
    ("restaurant", {"lastScrapedAtByLocale": {"en": "today", "xx": 1}, "updatedAt": "2023-01-01T00:00:00Z", "_id": "x"}, ["_id must be an ObjectId", "lastScrapedAtByLocale.xx is not a supported locale (en, ar)", "lastScrapedAtByLocale.en must be a valid Date", "updatedAt must not be earlier than createdAt"]),
    ("category", {"sortOrder": 4}, ["sourceKey does not match the identity fields (expected talabat:restaurant:id:9:category:pos:4)"]),
    ("category", {"sortOrder": 100001}, ["sourceKey category position must be an integer between 0 and 100000"]),
    ("category", {"sourceKeyKind": "anchor"}, ["sourceKey must be an anchor category key under restaurantSourceKey"]),
    ("category", {"sourceKeyKind": "anchor", "sourceKey": KEY + ":category:anchor:x"}, []),
    ("category", {"restaurantSourceKey": KEY + ":category:id:1"}, ["restaurantSourceKey must be a valid restaurant sourceKey"]),
    ("category", {"platform": "careem", "platformRestaurantId": "8"}, ["restaurantSourceKey must belong to the same platform", "platformRestaurantId does not match restaurantSourceKey"]),
    ("item", {"sourceKey": KEY + ":category:id:1:item:pos:2", "sourceKeyKind": "position"}, ['categoryId is required when sourceKeyKind is "position"']),
    ("item", {"sourceKey": KEY + ":category:id:1:item:pos:02", "sourceKeyKind": "position", "categoryId": ID}, [f"sourceKey does not match the identity fields (expected {KEY}:category:id:1:item:pos:2)"]),
    ("item", {"sourceKey": KEY + ":item:anchor:a/b"}, ["sourceKey must be an anchor item key under restaurantSourceKey"]),
    ("item", {"platformItemId": "7", "sourceKeyKind": "id"}, [f"sourceKey does not match the identity fields (expected {KEY}:item:id:7)"]),
    ("item", {"price": GONE, "originalPrice": 100001}, ["price is required", "originalPrice must be <= 100000"]),
    ("item", {"price": 6, "availabilityStatus": "unknown"}, ["originalPrice must not be lower than price", 'isAvailable must be absent when availabilityStatus is "unknown"']),
    ("item", {"availabilityStatus": "available", "calories": -1}, ['isAvailable must be true when availabilityStatus is "available"', "calories must be >= 0"]),
    ("item", {"modifiers": [{"name": {"en": "g"}, "options": []}, 7, {"name": {"en": "g"}, "options": [{}, {"name": {"en": "o"}, "priceDelta": "x"}]}]},
     ["modifiers[0].options must be a non-empty array", "modifiers[1] must be an object", "modifiers[2].options[0].name is required", "modifiers[2].options[1].priceDelta must be a finite number"]),
    ("item", {"modifiers": {}, "isAvailable": GONE}, ["isAvailable is required", "modifiers must be an array"]),
    ("modifiers", {"minSelections": 0, "maxSelections": 0, "groupId": "كباب"}, ["groupId must not contain Arabic text (translated names are not identities)", "maxSelections must be >= 1", "minSelections must be >= 1 when the group is required"]),
    ("modifiers", {"minSelections": 3, "options": None}, ["minSelections must not exceed maxSelections", "options must be a non-empty array"]),
    ("run", {"runId": "short", "status": "running", "errors": []}, ["runId must be 8–128 characters of [A-Za-z0-9._:-]", "finishedAt must be absent while the run is running"]),
    ("run", {"finishedAt": "2023-01-01T00:00:00Z", "errors": []}, ["finishedAt must not be earlier than startedAt", "errors must contain at least one entry for a failed run"]),
    ("run", {"counts": {"itemsSeen": 1.5}, "errors": [1] * 201}, [f"counts.{n} is required" if n != "itemsSeen" else "counts.itemsSeen must be an integer" for n in validators.COUNTS] + ["errors must contain at most 200 entries"] + [f"errors[{i}] must be an object" for i in range(201)]),
    ("run", {"errors": [{"stage": "s", "code": "", "message": "a?api_key=1"}], "fetch": {"statusCode": 99, "finalUrl": "ftp://x"}},
     ["errors[0].code must not be empty", "errors[0].message must not contain secret query parameters", "fetch.statusCode must be >= 100", "fetch.finalUrl must use http or https"]),
    ("group", {"city": " ", "location": {"lat": 91}, "signals": {"names": ["", "a"]}, "price": None, "url": "x"},
     ["city must be a non-empty string of at most 100 characters", "location.lat must be a latitude", "signals.names must be an array of non-empty strings", "signals.brands must be an array of non-empty strings",
      "url platform-specific data does not belong on a canonical group", "price platform-specific data does not belong on a canonical group"]),
    ("mapping", {"matchStatus": "REJECTED", "canonicalRestaurantGroupId": GONE, "confidence": 1.1}, ["canonicalRestaurantGroupId is required when REJECTED", "isActive must be false exactly when REJECTED", "confidence must be between 0 and 1"]),
    ("mapping", {"matchStatus": "UNMATCHED", "matchMethod": GONE, "evidence": {"signals": ["X"], "conflicts": []}}, ["canonicalRestaurantGroupId must be absent while UNMATCHED", "evidence.signals contains an unknown signal"]),
    ("mapping", {"matchStatus": "UNMATCHED", "matchMethod": GONE, "canonicalRestaurantGroupId": GONE}, []),
    ("canonical", {"identityKey": "seed", "searchKeywords": ["k"] * 151, "variant": {"quantity": 0, "size": " ", "label": {}}, "isActive": True},
     ["identityKey does not match restaurantGroupId + seedMenuItemId", "searchKeywords must have at most 150 entries", "variant.quantity must be a positive number", "variant.size must be a non-empty string", "variant.label must contain at least one locale",
      "isActive platform-specific data does not belong on a canonical item"]),
    ("item_mapping", {"matchStatus": "UNMATCHED"}, ["canonicalItemId must be absent while UNMATCHED", "matchMethod must be absent while UNMATCHED"]),
    ("item_mapping", {"isActive": False, "confidence": 0.5, "evidence": {"reasons": ["a"], "conflicts": [], "nameScore": 2, "candidateCanonicalItemIds": ["x"]}},
     ["supersededAt is required on an inactive (superseded) mapping", "confidence must be 1 for IMPORT", "evidence.nameScore must be between 0 and 1", "evidence.reasons must be an array of UPPER_SNAKE codes", "evidence.candidateCanonicalItemIds must be an array of ObjectIds"]),
    ("item_mapping", {"supersededAt": DAY, "note": "", "name": {"en": "x"}}, ["supersededAt must be absent on an active mapping", "note must be a non-empty string of at most 500 characters", "name platform data does not belong on an item mapping"]),
]


@pytest.mark.parametrize("kind", sorted(GOOD))
def test_issues(spark, kind):
    cases = [(-1, GOOD[kind], [])] + [(i, {k: v for k, v in {**GOOD[kind], **change}.items() if v is not GONE}, told) for i, (of, change, told) in enumerate(CASES) if of == kind]
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d, _ in cases] + [(1000, "[]"), (1001, None)], "id int, json string").withColumn("doc", F.parse_json("json"))
    found = {r.id: [f"{x.path} {x.message}" for x in r.issues] for r in validators.validated(rows, validators.KINDS[kind]).collect()}
    assert found == {i: told for i, _, told in cases} | {1000: ["$ must be an object"], 1001: ["$ must be an object"]}


def test_rows_and_columns(spark):
    rows = spark.createDataFrame([("a", "[]", 1), ("a", "[]", 2)], "id string, json string, issues int").withColumn("doc", F.parse_json("json"))
    assert sorted(tuple(r) for r in validators.issue_rows(rows, validators.GROUP, "id").collect()) == [("a", 0, "$", "must be an object")] * 2
    assert validators.validated(rows, validators.GROUP, out="found").columns == ["id", "json", "issues", "doc", "found"]
    assert validators.issue_rows(rows.limit(0), validators.ITEM, "id").collect() == []
