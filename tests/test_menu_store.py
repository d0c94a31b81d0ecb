"""Menus written to four tables at once."""

import tempfile

import pytest

from tallymart.operators import menu_store
from tallymart.operators.menu_store import Conflict, MenuStore

R = "restaurant string, platform string, platform_id string, name string, url string, currency string, lat double, lng double"
C = "restaurant string, source_key string, kind string, platform_id string, name string, sort_order int, at int"
I = "restaurant string, source_key string, kind string, platform_id string, category_key string, name string, description string, price double, original_price double, currency string, image_url string, available boolean, at int, clear array<string>"  # noqa: E741
P = "restaurant string, complete boolean, items_seen int, items_rejected int"


def item(r, key, name="n", price=1.0, kind="anchor", pid=None, **more):
    row = {"restaurant": r, "source_key": key, "kind": kind, "platform_id": pid, "category_key": None, "name": name, "description": None, "price": price, "original_price": None, "currency": "AED", "image_url": None, "available": None, "at": 0, "clear": None}
    return tuple((row | more).values())


@pytest.fixture
def store(spark):
    return MenuStore(spark, f"file://{tempfile.mkdtemp(prefix='spark-')}/menus", buckets=4)


def batch(spark, restaurants, categories=(), items=(), pages=None):
    made = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    named = [(r, "d", None, n, f"https://x/{r}", "AED", None, None) if not isinstance(r, tuple) else r for r, n in restaurants]
    told = pages if pages is not None else [(r[0], True, sum(i[0] == r[0] for i in items), 0) for r in named]
    return made(named, R), made(categories, C), made(items, I), made(told, P)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def run_of(store, run_id):
    return {r.restaurant: r for r in store.read("runs").where(f"run_id = '{run_id}'").collect()}


def test_first_and_second_write(spark, store):
    assert store.read("items").count() == 0
    cats = [("a", "c1", "id", "1", "Mains", 0, 0), ("b", "c1", "anchor", None, "Tea", 0, 0)]
    one = [item("a", "i1", "Soup", 5.0, "id", "11", category_key="c1", description="hot"), item("a", "i2", "Bread"), item("b", "i1", "Tea", 2.0)]
    assert store.write(*batch(spark, [("a", "A"), ("b", "B")], cats, one), "en", "r1", "2024-01-01").count() == 0
    runs = run_of(store, "r1")
    assert (runs["a"].restaurants_created, runs["a"].categories_created, runs["a"].items_created, runs["a"].items_inactive, runs["a"].inactive_applied) == (1, 1, 2, 0, True)
    # the other language of one restaurant: i1 under another key but with its id, i2 gone, i3 new
    two = [item("a", "i1-ar", "شوربة", 6.0, "id", "11", clear=["description"]), item("a", "i3", "خبز", 1.0, "id", "13")]
    store.write(*batch(spark, [("a", "ا")], [("a", "c1", "id", "1", "Mains", 0, 0)], two), "ar", "r2", "2024-01-02")
    runs = run_of(store, "r2")
    assert set(runs) == {"a"} and (runs["a"].restaurants_updated, runs["a"].categories_updated, runs["a"].items_created, runs["a"].items_updated, runs["a"].items_inactive) == (1, 1, 1, 1, 1)
    got = {r.source_key: r for r in store.read("items").where("restaurant = 'a'").collect()}
    assert got["i1-ar"].name == {"en": "Soup", "ar": "شوربة"} and got["i1-ar"].description == {"en": "hot"} and (got["i1-ar"].price, got["i1-ar"].category_key) == (6.0, "c1")
    assert {k: r.active for k, r in got.items()} == {"i1-ar": True, "i2": False, "i3": True}
    assert (str(got["i1-ar"].first_seen)[:10], str(got["i1-ar"].last_seen)[:10], str(got["i2"].last_seen)[:10]) == ("2024-01-01", "2024-01-02", "2024-01-01")
    assert rows(store.read("items").where("restaurant = 'b'"), "source_key", "active") == [("i1", True)]
    store.write(*batch(spark, [("a", "ا")], [("a", "c1", "id", "1", "Mains", 0, 0)], two), "ar", "r3", "2024-01-03")
    assert (run_of(store, "r3")["a"].items_unchanged, run_of(store, "r3")["a"].restaurants_unchanged, run_of(store, "r3")["a"].items_updated) == (2, 1, 0)


def test_refused_records(spark, store):
    store.write(*batch(spark, [("a", "A")], [], [item("a", "i1", kind="id", pid="1"), item("a", "i2", kind="id", pid="2"), item("a", "k3")]), "en", "r1", "2024-01-01")
    came = [
        item("a", "i1", "one", kind="id", pid="1"), item("a", "again", "second", kind="id", pid="1", at=1),  # one record twice
        item("a", "k3", "takes a key", kind="id", pid="9"), item("a", "i9", "", 1.0, "id", "8"), item("a", "i8", "dear", -1.0, "id", "7"), item("a", "i7", "odd", 5.0, "id", "6", original_price=4.0, currency="aed"),
        item("a", "weak"), item("x", "i1"), item("bad", "i1"),
    ]
    got = store.write(*batch(spark, [("a", "A"), ("bad", "")], [], came), "en", "r2", "2024-01-02")
    assert rows(got, "restaurant", "entity", "source_key", "code") == sorted([
        ("a", "items", "again", "DUPLICATE_KEY"), ("a", "items", "k3", "DUPLICATE_KEY"), ("a", "items", "i9", "VALIDATION_FAILED: name"), ("a", "items", "i8", "VALIDATION_FAILED: price"),
        ("a", "items", "i7", "VALIDATION_FAILED: original_price,currency"), ("a", "items", "weak", "IDENTITY_DOWNGRADE"), ("x", "items", "i1", "UNKNOWN_RESTAURANT"), ("bad", "items", "i1", "UNKNOWN_RESTAURANT"), ("bad", "restaurants", "bad", "VALIDATION_FAILED: name"),
    ], key=str)
    assert rows(store.read("items"), "source_key", "name", "active") == [("i1", {"en": "one"}, True), ("i2", {"en": "n"}, True), ("k3", {"en": "n"}, True)]
    run = run_of(store, "r2")
    assert set(run) == {"a"} and run["a"].items_rejected == 6 and run["a"].inactive_reasons == ["IDENTITY_DOWNGRADE", "TOO_MANY_REJECTED_ITEMS"]


def test_incomplete_pages_take_nothing_away(spark, store):
    some = [item("a", f"i{k}") for k in range(4)]
    store.write(*batch(spark, [("a", "A")], [], some), "en", "r1", "2024-01-01")
    for run_id, told, reasons in (("r2", ("a", False, 1, 0), ["INCOMPLETE", "SUSPICIOUS_ITEM_DROP"]), ("r3", ("a", True, 0, 0), ["NO_ITEMS", "SUSPICIOUS_ITEM_DROP"])):
        store.write(*batch(spark, [("a", "A")], [], some[:1], [told]), "en", run_id, "2024-01-02")
        assert run_of(store, run_id)["a"].inactive_reasons == reasons and store.read("items").where("active").count() == 4
    store.write(*batch(spark, [("a", "A")], [], some[:2]), "en", "r4", "2024-01-02", deactivate=False)
    assert store.read("items").where("active").count() == 4
    store.write(*batch(spark, [("a", "A")], [], some[:2]), "en", "r5", "2024-01-02")
    assert store.read("items").where("active").count() == 2


def test_a_killed_run_leaves_the_old_state(spark, store, monkeypatch):
    store.write(*batch(spark, [("a", "A")], [], [item("a", "i1")]), "en", "r1", "2024-01-01")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(MenuStore, "_publish", killed)  # all tables are written, the manifest is not
        with pytest.raises(KeyboardInterrupt):
            store.write(*batch(spark, [("a", "Z"), ("b", "B")], [], [item("a", "i2"), item("b", "i1")]), "en", "r2", "2024-01-02")
    with monkeypatch.context() as m:
        m.setattr(menu_store, "kept", killed)  # some tables are written
        with pytest.raises(KeyboardInterrupt):
            store.write(*batch(spark, [("a", "Z")], [], [item("a", "i2")]), "en", "r2", "2024-01-02")
    assert rows(store.read("restaurants"), "restaurant", "name") == [("a", {"en": "A"})] and rows(store.read("items"), "source_key") == [("i1",)] and set(run_of(store, "r2")) == set()
    store.write(*batch(spark, [("b", "B")], [], [item("b", "i1")]), "en", "r3", "2024-01-03")
    assert rows(store.read("items"), "restaurant", "source_key") == [("a", "i1"), ("b", "i1")]


def test_two_writers(spark, store, monkeypatch):
    store.write(*batch(spark, [("a", "A")], [], [item("a", "i1")]), "en", "r1", "2024-01-01")
    plain, met = MenuStore._publish, []

    def late(self, number, state):
        if not met:  # another batch comes first
            met.append(1)
            MenuStore(spark, store.path, 4).write(*batch(spark, [("a", "A")], [], [item("a", "i1"), item("a", "i2")]), "en", "other", "2024-01-02")
        plain(self, number, state)

    monkeypatch.setattr(MenuStore, "_publish", late)
    store.write(*batch(spark, [("a", "A")], [], [item("a", "i1"), item("a", "i3")]), "en", "mine", "2024-01-03")
    assert rows(store.read("items"), "source_key", "active") == [("i1", True), ("i2", False), ("i3", True)] and run_of(store, "mine")["a"].items_inactive == 1
    met.clear()
    with pytest.raises(Conflict):
        store.write(*batch(spark, [("a", "A")], [], [item("a", "i4")]), "en", "lost", "2024-01-04", attempts=1)
    assert not run_of(store, "lost")
