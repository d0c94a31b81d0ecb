"""Distances and cells on the sphere, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0


def distance_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Haversine."""
    dlat, dlng = F.radians(lat2 - lat1) / 2, F.radians(lng2 - lng1) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlng), 2)
    return 2 * EARTH_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def valid(lat: Column, lng: Column) -> Column:
    """Finite, in range, and not the origin, which stands for no pin; false for null."""
    fine = (F.abs(lat) <= 90) & (F.abs(lng) <= 180) & ~F.isnan(lat) & ~F.isnan(lng) & ~((lat == 0) & (lng == 0))
    return F.coalesce(fine, F.lit(False))


def cell(lat: Column, lng: Column, degrees: float) -> tuple[Column, Column]:
    return F.floor(lat / degrees).cast("long"), F.floor(lng / degrees).cast("long")


def near_pairs(left, right, metres: float, keys: str | None = None, carry: tuple[str, ...] = ()):
    """Pairs of rows (id, lat, lng) within `metres`, by an equi-join on cells: each left row visits its cell and the eight around.
    `keys`, an array column of both: only pairs that share an element, which meet by it too, each pair at the first one that both have.
    `carry`: columns of both that go along, as structs s and t.

    Cells are bands of latitude as high as `metres`, each cut into equal cells that are at least as wide there, around the
    whole circle; so nothing is lost at any latitude, at the poles or at the date line. A null pin is near nothing."""
    high = metres / EARTH_M * 180 / math.pi * 1.001
    band = lambda lat: F.floor(lat / high).cast("long")

    def around(y):  # cells of a band: none of them narrower than `metres` at its end nearer to a pole, or a band beyond
        far = F.least(F.greatest(F.abs(y), F.abs(y + 1)) * high + high, F.lit(89.999))
        return F.greatest(F.floor(360 / high * F.cos(F.radians(far))), F.lit(1)).cast("long")

    place = lambda lng, n: F.pmod(F.floor((lng + 180) / 360 * n).cast("long"), n)
    steps = F.array(*[F.lit(i).cast("long") for i in (-1, 0, 1)])
    own = lambda s, k: [*([F.array_distinct(F.array_compact(keys)).alias(k)] if keys else []), *([F.struct(*carry).alias(s)] if carry else [])]
    kept = lambda s, k: [*([k, "key"] if keys else []), *([s] if carry else [])]
    by_key = lambda df, k: df.withColumn("key", F.explode(k)) if keys else df
    rows = left.select(F.col("id").alias("id1"), F.col("lat").alias("lat1"), F.col("lng").alias("lng1"), *own("s", "k1"), F.explode(F.transform(steps, lambda d: band(F.col("lat")) + d)).alias("y"))
    n = around(F.col("y"))
    cells = F.array_distinct(F.transform(steps, lambda d: F.pmod(place(F.col("lng1"), n) + d, n)))
    rows = by_key(rows, "k1").select("id1", "lat1", "lng1", "y", *kept("s", "k1"), F.explode(cells).alias("x"))
    y = band(F.col("lat"))
    there = right.select(F.col("id").alias("id2"), F.col("lat").alias("lat2"), F.col("lng").alias("lng2"), y.alias("y"), place(F.col("lng"), around(y)).alias("x"), *own("t", "k2"))
    pairs = rows.join(by_key(there, "k2"), ["x", "y", *(["key"] if keys else [])])
    if keys:
        pairs = pairs.where(F.get(F.array_intersect("k1", "k2"), F.lit(0)) == F.col("key"))
    pairs = pairs.withColumn("metres", distance_m(F.col("lat1"), F.col("lng1"), F.col("lat2"), F.col("lng2")))
    return pairs.where(F.col("metres") <= metres).select("id1", "id2", "metres", *(("s", "t") if carry else ()))


BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def geohash(lat: Column, lng: Column, length: int = 6) -> Column:
    """Bits of longitude and latitude in turn, five to a character."""
    bits = 5 * length
    of_lng, of_lat = (bits + 1) // 2, bits // 2
    x = F.least(F.floor((lng + 180) / 360 * (1 << of_lng)), F.lit((1 << of_lng) - 1)).cast("long")
    y = F.least(F.floor((lat + 90) / 180 * (1 << of_lat)), F.lit((1 << of_lat) - 1)).cast("long")

    def bit(i: int) -> Column:
        return F.shiftright(y, of_lat - 1 - i // 2).bitwiseAND(1) if i % 2 else F.shiftright(x, of_lng - 1 - i // 2).bitwiseAND(1)

    def character(k: int) -> Column:
        code = sum((bit(5 * k + j) * (1 << (4 - j)) for j in range(1, 5)), bit(5 * k) * 16)
        return F.substring(F.lit(BASE32), (code + 1).cast("int"), F.lit(1))

    return F.concat(*[character(k) for k in range(length)])
