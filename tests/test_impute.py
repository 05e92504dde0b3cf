import random

import pytest

from tallyhawk.operators import impute
from tallyhawk.settings import SkewPolicy

SCHEMA = "trans_num string, merch_lat double, merch_long double, merch_zipcode string"


def nearest(rows):
    known = [r for r in rows if r[3] is not None and r[1] is not None]
    out = {}
    for name, lat, long, zip_ in rows:
        if zip_ is None and lat is not None and known:
            d = min((lat - k[1]) ** 2 + (long - k[2]) ** 2 for k in known)
            zip_ = min(k[3] for k in known if (lat - k[1]) ** 2 + (long - k[2]) ** 2 == d)
        out[name] = zip_
    return out


def check(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.trans_num: r for r in impute.fill_merchant_zip(df, **settings).collect()}
    wanted = nearest(rows)
    assert {n: r.merch_zipcode for n, r in found.items()} == wanted
    assert all(found[r[0]].merch_zipcode_missing == (r[3] is None) for r in rows)


def make(n, seed, place, missing=0.3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lat, long = place(rnd)
        rows.append((str(i), lat, long, None if rnd.random() < missing else f"{rnd.randrange(99999):05d}"))
    return rows


def test_spread_places(spark):
    check(spark, make(400, 1, lambda r: (r.uniform(-89, 89), r.uniform(-179, 179))))


def test_crowded_town_and_lone_places(spark, monkeypatch):
    # A low limit forces cells to be split several times.
    monkeypatch.setattr(impute, "CROWDED", 4)

    def place(r):
        if r.random() < 0.7:
            return 40.7 + r.gauss(0, 0.002), -74 + r.gauss(0, 0.002)
        return r.uniform(38, 44), r.uniform(-78, -70)

    rows = make(500, 2, place)
    # A third of all rows are copies of one place, some without a zip code.
    rows += [(f"c{i}", 40.7, -74.0, None if i % 2 else f"{i:05d}") for i in range(250)]
    check(spark, rows, policy=SkewPolicy(hot_rows=20, salts=4))


def test_equally_near_places_give_the_smallest_zip(spark):
    check(spark, [("a", 10.0, 10.0, None), ("b", 10.0, 11.0, "00002"), ("c", 11.0, 10.0, "00001"),
                  ("d", 9.0, 10.0, "00003")])


def test_nothing_known_and_missing_coordinates(spark):
    check(spark, [("a", 1.0, 1.0, None), ("b", None, None, None)])
    check(spark, [("a", 1.0, 1.0, None), ("b", None, None, None), ("c", None, None, "00009"),
                  ("d", 5.0, 5.0, "00007")])


def test_sides_nest():
    ratios = [a / b for a, b in zip(impute.SIDES, impute.SIDES[1:])]
    assert all(r == int(r) and int(r) & (int(r) - 1) == 0 for r in ratios)
    assert impute.SIDES[0] > 360


def test_place_in_an_empty_region(spark):
    check(spark, [("a", -80.0, 170.0, None)] + [(f"k{i}", 40.0 + i / 1000, -74.0, f"{i:05d}")
                                               for i in range(200)])


def test_places_off_the_globe_and_no_numbers(spark, monkeypatch):
    monkeypatch.setattr(impute, "CROWDED", 3)
    nan, inf = float("nan"), float("inf")

    def place(r):
        spots = [(40.0, -200.0), (-95.0, -100.0), (1e6, 3e7), (-4e5, 20.0), (421.9, 331.9), (422.1, 332.1)]
        if r.random() < 0.5:
            lat, long = r.choice(spots)
            return lat + r.gauss(0, 5), long + r.gauss(0, 5)
        return r.uniform(-89, 89), r.uniform(-179, 179)

    rows = make(220, 5, place)
    check(spark, rows)
    odd = [("n1", nan, 1.0, None), ("n2", 1.0, nan, "99999"), ("n3", inf, 1.0, None)]
    got = {r.trans_num: r.merch_zipcode for r in impute.fill_merchant_zip(spark.createDataFrame(rows + odd, SCHEMA)).collect()}
    assert got["n1"] is None and got["n3"] is None and got["n2"] == "99999"
    assert {k: v for k, v in got.items() if k[0] != "n"} == nearest(rows)
