"""Spellings one letter apart, against all pairs by hand."""

import random

import pytest

from vedrina.operators.spellings import consolidate_spellings, spelling_links


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def by_hand(rows, least_chars):
    """Groups of (city, country) as {country: [set of cities]}; accents are not in these rows."""
    names = sorted({(country, city) for city, country in rows}, key=repr)
    label = {name: name for name in names}
    changed = True
    while changed:
        changed = False
        for a in names:
            for b in names:
                near = a[0] == b[0] and min(len(a[1]), len(b[1])) >= least_chars and one_apart(a[1], b[1])
                if near and repr(label[b]) < repr(label[a]):
                    label[a] = label[b]
                    changed = True
    found = {}
    for name in names:
        found.setdefault(label[name], []).append(name)
    result = []
    for group in found.values():
        listed = {city: sum(row == (city, group[0][0]) for row in rows) for _, city in group}
        best = min(listed, key=lambda city: (-listed[city], city))
        result.append((group[0][0], best, sum(listed.values()), len(group)))
    return sorted(result, key=repr)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("seed, least_chars", [(1, 1), (2, 3), (3, 5)])
def test_all_pairs(spark, seed, least_chars):
    dice = random.Random(seed)
    rows = []
    for _ in range(150):
        city = list(dice.choice(["beograd", "zagreb", "ab", "aab", "sarajevo", "skoplje", "nis", "novi sad"]))
        for _ in range(dice.randrange(3)):
            at = dice.randrange(len(city) + 1)
            edit = dice.randrange(3)
            city[at : at + (edit != 0)] = [dice.choice("abcdx")] if edit < 2 else []
        rows.append(("".join(city) or "x", dice.choice(["A", "A", "B", None])))
    df = spark.createDataFrame(rows, "city string, country string").repartition(4)
    assert found(consolidate_spellings([df], {}, least_chars)) == by_hand(rows, least_chars)


def test_accents_and_counts(spark):
    rows = [("Beograd", "Serbia")] * 3 + [("Beograd", "Serbia RS"), ("Beograb", "Serbia"), ("Béograd", "Serbia"), ("Beogrd", "Serbia"), ("Beograd", "Croatia")]
    answer = found(consolidate_spellings([spark.createDataFrame(rows, "city string, country string")]))
    assert answer == [("Hrvatska", "Beograd", 1, 1), ("Srbija", "Beograd", 7, 3)]


def test_links_grow_with_the_letters(spark):
    """A thousand spellings that differ from one another in one letter make a thousand links, not all pairs."""
    rows = [(n, "A", f"city{chr(0x4E00 + n)}name") for n in range(1000)]
    links = spelling_links(spark.createDataFrame(rows, "node bigint, country string, city_key string"))
    assert links.count() == 999


def test_no_rows(spark):
    empty = spark.createDataFrame([], "city string, country string")
    assert consolidate_spellings([empty]).count() == 0
    nulls = spark.createDataFrame([(None, "A"), ("", "A"), ("Nis", None)], "city string, country string")
    assert found(consolidate_spellings([nulls])) == [("A", "", 1, 1), (None, "Nis", 1, 1)]
