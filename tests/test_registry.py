"""Every registered query is well named, and every oracle belongs to a query."""

import re

import __spark_entry__ as contract

INVENTORY = {
    "s": [1, 2, 4, 5, 6, 7, 8], "k": range(1, 12), "p": range(1, 29), "j": range(1, 13), "a": range(1, 20), "w": range(1, 11),
    "t": range(1, 5), "r": range(1, 8), "x": range(1, 11), "v": range(1, 11), "g": range(1, 17), "c": [*range(1, 13), *range(20, 42)],
    "b": range(1, 14), "e": range(1, 14), "o": range(1, 8), "st": range(1, 11), "m": range(1, 10), "ts": range(1, 7), "xs": range(1, 6)}


def test_names_and_oracles():
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries)
    assert all(re.fullmatch(r"[a-z]{1,2}\d{1,2}_[a-z0-9_]+|pipeline", name) for name in queries)


def test_every_inventory_entry_has_a_query():
    have = {found.group(0) for name in contract.queries() if (found := re.match(r"[a-z]+\d+", name))}
    # the database reader has none: it would need a running database
    expected = {f"{letter}{i:02d}" if letter not in ("ts", "xs") else f"{letter}{i}" for letter, ids in INVENTORY.items() for i in ids}
    assert expected <= have, sorted(expected - have)


def test_flagship_runs(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "report_date" in df.columns
