"""Splits by several label columns at once, against a loop."""

import hashlib
import math
import random

import pytest

from corpusprep.operators import split as sp

DDL = "workbook string, sheet string, row_idx bigint, colour string, size int"


def plain(rows, frac):
    """``row_idx -> split`` by sorting whole groups in memory."""
    out = {}
    for g in {r[:2] for r in rows}:
        mine = [r for r in rows if r[:2] == g]
        have = [c for c in (3, 4) if any(r[c] is not None for r in mine)]
        mine = [r for r in mine if have and all(r[c] is not None for c in have)]
        shown = lambda r: [str(r[c]) for c in have]
        done = 0
        for combo in sorted({tuple(shown(r)) for r in mine}):
            part = sorted((r for r in mine if tuple(shown(r)) == combo), key=lambda r: (hashlib.md5(f"42:{r[2]}".encode()).hexdigest(), r[2]))
            take = math.floor((done + len(part)) * frac) - math.floor(done * frac)
            out |= {r[2]: "train" if i < take else "test" for i, r in enumerate(part)}
            done += len(part)
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    out = [("w", s, 0, rnd.choice(["red", "blue", None]), rnd.choice([1, 2, 3, 10, 11, 12, 13, 14, 15])) for s in ("a", None) for _ in range(90)]
    out += [("w", "colours", 0, rnd.choice(["red", "blue"]), None) for _ in range(7)]
    out += [(None, "none", 0, None, None) for _ in range(3)] + [("w", "one", 0, "red", 1)]
    return [(w, s, i, c, z) for i, (w, s, _, c, z) in enumerate(out)]


def test_equals_a_loop_and_keeps_shares_within_a_row(spark, rows):
    df = spark.createDataFrame(rows, DDL).repartition(5)
    out = sp.split_by_combination(df, ["colour", "absent", "size"])
    assert out.columns == [*df.columns, "split"]
    got = out.collect()
    assert {r["row_idx"]: r["split"] for r in got} == plain(rows, 0.8)
    assert len(got) == len({r["row_idx"] for r in got})
    for cols in ((), ("colour",), ("colour", "size")):
        shares = {}
        for r in got:
            shares.setdefault((r["workbook"], r["sheet"], *[r[c] for c in cols]), []).append(r["split"] == "train")
        assert all(abs(sum(x) - 0.8 * len(x)) <= 1 for x in shares.values())


def test_shares_of_nothing_and_of_all(spark, rows):
    df = spark.createDataFrame(rows, DDL)
    assert {r["split"] for r in sp.split_by_combination(df, ["colour", "size"], train=0, test=1).collect()} == {"test"}
    assert {r["split"] for r in sp.split_by_combination(df, ["colour", "size"], train=1, test=0).collect()} == {"train"}
    assert sp.split_by_combination(df.where("false"), ["colour"]).count() == 0
    with pytest.raises(ValueError):
        sp.split_by_combination(df, ["absent"])


def test_an_empty_by_is_one_group(spark, rows):
    full = [r for r in rows if r[3] is not None and r[4] is not None]
    df = spark.createDataFrame(full, DDL)
    got = {r["row_idx"]: r["split"] for r in sp.split_by_combination(df, ["colour", "size"], []).collect()}
    assert got == plain([("x", "y", *r[2:]) for r in full], 0.8)
