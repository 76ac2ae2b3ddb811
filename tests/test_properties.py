import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corpusprep.operators import labels as lb
from corpusprep.operators import split as sp

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(labels=st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=40),
       shares=st.sampled_from([(80, 20), (70, 30), (1, 3), (50, 50)]))
def test_split_properties(spark, labels, shares):
    rows = [("w", "g1" if i % 3 else "g2", i * 7 + 1, lab) for i, lab in enumerate(labels)]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, label string")
    out = sp.stratified_split(df, "label", train=shares[0], test=shares[1]).collect()
    frac = sp.train_fraction(*shares)
    assert len(out) == sum(1 for r in rows if r[3] is not None)          # complete, nulls dropped
    assert len({r.row_idx for r in out}) == len(out)                      # disjoint
    n = Counter((r.sheet, r.label) for r in out)
    tr = Counter((r.sheet, r.label) for r in out if r.split == "train")
    for key, cnt in n.items():
        assert tr[key] == max(1, math.floor(cnt * frac))


@SETTINGS
@given(labels=st.lists(st.sampled_from(["x", "y", "z", "é"]), min_size=1, max_size=30))
def test_encode_decode_round_trip(spark, labels):
    rows = [("w", "s", i, lab, "train" if i % 2 == 0 else "test") for i, lab in enumerate(labels)]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, label string, split string")
    m = lb.label_map_sorted(df, "label")
    enc = lb.label_encode(df, m, "label")
    train_labels = {r[3] for r in rows if r[4] == "train"}
    for r in enc.collect():
        assert (r.label_id >= 0) == (r.label in train_labels)
    dec = lb.label_decode(enc.where("label_id >= 0"), m, out="back").collect()
    assert all(r.back == r.label for r in dec)
    ids = sorted(r.label_id for r in m.collect())
    assert ids == list(range(len(train_labels)))
