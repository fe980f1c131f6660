"""Name keys: hand-written pairs and invariants; resolution invariants."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from innsight.functions import keys as K
from innsight.operators import resolve as R

PIECES = ["Villa", " ", "(", ")", "Phone", "sđt", " 0909", "\n", "\t", " ", "Hà Nội", "x", "  ", "(a)", "b)"]

# name, cleaned name, needle, inside needle
PAIRS = [
    ("Villa", "Villa", "Villa", None),
    ("  Villa  ", "Villa", "Villa", None),
    ("Villa Phone 0909", "Villa", "Villa", None),
    ("Villa sđt 0909 (x)", "Villa", "Villa", "x"),
    ("Villa (Hà Nội)", "Villa (Hà Nội)", "Villa", "Hà Nội"),
    ("Villa (Hà Nội Phone 1)", "Villa (Hà Nội", "Villa", "Hà Nội"),
    ("(Hà Nội) Villa", "(Hà Nội) Villa", "(Hà Nội) Villa", None),
    ("Villa (a) (b)", "Villa (a) (b)", "Villa", "a) (b"),
    ("(a)", "(a)", "", "a"),
    ("", "", "", None),
    ("Phone", "", "", None),
    ("phone", "phone", "phone", None),
]


def _keys(spark, names):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    return df.select("i", K.clean_homename(F.col("name")).alias("c"), K.match_needle(F.col("name")).alias("n"),
                     K.fallback_needle(F.col("name")).alias("f")).orderBy("i").collect()


def test_name_keys(spark):
    for (name, *want), r in zip(PAIRS, _keys(spark, [p[0] for p in PAIRS]), strict=True):
        assert [r["c"], r["n"], r["f"]] == want, name


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), min_size=0, max_size=8).map("".join), min_size=1, max_size=30))
def test_name_key_invariants(spark, names):
    rows = _keys(spark, names)
    again = _keys(spark, [r["c"] for r in rows])
    for name, r, a in zip(names, rows, again):
        for key in (r["c"], r["n"], r["f"] or ""):
            # nothing of a contact is left on its line, and nothing to strip
            assert not any(w in line for line in key.split("\n") for w in ("Phone", "sđt")), repr(name)
            assert key == key.strip()
        assert a["c"] == r["c"], repr(name)  # cleaning twice changes nothing
        if "\n" not in name:
            assert (r["f"] is None) == (not (name.endswith(")") and "(" in name)), repr(name)


def test_pass_invariants(spark):
    from innsight.plans.bindings import homes_from_part

    a, m = R.resolve_passes(homes_from_part(spark, "/root/testdata/sf0.001"))
    # each anchor appears once, in one pass
    assert a.groupBy("anchor_source", "anchor_id").count().where("count > 1").count() == 0
    # a matched home gives its rooms and reviews to at most one anchor
    assert m.where("owned").groupBy("source", "match_id").count().where("count > 1").count() == 0
    # an anchor of pass p was not matched by an earlier pass
    j = a.alias("a").join(m.alias("m"), (F.col("a.anchor_id") == F.col("m.match_id")) & (F.col("m.pass") < F.col("a.pass")))
    assert j.count() == 0
