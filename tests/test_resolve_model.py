"""Resolution: golden tables, random inputs against the SQL forms, plan checks."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from innsight.functions.keys import room_keywords_sql
from innsight.operators import resolve as R
from innsight.plans.q_resolve import combine_ctes
from innsight.plans.q_rooms import _PHOTOS_SQL, _facilities_sql, _of_sql, fold_ctes

WORDS = ["cold ring", "old ring", "ring", "r", "co", "(x)", "a (b)", "a (b) (c)", "Phone 1", "z Phone 9",
         "ld", "o", "Cold Ring", "gold ring sđt 0912", "ring (cold)", "b"]
HOME_SCHEMA = "source int, id bigint, seq bigint, homename string, city string"


# --- the three passes on random homes, against the SQL form ----------------------------------------

def _random_homes(rng, n):
    rows, used = [], set()
    for _ in range(n):
        i = rng.randrange(10_000)
        while i in used:
            i = rng.randrange(10_000)
        used.add(i)
        rows.append({"source": rng.choice([1, 2, 3]), "id": i, "seq": rng.randrange(1_000_000) * 10_000 + i,
                     "homename": rng.choice(WORDS), "city": rng.choice(["A", "B"])})
    return rows


def _sql(name, rows, schema, sql):
    """Run DuckDB SQL over a view ``name`` of the rows."""
    con = duckdb.connect()
    cols = [c.split() for c in schema.split(", ")]
    types = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "array<string>": "VARCHAR[]"}
    con.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {types[t]}' for c, t in cols)})")
    con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(cols))})", rows)
    out = con.execute(sql).fetchall()
    return out, [d[0] for d in con.description]


def test_combine_matches_sql(spark):
    rng = random.Random(7)
    attrs = "url string, rating string, cheapest_price string, address string, description string, property_highlights array<string>, images array<string>"
    schema = HOME_SCHEMA + ", " + attrs
    final, ctes = combine_ctes("homes AS (SELECT * FROM given)")
    for trial in range(8):
        rows = [(h["source"], h["id"], h["seq"], h["homename"], h["city"], f"u{h['id']}", None, f"{h['id']}.000",
                 rng.choice([None, "", "a"]), rng.choice([None, "", "d"]), rng.choice([None, [], ["x"]]), rng.choice([None, [], ["i", "j"]]))
                for h in _random_homes(rng, rng.randrange(5, 40))]
        out = R.combine_three_sources(spark.createDataFrame(rows, schema))
        got = out.withColumn("property_highlights", F.array_join("property_highlights", "|")).withColumn("images", F.array_join("images", "|"))
        want, names = _sql("given", rows, schema, "WITH " + ",\n".join(ctes) + "\n" + final)
        assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(repr, want)), trial


def test_string_ids_and_any_sources(spark):
    """The declared schema: ids are strings, sources have names, and there may be four of them."""
    rows = [("w", "w1", 1, "Villa", "A"), ("x", "x1", 1, "villa lux", "A"), ("y", "y1", 1, "Villa (b)", "A"), ("z", "z1", 1, "z", "A")]
    homes = spark.createDataFrame(rows, "source string, id string, seq bigint, homename string, city string")
    rooms = spark.createDataFrame([("w", "Villa", "r1", 1, "Suite", None, ["p"]), ("x", "villa lux", "r2", 1, "suite", ["f"], None),
                                   ("y", "Villa (b)", "r3", 1, "Cabin", None, None)],
                                  "source string, homename string, id string, seq bigint, roomtype string, facilities array<string>, photos array<string>")
    reviews = spark.createDataFrame([("x", "villa lux", "v1", 1, 2.0)], "source string, homename string, id string, seq bigint, score double")
    docs, rv = R.combined_document_tables(homes, rooms, reviews, sources=("w", "x", "y", "z"))
    got = {r["anchor_id"]: r for r in docs.collect()}
    assert set(got) == {"w1", "z1"}  # x1 and y1 are matched by w1
    d = got["w1"]
    assert (d["id_w"], d["id_x"], d["id_y"], d["id_z"]) == ("w1", "x1", "y1", None)
    assert [(r["roomtype"], r["id_w"], r["id_x"], r["id_y"], r["id_z"], r["facilities"], r["photos"]) for r in d["rooms"]] == [
        ("Suite", "r1", "r2", "r3", None, ["f"], ["p"])]
    assert [tuple(r) for r in rv.select("anchor_id", "source", "id").collect()] == [("w1", "x", "v1")]


def test_first_per_name_without_order_or_name(spark):
    rows = [(1, 1, None, "x", "A"), (1, 2, 7, "x", "A"), (1, 3, None, "only", "A"), (1, 4, 1, None, "A")]
    got = {(r["homename"], r["id"]) for r in R.first_per_name(spark.createDataFrame(rows, HOME_SCHEMA)).collect()}
    assert got == {("x", 2), ("only", 3)}


def test_equal_needles_are_verified_once(spark):
    """5,000 anchors with one needle in a city: the verify join sees the needle once, not once per anchor."""
    rows = [(1, i, i, f"Homestay ({i})", "A") for i in range(5000)] + [(2, 9000 + i, i, f"homestay {i}", "A") for i in range(20)]
    m = R.best_matches(spark.createDataFrame(rows, HOME_SCHEMA))
    got = m.where("anchor_source = 1").collect()
    assert len(got) == 5000 and {r["match_id"] for r in got} == {9000}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        m = R.best_matches(spark.createDataFrame(rows, HOME_SCHEMA))
        m.write.format("noop").mode("overwrite").save()
        plan = m._jdf.queryExecution().optimizedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the join that carries the contains test reads aggregated (distinct) needles, never the anchors with their ids
    text = plan.toString()
    at = text.index("Contains(") if "Contains(" in text else text.index("contains")
    assert "anchor_id" not in text[at:text.index("\n", at)]


def test_empty_and_short_needles(spark):
    rows = [(1, 1, 1, "(x)", "A"), (2, 2, 2, "zeta", "A"), (2, 3, 3, "alpha", "A"), (3, 4, 4, "beta", "B"),
            (1, 5, 5, "r", "A"), (2, 6, 6, "bar", "A"), (1, 7, 7, "al", "A"), (3, 8, 8, "cAL", "A")]
    df = spark.createDataFrame(rows, HOME_SCHEMA)
    m = {(r["anchor_id"], r["source"]): r["match_id"] for r in R.best_matches(df).collect()}
    assert m[(1, 2)] == 3            # empty needle: alphabetically first of the city
    assert (1, 3) in m and m[(1, 3)] == 8
    assert m[(5, 2)] == 6            # 'r' in 'bar'
    assert m[(7, 2)] == 3 and m[(7, 3)] == 8   # 'al' in 'alpha' and (case-insensitive) 'cAL'


def test_containment_plan_has_no_cross_join(spark):
    df = spark.createDataFrame([(1, 1, 1, "cold ring", "A"), (2, 2, 2, "old ring", "A")], HOME_SCHEMA)
    plan = R.best_matches(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# --- the greedy room match, against golden tables and the SQL form ------------------------------------

ROOMS = "home string, source int, id bigint, seq bigint, roomtype string, facilities array<string>, photos array<string>"

TYPES = ["Deluxe Room", "deluxe room", "Phòng Deluxe", "Double Room", "Phòng đôi", "Suite", "suite king",
         "Family Room", "phòng gia đình", "Standard", "Bungalow", "Deluxe Double Room", "Giường phụ"]


@pytest.mark.parametrize("mode", ["reference", "merge_equal"])
def test_greedy_matches_sql(spark, mode):
    rng = random.Random(3)
    rows, rid = [], 0
    for h in range(40):
        for s in (1, 2, 3):
            for _ in range(rng.randrange(0, 6)):
                rid += 1
                fac = None if rng.random() < 0.2 else [f"f{j}" for j in range(rng.randrange(0, 4))]
                rows.append((f"h{h}", s, rid, rid, rng.choice(TYPES), fac, rng.choice([None, [f"p{rid}"]])))
    df = spark.createDataFrame(rows, ROOMS)
    got = [(r["home"], r["room_ord"], r["roomtype"], r["id_1"], r["id_2"], r["id_3"], list(r["facilities"]), list(r["photos"]))
           for r in R.greedy_room_match(df, mode=mode).collect()]
    keyed = f"keyed AS (SELECT *, source AS rank, lower(roomtype) AS low, {room_keywords_sql('roomtype')} AS room_key, NULL AS availables FROM given)"
    want, _ = _sql("given", rows, ROOMS, f"""WITH RECURSIVE {keyed}, {fold_ctes('keyed', mode)}
        SELECT home, row_number() OVER (PARTITION BY home ORDER BY n) - 1, x.t, {_of_sql(1, 'id')}, {_of_sql(2, 'id')}, {_of_sql(3, 'id')},
        {_facilities_sql()}, {_PHOTOS_SQL} FROM folded""")
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert "Python" not in R.greedy_room_match(df, mode=mode)._jdf.queryExecution().toString()


GOLDEN = [
    # case variants, one source each: one room, the longest facilities, photos of the first source
    ([(1, 1, "Suite", ["a"], ["p1"]), (2, 2, "suite", ["a", "b"], ["p2"]), (3, 3, "SUITE", None, None)],
     [("Suite", 1, 2, 3, ["a", "b"], ["p1"])]),
    # within a source the stored order decides which room opens first
    ([(2, 2, "Cabin by the lake", None, ["p2"]), (1, 5, "Suite", None, ["p1"]), (1, 1, "cabin", None, ["p0"])],
     [("cabin", 1, 2, None, [], ["p0"]), ("Suite", 5, None, None, [], ["p1"])]),
    # a taken string is skipped in every source
    ([(1, 1, "Deluxe Room", None, None), (2, 2, "Deluxe Room", None, None), (2, 3, "phòng deluxe", None, None)],
     [("Deluxe Room", 1, 3, None, [], [])]),
    # stored order decides which of two matching rooms is taken
    ([(1, 1, "Family", None, None), (2, 3, "family b", None, None), (2, 2, "family a", None, None)],
     [("Family", 1, 2, None, [], []), ("family b", None, 3, None, [], [])]),
    # ties of facility lists keep the first
    ([(1, 1, "x", ["a"], None), (2, 2, "X", ["b"], None)], [("x", 1, 2, None, ["a"], [])]),
]


@pytest.mark.parametrize("rooms, want", GOLDEN)
def test_greedy_golden(spark, rooms, want):
    df = spark.createDataFrame([("h", s, i, i, t, f, p) for s, i, t, f, p in rooms], ROOMS)
    got = [(r["roomtype"], r["id_1"], r["id_2"], r["id_3"], list(r["facilities"]), list(r["photos"]))
           for r in R.greedy_room_match(df).orderBy("room_ord").collect()]
    assert got == want


def test_greedy_equal_strings_merge_on_request(spark):
    df = spark.createDataFrame([("h", 1, 1, 1, "Suite", None, None), ("h", 2, 2, 2, "Suite", ["a"], None), ("h", 3, 3, 3, "Cabin", None, None)], ROOMS)
    rows = R.greedy_room_match(df, mode="merge_equal").orderBy("room_ord").collect()
    assert [(r["roomtype"], r["id_1"], r["id_2"], r["id_3"]) for r in rows] == [("Suite", 1, 2, None), ("Cabin", None, None, 3)]


def test_keywords_and_modes_are_honoured(spark):
    df = spark.createDataFrame([("h", 1, 1, 1, "aa zed", None, None), ("h", 2, 2, 2, "bb zed", None, None), ("h", 2, 3, 3, "cc", None, None)], ROOMS)
    pairs = {(r["a_id"], r["b_id"]) for r in R.room_candidates(df, keywords=[("zed", [])]).collect()}
    assert pairs == {(1, 2)}
    for f in (R.room_candidates, R.type_candidates, R.greedy_room_match):
        with pytest.raises(ValueError):
            f(df, mode="other")


def test_greedy_equal_strings_never_merge(spark):
    rows = [("h", 1, 1, 1, "Suite", None, ["p1"]), ("h", 2, 2, 2, "Suite", ["a", "b"], None),
            ("h", 2, 3, 3, "Bungalow", None, None), ("h", 3, 4, 4, "Cabin", None, None)]
    df = spark.createDataFrame(rows, "home string, source int, id bigint, seq bigint, roomtype string, "
                                     "facilities array<string>, photos array<string>")
    out = R.greedy_room_match(df).orderBy("room_ord").collect()
    # 'Suite' of source 2 is skipped (equal string already taken); Bungalow and
    # Cabin have no keyword, their empty keys equal Suite's, so both merge into it
    assert [r["roomtype"] for r in out] == ["Suite"]
    assert (out[0]["id_1"], out[0]["id_2"], out[0]["id_3"]) == (1, 3, 4)
    assert list(out[0]["photos"]) == ["p1"]
    merge_eq = R.greedy_room_match(df, mode="merge_equal").orderBy("room_ord").collect()
    assert [r["roomtype"] for r in merge_eq] == ["Suite", "Bungalow", "Cabin"]


def test_first_per_name_is_lowest_seq(spark):
    rows = [(1, 10, 5, "x", "A"), (1, 11, 3, "x", "B"), (2, 12, 1, "x", "C")]
    df = spark.createDataFrame(rows, HOME_SCHEMA)
    got = {(r["source"], r["homename"]): r["id"] for r in R.first_per_name(df).collect()}
    assert got == {(1, "x"): 11, (2, "x"): 12}


def test_room_candidates_substring_and_key(spark):
    rows = [("h", 1, 1, 1, "Deluxe Room", None, None), ("h", 2, 2, 2, "deluxe room with view", None, None),
            ("h", 3, 3, 3, "Phòng Deluxe", None, None), ("h", 3, 4, 4, "Cabin", None, None)]
    df = spark.createDataFrame(rows, "home string, source int, id bigint, seq bigint, roomtype string, "
                                     "facilities array<string>, photos array<string>")
    pairs = {(r["a_id"], r["b_id"]) for r in R.room_candidates(df).collect()}
    assert (1, 2) in pairs and (1, 3) in pairs and (2, 3) in pairs
    assert (1, 4) not in pairs
    merge_eq = {(r["a_id"], r["b_id"]) for r in R.room_candidates(df, mode="merge_equal").collect()}
    assert (1, 3) in merge_eq


def test_shorten_room_type_vietnamese(spark):
    from innsight.functions.keys import shorten_room_type

    df = spark.createDataFrame([("Phòng Deluxe Giường Đôi",), ("phòng bốn người",), ("Phòng tập thể Ban công",),
                                ("Suite",)], "t string")
    got = [r[0] for r in df.select(shorten_room_type(F.col("t"))).collect()]
    assert got[0] == "deluxe double room deluxe room"
    assert got[1] == ""  # the variant keeps its leading space
    assert got[2] == "balcony dormitory room"
    assert got[3] == ""


def test_room_candidates_match_brute_force(spark):
    rng = random.Random(11)
    types = TYPES + ["a", "ab", "Ab", "b", "room", "Room 2", "xroomx", "giường phụ thêm"]
    rows = []
    for i in range(160):
        rows.append((f"h{rng.randrange(6)}", rng.choice([1, 2, 3]), i, i, rng.choice(types), None, None))
    df = spark.createDataFrame(rows, "home string, source int, id bigint, seq bigint, roomtype string, "
                                     "facilities array<string>, photos array<string>")
    for mode in ("reference", "merge_equal"):
        got = {(r["home"], r["a_id"], r["b_id"]) for r in R.room_candidates(df, mode=mode).collect()}
        keys = {t: k for t, k in df.select("roomtype", R.shorten_room_type(F.col("roomtype"))).distinct().collect()}
        want = set()
        for h1, s1, i1, _, t1, _, _ in rows:
            for h2, s2, i2, _, t2, _, _ in rows:
                if h1 != h2 or s1 >= s2:
                    continue
                k1, k2 = keys[t1], keys[t2]
                key_ok = k1 == k2 and (mode == "reference" or k1 != "")
                if t1.lower() in t2.lower() or t2.lower() in t1.lower() or key_ok:
                    want.add((h1, i1, i2))
        assert got == want, mode


def test_document_tables_equal_nested_documents(spark):
    """The reviews child table holds exactly the nested arrays, in stored order."""
    from innsight.plans.bindings import home_rows_from_lineitem, homes_from_part

    sf = "/root/testdata/sf0.001"
    homes = homes_from_part(spark, sf, block=60)
    rows = home_rows_from_lineitem(spark, sf, block=60)
    room, review = rows.where(F.col("kind") == "room"), rows.where(F.col("kind") == "review")
    nested = {(r["pass"], r["anchor_id"]): r for r in R.combined_documents(homes, room, review).collect()}
    docs, reviews = R.combined_document_tables(homes, room, review)
    assert docs.count() == len(nested)
    from_table = {}
    for r in reviews.collect():
        from_table.setdefault((r["pass"], r["anchor_id"], r["source"]), []).append((r["seq"], r["id"], r["score"]))
    n = 0
    for key, doc in nested.items():
        for s in (1, 2, 3):
            arr = [(x["_o"], x["id"], x["score"]) for x in (doc[f"rows_{s}"] or [])]
            assert arr == sorted(from_table.get((*key, s), [])), (key, s)
            n += len(arr)
    assert n == reviews.count() > 0


def test_hot_name_is_pre_aggregated(spark):
    """A name held by 40% of all rows: right first row, and W1 collapses map-side."""
    rows = [(1 + i % 3, i, 1000 - i, "hot" if i % 5 < 2 else f"n{i % 37}", f"c{i % 4}") for i in range(3000)]
    homes = spark.createDataFrame(rows, HOME_SCHEMA).repartition(8)
    w1 = R.first_per_name(homes)
    want = {}
    for src, i, seq, name, _ in rows:
        if (src, name) not in want or seq < want[(src, name)]:
            want[(src, name)] = seq
    got = {(r["source"], r["homename"]): r["seq"] for r in w1.collect()}
    assert got == want
    plan = w1._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_document_reviews_are_not_collected(spark):
    """S6 at scale: the reviews child table is a join, never a per-property collect."""
    from innsight.plans.bindings import home_rows_from_lineitem, homes_from_part

    sf = "/root/testdata/sf0.001"
    rows = home_rows_from_lineitem(spark, sf, block=60)
    docs, reviews = R.combined_document_tables(homes_from_part(spark, sf, block=60), rows.where(F.col("kind") == "room"),
                                               rows.where(F.col("kind") == "review"))
    plan = reviews._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan
    assert set(reviews.columns) == {"pass", "anchor_id", "source", "seq", "id", "score"}


def test_resolved_passes_do_not_depend_on_cache(spark):
    """The resolved anchors and matches start from a reliable checkpoint: dropping
    every cached block (as a lost executor would) changes nothing."""
    rnd = random.Random(7)
    rows = [(rnd.choice([1, 2, 3]), i, rnd.randrange(50), rnd.choice(WORDS), rnd.choice(["x", "y"])) for i in range(60)]
    homes = spark.createDataFrame(rows, HOME_SCHEMA)
    anchors, matches = R.resolve_passes(homes)
    before = (sorted(map(tuple, anchors.collect())), sorted(map(tuple, matches.collect())))
    for d in (anchors, matches):
        plan = d._jdf.queryExecution().optimizedPlan().toString()
        assert "LogicalRDD" in plan and "InMemoryRelation" not in plan
    spark.catalog.clearCache()
    assert (sorted(map(tuple, anchors.collect())), sorted(map(tuple, matches.collect()))) == before
