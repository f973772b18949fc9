"""Tables kept up by changes, roll-ups of distinct counts, and comparison by digests."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from granary.catalog import QUERIES
from granary.operators import bitmaps, digest_tree, key_filter
from granary.plans import commits, upkeep
from granary.sources import sample

SALE = "k string, v long, price decimal(18,2)"
KEPT = upkeep.Kept("t", ("k",), ("v",), "price")


def test_random_batches_equal_a_rebuild(spark, tmp_path):
    draw, held = random.Random(3), Counter()
    for load in range(6):
        came = [(draw.choice(["a", "b", "c", None, "e"]), draw.randint(1, 9), draw.choice([1, 2, 3, None])) for _ in range(8)]
        went = draw.sample(sorted(held.elements(), key=repr), k=min(len(list(held.elements())), draw.randint(0, 9)))
        held.update(came)
        held.subtract(went)
        signed = upkeep.changes(spark.createDataFrame(came, SALE.replace("decimal(18,2)", "long")), spark.createDataFrame(went, SALE.replace("decimal(18,2)", "long")))
        signed = signed.withColumn("price", F.col("price").cast("decimal(18,2)"))
        upkeep.apply(spark, str(tmp_path), f"load{load}", lambda state: [(KEPT, signed)])
        expected = defaultdict(lambda: [0, 0, None])
        for key, v, price in held.elements():
            group = expected[key]
            group[0] += 1
            group[1] += v
            group[2] = max((p for p in (group[2], price) if p is not None), default=None)
        found = {r.k: [r.rows, r.v, None if r.price is None else int(r.price)] for r in upkeep.result(spark, str(tmp_path), KEPT).collect()}
        assert found == dict(expected), load


def test_only_touched_buckets_are_written_and_loads_count_once(spark, tmp_path):
    root = str(tmp_path)

    def load(name, rows, went=()):
        def signed(some):
            return spark.createDataFrame(some, "k string, v long, price long").withColumn("price", F.col("price").cast("decimal(18,2)"))

        return upkeep.apply(spark, root, name, lambda state: [(KEPT, upkeep.changes(signed(rows), signed(list(went))))])

    first = load("one", [(f"k{i}", 1, i) for i in range(300)])
    assert len(first.tables) > 50
    second = load("two", [("k7", 5, 1)])
    moved = [name for name in second.tables if second.tables[name] != first.tables[name]]
    assert len(moved) == 1
    assert load("two", [("k7", 5, 1)]) == second
    third = load("three", [], [("k7", 1, 7), ("k7", 5, 1)])
    assert "k7" not in {r.k for r in upkeep.result(spark, root, KEPT).collect()} and third.version == 3
    assert {r.k: r.rows for r in upkeep.result(spark, root, KEPT, 2).collect()}["k7"] == 2
    with pytest.raises(ValueError, match="never came"):
        load("four", [], [("k7", 1, 7)])
    assert commits.current(spark, root) == third


def test_a_load_writes_its_changes_alone_until_parts_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upkeep, "PARTS", 2)
    kept, root = upkeep.Kept("t", ("k",), ("v",), "price", buckets=1), str(tmp_path)
    most = spark.range(500).select(F.concat(F.lit("k"), F.col("id") % 50).alias("k"), F.lit(2).cast("long").alias("v"), F.col("id").cast("decimal(18,2)").alias("price"))

    def load(n, came, went=None):
        return upkeep.apply(spark, root, f"load{n}", lambda state: [(kept, upkeep.changes(came, went))])

    state = load(0, most)
    assert spark.read.parquet(state.tables["t/0"]).count() == 500
    one = spark.sql("select 'k7' k, 1L v, 900.00BD price")
    for n in range(1, 4):
        # a row that comes and goes again, the last one stays
        state = load(n, one) if n % 2 else load(n, one.limit(0), one)
        held = upkeep.result(spark, root, kept)
        seven = held.where("k = 'k7'").first()
        assert held.count() == 50 and (seven.rows, seven.v, int(seven.price)) == ((11, 21, 900) if n % 2 else (10, 20, 457)), n
        parts = state.notes["parts"]["t/0"]
        assert len(parts) <= upkeep.PARTS and (len(parts) == 1 or spark.read.parquet(state.tables["t/0"]).count() == 1)
        assert state.notes["rows"]["t/0"] == 500 + n % 2
    gone = upkeep.apply(spark, root, "gone", lambda state: [(kept, upkeep.changes(most.limit(0), most.unionByName(one)))])
    assert gone.tables == {} and gone.notes["parts"] == {} and gone.notes["rows"] == {}
    assert {r.k: r.rows for r in upkeep.result(spark, root, kept, 1).collect()} == {f"k{n}": 10 for n in range(50)}


def test_states_without_remembered_parts_are_read_as_they_are(spark, tmp_path):
    kept, root = upkeep.Kept("t", ("k",), ("v",), "price", buckets=1), str(tmp_path)
    one = spark.sql("select 'a' k, 4L v, 1.00BD price")
    spark.sql("select 'a' k, 1.00BD price, 2L _rows, 8L v").write.parquet(f"{root}/t/old")
    commits.commit(spark, root, commits.EMPTY, "old", {"t/0": f"{root}/t/old"}, {"loads": ["old"]})
    state = upkeep.apply(spark, root, "new", lambda state: [(kept, upkeep.changes(one.limit(0), one))])
    assert [tuple(r) for r in upkeep.result(spark, root, kept).select("k", "rows", "v").collect()] == [("a", 1, 4)]
    assert state.notes["rows"] == {"t/0": 1}
    assert upkeep.apply(spark, root, "last", lambda state: [(kept, upkeep.changes(one.limit(0), one))]).tables == {}


def test_rows_that_meet_no_wanted_key_are_dropped(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 7).alias("n"))
    wanted = rows.where("id % 1000 = 5 or id = 3000")
    found = key_filter.may_meet(rows, wanted, ["id", "n"])
    assert found.columns == rows.columns
    assert wanted.exceptAll(found).isEmpty() and found.count() < 2 * wanted.count()
    assert key_filter.may_meet(rows, wanted.limit(0), ["id"]).isEmpty()
    assert key_filter.may_meet(rows, wanted.withColumn("id", F.col("id").cast("int")), ["id"]).count() == 20_000


def test_rows_before_that_meet_no_change_are_not_joined(spark):
    many = upkeep.changes(spark.range(10_000).withColumn("l", F.lit("x")))
    few = upkeep.changes(spark.range(3).withColumn("r", F.lit("y")))
    nothing = few.limit(0)
    met = upkeep.joined(many, many.limit(0), nothing, few, "id")
    assert met.count() == 3
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2  # with the changes, and with the bits of their keys


@pytest.mark.parametrize("name", ["upkeep_revenue_by_shipper", "upkeep_daily_revenue"])
def test_what_changed_is_worked_out_once_for_a_load(spark, monkeypatch, name):
    lines = spark.range(630).selectExpr(
        "id div 3 order_id", "id % 8 product_id", "cast(id % 11 + 1 as decimal(18,2)) unit_price", "id % 5 + 1 quantity", "0.10BD discount"
    )
    lines = lines.unionByName(lines.where("order_id % 6 = 1"))  # rows that come twice
    heads = spark.range(210).selectExpr("id order_id", "id % 9 customer_id", "date'2026-01-01' order_date", "id % 10 shipper_id")
    met = lines.join(heads, "order_id").selectExpr("*", "cast(round(quantity * unit_price * 0.9, 2) as decimal(18,2)) net")
    read = spark.sparkContext.accumulator(0)

    def counted(frame):
        def each(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        return frame.mapInArrow(each, frame.schema)

    monkeypatch.setattr(sample, "order_details", lambda *_: counted(lines))
    monkeypatch.setattr(sample, "orders", lambda *_: heads)
    found = QUERIES[name](spark, "unused")
    # rows and doubtful rows of the first load, late ones of the second, those that went
    assert read.value == 4 * lines.count()
    keys = ["shipper_id", "customer_id"] if "shipper" in name else ["order_date"]
    want = met.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum("net").cast("decimal(18,2)").alias("spent"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_whole_rows_are_written_as_they_come_and_add_up(spark, tmp_path):
    kept, root = upkeep.Kept("w", ("k", "v"), by=("k",), buckets=2, whole=True), str(tmp_path)
    rows = spark.sql("select explode(array(1, 1, 2, null)) k, 7 v")
    one, other = rows.where("k = 1").limit(1), spark.sql("select 3 k, 7 v")

    def load(name, came, went=None):
        return upkeep.apply(spark, root, name, lambda state: upkeep.parts(spark, root, name, [(kept, upkeep.changes(came, went))]))

    def held():
        return {(r.k, r.v): r.rows for r in upkeep.result(spark, root, kept).collect()}

    signed = upkeep.part(spark, root, "plan", kept, upkeep.changes(rows, one))
    assert signed.changes().agg(F.sum(F.abs("sign"))).first()[0] == 5
    load("one", rows)
    assert held() == {(1, 7): 2, (2, 7): 1, (None, 7): 1}
    load("two", other, other)  # comes and goes in one load
    load("three", one.limit(0), one.unionByName(rows.where("k is null")))
    assert held() == {(1, 7): 1, (2, 7): 1}
    with pytest.raises(ValueError, match="never came"):
        load("four", one, one.unionByName(one).unionByName(one))
    assert held() == {(1, 7): 1, (2, 7): 1}


def test_an_emptied_bucket_leaves_the_table(spark, tmp_path):
    one = spark.sql("select 'a' k, 1L v, 1.00BD price")
    upkeep.apply(spark, str(tmp_path), "in", lambda state: [(KEPT, upkeep.changes(one))])
    state = upkeep.apply(spark, str(tmp_path), "out", lambda state: [(KEPT, upkeep.changes(one.limit(0), one))])
    assert state.tables == {} and upkeep.result(spark, str(tmp_path), KEPT) is None


def test_changes_of_a_join(spark):
    left = [(1, "a"), (1, "b"), (2, "c")]
    right = [(1, "x"), (3, "y")]
    l_in, l_out, r_in, r_out = [(3, "d"), (1, "e")], [(1, "a")], [(2, "z"), (1, "w")], [(1, "x")]

    def frame(rows, name):
        return spark.createDataFrame(rows, f"id long, {name} string")

    found = upkeep.joined(
        upkeep.changes(frame(left, "l")), upkeep.changes(frame(l_in, "l"), frame(l_out, "l")),
        upkeep.changes(frame(right, "r")), upkeep.changes(frame(r_in, "r"), frame(r_out, "r")), "id",
    )
    total = Counter()
    for row in found.collect():
        total[(row.id, row.l, row.r)] += row.sign

    def met(a, b):
        return Counter((i, x, y) for i, x in a for j, y in b if i == j)

    after = met([r for r in left if r not in l_out] + l_in, [r for r in right if r not in r_out] + r_in)
    after.subtract(met(left, right))
    assert {k: v for k, v in total.items() if v} == {k: v for k, v in after.items() if v}


def test_rows_of_a_key_are_added_up_before_they_are_joined(spark, tmp_path):
    draw, kept = random.Random(11), upkeep.Kept("t", ("r",), ("v",), buckets=2)

    def frame(n, name, kind, values):
        rows = [(draw.choice([1, 2, 3, 4, None]), draw.choice(values), draw.choice([-1, 1, 1, 2])) for _ in range(n)]
        return spark.createDataFrame(rows, f"id long, {name} {kind}, sign long")

    sides = [frame(n, "v", "long", [1, 5, 9, None]) for n in (60, 40)] + [frame(n, "r", "string", ["x", "y", None]) for n in (5, 5)]
    price = F.col("v").cast("decimal(18,2)") / 4
    plain = upkeep.joined(*sides, "id").withColumn("v", price.cast("decimal(18,2)"))
    added = upkeep.joined(*sides, "id", {"v": price.cast("decimal(18,2)")})
    found, want = upkeep._folded(kept, added), upkeep._folded(kept, plain)
    assert found.schema == want.schema
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
    # one row for each key with the changes and one with the rows before, for each row of the right
    left, left_changes = (side.where("id = 3") for side in sides[:2])
    right, right_changes = (side.limit(1).withColumn("id", F.lit(3).cast("long")) for side in sides[2:])
    assert upkeep.joined(left, left_changes, right, right_changes, "id", {"v": price}).rows.count() == 3


@pytest.mark.parametrize("name, by_line", [("upkeep_revenue_by_shipper", False), ("upkeep_daily_revenue", False), ("upkeep_dim_product", True)])
def test_lines_of_an_order_meet_its_head_once_unless_told_apart(spark, monkeypatch, name, by_line):
    lines = spark.range(600).selectExpr(
        "id div 20 order_id", "id % 8 product_id", "cast(id % 11 + 1 as decimal(18,2)) unit_price", "id % 5 + 1 quantity", "0.10BD discount"
    )
    heads = spark.range(30).selectExpr("id order_id", "id % 9 customer_id", "date'2026-01-01' order_date", "id % 10 shipper_id")
    met, joined = [], upkeep.joined

    def counted(*given):
        sales = joined(*given)
        met.append((sales.rows if isinstance(sales, upkeep.Added) else sales).count())
        return sales

    monkeypatch.setattr(sample, "order_details", lambda *_: lines)
    monkeypatch.setattr(sample, "orders", lambda *_: heads)
    monkeypatch.setattr(upkeep, "joined", counted)
    QUERIES[name](spark, "unused")
    # 27 orders at first, 3 late ones, 5 heads that went and came, 3 orders with doubtful lines
    orders = [heads.where(some).count() for some in ("order_id % 10 <> 0", "order_id % 10 = 0", "order_id % 7 = 3", "order_id % 9 = 4")]
    orders[2] *= 2
    if by_line:
        assert met[1:] == [20 * n for n in orders[1:]]
    else:
        assert met == orders


def test_bitmaps_count_exactly_at_any_grain(spark):
    draw = random.Random(5)
    rows = [(draw.choice("ab"), draw.choice([1, 2, None]), draw.choice([0, 1, -1, 32768, 32769, 70_000, None, 5_000_000_000])) for _ in range(400)]
    frame = spark.createDataFrame(rows, "g string, h long, m long")
    rolled = bitmaps.rollup(frame, "m", ["g", "h"])
    for groups, at in ((["g", "h"], lambda r: r[:2]), (["g"], lambda r: r[:1]), (["h"], lambda r: r[1:2])):
        expected = defaultdict(set)
        for row in rows:
            if row[2] is not None:
                expected[at(row)].add(row[2])
        got = {tuple(r[: len(groups)]): r.n for r in bitmaps.distinct_count(rolled, groups, "n").collect()}
        assert got == {k: len(v) for k, v in expected.items()}
    half = bitmaps.rollup(frame.where("m > 1"), "m", ["g"]).unionByName(bitmaps.rollup(frame.where("m <= 32768"), "m", ["g"]))
    whole = {r.g: r.n for r in bitmaps.distinct_count(half, ["g"], "n").collect()}
    assert whole == {r.g: r.n for r in bitmaps.distinct_count(rolled, ["g"], "n").collect()}


def test_digests_name_exactly_what_differs(spark, tmp_path):
    left = spark.range(50_000).select(F.col("id").alias("k"), F.when(F.col("id") % 100 != 0, F.col("id") * 2).alias("v"))
    right = left.where("k <> 77").withColumn("v", F.when(F.col("k") == 500, 0).when(F.col("k") == 9, 7).otherwise(F.col("v")))
    right = right.unionByName(spark.sql("select 60000L k, 1L v")).unionByName(left.where("k = 12345"))
    for name, table in (("l", left), ("r", right)):
        digest_tree.write_tree(table.repartition(3 if name == "l" else 7), ["k"], str(tmp_path / name))
    apart = digest_tree.differing_ranges(spark, str(tmp_path / "l"), str(tmp_path / "r"))
    assert len(apart) <= 5
    found = {r.k: r.state for r in digest_tree.differences(left, right, ["k"], str(tmp_path / "l"), str(tmp_path / "r")).collect()}
    assert found == {77: "missing", 500: "changed", 9: "changed", 60000: "new", 12345: "changed"}
    assert digest_tree.differing_ranges(spark, str(tmp_path / "l"), str(tmp_path / "l")) == []
    assert digest_tree.differences(left, left, ["k"], str(tmp_path / "l"), str(tmp_path / "l")).count() == 0


def test_larger_tables_get_finer_ranges(spark, tmp_path, monkeypatch):
    # as many rows a range as 9 million have, so that spread changes leave most ranges alone
    monkeypatch.setattr(digest_tree, "LEVELS", 2)
    left = spark.range(40_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    right = left.where("k % 400 <> 5").withColumn("v", F.when(F.col("k") % 400 == 6, 2).otherwise(1))
    for name, table in (("l", left), ("r", right), ("few", right.limit(100))):
        digest_tree.write_tree(table, ["k"], str(tmp_path / name))
    apart = digest_tree.differing_ranges(spark, str(tmp_path / "l"), str(tmp_path / "r"))
    ranges = left.select(digest_tree._range(["k"], digest_tree.depth(spark, str(tmp_path / "l"))).alias("n"))
    assert len(apart) <= 200 and ranges.where(F.col("n").isin(apart)).count() < 40_000 / 4
    found = {r.k: r.state for r in digest_tree.differences(left, right, ["k"], str(tmp_path / "l"), str(tmp_path / "r")).collect()}
    assert found == {k: "missing" if k % 400 == 5 else "changed" for k in range(40_000) if k % 400 in (5, 6)}
    # trees of different depth are compared down to the last level that both have
    few = digest_tree.differences(left, right.limit(100), ["k"], str(tmp_path / "l"), str(tmp_path / "few"))
    assert few.where("state <> 'missing'").count() <= 100 and few.count() >= 39_900
