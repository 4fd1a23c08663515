"""Shapes of physical plans that matter at size."""

from pyspark.sql import functions as F

from tidemark.functions.columns import row_hash, with_scd2
from tidemark.operators import changes
from tidemark.operators.scd2 import scd2_parts
from tidemark.session import stored


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def two_sides(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    dim = stored(with_scd2(rows, ["k", "v"], "2024-01-01"), "dim", ("Iscurrent",))
    staged = rows.withColumns({"hash": row_hash(["k", "v"]), "batch_id": F.lit(1)})
    return dim, stored(staged, "staged", ("batch_id",))


def test_anti_joins(spark):
    dim, staged = two_sides(spark)
    assert "LeftAnti" in plan(changes.new_keys(staged, dim, ["k"]))
    text = plan(changes.not_current(staged, dim, ["k"]))
    assert "LeftAnti" in text and "LeftOuter" not in text


def test_latest_batch_prunes_partitions(spark):
    _, staged = two_sides(spark)
    assert "PartitionFilters: [isnotnull(batch_id" in plan(changes.latest_batch(staged))


def test_open_rows_and_batch_are_read_once(spark):
    dim, staged = two_sides(spark)
    text = plan(scd2_parts(dim, staged, ["k"], "2024-02-01").open)
    assert text.count("FileScan") == 2 and text.count("FullOuter") == 1
    # One exchange of the open rows, one of the batch on its way to a row per key.
    assert text.count("Exchange hashpartitioning") == 2
    assert "PartitionFilters: [isnotnull(Iscurrent" in text


def test_closed_rows_are_read_without_a_shuffle(spark):
    dim, staged = two_sides(spark)
    assert "Exchange" not in plan(scd2_parts(dim, staged, ["k"], "2024-02-01").closed)


def test_shared_folder_is_the_session_s(spark):
    from tidemark.session import shared_path

    assert shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_merge_leaves_other_rows_out_of_the_join(spark):
    from tidemark.operators.scd2 import scd2_single_merge

    dim, staged = two_sides(spark)
    text = plan(scd2_single_merge(dim, staged.drop("batch_id"), ["k"], "2024-02-01"))
    joined = text[text.index("LeftOuter"):]
    assert "PartitionFilters: [isnotnull(Iscurrent" in joined


def test_order_lines_are_moved_without_what_their_order_brings(spark, sf_dir):
    from tidemark.checks import inputs

    text = plan(inputs.order_lines(spark, sf_dir))
    lines = [at for at in text.split("Exchange hashpartitioning(")[1:] if at.startswith(("l_partkey", "l_orderkey"))]
    assert [at.split("#")[0] for at in lines] == ["l_orderkey", "l_partkey"] or [at.split("#")[0] for at in lines] == ["l_partkey"]
    assert "c_name" not in text[text.index("hashpartitioning(l_partkey"):].split("Exchange")[0]
    assert "BroadcastHashJoin [l_partkey" not in text and "BroadcastHashJoin [o_custkey" not in text


def test_dimension_of_repeated_rows_drops_copies_before_sorting(spark):
    from tidemark.plans import star

    names = star.model.CUSTOMER_COLUMNS
    rows = stored(spark.range(40).select(*[(F.col("id") % 2).cast("string").alias(c) for c in names]), "rows")
    made = star.build_dimension(rows, names, "customer_id", "2024-01-01", repeated=True)
    text = plan(made)
    assert text.rindex("HashAggregate") > text.rindex("Sort [")
    assert sorted(r.customer_id for r in made.collect()) == ["0", "1"]


def test_dimension_is_written_before_it_is_numbered(spark):
    from tidemark.plans import star

    rows = spark.createDataFrame([("b", 0.0), ("a", 1.0), ("a", -0.0), (None, 2.0)], "k string, v double")
    made = star.build_dimension(rows, ["k", "v"], "k", "2024-01-01", surrogate="n", repeated=True)
    assert "FileScan parquet" in plan(made)
    assert [tuple(r) for r in made.orderBy("n").select("n", "k", "v").collect()] == [(1, None, 2.0), (2, "a", 0.0), (3, "b", 0.0)]


def test_order_ids_that_are_numbers(spark):
    from tidemark.plans import star

    ids = ["12", " 12\t", "+7", "-7", "n1", "1e3", "1.5", "", None, "9223372036854775808", "\u0663", "1_0", "5L", "0x1"]
    rows = spark.createDataFrame([(i,) for i in ids], "order_id string")
    want = [r[0] for r in rows.selectExpr("try_cast(order_id AS bigint)").collect()]
    assert [r[0] for r in rows.select(star._order_number()).collect()] == want
    assert want[:4] == [12, 12, 7, -7] and star.order_rejects(rows).count() == want.count(None)


def test_the_order_file_is_packed_and_in_parts(spark, sf_dir, tmp_path, monkeypatch):
    from tidemark.checks import dims

    folder = tmp_path / "order-file"
    monkeypatch.setattr(dims, "shared_path", lambda spark, label: str(folder))
    whole = sorted(map(tuple, dims.pl_csv_to_star(spark, sf_dir).collect()), key=str)
    text = sum(len(r.value) + 1 for r in spark.read.text(str(folder)).collect())
    parts = list(folder.glob("part-*"))
    assert sum(p.stat().st_size for p in parts) < text / 2
    folder = tmp_path / "many"
    monkeypatch.setattr(dims, "LINES_PER_FILE", 500)
    assert sorted(map(tuple, dims.pl_csv_to_star(spark, sf_dir).collect()), key=str) == whole
    lines = dict((name, n) for name, n, _ in whole)
    assert len(list(folder.glob("part-*"))) >= (lines["fact"] + lines["broken_line"]) / 500
