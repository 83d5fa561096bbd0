import pytest
from pyspark.sql import functions as F

from leadpipe.operators import filters, projection, relational


def test_dedup_keeps_first_in_order(frame):
    df = frame([(1, "a", "x"), (2, "a", "y"), (3, "b", "z"), (0, "b", "w")], "n int, k string, v string")
    rows = relational.dedup_first(df, "k", ["n"]).collect()
    assert {(r.k, r.v) for r in rows} == {("a", "x"), ("b", "w")}


def test_dedup_with_a_hot_key(spark):
    rows = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    first = relational.dedup_first(rows, "k", ["id"])
    assert first.count() == 20_001
    assert first.where("k = -1").first().id == 0
    plan = first._jdf.queryExecution().executedPlan().toString()
    # One row per key and task before the shuffle.
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")


def test_anti_existing(frame):
    new = frame(["a", "b", "c"], "JobId string")
    old = frame([("a", 1), ("a", 2), (None, 3)], "JobId string, n int")
    assert {r[0] for r in relational.anti_existing(new, old).collect()} == {"b", "c"}
    assert relational.anti_existing(new, old.limit(0)).count() == 3


def test_territory(frame):
    territory = frame([("CA", "REP_A"), ("ca", "REP_A"), ("NY", "REP_B")], "state string, rep string")
    df = frame(["ca", "CA", "NY", "ZZ", None], "State string")
    rows = relational.territory_lookup(df, territory).collect()
    assert sorted(((r.State or "", r.rep) for r in rows), key=str) == sorted(
        [("ca", "REP_A"), ("CA", "REP_A"), ("NY", "REP_B"), ("ZZ", None), ("", None)], key=str
    )


def test_enrichment(frame):
    df = frame(["A", "A", "B", None], "AccountName string")
    results = frame(
        [("A", 2, "second", 0.5), ("A", 1, "first", 12.5), ("C", 1, "other", 1.0)],
        "query string, rank int, url string, score double",
    )
    links = relational.enrich_top1(df, results).collect()
    assert sorted((str(r.AccountName), r.google_link) for r in links if r.google_link) == [
        ("A", "first"),
        ("A", "first"),
    ]
    assert len(links) == 4
    entities = relational.enrich_kg(df, results).collect()
    assert {r.entity for r in entities} == {"first (12.5)", None}


def test_first_account(frame):
    df = frame(
        [(1, "l", "A"), (0, "l", "B"), (2, "m", "C"), (3, None, "D")],
        "n int, CompanyLink string, AccountName string",
    )
    rows = relational.first_account_for_link(df, "n").collect()
    assert {(r.n, r.firstAccount) for r in rows} == {(1, "B"), (0, "B"), (2, "C"), (3, None)}


def test_best_score_takes_the_first_of_equals(frame):
    df = frame([("k", "a", 5, 1), ("k", "b", 9, 2), ("k", "c", 9, 3)], "k string, v string, s int, pos int")
    assert tuple(relational.best_score(df, "k", "v", "s", "pos").first()) == ("k", "b", 9)


@pytest.mark.parametrize("rows", [0, 1, 99, 100, 101, 5_000])
def test_batches_are_full_and_in_order(spark, rows):
    df = spark.range(rows).select(F.concat(F.lit("k"), F.lpad("id", 6, "0")).alias("k"))
    numbered = relational.batch_number(df.repartition(5), ["k"])
    assert {(r.k, r.batch) for r in numbered.collect()} == {
        (f"k{i:06}", i // 100) for i in range(rows)
    }


def test_batches_of_a_hot_leading_key(spark):
    df = spark.range(9_000).select(F.when(F.col("id") < 8_000, 5).otherwise(6).alias("a"), "id")
    numbered = relational.batch_number(df, ["a", "id"])
    assert {(r.id, r.batch) for r in numbered.collect()} == {(i, i // 100) for i in range(9_000)}


def test_rows_of_one_order_key_are_numbered_by_many_tasks(spark, tmp_path):
    df = spark.range(20_000).select(F.lit(1).alias("a"), "id", F.array("id").alias("more"))
    path = str(tmp_path / "numbered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    try:
        numbered = relational.number_rows(df, ["a"], path=path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.nth for r in numbered.collect()) == list(range(20_000))
    per_task = spark.read.parquet(path).groupBy(F.shiftright("_place", 33)).count().collect()
    assert len(per_task) > 4 and max(r["count"] for r in per_task) < 10_000


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    first = relational.sample_rows(df, "id", 5).collect()
    assert len(first) == 5
    assert first == relational.sample_rows(df.repartition(3), "id", 5).collect()


def test_concat_keeps_duplicates(frame):
    a, b = frame([(1, 2)], "x int, y int"), frame([(2, 1)], "y int, x int")
    assert sorted(map(tuple, relational.concat_pages(a, b, a).collect())) == [(1, 2)] * 3


def test_projections(frame):
    df = frame([(1, None, "x")], "a int, b string, c string")
    assert projection.rename_positional(df, ["p", "q", "r"]).columns == ["p", "q", "r"]
    with pytest.raises(ValueError):
        projection.rename_positional(df, ["p", "q"])
    assert projection.swap_column(df, "b", "c").columns == ["a", "b"]
    with pytest.raises(ValueError):
        projection.drop_columns(df, "zz")
    odd = df.toDF("Job Title", "A/B\\c", "x[^\\w\\s]")
    assert projection.normalize_colnames(odd).columns == ["jobtitle", "abc", "x[^ws]"]
    changed = projection.conditional_assign(df, "c", F.col("b") == "q", F.lit("y"))
    assert changed.first().c == "x"


def test_filters(frame):
    df = frame(["mr", "unknown", "chief", "no longer with us", "", None], "title string")
    assert filters.filter_blocklist(df, "title").count() == 4
    assert filters.filter_not_contains(df, "title").count() == 4
    assert filters.filter_nonempty(df, "title").count() == 4
    assert filters.filter_null(df, "title").count() == 5
    scores = frame([79, 80, None], "titleScore int")
    assert [r[0] for r in filters.filter_score(scores).collect()] == [80]
    days = frame([0, 29, 30, None], "days_ago int")
    assert [r[0] for r in filters.filter_recent(days).collect()] == [0, 29]
    links = frame([([],), (["a"],), (["a", "b"],)], "links array<string>")
    assert filters.has_n_links(links, "links", 1).count() == 1
    assert filters.has_n_links(links, "links", 0).count() == 1
