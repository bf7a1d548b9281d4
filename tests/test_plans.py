"""What the plans look like when nothing is small enough to be broadcast."""

import pytest
from pyspark.sql import functions as F

from cobasket.operators import baskets as bk, enrich, mining, search, summary, views
from cobasket.plans import catalog, staging
from cobasket.sources import patterns, tables

BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def large(spark):
    before = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield spark
    spark.conf.set(BROADCAST, before)


@pytest.mark.parametrize("name", catalog.queries())
def test_no_query_compares_all_rows_with_all(large, small, name):
    plan = plan_of(catalog.queries()[name](large, small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # A broadcast that the threshold does not choose must be one of the bounded ones.
    if "BroadcastHashJoin" in plan:
        assert name in {"ranked_patterns", "enriched_patterns", "patterns_nested", "similar_items",  # of a global rank
                        "frequent_pairs", "attribute_pairs", "train_patterns",  # bitmap of buckets
                        "snapshot_differences"}  # list of buckets
    assert "Python" not in plan


def test_filters_and_columns_reach_the_scan(large, small):
    plan = plan_of(search.filter_high_rated(staging.products(large, small), 3.0, 30).select("asin"))
    assert "GreaterThanOrEqual(avg_rating,3.0)" in plan and "GreaterThanOrEqual(total_reviews,30)" in plan
    assert "title" not in plan.partition("ReadSchema")[2]
    plan = plan_of(search.search_form(staging.products(large, small), group="ECONOMY", min_rating=3.0))
    assert "EqualTo(product_group,ECONOMY)" in plan and "TakeOrderedAndProject" in plan
    plan = plan_of(summary.top_reviewers(staging.reviewed(large, small)))
    assert "GreaterThanOrEqual(rating,4)" in plan
    assert "ReadSchema: struct<customer_id:bigint,rating:int>" in plan


@pytest.mark.parametrize("build", [bk.baskets, bk.baskets_sampled_items])
def test_baskets_are_limited_before_the_shuffle(large, small, build):
    plan = plan_of(build(staging.reviews(large, small), 20))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 2  # one to make rows distinct, one per basket


def test_samples_are_limited_before_the_shuffle(large, small):
    plan = plan_of(enrich.sample_customers(staging.customer_pairs(large, small), staging.reviews(large, small)))
    # Customers of a pair are cut in the tasks and after the shuffle; their ratings are joined by then, in place.
    assert plan.count("WindowGroupLimit") == 3


def test_category_analysis_shuffles_edges_once(large, small):
    plan = plan_of(summary.category_analysis(staging.belongs_to(large, small), staging.products(large, small)))
    assert plan.count("Exchange hashpartitioning") == 3  # both sides of the join, and the sums per category


def test_validation_forces_no_broadcast(large, small):
    plan = plan_of(mining.validate_patterns(staging.train_pairs(large, small), staging.split(large, small)))
    assert "Broadcast" not in plan


def shuffled(df, *columns):
    """Rows that the exchanges on these columns wrote, after a run of the query."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange" and all(c in node.outputPartitioning().toString() for c in columns):
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return found


SKEW = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}


@pytest.fixture
def skewed(large):
    before = {k: large.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        large.conf.set(k, v)
    yield large
    for k, v in before.items():
        large.conf.unset(k) if v is None else large.conf.set(k, v)


def hot_reviews(spark, n=150_000):
    """Reviews, a third of them by one customer."""
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("customer_id"),
                                 F.col("id").alias("product_id"), F.lit(1).alias("rating"))


def test_a_hot_customer_is_split(skewed):
    rows = bk.basket_rows(hot_reviews(skewed))
    rows.collect()
    plan = plan_of(rows)
    assert "skew=true" in plan and "LeftSemi" in plan
    sizes = mining.item_rows(rows).groupBy("customer_id").count()
    joined = mining.item_rows(rows).join(sizes, "customer_id")
    joined.collect()
    assert "skew=true" not in plan_of(joined)  # the same join with an aggregate that isn't stored


def test_the_blocks_of_a_hot_customer_are_dealt_out(skewed):
    kept = bk.basket_rows(hot_reviews(skewed))
    groups = mining.pair_groups(mining.kept_rows(kept, 1), block=5000).select("_i", "_j", F.size("_items").alias("n"))
    found = groups.collect()
    assert "skew=true" in plan_of(groups)
    assert max(r.n for r in found) < 2 * 5000 * 1.5 and len(found) > 50


def test_infrequent_pairs_are_not_shuffled(large):
    """Many pairs that occur once and few that occur often: the second pass moves the few."""
    rows = large.range(40_000).select((F.col("id") / 20).cast("int").alias("customer_id"),
                                      (F.xxhash64("id") % 3000).alias("item"))
    rows = rows.unionByName(large.range(2000).select(F.col("id").cast("int").alias("customer_id"), F.explode(
        F.array(F.lit(-9001).cast("long"), F.lit(-9002).cast("long"))).alias("item"))).distinct()
    groups = mining.pair_groups(rows).localCheckpoint()
    plain = mining.pairs_of(groups).groupBy("item1", "item2").agg(F.count("*").alias("support")).filter("support >= 5")
    pruned = mining.counted_pairs(groups, 5)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, pruned.collect())) != []
    before, after = (sum(shuffled(df, "item1", "item2")) for df in (plain, pruned))
    assert before > 300_000 and after < before / 10


def test_scans_of_buckets_do_not_shuffle_edges(large, small):
    plan = plan_of(tables.scan_end(large, staging.bucketed(large, small), "reviewed", "product_id"))
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    plan = plan_of(tables.scan_both_ends(large, staging.bucketed(large, small), "reviewed"))
    assert plan.count("Exchange hashpartitioning") <= 2 and "hashpartitioning(_customer_id" not in plan


def test_ranks_are_found_by_statistics(large, small):
    """The filter reaches the scan, and of many patterns only those of a few row groups and pages are read."""
    path = staging.scratch_path(large, "many-patterns")
    many = large.range(1, 200_001).select(F.col("id").alias("rank"), F.struct(
        *[F.lit(None).cast(t).alias(n) for n, t in (("asin1", "string"), ("asin2", "string"), ("title1", "string"), (
            "title2", "string"), ("avgRating1", "double"), ("avgRating2", "double"))]).alias("products"),
        F.col("id").alias("support"), F.lit(0.5).alias("confidence"),
        F.array().cast("array<struct<customer_id:string,rating1:double,rating2:double>>").alias("sample_customers"))
    patterns.write_ranked(many.repartition(5), path)
    top = views.pattern_overview(patterns.read_ranked(large, path))
    assert "PushedFilters: [IsNotNull(rank), LessThanOrEqual(rank,20)]" in plan_of(top)
    assert "products" not in plan_of(top).partition("ReadSchema")[2]
    found = top.collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 21))
    scan = top._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() <= 20_000
    one = views.pattern_detail(patterns.read_ranked(large, path), rank=150_000)
    assert "EqualTo(rank,150000)" in plan_of(one) and one.count() == 1


def test_text_is_parsed_without_a_shuffle(large, small):
    assert "Exchange" not in plan_of(staging.parsed(large, small))


def test_results_do_not_depend_on_the_number_of_partitions(spark, small):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for partitions in ("1", "4", "32"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            reviews = staging.reviews(spark, small).repartition(int(partitions), F.rand())
            pairs = mining.frequent_pairs(bk.baskets_sampled_items(reviews, 20), 4)
            ranked = mining.ranked_patterns(pairs, 100)
            found.append(sorted(tuple(r) for r in ranked.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] and len(found[0]) > 100
