"""Gold after changes equals gold built from scratch, and a change touches its own folders only."""

import pytest
from pyspark.sql import functions as F

from ledgerlight.checks.inputs import Inputs
from ledgerlight.plans.incremental_gold import apply_silver, refresh_gold
from ledgerlight.plans.layers import build_composite, build_gold
from ledgerlight.sources import keyed as KY
from ledgerlight.sources import writers as WR
from ledgerlight.sources.commits import CommitLog

CELLS = ["cik", "period_end", "distress_label", "altman_z_score", "distress_zone", "revenue_growth_qoq", "net_income_growth_qoq", "asset_growth_qoq", "revenue_declining_3q"]


def cells(df):
    return sorted(str(tuple(r)) for r in df.select(*CELLS).collect())


@pytest.fixture(scope="module")
def layers(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    return inputs.silver.where("cik <= 6").cache(), inputs.universe.cache()


def test_changes_give_what_a_full_build_gives(spark, layers, tmp_path):
    silver, universe = layers
    paths = f"{tmp_path}/silver", f"{tmp_path}/gold"
    first = silver.where("cik % 3 <> 1 AND year(period_end) < 1996")
    apply_silver(first, universe, *paths, buckets=4)
    assert cells(KY.read_keyed(spark, paths[1])) == cells(build_gold(first, universe))
    # later periods, a restated value, assets that vanish
    later = silver.where("cik = 2 AND year(period_end) >= 1996")
    restated = first.where("cik = 3").orderBy("period_end").limit(1).withColumn("revenue", F.lit(1.0))
    vanished = first.where("cik = 5").orderBy(F.desc("period_end")).limit(2).withColumn("assets_total", F.lit(None).cast("double"))
    changed = later.unionByName(restated).unionByName(vanished)
    apply_silver(changed, universe, *paths)
    whole = first.join(changed, ["cik", "period_end"], "left_anti").unionByName(changed)
    assert cells(KY.read_keyed(spark, paths[1])) == cells(build_gold(whole, universe))
    before = CommitLog(spark, paths[1]).latest()
    apply_silver(changed, universe, *paths)  # a repeated run changes nothing
    assert cells(KY.read_keyed(spark, paths[1])) == cells(build_gold(whole, universe)) and before[0] + 1 == CommitLog(spark, paths[1]).latest()[0]
    # a company whose rows all lose their assets leaves gold
    gone = whole.where("cik = 2").withColumn("assets_total", F.lit(None).cast("double"))
    apply_silver(gone, universe, *paths)
    assert KY.read_keyed(spark, paths[1]).where("cik = 2").count() == 0


def test_changed_labels_and_touched_folders(spark, layers, tmp_path):
    silver, universe = layers
    paths = f"{tmp_path}/silver", f"{tmp_path}/gold"
    apply_silver(silver, universe, *paths, buckets=16)
    folders = CommitLog(spark, paths[1]).latest()[1]["folders"]
    company = silver.where("cik = 2").select("cik").distinct()
    relabelled = universe.withColumn("distress_label", F.when(F.col("cik").endswith("0002"), F.lit("1")).otherwise(F.lit("0")))
    assert refresh_gold(spark, company, relabelled, *paths) == 1
    after = CommitLog(spark, paths[1]).latest()[1]["folders"]
    assert sum(after[b] != folders[b] for b in folders) == 1
    read = KY.read_for(spark, paths[0], company)
    assert len({f.rpartition("/")[0] for f in read.inputFiles()}) == 1 and {r.cik for r in read.select("cik").distinct().collect()} == {2}
    assert refresh_gold(spark, spark.createDataFrame([(999_999,)], "cik long"), universe, *paths) in (0, 1)
    assert KY.read_keyed(spark, paths[1]).count() == silver.where("assets_total > 0").count()


def test_large_buckets_are_written_by_several_tasks(spark, layers, tmp_path, monkeypatch):
    silver, universe = layers
    few, many = (f"{tmp_path}/few_silver", f"{tmp_path}/few_gold"), (f"{tmp_path}/many_silver", f"{tmp_path}/many_gold")
    apply_silver(silver, universe, *few, buckets=2)
    monkeypatch.setattr(KY, "TASK_ROWS", 10)
    apply_silver(silver, universe, *many, buckets=2)
    apply_silver(silver.where("cik < 3"), universe, *many)
    for one, several in zip(few, many):
        files = [f.rpartition("/")[0] for f in KY.read_keyed(spark, one).inputFiles()]
        assert len(files) == len(set(files))
        files = [f.rpartition("/")[0] for f in KY.read_keyed(spark, several).inputFiles()]
        assert len(files) > 2 * len(set(files))
    assert cells(KY.read_keyed(spark, many[1])) == cells(KY.read_keyed(spark, few[1])) == cells(build_gold(silver, universe))


def test_folders_of_a_merge_that_only_removes(spark, layers, tmp_path):
    silver, universe = layers
    path = f"{tmp_path}/gold"
    rows = build_gold(silver, universe)
    companies = silver.select("cik").distinct()
    KY.merge_keyed(rows, path, ["cik", "period_end"], buckets=4, by=["cik"], replaced=companies)
    before = CommitLog(spark, path).latest()[1]["folders"]
    # stored rows of one company go, none come: its bucket keeps the others, or has no folder
    KY.merge_keyed(rows.where("cik = -1"), path, ["cik", "period_end"], by=["cik"], replaced=companies.where("cik = 2"))
    after = CommitLog(spark, path).latest()[1]["folders"]
    assert set(after) <= set(before) and KY.read_keyed(spark, path).where("cik = 2").count() == 0
    assert KY.read_keyed(spark, path).count() == rows.where("cik <> 2").count()


def test_bucketed_silver_needs_no_exchange_below_the_windows(spark, layers):
    silver, universe = layers
    WR.write_bucketed(silver, "silver_by_company", ["cik"], ["form_type", "period_end"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.table("silver_by_company")
        assert cells(build_gold(stored, universe)) == cells(build_gold(silver, universe))
        plan = build_gold(stored, universe)._jdf.queryExecution().executedPlan().toString()
        # the labels are dealt out to the buckets of silver; silver itself stays where it is
        exchanges = [line for line in plan.split("\n") if "Exchange" in line]
        assert len(exchanges) == 1 and "Window" in plan and plan.index("Window") < plan.index("Exchange")
        WR.write_bucketed(build_gold(stored, universe), "gold_by_company", ["cik"], ["form_type", "period_end"], 4)
        gold = spark.table("gold_by_company")
        own = build_composite(gold)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(cik" not in own.split("gold_by_company")[0] or own.count("Exchange") <= 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS silver_by_company")
        spark.sql("DROP TABLE IF EXISTS gold_by_company")
