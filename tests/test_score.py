from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pathgauge.params import ScorePick, profile
from pathgauge.plans import score

PARAMS = profile("2022Q2")
T0, T1 = PARAMS.reference_year, PARAMS.end_year

CONNECTED = (
    "id long, equity_market string, scenario_source string, scenario string, scenario_geography string, "
    "ald_sector string, technology string, year int, plan_tech_prod double, scen_tech_prod double"
)
BRIDGE = "company_name string, company_id long, sector_assessed string"


def cell(id, tech, year, plan, scen, sector="Power", source="WEO2022", name="NZE_2050", geo="Global", market="GlobalMarket"):
    return (id, market, source, name, geo, sector, tech, year, plan, scen)


def two(id, tech, start, end, **other):
    return [cell(id, tech, T0, *start, **other), cell(id, tech, T1, *end, **other)]


def frames(spark, data, bridge=(("A", 1, "Power"),)):
    return spark.createDataFrame(list(data), CONNECTED), spark.createDataFrame(list(bridge), BRIDGE)


def test_shares(spark):
    data = (
        two(1, "CoalCap", (60.0, 60.0), (50.0, 40.0))
        + two(1, "HydroCap", (40.0, 40.0), (50.0, 60.0))
        + two(1, "CoalCap", (5.0, 5.0), (5.0, 5.0), market="Other")
        + two(9, "CoalCap", (5.0, 5.0), (5.0, 5.0))
        + [cell(1, "CoalCap", T0 + 1, 5.0, 5.0)]
        + two(1, "BOF", (5.0, 5.0), (5.0, 5.0), sector="Steel")
    )
    got = score.tech_share(*frames(spark, data), PARAMS)
    assert rows(got, "technology", "year", "plan_sec_prod", "scen_sec_prod", "plan_tech_share", "scen_tech_share") == [
        ("CoalCap", T0, 100.0, 100.0, 0.6, 0.6),
        ("CoalCap", T1, 100.0, 100.0, 0.5, 0.4),
        ("HydroCap", T0, 100.0, 100.0, 0.4, 0.4),
        ("HydroCap", T1, 100.0, 100.0, 0.5, 0.6),
    ]


def test_equal_scenario_names_of_two_sources_pool_in_the_total(spark):
    data = two(1, "CoalCap", (10.0, 10.0), (10.0, 10.0)) + two(
        1, "CoalCap", (30.0, 30.0), (30.0, 30.0), source="OTHER"
    )
    got = score.tech_share(*frames(spark, data), PARAMS).where(F.col("year") == T1)
    assert rows(got, "scenario_source", "plan_sec_prod", "plan_tech_share") == [
        ("OTHER", 40.0, 0.75),
        ("WEO2022", 40.0, 0.25),
    ]


def test_two_listed_sectors_double_sums_but_not_ratios(spark):
    data = two(1, "CoalCap", (60.0, 60.0), (50.0, 40.0)) + two(1, "HydroCap", (40.0, 40.0), (50.0, 60.0))
    single = score.scored_technologies(*frames(spark, data), PARAMS)
    double = score.scored_technologies(*frames(spark, data, [("A", 1, "Power"), ("A", 1, "HDV")]), PARAMS)
    assert rows(double, "technology", "year", "plan_tech_prod") == [
        (t, y, 2 * p) for t, y, p in rows(single, "technology", "year", "plan_tech_prod")
    ]
    columns = ["technology", "year", "plan_tech_share", "trajectory_alignment", "single_score_Case8"]
    assert rows(double, *columns) == rows(single, *columns)


def factors(spark, data, **options):
    return score.scored_technologies(*frames(spark, data, **options), PARAMS)


def test_weights(spark):
    data = (
        # Most relevant: the larger change and the larger end value count.
        two(1, "CoalCap", (100.0, 100.0), (150.0, 40.0))
        + two(1, "RenewablesCap", (10.0, 10.0), (20.0, 80.0))
        # Not most relevant: always the scenario's.
        + two(1, "HydroCap", (10.0, 10.0), (90.0, 20.0))
    )
    got = factors(spark, data).where(F.col("year") == T1)
    columns = ["technology", "scenario_change", "production_change", "tech_allocation_weight", "trajectory_alignment", "type"]
    assert rows(got, *columns) == [
        ("CoalCap", 60.0, 50.0, 150.0, -2.75, "Brown"),
        ("HydroCap", 10.0, 80.0, 20.0, 3.5, "Green"),
        ("RenewablesCap", 70.0, 10.0, 80.0, -0.75, "Green"),
    ]
    weights = {"CoalCap": 60 * 150, "HydroCap": 10 * 20, "RenewablesCap": 70 * 80}
    alignments = {"CoalCap": -2.75, "HydroCap": 3.5, "RenewablesCap": -0.75}
    mean = sum(weights[t] * alignments[t] for t in weights) / sum(weights.values())
    assert {round(r[0], 12) for r in got.select("single_score_Case8").collect()} == {round(mean, 12)}


def test_production_change_larger_than_the_scenarios(spark):
    got = factors(spark, two(1, "CoalCap", (100.0, 100.0), (190.0, 40.0)))
    assert rows(got.where(F.col("year") == T1), "scenario_change", "production_change") == [(90.0, 90.0)]


def test_zero_scenario(spark):
    data = two(1, "CoalCap", (5.0, 5.0), (0.0, 0.0)) + two(1, "HydroCap", (5.0, 5.0), (3.0, 0.0)) + two(
        1, "GasCap", (5.0, 5.0), (3.0, 0.0)
    )
    got = factors(spark, data).where(F.col("year") == T1)
    alignment = {r.technology: r.trajectory_alignment + 0.0 for r in got.collect()}
    assert alignment == {"CoalCap": 0.0, "HydroCap": 1.0, "GasCap": -1.0}


def test_one_year_is_both_first_and_last(spark):
    got = factors(spark, [cell(1, "HydroCap", T1, 30.0, 20.0)])
    assert rows(got, "year", "scenario_change", "production_change", "single_score_Case8") == [
        (T1, 0.0, 10.0, None)  # no change, no weight, no score
    ]


def test_a_series_missing_in_one_year_leaves_the_others_score_alone(spark):
    data = two(1, "CoalCap", (100.0, 100.0), (150.0, 40.0)) + [cell(1, "HydroCap", T0, 10.0, 20.0)]
    got = factors(spark, data)
    assert rows(got.where(F.col("year") == T1), "technology", "single_score_Case8") == [("CoalCap", -2.75)]
    assert got.where(F.col("year") == T0).count() == 2


def test_untyped_technology_counts_in_totals_then_drops_out(spark):
    data = two(1, "Electric", (1.0, 1.0), (1.0, 2.0), sector="Automotive") + two(
        1, "FuelCell", (3.0, 3.0), (3.0, 2.0), sector="Automotive"
    )
    got = factors(spark, data).where(F.col("year") == T1)
    assert rows(got, "technology", "plan_tech_share", "scen_tech_share") == [("Electric", 0.25, 0.5)]


def test_missing_values_sum_to_zero(spark):
    got = factors(spark, two(1, "HydroCap", (None, None), (None, 4.0)))
    assert rows(got, "year", "plan_tech_prod", "scen_tech_prod") == [(T0, 0.0, 0.0), (T1, 0.0, 4.0)]


def test_scores_equal_those_beside_the_technologies(spark):
    data = []
    for id in (1, 2, 3):
        for tech, factor in (("CoalCap", 0.5), ("HydroCap", 1.5), ("RenewablesCap", 2.0)):
            data += two(id, tech, (10.0 * id, 10.0 * id), (7.0 * id + id * id, 10.0 * id * factor))
            data += two(id, tech, (10.0 * id, 10.0 * id), (7.0 * id, 9.0), name="APS")
            data += two(id, tech, (10.0 * id, 10.0 * id), (7.0 * id, 9.0), geo="OECD")
    bridge = [("A", 1, "Power"), ("B", 2, "Power"), ("B", 3, "Power")]
    connected, listed = frames(spark, data, bridge)
    scores = score.company_scores(connected, listed, PARAMS)
    beside = score.scored_technologies(connected, listed, PARAMS).where(
        (F.col("year") == T1) & (F.col("scenario") == "NZE_2050")
    )
    want = beside.select("ald_sector", "company_name", "single_score_Case8").distinct()
    assert rows(scores) == rows(want)
    assert scores.count() == 3  # company B keeps one score per id


def test_score_needs_no_sector_totals(spark):
    connected, listed = frames(spark, two(1, "CoalCap", (1.0, 1.0), (1.0, 1.0)))
    plan = score.company_scores(connected, listed, PARAMS)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_score_reads_only_the_picked_sources(spark, tmp_path):
    data = two(1, "CoalCap", (1.0, 1.0), (1.0, 2.0)) + two(1, "CoalCap", (1.0, 1.0), (1.0, 2.0), source="OTHER")
    connected, listed = frames(spark, data)
    path = str(tmp_path / "connected")
    connected.write.partitionBy("scenario_source").parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        scores = score.company_scores(spark.read.parquet(path), listed, PARAMS)
        plan = scores._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [((scenario_source" in plan and "In(year, [2022,2027])" in plan
    assert rows(scores, "single_score_Case8") == [(0.5,)]


def test_sector_pick_and_truck_companies(spark):
    data = two(1, "CoalCap", (1.0, 1.0), (1.0, 2.0)) + two(1, "CoalCap", (1.0, 1.0), (1.0, 4.0), name="APS")
    for id in (2, 3):
        data += two(id, "ICE_HDV", (1.0, 1.0), (1.0, 2.0), sector="HDV", source="ETP2017", name="B2DS")
    bridge = [("CEZ as", 1, "Power"), ("Volvo AB", 2, "HDV"), ("Other", 3, "HDV")]
    got = score.company_scores(*frames(spark, data, bridge), PARAMS)
    assert rows(got) == [("HDV", "Volvo", 0.5), ("Power", "CEZ, a.s.", 0.5)]
    free = profile("2022Q2", score_picks={"HDV": ScorePick("ETP2017", "B2DS")})
    assert rows(score.company_scores(*frames(spark, data, bridge), free), "company_name") == [("Other",), ("Volvo",)]


def test_rank_class_and_light(spark):
    data = [("Power", "a", 0.5), ("Power", "b", 0.0), ("Power", "c", -0.1), ("Power", "d", None), ("HDV", "a", -1.0), ("HDV", "b", -1.0)]
    df = spark.createDataFrame(data, "ald_sector string, company_name string, single_score_Case8 double")
    got = score.score_result(df)
    yes, no = "Aligned with NZE  (1.5°C)", "Misaligned with NZE  (1.5°C)"
    assert rows(got, "ald_sector", "company_name", "rank", "aggregate_score_class", "aggregate_score_traffic_light") == [
        ("HDV", "a", 1.5, "Misaligned", "Red"),
        ("HDV", "b", 1.5, "Misaligned", "Red"),
        ("Power", "a", 2.0, yes, "Green"),
        ("Power", "b", 3.0, yes, "Green"),
        ("Power", "c", 4.0, no, "Red"),
        ("Power", "d", None, no, "Red"),
    ]


def comm_data():
    return (
        two(1, "CoalCap", (100.0, 100.0), (150.0, 40.0))
        + two(1, "RenewablesCap", (10.0, 10.0), (20.0, 80.0))
        + [cell(1, "HydroCap", T0, 10.0, 20.0)]
        + two(2, "ICE", (10.0, 10.0), (20.0, 5.0), sector="Automotive")
    )


def test_communication_plan_equals_its_join_form(spark):
    scored = score.scored_technologies(
        *frames(spark, comm_data(), [("A", 1, "Power"), ("B", 2, "Automotive")]), PARAMS
    )
    got = score.communication_plan(scored, PARAMS)
    keys = ["technology", "ald_sector", "company_name", "scenario", "scenario_geography"]
    wide = score.values_wide(scored, PARAMS)
    end = scored.where(F.col("year") == T1)
    total = end.groupBy(keys[1:]).agg(F.sum("weighting_factor").alias("total"))
    left = end.join(total, keys[1:]).withColumn("weighting_factor", F.col("weighting_factor") / F.col("total"))
    want = left.join(wide, keys, "right").select(got.columns)
    assert rows(got) == rows(want)
    assert got.count() == 4 and got.where("type is null").count() == 1


def test_normalised_weights_sum_to_one(spark):
    scored = score.scored_technologies(*frames(spark, comm_data()), PARAMS)
    total = score.communication_plan(scored, PARAMS).agg(F.sum("weighting_factor")).collect()[0][0]
    assert total == pytest.approx(1.0)


def test_communication_plan_rejects_two_ids_of_one_company(spark):
    data = two(1, "CoalCap", (1.0, 1.0), (1.0, 2.0)) + two(2, "CoalCap", (1.0, 1.0), (1.0, 2.0))
    scored = score.scored_technologies(*frames(spark, data, [("A", 1, "Power"), ("A", 2, "Power")]), PARAMS)
    with pytest.raises(Exception, match="more than one row"):
        score.communication_plan(scored, PARAMS).collect()
    with pytest.raises(Exception, match="more than one row"):
        score.values_wide(scored, PARAMS).collect()
