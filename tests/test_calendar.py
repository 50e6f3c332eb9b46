from datetime import datetime

from starloom.operators.calendar import build_time_dimension, update_time_dimension


def sales(spark, *dates):
    return spark.createDataFrame([(d,) for d in dates], "order_date timestamp")


def test_one_year_has_802_rows(spark):
    dim = build_time_dimension(sales(spark, datetime(2019, 9, 17, 14, 44)))
    rows = dim.collect()
    assert len(rows) == 802
    by_id = {(r["timebranch"], r["time_id"]): r for r in rows}
    d = by_id[("main", "D_20190917")]
    assert (d["time_name"], d["time_parent"], d["time_lvl"], d["time_combined_id"]) == \
        ("2019-09-17", "M_20199", "0", "M_D_20190917")
    m = by_id[("main", "M_20199")]
    assert (m["time_name"], m["time_parent"], m["time_lvl"]) == ("2019-9", "Q_20193", "1")
    assert by_id[("main", "Q_20193")]["time_parent"] == "HY_20192"
    assert by_id[("main", "HY_20192")]["time_name"] == "HY_2-2019"
    assert by_id[("main", "Y_2019")]["time_parent"] is None
    assert by_id[("main", "Y_2019")]["time_lvl"] == "4"
    # Dec 30-31 2019 belong to ISO week 1 of 2020.
    assert by_id[("week", "D_20191231")]["time_parent"] == "W_20201"
    assert by_id[("week", "W_20201")]["time_name"] == "W_1-2020"
    assert len({r["time_combined_id"] for r in rows}) == 802


def test_leading_week_of_previous_year_is_orphaned(spark):
    rows = build_time_dimension(sales(spark, datetime(2021, 3, 1))).collect()
    assert len(rows) == 802
    week_days = {r["time_id"]: r["time_parent"] for r in rows if r["timebranch"] == "week" and r["time_lvl"] == "0"}
    assert [d for d, p in week_days.items() if p is None] == ["D_20210101", "D_20210102", "D_20210103"]
    assert any(r["time_id"] == "W_202053" for r in rows)


def test_two_years_and_empty(spark):
    assert build_time_dimension(sales(spark, datetime(2019, 1, 5), datetime(2020, 6, 1))).count() == 1605
    assert build_time_dimension(spark.createDataFrame([], "order_date timestamp")).count() == 0


def test_update_appends_only_new_rows(spark):
    dim = build_time_dimension(sales(spark, datetime(2019, 1, 5)))
    added, full = update_time_dimension(dim, sales(spark, datetime(2019, 1, 5), datetime(2020, 2, 2)))
    assert full.count() == 1605
    assert added.count() == 1605 - 802 + 0
    again, _ = update_time_dimension(full, sales(spark, datetime(2019, 1, 5), datetime(2020, 2, 2)))
    assert again.count() == 0


def test_update_time_table_via_catalog(spark):
    from starloom.operators.calendar import update_time_table
    spark.sql("DROP TABLE IF EXISTS time_dimension_t")
    assert update_time_table(spark, "time_dimension_t", sales(spark, datetime(2019, 1, 5))) is None
    build_time_dimension(sales(spark, datetime(2019, 1, 5))).write.saveAsTable("time_dimension_t")
    assert update_time_table(spark, "time_dimension_t", sales(spark, datetime(2020, 1, 5))) == 803
    assert spark.table("time_dimension_t").count() == 1605
    spark.sql("DROP TABLE time_dimension_t")
