import importlib


def test_entry_runs(spark):
    mod = importlib.import_module("__spark_entry__")
    df = mod.entry(spark)
    assert df.count() > 0
    assert set(mod.queries()) == set(mod.oracle_sql()) | (set(mod.queries()) - set(mod.oracle_sql()))
    assert [f.name for f in df.schema.fields] == [
        "interval_start_utc", "interval_start_uk", "kwh", "tariff_code", "unit_rate", "cost",
        "usage_date", "hour_of_day", "time_band"]
