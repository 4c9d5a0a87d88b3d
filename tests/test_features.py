from subscope.operators.features import add_features

FIELDS = (
    "total_day_minutes double, total_eve_minutes double, total_night_minutes double, "
    "total_day_calls double, total_eve_calls double, total_night_calls double, "
    "total_day_charge double, total_eve_charge double, total_night_charge double, "
    "total_intl_minutes double, total_intl_calls double, total_intl_charge double"
)


def derive(spark, *row):
    return add_features(spark.createDataFrame([row], FIELDS)).first()


def test_international_use_enters_the_charge_only(spark):
    r = derive(spark, 10.0, 20.0, 30.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 100.0, 50.0, 7.0)
    assert (r["total_minutes"], r["total_calls"], r["total_charge"]) == (60.0, 6.0, 22.0)
    assert r["avg_minutes_per_call"] == 10.0
    assert r["daytime_ratio"] == 10.0 / 60.0


def test_no_calls_and_no_minutes(spark):
    r = derive(spark, *[0.0] * 12)
    assert r["avg_minutes_per_call"] == 0.0
    assert r["daytime_ratio"] is None


def test_null_calls_give_zero_per_call(spark):
    r = derive(spark, 1.0, 1.0, 1.0, None, 1.0, 1.0, *[0.0] * 6)
    assert r["total_calls"] is None
    assert r["avg_minutes_per_call"] == 0.0


def test_division_does_not_depend_on_ansi_mode(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            assert derive(spark, *[0.0] * 12)["daytime_ratio"] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
