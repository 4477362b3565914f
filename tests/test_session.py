from churnlens.session import DEFAULTS, get_spark


def test_get_spark_respects_explicit_settings(spark):
    s = get_spark(conf={"spark.sql.adaptive.skewJoin.enabled": "false"})
    assert s is spark  # reuses the running session
    assert s.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    assert s.conf.get("spark.sql.adaptive.enabled") == DEFAULTS["spark.sql.adaptive.enabled"]
    s.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
