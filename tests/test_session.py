from tidemill.session import fresh_path, work_dir


def test_work_dir_is_the_sessions_checkpoint_dir(spark):
    d = work_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir().rstrip("/")
    p1, p2 = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert p1.startswith(d) and p2.startswith(d) and p1 != p2


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.ui.enabled") == "false"
