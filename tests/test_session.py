"""Settings that a session gets."""

from medallion.session import apply_settings


def test_generated_methods_stay_small_enough_for_the_jvm_to_compile(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(limit)
    assert int(apply_settings(spark).conf.get(limit)) <= 8000
