"""Session defaults that the speed of the wide request stages rests on."""


def test_no_stage_is_left_to_the_interpreter(spark):
    from ledgerlark.session import ensure_defaults

    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    ensure_defaults(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
