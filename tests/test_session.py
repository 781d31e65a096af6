"""A session that was built without the library's settings."""

import __spark_entry__ as entry

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_queries_limit_the_methods_of_a_plain_session_and_respect_a_limit_of_its_own(spark, sf):
    given = spark.conf.get(LIMIT)
    try:
        for before, after in (("65535", "8000"), ("20000", "20000")):
            spark.conf.set(LIMIT, before)
            entry.queries()["log_object"](spark, sf)
            assert spark.conf.get(LIMIT) == after
    finally:
        spark.conf.set(LIMIT, given)
