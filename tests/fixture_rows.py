"""Paths and rows of the fixture files."""

import os

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


def fixture_path(name):
    return os.path.join(FIXTURES, name)


def read_fixture(spark, name, ddl, positions=None):
    """Read a header-less fixture CSV by position; ``seq`` = line number (file order)."""
    from pyspark.sql import functions as F
    from eventide.sources.files import parse_delimited, read_lines
    lines = read_lines(spark, fixture_path(name)).coalesce(1).withColumn("seq", F.monotonically_increasing_id())
    return parse_delimited(lines, ddl, positions=positions, keep=["seq"])
