"""Parsers on bodies that the tables don't have."""

from pyspark.sql import functions as F

from tidemill.operators import parse


def test_delimited_cells_and_xml_values_of_any_length(spark):
    long = "x, " * 100_000 + "end"
    df = spark.createDataFrame([(f'"{long}"|a\nshort|b', f"<r><item><v>{long}</v></item></r>", "item")], "body string, xml string, selector string")
    got = df.select(F.explode(parse.delimited_records(F.col("body"), ["text", "source"], "|")).alias("r")).collect()
    assert [dict(x.r) for x in got] == [{"text": long, "source": "a"}, {"text": "short", "source": "b"}]
    assert [r.record for r in parse.xml_records(df, "xml", "selector", ["body"]).collect()] == [f'{{"v":"{long}"}}']
