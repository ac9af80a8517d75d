"""Sites as rows: what a rule may say, and what is refused."""
import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import extract, site_rules
from bazaarlens.operators.selectors import STEP

PAGES = "source_site string, listing_url string, html string"


def rows(spark, schema, *given):
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([[r.get(c) for c in names] for r in given], schema)


def rule(field, source, **more):
    return {"site": "New", "field": field, "source": source} | more


SELECTORS = ({"selector": "h6", "step": 0, "tag": "h6"}, {"selector": "b", "step": 0, "tag": "b"},
             {"selector": "quote", "step": 0, "tag": "i", "attr": "title", "op": "^=", "value": "it's \\"},
             {"selector": "json", "step": 0, "tag": "script", "class_regex": "^da'?ta$"})


def read(spark, html, *rules, functions=None, selectors=SELECTORS):
    pages = spark.createDataFrame([("New", "https://x/a-b/1", html), ("Flippa", "f", "<h1>F</h1>"), ("Other", "o", "<h1>O</h1>"), (None, "n", "")], PAGES)
    out = site_rules.extract_by_rules(pages, rows(spark, site_rules.RULE, *rules), rows(spark, STEP, *selectors), functions,
                                      {"Flippa": extract.EXTRACTORS["Flippa"]})
    return {r["source_site"]: r for r in out.collect()}


def test_rules_in_their_order(spark):
    title = (rule("title", "element", selector="h6", option=0, required=True), rule("title", "url", pattern="/([a-z]+-[a-z]+)/", option=1))
    price = (rule("price", "element", selector="b", option=0), rule("price", "page", pattern=r"only (\S+)", option=1))
    got = read(spark, "<h6> T </h6><b>$0</b> only $3k", *title, *price)
    assert (got["New"].title, got["New"].price, got["Flippa"].title) == ("T", 3000.0, "F") and set(got) == {"New", "Flippa"}
    got = read(spark, "<h6> </h6><b>$2</b> only $3k", *title, *price)["New"]
    assert (got.title, got.price) == ("a-b", 2.0)
    assert "New" not in read(spark, "<h6> </h6>", title[0])  # a required field without a text: no record


def test_quotes_json_values_and_settings(spark):
    got = read(spark, """<i title="it's \\ fine">in</i><script class="da'ta">{"a":{"n":" 7.5 "}}</script><p>x</p><p>y</p>""",
               rule("title", "element", selector="quote", take="title"), rule("multiple", "element", selector="json", take="raw", path="$.a.n"),
               rule("industry", "value", value="it's given"), rule("description", "page", most=4), rule("text", "setting", value="spaced"),
               rule("price", "value", value="1.5 million"), rule("amounts", "setting", value="suffix"))["New"]
    assert (got.title, got.multiple, got.industry, got.description, got.price) == ("it's \\ fine", 7.5, "it's given", "in x", 1.5e6)


def test_a_function_of_a_site_sees_its_rows_only(spark):
    got = read(spark, "<h6>T</h6>", rule("title", "element", selector="h6"),
               functions={"New": lambda df: df.withColumns({"title": F.upper(F.concat("title", F.lit("!"))), "seen": F.lit(1)})})
    assert (got["New"].title, got["New"].seen, got["Flippa"].title, got["Flippa"].seen) == ("T!", 1, "F", None)
    with pytest.raises(ValueError, match="without an extractor"):
        read(spark, "", functions={"Nowhere": lambda df: df})


def test_rules_that_cannot_be_meant_are_refused(spark):
    for bad in (rule("colour", "page"), rule("title", "element"), rule("title", "element", selector="nav"), rule("title", "guess"),
                rule("price", "label"), rule("amounts", "setting", value="roman"), {"field": "title", "source": "page"},
                rule("price", "label", words=["price"])):
        with pytest.raises(ValueError):
            read(spark, "", bad)


def test_no_rules_and_repeated_rules(spark):
    assert set(read(spark, "<h6>T</h6>")) == {"Flippa"}
    one = rule("title", "element", selector="h6")
    assert read(spark, "<h6>T</h6>", one, one)["New"].title == "T"
    table = rows(spark, site_rules.RULE, one), rows(spark, STEP, *SELECTORS)
    assert site_rules.sites(*table)["New"] is site_rules.sites(*table)["New"]  # compiled once
