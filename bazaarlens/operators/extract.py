"""Listing pages to records, by one extractor per site.

An extractor is data plus two small functions: which elements to pick, how label/value rows
are laid out, the text each field is read from, and what derives from the fields. All sites
share one scan and a few projections; in each, a row evaluates only its own site's branch,
and nothing shuffles. Element selection ends in plain text columns, site rules choose among
those, and numbers are read from the chosen texts once for all sites.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from bazaarlens import fixed_values as fv, schemas
from bazaarlens.functions import classify, money, text as tx
from bazaarlens.operators.selectors import (
    E, all_of, first, first_of, let, packed, page_text, quoted, spaced_text, stripped, stripped_sql, text)
from bazaarlens.sources.html import OUTLINE, flatten_pages

Rules = dict[str, Column]
Kinds = tuple[tuple[str, tuple[str, ...]], ...]

OUTLINE_COLUMNS = tuple(f.name for f in OUTLINE)
#: What selectors and texts of elements read of an outline.
INDEXED = ("nodes", "strings", "tag_index", "class_index", "attr_index")
ELEMENTS = ("idx", "last", "cls", "attrs", "s0", "s1")


def by_site(site: Column, choices: dict[str, Column]) -> Column:
    """The branch of the row's site; NULL for sites without one."""
    out = None
    for name, value in choices.items():
        out = F.when(site == name, value) if out is None else out.when(site == name, value)
    return out


# --- elements ---------------------------------------------------------------------
@dataclass(frozen=True)
class Pick:
    """First element of an ordered selector list, and what to take from it."""

    selector: str
    take: str = "stripped"  # stripped, text, packed, raw, json (raw, parsed), or an attribute name

    def value(self, node: str) -> str:
        if self.take in ("raw", "json"):
            return f"{node}.raw" if self.take == "raw" else f"try_parse_json({node}.raw)"
        reader = {"stripped": stripped, "text": text, "packed": packed}.get(self.take)
        return reader(node) if reader else f"{node}.attrs['{quoted(self.take)}']"


def pick(*options: E, take: str = "stripped", together: bool = False) -> Pick:
    """``together`` takes the first of all options in document order instead of by option."""
    return Pick(first(*options) if together else first_of(*options), take)


JSONLD = E("script", attrs={"type": "application/ld+json"})
NEXTDATA = E("script", attrs={"id": "__NEXT_DATA__"})


# --- label/value layouts (C3) -----------------------------------------------------
def _in_row(places: str) -> str:
    return f"filter({places}, i -> i > r.idx AND i <= r.last)"


@dataclass(frozen=True)
class Layout:
    """Rows of a box; ``label`` and ``value`` are elements of a row ``r``, either may be missing. Without ``value`` it is
    the row itself, or with ``two_cells`` the second of exactly two ``label`` elements."""

    box: E
    row: E
    label: E
    value: E | None = None
    strip_label: bool = True
    strip_value: bool = True
    value_without_label: bool = False
    two_cells: bool = False

    def nodes(self) -> str:
        """Label and value node of every row by idx, over the box column ``_box``. What may be one is looked up once a box, not for every row."""
        found = {"labels": self.label} | ({"values": self.value} if self.value else {})
        once = {n: e for n, e in found.items() if e.inside is None}  # elements around it have to be in the row as well
        here = {n: _in_row(n) if n in once else e.found(within="r") for n, e in found.items()}
        if self.two_cells:
            pair = let(here["labels"], "two", "if(size(two) = 2, struct(get(two, 0) AS label, get(two, 1) AS value), NULL)")
        else:
            value = f"get({here['values']}, 0)" if self.value else "r.idx"
            pair = f"struct(get({here['labels']}, 0) AS label, {value} AS value)"
        out = f"transform({all_of(self.row, within='_box')}, r -> {pair})"
        for n, e in once.items():
            out = let(e.found(within="_box"), n, out)
        return out

    def texts(self, pairs: str) -> str:
        label_node, value_node = "get(nodes, p.label)", "get(nodes, p.value)"
        label = stripped(label_node) if self.strip_label else text(label_node)
        value = text(value_node)
        if self.value_without_label:
            value = f"replace({value}, {text(label_node)}, '')"
        if self.strip_value:
            value = stripped_sql(value)
        return (f"transform(filter({pairs}, p -> p.label IS NOT NULL AND p.value IS NOT NULL), "
                f"p -> struct(lower({label}) AS label, {value} AS value))")


PARAGRAPHS = Layout(  # p with span.title inside div.financials: what is left of the paragraph is the value
    E("div", cls="financials"), E("p"), E("span", cls="title"), value_without_label=True)
HEADINGS = Layout(  # li with h6 and p
    E("div", cls="inform_revenue single_business"), E("li"), E("h6"), E("p"), strip_label=False, strip_value=False)
CELLS = Layout(E("table", cls="listing-data-table"), E("tr"), E(("th", "td")), two_cells=True)
LINES = Layout(  # div.line with div.left and div.right
    E("div", cls="sb-table"), E("div", cls="line"), E("div", cls="left"), E("div", cls="right"))


def _label_stages(layouts: dict[str, Layout], choose: Callable[[dict[str, Column]], Column]) -> list[Rules]:
    """Box, then nodes, then texts of the label rows by the layout of each row's site."""
    return [{"_box": choose({n: F.expr(first(x.box)) for n, x in layouts.items()})},
            {"_pairs": choose({n: F.expr(x.nodes()) for n, x in layouts.items()})},
            {"_rows": choose({n: F.expr(x.texts("_pairs")) for n, x in layouts.items()})}]


def label_rows(outlines: DataFrame, layouts: dict[str, Layout], site: Column) -> DataFrame:
    """Add ``_rows`` (label, value)."""
    for columns in _label_stages(layouts, lambda choices: by_site(site, choices)):
        outlines = outlines.withColumns(columns)
    return outlines.drop("_box", "_pairs")


def label_kind(label: Column, kinds: Kinds) -> Column:
    """First kind whose words all occur in the label."""
    out = None
    for kind, words in kinds:
        hit = label.contains(words[0])
        for w in words[1:]:
            hit = hit & label.contains(w)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


def disclosed(value: Column) -> Column:
    """C4"""
    return ~F.lower(value).contains("not disclosed")


def deciding_text(values: Column) -> Column:
    """First of several texts with a non-zero amount, else the last one."""
    usable = F.filter(values, lambda v: F.coalesce(money.parse_price_base(v) != 0, F.lit(False)))
    return F.coalesce(F.get(usable, F.lit(0)), F.try_element_at(values, F.lit(-1)))


def or_else(value: Column, *others: Column) -> Column:
    """The first value that is present and not zero, else the last one there is."""
    every = (value, *others)
    return F.coalesce(*[tx.present(v) for v in every], *reversed(every)) if others else value


def numeric_aliases(df: DataFrame) -> DataFrame:
    """Profit stands for cash flow, and amounts are repeated under ``*_numeric``."""
    out = df.withColumn("profit", F.col("cash_flow")) if "cash_flow" in df.columns else df
    amounts = [c for c in ("asking_price", "revenue", "profit", "cash_flow") if c in out.columns]
    return out.withColumns({f"{c}_numeric": F.col(c) for c in amounts})


# --- embedded JSON (C6, C7): fields as text ----------------------------------------
def parsed(body: Column) -> Column:
    """A JSON body as VARIANT, to be kept in a column: it is parsed once, whatever number of paths is read. NULL where
    malformed; what follows a complete value is not read. Of a repeated key the last counts, as ``build_session`` sets it; Spark's default takes it as malformed."""
    return F.try_parse_json(body)


def json_text(json: Column, path: str) -> Column:
    """What lies at a path of parsed JSON, as text; objects and arrays as JSON. NULL where there is nothing or a null."""
    return F.try_variant_get(json, path, "string")


def jsonld_fields(json: Column) -> Rules:
    """C6, from a ``parsed`` body. Malformed JSON gives NULL fields; an offer without a price costs 0."""
    address = "$.offers.availableAtOrFrom.address"
    return {
        "title": json_text(json, "$.name"),
        "description": json_text(json, "$.description"),
        "price": F.when(json_text(json, "$.offers").isNotNull(), F.coalesce(json_text(json, "$.offers.price"), F.lit("0"))),
        "location": tx.join_city_state(json_text(json, f"{address}.addressLocality"), json_text(json, f"{address}.addressRegion")),
    }


def nextdata_fields(json: Column) -> Rules:
    """C7, from a ``parsed`` body. ``_keep`` is false when the page carries no listing object."""
    at = "$.props.pageProps.listing"
    listing = json_text(json, at)
    paths = {"title": "headline", "description": "about", "price": "askingPrice", "revenue": "financialSummary.revenue",
             "cash_flow": "financialSummary.profit", "established_year": "foundedIn", "industry": "category"}
    return {"_keep": F.coalesce(listing.startswith("{") & (listing != "{}"), F.lit(False))} | {
        name: json_text(json, f"{at}.{path}") for name, path in paths.items()}


# --- one extractor per site -------------------------------------------------------
@dataclass(frozen=True)
class Found:
    """The plain text columns a site's fields are chosen from."""

    text: Column                        # page text
    low: Column                         # the same in lower case
    url: Column
    picks: dict[str, Column]            # picked texts, or parsed JSON, by slot
    labels: dict[str, Column]           # value of the last row of a label kind
    asking: Column                      # all values of the ``price`` kind, in order
    wholes: dict[str, Column]           # first match of a pattern list in the page text, by slot


@dataclass(frozen=True)
class Site:
    """``fields`` gives a text per field, or several: a later one counts when the amounts of the
    earlier ones are missing or zero."""

    fields: Callable[[Found], dict[str, Column | tuple[Column, ...]]]
    picks: dict[str, Pick] = field(default_factory=dict)
    wholes: dict[str, tuple[str, ...]] = field(default_factory=dict)  # pattern lists of which match and capture are wanted
    layout: Layout | None = None
    kinds: Kinds = ()
    guarded: bool = False               # undisclosed label values are skipped (C4)
    extra_kinds: Kinds = ()             # a second, independent classification of the same rows
    derived: Callable[[Rules], Rules] | None = None
    spaced_text: bool = False           # page text joined by spaces
    needs_low: bool = False             # the rules look words up in lower-case text
    suffix_amounts: bool = False        # amounts by the suffix parser
    besides: tuple[str, ...] = ("listing_url",)  # of the record's fields, those that are not read from the page
    always: tuple[str, ...] = ()        # fields a record has even when nothing was found
    marks: dict[str, str] = field(default_factory=dict)  # fields a record has when there is a row of a label kind, readable or not
    ours: tuple[str, ...] = ()          # fields under a common name that the site's own record lacks


def _bizbuysell(at: Found) -> dict[str, Column | tuple[Column, ...]]:
    ld = jsonld_fields(at.picks["parsed"])
    return {
        "title": F.coalesce(tx.not_blank(ld["title"]), at.picks["title"], F.lit(fv.TITLE_NOT_FOUND)),
        "description": F.coalesce(tx.not_blank(ld["description"]), at.picks["description"],
                                  F.lit(fv.DESCRIPTION_NOT_FOUND)),
        "price": (ld["price"], deciding_text(at.asking), at.picks["price"]),
        "revenue": (at.labels["revenue"], tx.search(at.text, fv.BBS_REVENUE)),
        "cash_flow": (at.labels["cash_flow"], tx.search(at.text, fv.BBS_CASH_FLOW)),
        "ebitda": at.labels["ebitda"],
        "location": ld["location"],
        "industry": at.picks["industry"],
        "established_year": F.coalesce(tx.search(at.picks["box"], fv.BBS_YEAR), tx.search(at.text, fv.BBS_YEAR)),
    }


def _bizquest(at: Found) -> dict[str, Column]:
    text, node = at.text, at.picks["price"]
    return {
        "title": F.coalesce(at.picks["title"], tx.title_from_slug(at.url)),
        "asking_price_raw": F.coalesce(node, at.wholes["price"]),
        "price": F.coalesce(node, tx.capture_of(at.wholes["price"], fv.BQ_PRICE)),
        "cash_flow": tx.capture_of(at.wholes["cash_flow"], fv.BQ_CASH_FLOW),
        "cash_flow_raw": at.wholes["cash_flow"],
        "revenue": tx.capture_of(at.wholes["revenue"], fv.BQ_REVENUE),
        "revenue_raw": at.wholes["revenue"],
        "_margin": tx.search(text, fv.BQ_MARGIN),
        "location": tx.location(text, fv.BQ_LOCATION),
        "category": classify.category(at.low),
        "established_year": money.year_in_range(text, fv.BQ_YEAR),
        "description": F.coalesce(tx.strip(at.picks["meta"]), tx.truncate(at.picks["description"], 500),
                                  tx.collapse_ws(text, 500)),
        "employees": tx.search(text, fv.BQ_EMPLOYEES),
        "inventory_value": tx.search(text, fv.BQ_INVENTORY),
        "real_estate_included": classify.real_estate_included(text),
        "reason_for_selling": tx.truncate(tx.strip(tx.search(text, fv.BQ_REASON)), 200),
        "financing_available": classify.flag_or_null(text, fv.BQ_FINANCING),
        "training_provided": classify.flag_or_null(text, fv.BQ_TRAINING),
    }


def _bizquest_derived(got: Rules) -> Rules:
    """What follows from the fields found: estimate, aliases, split place, defaults."""
    revenue = F.coalesce(got["revenue"], money.revenue_from_margin(got["cash_flow"], got["_margin"]))
    estimate = F.when(got["cash_flow"].isNotNull(), money.revenue_from_margin_label(got["_margin"]))
    return {
        "asking_price": got["price"], "asking_price_numeric": got["price"],
        "cash_flow_numeric": got["cash_flow"], "profit": got["cash_flow"], "profit_numeric": got["cash_flow"],
        "profit_raw": got["cash_flow_raw"], "revenue": revenue, "revenue_numeric": revenue,
        "revenue_raw": F.coalesce(got["revenue_raw"], estimate),
        "location_raw": got["location"], "city": tx.city_of(got["location"]), "state": tx.state_of(got["location"]),
        "industry": F.coalesce(got["category"], F.lit(fv.DEFAULT_CATEGORY)),
        "business_type": F.coalesce(got["category"], F.lit(fv.DEFAULT_BUSINESS_TYPE)),
        "category": F.coalesce(got["category"], F.lit(fv.DEFAULT_CATEGORY)),
    }


def _quietlight(at: Found) -> dict[str, Column]:
    return {
        "title": F.coalesce(at.picks["title"], F.lit(fv.TITLE_NOT_FOUND)),
        "price": money.labelled_price_text(at.picks["price"], "asking price:", "+ inventory"),
        "revenue": at.labels["revenue"],
        "cash_flow": at.labels["cash_flow"],
        "multiple": at.labels["multiple"],
        "description": F.coalesce(at.picks["description"], F.lit(fv.DESCRIPTION_NOT_FOUND)),
        "industry": F.coalesce(at.picks["industry"], F.lit(fv.INDUSTRY_NOT_FOUND)),
        "seller_financing": classify.seller_financing(at.low),
    }


def _websiteproperties(at: Found) -> dict[str, Column]:
    return {
        "title": F.coalesce(at.picks["title"], F.lit(fv.TITLE_NOT_FOUND)),
        "price": money.labelled_price_text(at.picks["price"], "asking price:"),
        "revenue": at.labels["revenue"],
        "cash_flow": at.labels["cash_flow"],
        "description": F.coalesce(at.picks["description"], F.lit(fv.DESCRIPTION_NOT_FOUND)),
        "established_year": money.first_digits(at.labels["year"], r"\d{4}"),
        "employees": money.first_digits(at.labels["employees"]),
        "industry": at.labels["industry"],
        "location": at.labels["location"],
    }


def _flippa(at: Found) -> dict[str, Column]:
    node = at.picks["price"]
    return {
        "title": F.coalesce(at.picks["title"], at.picks["meta"], F.lit(fv.TITLE_NOT_FOUND)),
        # the page text counts only when there is no price element at all
        "price": F.when(node.isNotNull(), tx.search(node, fv.FL_PRICE_NODE, ignore_case=False))
        .otherwise(tx.search(at.text, fv.FL_PRICE)),
        "description": at.picks["description"],
        "revenue": tx.search(at.text, fv.FL_REVENUE),
        "cash_flow": tx.search(at.text, fv.FL_CASH_FLOW),
        "industry": tx.strip(tx.search(at.text, fv.FL_INDUSTRY)),
    }


def _empireflippers(at: Found) -> dict[str, Column]:
    text, node = at.text, at.picks["price"]
    # the first of several boxes that exists, the meta description last
    chosen = F.coalesce(at.picks["description"], at.picks["meta"])
    return {
        "title": F.coalesce(at.picks["title"], F.lit(fv.TITLE_NOT_FOUND)),
        "price": F.when(node.isNotNull(), tx.search(node, fv.EF_PRICE_NODE)).otherwise(tx.search(text, fv.EF_PRICE)),
        "revenue": tx.search(text, fv.EF_REVENUE),
        "cash_flow": tx.search(text, fv.EF_PROFIT),
        "multiple": tx.search(text, fv.EF_MULTIPLE),
        "industry": tx.strip(tx.search(text, fv.EF_INDUSTRY)),
        "established_year": tx.search(text, fv.EF_YEAR),
        "description": F.coalesce(tx.not_blank(chosen), tx.strip(tx.search(text, fv.EF_DESCRIPTION)),
                                  F.lit(fv.SEE_LISTING)),
    }


def _empireflippers_derived(got: Rules) -> Rules:
    """The page states monthly figures."""
    return {c: money.annualise(tx.present(got[c])) for c in ("revenue", "cash_flow")}


def _feinternational(at: Found) -> dict[str, Column | tuple[Column, ...]]:
    text, metrics = at.text, at.picks["metrics"]
    return {
        "title": at.picks["title"],
        "price": (tx.search(metrics, fv.FE_PRICE_METRIC), tx.first_regex(text, fv.FE_PRICE)),
        "revenue": (tx.search(metrics, fv.FE_REVENUE_METRIC), tx.first_regex(text, fv.FE_REVENUE)),
        "cash_flow": tx.search(metrics, fv.FE_PROFIT_METRIC),
        "multiple": tx.search(metrics, fv.FE_MULTIPLE_METRIC),
        "industry": F.coalesce(at.picks["industry"], classify.industry_from_url(at.url)),
        "location": at.picks["location"],
        "established_year": tx.search(text, fv.FE_YEAR),
        "description": tx.truncate(at.picks["description"], 1000),
    }


def _websiteclosers(at: Found) -> dict[str, Column]:
    return {
        "title": at.picks["title"],
        "description": tx.truncate(at.picks["description"], 2000),
        "price": at.labels["price"],
        "cash_flow": at.labels["cash_flow"],
        "revenue": at.labels["revenue"],
        "established_year": money.first_digits(at.labels["year"], r"\d{4}"),
    }


def with_multiple(got: Rules) -> Rules:
    """A computed multiple goes before one the page states."""
    return {"multiple": F.coalesce(money.multiple(got["price"], got["cash_flow"]), got["multiple"])}


def titled(got: Rules) -> Rules:
    """No title, no record."""
    return {"_keep": F.coalesce(F.length(got["title"]) > 0, F.lit(False))}


_QL_BOX = E("div", cls="inform_price single_business_price")

EXTRACTORS: dict[str, Site] = {
    "QuietLight": Site(
        _quietlight,
        {"title": pick(E("h3")), "price": pick(_QL_BOX >> E("h4"), take="text"), "description": pick(_QL_BOX >> E("p")),
         "industry": pick(E("div", cls="listing-card__category-name"))},
        layout=HEADINGS, kinds=(("revenue", ("revenue",)), ("cash_flow", ("income",)), ("multiple", ("multiple",))),
        derived=with_multiple, needs_low=True),
    "BizBuySell": Site(
        _bizbuysell,
        {"parsed": pick(JSONLD, take="json"), "title": pick(E("h1", cls="font-h1-new"), E("h1")),
         "description": pick(E("div", cls="business-description"), E("div", cls="description")),
         "price": pick(E("span", cls="price asking"), E("div", cls="asking-price"), take="text"),
         "industry": pick(E("div", cls="category"), E("span", cls="category"), E("div", cls="business-type"), together=True),
         "box": pick(PARAGRAPHS.box, take="text")},
        layout=PARAGRAPHS, kinds=(("price", ("asking price",)), ("cash_flow", ("cash flow",)), ("cash_flow", ("sde",)),
                     ("revenue", ("gross", "revenue")), ("ebitda", ("ebitda",))), guarded=True),
    "BizQuest": Site(
        _bizquest,
        {"title": pick(E("h1"), E("h2", cls="business-title")), "price": pick(E("span", cls="price"), E("div", cls="price")),
         "meta": pick(E("meta", attrs={"name": "description"}), take="content"),
         "description": pick(E("div", cls="description"), E("section", cls="business-description"))},
        {"price": fv.BQ_PRICE, "cash_flow": fv.BQ_CASH_FLOW, "revenue": fv.BQ_REVENUE}, derived=_bizquest_derived, spaced_text=True, suffix_amounts=True, needs_low=True, ours=("price", "industry")),
    "WebsiteProperties": Site(
        _websiteproperties,
        {"title": pick(E("h2", cls="blog-single-title")), "price": pick(E("h5", cls="mt-4"), take="text"),
         "description": pick(E("div", cls="listing-single-content") >> E("p"))},
        layout=CELLS, kinds=(("revenue", ("gross revenue",)), ("cash_flow", ("cash flow",))),
        extra_kinds=(("year", ("year established",)), ("employees", ("employees",)), ("industry", ("industry",)),
                     ("location", ("location",))),
        derived=with_multiple, marks={"established_year": "year", "employees": "employees"}),
    "Flippa": Site(
        _flippa,
        {"title": pick(E("h1")), "meta": pick(E("meta", attrs={"property": "og:title"}), take="content"),
         "price": pick(E("div", class_part="price"), take="text"),
         "description": pick(E("meta", attrs={"name": "description"}), E("meta", attrs={"property": "og:description"}),
                             take="content")}),
    "EmpireFlippers": Site(
        _empireflippers,
        {"title": pick(E("h1")), "price": pick(E("div", cls="info-price"), take="packed"),
         "description": pick(E("div", cls="listing-description"), E("div", cls="business-description"),
                             E("div", cls="description")),
         "meta": pick(E("meta", attrs={"name": "description"}), take="content")},
        derived=_empireflippers_derived),
    "Acquire": Site(
        lambda at: nextdata_fields(at.picks["parsed"]), {"parsed": pick(NEXTDATA, take="json")}, derived=with_multiple,
        always=("title", "description", "price", "revenue", "cash_flow", "established_year", "industry")),
    "FEInternational": Site(
        _feinternational,
        {"title": pick(E("h1", cls="listing-title"), E("h1"), E("h2", cls="title")),
         "metrics": pick(E("div", cls="key-metrics"), E("section", cls="metrics"), E("div", cls="listing-stats"), take="text"),
         "industry": pick(E("div", cls="business-type"), E("span", cls="category")),
         "location": pick(E("span", cls="location"), E("div", cls="business-location")),
         "description": pick(E("div", cls="listing-description"), E("section", cls="description"), E("div", cls="overview"))},
        derived=titled, besides=("listing_url", "source_site")),
    "WebsiteClosers": Site(
        _websiteclosers, {"title": pick(E("h1")), "description": pick(E("div", cls="wysiwyg cfx"))},
        layout=LINES, kinds=(("price", ("asking price",)), ("cash_flow", ("cash flow",)), ("revenue", ("gross income",)),
                ("year", ("year established",))),
        derived=titled),
}
_FIELDS = [("_keep", T.BooleanType()), ("_margin", T.DoubleType())] + [
    (f.name, f.dataType) for f in schemas.EXTRACTED.fields]


# of these kinds an unreadable row leaves the one before it in force; of amounts the last row counts as it is
_READABLE = {"multiple": lambda v: money.number_or_null(v).isNotNull(), "year": lambda v: v.rlike(r"\d{4}")}
_AMOUNTS = ("price", "revenue", "cash_flow", "ebitda", "inventory_value")
_NUMBERS = ("multiple", "_margin")


class _Sites:
    """Sites by number: a row asks for its site in each of some hundred columns, and numbers are compared at once."""

    def __init__(self, extractors: dict[str, Site], at: Column) -> None:
        self.numbers = {n: k for k, n in enumerate(extractors, 1)}
        self.number = F.coalesce(by_site(at, {n: F.lit(k) for n, k in self.numbers.items()}), F.lit(0)) if extractors else F.lit(0)

    def isin(self, *names: str) -> Column:
        return F.col("_site").isin(*[self.numbers[n] for n in names])

    def choose(self, choices: dict[str, Column]) -> Column:
        """The branch of the row's site."""
        return by_site(F.col("_site"), {self.numbers[n]: value for n, value in choices.items()})


def _gather(extractors: dict[str, Site], at: _Sites) -> list[tuple[Rules, tuple[str, ...]]]:
    """Outlines to plain columns ``_text``, ``_pick_*``, ``_label_*`` and ``_asking``: columns to add, and columns
    no longer needed after them, step by step."""
    spaced = [n for n, x in extractors.items() if x.spaced_text]
    slots = sorted({s for x in extractors.values() for s in x.picks})
    plain = page_text(F.col("strings"))
    text_column = F.when(at.isin(*spaced), spaced_text(F.col("strings"))).otherwise(plain) if spaced else plain
    # the element first, then its text: two projections, so no element is searched for twice
    nodes = {"_text": text_column} | {
        f"_node_{s}": at.choose({n: F.expr(x.picks[s].selector) for n, x in extractors.items() if s in x.picks})
        for s in slots}
    lowered = [n for n, x in extractors.items() if x.needs_low]
    searched = {n: p for x in extractors.values() for n, p in x.wholes.items()}
    wholes = {f"_whole_{s}": at.choose({n: tx.first_regex_whole(F.col("_text"), x.wholes[s]) for n, x in extractors.items() if s in x.wholes})
              for s in searched}
    picks = {"_low": F.when(at.isin(*lowered), F.lower("_text"))} | wholes | {
        f"_pick_{s}": at.choose({n: F.expr(x.picks[s].value(f"_node_{s}")) for n, x in extractors.items() if s in x.picks})
        for s in slots}
    layouts = {n: x.layout for n, x in extractors.items() if x.layout}
    done = tuple(f"_node_{s}" for s in slots)
    if not layouts:
        return [(nodes, ()), (picks, (*done, *OUTLINE_COLUMNS))]
    # each step copies what it keeps: as few steps as can be have the outline, and its index goes as soon as nothing is looked up
    box, pairs, rows = _label_stages(layouts, at.choose)
    stages: list[tuple[Rules, tuple[str, ...]]] = [
        (nodes | box, ("string_nodes", "parse_error")), (picks | pairs, (*done, "_box", "tag_index", "class_index", "attr_index")),
        (rows, ("_pairs", "nodes", "strings"))]

    def tagged(x: Site):
        def tag(r: Column) -> Column:
            kind = label_kind(r["label"], x.kinds)
            if x.guarded:  # undisclosed amounts are skipped, an undisclosed price is just unreadable
                kind = F.when((kind == "price") | disclosed(r["value"]), kind)
            extra = label_kind(r["label"], x.extra_kinds) if x.extra_kinds else F.lit(None).cast("string")
            return F.struct(kind.alias("kind"), extra.alias("extra"), r["value"].alias("value"))
        return tag

    stages.append(({"_rows": at.choose({n: F.transform("_rows", tagged(extractors[n])) for n in layouts})}, ()))
    kinds = sorted({k for x in extractors.values() for k, _ in x.kinds})
    extras = sorted({k for x in extractors.values() for k, _ in x.extra_kinds})
    last = "try_element_at(filter(_rows, r -> r.{c} = '{k}'), -1).value"

    def last_row(k: str) -> Column:
        if k not in _READABLE:
            return F.expr(last.format(c="kind", k=k))
        return F.try_element_at(F.filter("_rows", lambda r: (r["kind"] == k) & _READABLE[k](r["value"])), F.lit(-1))["value"]

    stages.append((
        {f"_label_{k}": last_row(k) for k in kinds}
        | {f"_extra_{k}": F.expr(last.format(c="extra", k=k)) for k in extras}
        | {"_asking": F.expr("transform(filter(_rows, r -> r.kind = 'price'), r -> r.value)")}, ("_rows",)))
    return stages


def _found(x: Site, labelled: bool, url: Column) -> Found:
    null = F.lit(None).cast("string")
    labels = {k: F.col(f"_label_{k}") for k, _ in x.kinds} | {k: F.col(f"_extra_{k}") for k, _ in x.extra_kinds}
    asking = F.col("_asking") if labelled else F.array(null)
    return Found(F.col("_text"), F.col("_low"), url, {s: F.col(f"_pick_{s}") for s in x.picks}, labels, asking, {s: F.col(f"_whole_{s}") for s in x.wholes})


@dataclass(frozen=True)
class _Prepared:
    """The columns of an extraction, by step. They name their inputs only, so any outlines can go through them."""

    extractors: dict[str, Site]
    reason: Column                                    # why a page gives no record
    number: Column                                    # of the site; kept as ``_site``
    gather: list[tuple[Rules, tuple[str, ...]]]
    raw: dict[str, Column]
    typed: Rules
    record: tuple[Rules, Column, Column]              # the record's fields, whether it is kept, names of the fields it has


_PREPARED: dict[tuple, _Prepared] = {}


def _prepared(extractors: dict[str, Site], site: str, url: str) -> _Prepared:
    """Building some thousand expressions takes seconds, reading a page microseconds: each set of extractors
    is built once and serves every batch of a stream."""
    key = (id(SparkContext._gateway), site, url, *((n, id(x)) for n, x in extractors.items()))
    if key not in _PREPARED:
        _PREPARED[key] = _prepare(dict(extractors), F.col(site), F.col(url))
    return _PREPARED[key]


def _prepare(extractors: dict[str, Site], at: Column, url: Column) -> _Prepared:
    reason = (F.when(~F.coalesce(at.isin(*extractors), F.lit(False)), F.concat(F.lit("no extractor for site "), F.coalesce(at, F.lit("NULL"))))
              .when(F.col("parse_error").isNotNull(), F.concat(F.lit("page cannot be read: "), "parse_error")))
    sites = _Sites(extractors, at)
    labelled = any(x.layout for x in extractors.values())
    chosen: dict[tuple[str, int], dict[str, Column]] = {}
    derived: dict[str, dict[str, Column]] = {}
    got = {n: F.col(f"_got_{n}") for n, _ in _FIELDS}
    for name, x in extractors.items():
        for f, value in x.fields(_found(x, labelled, url)).items():
            for k, one in enumerate(value if isinstance(value, tuple) else (value,)):
                chosen.setdefault((f, k), {})[name] = one
        for f, value in (x.derived(got) if x.derived else {}).items():
            derived.setdefault(f, {})[name] = value
    # the texts first, then the numbers in them: one reading per field, whatever the site
    raw = {f"_raw_{f}_{k}": sites.choose(by) for (f, k), by in chosen.items()}
    marked: dict[str, dict[str, Column]] = {}
    for name, x in extractors.items():
        labels = _found(x, labelled, url).labels
        for f, kind in x.marks.items():
            marked.setdefault(f, {})[name] = labels[kind].isNotNull()
    marks = {f"_mark_{f}": sites.choose(by) for f, by in marked.items()}
    by_suffix = [n for n, x in extractors.items() if x.suffix_amounts]

    def read(name: str, kind: T.DataType) -> Column:
        texts = [F.col(f"_raw_{f}_{k}") for f, k in chosen if f == name]
        if not texts:
            return F.lit(None).cast(kind)
        if name not in _AMOUNTS:
            return (money.number_or_null(texts[0]) if name in _NUMBERS else texts[0].try_cast(kind))
        amount = or_else(*[F.when(t.isNotNull(), money.parse_price_base(t)) for t in texts])
        if not by_suffix:
            return amount
        return F.when(sites.isin(*by_suffix), F.when(texts[0].isNotNull(), money.parse_price_suffix(texts[0]))).otherwise(amount)

    # a field is in a record when a text was found for it, readable or not, or a value was worked out; a
    # multiple has to be readable
    def has(name: str) -> Column:
        found = F.coalesce(F.col(f"_mark_{name}"), F.lit(False)) if name in marked else F.lit(False)
        for f, k in chosen:
            if f == name and name not in _NUMBERS:
                found = found | F.col(f"_raw_{f}_{k}").isNotNull()
        return found

    fields = [n for n, _ in _FIELDS if not n.startswith("_")]
    typed = {f"_got_{n}": read(n, t) for n, t in _FIELDS} | {f"_has_{n}": has(n) for n in fields}
    out = {n: sites.choose(derived[n]).otherwise(got[n]) if n in derived else got[n] for n, _ in _FIELDS}

    def emitted(name: str) -> Column:
        there = F.col(f"_has_{name}") | F.col(f"_out_{name}").isNotNull()
        worked_out = list(derived.get(name, ()))
        if worked_out:
            there = F.when(sites.isin(*worked_out), F.col(f"_out_{name}").isNotNull()).otherwise(there)
        always = [n for n, x in extractors.items() if name in x.always]
        ours = [n for n, x in extractors.items() if name in x.ours]
        there = there | sites.isin(*always) if always else there
        there = there & ~sites.isin(*ours) if ours else there
        return F.when(there, name)

    own = [F.when(sites.isin(n), F.array(*map(F.lit, x.besides))) for n, x in extractors.items()]
    names = F.concat(F.coalesce(*own), F.array_compact(F.array(*map(emitted, fields))))
    return _Prepared(extractors, reason, sites.number, _gather(extractors, sites), raw | marks, typed,
                     ({n: out[n] for n in fields}, F.coalesce(out["_keep"], F.lit(True)), names))


def extract_outlines(outlines: DataFrame, extractors: dict[str, Site] | None = None, site: str = "source_site",
                     url: str = "listing_url", with_rejects: bool = False, with_emitted: bool = False) -> DataFrame:
    """Records of outlined listing pages of any mix of sites (H2: pass a dict with more extractors).

    Unreadable pages and pages of unknown sites give no record, or ``with_rejects`` one of NULLs with
    the column ``reject_reason``. ``with_emitted`` adds ``emitted``, the names of the fields that the site's
    own record of the page has (F4); records are ragged, their columns are not.
    """
    ready = _prepared(EXTRACTORS if extractors is None else extractors, site, url)
    keep = [c for c in outlines.columns if c not in OUTLINE_COLUMNS]
    outlines = outlines.withColumns({"reject_reason": ready.reason, "_site": ready.number})
    if with_rejects:
        keep.append("reject_reason")
    else:
        outlines = outlines.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    for columns, done in ready.gather:
        outlines = outlines.withColumns(columns).drop(*done)
    raw = outlines.select(*keep, "_site", *[c.alias(n) for n, c in ready.raw.items()])
    wanted = [n for n in ready.typed if with_emitted or not n.startswith("_has_")]
    typed = raw.select(*keep, "_site", *[ready.typed[n].alias(n) for n in wanted])
    # C12. One record or none, as a generator: a filter would be pushed down through every
    # projection above and evaluate them all a second time. It makes no more than the row, so
    # fields that nobody reads are not worked out
    record, keeps, names = ready.record
    if with_rejects:
        keeps = keeps | F.col("reject_reason").isNotNull()
    marks = [n for n in wanted if n.startswith("_has_")]
    once = typed.select("*", F.explode(F.when(keeps, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))).alias("_once"))
    if not with_emitted:
        return once.select(*keep, *[c.alias(n) for n, c in record.items()])
    rows = once.select(*keep, "_site", *marks, *[c.alias(n) for n, c in record.items()])
    fields = [n.removeprefix("_has_") for n in marks]
    return rows.withColumns({f"_out_{n}": F.col(n) for n in fields}).select(*keep, *fields, names.alias("emitted"))


def extract_listings(pages: DataFrame, extractors: dict[str, Site] | None = None, with_rejects: bool = False,
                     with_emitted: bool = False) -> DataFrame:
    """Pages (``source_site``, ``listing_url``, ``html``, ...) to records: one parse per page."""
    return extract_outlines(flatten_pages(pages, (*INDEXED, "parse_error"), (*ELEMENTS, "raw")), extractors, with_rejects=with_rejects, with_emitted=with_emitted)
