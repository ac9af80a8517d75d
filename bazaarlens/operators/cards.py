"""Results pages cut into cards, each card read as a row."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens import fixed_values as fv, schemas
from bazaarlens.functions import classify, money, text as tx
from bazaarlens.operators.extract import OUTLINE_COLUMNS, by_site
from bazaarlens.operators.selectors import E, all_of, first as first_node, let, packed, spaced


@dataclass(frozen=True)
class CardRule:
    cards: tuple[E, ...]
    first: int                      # cards read per page
    title: tuple[E, ...]
    link: E
    base_url: str
    price: tuple[str, ...]
    cash_flow: str | None = None
    profit: str | None = None
    profit_monthly: bool = False
    profit_is_cash_flow: bool = False
    revenue: str | None = None
    revenue_monthly: bool = False
    place: bool = False
    default_title: str | None = None
    title_from_link: bool = False


CARD_RULES: dict[str, CardRule] = {
    "BizQuest": CardRule(
        (E("div", cls="listing"),), 5, (), E("a", attr_parts={"href": "/business-for-sale/"}),
        "https://www.bizquest.com", (fv.CARD_BQ_PRICE,), cash_flow=fv.CARD_BQ_CASH_FLOW, place=True,
        title_from_link=True),
    "EmpireFlippers": CardRule(
        (E("div", class_part="listing"),), 3, (E(("h2", "h3", "a")),), E("a", attr_parts={"href": "/listing/"}),
        "https://empireflippers.com", (fv.CARD_EF_PRICE,), profit=fv.CARD_EF_PROFIT, profit_monthly=True,
        revenue=fv.CARD_EF_REVENUE, revenue_monthly=True, default_title=fv.EMPIRE_CARD_TITLE),
    "WebsiteProperties": CardRule(
        (E("article", cls="listing"), E("div", cls="listing-item")), 3, (E(("h2", "h3")),),
        E("a", attr_parts={"href": "/listing"}), "https://websiteproperties.com", (fv.CARD_WP_PRICE,),
        profit=fv.CARD_WP_PROFIT, profit_monthly=True, profit_is_cash_flow=True, revenue=fv.CARD_WP_REVENUE),
    "QuietLight": CardRule(
        (E("div", cls="listing-card"), E("article", cls="listing")), 3,
        (E(("h2", "h3")), E(cls="listing-title")), E("a", attr_parts={"href": "/listing"}),
        "https://quietlight.com", (fv.CARD_QL_PRICE,), profit=fv.CARD_QL_PROFIT, profit_is_cash_flow=True,
        revenue=fv.CARD_QL_REVENUE),
    "BizBuySell": CardRule(
        (E("div", cls="listing"), E("div", class_part="listing-card")), 3, (E(("h2", "h3")), E(cls="title")),
        E("a", attr_parts={"href": "/Business"}), "https://www.bizbuysell.com", fv.CARD_BBS_PRICE,
        cash_flow=fv.CARD_BBS_CASH_FLOW, revenue=fv.CARD_BBS_REVENUE, place=True),
}


_PREPARED: dict[tuple, tuple[Column, list[dict[str, Column]], dict[str, Column]]] = {}


def card_pieces(rule: CardRule, first: int | None) -> Column:
    """Text, link and title text of the first cards of a page, without the outline."""
    cards = all_of(*rule.cards) if first is None else f"slice({all_of(*rule.cards)}, 1, {first})"
    link = first_node(rule.link, within="c")
    title = link if rule.title_from_link else first_node(*rule.title, within="c")
    return F.expr(f"transform({cards}, c -> struct({spaced('c')} AS text, {link}.attrs['href'] AS href, "
                  f"{let(title, 't', packed('t'))} AS title))")


_AMOUNTS = ("price", "cash_flow", "profit", "revenue")


def _patterns(rule: CardRule, amount: str) -> tuple[str, ...]:
    given = getattr(rule, amount)
    return () if given is None else (given,) if isinstance(given, str) else given


def _amount(rule: CardRule, amount: str, monthly: bool = False) -> tuple[Column, Column]:
    """(value, raw text) of an amount, from the columns ``_whole_*`` and ``_number_*``; both NULL when no pattern matches."""
    if not _patterns(rule, amount):
        return F.lit(None).cast("double"), F.lit(None).cast("string")
    value = F.col(f"_number_{amount}")
    return (money.annualise(value), money.per_month_label(value)) if monthly else (value, F.col(f"_whole_{amount}"))


def read_card(source: str, rule: CardRule, text: Column, href: Column, title: Column) -> dict[str, Column]:
    url = tx.absolutise(href, F.lit(rule.base_url))
    price, price_raw = _amount(rule, "price")
    cash, cash_raw = _amount(rule, "cash_flow")
    profit, profit_raw = _amount(rule, "profit", rule.profit_monthly)
    if rule.profit is None:  # cash flow stands in for profit
        profit, profit_raw = cash, cash_raw if source == "BizQuest" else F.lit(None).cast("string")
    if rule.profit_is_cash_flow:
        cash = profit
    revenue, revenue_raw = _amount(rule, "revenue", rule.revenue_monthly)
    business_type, category = classify.card_type(source, text)
    if rule.title_from_link:
        title = tx.card_title(title, url)
    elif rule.default_title:
        title = F.coalesce(title, F.lit(rule.default_title))
    place = F.col("_place")
    return {
        "listing_url": url, "title": title, "asking_price": price, "asking_price_raw": price_raw,
        "cash_flow": cash, "cash_flow_raw": cash_raw, "profit": profit, "profit_raw": profit_raw,
        "revenue": revenue, "revenue_raw": revenue_raw, "location": place, "city": tx.city_of(place),
        "state": tx.state_of(place), "category": category, "business_type": business_type,
    }


def _stages(at: Column) -> list[dict[str, Column]]:
    """A card's text is searched once for each amount; numbers are read from what was found, each in a step of its own."""
    text = F.col("_text")
    found = {a: {n: p for n, r in CARD_RULES.items() if (p := _patterns(r, a))} for a in _AMOUNTS}
    place = tx.search(text, fv.CARD_PLACE, ignore_case=False)
    whole = {f"_whole_{a}": by_site(at, {n: tx.first_regex_whole(text, p) for n, p in by.items()}) for a, by in found.items()}
    short = {f"_short_{a}": by_site(at, {n: tx.capture_of(F.col(f"_whole_{a}"), p) for n, p in by.items()}) for a, by in found.items()}
    number = {f"_number_{a}": F.when(F.col(f"_whole_{a}").isNotNull(), money.parse_price_suffix(F.col(f"_short_{a}"))) for a in _AMOUNTS}
    return [whole | {"_place": by_site(at, {n: place for n, r in CARD_RULES.items() if r.place})}, short, number]


def extract_cards(outlines: DataFrame, source: str = "source", scraped_at: Column | None = None,
                  first: int | None = -1) -> DataFrame:
    """Card rows of outlined results pages. ``first=None`` reads every card, the default each site's own number.

    A BizQuest card without a link is skipped; elsewhere the link may be missing.
    """
    at = F.col(source)
    key = (id(SparkContext._gateway), source, first, *((n, id(r)) for n, r in CARD_RULES.items()))
    if key not in _PREPARED:  # built once: the expressions name their inputs only
        read = {n: read_card(n, r, F.col("_text"), F.col("_href"), F.col("_title")) for n, r in CARD_RULES.items()}
        names = [f.name for f in schemas.CARDS.fields if f.name not in ("source", "scraped_at")]
        _PREPARED[key] = (
            by_site(at, {n: card_pieces(r, r.first if first == -1 else first) for n, r in CARD_RULES.items()}),
            _stages(at), {c: by_site(at, {n: fields[c] for n, fields in read.items()}) for c in names})
    pieces, stages, fields = _PREPARED[key]
    keep = [c for c in outlines.columns if c not in (*OUTLINE_COLUMNS, "scraped_at")]
    stamp = F.current_timestamp() if scraped_at is None else scraped_at
    cards = (
        outlines.filter(at.isin(*CARD_RULES))
        .select(*keep, stamp.cast("timestamp").alias("scraped_at"), F.posexplode(pieces).alias("card_pos", "_card"))
        .select(*keep, "scraped_at", "card_pos", *[F.col(f"_card.{c}").alias(f"_{c}") for c in ("text", "href", "title")])
        .filter((at != "BizQuest") | F.col("_href").isNotNull())
    )
    for columns in stages:
        cards = cards.withColumns(columns)
    return cards.select(*keep, "scraped_at", "card_pos", *[c.alias(n) for n, c in fields.items() if n != source])
