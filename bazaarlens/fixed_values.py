"""Words, patterns, selectors' literals and constants the results depend on.

They are kept together and spelled out because changing any of them changes what is
extracted. Patterns hold one capture group; ``[\\d,]+`` may match a lone comma on purpose.
"""

# --- fixed values: business tagging ------------------------------------------------
FBA_KEYWORDS = (
    "amazon fba", "fba business", "fulfillment by amazon", "amazon seller", "amazon store",
    "fba seller", "amazon brand", "private label", "amazon wholesale", "amazon dropship",
    "amazon ppc", "seller central", "amazon account", "asin", "buy box", "prime eligible",
)
AMAZON_RELATED = (
    "amazon affiliate", "amazon associates", "kindle", "amazon kdp", "amazon merch", "audible",
)
ECOMMERCE_TERMS = ("ecommerce", "e-commerce", "online retail")
FBA_URL_TERMS = ("amazon", "fba")
FBA_URL_WEIGHT = 2.0
ECOMMERCE_WEIGHT = 0.5
FBA_THRESHOLD = 1.0

# first category with any hit wins, so the order is part of the value
CATEGORIES = (
    ("Restaurant", ("restaurant", "cafe", "coffee", "food", "dining", "bar", "grill", "pizza", "bakery")),
    ("Retail", ("retail", "store", "shop", "boutique", "mart", "market")),
    ("Service", ("service", "consulting", "agency", "cleaning", "repair", "maintenance")),
    ("Manufacturing", ("manufacturing", "factory", "production", "industrial")),
    ("E-commerce", ("e-commerce", "ecommerce", "online", "internet", "amazon", "fba", "shopify")),
    ("Franchise", ("franchise", "franchising")),
    ("Healthcare", ("medical", "health", "clinic", "dental", "wellness", "pharmacy")),
    ("Technology", ("technology", "tech", "software", "saas", "it", "digital", "app")),
    ("Automotive", ("auto", "car", "vehicle", "mechanic", "dealership")),
    ("Real Estate", ("real estate", "property", "realty", "rental")),
)
DEFAULT_CATEGORY = "General"
DEFAULT_BUSINESS_TYPE = "Business"

# --- fixed values: defaults --------------------------------------------------------
TITLE_NOT_FOUND = "Title not found"
DESCRIPTION_NOT_FOUND = "Description not found"
INDUSTRY_NOT_FOUND = "Industry not found"
SEE_LISTING = "See listing for details"
EMPIRE_CARD_TITLE = "Empire Flippers Listing"
DEFAULT_TRIGGER = "scheduler"
ESTIMATED_SEARCH_PAGES = 10
YEAR_WINDOW = (1900, 2025)

# --- fixed values: amount shapes ---------------------------------------------------
N = r"([\d,]+)"
M = r"([\d,]+(?:\.\d+)?[KkMm]?)"
MI = r"([\d,]+(?:\.\d+)?[KkMm]?(?:illion)?)"

# --- fixed values: listing-page patterns, per site ---------------------------------
BBS_REVENUE = r"Gross Revenue[:\s]*\$?" + N
BBS_CASH_FLOW = r"Cash Flow.*?(?:SDE)?[:\s]*\$?" + N
BBS_YEAR = r"Established[:\s]*(\d{4})"

BQ_PRICE = (
    r"(?:asking price|price)[:\s]*\$?" + MI,
    r"\$?" + MI + r"\s*(?:asking|sale|price)",
    r"for sale[:\s]*\$?" + MI,
)
BQ_CASH_FLOW = (
    r"cash flow[:\s]*\$?" + MI,
    r"(?:annual cash flow|yearly cash flow)[:\s]*\$?" + MI,
    r"(?:net income|net profit)[:\s]*\$?" + MI,
    r"(?:ebitda|sde)[:\s]*\$?" + MI,
)
BQ_REVENUE = (
    r"(?:gross revenue|gross sales|annual revenue|yearly revenue|revenue)[:\s]*\$?" + MI,
    r"(?:sales|annual sales|yearly sales)[:\s]*\$?" + MI,
    r"\$?" + MI + r"\s*(?:in revenue|in sales)",
)
BQ_MARGIN = r"(\d+(?:\.\d+)?)\s*%\s*(?:margin|profit margin)"
BQ_LOCATION = (  # case-sensitive
    r"(?:location|located in|based in)[:\s]*([^,]+,\s*[A-Z]{2})",
    r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*,\s*[A-Z]{2})",
)
BQ_YEAR = (
    r"(?:established|founded|since)[:\s]*(\d{4})",
    r"(\d{4})\s*(?:established|founded)",
    r"(?:in business since|operating since)[:\s]*(\d{4})",
)
BQ_EMPLOYEES = r"(\d+)\s*(?:employees|staff|workers)"
BQ_INVENTORY = r"inventory[:\s]*\$?" + M
BQ_ESTATE_YES = r"real estate included|includes real estate|property included"
BQ_ESTATE_NO = r"lease|rent|no real estate"
BQ_REASON = r"(?:reason for selling|selling because)[:\s]*([^.]+)"
BQ_FINANCING = r"financing available|seller financing|owner financing|sba"
BQ_TRAINING = r"training provided|training included|will train"

FL_PRICE_NODE = r"USD\s*\$?" + N  # case-sensitive
FL_PRICE = r"(?:Asking Price|Buy It Now)[:\s]*\$?" + N
FL_REVENUE = r"(?:revenue|sales)[:\s]*\$?" + M
FL_CASH_FLOW = r"(?:profit|cash flow|net income)[:\s]*\$?" + M
FL_INDUSTRY = r"(?:category|industry|niche)[:\s]*([^\n,]+)"
FL_LISTING_HREF = r"/\d{7,}$"

EF_PRICE_NODE = r"\$" + N
EF_PRICE = r"(?:Listing Price)[:\s]*\$" + N
EF_REVENUE = r"Avg\.\s*Monthly\s*Revenue\s*\$" + N
EF_PROFIT = r"Avg\.\s*Monthly\s*Profit\s*\$" + N
EF_MULTIPLE = r"(?:Multiple)[:\s]*([\d.]+)x?"
EF_INDUSTRY = r"(?:Monetizations?|Business Type)[:\s]*([^\n]+)"
EF_YEAR = r"(?:Business Created|Established|Founded)[:\s]*(\d{4})"
EF_DESCRIPTION = r"(?:Description|Overview|About)[:\s]*([^\n]{50,500})"

FE_PRICE_METRIC = r"asking\s*price[:\s]*\$?" + M
FE_PRICE = (
    r"price[:\s]*\$?" + M,
    r"\$?" + M + r"\s*asking",
    r"for\s*sale[:\s]*\$?" + M,
)
FE_REVENUE_METRIC = r"revenue[:\s]*\$?" + M
FE_REVENUE = (
    r"annual\s*revenue[:\s]*\$?" + M,
    r"yearly\s*revenue[:\s]*\$?" + M,
    r"ttm\s*revenue[:\s]*\$?" + M,
)
FE_PROFIT_METRIC = r"(?:profit|net\s*income|ebitda)[:\s]*\$?" + M
FE_MULTIPLE_METRIC = r"([\d.]+)x?\s*multiple"
FE_YEAR = r"established[:\s]*(\d{4})"
FE_URL_INDUSTRY = (
    ("amazon-fba", "Amazon FBA"),
    ("ecommerce", "E-commerce"),
    ("saas", "SaaS"),
    ("content", "Content/Publishing"),
)

# --- fixed values: results-page card patterns --------------------------------------
CARD_PLACE = r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*,\s*[A-Z]{2})"  # case-sensitive
CARD_BQ_PRICE = r"\$?" + MI
CARD_BQ_CASH_FLOW = r"cash flow[:\s]*\$?" + M
CARD_EF_PRICE = r"\$?" + N
CARD_EF_PROFIT = r"(?:monthly profit|net profit)[:\s]*\$?" + N
CARD_EF_REVENUE = r"(?:monthly revenue|gross revenue)[:\s]*\$?" + N
CARD_WP_PRICE = r"\$?" + M
CARD_WP_PROFIT = r"(?:monthly profit|cash flow)[:\s]*\$?" + N
CARD_WP_REVENUE = r"(?:revenue|sales)[:\s]*\$?" + N
CARD_QL_PRICE = r"\$?" + M
CARD_QL_PROFIT = r"(?:ttm|earnings|sde)[:\s]*\$?" + N
CARD_QL_REVENUE = r"(?:revenue|sales)[:\s]*\$?" + N
CARD_BBS_PRICE = (r"asking price[:\s]*\$?" + N, r"\$?" + N)
CARD_BBS_CASH_FLOW = r"cash flow[:\s]*\$?" + N
CARD_BBS_REVENUE = r"(?:gross revenue|revenue)[:\s]*\$?" + N

# --- fixed values: page-quality checks ---------------------------------------------
MONEY_VALUE = r"\$[\d,]+(?:\.\d{2})?"
COVERAGE_PATTERNS = {  # any character includes line ends
    "Asking Price": r"Asking Price[:\s]*\$?([\d,]+)",
    "Cash Flow": r"Cash Flow.*?\$?([\d,]+)",
    "Gross Revenue": r"Gross Revenue[:\s]*\$?([\d,]+)",
    "EBITDA": r"EBITDA[:\s]*([^\n]+)",
    "Established Year": r"Established[:\s]*(\d{4})",
    "SDE": r"SDE.*?\$?([\d,]+)",
}
META_WORDS = ("price", "title", "description")
DEAD_TITLE = r"404|not found"

# --- fixed values: sites -----------------------------------------------------------
# name, base_url, search_url, search_urls, ecommerce_url, amazon_url, enabled
SITES = (
    ("QuietLight", "https://quietlight.com", None,
     ["https://quietlight.com/amazon-fba-businesses-for-sale/",
      "https://quietlight.com/ecommerce-businesses-for-sale/"], None, None, True),
    ("BizBuySell", "https://www.bizbuysell.com", None, None, None,
     "https://www.bizbuysell.com/amazon-stores-for-sale/", True),
    ("BizQuest", "https://www.bizquest.com",
     "https://www.bizquest.com/dynamic/search/businesses-for-sale/", None, None,
     "https://www.bizquest.com/amazon-business-for-sale/", True),
    ("WebsiteProperties", "https://websiteproperties.com",
     "https://websiteproperties.com/websites-for-sale/", None, None, None, True),
    ("Flippa", "https://flippa.com",
     "https://flippa.com/search?filter[property_type][]=website", None, None,
     "https://flippa.com/buy/monetization/amazon-fba", True),
    ("EmpireFlippers", "https://empireflippers.com",
     "https://empireflippers.com/marketplace/", None, None,
     "https://empireflippers.com/marketplace/amazon-fba-businesses-for-sale/", True),
    ("Acquire", "https://acquire.com", "https://acquire.com/buyers/", None, None, None, False),
    ("FEInternational", "https://feinternational.com",
     "https://feinternational.com/buy-a-business/", None, None, None, False),
    ("WebsiteClosers", "https://www.websiteclosers.com",
     "https://www.websiteclosers.com/businesses-for-sale/", None, None, None, True),
)
BQ_PAGES_BASE = "https://www.bizquest.com/businesses-for-sale/"
FLIPPA_PAGE_SIZE = 50
SINGLE_PAGE_SITES = ("Acquire", "FEInternational")
# which pagination stop rules a site applies (a missing page always stops)
STOP_ON_NO_NEW = ("BizBuySell", "BizQuest", "Flippa", "WebsiteClosers")
STOP_ON_NO_NEW_AFTER_FIRST = ("WebsiteProperties",)
STOP_ON_NO_MATCH = ("QuietLight", "WebsiteProperties", "EmpireFlippers")
STOP_WITHOUT_NEXT = ("QuietLight", "WebsiteProperties", "EmpireFlippers")
