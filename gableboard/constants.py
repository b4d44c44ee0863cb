"""Fixed values.

Everything in this file must equal the published values of the market rules, or
results change: word lists, lookup tables, text formats and thresholds.
"""

# The closed set of towns.
TOWNS = (
    "Kittery", "York", "Ogunquit", "Wells", "Kennebunk",
    "Kennebunkport", "Biddeford", "Saco", "Old Orchard Beach", "Scarborough",
)

# Place name -> town.
PLACE_TO_TOWN = {
    "nubble peninsula": "York",
    "long sands beach": "York",
    "short sands beach": "York",
    "york beach": "York",
    "york harbor": "York",
    "cape neddick": "York",
    "moody": "Wells",
    "moody beach": "Wells",
    "ocean park": "Old Orchard Beach",
    "ocean park meadows": "Old Orchard Beach",
    "oob": "Old Orchard Beach",
    "goose rocks beach": "Kennebunkport",
    "goose rocks": "Kennebunkport",
    "cape porpoise": "Kennebunkport",
    "kennebunk beach": "Kennebunk",
    "kennebunk port": "Kennebunkport",
    "biddeford pool": "Biddeford",
}

# Office spelling (lower case) -> canonical office.
OFFICE_SPELLINGS = {
    "anne erwin sothebys international rlty": "Anne Erwin Sotheby's International Realty",
    "the aland realty group": "The Aland Realty Group, LLC",
    "kw coastal and lakes & mountains realty": "Keller Williams Coastal and Lakes & Mountains Realty",
    "kw coastal and lakes & mountains realty/portsmouth": "Keller Williams Coastal and Lakes & Mountains Realty",
    "century 21 atlantic realty": "CENTURY 21 Atlantic Realty",
    "century 21 barbara patterson": "CENTURY 21 Barbara Patterson",
    "better homes and gardens real estate - the masiello group": "Better Homes & Gardens Real Estate/The Masiello Group",
    "signature homes real estate group": "Signature Homes Real Estate Group, LLC",
    "great island realty llc": "Great Island Realty, LLC",
    "great island realty, llc": "Great Island Realty, LLC",
    "landvest, inc.": "LandVest, Inc.",
    "abigail douris real estatellc": "Abigail Douris Real Estate LLC",
    "red post realty": "Red Post Realty, LLC",
    "cameron prestige llc": "Cameron Prestige, LLC",
    "samonas realty": "Samonas Realty, LLC",
    "carey giampa, llc/rye": "Carey & Giampa, LLC",
}

# Placeholder names that never rank on agent boards.
PLACEHOLDER_AGENTS = (
    "non-mreis agent",
    "anne erwin real estate",
    "anchor real estate",
    "comp sale / for sale by owner",
    "comp sale \\u002f for sale by owner",
)

# Companies that appear in the agent column.
COMPANIES_AS_AGENTS = (
    "anne erwin real estate",
    "anchor real estate",
)

# Designations removed from agent names.
DESIGNATIONS = (
    "CRS", "ABR", "GRI", "SRES", "SRS", "e-?PRO", "CDPE", "CNE", "CLHMS", "RSPS",
    "PSA", "MRP", "AHWD", "RENE", "C2EX", "GREEN", "SFR", "BPOR", "REALTOR", "PA",
    "BROKER", "LIC", "ASSOCIATE",
)

# Street words and their short forms.
STREET_WORDS = {
    "AVENUE": "AVE", "BOULEVARD": "BLVD", "CIRCLE": "CIR", "COURT": "CT",
    "DRIVE": "DR", "HIGHWAY": "HWY", "LANE": "LN", "PLACE": "PL",
    "ROAD": "RD", "SQUARE": "SQ", "STREET": "ST", "TERRACE": "TER",
}

# Property types kept by the residential purge.
RESIDENTIAL_TYPES = ("Single Family Residential", "Condo/Co-op")

# Page-status rules, (status, phrases), first hit wins.
PAGE_RULES = (
    ("captcha", (
        "captcha", "px-captcha", "captcha.px-cloud.net", "perimeterx",
        "verify you are human", "before we continue", "press and hold",
        "press & hold", "security check",
    )),
    ("blocked", (
        "/captcha/", "access to this page has been denied", "request unsuccessful",
        "403 forbidden", "temporarily unavailable", "access denied",
    )),
)
SALE_PAGE_RULES = (
    ("captcha", ("verify you are a human", "please verify", "captcha", "are you a robot")),
    ("error", ("the request could not be satisfied", "access denied", "request blocked")),
)
LISTING_PAGE_RULES = (("blocked", ("unexpected occurred", "access denied", "captcha")),)
DIRECTORY_PAGE_RULES = (
    ("blocked", (
        "captcha", "px-captcha", "perimeterx", "verify you are human",
        "press and hold", "access denied", "403 forbidden",
    )),
)

# Line openers that are not an office name on a profile page.
NOT_AN_OFFICE = (
    "reviews", "contact", "recent sales", "report a problem",
    "sales last 12 months", "total sales", "price range",
    "average price", "get to know", "visit ", "specialties",
)

# Thresholds.
YEAR_DAYS = 365
HIGH_VALUE = 500_000
THIN_TOWN = 50
MOVER_MIN_SIDES = 5
MOVER_TOP = 5
MOVER_BANNER_MIN = 10
STALE_DAYS_ON_MARKET = 60
SWEEP_DAYS = 7
TOWN_FILTER_CAP = 50
SEARCH_CAP = 15
GAP_DETAIL_CAP = 100
