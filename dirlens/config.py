"""User-customizable configuration: dictionaries, quality rules, keyword rules, selectors.

The defaults below are FIXED VALUES that must equal the reference's behaviour
(dictionary entries, rule weights, validation patterns, keyword lists, page
selectors). They are data, kept here in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (normalization dictionary)
# ---------------------------------------------------------------------------
DEFAULT_COUNTRIES = {
    "BD": {"name": "Bangladesh", "full_name": "Bangladesh", "region": "South Asia"},
    "IN": {"name": "India", "full_name": "India", "region": "South Asia"},
    "US": {"name": "United States", "full_name": "United States of America",
           "region": "North America"},
}

DEFAULT_INDUSTRY_TAXONOMY = [
    "Agriculture", "Construction", "Education", "Entertainment", "Finance",
    "Food & Beverage", "Government", "Healthcare", "IT & Technology",
    "Manufacturing", "Real Estate", "Retail", "Transportation",
]
DEFAULT_INDUSTRY_ALIASES = {
    "Tech": "IT & Technology",
    "Software": "IT & Technology",
    "Farming": "Agriculture",
    "Building": "Construction",
    "Shop": "Retail",
}

DEFAULT_CORE_MODULES = [
    "Sales", "CRM", "Accounting", "Inventory", "HR", "Project Management",
    "Marketing", "Helpdesk",
]
DEFAULT_MODULE_ALIASES = {
    "Customer Relationship Management": "CRM",
    "Human Resources": "HR",
    "Accounts": "Accounting",
    "Stock": "Inventory",
}

# Tier set used by the cleaner, and the badge words stripped from names.
DEFAULT_TIERS = ["Gold", "Silver", "Ready"]
DEFAULT_BADGES = ["Gold", "Silver", "Ready"]
# Sort rank of tiers in the flattened partner/client export; others rank 3.
DEFAULT_TIER_RANK = {"Gold": 0, "Silver": 1, "Ready": 2}

# ---------------------------------------------------------------------------
# FIXED VALUES (quality rules)
# ---------------------------------------------------------------------------
DEFAULT_MANDATORY = {
    "providers": ["name", "country", "source_url"],
    "clients": ["client_name", "provider_id", "industry"],
    "references": ["client_id", "description"],
}
DEFAULT_PATTERNS = {
    "url": r"^https?://[^\s]+$",
    "country_code": r"^(BD|IN|US)$",
}
DEFAULT_WEIGHTS = {
    "name": 1.0,
    "country": 1.0,
    "location": 0.8,
    "website": 0.9,
    "services": 0.9,
}

# ---------------------------------------------------------------------------
# FIXED VALUES (keyword rules)
# ---------------------------------------------------------------------------
# Multi-label service classification, label -> keywords, in order.
DEFAULT_SERVICE_KEYWORDS = [
    ("Implementation", ["implementation", "setup", "install", "deploy", "configure"]),
    ("Customization", ["customization", "customize", "custom", "module", "develop"]),
    ("Integration", ["integration", "integrate", "api", "payment", "gateway"]),
    ("Migration", ["migration", "migrate", "upgrade", "data"]),
    ("Support & Training", ["support", "training", "consultant", "consulting", "help",
                            "fix", "bug"]),
    ("Web & E-commerce", ["website", "ecommerce", "store", "shop", "design", "theme"]),
]
# First-match industry inference from a reference description, in order.
DEFAULT_INDUSTRY_KEYWORDS = [
    ("Manufacturing", "manufacturing"),
    ("Retail", "retail"),
    ("Healthcare", "health"),
    ("Finance", "finance"),
    ("Education", "education"),
    ("Services", "service"),
]
DEFAULT_INDUSTRY_FALLBACK = "General"

# Block-page markers and listing limits.
DEFAULT_BLOCK_MARKERS = ["It needs a human touch", "Access Denied"]
MAX_LISTING_PAGES = 10

# Page selectors per target.
DEFAULT_TARGETS = {
    "bangladesh": {
        "base_url": "https://www.example.com/providers/bangladesh",
        "country_code": "BD",
        "listing": {"provider_link": "a.provider-link", "next_page": "a.next-page"},
        "detail": {
            "name": "h1.company-name",
            "tier": ".badge-tier",
            "location": ".location-info",
            "website": "a.website-link",
            "description": ".about-section",
            "services": ".services-list li",
            "references": ".client-references li",
        },
    },
    "gig_marketplace": {
        "base_url": "https://www.example.com/search/gigs",
        "country_code": "XX",
        "listing": {"provider_link": "div[data-testid^='gig-card'] a[href^='/']",
                    "next_page": "li.page-item a[aria-label='Next']"},
        "detail": {
            "name": "h1",
            "tier": ".seller-level",
            "location": ".seller-location",
            "website": "",
            "description": ".description-wrapper",
            "services": ".gig-metadata li",
            "references": ".reviews-wrapper .review-item",
        },
    },
}
# ---------------------------------------------------------------------------


def _lookup(names: list, aliases: dict) -> dict:
    out = {a.lower(): name for a, name in reversed(aliases.items())}
    out.update({n.lower(): n for n in reversed(names)})
    return out


@dataclass
class Dictionary:
    countries: dict = field(default_factory=lambda: dict(DEFAULT_COUNTRIES))
    industry_taxonomy: list = field(default_factory=lambda: list(DEFAULT_INDUSTRY_TAXONOMY))
    industry_aliases: dict = field(default_factory=lambda: dict(DEFAULT_INDUSTRY_ALIASES))
    core_modules: list = field(default_factory=lambda: list(DEFAULT_CORE_MODULES))
    module_aliases: dict = field(default_factory=lambda: dict(DEFAULT_MODULE_ALIASES))
    tiers: list = field(default_factory=lambda: list(DEFAULT_TIERS))
    badges: list = field(default_factory=lambda: list(DEFAULT_BADGES))

    def industry_lookup(self) -> dict:
        """lower(taxonomy name or alias) -> taxonomy name; the taxonomy's own names win."""
        return _lookup(self.industry_taxonomy, self.industry_aliases)

    def module_lookup(self) -> dict:
        """lower(core module or alias) -> core module; the core modules' own names win."""
        return _lookup(self.core_modules, self.module_aliases)

    def country_lookup(self) -> dict:
        """lower(name) and lower(full_name) -> code; first code wins on clashes."""
        out: dict = {}
        for code, info in self.countries.items():
            for key in (info.get("name", ""), info.get("full_name", "")):
                if key and key.lower() not in out:
                    out[key.lower()] = code
        return out


@dataclass
class QualityRules:
    mandatory: list = field(default_factory=lambda: list(DEFAULT_MANDATORY["providers"]))
    weights: dict = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))
    country_pattern: str = DEFAULT_PATTERNS["country_code"]
    tier_pattern: str | None = None          # absent in the default rules => always valid
    url_pattern: str = DEFAULT_PATTERNS["url"]
    short_description: int = 50
    description_full: float = 200.0
    #: Mandatory fields of every entity that the rules declare.
    entities: dict = field(default_factory=lambda: {k: list(v) for k, v in DEFAULT_MANDATORY.items()})


@dataclass
class KeywordRules:
    services: list = field(default_factory=lambda: list(DEFAULT_SERVICE_KEYWORDS))
    industries: list = field(default_factory=lambda: list(DEFAULT_INDUSTRY_KEYWORDS))
    industry_fallback: str = DEFAULT_INDUSTRY_FALLBACK


def load_targets(path: str) -> dict:
    """Page targets from a JSON file {name: {base_url, country_code, listing, detail}}."""
    import json
    with open(path, "r", encoding="utf-8") as f:
        return json.load(f)


def target_named(name: str, targets: dict | None = None) -> dict:
    """The target of that name; ValueError naming the known ones if there is none."""
    known = DEFAULT_TARGETS if targets is None else targets
    if name not in known:
        raise ValueError(f"unknown target {name!r}; known: {', '.join(sorted(known))}")
    return known[name]


def load_dictionary(path: str) -> tuple[Dictionary, QualityRules]:
    """Read a dictionary JSON file (driver side, a few KB) into config objects."""
    import json
    with open(path, "r", encoding="utf-8") as f:
        raw = json.load(f)
    d = Dictionary()
    if "countries" in raw:
        d.countries = raw["countries"]
    ind = raw.get("industries", {})
    d.industry_taxonomy = ind.get("standardized_taxonomy", d.industry_taxonomy)
    d.industry_aliases = ind.get("normalization_map", d.industry_aliases)
    mod = raw.get("service_modules", {})
    d.core_modules = mod.get("core_modules", d.core_modules)
    d.module_aliases = mod.get("module_aliases", d.module_aliases)
    q = QualityRules()
    rules = raw.get("data_quality_rules", {})
    q.entities = {**q.entities, **rules.get("mandatory_fields", {})}
    q.mandatory = list(q.entities["providers"])
    pats = rules.get("validation_patterns", {})
    q.country_pattern = pats.get("country_code", q.country_pattern)
    q.url_pattern = pats.get("url", q.url_pattern)
    q.tier_pattern = pats.get("tier", None)
    q.weights = rules.get("completeness_weights", {}).get("providers", q.weights)
    return d, q
