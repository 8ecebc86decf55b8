"""Fixed values.

Word lists, lookup tables, patterns and constants that results depend on. They
are plain data; the code that uses them lives elsewhere. Larger vocabularies
(the industry list of an ICP, for one) are parameters of the jobs instead.
"""

from __future__ import annotations

# Fixed value: written to every gated row.
SCHEMA_VERSION = "1.0"

# --- triage -----------------------------------------------------------------
# Phrases that decide a page's crawl issue, with the texts and
# first characters that every match has.
PARKED = (
    ("domain", "godaddy", "sedo.com", "afternic", "namecheap", "purchase"),
    "tbdgsani",
    r"\b(this domain is for sale|buy this domain|domain parking|godaddy|sedo\.com|afternic"
    r"|namecheap parking|is available for purchase)\b",
)
UNDER_CONSTRUCTION = (
    ("coming soon", "maintenance", "under construction", "launching soon", "being built", "deploy your"),
    "csultd",
    r"\b(coming soon|site under maintenance|under construction|launching soon"
    r"|this site is (?:currently )?being built|deploy your files)\b",
)
BOT_CHALLENGE = (
    ("verify you", "attention required", "your browser", "cloudflare", "access denied", "blocked by", "a robot", "captcha"),
    "vacb",
    r"\b(verify you are human|attention required|checking your browser|cloudflare|access denied"
    r"|blocked by an extension|are you a robot|captcha)\b",
)
LOGIN_REQUIRED = (
    ("sign in to", "please log", "subscribers", "paywall"),
    "spt",
    r"\b(sign in to continue|please log in to view|subscribers only"
    r"|this content is for subscribers|paywall)\b",
)
COOKIE_BANNER = (
    ("cookie", "gdpr consent"),
    "wacg",
    r"\b(we use cookies|accept all cookies|cookie (?:policy|consent)|gdpr consent)\b",
)
LOTTERY = (
    ("draw results", "winning numbers", "lottery", "jackpot"),
    "dwlj",
    r"\b(draw results|winning numbers|lottery|jackpot)\b",
)
LISTING = (
    ("top", "best", "review"),
    "tr0-9",
    r"\b(top\s+\d+\b|\d+\s+(?:best|top)\b|reviews?\s*[:•]?\s*\d(?:\.\d)?\s*/\s*5)\b",
)
RATING = r"\d(?:\.\d)?\s*(?:/\s*5|★|stars?)\b"
LISTICLE = (
    ("top", "best", "ways", "tips", "reasons", "things", "steps", "how", "ultimate guide"),
    "tbhu0-9",
    r"\b(top\s+\d+|best\s+\d+|\d+\s+(?:ways|tips|reasons|things|steps)|how\s+to|ultimate guide)\b",
)
PARAGRAPH_SUBJECT = r"^([A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+)+)\b"
TEMPLATE_TEXT = (
    ("lorem ipsum", "welcome to", "first post", "hello world", "john doe", "jane smith", "jesse n", "frankie b"),
    "lwthjf",
    r"\b(?:lorem ipsum|welcome to wordpress|this is your first post|hello world"
    r"|john doe|jane smith|jesse n\.?|frankie b\.?)\b",
)
EMPTY_PROSE_WORDS = 15
THIN_PROSE_WORDS = 120
RATED_PARAGRAPHS = 3
REPEATED_SUBJECTS = 3

# --- page structure ---------------------------------------------------------
# Link, price and footer shapes.
MARKDOWN_LINK = r"\[([^\]]*)\]\((https?://[^\s)]+)\)"
BARE_URL = r"https?://[^\s)\]}>\"']+"
PRICE = r"(?:[$€£¥]|USD|EUR|GBP)\s?\d[\d,.]*"
PRICE_TEXTS = ("$", "€", "£", "¥", "USD", "EUR", "GBP")
FOOTER_LINES = 25
SECTION_CHARS = 4000
PRICING_TITLES = ("pricing", "plans")

# --- page fields ------------------------------------------------------------
# Host labels that do not name a company.
TRACKING_LABELS = (
    "www", "app", "docs", "blog", "marketing", "get", "go", "try",
    "shop", "store", "help", "support", "status", "mail",
)

# Social platforms and the text their links contain.
SOCIAL_PLATFORMS = {
    "linkedin_url": ("linkedin.com",),
    "twitter_url": ("twitter.com", "x.com"),
    "crunchbase_url": ("crunchbase.com",),
    "g2_url": ("g2.com",),
    "capterra_url": ("capterra.com",),
    "youtube_url": ("youtube.com",),
}
SOCIAL_MARKDOWN_LINK = r"\[([^\]]+)\]\((https?://[^\)]+)\)"
SOCIAL_BARE_URL = r"https?://[^\s)]+"

# Fixed value: copyright line.
COPYRIGHT = (
    r"©\s*(\d{4})?\s*,?\s*([A-Z][\w&.,'’\-\s]{1,80}?)"
    r"(?=\s*\.?(?:\s+All rights reserved|\s*[|\n]|\s*$))"
)

# Description limits.
DESCRIPTION_MIN_WORDS = 6
DESCRIPTION_MAX_CHARS = 500

# Language names and their codes.
LANGUAGES = {
    "english": "en", "deutsch": "de", "german": "de", "français": "fr", "francais": "fr",
    "french": "fr", "spanish": "es", "italian": "it", "portuguese": "pt", "dutch": "nl",
    "polish": "pl", "turkish": "tr", "russian": "ru", "japanese": "ja", "chinese": "zh",
    "korean": "ko", "arabic": "ar",
}

# Pricing; hints with texts and first characters of each match.
CURRENCY_SYMBOLS = {"$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY"}
PRICE_POINTS = 20
BILLING_HINTS = {
    "FREEMIUM": (("free",), "f", r"\bfree (?:plan|forever|tier)\b|freemium"),
    "USAGE": (("per ", "usage", "pay as"), "pu", r"per (?:seat|user|api call|request|credit|unit)|usage[- ]based|pay as you go"),
    "PERPETUAL": (("one-time", "one time", "lifetime", "perpetual"), "opl", r"one[- ]time (?:payment|fee)|lifetime license|perpetual license"),
    "SUBSCRIPTION": (("/", "monthly", "annually", "per month", "per year"), "/map", r"/\s?(?:mo|month|year|yr)\b|monthly|annually|per month|per year"),
}

# Careers section and role lines.
CAREERS_SECTION = (
    r"^##\s*(?:careers|jobs|open\s+(?:positions|roles)|we'?re\s+hiring|join\s+(?:us|our\s+team))\b"
    r".*?(?=^##\s|\z)"
)
ROLE_LINE = (
    r"^(.+?)\s+[—-]\s+(.+?)\s+[—-]\s+(.+?)\s+[—-]\s+Posted\s+(\d{4}-\d{2}-\d{2})\s*$"
)
ROLE_BULLET = r"^\s*[-*+]\s+"
LOOSE_HEADING = r"^#{3,4}\s+([^\n]+)$"
LOOSE_BULLET = r"^\s*[-*]\s+([^\n]+)$"
ISO_DATE = r"\b\d{4}-\d{2}-\d{2}\b"
TRAILING_PARENTHESIS = r"\(([^)]+)\)\s*$"
ROLE_SEPARATOR = r"\s*[—|]\s*|\s+-\s+|\s*,\s*"
DEPARTMENTS = (
    "engineering", "sales", "marketing", "design", "product", "support",
    "customer success", "operations", "finance", "hr", "people", "legal",
    "data", "analytics", "recruiting", "talent",
)
ROLE_TITLE_CHARS = (3, 80)
ROLE_TITLE_WORDS = 8

# Technology vendors as (code, category, aliases).
TECHNOLOGIES = (
    ("salesforce", "CRM", ("salesforce",)),
    ("hubspot", "CRM", ("hubspot",)),
    ("pipedrive", "CRM", ("pipedrive",)),
    ("zoho_crm", "CRM", ("zoho crm", "zoho.com")),
    ("dynamics_365", "CRM", ("dynamics 365", "microsoft dynamics")),
    ("close_crm", "CRM", ("close.com", "close crm")),
    ("google_analytics", "ANALYTICS", ("google analytics", "gtag", "googletagmanager")),
    ("segment", "ANALYTICS", ("segment",)),
    ("mixpanel", "ANALYTICS", ("mixpanel",)),
    ("amplitude", "ANALYTICS", ("amplitude",)),
    ("heap", "ANALYTICS", ("heap analytics", "heap.io")),
    ("hotjar", "ANALYTICS", ("hotjar",)),
    ("fullstory", "ANALYTICS", ("fullstory",)),
    ("posthog", "ANALYTICS", ("posthog",)),
    ("intercom", "SUPPORT", ("intercom",)),
    ("zendesk", "SUPPORT", ("zendesk",)),
    ("drift", "SUPPORT", ("drift.com", "drift chat")),
    ("freshdesk", "SUPPORT", ("freshdesk",)),
    ("helpscout", "SUPPORT", ("help scout", "helpscout")),
    ("frontapp", "SUPPORT", ("frontapp", "front app")),
    ("stripe", "PAYMENTS", ("stripe",)),
    ("paypal", "PAYMENTS", ("paypal",)),
    ("braintree", "PAYMENTS", ("braintree",)),
    ("adyen", "PAYMENTS", ("adyen",)),
    ("chargebee", "PAYMENTS", ("chargebee",)),
    ("recurly", "PAYMENTS", ("recurly",)),
    ("shopify", "ECOMMERCE", ("shopify",)),
    ("bigcommerce", "ECOMMERCE", ("bigcommerce",)),
    ("woocommerce", "ECOMMERCE", ("woocommerce",)),
    ("magento", "ECOMMERCE", ("magento",)),
    ("marketo", "MARKETING", ("marketo",)),
    ("mailchimp", "MARKETING", ("mailchimp",)),
    ("klaviyo", "MARKETING", ("klaviyo",)),
    ("pardot", "MARKETING", ("pardot",)),
    ("activecampaign", "MARKETING", ("activecampaign",)),
    ("braze", "MARKETING", ("braze",)),
    ("iterable", "MARKETING", ("iterable",)),
    ("customerio", "MARKETING", ("customer.io",)),
    ("wordpress", "CMS", ("wordpress", "wp-content")),
    ("webflow", "CMS", ("webflow",)),
    ("contentful", "CMS", ("contentful",)),
    ("sanity", "CMS", ("sanity.io",)),
    ("drupal", "CMS", ("drupal",)),
    ("squarespace", "CMS", ("squarespace",)),
    ("wix", "CMS", ("wix.com",)),
    ("cloudflare", "INFRA", ("cloudflare",)),
    ("aws", "INFRA", ("amazon web services", "aws")),
    ("azure", "INFRA", ("microsoft azure", "azure cloud")),
    ("gcp", "INFRA", ("google cloud platform", "google cloud")),
    ("vercel", "INFRA", ("vercel",)),
    ("netlify", "INFRA", ("netlify",)),
    ("heroku", "INFRA", ("heroku",)),
    ("digitalocean", "INFRA", ("digitalocean", "digital ocean")),
    ("slack", "COMMUNICATION", ("slack",)),
    ("zoom", "COMMUNICATION", ("zoom.us", "zoom video", "zoom meeting")),
    ("microsoft_teams", "COMMUNICATION", ("microsoft teams",)),
    ("calendly", "COMMUNICATION", ("calendly",)),
    ("github", "DEV_TOOLS", ("github",)),
    ("gitlab", "DEV_TOOLS", ("gitlab",)),
    ("jira", "DEV_TOOLS", ("jira",)),
    ("confluence", "DEV_TOOLS", ("confluence",)),
    ("linear_app", "DEV_TOOLS", ("linear.app", "linear issue tracker")),
    ("asana", "DEV_TOOLS", ("asana.com", "asana app")),
    ("trello", "DEV_TOOLS", ("trello",)),
    ("notion", "DEV_TOOLS", ("notion.so",)),
    ("snowflake", "DATA_BI", ("snowflake",)),
    ("looker", "DATA_BI", ("looker",)),
    ("tableau", "DATA_BI", ("tableau",)),
    ("power_bi", "DATA_BI", ("power bi", "powerbi")),
    ("databricks", "DATA_BI", ("databricks",)),
    ("fivetran", "DATA_BI", ("fivetran",)),
    ("dbt", "DATA_BI", ("dbt labs", "getdbt.com")),
    ("okta", "SECURITY_IAM", ("okta",)),
    ("auth0", "SECURITY_IAM", ("auth0",)),
    ("onelogin", "SECURITY_IAM", ("onelogin",)),
    ("duo_security", "SECURITY_IAM", ("duo security",)),
    ("1password", "SECURITY_IAM", ("1password",)),
    ("workday", "HR_PEOPLE", ("workday",)),
    ("bamboohr", "HR_PEOPLE", ("bamboohr",)),
    ("gusto", "HR_PEOPLE", ("gusto.com", "gusto payroll")),
    ("rippling", "HR_PEOPLE", ("rippling",)),
    ("greenhouse", "HR_PEOPLE", ("greenhouse.io", "greenhouse recruiting")),
    ("lever", "HR_PEOPLE", ("lever.co", "lever recruiting")),
)

# Compliance codes and aliases.
COMPLIANCE = (
    ("ISO27001", None, ("ISO 27001", "ISO/IEC 27001", "ISO27001")),
    ("SOC2", None, ("SOC 2", "SOC2")),
    ("NIST", None, ("NIST",)),
    ("HIPAA", None, ("HIPAA",)),
    ("PCI-DSS", None, ("PCI DSS", "PCI-DSS")),
    ("GDPR", None, ("GDPR",)),
    ("CMMC", None, ("CMMC",)),
    ("DFARS", None, ("DFARS",)),
    ("FEDRAMP", None, ("FedRAMP", "FED RAMP")),
    ("NIS2", None, ("NIS2", "NIS 2")),
    ("CYBERSECURE_CANADA", None, ("CyberSecure Canada",)),
)

# Topics and aliases.
TOPICS = (
    ("AI_ML", None, ("artificial intelligence", "machine learning", "generative ai", "llm", "deep learning")),
    ("SAAS", None, ("saas", "software as a service")),
    ("FINTECH", None, ("fintech", "financial technology", "payments")),
    ("HEALTHTECH", None, ("healthtech", "digital health", "healthcare technology")),
    ("CYBERSECURITY", None, ("cybersecurity", "infosec", "information security")),
    ("SALES", None, ("sales", "revenue growth", "go-to-market", "gtm")),
    ("MARKETING", None, ("marketing", "growth marketing", "demand generation")),
    ("RECRUITING", None, ("recruiting", "talent acquisition", "hiring")),
    ("VENTURE_CAPITAL", None, ("venture capital", "vc", "startup investing")),
    ("CLIMATE", None, ("climate tech", "sustainability", "clean energy")),
)

# Fund roles in the order they are tried.
FUND_ROLES = (
    ("MANAGING_PARTNER", None, ("managing partner", "managing director")),
    ("GENERAL_PARTNER", None, ("general partner", "gp")),
    ("VENTURE_PARTNER", None, ("venture partner",)),
    ("OPERATING_PARTNER", None, ("operating partner",)),
    ("PARTNER", None, ("partner",)),
    ("VICE_PRESIDENT", None, ("vice president", "vp")),
    ("PRINCIPAL", None, ("principal",)),
    ("ASSOCIATE", None, ("associate",)),
    ("ANALYST", None, ("analyst",)),
    ("SCOUT", None, ("scout", "venture scout")),
)

# Wording that scores a business model, with texts and first characters of each match.
PRICING_WORDING = {
    "FREEMIUM": (("free",), "f", r"\bfree (?:plan|forever|tier)\b|freemium"),
    "USAGE": (("pay as", "usage", "per "), "pu", r"pay as you go|usage[- ]based|per (?:seat|api call|credit)"),
    "PERPETUAL": (("one-time", "one time", "perpetual"), "op", r"one[- ]time payment|perpetual license"),
    "SUBSCRIPTION": (("/", "subscription"), "/s", r"/\s?(?:mo|month|year)\b|subscription"),
}
OFFERING_WORDING = {
    "MARKETPLACE": (("marketplace", "buyers and"), "mb", r"\bmarketplace\b|buyers and sellers"),
    "HARDWARE": (("hardware", "device", "ship"), "hds", r"\bhardware\b|\bdevices?\b|ships? to your"),
    "DATA": (("dataset", "api ", "data provider"), "da", r"\bdatasets?\b|\bapi (?:access|credits)\b|data provider"),
    "SERVICES": (("consulting", "service"), "cmp", r"\bconsulting\b|\bmanaged service\b|\bprofessional services\b"),
    "SAAS": (("saas", "software", "platform", "cloud"), "spc", r"\bsaas\b|\bsoftware\b|\bplatform\b|\bcloud[- ]based\b"),
}
SELF_SERVE_WORDING = (("sign up", "free trial", "serve"), "s", r"\bsign up free\b|\bstart free trial\b|\bself[- ]serve\b")
SALES_LED_WORDING = (("sales", "demo"), "cbtr", r"\bcontact sales\b|\bbook a demo\b|\btalk to sales\b|\brequest a demo\b")
DELIVERY_LABELS = ("SELF_SERVE", "SALES_LED", "HYBRID")

# Wording that names a parent company, in the order tried.
PARENT_WORDING = (
    "is a subsidiary of ",
    "a (?:wholly[- ]owned )?subsidiary of ",
    "part of ",
)

# Date shapes.
SLASH_DATE = r"\b\d{1,2}/\d{1,2}/\d{4}\b"
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)
MONTH_NAME_DATE = r"\b(?:" + "|".join(MONTHS) + r")\s+\d{1,2}?,?\s*\d{4}\b"

# Founding and duration claims, in the order tried.
FOUNDED_WORDING = ("[Ff]ounded in ", "[Ee]stablished in ", "[Ss]ince ")
DURATION_WORDING = (
    r"(?:over|more than)\s+(\d+)\s+years",
    r"(\d+)\+?\s+years?\s+(?:of experience|combined experience|in the industry)",
)

# US states.
US_STATES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA",
    "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "Florida": "FL", "Georgia": "GA",
    "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA",
    "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD",
    "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS", "Missouri": "MO",
    "Montana": "MT", "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ",
    "New Mexico": "NM", "New York": "NY", "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH",
    "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC",
    "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT",
    "Virginia": "VA", "Washington": "WA", "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}
IN_CITY_COUNTRY = (
    r"\bin\s+([A-Z][\w.\-]*(?:\s+[A-Z][\w.\-]*)*,\s*[A-Z][\w.\-]*(?:\s+[A-Z][\w.\-]*)*)\b"
)
CITY_STATE = r"\b([A-Z][a-zA-Z]+(?:\s[A-Z][a-zA-Z]+)*),\s*([A-Z]{2})\b"
REMOTE_REGION = r"\bRemote\s*\([^)]+\)"

# Languages that fit a currency; legal suffixes of a name.
CURRENCY_LANGUAGES = {
    "USD": ("en",),
    "GBP": ("en",),
    "JPY": ("ja",),
    "EUR": ("en", "de", "fr", "es", "it", "nl", "pt"),
}
LEGAL_SUFFIX = r"\b(inc|llc|ltd|limited|corp|corporation|gmbh|co|plc|s\.?a\.?|b\.?v\.?)\b\.?"

# --- gate -------------------------------------------------------------------
# Domain shape and strings that stand for "nothing".
DOMAIN_SHAPE = r"^[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+$"
PLACEHOLDERS = ("n/a", "na", "unknown", "none", "null", "not specified", "not available", "tbd")
ROLE_KEYS = ("title", "department", "location", "posted_date")
REQUIRED_EMPTY_PENALTY = 30.0
LOWER_SOURCE_PENALTY = 2.0
DRIFT_WINDOW = 20
DRIFT_MIN_HISTORY = 5

# --- profiles ---------------------------------------------------------------
# Title wording of the seniority ladder, highest first.
SENIORITY_WORDING = (
    ("C_LEVEL", r"\b(chief|ceo|cfo|coo|cto|cmo|cpo|cro|president|founder|co-founder)\b"),
    ("VP", r"\b(vp|vice president|svp|evp)\b"),
    ("DIRECTOR", r"\b(director|head of)\b"),
    ("MANAGER", r"\b(manager|lead|supervisor)\b"),
)

# Headcount brackets (upper bound, label).
HEADCOUNT_BANDS = (
    (10, "1-10"), (50, "11-50"), (200, "51-200"), (500, "201-500"),
    (1000, "501-1000"), (5000, "1001-5000"), (10000, "5001-10000"),
)
HEADCOUNT_ABOVE = "10001+"
ACTIVE_ROLES = 5
CONNECTIONS_CEILING = 500
MUTUAL_SAMPLE = 3

# Company types and their spellings.
COMPANY_TYPES = {
    "PUBLIC_COMPANY": ("public company",),
    "PRIVATELY_HELD": ("privately held", "private company"),
    "NONPROFIT": ("nonprofit", "non-profit", "non profit"),
    "GOVERNMENT_AGENCY": ("government agency",),
    "PARTNERSHIP": ("partnership",),
    "SELF_EMPLOYED": ("self-employed", "self employed"),
    "SOLE_PROPRIETORSHIP": ("sole proprietorship",),
    "EDUCATIONAL_INSTITUTION": ("educational institution", "educational"),
}

# Shapes found in a bio.
BIO_URL = r"https?://[^\s)]+"
BIO_COMPANY = r"(?:\bat\s+|@\s*)([A-Z][\w&\-]*(?:\s+[A-Z][\w&\-]*){0,4})"
BIO_HANDLE = r"(?<!\w)@(\w{2,30})\b"

# End dates that mean "still there".
ONGOING = ("present", "current", "now", "")

# Person-name titles and credentials, compared without dots in upper case.
NAME_TITLES = ("DR", "PROF", "MR", "MRS", "MS", "MX")
NAME_CREDENTIALS = (
    "MD", "PHD", "PHARMD", "MBA", "MSC", "MS", "MA", "BA", "BS", "BSC",
    "RN", "RPH", "DDS", "DO", "JD", "CPA", "MPH", "MPHARM", "DVM", "EDD",
    "BCACP", "BCIDP", "GPC", "FAPCR", "EMSHA", "LSSBBP", "MCH", "FACP",
    "FACC", "FRCP", "MRCP", "FAAP", "MSPH", "MHA", "MPA",
)

# Key spellings of profile records.
COMPANY_KEYS = {
    "name": ("name", "companyName", "companyname"),
    "industry": ("industry", "companyIndustry"),
    "headcount": ("headcount", "employeeCount", "staffCount", "companySize"),
    "location": ("location", "hqLocation", "companyLocation"),
    "linkedin_url": ("linkedin_url", "linkedinUrl", "url", "companyUrl"),
}
PERSON_KEYS = {
    "linkedin_url": ("linkedin_url", "linkedinUrl", "profileUrl", "url"),
    "full_name": ("full_name", "fullName", "name"),
    "job_title": ("job_title", "jobTitle", "headline", "occupation"),
    "country": ("country", "addressCountryOnly", "location"),
    "linkedin_about": ("linkedin_about", "about", "summary"),
    "age": ("age", "estimatedAge"),
    "company_industry": ("company_industry", "companyIndustry", "currentCompanyIndustry"),
}
CERTIFICATION_KEYS = {
    "name": ("name", "title", "certification"),
    "issuer": ("issuer", "authority", "organization"),
    "issued_date": ("issued_date", "issue_date", "date"),
}

# --- ICP --------------------------------------------------------------------
# Company-size buckets; limits.
SIZE_BUCKETS = (
    "1", "2-10", "11-50", "51-200", "201-500", "501-1,000", "1,001-5,000", "5,001-10,000", "10,001+",
)
LEAD_BATCH = 50

# Field groups of the audit view.
AUDIT_GROUPS = {
    "Identity": ("domain_normalize", "company_entity_resolve"),
    "Descriptive": ("company_description_extract", "legal_entity_extract", "business_model"),
    "Signals": (
        "tech_stack_normalize", "compliance_framework_extract", "experience_signal_extract",
        "service_region_extract", "pricing_locale_extract", "careers_page_parse",
        "social_links_extract", "site_locale_detect", "date_normalize",
    ),
}
QUALITY_BANDS = ((80.0, "green"), (50.0, "amber"), (0.0, "red"))
