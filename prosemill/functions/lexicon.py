"""Term tables of the default lexicon. Everything here is data; patterns.py makes expressions of it.

All tables below are fixed values: results depend on each term and on the order.
"""

# Groups of URL terms that block a page, whole words on the lower-cased URL.
BLOCKED_URL = [
    r"casino|poker|slot|betting|gambl|jackpot|roulette|blackjack|sportsbook",
    r"dating|hookup|escort|adult|porn|xxx|cam[s]?girl|onlyfans",
    r"coupon[s]?code|promo-?code|discount-?code|deal[s]?of|cashback|freebies",
    r"buy-?backlinks|seo-?service|link-?building|guest-?post-?service|pbn",
    r"viagra|cialis|pharmacy-?online|buy-?pills|weight-?loss-?pill",
    r"djvu|torrent|pirate|warez|cracked|keygen",
]
# Groups of phrases that mark spam.
SPAM_CONTENT = [
    r"free\s+spins|no\s+deposit\s+bonus|wagering\s+requirement|slot\s+machine|live\s+dealer",
    r"find\s+a\s+date|singles\s+near|hookup\s+site|dating\s+app\s+review",
    r"click\s+here\s+to\s+buy|limited\s+time\s+offer|act\s+now|order\s+today",
    r"crypto\s+signal|forex\s+robot|binary\s+option|guaranteed\s+return|passive\s+income\s+online",
]
# Verbs of deciding, with stems.
DECISION_STEMS = [
    r"evaluat\w*", r"compar\w*", r"assess\w*", "chose", "choose", "choosing", r"select\w*", r"shortlist\w*", r"procur\w*", r"purchas\w*",
    r"switch\w*", r"migrat\w*", r"adopt\w*", r"implement\w*", r"deploy\w*", r"negotiat\w*", r"renew\w*", r"cancel\w*", r"replac\w*",
    r"onboard\w*", r"integrat\w*", r"pilot\w*", r"trial\w*", r"demo\w*", r"benchmark\w*", r"vett\w*", r"audit\w*", r"review\w*", r"analyz\w*",
    r"test(?:ed|ing)", "decided", "deciding", r"sign(?:ed|ing)\s+(?:up|on|with)", r"went\s+with", r"opted\s+for", r"rolled?\s+out",
    r"narrow\w*\s+down", r"ruled?\s+out",
]
# Nouns and names of products.
PRODUCT_NOUNS = [
    "SaaS", "software", "platform", "tool", "solution", "vendor", "provider", "product", "service", "subscription", "license",
    "CRM", "ERP", "HRIS", "HCM", "LMS", "CMS", "ATS", "CDP", "cloud", "API", "dashboard", "module", "suite",
    "Salesforce", "HubSpot", "Workday", "ServiceNow", "Zendesk", "Slack", "Jira", "Confluence", "Notion", "Asana", "Monday",
    "SAP", "Oracle", r"Microsoft\s+365", r"Google\s+Workspace", "AWS", "Azure", "GCP", "Snowflake", "Databricks",
    "Stripe", "Twilio", "SendGrid", "Okta", "Auth0", r"enterprise\s+software", r"business\s+application", r"tech\s+stack", r"software\s+stack",
    "martech", r"procurement\s+system", r"vendor\s+management",
]
# Phrases of reasoning.
REASONING_PHRASES = [
    "because", r"due\s+to", r"owing\s+to", "needed", "required", "requirement[s]?",
    r"after\s+(?:testing|evaluating|comparing|reviewing|trying|assessing|piloting)", r"deciding\s+factor", r"key\s+factor", r"main\s+reason",
    r"the\s+reason\s+(?:we|they|our|I)", r"in\s+order\s+to", r"so\s+(?:we|they|that)", r"which\s+(?:led|helped|allowed|enabled|made)",
    r"as\s+a\s+result", "consequently", "therefore", r"based\s+on", r"given\s+(?:that|the)", "considering",
    r"(?:better|worse|cheaper|faster|easier|harder)\s+than", r"compared\s+to", "versus", r"vs\.?", r"pros?\s+and\s+cons?", "trade-?off",
    "ultimately", r"finally\s+(?:chose|decided|went|selected)",
    r"the\s+(?:biggest|main|primary|key)\s+(?:advantage|disadvantage|benefit|drawback|concern|issue)",
    r"what\s+(?:sold|convinced|swayed|persuaded)\s+(?:us|them|me)", r"(?:worth|not\s+worth)\s+(?:the|it)", r"outweigh\w*", r"prioritiz\w*",
    "criteria", "must-?have", "nice-?to-?have", "deal-?breaker",
]
# Marks of a narrative.
NARRATIVE_MARKERS = [
    "because", r"after\s+testing", r"decided\s+to", "evaluated", "chose", "rejected", r"due\s+to", "needed", "challenge", "concern", "issue",
    "struggled", r"switched\s+(?:from|to)", r"we\s+(?:chose|picked|went|opted|decided|needed|found|tried|tested)",
    r"our\s+(?:team|company|org|experience)", r"pain\s+point", r"deal\s*breaker", r"lesson\s+learned", r"in\s+hindsight", r"looking\s+back",
    r"turned\s+out", r"pros?\s+and\s+cons?", "trade-?off", "downside", "upside",
]
# Parts of URLs of documentation.
DOCS_URL = [
    "/docs?/", "/help/", "/support/", "/kb/", "/knowledge-?base/", "/api-?(?:reference|docs?)/", "/developer[s]?/", "/guide[s]?/", "/tutorial[s]?/",
    "/how-?to/", "/faq/", "/changelog/", "/release-?notes?/", "/reference/", r"docs\.", r"help\.", r"support\.", r"wiki\.", r"learn\.", r"developer[s]?\.",
]
# URL parts and domains that raise a page's score, and URL parts that lower it.
HIGH_URL = [
    "/case-?stud(?:y|ies)", "/success-?stor(?:y|ies)", "/customer-?stor(?:y|ies)", "/customer-?case", "/client-?stor(?:y|ies)",
    "/migrat(?:e|ion|ing)", "/switch(?:ing|ed)", "/mov(?:ing|ed)-?(?:from|to|away)", r"/from-\w+-to-\w+", "/why-we-(?:chose|switched|moved|use|replaced)",
    "/compar(?:e|ison|ing)", "/vs-?", "/versus", "/alternatives?", "/evaluation", "/vendor-?(?:compar|select|assess|review)", "/tool-?compar",
    "/rfp", "/procurement", "/vendor-?select", "/buying-?guide", "/software-?select", "/engineering-?blog", "/tech-?blog", "/retrospect", "/post-?mortem",
    "/lessons-?learned", "/how-we-", "/why-we-", "/security-?(?:review|assessment|evaluat)", "/compliance-?(?:review|check)", "/review", "/analysis",
    "/deep-?dive", "/breakdown",
]
HIGH_DOMAIN = [
    r"g2\.com", r"capterra\.com", r"trustradius\.com", r"gartner\.com", r"forrester\.com", r"idc\.com", r"infoq\.com",
    r"engineering\.(?:\w+\.)?(?:com|io)", r"blog\.(?:\w+\.)?(?:com|io)", r"medium\.com", r"dev\.to", r"hashnode\.(?:com|dev)",
    r"hbr\.org", r"mckinsey\.com", r"deloitte\.com",
]
LOW_URL = [
    "/product[s]?/?$", "/feature[s]?/?$", "/pricing/?$", "/plans/?$", "/about/?$", "/about-us/?$", "/contact/?$", "/login/?$", "/signup/?$",
    "/home/?$", "/index", "/404", "/error", "job", "career", "hire", "recruit", "position", "opening",
]
# Keywords and weights; the order is the order of matched keywords.
WEIGHTED = {
    "chose": 5, "choose": 4, "selected": 5, "shortlist": 4, "compare": 3, "evaluated": 5, "evaluate": 4, "adopted": 5, "rejected": 5, "replaced": 5,
    "switched": 5, "migrated": 5, "procured": 5, "purchased": 4, "trialed": 4, "piloted": 4, "procurement": 5, "RFP": 5, "proof of concept": 5,
    "due diligence": 5, "vendor selection": 6, "security review": 5, "compliance check": 5, "vendor assessment": 5, "moved from": 6, "switched from": 6,
    "migrated from": 6, "migrated away": 6, "replaced with": 5, "transitioned from": 5, "vendor lock-in": 5, "too expensive": 5, "integration issues": 5,
    "scalability issues": 5, "security concerns": 5, "lacked support": 5, "onboarding difficulty": 5, "onboarding": 3, "implementation": 3, "rollout": 3,
    "data migration": 4, "SLA": 4, "integration": 2, "pricing": 3, "scalability": 2, "vendor": 4, "contract": 3, "renewal": 3, "pilot": 4,
    "stakeholder": 3, "compliance": 3, "ROI": 4, "total cost of ownership": 5, "single sign-on": 3, "API": 2, "trial": 3, "deploy": 2, "migrate": 4,
}
MIN_SCORE, SOURCE_BONUS, MAX_SNIPPET = 8, 4, 480
# Substrings of which a raw record needs one.
PREFILTER = ["SaaS", "software purchase", "vendor selection", "procurement", "RFP", "software evaluation", "cloud platform", "enterprise software"]
# Substrings of the two-signal prefilter, terms of deciding and of acting; regular expressions on titles.
TWO_SIGNAL_DECISION = [
    "chose", "selected", "switched", "migrated", "evaluated", "replaced", "rejected", "moved from", "adopted", "piloted", "trialed", "we decided",
    "we went with", "we ended up", "we picked", "procured", "purchased",
]
TWO_SIGNAL_ACTOR = ["we ", "our team", "our company", "our org", "we've ", "the team selected", "the company chose", "they selected", "the client", "my team"]
# The two-signal test of other sources: shortest text, terms of deciding, terms of acting (empty: not asked for).
PREFILTERS = {
    "reviews": (
        80,
        ["chose", "selected", "switched", "migrated", "evaluated", "replaced", "rejected", "moved from", "adopted", "piloted", "procured", "purchased", "trialed"],
        ["we ", "our team", "our company", "our org", "we've ", "the team", "the company", "they selected", "they chose", "the client", "the organization"],
    ),
    "articles": (
        100,
        ["chose", "selected", "switched", "migrated", "evaluated", "replaced", "rejected", "moved from", "adopted", "piloted"],
        ["we ", "our team", "our company", "we've ", "we'd "],
    ),
    "items": (
        101,
        ["chose", "selected", "switched", "migrated", "evaluated", "replaced", "rejected", "moved from", "adopted", "piloted", "trialed"],
        ["we ", "our team", "our company", "we've ", "we'd "],
    ),
    "posts": (
        80,
        ["chose", "selected", "switched", "migrated", "evaluated", "replaced", "rejected", "moved from", "adopted", "piloted", "trialed", "we decided", "we went with", "we ended up", "we picked"],
        ["we ", "our team", "our company", "our org", "we've ", "we'd ", "the team", "the company", "my team", "our shop"],
    ),
    "questions": (
        0,
        [
            "switched from", "migrated from", "replaced", "chose instead", "moved away from", "why we use", "we chose", "we selected", "alternatives considered", "comparison", "vs ",
            "instead of", "moved to", "switched to", "migrated to", "evaluated", "shortlisted", "why not", "we decided", "our team chose", "we went with",
        ],
        [],
    ),
    "expansion": (200, ["switched", "migrated", "replaced", "chose", "moved from", "alternatives", "we decided", "we selected"], []),
}
# The same test by whole words; a term that ends in a space needs a word after it.
REGEX_PREFILTERS = {
    "targeted_items": (
        80,
        ["chose", "switched", "migrated", "replaced", "moved", "adopted", "selected", "evaluated", "decided", "implemented", "deployed", "went with", "ended up"],
        ["we ", "our team", "our company", "my team", "my company", "i ", "i've", "we've", "we're", "we chose", "we migrated", "we moved", "we switched", "we replaced"],
    ),
    "answers": (
        100,
        ["chose", "switched", "migrated", "replaced", "moved", "adopted", "selected", "evaluated", "decided", "implemented", "deployed", "went with", "ended up", "settled on"],
        [
            "we ", "our team", "our company", "our org", "my team", "my company", "i ", "i've", "we've", "we're", "our stack", "we chose", "we migrated", "we moved", "we switched",
            "we replaced", "we selected", "we went with", "we decided", "we ended up", "we evaluated",
        ],
    ),
    "expansion_words": (
        0,
        ["chose", "switched", "migrated", "replaced", "moved", "adopted", "selected", "evaluated", "decided", "implemented", "deployed"],
        ["we", "our team", "our company", "our org", "i ", "the team", "the company", "my team", "our stack", "we've", "we're"],
    ),
}
# Phrases of which a raw record of the targeted ingestion needs one.
TARGETED = [
    "we chose", "we selected", "we evaluated", "we switched", "we migrated", "we replaced", "we adopted", "we rejected", "we piloted", "we trialed", "we procured", "we purchased",
    "why we switched", "why we chose", "why we moved", "why we use", "why we replaced", "moved from", "migrated from", "switched from", "migrated away from", "transitioned from",
    "replaced with", "moved away from", "vendor evaluation", "vendor selection", "software evaluation", "evaluated several", "evaluated multiple", "compared vendors",
    "shortlisted vendors", "proof of concept", "security review", "compliance review", "procurement process", "RFP process", "request for proposal", "vendor assessment",
    "due diligence", "rejected because", "decided against", "too expensive for", "vendor lock-in", "lacked support", "integration issues", "scalability issues",
    "security concerns", "case study", "lessons learned", "retrospective", "post-mortem", "engineering blog", "tech stack", "tool evaluation",
]
TITLE_SIGNALS = [
    "switched", "migrated", "migration", "chose", "selected", "moved from", "from.*to", "vs ", "compared", "why we", "how we", "replaced",
    "alternatives", "evaluation", "choosing", "decided", "abandoned", "deprecated", "away from", "instead of", "over.*because",
]
# Strict verbs, markers and actors of the narrative gate.
GATE_VERBS = [
    "chose", "choose", "selected", "select", "evaluated", "evaluate", "shortlisted", "shortlist", "compared", "compare", "trialed", "trial",
    "piloted", "pilot", "adopted", "adopt", "purchased", "purchase", "procured", "procurement", "rejected", "reject", "replaced", "replace",
    "switched", "switch", "migrated", "migrate",
]
GATE_MARKERS = [
    "because", "due to", "since", "so that", "therefore", "as a result", "needed", "required", "requirement", "must have", "deciding factor",
    "dealbreaker", "concern", "concerns", "issue", "issues", "challenge", "challenges", "risk", "risks", "limitation", "limitations", "friction",
    "tradeoff", "trade-off", "too expensive", "pricing", "security review", "compliance", "integration", "vendor lock-in", "onboarding",
    "implementation", "support", "moved from", "switched from", "migrated away", "transitioned", "deprecated", "lacked", "scalability",
]
_DONE = "chose|selected|evaluated|adopted|rejected|replaced|switched|migrated|purchased|procured"
GATE_ACTORS = [
    rf"we\s+(?:{_DONE}|trialed|piloted|decided|moved\s+(?:from|to|away)|opted\s+(?:for|to)|ended\s+up\s+(?:with|choosing|selecting|going)|went\s+with|settled\s+on|shortlisted|narrowed\s+down|picked|signed\s+(?:up\s+with|a\s+contract|on\s+with))",
    rf"our\s+(?:team|company|org|organization|engineering|engineers|developers|devs|security|infra|infrastructure|ops|management|procurement|finance|it\s+(?:department|team)|cto|vp|ciso|procurement\s+team|buying\s+committee|leadership)\s+(?:\w+\s+){{0,3}}(?:{_DONE}|trialed|piloted|decided|opted)",
    rf"(?:the\s+)?(?:company|organization|team|firm|enterprise|client|customer|vendor|agency|startup|corporation)\s+(?:{_DONE}|trialed|piloted|decided|moved|opted)",
    rf"(?:they|the\s+team|management|engineering|leadership|the\s+client|the\s+vendor|the\s+customer)\s+(?:{_DONE}|decided|opted|needed|required)",
    r"(?:was|were)\s+(?:chosen|selected|evaluated|adopted|rejected|replaced|switched|migrated|purchased|procured|shortlisted)\s+(?:by|after|because|due\s+to)",
    r"(?:we|our\s+team|our\s+company)\s+(?:moved|switched|migrated|transitioned)\s+(?:from|away\s+from|to)",
    r"why\s+we\s+(?:chose|switched|moved|use|replaced|selected|went\s+with)",
    r"how\s+we\s+(?:chose|evaluated|selected|decided|migrated|switched)",
    r"after\s+(?:evaluating|comparing|testing|trialing|piloting|assessing|reviewing|shortlisting|benchmarking)\s+(?:\w+\s+){0,4}(?:we|the\s+team|our\s+team|management)",
    r"decision\s+(?:was\s+made|to\s+(?:choose|select|adopt|reject|replace|switch|migrate|purchase|procure))",
]
DROPPED = {"verb": "dropped_missing_decision_verb", "marker": "dropped_missing_reason_marker", "actor": "dropped_missing_actor", "nav": "dropped_navigation_noise", "bio": "dropped_bio_or_job_description", None: "passed"}
# Labels and their patterns, open at the end.
WORKFLOW = {
    "discovery": r"discover\w*|research\w*|look(?:ing)?\s+(?:for|into)|explor\w*|search(?:ing)?",
    "evaluation": r"evaluat\w*|compar\w*|assess\w*|review\w*|analyz\w*|benchmark\w*|test(?:ing)?",
    "shortlisting": r"shortlist\w*|narrow(?:ed)?\s+down|top\s+\d|finalist|candidate",
    "trial": r"trial|pilot|proof\s+of\s+concept|POC|demo|free\s+tier|sandbox",
    "negotiation": r"negotiat\w*|pricing|contract\w*|discount\w*|terms|proposal|quote",
    "procurement": r"procurement|RFP|RFI|RFQ|purchas\w*|buy(?:ing)?|acquisition",
    "implementation": r"implement\w*|deploy\w*|migrat\w*|onboard\w*|rollout|integrat\w*|launch",
    "renewal": r"renew\w*|churn\w*|switch(?:ing)?|replac\w*|cancel\w*|retent\w*",
}
CRITERIA = {
    "pricing": r"pric\w*|cost\w*|budget|expense|ROI|TCO|total\s+cost",
    "security": r"secur\w*|complian\w*|SOC\s*2|GDPR|HIPAA|encrypt\w*|audit\w*",
    "scalability": r"scal\w*|performance|uptime|SLA|reliab\w*|availab\w*",
    "integration": r"integrat\w*|API|connect\w*|plugin|ecosystem|interoper\w*",
    "usability": r"usab\w*|UX|user\s+experience|intuitive|ease\s+of\s+use|learning\s+curve",
    "support": r"support\w*|customer\s+success|documentation|training|onboard\w*",
    "features": r"feature\w*|capabilit\w*|function\w*|workflow\w*|automat\w*",
}
OBJECTION = {
    "too_expensive": r"too\s+expensive|over\s*budget|cost\s+prohibitive|pric(?:ey|y)",
    "security_concern": r"security\s+concern|not\s+compliant|failed\s+audit|data\s+breach",
    "poor_integration": r"doesn.t\s+integrat\w*|no\s+API|lack.*integrat\w*|incompatible",
    "complexity": r"too\s+complex|steep\s+learning|hard\s+to\s+use|complicated",
    "vendor_lock_in": r"vendor\s+lock|lock.?in|proprietary|switching\s+cost",
    "missing_feature": r"missing\s+feature|doesn.t\s+support|no\s+support\s+for|lack",
}
INDUSTRY = {
    "healthcare": r"health\w*|medical|hospital|pharma\w*|HIPAA|patient|clinical",
    "finance": r"financ\w*|bank\w*|fintech|trading|payment\w*|insur(?:ance)?",
    "education": r"educ\w*|university|school|learning|LMS|academic",
    "ecommerce": r"ecommerce|e-commerce|retail|shop\w*|marketplace|cart",
    "technology": r"tech\w*|software|SaaS|startup|developer|engineering",
    "manufacturing": r"manufactur\w*|supply\s+chain|logistics|warehouse|inventory",
    "government": r"government|federal|public\s+sector|FedRAMP|agency",
    "media": r"media|publish\w*|content|broadcast\w*|entertainment|streaming",
}
# Navigation terms; biography and job phrases with what overrides them; promotion.
NAV_TERMS = [
    "skip to content", "skip to main", "skip to navigation", "home", "about us", "about", "contact us", "contact", "services", "our services",
    "products", "solutions", "pricing", "blog", "resources", "careers", "faq", "faqs", "terms of service", "terms of use", "privacy policy", "privacy",
    "cookie policy", "sitemap", "site map", "sign in", "sign up", "log in", "log out", "login", "logout", "register", "subscribe", "unsubscribe",
    "follow us", "share this", "tweet", "pin it", "all rights reserved", "copyright", "read more", "learn more", "see more", "view all", "get started",
    "get a demo", "request demo", "book a demo", "free trial", "start free", "try free", "try it free", "menu", "navigation", "search", "close",
    "back to top", "next", "previous", r"page \d+", "accept cookies", "cookie preferences", "we use cookies", "this site uses cookies", "accept all cookies",
]
BIO = [
    r"(?:senior|junior|lead|staff|principal|chief|head of|vp of|director of|manager of|associate|intern)\s+"
    r"(?:software|data|product|project|program|marketing|sales|account|customer|business|operations|engineering|design|devops|cloud|security|compliance|hr|finance|support)\s*"
    r"(?:engineer|developer|architect|analyst|scientist|manager|director|officer|specialist|consultant|coordinator|lead|representative|executive|strategist|designer)?",
    r"years?\s+of\s+experience", r"responsible\s+for", r"job\s+(?:description|responsibilities|duties|requirements|qualifications)", r"key\s+responsibilities",
    r"(?:bachelor|master|phd|mba|degree)\s+in", r"graduated\s+from", "resume", r"curriculum\s+vitae", r"looking\s+for\s+(?:a|an)\s+(?:job|position|role|opportunity)",
    r"apply\s+(?:now|today|here)", r"(?:full|part)\s*-?\s*time\s+(?:position|role|opportunity|job)", r"salary\s+range", r"compensation\s+package",
    r"we\s+are\s+(?:looking|hiring|seeking)",
]
BIO_OVERRIDE = [
    "chose", "selected", "evaluated", "adopted", "purchased", "procured", "rejected", "replaced", "switched", "migrated", r"vendor\s+selection",
    r"procurement\s+(?:process|decision)", r"buying\s+decision", r"evaluation\s+criteria", "shortlisted", r"compared\s+(?:vendors|solutions|platforms|tools)",
]
FIRST_PERSON = ["we chose", "we selected", "we evaluated", "we adopted", "we switched", "we migrated", "we replaced", "we procured"]
PROMO = [
    r"sign\s+up\s+(?:for|now|today|here|free)", r"create\s+(?:an?\s+)?account", r"(?:start|begin)\s+(?:your\s+)?free\s+trial", r"try\s+(?:it\s+)?free",
    r"get\s+(?:started|a\s+demo)", r"book\s+(?:a\s+)?demo", r"request\s+(?:a\s+)?demo", r"schedule\s+(?:a\s+)?demo", r"no\s+credit\s+card\s+required",
    r"limited\s+time\s+offer", r"(?:\d+)\s*%\s*off", r"money\s*-?\s*back\s+guarantee", r"cancel\s+(?:any\s*time|at\s+any\s+time)",
    r"subscribe\s+to\s+(?:our|the)\s+newsletter", r"join\s+(?:\d+[\+k]?\s+)?(?:companies|teams|users|customers)",
    r"trusted\s+by\s+(?:\d+[\+k]?\s+)?(?:companies|teams|businesses)",
]
# What cleaning deletes, besides menus and clusters of short lines.
FOOTER = r"(?:©|copyright|\bAll\s+Rights\s+Reserved\b|Privacy\s+Policy|Terms\s+of\s+(?:Service|Use)|Cookie\s+(?:Policy|Settings)|Sitemap|Unsubscribe).*$"
SOCIAL = r"(?:Follow\s+us|Share\s+(?:on|this)|Tweet|Pin\s+it|Facebook|Twitter|LinkedIn|Instagram|YouTube)\s*[|/•·\s]*(?:Facebook|Twitter|LinkedIn|Instagram|YouTube)"
SKIP_LINK = r"^Skip\s+to\s+(?:content|main|navigation)\s*$"
COOKIES = r"(?:We\s+use\s+cookies|This\s+(?:site|website)\s+uses\s+cookies|Accept\s+(?:all\s+)?cookies|Cookie\s+preferences).*?(?:\.|$)"
MENU = r"^(?:[A-Z][a-z]+\s*[|/•·]\s*){3,}[A-Z][a-z]+\s*$"
PIPE_MENU = r"^(?:[A-Za-z][A-Za-z ]{0,20}\s*[|/•·]\s*){2,}[A-Za-z][A-Za-z ]{0,20}\s*$"
BREADCRUMB = r"^(?:[A-Za-z ]+\s*>\s*){2,}[A-Za-z ]+\s*$"
SHORT_LINES = r"(?:^.{1,20}\n){4,}"
ABBREVIATIONS = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Inc", "Ltd", "Corp", "etc", "vs"]
# Patterns of personal data.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONES = [r"\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}", r"\+\d{1,3}[-.\s]?\d{1,4}[-.\s]?\d{3,4}[-.\s]?\d{3,4}"]
SSN = r"\b\d{3}[-\s]?\d{2}[-\s]?\d{4}\b"
STREET = r"\b\d{1,5}\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s+(?:Street|St|Avenue|Ave|Boulevard|Blvd|Drive|Dr|Road|Rd|Lane|Ln|Court|Ct|Place|Pl|Way|Circle|Cir)\b"
PO_BOX = r"\bP\.?O\.?\s*Box\s+\d+\b"
CITY_ZIP = r"\b[A-Z][a-z]+,?\s+[A-Z]{2}\s+\d{5}(?:-\d{4})?\b"
CARD = r"\b(?:\d{4}[-\s]?){3}\d{4}\b"

# Class names and header words of review pages, header words of case studies.
REVIEW_CLASS = "review|alternative|considered|competitor|switching|reason"
REVIEW_HEADERS = ["alternative", "consider", "switched", "replaced", "reason", "previous", "competitor", "instead"]
CASE_HEADERS = ["challenge", "solution", "result", "project", "background", "approach", "outcome", "summary", "overview"]
CASE_STOPS = ["challenge", "solution", "result", "project"]
MAIN_CLASS = "post|article|content|body|text"

#: Terms that do occur in the supplied corpus, for queries at volume.
CORPUS_WEIGHTED = {"the": 2, "that": 3, "and": 1, "le": 2, "de": 1, "sch": 2, "para": 3, "of the": 4, "for": 1}
