"""Rule vocabularies.

FIXED VALUES: every list, pattern and constant in this module has to hold exactly these values
for results to be right, so they are written out plainly and in their natural (first match wins)
order. Patterns are plain regular expressions, matched case-insensitively unless the name ends in
``_CS``.  ``functions.rules`` turns them into Column expressions; nothing here runs.
"""

# --- sources ---------------------------------------------------------------------------------

SOURCES = [
    # name, category, paywalled, status, region of a national section feed, feed id
    ("BBC News (World)", "WORLD", False, "verified", None, None),
    ("NPR (World)", "WORLD", False, "verified", None, None),
    ("The Guardian (World)", "WORLD", False, "known", None, None),
    ("The Verge", "TECH", False, "known", None, None),
    ("Al Jazeera", "WORLD", False, "reachable", None, None),
    ("CBS News (U.S.)", "WORLD", False, "verified", "united_states", "cbs-us"),
    ("The Verge (Mobile)", "TECH", False, "verified", None, "verge-mobile"),
    ("The Verge (Tech)", "TECH", False, "verified", None, "verge-tech"),
    ("BBC News (Technology)", "TECH", False, "verified", None, "bbc-technology"),
    ("BBC News (Science & Environment)", "SCIENCE", False, "verified", None, "bbc-science"),
    ("BBC News (Health)", "HEALTH", False, "verified", None, "bbc-health"),
    ("The Guardian (Technology)", "TECH", False, "verified", None, "guardian-technology"),
    ("The Guardian (Science)", "SCIENCE", False, "verified", None, "guardian-science"),
    ("The Guardian (Culture)", "CULTURE", False, "verified", None, "guardian-culture"),
    ("NHK World (Japan)", "JAPAN", False, "flagged", None, None),
    ("Financial Times", "ECONOMY", True, "flagged", None, None),
]
STATUS_RELIABILITY = {"verified": "high", "known": "high", "reachable": "medium", "flagged": "low"}
RELIABLE_OUTLETS = ["bbc", "npr", "guardian", "financial times", "the verge", "al jazeera",
                    "cbs news"]
PUBLISHER_FAMILIES = {
    "bbc news": "bbc", "bbc": "bbc", "the guardian": "guardian", "guardian": "guardian",
    "financial times": "ft", "the verge": "verge", "npr": "npr", "al jazeera": "al-jazeera",
    "cbs news": "cbs",
}
UK_FAMILIES = ["bbc", "guardian", "ft"]

# --- urls and titles -------------------------------------------------------------------------

TRACKING_PREFIXES = ["utm_", "at_medium", "at_campaign", "at_", "ito", "cmpid", "ns_"]
INGEST_VIDEO_PATH = r"/(videos?|watch|av/)"
RANK_VIDEO_PATH = r"/(videos?|watch|av)/"
LIVE_TITLE = r"\b(live|as it happened|live blog|liveblog)\b"
LIVE_PATH = r"/live(/|-|$)"
TITLE_STOPWORDS = ("a an the of to in on for and or with from at by as is are was were this that "
                   "after over into out new his her their its it he she they we you").split()
KEYWORD_STOPWORDS = (
    "the a an and or but of to in on for with from at by as is are was were be been that this it "
    "its his her their they we you has have had will would could said after over into out new news "
    "world daily times post media online about").split()
SNIPPET_CHARS = 400
MIN_SNIPPET = 140
JACCARD_NUM, JACCARD_DEN = 3, 10           # title similarity threshold 0.30, as a fraction

# --- editorial kinds (title only) ------------------------------------------------------------

HIGH_IMPACT = (
    r"\b(antitrust|monopoly|white house|executive order|national security|export controls?|"
    r"sanction\w*|regulat\w*|oversight|supreme court|federal (probe|investigation|lawsuit|trade)|"
    r"data center|semiconductor|chip (ban|export|act|war)|"
    r"anthropic|openai|deepmind|\bai (policy|regulation|safety|act|bill|rules?|oversight|deal|"
    r"partnership|infrastructure)\b|"
    r"government (contract|deal|partnership|funding)|cloud (deal|contract|partnership)|"
    r"acquisition|merger|\bbillion\b)\b")
ARTS_REVIEW = (
    r"\b(album review|music review|ep review|track review|single review|song review|"
    r"film review|movie review|tv review|television review|series review|game review|"
    r"book review|art review|gallery review|exhibition review|restaurant review|concert review|"
    r"celebrity profile|\brecaps?\b|best songs|new album|new single|debut album|"
    r"track[- ]by[- ]track)\b")
DEAL = (
    r"(\$\s?\d[\d,]*\s*off\b|\b\d+%\s*off\b|\bon sale\b|\bon clearance\b|\bsave \$\d|\bcoupon\b|"
    r"\bprime day\b|\bblack friday\b|\bcyber monday\b|\blowest price\b|\bbest price\b|"
    r"\bprice (drop|cut)\b|\bdrops? to \$|\bunder \$\d|\bbuying guide\b|\bgift guide\b|"
    r"\bdiscounted\b|\bdeal of the (day|week)\b)")
PRODUCT = (
    r"(\breview:|\bhands[- ]on\b|\bunboxing\b|buying guide|gift guide|"
    r"\b\d+ best\b|\bbest \w+ (of|for|to buy|under)\b|our favorite|"
    r"\bdeal[s]?:|\bon sale\b|\bdiscount\b|prime day|black friday|cyber monday|"
    r"universal remote|\bearbuds?\b|\bheadphones?\b|smartwatch|\bgadget\b|\bgizmo\b)")
PODCAST = (r"\b(podcast|this week'?s episode|on the latest episode|episode \d+|"
           r"listen to (this|the) episode|our (weekly )?show)\b")
REVIEW = r"\breview:\s|\bhands[- ]on\b|\bunboxing\b"
CIVIC_OVERRIDE = (
    r"\b(backlash|protest\w*|boycott|controvers\w*|government|president|white house|\btrump\b|"
    r"\bbiden\b|election|politic\w*|policy|policies|police|\blaw\b|laws|lawsuit|legislation|"
    r"regulat\w*|antitrust|court|ruling|diplomat\w*|embassy|military|defen[cs]e|security|"
    r"sanction\w*|labor|labour|union|strike|layoffs?|\bai\b|artificial intelligence|platform|"
    r"moderation|copyright|business|market\w*|econom\w*|\bsafety\b|privacy|\bdata\b|deepfake)\b")
ENTERTAINMENT = (
    r"\b(x-men|masters of the universe|star wars|marvel|dc (comics|universe)|"
    r"trailer|season (finale|premiere)|box office|spoilers?|"
    r"netflix|disney\+?|hbo max|prime video|anime|comic[- ]con|"
    r"cinematic universe|reboot|spin[- ]?off|fan(dom| service)|"
    r"\bmovie\b|\btv show\b|\bsitcom\b|streaming series|"
    r"celebrity|red carpet|grammys?|oscars?|golden globes?|met gala)\b")
NOSTALGIA = (r"\b(nostalgia|throwback|remember when|growing up with|an ode to|"
             r"in praise of|the magic of|why i still love|a love letter to)\b")
ESSAY = (
    r"\bi (made|built|tried|spent|created|wrote|learned|quit|turned|gave up|switched|reviewed)\b|"
    r"\bhow i\b|\bwhy i\b|\bmy (year|life|journey|story|experience|app|kid|dog|cat|yard|garden|"
    r"house|apartment|family|routine|setup|desk)\b")
# First match wins; '' keeps the story.
EDITORIAL_KINDS = [
    (HIGH_IMPACT, ""),
    (ARTS_REVIEW, "arts/entertainment review"),
    (DEAL, "product/deal"),
    (PRODUCT, "product/deal"),
    (PODCAST, "podcast"),
    (REVIEW, "review/buying guide"),
    (CIVIC_OVERRIDE, ""),
    (ENTERTAINMENT, "entertainment/franchise"),
    (NOSTALGIA, "nostalgia essay"),
    (ESSAY, "personal essay"),
]
IMPORTANCE = (
    r"\b(government|parliament|congress|senate|election|vote|court|ruling|lawsuit|sanction\w*|"
    r"treaty|ceasefire|war|peace|diplomacy|summit|military|nuclear|economy|inflation|tariff|"
    r"climate|emissions|environment|wildfire|flood|drought|outbreak|disease|health|pandemic|"
    r"president|minister|policy|regulat\w*|central bank|interest rate|geopolit\w*|"
    r"infrastructure|energy|grid|labor|labour|layoffs|unemployment|wages|strike|gdp|recession|"
    r"trade|supply chain|semiconductor|data breach|cyberattack|surveillance|privacy|"
    r"supreme court|indict\w*|charged|aid|famine|refugee|humanitarian)\b")

# --- scoring ---------------------------------------------------------------------------------

LEAD_WEIGHT = {"WORLD": 4, "ECONOMY": 3, "BUSINESS": 3, "FINANCE": 3, "TECH": 2, "AI": 2,
               "JAPAN": 2, "SCIENCE": 1}
CATEGORY_CAP = 2
WORLD_CAP = 2
DOMINANT_CLUSTER_MIN = 4
LAUNCH_BOOST = 3.5
DISCOVERY_BOOST = 1.5
EARNINGS_PENALTY = -1.5
SAME_COUNTRY_PENALTY = -3.0
CONFLICT_TONE_PENALTY = -4.0
HISTORY_PENALTIES = [-2.5, -3.5, -4.5]
HISTORY_EDITIONS = 3
CONFLICT_TONES = ["negative_conflict", "negative_crisis"]
DISCOVERY_MIN_BASE = 4.0
EXACT_COOLDOWN_EDITIONS = 7
PRODUCT_COOLDOWN_EDITIONS = 3
IMAGE_COOLDOWN_EDITIONS = 90

# --- topic fingerprint -----------------------------------------------------------------------

FINGERPRINT = [
    (r"\b(u\.?\s?s\.?\s?a?\.?|united states|america|american|washington|white house|"
     r"trump administration|the administration|president trump|\btrump\b|\bbiden\b|"
     r"pentagon|congress)\b", "usa"),
    (r"\b(iran|iranian|tehran)\b", "iran"),
    (r"\b(israel|israeli|tel aviv|netanyahu)\b", "israel"),
    (r"\b(pakistan|pakistani|islamabad)\b", "pakistan"),
    (r"\b(china|chinese|beijing|xi jinping)\b", "china"),
    (r"\b(russia|russian|moscow|kremlin|putin)\b", "russia"),
    (r"\b(ukraine|ukrainian|kyiv|kiev|zelensky)\b", "ukraine"),
    (r"\b(gaza|hamas|palestin\w+)\b", "gaza"),
    (r"\b(european union|\beu\b|brussels)\b", "eu"),
    (r"\b(amazon|\baws\b)\b", "amazon"),
    (r"\b(anthropic|claude)\b", "anthropic"),
    (r"\b(openai|chatgpt|sam altman)\b", "openai"),
    (r"\b(google|alphabet|deepmind|gemini)\b", "google"),
    (r"\b(microsoft|azure)\b", "microsoft"),
    (r"\b(meta|facebook|instagram)\b", "meta"),
    (r"\b(apple|iphone)\b", "apple"),
    (r"\b(nvidia)\b", "nvidia"),
    (r"\b(peace|ceasefire|truce|talks?|negotiat\w+|\bdeal\b|agreement|accord|diplomacy|"
     r"summit)\b", "peace_talks"),
    (r"\b(tariff\w*|trade war|trade deal|import\w*|export\w*|supply chain)\b", "trade"),
    (r"\b(antitrust|monopoly|competition probe)\b", "antitrust"),
    (r"\b(\bai\b|a\.i\.|artificial intelligence)\b", "ai"),
    (r"\b(climate|emissions|warming|carbon|wildfire|flood\w*|drought)\b", "climate"),
    (r"\b(election|\bvote\b|ballot|primary|campaign)\b", "election"),
    (r"\b(\bwar\b|military|missile|airstrike|troops|nuclear)\b", "military"),
    (r"\b(inflation|interest rate|recession|\bgdp\b|markets?|stocks?|\bbond\b)\b", "markets"),
]
FINGERPRINT_ENTITIES = ["usa", "iran", "israel", "pakistan", "china", "russia", "ukraine", "gaza",
                        "eu", "amazon", "anthropic", "openai", "google", "microsoft", "meta",
                        "apple", "nvidia"]
FINGERPRINT_THEMES = ["peace_talks", "trade", "antitrust", "ai", "climate", "election",
                      "military", "markets"]

# --- story metadata --------------------------------------------------------------------------

COUNTRIES = [
    ("North America", "United States", r"\b(u\.?s\.?a?\.?|united states|america\b|american\b|washington|white house|pentagon|congress)\b"),
    ("North America", "Canada", r"\b(canada|canadian|ottawa|toronto)\b"),
    ("North America", "Mexico", r"\b(mexico|mexican|mexico city)\b"),
    ("Latin America", "Brazil", r"\b(brazil|brazilian|brasilia|sao paulo)\b"),
    ("Latin America", "Argentina", r"\b(argentina|argentine|buenos aires)\b"),
    ("Latin America", "Colombia", r"\b(colombia|colombian|bogota)\b"),
    ("Latin America", "Venezuela", r"\b(venezuela|venezuelan|caracas)\b"),
    ("Latin America", "Chile", r"\b(chile|chilean|santiago)\b"),
    ("Europe", "United Kingdom", r"\b(\buk\b|britain|british|england|scotland|wales|london|downing street)\b"),
    ("Europe", "France", r"\b(france|french|paris)\b"),
    ("Europe", "Germany", r"\b(germany|german|berlin)\b"),
    ("Europe", "Italy", r"\b(italy|italian|rome)\b"),
    ("Europe", "Spain", r"\b(spain|spanish|madrid)\b"),
    ("Europe", "Ukraine", r"\b(ukraine|ukrainian|kyiv|kiev|zelensky)\b"),
    ("Europe", "Russia", r"\b(russia|russian|moscow|kremlin|putin)\b"),
    ("Europe", "Poland", r"\b(poland|polish|warsaw)\b"),
    ("Middle East", "Israel", r"\b(israel|israeli|tel aviv|jerusalem|netanyahu)\b"),
    ("Middle East", "Palestinian territories", r"\b(gaza|hamas|palestin\w+|west bank)\b"),
    ("Middle East", "Iran", r"\b(iran|iranian|tehran)\b"),
    ("Middle East", "Saudi Arabia", r"\b(saudi|riyadh)\b"),
    ("Middle East", "Syria", r"\b(syria|syrian|damascus)\b"),
    ("Middle East", "Lebanon", r"\b(lebanon|lebanese|beirut|hezbollah)\b"),
    ("Middle East", "Yemen", r"\b(yemen|yemeni|houthi)\b"),
    ("Middle East", "Iraq", r"\b(iraq|iraqi|baghdad)\b"),
    ("Middle East", "Turkey", r"\b(turkey|turkish|ankara|istanbul|erdogan)\b"),
    ("Africa", "Nigeria", r"\b(nigeria|nigerian|lagos|abuja)\b"),
    ("Africa", "South Africa", r"\b(south africa|johannesburg|pretoria)\b"),
    ("Africa", "Egypt", r"\b(egypt|egyptian|cairo)\b"),
    ("Africa", "Kenya", r"\b(kenya|kenyan|nairobi)\b"),
    ("Africa", "Ethiopia", r"\b(ethiopia|ethiopian|addis ababa)\b"),
    ("Africa", "Sudan", r"\b(sudan|sudanese|khartoum)\b"),
    ("Africa", "DR Congo", r"\b(congo|congolese|kinshasa)\b"),
    ("Asia-Pacific", "China", r"\b(china|chinese|beijing|shanghai|xi jinping)\b"),
    ("Asia-Pacific", "Japan", r"\b(japan|japanese|tokyo)\b"),
    ("Asia-Pacific", "India", r"\b(india|indian|delhi|mumbai|modi)\b"),
    ("Asia-Pacific", "Pakistan", r"\b(pakistan|pakistani|islamabad|karachi)\b"),
    ("Asia-Pacific", "South Korea", r"\b(south korea|korean\b|seoul)\b"),
    ("Asia-Pacific", "North Korea", r"\b(north korea|pyongyang)\b"),
    ("Asia-Pacific", "Australia", r"\b(australia|australian|canberra|sydney)\b"),
    ("Asia-Pacific", "Indonesia", r"\b(indonesia|indonesian|jakarta)\b"),
    ("Asia-Pacific", "Philippines", r"\b(philippine\w*|filipino|manila)\b"),
    ("Asia-Pacific", "Taiwan", r"\b(taiwan|taiwanese|taipei)\b"),
]
EVENT_FAMILIES = [
    ("conflict", r"\b(\bwar\b|airstrike\w*|missile\w*|shell\w+|invasion|offensiv\w+|troops|"
                 r"ceasefire|hostage\w*|militant\w*|insurgen\w+|drone strike\w*|artillery|frontline)\b"),
    ("protest", r"\b(protest\w*|demonstrat\w+|riot\w*|unrest|marche[sd]|rally|rallies|strike action|walkout)\b"),
    ("election", r"\b(election\w*|ballot\w*|\bvote\b|voters?|polls? open|primary|runoff|referendum)\b"),
    ("political_scandal", r"\b(scandal|impeach\w+|corruption|bribery|indict\w+|resign\w+ over|cover-?up)\b"),
    ("disaster", r"\b(earthquake|hurricane|typhoon|cyclone|wildfire\w*|flood\w*|landslide|tsunami|"
                 r"eruption|heatwave|storm\w* kill|death toll|derail\w*|plane crash|collapse\w* kill)\b"),
    ("earnings", r"\b(earnings|quarterly (results|profit|revenue)|q[1-4] (results|profit|revenue)|"
                 r"profit (rise|fall|jump|drop)\w*|revenue (beat|miss)\w*|forecast\w* (cut|raise)\w*)\b"),
    ("markets", r"\b(stocks?\b|shares?\b|markets? (rally|slide|fall|rise)|inflation|interest rates?|"
                r"central bank|\bfed\b|bond yields?|\bgdp\b|recession)\b"),
    ("science_discovery", r"\b(discover\w+|breakthrough|telescope|astronomer\w*|fossil\w*|"
                          r"spacecraft|\bnasa\b|space mission|quantum|physicist\w*|new species|researchers? (found|find))\b"),
    ("health_breakthrough", r"\b(vaccine\w*|clinical trial\w*|cancer treatment|new drug|therapy shows|"
                            r"cure\w*|transplant\w*|alzheimer\w*|obesity drug\w*)\b"),
    ("policy", r"\b(\bbill\b|legislation|regulat\w+|\bban\b|sanction\w*|tariff\w*|policy|lawmaker\w*|"
               r"court rul\w+|supreme court|minister\w* announc\w+|government plan\w*)\b"),
    ("culture", r"\b(film\b|movie\w*|box office|album\w*|concert\w*|festival\w*|museum\w*|exhibition\w*|"
                r"\bnovel\b|booker|oscars?|grammy\w*|premiere\w*|theatre|theater\b)\b"),
]
LAUNCH_VERB = r"\b(announc\w+|launch\w+|unveil\w+|introduc\w+|releas\w+|debut\w+)\b"
CONSUMER_PRODUCT = (
    r"\b(smart ?phones?|phones?|handsets?|foldables?|tablets?|laptops?|notebooks?|"
    r"consoles?|headsets?|smart ?watch\w*|smart ?glasses|earbuds?|e-?readers?|cameras?|"
    r"televisions?|\btvs?\b|operating system|android \d+|ios \d+|windows \d+|macos \w+|"
    r"browsers?|apps?\b|platforms?|chatbots?|assistants?)\b")
LAUNCH_EXCLUDE = (
    r"\b(rumou?r\w*|leak\w*|reportedly|expected to|may\b|could\b|might\b|tipped to|"
    r"deals?\b|discount\w*|% off|price (cut|drop)|flash sale|clearance|best \w+ to buy|buying guide|"
    r"benchmark\w*|geekbench|antutu|earnings|revenue|profit|stocks?\b|shares?\b|"
    r"affiliate|preview\b|hands-?on)\b")
ACCESSORY = (
    r"\b(cases?\b|covers?\b|cables?\b|chargers?\b|adapters?\b|dongles?\b|straps?\b|"
    r"bands?\b|stands?\b|mounts?\b|styl(us|i)\b|screen protectors?|keychains?|skins?\b)\b")
CRISIS = (r"\b(kill\w*|death\w*|dead\b|dies?\b|died\b|casualt\w*|famine|outbreak|"
          r"epidemic|crisis|collaps\w*|missing\b|injur\w*|victims?)\b")
FORWARD = (r"\b(plans? to|will (open|build|invest|expand|create)|to invest|pledg\w+|"
           r"unveil\w+ plan|aims? to|set to (open|build|expand))\b")
LAUNCH_FRESH_HOURS = 72

# --- story identity --------------------------------------------------------------------------

BRANDS = [
    (r"\bsamsung\b", "samsung"),
    (r"\b(apple|iphone|ipad|macbook|airpods|apple watch|vision pro)\b", "apple"),
    (r"\b(google|pixel|android)\b", "google"),
    (r"\bmicrosoft|xbox|surface\b", "microsoft"),
    (r"\b(meta|quest|oculus)\b", "meta"),
    (r"\b(sony|playstation|\bps5\b)\b", "sony"),
    (r"\bnintendo|switch 2\b", "nintendo"),
    (r"\b(openai|chatgpt)\b", "openai"),
    (r"\banthropic|claude\b", "anthropic"),
    (r"\bnothing phone\b", "nothing"),
    (r"\bmotorola|moto g\b", "motorola"),
    (r"\bxiaomi|redmi\b", "xiaomi"),
    (r"\boneplus\b", "oneplus"),
    (r"\btesla\b", "tesla"),
]
PRODUCT_FAMILIES = [
    (r"\b(galaxy\s+)?z\s*fold\b", "galaxy z fold"),
    (r"\b(galaxy\s+)?z\s*flip\b", "galaxy z flip"),
    (r"\bgalaxy\s+s\d+\b", "galaxy s"),
    (r"\bgalaxy\s+watch\b", "galaxy watch"),
    (r"\bgalaxy\s+buds\b", "galaxy buds"),
    (r"\bgalaxy\b", "galaxy"),
    (r"\biphone\b", "iphone"),
    (r"\bapple\s+watch\b", "apple watch"),
    (r"\bairpods\b", "airpods"),
    (r"\bvision\s+pro\b", "vision pro"),
    (r"\bmac(book)?\b", "mac"),
    (r"\bipad\b", "ipad"),
    (r"\bpixel\s+watch\b", "pixel watch"),
    (r"\bpixel\b", "pixel"),
    (r"\bplaystation|\bps5\b", "playstation"),
    (r"\bxbox\b", "xbox"),
    (r"\bswitch\s*2\b", "switch"),
    (r"\bquest\s*\d?\b", "quest"),
]
LAUNCH_EVENTS = [
    (r"\bunpacked\b", "unpacked"),
    (r"\bwwdc\b", "wwdc"),
    (r"\bmade by google\b", "made by google"),
    (r"\bgalaxy ai\b", "galaxy ai"),
    (r"\b(ces|mwc|ifa)\b", "trade show"),
    (r"\bkeynote\b", "keynote"),
]
ROUNDUP_TITLE = (r"\b(everything|all the news|announcements?|roundup|round-up|biggest|recap|"
                 r"what was announced|highlights|liveblog|as it happened|how to watch)\b")
PRODUCT_EVENT_FAMILIES = ["consumer_launch", "other"]

# --- topics and regions ----------------------------------------------------------------------

SUPPORTED_REGIONS = ["japan", "united_states", "world"]
SUPPORTED_TOPICS = ["ai", "business", "climate", "culture", "health", "science", "tech"]
REGION_ALIASES = {"japan": "japan", "jp": "japan", "jpn": "japan", "us": "united_states",
                  "usa": "united_states", "u_s": "united_states",
                  "united_states": "united_states", "world": "world"}
REGION_PRIORITY = ["united_states", "japan", "world"]
US_MIN_QUOTA = 3
CATEGORY_TOPICS = {
    "AI": ["ai", "tech"], "BUSINESS": ["business"], "CLIMATE": ["climate"],
    "CULTURE": ["culture"], "ECONOMY": ["business"], "FINANCE": ["business"],
    "HEALTH": ["health"], "SCIENCE": ["science"], "TECH": ["tech"],
}
TEXT_TOPICS = [
    (r"\b(ai|artificial intelligence|machine learning)\b", "ai"),
    (r"\b(business|economy|economic|finance|market|company)\b", "business"),
    (r"\b(climate|emissions?|warming|wildfires?|drought)\b", "climate"),
    (r"\b(culture|museum|art|heritage|literature)\b", "culture"),
    (r"\b(health|hospital|medical|disease|vaccine)\b", "health"),
    (r"\b(science|research|scientists?|laborator(?:y|ies))\b", "science"),
    (r"\b(tech|technology|software|chip|semiconductor|robot)\b", "tech"),
]
REGION_COMPANIES = r"\b(sony|toyota|nintendo|softbank|honda)\b"
REGION_RULES = {
    "japan": [
        ("japan", r"\bjapan\b"),
        ("japanese", r"\bjapanese\b"),
        ("tokyo", r"\btokyo\b"),
        ("osaka", r"\bosaka\b"),
        ("kyoto", r"\bkyoto\b"),
        ("okinawa", r"\bokinawa\b"),
        ("hokkaido", r"\bhokkaido\b"),
        ("fukushima", r"\bfukushima\b"),
        ("yen", r"\byen\b"),
        ("bank-of-japan", r"\bbank of japan\b|\bboj\b"),
        ("nikkei", r"\bnikkei\b"),
        ("japanese-government", r"\bjapanese government\b"),
    ],
    "united_states": [
        ("united-states", r"\bunited states\b|\bu\.s\.\b|\busa\b"),
        ("washington", r"\bwashington(?:,\s*d\.?c\.?)?\b"),
        ("white-house", r"\bwhite house\b"),
        ("congress", r"\bcongress\b"),
        ("capitol-hill", r"\bcapitol hill\b"),
        ("pentagon", r"\bthe pentagon\b"),
        ("fbi", r"\bfbi\b"),
        ("us-state", r"\b(california|texas|florida|new york|pennsylvania|illinois|ohio|"
                     r"michigan|arizona|colorado|massachusetts|virginia|oregon|nevada|"
                     r"alabama|louisiana|kentucky|oklahoma|minnesota|wisconsin)\b"),
    ],
    "world": [
        ("united-nations", r"\bunited nations\b|\bu\.n\.\b"),
        ("multinational", r"\bmultinational\b|\binternational coalition\b"),
        ("g7", r"\bg7\b|\bgroup of seven\b"),
        ("global-treaty", r"\bglobal (?:treaty|agreement|summit)\b"),
    ],
}
CATEGORIES = ["AI", "BUSINESS", "CLIMATE", "CULTURE", "ECONOMY", "FINANCE", "HEALTH", "JAPAN",
              "SCIENCE", "TECH", "WORLD", "OTHER"]
RELIABILITIES = ["high", "medium", "low", "unknown"]
STRENGTHS = ["primary", "incidental", "none"]

# --- custom mix ------------------------------------------------------------------------------

SELECTOR_VERSION = 3
POOL_SELECTOR_VERSION = 1
POOL_SCHEMA_VERSION = 1
GENERATOR_VERSION = 1
EDITORIAL_ARTIFACT = "editorial-mix-pool"
STORY_COUNT = 5
TOPIC_BONUS = 10.0
NEW_CATEGORY_BONUS = 0.6
NEW_SOURCE_BONUS = 0.4
ENRICH_TARGET = 20
ENRICH_MINIMUM = 15
ENRICH_FLOORS = [("united_states", 6), ("japan", 4), ("world", 4)]
MAX_POOL_BYTES = 2 * 1024 * 1024
POOL_RETENTION_DAYS = 9
POOL_MAX_AGE_DAYS = 8
POOL_FUTURE_SKEW_MINUTES = 10
MAX_VALIDATIONS = 5
RAW_FORBIDDEN_KEYS = ["rawbody", "raw_body", "fulltext", "full_text", "audiodata", "audio_data",
                      "authtoken", "auth_token"]
ENRICHED_FORBIDDEN_KEYS = ["prompt", "prompts", "rawbody", "raw_body", "articlebody",
                           "article_body", "fulltext", "full_text", "sourcetext", "source_text",
                           "providerresponse", "provider_response", "apikey", "api_key"]
EDITION_LEVEL_FIELDS = ["number", "importance", "lead", "focus", "version"]
POOL_ERROR_CATEGORIES = [
    (r"candidate id collision", "duplicate_candidate_id"),
    (r"invalid (?:published_at|publishedAt|generatedAt|now|reference_at)\b", "invalid_timestamp"),
    (r"invalid date\b|date must be", "invalid_timestamp"),
    (r"(?:source )?candidates must be a list", "schema_invalid"),
    (r"empty required copy", "empty_required_copy"),
    (r"duplicate candidate id", "duplicate_candidate_id"),
    (r"duplicate canonical URL", "duplicate_canonical_url"),
    (r"\bmissing\b", "missing_required_field"),
    (r"unexpected (?:key|field)", "unexpected_field"),
    (r"poolIdentity|identity", "identity_mismatch"),
    (r"local path|file://|local_path", "local_path_leakage"),
    (r"quality\b", "invalid_quality_shape"),
    (r"evidence|eligib", "invalid_evidence"),
    (r"category|topics?|region|taxonom", "invalid_taxonomy"),
    (r"baseScore|sourceRisk|clusterS|numeric|precision", "invalid_numeric_field"),
    (r"invalid URL|candidateCount|schemaVersion|selectorVersion", "schema_invalid"),
]

# --- prose rules -----------------------------------------------------------------------------

BOILERPLATE = [
    "skip to content", "skip to main", "accessibility", "hide caption", "toggle caption",
    "image caption", "media caption", "getty images", "read more", "sign up", "sign in",
    "log in", "subscribe", "newsletter", "follow us", "share this", "share on",
    "advertisement", "cookie", "privacy policy", "terms of", "all rights reserved",
    "copyright", "back to top", "more on this story", "related topics", "watch:",
    "listen:", "play video", "click here", "download the app", "supported browser",
    "enable javascript", "view comments", "most read", "in pictures", "tap here",
    "bbc is not responsible", "external sites", "this video can not be played",
    "logo", "homepage", "weekend editor", "vox media", "comments", "more from the verge",
]
BYLINE = (r"^(by|source|photo|photograph|credit|reporting by|updated|published|"
          r"editor's note|getty|reuters|associated press)\b")
STAKES = (r"\b(could|may|might|risk|warn(?:s|ed)?|threat|expected|means?|impact|"
          r"because|lead(?:s)? to|consequence|raising|fears?|concerns?|"
          r"significant|major|first time|unprecedented|escalat\w*|ceasefire|"
          r"agreement|deal|sanction\w*)\b")
AFFILIATE = (r"(may earn (an? )?commission|if you (buy|purchase) something|"
             r"vox media|affiliate link|our ethics (policy|statement))")
AUTHOR_BIO = (r"\bis\s+(a|an|the)\b[^.]{0,70}\b(editor|reporter|writer|journalist|"
              r"correspondent|contributor|columnist|anchor|host)\b")
CREDIT_END = (r"(getty images|/\s*ap\b|/\s*afp\b|/\s*npr\b|/\s*getty|reuters|"
              r"associated press|\bafp\b|bloomberg|pool|handout|via getty)"
              "\\s*[.\\)\"'”]*\\s*$")
CAPTION_SCENE = (r"^(a|an|the)\s+[\w'’]+(?:\s+[\w'’,]+){0,6}?\s+"
                 r"(holds?|carries|carry|waves?|stands?|sits?|walks?|marche?s?|"
                 r"gathers?|wears?|raises?|displays?|protests?|cheers?|poses?|"
                 r"attends?|hugs?|embraces?|celebrat\w+|reacts?)\b")
CAPTION_LEAD = (r"^\s*(file ?photo|file ?-|pictured|photo|photograph|image|illustration|video|"
                r"graphic|caption)\b\s*[:\-—]")
CAPTION_CUE = (
    r"\b(pictured (above|below|here|right|left)|seen (here|above|below)|from left( to right)?|"
    r"left to right|is seen|are seen|looks on|gestures|holds up|poses for|walk(s)? past|"
    r"during a (rally|protest|ceremony|match|game|parade|news conference|press conference))\b")
CAPTION_VERB = (
    r"^\s*[\w'’.,\- ]{0,55}?\b(holds?|carries|carry|waves?|stands?|sits?|walks?|marche?s?|gathers?|"
    r"wears?|raises?|displays?|protests?|cheers?|poses?|attends?|hugs?|embraces?|celebrat\w+|"
    r"reacts?|gestures?|looks on)\b")
CAPTION_MEDIA = (r"\b(image|photo|photograph|picture|video|footage)\s+"
                 r"(made|taken|provided|obtained|released|distributed|courtesy)\b")
ELLIPSIS_END = r"(\.\.\.|…)\s*$"
METADATA_BIO = (
    r"(\bwork has (also )?appeared\b|"
    r"\bstarted out at\b|"
    r"\b(beat reporter|staff (writer|reporter)|senior (writer|reporter|editor)|"
    r"freelance (writer|journalist)|contributing (writer|editor|reporter))\b|"
    r"\b(reporter|writer|editor|journalist|correspondent|columnist|contributor)s?\s+"
    r"for\s+(more than|over|nearly|almost)\b|"
    r"\bcovers\s+[\w\s,'-]{1,40}\s+for\s+[A-Z]|"
    r"\bwrites about\s+[\w\s,'-]{1,40}\s+for\s+[A-Z]|"
    r"\b(is|was)\s+(a|an)\s+[\w\s,'’-]{0,40}?\b"
    r"(reporter|writer|editor|journalist|correspondent|columnist|contributor|critic|blogger|anchor|host)\s+"
    r"(for|at|covering|based|who|with)\b|"
    r"\bfollow (her|him|them|us) on\b|"
    r"\byou can (reach|email|follow) (her|him|them)\b)")
METADATA_CAPTION = (
    r"(\b(photo|image|picture) (by|credit)\b|\bgetty images\b|\bap photo\b|\bvia getty\b|"
    r"\breuters\s*/|/\s*afp\b|\bpool photo\b|"
    r"\barrives (to|for|at)\b|\bspeaks (during|at|to)\b|\bstands? near\b|\bsits? (in|near|beside)\b|"
    r"\bwalks? (past|through|along)\b|\battends? (a|an|the)\b|\bis seen\b|\bare seen\b|\bpictured\b|"
    r"\bduring a (round table|round-table|meeting|summit|session|hearing|signing))\b")
STITCHED_QUOTE = ("[\\w’'][\\s]+[\"“][^\"”]{1,180}[,.\\!?][\"”]\\s+\\w+\\s+"
                  "(said|says|told|added|noted|argued|wrote)\\b")
BIO_JOINED = (r"^\s*(he|she|they)\s+joined\s+[A-Z][\w.&'’-]*(?:\s+[A-Z][\w.&'’-]*){0,4}"
              r"\s+in\s+(19|20)\d\d\b")
BIO_YEARS_AT_CS = "\\byears?\\s+at\\s+[A-Z][\\w.&'’-]+\\s*[.\"'”’]*\\s*$"
ABBREVIATIONS_CS = (r"\b(?:(?:[A-Za-z]\.){2,}|(?:Mr|Mrs|Ms|Dr|Prof|Gen|Sen|Rep|Gov|St|Jr|Sr|vs|"
                    r"No|Inc|Ltd|Co|Corp)\.)")
ABBREVIATION_END_CS = ("\\b(?:Mr|Mrs|Ms|Dr|Prof|Gen|Sen|Rep|Gov|St|vs|No)\\."
                       "[\"')\\]”’]?\\s*$")
CONNECTIVE_OPEN = r"^\s*(And|But|Also|Meanwhile|However)\b[\s,]"
ROUNDUP_LINE = (r"^[^.!?]{0,60}\b(briefing|newsletter|roundup|rundown)\b[^.!?]{0,40}:")
SENTENCE_END_CS = "[.!?][\"')\\]”’]?\\s*$"
COMPOUND_DANGLE_CS = ("\\b(between|among|amongst|amid)\\s+(the\\s+)?[A-Z][\\w.&'’-]*\\.?"
                      "[\"')\\]”’]?\\s*$")
DANGLING_END = [
    "the", "a", "an", "of", "to", "and", "or", "that", "this", "with", "for", "from",
    "as", "but", "said", "its", "his", "her", "their", "than",
    "between", "among", "amongst", "amid", "while", "because", "after", "before",
    "against", "despite", "since", "although", "though", "unless", "whereas",
    "toward", "towards", "without", "within", "whether", "nor"]
BLOCKING_FLAGS = ["needs_review", "source_unavailable", "thin_source", "whyItMatters_needs_human"]
PROSE_GATE_SINCE = "2026-07-11"
FUTURE_DATE_DAYS = 2
FEED_FOCUS = "MIXED"
FEED_VERSION = 1

# --- dialogue rules --------------------------------------------------------------------------

DRIFT_SECONDS = 0.50
JA_CHARS_CS = "[぀-ゟ゠-ヿ一-鿿]"
JA_FORBIDDEN = [
    "についての発表をしました", "についての報告をしました", "による発表によると",
    "することが可能です", "であるということです",
    "速報", "衝撃", "驚愕", "必見", "！！",
    "についてお話しします", "お伝えします", "お届けします", "お届けしました",
    "今日のSignalsでした", "また次回", "ご清聴", "お相手は",
]
JA_MAX_LINE_CHARS = 90
JA_SOLO_MAX_CHARS = 60
JA_QUESTION_CS = "[？?]|か(?:ね|な)?[。」]?\\s*$"
JA_MIN_LISTENER_TURNS = 2
JA_MIN_QUESTIONS = 2
JA_PASTE_MIN = 15
JA_SENTENCE_COPY_RATIO = 0.80
JA_AIZUCHI_MAX = 9
JA_LISTENER_STATEMENT_MAX = 40
JA_REPEAT_ANNOUNCE = "発表されました"
ENGLISH_NUMBERS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6,
    "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12,
    "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17,
    "eighteen": 18, "nineteen": 19, "twenty": 20, "thirty": 30, "forty": 40,
    "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90, "hundred": 100,
    "first": 1, "second": 2, "third": 3, "fourth": 4, "fifth": 5, "sixth": 6,
    "seventh": 7, "eighth": 8, "ninth": 9, "tenth": 10,
}
KANJI_DIGITS = {"〇": 0, "零": 0, "一": 1, "二": 2, "三": 3, "四": 4, "五": 5,
                "六": 6, "七": 7, "八": 8, "九": 9}
KANJI_UNITS = {"十": 10, "百": 100, "千": 1000}

# --- keyed stores ----------------------------------------------------------------------------

QUOTA_PER_IP_MINUTE = 10
QUOTA_PER_SUBJECT_HOUR = 30
QUOTA_PER_TOKEN_MINUTE = 60
CLAIM_TTL_HOURS = 24
STATUS_RETENTION_DAYS = 400
