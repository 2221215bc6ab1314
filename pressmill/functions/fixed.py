"""Lists, patterns and tables that results depend on, in their natural order."""

# --- URL filtering ---------------------------------------------------------------------------

SKIP_COMMON = [
    "/shop", "/store", "/buy", "/product", "/cart", "/purchase", "/guide", "/test", "/review", "/comparison", "/best-",
    "/faq", "/help", "/about", "/contact", "/legal", "/terms", "/privacy", "/sitemap", "/search", "/404", "/error",
    "/login", "/register", "/account", "/profile", "/dashboard",
    "/rss", "/feed", "/xml", "/api/", "/embed/", "/iframe", "/widget/", "/app/", "/mobile/", "/newsletter/", "/podcast",
    "?utm_", "?ref=", "?source=", "?campaign=", "?fbclid=", "?origin=", "?lmd_", "?tracking=", "?affiliate=", "#",
    "/archive", "/category", "/categories", "/tag/", "/tags/", "/author/", "/date/", "/year/", "/month/", "/section/",
    "/social", "/share", "/print", "/pdf", "/download",
]
SKIP_BY_LANGUAGE = {
    "french": [
        "/guides-d-achat/", "/guide-achat/", "/comparatif/", "/boutique/", "/abonnement/", "/subscription/", "/mentions-legales/", "/politique-confidentialite/",
        "/cgu/", "/conditions-utilisation/", "/services/", "/partenaires/", "/publicite/", "/applications-groupe/", "/annonces-legales/",
    ],
    "romanian": [
        "/ghid-", "/ghiduri/", "/test-", "/recenzie-", "/review-", "/anunturi/", "/reclame/", "/publicitate/", "/contact", "/despre-noi", "/despre/",
        "/politica-", "/termeni-", "/conditii/", "/abonament/", "/newsletter/", "/servicii/",
    ],
    "english": [
        "/guides/", "/guide/", "/reviews/", "/deals/", "/offers/", "/shop/", "/store/", "/buy/", "/subscription/", "/about-us/", "/contact-us/",
        "/privacy-policy/", "/terms-of-service/", "/advertise/", "/jobs/",
    ],
}
SUFFIX_LANGUAGE = [(".ro", "romanian"), (".fr", "french"), (".com", "english"), (".org", "english"), (".net", "english"), (".uk", "english"), (".us", "english")]
ARTICLE_ID = [
    r"[-_](\d{6,})[_-]", r"/(\d{6,})\.html", r"/(\d{6,})/", r"/article/(\d+)/", r"/news/(\d+)", r"/story/(\d+)", r"-a(\d+)\.html", r"/(\d+)-[a-z]",
    r"article-(\d+)", r"/stire-(\d+)", r"/articol-(\d+)", r"[-/](\d{7,})$", r"-(\d{6,})$", r"/(\d{6,})$", r"-(\d{5,})$", r"/(\d{5,})$",
]
#: The fetcher knows all but the last two.
FETCHER_ARTICLE_ID = ARTICLE_ID[:14]
CATEGORY_PAGE = [r"^/[a-z-]+/?$", r"^/[a-z-]+\.html?$", r"^/section/[a-z-]+/?$", r"^/category/[a-z-]+/?$", r"^/tag/[a-z-]+/?$"]
SKIP_EXTENSIONS = [".xml", ".rss", ".pdf", ".zip", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".json"]
INVALID_PATHS = ["", "/", "?getmobile=1", "--><!--", "-->", "<!--", "<!", "--"]
SHORT_DOMAINS = {"digi24.ro": "www.digi24.ro", "bzi.ro": "www.bzi.ro", "lemonde.fr": "www.lemonde.fr"}
SLUG_IN_PATH = {"www.lemonde.fr": (r"/([^/]+)_\d+_\d+\.html$", "fr"), "www.bzi.ro": (r"/([^/]+)-\d+$", "ro"), "www.digi24.ro": (r"/([^/]+)-(\d+)$", "ro")}
SLUG_SMALL_WORDS = {
    "fr": ["le", "la", "les", "de", "du", "des", "à", "au", "aux", "et", "ou", "pour", "sur", "avec", "sans", "dans", "par", "un", "une"],
    "ro": ["de", "la", "în", "cu", "pe", "din", "pentru", "prin", "după", "înainte", "fără", "și", "sau", "dar", "iar", "un", "o"],
    "en": ["the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by"],
}

# --- text cleaning ---------------------------------------------------------------------------

PAYWALL = {
    "french": [
        r"Il vous reste \d+[.,]\d*% de cet article à lire.*", r"La suite est réservée aux abonnés.*", r"Article réservé à nos abonnés.*", r"Pour lire la suite.*abonnez-vous.*",
        r"Cet article est réservé aux abonnés.*", r"Le contenu auquel vous tentez d'accéder.*abonné.*", r"\*\*Il vous reste \d+.*à lire\*\*", r"Accès illimité.*à partir de.*€.*",
    ],
    "romanian": [
        r"Restul articolului este rezervat abonațiilor.*", r"Pentru a citi restul articolului.*abonează-te.*", r"Articol disponibil doar pentru abonați.*", r"Conținutul complet.*doar pentru abonați.*",
        r"Acest articol este disponibil doar.*", r"Pentru a accesa conținutul complet.*", r"\*\*Îți mai rămân \d+.*de citit\*\*", r"Abonament de la.*lei.*",
    ],
    "english": [
        r"You have \d+% of this article remaining.*", r"This content is for subscribers only.*", r"Subscribe to continue reading.*", r"To read the full article.*subscribe.*",
        r"Premium content.*subscribers only.*", r"\*\*You have \d+.*remaining\*\*", r"Subscription from.*\$.*month.*",
    ],
}
DROPPED_LINES = {
    "french": [
        r"Lire aussi.*?\|.*?Article réservé.*", r"Lire aussi la tribune.*?\|.*", r"Lire plus tard.*", r"Lire la suite.*", r"Voir aussi.*?\|.*", r"À lire également.*", r"Dans le même dossier.*", r"Sur le même sujet.*",
        r"Partager cet article.*", r"Partager sur Facebook.*", r"Partager sur Twitter.*", r"Suivez.*?sur.*", r"Retrouvez.*?sur.*", r"Rejoignez.*?sur.*",
        r"Recevez.*?newsletter.*", r"S'abonner.*?à partir de.*€.*", r"Abonnez-vous.*", r"Newsletter.*gratuite.*", r"Inscrivez-vous.*newsletter.*", r"Découvrez nos offres.*abonnement.*",
        r"Le Monde.*Tous droits réservés.*", r"Copyright.*Le Monde.*", r"Mentions légales.*", r"Politique de confidentialité.*", r"Conditions générales.*", r"CGU.*CGV.*",
        r"\(.*?Mis à jour.*?\)", r"\(.*?Publié.*?\)", r"\(.*?Modifié.*?\)", r"^Par\s+[A-Z][a-z]+\s+[A-Z][a-z]+.*$", r"Édité par.*", r"Relu par.*",
    ],
    "romanian": [
        r"Citește și:.*", r"Vezi și:.*", r"Citește mai mult.*", r"Continuă citirea.*", r"În același subiect.*", r"Articole similare.*", r"Pe același subiect.*", r"De asemenea:.*",
        r"Distribuie acest articol.*", r"Distribuie pe Facebook.*", r"Distribuie pe Twitter.*", r"Urmărește.*?pe.*", r"Găsește.*?pe.*", r"Alătură-te.*?pe.*",
        r"Primește newsletter.*", r"Abonează-te.*newsletter.*", r"Înscrie-te.*newsletter.*", r"Newsletter.*gratuit.*", r"Află primul.*newsletter.*", r"Descoperă ofertele.*abonament.*",
        r"Toate drepturile rezervate.*", r"Copyright.*", r"Termeni și condiții.*", r"Politica de confidențialitate.*", r"Contact.*redacție.*", r"Despre noi.*",
        r"\(.*?Actualizat.*?\)", r"\(.*?Publicat.*?\)", r"\(.*?Modificat.*?\)", r"^De\s+[A-Z][a-z]+\s+[A-Z][a-z]+.*$", r"Editor:.*", r"Autor:.*",
    ],
    "english": [
        r"Read also:.*", r"See also:.*", r"Read more.*", r"Continue reading.*", r"Related articles.*", r"On the same topic.*", r"You might also like.*",
        r"Share this article.*", r"Share on Facebook.*", r"Share on Twitter.*", r"Follow.*?on.*", r"Find.*?on.*", r"Join.*?on.*",
        r"Get our newsletter.*", r"Subscribe.*newsletter.*", r"Sign up.*newsletter.*", r"Free newsletter.*", r"Be the first.*newsletter.*", r"Discover.*subscription.*",
    ],
}
DROPPED_EVERYWHERE = [
    r"^@[a-zA-Z0-9_]+$", r"(?:^|\s)#[a-zA-Z][a-zA-Z0-9_]*(?:\s|$)", r"bit\.ly/[a-zA-Z0-9]+", r"tinyurl\.com/[a-zA-Z0-9]+",
    r"https?://[^\s]+", r"www\.[^\s]+", r"\[.*?\]\(.*?\)", r"<a\s+[^>]*>.*?</a>",
    r"^\d+[.,]\d*%.*", r".*\d+[.,]\d*%.*remaining.*", r".*\d+[.,]\d*%.*ramaining.*",
    r".*paywall.*", r".*premium.*content.*", r".*subscriber.*only.*", r".*subscription.*required.*",
    r"^[A-Z][a-z]+\s*[|>]\s*[A-Z][a-z]+.*", r"^Home\s*[|>].*", r".*\s*[|>]\s*Article$",
    r"Advertisement", r"Sponsored Content", r"Promoted Post", r"Publicité", r"Reclamă", r"Anunț comercial",
]
LANGUAGE_WORDS = [("romanian", ["și", "cu", "pentru", "este", "sunt", "într-un", "într-o"]), ("french", ["avec", "pour", "dans", "cette", "vous", "nous", "être"])]

#: Broken emphasis joined, empty emphasis dropped, markers spaced, blank space shortened, in this order. Patterns begin with their marker and look behind it for the
#: letter, which is much faster than a letter first; .? lets that be a surrogate pair, \G keeps it from being the last letter of the match before.
MARKDOWN_REPAIRS = [
    (r"\*(?<!\G\*)(?<=.?\w\*)\*[ \t]*\n[ \t]*(\w)", "**$1"), (r"(?=[ \t\n])(?!\G)(?<=.?\w)[ \t]*\n[ \t]*\*\*(\w)", "**$1"), (r"\*(?<!\G\*)(?<=.?\w\*)[ \t]*\n[ \t]*(\w)", "*$1"),
    (r"(?=[ \t\n])(?!\G)(?<=.?\w)[ \t]*\n[ \t]*\*(?!\*)(\w)", "*$1"), (r"`(?<!\G`)(?<=.?\w`)[ \t]*\n[ \t]*(\w)", "`$1"), (r"(?=[ \t\n])(?!\G)(?<=.?\w)[ \t]*\n[ \t]*`(\w)", "`$1"),
    (r"\*\*\s*\*\*", ""), (r"\*(?<!\*\*)\s+\*(?!\*)", ""), ("``", ""), (r"\*{3,}", "**"),
    (r"\*(?<!\G\*)(?<=.?\w\*)\*\w", " $0"), (r"\*(?<!\G\*)(?<=.?\w\*)(?!\*)\w", " $0"), (r"[ \t]{2,}", " "), (r"\n{3,}", "\n\n"), (r"[ \t]+\n", "\n"),
]
#: What each of them cannot match without: a text, or a pattern of a quick search.
REPAIRS_NEED = ["**", r"\n[ \t]*\*\*", "*", r"\n[ \t]*\*", "`", "`", "**", "*", "``", "***", "**", "*", None, "\n\n\n", None]

# --- enrichment ------------------------------------------------------------------------------

PERSONS = [r"\b[A-Z][a-z]+\s+[A-Z][a-z]+\b", r"\b[A-Z]\.\s*[A-Z][a-z]+\b"]
LOCATIONS = [
    [
        "Paris", "Lyon", "Marseille", "Toulouse", "Nice", "Nantes", "Strasbourg", "Montpellier", "Bordeaux", "Lille", "Rennes", "Reims", "Le Havre", "Saint-Étienne", "Toulon", "Grenoble", "Angers", "Dijon",
        "Nîmes", "Aix-en-Provence", "Brest", "Le Mans", "Amiens", "Tours", "Limoges", "Clermont-Ferrand", "Villeurbanne", "Besançon",
    ],
    [
        "France", "Allemagne", "Italie", "Espagne", "Portugal", "Belgique", "Suisse", "Luxembourg", "Royaume-Uni", "États-Unis", "Canada", "Chine", "Japon", "Russie", "Inde", "Brésil", "Argentine", "Mexique",
        "Australie", "Afrique du Sud",
    ],
    ["Europe", "Asie", "Afrique", "Amérique", "Océanie"],
    ["Gaza", "Israël", "Palestine", "Ukraine", "Russie", "Syrie", "Irak", "Afghanistan", "Iran"],
]
ORGANIZATIONS = [
    ["ONU", "UNESCO", "OTAN", "UE", "Commission européenne", "Parlement européen", "Assemblée nationale", "Sénat", "Élysée", "Matignon"],
    ["Apple", "Google", "Microsoft", "Amazon", "Facebook", "Meta", "Twitter", "Tesla", "BMW", "Mercedes", "Volkswagen", "Airbus", "Total", "LVMH", "L'Oréal"],
]
COMPANY = r"\b[A-Z][A-Za-z]*\s+(?:SA|SAS|SARL|Inc|Corp|Ltd|AG|GmbH)\b"
POSITIVE = [
    "réussite", "succès", "victoire", "progrès", "amélioration", "développement", "croissance", "augmentation", "hausse", "gain", "bénéfice", "prospérité", "innovation", "modernisation", "excellence", "qualité",
]
NEGATIVE = [
    "crise", "problème", "difficulté", "échec", "perte", "baisse", "chute", "diminution", "réduction", "conflit", "guerre", "violence", "accident", "catastrophe", "danger", "risque", "menace", "inquiétude",
    "préoccupation", "corruption", "scandale", "polémique",
]
IMPORTANT = [
    "gouvernement", "président", "ministre", "parlement", "élection", "économie", "crise", "guerre", "paix", "accord", "traité", "innovation", "découverte", "recherche", "technologie", "santé", "climat",
    "environnement", "éducation", "culture",
]
LOW_VALUE = ["guide d'achat", "meilleur", "comparatif", "test", "avis", "accident de voiture", "faits divers", "people", "célébrité"]
URGENT = ["urgent", "alerte", "exclusif", "breaking"]
SCOPE_LOCAL = ["iași", "iasi", "moldavie", "moldova", "românia", "romania", "roumanie"]
SCOPE_NATIONAL = ["france", "français", "nationale", "gouvernement français", "paris"]
SCOPE_INTERNATIONAL = ["international", "mondial", "europe", "union européenne", "otan", "onu"]
TOPICS = [
    ("economic", ["bani", "economie", "buget", "taxa", "pib", "afaceri", "business", "profit", "investitie"]),
    ("politic", ["guvern", "parlament", "alegeri", "presedinte", "ministru", "politica", "partidul"]),
    ("social", ["social", "comunitate", "societate", "familie", "oameni", "populatie"]),
    ("sport", ["fotbal", "sport", "campionat", "echipa", "jucator", "meci"]),
    ("tehnologie", ["tehnologie", "internet", "calculator", "software", "app", "digital"]),
    ("sanatate", ["sanatate", "medical", "doctor", "spital", "tratament", "medicina"]),
    ("educatie", ["educatie", "scolar", "universitate", "elev", "student", "invatamant"]),
    ("cultural", ["cultura", "arte", "muzica", "film", "teatru", "literatura"]),
    ("international", ["international", "mondial", "europa", "sua", "rusia", "china"]),
]
TOPIC_NAMES = {
    "economic": "economic", "politic": "politic", "social": "social", "sport": "sport", "tehnologie": "technology", "educatie": "education", "sanatate": "health", "cultural": "culture",
    "international": "international",
}
#: Categories that get a feed.
FEED_CATEGORIES = ["politic", "economic", "social", "international", "health", "technology", "culture"]
SHOPPING, ABOUT = ["guide", "test", "review", "best", "top"], ["about", "contact", "terms", "privacy"]
KEPT_TYPES = ["news_article", "opinion_article"]
MIN_ANALYSED, FEED_SIZE, FEED_THRESHOLD = 100, 10, 0.4
