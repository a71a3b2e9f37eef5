"""Word lists, patterns and tables that results depend on.  Kept as they must be, in natural order."""

from __future__ import annotations

# --- fixed values: patterns in ECMAScript notation, translated by ``rx`` ---
TENNIS = r"\bt[eéê]nn?is|lawn tennis"
PADEL = r"p[aá]del"
SQUASH = r"\bsquash"
PADEL_TENNIS = r"p[aá]d(el|dle)[\s-]*tennis"

PUBLIC = "|".join(
    [
        "municipal", "municipio", "munic[ií]pio", "ayuntamiento", "ajuntament", "concello", "concejo", "c[aâ]mara municipal", "prefeitura",
        "alcald[ií]a", r"\bcouncil\b", r"\bborough\b", r"\bcity of\b", r"\bcounty\b", r"\btown of\b", r"\bvillage of\b", r"\bdistrict\b",
        "parks (and|&) rec", r"\bpublic (park|court|pool)", "deportes municipales", r"\bcommunity\b", r"\bcomunitari", r"\brecreation\b", r"\brecreativ",
        "leisure cent", "leisure center", "civic cent", "social club", r"\bvillage hall\b", "centro c[ií]vico", "casa de la cultura", "polideportivo",
        "poliesportiu", "complejo deportivo municipal", "centro deportivo municipal", r"\bcharity\b", r"\bnon-?profit\b", r"\bfoundation\b",
        "funda[cç][aã]o", "fundaci[oó]n", "universidad", "universidade", "university", r"\bcollege\b", r"\bschool\b", r"\bacademy of\b", "colegio",
        "col[eé]gio", "instituto", "escuela", "escola", r"\bcampus\b", r"\bstudent", "federaci[oó]n", "federa[cç][aã]o", "federation",
        r"\bassociation\b", "asociaci[oó]n", "associa[cç][aã]o", r"\bconfedera", r"\bleague\b", r"\bliga\b", r"\bcircuit\b", "ministerio",
        "minist[eé]rio", "gobierno", "governo", r"\bgovern", r"\bstate of\b", r"\bYMCA\b", r"\bYWCA\b", r"\barmy\b", r"\bnavy\b", "air force",
        r"\bmilitary\b", "defence", "defense", r"\bpolice\b", r"\bpolic[ií]a\b", "penitenci",
    ]
)
PUBLIC_DOMAIN = "|".join(
    [
        r"\.gov(\.|$)", r"\.gob(\.|$)", r"\.gouv(\.|$)", r"\.gv\.", r"\.mil(\.|$)", r"\.edu(\.|$)", r"\.ac\.", r"\.sch\.", r"\.k12\.", r"\.int(\.|$)",
        "ayuntamiento", "municipal", "prefeitura", r"\.council\.", r"council\.gov",
    ]
)
CLUB_WORD = "|".join(
    [
        r"\bclub\b", r"\bclube\b", r"\bclub[eu]", r"\bcd\b", r"\bct\b", "country club", "racquet", "racket", "lawn tennis", "tennis club", "tenis club",
        "t[eéê]nis club", "p[aá]del", "padel", "squash", "sports? club", "sporting", r"\bacademy\b", "academia", "centre de tennis", "centro de tenis",
        "centro de t[eéê]nis", r"\bcourts?\b", r"\bclubhouse\b", r"\bindoor\b", r"\bcentre?\b", r"\bcenter\b", r"\bc[ií]rculo\b", r"\bcircolo\b",
        r"\bcercle\b", r"club\b", r"cent(er|re)\b", r"\btc\b", r"\bltc\b",
    ]
)
EMAIL = r"[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,24}"
JUNK_EMAIL = "|".join(
    [
        r"\.(png|jpe?g|gif|webp|svg|css|js|woff2?)$", r"@(2x|3x)\.", "sentry", "wixpress", r"example\.(com|org|net)", "yourdomain", r"domain\.com",
        "godaddy", "squarespace", r"wordpress\.(com|org)", "cloudflare", "placeholder", "^email@", "^test@", "^user@", "^name@", "^your", r"sentry\.io",
        r"\.local$", "jquery", "bootstrap", r"googlemail\.com\.", "lorem", "ipsum", r"@email\.", r"@mail\.com$", "@domain",
    ]
)
NO_REPLY = r"^(no-?reply|donot-?reply|postmaster|hostmaster|abuse|privacy|dmarc|dkim|spam|webmaster|wordpress|admin@localhost|sales@wix)"
REGISTER_JUNK = r"^(nonmember@nonmember|no-?reply@|donotreply@|example@|test@|your@|email@example|info@(mysite|website|example|domain))"
ROLES = [
    "info", "contact", "contacto", "contato", "geral", "general", "club", "clube", "clubhouse", "secretaria", "secretariat", "secretary", "admin",
    "administracion", "administra[cç][aã]o", "reservas", "reservations", "bookings", "hello", "enquiries", "enquiry", "office", "mail", "membership",
    "socios", "s[oó]cios", "manager", "gerencia", "director",
]
CONTACT_NAME = r"(?:contacto|contato|contact|secretari[oa]|secretary|president[ea]?|gerente|manager|responsable|respons[aá]vel|director[a]?)\s*[:\-–]\s*([A-ZÁÉÍÓÚÑÂÃÊÔÇ][\p{L}.'\-]+(?:\s+[A-ZÁÉÍÓÚÑÂÃÊÔÇ][\p{L}.'\-]+){1,3})"
NOT_A_CONTACT = r"\b(club|tennis|padel|squash|email|telefono|phone)\b"
STOPWORDS = [
    "club", "clube", "de", "del", "la", "el", "los", "las", "do", "da", "dos", "das", "of", "the", "tenis", "tennis", "padel", "squash", "sports",
    "sport", "deportivo", "real", "centro", "centre", "center", "ct", "cd", "and", "y", "e", "lawn", "racquet", "racket", "asociacion", "asoc",
    "com", "www", "net", "org", "tennisclub", "padelclub", "squashclub", "sportclub",
]
FREEMAIL = [
    "gmail.com", "googlemail.com", "hotmail.com", "hotmail.es", "hotmail.co.uk", "outlook.com", "outlook.es", "live.com", "yahoo.com", "yahoo.es",
    "yahoo.co.uk", "yahoo.com.br", "ymail.com", "aol.com", "icloud.com", "me.com", "mail.com", "gmx.com", "gmx.net", "protonmail.com", "proton.me",
    "terra.com.br", "uol.com.br", "bol.com.br", "ig.com.br", "telefonica.net", "orange.es", "mail.telepac.pt", "sapo.pt", "clix.pt", "netcabo.pt",
    "hotmail.com.ar", "yahoo.com.ar", "zoho.com", "yandex.com", "free.fr", "btinternet.com", "sky.com", "virginmedia.com", "msn.com",
]
AGGREGATOR = "|".join(
    [
        "wikipedia", "wikidata", "tripadvisor", "yelp", "expedia", r"hotels?\.com", "playtomic", "matchi", "padelmates", r"\bitf", r"\bwta",
        r"\batptour", "sportsvenue", "venue-?finder", "directory", "yellowpages", "businesslist", "facebook", "instagram", "youtube", "linkedin",
        r"\.gov", r"\.gob\.", r"\bun\.org",
    ]
)
LISTING_NAME = "|".join(
    [
        "encuentra", "busca(r|dor)?", "directorio", "listado", "gu[ií]a", "mejores", r"los \d", "find (a|the|your)", "search for", r"best \d?",
        r"top \d", "listings?", "booking system", "reserva (tu|de)", "book (a|your)", "compare", "marketplace", "platform", "software",
        "en todo el mundo", "por el mundo", "no mundo", "worldwide", "around the world", "all over the world", "del mundo", "globally",
    ]
)
NOT_A_CLUB_SITE = "|".join(
    [
        "facebook", "instagram", "twitter", r"x\.com", "youtube", "linkedin", "tiktok", "pinterest", "tripadvisor", "yelp", "foursquare", "yellowpages",
        "paginasamarillas", "paginas-amarelas", r"google\.", r"maps\.", r"goo\.gl", r"wa\.me", r"t\.me", "wikipedia", "wikimapia", r"apple\.com",
        "openstreetmap", r"booking\.com", "airbnb", "indeed", "glassdoor", "crunchbase", "wanderboat", "cylex", "tuugo", "opendi", "hotfrog",
        r"local\.ch", "infobel", "kompass", "findglocal", "eventbrite", "meetup", "amazon", "ebay", r"\.pdf$",
    ]
)
CLUB_PLATFORM = r"clubspark|lta\.org\.uk|matchi\.se|playtomic|courtreserve|sportlomo|teamer|pitchero|gameday|revolutionise|sportsengine|leaguerepublic|tenup|padelmanager|taykus"
SOCIAL_HOST = r"facebook|instagram|twitter|x\.com|linktr\.ee|tiktok|youtube"
SKIPPED_LINK = r"facebook|instagram|twitter|x\.com|youtube|linkedin|tiktok|whatsapp|google\.|maps\.|goo\.gl|wa\.me|t\.me|apple\.com|play\.google|wikipedia"
NAVIGATION = r"^(home|inicio|contacto|contact|about|login|registr|cookie|privac|terms|aviso|menu|buscar|search)"
NEXT_TEXT = r"^(next|siguiente|siguiente »|próxima|proxima|seguinte|»|>|older|next page)$"
CHALLENGE = r"sgcaptcha|\/cdn-cgi\/challenge|cf[-_]chl|captcha-delivery|__cf_chl|jschl_vc|incapsula|distil_r_blocked|are you a human|enable javascript to continue"
DRAWN_BY_SCRIPT = r'__NEXT_DATA__|window\.__|ng-app|data-react|vue-app|\.json"'
EXCLUDED_CATEGORY = "|".join(
    [
        "College_and_University", "Universit", "Schools?_and", "/Schools?/", "K-12", "News_and_Media", "Magazines?", "Publications?", "Organizations?",
        "Associations?", "Federations?", "Governing", "Instruction", "Camps", "Coaching", "Products?", "Shopping", "Equipment", "Chats_and_Forums",
        "Personal_Pages", "Universidades", "Escuelas", "Organizaciones", "Federaci", "Noticias", "Revistas", "Tiendas", "Educa", "Not%C3%ADcias",
        "Lojas",
    ]
)
RELEVANT = r"(Tennis|Squash|Racquet|Racket|Padel|Paddle|Tenis|T%C3%AAnis|P%C3%A1del)"
CONTACT_PATHS = [
    "/contato", "/fale-conosco", "/faleconosco", "/fale-com-a-gente", "/atendimento", "/contact", "/contact-us", "/contacto", "/contactos",
    "/contacta", "/kontakt", "/about", "/quienes-somos", "/sobre-nos", "/socios", "/membership", "/reservas", "/impressum",
]
CONTACT_LINK = r"contact|contacto|contacta|contato|fale[-\s]?conosco|fale[-\s]?com|atendimento|contate|kontakt|about|quienes|sobre|nosotros|socios|membership|impressum|reservas"
PLUMBING = r"^(cpanel|webmail|mail|ftp|autodiscover|autoconfig|cpcalendars|cpcontacts|smtp|pop3?|imap|ns\d*|server\d*|host\d*|vps\d*|mx\d*|staging|test|dev)\."
MINED_WORDS = [
    "padel", "tennisclub", "squashclub", "racquetclub", "clubdetenis", "tenisclub", "clubdepadel", "tenisclube", "clubedetenis",
]
VANITY_TLDS = [
    "tv", "fm", "io", "cc", "me", "ai", "gg", "to", "ws", "nu", "mu", "sc", "vu", "st", "tk",
]
TERMS = {
    "Spanish": ["club de tenis", "club de pádel", "club de squash", "academia de tenis", "centro de padel"],
    "Portuguese": ["clube de ténis", "clube de padel", "clube de squash", "academia de tênis", "centro de padel"],
    "English": ["tennis club", "padel club", "squash club", "racquet club", "tennis centre", "padel center"],
}
TERMS_OF_BRAZIL = ["clube de tênis", "clube de padel", "clube de squash", "academia de tênis", "centro de padel", "clube de tenis"]
CONTACT_WORD_OF_BRAZIL = "contato"
CONTACT_WORD = {"Spanish": "contacto", "Portuguese": "contacto", "English": "contact"}
ANCHOR = r"""<a\b[^>]*href=["']([^"']+)["'][^>]*>([\s\S]*?)<\/a>"""
SKIPPED_SCHEME = r"^(#|javascript:|mailto:|tel:)"
TITLE = r"<title[^>]*>([\s\S]{0,200}?)<\/title>"
H1 = r"<h1[^>]*>([\s\S]{0,200}?)<\/h1>"
NAMING_META = r"""<meta[^>]+(?:property|name)\s*=\s*["'](?:og:site_name|og:title|application-name)["'][^>]*>"""
META_CONTENT = r"""content\s*=\s*["']([^"']{1,200})["']"""
TITLE_PREFIX = r"^(welcome to|bienvenidos? a|bem-vindos? a|home\s*[-:]\s*)"
TITLE_SUFFIX = r"\s*[-:,]\s*(home|inicio|in[ií]cio|official site|sitio oficial)\s*$"
VENUE_ID = r"VenueId=([A-Za-z0-9]+)"
VENUE_TITLE_SUFFIX = r"\s*[|-]\s*LTA\s*$"
CARD_BLOCK = r"__header[^>]*>\s*{label}\s*<\/div>([\s\S]{{0,400}}?)<\/div>"
META_REFRESH = r"""http-equiv=["']refresh["'][^>]*content=["']\s*\d+\s*;\s*(?:url=)?([^"'>]+)"""
REL_NEXT = r"""<link[^>]+rel=["']next["'][^>]+href=["']([^"']+)["']"""
CF_EMAIL = r'data-cfemail="([0-9a-f]+)"'
MAILTO = r"""mailto:([^"'?\s>]+)"""
SPELT_OUT = [
    (r"&#0?64;", "@"),
    (r"&#0?46;", "."),
    (r"\s*[\[({]\s*(at|arroba|arobase)\s*[\])}]\s*", "@"),
    (r"\s*[\[({]\s*(dot|punto|ponto)\s*[\])}]\s*", "."),
    (r"\s+(at)\s+", "@"),
    (r"\s+(dot|punto|ponto)\s+", "."),
]
MAP_SPORT = r"(^|; ?)(tennis|padel|paddle_tennis|padel_tennis|squash)"
MAP_CLUB = r"^(tennis|padel|squash|racquet)$"
MAP_CENTRE_NAME = r"tennis|p[aá]del|squash"
CHALLENGED = "blocked by a challenge page"
SILENT = "no email published"
MISSED = ("unreachable", "bad url")
MOST_ATTEMPTS = 4
CHALLENGE_MINUTES = 360
RETRY_MINUTES = 10
ACCESS_FOR_ALL = "^(yes|public|permissive)$"
PUBLIC_OPERATOR = "^(government|public|council)$"
REGISTER_SITES = r"(^|\.)lta\.org\.uk$|ltapadel|ltatennisfoundation"
REGISTER_MAIL = r"lta\.org\.uk$"
TOO_BIG = "504|timed out|out of memory|cut the query short"
RESULT_LINK = r'<a[^>]+href="([^"]*uddg=[^"]+)"[^>]*>([\s\S]*?)<\/a>'
RESULT_TARGET = r'uddg=([^&"]+)'
# countries in the order of their table: code, name, language
COUNTRIES = [
    ("AR", "Argentina", "Spanish"),
    ("BO", "Bolivia", "Spanish"),
    ("CL", "Chile", "Spanish"),
    ("CO", "Colombia", "Spanish"),
    ("CR", "Costa Rica", "Spanish"),
    ("CU", "Cuba", "Spanish"),
    ("DO", "Dominican Republic", "Spanish"),
    ("EC", "Ecuador", "Spanish"),
    ("SV", "El Salvador", "Spanish"),
    ("GQ", "Equatorial Guinea", "Spanish"),
    ("GT", "Guatemala", "Spanish"),
    ("HN", "Honduras", "Spanish"),
    ("MX", "Mexico", "Spanish"),
    ("NI", "Nicaragua", "Spanish"),
    ("PA", "Panama", "Spanish"),
    ("PY", "Paraguay", "Spanish"),
    ("PE", "Peru", "Spanish"),
    ("ES", "Spain", "Spanish"),
    ("UY", "Uruguay", "Spanish"),
    ("VE", "Venezuela", "Spanish"),
    ("AO", "Angola", "Portuguese"),
    ("BR", "Brazil", "Portuguese"),
    ("CV", "Cape Verde", "Portuguese"),
    ("TL", "East Timor", "Portuguese"),
    ("GW", "Guinea-Bissau", "Portuguese"),
    ("MZ", "Mozambique", "Portuguese"),
    ("PT", "Portugal", "Portuguese"),
    ("ST", "São Tomé and Príncipe", "Portuguese"),
    ("AG", "Antigua and Barbuda", "English"),
    ("AU", "Australia", "English"),
    ("BS", "Bahamas", "English"),
    ("BB", "Barbados", "English"),
    ("BZ", "Belize", "English"),
    ("BW", "Botswana", "English"),
    ("CA", "Canada", "English"),
    ("DM", "Dominica", "English"),
    ("FJ", "Fiji", "English"),
    ("GM", "Gambia", "English"),
    ("GH", "Ghana", "English"),
    ("GD", "Grenada", "English"),
    ("GY", "Guyana", "English"),
    ("IN", "India", "English"),
    ("IE", "Ireland", "English"),
    ("JM", "Jamaica", "English"),
    ("KE", "Kenya", "English"),
    ("KI", "Kiribati", "English"),
    ("LS", "Lesotho", "English"),
    ("LR", "Liberia", "English"),
    ("MW", "Malawi", "English"),
    ("MT", "Malta", "English"),
    ("MH", "Marshall Islands", "English"),
    ("MU", "Mauritius", "English"),
    ("FM", "Micronesia", "English"),
    ("NA", "Namibia", "English"),
    ("NR", "Nauru", "English"),
    ("NZ", "New Zealand", "English"),
    ("NG", "Nigeria", "English"),
    ("PK", "Pakistan", "English"),
    ("PW", "Palau", "English"),
    ("PG", "Papua New Guinea", "English"),
    ("PH", "Philippines", "English"),
    ("RW", "Rwanda", "English"),
    ("KN", "Saint Kitts and Nevis", "English"),
    ("LC", "Saint Lucia", "English"),
    ("VC", "Saint Vincent and the Grenadines", "English"),
    ("WS", "Samoa", "English"),
    ("SC", "Seychelles", "English"),
    ("SL", "Sierra Leone", "English"),
    ("SG", "Singapore", "English"),
    ("SB", "Solomon Islands", "English"),
    ("ZA", "South Africa", "English"),
    ("SS", "South Sudan", "English"),
    ("SD", "Sudan", "English"),
    ("TZ", "Tanzania", "English"),
    ("TO", "Tonga", "English"),
    ("TT", "Trinidad and Tobago", "English"),
    ("TV", "Tuvalu", "English"),
    ("UG", "Uganda", "English"),
    ("GB", "United Kingdom", "English"),
    ("US", "United States", "English"),
    ("VU", "Vanuatu", "English"),
    ("ZM", "Zambia", "English"),
    ("ZW", "Zimbabwe", "English"),
    ("AE", "United Arab Emirates", "English"),
    ("CY", "Cyprus", "English"),
    ("EG", "Egypt", "English"),
    ("HK", "Hong Kong", "English"),
    ("BM", "Bermuda", "English"),
    ("KY", "Cayman Islands", "English"),
    ("GI", "Gibraltar", "English"),
    ("JE", "Jersey", "English"),
    ("IM", "Isle of Man", "English"),
    ("PR", "Puerto Rico", "Spanish"),
]
PRIORITY = [
    "ES", "GB", "BR", "AR", "US", "AU", "PT", "MX", "IN", "ZA", "CA", "IE", "NZ", "CL", "CO", "PE", "UY", "EC", "PY", "CR", "PA", "GT", "DO", "VE",
    "BO", "SV", "HN", "NI", "CU", "SG", "PH", "PK", "KE", "NG", "MT", "MU", "ZW", "ZM", "TZ", "UG", "GH", "BW", "NA", "TT", "JM", "BS", "BB", "FJ",
    "PG", "MZ", "AO", "CV", "SC", "MW", "RW", "GY", "BZ", "LC", "GD", "AG", "KN", "VC", "DM", "SS", "SD", "GM", "LS", "LR", "SL", "TL", "GW", "ST",
    "GQ", "WS", "TO", "VU", "SB", "KI", "NR", "TV", "MH", "FM", "PW", "AE", "HK", "EG", "CY", "PR", "BM", "KY", "GI", "JE", "IM",
]
COUNTRY_ALIASES = {
    "Timor_Leste": "TL", "España": "ES", "México": "MX", "Perú": "PE", "Panamá": "PA", "República_Dominicana": "DO", "Brasil": "BR", "Estados_Unidos": "US",
    "Reino_Unido": "GB", "Irlanda": "IE", "Sudáfrica": "ZA", "Nueva_Zelanda": "NZ", "Filipinas": "PH", "Kenia": "KE",
}
# --- end of fixed values ---
