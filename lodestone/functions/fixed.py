"""Word lists, patterns and limits that results depend on. They are data, not choices of ours."""

# --- values that read as missing in delimited files
MISSING_TOKENS = ["", "None", "NA", "N/A", "null", "n/a"]
NOT_REPORTED = ["---", "-", ""]

# --- relationships between a field and a disclosure, strongest first, and review states
RELATIONSHIPS = ["equivalent", "component", "intensity", "partial", "gap_gri_side", "gap_stars_side"]
ANSWERS = ["equivalent", "component", "intensity", "partial"]
CITABLE = ["equivalent", "component", "intensity"]
REVIEW_STATES = ["proposed", "confirmed", "rejected"]
STATUS_ORDER = ["Reported", "Partially reported", "Not reported", "Not assessed"]

# --- value typing
NUMERIC = r"^-?[0-9,]+(?:\.[0-9]+)?$"
DATE = r"^[A-Z][a-z]{2}\.? [0-9]{1,2}, [0-9]{4}$|^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
YEAR_FIELD = r"(?i)\byear\b|\bdate\b"
YEAR = r"^(19|20)[0-9]{2}$"
LONG_TEXT = 200
INTENSITY = r"(?i)per person|per unit of floor area|per capita"

# --- page quality
TOPIC_TERMS = [
    "esg", "environmental", "social", "governance", "sustainab", "emission", "carbon", "disclosure", "framework", "reporting",
    "materiality", "gri", "tcfd", "csrd", "esrs", "sasb", "stars", "credit", "indicator",
]
SALES_TERMS = [
    "enroll", "certificate", "instructor", "testimonial", "premium template", "upgrading to a paid", "start free", "book a demo",
    "request a quote", "sign up today", "our clients", "pricing",
]
CONSENT_MARKERS = [
    "accept the disclaimer", "clauses de non-responsabilité", "cookie consent", "no authorization", "aucune autorisation",
    "please enable javascript", "access denied", "are you a robot",
]
FRENCH_MARKERS = [" les ", " des ", " une ", " est ", " qui ", " pour ", " dans "]
FRENCH_FROM, TOPIC_PER_1000, SALES_FROM, THIN_WORDS, STATUS_CHARS = 25, 25, 5, 200, 500

# --- chunking
TARGET_CHARS, OVERLAP_CHARS, MIN_CHUNK_CHARS, MIN_DOC_WORDS, MAX_DOC_CHARS = 1000, 200, 120, 100, 200_000
HEADER_RULE = "=" * 60

# --- quantities and figures
QUANTITY_UNITS = r"percent|tonnes?|tons?|kWh|MWh|GWh|million|billion|USD|EUR"
NUMBER_LIKE = r"[0-9][0-9,.]*"
SPELLED = (
    r"(?i)\b(two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety"
    r"|hundred|thousand|million|billion)\b"
)
# what stands between two of a list's numbers, and between two scopes
REFERENCE_JOINT = r"\s*,\s*(?:and\s+|&\s+)?|\s+(?:and|&)\s+"
SCOPE_JOINT = r"\s*,\s*|\s*(?:and|&|to)\s*"
SCOPE_ITEM = r"[123](?![0-9,.][0-9])"
COUNTED_UNIT = r"(?i)^\s*(?:total\s+)?number of (weeks|days|months|years|hours) of\b"
TOKEN_CHARS, CELL_CHARS = 60, 87

# --- lexical vectors
TERM = r"[a-z][a-z0-9\-]+"
STOPWORDS = [
    "the", "and", "for", "that", "with", "this", "are", "from", "have", "has", "not", "but", "all", "can", "into", "each", "such",
    "may", "which", "their", "they", "there", "these", "those", "than", "then", "when", "what", "will", "would", "should", "could",
    "been", "being", "was", "were", "its", "also", "any", "other", "more", "most", "some", "how", "who", "our", "out", "about",
    "over", "under", "between", "within", "including", "well", "you",
]
MIN_DOC_FREQUENCY = 2
WEAK_MATCH = 0.45
NORM_FLOOR = 1e-12

# --- lines of a standard's page below which nothing is binding
GUIDANCE_MARKERS, GUIDANCE_PREFIX = ["guidance", "background", "glossary"], "guidance for"

# --- documents
DOCUMENT_EXTENSIONS = [".pdf", ".xlsx", ".xls", ".docx", ".doc", ".csv", ".pptx"]
SPREADSHEET_EXTENSIONS = [".xlsx", ".xlsm", ".xls"]
