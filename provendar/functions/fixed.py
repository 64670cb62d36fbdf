"""Fixed values of the data model: identifiers, thresholds, word lists and patterns that results depend on."""

# ---- fixed values: cell syntax and units
NUMBER = r"^-?\d+(?:[.,]\d+)?(?:[eE][+-]?\d+)?$"
NATIVE_NUMBER = r"^-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?$"
BELOW = r"^<\s*(\d+(?:[.,]\d+)?(?:[eE][+-]?\d+)?)$"
UNIT_IN_NAME = r"\((kcal|kJ|mg|µg|g)/100 (?:g|ml)\)"
UNIT_IN_HEADER = r"\[(kcal|kJ|mg|µg|g)\]"
UNIT_KEYS = {"kcal": "kcal", "kJ": "kj", "mg": "mg", "µg": "ug", "g": "g"}
GRAMS = {"g": 1.0, "mg": 1e-3, "ug": 1e-6, "µg": 1e-6}
LIGATURES = {"œ": "oe", "Œ": "OE", "æ": "ae", "Æ": "AE", "ß": "ss"}
KEY_ALIASES = {"alfa_tocoferol_mg": "a_tocoferol_mg"}
ID_ALPHABET = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
ID_PREFIX = "nfx_"

# ---- fixed values: value kinds, ranks, bases
KIND_TO_TYPE = {"number": "measured", "trace": "trace", "below_loq": "below_loq"}
TYPE_RANK = {"measured": 0, "trace": 1, "below_loq": 2}
PER_100G, PER_100ML = "per_100g_edible", "per_100ml"
DIVERGENCE = 0.30
LITE_DIVERGENCE_RATIO = 0.7

# ---- fixed values: quality checks
PROXIMATES = ("WATER", "PROCNT", "FAT", "CHOAVL", "FIBTG", "ASH", "ALC")
PROXIMATES_RANGE = (97.0, 103.0)
ENERGY = {"PROCNT": 4.0, "FAT": 9.0, "CHOAVL": 4.0, "FIBTG": 2.0, "ALC": 7.0, "POLYL": 2.4}
ENERGY_OPTIONAL = ("POLYL",)
ENERGY_TOLERANCE, ENERGY_FLOOR = 0.05, 5.0
FATTY_ACIDS = ("FASAT", "FAMS", "FAPU", "FATRN")
SUGARS = ("GLUS", "FRUS", "GALS", "SUCS", "LACS", "MALS")
SUM_TOLERANCE = 1.02
AMINO_ACIDS = ("ALA", "ARG", "ASP", "CYS", "GLU", "GLY", "HIS", "ILE", "LEU", "LYS", "MET", "PHE", "PRO", "SER", "THR", "TRP", "TYR", "VAL")
AMINO_RANGE = (0.85, 1.15)
SALT_FACTOR, SALT_TOLERANCE = 2.5, 0.10
RETINOL_SHARE = 0.95
GRAM_NUTRIENTS = ("WATER", "PROCNT", "FAT", "FASAT", "FAMS", "FAPU", "CHOAVL", "FIBTG", "SUGAR", "STARCH", "ASH", "ALC", "NACL", "SALTEQ")
Z_LIMIT, Z_MIN_N = 4.0, 10
EXAMPLES = 5
SEVERITY_RANK = {"error": 0, "warning": 1, "info": 2}

# ---- fixed values: matching of records
CORE = ("ENERC_KCAL", "PROCNT", "FAT", "CHOAVL", "WATER", "FIBTG")
VETO_SHARED, VETO_DIVERGENT, VETO_RATIO = 3, 2, 0.65
TERM_WEIGHT, NAME_WEIGHT, GROUP_WEIGHT = 0.55, 0.25, 0.20
AUTOMATIC, REVIEW, SINGLE_TERM = 0.84, 0.50, 0.65
RARE_TOKEN = 25
GENERIC_TERMS = (
    "raw", "boiled", "cooked", "grilled", "fried", "roasted", "roast", "stewed", "breaded", "fresh", "dried", "dry", "dehydrated", "frozen",
    "canned", "drained", "whole", "skin", "with_skin", "without_skin", "lean", "fat", "semi_skimmed", "skimmed", "liquid", "solid", "natural",
    "plain", "salted", "unsalted", "with_salt", "sweetened", "flavoured", "fortified", "powder", "instant", "concentrated", "pulp", "pieces",
    "grated", "squeezed", "stuffed", "filled", "green", "white", "black", "red", "sweet", "light", "reduced", "homemade", "crystallized",
    "pasteurized", "uht", "seco",
)
COLOR_TERMS = ("green", "white", "black", "red", "yellow")
STOP_WORDS = (
    "de", "da", "do", "das", "dos", "e", "ou", "em", "para", "no", "na", "ao", "aos", "as", "um", "uma", "sem", "com", "o", "a", "os", "du", "des",
    "et", "en", "au", "aux", "la", "le", "les", "un", "une", "l", "sans", "avec", "y", "d", "n", "the", "of", "and", "an", "in", "on", "for", "with",
    "without", "to", "is", "tipo", "type", "moyen", "media", "medio", "average", "pur", "puro", "pure", "pura", "simples", "standard", "tablete",
    "tablette", "aliment", "emballe", "preemballe", "embalado", "preembalado", "rafinee", "refinado",
)

# ---- fixed values: vocabulary gates
ENERGY_TAGS = ("ENERC_KJ", "ENERC_KCAL")
ABSENCE_TYPES = ("not_measured", "not_detected", "below_loq", "trace", "not_applicable", "assumed_zero")
PROFILES = ("core", "extended", "lite")

# ---- fixed values: locales of values, first exact, then in this order; locales that the client tries
VALUE_CHAINS = {"fr": ["en", "pt"], "en": ["fr", "pt"], "pt": ["en", "fr"], "pt-PT": ["pt", "en", "fr"], "pt-BR": ["pt", "en", "fr"]}
CLIENT_LOCALES = ("en", "fr", "pt")

# ---- fixed values: retention methods, the first keyword found wins
METHODS = (
    ("MICROWAVE", "microwaved"), ("REHEAT", "reheated"), ("CANNED", "canned"), ("BLANCH", "blanched"), ("POACH", "poached"), ("BOIL", "boiled"),
    ("STEAM", "steamed"), ("BRAIS", "braised"), ("STEW", "stewed"), ("SIMMER", "simmered"), ("SIMMR", "simmered"), ("ROAST", "roasted"),
    ("BROIL", "broiled"), ("FRY", "fried"), ("SAUTE", "fried"), ("FRIED", "fried"), ("BAKE", "baked"), ("GRILL", "grilled"),
    ("COOKED", "cooked"), ("CKD", "cooked"), ("HEATED", "cooked"),
)

# ---- fixed values: locale chains
CHAINS = {"en": [], "fr": [], "pt": ["en"], "pt-PT": ["pt", "en"], "pt-BR": ["pt", "en"], "es": ["en"], "de": ["en"], "it": ["en"]}
LABEL_OK = ("native", "official", "curated")
