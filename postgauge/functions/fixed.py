"""They decide results, so they must not drift."""

# Phrases whose density marks a concrete question, tried in this order at each position.
ACTION_PHRASES = [
    "how to", "what is", "why does", "can i", "is there",
    "does anyone", "help me", "anyone know",
    "What", "How", "Why", "should", "can",
]

# Quality feature columns, in output order.
QUALITY_FEATURES = [
    "title_len",
    "body_len",
    "title_ends_with_qmark",
    "body_ends_with_qmark",
    "flesch_score",
    "action_verbs_density",
    "title_caps_ratio",
]

# Word groups counted by the text report.
REPORTING_VERBS = ["told", "said"]
CONJUNCTIONS = ["but", "and"]
WH_ADVERBS = ["when", "where", "why", "how", "whence", "whereby", "whereupon"]

# Flesch reading ease.
FLESCH_BASE = 206.835
FLESCH_PER_SENTENCE = 1.015
FLESCH_PER_WORD = 84.6

# Quality rules.
ACCEPTED_MIN_SCORE = 5
HIGH_SCORE = 10

# Defaults.
ROW_CAP = 501
TRAIN_SHARE = 0.7
SEED = 42
SAMPLE_SIZE = 1000
BODY_LENGTH_LIMIT = 2000
HISTOGRAM_BINS = 60
MAX_CATEGORIES = 5
MISSING_CATEGORY = "missing"
INFREQUENT_SUFFIX = "infrequent_sklearn"
SVD_COMPONENTS = 100
NEIGHBORS = 15
LABEL_KEYS = ["Question_quality", "Answer_quality"]
UNLABELED = "Unlabeled"

# Unicode white space: once as a regex class body that Java and RE2 both read, in the
# form that matches fastest, and once as characters.
WHITESPACE = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x{85}\x{a0}\p{Z}"
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
