"""Fixed values that results depend on.

Everything in the "FIXED VALUES" block must stay exactly as written: the
label spellings, display names, regex character classes and thresholds
define the semantics the engine reproduces.  Importing this module opens no
file, jar or session.
"""

from __future__ import annotations

import functools
import html.entities

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the published pipeline's settings)
# ---------------------------------------------------------------------------

# Candidate source columns, tried left to right.
TEXT_CANDIDATES = ["text", "Email Text", "Text", "body"]
LABEL_CANDIDATES = ["label", "Email Type", "Class"]

# Label spellings (compared after lower-casing and trimming) -> class.
LABEL_MAP = {
    "phishing email": 1,
    "1.0": 1,
    "1": 1,
    "spam": 1,
    "safe email": 0,
    "0.0": 0,
    "0": 0,
    "ham": 0,
    "not phishing": 0,
}

# Display names for the binary label.
LABEL_NAMES_EDA = {0: "Not Phishing (0)", 1: "Phishing (1)"}
LABEL_NAMES_SHORT = {0: "Great", 1: "Bait"}
LABEL_NAMES_PLAIN = {0: "Not Phishing", 1: "Phishing"}

# Values treated as "missing" by the completeness check.
MISSING_TOKENS = ["nan", "none", "null"]

# Money / account keywords used to tag samples.
MONEY_KEYWORDS = ["account", "bank", "bill", "cash", "credit", "eur", "fund",
                  "hundred", "money", "paid", "pay", "price", "thousand"]

# Contractions expanded (in this order, case-sensitive) by the aggressive cleaner.
CONTRACTIONS = [("n't", " not"), ("'re", " are"), ("'s", " is"), ("'d", " would"),
                ("'ll", " will"), ("'ve", " have"), ("'m", " am")]

# Special tokens dropped when merging sub-word tokens; word-start / newline markers.
SPECIAL_TOKENS = ["<s>", "</s>", "<pad>", "<unk>"]
WORD_START_MARK = "Ġ"   # 'Ġ'
NEWLINE_MARK = "Ċ"      # 'Ċ'

# Thresholds.
MIN_CLEAN_CHARS = 50
MIN_TOKENS = 5
MAX_TOKENS = 2000
VERY_LONG_CHARS = 100_000
EXTREMELY_LONG_CHARS = 1_000_000
TARGET_DATASET_SIZE = 100_000
SEED = 42
SPLIT_PERCENT = (70, 15, 15)   # train / validation / test
CV_FOLDS = 5
LEARNING_FRACTIONS = [0.1, 0.325, 0.55, 0.775, 1.0]
HIST_BINS = 50
TOP_NGRAMS = 20
TOP_WORDS = 100
TOP_SOURCES = 10
PREVIEW_CHARS = 100
NO_DESCRIPTION = "No description available."

# Python's str.isspace() set, spelled so Java regex and RE2 read it alike.
WS_CLASS = (r"\t\n\x{0B}\f\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# Python's Unicode \w (letters, numbers, underscore).
WORD_CLASS = r"\p{L}\p{N}_"
# string.punctuation (32 ASCII characters) as a range class.
PUNCT_CLASS = r"[!-/:-@\[-`{-~]"
URL_PATTERN = r"(https?://[^" + WS_CLASS + r"]+|www\.[^" + WS_CLASS + r"]+)"

# ---------------------------------------------------------------------------
# Tables derived from libraries (not transcribed)
# ---------------------------------------------------------------------------


# FIXED VALUES: the English list of Spark ML's StopWordsRemover, stated here so
# that importing the package needs no jar, session or file.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
    hers herself it its itself they them their theirs themselves what which who whom this that these
    those am is are was were be been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through during before after
    above below to from up down in out on off over under again further then once here there when where
    why how all any both each few more most other some such no nor not only own same so than too very s
    t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
    they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
    weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
    couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
    would
    """.split())


def english_stop_words() -> tuple[str, ...]:
    return ENGLISH_STOP_WORDS


@functools.lru_cache(maxsize=None)
def html_named_entities() -> dict[str, str]:
    """HTML 5 character references from the Python standard library: names
    with their semicolon, and the older names that may stand without one."""
    return dict(html.entities.html5)
