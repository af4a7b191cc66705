"""Regular expressions and word lists shared by the column functions.

Character classes are written so Java regex (Spark) and RE2 (DuckDB) agree
with Python's Unicode ``\\w`` and ``\\s``: ASCII ``\\w`` would split accented
words, and neither engine's ``\\s`` covers the Unicode spaces Python strips.
"""

from __future__ import annotations

# Python's str ``\w``: letters, numbers and underscore.
WORD_CLASS = r"\p{L}\p{N}_"

# Python's str ``\s``, listed code point by code point.
SPACE_CLASS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

SPACE_RUN = "[" + SPACE_CLASS + "]+"
NON_WORD = "[^" + WORD_CLASS + "]"

# ---------------------------------------------------------------------------
# These must equal the reference behaviour for equal results.
# ---------------------------------------------------------------------------

# Characters kept by both text cleaners: word characters, whitespace, '-', '.'.
CLEAN_DROP = "[^" + WORD_CLASS + SPACE_CLASS + r"\-\.]"
# A run of characters that the training cleaner turns into one space: dropped
# characters and whitespace alike, that is all but word characters, '-', '.'.
CLEAN_GAP = "[^" + WORD_CLASS + r"\-\.]+"

# Code format used when parsing code sets (strict form, optional dot part).
CODE_STRICT = r"^[A-Z][0-9]{2}(\.[0-9A-Z]{1,4})?$"

# Code format used by the validation reports (dot part mandatory, digits or X).
CODE_REPORT = r"^[A-Z][0-9]{2}\.[0-9X]{1,2}$"

# Separator of a code-set string.
CODE_SEPARATOR = "|"

# Lexicon of the training features (word-bounded counts on cleaned text).
TRAINING_LEXICON = {
    "symptoms": ["pain", "discomfort", "pressure", "burning", "nausea",
                 "dizziness", "fatigue", "weakness"],
    "body_parts": ["chest", "abdomen", "head", "back", "legs", "arms", "neck",
                   "shoulder", "knee", "hip", "throat", "stomach"],
    "severity": ["mild", "moderate", "severe", "acute", "chronic",
                 "intermittent", "persistent"],
    "medical_terms": ["examination", "diagnosis", "treatment", "medication",
                      "symptoms", "condition"],
}

# Lexicon of the scoring-app features (distinct substrings present).
APP_LEXICON = {
    "symptoms": ["pain", "discomfort", "pressure", "burning", "nausea",
                 "dizziness", "fatigue", "weakness"],
    "body_parts": ["chest", "abdomen", "head", "back", "legs", "arms", "neck",
                   "shoulder", "knee", "hip", "throat", "stomach"],
    "severity": ["severe", "acute", "chronic", "mild", "moderate",
                 "intermittent", "persistent"],
    "medical_terms": ["diagnosis", "treatment", "symptoms", "examination",
                      "test", "medication", "condition"],
}

# Entity phrases (leftmost-first alternation, whole words).
ENTITY_LEXICON = {
    "symptoms": ["pain", "discomfort", "pressure", "burning", "nausea",
                 "dizziness", "fatigue", "weakness", "shortness of breath",
                 "chest pain"],
    "body_parts": ["chest", "abdomen", "head", "back", "legs", "arms", "neck",
                   "shoulder", "knee", "hip", "throat", "stomach", "heart",
                   "lungs"],
    "medications": ["aspirin", "ibuprofen", "acetaminophen", "antibiotics",
                    "insulin", "metformin"],
    "procedures": ["ekg", "ecg", "x-ray", "mri", "ct scan", "blood test",
                   "surgery", "examination"],
}

# Stop words removed before counting terms.
STOP_WORDS = ["the", "a", "an", "and", "or", "but", "in", "on", "at", "to",
              "for", "of", "with", "by"]

# Term vocabulary: size and minimum number of documents.
VOCAB_SIZE = 1000
VOCAB_MIN_DF = 2

# Validation messages.
MSG_SHORT_TEXT = "Clinical notes must be at least 10 characters long"
MSG_BAD_AGE = "Patient age must be between 0 and 120"

# Confidence levels: (lower bound, name), checked in order.
CONFIDENCE_LEVELS = [(0.8, "High"), (0.6, "Medium"), (0.0, "Low")]

# Bucket edges of the distribution reports.
AGE_BUCKETS = ["Under 18", "18-30", "31-50", "51-70", "Over 70", "Unknown"]
STAY_BUCKETS = ["1 day or less", "2-7 days", "8-14 days", "15-30 days",
                "Over 30 days", "Unknown"]
SEVERITY_BUCKETS = ["Low (1-2)", "Medium (2.1-5)", "High (5.1-8)",
                    "Critical (>8)", "Unknown"]

# Split fractions and seed.
SPLIT_SEED = 42
SPLIT_TEST_FRACTION = 0.3
SPLIT_HOLDOUT_TEST_FRACTION = 0.5

# ---------------------------------------------------------------------------


def regex_escape(text: str) -> str:
    """Escape regex metacharacters in a form both Java regex and RE2 accept."""
    out = []
    for ch in text:
        if ch in r".^$*+?()[]{}|\/":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)
