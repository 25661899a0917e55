"""Results depend on them, so they are stated here once, as plain text."""

# Text encodings.
TOKEN_SEPARATOR = " "
TAG_SEPARATOR = "/"
CJK_PATTERN = "[一-龥]"
IDEOGRAPHIC_SPACE = "　"
# Characters removed at both ends by a trim: code points 0 to 32.
TRIM_CHARACTERS = "".join(chr(code) for code in range(33))

# Sentence and clause borders.
LINE_BREAKS = "\r\n"
SENTENCE_MARKS = "。？?！!；;\t"
CLAUSE_MARKS = "，,。？?！!；;\n\r"
FULL_STOP = "。"
SHORT_SENTENCE = 5

# Origin line, "label: site-site".
ORIGIN_LABEL_PATTERN = "^.*?[:：][ ]*"
ORIGIN_SPLIT_PATTERN = "[-－]"

# Keywords.
EXCLUDED_TAG_INITIALS = ["d", "f", "t", "m", "b", "c", "e", "o", "p", "q", "u", "y", "z", "r", "w"]
BANNED_SUBSTRINGS = ["某", "记者"]
KEYWORD_COUNT = 7
KEYWORD_WINDOW = 3
KEYWORD_CANDIDATES = 20
TITLE_BOOST = 2.0

# Iterative ranking.
DAMPING = 0.85
MAX_ROUNDS = 200
MIN_DIFF = 1e-4

# BM25 and summary.
BM25_K1 = 1.5
BM25_B = 0.75
SUMMARY_LENGTH = 200
CUE_PHRASES = ["综上所述"]
CUE_FACTOR = 2.0
LAST_SENTENCE_FACTOR = 0.9
REDUNDANCY_THRESHOLD = 10.0

# Sentiment.
FIRST_CLAUSE_FACTOR = 2.0
NEGATION_BEFORE_ADVERB = 2.0
ADVERB_BEFORE_NEGATION = 0.5

# Places.
TITLE_REPEATS = 3
PLACE_COUNT = 3

# Classification.
TEMPLATE_SIZE = 500
UNKNOWN_CLASS = "Unknown"
FALLBACK_LABEL = "时事"
EVIDENCE_LABELS = ["汽车"]
LABEL_EXCLUSIONS = {"军事": ["娱乐", "旅游", "体育", "汽车"]}
WORD_VECTOR_SIZE = 200
HASH_FEATURES = 1_000_000
SPLIT_SEED = 1231
# Words that word vectors are learned for, at most; the driver holds two vectors of each.
VOCABULARY_BOUND = 200_000
