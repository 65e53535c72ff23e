"""Fixed values.

Word lists, patterns, weights and names that decide results.  They are stated
here once and used by the Spark columns and by the SQL that checks them.
"""

# ---- fixed values: labels and word lists -------------------------------

LABELS = ["A", "B", "C", "D"]

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

WH_WORDS = "who what when where why how which".split()
WH_FILTER_WORDS = "who what where when why how".split()

# first words that disqualify a run of capitalised words
STOP_STARTS = "in on at during because for eventually this that these those it".split()

# last words / second words of a broken question (readability gate)
GATE_LAST = (
    "a an and as at because by for from in into of on or than that the to with"
).split()
GATE_SECOND = GATE_LAST + ["now", "then", "there"]

# the same two lists for the ranker; "as" is not in them
RANKER_LAST = (
    "a an and at because by for from in into of on or than that the to with"
).split()
RANKER_SECOND = RANKER_LAST + ["now", "then", "there"]

VERBS = (
    "am are be became become been being called can contains could decoded did "
    "discovered does do found generated generates had has have included is "
    "issued known launched lies may might must orbits provided should study "
    "took use used uses was were will would"
).split()

PERSON_CLUES = "named soldier scholar king queen scientist inventor".split()
PERSON_CLUES_FREE = PERSON_CLUES + ["author", "writer"]

GEO_WORDS = (
    "city town village country island river street avenue road university "
    "college museum park ocean sea lake mountain"
).split()

SUFFIX_STOP_STARTS = (
    "because since although though unless until while as after before when "
    "whenever which that who whose where whereby and but or so yet"
).split()

DEFINITION_TRIGGERS = ["known as", "called", "referred to as", "named after"]
COPULA_STARTS = (
    "it is|it was|they are|they were|this is|this was|he is|she is"
)
LONE_ADVERBS = (
    "famously commonly also often widely generally typically sometimes "
    "officially simply popularly formally colloquially informally known"
).split()
BARE_PRONOUNS = "it he she they this that these those".split()

AUXILIARIES = (
    "was is were are has have had will would could should did does do"
).split()

DEGREE_CUES = ["degree", "mba", "phd", "ph.d", "bachelor", "master", "diploma"]

NULL_WORDS = ["nan", "none", "null"]
OPTION_CHARS = 220

FIXED_FILLERS = ["related detail", "background fact", "supporting idea", "none of these"]
CONSTANT_NEGATIVES = ["object", "thing", "unknown", "item"]

# ---- fixed values: patterns ---------------------------------------------

DATE_RE = r"\b(?:\d{4}|\d+\s*BC|[A-Z][a-z]+\s+\d{4})\b"
ACRONYM_RE = r"\b[A-Z]{2,}\b"
POSSESSIVE_RE = r"\b([A-Z][a-z]{3,})'s\b"
PROPER_RE = (
    r"\b(?:[A-Z][a-z]+(?:-[A-Z][a-z]+)?(?:'s)?\s+){1,5}"
    r"[A-Z][a-z]+(?:-[A-Z][a-z]+)?(?:'s)?\b"
)
DEFINITION_HEAD = (
    r"(?i)\b(?:known as|called|referred to as|named after)\s+"
    r"((?:the\s+|a\s+|an\s+)?[a-zA-Z][a-zA-Z\s'\-]{3,50}?)"
)
DEFINITION_TAIL = r"\s*(?:[,.]|because|since|which|that|$)"
DEFINITION_RE = DEFINITION_HEAD + "(?=" + DEFINITION_TAIL + ")"
LOCATION_RE = (
    r"\b(?:in|at|near|from|within)\s+"
    r"((?:the\s+)?[A-Z][a-zA-Z]+(?:\s+of\s+[A-Z][a-zA-Z]+|(?:\s+[A-Z][a-zA-Z]+){0,3}))"
)
KEYWORD_RE = r"\b[a-zA-Z]{7,}\b"
HYPHEN_NAME_RE = r"\b[A-Z][a-z]+-[A-Z][a-z]+\b"
REFERENT_RE = r"\b[A-Z][a-z]{3,}(?:\s+[A-Z][a-z]+)*\b"
FULL_DATE_RE = r"^(?:\d{4}|\d+\s*BC|[A-Z][a-z]+\s+\d{4})$"
FULL_DATE_LOWER_RE = r"^(?:\d{4}|\d+\s*bc|[a-z]+\s+\d{4})$"
FULL_NUMBER_RE = r"^\d[\d\s,.\-/]*$"
FULL_ACRONYM_RE = r"^[A-Z]{2,}$"
FULL_PROPER_RE = r"^[A-Z][a-z]+(?:-[A-Z][a-z]+)?(?:\s+[A-Z][a-z]+(?:-[A-Z][a-z]+)?){0,4}$"
WH_PREPOSITION_RE = r"(?i)\b(what|who|where|when|why|how)\s+(from|of|in|on|to|for)\b"
DATE_WORD_RE = (
    r"(?i)\b(\d{4}|\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}|january|february|march|april|may|june|"
    r"july|august|september|october|november|december)\b"
)

# ---- fixed values: scores -------------------------------------------------

BASE_SCORE = {
    "date": 4.2,
    "acronym": 3.8,
    "person": 3.6,
    "properNoun": 4.8,
    "definition": 5.2,
    "location": 4.5,
    "keyword": 2.0,
}
WORD_BONUS = 0.4
WORD_BONUS_LIMIT = 4
SENTENCE_DECAY = 0.1
NAMED_BONUS = 1.5
HYPHEN_BONUS = 0.8
GOLD_SCORE = 7.5
MANUAL_SCORE = 10.0
ANSWER_RANK_COST = 0.05

TEMPLATE_BIAS = {
    "definition": 1.20,
    "where_wh": 1.10,
    "suffix_wh": 1.00,
    "cloze": 0.55,
    "generic_wh": 0.08,
}

OPTION_WEIGHTS = {"retrieval": 0.42, "model": 0.24, "type": 0.18, "length": 0.12}
OWN_PASSAGE_BONUS = 0.12
VERIFIER_WEIGHT = 0.16
VERIFIER_POOL = 24
SIMILAR_LIMIT = 0.82
RETRIEVAL_LIMIT = 180
TIE_TOLERANCE = 0.003
BUNDLE_POOL = 6

STAGES = ["strict", "retrieved", "relaxed", "last_resort"]
QUALITY_SCORE = {"strict": 4.0, "retrieved": 3.0, "relaxed": 2.0, "last_resort": 1.0}
VERIFIER_BONUS = 0.35
QUESTION_SCORE_SHARE = 0.05

# correct category, other category, score when categories may differ
RELAXED_PAIRS = [
    ("term", "definition", 0.65),
    ("term", "statement", 0.65),
    ("definition", "term", 0.65),
    ("definition", "statement", 0.65),
    ("statement", "term", 0.65),
    ("statement", "definition", 0.65),
    ("properNoun", "term", 0.55),
    ("educationDegree", "term", 0.45),
    ("educationDegree", "statement", 0.45),
]

# categories searched for a correct answer of the given category
SEARCH_CATEGORIES = {
    "term": ["term", "definition", "statement"],
    "definition": ["term", "definition", "statement"],
    "statement": ["term", "definition", "statement"],
    "properNoun": ["properNoun", "term"],
}

GENERIC_QUESTIONS = {
    "date": "When did the event described in the passage take place?",
    "person": "Who is being described in the passage?",
    "other": "What is being described in the passage?",
}
CLOZE_PREFIX = "Which answer best completes this sentence: "
BLANK = "_____"
HINT_BLANK = "__________"

TARGET_WEIGHTS = {"unigram": 0.65, "bigram": 0.25, "wh": 0.10}
WRONG_ANSWER_FACTOR = 0.35
CLOZE_FACTOR = 0.55
BAD_QUESTION_FACTOR = 0.20
POSITIVE_THRESHOLD = 0.22
NEGATIVE_THRESHOLD = 0.08
CLEAR_POSITIVE_STEP = 0.08
CLEAR_POSITIVE_FLOOR = 0.45

VOCABULARY_SIZE = 20_000
CORPUS_VOCABULARY_SIZE = 60_000

VERIFIER_FEATURES = [
    "tfidf_cosine_sim",
    "unigram_overlap_ratio",
    "idf_weighted_score",
    "best_sentence_overlap",
    "bigram_overlap_ratio",
    "exact_match_flag",
    "option_token_length",
    "option_char_length",
    "first_position",
    "is_number",
    "kmeans_cluster_label",
    "kmeans_centroid_dist",
]

RANKER_FEATURES = [
    "question_word_count",
    "question_char_count",
    "starts_with_wh",
    "is_cloze",
    "has_blank",
    "contains_answer_text",
    "has_verb_like_token",
    "second_word_bad",
    "trailing_word_bad",
    "double_punctuation",
    "wh_who",
    "wh_what",
    "wh_when",
    "wh_where",
    "wh_why",
    "wh_how",
    "wh_which",
    "answer_kind_date",
    "answer_kind_person",
    "answer_kind_acronym",
    "answer_kind_proper_noun",
    "answer_kind_keyword",
    "wh_matches_answer_kind",
    "answer_candidate_score",
    "answer_word_count",
    "source_sentence_index",
    "source_sentence_position",
    "source_sentence_word_count",
    "answer_position_in_sentence",
    "words_before_answer",
    "words_after_answer",
    "question_source_unigram_overlap",
    "question_article_unigram_overlap",
    "question_source_bigram_overlap",
    "model_a_correct_score",
    "model_a_best_other_score",
    "model_a_margin",
    "model_a_correct_rank",
    "model_a_score_spread",
]

DISTRACTOR_FEATURES = ["edit_distance", "length_difference", "in_article", "lexical_cosine"]

# English stop words of the corpus vocabulary (short common function words)
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because "
    "been before being below between both but by can cannot could did do does "
    "doing down during each few for from further had has have having he her "
    "here hers herself him himself his how i if in into is it its itself me "
    "more most my myself no nor not of off on once only or other our ours "
    "ourselves out over own same she should so some such than that the their "
    "theirs them themselves then there these they this those through to too "
    "under until up very was we were what when where which while who whom why "
    "will with would you your yours yourself yourselves"
).split()
