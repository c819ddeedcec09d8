"""Fixed values of the text jobs: word lists, weights and rule tables."""

# Sentiment: word scores, smoothing constant, label bounds, escalation threshold.
SENTIMENT = {
    "late": -1.2, "damaged": -1.9, "great": 3.1, "bad": -2.5, "superb": 3.0, "terrible": -2.9, "ridiculous": -2.1, "love": 3.2,
}
# Words of the sample corpus (its vocabulary is invented apart from the insults).
SAMPLE_SENTIMENT = {
    **SENTIMENT,
    "trash": -1.9, "scum": -2.1, "idiot": -2.1, "clown": -1.2, "worthless": -2.5, "moron": -2.1, "pathetic": -2.5,
    "loser": -1.9, "disgusting": -2.9, "stupid": -1.9,
    "thanea": 1.2, "theaeati": 1.9, "onanshat": 1.9, "licensed": 1.2, "heet": 1.2, "avec": 1.2, "nicht": -1.2,
}
ALPHA = 15
LABEL_BOUND = 0.05
ESCALATE_BELOW = -0.6
NEGATIONS = ["not", "no", "never", "nicht", "pas"]

# Classification: label -> term weights, for the sample corpus.
TOPIC_TERMS = {
    "abuse": {w: 3.0 for w in ["trash", "scum", "idiot", "clown", "worthless", "moron", "pathetic", "loser", "disgusting", "stupid"]},
    "account": {"mail": 2.0, "example": 2.0, "token": 3.0, "thon": 1.0},
    "billing": {"than": 1.0, "thth": 1.0, "ofthe": 1.0, "eau": 1.0},
    "delivery": {"ther": 1.0, "ering": 1.0, "keit": 1.0, "ment": 1.0},
    "legal": {"licensed": 3.0, "license": 3.0, "apache": 2.0, "rights": 1.0},
    "product": {"ing": 1.0, "tion": 1.0, "heit": 1.0, "ado": 1.0},
}
# Described labels: description and a few example texts per label.
DESCRIBED_LABELS = {
    "legal": {"description": "text under a license or with licensed rights", "examples": ["licensed under the apache license"]},
    "abuse": {"description": "insults: idiot, moron, loser, clown", "examples": ["what a pathetic stupid idiot", "worthless trash"]},
    "contact": {"description": "holds an address like mail at example com", "examples": ["write to mail at example com"]},
    "general": {"description": "ordinary prose with that this with from", "examples": ["from this and with that"]},
}
ROUTING = {"abuse": "trust", "account": "identity", "billing": "finance", "delivery": "logistics", "legal": "legal", "product": "support"}
# Severity cues: level -> words.
SEVERITY = {3: ["disgusting", "scum"], 2: ["worthless", "trash", "moron"], 1: ["clown", "loser", "token"]}
CHURN_CUES = ["pathetic", "stupid"]
SUPPORT_CUES = ["mail", "token", "license"]
# Clause risk: cue weights and bands; obligation words.
CLAUSE_CUES = {"nter": 1.0, "erent": 1.0, "thea": 2.0, "an": 0.5, "inger": 2.0, "ofthe": 1.0}
OBLIGATION_CUES = ["shall", "must", "ther", "than"]
# Aspects: name -> cue words (at most 10 aspects of at most 30 characters).
ASPECTS = {"delivery": ["ther", "ering", "ment", "keit"], "price": ["than", "thth", "eau"], "quality": ["tion", "ing", "heit"]}

# Language profiles: frequent function words.
LANGUAGE_PROFILES = {
    "de": ["der", "die", "und", "von", "den", "zu", "mit", "das", "auf", "nicht", "ist", "ein", "eine", "sich"],
    "en": ["the", "and", "of", "to", "a", "is", "that", "it", "was", "for", "with", "this", "are", "by"],
    "es": ["el", "los", "del", "las", "para", "con", "su", "por", "una", "que", "y", "se", "no", "lo"],
    "fr": ["la", "et", "le", "des", "les", "du", "pour", "une", "est", "que", "qui", "dans", "pas", "sur"],
}

# Prices per million tokens, and characters and words per token.
PRICE_IN, PRICE_OUT = 3.0, 15.0
CHARS_PER_TOKEN, WORDS_PER_TOKEN = 4, 0.75
PIECE_PATTERN = r"[\p{L}]{1,6}|[0-9]{1,3}|[^\s\p{L}0-9]"

# Intents: (priority, intent, terms); the first rule with a hit wins.
INTENTS = [
    (1, "abuse", ["trash", "idiot", "stupid", "moron", "scum", "clown"]),
    (2, "account", ["token", "mail", "license"]),
    (3, "compare", ["than", "thth", "que"]),
    (4, "explain", ["ther", "tion", "keit", "ment"]),
]
