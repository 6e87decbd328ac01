"""Fixed values of the transcript rules: patterns, weights, phrases and thresholds that results depend on."""

# fixed values: speaker prefixes, in order of trial
SPEAKER_PATTERNS = [
    r"^\s*([^\(]{3,50})\s*\(([^)]+)\)\s*\.\s*[-–−]\s*",
    r"^\s*([^\(]{3,50})\s*\(([^)]+)\)\s*\.?\s*[-–−]\s*",
    r"^\s*([^\.\(]{3,50})\s*\.\s*[-–−]\s*",
    r"^\s*([^-–−\(]{3,50})\s*[-–−]\s*",
    r"^\s*([^:]{3,80})\s*:\s*",
    r"^\s*<(?:strong|b)>\s*([^<]+?)\s*</(?:strong|b)>\s*[:\-–−]?\s*",
    r"^\s*((?:The\s+)?President(?:\s+of\s+the\s+European\s+Parliament)?)\s*[.\-–−:]\s*",
    r"^\s*(Vice-President\s+[A-Za-züäöüúéèàâêîôûç\-'\s]+)\s*[.\-–−:]\s*",
]
WITH_PARTY = (0, 1)
NOT_A_SPEAKER = ["written statements", "voting time", "next item", "the sitting", "the session", "order of business"]

# fixed values: beginnings of procedural lines
PROCEDURAL_PATTERNS = [
    r"^(?:The\s+)?(?:sitting|session|meeting)\s+(?:is\s+)?(?:opened|closed|suspended|resumed|adjourned)",
    r"^(?:The\s+)?debate\s+(?:is\s+)?(?:opened|closed|suspended)",
    r"^(?:We\s+)?(?:shall|will)\s+(?:now\s+)?(?:proceed|continue|move)",
    r"^(?:Madam|Mr)\s+President(?:\s+of\s+the\s+Commission)?",
    r"^(?:The\s+)?President\b",
    r"^Ladies\s+and\s+gentlemen",
    r"^Honourable\s+Members",
    r"^Dear\s+colleagues",
    r"^Voting\s+time",
    r"^(?:The\s+)?vote\s+(?:is\s+)?(?:taken|called|conducted)",
    r"^Question\s+Time",
    r"^Written\s+statements?",
    r"^Procedures?\s+without\s+debate",
    r"^Explanations?\s+of\s+votes?",
    r"^Corrections?\s+to\s+votes?",
    r"^Next\s+item(?:\s+on\s+the\s+agenda)?",
    r"^Order\s+of\s+business",
    r"^(?:The\s+)?agenda\s+(?:is\s+)?(?:adopted|approved)",
    r"^(?:That\s+)?concludes\s+(?:the\s+)?(?:debate|item)",
    r"^\([^)]*(?:applause|laughter|protests?|shouts?|interruption)[^)]*\)",
    r"^\([^)]*(?:mixed\s+reactions|uproar|noise)[^)]*\)",
    r"^\((?:The\s+)?sitting\s+(?:was\s+)?(?:suspended|interrupted)",
    r"^(?:The\s+)?sitting\s+(?:opened|closed|suspended|resumed)\s+at\s+\d",
    r"^It\s+is\s+now\s+\d{1,2}[:.]\d{2}",
    r"^At\s+\d{1,2}[:.]\d{2}",
    r"^I\s+call\s+(?:upon|on)\s+(?:the\s+)?(?:Commission|Council|rapporteur)",
    r"^Point\s+of\s+order",
    r"^Blue\s+card\s+question",
    r"^(?:Catch-the-eye|Blue-card)\s+procedure",
]
PROCEDURAL_KEYWORDS = [
    "applause", "laughter", "interruption", "mixed reactions", "uproar", "protests", "shouts", "silence", "sitting opened",
    "sitting closed", "sitting suspended", "voting time", "vote is taken", "unanimously adopted", "next item", "debate is closed", "that concludes",
]

# fixed values: time hints, in order of trial, with the group that holds the time
TIME_PATTERNS = [
    (r"\b(\d{1,2}[:.]\d{2})\s*(?:hrs?|hours?)?\b", 1),
    (r"\b(\d{1,2}h\d{2})\b", 1),
    (r"\((The\s+sitting\s+(?:opened|closed|suspended|resumed)\s+at\s+(\d{1,2}[:.]\d{2}))\)", 2),
    (r"at\s+(\d{1,2}[:.]\d{2})", 1),
    (r"\b(\d{1,2}[:.]\d{2})\s*([ap]\.?m\.?)\b", 1),
    (r"(?:opened|closed|suspended|resumed)\s+at\s+(\d{1,2}[:.]\d{2})", 1),
]

# fixed values: weighted patterns of the classifier by group
CLASSIFIER = {
    "session": [
        (r"\bsitting.*(?:opened|begins?|starts?)\b", 0.95),
        (r"\bsitting.*(?:closed|ends?|adjourned?)\b", 0.95),
        (r"\bsitting.*(?:suspended?|resumed?|interrupted?)\b", 0.90),
        (r"\bsession.*(?:begins?|starts?|opens?)\b", 0.85),
        (r"\bsession.*(?:ends?|closes?|adjourns?)\b", 0.85),
        (r"\b(?:good morning|good afternoon|good evening)\b.*colleagues", 0.80),
        (r"\bbreak.*(?:minutes?|lunch|coffee)\b", 0.75),
    ],
    "voting": [
        (r"\bvoting\s+time\b", 0.95),
        (r"\bvote\s+(?:on|is taken|now)\b", 0.90),
        (r"\bvoting\s+list\b", 0.90),
        (r"\bvoting\s+results?\b", 0.85),
        (r"\b(?:adopted|rejected).*(?:unanimously|majority)\b", 0.85),
        (r"\bexplanations?\s+of\s+votes?\b", 0.80),
        (r"\bcorrections?\s+to\s+votes?\b", 0.80),
        (r"\broll.*call.*vote\b", 0.75),
    ],
    "agenda": [
        (r"\bnext\s+item.*agenda\b", 0.95),
        (r"\bdebate\s+on.*(?:report|proposal|question)\b", 0.90),
        (r"\breport\s+by.*(?:mr|mrs|ms)\s+\w+", 0.85),
        (r"\bquestion\s+(?:by|from).*(?:mr|mrs|ms)\s+\w+", 0.85),
        (r"\bstatement\s+by.*(?:commission|council)\b", 0.80),
        (r"\border\s+of\s+business\b", 0.80),
        (r"\bdiscussion\s+on.*", 0.70),
    ],
    "procedural": [
        (r"\bwritten\s+statements?\b", 0.90),
        (r"\bprocedures?\s+without\s+debate\b", 0.90),
        (r"\bi\s+call\s+(?:upon|on)\b", 0.85),
        (r"\brule\s+\d+.*(?:regulation|procedure)\b", 0.80),
        (r"\bmembers?\s+requests?\b", 0.75),
        (r"\bpoint\s+of\s+order\b", 0.85),
    ],
    "speech": [
        (r"\b(?:mr|madam)\s+president.*(?:thank you|i would like)\b", 0.90),
        (r"\bi\s+(?:believe|think|propose|suggest|urge)\b", 0.80),
        (r"\bwe\s+(?:must|should|need to|have to)\b", 0.80),
        (r"\bthis\s+(?:is|shows|demonstrates|proves)\b", 0.75),
        (r"\bin\s+my\s+(?:view|opinion|country)\b", 0.75),
        (r"\blet\s+me\s+(?:say|tell|explain|clarify)\b", 0.70),
        (r"\bi\s+(?:want|wish|hope)\s+to\b", 0.70),
    ],
}
GROUP_CLASS = {"session": "announcement", "voting": "procedural", "agenda": "announcement", "procedural": "procedural", "speech": "speech"}
FEATURE_WEIGHTS = {
    "announcement": [("president_speaker", 0.3)],
    "procedural": [("president_speaker", 0.2), ("short_text", 0.2)],
    "speech": [("short_text", -0.2), ("long_text", 0.3), ("parenthetical", -0.2), ("policy_heavy", 0.4)],
    "interruption": [("parenthetical", 0.4), ("has_interruptions", 0.2)],
}
CLASS_ORDER = ["speech", "announcement", "procedural", "interruption"]
ANNOUNCEMENT_BY_GROUP = [("session", "session_management"), ("voting", "voting_procedure"), ("agenda", "agenda_item"), ("procedural", "procedural_notice")]
OFFICIALS = ["commissioner", "minister", "rapporteur"]
INTERRUPTIONS = ["applause", "laughter", "interruption"]
FORMAL = ["ladies and gentlemen", "honourable members", "distinguished colleagues"]
POLICY = ["regulation", "directive", "amendment", "proposal", "budget", "policy", "legislation"]

# fixed values: phrases of the plain announcement ladder, and of the plain procedural test
ANNOUNCEMENT_PHRASES = {
    "session_management": ["sitting is opened", "sitting is closed", "sitting is suspended", "sitting is resumed", "session begins", "session ends", "break", "adjournment"],
    "voting_procedure": ["voting time", "time to vote", "vote is taken", "vote on", "voting list", "voting results", "unanimously adopted", "rejected"],
    "agenda_item": ["next item", "debate on", "discussion on", "report by", "question by", "statement by", "commission statement"],
    "procedural_notice": ["procedures without debate", "written statements", "i call upon", "order of business", "rule", "regulation"],
}
PROCEDURAL_PHRASES = [
    "sitting is opened", "sitting is closed", "sitting is suspended", "sitting is resumed", "the debate is closed", "next item",
    "voting time", "written statements", "procedures without debate", "i call upon", "the session is adjourned",
]
PLAIN_TIMES = [r"(\d{1,2}[:.]\d{2})\s*[-–]\s*", r"\((\d{1,2}[:.]\d{2})\)", r"at\s+(\d{1,2}[:.]\d{2})", r"(\d{1,2}[:.]\d{2})\s+[AP]M", r"(\d{1,2}h\d{2})"]

# fixed values: errors by type (severity, category, strategy, most retries, back-off factor)
ERROR_TYPES = {
    "ConnectionError": ("medium", "network", "exponential_backoff", 5, 2.0),
    "TimeoutError": ("medium", "network", "linear_backoff", 3, 1.5),
    "AuthenticationError": ("high", "authentication", "manual_intervention", 1, 1.0),
    "TokenExpiredError": ("medium", "authentication", "immediate_retry", 2, 1.0),
    "RateLimitError": ("low", "rate_limit", "linear_backoff", 10, 1.0),
    "DataCorruptionError": ("high", "data_corruption", "checkpoint_restore", 1, 1.0),
    "MemoryError": ("critical", "resource", "graceful_degradation", 1, 1.0),
    "DiskSpaceError": ("high", "resource", "manual_intervention", 0, 1.0),
}
# fixed values: parts of an error's message, in order of trial; other errors are the default
ERROR_MESSAGES = [
    ("connection", ("medium", "network", "exponential_backoff", 3, 2.0)),
    ("timeout", ("medium", "network", "exponential_backoff", 3, 2.0)),
    ("rate limit", ("low", "rate_limit", "linear_backoff", 5, 1.0)),
    ("authentication", ("high", "authentication", "manual_intervention", 1, 1.0)),
]
ERROR_DEFAULT = ("medium", "unknown", "exponential_backoff", 3, 2.0)
SEVERITY_AFTER_RETRIES, MOST_DELAY = 2, 300.0

# fixed values: legal changes of a session's state
TRANSITIONS = {
    "discovered": ("queued", "cancelled"),
    "queued": ("prioritized", "processing", "cancelled"),
    "prioritized": ("processing", "cancelled"),
    "processing": ("completed", "failed", "retry_pending", "paused", "cancelled"),
    "retry_pending": ("processing", "cancelled"),
    "paused": ("queued", "cancelled"),
}

# fixed values: hours that a cached entry is valid, by kind; others one hour; none longer than a week
CACHE_HOURS = {"session_discovery": 24.0, "integration_results": 4.0, "document_links": 6.0, "verbatim_content": 168.0, "parsed_speeches": 72.0, "validation_results": 2.0, "api_responses": 0.5}
OTHER_HOURS, MOST_HOURS, UNUSED_HOURS = 1.0, 168.0, 72.0

# fixed values: addresses of documents, then words in an address, in order of trial
URL_PATTERNS = [
    ("verbatim", r"(?i)https?://www\.europarl\.europa\.eu/doceo/document/[A-Z]+-\d+-\d+-[A-Z]{2}\.html"),
    ("verbatim", r"(?i)https?://www\.europarl\.europa\.eu/doceo/document/[A-Z]+-\d+-\d+-[A-Z]{2}\.pdf"),
    ("verbatim", r"(?i)https?://www\.europarl\.europa\.eu/plenary/[a-z]{2}/vod/"),
    ("agenda", r"(?i)https?://www\.europarl\.europa\.eu/doceo/document/[A-Z]+-\d+-\d+-[A-Z]{2}-AG\.html"),
    ("agenda", r"(?i)https?://www\.europarl\.europa\.eu/plenary/[a-z]{2}/agenda/"),
]
URL_WORDS = [
    ("verbatim", ("verbatim", "cre-")),
    ("agenda", ("agenda", "-ag")),
    ("minutes", ("minutes", "-pv")),
    ("amendment", ("amendment",)),
    ("report", ("report",)),
    ("question", ("question",)),
    ("resolution", ("resolution",)),
]
URL_FORMATS = ("html", "pdf", "xml", "doc", "docx")

# fixed values: patterns of session names, in order of trial, with the names of their groups
SESSION_NAMES = [
    (r"^([A-Z]+)-(\d+)-(\d{4})-(\d{2})-(\d{2})", ("type", "term", "year", "month", "day")),
    (r"^(\d{4})-(\d{2})-(\d{2})", ("year", "month", "day")),
    (r"^(\d+)-(\d+)", ("term", "session")),
]

# fixed values: speakers as they are written, in order of trial, and what a name loses
PRESIDENT = r"(?i)(?:madam|mr|mrs|ms)?\s*president(?:e|a)?"
NAMED_SPEAKERS = [
    ("Commissioner ", r"(?i)commissioner\s+([a-zA-ZÀ-ÿ\s]+)"),
    ("", r"(?i)([a-zA-ZÀ-ÿ\s]+)\s*\([A-Z]{2,4}\)"),
    ("", r"(?i)([a-zA-ZÀ-ÿ\s]+),?\s*rapporteur"),
]
SPEAKER_TITLES = [r"(?i)^(madam|mr|mrs|ms|dr|prof)\s+", r"(?i)\s+(mp|mep|commissioner)$", r"(?i)\([A-Z]{2,4}\)$"]
SPEECH_START = r"^([^.–\-<]*?)(?:\.|\s*–|\s*—)\s*(.*)"
LEAST_SEGMENT = 10

# fixed values: the announcement scorer's classes in order of trial: patterns, roles, context words, words that a short text stays under
ANNOUNCEMENT_RULES = {
    "session_management": (["sitting is (opened|closed|suspended|resumed)", "session (begins|ends)", "break|pause|adjournment"], ["president", "vice-president"], [], 30),
    "voting_procedure": (
        ["voting time|time to vote", "vote (on|is) (taken|called)", "voting list|voting results", "unanimously adopted|rejected"],
        [],
        ["amendment", "proposal", "motion", "resolution"],
        100,
    ),
    "agenda_item": (["next item (on the agenda|is)", "debate on|discussion on", "report by|question by", "commission statement"], [], [], 50),
}
ANNOUNCEMENT_FROM = 0.6

# ---- time mentions: fixed values, in the order of trial ---------------------------------------------

#: format, what it is worth, pattern; letters match in either case
MENTION_PATTERNS = [
    ("hh_mm_ss", 0.9, r"\b([01]?\d|2[0-3]):([0-5]\d):([0-5]\d)\b"),
    ("hh_mm_ss", 0.9, r"\b(\d{1,2})\.([0-5]\d)\.([0-5]\d)\b"),
    ("hh_mm", 0.8, r"\b([01]?\d|2[0-3]):([0-5]\d)\b"),
    ("hh_mm", 0.8, r"\b(\d{1,2})\.([0-5]\d)\b"),
    ("hh_mm", 0.8, r"\b(\d{1,2})h([0-5]\d)\b"),
    ("hh_mm_ss_ampm", 0.85, r"\b(\d{1,2}):([0-5]\d):([0-5]\d)\s*(AM|PM|am|pm)\b"),
    ("hh_mm_ss_ampm", 0.85, r"\b(\d{1,2}):([0-5]\d):([0-5]\d)\s*(A\.M\.|P\.M\.)\b"),
    ("hh_mm_ampm", 0.75, r"\b(\d{1,2}):([0-5]\d)\s*(AM|PM|am|pm)\b"),
    ("hh_mm_ampm", 0.75, r"\b(\d{1,2}):([0-5]\d)\s*(A\.M\.|P\.M\.)\b"),
    ("contextual", 0.6, r"\bat\s+(\d{1,2})\s*(?:hours?\s*)?(?:and\s*)?(\d{1,2})?\s*(?:minutes?)?\b"),
    ("contextual", 0.6, r"\b(?:around|about|approximately)\s+(\d{1,2})(?::(\d{2}))?\b"),
    ("contextual", 0.6, r"\b(?:quarter\s+past|half\s+past|\d+\s+minutes?\s+past)\s+(\d{1,2})\b"),
]
#: where the patterns can begin: clocks by the mark after their first digits, word patterns by the word before the digits,
#: the last one by how long the word before "past" is, or at its own digits
MENTION_MARKS = {":": (0, 2, 5, 6, 7, 8), ".": (1, 3), "h": (4,)}
MENTION_WORDS = {9: ["at"], 10: ["around", "about", "approximately"]}
MENTION_PAST, MENTION_PARTS = 11, (len("quarter"), len("half"))
#: any of these near a mention: PARLIAMENT_BOOST once
PARLIAMENT_TIMES = [
    r"sitting\s+(?:opens?|begins?|starts?)\s+at\s+",
    r"president\s*\.\s*–\s*(?:good\s+morning|the\s+sitting)",
    r"(?:madam|mr)\s+president\s*\.\s*–",
    r"commissioner\s+\w+\s*\.\s*–",
    r"(?:vote|voting)\s+(?:at|begins?)\s+",
]
PARLIAMENT_BOOST, CONTEXT_BOOST = 0.15, 0.1
#: any of a class near a mention: CONTEXT_BOOST once for each class
TIME_CONTEXTS = {
    "session_times": ["sitting.*?(?:opens?|begins?|starts?)", "sitting.*?(?:closes?|ends?|adjourns?)", "session.*?(?:opens?|begins?|starts?)", "session.*?(?:closes?|ends?|adjourns?)"],
    "speech_times": ["at.*?(?:says?|speaks?|states?)", "speaker.*?(?:begins?|continues?)", "(?:mr|mrs|ms|madam).*?president.*?at"],
    "procedural_times": ["vote.*?(?:at|begins?|starts?)", "break.*?(?:at|until)", "recess.*?(?:at|until)", "applause.*?(?:at|lasting)"],
}
#: class, from which score, what it is worth to an association
TIME_CONFIDENCE = [("high", 0.9, 0.95), ("medium", 0.7, 0.8), ("low", 0.5, 0.6), ("estimated", 0.0, 0.3)]
#: words, of these words too, event, else event; the first that fits
TIME_EVENTS = [
    (["sitting opens", "sitting begins", "session starts"], [], "session_start", None),
    (["sitting closes", "sitting ends", "session ends"], [], "session_end", None),
    (["vote", "voting", "ballot"], ["begins", "starts", "at"], "vote_start", "vote_end"),
    (["break", "recess", "adjourn"], ["until", "resume"], "break_start", "break_end"),
]
OTHER_EVENT = "speech_start"
MENTION_REACH, MENTION_CONTEXT, MENTION_BUCKET = 200, 50, 100
#: distance, confidence, speaker near the mention, a speech's start
ASSOCIATION = (0.4, 0.3, 0.2, 0.1)

#: Words of a report, of which two must be there.
REPORT_WORDS = ["plenary", "sitting", "president", "debate", "parliament", "agenda"]

# What stands before a speech, in order of trial; name, then role where there is a second group.
SPEAKER_PREFIXES = [
    r"\A([^(]+?)(?:\s*\(([^)]+)\))?\s*[.–-]\s*",
    r"(?i)\A((?:Mr|Mrs|Ms|Dr|Prof)\s+[^(]+?)\s*(?:\(([^)]+)\))?\s*[:\-–]",
    r"\A([A-Za-z\s]+?):\s*",
    r"(?i)\A<(?:b|strong)>\s*([^<]+?)\s*</(?:b|strong)>\s*[:\-–]",
]
# An announcement in the simple parser, by its role, by any of the patterns, or by too few words.
SIMPLE_ROLES = ["president", "vice-president"]
SIMPLE_ANNOUNCEMENTS = [
    r"the sitting is (opened|closed)",
    r"next item (on the agenda|is)",
    r"voting time",
    r"procedures without debate",
    r"written statements",
    r"i call upon",
    r"the debate is closed",
]
SIMPLE_WORDS = 20
LEAST_SPEAKER, LEAST_TEXT, LEAST_CONFIDENCE = 2, 10, 0.1

# Speaking time. Words a minute, sounds that add a fifth, words that add a tenth, minutes at least.
WORDS_A_MINUTE, LEAST_MINUTES = 150, 0.5
PAUSES, QUESTIONS = ["applause", "laughter", "interruption", "mixed reactions"], ["question", "answer", "mr president"]
# How dates are written, in order of trial.
DATE_FORMATS = ["yyyy-M-d", "d/M/yyyy", "d.M.yyyy", "d MMMM yyyy", "MMMM d, yyyy"]
# Fixed value: days of a range at least.
LEAST_DAYS = 7
