"""Fixed values that must equal the behaviour being matched.

Everything in this module is data, not logic: the cell tokens a CSV reader
treats as missing, the header hints used to find each logical column, the
answer prefixes that count as "experienced", chart colour lists, and the
filler answers set aside before theming.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference behaviour exactly)
# ---------------------------------------------------------------------------

# Cells exactly equal to one of these become null when an export is read
# (the default missing-value tokens of the pandas CSV reader).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Logical keys in output order, with the header hints tried in order.
COLUMN_HINTS = {
    "order_date": ["order date"],
    "attendee_status": ["attendee status"],
    "ticket_type": ["ticket type"],
    "total_paid": ["total paid"],
    "role": ["role", "best describes", "which industry"],
    "experience": ["experience", "how would you describe"],
    "session_goals": ["most like to get", "get from this session", "最希望从本次"],
    "speaker_q": ["speaker", "question for", "ask the guest", "love to ask", "guest"],
    "future_topics": ["topic", "future", "explore"],
}
KEYS = list(COLUMN_HINTS)

# Answers whose lower-cased text starts with one of these count as experienced.
EXPERIENCED_LABELS = ["Regular user", "Intermediate", "Advanced", "Expert"]

# Status text (after trimming, case-sensitive) that counts as attending.
ATTENDING = "Attending"

# Separators tried in order when shortening a chart label, and the word cap.
SHORTEN_SEPARATORS = [" — ", " – ", " - "]
SHORTEN_MAX_WORDS = 6
ELLIPSIS = "…"

# Bar colours by rank position; positions past the end use BAR_DEFAULT.
BAR_PALETTE = [
    "var(--jade)", "var(--jade)", "var(--sage)", "var(--amber)",
    "var(--amber)", "var(--plum)", "var(--grey-bar)", "var(--grey-bar)",
    "var(--grey-bar)", "var(--grey-bar)",
]
BAR_DEFAULT = "var(--grey-bar)"
# Donut segment colours, cycled by position.
DONUT_PALETTE = [
    "var(--jade)", "var(--amber)", "var(--plum)", "var(--sage)", "var(--grey-bar)",
]
# Role / goal bar colours in the page script, cycled by position.
ROLE_PALETTE = [
    "var(--jade)", "var(--jade)", "var(--sage)", "var(--amber)",
    "var(--amber)", "var(--plum)", "var(--grey-bar)", "var(--grey-bar)",
]

# Fixed row labels and sentences.
NO_ANSWER_LABEL = "No answer"
BLANK_TOPICS_LABEL = "No specific ask / blank"
DEFAULT_TICKET_TYPES = "General Admission"
MONEY_FREE = "Free ($0 AUD)"
MONEY_SUFFIX = " AUD collected"

# Filler answers set aside before theming (compared after lower-casing,
# trimming and dropping trailing punctuation).  The first eight are the ones
# the reference names; the rest are plain variants of them.
FILLER_ANSWERS = [
    "n/a", "none", "no", "nothing", "just curious", "no questions for now",
    "无", "没有",
    "na", "nil", "nope", "no question", "no questions", "not really",
    "nothing yet", "暂无", "没有问题",
]
# Trailing punctuation dropped before the filler comparison.
FILLER_TRAILING_PUNCT = ".!?。！？…"

# Theme contract limits (title words, quotes per theme, themes per list).
THEME_MAX_TITLE_WORDS = 6
THEME_MAX_QUOTES = 3
THEME_MAX_COUNT = 6
THEME_MIN_COUNT = 4

# Insight sentence length cap.
INSIGHT_MAX_CHARS = 160

# Report sentences (fixed wording of the report's fill-in text).
KPI_ATTENDING_SUFFIX = "% confirmed Attending"
KPI_PEAK_SUFFIX = "% of all registrations landed in one day"
KPI_EXPERIENCED_SUFFIX = " attendees reported regular or advanced AI use"
KPI_QUESTIONS_SUFFIX = " attendees — answers like “no” or “n/a” not counted"
ROLE_MULTI_SUFFIX = " attendees selected more than one role — counts reflect every role picked."
ROLE_SINGLE = "Each attendee selected a single role."
SPEAKERQ_DESC_SUFFIX = (" attendees asked a question. Grouped by similarity, ranked by how many asked something "
                        "similar — up to 3 representative questions per cluster, ready to read out.")
TOPICS_DESC_CHOICES = "Options picked on the form; attendees could pick more than one. "
TOPICS_DESC_THEMES = "From the future-topics question only, tagged by theme. "
TOPICS_DESC_BLANK = '"No specific ask / blank" covers unanswered entries.'
TITLE_SUFFIX = " · Registration Dashboard"
