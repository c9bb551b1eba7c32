"""Results are only right when these stay exactly as they are."""

# Languages a run may track; a run tracks three of them by default.
LANGUAGES = (
    "Python",
    "Java",
    "JavaScript",
    "TypeScript",
    "CPP",
    "CSharp",
    "C",
    "PHP",
    "Go",
    "Ruby",
)
TRACKED = ("Python", "Java", "C")

# Characters removed from a description before it is cut into words.
NON_LETTERS = "[^a-zA-Z ]"
# The same as whole runs, spelt with the ASCII class that Java looks up in a table; this halves
# the time spent in the pattern.
NON_LETTER_RUNS = r"[^\p{Alpha} ]+"

# Push times on the wire are UTC with a literal Z.
PUSHED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
CLOCK_FORMAT = "HH:mm:ss"

# A description or language that was missing when captured as plain text.
MISSING_TEXT = "None"

RECENT_SECONDS = 60
TOP_WORDS = 10
HISTORY_LENGTH = 10
PREVIEW_ROWS = 10
PAGE_SIZE = 50
POLL_SECONDS = 15
BATCH_SECONDS = 60

# Number stream: divisor, label texts, batch and window length, drawing range.
DIVISOR = 9
DIVISIBLE, NOT_DIVISIBLE = "Yes", "No"
NUMBER_BATCH_SECONDS = 2
NUMBER_WINDOW_SECONDS = 20
NUMBER_LATENESS = "1 minute"
NUMBER_MAX = 1_000_000_000

# Age labels of the unsplit recency count.
OLD, RECENT = "old", "recent"

# Two-column random table: size and exclusive upper bound of the values.
TABLE_ROWS = 1_000_000
TABLE_BOUND = 999
RAISE_B = 10_000
