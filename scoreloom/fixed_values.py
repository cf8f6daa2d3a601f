"""Fixed values that results must agree on: enumerations, labels, rules, patterns."""

# Match statuses, in the order the upstream feed documents them.
STATUSES = (
    "SCHEDULED", "TIMED", "IN_PLAY", "PAUSED", "EXTRA_TIME", "PENALTY_SHOOTOUT",
    "FINISHED", "SUSPENDED", "POSTPONED", "CANCELLED", "AWARDED",
)
UPCOMING = ("TIMED", "SCHEDULED", "IN_PLAY")
FINISHED = "FINISHED"
SHOOTOUT = "PENALTY_SHOOTOUT"
WINNERS = ("HOME_TEAM", "AWAY_TEAM", "DRAW")

# Stages in playing order with display label, short label and how far
# reaching that stage counts (the third-place match counts as deep as a semi-final).
GROUP_STAGE = "GROUP_STAGE"
STAGE_ROWS = (
    # stage, order, label, short label, depth
    ("GROUP_STAGE", 0, "Group stage", "Groupes", 0),
    ("LAST_32", 1, "Round of 32", "16es", 1),
    ("LAST_16", 2, "Round of 16", "8es", 2),
    ("QUARTER_FINALS", 3, "Quarter-finals", "Quarts", 3),
    ("SEMI_FINALS", 4, "Semi-finals", "Demies", 4),
    ("THIRD_PLACE", 5, "Third place", "3e place", 4),
    ("FINAL", 6, "Final", "Finale", 5),
)
STAGES = tuple(row[0] for row in STAGE_ROWS)
KNOCKOUT = STAGES[1:]
TITLE_PATH = ("LAST_32", "LAST_16", "QUARTER_FINALS", "SEMI_FINALS", "FINAL")
UNKNOWN_STAGE_ORDER = 99
REACH_LEVELS = ("Entrée", "8es", "Quarts", "Demies", "Finale", "Titre")

# Full stage names and short month names used in French display strings.
STAGE_NAMES_FR = {
    "GROUP_STAGE": "Phase de groupes",
    "LAST_32": "16es de finale",
    "LAST_16": "8es de finale",
    "QUARTER_FINALS": "Quarts de finale",
    "SEMI_FINALS": "Demi-finales",
    "THIRD_PLACE": "Match pour la 3e place",
    "FINAL": "Finale",
}
MONTHS_FR = (
    "JANV", "FÉVR", "MARS", "AVR", "MAI", "JUIN",
    "JUIL", "AOÛT", "SEPT", "OCT", "NOV", "DÉC",
)

# Points rule.
POINTS_WIN, POINTS_DRAW = 3, 1

# Source spelling -> canonical team name (statistics CSV).
TEAM_ALIASES = {
    "Bosnia–Herz": "Bosnia-Herzegovina",
    "Cabo Verde": "Cape Verde Islands",
    "Côte d'Ivoire": "Ivory Coast",
    "IR Iran": "Iran",
    "Korea Republic": "South Korea",
    "Türkiye": "Turkey",
}

# Display marks.
EN_DASH = "–"
SHOOTOUT_MARK = "t.a.b."

# Rating model.
RIDGE = 0.05
MAX_GOALS = 10
UNKNOWN_PAIR_PROBABILITY = 0.5

# Freshness limits in hours.
WARN_AFTER_HOURS, ERROR_AFTER_HOURS = 26, 48
