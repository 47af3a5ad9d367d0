"""Words, codes and texts that results must carry exactly. Fixed values."""

from __future__ import annotations

# Commute modes as declared, and the travel mode each one is routed with.
WALKING_MODE = "Marche/running"
CYCLING_MODE = "Vélo/Trottinette/Autres"
TRAVEL_MODES = {
    WALKING_MODE: "WALK",
    CYCLING_MODE: "BICYCLE",
}

# Spelling corrections for sports, lower-case spelling to label.
SPORT_SPELLINGS = {"runing": "Course à pied"}

# Business parameters.
BONUS_RATE = "bonus_rate"
ACTIVITY_THRESHOLD = "wellbeing_activity_threshold"
WELLBEING_DAYS = "wellbeing_days"
MAX_WALKING_KM = "max_commute_distance_walking_km"
MAX_CYCLING_KM = "max_commute_distance_cycling_km"
COMMUTE_PARAMETERS = (BONUS_RATE, MAX_WALKING_KM, MAX_CYCLING_KM)
WELLBEING_PARAMETERS = (ACTIVITY_THRESHOLD, WELLBEING_DAYS)
PARAMETER_NAMES = (BONUS_RATE, ACTIVITY_THRESHOLD, WELLBEING_DAYS, MAX_WALKING_KM, MAX_CYCLING_KM)

# Initial parameter versions (name, value, first day, comment), open-ended.
INITIAL_PARAMETERS = (
    (BONUS_RATE, "0.05", "2025-06-20", "Taux initial de la prime sportive"),
    (ACTIVITY_THRESHOLD, "15", "2025-06-20", "Nombre minimal d activités sur douze mois"),
    (WELLBEING_DAYS, "5", "2025-06-20", "Nombre de jours bien-être accordés"),
    (MAX_WALKING_KM, "15", "2025-06-20", "Distance maximale marche ou course à pied"),
    (MAX_CYCLING_KM, "25", "2025-06-20", "Distance maximale vélo, trottinette ou autre"),
)
CLOSED_RATE_COMMENT = "Taux initial de la prime sportive, clôturé avant révision"
REVISED_RATE_COMMENT = "Taux révisé de la prime sportive"
RATE_BOUNDS = ("0.01", "1.00")

# Outcome codes of the commute bonus, in the order they are decided.
PARAMETERS_NOT_AVAILABLE = "PARAMETERS_NOT_AVAILABLE"
NOT_ACTIVE_COMMUTE_DECLARED = "NOT_ACTIVE_COMMUTE_DECLARED"
ROUTE_INVALID_OR_MISSING = "ROUTE_INVALID_OR_MISSING"
DISTANCE_ABOVE_LIMIT = "DISTANCE_ABOVE_LIMIT"
ELIGIBLE = "ELIGIBLE"

# Publication states and the error left by an expired claim.
PENDING = "PENDING"
IN_PROGRESS = "IN_PROGRESS"
PUBLISHED = "PUBLISHED"
ERROR = "ERROR"
BACKFILLED = "BACKFILLED"
PUBLICATION_STATUSES = (PENDING, IN_PROGRESS, PUBLISHED, ERROR, BACKFILLED)
STALE_CLAIM_ERROR = "STALE_IN_PROGRESS_CLAIM"
ERROR_TEXT_LENGTH = 2000
DEFAULT_STALE_MINUTES = 15

# Status texts stored with a captured route response.
REQUEST_ERROR = "REQUEST_ERROR"
NO_ROUTE = "NO_ROUTE"
ROUTE_SOURCE = "google_routes_api"

# Error texts of a captured delivery response and of its link response.
INVALID_JSON_RESPONSE = "INVALID_JSON_RESPONSE"
DELIVERY_ERROR = "SLACK_ERROR"
MISSING_DELIVERY_FIELDS = "missing_channel_or_message_ts"
LINK_ERROR_PREFIX = "PERMALINK_"
MISSING_LINK = "missing_permalink"
UNKNOWN_ERROR = "unknown_error"

# Announcement texts.
ANNOUNCEMENT_TITLE = "Nouvelle activité sportive"
NOT_GIVEN = "non renseignée"
