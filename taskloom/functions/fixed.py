"""Severities, allowed operations, phrases and limits that results depend on, as plain data."""

# --- fixed values: severity levels ---------------------------------------------------------------------------------
LEVELS = ("minor", "moderate", "major", "critical")
LAG_MIN = {"minor": 1, "moderate": 3, "major": 8, "critical": 24}
LAG_EXTRA = {"minor": 48, "moderate": 24, "major": 12, "critical": 4}
DURATION_DELTA = {"minor": 1, "moderate": 2, "major": 4, "critical": 6}
WINDOW_DIVISOR = {"minor": 8, "moderate": 5, "major": 3, "critical": 2}
BUDGET_DIVISOR = {"minor": 10, "moderate": 5, "major": 3, "critical": 2}
#: numerators over the critical path in tenths: first and last start of a downtime
START_BAND = {"early": (0, 2), "mid": (4, 6), "late": (7, 9)}

# --- fixed values: operations by constraint type -------------------------------------------------------------------
ALLOWED_OPS = {
    "TYPE-A": ("reduce_capacity", "freeze_resource", "enforce_time_lag", "add_precedence", "alter_objective"),
    "TYPE-B": ("reduce_capacity", "alter_mode_profile", "restrict_modes", "add_mode", "reduce_nonrenewable_budget", "alter_objective"),
    "TYPE-C": ("reduce_capacity", "freeze_resource", "enforce_time_lag", "add_precedence", "alter_objective"),
}
REQUIRED_KEYS = {
    "reduce_capacity": ("resource",), "freeze_resource": ("resource",), "enforce_time_lag": ("i", "j"),
    "alter_mode_profile": ("activity_id", "mode_id"), "restrict_modes": ("activity_id", "remove_mode_ids"),
}
RELATIONS = ("FS", "SS", "FF", "SF")
OBJECTIVES = ("minimize_makespan", "minimize_weighted_tardiness", "minimize_resource_cost", "maximize_robustness_margin")

# --- fixed values: phrases that count as evidence ------------------------------------------------------------------
DOWNTIME_PHRASES = (
    "offline", "unavailable", "shutdown", "down", "capacity reduced", "capacity cut", "failure", "malfunction", "breakdown", "out of service",
    "contamination", "maintenance", "repair", "reduced by", "drops to", "limited to", "coolant failure", "power outage", "blocked",
)
LAG_PHRASES = {
    "FS": (
        r"must wait", r"cannot start until", r"after.*finish", r"minimum.*gap", r"\blag\b", r"\bdelay\b", r"cool(?:ing)?", r"cur(?:e|ing)", r"dry(?:ing)?",
        r"decontaminat", r"steriliz", r"separation", r"must not start before", r"at least.*hour", r"\bbuffer\b", r"mandatory gap", r"waiting period",
        r"must start within", r"no later than", r"time window", r"within.*hour", r"cannot be delayed",
    ),
    "SS": (r"start.*together", r"simultaneously", r"at the same time", r"concurrent", r"must begin.*when", r"same.*start", r"coordinated start"),
    "FF": (r"finish.*together", r"complete.*simultaneously", r"must end.*before.*end", r"finish.*within.*of.*finish", r"completion.*window"),
}
OBJECTIVE_PHRASES = {
    "minimize_weighted_tardiness": ("penalty", "deadline", "late", "overdue", "minimize.*delay", "due date", "tardiness", "priority", "weighted", "urgent"),
    "minimize_resource_cost": ("cost", "budget", "expense", "minimize.*resource", "resource.*cost", "cheaper", "economical"),
    "maximize_robustness_margin": ("robust", "buffer", "slack", "safety margin", "contingency", "risk", "uncertainty"),
}
MODE_PHRASES = (
    "unavailable", "not available", "restricted to", "cannot use", "forced to", "only option", "engineer.*left", "resource.*shortage", "mode.*removed",
    "option.*removed", "slow.*mode", "fast.*mode.*unavailable", "team.*reduced", "contractor.*unavailable",
)
PROXIMITY_WORDS = 10

# --- fixed values: limits ------------------------------------------------------------------------------------------
WORDS_LEAST, WORDS_MOST, DISRUPTION_WORDS = 50, 1500, 10
SECTIONS = ("context:", "resources:", "tasks:", "disruption:")
GAP_LIMIT = {"easy": 0.02, "medium": 0.05, "hard": 0.15}
QUOTA_SHARE = {"easy": 0.30, "medium": 0.50, "hard": 0.20}
QUOTA_DEFAULT, QUOTA_TARGET = 0.50, 15_000
NUM_PERM, BANDS, SAME_LEAST = 128, 16, 109
PRIME = (1 << 61) - 1
QUESTION_TYPES = (("optimization", 50), ("feasibility", 25), ("rescheduling", 25))
PRICE_IN, PRICE_OUT = 0.0025, 0.01
SPLIT_SHARES = (("train", 0.7), ("val", 0.1), ("test", 0.2))

FULL_RUN_CANDIDATES = 95_000
