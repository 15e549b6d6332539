"""Results must carry exactly these labels, limits and seed rows."""

# --- message contract -----------------------------------------------------------------
REQUIRED_FIELDS = ("badge_id", "user_id", "zone_id", "reader_id", "event_timestamp")
ID_FIELDS = ("badge_id", "user_id", "zone_id", "reader_id")
OPTIONAL_FIELDS = ("signal_strength", "direction")
ID_LENGTH = 50
DIRECTION_LENGTH = 10
MISSING_SIGNAL = -999
WEAK_BELOW = -80
MEDIUM_BELOW = -60
# Event times this far from the arrival time are rejected: a broken clock must not make folders without limit.
EVENT_DAYS_BEFORE_ARRIVAL = 3660
EVENT_DAYS_AFTER_ARRIVAL = 1
SIGNAL_LIMIT = 1000  # decimal(5,2) holds values strictly between -1000 and 1000

# --- tasks of a run ---------------------------------------------------------------------
STAGE_TASK = "badge_stage_task"
ENRICH_TASK = "badge_enrich_task"

# --- derived flags --------------------------------------------------------------------
DAY_STARTS_AT = 6
DAY_ENDS_AT = 22

# --- monitoring thresholds ------------------------------------------------------------
STALE_AFTER_SECONDS = 300
WARNING_AFTER_SECONDS = 120
HEALTHY_LATENCY_SECONDS = 120
EXCELLENT_BELOW_PCT = 20
GOOD_BELOW_PCT = 50
FAIR_BELOW_PCT = 80
RUN_HISTORY_LIMIT = 1000
RECENT_RUNS_LIMIT = 5
RUN_ERRORS_LIMIT = 20

# --- table names shown in results -----------------------------------------------------
RAW_TABLE = "RAW_BADGE_EVENTS"
STAGING_TABLE = "STG_BADGE_EVENTS"
FACT_TABLE = "FCT_ACCESS_EVENTS"
USERS_TABLE = "DIM_USERS"

# --- status texts ---------------------------------------------------------------------
PENDING_CHECK = "Stream Has Data?"
PENDING_TEXT = "WARNING:  Data pending (tasks still processing)"
DRAINED_TEXT = " Stream consumed (pipeline caught up)"

# --- values of automatically created users --------------------------------------------
UNKNOWN = "UNKNOWN"
UNKNOWN_CLEARANCE = "PUBLIC"

# --- seed rows, keys 1..5 in this order -----------------------------------------------
SEED_USERS = [
    # user_id, user_name, user_type, department, clearance_level
    ("USR-001", "John Smith", "EMPLOYEE", "Engineering", "CONFIDENTIAL"),
    ("USR-002", "Jane Doe", "EMPLOYEE", "HR", "PUBLIC"),
    ("USR-003", "Bob Johnson", "CONTRACTOR", "IT Support", "PUBLIC"),
    ("USR-004", "Alice Williams", "EMPLOYEE", "Security", "SECRET"),
    ("USR-005", "Mike Davis", "VISITOR", "External", "PUBLIC"),
]
SEED_ZONES = [
    # zone_id, reader_id, building_name, floor_number, zone_name, zone_type,
    # capacity, requires_clearance, is_restricted, reader_location, reader_type
    ("ZONE-LOBBY-1", "RDR-101", "Main Building", 1, "Main Lobby", "LOBBY",
     100, None, False, "Main Entrance", "BIDIRECTIONAL"),
    ("ZONE-OFFICE-2A", "RDR-201", "Main Building", 2, "Engineering Office 2A", "OFFICE",
     30, "CONFIDENTIAL", True, "Floor 2 East", "ENTRY"),
    ("ZONE-SERVER-B1", "RDR-B101", "Main Building", -1, "Server Room B1", "SECURE_AREA",
     5, "SECRET", True, "Basement Security Door", "BIDIRECTIONAL"),
    ("ZONE-CONF-3B", "RDR-301", "Main Building", 3, "Conference Room 3B", "CONFERENCE_ROOM",
     20, None, False, "Floor 3 West", "ENTRY"),
    ("ZONE-PARKING-1", "RDR-P01", "Parking Structure", 1, "Employee Parking Level 1", "PARKING",
     200, None, False, "Garage Entry", "ENTRY"),
]
