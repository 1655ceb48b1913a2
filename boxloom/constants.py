"""Fixed values of the data contract."""

# Class ids of taxonomy v1; a null id marks an inactive candidate.
TAXONOMY = [
    (0, "Car", True),
    (1, "Truck", True),
    (2, "Bulldozer", True),
    (3, "Excavator", True),
    (4, "WaterTruck", True),
    (5, "Sign", True),
    (None, "Pedestrian", False),
    (None, "BoxTruck", False),
]
HEAVY_EQUIPMENT = ["Bulldozer", "Excavator", "WaterTruck"]

# Camera order, id, width, height, stored rotation.
CAMERAS = [
    (0, "front", 1920, 1080, 0),
    (1, "front_left", 1920, 1080, 0),
    (2, "front_right", 1920, 1080, 0),
    (3, "back", 1920, 1080, 0),
    (4, "back_left", 1920, 1080, 0),
    (5, "back_right", 1920, 1080, 0),
]

# Enums.
SOURCES = ["human", "detector", "tracker", "foundation_teacher"]
REVIEW_STATES = [
    "unreviewed_prediction",
    "human_verified",
    "human_modified",
    "human_created",
    "verified_empty",
    "rejected_prediction",
]
BANDS = ["auto_accept_candidate", "review", "manual_search"]

# File stem format and gap that starts a new sequence.
STEM_FORMAT = "yyyyMMdd_HHmmss_SSSSSS"
SEQUENCE_GAP_US = 1_000_000

# COCO area edges and IoU levels.
SMALL_AREA = 32.0 * 32.0
MEDIUM_AREA = 96.0 * 96.0
IOU_LEVELS = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]

# Fixed value: two-sided 95% normal quantile.
Z95 = 1.959963984540054
