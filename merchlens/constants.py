"""Values fixed by the data formats and by the workload this engine reproduces."""

# Text formats.
RATING_MARKER = "PRODUCT_RATING_PREFIX:"
RATING_LINE_PATTERN = ".+PRODUCT_RATING_PREFIX.+"
FIELD_SEPARATOR = "|"
PRODUCT_FILE_SEPARATOR = "^"
RATING_FILE_SEPARATOR = ","

# List lengths and floors.
USER_RECS_LENGTH = 20
SIMILAR_CANDIDATES = 20
RECENT_RATINGS = 20
RECENT_LIST_CAP = 40
TABLE_SIMILARITY_FLOOR = 0.4
SCORING_SIMILARITY_FLOOR = 0.6
LIKE_THRESHOLD = 3

# Model parameters.
ALS_RANK = 50
ALS_ITERATIONS = 5
ALS_REGULARISATION = 0.01
GRID_RANKS = (100, 200, 250)
GRID_REGULARISATIONS = (1.0, 0.1, 0.01, 0.001)
TRAIN_FRACTION = 0.8

# Streaming.
TRIGGER_INTERVAL = "2 seconds"
LOG_TOPIC = "log"
RATING_TOPIC = "recommender"
