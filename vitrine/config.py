"""Fixed values and defaults.

Everything under "FIXED VALUES" must equal the behaviour being matched
(rule table, default targets, file extensions, null tokens, thresholds,
palette, output column order, message formats).  They are stated as plain
data in their natural order; the code never re-derives them.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference behaviour exactly)
# ---------------------------------------------------------------------------

# Image file extensions, tried in this order for every product id.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp", ".bmp")

# Row cap and display sample size.
MAX_PRODUCTS = 5000
SAMPLE_DISPLAY = 12

# Duplicate detection.
DUPLICATE_SIMILARITY_THRESHOLD = 0.92
MIN_CLUSTER_SIZE = 2

# Recommendation / search sizes.
TOP_K_RECOMMENDATIONS = 5
TOP_K_SEARCH_RESULTS = 5
SEARCH_OVERFETCH = 10          # text search retrieves top_k + 10 before filtering

# Recommendation score bonuses and cap.
BONUS_SAME_MASTER_CATEGORY = 0.02
BONUS_SAME_USAGE = 0.01
SCORE_CAP = 1.0

# Required catalog columns (presence is checked, nulls are dropped).
REQUIRED_COLUMNS = (
    "id", "articleType", "masterCategory", "subCategory", "baseColour",
    "season", "year", "usage", "productDisplayName",
)

# Column order of the unique-catalog export.
EXPORT_COLUMNS = (
    "id", "productDisplayName", "masterCategory", "subCategory",
    "articleType", "baseColour", "brand", "usage", "season", "year",
    "image_path",
)

# Complementary article-type rules, in declaration order (order matters:
# the first partial match wins).
COMPLEMENTARY_RULES = (
    ("shoes", ("socks", "watch", "sports shoes", "casual shoes", "shorts", "trousers")),
    ("sports shoes", ("socks", "shorts", "track pants", "sports watch", "water bottle", "cap")),
    ("casual shoes", ("jeans", "shorts", "belt", "sunglasses", "watch")),
    ("formal shoes", ("trousers", "belt", "tie", "cufflinks", "socks")),
    ("heels", ("skirts", "dresses", "clutches", "kurtas")),
    ("sandals", ("shorts", "skirts", "dresses", "sunglasses")),
    ("flip flops", ("shorts", "t-shirts", "sunglasses")),
    ("boots", ("jeans", "trousers", "jacket", "scarf")),
    ("shirts", ("trousers", "jeans", "belt", "watch", "formal shoes", "tie")),
    ("t-shirts", ("jeans", "shorts", "casual shoes", "watch", "cap")),
    ("tops", ("jeans", "skirts", "flats", "clutches", "earrings")),
    ("kurtas", ("churidars", "leggings", "flats", "earrings", "dupatta")),
    ("blouses", ("saree", "skirts", "trousers", "earrings")),
    ("sweatshirts", ("track pants", "casual shoes", "cap", "backpacks")),
    ("jackets", ("jeans", "shirts", "boots", "scarf", "watch")),
    ("sweaters", ("jeans", "trousers", "boots", "scarf", "watch")),
    ("hoodies", ("track pants", "casual shoes", "cap", "backpacks")),
    ("dresses", ("heels", "sandals", "clutches", "earrings", "belt")),
    ("sarees", ("blouses", "flats", "earrings", "clutches")),
    ("jeans", ("shirts", "t-shirts", "casual shoes", "belt", "watch")),
    ("trousers", ("shirts", "formal shoes", "belt", "tie", "watch")),
    ("shorts", ("t-shirts", "sports shoes", "socks", "cap", "sunglasses")),
    ("skirts", ("tops", "blouses", "heels", "sandals", "earrings")),
    ("leggings", ("kurtas", "tops", "flats", "earrings")),
    ("churidars", ("kurtas", "flats", "earrings", "dupatta")),
    ("track pants", ("sweatshirts", "sports shoes", "socks", "cap")),
    ("watch", ("shirts", "formal shoes", "belt", "sunglasses")),
    ("sunglasses", ("t-shirts", "casual shoes", "cap", "shorts")),
    ("belt", ("shirts", "trousers", "jeans", "formal shoes")),
    ("cap", ("t-shirts", "shorts", "sports shoes", "sunglasses")),
    ("backpacks", ("hoodies", "track pants", "casual shoes")),
    ("handbags", ("dresses", "tops", "heels", "sunglasses")),
    ("clutches", ("dresses", "heels", "earrings")),
    ("earrings", ("tops", "dresses", "kurtas")),
    ("bracelet", ("watch", "shirts", "casual shoes")),
    ("tie", ("shirts", "formal shoes", "trousers")),
    ("scarf", ("jackets", "boots", "sweaters")),
    ("socks", ("sports shoes", "casual shoes", "formal shoes")),
    ("dupatta", ("kurtas", "churidars")),
)

# Targets used when no rule key matches.
DEFAULT_COMPLEMENTARY = ("accessories", "watches", "sunglasses", "belts", "bags")

# Recommendation reason texts ({target} / {source} are title-cased types).
REASON_RULE = (
    "'{target}' is a popular complementary item for '{source}' — based on "
    "fashion compatibility rules and CLIP embedding similarity."
)
REASON_FALLBACK = "Complementary accessory for {source} (embedding similarity)"

# Tokens read as missing values by the catalog CSV reader.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Projection / chart data.
PROJECTION_SAMPLE_SIZE = 500
PCA_COMPONENTS = 50
COLOR_PALETTE = (
    "#6366f1", "#8b5cf6", "#ec4899", "#f43f5e", "#f97316",
    "#eab308", "#22c55e", "#14b8a6", "#0ea5e9", "#3b82f6",
)

# Score colour bands (>= 0.85 green, >= 0.70 yellow, else red).
SCORE_BAND_GREEN = 0.85
SCORE_BAND_YELLOW = 0.70

# Display cuts.
TOP_ARTICLE_TYPES = 20
TOP_COLOURS = 15
CHART_TOP_TYPES = 15
NAME_LABEL_CHARS = 30          # display sample label truncation
NAME_DISPLAY_CHARS = 35
REASON_DISPLAY_CHARS = 60
QUERY_LABEL_CHARS = 20

# ---------------------------------------------------------------------------
# Engine defaults (ours, not the reference's)
# ---------------------------------------------------------------------------

# Hashed bag-of-words text encoder: number of buckets (= vector dimension
# of the supplied embeddings) and md5 hex prefix length used for bucketing.
HASH_DIM = 64
HASH_HEX_CHARS = 7

# Largest block (rows) of a stored table of vectors (pivot summaries, the
# block store of the streamed duplicate check).
MAX_BLOCK_ROWS = 2048

# Largest block (rows) of a similarity join.  A block travels to every
# partner block; the kernels score it in tiles, so only its own bytes
# (32,768 rows of 64 doubles: 16 MiB) count in a task's memory.
JOIN_BLOCK_ROWS = 32768

# Sample seed for deterministic caps.
SAMPLE_SEED = 42
DISPLAY_SEED = 0
