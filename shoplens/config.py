"""Every constant that shapes a result, in one place."""

# --- Fixed values: results are only right with exactly these -----------------

EVENT_WEIGHTS = {"purchase": 5, "cart": 3, "view": 1, "remove_from_cart": 0}
COLD_START_MAX_EVENTS = 3
DECAY_HALF_LIFE_DAYS = 14

TOP_N = 20
ALS_PARAMS = {"implicitPrefs": True, "rank": 20, "maxIter": 15, "regParam": 0.1,
              "nonnegative": True, "coldStartStrategy": "drop", "seed": 42}
TRAIN_PERCENT = 80

CANDIDATE_POOL = 2000
BRAND_CAP = 3
EVAL_KS = (10, 20)

NEIGHBOURS = 12
MIN_EMBEDDING_USERS = 3
COMPLEMENTS = 8
MIN_SHARED_USERS = 2
COMPLEMENT_SHRINKAGE = 5
MAX_SESSION_ITEMS = 50
TOP_SHARES = 5
PROFILE_TOKENS = 25
RECENT_ITEMS = 10
SEEN_ITEMS = 200
PERSONAS_WARM, PERSONAS_COLD = 12, 8

POPULAR_HEAD = 5000  # items that meet candidates by broadcast; bounds no result
KNOWN_BLOCK = 2048
POPULAR_CANDIDATES = 30
CATEGORY_CANDIDATES = 20
SESSION_ANCHORS = 3
NEIGHBOURS_PER_ANCHOR = 6
COPURCHASE_ANCHORS = 5
MIN_COMPLEMENTS = 3
DEPARTMENT_VALUE = 0.3
COMPLEMENTS_USED = 4
ITEMS_PER_COMPLEMENT = 5

SESSION_MAX_EVENTS = 20
SESSION_TTL_SECONDS = 7200
SESSION_DECAY = 0.8

STREAM_FLUSH_EVENTS = 500
STREAM_FLUSH_SECONDS = 30

# factor -> (label, weight); the weights of one profile add up to 1
RANKING_PROFILES = {
    "home": {
        "als": ("Base ALS Score", 0.30),
        "copurchase": ("Item Co-purchase Factor", 0.18),
        "content": ("User-Item Similarity", 0.14),
        "session": ("Session Intent Boost", 0.14),
        "category": ("Category Affinity", 0.10),
        "price": ("Price Range Fit", 0.06),
        "brand": ("Brand Affinity", 0.05),
        "popularity": ("Popularity", 0.03),
    },
    "product": {
        "context": ("Item-Item Similarity", 0.24),
        "copurchase": ("Item Co-purchase Factor", 0.20),
        "complement": ("Complementary Category", 0.14),
        "als": ("Base ALS Score", 0.12),
        "session": ("Session Intent Boost", 0.08),
        "content": ("User-Item Similarity", 0.06),
        "category": ("Category Affinity", 0.05),
        "price": ("Price Range Fit", 0.04),
        "brand": ("Brand Affinity", 0.04),
        "popularity": ("Popularity", 0.03),
    },
}
VARIETY_DECAY = {"home": 0.75, "product": 0.6}

STRATEGY_LABELS = {
    "als": "Warm user: ALS collaborative filtering candidates",
    "content": "Cold-start user (<= 3 events): TF-IDF content-based candidates",
    "none": "New visitor: popularity + live-session candidates",
}

# Last parts of category codes whose display name is not the capitalised part
TOKEN_LABELS = {"clocks": "Watch", "tv": "TV", "acoustic": "Speaker",
                "hdd": "HDD", "ssd": "SSD", "cpu": "CPU"}

CONTROL_PERCENT = 50
VARIANTS = ("control", "treatment")
EXPERIMENT_EVENTS = ("impression", "click", "conversion")

# --- Ours: how the work is laid out on a cluster ------------------------------

# Scores are rounded this far before they are ranked: two sums of the same terms
# in another order must tie, or ranks would change with the partitioning.
SCORE_DIGITS = 10
# A key above this share of the rows is "heavy". There can never be more than
# 1 / HEAVY_SHARE of them, which is what makes broadcasting them safe.
HEAVY_SHARE = 0.001
SALTS = 32
PAIR_BLOCK = 128
UNSEEN_HEAD = 2000
