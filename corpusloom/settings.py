"""Fixed values of the taxonomy workload: thresholds, limits and weight vectors."""

from __future__ import annotations

# Order of the feature blocks, and the combinations that a sweep compares.
FIELDS = ("title", "description", "notes")
WEIGHT_ORDER = (*FIELDS, "cat")
COMBOS: dict[str, tuple[float, float, float, float]] = {
    "labels_only": (0.0, 0.0, 0.0, 1.0),
    "notes_only": (0.0, 0.0, 1.0, 0.0),
    "description_only": (0.0, 1.0, 0.0, 0.0),
    "title_notes": (1.0, 0.0, 1.0, 0.0),
    "all_equal": (1.0, 1.0, 1.0, 1.0),
    "notes_weighted": (0.3, 0.3, 1.0, 0.5),
    "semantic_no_cat": (1.0, 1.0, 1.0, 0.0),
    "title_desc_cat": (1.0, 1.0, 0.0, 1.0),
}

# Search of k, starts of KMeans, rows of a silhouette.
K_MIN, K_MAX, K_PROBES, ROWS_PER_CLUSTER = 30, 90, 12, 25
KMEANS_SEED, KMEANS_STARTS, KMEANS_ITERATIONS, SILHOUETTE_ROWS = 42, 10, 300, 5000

# When a cluster counts, when a clustering is stable, members shown to the namer.
MIN_MASS, MIN_ROWS, RESEEDS, STABLE_ARI = 0.003, 25, 3, 0.60
NEAREST, DIVERSE = 8, 4

# Limits of embedding requests and of batches of descriptions.
EMBED_WIDTH, INPUT_CHARS, INPUT_TOKENS, REQUEST_TOKENS, REQUEST_ITEMS = 1024, 24_000, 8_000, 250_000, 128
GROUP_SIZE, DESCRIPTION_CHARS, MIN_CHARS, MOST_REQUESTS = 12, 1500, 40, 100_000
