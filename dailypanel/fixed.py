"""They have to be exactly these for the results to be right."""

# Hour edges of the three times of day; the lower edge belongs to the later band.
TOD_EDGES = (10, 17)
TODS = (0, 1, 2)

# A shifted day starts at 5 h. Bed hours are looked for from 18 h on, wake hours from 5 h to before 13 h.
DAY_SHIFT_HOURS = 5
BED_FROM_HOUR = 18
WAKE_HOURS = (5, 13)
BED_WRAP_BELOW = 15

# A night that began between these hours ends on the next day.
EVENING_HOURS = (15, 23)

# Codes of the valence/arousal quadrants, "both zero" first, and of a missing side.
QUADRANTS = (-10, 1, 2, 3, 4)
QUADRANT_MISSING = -1

# Statistics per averaged variable, by day and by time of day, in display order.
MEAN_STATS = ("mean", "std", "std_slide", "max", "min", "first", "last")
TOD_STATS = ("mean", "max", "min")

# Days of the sliding deviation, span of the smoothed columns, and width of the "no change" class.
SLIDE_DAYS = 3
SPAN = 7
CLASS_WIDTH = 0.5

# Calendar categories.
MONTHS = tuple(range(1, 13))
WEEKDAYS = tuple(range(7))

# Half width of a 95 % band in deviations, codes of the value bands, and the first generated date.
CONFIDENCE = 1.96
BAND_CODES = {"Low": 0, "Medium": 1, "High": 2}
BASE_DATE = "2023-01-01"

# Forms of measurement texts: "a to b unit", "a+ unit", feet and inches, and texts that say nothing.
SPEC_RANGE = r"^\s*(\S+) to (\S+)(?: (.*?))?\s*$"
SPEC_OPEN = r"^\s*([^+]*?)\s*\+\s*(.*?)\s*$"
SPEC_FEET = r"^\s*(\d+)\s*'\s*(\d+)\s*\"?\s*$"
SPEC_UNKNOWN = "Unidentified"
SPEC_COMPACT = "Unidentified (Compact Construction)"
SPEC_ABSENT = "None or Unspecified"

# Tuning grids by model. alpha and l1_ratio are penalties of the usual per-row objectives.
REGRESSION_GRIDS = {
    "linear": {},
    "ridge": {"alpha": [0.01, 0.1, 0.5, 1.0, 5.0, 10.0, 50.0, 100.0]},
    "lasso": {"alpha": [0.00001, 0.0001, 0.001, 0.01, 0.05, 0.1, 0.5, 1.0]},
    "elastic_net": {
        "alpha": [0.00001, 0.0001, 0.001, 0.01, 0.05, 0.1, 0.5],
        "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9],
    },
    "tree": {"maxDepth": [2, 3, 4, 5], "minInstancesPerNode": [1, 2, 4]},
    "forest": {"numTrees": [50, 100, 200], "maxDepth": [3, 4, 5], "minInstancesPerNode": [1, 2, 4]},
    "boosted": {
        "maxIter": [50, 100, 200],
        "stepSize": [0.01, 0.05, 0.1],
        "maxDepth": [2, 3, 4],
        "subsamplingRate": [0.8, 0.9, 1.0],
    },
}
CLASSIFICATION_GRIDS = {
    "logistic": {"C": [0.01, 0.1, 1.0, 10.0]},
    "tree": {"maxDepth": [2, 3, 4, 5], "minInstancesPerNode": [1, 2, 4]},
    "forest": {"numTrees": [50, 100, 200], "maxDepth": [3, 4, 5], "minInstancesPerNode": [1, 2, 4]},
}
