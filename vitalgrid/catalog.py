"""Fixed values of the data model: metrics, limits, rules and names."""

from __future__ import annotations

# Schema per data type.
SCHEMAS = {
    "heart_rate": {
        "required": ["timestamp", "heart_rate"],
        "optional": ["activity_type", "confidence"],
    },
    "sleep": {
        "required": ["date", "duration_minutes"],
        "optional": ["quality_score", "sleep_stage"],
    },
    "steps": {
        "required": ["timestamp", "step_count"],
        "optional": ["distance_km", "calories"],
    },
}

# The metric column of each data type.
METRIC_COLUMN = {
    "heart_rate": "heart_rate",
    "steps": "step_count",
    "sleep": "duration_minutes",
}

# Numeric and text columns of the schemas; all data types share one table of them.
NUMBERS = ["heart_rate", "confidence", "duration_minutes", "quality_score", "step_count", "distance_km", "calories"]
TEXTS = ["activity_type", "sleep_stage"]

# Allowed range per column, with the label used in messages.
VALUE_RANGES = {
    "heart_rate": (30, 220, "Heart rate"),
    "step_count": (0, 100000, "Step count"),
    "duration_minutes": (0, 1440, "Duration"),
}

# Threshold rules as (minimum, maximum, sustained rows).
THRESHOLD_RULES = {
    "heart_rate": (40, 120, 10),
    "steps": (0, 1000, 5),
    "sleep": (180, 720, 0),
}

# Keywords that name a data type in a file name, tried in this order.
FILE_KEYWORDS = {
    "heart_rate": ["heart", "hr", "pulse", "bpm"],
    "sleep": ["sleep", "rest", "bed"],
    "steps": ["step", "walk", "activity"],
}

# Common column names and their standard form.
COLUMN_NAMES = {
    "time": "timestamp",
    "date": "timestamp",
    "datetime": "timestamp",
    "hr": "heart_rate",
    "heartrate": "heart_rate",
    "bpm": "heart_rate",
    "pulse": "heart_rate",
    "steps": "step_count",
    "stepcount": "step_count",
    "sleep": "sleep_stage",
    "stage": "sleep_stage",
    "duration": "duration_minutes",
    "minutes": "duration_minutes",
}

# Names a timestamp column may have, in order of preference.
TIMESTAMP_NAMES = ["timestamp", "date", "datetime", "time", "Date", "Time", "DateTime", "Timestamp"]

# Names that the quick check accepts as a timestamp column.
QUICK_TIMESTAMP_NAMES = ["timestamp", "date", "datetime", "time", "Date", "Time"]

# Wrapper fields a JSON file may hold its records in, in order of preference.
JSON_WRAPPERS = ["data", "records", "entries"]

# Places and their time zones.
PLACE_ZONES = {
    "new york": "America/New_York",
    "london": "Europe/London",
    "tokyo": "Asia/Tokyo",
    "los angeles": "America/Los_Angeles",
    "chicago": "America/Chicago",
    "paris": "Europe/Paris",
    "sydney": "Australia/Sydney",
    "mumbai": "Asia/Kolkata",
    "delhi": "Asia/Kolkata",
    "dubai": "Asia/Dubai",
    "singapore": "Asia/Singapore",
    "hong kong": "Asia/Hong_Kong",
    "toronto": "America/Toronto",
}

# Target frequencies and their length in seconds.
FREQUENCIES = {
    "30 sec": 30,
    "1 min": 60,
    "5 min": 300,
    "15 min": 900,
    "30 min": 1800,
    "1 hour": 3600,
}

# First accepted moment, and the fill limits.
EARLIEST = "2010-01-01 00:00:00"
INTERPOLATE_LIMIT = 10
BACKFILL_LIMIT = 5

# Days of the week in display order, and severities.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
SEVERITIES = ["High", "Medium", "Low"]

# Names of the flag columns that the operators add.
OUTLIER_SUFFIX = "_is_outlier"
ANOMALY_SUFFIX = "_anomaly"

# Issue texts of the validation, with their number formats.
ISSUES = {
    "invalid": "Failed to parse %d timestamps (%.1f%%)",
    "future": "Found %d future timestamps",
    "old": "Found %d timestamps before 2010",
    "range": "%s: %%d values outside range [%s, %s]",
}

# Why a stage gives no result for a series.
UNKNOWN_TYPE = "Unknown data type: %s"
NO_METRIC = "Metric column '%s' not found"
TOO_FEW_READINGS = "Insufficient data for modeling"
NO_ROWS_LEFT = "No rows with a valid time"
NO_WINDOWS = "No data available for feature extraction"

# Why a clustering gives no result.
TOO_FEW_ROWS = "Insufficient data: only %d sample(s) available for clustering. Need at least 2 samples."

# Findings per code, as text with its number formats.
FINDINGS = {
    "hr_low": "💙 Your average heart rate (%.0f bpm) is below normal. This could indicate good cardiovascular fitness or bradycardia.",
    "hr_high": "❤️ Your average heart rate (%.0f bpm) is elevated. Consider consulting a healthcare provider.",
    "hr_normal": "✅ Your average heart rate (%.0f bpm) is within normal range.",
    "hr_variable": "📊 High heart rate variability detected (σ=%.1f). This suggests good adaptability to stress.",
    "hr_peak": "⚠️ Peak heart rate of %.0f bpm detected. Ensure this occurred during intense exercise.",
    "steps_goal": "🎯 Excellent! You've achieved %,.0f steps, exceeding the daily goal of 10,000!",
    "steps_short": "🚶 You have %,.0f steps. %,.0f more to reach your daily goal!",
    "steps_active": "💪 Great activity level! Averaging %.0f steps per interval.",
    "sleep_good": "😴 Optimal sleep duration: %.1f hours. Well done!",
    "sleep_short": "⏰ Sleep duration (%.1fh) is below recommended 7-9 hours.",
    "sleep_long": "😴 Long sleep duration (%.1fh). Quality matters more than quantity!",
    "sleep_deep": "🌙 Excellent deep sleep: %.0f%% of total sleep time.",
}

# Method names in reports, and reason texts.
METHODS = {
    "threshold": "Threshold-Based",
    "residual": "Prophet Residual-Based",
    "cluster": "Cluster-Based",
}
REASONS = {
    "sustained_high": "High %s (>%s)",
    "sustained_low": "Low %s (<%s)",
    "instant_high": "Excessive %s",
    "instant_low": "Insufficient %s",
    "residual": "Deviates from predicted trend",
    "noise": "Noise point (DBSCAN)",
    "small_cluster": "Belongs to small cluster #%d",
}
