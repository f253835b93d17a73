"""Fixed values that must equal the reference's for equal results.

Fixed values (value lists of the transaction event, as published by the
event producer): payment methods, commission types,
customer types, failure reasons, device library, base coordinates.
"""

# --- fixed values -----------------------------------------------------------
PAYMENT_METHODS = ["online", "pos", "mobile", "nfc"]
COMMISSION_TYPES = ["flat", "progressive", "tiered"]
CUSTOMER_TYPES = ["individual", "CIP", "business"]
FAILURE_REASONS = ["cancelled", "insufficient_funds", "system_error", "fraud_prevented"]
DEVICE_LIBRARY = [
    {"os": "Android", "app_version": "2.4.1", "device_model": "Samsung Galaxy S25"},
    {"os": "iOS", "app_version": "3.1.0", "device_model": "iPhone 15"},
    {"os": "Android", "app_version": "1.9.5", "device_model": "Google Pixel 6"},
]
BASE_LAT = 35.7219
BASE_LNG = 51.3347
KNOWN_OS = ["iOS", "Android"]
STATUSES = ["approved", "declined"]
# Part-of-day labels and their hour ranges [start, end).
DAY_PARTS = [("Morning", 6, 12), ("Afternoon", 12, 18), ("Evening", 18, 24)]
DAY_PART_ELSE = "Night"
# Segment thresholds of the customer segmentation report.
SEGMENT_FREQUENCY = 10
SEGMENT_SPEND = 100000
SEGMENT_RECENCY_DAYS = 30
# Fraud rule defaults.
AMOUNT_FACTOR = 10
VELOCITY_LIMIT = 5
GEO_WINDOW = "5 minutes"
GEO_THRESHOLD = 0.5
# Alert labels.
FRAUD_AMOUNT = "Amount anomaly"
FRAUD_VELOCITY = "Velocity Fraud"
FRAUD_GEO = "Geographical impossibility"
# Segment labels: (met, not met) per criterion.
SEGMENT_LABELS = {
    "frequency": ("High Frequency", "Low Frequency"),
    "spending": ("High Spending", "Low Spending"),
    "recency": ("Recent", "Inactive"),
}
# Day-length estimate: default latitude (New York) and the solar declination
# amplitude in degrees.
DAYLIGHT_LATITUDE = 40.7128
DECLINATION_AMPLITUDE = 23.44
# 97.5 % normal quantile used for 95 % intervals.
Z_975 = 1.959963984540054
# ---------------------------------------------------------------------------
