"""Values that other systems depend on. Everything here is data, not logic."""

# --- Fixed values: what the booking provider and the ad platforms send ---------------

WANTED_WEBHOOK_EVENT = "invitee.created"

CHANNEL_BY_EVENT_TYPE = {
    "https://api.calendly.com/event_types/d639ecd3-8718-4068-955a-436b10d72c78": "facebook_paid_ads",
    "https://api.calendly.com/event_types/dbb4ec50-38cd-4bcd-bbff-efb7b5a6f098": "youtube_paid_ads",
    "https://api.calendly.com/event_types/bb339e98-7a67-4af2-b584-8dbf95564312": "tiktok_paid_ads",
}

SPEND_CHANNELS = ("facebook_paid_ads", "youtube_paid_ads", "tiktok_paid_ads")

# --- Fixed values: bronze layout ------------------------------------------------------

BOOKING_SOURCE_SYSTEM = "calendly"
SPEND_SOURCE_SYSTEM = "marketing_spend_public_s3"
BOOKING_KEY_PREFIX = "bronze/calendly_webhooks"
SPEND_KEY_PREFIX = "bronze/marketing_spend"
UNKNOWN_WEBHOOK_EVENT = "unknown_event"
SPEND_FILE_PATTERN = r"^spend_data_.*\.json$"
MANIFEST_LIST_KEYS = ("files", "file_names", "spend_files", "objects")
MANIFEST_NAME_KEYS = ("file_name", "filename", "name", "key", "path")

# --- Fixed values: labels for missing attributes --------------------------------------

UNKNOWN_CAMPAIGN = "unknown_campaign"
UNKNOWN_EMPLOYEE_ID = "unknown_employee"
UNKNOWN_EMPLOYEE_NAME = "Unknown Employee"
UNKNOWN_EMPLOYEE_EMAIL = "unknown_email"

# --- Fixed values: presentation labels ------------------------------------------------

COLUMN_TITLES = {
    "channel": "Channel",
    "total_spend_usd": "Total Spend",
    "booked_call_count": "Booked Calls",
    "cost_per_booking_usd": "Cost per Booking",
    "metric_date": "Metric Date",
    "booking_date": "Booking Date",
    "utm_campaign": "UTM Campaign",
    "meeting_day_of_week": "Meeting Day",
    "meeting_hour": "Meeting Hour",
    "employee_id": "Employee ID",
    "employee_name": "Employee Name",
    "employee_email": "Employee Email",
    "gold_processed_at": "Gold Processed At",
    "total_bookings": "Total Bookings",
    "average_cost_per_booking_usd": "Average CPB",
    "channel_count": "Channel Count",
    "spend_date_count": "Spend Date Count",
    "booking_date_count": "Booking Date Count",
}

CHANNEL_TITLES = {
    "facebook_paid_ads": "Facebook Paid Ads",
    "youtube_paid_ads": "YouTube Paid Ads",
    "tiktok_paid_ads": "TikTok Paid Ads",
}
