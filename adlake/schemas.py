"""Declared schemas. Bronze is never inferred: inference would read every file twice and
drop optional fields that happen to be absent from a day's data."""

PAYLOAD = """struct<
  uri: string, created_at: string, updated_at: string, email: string, name: string,
  first_name: string, last_name: string, timezone: string, status: string,
  rescheduled: boolean, canceled: boolean, cancel_reason: string,
  questions_and_answers: array<struct<question: string, answer: string, position: int>>,
  scheduled_event: struct<
    uri: string, name: string, status: string, event_type: string,
    start_time: string, end_time: string, created_at: string, updated_at: string,
    location: struct<type: string, location: string>,
    event_memberships: array<struct<user: string, user_name: string, user_email: string>>>,
  tracking: struct<utm_source: string, utm_medium: string, utm_campaign: string,
    utm_content: string, utm_term: string, salesforce_uuid: string>>"""

WEBHOOK_EVENT = f"struct<event: string, created_at: string, created_by: string, payload: {PAYLOAD}>"

# amounts are read as strings so that a non-numeric one is rejected alone, not its whole file
SPEND_RECORDS = "array<struct<date: string, channel: string, spend: string>>"

BRONZE_BOOKING = f"""
  source_system string, ingestion_timestamp string, webhook_event string, booking_id string,
  event_type_uri string, channel string, raw_s3_key string, raw_event {WEBHOOK_EVENT},
  _corrupt_record string"""

# columns of a bare webhook event lying next to enveloped ones
BARE_EVENT = f"event string, created_at string, created_by string, payload {PAYLOAD}"

BRONZE_SPEND = f"""
  source_system string, ingestion_timestamp string, source_url string,
  source_file_name string, raw_s3_key string, raw_payload {SPEND_RECORDS},
  _corrupt_record string"""

SILVER_BOOKING = """
  webhook_event string, webhook_created_at string, webhook_created_by string,
  booking_id string, invitee_uri string, booking_created_at string, booking_date date,
  booking_updated_at string, invitee_email string, invitee_name string,
  invitee_first_name string, invitee_last_name string, invitee_phone string,
  invitee_timezone string, invitee_status string, invitee_canceled boolean,
  invitee_cancel_reason string, rescheduled boolean, scheduled_event_id string,
  scheduled_event_uri string, scheduled_event_name string, scheduled_event_status string,
  event_type_uri string, channel string, meeting_created_at string, meeting_updated_at string,
  meeting_start_time string, meeting_end_time string, meeting_date date,
  meeting_day_of_week string, meeting_hour int, meeting_week_start_date date,
  meeting_location_type string, meeting_location string, utm_source string, utm_medium string,
  utm_campaign string, utm_content string, utm_term string, salesforce_uuid string,
  employee_uri string, employee_id string, employee_name string, employee_email string,
  bronze_source_system string, bronze_ingestion_timestamp string, bronze_raw_s3_key string,
  bronze_source_file_path string"""

SILVER_SPEND = """
  spend_date date, channel string, spend_usd double, source_file string,
  bronze_source_system string, bronze_ingestion_timestamp string, bronze_source_url string,
  bronze_raw_s3_key string, bronze_source_file_path string"""
