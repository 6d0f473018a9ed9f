"""The rule table: 66 expectations over the cleaned tables.

Dates that depend on the deployment (oldest plausible date, evaluation date) are
parameters, so the same rules serve live data and history.
"""

from __future__ import annotations

from innsight.operators.quality import CRITICAL, WARNING, Rule


def _required(column: str) -> str:
    return f"{column} IS NOT NULL"


def _text(column: str) -> str:
    return f"{column} IS NOT NULL AND LENGTH({column}) > 0"


def _mail(column: str) -> str:
    return f"{column} IS NOT NULL AND INSTR({column}, chr(64)) > 0"


def _range(column: str, low, high) -> str:
    return f"{column} BETWEEN {low} AND {high}"


def _since(column: str, first_day: str) -> str:
    return f"{column} IS NOT NULL AND {column} >= DATE'{first_day}'"


def build_rules(
    min_date: str = "2020-01-01", min_hire_date: str = "2015-01-01", as_of: str | None = None
) -> list[Rule]:
    today = f"DATE'{as_of}'" if as_of else "CURRENT_DATE()"
    # Rule names, thresholds and severities of the rule table.
    spec: dict[str, list[tuple[str, str, str]]] = {
        "users": [
            ("valid_user_id", _required("user_id"), CRITICAL),
            ("valid_email", f"{_text('email')} AND INSTR(email, chr(64)) > 0", CRITICAL),
            ("valid_name", _text("name"), CRITICAL),
            ("valid_created_date", _since("created_at", min_date), CRITICAL),
            ("recent_user", f"created_at >= {today} - INTERVAL 5 YEARS", WARNING),
        ],
        "hosts": [
            ("valid_host_id", _required("host_id"), CRITICAL),
            ("valid_email", _mail("email"), CRITICAL),
            ("valid_rating", "rating IS NULL OR (rating >= 1.0 AND rating <= 5.0)", WARNING),
        ],
        "destinations": [
            ("valid_destination_id", _required("destination_id"), CRITICAL),
            ("valid_destination_name", _text("destination"), CRITICAL),
            ("valid_country", _required("country"), CRITICAL),
        ],
        "countries": [
            ("valid_country", _text("country"), CRITICAL),
            ("valid_country_code", "country_code IS NOT NULL AND LENGTH(country_code) = 2", CRITICAL),
        ],
        "properties": [
            ("valid_property_id", _required("property_id"), CRITICAL),
            ("valid_host", _required("host_id"), CRITICAL),
            ("valid_destination", _required("destination_id"), CRITICAL),
            ("positive_base_price", "base_price > 0", CRITICAL),
            ("reasonable_price", _range("base_price", 10, 10000), WARNING),
            ("valid_guests", "max_guests >= 1", CRITICAL),
            ("reasonable_guests", _range("max_guests", 1, 20), WARNING),
            (
                "valid_coordinates",
                f"{_range('property_latitude', -90, 90)} AND {_range('property_longitude', -180, 180)}",
                WARNING,
            ),
        ],
        "amenities": [
            ("valid_amenity_id", _required("amenity_id"), CRITICAL),
            ("valid_amenity_name", _text("name"), CRITICAL),
        ],
        "employees": [
            ("valid_employee_id", _required("employee_id"), CRITICAL),
            ("valid_host", _required("host_id"), CRITICAL),
            ("valid_joined_date", _since("joined_at", min_hire_date), CRITICAL),
            ("valid_employment_status", "end_service_date IS NULL OR end_service_date >= joined_at", WARNING),
        ],
        "bookings": [
            ("valid_booking_id", _required("booking_id"), CRITICAL),
            ("valid_user", _required("user_id"), CRITICAL),
            ("valid_property", _required("property_id"), CRITICAL),
            ("valid_check_in", _since("check_in", min_date), CRITICAL),
            ("valid_check_out", "check_out IS NOT NULL AND check_out > check_in", CRITICAL),
            ("valid_guests", "guests_count >= 1", CRITICAL),
            ("reasonable_guests", _range("guests_count", 1, 20), WARNING),
            ("positive_amount", "total_amount > 0", CRITICAL),
            ("reasonable_amount", _range("total_amount", 10, 100000), WARNING),
            ("reasonable_stay", _range("DATEDIFF(check_out, check_in)", 1, 365), WARNING),
        ],
        "booking_updates": [
            ("valid_booking_update_id", _required("booking_update_id"), CRITICAL),
            ("valid_booking", _required("booking_id"), CRITICAL),
            ("valid_dates", "check_in IS NOT NULL AND check_out IS NOT NULL AND check_out > check_in", CRITICAL),
            ("update_after_creation", "created_at IS NULL OR updated_at >= created_at", WARNING),
        ],
        "payments": [
            ("valid_payment_id", _required("payment_id"), CRITICAL),
            ("valid_booking", _required("booking_id"), CRITICAL),
            ("positive_amount", "amount > 0", CRITICAL),
            ("reasonable_amount", _range("amount", 1, 100000), WARNING),
            ("valid_payment_method", _required("payment_method"), CRITICAL),
            ("valid_payment_date", _since("payment_date", min_date), CRITICAL),
        ],
        "reviews": [
            ("valid_review_id", _required("review_id"), CRITICAL),
            ("valid_booking", _required("booking_id"), CRITICAL),
            ("valid_property", _required("property_id"), CRITICAL),
            ("valid_user", _required("user_id"), CRITICAL),
            ("valid_rating", "rating >= 1.0 AND rating <= 5.0", CRITICAL),
            ("has_comment_or_rating", "comment IS NOT NULL OR rating IS NOT NULL", WARNING),
        ],
        "clickstream": [
            ("valid_event", _text("event"), CRITICAL),
            ("valid_timestamp", _since("timestamp", min_date), CRITICAL),
            ("recent_event", f"timestamp >= {today} - INTERVAL 90 DAYS", WARNING),
        ],
        "page_views": [
            ("valid_view_id", _required("view_id"), CRITICAL),
            ("valid_timestamp", _since("timestamp", min_date), CRITICAL),
            ("valid_page_url", _text("page_url"), CRITICAL),
            ("recent_page_view", f"timestamp >= {today} - INTERVAL 90 DAYS", WARNING),
        ],
        "customer_support_logs": [
            ("valid_ticket_id", _text("ticket_id"), CRITICAL),
            ("valid_user", _required("user_id"), CRITICAL),
            ("valid_created_date", _required("created_at"), CRITICAL),
            ("has_messages", "messages IS NOT NULL AND SIZE(messages) > 0", WARNING),
        ],
        "forecast_daily_metric": [("has_data", "1=1", WARNING)],
        "historical_daily_metric": [("has_data", "1=1", WARNING)],
    }
    return [
        Rule(f"silver_{table}", name, sql, severity, f"{name.replace('_', ' ')} of {table.replace('_', ' ')}")
        for table, entries in spec.items()
        for name, sql, severity in entries
    ]


def rules_for(rules: list[Rule], table: str) -> list[Rule]:
    return [r for r in rules if r.table == f"silver_{table}"]


# Quarantine reasons, first match wins.
BOOKING_REASONS = [
    ("booking_id IS NULL", "CRITICAL: Missing booking ID (primary key)"),
    ("user_id IS NULL", "CRITICAL: Missing user ID (FK)"),
    ("property_id IS NULL", "CRITICAL: Missing property ID (FK)"),
    ("check_in IS NULL", "CRITICAL: Missing check-in date"),
    ("check_out IS NULL", "CRITICAL: Missing check-out date"),
    ("check_out <= check_in", "CRITICAL: Check-out not after check-in"),
    ("guests_count < 1", "CRITICAL: Invalid guest count"),
    ("total_amount <= 0", "CRITICAL: Invalid total amount"),
]
PAYMENT_REASONS = [
    ("payment_id IS NULL", "CRITICAL: Missing payment ID (primary key)"),
    ("booking_id IS NULL", "CRITICAL: Missing booking ID (FK)"),
    ("amount <= 0", "CRITICAL: Invalid payment amount"),
    ("payment_method IS NULL", "CRITICAL: Missing payment method"),
    ("payment_date IS NULL", "CRITICAL: Missing payment date"),
]
OTHER_REASON = "CRITICAL: Multiple validation failures"
