from .dates import month_number, month_start, parse_civil_date, parse_instant, parse_local, whole_seconds
from .numbers import mean_to_cents, percent
from .text import DOMAIN_ALIASES, DOT_BLIND_DOMAINS, blank_to_null, canonical_email, clean_label

__all__ = [
    "DOMAIN_ALIASES",
    "DOT_BLIND_DOMAINS",
    "blank_to_null",
    "canonical_email",
    "clean_label",
    "mean_to_cents",
    "month_number",
    "month_start",
    "parse_civil_date",
    "parse_instant",
    "parse_local",
    "percent",
    "whole_seconds",
]
