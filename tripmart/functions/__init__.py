"""Scalar column expressions."""

from tripmart.functions.scalars import (
    bad_money_count,
    bounded_distance,
    event_time_text,
    id_text,
    money,
    money_sum,
    next_weekday,
    whole_number,
)

__all__ = [
    "bad_money_count",
    "bounded_distance",
    "event_time_text",
    "id_text",
    "money",
    "money_sum",
    "next_weekday",
    "whole_number",
]
