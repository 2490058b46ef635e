from .columns import (
    band,
    iso_date,
    label,
    mask_name,
    mask_phone,
    money,
    rate,
    round_score,
    whole_number,
)

__all__ = [
    "band",
    "iso_date",
    "label",
    "mask_name",
    "mask_phone",
    "money",
    "rate",
    "round_score",
    "whole_number",
]
