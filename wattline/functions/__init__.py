from .codes import product_code
from .money import mean, rounded, strict_double, total
from .time import (day_start, far_future, fill_open_end, floor_half_hour, from_uk_wall_clock,
                   hour_of_day, iso_z, month_start, parse_instant, shift_days, to_uk_wall_clock)

__all__ = [
    "product_code", "total", "mean", "rounded", "strict_double", "day_start", "far_future", "fill_open_end",
    "floor_half_hour", "from_uk_wall_clock", "hour_of_day", "iso_z", "month_start",
    "parse_instant", "shift_days", "to_uk_wall_clock",
]
