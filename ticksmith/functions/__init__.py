from .columns import (blank, to_int, to_bigint, to_double, to_bool, to_u64, to_string, to_ts,
                      cast_code, safe_ratio, tick_to_seconds, grenade_category, opposite_side,
                      not_in_list)

__all__ = ["blank", "to_int", "to_bigint", "to_double", "to_bool", "to_u64", "to_string", "to_ts",
           "cast_code", "safe_ratio", "tick_to_seconds", "grenade_category", "opposite_side",
           "not_in_list"]
